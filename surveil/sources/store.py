"""The result tables, as Parquet folders under one root.

Tables that only grow (readings, reports) are appended to; a table of their keys, in buckets by a
hash of the key, tells whatever event time a copy carries. Tables that are replaced (windows, whole
tables) are written beside what is there, each write under a commit of its own, and switched by one
file: ``_commits/<number>.json`` says which commit holds a window or a table from then on. The file
is created only if no other writer has taken the number, so two writers cannot make the same commit,
and all tables written in one transaction change together.
"""

import json
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from surveil import schemas
from surveil.functions.clock import utc
from surveil.functions.display import nan_to_null
from surveil.operators.clusters import latest_assignment
from surveil.operators.keyed import insert_if_absent
from surveil.session import delete_path

# table -> schema, column its date partition comes from, further partition column
TABLES: dict[str, tuple[StructType, str | None]] = {
    "vitals_results": (schemas.STORED_READING, "event_time"),
    "geo_events": (schemas.STORED_REPORT, "event_time"),
    "assignments": (schemas.ASSIGNMENT, "window_end"),
    "clusters": (schemas.CLUSTER, "window_end"),
    "region_risk": (schemas.REGION_RISK, "window_end"),
    "forecasts": (schemas.FORECAST, None),
    "evaluation": (schemas.EVALUATION, None),
    "quarantine": (schemas.fields("feed string, batch_id bigint, reject_reason string, record string"), None),
    "late_reports": (schemas.STORED_REPORT, None),
    "batch_metrics": (schemas.BATCH_METRICS, None),
    "stream_progress": (schemas.STREAM_PROGRESS, None),
}
RESULT_TABLES = ["vitals_results", "geo_events", "clusters", "region_risk", "forecasts"]
VERSIONED = {"forecasts", "evaluation"}
KEY_BUCKETS = 64
_MARKER = "_surveil_store"


def _storable(field: StructField):
    """The column in its stored type; a number that is none is stored as NULL."""
    value = F.col(field.name).cast(field.dataType)
    return nan_to_null(value) if isinstance(field.dataType, DoubleType) else value


def _known(table: str) -> tuple[StructType, str | None]:
    if table not in TABLES:
        raise ValueError(f"Unknown table: {table}")
    return TABLES[table]


class Store:
    """Reads and writes the tables; every write is one committed Spark job."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        _known(table)
        return f"{self.root}/{table}"

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def status(self) -> str:
        """'missing' (no store), 'empty' (no results yet) or 'ok'."""
        if not self._exists(self.root):
            return "missing"
        return "ok" if self._exists(self.path("vitals_results")) else "empty"

    def table_names(self) -> set[str]:
        return {name for name in TABLES if self._exists(self.path(name))}

    def create(self) -> None:
        """Mark the root as ours, so that ``reset`` can never delete another folder."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{_MARKER}")
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True).close()

    def reset(self) -> None:
        """Delete store and checkpoints together (checkpoints live under the root)."""
        if self._exists(self.root) and not self._exists(f"{self.root}/{_MARKER}"):
            raise ValueError(f"{self.root} is not a store; nothing was deleted")
        delete_path(self.spark, self.root)

    # reading

    def read(self, table: str) -> DataFrame:
        """All rows; a table that does not exist yet is empty with the right schema."""
        schema, time = _known(table)
        if not self._exists(self.path(table)):
            return self.spark.createDataFrame([], schema)
        if table in VERSIONED:
            return self._in_force(table, self.spark.read.schema(StructType(list(schema.fields)).add("commit", "string")).parquet(self.path(table))).select(*schema.names)
        return (self._by_day(table) if time else self.spark.read.schema(schema).parquet(self.path(table))).select(*schema.names)

    def _by_day(self, table: str) -> DataFrame | None:
        schema, time = _known(table)
        if not self._exists(self.path(table)):
            return None
        stored = StructType(list(schema.fields)).add("day", "date")
        if time != "window_end":
            return self.spark.read.schema(stored).parquet(self.path(table))
        return self._in_force(table, self.spark.read.schema(stored.add("slot", "string").add("commit", "string")).parquet(self.path(table)))

    # commits

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit_numbers(self, folder: str = "_commits") -> list[int]:
        path, fs = self._fs(f"{self.root}/{folder}")
        if not fs.exists(path):
            return []
        return sorted(int(status.getPath().getName().split(".")[0]) for status in fs.listStatus(path) if status.getPath().getName().endswith(".json"))

    def commits(self, upto: int | None = None) -> DataFrame:
        """(table, day, slot, commit, seq): what is in force, or was after commit ``upto``."""
        numbers = [n for n in self._commit_numbers() if upto is None or n <= upto]
        if not numbers:
            return self.spark.createDataFrame([], schemas.COMMIT)
        rows = self.spark.read.schema(schemas.COMMIT).json([f"{self.root}/_commits/{n:012d}.json" for n in numbers])
        return rows.groupBy("table", "day", "slot").agg(F.max(F.struct("seq", "commit")).alias("x")).select("table", "day", "slot", "x.commit", "x.seq")

    def _in_force(self, table: str, rows: DataFrame) -> DataFrame:
        held = self.commits().filter(F.col("table") == table)
        if table in VERSIONED:
            return rows.join(held.select("commit"), "commit", "left_semi")
        return rows.join(held.select("day", "slot", "commit"), ["day", "slot", "commit"], "left_semi")

    def _publish(self, entries: list[tuple[str, str | None, str | None, str]]) -> int:
        """Put (table, day, slot, commit) in force at once; returns the number of the commit."""
        seq = max([0, *self._commit_numbers(), *self._commit_numbers("_claims")])
        while True:
            seq += 1
            claim, fs = self._fs(f"{self.root}/_claims/{seq:012d}.json")
            try:
                fs.create(claim, False).close()      # only one writer can create it; a number nobody commits stays a gap
                break
            except Exception:
                if not fs.exists(claim):
                    raise
        rows = [{"seq": seq, "table": t, "day": d, "slot": s, "commit": c} for t, d, s, c in entries]
        pending, _ = self._fs(f"{self.root}/_pending/{uuid.uuid4().hex}")
        out = fs.create(pending, False)
        out.write(bytearray(("\n".join(map(json.dumps, rows)) + "\n").encode("utf-8")))
        out.close()
        target, _ = self._fs(f"{self.root}/_commits/{seq:012d}.json")
        fs.mkdirs(target.getParent())
        if not fs.rename(pending, target):           # readers see the whole file or none
            raise OSError(f"cannot commit {target}")
        return seq

    @contextmanager
    def transaction(self):
        """``put(table, rows, windows)`` writes beside what is there; all of it counts once the block ends well."""
        entries, commit = [], uuid.uuid4().hex

        def put(table: str, rows: DataFrame, windows: list[tuple[str, str]] | None = None) -> None:
            _, time = _known(table)
            shaped = self._shaped(rows, table).withColumn("commit", F.lit(commit))
            if table in VERSIONED:
                shaped.write.mode("append").partitionBy("commit").parquet(self.path(table))
                entries.append((table, None, None, commit))
                return
            if time != "window_end":
                raise ValueError(f"{table} is not replaced")
            shaped.write.mode("append").partitionBy("day", "slot", "commit").parquet(self.path(table))
            entries.extend((table, day, slot, commit) for day, slot in (self.windows_of(rows) if windows is None else windows))
        yield put
        if entries:
            self._publish(entries)

    def vacuum(self) -> int:
        """Merge all commits into one and delete what it does not hold; no reader or writer may be at work.

        Returns the number of folders deleted.
        """
        rows = self.commits().collect()
        held = {(r["table"], str(r["day"]) if r["day"] else None, r["slot"], r["commit"]) for r in rows}
        if held:
            last = self._publish(sorted(held, key=str))
            for folder in ("_commits", "_claims"):
                for n in self._commit_numbers(folder):
                    if n < last:
                        delete_path(self.spark, f"{self.root}/{folder}/{n:012d}.json")
        gone = 0
        for table, (_, time) in TABLES.items():
            if time != "window_end" and table not in VERSIONED or not self._exists(self.path(table)):
                continue
            columns = "commit string" if table in VERSIONED else "day date, slot string, commit string"
            rows = self.spark.read.schema(schemas.fields(columns)).parquet(self.path(table)).distinct()
            for r in rows.collect():
                day, slot = (str(r["day"]), r["slot"]) if "day" in columns else (None, None)
                if (table, day, slot, r["commit"]) not in held:
                    delete_path(self.spark, f"{self.path(table)}/" + (f"day={day}/slot={slot}/" if day else "") + f"commit={r['commit']}")
                    gone += 1
        return gone

    def read_range(self, table: str, start: datetime, end: datetime) -> DataFrame:
        """Rows with start < time <= end; the date partitions are pruned.

        Bounds without a zone are UTC, whatever the zone of this process.
        """
        schema, time = _known(table)
        rows = self._by_day(table)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        first, last = utc(start), utc(end)
        pruned = F.col("day").between(F.to_date(first), F.to_date(last))
        return rows.filter(pruned & (F.col(time) > first) & (F.col(time) <= last)).select(*schema.names)

    def read_days(self, table: str, days: list[str]) -> DataFrame:
        """Rows of the named days (UTC, ISO text); other partitions are not listed."""
        schema, _ = _known(table)
        rows = self._by_day(table)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        return rows.filter(F.col("day").isin([F.lit(d).cast("date") for d in days])).select(*schema.names)

    def days_of(self, rows: DataFrame) -> list[str]:
        """The UTC days of ``event_time``, as ISO text: as many as a batch touches."""
        found = rows.filter("event_time IS NOT NULL").select(F.date_format("event_time", "yyyy-MM-dd").alias("d")).distinct()
        return sorted(r["d"] for r in found.collect())

    def windows_of(self, ends: DataFrame) -> list[tuple[str, str]]:
        """(day, slot) of window ends: the partitions of a window table."""
        found = ends.select(F.date_format("window_end", "yyyy-MM-dd").alias("d"), F.date_format("window_end", "HHmm").alias("s")).distinct()
        return sorted((r["d"], r["s"]) for r in found.collect())

    def now(self) -> str:
        """One time for a whole batch, as text with its zone."""
        return datetime.now(timezone.utc).isoformat(timespec="microseconds")

    def geo_events(self) -> DataFrame:
        """Reports with the cluster of the last window that included them."""
        last = latest_assignment(self.read("assignments")).drop("window_end")
        return self.read("geo_events").join(last, "event_id", "left").withColumn(
            "in_cluster", F.coalesce("in_cluster", F.lit(False)))

    def newest_micros(self, table: str) -> int | None:
        """Newest event time in microseconds since 1970; only the newest day is read."""
        rows = self._by_day(table)
        if rows is None:
            return None
        newest = rows.agg(F.max("day"))
        return rows.filter(F.col("day") == newest.scalar()).agg(F.max(F.unix_micros("event_time"))).first()[0]

    def counts(self) -> DataFrame:
        out = None
        for name in RESULT_TABLES:
            one = self.read(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            out = one if out is None else out.unionByName(one)
        return out

    # writing

    def _shaped(self, rows: DataFrame, table: str) -> DataFrame:
        schema, time = _known(table)
        shaped = rows.select(*[_storable(f).alias(f.name) for f in schema.fields])
        if time:
            shaped = shaped.withColumn("day", F.to_date(time))
        if time == "window_end":
            shaped = shaped.withColumn("slot", F.date_format(time, "HHmm"))
        return shaped

    def _keys(self, table: str, buckets: list[int]) -> DataFrame:
        """Stored keys of some buckets."""
        path = f"{self.root}/_keys/{table}"
        if not self._exists(path):
            return self.spark.createDataFrame([], "event_id string")
        keys = self.spark.read.schema("event_id string, bucket int").parquet(path)
        return keys.filter(F.col("bucket").isin(buckets)).select("event_id")

    def _add_keys(self, table: str, keys: DataFrame, buckets: list[int] | None) -> None:
        bucket = F.pmod(F.xxhash64("event_id"), F.lit(KEY_BUCKETS)).cast("int")
        if buckets is not None:
            keys = keys.join(self._keys(table, buckets), "event_id", "left_anti")
        keys.withColumn("bucket", bucket).write.mode("append").partitionBy("bucket").parquet(f"{self.root}/_keys/{table}")

    def insert_if_absent(self, table: str, batch: DataFrame, days: list[str] | None = None) -> int:
        """Append rows whose key is not stored yet and return how many.

        Stored copies are looked for in the key table, in the buckets that the batch's keys fall in,
        whatever event time they have. Keys are added after the rows; a batch that failed in between
        finds its own rows on its days (``days``; by default those of the batch) when it is tried again.
        """
        if not self._exists(f"{self.root}/_keys/{table}") and self._exists(self.path(table)):
            self._add_keys(table, self.read(table).select("event_id").distinct(), None)   # a store from before the key table
        keys = batch.select("event_id").filter("event_id IS NOT NULL").distinct()
        buckets = [r[0] for r in keys.select(F.pmod(F.xxhash64("event_id"), F.lit(KEY_BUCKETS)).cast("int")).distinct().collect()]
        own_days = self.read_days(table, self.days_of(batch) if days is None else days).select("event_id")
        stored = self._keys(table, buckets).unionByName(own_days)
        written = Observation()
        new = self._shaped(insert_if_absent(batch, stored), table).observe(written, F.count(F.lit(1)).alias("n"))
        new.write.mode("append").partitionBy("day").parquet(self.path(table))
        self._add_keys(table, keys, buckets)
        return written.get.get("n", 0)

    def overwrite_windows(self, table: str, rows: DataFrame, windows: list[tuple[str, str]] | None = None) -> None:
        """Replace the windows present in ``rows``, or ``windows`` (day, slot); those without rows become empty."""
        with self.transaction() as put:
            put(table, rows, windows)

    def replace_batch(self, table: str, feed: str, batch_id: int, rows: DataFrame) -> None:
        """The rows a batch of a feed adds to a side table; tried again, the batch replaces them."""
        schema, _ = _known(table)
        own = {"feed": F.lit(feed), "batch_id": F.lit(batch_id).cast("long")}
        shaped = rows.withColumns(own).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in own], *own)
        shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feed", "batch_id").parquet(self.path(table))

    def record_batch(self, feed: str, batch_id: int, read: int, rejected: int, new: int, flagged: int | None) -> None:
        """The counters of a batch; the first record stays, for a second try finds its events stored already."""
        if self._exists(f"{self.path('batch_metrics')}/feed={feed}/batch_id={batch_id}"):
            return
        row = self.spark.createDataFrame([(read, rejected, new, flagged)], "rows_read bigint, rows_rejected bigint, rows_new bigint, rows_flagged bigint")
        self.replace_batch("batch_metrics", feed, batch_id, row.withColumn("recorded_at", F.current_timestamp()))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Publish a new version of a whole table.

        Readers see the old content until the new one is committed; of two writers, the later commit stays.
        """
        if table not in VERSIONED:
            raise ValueError(f"{table} is not replaced as a whole")
        with self.transaction() as put:
            put(table, rows)
