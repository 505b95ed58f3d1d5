"""Both feeds as Structured Streaming jobs, and the batch jobs that follow them.

Each feed is one query with its own checkpoint. A micro-batch stays a DataFrame from the files to
the store. Every write of a batch is keyed by what it replaces (an event, a window, or the batch
itself), so a batch that is tried again leaves the tables as one that worked at once. Times stay in
Spark; what reaches the driver are counters and the names of touched days and windows.
"""

import time
from collections import deque
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from surveil import schemas
from surveil.constants import CLUSTER_WINDOW_MINUTES, TRIGGER_SECONDS
from surveil.functions.clock import latency_seconds
from surveil.operators.clusters import cluster_summary, window_members
from surveil.operators.dbscan import find_clusters
from surveil.operators.forecast import trend_forecast
from surveil.operators.history import series_history
from surveil.operators import iforest, validate
from surveil.operators.keyed import first_copy
from surveil.operators.validate import reading_rules, reject_reason, report_rules, with_reason
from surveil.plans.evaluation import evaluate_clusters, evaluate_flags
from surveil.plans.reports import evaluation_table
from surveil.plans.risk import risk_of_windows
from surveil.session import staged_tables
from surveil.sources.files import CORRUPT, stream_json
from surveil.sources.store import Store

Handler = Callable[[DataFrame, int], None]

REPLAY_DELAY = "2 hours"
PROGRESS_SECONDS = 10
_HEAP_STATE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BatchTooLarge(RuntimeError):
    """A micro-batch held more valid records than its feed allows."""


def with_processing_time(rows: DataFrame, at=None) -> DataFrame:
    """``processed_at`` (one value for the batch) and the latency since ``created_at``."""
    return rows.withColumn("processed_at", F.current_timestamp() if at is None else at.cast("timestamp")).withColumn(
        "latency_seconds", latency_seconds(F.col("created_at"), F.col("processed_at")))


@dataclass
class Feed:
    """What differs between the feeds: rules, stored names, and what happens after the insert."""
    name: str
    schema: object
    rules: list
    table: str
    renames: dict
    prepare: Callable[[DataFrame], DataFrame]
    after: Callable[[DataFrame, int, object], None]
    before: Callable[[], object] = lambda: None       # its answer is handed to ``after`` of the same batch
    limit: int | None = None

    def handler(self, store: Store) -> Handler:
        def handle(batch: DataFrame, batch_id: int) -> None:
            if batch.isEmpty():
                return
            with staged_tables(store.spark):
                self._handle(store, batch, batch_id)
        return handle

    def _handle(self, store: Store, batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        marked = with_reason(batch, self.rules).observe(
            seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("reject_reason").isNotNull()).alias("rejected")).persist()
        try:
            marked.count()
            counts = seen.get
            if self.limit is not None and counts["read"] - counts["rejected"] > self.limit:
                raise BatchTooLarge(f"batch {batch_id} of {self.name}: more than {self.limit} valid records")
            text = F.to_json(F.struct(*[c for c in batch.columns if c != CORRUPT]))
            raw = F.coalesce(F.col(CORRUPT), text) if CORRUPT in batch.columns else text
            store.replace_batch("quarantine", self.name, batch_id, marked.filter("reject_reason IS NOT NULL").select(
                "reject_reason", raw.alias("record")))
            valid = marked.filter("reject_reason IS NULL").drop("reject_reason", CORRUPT).withColumnsRenamed(self.renames)
            known = self.before()
            flagged = Observation()
            rows = with_processing_time(self.prepare(valid), F.lit(store.now()))
            if "predicted_anomaly" in rows.columns:
                rows = rows.observe(flagged, F.count_if(F.col("predicted_anomaly")).alias("n"))
            new = store.insert_if_absent(self.table, rows, store.days_of(valid))
            store.record_batch(self.name, batch_id, counts["read"], counts["rejected"], new,
                               (flagged.get.get("n", 0) if "predicted_anomaly" in rows.columns else None))
            self.after(valid, batch_id, known)
        finally:
            marked.unpersist()


def vitals_feed(store: Store, score: Callable[[DataFrame], DataFrame], slide: int = CLUSTER_WINDOW_MINUTES,
                limit: int | None = None) -> Feed:
    """Scored readings. ``score`` adds anomaly_score and predicted_anomaly; windows that already
    have clusters get their risk again, so risk follows readings that come late."""
    return Feed("vitals", schemas.READING, reading_rules(), "vitals_results", {"region_id": "region"}, score,
                lambda valid, *_: refresh_risk(store, slide, valid), limit=limit)


def reports_feed(store: Store, slide: int = CLUSTER_WINDOW_MINUTES, lateness: timedelta | None = None,
                 limit: int | None = None) -> Feed:
    """Reports; the windows they fall in, and only those, are clustered again.

    With ``lateness``, reports older than the newest one stored before the batch by more than that
    are stored and listed in ``late_reports``, but re-open nothing.
    """
    names = {"region_id": "region", "symptom_category": "symptom_type"}

    def before() -> int | None:
        return store.newest_micros("geo_events") if lateness is not None else None

    def after(valid: DataFrame, batch_id: int, newest: int | None) -> None:
        if newest is not None:
            late = F.unix_micros("event_time") < F.lit(newest - int(lateness.total_seconds() * 1e6))
            store.replace_batch("late_reports", "reports", batch_id, with_processing_time(valid.filter(late), F.lit(store.now())))
            valid = valid.filter(~late)
        update_windows(store, valid, slide)

    return Feed("reports", schemas.REPORT, report_rules(), "geo_events", names, lambda valid: valid, after, before, limit)


def vitals_handler(store: Store, score: Callable[[DataFrame], DataFrame], limit: int | None = None) -> Handler:
    return vitals_feed(store, score, limit=limit).handler(store)


def reports_handler(store: Store, slide: int = CLUSTER_WINDOW_MINUTES, lateness: timedelta | None = None,
                    limit: int | None = None) -> Handler:
    return reports_feed(store, slide, lateness, limit).handler(store)


def _touched(rows: DataFrame, minutes: int, slide: int) -> DataFrame:
    return window_members(rows.select("event_time"), minutes, slide).select("window_end").distinct()


def update_windows(store: Store, touched_by: DataFrame, slide: int = CLUSTER_WINDOW_MINUTES) -> None:
    """Cluster and score again every window that holds one of the given reports."""
    minutes = CLUSTER_WINDOW_MINUTES
    ends = _touched(touched_by, minutes, slide)
    windows = store.windows_of(ends)
    if not windows:
        return
    days = store.days_of(ends.select(F.explode(F.array("window_end", F.col("window_end") - F.expr(f"INTERVAL {minutes} MINUTES"))).alias("event_time")))
    members = window_members(store.read_days("geo_events", days), minutes, slide).join(ends, "window_end", "left_semi")
    labelled = find_clusters(members.select("window_end", "event_id", "event_time", "latitude", "longitude",
                                            "region", "case_count"))
    now = F.current_timestamp()
    risk = risk_of_windows(labelled, store.read_days("vitals_results", days), minutes, slide)
    with store.transaction() as put:      # a window's assignments, clusters and risk change together
        put("assignments", labelled, windows)
        put("clusters", cluster_summary(labelled).withColumn("calculated_at", now), windows)
        put("region_risk", risk.withColumn("calculated_at", now), windows)


def refresh_risk(store: Store, slide: int = CLUSTER_WINDOW_MINUTES, touched_by: DataFrame | None = None) -> None:
    """Risk of stored windows from stored assignments, for readings that came after the reports.

    ``touched_by`` limits it to the windows that hold one of those readings.
    """
    minutes = CLUSTER_WINDOW_MINUTES
    assigned = store.read("assignments")
    readings, reports = store.read("vitals_results"), store.read("geo_events")
    if touched_by is not None:
        ends = _touched(touched_by, minutes, slide)
        days = store.days_of(ends.select(F.explode(F.array("window_end", F.col("window_end") - F.expr(f"INTERVAL {minutes} MINUTES"))).alias("event_time")))
        assigned = store.read_days("assignments", days).join(ends, "window_end", "left_semi")
        readings, reports = store.read_days("vitals_results", days), store.read_days("geo_events", days)
    windows = store.windows_of(assigned.select("window_end").distinct())
    if not windows:
        return
    members = assigned.join(reports.select("event_id", "region", "case_count"), "event_id")
    risk = risk_of_windows(members, readings, minutes, slide)
    store.overwrite_windows("region_risk", risk.withColumn("calculated_at", F.current_timestamp()), windows)


def publish_forecasts(store: Store) -> None:
    """Forecast every series of the stored reports and replace the forecast table."""
    cases = store.read("geo_events").select("event_time", "region", "symptom_type", "case_count")
    history = series_history(cases)
    rows = trend_forecast(history).withColumn("generated_at", F.current_timestamp())
    store.replace("forecasts", rows)


def publish_evaluation(store: Store, train: DataFrame, held_out: DataFrame, labels: DataFrame, reports: DataFrame,
                       report_labels: DataFrame, model_path: str, **options) -> None:
    """Train and save a forest on one part, score the other with the saved model, replay the reports, compare both with the
    labels that were kept apart, and replace the evaluation table."""
    iforest.save(iforest.train(validate.valid_readings(train), **options), model_path)
    scored = iforest.score(iforest.load(store.spark, model_path), first_copy(validate.valid_readings(held_out)))
    store.replace("evaluation", evaluation_table(
        ("forest", evaluate_flags(scored, labels)), ("dbscan", evaluate_clusters(first_copy(validate.valid_reports(reports)), report_labels))))


TRIGGERS = {"once": {"availableNow": True}, "continuous": {"processingTime": f"{TRIGGER_SECONDS} seconds"}}


def start_feed(stream: DataFrame, name: str, handler: Handler, checkpoint: str, mode: str):
    """'once' drains what is there and stops; 'continuous' looks for files every few seconds."""
    if mode not in TRIGGERS:
        raise ValueError(f"Unknown mode: {mode}")
    return stream.writeStream.queryName(name).foreachBatch(handler).option(
        "checkpointLocation", checkpoint).trigger(**TRIGGERS[mode]).start()


def without_replays(stream: DataFrame, delay: str = REPLAY_DELAY, rules: list | None = None) -> DataFrame:
    """Drop replays inside the stream: a valid record whose key came with one already.

    The state is bounded by ``delay`` after the arrival of a record, not after its event time, so an
    event that is late, however late, is kept. Records that fail a rule (without ``rules``: those
    without a key) pass as they are: they are counted and rejected one by one, and a valid copy that
    follows a broken one is not taken for a replay.
    """
    valid = F.col("event_id").isNotNull() if rules is None else reject_reason(rules).isNull()
    marked = stream.withColumn("_arrived", F.current_timestamp()).withColumn(
        "_key", F.when(valid, F.concat(F.lit("id:"), F.col("event_id"))).otherwise(F.uuid()))
    return marked.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_arrived", "_key")


class ProgressLog(StreamingQueryListener):
    """Batch durations, rows and state sizes of the feeds, for the table ``stream_progress``.

    Spark reports on a thread of its own; rows wait here until ``flush`` writes them.
    """

    def __init__(self):
        self.waiting: deque = deque()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        dropped = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in state)
        self.waiting.append((p.name, p.batchId, p.timestamp, p.durationMs.get("triggerExecution", 0), p.durationMs.get("addBatch", 0), p.numInputRows,
                             float(p.processedRowsPerSecond or 0.0), sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state), dropped))

    def flush(self, store: Store) -> int:
        """Write what waits; batches without rows are left out. Returns the number of batches written."""
        rows = {}
        while self.waiting:
            row = self.waiting.popleft()
            if row[5]:
                rows[row[0], row[1]] = row
        for (feed, batch_id), row in rows.items():
            one = store.spark.createDataFrame([row[2:]], "started_at string, batch_ms bigint, write_ms bigint, rows_read bigint, rows_per_second double,"
                                              " state_rows bigint, state_bytes bigint, replays_dropped bigint")
            store.replace_batch("stream_progress", feed, batch_id, one.withColumn("started_at", F.col("started_at").cast("timestamp")))
        return len(rows)


def run(spark: SparkSession, store: Store, vitals_dir: str, reports_dir: str, score: Callable[[DataFrame], DataFrame],
        mode: str, stop_after: float | None = None, slide: int = CLUSTER_WINDOW_MINUTES,
        lateness: timedelta | None = None, limit: int | None = None, replays: str | None = REPLAY_DELAY) -> None:
    """Run both feeds. In 'once' mode readings come first, so risk sees all of them.

    Replays within ``replays`` of the first copy are dropped in the stream (None: only in the
    store, where copies of any age are found). ``limit`` is the most valid records a batch may have.
    Progress goes to ``stream_progress``. A failing query ends the run with its own exception.
    """
    store.create()
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) in (None, _HEAP_STATE):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", _DISK_STATE)
    feeds = [(vitals_feed(store, score, slide, limit), vitals_dir), (reports_feed(store, slide, lateness, limit), reports_dir)]
    progress = ProgressLog()
    spark.streams.addListener(progress)
    running = []
    try:
        for feed, folder in feeds:
            stream = stream_json(spark, folder, feed.schema)
            stream = stream if replays is None else without_replays(stream, replays, feed.rules)
            running.append(start_feed(stream, feed.name, feed.handler(store),
                                      f"{store.root}/checkpoints/{feed.name}", mode))
            if mode == "once":
                running[-1].awaitTermination()
        if mode == "continuous":
            spark.streams.resetTerminated()
            end = None if stop_after is None else time.monotonic() + stop_after
            while end is None or time.monotonic() < end:
                if spark.streams.awaitAnyTermination(PROGRESS_SECONDS if end is None else max(1, min(PROGRESS_SECONDS, int(end - time.monotonic())))):
                    break
                progress.flush(store)
            for query in running:  # one that failed hands its exception on
                if not query.isActive:
                    query.awaitTermination()
    finally:
        for query in running:
            query.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)   # the last reports are on their way
        spark.streams.removeListener(progress)
        progress.flush(store)
