"""WARC archives in seekable Zstandard bundles.

Each task writes its records into archives of independent frames; a frame holds whole records up
to ``FRAME_BYTES``. A footer in a skippable frame lists the compressed and plain size of every
frame, and the index maps each record to (archive, frame, offset inside the plain frame, length),
so one record is read by decompressing one frame. Payloads that occur more than once are written
once; the others are revisit records that point to it.

Archives go to a folder every executor reaches, by URI through ``pyarrow.fs``. A task names its
archives anew on every attempt, and only the index, committed by Spark as a Parquet table, says
which archives count: files of a failed attempt are never read.

Defined results: null html is an empty payload, and all empty payloads are equal; of equal
payloads the smallest page id is the response (a null id only when there is no other); repeated
rows with that id are all responses; a very long page is a frame of its own; an empty table
gives an empty index; other columns are ignored.
"""

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.session import scratch_dir, stage

FRAME_BYTES = 1 << 19
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

# Fixed values of the seekable Zstandard format: skippable frame, footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "page_id long, archive string, frame int, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _id(name: str) -> int | None:
    number = name[len("<urn:x-page:"):-1]
    return int(number) if number else None


def build_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps digest and length of the payload it leaves out."""
    block = HTTP if revisit else HTTP + payload
    url = "".join(" " if c in "\r\n" else c for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    head = data[at:stop].decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, data[begin:end], end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: a skippable frame with the sizes of all frames."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame of an open archive."""
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    raw = file.read_at(8 * count, size - 9 - 8 * count)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


class _Archive:
    def __init__(self, folder: str):
        from pyarrow import fs
        import zstandard
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes, self.records, self.plain, self.written = [], [], 0, 0

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        if self.records and self.plain + len(record) > FRAME_BYTES:
            self.end_frame()
        place = (self.name, len(self.sizes), self.plain, len(record))
        self.records.append(record)
        self.plain += len(record)
        return place

    def end_frame(self) -> None:
        if self.records:
            packed = self.squeeze.compress(b"".join(self.records))
            self.out.write(packed)
            self.sizes.append((len(packed), self.plain))
            self.written += len(packed)
            self.records, self.plain = [], 0

    def close(self) -> None:
        self.end_frame()
        self.out.write(seek_table(self.sizes))
        self.out.close()


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, sha, refers_to) of every page whose payload another page holds as its response."""
    narrow = pages.select("page_id", F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")).alias("sha"))
    groups = narrow.groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("refers_to")).filter("n > 1 AND refers_to IS NOT NULL")
    return narrow.join(groups.select("sha", "refers_to"), "sha").filter(
        "page_id IS NULL OR page_id <> refers_to").select("page_id", "sha", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html) as archives in ``folder``; returns the committed index."""
    again = stage(revisits(pages), "revisits").withColumnRenamed("page_id", "_page")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.join(again.select("_page", "refers_to", "sha"), F.col("page_id").eqNullSafe(F.col("_page")) & (F.sha1("payload") == F.col("sha")), "left")
    rows = rows.select("page_id", "url", "payload", "refers_to")

    def run(batches):
        archive = None
        for batch in batches:
            found = []
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    archive = _Archive(folder)
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                found.append((page_id, *archive.add(build_record(page_id, url, payload, digest, refers_to, refers_to is not None))))
                if archive.written > ARCHIVE_BYTES:
                    archive.close()
                    archive = None
            columns = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                names=["page_id", "archive", "frame", "offset", "length"])
        if archive is not None:
            archive.close()

    return stage(rows.mapInArrow(run, INDEX), "index")


def _record(headers: dict[str, str], block: bytes) -> tuple:
    kind, payload = headers["WARC-Type"], block[len(HTTP):]
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    else:
        size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    refers = headers.get("WARC-Refers-To")
    return (_id(headers["WARC-Record-ID"]), size, digest, kind, None if refers is None else _id(refers),
            headers["WARC-Target-URI"], payload)


def read_records(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that ``index`` lists (all of it, or the rows of some pages), by seeking.

    Each frame that holds a listed record is read once. Work is dealt out by frame.
    """
    frames = index.groupBy("archive", "frame").agg(F.collect_list("offset").alias("offsets"))  # a frame has a bounded size
    width = 7 if payload else 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][:width]
    names = [x.split()[0] for x in RECORD.split(", ")][:width]

    def run(batches):
        import zstandard
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(folder)
        plain, name, file, table = zstandard.ZstdDecompressor(), None, None, []
        for batch in batches:
            for archive, frame, offsets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    if file is not None:
                        file.close()
                    name, file = archive, system.open_input_file(f"{path}/{archive}")
                    table = read_seek_table(file, file.size())
                at, packed, size = table[frame]
                data = plain.decompress(file.read_at(packed, at), max_output_size=size)
                found = [_record(*parse_record(data, x)[:2])[:width] for x in sorted(offsets)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)
        if file is not None:
            file.close()

    return frames.sortWithinPartitions("archive", "frame").mapInArrow(run, ", ".join(RECORD.split(", ")[:width]))


def new_folder(spark) -> str:
    folder = scratch_dir(spark).rstrip("/")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return f"{folder}/warc-{uuid.uuid4().hex}"


def query(spark, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    index = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), folder)
    return read_records(index, folder, payload=False).drop("url")
