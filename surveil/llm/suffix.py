"""Suffix-array removal of repeated strings: difference cover, one bucket of suffixes at a time.

A byte goes when a 100-byte string over it also starts earlier (smaller document id, or earlier in
the same document); documents do not join. Sorting every suffix of a corpus would move many times
its size, so the text is parsed first, as prefix-free parsing does for large suffix arrays:

1. Every 100-byte window picks an anchor, the leftmost of its 24-byte strings with the least hash.
   Consecutive windows with one anchor form a phrase. Equal windows have equal anchors at equal
   distance, so they lie in phrases with the same key (the anchor's hash).
2. Phrases whose key occurs once hold no repeat and leave. The rest form a dictionary of distinct
   phrases with the first place of each.
3. Suffix buckets: the windows of the distinct phrases under one key, split further by the hash of
   the window where a key has many phrases. A task takes one bucket after the other and sorts its
   suffixes by their first 31 bytes. Long ties are resolved by the ranks of a difference-cover
   sample: positions whose distance from the anchor is in D modulo 31 are ranked beforehand by
   doubling, and a suffix takes the rank of the next sample position. Memory follows the bucket.
4. Neighbours in that order that agree on all 100 bytes form a class; its smallest place stays, and
   every other place of its phrases is removed.

Defined results: null text is empty; a null id comes after all others; rows that repeat an id
are one document for the order, so neither is earlier at the same start, but each loses only its
own bytes (``row``, a hash of the text, tells them apart); texts under 100 bytes lose nothing; any length is handled in segments; an empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.words import BYTE_VALUES, RADIX, _constants, as_bytes, mix, resting, slices
from surveil.session import release_shuffles, stage, unstage

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1            # anchor positions in a window
POSITION_BITS = 17
CHUNK = (1 << POSITION_BITS) - 64
SEGMENT = CHUNK - 256               # window starts of one segment
PHRASES_PER_BUCKET = 2000
BUCKET_WORK = 1 << 19            # bytes and windows of phrases sorted at a time; each takes some 100 bytes of a task
LAST_ID = (1 << 63) - 1

# A perfect difference set; every distance modulo 31 is a difference of two of them.
PERIOD, COVER = 31, [0, 1, 3, 8, 12, 18]
IN_COVER = np.isin(np.arange(PERIOD), COVER)
TO_COVER = np.array([min(d for d in range(PERIOD) if (c + d) % PERIOD in COVER) for c in range(PERIOD)])

_U = np.uint64
_SECOND = _constants("phrase-byte", 256)
_BASE = int(_constants("phrase-radix", 1)[0])
_POWERS: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    if base not in _POWERS:
        table = np.full(n, base, _U)
        table[0] = 1
        _POWERS[base] = np.multiply.accumulate(table)
    return _POWERS[base]


def phrases_of(chunk: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """(segment, first window, windows, anchor, key, hash) of all phrases in a chunk of segments.

    Positions are relative to the chunk.
    """
    n = len(chunk)
    g, power = BYTE_VALUES[chunk], RADIX
    grams = {1: g}
    for size in (1, 2, 4, 8):
        g = g[:-size] + g[size:] * _U(power)
        grams[2 * size] = g
        power = power * power % (1 << 64)
    full = grams[16][:n - GRAM + 1] + grams[8][16:16 + n - GRAM + 1] * _U(power)
    full = mix(full)
    low = _U((1 << POSITION_BITS) - 1)
    least = (full & ~low) | np.arange(len(full), dtype=_U)
    step = 1
    while 2 * step <= SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:len(least) - (SPAN - step)], least[SPAN - step:])
    windows = np.maximum(sizes - LENGTH + 1, 0)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(int(windows.sum()))
    segment = np.repeat(np.arange(len(starts)), windows)
    anchor = (least[at] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])])) if len(at) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(at)))
    p0, anchor, segment = at[first], anchor[first], segment[first]
    up = _power_table(_BASE, CHUNK + 512)
    down = _power_table(pow(_BASE, -1, 1 << 64), CHUNK + 512)
    total = np.concatenate([np.zeros(1, _U), np.cumsum(_SECOND[chunk] * up[:n])])
    end = p0 + count + LENGTH - 1
    name = mix((total[end] - total[p0]) * down[p0] + count.astype(_U))
    return segment, p0, count, anchor, full[anchor], name


def _segments(raw: list[bytes]):
    """Chunks: (bytes, document index, offset in the document, start in the chunk, size) per segment."""
    parts, doc, offset, size, total = [], [], [], [], 0
    for i, text in enumerate(raw):
        for o in range(0, len(text) - LENGTH + 1, SEGMENT):
            piece = text[o:o + SEGMENT + LENGTH - 1]
            if parts and total + len(piece) > CHUNK:
                yield _chunk(parts, doc, offset, size)
                parts, doc, offset, size, total = [], [], [], [], 0
            parts.append(piece)
            doc.append(i)
            offset.append(o)
            size.append(len(piece))
            total += len(piece)
    if parts:
        yield _chunk(parts, doc, offset, size)


def _chunk(parts, doc, offset, size):
    sizes = np.array(size)
    return np.frombuffer(b"".join(parts), np.uint8), np.array(doc), np.array(offset), np.cumsum(sizes) - sizes, sizes


def parse(docs: DataFrame) -> DataFrame:
    """(key, name, doc, row, p0, lead, windows): the phrases of every text. No shuffle."""
    @resting
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            own = batch.column(1).to_numpy(zero_copy_only=False)
            raw = [as_bytes(t) for t in batch.column(2).to_pylist()]
            for chunk, doc, offset, start, size in _segments(raw):
                segment, p0, count, anchor, key, name = phrases_of(chunk, start, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(name.view(np.int64)), pa.array(ids[doc[segment]]), pa.array(own[doc[segment]]),
                     pa.array(p0 - start[segment] + offset[segment]), pa.array((anchor - p0).astype(np.int16)), pa.array(count.astype(np.int16))],
                    names=["key", "name", "doc", "row", "p0", "lead", "windows"])

    return _keyed(docs).mapInArrow(run, "key long, name long, doc long, row long, p0 long, lead short, windows short")


def _keyed(docs: DataFrame, rest: tuple = ()) -> DataFrame:
    """(doc, row, text, rest): ``doc`` is the place in the order, ``row`` tells the texts of one id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"),
                       *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(rest)])


def cover_ranks(text: np.ndarray, sample: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Rank of the suffix (up to its phrase's end) at every sample position.

    ``stop`` is the end of the phrase of each sample. Blocks of 31 bytes are named first; names are
    then doubled, for a sample position plus 31 is a sample position again.
    """
    words = eight_bytes(text)
    ranks = np.zeros(len(text) + 1, np.int64)
    inside = np.minimum(stop - sample, PERIOD)
    keys = [masked(words, sample, 8 * k, inside) for k in range(4)]
    order = np.lexsort([inside, *keys[::-1]])
    ranks[sample] = _names([inside, *keys], order)
    step = PERIOD
    while step < int((stop - sample).max(initial=0)):
        beyond = np.where(sample + step < stop, ranks[np.minimum(sample + step, len(text))], 0)
        own = ranks[sample]
        order = np.lexsort([beyond, own])
        ranks[sample] = _names([own, beyond], order)
        step *= 2
    return ranks


def _names(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 in the given order."""
    if not len(order):
        return np.zeros(0, np.int64)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros beyond the end)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(_U)
    out = padded[:-8]
    for k in range(1, 8):
        out = (out << _U(8)) | padded[k:len(padded) - 8 + k]
    return out


def masked(words: np.ndarray, at: np.ndarray, skip: int, inside: np.ndarray) -> np.ndarray:
    """Bytes ``skip`` to ``skip + 8`` of each suffix, as far as ``inside`` bytes of it."""
    got = words[np.minimum(at + skip, len(words) - 1)]
    left = np.clip(inside - skip, 0, 8)
    return np.where(left > 0, got >> _U(8) * (8 - np.maximum(left, 1)).astype(_U) << _U(8) * (8 - np.maximum(left, 1)).astype(_U), _U(0))


def sort_buckets(text: np.ndarray, start: np.ndarray, stop: np.ndarray, lead: np.ndarray, phrase: np.ndarray,
                 at: np.ndarray, bucket: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each suffix, whether an equal 100-byte string stands at a smaller place.

    Phrases are ``text[start:stop]`` with their anchor ``lead`` bytes in; suffix i starts at
    ``at[i]`` in phrase ``phrase[i]`` and belongs to ``bucket[i]``; ``place`` orders the suffixes.
    """
    words = eight_bytes(text)
    where = np.arange(len(text))
    owner = np.searchsorted(start, where, "right") - 1
    sample = where[IN_COVER[(where - start[owner] - lead[owner]) % PERIOD]]
    ranks = cover_ranks(text, sample, stop[owner[sample]])
    residue = (at - start[phrase] - lead[phrase]) % PERIOD
    rank = ranks[at + TO_COVER[residue]]
    prefix = [words[at], words[at + 8], words[at + 16], words[at + 24] >> _U(8)]
    order = np.lexsort([rank, residue, *prefix[::-1], bucket])
    # equal windows are neighbours now: same bucket, same distance to the anchor, same 100 bytes
    same = (bucket[order][1:] == bucket[order][:-1]) & (residue[order][1:] == residue[order][:-1])
    pair = np.flatnonzero(same)
    for skip in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        pair = pair[words[at[order[pair]] + skip] == words[at[order[pair + 1]] + skip]]
    head = np.ones(len(order), bool)
    head[pair + 1] = False
    begin = np.flatnonzero(head)
    low = np.minimum.reduceat(place[order], begin)
    out = np.empty(len(order), bool)
    out[order] = place[order] > low[np.cumsum(head) - 1]
    return out


def _resolve(rows: list[tuple]) -> pa.RecordBatch:
    """Sort the buckets of complete rows (key, part, name, doc, p0, lead, offsets, bytes)."""
    sizes = np.array([len(r[7]) for r in rows])
    stop = np.cumsum(sizes)
    start = stop - sizes
    text = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
    numbers = np.unique([f"{r[0]}/{r[1]}" for r in rows], return_inverse=True)[1]
    counts = np.array([len(r[6]) for r in rows])
    phrase = np.repeat(np.arange(len(rows)), counts)
    offset = np.concatenate([np.asarray(r[6], np.int64) for r in rows])
    doc = np.array([r[3] for r in rows], np.int64)[phrase]
    position = np.array([r[4] for r in rows], np.int64)[phrase] + offset
    order = np.lexsort([position, doc])
    place = _names([doc, position], order)
    gone = sort_buckets(text, start, stop, np.array([r[5] for r in rows], np.int64), phrase, start[phrase] + offset, numbers[phrase], place)
    found = np.flatnonzero(gone)
    lists: dict[int, list[int]] = {}
    for i, o in zip(phrase[found].tolist(), offset[found].tolist(), strict=True):
        lists.setdefault(i, []).append(o)
    kept = list(lists)
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[i][0] for i in kept], pa.int64()), pa.array([rows[i][2] for i in kept], pa.int64()),
         pa.array([lists[i] for i in kept], pa.list_(pa.int16()))], names=["key", "name", "offsets"])


def foreign_windows(dictionary: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, name, foreign): windows of a phrase's first place that stand earlier elsewhere."""
    sized = dictionary.join(dictionary.groupBy("key").agg(F.ceil(F.count("*") / PHRASES_PER_BUCKET).cast("int").alias("parts")), "key")
    per_doc = sized.groupBy("doc", "row").agg(F.collect_list(F.struct("key", "name", "p0", "lead", "windows", "parts")).alias("wanted"))
    rows = per_doc.join(_keyed(docs), ["doc", "row"]).select("doc", "text", "wanted")

    @resting
    def cut(batches):
        for batch in batches:
            out = []
            for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = as_bytes(text)
                for w in wanted:
                    piece = raw[w["p0"]:w["p0"] + w["windows"] + LENGTH - 1]
                    split: dict[int, list[int]] = {}
                    for o in range(w["windows"]):
                        part = 0 if w["parts"] == 1 else int.from_bytes(hashlib.blake2b(piece[o:o + LENGTH], digest_size=4).digest(), "big") % w["parts"]
                        split.setdefault(part, []).append(o)
                    out += [(w["key"], part, w["name"], doc, w["p0"], w["lead"], offsets, piece) for part, offsets in split.items()]
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.list_(pa.int16()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["key", "part", "name", "doc", "p0", "lead", "offsets", "piece"])

    pieces = rows.mapInArrow(cut, "key long, part int, name long, doc long, p0 long, lead short, offsets array<short>, piece binary")
    pieces = pieces.repartition("key", "part").sortWithinPartitions("key", "part")

    @resting
    def resolve(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > BUCKET_WORK and row[:2] != held[-1][:2]:
                    yield _resolve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6]) + len(row[7])
        if held:
            yield _resolve(held)

    parts = pieces.mapInArrow(resolve, "key long, name long, offsets array<short>")
    return parts.groupBy("key", "name").agg(F.flatten(F.collect_list("offsets")).alias("foreign"))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, row, gone): per text the phrases with removed windows, as (p0, windows, foreign);
    ``foreign`` is null where all windows go."""
    phrases = stage(parse(docs), "phrases", "zstd")
    # one row per key: how often it occurs, and whether its phrases differ
    keys = phrases.groupBy("key").agg(F.count("*").alias("n"), F.min("name").alias("low"), F.max("name").alias("high"))
    # staged, so that a key with very many phrases can be split in the join
    keys = stage(keys.filter("n > 1").select("key", (F.col("low") != F.col("high")).alias("differ")), "keys", "zstd")
    release_shuffles(docs.sparkSession)
    live = stage(phrases.join(keys, "key"), "live", "zstd")
    unstage(phrases)
    release_shuffles(docs.sparkSession)
    first = stage(live.groupBy("key", "name").agg(
        F.min(F.struct("doc", "p0", "row")).alias("first"), F.max("lead").alias("lead"), F.max("windows").alias("windows"),
        F.count("*").alias("n"), F.max("differ").alias("differ")).select("key", "name", "first.*", "lead", "windows", "n", "differ"), "dictionary", "zstd")
    release_shuffles(docs.sparkSession)
    foreign = stage(foreign_windows(first.filter("differ").select("key", "name", "doc", "row", "p0", "lead", "windows"), docs), "foreign", "zstd")
    release_shuffles(docs.sparkSession)
    marked = first.select("key", "name", F.struct("doc", "p0").alias("first"), "n").join(foreign, ["key", "name"], "left").filter("n > 1 OR foreign IS NOT NULL")
    marked = stage(marked, "marked", "zstd")
    unstage(first)
    unstage(foreign)
    release_shuffles(docs.sparkSession)
    here = F.struct("doc", "p0") == F.col("first")
    hits = live.select("key", "name", "doc", "row", "p0", "windows").join(marked, ["key", "name"]).filter(~here | F.col("foreign").isNotNull())
    gone = hits.select("doc", "row", F.struct("p0", "windows", F.when(here, F.col("foreign")).alias("foreign")).alias("hit")).groupBy("doc", "row").agg(
        F.collect_list("hit").alias("gone"))
    # texts move after this: the phrases must not lie beside them
    gone = stage(gone, "gone", "zstd")
    unstage(live)
    unstage(marked)
    unstage(keys)
    release_shuffles(docs.sparkSession)
    return gone


def removed_runs(gone: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Maximal removed runs (begin, end) of a text of ``size`` bytes."""
    runs = []
    for hit in gone or []:
        p0 = hit["p0"]
        if hit["foreign"] is None:
            runs.append((p0, p0 + hit["windows"] + LENGTH - 1))
        else:
            runs += [(p0 + o, p0 + o + LENGTH) for o in hit["foreign"]]
    merged: list[list[int]] = []
    for begin, end in sorted(runs):
        end = min(end, size)
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        elif begin < end:
            merged.append([begin, end])
    return [(a, b) for a, b in merged]


def keep(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for begin, end in runs:
        out.append(raw[at:begin])
        at = end
    return b"".join([*out, raw[at:]])


RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``docs`` without its text, plus n_bytes, n_removed, n_spans and kept_sha256.

    ``with_text`` keeps the column with what is left; a character that lost a part is left out.
    """
    rest = [c for c in docs.columns if c not in ("text", "_doc", "_gone", *RESULTS)]
    gone = repeats(docs).withColumnRenamed("gone", "_gone")
    rows = _keyed(docs, rest).join(gone, ["doc", "row"], "left").select("text", "_gone", *[F.col(f"_{i}").alias(c) for i, c in enumerate(rest)])

    @resting
    def run(batches):
        for batch in batches:
            # a megabyte of text at a time: a batch of Spark's holds as many rows as it may, of any length
            for part in slices(pc.binary_length(batch.column(0)).fill_null(0).to_pylist()):
                some = batch.slice(part.start, part.stop - part.start)
                texts, columns = [], [[], [], [], []]
                for text, gone in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    raw = as_bytes(text)
                    runs = removed_runs(gone, len(raw))
                    left = keep(raw, runs) if runs else raw
                    for column, value in zip(columns, (len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest()), strict=True):
                        column.append(value)
                    if with_text:
                        texts.append(left.decode("utf-8", "ignore"))
                own = [pa.array(texts, pa.string())] if with_text else []
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *some.columns[2:], *arrays], names=[*["text"] * with_text, *rest, *RESULTS])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    fields = ["text string"] * with_text + [f"`{c}` {kinds[c]}" for c in rest]
    return rows.mapInArrow(run, ", ".join([*fields, "n_bytes long, n_removed long, n_spans long, kept_sha256 string"]))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated strings cut out of its texts, in the same columns."""
    left = remove_repeats(docs, with_text=True)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
