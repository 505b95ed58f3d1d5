"""Substring removal by MinHash banding of paragraphs.

A paragraph here is a run of whole sentences with at least 20 words, and paragraphs overlap: so a
passage is found wherever in a line or document it was pasted, as long as it keeps its sentences.
One starts at every sentence. A sentence of more than 40 words is cut where the hash of five words
is the least of 12 to either side, so the cuts move with the words; a piece without such a place
is cut every 40 words.

A paragraph is its set of 5-word shingles. Bands of two values or more are tuned for recall: ``tune``
picks the fewest values that miss at most ``MISSED`` of pairs at the threshold. Overlapping paragraphs
of one text share most of their values, so bands first tell which values stand in two different
texts, and only paragraphs that hold one leave their text. Of those, paragraphs with equal shingles are one
class. In a bucket each class is compared with the smallest and two others; then only pairs whose
components still differ; a bucket of more than ``CROWD`` classes is first divided by runs of signature
extracts (``divisions``). Pairs whose sizes or signature bits rule the threshold out are dropped before
texts are read. Links inside a text are found in the task that holds it, by the same bands, in texts that
share something. Similarity is exact Jaccard on the full sets. Of a component, the paragraphs of its
first document stay, and the words of all others are removed, so a passage survives once and clean
documents keep all they have. Repeats inside the first document are left alone.

Defined results: null text is empty; a null id comes after all others; rows that repeat an id are
one document for the order, but each loses only its own passages (``row`` is a hash of the text; equal texts are looked at once); a text with 5 to 19 words is one paragraph, a shorter one has none; texts may be of
any length; an empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.components import components
from surveil.llm.idtable import ranges
from surveil.llm.minhash import LONGS, PERCENT, VALUES, extracts, promising, renamed, signatures, similar
from surveil.llm.words import Words, _constants, as_bytes, mix, resting, shingle_sets, slices
from surveil.session import release_shuffles, stage, unstage

SHINGLE = 5
MIN_WORDS = 20
LONG_SENTENCE = 40
AROUND = 12         # words to either side of a cut in a long sentence
THRESHOLD = 0.75
MISSED = 0.002
LAST_ID = (1 << 63) - 1
SET_ITEMS = 1 << 21     # shingles compared at a time inside texts
KEY_BITS = 48           # of a band value; equal ones of different bands only add pairs to compare
BATCH_VALUES = 1 << 21
PACKED = 1 << 16
CROWD = 100             # classes of a bucket; more are divided before pairs are formed
EARLY = 4               # numbers of extracts that members of open buckets carry; again 4.4 standard deviations below the threshold
EARLY_AGREEING = int(0.765625 * 16 * EARLY - 4.4 * (0.765625 * 0.234375 * 16 * EARLY) ** 0.5)
RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def tune(threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """(bands, rows): the fewest values per paragraph that miss at most ``missed`` at the threshold.

    Bands of one value are not among them: unrelated texts share too many five-word runs."""
    choices = []
    for rows in range(2, 5):
        bands = 1
        while (1 - threshold ** rows) ** bands > missed:
            bands += 1
        choices.append((bands * rows, bands, rows))
    return min(choices)[1:]


BANDS, ROWS = tune()
_XOR = _constants("paragraph-xor", BANDS * ROWS)
_MULTIPLY = _constants("paragraph-multiply", BANDS * ROWS)


def _pieces(start: np.ndarray, n: int) -> np.ndarray:
    """``start`` with a further cut every LONG_SENTENCE words."""
    pieces = -(-np.diff(np.append(start, n)) // LONG_SENTENCE)
    within = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(start, pieces) + within * LONG_SENTENCE


def _sentence_starts(words: Words, shingle: np.ndarray) -> np.ndarray:
    """Index of the first word of every sentence, or piece of a long one, of a batch.

    ``shingle`` has the hash of the words from each word on.
    """
    n = len(words.starts)
    newline = np.concatenate([[0], np.cumsum(words.bytes == 10)])
    ends = np.isin(words.bytes[words.ends - 1], np.frombuffer(b".!?", np.uint8))
    ends[:-1] |= newline[words.starts[1:]] > newline[words.ends[:-1]]
    ends[:-1] |= words.of[1:] != words.of[:-1]
    start = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
    length = np.diff(np.append(start, n))
    # words of long sentences with AROUND words on either side in the same sentence
    stop = start + length - AROUND - SHINGLE
    room = np.where(length > LONG_SENTENCE, np.maximum(stop - start - AROUND + 1, 0), 0)
    at = np.repeat(start + AROUND - (np.cumsum(room) - room), room) + np.arange(int(room.sum()))
    for k in range(1, AROUND + 1):
        at = at[(shingle[at] < shingle[at - k]) & (shingle[at] <= shingle[at + k])]
    return _pieces(np.union1d(start, at), n)


def paragraphs(texts: list[bytes]):
    """(text, first byte, end byte, class, values, first shingle, end shingle) of the paragraphs of a batch of texts, and its shingles."""
    none = np.zeros(0, np.int64)
    nothing = (none, none, none, np.zeros(0, np.uint64), np.zeros((0, BANDS), np.uint64), none, none, np.zeros(0, np.uint64))
    words = Words(texts, lower=True)
    n = len(words.starts)
    at, h = words.windows(SHINGLE)
    if not len(at):
        return nothing
    shingle = np.zeros(n + 1, np.uint64)
    shingle[at] = h
    starts = _sentence_starts(words, mix(shingle))
    stops = np.append(starts[1:], n)
    owner = words.of[starts]
    counts = words.counts()
    last = words.first[1:][owner]
    first = starts
    # the first sentence end at least MIN_WORDS on, in the same text
    reach = np.searchsorted(stops, first + MIN_WORDS)
    end = np.where(reach < len(stops), stops[np.minimum(reach, len(stops) - 1)], n + 1)
    short = (counts[owner] < MIN_WORDS) & (first == words.first[owner])
    end = np.where(short, last, end)
    good = (end <= last) & (end - first >= SHINGLE)
    first, end, owner = first[good], end[good], owner[good]
    if not len(first):
        return nothing
    stop = end - SHINGLE + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingle))])
    name = mix(total[stop] - total[first] + (stop - first).astype(np.uint64))
    values = np.empty((len(first), BANDS), np.uint64)
    pairs = np.column_stack([first, stop]).ravel()
    for b in range(BANDS):
        key = np.full(len(first), b + 1, np.uint64)
        for k in range(b * ROWS, b * ROWS + ROWS):
            scrambled = (shingle ^ _XOR[k]) * _MULTIPLY[k]
            key = mix(key + np.minimum.reduceat(scrambled, pairs)[::2])
        values[:, b] = key >> np.uint64(64 - KEY_BITS)
    base = words.text_starts[owner]
    return owner, words.starts[first] - base, words.ends[end - 1] - base, name, values, first, stop, shingle


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    begins = np.ones(len(columns[0]), bool)
    begins[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return begins


def parse(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, rows, keys, passed): the band values of every text, packed by range of values. No shuffle.

    Of a value that several texts of a batch hold, two of them stand for all in its bucket; the others are
    known to share it, and go with ``passed`` to any bucket, so a value has few entries however common it is.
    """
    names = ["bucket", "rows", "keys", "passed"]

    def packed(bucket: list[int], cuts: list[int], rows: np.ndarray, keys: np.ndarray, passed: bool) -> pa.RecordBatch:
        blobs = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (rows, keys)]
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *[pa.array(x, pa.binary()) for x in blobs], pa.array([passed] * len(bucket), pa.bool_())], names=names)

    def dealt(rows: np.ndarray, keys: np.ndarray):
        """The values of a batch in which no row stands twice."""
        order = np.argsort(keys)
        rows, keys = rows[order], keys[order]
        begins = _runs(keys)
        middle = ~(begins | np.append(begins[1:], True))
        known, rows, keys = (rows[middle], keys[middle]), rows[~middle], keys[~middle]
        cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) * np.uint64((1 << KEY_BITS) // buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        yield packed(full.tolist(), [*cuts[full].tolist(), len(keys)], rows, keys, False)
        at = list(range(0, len(known[0]), PACKED))
        yield packed([int(known[1][i]) % buckets for i in at], [*at, len(known[0])], *known, True)

    @resting
    def run(batches):
        for batch in batches:
            rows, at = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            raw = [as_bytes(t) for t in batch.column(1).take(pa.array(at)).to_pylist()]
            held, n = [], 0
            for part in slices([len(b) for b in raw]):
                owner, _, _, _, values, *_ = paragraphs(raw[part])
                owner, key = np.repeat(owner, BANDS), values.ravel()
                order = np.lexsort((key, owner))
                owner, key = owner[order], key[order]
                new = _runs(owner, key)
                held.append((rows[part][owner[new]], key[new]))
                n += len(held[-1][0])
                if n > BATCH_VALUES:
                    yield from dealt(*map(np.concatenate, zip(*held)))
                    held, n = [], 0
            if n:
                yield from dealt(*map(np.concatenate, zip(*held)))

    return docs.select("row", "text").mapInArrow(run, "bucket long, rows binary, keys binary, passed boolean")


def shared_values(docs: DataFrame) -> DataFrame:
    """(row, key): the band values that stand in two different texts, with the texts. One shuffle of packed values."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(group: pa.Table) -> pa.Table:
        passed = group.column("passed").combine_chunks()
        rows, keys = [], []
        for some in (passed, pc.invert(passed)):
            own = group.filter(some)
            rows.append(np.frombuffer(b"".join(own.column("rows").to_pylist()), np.int64))
            keys.append(np.frombuffer(b"".join(own.column("keys").to_pylist()), np.uint64))
        order = np.argsort(keys[1])
        row, key = rows[1][order], keys[1][order]
        begins = np.flatnonzero(_runs(key)) if len(key) else np.zeros(0, np.int64)
        if len(key):
            several = np.minimum.reduceat(row, begins) != np.maximum.reduceat(row, begins)
            several = np.repeat(several, np.diff(np.append(begins, len(key))))
            row, key = row[several], key[several]
        return pa.table({"row": pa.array(np.concatenate([rows[0], row])), "key": pa.array(np.concatenate([keys[0], key]).view(np.int64))})

    return parse(docs, buckets).groupBy("bucket").applyInArrow(run, "row long, key long")


def _keyed(docs: DataFrame, rest: tuple = ()) -> DataFrame:
    """(doc, row, text, rest): ``doc`` is the place in the order, ``row`` tells the texts of one id apart."""
    text = F.col("text").cast("string")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"),
                       *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(rest)])


def shared_paragraphs(texts: DataFrame) -> DataFrame:
    """(u, row, low, keys, piece): of ``texts`` (row, low, keys, text), the classes that hold some of the ``keys``. No shuffle."""
    @resting
    def run(batches):
        for batch in batches:
            rows, lows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw = [as_bytes(t) for t in batch.column(3).to_pylist()]
            for part in slices([len(b) for b in raw]):
                # a value that is asked for in one text is asked for in all that hold it
                keys = batch.column(2).slice(part.start, part.stop - part.start).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                owner, s, e, name, values, *_ = paragraphs(raw[part])
                hit = np.isin(values, keys)
                order = np.lexsort((name, owner))
                order = order[_runs(owner[order], name[order])]
                order = order[hit[order].any(axis=1)]
                hit, owner = hit[order], owner[order]
                held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(hit.sum(axis=1))]), pa.int32()), pa.array(values[order][hit].view(np.int64)))
                pieces = [raw[part.start + i][a:b] for i, a, b in zip(owner.tolist(), s[order].tolist(), e[order].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[order].view(np.int64)), pa.array(rows[part][owner], pa.int64()), pa.array(lows[part][owner], pa.int64()), held, pa.array(pieces, pa.binary())],
                    names=["u", "row", "low", "keys", "piece"])

    return texts.select("row", "low", "keys", "text").mapInArrow(run, "u long, row long, low long, keys array<long>, piece binary")


def sketched(classes: DataFrame) -> DataFrame:
    """``classes`` with the set size and the signature bits of their pieces. No shuffle."""
    @resting
    def run(batches):
        for batch in batches:
            pieces = batch.column(4).to_pylist()
            for part in slices([len(x) for x in pieces]):
                offsets, hashes = shingle_sets(pieces[part], SHINGLE)
                own = [pa.array(np.diff(offsets)), pa.array(list(extracts(signatures(offsets, hashes))), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.slice(part.start, part.stop - part.start).columns, *own], names=["u", "low", "text", "keys", "piece", "n_shingles", "bits"])

    return classes.select("u", "low", "text", "keys", "piece").mapInArrow(
        run, "u long, low long, text long, keys array<long>, piece binary, n_shingles long, bits array<long>")


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Bring the components of a[i] and b[i] together; ``label`` is the smallest member of a component."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := label[label], label):
            label[:] = further


def linked_inside(owner: np.ndarray, name: np.ndarray, values: np.ndarray, first: np.ndarray, stop: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """A number per paragraph, equal for those of one text that links inside the text connect."""
    order = np.lexsort((name, owner))
    new = _runs(owner[order], name[order])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    rep = order[new]
    owner, values, first, lengths = owner[rep], values[rep], first[rep], (stop - first)[rep]
    m = len(rep)
    # the sorted set of each class, as numbers of the batch's shingles
    kinds, ids = np.unique(shingle, return_inverse=True)
    sets = np.unique(np.repeat(np.arange(m), lengths) * len(kinds) + ids[ranges(first, lengths)])
    sizes = np.bincount(sets // len(kinds), minlength=m)
    starts, sets = np.cumsum(sizes) - sizes, sets % len(kinds)
    label = np.arange(m)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        fits = 100 * np.minimum(sizes[a], sizes[b]) >= PERCENT * np.maximum(sizes[a], sizes[b])
        a, b = a[fits], b[fits]
        for part in slices((sizes[a] + sizes[b]).tolist(), SET_ITEMS):
            x, y = a[part], b[part]
            place = np.arange(len(x)) * len(kinds)
            both = np.sort(np.concatenate([np.repeat(place, sizes[i]) + sets[ranges(starts[i], sizes[i])] for i in (x, y)]))
            common = np.bincount(both[1:][both[1:] == both[:-1]] // len(kinds), minlength=len(x))
            good = 100 * common >= PERCENT * (sizes[x] + sizes[y] - common)
            _joined(label, x[good], y[good])

    for band in range(BANDS):
        order = np.lexsort((values[:, band], owner))
        begins = np.flatnonzero(_runs(owner[order], values[order, band]))
        ends = np.repeat(np.append(begins[1:], m), np.diff(np.append(begins, m)))
        at, step = np.arange(m), 1
        while len(at := at[at + step < ends[at]]):
            a, b = order[at], order[at + step]
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
            if len(a):
                met = (values[a, :band] == values[b, :band]).any(axis=1)    # in an earlier band
                compare(a[~met], b[~met])
            step += 1
    return label[number]


def reach(texts: DataFrame) -> DataFrame:
    """(row, low, root, members, spans): what in ``texts`` (row, low, high, here, text) may go, by component.

    ``here`` are classes that other texts hold or link with: a component inside the text has the smallest as
    its ``root`` and all as ``members``. A text of several documents has the rest under a null ``root``. No shuffle.
    """
    @resting
    def run(batches):
        for batch in batches:
            rows, lows, highs = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            raw = [as_bytes(t) for t in batch.column(4).to_pylist()]
            for part in slices([len(b) for b in raw]):
                # a class that is asked for in one text is asked for in all that hold it
                here = batch.column(3).slice(part.start, part.stop - part.start).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                owner, s, e, name, *rest = paragraphs(raw[part])
                u = name.view(np.int64)
                label = linked_inside(owner, name, *rest)
                touched = np.isin(u, here)
                through = np.zeros(len(u), bool)
                through[label[touched]] = True
                through = through[label]
                copied = (lows[part] != highs[part])[owner]
                group = np.where(through, label + len(raw), owner)
                order = np.flatnonzero(through | copied)
                order = order[np.lexsort((s[order], group[order]))]
                columns = [[], [], [], [], []]
                begins = np.flatnonzero(_runs(group[order])).tolist()
                for a, b in zip(begins, [*begins[1:], len(order)], strict=True):
                    own = order[a:b]
                    members = np.unique(u[own][touched[own]]).tolist()
                    spans = merged([{"s": x, "e": y} for x, y in zip(s[own].tolist(), e[own].tolist(), strict=True)])
                    at = part.start + int(owner[own[0]])
                    for column, value in zip(columns, (rows[at], lows[at], members[0] if members else None, members, [{"s": x, "e": y} for x, y in spans]), strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["row", "low", "root", "members", "spans"])

    return texts.select("row", "low", "high", "here", "text").mapInArrow(
        run, "row long, low long, root long, members array<long>, spans array<struct<s:long,e:long>>")


def confirm(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets are similar enough."""
    rows = pairs.join(pieces.select(F.col("u").alias("b"), F.col("piece").alias("second")), "b").join(
        pieces.select(F.col("u").alias("a"), F.col("piece").alias("first")), "a").select("a", "b", "first", "second")

    def run(batches):
        for batch in batches:
            a, b, first, second = (c.to_pylist() for c in batch.columns)
            found = []
            for part in slices([len(x) + len(y) for x, y in zip(first, second, strict=True)]):
                n = part.stop - part.start
                offsets, hashes = shingle_sets([*first[part], *second[part]], SHINGLE)
                own = lambda i: hashes[offsets[i]:offsets[i + 1]]
                found += [(a[part.start + i], b[part.start + i]) for i in range(n) if similar(own(i), own(n + i))]
            columns = list(zip(*found, strict=True)) if found else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def divisions(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """``rows`` of crowded buckets, dealt into parts by runs of five signature extracts; ``key`` is the part.

    Classes at the threshold agree in some run of the 36 but for one pair in 60,000; most others of a bucket in none.
    Parts with a single component are left out.
    """
    runs = [F.xxhash64("key", F.lit(3 * i + j), F.shiftrightunsigned(f"bit{i}", 20 * j).bitwiseAND(F.lit((1 << 20) - 1))) for i in range(VALUES // 16) for j in range(3)]
    full = rows.select("key", "doc", "component").join(sketch, "doc")
    parts = full.select(F.explode(F.array(*runs)).alias("key"), *[c for c in rows.columns if c != "key"])
    mixed = parts.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return parts.join(mixed, "key")


def open_pairs(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """(a, b): the pairs of a bucket, or a part of one, whose components differ and whose sizes and signatures allow the threshold."""
    apart = F.expr("a < b AND component_a <> component_b AND coalesce(text_a <> text_b, true)")     # links inside a text come later
    pairs = renamed(rows, "a", ["key"]).join(renamed(rows, "b", ["key"]), "key").filter(apart & promising(EARLY, EARLY_AGREEING)).select("a", "b").distinct()
    bare = sketch.drop("text")
    return pairs.join(renamed(bare, "a"), "a").join(renamed(bare, "b"), "b").filter(promising()).select("a", "b")


def removals(docs: DataFrame) -> DataFrame:
    """(doc, row, gone): the byte ranges to remove from each text."""
    spark = docs.sparkSession
    rows = _keyed(docs)
    owners = stage(rows.groupBy("row").agg(F.min("doc").alias("low"), F.max("doc").alias("high")), "owners", "zstd")

    def with_text(asked: DataFrame) -> DataFrame:
        """``asked`` (row, low, ...) with the text, which moves by a shuffle at every size."""
        return rows.select(F.col("doc").alias("low"), "row", "text").join(asked.hint("merge"), ["low", "row"])

    # values that stand in two different texts
    holding = shared_values(rows).groupBy("row").agg(F.collect_set("key").alias("keys"))
    holding = stage(holding, "holding", "zstd")
    release_shuffles(spark)
    found = stage(shared_paragraphs(with_text(holding.join(owners.select("row", "low"), "row"))), "found", "zstd")
    release_shuffles(spark)
    # one row per class before the bands are dealt out; ``text`` is the only text that holds it, or null
    classes = found.groupBy("u").agg(F.min("low").alias("low"), F.min("row").alias("lo"), F.max("row").alias("hi"), F.first("keys").alias("keys"), F.first("piece").alias("piece"))
    classes = stage(sketched(classes.withColumn("text", F.expr("if(lo = hi, lo, null)"))), "classes", "zstd")
    places = stage(found.select("u", "row"), "occurrences", "zstd")
    unstage(found)
    unstage(holding)
    release_shuffles(spark)
    keyed = classes.select("u", F.explode(F.array_distinct("keys")).alias("key"))
    # buckets that hold two different classes
    leaders = F.array_distinct(F.array(F.min("u"), *[F.min_by("u", F.xxhash64("u", F.lit(i))) for i in range(2)]))
    buckets = keyed.groupBy("key").agg(leaders.alias("leaders"), F.min("u").alias("low"), F.max("u").alias("high")).filter("low <> high").select("key", "leaders")
    buckets = stage(buckets, "buckets", "zstd")  # staged, so that a key with very many paragraphs can be split in the join
    members = stage(keyed.join(buckets, "key"), "members", "zstd")
    pieces = classes.select("u", "piece")
    sketch = classes.select(F.col("u").alias("doc"), "text", "n_shingles", *[F.element_at("bits", i + 1).alias(f"bit{i}") for i in range(LONGS)])
    first = members.select("u", F.explode("leaders").alias("leader")).filter("u <> leader").select(
        F.least("leader", "u").alias("a"), F.greatest("leader", "u").alias("b")).distinct()
    first = first.join(renamed(sketch, "a"), "a").join(renamed(sketch, "b"), "b").filter(promising()).select("a", "b")
    first = stage(first, "pairs")
    release_shuffles(spark)
    links = stage(confirm(first, pieces), "confirmed")
    belongs = stage(components(links), "components")
    located = members.select("key", "u").join(belongs.withColumnRenamed("node", "u"), "u", "left").select(
        "key", F.col("u").alias("doc"), F.coalesce("component", "u").alias("component"))
    mixed = located.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).filter("lo <> hi AND n > 2").select("key", "n")
    slim = sketch.select("doc", "text", "n_shingles", *[f"bit{i}" for i in range(EARLY)])
    open_rows = stage(located.join(mixed, "key").join(slim, "doc"), "open", "zstd")
    unstage(members)
    unstage(buckets)
    release_shuffles(spark)
    divided = stage(divisions(open_rows.filter(F.col("n") > CROWD).drop("n"), sketch), "divided", "zstd")
    release_shuffles(spark)
    # one after the other, as the shuffles of both would lie on the disks
    crowded = stage(open_pairs(divided, sketch), "crowded-pairs")
    unstage(divided)
    release_shuffles(spark)
    second = open_pairs(open_rows.filter(F.col("n") <= CROWD).drop("n"), sketch).unionByName(crowded).distinct()
    second = stage(second.join(first, ["a", "b"], "left_anti"), "more-pairs")
    unstage(open_rows)
    release_shuffles(spark)
    if not second.isEmpty():
        belongs = stage(components(links.unionByName(confirm(second, pieces))), "components")
    # what several texts hold, or link with, leads on to its neighbours inside each text
    touched = classes.filter("text IS NULL").select("u").unionByName(belongs.select(F.col("node").alias("u"))).distinct()
    here = places.join(touched, "u").groupBy("row").agg(F.collect_set("u").alias("here"))
    asked = stage(owners.join(here, "row", "left").filter("here IS NOT NULL OR low <> high"), "asked", "zstd")
    release_shuffles(spark)
    reached = stage(reach(with_text(asked)), "reached", "zstd")
    release_shuffles(spark)
    inside = reached.select(F.col("root").alias("a"), F.explode("members").alias("b")).filter("a <> b")
    belongs = stage(components(belongs.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(inside)), "components")
    grouped = classes.select("u", "low").join(belongs.withColumnRenamed("node", "u"), "u", "left").withColumn("component", F.coalesce("component", "u"))
    firsts = grouped.groupBy("component").agg(F.min("low").alias("first_doc"))
    owner = grouped.select(F.col("u").alias("root"), "component").join(firsts, "component").select("root", "first_doc")
    hits = reached.join(owner, "root", "left").select("row", F.coalesce("first_doc", "low").alias("first_doc"), "spans")
    later = rows.select("doc", "row").distinct().join(hits, "row").filter("doc <> first_doc")
    gone = stage(later.groupBy("doc", "row").agg(F.flatten(F.collect_list("spans")).alias("gone")), "gone", "zstd")
    unstage(classes)
    release_shuffles(spark)
    return gone


def merged(gone: list[dict] | None, size: int = LAST_ID) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    out: list[list[int]] = []
    for s, e in sorted((g["s"], min(g["e"], size)) for g in gone or []):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        elif s < e:
            out.append([s, e])
    return [(s, e) for s, e in out]


def remove_passages(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``docs`` without its text, plus n_bytes, n_removed, n_spans and kept_sha256."""
    rest = [c for c in docs.columns if c not in ("text", "doc", "_gone", *RESULTS)]
    rows = _keyed(docs, rest).join(removals(docs).withColumnRenamed("gone", "_gone"), ["doc", "row"], "left").select("text", "_gone", *[F.col(f"_{i}").alias(c) for i, c in enumerate(rest)])

    def run(batches):
        for batch in batches:
            texts, columns = [], [[], [], [], []]
            for text, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = as_bytes(text)
                runs = merged(gone, len(raw))
                left = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(raw)], strict=True))
                for column, value in zip(columns, (len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest()), strict=True):
                    column.append(value)
                texts.append(left.decode("utf-8", "ignore"))
            own = [pa.array(texts, pa.string())] if with_text else []
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *batch.columns[2:], *arrays], names=[*["text"] * with_text, *rest, *RESULTS])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    fields = ["text string"] * with_text + [f"`{c}` {kinds[c]}" for c in rest]
    return rows.mapInArrow(run, ", ".join([*fields, "n_bytes long, n_removed long, n_spans long, kept_sha256 string"]))


def query(spark, sf_dir: str) -> DataFrame:
    return remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
