"""MinHash near-duplicate removal with min-max hashing.

A document is the set of its 5-word shingles. Under each of ``PERMUTATIONS`` permutations both
the smallest and the largest value are kept, so 100 evaluations per shingle give 200 signature
values, each of which agrees between two documents with the probability of their Jaccard
similarity. Five values make a band; documents that agree in a band are candidates. At the
threshold of 0.75 a pair is missed by all 40 bands about twice in 100,000. Before any text is
read, a candidate must have a possible size ratio and agree in enough 4-bit extracts of the
signature (one in 100,000 pairs at the threshold does not).

Links are confirmed on the full sets. Documents with equal sets are one class and are not
compared. Then documents take turns: each asks one leader (the smallest of a bucket by id, later by
a hash) of a component other than its own, over all its buckets, and components are formed anew;
in a last turn it asks the leaders of all its buckets that still hold several components, and at
the end all pairs of a bucket whose components differ are compared, unless 1,024 further values
rule the threshold out (one in 100,000 pairs at the threshold again). So a group of near copies costs
a comparison per document and turn, and yet no pair that could join two components goes unchecked.
Each turn starts jobs of its own: planning a query runs them.

Defined results: a null text is empty; empty sets link with nothing; a row without an id links
with nothing and is kept; rows that repeat an id are one document; an empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.components import components
from surveil.llm.words import _constants, as_bytes, mix, resting, shingle_sets, slices
from surveil.session import release_shuffles, stage

SHINGLE = 5
PERMUTATIONS = 100
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
PERCENT = 75
# four bits of a value agree with probability 0.75 + 0.25 / 16 at the threshold; 4.4 standard deviations below that
VALUES = 2 * PERMUTATIONS
LONGS = -(-VALUES // 16)
MIN_AGREEING = int(0.765625 * VALUES - 4.4 * (0.765625 * 0.234375 * VALUES) ** 0.5)
ROWS_PER_SALT = 256
TURNS = 1       # in which a document asks one leader; every turn is some eighty stages
LEADERS = 3
# further values for documents whose buckets stay open, so that few pairs below the threshold are left
FINE = 512
FINE_AGREEING = int(0.765625 * 2 * FINE - 4.4 * (0.765625 * 0.234375 * 2 * FINE) ** 0.5)

_XOR = _constants("minhash-xor", PERMUTATIONS)
_MULTIPLY = _constants("minhash-multiply", PERMUTATIONS)
_FINE_XOR = _constants("minhash-fine-xor", FINE)
_FINE_MULTIPLY = _constants("minhash-fine-multiply", FINE)


def signatures(offsets: np.ndarray, hashes: np.ndarray, xor: np.ndarray = _XOR, multiply: np.ndarray = _MULTIPLY) -> np.ndarray:
    """(documents, 2 * permutations): minima, then maxima. Every set must hold something."""
    n = len(xor)
    out = np.empty((len(offsets) - 1, 2 * n), np.uint64)
    if not len(out):
        return out
    for k in range(n):
        values = (hashes ^ xor[k]) * multiply[k]
        out[:, k] = np.minimum.reduceat(values, offsets[:-1])
        out[:, n + k] = np.maximum.reduceat(values, offsets[:-1])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys; equal keys mean equal band and equal values in it."""
    keys = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        total = np.full(len(signature), b + 1, np.uint64)
        for k in range(b * ROWS, b * ROWS + ROWS):
            # a band takes its values from all over the signature
            total = mix(total + signature[:, (k * 23) % VALUES])
        keys[:, b] = total
    return keys.view(np.int64)


def extracts(signature: np.ndarray) -> np.ndarray:
    """(documents, LONGS): four bits of every value, sixteen to a number."""
    values = signature.shape[1]
    nibbles = np.zeros((len(signature), 16 * -(-values // 16)), np.uint8)
    nibbles[:, :values] = mix(signature).astype(np.uint8) & 15
    return np.ascontiguousarray(nibbles[:, ::2] << 4 | nibbles[:, 1::2]).view(np.int64)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, bits, bands) per row; ``bands`` is null for an empty set. No shuffle."""
    @resting
    def run(batches):
        for batch in batches:
            raw = [as_bytes(t) for t in batch.column(1).to_pylist()]
            sizes, digests, bands, bits = [], [], [], []
            for part in slices([len(b) for b in raw]):
                offsets, hashes = shingle_sets(raw[part], SHINGLE)
                n = np.diff(offsets)
                sizes.append(n)
                digests += [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(offsets, offsets[1:])]
                full = np.flatnonzero(n)
                signature = signatures(np.append(offsets[full], len(hashes)), hashes)
                own, packed = [None] * len(n), [None] * len(n)
                for i, row, word in zip(full.tolist(), band_keys(signature), extracts(signature), strict=True):
                    own[i], packed[i] = row, word
                bands += own
                bits += packed
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(sizes) if sizes else [], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bits", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bits array<long>, bands array<long>")


def finer(texts: DataFrame) -> DataFrame:
    """(doc, fine): the extracts of FINE further permutations per text that is not empty. No shuffle."""
    @resting
    def run(batches):
        for batch in batches:
            raw = [as_bytes(t) for t in batch.column(1).to_pylist()]
            for part in slices([len(b) for b in raw]):
                offsets, hashes = shingle_sets(raw[part], SHINGLE)
                full = np.flatnonzero(np.diff(offsets))
                words = extracts(signatures(np.append(offsets[full], len(hashes)), hashes, _FINE_XOR, _FINE_MULTIPLY))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full + part.start)), pa.array(list(words), pa.list_(pa.int64()))], names=["doc", "fine"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc long, fine array<long>")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Rows are brought together by ``a``, with as many copies of its text as its partners need
    tasks; each task holds one set of ``a`` and streams the partners.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / ROWS_PER_SALT).cast("int").alias("salts"))
    heads = salts.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"))
    tails = pairs.join(salts, "a").select(F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("part"))
    rows = heads.unionByName(tails).hint("merge").join(texts, "doc_id").repartition("a", "salt").sortWithinPartitions("a", "salt", "part")

    @resting
    def run(batches):
        head, sets = None, []
        for batch in batches:
            found = []
            ids, a, salt, part, texts = (c.to_pylist() for c in batch.columns)
            raw = [as_bytes(t) for t in texts]
            for piece in slices([len(b) for b in raw]):
                offsets, hashes = shingle_sets(raw[piece], SHINGLE)
                for i in range(piece.start, piece.stop):
                    own = hashes[offsets[i - piece.start]:offsets[i - piece.start + 1]]
                    if part[i] == 0:
                        if head != (a[i], salt[i]):
                            head, sets = (a[i], salt[i]), []
                        sets.append(own.copy())
                    elif any(similar(x, own) for x in sets):
                        found.append((a[i], ids[i]))
            columns = list(zip(*found, strict=True)) if found else [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return rows.select("doc_id", "a", "salt", "part", "text").mapInArrow(run, "a long, b long").distinct()


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have 100 * intersection >= PERCENT * union."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def renamed(rows: DataFrame, side: str, keep: list[str] | None = None) -> DataFrame:
    return rows.select(*[F.col(c).alias(side if c == "doc" else c if c in (keep or []) else f"{c}_{side}") for c in rows.columns])


def promising(longs: int = LONGS, agreeing: int = MIN_AGREEING):
    """Sizes and the first signature extracts of two documents allow the threshold."""
    differing = F.lit(0)
    for i in range(longs):
        differing = differing + _differing(F.col(f"bit{i}_a"), F.col(f"bit{i}_b"))
    sizes = F.expr(f"100 * least(n_shingles_a, n_shingles_b) >= {PERCENT} * greatest(n_shingles_a, n_shingles_b)")
    return sizes & (F.lit(min(VALUES, 16 * longs)) - differing >= agreeing)


def _differing(x, y):
    """How many of the sixteen values of two extracts differ."""
    z = x.bitwiseXOR(y)
    for shift in (1, 2):  # the lowest bit of each four becomes 1 where any of them is
        z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
    return F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))


def close():
    """The finer extracts of two documents allow the threshold."""
    return F.lit(2 * FINE) - F.aggregate(F.zip_with("fine_a", "fine_b", _differing), F.lit(0), lambda n, x: n + x) >= FINE_AGREEING


def open_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of a bucket whose components differ and whose sizes, signatures and finer values allow the threshold.

    Near copies share several buckets; the pair comes from the first of them alone.
    """
    rows = rows.join(rows.groupBy("doc").agg(F.collect_set("key").alias("keys")), "doc")
    ours, other = renamed(rows, "a", ["key"]), renamed(rows, "b", ["key"])
    first = F.col("key") == F.array_min(F.array_intersect("keys_a", "keys_b"))
    return ours.join(other, "key").filter(F.expr("a < b AND component_a <> component_b") & promising() & first & close()).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    described = stage(describe(docs), "signatures", "zstd")
    full = described.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # equal sets are one class, reduced before the shuffle
    classes = stage(full.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.min_by(F.struct("n_shingles", "bits", "bands"), "doc_id").alias("d")).select("digest", "rep", "d.*"), "classes", "zstd")
    keyed = classes.select(F.col("rep").alias("doc"), F.explode("bands").alias("key"))
    # staged, so that a key with very many documents can be split in the join
    buckets = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets", "zstd")
    members = stage(keyed.join(buckets, "key"), "members", "zstd")
    asked = members.select(F.col("doc").alias("doc_id")).distinct()
    # texts move by a shuffle at every size, and once
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        asked.hint("merge"), "doc_id"), "texts", "zstd")
    release_shuffles(docs.sparkSession)
    sketch = classes.select(F.col("rep").alias("doc"), "n_shingles", *[F.element_at("bits", i + 1).alias(f"bit{i}") for i in range(LONGS)])
    sketch = stage(sketch.join(asked.withColumnRenamed("doc_id", "doc"), "doc"), "sketch", "zstd")

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs that sizes and signatures allow."""
        return pairs.join(renamed(sketch, "a"), "a").join(renamed(sketch, "b"), "b").filter(promising()).select("a", "b")

    links, belongs, tested = None, None, None
    for turn in range(TURNS + 1):
        # buckets of two as well: a document that asked the leader of another bucket has not met its only partner here
        located = members.select("key", "doc") if belongs is None else members.select("key", "doc").join(
            belongs.withColumnRenamed("node", "doc"), "doc", "left")
        located = located.withColumn("component", F.coalesce("component", "doc") if belongs is not None else F.col("doc"))
        last = turn == TURNS
        order = [F.col("doc"), *[F.xxhash64("doc", F.lit(i)) for i in range(1, LEADERS)]]
        leads = [F.min_by(F.struct("doc", "component"), by) for by in (order if last else order[turn:turn + 1])]
        mixed = located.groupBy("key").agg(F.array_distinct(F.array(*leads)).alias("leads"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
        open_rows = stage(located.join(stage(mixed.select("key", "leads"), "mixed", "zstd"), "key"), "open", "zstd")
        other = F.filter("leads", lambda x: x["component"] != F.col("component"))
        asks = open_rows.select("doc", F.explode(other).alias("lead")).select("doc", F.col("lead.doc").alias("leader"))
        if not last:   # a document asks one leader a turn
            asks = asks.groupBy("doc").agg(F.min_by("leader", F.xxhash64("leader", F.lit(turn))).alias("leader"))
        pairs = asks.select(F.least("leader", "doc").alias("a"), F.greatest("leader", "doc").alias("b")).distinct()
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(likely(pairs), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stage(confirm(pairs, texts), "confirmed")
        links = found if links is None else links.unionByName(found)
        belongs = stage(components(links), "components")
        release_shuffles(docs.sparkSession)
    # pairs of a bucket whose components differ still have to be looked at (in a bucket of two the last turn did)
    located = members.filter("n > 2").select("key", "doc").join(
        belongs.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))
    mixed = located.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    open_rows = stage(located.join(mixed, "key"), "open", "zstd")
    # what is left are mostly pairs somewhat below the threshold: more values tell before texts are read
    asking = open_rows.select(F.col("doc").alias("doc_id")).distinct()
    fine = stage(finer(texts.join(asking, "doc_id")), "fine", "zstd")
    second = open_pairs(open_rows.join(sketch, "doc").join(fine, "doc")).distinct()     # an id may repeat
    second = stage(second.join(tested, ["a", "b"], "left_anti"), "more-pairs")
    release_shuffles(docs.sparkSession)
    if not second.isEmpty():
        belongs = stage(components(links.unionByName(confirm(second, texts))), "components")
    reps = classes.select("digest", F.col("rep").alias("node")).join(belongs, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    linked = full.select("doc_id", "n_shingles", "digest").join(reps, "digest")
    # an id that repeats with different texts is one document
    per_id = linked.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    alone = described.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles")
    result = full.select("doc_id", "n_shingles").unionByName(alone).join(per_id, "doc_id", "left")
    result = result.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest of their component, in the columns of ``docs``.

    Rows that repeat a kept id stay as they are.
    """
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
