"""Phrase collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces at punctuation and line ends, and pieces into words. An edge is a run of
``longest`` = 3 words and joins the node of its first two words to the node of its last two; its
weight is the number of its occurrences. What is shorter is derived: a node occurs as often as the
edges that leave it, plus once for every piece that ends in it (flow plus end corrections), and a
word as often as the nodes that start with it, plus once for every piece that ends in it. All of
this is additive, so a task adds up the graph of a batch of texts before anything is shuffled, and
words are derived there; nodes are derived after the edges have been added up, in the same
partition. Edges and nodes below the least count can be in no candidate: they count in the flows
and are dropped right after.

Of the heavy edges, unary paths (nodes with one heavy edge in and one out) are compacted by pointer
jumping; a path row has the counts of all its nodes, so a candidate finds both of its shorter parts
beside it. Paths that are still open after ``ROUNDS`` rounds are cycles or longer than 2 ** ROUNDS
nodes; their edges stay single, which changes the layout only.

Edges are shuffled by their first node. Nodes that hold a large share of the edges of a bounded
sample of texts are spread over ``SALTS`` parts by the next word and added up again at the end; the
sample decides about the layout only, never about a count.

Defined results: a null text is empty; a null lang is ``und``, so is the text ``und``; counts are
per lang; repeated rows count each; texts of any length are worked on in cuts between pieces; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveil.llm.words import as_bytes, slices
from surveil.session import stage

LEAST = 10
COVER_PERCENT = 50
TOP = 2000
BATCH = 1 << 23
SALTS = 64
SAMPLE_TEXTS, HOT_SHARE = 2000, 0.002
ROUNDS = 12
BREAKS = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

EDGE = "lang string, node string, next string, salt int, n long"
_UPPER = bytes(range(65, 91))
_TABLE = bytes.maketrans(_UPPER + b"\t" + BREAKS, _UPPER.lower() + b" " + b"\n" * len(BREAKS))


# ---- the graph of a batch of texts ------------------------------------------------------------

def cuts(data: bytes, limit: int = BATCH):
    """Stretches of about ``limit`` bytes that end between pieces."""
    at = 0
    while at < len(data):
        end = data.find(b"\n", at + limit)
        end = len(data) if end < 0 else end + 1
        yield data[at:end]
        at = end


def local_graph(data: bytes):
    """(words, nodes, edges, ends, single, total) of cleaned text.

    ``nodes`` are (first, second, n), ``edges`` (node, word, n), ``ends`` (node, n); ``single`` is the
    count of every word and ``total`` that of all words.
    """
    coded = pc.split_pattern(pa.array([data.replace(b"\n", b" \n ")], pa.large_binary()), b" ").flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    blank, line = (pc.index(words, pa.scalar(x, pa.large_binary())).as_py() for x in (b"", b"\n"))
    code = code[code != blank]
    word = code != line
    size = max(len(words), 1)
    after = np.concatenate([word[1:], [False]]) & word           # a word with a word behind it
    third = np.concatenate([after[1:], [False]]) & after
    first = np.flatnonzero(after)
    pair, node = np.unique(code[first] * size + code[first + 1], return_inverse=True)
    goes_on = third[first]
    edge, n = np.unique(node[goes_on] * size + code[first[goes_on] + 2], return_counts=True)
    edges = (edge // size, edge % size, n)
    ends = np.bincount(node[~goes_on], minlength=len(pair))
    # flow: what leaves a node, plus the pieces that end in it
    flow = np.bincount(edges[0], weights=n, minlength=len(pair)).astype(np.int64) + ends
    last = np.bincount(code[word & ~after], minlength=size)
    single = np.bincount(pair // size, weights=flow, minlength=size).astype(np.int64) + last
    at = np.flatnonzero(ends)
    return words, (pair // size, pair % size, flow), edges, (at, ends[at]), single, int(single.sum())


def _edge_rows(lang: str, data: bytes, hot: pa.Array | None):
    words, (first, second, _), (node, word, n), (end, times), single, total = local_graph(data)
    if not total:
        return
    text = words.cast(pa.binary())
    named = pc.binary_join_element_wise(text.take(pa.array(first)), text.take(pa.array(second)), b" ").cast(pa.string())
    text = text.cast(pa.string())
    known = np.flatnonzero(single)
    nodes = pa.concat_arrays([named.take(pa.array(node)), named.take(pa.array(end)), text.take(pa.array(known)), pa.array([""])])
    follow = pa.concat_arrays([text.take(pa.array(word)), pa.nulls(len(end) + len(known) + 1, pa.string())])
    counts = np.concatenate([n, times, single[known], [total]]).astype(np.int64)
    salt = np.zeros(len(counts), np.int32)
    if hot is not None and len(node):
        for i in np.flatnonzero(pc.is_in(nodes.slice(0, len(node)), value_set=hot).to_numpy(zero_copy_only=False)).tolist():
            salt[i] = 1 + zlib.crc32(follow[i].as_buffer()) % SALTS
    for at in range(0, len(counts), 1 << 16):
        some = slice(at, at + (1 << 16))
        size = len(counts[some])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * size, pa.string()), nodes.slice(at, size), follow.slice(at, size), pa.array(salt[some]), pa.array(counts[some])],
                                         names=["lang", "node", "next", "salt", "n"])


def graph_rows(docs: DataFrame, hot: dict[str, list[str]] | None = None) -> DataFrame:
    """``EDGE`` rows of all batches: edges, piece ends of nodes (no next), words, and the empty node for all words of a lang."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    marked = {lang: pa.array(nodes, pa.string()) for lang, nodes in (hot or {}).items()}

    def run(batches):
        held, size = {}, 0

        def flush():
            for lang in sorted(held):
                for part in cuts(b"\n".join(held[lang])):
                    yield from _edge_rows(lang, part, marked.get(lang))

        for batch in batches:
            sizes = [x or 0 for x in pc.binary_length(batch.column(1)).to_pylist()]
            for some in slices(sizes, BATCH):
                for lang, text in zip(*(c.slice(some.start, some.stop - some.start).to_pylist() for c in batch.columns)):
                    held.setdefault(lang, []).append(as_bytes(text).translate(_TABLE))
                size += sum(sizes[some])
                if size >= BATCH:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return rows.mapInArrow(run, EDGE)


def hot_nodes(docs: DataFrame) -> dict[str, list[str]]:
    """Nodes with a large share of the edges of a sample; at most 1 / HOT_SHARE of them."""
    total = docs.count()
    if not total:
        return {}
    sample = graph_rows(docs.sample(min(1.0, SAMPLE_TEXTS / total), 13)).filter("next IS NOT NULL")
    counted = sample.groupBy("lang", "node").agg(F.count("*").alias("n"))
    every = counted.agg(F.sum("n")).first()[0] or 0
    found: dict[str, list[str]] = {}
    for row in counted.filter(F.col("n") > F.lit(every * HOT_SHARE)).collect():
        found.setdefault(row.lang, []).append(row.node)
    return found


def heavy_graph(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(edges, flows): edges (lang, node, next, n) and nodes, words and langs (lang, node, n) with ``n`` >= least."""
    hot = hot_nodes(docs)
    spread = sorted({node for nodes in hot.values() for node in nodes})   # at most 1 / HOT_SHARE
    dealt = graph_rows(docs, hot).repartition("lang", "node", "salt")
    edges = dealt.groupBy("lang", "node", "salt", "next").agg(F.sum("n").alias("n"))
    # an edge adds to the flow of its node; a heavy one stays a row of its own besides
    flow = F.struct(F.lit(None).cast("string").alias("next"), F.col("n"))
    rows = F.when(F.col("next").isNotNull() & (F.col("n") >= least), F.array(flow, F.struct("next", "n"))).otherwise(F.array(flow))
    both = edges.select("lang", "node", "salt", F.explode(rows).alias("x")).select("lang", "node", "salt", "x.next", "x.n")
    summed = both.groupBy("lang", "node", "salt", "next").agg(F.sum("n").alias("n"))
    kept = stage(summed.filter((F.col("n") >= least) | F.col("next").isNull() & F.col("node").isin("", *spread)), "phrase-graph")
    flows = kept.filter("next IS NULL").groupBy("lang", "node").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("node") == ""))
    return kept.filter("next IS NOT NULL").select("lang", "node", "next", "n"), stage(flows, "phrase-flows")


# ---- compaction -------------------------------------------------------------------------------

def compact(edges: DataFrame) -> DataFrame:
    """(lang, path, place, node, next, to, n): every heavy edge with its place on its unary path."""
    edges = stage(edges.withColumn("to", F.concat(F.substring_index("node", " ", -1), F.lit(" "), F.col("next"))), "phrase-edges")
    out = edges.groupBy("lang", "node").agg(F.count("*").alias("_out"))
    into = edges.groupBy("lang", F.col("to").alias("node")).agg(F.count("*").alias("_in"), F.min("node").alias("_from"))
    inner = stage(out.filter("_out = 1").join(into.filter("_in = 1"), ["lang", "node"]).select("lang", "node", "_from"), "phrase-inner")
    # the first inner node of the stretch names the path
    before = inner.select("lang", F.col("node").alias("_from"), F.lit(True).alias("_is"))
    state = stage(inner.join(before, ["lang", "_from"], "left").select(
        "lang", "node", F.when(F.col("_is"), F.col("_from")).otherwise(F.col("node")).alias("head"),
        F.when(F.col("_is"), 1).otherwise(0).cast("long").alias("step"), F.coalesce("_is", F.lit(False)).alias("open")), "phrase-runs")
    for _ in range(ROUNDS):
        if state.filter("open").isEmpty():
            break
        ahead = state.select("lang", F.col("node").alias("head"), F.col("head").alias("_head"), F.col("step").alias("_step"), F.col("open").alias("_open"))
        moved = state.filter("open").join(ahead, ["lang", "head"]).select(
            "lang", "node", F.col("_head").alias("head"), (F.col("step") + F.col("_step")).alias("step"), F.col("_open").alias("open"))
        state = stage(moved.unionByName(state.filter("NOT open")), "phrase-runs")
    done = state.filter("NOT open")
    start = done.select("lang", "node", F.col("head").alias("_head"), (F.col("step") + 1).alias("_place"))
    enters = done.filter("step = 0").select("lang", F.col("node").alias("to"), F.col("node").alias("_enters"))
    placed = edges.join(start, ["lang", "node"], "left").join(enters, ["lang", "to"], "left")
    alone = F.concat("node", F.lit("\n"), "next")
    return placed.select("lang", F.coalesce("_head", "_enters", alone).alias("path"), F.coalesce("_place", F.lit(0).cast("long")).alias("place"), "node", "next", "to", "n")


def paths(edges: DataFrame, flows: DataFrame) -> DataFrame:
    """(lang, path, nodes, words, counts, flows): a unary path per row; node i and edge i (to node i + 1)."""
    counted = compact(edges).join(flows.select("lang", "node", F.col("n").alias("_flow")), ["lang", "node"])
    ordered = F.sort_array(F.collect_list(F.struct("place", "node", "next", "n", "_flow", "to")))
    row = counted.groupBy("lang", "path").agg(ordered.alias("e"))
    last = row.select("lang", "path", "e", F.element_at("e", -1)["to"].alias("node")).join(
        flows.select("lang", "node", F.col("n").alias("_end")), ["lang", "node"])
    return last.select("lang", "path", F.col("e.node").alias("nodes"), F.col("e.next").alias("words"), F.col("e.n").alias("counts"),
                       F.concat("e._flow", F.array("_end")).alias("flows"))


# ---- candidates -------------------------------------------------------------------------------

def collocations(docs: DataFrame, least: int = LEAST, cover_percent: int = COVER_PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the first ``top`` of each lang."""
    edges, flows = heavy_graph(docs, least)
    edges = stage(edges, "phrase-heavy")
    whole = flows.filter("node = ''").select("lang", F.col("n"))
    words = flows.filter("node <> '' AND instr(node, ' ') = 0")
    pairs = flows.filter("instr(node, ' ') > 0")
    # longer candidates: both shorter parts stand on the path
    edge = F.explode(F.arrays_zip("nodes", "words", "counts", F.slice("flows", 1, F.size("words")).alias("left"), F.slice("flows", 2, F.size("words")).alias("right")))
    long = paths(edges, pairs).select("lang", edge.alias("x")).select(
        "lang", F.concat("x.nodes", F.lit(" "), "x.words").alias("phrase"), F.col("x.counts").alias("a"), F.col("x.left").alias("_l2"), F.col("x.right").alias("_r1"))
    over = edges.select("lang", "node", "n").unionByName(
        edges.select("lang", F.concat(F.substring_index("node", " ", -1), F.lit(" "), F.col("next")).alias("node"), "n")).groupBy("lang", "node").agg(F.max("n").alias("_over"))
    short = pairs.join(over, ["lang", "node"], "left").filter(
        F.col("_over").isNull() | (F.lit(100) * F.col("_over") < F.lit(cover_percent) * F.col("n"))).select(
        "lang", F.col("node").alias("phrase"), F.col("n").alias("a"), F.lit(None).cast("long").alias("_l2"), F.lit(None).cast("long").alias("_r1"))
    found = long.unionByName(short).withColumn("_first", F.substring_index("phrase", " ", 1)).withColumn("_last", F.substring_index("phrase", " ", -1))
    found = found.join(words.select("lang", F.col("node").alias("_first"), F.col("n").alias("_l1")), ["lang", "_first"]).join(
        words.select("lang", F.col("node").alias("_last"), F.col("n").alias("_rl")), ["lang", "_last"])
    exact = "(1000000BD * cast(a AS decimal(20,0)) * cast(a AS decimal(20,0))) div (cast({} AS decimal(20,0)) * cast({} AS decimal(20,0)))"
    first_cut = F.struct(F.expr(exact.format("_l1", "coalesce(_r1, _rl)")).alias("score"), F.lit(1).alias("k"), F.col("_l1").alias("l"), F.coalesce("_r1", "_rl").alias("r"))
    second_cut = F.when(F.col("_l2").isNotNull(), F.struct(F.expr(exact.format("_l2", "_rl")).alias("score"), F.lit(2).alias("k"), F.col("_l2").alias("l"), F.col("_rl").alias("r")))
    scored = found.select("lang", "phrase", "a", F.least(first_cut, second_cut).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return first.join(whole, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))
