"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are scaled to unit length; cosine >= 0.95 is then a distance of at most sqrt(0.1). Equal
vectors are one class. Classes go to the nearest of a few pivots and, where a pivot has many, to
blocks of about ``BLOCK`` by hash, so a group of near copies of any size spreads over tasks. Each
block gets a cover tree: nested levels whose radii halve, every node with the true radius of its
members. Pairs of blocks that the triangle inequality cannot rule out are traversed together:
a pair of nodes is dropped when its centres are further apart than the threshold plus both radii,
accepted as a whole when even the far ends are close enough, and otherwise replaced by the pairs of
its children. What comes out of a pair of blocks is a count per vector and one link per vector to
its local component, never the list of all pairs.

All decisions are in double precision and exact; only the choice of pivots (a bounded sample, by
hash of the id) affects speed. Random vectors in many dimensions are all equally far apart, so
there every pair of top-level nodes is looked at; the trees save work where vectors crowd.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or
has no id, links with nothing; vectors of different length do not link; rows that repeat an id
are vectors of their own and share a component; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.components import components
from surveil.session import stage

COSINE = 0.95
BLOCK = 2048
PIVOTS = 64
GROUPS = 32
MARGIN = 1e-7   # distances near zero are exact to about 3e-8
LEVELS = 8



def unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    # scaled first, so that squares of very large or small components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def build(x: np.ndarray):
    """(order, nodes, radii): a cover tree over unit vectors.

    ``order`` puts the members of every node side by side. A node is (center, first member, end,
    first child, end of children) in terms of that order; nodes are numbered level by level.
    """
    n = len(x)
    gap = distances(x, x)
    radius = max(float(gap[0].max()), MARGIN)
    labels = [np.zeros(n, np.int64)]
    for level in range(1, LEVELS):
        if all_alone(labels[-1]):
            break
        labels.append(_cover(gap, labels[-1], radius / 2 ** level))
    order = np.lexsort(labels[::-1])
    nodes, radii, previous = [], [], None
    for label in labels:
        own = label[order]
        chain = [lab[order] for lab in labels[:len(nodes) + 1]]
        new = np.ones(n, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in chain], axis=0)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        where = np.empty(n, np.int64)
        where[order] = np.arange(n)
        center = where[own[begin]]
        node = np.stack([center, begin, end], axis=1)
        far = np.maximum.reduceat(gap[order[np.repeat(center, end - begin)], order], begin)
        nodes.append(node)
        radii.append(far)
    out, offset = [], 0
    for depth, node in enumerate(nodes):
        offset += len(node)
        if depth + 1 < len(nodes):
            below = nodes[depth + 1]
            child = np.searchsorted(below[:, 1], node[:, 1]) + offset
            stop = np.searchsorted(below[:, 1], node[:, 2]) + offset
        else:
            child = stop = np.zeros(len(node), np.int64)
        out.append(np.column_stack([node, child, stop]))
    return order, np.concatenate(out), np.concatenate(radii)


def all_alone(label: np.ndarray) -> bool:
    return len(np.unique(label)) == len(label)


def _cover(gap: np.ndarray, parent: np.ndarray, radius: float) -> np.ndarray:
    """The centre each point belongs to, within its parent: centres are over ``radius`` apart."""
    label = np.full(len(parent), -1, np.int64)
    near = (gap <= radius) & (parent[:, None] == parent[None, :])
    # a parent's centre stays a centre, so levels are nested
    for i in [*np.unique(parent).tolist(), *np.flatnonzero(near.sum(axis=1) > 1).tolist()]:
        if label[i] < 0:
            label[near[i] & (label < 0)] = i
            label[i] = i
    return np.where(label < 0, np.arange(len(parent)), label)


class Block:
    def __init__(self, ids, copies, vectors: bytes, width: int, nodes, radii):
        self.ids, self.copies = np.asarray(ids, np.int64), np.asarray(copies, np.int64)
        self.x = unit(np.frombuffer(vectors, np.float32).reshape(-1, width))
        self.nodes, self.radii = np.asarray(nodes, np.int64), np.asarray(radii)
        self.centers = self.x[self.nodes[:, 0]]
        self.sums = np.concatenate([[0], np.cumsum(self.copies)])


def traverse(a: Block, b: Block, cosine: float = COSINE):
    """(links of a's members, links of b's, pairs, whole): counts by copies, linked point pairs,
    and pairs of ranges linked as a whole. ``a is b`` is the block with itself."""
    reach = np.sqrt(2.0 - 2.0 * cosine)
    same = a is b
    count_a, count_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    pairs, whole = [], []
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(left):
        next_left, next_right = [], []
        for i in range(0, len(left), 1 << 16):
            p, q = left[i:i + (1 << 16)], right[i:i + (1 << 16)]
            gap = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", a.centers[p], b.centers[q]), 0.0))
            slack = a.radii[p] + b.radii[q]
            keep = gap <= reach + slack + MARGIN
            p, q, gap, slack = p[keep], q[keep], gap[keep], slack[keep]
            sure = gap + slack <= reach - MARGIN
            for s, t in zip(p[sure].tolist(), q[sure].tolist(), strict=True):
                whole.append((s, t))
            p, q = p[~sure], q[~sure]
            leaf = (a.nodes[p, 3] == a.nodes[p, 4]) & (b.nodes[q, 3] == b.nodes[q, 4])
            for s, t in zip(p[leaf].tolist(), q[leaf].tolist(), strict=True):
                pairs.append(_exact(a, b, s, t, same and s == t, cosine))
            for s, t in zip(p[~leaf].tolist(), q[~leaf].tolist(), strict=True):
                u, v = _expand(a, b, s, t, same and s == t, reach)
                next_left.append(u)
                next_right.append(v)
        left = np.concatenate(next_left) if next_left else np.zeros(0, np.int64)
        right = np.concatenate(next_right) if next_right else np.zeros(0, np.int64)
    for i, j in pairs:
        np.add.at(count_a, i, b.copies[j])
        np.add.at(count_b, j, a.copies[i])
    for s, t in whole:
        (_, lo, hi, _, _), (_, lo2, hi2, _, _) = a.nodes[s], b.nodes[t]
        count_a[lo:hi] += b.sums[hi2] - b.sums[lo2]
        if same and s == t:
            count_a[lo:hi] -= a.copies[lo:hi]
        else:
            count_b[lo2:hi2] += a.sums[hi] - a.sums[lo]
    return count_a, count_b, pairs, whole


def _children(block: Block, node: int) -> np.ndarray:
    first, end = block.nodes[node, 3:5]
    return np.arange(first, end) if end > first else np.array([node])


def _expand(a: Block, b: Block, s: int, t: int, itself: bool, reach: float):
    """The pairs of children that are near enough; a node with itself gives each pair once."""
    u, v = _children(a, s), _children(b, t)
    out = [[], []]
    for i in range(0, len(u), 512):
        part = u[i:i + 512]
        near = distances(a.centers[part], b.centers[v]) <= reach + a.radii[part][:, None] + b.radii[v][None, :] + MARGIN
        if itself:
            near &= part[:, None] <= v[None, :]
        x, y = np.nonzero(near)
        out[0].append(part[x])
        out[1].append(v[y])
    return np.concatenate(out[0]), np.concatenate(out[1])


def _exact(a: Block, b: Block, s: int, t: int, itself: bool, cosine: float):
    """The linked pairs of members of two leaves."""
    (_, lo, hi, _, _), (_, lo2, hi2, _, _) = a.nodes[s], b.nodes[t]
    near = a.x[lo:hi] @ b.x[lo2:hi2].T >= cosine
    if itself:
        near &= np.arange(lo, hi)[:, None] < np.arange(lo2, hi2)[None, :]
    i, j = np.nonzero(near)
    return i + lo, j + lo2


def local_links(a: Block, b: Block, pairs, whole) -> tuple[np.ndarray, np.ndarray]:
    """(id, root id): every linked vector with the smallest id of its component in these blocks."""
    ids = a.ids if a is b else np.concatenate([a.ids, b.ids])
    shift = 0 if a is b else len(a.ids)
    left = [i for i, _ in pairs]
    right = [j + shift for _, j in pairs]
    for s, t in whole:
        (_, lo, hi, _, _), (_, lo2, hi2, _, _) = a.nodes[s], b.nodes[t]
        left += [np.full(hi2 - lo2, lo), np.full(hi - lo, lo2 + shift)]
        right += [np.arange(lo2, hi2) + shift, np.arange(lo, hi)]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = np.concatenate(left), np.concatenate(right)
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    by_rank = np.sort(ids, kind="stable")
    u, v = rank[u], rank[v]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    linked = np.flatnonzero(root != np.arange(len(ids)))
    return by_rank[linked], by_rank[root[linked]]


def classes_of(vectors: DataFrame) -> DataFrame:
    """(embedding, width, rep, copies): the distinct usable vectors."""
    x = F.col("embedding").cast("array<float>")
    usable = (F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")).cast("float"))) & F.exists(x, lambda v: v != 0))
    return vectors.filter(usable).groupBy(x.alias("embedding")).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies")).withColumn("width", F.size("embedding"))


def trees(classes: DataFrame) -> DataFrame:
    """One cover tree per block."""
    pivots = {}
    for row in classes.orderBy(F.xxhash64("rep")).limit(PIVOTS).select("width", "embedding").collect():  # at most PIVOTS
        pivots.setdefault(row["width"], []).append(row["embedding"])
    pivots = {w: unit(np.array(v, np.float32)) for w, v in pivots.items()}

    def assign(batches):
        for batch in batches:
            rows = batch.column(0)
            width = batch.column(1).to_numpy()
            best = np.zeros(len(width), np.int64)
            for w in np.unique(width):
                mine = np.flatnonzero(width == w)
                if w in pivots:
                    x = unit(np.array([rows[i].as_py() for i in mine.tolist()], np.float32))
                    best[mine] = (x @ pivots[w].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32))], names=["embedding", "width", "rep", "copies", "pivot"])

    placed = classes.select("embedding", "width", "rep", "copies").mapInArrow(assign, "embedding array<float>, width int, rep long, copies long, pivot int")
    placed = stage(placed, "placed")
    sizes = placed.groupBy("width", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    blocks = placed.join(sizes, ["width", "pivot"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))

    def grow(table: pa.Table) -> pa.Table:
        raw = np.array(table.column("embedding").to_pylist(), np.float32)
        x = unit(raw)
        order, nodes, radii = build(x)
        pick = lambda name: table.column(name).to_numpy()[order].tolist()
        return pa.Table.from_pydict({
            "ids": [pick("rep")], "copies": [pick("copies")], "vectors": [raw[order].tobytes()], "width": [raw.shape[1]],
            "center": [x[order][nodes[0, 0]].tolist()], "radius": [float(radii[0])], "nodes": [nodes.tolist()], "radii": [radii.tolist()]},
            schema=pa.schema([("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("vectors", pa.binary()), ("width", pa.int32()),
                              ("center", pa.list_(pa.float64())), ("radius", pa.float64()), ("nodes", pa.list_(pa.list_(pa.int32()))), ("radii", pa.list_(pa.float64()))]))

    grown = blocks.groupBy("width", "pivot", "part").applyInArrow(
        grow, "ids array<long>, copies array<long>, vectors binary, width int, center array<double>, radius double, nodes array<array<int>>, radii array<double>")
    # a block is known by the id of its first member
    return stage(grown.withColumn("block", F.element_at("ids", 1)), "trees")


def near_blocks(forest: DataFrame, cosine: float) -> DataFrame:
    """(a, b): pairs of blocks, a <= b, that may hold a link; from their centres and radii alone."""
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    narrow = forest.select("block", "width", "center", "radius")
    # blocks meet in GROUPS tasks per width, not in one
    other = narrow.select(F.col("block").alias("b"), "width", F.col("center").alias("center_b"), F.col("radius").alias("radius_b"),
                          F.pmod(F.xxhash64("block"), F.lit(GROUPS)).cast("int").alias("group"))
    ours = narrow.withColumnRenamed("block", "a").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))))
    both = ours.join(other, ["width", "group"]).filter("a <= b")
    dot = F.aggregate(F.zip_with("center", "center_b", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    gap = F.sqrt(F.greatest(F.lit(2.0) - 2.0 * dot, F.lit(0.0)))
    return both.filter(gap <= F.col("radius") + F.col("radius_b") + F.lit(reach + 1e-6)).select("a", "b")


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of (vec_id, embedding)."""
    classes = stage(classes_of(vectors), "classes")
    forest = trees(classes)
    body = ["ids", "copies", "vectors", "nodes", "radii"]
    left = forest.select(F.col("block").alias("a"), "width", F.struct(*body).alias("left"))
    right = forest.select(F.col("block").alias("b"), F.struct(*body).alias("right"))
    rows = near_blocks(forest, cosine).join(left, "a").join(right, "b").select("a", "b", "width", "left", "right")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b, width, left, right = (batch.column(k)[i].as_py() for k in range(5))
                make = lambda t: Block(t["ids"], t["copies"], t["vectors"], width, t["nodes"], t["radii"])
                first = make(left)
                second = first if a == b else make(right)
                count_a, count_b, pairs, whole = traverse(first, second, cosine)
                total = count_a + count_b if a == b else np.concatenate([count_a, count_b])
                ids = first.ids if a == b else np.concatenate([first.ids, second.ids])
                member, root = local_links(first, second, pairs, whole)
                hit = np.flatnonzero(total)
                columns = [np.concatenate([ids[hit], member]), np.concatenate([total[hit], np.zeros(len(member), np.int64)])]
                roots = pa.array(np.concatenate([ids[hit], root]))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), roots], names=["rep", "n", "root"])

    found = stage(rows.mapInArrow(run, "rep long, n long, root long"), "found")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    together = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(counts, "rep", "left").join(together.withColumnRenamed("node", "rep"), "rep", "left").select(
        "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    x = F.col("embedding").cast("array<float>")
    rows = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull(), x).alias("embedding"))
    joined = rows.join(per_class, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return joined.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def query(spark, sf_dir: str) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
