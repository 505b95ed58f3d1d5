"""Prefix trie of conversations: ternary search trees per range shard, merged at the shard borders.

A turn is named by 16 bytes of a SHA-256 of its role and text, followed by its number of words; a
conversation is the concatenation of its turns' names, so texts are shuffled nowhere and byte order
puts every subtree of the trie into one stretch. Conversations are range-partitioned by that name
and member id, equal ones are counted where they lie, and the distinct ones are range-partitioned
into shards of bounded size.

In a shard the turns are dictionary-encoded (numbers in byte order) and the sequences put into a
ternary search tree, medians first, so that every tree of siblings is balanced. One iterative
traversal adds up members, leaves and savings. All nodes but those on the first and the last path
of the shard are final. The nodes on these two paths may go on in other shards: a shard hands each
path on as a sequence with the sums that its nodes got from elsewhere, and such paths are sharded
again, until one shard holds them all. As a shard makes two paths of many thousand sequences, that
is a round or two at any size. Parents that were open are named by (path, depth) and filled in last.

Members of one node of the whole corpus (a third of all rows may be copies of one conversation) are
written as runs of ids in ascending order, each of bounded size, and hashed run by run.

Defined results: null role or text is empty; turns of a conversation go by turn (null first), then
role, then the hash of role and text; a repeated row is a turn of its own; rows without conv_id
belong to no conversation and are left out; a conversation without turns is a member of the root
alone; an empty table has the root alone, without a conv_id; turns and conversations may be of any
length; other columns are ignored, whatever their names.
"""

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.llm.words import WORD
from surveil.session import stage

NAME = 16                 # bytes of a turn's hash
TURN = NAME + 4           # and its number of words
SHARD_TURNS = 1 << 18
SHARD_PATHS = 16          # a shard has as many at least, so that its two border paths are few beside them
RUN_IDS = 4096
GROUP, SHARED = 20, 4

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PATH = "seq binary, at int, ns array<long>, firsts array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
OUT = f"kind int, {NODE}, up binary, path binary, place int, {PATH}"
NODE_ROW, PATH_ROW, PLACE_ROW = 0, 1, 2
EMPTY = hashlib.sha256(b"").hexdigest()


# ---- sequences --------------------------------------------------------------------------------

def turn_name() -> Column:
    """40 hex digits: hash of role and text, then the words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(both, 256), 1, 2 * NAME), F.lpad(F.lower(F.hex(F.regexp_count(text, F.lit(WORD)))), 8, "0"))


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, seq) of (conv_id, turn, role, text): the names of a conversation's turns, in order."""
    named = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), turn_name().alias("name")).alias("t"))
    grouped = named.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return grouped.select("conv_id", F.unhex(F.array_join("turns.name", "")).alias("seq"))


def branch(convs: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of c - c % group, then its own after the first
    h, with h = crc32(decimal c) % shared."""
    kept = convs.withColumn("_h", (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")).withColumn(
        "_base", F.col("conv_id") - F.col("conv_id") % group)
    heads = convs.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.substring("seq", 1, TURN * (shared - 1)).alias("_head"))
    head = F.coalesce(F.substr("_head", F.lit(1), F.col("_h") * TURN), F.unhex(F.lit("")))
    return kept.join(heads, "_base", "left").select("conv_id", F.concat(head, F.substr("seq", F.col("_h") * TURN + 1, F.length("seq"))).alias("seq"))


# ---- members ----------------------------------------------------------------------------------

def member_runs(convs: DataFrame) -> DataFrame:
    """(seq, first, n, members): ascending ids of equal sequences, at most ``RUN_IDS`` a row."""
    ordered = convs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")

    def run(batches):
        seq, ids = None, []

        def rows(done):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1][0] for x in done], pa.int64()),
                                               pa.array([len(x[1]) for x in done], pa.int64()), pa.array([",".join(map(str, x[1])) for x in done], pa.string())],
                                              names=["seq", "first", "n", "members"])

        for batch in batches:
            done = []
            for own, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != seq or len(ids) == RUN_IDS:
                    if ids:
                        done.append((seq, ids))
                    seq, ids = own, []
                ids.append(conv_id)
            if done:
                yield rows(done)
        if ids:
            yield rows([(seq, ids)])

    return ordered.select("seq", "conv_id").mapInArrow(run, "seq binary, first long, n long, members string")


# ---- one shard --------------------------------------------------------------------------------

class TernaryTree:
    """Sequences of numbers; node i has a number, a lower and a higher sibling, and a first child."""

    def __init__(self):
        self.value, self.low, self.high, self.down = [-1], [0], [0], [0]   # node 0 is the root

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence, the root first."""
        node, path = 0, [0]
        value, low, high, down = self.value, self.low, self.high, self.down
        for number in sequence:
            at, link, parent = down[node], down, node
            while at and value[at] != number:
                link, parent = (low, at) if number < value[at] else (high, at)
                at = link[at]
            if not at:
                at = link[parent] = len(value)
                value.append(number)
                low.append(0)
                high.append(0)
                down.append(0)
            node = at
            path.append(node)
        return path


def median_order(n: int):
    """0 .. n - 1, the middle first, then the middles of both halves, and so on."""
    waiting = [(0, n)]
    for a, b in waiting:
        if a < b:
            m = (a + b) // 2
            yield m
            waiting += [(a, m), (m + 1, b)]


def path_name(seq: bytes) -> bytes:
    return hashlib.sha256(seq).digest()[:NAME]


def build(paths: list[tuple], last: bool) -> list[tuple]:
    """Rows of ``OUT`` of one shard.

    ``paths`` are (seq, at, ns, firsts, kids, leaves, saved, ends, is_path), distinct and in byte order;
    the lists give what the nodes of depth ``at`` and more have besides their children here.
    With ``last`` no other shard exists, so all nodes are final.
    """
    cut = [[seq[i:i + TURN] for i in range(0, len(seq), TURN)] for seq, *_ in paths]
    names = sorted(set().union(*cut))
    number = {name: i for i, name in enumerate(names)}
    words = [int.from_bytes(name[NAME:], "big") for name in names]
    tree, spots = TernaryTree(), [None] * len(paths)
    for i in median_order(len(paths)):
        spots[i] = tree.insert([number[x] for x in cut[i]])
    size = len(tree.value)
    n, first, kids, leaves, saved, ends = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [None] * size
    for (_, at, ns, firsts, ks, ls, ss, es, _), nodes in zip(paths, spots):
        for j, node in enumerate(nodes[at:]):
            n[node] += ns[j]
            if firsts[j] is not None and (first[node] is None or firsts[j] < first[node]):
                first[node] = firsts[j]
            kids[node] += ks[j]
            leaves[node] += ls[j]
            saved[node] += ss[j]
            ends[node] = ends[node] or es[j]
    left, right = spots[0], spots[-1]
    common = 0
    while common < min(len(left), len(right)) and left[common] == right[common]:
        common += 1
    open_nodes = {} if last else {node: (0, d) for d, node in enumerate(left)} | {node: (1, d) for d, node in enumerate(right) if d >= common}
    # nodes in the order of the traversal, with parent and depth; children come after their parent
    order, parent, depth, waiting = [0], [0] * size, [0] * size, [(tree.down[0], 0)]
    while waiting:
        at, up = waiting.pop()
        if at:
            parent[at], depth[at] = up, depth[up] + 1
            order.append(at)
            waiting += [(tree.low[at], up), (tree.high[at], up), (tree.down[at], at)]
    order.sort(key=depth.__getitem__)
    for node in reversed(order):
        if node in open_nodes:
            continue                      # its parent is open too and waits for the merge
        if not kids[node]:
            leaves[node] = 1
        if node:
            saved[node] += (n[node] - 1) * words[tree.value[node]]
            up = parent[node]
            n[up] += n[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            kids[up] += 1
            if first[node] is not None and (first[up] is None or first[node] < first[up]):
                first[up] = first[node]
    edges = (path_name(paths[0][0]), path_name(paths[-1][0]))
    none = (None,) * 8
    out = []
    for node in order:
        if node in open_nodes:
            continue
        up = parent[node]
        side = open_nodes.get(up)
        out.append((NODE_ROW, first[node], depth[node], None if side is not None or not node else first[up], n[node], kids[node], leaves[node], saved[node],
                    ends[node] or EMPTY, None if side is None else edges[side[0]], None, None, *none))
    if not last:
        for nodes, seq, at in ((left, paths[0][0], 0), (right, paths[-1][0], common))[:1 + (right is not left)]:
            own = nodes[at:]
            out.append((PATH_ROW, *(None,) * 9, None, None, seq, at, *([x[v] for v in own] for x in (n, first, kids, leaves, saved, ends))))
    for (seq, at, *_, is_path), nodes in zip(paths, spots):
        if is_path:                       # where the nodes of a path of the round before have gone
            for d, node in enumerate(nodes[at:], at):
                side = open_nodes.get(node)
                out.append((PLACE_ROW, first[node] if side is None else None, d, *(None,) * 6, None if side is None else edges[side[0]], path_name(seq), d, *none))
    return out


_TYPES = [pa.int32(), *[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string())]
_NAMES = [x.strip().split()[0] for x in OUT.split(",")]


def _rows(rows: list[tuple]):
    for first in range(0, len(rows), 8192):
        columns = zip(*rows[first:first + 8192])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _member_paths(batches):
    """Streams (seq, first, n, members) sorted by seq and first as paths; members are hashed run by run."""
    seq, first, n, digest = None, None, 0, None
    for batch in batches:
        for own, low, count, members in zip(*(c.to_pylist() for c in batch.columns)):
            if own == seq:
                digest.update(b"," + members.encode())
                n += count
                continue
            if seq is not None:
                yield seq, len(seq) // TURN, [n], [first], [0], [0], [0], [digest.hexdigest()], False
            seq, first, n, digest = own, low, count, hashlib.sha256(members.encode())
    if seq is not None:
        yield seq, len(seq) // TURN, [n], [first], [0], [0], [0], [digest.hexdigest()], False


def _open_paths(batches):
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield *row, True


def _shards(stream, last: bool, limit: int):
    """Shards of about ``limit`` turns, in order; each as record batches."""
    own, turns = [], 0
    for path in stream:
        if len(own) >= SHARD_PATHS and turns >= limit and not last:
            yield from _rows(build(own, last))
            own, turns = [], 0
        own.append(path)
        turns += len(path[0]) // TURN + 1
    if own:
        yield from _rows(build(own, last))


# ---- the trie ---------------------------------------------------------------------------------

def prefix_trie(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes (``NODE``) of the trie of (conv_id, seq), one row per distinct prefix."""
    spark = convs.sparkSession
    root = spark.range(1).select(F.unhex(F.lit("")).alias("seq"), F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("n"), F.lit("").alias("members"))
    runs = stage(member_runs(stage(convs.select("conv_id", "seq"), "sequences")), "member-runs")
    # a root without members keeps the trie of an empty table whole
    runs = runs if not runs.isEmpty() else root
    ordered = runs.repartitionByRange("seq").sortWithinPartitions("seq", "first").select("seq", "first", "n", "members")
    made = stage(ordered.mapInArrow(lambda batches: _shards(_member_paths(batches), False, shard_turns), OUT), "trie-shards")
    rounds = [made]
    fields = [x.strip().split()[0] for x in PATH.split(",")]
    while True:
        paths = rounds[-1].filter(F.col("kind") == PATH_ROW).select(fields)
        count, turns = paths.agg(F.count("*"), F.sum(F.length("seq") / TURN + 1)).first()
        last = (turns or 0) <= shard_turns or count <= 2 * SHARD_PATHS
        # the last round has one shard; before, every task gets enough paths to shrink them to a quarter
        tasks = 1 if last else max(1, min(int(turns) // shard_turns, count // SHARD_PATHS))
        ordered = paths.repartitionByRange(tasks, "seq").sortWithinPartitions("seq")
        rounds.append(stage(ordered.mapInArrow(lambda batches, last=last: _shards(_open_paths(batches), last, shard_turns), OUT), "trie-borders"))
        if last:
            break
    node_columns = [x.strip().split()[0] for x in NODE.split(",")]
    nodes, places = None, None
    for made in reversed(rounds):
        own = made.filter(F.col("kind") == NODE_ROW).select(*node_columns, "up")
        moved = made.filter(F.col("kind") == PLACE_ROW).select("path", F.col("place").cast("long").alias("_depth"), F.col("conv_id").alias("_first"), F.col("up").alias("_up"))
        if places is not None:
            named = places.select(F.col("path").alias("up"), "_depth", F.col("_first").alias("_found"))
            own = own.withColumn("_depth", F.col("depth") - 1).join(named, ["up", "_depth"], "left").withColumn(
                "parent_conv_id", F.coalesce("parent_conv_id", "_found")).select(*node_columns, "up")
            moved = moved.join(places.select(F.col("path").alias("_up"), "_depth", F.col("_first").alias("_found")), ["_up", "_depth"], "left").select(
                "path", "_depth", F.coalesce("_first", "_found").alias("_first"), "_up")
        nodes = own if nodes is None else nodes.unionByName(own)
        places = moved
    return nodes.select(node_columns)


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(branch(sequences(rows)))
