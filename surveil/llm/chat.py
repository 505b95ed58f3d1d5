"""Chat formatting of reply trees. Native expressions only.

A tree is a set of messages with a parent each. Stretches in which every message has one reply
are contracted first (pointer jumping: a self-join doubles the distance each round), so a thread
of n messages takes log n rounds; then iterative self-joins climb from each leaf over the
contracted tree and list its root-to-leaf path. Paths are ranked by score inside their tree, and
each chosen path becomes one text.

Template: every turn is ``### role: text </turn>`` and a line feed. Control strings inside a
role or text are escaped reversibly: a backslash becomes ``\\b``, ``#`` becomes ``\\h``, ``<``
becomes ``\\l``, and ``:`` in a role ``\\c``; a marker can therefore never be forged by a text.
The loss mask is a list of code-point spans of the formatted text that cover the assistant's texts.

Defined results: null text or role is empty; a message whose parent is missing or is itself is a
root; messages on a parent cycle have no path and appear in none; a repeated (tree, node) id is
one message (the smallest row); messages may have any length; an empty table gives no rows;
other columns of the input are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveil.session import stage

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]   # the backslash first; undone in reverse
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
ASSISTANT = "assistant"
PROBE = "\\### Assistant: </turn> ok"


def escape(value: Column, table=ESCAPES) -> Column:
    for raw, safe in table:
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def unescape(value: Column, table=ESCAPES) -> Column:
    for raw, safe in reversed(table):
        value = F.replace(value, F.lit(safe), F.lit(raw))
    return value


def runs(nodes: DataFrame) -> DataFrame:
    """(tree, node, parent, head, step): the unbranched stretch each message lies on.

    ``head`` is the stretch's first message and ``step`` the distance from it.
    """
    children = nodes.filter("parent IS NOT NULL AND parent <> node").groupBy("tree", "parent").agg(F.count("*").alias("replies"))
    parents = nodes.select("tree", F.col("node").alias("parent"))
    linked = nodes.select("tree", "node", "parent").join(
        parents.join(children, ["tree", "parent"]), ["tree", "parent"], "left")
    # a parent that exists and has one reply continues its stretch
    inner = (F.col("replies") == 1) & (F.col("parent") != F.col("node"))
    state = stage(linked.select(
        "tree", "node", F.when(F.col("replies").isNotNull() & (F.col("parent") != F.col("node")), F.col("parent")).alias("parent"),
        F.when(inner, F.col("parent")).otherwise(F.col("node")).alias("head"),
        F.when(inner, 1).otherwise(0).cast("long").alias("step"), F.coalesce(inner, F.lit(False)).alias("open")), "runs")
    rounds = 1
    while rounds < 64 and not state.filter("open").isEmpty():
        ahead = state.select("tree", F.col("node").alias("head"), F.col("head").alias("_head"),
                             F.col("step").alias("_step"), F.col("open").alias("_open"))
        # only stretches whose head is not known yet are joined again
        moved = state.filter("open").join(ahead, ["tree", "head"], "left").select(
            "tree", "node", "parent", F.coalesce("_head", "head").alias("head"),
            (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step"),
            (F.coalesce("_open", F.lit(False)) & (F.col("_head") != F.col("node"))).alias("open"))
        state = stage(moved.unionByName(state.filter("NOT open")), "runs")
        rounds += 1
    return state


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, hop, step): every message of every root-to-leaf path.

    In path order, ``hop`` falls (0 is the leaf's stretch) and, inside a hop, ``step`` rises.
    """
    state = runs(nodes)
    # a message is the last of its stretch when nothing on the stretch follows it
    last = state.groupBy("tree", "head").agg(F.max_by("node", "step").alias("node"))
    heads = state.filter("step = 0 AND NOT open").select("tree", F.col("node").alias("head"), F.col("parent"))
    above = state.select("tree", F.col("node").alias("parent"), F.col("head").alias("up"))
    tree = heads.join(above, ["tree", "parent"], "left").select("tree", "head", "up")
    tree = stage(tree.join(last, ["tree", "head"]), "stretches")
    inner = tree.filter("up IS NOT NULL").select("tree", F.col("up").alias("head")).distinct()
    front = stage(tree.join(inner, ["tree", "head"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "head", "up", F.lit(0).alias("hop")), "front")
    levels = [front]
    parents = tree.select("tree", F.col("head").alias("up"), F.col("up").alias("_up"))
    while not front.filter("up IS NOT NULL").isEmpty():
        front = stage(front.filter("up IS NOT NULL").join(parents, ["tree", "up"]).select(
            "tree", "leaf", F.col("up").alias("head"), F.col("_up").alias("up"), (F.col("hop") + 1).alias("hop")), "front")
        levels.append(front)
    climbed = levels[0]
    for level in levels[1:]:
        climbed = climbed.unionByName(level)
    return climbed.select("tree", "leaf", "head", "hop").join(
        state.select("tree", "node", "head", "step"), ["tree", "head"]).select("tree", "leaf", "node", "hop", "step")


def format_trees(messages: DataFrame, top: int | None = None, salts: int = 64) -> DataFrame:
    """(tree, leaf, score, place, formatted, mask) from (tree, node, parent, role, text, score).

    One row per chosen path: ``top`` per tree by mean message score (then leaf id), or all.
    ``mask`` is an array of (start, length) in code points, start from 0.
    """
    clean = messages.select(
        "tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    clean = stage(clean.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select(
        "tree", "node", "m.*"), "messages")
    paths = leaf_paths(clean.select("tree", "node", "parent"))
    if top is not None:
        scored = paths.join(clean.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
        order = [F.desc("score"), F.col("leaf")]
        part = F.pmod(F.xxhash64("leaf"), F.lit(salts))
        few = scored.withColumn("_salt", part).withColumn(
            "_place", F.row_number().over(Window.partitionBy("tree", "_salt").orderBy(*order))).filter(F.col("_place") <= top)
        chosen = few.withColumn("_place", F.row_number().over(Window.partitionBy("tree").orderBy(*order))).filter(F.col("_place") <= top)
        paths = paths.join(chosen.select("tree", "leaf"), ["tree", "leaf"], "left_semi")
    turns = paths.join(clean.select("tree", "node", "role", "text", "score"), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(MIDDLE))
    turns = turns.select("tree", "leaf", "hop", "step", "role", "score", head.alias("head"), escape(F.col("text")).alias("body"))
    chars = F.length("head") + F.length("body") + len(CLOSE)
    along = Window.partitionBy("tree", "leaf").orderBy(F.desc("hop"), "step")
    turns = turns.withColumn("start", F.coalesce(
        F.sum(chars).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head"))
    turn = F.struct("start", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.length("body").alias("length"),
                    (F.col("role") == ASSISTANT).alias("learn"))
    grouped = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.avg("score").alias("score"))
    return grouped.select(
        "tree", "leaf", "score", F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]),
                    lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("mask"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), unescaped."""
    pieces = F.split(formatted, " </turn>\n", -1)
    body = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(body, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(p, F.locate(MIDDLE, p) + len(MIDDLE))).alias("text")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(mask, lambda m: unescape(
        F.substring(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")


def turns_as_tree(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a tree each: every row answers the one before it."""
    within = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select(F.struct("conv_id").alias("tree"), F.row_number().over(within).cast("long").alias("node"), "role", "text")
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(PROBE).alias("text"))
    done = format_trees(turns_as_tree(rows.unionByName(probe)))
    read = done.select(F.col("tree.conv_id").alias("conv_id"), "formatted",
                       read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("mask")).alias("learned"))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
