"""Mixing sources to target weights by systematic sampling. Native expressions only.

Inside a source, documents are ordered by size and id. Every document is expected ``target /
source size`` times; these expectations are added up along the order, one random offset per
source is added, and a document is taken once for each integer the running sum passes in its
step. All documents of a source have the same expectation, so the running sum is the rank times
the rate: no floating-point sum, and the same result on every run. Ordering by size makes the
words taken follow the words asked for (each size class gets its share).

Targets: sources in code-point order (null last) weigh ``weights`` in rotation and share
``budget`` times all words; a source gets at most ``most`` times its own words, and what it
cannot take is shared again by weight.

Defined results: a null text has size 0; a source without words has target 0 and takes nothing;
an empty table gives an empty result; repeated rows count as documents of their own; a null id
sorts first. Columns named ``size``, ``source_size``, ``target``, ``copies`` or ``taken`` in the
input are replaced.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.llm.ranks import ranked
from surveil.llm.words import WORD
from surveil.session import stage

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2.0
SEED = "mix-1"
RESULTS = ["size", "source_size", "target", "copies", "taken"]


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size), one row per source.

    Rounds of capping: each round brings two sums to the driver, and at least one more source
    reaches its cap.
    """
    named = sizes.withColumn("_none", F.col("source").isNull()).withColumn("_one", F.lit(1))
    numbered = ranked(named, ["_one"], ["_none", "source"], "sources", "source_no")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    state = stage(numbered.select("source", "source_no", "source_size", weight.alias("weight"),
                                  (F.col("source_size") * F.lit(most)).alias("cap")), "weights")
    words = float(state.agg(F.sum("source_size")).first()[0] or 0)
    capped = F.lit(False)
    while True:
        full, free = state.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
                               F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        rest, free = budget * words - float(full or 0.0), float(free or 0.0)
        share = F.lit(rest) * F.col("weight") / F.lit(free or 1.0)
        over = capped | (share > F.col("cap"))
        if not state.filter(over & ~capped).limit(1).count():
            break
        # what is capped is decided by two scalars of this round, so the condition stays short
        limit = F.lit(rest) * F.col("weight") / F.lit(free) > F.col("cap")
        capped = limit | capped
    target = F.when(capped, F.col("cap")).otherwise(share)
    return state.select("source", "source_no", "source_size", target.alias("target"))


def offset(source, seed: str = SEED):
    """A number in [0, 1) that depends on the source alone."""
    named = F.concat(F.lit(seed), F.when(source.isNull(), F.lit("/")).otherwise(F.concat(F.lit(":"), source)))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def allocate(docs: DataFrame, carry: list[str] | None = None, weights=WEIGHTS, budget: float = BUDGET,
             most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken, carried columns): how often each document is taken."""
    carry = [c for c in carry or [] if c not in (*RESULTS, "doc_id")]
    extra = [c for c in carry if c != "source"]
    sized = docs.select("doc_id", "source", *[F.col(f"`{c}`") for c in extra],
                        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # null sources get a key of their own, so that keys are never null
    keyed = sized.withColumn("_source", F.when(F.col("source").isNull(), F.lit("/")).otherwise(F.concat(F.lit(":"), "source")))
    rows = ranked(keyed, ["_source"], ["size", "doc_id"], "mix")
    totals = rows.groupBy("_source", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals.select("source", "source_size"), weights, budget, most)
    targets = targets.withColumn("_source", F.when(F.col("source").isNull(), F.lit("/")).otherwise(F.concat(F.lit(":"), "source"))).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(targets, "_source").withColumn("_rate", rate).withColumn("_u", offset(F.col("source"), seed))
    passed = F.floor(F.col("rank") * F.col("_rate") + F.col("_u")) - F.floor((F.col("rank") - 1) * F.col("_rate") + F.col("_u"))
    copies = F.least(passed, F.lit(int(-(-most // 1)))).cast("long")
    return joined.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"`{c}`") for c in carry])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each as often as it is taken, in the columns of ``docs``."""
    shaped = docs.select(*[F.col(f"`{c}`").alias(f"{c}_") if c in RESULTS else F.col(f"`{c}`") for c in docs.columns])
    taken = allocate(shaped, [c for c in shaped.columns if c != "doc_id"], **options).filter("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"`{c}_`").alias(c) if c in RESULTS else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return allocate(docs).select("doc_id", "size", "source_size", "target", "taken")
