"""Session helpers: defaults, and scratch tables that cut lineage."""

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_staged: ContextVar[list | None] = ContextVar("staged", default=None)


def build_session(name: str = "surveil", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect; cluster settings win over these."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # recording the call site of every column operation makes building plans slow
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return apply_defaults(builder.getOrCreate())


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Runtime settings results depend on (all times are UTC)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, gets a folder of its own when the setting is absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    folder = os.environ.get("SURVEIL_SCRATCH")
    if not folder:
        folder = os.environ["SURVEIL_SCRATCH"] = tempfile.mkdtemp(prefix="surveil-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)   # a folder of its own goes with the process that made it
    return folder


def stage(frame: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``frame`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage for iterative jobs, survives lost executors, and gives the
    planner real sizes, so a later join broadcasts only what is measured to be small.
    """
    spark = frame.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/surveil-{uuid.uuid4().hex}/{name}"
    if _staged.get() is not None:
        _staged.get().append(path.rsplit("/", 1)[0])
    frame.write.mode("errorifexists").option("compression", codec).parquet(path)
    staged = spark.read.schema(frame.schema).parquet(path)
    staged.staged_in = path.rsplit("/", 1)[0]
    return staged


def unstage(staged: DataFrame) -> None:
    """Delete a table that ``stage`` wrote and nothing reads any more."""
    delete_path(staged.sparkSession, staged.staged_in)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged_tables(spark: SparkSession):
    """Tables staged inside are deleted at the end; results must be written before that.

    Long-running streams use it so that scratch tables do not pile up.
    """
    token = _staged.set([])
    try:
        yield
    finally:
        paths = _staged.get()
        _staged.reset(token)
        for path in paths:
            delete_path(spark, path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs now, not when the driver next collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release_heaps(spark: SparkSession) -> None:
    """Let executors collect garbage: a heap that a shuffle has filled shrinks before Python workers grow beside it."""
    tasks = spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()
