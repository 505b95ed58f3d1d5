"""Files in and out. Schemas are given, never inferred."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveil.constants import FILES_PER_TRIGGER

CORRUPT = "_corrupt_record"


def stream_json(spark: SparkSession, folder: str, schema: StructType,
                files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """JSON lines as a stream: only ``*.json``, a bounded number of files per trigger.

    A broken line becomes a row of NULLs with its text in ``_corrupt_record``, so it is counted as
    read and then rejected, and can still be looked at.
    """
    shown = StructType(list(schema.fields)).add(CORRUPT, "string")
    return (spark.readStream.schema(shown).option("pathGlobFilter", "*.json")
            .option("maxFilesPerTrigger", files_per_trigger).json(folder))


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header; ISO timestamps with an offset are read as UTC."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON document (an object or an array); a missing or broken file gives no rows."""
    shown = StructType(list(schema.fields)).add("_corrupt_record", "string")
    try:
        rows = spark.read.schema(shown).option("multiLine", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    complete = F.col("_corrupt_record").isNull() & F.coalesce(*[F.col(n).isNotNull() for n in schema.names])
    return rows.filter(complete).select(*schema.names)


def count_labels(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count("*").alias("rows_written"), F.count_if(F.col("is_corrupt")).alias("corrupt_rows"))


def _mode(fresh: bool) -> str:
    """Refuse an existing target unless it may be replaced."""
    return "overwrite" if fresh else "errorifexists"


def write_json_lines(frame: DataFrame, path: str, fresh: bool = False, append: bool = False) -> None:
    """Spark's commit makes the files visible at once, under their final names."""
    frame.write.mode("append" if append else _mode(fresh)).json(path)


def write_csv(frame: DataFrame, path: str, fresh: bool = False) -> None:
    frame.write.mode(_mode(fresh)).option("header", True).csv(path)
