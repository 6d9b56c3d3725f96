"""What the operators share: reading the table, stored intermediate tables, word patterns and hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contestlab.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: a cut in the lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000  # texts sent to a Python worker at a time


def small_batches(spark: SparkSession) -> None:
    """Texts are long rows: fewer of them per Arrow batch keep the buffers on both sides small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def whole(text: Column) -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def wide_hash(text: Column) -> tuple[Column, Column]:
    """128 bits of a text as two numbers: a collision needs both 64-bit hashes to agree."""
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)
