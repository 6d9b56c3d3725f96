"""Stored tables: Parquet folders with declared schemas, delimited text, de-duplicating appends."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from contestlab.operators.frames import same_keys
from contestlab.operators.joins import BITMAP_ROWS, BITS, bitmap, marked
from contestlab.session import pinned


def folder(spark: SparkSession, path: str):
    """File system and path of a folder, as the JVM knows them."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _is_name(target: str) -> bool:
    """A catalog table; anything with a slash is a folder."""
    return "/" not in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a folder (anything with a slash) or a catalog table of that name exists."""
    if _is_name(target):
        return spark.catalog.tableExists(target)
    fs, path = folder(spark, target)
    return fs.exists(path) and len(fs.listStatus(path)) > 0


def list_tables(spark: SparkSession, root: str | None = None) -> list[str]:
    """Names of the tables below a folder, or of the current catalog database."""
    if root is None:
        return sorted(t.name for t in spark.catalog.listTables())
    fs, path = folder(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def drop_table(spark: SparkSession, target: str) -> None:
    if _is_name(target):
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        return
    fs, path = folder(spark, target)
    fs.delete(path, True)


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None,
               where: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Stored table; the condition and the columns reach the Parquet scan."""
    if not _is_name(target):
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(target)
    else:
        df = spark.table(target)
    df = df if where is None else df.filter(where)
    return df if columns is None else df.select(*columns)


PRUNED = 5_000           # partitions whose values are named in the read; beyond them their range is
HASHES = 1_000_000       # rows of a batch whose hashes are broadcast, 8 bytes each


def _touched(batch: DataFrame, columns: Sequence[str]) -> tuple[list[Column], int]:
    """Which values of the partition columns a batch has, in literals, so that other folders are not listed or read; and its rows."""
    folders = batch.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).limit(PRUNED + 1).collect()
    many = len(folders) > PRUNED
    ends = batch.agg(F.count(F.lit(1)), *[f(c) for c in columns for f in (F.min, F.max, F.count)]).first() if many else None
    n, conditions = ends[0] if many else sum(r["_n"] for r in folders), []
    for i, c in enumerate(columns):
        col = F.col(c)
        if isinstance(batch.schema[c].dataType, (T.FloatType, T.DoubleType, T.BinaryType)):
            continue
        if many:
            low, high, known = ends[3 * i + 1:3 * i + 4]
            inside, missing = col.between(low, high), known < n
        else:
            values = {r[c] for r in folders}
            inside, missing = col.isin([v for v in values if v is not None]), None in values
        conditions.append(inside | col.isNull() if missing else inside)
    return conditions, n


def _hash(cols: Sequence[str], schema: T.StructType) -> Column:
    """64 bits of a row; equal rows have equal ones, 0.0 and -0.0 included."""
    floats = (T.FloatType, T.DoubleType)
    return F.xxhash64(*[F.col(c) + F.lit(0.0).cast(schema[c].dataType) if isinstance(schema[c].dataType, floats) else F.col(c) for c in cols])


def _perhaps_in(stored: DataFrame, batch: DataFrame, n: int, compared: Sequence[str], bits: int = BITS) -> DataFrame:
    """The stored rows whose hash the batch of n rows has, or in a large batch may have; the stored table is not shuffled for it.

    Up to `HASHES` rows the hashes themselves are broadcast, up to `BITMAP_ROWS` a bitmap of `bits` bits, which
    lets an eighth of the other rows pass at most. Beyond that all stored rows go on to the exact comparison.
    """
    mine, its = _hash(compared, batch.schema), _hash(compared, stored.schema)
    if n <= HASHES:
        return stored.join(F.broadcast(batch.select(mine.alias("_hash"))), its == F.col("_hash"), "left_semi")
    return marked(stored, bitmap(batch, mine, bits), its, bits) if n <= BITMAP_ROWS else stored


def new_rows(df: DataFrame, target: str, keys: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """The rows of `df`, each once, that an existing table does not hold yet. See `append_distinct`."""
    spark = df.sparkSession
    stored = read_table(spark, target, None if _is_name(target) else df.schema)
    if _is_name(target):  # compared as they will be stored
        df = df.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in df.columns])
    compared = list(keys) if keys else df.columns
    texts = [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]
    df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})  # a folder's name cannot tell them apart
    batch = pinned(_each_once(df, keys))  # its partitions, its hashes and its rows are all read from it
    conditions, n = _touched(batch, [c for c in partition_by if c in compared])
    for condition in conditions:
        stored = stored.filter(condition)
    known = _perhaps_in(stored.select(*compared), batch, n, compared)
    return batch.alias("n").join(known.alias("s"), same_keys("n", "s", compared), "left_anti")


def _each_once(df: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    rest = [c for c in df.columns if keys and c not in keys]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def append_distinct(df: DataFrame, target: str, keys: Sequence[str] | None = None,
                    partition_by: Sequence[str] = ()) -> None:
    """Append the rows the table does not hold yet, each once; create the table if missing.

    Rows count as equal when all columns (or `keys`) are equal, missing values included. Only new files are
    written, so a repeated or restarted load stores nothing twice. Of a table that is partitioned by compared
    columns only the partitions the batch has are read: its values are found first and become a filter of
    the scan (above `PRUNED` partitions, their range does). If `keys` leave a partition column out, a key may be
    stored in any partition and all are read. An empty text in a partition column is stored as a missing one. A target
    without a slash is a catalog table. One writer at a time.
    """
    spark = df.sparkSession
    if table_exists(spark, target):
        batch = new_rows(df, target, keys, partition_by)
        if _is_name(target):
            batch.select(*spark.table(target).columns).write.insertInto(target)
            return
    else:
        batch = _each_once(df, keys)
    writer = batch.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_name(target):
        writer.format("parquet").saveAsTable(target)
    else:
        writer.parquet(target)


# Delimited text. A backslash, a line break and a NUL inside a text are written as two characters, and a missing value as
# \N, which no text can be then: files split at any line, and every text comes back.
_MISSING = "\\N"
_ESCAPES = {"\n": "\\n", "\r": "\\r", "\x00": "\\0"}
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _texts_of(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def _escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, written in _ESCAPES.items():
        out = F.replace(out, F.lit(char), F.lit(written))
    return out


def _unescape(text: Column) -> Column:
    """Between two backslashes written for one, the others begin an escape."""
    def plain(part: Column) -> Column:
        for char, written in _ESCAPES.items():
            part = F.replace(part, F.lit(written), F.lit(char))
        return part

    parts = F.split(text, r"\\\\", -1)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(parts, plain), "\\")).otherwise(text)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", missing: str | None = None) -> None:
    """Delimited text with a header, one part file per task; all texts and times come back by `read_csv`.

    For other programs name a marker of `missing` values, "NA" say: then texts are written as they are, quoted where
    need be, and one that reads like the marker is missing when it comes back."""
    if missing is None:
        df = df.withColumns({c: _escape(F.col(c)) for c in _texts_of(df.schema)})
    df.write.mode(mode).options(
        header=True, sep=sep, nullValue=_MISSING if missing is None else missing, emptyValue='""', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_TIMES).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", missing: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """Delimited text as written by `write_csv` with the same marker, or by other programs. With `multi_line`, which only
    text with a marker needs, fields may hold line breaks, at the price of one task per file."""
    df = spark.read.schema(schema).options(
        header=True, sep=sep, nullValue=_MISSING if missing is None else missing, emptyValue="", escape='"', multiLine=multi_line,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_TIMES).csv(path)
    return df.withColumns({c: _unescape(F.col(c)) for c in _texts_of(schema)}) if missing is None else df


# Fixed value: piece of the addresses of season pages.
SEASON_PATH = "all_matches"


def season_worklist(spark: SparkSession, start: int, end: int, leagues: dict[str, str], base: str) -> DataFrame:
    """Addresses of the season pages from `start` up to seasons ending by `end`, per league
    (title -> path). Raises when the range is empty."""
    if end <= start:
        raise ValueError("the start year must lie before the end year")
    paths = F.array(*[F.struct(F.lit(t).alias("title"), F.lit(p).alias("path")) for t, p in leagues.items()])
    return (
        spark.range(start, end).select(F.col("id").cast("int").alias("season_start"), F.explode(paths).alias("l"))
        .select(
            "season_start", (F.col("season_start") + 1).alias("season_end"), "l.title", "l.path",
            F.concat_ws("", F.lit(f"{base}/{SEASON_PATH}/"), "l.path", F.lit("-"), F.col("season_start").cast("string"),
                        F.lit("-"), (F.col("season_start") + 1).cast("string"), F.lit("/")).alias("url"))
    )


MODEL_RESULT = T.StructType([
    T.StructField("approach", T.StringType()),
    T.StructField("result", T.DoubleType()),
    T.StructField("time_run", T.StringType()),
])


def log_result(result: DataFrame, target: str, approach: str, as_of: date | None = None) -> None:
    """Add one run (a one-row frame with column accuracy) to the run log, once."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    row = result.select(
        F.lit(approach).alias("approach"), F.col("accuracy").cast("double").alias("result"),
        F.date_format(day, "yyyy-MM-dd").alias("time_run"))
    append_distinct(row, target)
