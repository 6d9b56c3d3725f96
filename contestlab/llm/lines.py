"""Removal of repeated lines, batch by batch, against levelled sorted runs of line hashes.

The lines seen so far are kept as runs: tables of line hashes, bucketed and sorted by hash, so that
a batch joins them without moving them. Every batch merge-anti-joins all runs, adds the lines that
were new as a run of level 0, and when a level has `fan` runs they are compacted into one of the
next. A line seen n times is thus rewritten at most log(batches) / log(fan) times.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contestlab.llm.common import BLANKS, discard, stored, whole, wide_hash

MIN_CHARS = 10
FAN = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case; other letters as they are."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


class LineRuns:
    """The hashes of all lines seen so far, as bucketed tables in the warehouse, by level."""

    def __init__(self, spark: SparkSession, fan: int = FAN):
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: dict[int, list[str]] = defaultdict(list)
        self._made = 0

    def _write(self, hashes: DataFrame) -> str:
        name, self._made = f"{self.name}_{self._made}", self._made + 1
        (hashes.repartition(self.buckets, "h1", "h2").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .format("parquet").saveAsTable(name))
        return name

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The rows whose hash is in no run."""
        for runs in self.levels.values():
            for name in runs:
                hashes = hashes.join(self.spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
        return hashes

    def add(self, hashes: DataFrame) -> None:
        """A new run of hashes that no run holds; full levels are compacted."""
        self.levels[0].append(self._write(hashes.select("h1", "h2")))
        level = 0
        while len(self.levels[level]) >= self.fan:
            old, self.levels[level] = self.levels[level], []
            merged = reduce(DataFrame.unionAll, [self.spark.table(n) for n in old])
            self.levels[level + 1].append(self._write(merged))
            self._drop(old)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        for names in self.levels.values():
            self._drop(names)
        self.levels.clear()


def _batches(docs: DataFrame, key: str, batches: int) -> list[Column]:
    """Conditions that cut the documents into consecutive ranges of the key; missing keys come first."""
    cuts = docs.select(F.percentile_approx(F.col(key), [i / batches for i in range(1, batches)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    k = F.col(key)
    lows = [None, *cuts]
    highs = [*cuts, None]
    out = []
    for low, high in zip(lows, highs, strict=True):
        cond = F.lit(True) if low is None else k > low
        if high is not None:
            cond = cond & (k <= high)
        out.append((cond | k.isNull()) if low is None else cond)
    return out


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                batches: int = 4, fan: int = FAN) -> DataFrame:
    """One row per input row: key, `n_lines`, `n_dropped` and `kept`, the text that stays.

    A line whose stripped, lower-cased key has at least `min_chars` code points stays only in the
    document with the smallest key that holds it, there as often as it occurs. A missing or empty
    text is one empty line. Rows with a missing key sort before all others and count as one document,
    as do rows that share a key; equal rows get equal results. An empty table gives no rows. Columns
    other than key and text are not read.
    """
    rows = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    marks = repeats(docs, key=key, text=text, min_chars=min_chars, batches=batches, fan=fan)
    return without(rows, marks, key="key", text="text").drop("text")


def repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
            batches: int = 4, fan: int = FAN) -> DataFrame:
    """Columns key_, t1_ (a hash of the text) and flags: a text of one character per line, 1 where the line goes.

    The documents come in `batches` consecutive ranges of the key, so a line is dropped if a run
    holds it or if the batch itself has a smaller holder. Batches and levels bound what a step
    touches; rows of a very common line are combined before each shuffle, and the join that brings
    verdicts back to the lines has a broadcast for the lines that make up more than a thousandth of
    them (a thousand at most), and a shuffle for all others.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    docs = docs.withColumn("t1", F.xxhash64(F.lit(1), "text"))
    h1, h2 = wide_hash(F.col("k"))
    runs, parts = LineRuns(spark, fan), []
    for cond in _batches(docs, "key", batches):
        batch = docs.where(cond)
        lines = batch.select("key", "t1", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        lines = lines.withColumn("k", line_key(F.col("line"))).where(F.length("k") >= min_chars)
        lines = stored(lines.select("key", "t1", "pos", h1.alias("h1"), h2.alias("h2")), "line-hashes")
        held = stored(lines.groupBy("h1", "h2").agg(
            F.min("key").alias("first"), F.max("key").alias("last"), F.max(F.col("key").isNull()).alias("unkeyed"),
            F.count(F.lit(1)).alias("n")), "line-holders")
        new = stored(runs.unseen(held), "line-new")
        # known lines go everywhere, lines new in this batch go where a smaller holder exists
        several = (F.col("first") < F.col("last")) | (F.col("unkeyed") & F.col("last").isNotNull())
        here = new.where(several).withColumn("new", F.lit(True))
        known = held.join(new.select("h1", "h2"), ["h1", "h2"], "left_anti").withColumn("new", F.lit(False))
        verdicts = stored(here.unionByName(known), "line-verdicts")
        runs.add(new)
        parts.append(stored(_dropped(lines, verdicts), "line-dropped"))
        discard(lines, held, new, verdicts)
    runs.close()
    gone = reduce(DataFrame.unionByName, parts)
    gap = lambda p, i: F.repeat(F.lit("0"), p - F.when(i > 0, F.get("gone", i - 1)).otherwise(-1) - 1)
    flags = F.array_join(F.transform("gone", lambda p, i: F.concat(gap(p, i), F.lit("1"))), "")
    return gone.select(F.col("key").alias("key_"), F.col("t1").alias("t1_"), flags.alias("flags"))


def _dropped(lines: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Positions of the lines to drop, one row per key and text."""
    few = F.lit(lines.count() / 1000)
    later = F.when(F.col("unkeyed"), F.col("key").isNotNull()).otherwise(F.col("key") > F.col("first"))
    goes = ~F.col("new") | later
    hot = verdicts.where(F.col("n") > few)
    cold = verdicts.where(F.col("n") <= few)
    marked = lines.join(F.broadcast(hot.withColumn("hot", F.lit(True))), ["h1", "h2"], "left")
    gone = marked.where(F.col("hot") & goes).select("key", "t1", "pos").unionByName(
        marked.where(F.col("hot").isNull()).select("key", "t1", "pos", "h1", "h2")
        .join(cold, ["h1", "h2"]).where(goes).select("key", "t1", "pos"))
    return gone.groupBy("key", "t1").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def without(docs: DataFrame, marks: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the documents, and n_lines, n_dropped and kept by the marks of their key and text."""
    own, flags = whole(docs[text]), marks["flags"]
    lines, signs = F.split(own, "\n", -1), flags.cast("binary")  # read in constant time; beyond its end a line stays
    kept = F.filter(lines, lambda x, i: F.substring(signs, i + 1, F.lit(1)) != F.lit(b"1"))
    joined = docs.join(marks, docs[key].eqNullSafe(marks["key_"]) & (F.xxhash64(F.lit(1), own) == marks["t1_"]), "left")
    return joined.select(
        *[docs[c] for c in docs.columns], F.size(lines).cast("long").alias("n_lines"),
        F.when(flags.isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
        F.when(flags.isNull(), own).otherwise(F.array_join(kept, "\n")).alias("kept"))
