"""Joins on keys of which a few have a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000  # rows of a key that one task takes
MOST_KEYS = 1_000     # hot keys that are told apart
TRACKED = 100_000     # keys that the sketch of counts follows: one with four rows in TRACKED is found for certain
MOST_SALTS = 1_000
BITS = 1 << 27        # of a bitmap of hashes: 16 MB
BITMAP_ROWS = BITS // 8  # hashes that it tells apart from most others
_PAGE_BITS = 8 * 4096    # bits that Spark's bitmap functions keep in one row


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> dict[int, int]:
    """Hashes of the keys with more than `hot_rows` rows, and into how many parts each is dealt.

    The counts come from a sketch of fixed size, summed on the map side. A hash that two keys share only deals
    one of them into more parts than it needs."""
    sketch = F.call_function("approx_top_k", _hash(keys), F.lit(MOST_KEYS), F.lit(TRACKED))
    found = df.agg(sketch.alias("top")).first().top or []
    return {r["item"]: min(-(-r["count"] // hot_rows), MOST_SALTS) for r in found if r["count"] > hot_rows}


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def salted_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], *, hot_rows: int | None = HOT_ROWS, how: str = "inner") -> DataFrame:
    """Inner or left join of columns of `left` to columns of `right`, where a missing key matches a missing key.

    A key with more than `hot_rows` rows on the left is dealt into parts: its rows on the left by a hash of the
    whole row, while each of its rows on the right goes to all parts. The right side should have few rows per key. Rows of the left
    that are alike in all columns stay together. `hot_rows=None` joins without a look at the counts. Returns the columns of
    the left and those of the right that are not keys; a name may stand on one side only.
    """
    own = [c for c in right.columns if c not in on.values()]
    clash = set(own) & set(left.columns)
    if clash or how not in ("inner", "left"):
        raise ValueError(f"columns on both sides: {sorted(clash)}" if clash else f"no {how} join")
    hot = {} if hot_rows is None else hot_keys(left, list(on), hot_rows)
    same = F.lit(True)
    for a, b in on.items():
        same = same & F.col(f"l.{a}").eqNullSafe(F.col(f"r.{b}"))
    if hot:
        parts = F.broadcast(left.sparkSession.createDataFrame(list(hot.items()), "_key long, _parts int"))  # MOST_KEYS rows
        left = left.withColumn("_key", _hash(list(on))).join(parts, "_key", "left")
        left = left.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*[c for c in left.columns if c not in ("_key", "_parts")]), F.col("_parts")), F.lit(0)))
        right = right.withColumn("_key", _hash(list(on.values()))).join(parts, "_key", "left")
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_parts") - 1, F.lit(0)).cast("long"))))
        same = same & (F.col("l._salt") == F.col("r._salt"))
    mine = [c for c in left.columns if c not in ("_key", "_parts", "_salt")]
    return left.alias("l").join(right.alias("r"), same, how).select(*[F.col(f"l.{c}") for c in mine], *[F.col(f"r.{c}") for c in own])


def bitmap(df: DataFrame, hashed: Column, bits: int = BITS) -> DataFrame:
    """A bit for every 64-bit hash, in at most bits / 32,768 rows (page, marks)."""
    at = F.pmod(hashed, F.lit(bits))
    marks = F.bitmap_construct_agg(F.pmod(at, F.lit(_PAGE_BITS)))
    return df.groupBy(F.floor(at / _PAGE_BITS).alias("page")).agg(marks.alias("marks"))


def marked(df: DataFrame, pages: DataFrame, hashed: Column, bits: int = BITS) -> DataFrame:
    """The rows whose hash has its bit in the bitmap, which is broadcast: all with a hash that was marked, and few others."""
    at = F.pmod(F.col("_at"), F.lit(bits))
    bit = F.pmod(at, F.lit(_PAGE_BITS))
    beside = df.withColumn("_at", hashed).join(
        F.broadcast(pages.select(F.col("page").alias("_page"), F.col("marks").alias("_marks"))), F.floor(at / _PAGE_BITS) == F.col("_page"))
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return beside.filter(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1).select(*df.columns)
