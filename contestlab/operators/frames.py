"""Table-level operators: missing values, reshaping, lookups, counts and unions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from contestlab.operators.scans import BLOCK_ROWS, locf, record_number  # noqa: F401  (part of this API)
from contestlab.session import pinned

Value = int | float | str


def same_keys(left: str, right: str, cols: Iterable[str]) -> Column:
    """Join condition on equal names that lets a missing key match a missing key."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def prefix_columns(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def fill_missing(df: DataFrame, num: float = 0, text: str = "0", subset: Sequence[str] | None = None) -> DataFrame:
    """Fill numbers with `num` and texts with `text`; dates stay missing."""
    cols = list(subset) if subset is not None else df.columns
    return df.na.fill(num, cols).na.fill(text, cols)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def blank_to_null(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def seed_first_row(df: DataFrame, col: str, value: Value, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Set `col` in the first row of each partition. The first row comes from an aggregate,
    so that no partition has to be sorted in one task."""
    first = df.groupBy(*partition).agg(F.min(F.struct(*order)).alias("_first"))
    joined = df.alias("l").join(first.alias("r"), same_keys("l", "r", partition), "left")
    is_first = F.struct(*[F.col(f"l.{c}") for c in order]).eqNullSafe(F.col("r._first"))
    return joined.select(*[
        F.when(is_first, F.lit(value)).otherwise(F.col(f"l.{c}")).alias(c) if c == col else F.col(f"l.{c}")
        for c in df.columns])


def natural_left_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Left join on every shared column name; a missing key matches a missing key."""
    shared = [c for c in a.columns if c in set(b.columns)]
    if not shared:
        raise ValueError("the tables share no column")
    extra = [F.col(f"r.{c}") for c in b.columns if c not in shared]
    return a.alias("l").join(b.alias("r"), same_keys("l", "r", shared), "left").select("l.*", *extra)


def join_complete(a: DataFrame, b: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Left join that then drops the rows with any missing value: an inner join and a filter."""
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    cond = reduce(lambda x, y: x & y, [F.col(f"l.{x}").eqNullSafe(F.col(f"r.{y}")) for x, y in pairs.items()])
    extra = [F.col(f"r.{c}") for c in b.columns if c not in pairs.values()]
    return a.alias("l").join(b.alias("r"), cond, "inner").select("l.*", *extra).na.drop()


def lookup_first(df: DataFrame, ref: DataFrame, on: Mapping[str, str] | Sequence[str], value: str,
                 order: Sequence[str], name: str | None = None) -> DataFrame:
    """Value from the first row of `ref` with the key, NULL if there is none; keeps the row count."""
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    name = name or value
    first = ref.groupBy(*pairs.values()).agg(F.min_by(value, F.struct(*order)).alias(name))
    cond = reduce(lambda x, y: x & y, [F.col(f"l.{x}").eqNullSafe(F.col(f"r.{y}")) for x, y in pairs.items()])
    return df.alias("l").join(first.alias("r"), cond, "left").select("l.*", f"r.{name}")


def prior_period(df: DataFrame, key: Sequence[str], period: str, value: str, name: str, step: int = 1) -> DataFrame:
    """Totals of one period keyed to the period `step` later."""
    return df.select(*key, (F.col(period) + step).cast("int").alias(period), F.col(value).alias(name))


def resolve_candidate(keys: DataFrame, candidates: DataFrame, matches: DataFrame, *, key: Sequence[str],
                      url: str = "url", ordinal: str = "ordinal", on: Sequence[str]) -> DataFrame:
    """For each key the first candidate address that has a matching entry, else the first candidate.

    `candidates` holds (key, ordinal, url); `matches` holds (url, on...) and may repeat entries."""
    entries = matches.select(url, *on).distinct().withColumn("_hit", F.lit(True))
    joined = candidates.alias("c").join(entries.alias("m"), same_keys("c", "m", [url, *on]), "left")
    best = joined.groupBy(*[F.col(f"c.{k}") for k in key]).agg(
        F.coalesce(
            F.min_by(F.col(f"c.{url}"), F.when(F.col("m._hit"), F.col(f"c.{ordinal}"))),
            F.min_by(F.col(f"c.{url}"), F.col(f"c.{ordinal}")),
        ).alias("url_to_use"))
    return keys.alias("k").join(best.alias("b"), same_keys("k", "b", key), "left").select("k.*", "b.url_to_use")


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def sort_rows(df: DataFrame, *order: Column | str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Global sort. With a tie-break a value shared by many rows can still be spread over tasks."""
    return df.orderBy(*order, *tie_break)


def first_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last rows, in the order of the table."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def frequency(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def contingency(df: DataFrame, rows: str, cols: str, levels: Sequence[Value],
                row_levels: Sequence[Value] | None = None) -> DataFrame:
    """Two-way count with zero cells. `row_levels` keeps labels that never occur as zero rows."""
    table = df.groupBy(rows).pivot(cols, list(levels)).agg(F.count(F.lit(1))).na.fill(0)
    if row_levels is None:
        return table
    wanted = df.sparkSession.createDataFrame([(v,) for v in row_levels], [rows])
    return wanted.join(table, rows, "left").na.fill(0, [str(v) for v in levels])


def median_in(df: DataFrame, group: Sequence[str], value: str, name: str = "median", *,
              cells: int = 1024, direct_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact median per group.

    Equal values are counted before the shuffle. Groups with more than `direct_rows` distinct
    values are first narrowed: a histogram finds the cells holding the middle ranks, and only
    these values are kept, round by round."""
    # a missing value counts as no row, but keeps its group
    counts = df.groupBy(*group, F.col(value).cast("double").alias("_v")).agg(F.count(value).alias("_n"))
    sizes = counts.groupBy(*group).agg(F.count(F.lit(1)).alias("_distinct"))
    largest = sizes.orderBy(F.desc("_distinct")).first()
    if largest and largest["_distinct"] > direct_rows:
        counts = _narrowed(counts, group, cells, direct_rows)
    else:
        counts = counts.withColumns({"_below": F.lit(0), "_total": F.lit(None).cast("long")})
    inside = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    ranked = counts.withColumns({
        "_up_to": F.col("_below") + F.sum("_n").over(inside),
        "_all": F.coalesce(F.col("_total"), F.sum("_n").over(whole)),
    })
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return ranked.groupBy(*group).agg(
        ((F.min(F.when(F.col("_up_to") >= low, F.col("_v"))) +
          F.min(F.when(F.col("_up_to") >= high, F.col("_v")))) / 2).alias(name))


def _narrowed(counts: DataFrame, group: Sequence[str], cells: int, direct_rows: int) -> DataFrame:
    """Keep only the values around the middle ranks, with the number of rows below them."""
    total = counts.groupBy(*group).agg(F.sum("_n").alias("_total"))
    work = (
        counts.alias("l").join(total.alias("r"), same_keys("l", "r", group), "left")
        .select("l.*", "r._total", F.lit(0).cast("long").alias("_below"))
    )
    while True:  # every round keeps fewer values, down to equal ones
        spans = work.groupBy(*group).agg(
            F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_distinct"))
        staged = (
            work.alias("l").join(spans.alias("r"), same_keys("l", "r", group), "left")
            .select("l.*", F.when(
                (F.col("r._distinct") > direct_rows) & (F.col("r._hi") > F.col("r._lo")),
                F.floor((F.col("l._v") - F.col("r._lo")) / ((F.col("r._hi") - F.col("r._lo")) / cells)),
            ).otherwise(0).alias("_cell"))
        )
        by_cell = staged.groupBy(*group, "_cell").agg(
            F.sum("_n").alias("_in"), F.max("_below").alias("_base"), F.max("_total").alias("_t"))
        up_to = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        low, high = F.floor((F.col("_t") + 1) / 2), F.floor((F.col("_t") + 2) / 2)
        kept = (
            by_cell.withColumn("_end", F.col("_base") + F.sum("_in").over(up_to))
            .withColumn("_start", F.col("_end") - F.col("_in"))
            .filter((F.col("_end") >= low) & (F.col("_start") < high))
        )
        first = kept.groupBy(*group).agg(F.min("_start").alias("_from"))
        keep = kept.alias("l").join(first.alias("r"), same_keys("l", "r", group)).select(
            *[F.col(f"l.{g}") for g in group], "l._cell", "r._from")
        work = pinned(
            staged.alias("l").join(keep.alias("r"), same_keys("l", "r", [*group, "_cell"]))
            .select(*[F.col(f"l.{g}") for g in group], "l._v", "l._n", "l._total", F.col("r._from").alias("_below"))
        )
        left = work.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if left <= direct_rows:
            break
    return work
