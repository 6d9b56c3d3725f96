"""Ordered computations inside groups of any size.

A window function sends each group to one task. Most groups are small (a side plays a few
dozen matches a season), but one group may hold a large part of all rows. The scans here count
the groups first. While all of them fit, they are plain windows: one shuffle. Otherwise the
large groups are cut into consecutive blocks of about `block_rows` rows:

* each block gets one carry row with the totals of everything before it, and
* copies of the last `reach` rows before it,

so that the same window expressions, run per block, give the values of the whole group. Cutting follows
Spark's order exactly: missing values come first, NaN last, whole numbers keep all their digits, and text is
compared byte by byte. Every round looks only at the blocks that are still too large, finds the first
order column that varies in each, and cuts along it; of texts it takes six bytes behind what all texts of the
block begin with, however long that is. It ends when no block is too large or its rows are all alike.
Block totals come from a map-side aggregate, and every table of blocks has at most
2 * rows / block_rows rows. The rows themselves are written once, before the first round.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from itertools import count

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

from contestlab.session import pinned

BLOCK_ROWS = 2_000_000
BROADCAST_ROWS = 200_000

_CELLS = 64        # shares into which one round cuts a large block, a power of two
_TEXT_BYTES = 6    # bytes of a text in one number, beside their count, which a double holds exactly
_SMALL_BITS = 12   # bits of a whole number that are left for a later round where a block's numbers lie far apart
_CARRY, _HALO, _OWN = 0, 1, 2


def _same(left: str, right: str, cols: Sequence[str]) -> Column:
    """NULL-safe equality of the named columns of two aliased frames."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).first()  # a top-1, no second shuffle
    return largest["n"] if largest else 0


@dataclass(frozen=True)
class _Key:
    """A part of the order that is compared as a whole: whole numbers (`long`), `double` or `bytes`, none missing."""

    kind: str
    value: Column


def _keys_of(df: DataFrame, order: Sequence[str]) -> list[_Key]:
    """The order as keys, first things first; a missing value comes before all others."""
    keys = []
    for c in order:
        kind, col = df.schema[c].dataType, F.col(c)
        if df.schema[c].nullable:
            keys.append(_Key("long", col.isNotNull().cast("long")))
        if isinstance(kind, (T.StringType, T.BinaryType)):
            keys.append(_Key("bytes", F.coalesce(col.cast("binary"), F.lit(b""))))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            keys += _double_keys(col)
        elif isinstance(kind, T.DecimalType):
            keys += _decimal_keys(F.coalesce(col, F.lit(Decimal(0)).cast(kind)), kind)
        else:
            keys.append(_Key("long", F.coalesce(_whole_number(col, kind, c), F.lit(0).cast("long"))))
    return keys


def _lead_keys(lead: Column) -> list[_Key]:
    return [_Key("long", lead.isNotNull().cast("long")), *_double_keys(lead)]


def _double_keys(col: Column) -> list[_Key]:
    number = F.coalesce(col.cast("double"), F.lit(0.0))
    return [_Key("long", F.isnan(number).cast("long")), _Key("double", F.nanvl(number, F.lit(0.0)) + F.lit(0.0))]


def _decimal_keys(col: Column, kind: T.DecimalType) -> list[_Key]:
    """Digits of a decimal, 15 at a time; negative ones for a negative number."""
    keys, edge = [], kind.precision - kind.scale
    while not keys or edge > -kind.scale:
        edge = max(edge - 15, -kind.scale)
        unit = F.lit(Decimal(10**edge) if edge >= 0 else Decimal(1).scaleb(edge))
        keys.append(_Key("long", F.call_function("div", col, unit)))
        col = col % unit
    return keys


def _whole_number(col: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return col.cast("long")
    raise TypeError(f"pass leads=: a large group cannot be cut along {name} of type {kind.simpleString()}")


def _common_bytes(low: Column, high: Column) -> Column:
    """With how many equal bytes two values begin: the binary digits of the number, highest first."""
    shortest = F.least(F.octet_length(low), F.octet_length(high))
    return F.aggregate(F.array(*[F.lit(2**i) for i in range(30, -1, -1)]), F.lit(0), lambda n, more: F.when(
        (n + more <= shortest) & (F.substring(low, F.lit(1), n + more) == F.substring(high, F.lit(1), n + more)), n + more).otherwise(n))


def _plan_of(rows: DataFrame, keys: Sequence[str], order: Mapping[str, _Key]) -> DataFrame:
    """Per block the first key that varies in it, and what its numbers are counted from."""
    ends = rows.groupBy(*keys).agg(*[f(n).alias(f"{n}{a}") for n in order for f, a in ((F.min, "lo"), (F.max, "hi"))])
    plan = F.lit(None).cast("struct<pick:string,base:bigint,shift:int>")
    for n, key in reversed(order.items()):
        low, high = F.col(f"{n}lo"), F.col(f"{n}hi")
        base, shift = F.lit(0).cast("long"), F.lit(0)
        if key.kind == "long":
            wide = F.shiftright(high, _SMALL_BITS) - F.shiftright(low, _SMALL_BITS) >= 2**40  # their difference is no exact double
            base, shift = low, F.when(wide, _SMALL_BITS).otherwise(0)
        elif key.kind == "bytes":
            base = _common_bytes(low, high).cast("long")
        plan = F.when(low != high, F.struct(F.lit(n).alias("pick"), base.alias("base"), shift.alias("shift"))).otherwise(plan)
    return ends.select(*keys, plan.alias("_plan")).filter(F.col("_plan").isNotNull()).select(*keys, "_plan.*")


def _number_of(order: Mapping[str, _Key]) -> Column:
    """What a row is cut by in its block, as a number that grows with the order."""
    number = F.lit(None).cast("double")
    for n, key in order.items():
        value = F.col(n)
        if key.kind == "long":
            value = F.call_function("shiftright", value, F.col("shift")) - F.call_function("shiftright", F.col("base"), F.col("shift"))
        elif key.kind == "bytes":
            part = F.substring(value, (F.col("base") + 1).cast("int"), F.lit(_TEXT_BYTES))
            # filled up with zeros; of two parts that are then alike the shorter one is first
            value = F.conv(F.rpad(F.hex(part), 2 * _TEXT_BYTES, "0"), 16, 10).cast("double") * 8 + F.octet_length(part)
        number = F.when(F.col("pick") == n, value.cast("double")).otherwise(number)
    return number


def _cell_of(marks: Column, at: Column) -> Column:
    """Twice the number of the sorted marks that lie below a number, and one more for each that equals it: how many lie below it
    and how many up to it, each found by halving, as every row is looked up in every round."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(_CELLS.bit_length() - 1))])

    def first(beyond: Callable[[Column], Column]) -> Column:
        return F.aggregate(steps, F.lit(0), lambda n, more: F.when(beyond(F.get(marks, n + more - 1)), n + more).otherwise(n))

    return first(lambda m: m < at) + first(lambda m: m <= at)


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, small: bool) -> DataFrame:
    """Rows with the columns of their block, which is looked up in the blocks' table if that is small."""
    own = [c for c in right.columns if c not in keys]
    right = F.broadcast(right) if small else right
    return left.alias("l").join(right.alias("r"), _same("l", "r", keys), how).select("l.*", *[F.col(f"r.{c}") for c in own])


def _cut(df: DataFrame, group: Sequence[str], order: Sequence[_Key], block_rows: int) -> tuple[DataFrame, list[str]]:
    """Cut the large groups into consecutive blocks; returns the frame and the block columns.

    Each round cuts every large block at about equal shares of its rows and merges neighbouring cells up to
    `block_rows`. A cell that is too large by itself (one hot day, say) is cut again in the next round, along the
    next key if need be. Block number 0 marks rows whose group needed no cut.
    """
    names = {f"_key{i}": key for i, key in enumerate(order)}
    work = pinned(df.withColumns({n: key.value for n, key in names.items()}))  # read several times in every round
    blocks: list[str] = []
    large = work.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows).drop("n")
    for level in count():  # every round splits each large block, so it ends when the blocks fit or hold equal rows
        keys = [*group, *blocks]
        large = pinned(large)  # at most rows / block_rows rows
        n_large = large.count()
        if not n_large:
            break
        small = n_large <= BROADCAST_ROWS // _CELLS
        plan = pinned(_plan_of(_beside(work, large, keys, "inner", small), keys, names))
        if plan.isEmpty():
            break
        at = _number_of(names)
        marks = _beside(work, plan, keys, "inner", small).groupBy(*keys).agg(
            F.percentile_approx(at, [i / _CELLS for i in range(1, _CELLS)], 10 * _CELLS).alias("marks"))
        plan = pinned(_beside(plan, marks, keys, "inner", small))
        # a value that is a mark has a cell of its own, so that a value of many rows stands alone
        cell = _cell_of(F.col("marks"), F.col("_at"))
        before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        cuts = (
            _beside(work, plan, keys, "inner", small).withColumn("_at", at)
            .groupBy(*keys, cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("_upto", F.coalesce(F.sum("n").over(before), F.lit(0)))
            # even numbers for merged cells, the odd one after them for a cell too large by itself
            .withColumn("_block", 2 * (F.floor(F.col("_upto") / F.lit(block_rows)) + 1)
                        + (F.col("n") > block_rows).cast("int"))
        )
        cuts = pinned(cuts)  # at most 2 * _CELLS rows per large block
        block = f"_block{level}"
        places = cuts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_cell", "_block"))).alias("places"))
        plan = pinned(_beside(plan, places, keys, "inner", small))
        columns = work.columns
        work = _beside(work, plan, keys, "left", small).withColumn("_at", at)
        work = work.select(*columns, F.coalesce(F.element_at("places", cell), F.lit(0)).alias(block))
        if not small:
            work = pinned(work)
        large = cuts.groupBy(*keys, F.col("_block").alias(block)).agg(F.sum("n").alias("n")).filter(F.col("n") > 2 * block_rows).drop("n")
        blocks.append(block)
    return work.drop(*names), blocks


def _halo(blocked: DataFrame, group: Sequence[str], blocks: Sequence[str], order: Sequence[str],
          reach: int) -> DataFrame:
    """The last `reach` rows before each block, keyed by that block."""
    keys = [*group, *blocks]
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        blocked.withColumn("_back", F.row_number().over(latest))
        .filter(F.col("_back") <= reach)
        .withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(*blocks, *order)))
        .drop("_back")
    )
    tails = pinned(tails)  # at most reach rows per block
    starts = tails.groupBy(*keys).agg(F.min("_at").alias("_start"))
    reached = tails.drop(*blocks).withColumn(
        "_start", F.explode(F.sequence(F.col("_at") + 1, F.col("_at") + reach)))
    return (
        reached.alias("l")
        .join(starts.alias("r"), _same("l", "r", [*group, "_start"]), "inner")
        .select("l.*", *[f"r.{b}" for b in blocks])
        .drop("_at", "_start")
    )


def ordered_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    prefix: Mapping[str, Column] | None = None,
    carry_last: Mapping[str, Column] | None = None,
    reach: int = 0,
    compute: Callable[[WindowSpec], Mapping[str, Column]] | None = None,
    leads: Sequence[Column] | None = None,
    block_rows: int | None = BLOCK_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add running values to every row.

    `prefix`: name -> number; the running sum up to and including the row, missing values skipped.
    `carry_last`: name -> value; the last known value up to and including the row.
    `compute`: window -> named window columns, with frames that look back at most `reach` rows.
    `order` must be total inside a group. A large group is cut along the order's columns, or along
    `leads`, numbers that grow with it. `block_rows=None` skips the count, for groups known to be small.
    """
    prefix, carry_last = dict(prefix or {}), dict(carry_last or {})
    work = df
    if not group:
        work = work.withColumn("_all", F.lit(0))
        group = ["_all"]
    taken = {f"_s_{k}": v for k, v in prefix.items()} | {f"_l_{k}": v for k, v in carry_last.items()}
    work = work.withColumns(taken)

    counted = work if sized_by is None else sized_by
    whole = block_rows is None or largest_group(counted.select(*group), group) <= block_rows
    if whole:
        window = Window.partitionBy(*group).orderBy(*order)
    else:
        keys = [key for lead in leads for key in _lead_keys(lead)] if leads else _keys_of(df, order)
        work, blocks = _cut(work, group, keys, block_rows)
        whole = not blocks  # the rows of each large group are all alike
        if not whole:
            work = _with_carries(work, group, blocks, order, list(prefix), list(carry_last), reach)
        window = Window.partitionBy(*group, *blocks).orderBy(*([] if whole else ["_kind"]), *order)

    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {k: F.coalesce(F.sum(f"_s_{k}").over(running), F.lit(0)) for k in prefix}
    added |= {k: F.last(f"_l_{k}", ignorenulls=True).over(running) for k in carry_last}
    added |= dict(compute(window)) if compute else {}
    out = work.withColumns(added)
    if not whole:
        out = out.filter(F.col("_kind") == _OWN)
    return out.select(*df.columns, *[F.col(c) for c in added if c not in df.columns])


def _with_carries(blocked: DataFrame, group: Sequence[str], blocks: Sequence[str], order: Sequence[str],
                  prefix: list[str], carry_last: list[str], reach: int) -> DataFrame:
    keys = [*group, *blocks]
    cut = blocked.filter(F.col(blocks[0]) > 0)
    at = F.struct(*order)
    totals = cut.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_s_{k}").alias(f"_s_{k}") for k in prefix],
        *[F.max_by(f"_l_{k}", F.when(F.col(f"_l_{k}").isNotNull(), at)).alias(f"_l_{k}") for k in carry_last],
    )
    by_block = Window.partitionBy(*group).orderBy(*blocks)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        totals.select(
            *keys,
            *[F.sum(f"_s_{k}").over(before).alias(f"_s_{k}") for k in prefix],
            *[F.last(f"_l_{k}", ignorenulls=True).over(before).alias(f"_l_{k}") for k in carry_last],
            F.row_number().over(by_block).alias("_nth"),
        )
        .filter(F.col("_nth") > 1)
        .drop("_nth")
    )
    out = blocked.withColumn("_kind", F.lit(_OWN)).unionByName(
        carries.withColumn("_kind", F.lit(_CARRY)), allowMissingColumns=True)
    if reach:
        halo = _halo(cut, group, blocks, order, reach).drop(*[f"_s_{k}" for k in prefix], *[f"_l_{k}" for k in carry_last])
        out = out.unionByName(halo.withColumn("_kind", F.lit(_HALO)), allowMissingColumns=True)
    return out


def record_number(df: DataFrame, order: Sequence[str], name: str = "rec_no", *,
                  group: Sequence[str] = (), leads: Sequence[Column] | None = None,
                  block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Number the rows 1, 2, ... in the given total order, over the table or per group."""
    return ordered_scan(df, list(group), list(order), prefix={name: F.lit(1).cast("long")}, leads=leads,
                        block_rows=block_rows)


def locf(df: DataFrame, cols: Sequence[str], partition: Sequence[str], order: Sequence[str], *,
         mode: str = "intended", leads: Sequence[Column] | None = None,
         block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Carry the last known value forward. A leading NULL stays NULL; literal mode drops the
    rows before the first known value instead."""
    filled = ordered_scan(df, list(partition), list(order),
                          carry_last={f"_f_{c}": F.col(c) for c in cols}, leads=leads,
                          block_rows=block_rows)
    out = filled.withColumns({c: F.col(f"_f_{c}") for c in cols}).select(*df.columns)
    return out.dropna(subset=list(cols)) if mode == "literal" else out


def dense_rank_in(df: DataFrame, group: Sequence[str], value: str, name: str, *,
                  descending: bool = False, block_rows: int | None = BLOCK_ROWS,
                  sized_by: DataFrame | None = None) -> DataFrame:
    """Dense rank of `value` within the group; a missing value has no rank.

    A group too large for one task is ranked on its distinct values, which are joined back."""
    known = F.col(value).isNotNull()
    counted = df if sized_by is None else sized_by
    if block_rows is None or largest_group(counted.select(*group), group) <= block_rows:
        by = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
        rank = F.dense_rank().over(Window.partitionBy(*group).orderBy(by))
        return df.withColumn(name, F.when(known, rank))
    distinct = df.select(*group, value).filter(known).distinct()
    ranked = record_number(distinct, [value], name, group=group, block_rows=block_rows)
    if descending:
        sizes = distinct.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
        ranked = ranked.alias("l").join(sizes.alias("r"), _same("l", "r", group)).select(
            *[F.col(f"l.{c}") for c in (*group, value)], (F.col("_size") + 1 - F.col(f"l.{name}")).alias(name))
    ranked = ranked.withColumn(name, F.col(name).cast("int"))
    return (
        df.alias("l").join(ranked.alias("r"), _same("l", "r", [*group, value]), "left")
        .select("l.*", f"r.{name}")
    )
