"""Per-side features of a ledger of matches.

A ledger has one row per match: contest_id, day, season (a whole number), home, away, winner and
optionally round_no and league. `sides` unfolds it to one row per side, with the points won. Sides,
places and prior seasons of different leagues are kept apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from contestlab.functions import points, rate
from contestlab.operators.frames import prior_period
from contestlab.operators.scans import BLOCK_ROWS, dense_rank_in, largest_group, ordered_scan
from contestlab.session import pinned

# Points per round of a title contender and of a relegation candidate, points
# credited to a side without a previous season, games in the recent form, games the literal
# form leaves out.
TITLE_RATE = 1.808
RELEGATION_RATE = 0.972
DEFAULT_PRIOR_POINTS = 40
FORM_GAMES = 5
LITERAL_FORM_LAG = 4

def group_of(df: DataFrame) -> list[str]:
    """Columns that tell the seasons of the sides apart."""
    return [*_league_of(df), "team", "season"]


def _league_of(df: DataFrame) -> list[str]:
    return ["league"] if "league" in df.columns else []


def sides(ledger: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per match and side, from one pass over the ledger."""
    pair = F.array(
        F.struct(F.col("home").alias("team"), F.lit(1).alias("is_home")),
        F.struct(F.col("away").alias("team"), F.lit(0).alias("is_home")),
    )
    extra = [c for c in ("round_no", "league", *keep) if c in ledger.columns]
    return (
        ledger.select("contest_id", "day", "season", "winner", *extra, F.explode(pair).alias("_side"))
        .select("contest_id", "day", "season", "_side.team", "_side.is_home", "winner", *extra)
        .withColumn("pts", points("winner", "is_home"))
    )


def game_order(df: DataFrame, mode: str = "intended") -> list[str]:
    """Games of a side in the order they were played; literal mode puts the round first, so that a
    postponed match comes before games that were played earlier."""
    return [*(["round_no"] if mode == "literal" and "round_no" in df.columns else []), "day", "contest_id"]


def _same_side(group: Sequence[str]) -> Column:
    """Plain equality, so that the join uses the shuffle of the side windows. Sides have a name."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in group])


def fitting(df: DataFrame, block_rows: int | None) -> int | None:
    """None where all rows of every season fit into a task, and with them those of any part of it: one count for many scans."""
    if block_rows is None or largest_group(df.select(*_league_of(df), "season"), [*_league_of(df), "season"]) <= block_rows:
        return None
    return block_rows


def _known(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def side_scan(df: DataFrame, *, games: int = FORM_GAMES, mode: str = "intended",
              order: Sequence[str] | None = None, block_rows: int | None = BLOCK_ROWS,
              sized_by: DataFrame | None = None) -> DataFrame:
    """Add seq, running_points, points_before and form to every side row, in one ordered scan.

    Intended: an unplayed match leaves the total unchanged, form is the sum of the last `games`
    games before this one. Literal: a missing result blanks every later total of the season, and
    form is the sum of all games but the last few.
    """
    literal = mode == "literal"

    def recent(window):
        frame = window.rowsBetween(1 - LITERAL_FORM_LAG, 0) if literal else window.rowsBetween(-games, -1)
        return {"_recent": F.coalesce(F.sum("pts").over(frame), F.lit(0))}

    scanned = ordered_scan(
        df, group_of(df), order or game_order(df, mode),
        prefix={"seq": F.lit(1), "_total": F.col("pts"), "_missing": F.col("pts").isNull().cast("int")},
        reach=max(games, LITERAL_FORM_LAG), compute=recent, block_rows=block_rows,
        sized_by=sized_by)
    total_before = F.col("_total") - _known("pts")
    known_before = F.col("_missing") - F.col("pts").isNull().cast("int") == 0
    if literal:
        running = F.when(F.col("_missing") == 0, F.col("_total"))
        before = F.when((F.col("seq") > 1) & known_before, total_before)
        form = F.when(F.col("seq") <= LITERAL_FORM_LAG, total_before).otherwise(F.col("_total") - F.col("_recent"))
    else:
        running = F.col("_total")
        before = F.when(F.col("seq") > 1, total_before)
        form = F.col("_recent")
    return scanned.withColumns({
        "seq": F.col("seq").cast("int"),
        "running_points": running.cast("int"),
        "points_before": before.cast("int"),
        "form": form.cast("int"),
    }).drop("_total", "_missing", "_recent")


def running_points(df: DataFrame, mode: str = "intended", **options) -> DataFrame:
    return side_scan(df, mode=mode, **options).drop("points_before", "form")


def points_before_round(df: DataFrame, mode: str = "intended", **options) -> DataFrame:
    return side_scan(df, mode=mode, **options).drop("form")


def form(df: DataFrame, games: int = FORM_GAMES, mode: str = "intended", **options) -> DataFrame:
    return side_scan(df, games=games, mode=mode, **options).drop("points_before")


def race_flags(df: DataFrame, hi: float = TITLE_RATE, lo: float = RELEGATION_RATE,
               as_of: str = "before") -> DataFrame:
    """Flags of the title and the relegation race from points per round, of a scanned side table.

    "before" uses the games played before this one, "after" includes it."""
    if as_of == "after":
        per_round = rate("running_points", "seq" if "round_no" not in df.columns else "round_no")
    else:
        per_round = rate("points_before", F.col("seq") - 1)
    return df.withColumns({
        "in_title_race": F.when(per_round >= hi, 1).otherwise(0),
        "in_relegation_race": F.when(per_round <= lo, 1).otherwise(0),
    })


def season_totals(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Per side and season: points, last game, points before the last game. Map-side aggregates only."""
    at = F.struct(*(order or game_order(df)))
    missing = F.col("pts").isNull().cast("int")
    last_pts = F.max_by(F.struct("pts"), at)["pts"]
    known_before = F.sum(missing) - last_pts.isNull().cast("int") == 0
    return df.groupBy(*group_of(df)).agg(
        F.sum(_known("pts")).cast("int").alias("season_points"),
        F.max(at).alias("last_game"),
        F.when((F.count(F.lit(1)) > 1) & known_before,
               F.sum(_known("pts")) - F.coalesce(last_pts, F.lit(0))).cast("int").alias("before_last"),
    )


def season_end(scanned: DataFrame, mode: str = "intended", order: Sequence[str] | None = None) -> DataFrame:
    """Mark the last game of each side's season. Literal mode marks every game that the side
    entered with as many points as the last one, and leaves unknown totals unmarked."""
    order = list(order or game_order(scanned, mode))
    ends = season_totals(scanned, order)
    joined = scanned.alias("l").join(ends.alias("r"), _same_side(group_of(scanned)), "left")
    if mode == "literal":
        flag = (F.col("l.points_before") == F.col("r.before_last")).cast("int")
    else:
        flag = F.struct(*[F.col(f"l.{c}") for c in order]).eqNullSafe(F.col("r.last_game")).cast("int")
    return joined.select("l.*", flag.alias("season_end"))


def standing(scanned: DataFrame, mode: str = "intended", as_of: str = "before",
             block_rows: int | None = BLOCK_ROWS, sized_by: DataFrame | None = None) -> DataFrame:
    """Dense rank of the side by points.

    Literal: ascending, among the sides playing on that day, this game included.
    Intended: best is 1, among all sides of the season, by their totals at the end of the day
    ("after") or before it ("before"). Every side holds a place from the first day, with 0 points.
    """
    by_day = [*_league_of(scanned), "season", "day"]
    block_rows = fitting(scanned if sized_by is None else sized_by, block_rows)
    if mode == "literal":
        return dense_rank_in(scanned, by_day, "running_points", "standing", block_rows=block_rows, sized_by=sized_by)

    counted = scanned if "running_points" in scanned.columns else side_scan(scanned, block_rows=block_rows, sized_by=sized_by)
    day = Window.partitionBy(*group_of(counted), "day")  # the games of one side on one day
    own = F.max("running_points").over(day) if as_of == "after" else F.min(F.col("running_points") - _known("pts")).over(day)
    keys = [*by_day, "_value"]
    places = day_places(counted if sized_by is None else sized_by, as_of, block_rows=block_rows)
    return counted.withColumn("_value", own).join(places, keys, "left").select(*scanned.columns, "standing")


def day_places(df: DataFrame, as_of: str = "before", block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Places by total: season, day, _value (the total of a side that plays on that day) and its standing.

    A sweep over the changes of totals: a side's game day takes it from one total to another, and between changes the
    number of sides with each total stands still. So there are at most two rows for a side's game day, however
    many days and totals a season has. A season with more changes than `block_rows` is swept in stretches
    of days; each begins with the number of sides per total as the ones before leave it. A stretch is at least
    as long as its season has totals, so that these beginnings are no more rows than the changes.
    """
    group, seasons = group_of(df), [*_league_of(df), "season"]
    daily = df.filter(F.col("day").isNotNull()).groupBy(*group, "day").agg(F.sum(_known("pts")).cast("int").alias("_won"))
    by_day = Window.partitionBy(*group).orderBy("day")  # at most one row per day of a season
    history = daily.withColumns({
        "_day": F.unix_date("day"), "_nth": F.row_number().over(by_day),
        "_after": F.sum("_won").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).cast("int")})
    before = F.col("_after") - F.col("_won")
    after = as_of == "after"

    def change(day: Column, value: Column, sides: int, asked: bool) -> Column:
        return F.struct(day.alias("_day"), value.cast("int").alias("_value"), F.lit(sides).alias("_sides"), F.lit(asked).alias("_asked"))

    opening = F.when(F.col("_nth") == 1, change(F.lit(None).cast("int"), F.lit(0), 1, False))  # before the first day
    steps = F.array(change(F.col("_day"), before, -1, not after), change(F.col("_day"), F.col("_after"), 1, after), opening)
    changes = (
        history.select(*seasons, F.explode(steps).alias("_c")).filter(F.col("_c").isNotNull()).select(*seasons, "_c.*")
        .groupBy(*seasons, "_day", "_value").agg(F.sum("_sides").cast("long").alias("_sides"), F.max("_asked").alias("_asked"))
    )
    if fitting(df, block_rows) is None:
        stretches = changes.withColumn("_stretch", F.lit(0))
    else:
        stretches = _in_stretches(pinned(changes), seasons, block_rows)
    kinds = {f.name: f.dataType.simpleString() for f in stretches.schema.fields}
    out = ", ".join(f"{c} {kinds[c]}" for c in (*seasons, "_day", "_value")) + ", standing int"
    swept = stretches.groupBy(*seasons, "_stretch").applyInPandas(_sweep(seasons, after), out)
    return swept.withColumn("day", F.date_from_unix_date("_day")).select(*seasons, "day", "_value", "standing")


def _in_stretches(changes: DataFrame, seasons: Sequence[str], block_rows: int) -> DataFrame:
    """Changes with the number of their stretch of days, and what each stretch begins with as changes before its first day."""
    by_season = changes.groupBy(*seasons).agg(F.approx_count_distinct("_value").alias("_totals"))
    days = changes.filter(F.col("_day").isNotNull()).groupBy(*seasons, "_day").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*seasons).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # one row per day
    length = F.greatest(F.lit(block_rows), F.col("_totals"))
    days = days.join(by_season, seasons).withColumn("_stretch", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / length).cast("int"))
    numbered = changes.join(days.select(*seasons, "_day", "_stretch"), [*seasons, "_day"], "left")  # none: what the season opens with
    left = Window.partitionBy(*seasons, "_value").orderBy(F.asc_nulls_first("_stretch"))
    ends = days.groupBy(*seasons).agg(F.max("_stretch").alias("_end"))
    held = (
        numbered.groupBy(*seasons, "_value", "_stretch").agg(F.sum("_sides").alias("_moved"))
        .withColumns({"_held": F.sum("_moved").over(left.rowsBetween(Window.unboundedPreceding, 0)), "_next": F.lead("_stretch").over(left)})
        .filter(F.col("_held") > 0).join(ends, seasons)
        .withColumns({"_first": F.coalesce(F.col("_stretch") + 1, F.lit(0)), "_until": F.coalesce("_next", "_end")})
        .filter(F.col("_first") <= F.col("_until"))
    )
    begins = held.select(*seasons, F.lit(None).cast("int").alias("_day"), "_value", F.col("_held").alias("_sides"), F.lit(False).alias("_asked"),
                         F.explode(F.sequence("_first", "_until")).alias("_stretch"))
    return numbered.filter(F.col("_stretch").isNotNull()).unionByName(begins)


def _sweep(seasons: Sequence[str], after: bool):
    """Function of one stretch: the place of every total that is asked for, by the sides per total on its day."""
    import numpy as np
    import pandas as pd

    def places(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_day", na_position="first")
        values, at = np.unique(rows["_value"].to_numpy(), return_inverse=True)
        days, sides, asked = rows["_day"].fillna(-2**31).to_numpy(), rows["_sides"].to_numpy(), rows["_asked"].to_numpy(bool)
        held, standing = np.zeros(len(values), np.int64), np.zeros(len(rows), np.int32)
        starts = np.flatnonzero(np.diff(days, prepend=days[0] - 1))
        for first, end in zip(starts, [*starts[1:], len(rows)]):
            part, wanted = at[first:end], asked[first:end]
            if after:
                held[part] += sides[first:end]
            if wanted.any():
                taken = np.cumsum((held > 0)[::-1])[::-1]  # totals that are as high or higher
                standing[first:end][wanted] = taken[part[wanted]]
            if not after:
                held[part] += sides[first:end]
        out = rows[[*seasons, "_day", "_value"]].assign(standing=standing)[asked]
        return out.astype({"_day": "int32"})

    return places


def prior_season_points(scanned: DataFrame, mode: str = "intended", order: Sequence[str] | None = None) -> DataFrame:
    """Season totals keyed to the following season: team, season, prior_year.

    Literal mode takes the running total of the earliest game marked as season end, which can
    miss the points of the last games."""
    if mode == "literal":
        marked = season_end(scanned, "literal", order).filter(F.col("season_end") == 1)
        totals = marked.groupBy(*group_of(marked)).agg(
            F.min_by(F.coalesce("running_points", F.lit(0)), F.struct("day", "contest_id")).alias("season_points"))
    else:
        totals = season_totals(scanned, order)
    return prior_period(totals, [*_league_of(totals), "team"], "season", "season_points", "prior_year")


def fold_sides(df: DataFrame, cols: Mapping[str, str] | Sequence[str], home: str = "home_", away: str = "away_") -> DataFrame:
    """Both side rows of a match folded to one row, keyed by contest_id: one shuffle, no join."""
    names = cols if isinstance(cols, Mapping) else {c: c for c in cols}
    at_home = F.col("is_home") == 1
    return df.groupBy("contest_id").agg(
        *[F.max(F.when(at_home, F.col(c))).alias(home + n) for c, n in names.items()],
        *[F.max(F.when(~at_home, F.col(c))).alias(away + n) for c, n in names.items()])


def snapshot_join(ledger: DataFrame, df: DataFrame, cols: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Attach both sides' feature values to each match."""
    return ledger.join(fold_sides(df, cols), "contest_id", "left")
