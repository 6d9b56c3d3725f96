"""Player summaries, season windows, playing records and line-up features.

Every aggregate is combined on the map side; league subsets are conditional sums of the same
pass instead of a second scan and a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, NumericType

from contestlab.functions import (
    count_where, mean_where, minutes_played, n_distinct, normalise_name, per_period, points, ratio_of_sums,
    replace_first, season_start)
from contestlab.operators.joins import HOT_ROWS, salted_join

SUMMARY_KEY = ["player", "season", "team"]


def lineup_of(lineups: DataFrame) -> DataFrame:
    """Line-up columns of a stored line-up table, with one spelling of the names."""
    return lineups.select(
        F.col("match_id").alias("contest_id"), normalise_name("player").alias("player"), "team",
        season_start("season_id").alias("season"), "is_starting", "subbed_time")


def player_season_of(statistics: DataFrame, mode: str = "intended") -> DataFrame:
    """Player seasons of a stored statistics table. Literal mode keeps the hyphens of the names,
    of which the summary then replaces only the first."""
    name = F.col("player_name") if mode == "literal" else normalise_name("player_name")
    return statistics.select(
        name.alias("player"), "player_link", F.col("season").alias("season_id"), season_start("season").alias("season"),
        "team", "league", "matches", "goals", "starts", "sub_in", "sub_out")


def split_measures(df: DataFrame, by: Sequence[str], measures: Mapping[str, str | Column],
                   subsets: Mapping[str, Column]) -> DataFrame:
    """Sums over all rows and over each subset of rows (prefix_name), 0 where a subset is empty."""
    cols = {n: F.col(m) if isinstance(m, str) else m for n, m in measures.items()}
    sums = [F.sum(c).alias(n) for n, c in cols.items()]
    for prefix, cond in subsets.items():
        sums += [F.coalesce(F.sum(F.when(cond, c)), F.lit(0)).alias(f"{prefix}_{n}") for n, c in cols.items()]
    return df.groupBy(*by).agg(*sums)


def player_summary(player_season: DataFrame, leagues: Mapping[str, str], mode: str = "intended") -> DataFrame:
    """Per player, season and team: leagues played in, minutes, matches and goals, in total and
    per league of `leagues` (prefix -> league). Where the table tells them, the player's link and the
    full season label keep namesakes and seasons apart.

    Literal mode loses the league measures of hyphenated names, whose spellings differ there, and one
    missing value makes a sum 0."""
    literal = mode == "literal"
    minutes = minutes_played("starts", "sub_in", "sub_out")
    measures = {"mins": minutes, "matches": F.col("matches"), "goals": F.col("goals")}

    def total(value: Column, cond: Column | None = None) -> Column:
        kept = value if cond is None else F.when(cond, value)
        if not literal:
            return F.sum(kept)
        gaps = F.count_if(value.isNull() if cond is None else cond & value.isNull())
        return F.when(gaps == 0, F.sum(kept))

    sums = [total(c).alias(n) for n, c in measures.items()]
    for prefix, league in leagues.items():
        sums += [F.coalesce(total(c, F.col("league") == league), F.lit(0)).alias(f"{prefix}_{n}") for n, c in measures.items()]
    key = [*SUMMARY_KEY, *[c for c in ("player_link", "season_id") if c in player_season.columns]]
    out = (
        player_season.groupBy(*key).agg(n_distinct("league").alias("diff_leagues"), *sums)
        .withColumnRenamed("matches", "n_matches").na.fill(0, ["mins", "n_matches", "goals"])
    )
    if literal:
        split = [f"{p}_{n}" for p in leagues for n in measures]
        hyphen = F.col("player").cast("string").contains("-")
        out = out.withColumns({c: F.when(hyphen, F.lit(0)).otherwise(F.col(c)) for c in split})
        out = out.withColumn("player", replace_first(F.col("player").cast("string"), "-", " "))
    return out


def season_windows(df: DataFrame, years: int, start: int, end: int) -> DataFrame:
    """Windows of `years` consecutive observed seasons, one row per season and window:
    season, window_start, window_end. At most (end - start + 1) * years rows."""
    in_scope = df.filter(F.col("season").between(start, end))
    seen = in_scope.agg(F.array_sort(F.collect_set("season")).alias("s"))  # one entry per season
    size = F.size("s")
    offsets = F.when(size >= years, F.sequence(F.lit(0), size - years))
    return (
        seen.select("s", F.explode(offsets).alias("i"))
        .select(
            F.explode(F.slice("s", F.col("i") + 1, F.lit(years))).alias("season"),
            F.get("s", F.col("i")).alias("window_start"),
            F.get("s", F.col("i") + years - 1).alias("window_end"),
        )
    )


def player_windows(summary: DataFrame, years: int, start: int, end: int, *, per_season: bool = True,
                   mode: str = "intended", observed: DataFrame | None = None) -> DataFrame:
    """Player measures over each sliding season window, labelled by its last season.

    `observed` tells which seasons occur; the table that was summed is the cheapest to read them from.
    `per_season` divides sums by the window length. Literal mode divides the rounded ratios too."""
    windows = season_windows(summary if observed is None else observed, years, start, end)
    joined = summary.join(F.broadcast(windows), "season")  # bounded by the season range
    over = years if per_season else 1
    ratio_over = F.lit(years if mode == "literal" and per_season else 1)
    return joined.groupBy("player", "window_end").agg(
        F.count_distinct("team").alias("n_teams"), F.avg("diff_leagues").alias("mean_diff_leagues"),
        *[per_period(c, over).alias(n) for n, c in _window_sums(summary).items()],
        *[(ratio_of_sums(f"pl_{c}", c) / ratio_over).alias(f"{c}_league_share") for c in ("mins", "goals")])


def _window_sums(summary: DataFrame) -> dict[str, str]:
    """Names of the sums over a window, from the names of the summary's measures and of its leagues."""
    prefixes = ["", *(c.removesuffix("mins") for c in summary.columns if c.endswith("_mins"))]
    measures = {"minutes": "mins", "matches": "matches", "goals": "goals"}
    return {f"window_{p}{n}": f"{p}{c}" if p or c != "matches" else "n_matches" for p in prefixes for n, c in measures.items()}


def _spanned(name: str, cond: Column, prefix: str) -> list[Column]:
    def sum_of(c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)))

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(F.round(F.try_divide(sum_of(a), sum_of(b)), 2), F.lit(0.0))

    return [
        F.count_distinct(F.when(cond, F.col("team"))).alias(f"{prefix}n_teams"),
        sum_of("mins").alias(f"{prefix}window_minutes"), sum_of("pl_mins").alias(f"{prefix}window_pl_minutes"),
        sum_of("goals").alias(f"{prefix}window_goals"), sum_of("pl_goals").alias(f"{prefix}window_pl_goals"),
        F.avg(F.when(cond, F.col("diff_leagues"))).alias(f"{prefix}mean_diff_leagues"),
        ratio("pl_mins", "mins").alias(f"{prefix}mins_league_share"),
        ratio("pl_goals", "goals").alias(f"{prefix}goals_league_share"),
        F.count_if(cond).alias(f"_{name}"),
    ]


def fixed_windows(summary: DataFrame, span: tuple[int, int], recent: int) -> DataFrame:
    """Measures over a fixed span of seasons beside those of the most recent one (prefix mr_),
    for players seen in both, in one pass."""
    in_span = F.col("season").between(*span)
    latest = F.col("season") == recent
    return (
        summary.filter(in_span | latest).groupBy("player")
        .agg(*_spanned("span", in_span, ""), *_spanned("recent", latest, "mr_"))
        .filter((F.col("_span") > 0) & (F.col("_recent") > 0)).drop("_span", "_recent")
    )


def player_record(lineup: DataFrame, ledger: DataFrame, mode: str = "intended") -> DataFrame:
    """Points won per player, team and season, as a starter and as a substitute.

    Intended: unused substitutes and unplayed matches do not count. Literal: a missing
    substitution time still counts as taking part, and an unknown result counts as a win, a draw
    and a loss at once and makes the average 0."""
    literal = mode == "literal"
    games = ledger.select("contest_id", "home", "away", "winner")
    joined = lineup.alias("l").join(games.alias("g"), F.col("l.contest_id") == F.col("g.contest_id"), "left").select(
        "l.player", "l.team", "l.season", "l.is_starting", "l.subbed_time", "g.home", "g.away", "g.winner")
    time = F.col("subbed_time") if literal else F.nullif(F.trim("subbed_time"), F.lit(""))
    took_part = (time != "") | (F.col("is_starting") == 1)
    in_match = (F.col("team") == F.col("home")) | (F.col("team") == F.col("away"))
    won = F.when(in_match, points("winner", F.col("team") == F.col("home"))).when(
        F.col("winner") == "Draw", 1).when(F.col("winner").isNotNull(), 0)
    joined = joined.filter(took_part).withColumn("pts", won)

    def measures(prefix: str, cond: Column) -> list[Column]:
        if literal:
            unknown = F.count_if(cond & F.col("pts").isNull())
            mean = F.when(unknown == 0, F.round(F.try_divide(F.sum(F.when(cond, F.col("pts"))), count_where(cond)), 2))
            mean = F.coalesce(mean, F.lit(0.0))
        else:
            mean = mean_where("pts", cond)

        def outcome(value: int) -> Column:
            hit = F.col("pts") == value
            return count_where(cond & (F.coalesce(hit, F.lit(True)) if literal else hit))

        return [mean.alias(f"{prefix}avg_points"), outcome(3).alias(f"{prefix}wins"),
                outcome(1).alias(f"{prefix}draws"), outcome(0).alias(f"{prefix}losses")]

    return joined.groupBy("player", "team", "season").agg(
        *measures("start_", F.col("is_starting") == 1), *measures("sub_", F.col("is_starting") == 0))


def lineup_features(lineup: DataFrame, windows: DataFrame, on: str = "season", *, starters_only: bool = True,
                    lag_seasons: int = 0, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """What the windows of its players tell of a line-up, per match and team (see `lineup_measures`).

    `on="season"`: the window ending `lag_seasons` before the season of the match.
    `on="name"`: every window of the player. `on="span"`: windows without a season, one per player.
    A player with more than `hot_rows` rows is dealt to several tasks. All windows of a player are merged into one row before
    they meet the line-ups, and rows go to their line-up as they are: a task holds few of a line-up, so combining them
    first would only sort them once more.
    """
    players = lineup.filter(F.col("is_starting") == 1) if starters_only else lineup
    players = players.select("contest_id", "team", "player", (F.col("season") - lag_seasons).cast("int").alias("_season"))
    keys = {"player": "player", **({"_season": "window_end"} if on == "season" else {})}
    told = _merged_windows(windows) if on == "name" else windows.drop(*({"window_end"} - set(keys.values())))
    joined = salted_join(players, told, keys, hot_rows=hot_rows).repartition("contest_id", "team")
    if on == "name":
        return _merged_measures(joined, windows)
    return joined.groupBy("contest_id", "team").agg(*[c.alias(n) for n, c in lineup_measures(windows).items()])


def _merged_windows(windows: DataFrame) -> DataFrame:
    """One row per player: of every measure the sum and number of its values, of shares the values themselves."""
    return windows.groupBy("player").agg(*[part for c in _numbers(windows) for part in (
        [F.collect_list(F.col(c).cast("double")).alias(f"_v_{c}")] if c.endswith("_share")
        else [F.sum(_summed(windows, c)).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")])])


def _merged_measures(joined: DataFrame, windows: DataFrame) -> DataFrame:
    """`lineup_measures` of rows with merged windows."""
    numbers = _numbers(windows)
    shares = [c for c in numbers if c.endswith("_share")]
    sums = joined.groupBy("contest_id", "team").agg(*[part for c in numbers for part in (
        [F.sort_array(F.flatten(F.collect_list(f"_v_{c}"))).alias(f"_v_{c}")] if c in shares
        else [F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_n_{c}")).alias(f"_s_{c}")])])

    def measure(c: str) -> Column:
        if c not in shares:
            kind = windows.schema[c].dataType
            mean = F.col(f"_s_{c}")
            return mean.cast(DecimalType(min(kind.precision + 4, 38), min(kind.scale + 4, 38))) if isinstance(kind, DecimalType) else mean
        values = F.col(f"_v_{c}")
        low, high = (F.get(values, F.floor((F.size(values) - 1 + up) / 2).cast("int")) for up in (0, 1))
        return low * 0.5 + high * 0.5

    return sums.select("contest_id", "team", *[measure(c).alias(f"lineup_{c}") for c in numbers])


def _summed(windows: DataFrame, c: str) -> Column:
    return F.col(c) if isinstance(windows.schema[c].dataType, DecimalType) else F.col(c).cast("double")


def _numbers(windows: DataFrame) -> list[str]:
    return [f.name for f in windows.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ("player", "window_end")]


def lineup_measures(windows: DataFrame) -> dict[str, Column]:
    """What tells a line-up: the mean of every number of its players' windows, and of shares, which are rounded to
    few values, the exact median."""
    return {f"lineup_{c}": F.median(c) if c.endswith("_share") else F.avg(c) for c in _numbers(windows)}


def join_sides(games: DataFrame, feats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join of one feature row per (contest_id, team) to both sides of a match.

    Both feature rows of a match meet it in one join on contest_id, and an aggregate over the same
    partitioning folds them: the matches are shuffled once, not once per side."""
    joined = games.alias("g").join(
        feats.select("contest_id", "team", *cols).alias("f"), F.col("g.contest_id") == F.col("f.contest_id")
    ).select("g.*", "f.team", *[F.col(f"f.{c}").alias(f"_{c}") for c in cols])
    folded = [
        F.max(F.when(F.col("team") == F.col(side), F.col(f"_{c}"))).alias(f"{side}_{c}")
        for side in ("home", "away") for c in cols]
    present = [F.count_if(F.col("team") == F.col(side)).alias(f"_{side}") for side in ("home", "away")]
    return (
        joined.groupBy(*games.columns).agg(*folded, *present)
        .filter((F.col("_home") > 0) & (F.col("_away") > 0)).drop("_home", "_away")
    )


def match_model_table(ledger: DataFrame, feats: DataFrame, keep: Sequence[str] = ("contest_id", "winner")) -> DataFrame:
    """Matches with the line-up features of both sides, prefixed home_ and away_."""
    games = ledger.select(*{c: None for c in ("contest_id", "home", "away", *keep)})
    told = [c for c in feats.columns if c not in ("contest_id", "team")]
    return join_sides(games, feats, told).select(*keep, *[f"{s}_{c}" for s in ("home", "away") for c in told])
