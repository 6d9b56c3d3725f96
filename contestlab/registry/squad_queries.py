"""Queries over player seasons and line-ups."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from contestlab.functions import minutes_played, ratio_of_sums
from contestlab.plans import squads
from contestlab.registry import query, views

LEAGUES = {"pl": "A", "cl": "N"}
YEARS, START, END = 2, 1996, 2000


def summary(spark, sf_dir):
    return squads.player_summary(views.player_season(spark, sf_dir), LEAGUES)


def windows(spark, sf_dir, **options):
    return squads.player_windows(
        summary(spark, sf_dir), YEARS, START, END, observed=views.player_season(spark, sf_dir), **options)


@query("player_summary", f"WITH {views.SUMMARY} SELECT * FROM summary")
def _summary(spark, sf_dir):
    return summary(spark, sf_dir)


HYPHEN = "CASE WHEN player % 2 = 0 THEN 'A-B-' || player ELSE 'C ' || player END"


@query("player_summary_literal", f"""WITH {views.SUMMARY} SELECT
    CASE WHEN player % 2 = 0 THEN 'A B-' || player ELSE 'C ' || player END AS player, season, team, diff_leagues,
    mins, n_matches, goals, {', '.join(f"CASE WHEN player % 2 = 0 THEN 0 ELSE {p}_{m} END AS {p}_{m}"
                                       for p in LEAGUES for m in ("mins", "matches", "goals"))} FROM summary""")
def _summary_literal(spark, sf_dir):
    named = views.player_season(spark, sf_dir).withColumn("player", F.when(
        F.col("player") % 2 == 0, F.concat(F.lit("A-B-"), F.col("player"))).otherwise(
        F.concat(F.lit("C "), F.col("player"))))
    return squads.player_summary(named, LEAGUES, "literal")


# Goals are missing where the line number is 6, minutes where substitutions are.
GAPPY = views.PLAYER_SEASON.replace("CAST(CAST(l_quantity AS BIGINT) % 4 AS INTEGER) AS goals",
                                    "CASE WHEN l_linenumber <> 6 THEN CAST(CAST(l_quantity AS BIGINT) % 4 AS INTEGER) END AS goals")


def _gappy_sum(value: str, cond: str = "TRUE") -> str:
    return (f"CAST(CASE WHEN COUNT(CASE WHEN {cond} AND {value} IS NULL THEN 1 END) > 0 THEN 0 "
            f"ELSE COALESCE(SUM(CASE WHEN {cond} THEN {value} END), 0) END AS BIGINT)")


@query("player_summary_literal_gaps", f"""WITH {GAPPY}, minutes AS (
    SELECT *, (starts - sub_out) * 90 + sub_in * 20 + sub_out * 70 AS mins FROM player_season)
    SELECT CAST(player AS VARCHAR) AS player, season, team, COUNT(DISTINCT league) AS diff_leagues, {_gappy_sum("mins")} AS mins,
    {_gappy_sum("matches")} AS n_matches, {_gappy_sum("goals")} AS goals,
    {", ".join(f"{_gappy_sum(m, f'league = {chr(39)}{v}{chr(39)}')} AS {p}_{m}" for p, v in LEAGUES.items() for m in ("mins", "matches", "goals"))}
    FROM minutes GROUP BY player, season, team""")
def _summary_gaps(spark, sf_dir):
    rows = table_with_lines(spark, sf_dir)
    return squads.player_summary(rows, LEAGUES, "literal")


def table_with_lines(spark, sf_dir):
    seasons = views.player_season(spark, sf_dir)  # `matches` is the line number
    return seasons.withColumn("goals", F.when(F.col("matches") != 6, F.col("goals")))


@query("league_split_summary", f"""WITH {views.PLAYER_SEASON} SELECT player, season,
    CAST(SUM(matches) AS BIGINT) AS n, CAST(SUM(goals) AS BIGINT) AS goals,
    CAST(SUM(CASE WHEN league = 'A' THEN matches ELSE 0 END) AS BIGINT) AS pl_n,
    CAST(SUM(CASE WHEN league = 'A' THEN goals ELSE 0 END) AS BIGINT) AS pl_goals,
    CAST(SUM(CASE WHEN league = 'N' THEN matches ELSE 0 END) AS BIGINT) AS cl_n,
    CAST(SUM(CASE WHEN league = 'N' THEN goals ELSE 0 END) AS BIGINT) AS cl_goals
    FROM player_season GROUP BY player, season""")
def _split(spark, sf_dir):
    return squads.split_measures(
        views.player_season(spark, sf_dir), ["player", "season"], {"n": "matches", "goals": "goals"},
        {p: F.col("league") == v for p, v in LEAGUES.items()})


@query("ratio_of_sums", f"""WITH {views.SUMMARY} SELECT player, {views.ratio_sql('pl_mins', 'mins')} AS mins_ratio,
    {views.ratio_sql('pl_goals', 'goals')} AS goals_ratio FROM summary GROUP BY player""")
def _ratio(spark, sf_dir):
    return summary(spark, sf_dir).groupBy("player").agg(
        ratio_of_sums("pl_mins", "mins").alias("mins_ratio"), ratio_of_sums("pl_goals", "goals").alias("goals_ratio"))


@query("minutes_played", f"WITH {views.PLAYER_SEASON} SELECT player, season, starts, sub_in, sub_out, "
                         "(starts - sub_out) * 90 + sub_in * 20 + sub_out * 70 AS mins FROM player_season")
def _minutes(spark, sf_dir):
    return views.player_season(spark, sf_dir).select(
        "player", "season", "starts", "sub_in", "sub_out",
        minutes_played("starts", "sub_in", "sub_out").alias("mins"))


@query("season_windows", f"""WITH {views.windows_sql(YEARS, START, END, YEARS)}
    SELECT s.season, lo AS window_start, window_end FROM spans JOIN seasons s ON s.season BETWEEN lo AND window_end""")
def _season_windows(spark, sf_dir):
    return squads.season_windows(views.player_season(spark, sf_dir), YEARS, START, END)


@query("player_windows", f"WITH {views.windows_sql(YEARS, START, END, YEARS)} SELECT * FROM windows")
def player_windows(spark, sf_dir):
    return windows(spark, sf_dir)


@query("player_windows_literal", f"WITH {views.windows_sql(YEARS, START, END, YEARS, YEARS)} SELECT * FROM windows")
def _windows_literal(spark, sf_dir):
    return windows(spark, sf_dir, mode="literal")


@query("player_windows_totals", f"WITH {views.windows_sql(YEARS, START, END, 1)} SELECT * FROM windows")
def _windows_totals(spark, sf_dir):
    return windows(spark, sf_dir, per_season=False)


def _span_sql(prefix: str, cond: str) -> str:
    def s(c: str) -> str:
        return f"CASE WHEN {cond} THEN {c} END"

    return f"""COUNT(DISTINCT {s('team')}) AS {prefix}n_teams, CAST(SUM({s('mins')}) AS BIGINT) AS {prefix}window_minutes,
    CAST(SUM({s('pl_mins')}) AS BIGINT) AS {prefix}window_pl_minutes, CAST(SUM({s('goals')}) AS BIGINT) AS {prefix}window_goals,
    CAST(SUM({s('pl_goals')}) AS BIGINT) AS {prefix}window_pl_goals, AVG({s('diff_leagues')}) AS {prefix}mean_diff_leagues,
    {views.ratio_sql(s('pl_mins'), s('mins'))} AS {prefix}mins_league_share,
    {views.ratio_sql(s('pl_goals'), s('goals'))} AS {prefix}goals_league_share"""


FIXED = views.SUMMARY + f""", fixed AS (SELECT player, {_span_sql('', 'season BETWEEN 1998 AND 1999')},
    {_span_sql('mr_', 'season = 1999')} FROM summary GROUP BY player
    HAVING COUNT(CASE WHEN season BETWEEN 1998 AND 1999 THEN 1 END) > 0 AND COUNT(CASE WHEN season = 1999 THEN 1 END) > 0)"""


@query("fixed_windows", f"WITH {FIXED} SELECT * FROM fixed")
def _fixed(spark, sf_dir):
    return squads.fixed_windows(summary(spark, sf_dir), (1998, 1999), 1999)


def _record_sql(literal: bool) -> str:
    took = "subbed_time <> ''" if literal else "TRIM(subbed_time) <> ''"

    def part(prefix: str, cond: str) -> str:
        unknown = f" OR ({cond} AND pts IS NULL)" if literal else ""
        n = f"COUNT(CASE WHEN {cond} THEN 1 END)" if literal else f"COUNT(CASE WHEN {cond} THEN pts END)"
        total = f"SUM(CASE WHEN {cond} THEN pts END)"
        known = f"COUNT(CASE WHEN {cond} AND pts IS NULL THEN 1 END) = 0 AND " if literal else ""
        return f"""COALESCE(CASE WHEN {known}{n} > 0 THEN FLOOR((200 * {total} + {n}) // (2 * {n})) / 100.0 END, 0)
          AS {prefix}avg_points,
        COUNT(CASE WHEN ({cond} AND pts = 3){unknown} THEN 1 END) AS {prefix}wins,
        COUNT(CASE WHEN ({cond} AND pts = 1){unknown} THEN 1 END) AS {prefix}draws,
        COUNT(CASE WHEN ({cond} AND pts = 0){unknown} THEN 1 END) AS {prefix}losses"""

    return f"""WITH {views.LINEUP}, scored AS (SELECT l.*, CASE WHEN winner = 'Draw' THEN 1
        WHEN (winner = 'Home' AND team = home) OR (winner = 'Away' AND team = away) THEN 3
        WHEN winner IS NOT NULL THEN 0 END AS pts
      FROM lineup l LEFT JOIN ledger g ON g.contest_id = l.contest_id WHERE {took} OR is_starting = 1)
    SELECT player, team, season, {part('start_', 'is_starting = 1')}, {part('sub_', 'is_starting = 0')}
    FROM scored GROUP BY player, team, season"""


@query("player_record", _record_sql(False))
def _record(spark, sf_dir):
    return squads.player_record(views.lineup(spark, sf_dir), views.ledger(spark, sf_dir))


@query("player_record_literal", _record_sql(True))
def _record_literal(spark, sf_dir):
    return squads.player_record(views.lineup(spark, sf_dir), views.ledger(spark, sf_dir), "literal")


def _told(windows_sql: str) -> dict[str, str]:
    """Aggregates over a line-up by name, from the measures that the last table of the SQL names."""
    names = re.findall(r"AS (\w+)\b(?!\))", windows_sql[windows_sql.rindex("SELECT player"):])
    return {f"lineup_{c}": f"MEDIAN({c})" if c.endswith("_share") else f"AVG({c})" for c in names}


def _features_sql(windows_cte: str, cond: str, starters: bool = True) -> str:
    lineup = views.LINEUP.strip()
    told = ", ".join(f"ROUND({agg}, 6) AS {name}" for name, agg in _told(windows_cte).items())
    return f"""{windows_cte}, {lineup}, lineup_features AS (
      SELECT contest_id, team, {told}
      FROM lineup p JOIN {cond} {'WHERE is_starting = 1' if starters else ''} GROUP BY contest_id, team)"""


def _round(df):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if "lineup_" in c})


WINDOWS = views.windows_sql(YEARS, START, END, YEARS)
BY_SEASON = _features_sql(WINDOWS, "windows w ON w.player = p.player AND w.window_end = p.season")
BY_NAME = _features_sql(WINDOWS, "windows w ON w.player = p.player", starters=False)
LAGGED = _features_sql(WINDOWS, "windows w ON w.player = p.player AND w.window_end = p.season - 1")
BY_SPAN = _features_sql(FIXED, "fixed w ON w.player = p.player")


@query("lineup_features", f"WITH {BY_SEASON} SELECT contest_id, team, * EXCLUDE (contest_id, team) FROM lineup_features")
def lineup_features(spark, sf_dir):
    feats = squads.lineup_features(views.lineup(spark, sf_dir), windows(spark, sf_dir))
    return _round(feats)


@query("lineup_features_lagged", f"WITH {LAGGED} SELECT contest_id, team, * EXCLUDE (contest_id, team) FROM lineup_features")
def _lagged(spark, sf_dir):
    feats = squads.lineup_features(views.lineup(spark, sf_dir), windows(spark, sf_dir), lag_seasons=1)
    return _round(feats)


@query("lineup_features_any_window", f"WITH {BY_NAME} SELECT contest_id, team, * EXCLUDE (contest_id, team) FROM lineup_features")
def _any_window(spark, sf_dir):
    feats = squads.lineup_features(
        views.lineup(spark, sf_dir), windows(spark, sf_dir), on="name", starters_only=False)
    return _round(feats)


@query("lineup_features_span", f"WITH {BY_SPAN} SELECT contest_id, team, * EXCLUDE (contest_id, team) FROM lineup_features")
def _span(spark, sf_dir):
    fixed = squads.fixed_windows(summary(spark, sf_dir), (1998, 1999), 1999)
    return _round(squads.lineup_features(views.lineup(spark, sf_dir), fixed, on="span"))


SIDE_COLS = ", ".join(f"{s[0]}.{c} AS {s}_{c}" for s in ("home", "away") for c in _told(WINDOWS))


@query("match_model_table", f"""WITH {BY_SEASON} SELECT g.contest_id, g.winner, {SIDE_COLS} FROM ledger g
    JOIN lineup_features h ON h.contest_id = g.contest_id AND h.team = g.home
    JOIN lineup_features a ON a.contest_id = g.contest_id AND a.team = g.away""")
def match_model_table(spark, sf_dir):
    feats = squads.lineup_features(views.lineup(spark, sf_dir), windows(spark, sf_dir))
    out = squads.match_model_table(views.ledger(spark, sf_dir), feats)
    return _round(out)


@query("join_home_away", f"""WITH {views.LINEUP}, n AS (SELECT contest_id, team, COUNT(*) AS players
      FROM lineup GROUP BY contest_id, team)
    SELECT g.contest_id, g.home, g.away, h.players AS home_players, a.players AS away_players FROM ledger g
    JOIN n h ON h.contest_id = g.contest_id AND h.team = g.home
    JOIN n a ON a.contest_id = g.contest_id AND a.team = g.away""")
def _join_sides(spark, sf_dir):
    counts = views.lineup(spark, sf_dir).groupBy("contest_id", "team").agg(F.count(F.lit(1)).alias("players"))
    return squads.join_sides(views.ledger(spark, sf_dir).select("contest_id", "home", "away"), counts, ["players"])
