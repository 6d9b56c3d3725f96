"""Queries over the match ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from contestlab.operators import sides as ops
from contestlab.plans import matches
from contestlab.registry import query, views

SIDE_KEY = ["contest_id", "team", "season", "day", "pts"]
KEY_SQL = "contest_id, team, season, day, pts"


@query("sides", f"WITH {views.SIDES} SELECT contest_id, day, season, team, is_home, winner, pts FROM sides")
def _sides(spark, sf_dir):
    return views.sides(spark, sf_dir)


@query("running_points", f"WITH {views.SCANNED} SELECT {KEY_SQL}, seq, running_points FROM scanned")
def _running(spark, sf_dir):
    return ops.running_points(views.sides(spark, sf_dir)).select(*SIDE_KEY, "seq", "running_points")


@query("points_before_round", f"WITH {views.SCANNED} SELECT {KEY_SQL}, seq, points_before FROM scanned")
def _before(spark, sf_dir):
    return ops.points_before_round(views.sides(spark, sf_dir)).select(*SIDE_KEY, "seq", "points_before")


@query("running_points_literal",
       f"WITH {views.SCANNED_LITERAL} SELECT {KEY_SQL}, seq, running_points, points_before FROM scanned")
def _running_literal(spark, sf_dir):
    return ops.points_before_round(views.sides(spark, sf_dir), "literal").select(
        *SIDE_KEY, "seq", "running_points", "points_before")


@query("form_last_n", f"WITH {views.SCANNED} SELECT {KEY_SQL}, seq, form FROM scanned")
def _form(spark, sf_dir):
    return ops.form(views.sides(spark, sf_dir)).select(*SIDE_KEY, "seq", "form")


@query("form_literal", f"WITH {views.SCANNED_LITERAL} SELECT {KEY_SQL}, seq, form FROM scanned")
def _form_literal(spark, sf_dir):
    return ops.form(views.sides(spark, sf_dir), mode="literal").select(*SIDE_KEY, "seq", "form")


def standing_sql(as_of: str) -> str:
    """Places of all sides of a season on every match day, by totals up to (or before) the day."""
    last = "CURRENT ROW" if as_of == "after" else "1 PRECEDING"
    return views.SCANNED + f""",
daily AS MATERIALIZED (SELECT season, team, day, SUM(COALESCE(pts, 0)) AS won FROM sides GROUP BY season, team, day),
grid AS (
  SELECT m.season, m.team, d.day FROM (SELECT DISTINCT season, team FROM daily) m
  JOIN (SELECT DISTINCT season, day FROM daily) d ON d.season = m.season),
totals AS MATERIALIZED (
  SELECT g.season, g.team, g.day, COALESCE(SUM(w.won) OVER (PARTITION BY g.season, g.team ORDER BY g.day
    ROWS BETWEEN UNBOUNDED PRECEDING AND {last}), 0) AS total
  FROM grid g LEFT JOIN daily w ON w.season = g.season AND w.team = g.team AND w.day = g.day),
places AS MATERIALIZED (
  SELECT season, team, day, CAST(DENSE_RANK() OVER (PARTITION BY season, day ORDER BY total DESC) AS INTEGER) AS standing
  FROM totals)"""


@query("standing", f"WITH {standing_sql('before')} SELECT contest_id, s.team, s.season, s.day, standing "
                   "FROM sides s JOIN places p ON p.season = s.season AND p.team = s.team AND p.day = s.day")
def _standing(spark, sf_dir):
    return ops.standing(views.sides(spark, sf_dir)).select("contest_id", "team", "season", "day", "standing")


@query("standing_after", f"WITH {standing_sql('after')} SELECT contest_id, s.team, s.season, s.day, standing "
                         "FROM sides s JOIN places p ON p.season = s.season AND p.team = s.team AND p.day = s.day")
def _standing_after(spark, sf_dir):
    return ops.standing(views.sides(spark, sf_dir), as_of="after").select(
        "contest_id", "team", "season", "day", "standing")


LITERAL_PLACES = """
places AS (
  SELECT contest_id, team, season, day, CASE WHEN running_points IS NOT NULL THEN
    CAST(DENSE_RANK() OVER (PARTITION BY season, day ORDER BY running_points ASC NULLS LAST) AS INTEGER) END AS standing
  FROM scanned)"""


@query("standing_literal", f"WITH {views.SCANNED_LITERAL}, {LITERAL_PLACES} SELECT * FROM places")
def _standing_literal(spark, sf_dir):
    scanned = ops.running_points(views.sides(spark, sf_dir), "literal")
    return ops.standing(scanned, "literal").select("contest_id", "team", "season", "day", "standing")


@query("season_end", f"""WITH {views.SCANNED} SELECT {KEY_SQL}, CAST(CASE WHEN ROW_NUMBER() OVER
    (PARTITION BY team, season ORDER BY day DESC, contest_id DESC) = 1 THEN 1 ELSE 0 END AS INTEGER) AS season_end
    FROM scanned""")
def _season_end(spark, sf_dir):
    return ops.season_end(views.sides(spark, sf_dir)).select(*SIDE_KEY, "season_end")


LITERAL_ENDS = """
ends AS (
  SELECT *, CAST(CASE WHEN last_before IS NULL OR points_before IS NULL THEN NULL
                      WHEN points_before = last_before THEN 1 ELSE 0 END AS INTEGER) AS season_end
  FROM (SELECT *, LAST_VALUE(points_before) OVER (PARTITION BY team, season ORDER BY day, contest_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_before FROM scanned) AS t)"""


@query("season_end_literal", f"WITH {views.SCANNED_LITERAL}, {LITERAL_ENDS} SELECT {KEY_SQL}, season_end FROM ends")
def _season_end_literal(spark, sf_dir):
    scanned = ops.points_before_round(views.sides(spark, sf_dir), "literal")
    return ops.season_end(scanned, "literal").select(*SIDE_KEY, "season_end")


FLAGS = """
flags AS (
  SELECT *, CASE WHEN seq > 1 AND points_before >= 1.808 * (seq - 1) THEN 1 ELSE 0 END AS in_title_race,
            CASE WHEN seq > 1 AND points_before <= 0.972 * (seq - 1) THEN 1 ELSE 0 END AS in_relegation_race,
            CASE WHEN running_points >= 1.808 * seq THEN 1 ELSE 0 END AS in_title_race_after,
            CASE WHEN running_points <= 0.972 * seq THEN 1 ELSE 0 END AS in_relegation_race_after
  FROM scanned)"""


@query("race_flags", f"""WITH {views.SCANNED}, {FLAGS} SELECT contest_id, team, seq, in_title_race,
    in_relegation_race, in_title_race_after, in_relegation_race_after FROM flags""")
def _flags(spark, sf_dir):
    scanned = ops.side_scan(views.sides(spark, sf_dir))
    after = ops.race_flags(scanned, as_of="after").withColumnsRenamed({
        "in_title_race": "in_title_race_after", "in_relegation_race": "in_relegation_race_after"})
    return ops.race_flags(after).select(
        "contest_id", "team", "seq", "in_title_race", "in_relegation_race",
        "in_title_race_after", "in_relegation_race_after")


PRIOR = """
prior AS (SELECT team, season + 1 AS season, CAST(SUM(COALESCE(pts, 0)) AS INTEGER) AS prior_year
          FROM sides GROUP BY team, season)"""
LITERAL_PRIOR = """
prior AS (
  SELECT team, season + 1 AS season, COALESCE(running_points, 0) AS prior_year FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY team, season ORDER BY day, contest_id) AS nth
    FROM ends WHERE season_end = 1) AS t WHERE nth = 1)"""


@query("prior_season_points", f"""WITH {views.SIDES}, {PRIOR} SELECT contest_id, s.team, s.season, prior_year,
    CAST(CASE WHEN prior_year IS NULL THEN 1 ELSE 0 END AS INTEGER) AS was_promo
    FROM sides s LEFT JOIN prior p ON p.team = s.team AND p.season = s.season""")
def _prior(spark, sf_dir):
    rows = views.sides(spark, sf_dir)
    return rows.join(ops.prior_season_points(rows), ["team", "season"], "left").select(
        "contest_id", "team", "season", "prior_year", F.col("prior_year").isNull().cast("int").alias("was_promo"))


@query("snapshot_join", f"""WITH {views.SCANNED} SELECT l.contest_id, l.winner,
    h.points_before AS home_points_before, h.form AS home_form, a.points_before AS away_points_before, a.form AS away_form
    FROM ledger l LEFT JOIN scanned h ON h.contest_id = l.contest_id AND h.is_home = 1
    LEFT JOIN scanned a ON a.contest_id = l.contest_id AND a.is_home = 0""")
def _snapshot(spark, sf_dir):
    games = views.ledger(spark, sf_dir)
    scanned = ops.side_scan(ops.sides(games))
    return ops.snapshot_join(games.select("contest_id", "winner"), scanned, ["points_before", "form"])


def features_sql(mode: str) -> str:
    if mode == "literal":
        parts = [views.SCANNED_LITERAL, LITERAL_PLACES, LITERAL_ENDS, LITERAL_PRIOR]
        title, relegation = "s.running_points >= 1.808 * s.seq", "s.running_points <= 0.972 * s.seq"
        place = "p.contest_id = s.contest_id AND p.team = s.team"
        before, rank = "COALESCE(s.points_before, 0)", "COALESCE(p.standing, 0)"
        winner = "COALESCE(s.winner, '0') AS winner"
    else:
        parts = [standing_sql("before"), PRIOR]
        title = "s.seq > 1 AND s.points_before >= 1.808 * (s.seq - 1)"
        relegation = "s.seq > 1 AND s.points_before <= 0.972 * (s.seq - 1)"
        place = "p.season = s.season AND p.day = s.day AND p.team = s.team"
        before, rank, winner = "s.points_before", "p.standing", "s.winner"
    return ", ".join(parts) + f""",
featured AS MATERIALIZED (
  SELECT s.contest_id, s.day, s.season, s.team, s.is_home, {winner}, s.seq, {before} AS points_before, s.form,
    CASE WHEN {title} THEN 1 ELSE 0 END AS in_title_race,
    CASE WHEN {relegation} THEN 1 ELSE 0 END AS in_relegation_race,
    {rank} AS standing, COALESCE(y.prior_year, 40) AS prior_year,
    CASE WHEN y.prior_year IS NULL THEN 1 ELSE 0 END AS was_promo
  FROM scanned s LEFT JOIN places p ON {place}
  LEFT JOIN prior y ON y.team = s.team AND y.season = s.season),
features AS MATERIALIZED (
  SELECT contest_id, day, season, winner, {folded("seq", "round_no", "")}, {folded("team", "home", "")}, {folded("team", "away", "", 0)},
    {", ".join(folded(c, c, "home_") + ", " + folded(c, c, "away_", 0) for c in matches.FEATURES)}
  FROM featured GROUP BY contest_id, day, season, winner)"""


def folded(column: str, name: str, prefix: str, side: int = 1) -> str:
    return f"MAX(CASE WHEN is_home = {side} THEN {column} END) AS {prefix}{name}"


@query("match_features", f"WITH {features_sql('intended')} SELECT * FROM features")
def match_features(spark, sf_dir):
    return matches.match_features(views.ledger(spark, sf_dir))


def two_leagues_sql() -> str:
    """The same of a ledger of two leagues: a season of a league is a season of its own, ten times the year plus the league."""
    sql = features_sql("intended")
    for old, new in (("SELECT contest_id, day, season, home, away, home_goals",
                      "SELECT contest_id, day, CAST(season * 10 + contest_id % 2 AS INTEGER) AS season, home, away, home_goals"),
                     ("season + 1 AS season", "season + 10 AS season")):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


@query("match_features_rounds", f"""WITH {two_leagues_sql()} SELECT * REPLACE (CAST(season // 10 AS INTEGER) AS season,
    CAST(contest_id % 38 + 1 AS INTEGER) AS round_no), CAST(contest_id % 2 AS INTEGER) AS league FROM features""")
def _features_rounds(spark, sf_dir):
    """Two leagues with rounds that are not played in the order of their numbers."""
    games = views.ledger(spark, sf_dir).withColumns({
        "league": (F.col("contest_id") % 2).cast("int"), "round_no": (F.col("contest_id") % 38 + 1).cast("int")})
    return matches.match_features(games)


@query("match_features_literal", f"WITH {features_sql('literal')} SELECT * FROM features")
def _features_literal(spark, sf_dir):
    return matches.match_features(views.ledger(spark, sf_dir), "literal")


@query("training_set", f"""WITH {features_sql('intended')} SELECT contest_id, {', '.join(matches.TRAINING_COLUMNS)}
    FROM features WHERE season <> 1995 AND winner IS NOT NULL""")
def _training(spark, sf_dir):
    return matches.training_set(matches.match_features(views.ledger(spark, sf_dir)), drop_seasons=[1995])


@query("next_round", f"""WITH {features_sql('intended')} SELECT contest_id, {', '.join(matches.TRAINING_COLUMNS[1:])}
    FROM features WHERE season <> 1995 AND winner IS NULL AND home_points_before <> 0 AND round_no = 19""")
def _next_round(spark, sf_dir):
    return matches.next_round(matches.match_features(views.ledger(spark, sf_dir)), 19, drop_seasons=[1995])


@query("training_set_literal", f"""WITH {features_sql('literal')} SELECT contest_id, {', '.join(matches.TRAINING_COLUMNS)}
    FROM features WHERE season <> 1995 AND winner <> '0'""")
def _training_literal(spark, sf_dir):
    return matches.training_set(matches.match_features(views.ledger(spark, sf_dir), "literal"), drop_seasons=[1995])
