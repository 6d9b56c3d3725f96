"""Contest views over the given tables, for Spark (frames) and as SQL text (common table expressions).

orders become matches, lineitem rows become player seasons and line-ups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from contestlab.functions import winner
from contestlab.operators.sides import sides as unfold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    unplayed = (F.col("o_orderstatus") == "P") & (F.year("o_orderdate") == 2001)
    return orders.select(
        F.col("o_orderkey").alias("contest_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.year("o_orderdate").alias("season"),
        (F.col("o_custkey") % 20).cast("int").alias("home"),
        ((F.col("o_custkey") % 20 + 1 + F.col("o_orderkey") % 19) % 20).cast("int").alias("away"),
        F.when(~unplayed, F.floor("o_totalprice") % 5).cast("int").alias("home_goals"),
        F.when(~unplayed, F.floor(F.col("o_totalprice") / 7) % 4).cast("int").alias("away_goals"),
    ).withColumn("winner", winner("home_goals", "away_goals"))


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unfold(ledger(spark, sf_dir))


def player_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("player"),
        (F.col("l_suppkey") % 10 + F.col("l_partkey") % 2).cast("int").alias("team"),
        F.col("l_returnflag").alias("league"),
        F.year("l_shipdate").alias("season"),
        F.col("l_linenumber").alias("matches"),
        (F.col("l_quantity").cast("bigint") % 4).cast("int").alias("goals"),
        (F.col("l_linenumber") - F.col("l_linenumber") % 2).alias("starts"),
        (F.col("l_linenumber") % 2).alias("sub_in"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") % 3 % 2).otherwise(0).alias("sub_out"),
    )


def lineup(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    games = ledger(spark, sf_dir).select("contest_id", "season", "home", "away")
    starting = F.when(F.col("l_returnflag") == "R", 0).otherwise(1)
    return items.join(games, items.l_orderkey == games.contest_id).select(
        "contest_id", F.col("l_suppkey").alias("player"),
        F.when(F.col("l_partkey") % 2 == 0, F.col("home")).otherwise(F.col("away")).alias("team"),
        "season", starting.alias("is_starting"),
        F.when((starting == 0) & (F.col("l_linenumber") % 2 == 0),
               F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("'"))).otherwise(" ").alias("subbed_time"),
    )


LEDGER = """
ledger AS MATERIALIZED (
  SELECT contest_id, day, season, home, away, home_goals, away_goals,
         CASE WHEN home_goals > away_goals THEN 'Home' WHEN home_goals < away_goals THEN 'Away'
              WHEN home_goals = away_goals THEN 'Draw' END AS winner
  FROM (
    SELECT o_orderkey AS contest_id, CAST(o_orderdate AS DATE) AS day,
           CAST(YEAR(o_orderdate) AS INTEGER) AS season,
           CAST(o_custkey % 20 AS INTEGER) AS home,
           CAST((o_custkey % 20 + 1 + o_orderkey % 19) % 20 AS INTEGER) AS away,
           CASE WHEN NOT (o_orderstatus = 'P' AND YEAR(o_orderdate) = 2001)
                THEN CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 5 AS INTEGER) END AS home_goals,
           CASE WHEN NOT (o_orderstatus = 'P' AND YEAR(o_orderdate) = 2001)
                THEN CAST(CAST(FLOOR(o_totalprice / 7) AS BIGINT) % 4 AS INTEGER) END AS away_goals
    FROM orders) AS base)"""

SIDES = LEDGER + """,
sides AS MATERIALIZED (
  SELECT contest_id, day, season, home AS team, 1 AS is_home, winner,
         CASE winner WHEN 'Home' THEN 3 WHEN 'Draw' THEN 1 WHEN 'Away' THEN 0 END AS pts FROM ledger
  UNION ALL
  SELECT contest_id, day, season, away, 0, winner,
         CASE winner WHEN 'Away' THEN 3 WHEN 'Draw' THEN 1 WHEN 'Home' THEN 0 END FROM ledger)"""

# Running values of a side, an unplayed match leaving the total unchanged.
SCANNED = SIDES + """,
scanned AS MATERIALIZED (
  SELECT *,
    CAST(ROW_NUMBER() OVER w AS INTEGER) AS seq,
    CAST(COALESCE(SUM(pts) OVER (w ROWS UNBOUNDED PRECEDING), 0) AS INTEGER) AS running_points,
    CASE WHEN ROW_NUMBER() OVER w > 1 THEN
      CAST(COALESCE(SUM(pts) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) END AS points_before,
    CAST(COALESCE(SUM(pts) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS form
  FROM sides WINDOW w AS (PARTITION BY team, season ORDER BY day, contest_id))"""

# The same, a missing result blanking every later total.
SCANNED_LITERAL = SIDES + """,
flagged AS (
  SELECT *, ROW_NUMBER() OVER w AS seq0,
    SUM(CASE WHEN pts IS NULL THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS missing,
    SUM(pts) OVER (w ROWS UNBOUNDED PRECEDING) AS total,
    SUM(pts) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS total_before,
    SUM(pts) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 4 PRECEDING) AS total_4_before
  FROM sides WINDOW w AS (PARTITION BY team, season ORDER BY day, contest_id)),
scanned0 AS (
  SELECT *, CASE WHEN missing = 0 THEN CAST(total AS INTEGER) END AS running_points FROM flagged),
scanned AS (
  SELECT contest_id, day, season, team, is_home, winner, pts, CAST(seq0 AS INTEGER) AS seq, running_points,
    LAG(running_points) OVER (PARTITION BY team, season ORDER BY day, contest_id) AS points_before,
    CAST(COALESCE(CASE WHEN seq0 <= 4 THEN total_before ELSE total_4_before END, 0) AS INTEGER) AS form
  FROM scanned0)"""

PLAYER_SEASON = """
player_season AS (
  SELECT l_suppkey AS player, CAST(l_suppkey % 10 + l_partkey % 2 AS INTEGER) AS team,
         l_returnflag AS league, CAST(YEAR(l_shipdate) AS INTEGER) AS season,
         l_linenumber AS matches, CAST(CAST(l_quantity AS BIGINT) % 4 AS INTEGER) AS goals,
         l_linenumber - l_linenumber % 2 AS starts, l_linenumber % 2 AS sub_in,
         CASE WHEN l_linenumber > 1 THEN l_linenumber % 3 % 2 ELSE 0 END AS sub_out
  FROM lineitem)"""

SUMMARY = PLAYER_SEASON + """,
minutes AS (
  SELECT *, (starts - sub_out) * 90 + sub_in * 20 + sub_out * 70 AS mins FROM player_season),
summary AS (
  SELECT player, season, team, COUNT(DISTINCT league) AS diff_leagues,
    CAST(SUM(mins) AS BIGINT) AS mins, CAST(SUM(matches) AS BIGINT) AS n_matches,
    CAST(SUM(goals) AS BIGINT) AS goals,
    CAST(COALESCE(SUM(CASE WHEN league = 'A' THEN mins END), 0) AS BIGINT) AS pl_mins,
    CAST(COALESCE(SUM(CASE WHEN league = 'A' THEN matches END), 0) AS BIGINT) AS pl_matches,
    CAST(COALESCE(SUM(CASE WHEN league = 'A' THEN goals END), 0) AS BIGINT) AS pl_goals,
    CAST(COALESCE(SUM(CASE WHEN league = 'N' THEN mins END), 0) AS BIGINT) AS cl_mins,
    CAST(COALESCE(SUM(CASE WHEN league = 'N' THEN matches END), 0) AS BIGINT) AS cl_matches,
    CAST(COALESCE(SUM(CASE WHEN league = 'N' THEN goals END), 0) AS BIGINT) AS cl_goals
  FROM minutes GROUP BY player, season, team)"""


def ratio_sql(a: str, b: str) -> str:
    """SUM(a) / SUM(b) of whole numbers, rounded half up to two digits; 0 when b is 0."""
    return f"COALESCE(CASE WHEN SUM({b}) > 0 THEN FLOOR((200 * SUM({a}) + SUM({b})) // (2 * SUM({b}))) / 100.0 END, 0)"


def windows_sql(years: int, start: int, end: int, over: int, ratio_over: int = 1) -> str:
    return SUMMARY + f""",
seasons AS (SELECT season, ROW_NUMBER() OVER (ORDER BY season) AS n FROM
  (SELECT DISTINCT season FROM summary WHERE season BETWEEN {start} AND {end}) AS d),
spans AS (SELECT a.season AS lo, b.season AS window_end FROM seasons a JOIN seasons b ON b.n = a.n + {years - 1}),
windows AS (
  SELECT player, window_end, COUNT(DISTINCT team) AS n_teams,
    SUM(mins) / {over}.0 AS window_minutes, SUM(n_matches) / {over}.0 AS window_matches, SUM(goals) / {over}.0 AS window_goals,
    SUM(cl_mins) / {over}.0 AS window_cl_minutes, SUM(cl_matches) / {over}.0 AS window_cl_matches,
    SUM(cl_goals) / {over}.0 AS window_cl_goals,
    SUM(pl_mins) / {over}.0 AS window_pl_minutes, SUM(pl_matches) / {over}.0 AS window_pl_matches,
    SUM(pl_goals) / {over}.0 AS window_pl_goals,
    AVG(diff_leagues) AS mean_diff_leagues,
    {ratio_sql("pl_mins", "mins")} / {ratio_over}.0 AS mins_league_share,
    {ratio_sql("pl_goals", "goals")} / {ratio_over}.0 AS goals_league_share
  FROM summary JOIN spans ON season BETWEEN lo AND window_end GROUP BY player, window_end)"""


LINEUP = LEDGER + """,
lineup AS (
  SELECT contest_id, l_suppkey AS player, CASE WHEN l_partkey % 2 = 0 THEN home ELSE away END AS team, season,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS is_starting,
         CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0
              THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '''' ELSE ' ' END AS subbed_time
  FROM lineitem JOIN ledger ON l_orderkey = contest_id)"""
