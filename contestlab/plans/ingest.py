"""Stored pages to fixture, line-up, biography and season tables.

Pages come as (page_id, url, html). All pages go through one distributed plan; nothing is fetched.
A page is parsed by one task, so windows over the rows of one page are bounded by its text.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from contestlab import functions as fn
from contestlab.operators.frames import blank_to_null, same_keys
from contestlab.operators.scans import locf
from contestlab.schemas import BIOGRAPHY, FIXTURE, LINEUP, PLAYER_SEASON
from contestlab.sources import html

# Column names by position, first label of the biography slice and the positions
# counted from it, text that opens the bench.
FIXTURE_COLUMNS = ["day", "kickoff", "home_team", "dash", "away_team", "score", "has_finished", "round"]
LINEUP_COLUMNS = ["number", "player", "subbed_time"]
SEASON_COLUMNS = [None, "league", "season", "team", "matches", "goals", "starts", "sub_in", "sub_out",
                  "yellows", "two_yellows", "red"]
BORN = "Born:"
BIOGRAPHY_POSITIONS = {"dob": 1, "country": 3, "height": 4, "weight": 5, "position": 6, "foot": 7}
BENCH = "Substitutes"
FIRST_ROUND = "1. Round"

BASE = "https://example.org"
REPORT_PATH = "report"  # fixed value: piece of the addresses of match reports


def fixtures_from_pages(pages: DataFrame, worklist: DataFrame, *, as_of: date | Column | None = None,
                        base: str = BASE, mode: str = "intended", literal_path: str = "first-league") -> DataFrame:
    """Fixture table of season pages; `worklist` names season and title of each address.

    Day and round are given once for the rows that follow. Literal mode compares days as texts,
    reads scores by position and puts `literal_path` into the report address of every league."""
    of_page = worklist.select("url", "season_start", "season_end", "title", "path")
    rows = html.tables_by_shape(html.html_tables(pages, with_url=True), min_rows=2).repartition("page_id")
    named = blank_to_null(html.name_columns(rows, FIXTURE_COLUMNS))
    at = ["page_id", "table_no"]
    seeded = named.withColumn("round", F.when(F.col("row_no") == 1, FIRST_ROUND).otherwise(F.col("round")))
    parsed = seeded.withColumns({
        "day": fn.parse_date("day"),
        "round_no": F.when(F.col("round").contains(". Round"),
                           F.replace("round", F.lit(". Round"), F.lit("")).try_cast("int")),
    })
    filled = locf(parsed, ["day", "round_no"], at, ["row_no"], block_rows=None)
    goals = filled.filter(F.col("dash") == "-").withColumn("_s", fn.parse_score("score", mode))
    joined = goals.join(of_page, "url")
    path = F.lit(literal_path) if mode == "literal" else F.col("path")
    out = joined.select(
        "day", "kickoff", "home_team", "dash", "away_team", "score",
        fn.has_finished("day", as_of, mode).alias("has_finished"), "round_no", "_s.*",
        fn.season_label("season_start").alias("season_id"), "season_start", "season_end", "title",
        fn.report_id(F.concat(F.lit(f"{base}/{REPORT_PATH}/"), path, F.lit("-")), "season_start", "season_end",
                     "home_team", "away_team").alias("match_id"),
        fn.winner("_s.ft_home", "_s.ft_away").alias("winner"),
        fn.goal_diff("_s.ft_home", "_s.ft_away").alias("diff"))
    return out.select(*FIXTURE.fieldNames()).distinct()


def lineups_from_pages(pages: DataFrame, fixtures: DataFrame, *, base: str = BASE) -> DataFrame:
    """Line-ups of the match pages that hold exactly two line-up tables."""
    games = fixtures.select(
        F.col("match_id").alias("url"), "home_team", "away_team", "season_id").distinct()
    tables = html.table_columns(pages, LINEUP_COLUMNS, min_rows=11, max_rows=21, with_url=True).repartition("page_id")
    # A table stays one row, with an array per column, up to the join: its windows, its sorts and its shuffles see no players.
    number_of = F.expr("nullif(array_position(transform(subbed_time, x -> startswith(x, 'Sub')), true), 0)")
    flagged = html.require_tables(tables, 2).withColumn("row_no", number_of)
    flagged = flagged.withColumn("bench", html.marker_row(F.col("row_no").isNotNull()))
    # Both sides grow with the pages, whatever their estimates say of arrays and texts: neither is ever broadcast.
    squads = flagged.join(games.hint("merge"), "url")
    # Equal rows have the same address and side. Where these belong to one table whose numbers differ, there are none.
    same_side = Window.partitionBy("url")
    count = F.when(F.col("nth") == 1, F.count_if(F.col("nth") == 1).over(same_side)).otherwise(
        F.count_if(F.col("nth") == 2).over(same_side))
    alone = (count == 1) & (F.size(F.array_distinct("number")) == F.size("number"))
    squads = squads.select(
        "number", "player", "subbed_time", "bench", "url", "season_id", alone.alias("alone"), (F.col("nth") == 1).alias("is_home"),
        F.when(F.col("nth") == 1, F.col("home_team")).otherwise(F.col("away_team")).alias("team"))
    once, more = (_players(squads.filter(c), base) for c in (F.col("alone"), ~F.col("alone")))
    return once.unionByName(more.distinct())


def _players(squads: DataFrame, base: str) -> DataFrame:
    """Line-up rows of tables that hold an array per column."""
    cells = F.arrays_zip("number", "player", "subbed_time")
    rows = squads.select("bench", "url", "season_id", "is_home", "team", F.posexplode(cells).alias("at", "c")).select(
        "*", "c.*").filter(F.col("number") != BENCH)
    out = rows.select(
        "number",
        fn.strip_marks("player").alias("player"),
        F.coalesce("subbed_time", F.lit(" ")).alias("subbed_time"),
        F.when(F.col("at") + 1 >= F.col("bench"), 0).otherwise(1).alias("is_starting"),
        "team", F.col("is_home").cast("int").alias("is_home"),
        F.col("url").alias("match_id"), "season_id", fn.player_link("player", base).alias("player_link"))
    return out.withColumn("player_key", fn.key_of("player", "team", "season_id")).select(*LINEUP.fieldNames())


def _distinct_players(lineups: DataFrame, base: str) -> DataFrame:
    return lineups.select("player", "team", "season_id").distinct().withColumns({
        "player_slug": F.replace("player", F.lit(" "), F.lit("-")),
        "player_link": fn.player_link("player", base),
    })


def biographies_from_pages(pages: DataFrame, lineups: DataFrame, *, base: str = BASE) -> DataFrame:
    """One row per player, team and season with what the player's page tells; NULL where it does not."""
    rows = html.tables_by_shape(html.html_tables(pages, with_url=True), min_rows=6, max_rows=10, n_cols=2).repartition("page_id")
    named = html.name_columns(rows, ["label", "info"])
    is_born = F.col("label") == BORN
    named = named.withColumn("_born", html.marker_row(is_born)).filter(
        (F.col("_born") == 1) | ((F.col("n_rows") >= 9) & F.col("_born").isNotNull()))
    info = fn.strip_punct(fn.strip_control("info"))
    sliced = html.slice_after_marker(named, is_born, info, BIOGRAPHY_POSITIONS, group=("page_id", "table_no", "url"))
    facts = (
        sliced.groupBy("url").agg(F.min_by(F.struct(*BIOGRAPHY_POSITIONS), F.struct("page_id", "table_no")).alias("b"))
        .select(F.col("url").alias("player_link"), "b.*")
    )
    out = _distinct_players(lineups, base).alias("p").join(
        facts.alias("f"), same_keys("p", "f", ["player_link"]), "left").select(
        "p.*", *[f"f.{c}" for c in BIOGRAPHY_POSITIONS])
    return out.withColumns({
        "dob": fn.parse_date("dob", "ddMMyyyy"),
        "height_cm": fn.parse_measure("height", " cm"),
        "weight_kg": fn.parse_measure("weight", " kg"),
        "field_position": fn.field_position("position"),
        "player_key": fn.key_of("player", "team", "season_id"),
    }).select(*BIOGRAPHY.fieldNames())


def season_stats_from_pages(pages: DataFrame, lineups: DataFrame, *, base: str = BASE) -> DataFrame:
    """Season statistics of the players' pages; a page without them adds nothing."""
    players = _distinct_players(lineups, base).select("player_slug", "player_link").distinct()
    rows = html.tables_by_shape(html.html_tables(pages, with_url=True), min_rows=1, n_cols=12)
    named = html.name_columns(rows, SEASON_COLUMNS)
    counts = [c for c in SEASON_COLUMNS[4:]]
    joined = named.withColumnRenamed("url", "player_link").join(players, "player_link")
    return joined.withColumns(
        {"league": fn.strip_punct(fn.strip_control("league")), "player_name": F.col("player_slug")}
        | {c: F.col(c).try_cast("int") for c in counts}
    ).select(*PLAYER_SEASON.fieldNames()).distinct()
