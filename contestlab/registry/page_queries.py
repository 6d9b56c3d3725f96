"""Queries over stored pages. The pages are written by the query itself from the given tables, a
bounded number of rows to a page, and read back; the SQL states the rows that went in."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from contestlab import functions as fn
from contestlab.operators.frames import resolve_candidate
from contestlab.plans import ingest
from contestlab.registry import query, views
from contestlab.registry.columns import CLASS_SQL, POSITION_SQL, positions
from contestlab.registry.views import table
from contestlab.sources import html

ROWS_PER_PAGE = 40


def row_of(*cells: Column | str, tag: str = "td") -> Column:
    """<tr> of the given texts, a missing text giving an empty cell."""
    parts = []
    for c in cells:
        c = F.lit(c) if isinstance(c, str) else c
        parts += [F.lit(f"<{tag}>"), F.coalesce(c.cast("string"), F.lit("")), F.lit(f"</{tag}>")]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """As many partitions as the session shuffles into: parsing costs far more than its few bytes suggest."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def page_of(df: DataFrame, page_id: Column, order: str, row: Column, url: Column | None = None) -> DataFrame:
    """One page with one table per block of rows; a block holds at most ROWS_PER_PAGE of them."""
    rows = df.select(page_id.cast("long").alias("page_id"), F.struct(F.col(order).alias("o"), row.alias("r")).alias("x"))
    rows = spread(rows, "page_id")
    body = F.concat_ws("", F.transform(F.sort_array(F.collect_list("x")), lambda x: x["r"]))
    out = rows.groupBy("page_id").agg(
        F.concat(F.lit("<html><body><p>a < b</p><table>"), body, F.lit("</table></body></html>")).alias("html"))
    url = url if url is not None else F.concat(F.lit("https://example.org/page/"), F.col("page_id"))
    return out.select("page_id", url.alias("url"), "html")


def order_pages(spark, sf_dir):
    """Each page: a header row and ROWS_PER_PAGE orders; orders of status P lack their last cell."""
    orders = table(spark, sf_dir, "orders")
    full = row_of(F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"))
    short = row_of(F.col("o_orderkey"), F.col("o_orderpriority"))
    pages = page_of(orders, F.floor(F.col("o_orderkey") / ROWS_PER_PAGE), "o_orderkey",
                    F.when(F.col("o_orderstatus") == "P", short).otherwise(full))
    head = F.lit("<table><tr><th>key</th><th>priority</th><th>status</th></tr>")
    return pages.withColumn("html", F.replace("html", F.lit("<table>"), head))


PAGE_ROWS_SQL = f"""page_rows AS (SELECT o_orderkey // {ROWS_PER_PAGE} AS page_id, 1 AS table_no,
    CAST(ROW_NUMBER() OVER (PARTITION BY o_orderkey // {ROWS_PER_PAGE} ORDER BY o_orderkey) AS INTEGER) AS row_no,
    CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS priority,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders)"""


@query("html_tables", f"""WITH {PAGE_ROWS_SQL}, w AS (SELECT *, MAX(CASE WHEN status IS NULL THEN 2 ELSE 3 END)
      OVER (PARTITION BY page_id) AS width FROM page_rows)
    SELECT page_id, table_no, row_no, CAST(width AS INTEGER) AS width, key || '|' || priority ||
      CASE WHEN width = 3 THEN '|' || COALESCE(status, 'none') ELSE '' END AS cells,
      CAST(COUNT(*) OVER (PARTITION BY page_id) AS INTEGER) AS n_rows FROM w""")
def _tables(spark, sf_dir):
    rows = html.html_tables(order_pages(spark, sf_dir))
    return rows.withColumns({"width": F.size("cells"), "cells": F.array_join("cells", "|", "none")})


@query("name_columns", f"WITH {PAGE_ROWS_SQL} SELECT page_id, table_no, row_no, key, status FROM page_rows")
def _named(spark, sf_dir):
    return html.name_columns(html.html_tables(order_pages(spark, sf_dir)), ["key", None, "status"]).drop("n_rows")


def sized_pages(spark, sf_dir):
    """Four line-up like tables a page, made of orders by key; their sizes vary with the data."""
    orders = table(spark, sf_dir, "orders").withColumns({
        "p": F.floor(F.col("o_orderkey") / ROWS_PER_PAGE), "t": (F.col("o_custkey") % 4).cast("int")})
    row = F.struct(F.col("o_orderkey").alias("o"), row_of(F.col("o_orderkey"), F.col("o_orderstatus")).alias("r"))
    one = spread(orders, "p").groupBy("p", "t").agg(F.concat(F.lit("<table>"), F.concat_ws(
        "", F.transform(F.sort_array(F.collect_list(row)), lambda x: x["r"])), F.lit("</table>")).alias("html"))
    return one.groupBy(F.col("p").alias("page_id")).agg(F.concat_ws("", F.transform(
        F.sort_array(F.collect_list(F.struct("t", "html"))), lambda x: x["html"])).alias("html")).select(
        "page_id", F.lit("").alias("url"), "html")


SIZED_SQL = f"""base AS (SELECT o_orderkey // {ROWS_PER_PAGE} AS page_id, o_custkey % 4 AS t, o_orderkey FROM orders),
  numbered AS (SELECT page_id, CAST(DENSE_RANK() OVER (PARTITION BY page_id ORDER BY t) AS INTEGER) AS table_no,
      CAST(ROW_NUMBER() OVER (PARTITION BY page_id, t ORDER BY o_orderkey) AS INTEGER) AS row_no,
      COUNT(*) OVER (PARTITION BY page_id, t) AS n, CAST(o_orderkey AS VARCHAR) AS key FROM base),
  fit AS (SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY page_id ORDER BY table_no) AS INTEGER) AS nth
    FROM numbered WHERE n BETWEEN 11 AND 21)"""


@query("tables_by_shape", f"WITH {SIZED_SQL} SELECT page_id, table_no, row_no, key FROM fit")
def _by_shape(spark, sf_dir):
    rows = html.tables_by_shape(html.html_tables(sized_pages(spark, sf_dir)), 11, 21, n_cols=2)
    return html.name_columns(rows, ["key"]).drop("n_rows")


@query("require_tables", f"""WITH {SIZED_SQL} SELECT page_id, table_no, row_no, key, nth FROM fit
    WHERE page_id IN (SELECT page_id FROM fit GROUP BY page_id HAVING MAX(nth) = 2)""")
def _required(spark, sf_dir):
    rows = html.tables_by_shape(html.html_tables(sized_pages(spark, sf_dir)), 11, 21, n_cols=2)
    return html.name_columns(html.require_tables(rows, 2), ["key"]).drop("n_rows")


# Season pages. Days and rounds are written once, before the rows they hold for.

LEAGUES = ["first-league", "second-league"]


def fixture_rows(spark, sf_dir):
    games = views.ledger(spark, sf_dir)
    score = F.concat(F.col("home_goals"), F.lit(":"), F.col("away_goals"), F.lit(" (0:0)"))
    return games.select(
        "*", score.alias("score"), F.floor(F.col("contest_id") / ROWS_PER_PAGE).alias("p"),
        (F.floor(F.col("contest_id") / ROWS_PER_PAGE) % 2).cast("int").alias("league"),
        # the days of a page: one for every ten matches
        F.date_add(F.lit(date(2001, 8, 1)), F.floor(F.col("contest_id") / 10).cast("int") % 2000).alias("match_day"))


def fixture_pages(spark, sf_dir):
    head = F.when(F.col("contest_id") % 20 == 0, F.concat(
        F.lit('<tr><td colspan="8">'), (F.floor(F.col("contest_id") % ROWS_PER_PAGE / 20) + 1).cast("string"),
        F.lit(". Round</td></tr>"))).otherwise("")
    day = F.when(F.col("contest_id") % 10 == 0, F.date_format("match_day", "dd/MM/yyyy"))
    body = row_of(day, "15:00", F.concat(F.lit("Team "), F.col("home")), "-",
                  F.concat(F.lit("Sons & Co "), F.col("away")), F.col("score"), "", "")
    return page_of(fixture_rows(spark, sf_dir), F.col("p"), "contest_id", F.concat(head, body))


def fixture_worklist(spark, sf_dir):
    """Season and league of each page, following from its number."""
    return fixture_rows(spark, sf_dir).select("p", "league").distinct().select(
        F.concat(F.lit("https://example.org/page/"), F.col("p")).alias("url"),
        (F.lit(1990) + F.col("p") % 30).cast("int").alias("season_start"),
        (F.lit(1991) + F.col("p") % 30).cast("int").alias("season_end"),
        F.when(F.col("league") == 0, "First").otherwise("Second").alias("title"),
        F.get(F.array(*[F.lit(x) for x in LEAGUES]), F.col("league")).alias("path"))


FIXTURES = views.LEDGER + f""",
fixture_base AS (SELECT *, contest_id // {ROWS_PER_PAGE} AS p,
    CAST(1990 + (contest_id // {ROWS_PER_PAGE}) % 30 AS INTEGER) AS s FROM ledger),
fixture AS (
  SELECT DISTINCT CAST(DATE '2001-08-01' + CAST((contest_id // 10) % 2000 AS INTEGER) AS DATE) AS day, '15:00' AS kickoff,
    'Team ' || home AS home_team, '-' AS dash, 'Sons & Co ' || away AS away_team,
    home_goals || ':' || away_goals || ' (0:0)' AS score,
    CAST(DATE '2001-08-01' + CAST((contest_id // 10) % 2000 AS INTEGER) < DATE '2004-01-01' AS INTEGER) AS has_finished,
    CAST((contest_id % {ROWS_PER_PAGE}) // 20 + 1 AS INTEGER) AS round_no,
    home_goals AS ft_home, away_goals AS ft_away,
    CASE WHEN home_goals IS NOT NULL THEN 0 END AS ht_home, CASE WHEN home_goals IS NOT NULL THEN 0 END AS ht_away,
    s || '/' || (s + 1) AS season_id, s AS season_start, s + 1 AS season_end,
    CASE WHEN p % 2 = 0 THEN 'First' ELSE 'Second' END AS title,
    'https://example.org/report/' || CASE WHEN p % 2 = 0 THEN 'first' ELSE 'second' END || '-league-' || s || '-' || (s + 1)
      || '-Team-' || home || '-Sons-Co-' || away || '/' AS match_id,
    winner, home_goals - away_goals AS diff
  FROM fixture_base)"""


@query("fixtures_from_pages", f"WITH {FIXTURES} SELECT * FROM fixture")
def fixtures(spark, sf_dir):
    return ingest.fixtures_from_pages(
        fixture_pages(spark, sf_dir), fixture_worklist(spark, sf_dir), as_of=date(2004, 1, 1))


# Match pages: 12 players a side, the last one on the bench, names and times made of the order.

def match_pages(spark, sf_dir):
    games = spread(views.ledger(spark, sf_dir).select("contest_id", "home", "away", "season"), "contest_id")

    def squad(side: str) -> Column:
        def line(i: Column) -> Column:
            name = F.concat(F.lit("O'Player "), F.col(side).cast("string"), F.lit("-No"), F.substring(F.lit("ABCDEFGHIJKL"), i, F.lit(1)))
            time = F.when((F.col("contest_id") + i) % 3 == 0, F.concat((i + 60).cast("string"), F.lit("'")))
            bench = F.when(i == 12, '<tr><td colspan="3">Substitutes</td></tr>').otherwise("")
            return F.concat(bench, row_of(i.cast("string"), name, time))

        numbers = F.sequence(F.lit(1), F.lit(12))
        return F.concat(F.lit("<table>"), F.concat_ws("", F.transform(numbers, line)), F.lit("</table>"))

    other = F.lit("<table><tr><td>Referee</td><td>X</td></tr></table>")
    return games.select(
        F.col("contest_id").alias("page_id"), F.concat(F.lit("https://example.org/report/"), F.col("contest_id")).alias("url"),
        F.concat(other, squad("home"), other, squad("away")).alias("html"))


def match_list(spark, sf_dir):
    return views.ledger(spark, sf_dir).select(
        F.concat(F.lit("https://example.org/report/"), F.col("contest_id")).alias("match_id"),
        F.concat(F.lit("Team "), F.col("home")).alias("home_team"),
        F.concat(F.lit("Team "), F.col("away")).alias("away_team"), fn.season_label("season").alias("season_id"))


LINEUPS = views.LEDGER + """,
squads AS (SELECT contest_id, season, home AS side, 1 AS is_home FROM ledger
  UNION ALL SELECT contest_id, season, away, 0 FROM ledger),
lineups AS (
  SELECT CAST(i AS VARCHAR) AS number, 'OPlayer No' || SUBSTR('ABCDEFGHIJKL', CAST(i AS INTEGER), 1) AS player0,
    side, i, contest_id, season, is_home FROM squads, (SELECT UNNEST(RANGE(1, 13)) AS i) AS n),
lineup_rows AS (
  SELECT number, 'OPlayer ' || 'No' || SUBSTR('ABCDEFGHIJKL', CAST(i AS INTEGER), 1) AS player,
    CASE WHEN (contest_id + i) % 3 = 0 THEN (i + 60) || '''' ELSE '' END AS subbed_time,
    CASE WHEN i < 12 THEN 1 ELSE 0 END AS is_starting, 'Team ' || side AS team, is_home,
    'https://example.org/report/' || contest_id AS match_id, season || '/' || (season + 1) AS season_id,
    'https://example.org/player_summary/O''Player-' || side || '-No' || SUBSTR('ABCDEFGHIJKL', CAST(i AS INTEGER), 1) || '/2/' AS player_link
  FROM lineups)"""


@query("lineups_from_pages", f"""WITH {LINEUPS} SELECT DISTINCT *, player || '_' || team || '_' || season_id AS player_key
    FROM lineup_rows""")
def lineups(spark, sf_dir):
    return ingest.lineups_from_pages(match_pages(spark, sf_dir), match_list(spark, sf_dir))


# Player pages: a biography for every customer and their orders as season statistics.

def people(spark, sf_dir):
    """Line-up rows naming a player per customer."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Player "), F.col("c_custkey")).alias("player"),
        F.concat(F.lit("Team "), F.col("c_nationkey")).alias("team"), F.lit("1998/1999").alias("season_id"))


def biography_pages(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    job = positions(spark, sf_dir).withColumnRenamed("o_orderkey", "k")
    joined = customer.join(job, customer.c_custkey == job.k, "left")
    born = F.date_add(F.lit(date(1970, 1, 1)), (F.col("c_custkey") % 9000).cast("int"))
    foot = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(row_of("Foot:", "left"))
    intro = F.when(F.col("c_custkey") % 4 == 0, F.concat(*[row_of("Fact:", "x") for _ in range(3)])).otherwise("")
    body = F.concat(
        intro, row_of(ingest.BORN, F.date_format(born, "dd/MM/yyyy")), row_of("Place of birth:", "Town"),
        row_of("Nationality:", F.concat(F.lit("Nation "), F.col("c_nationkey"))),
        row_of("Height:", F.concat(F.col("c_custkey") % 60 + 150, F.lit(" cm"))),
        row_of("Weight:", F.when(F.col("c_custkey") % 5 != 0, F.concat(F.col("c_custkey") % 40 + 60, F.lit(" kg"))).otherwise("?")),
        row_of("Position(s):", F.coalesce("position", F.lit("none"))), foot)
    return joined.select(
        F.col("c_custkey").alias("page_id"),
        F.concat(F.lit("https://example.org/player_summary/Player-"), F.col("c_custkey"), F.lit("/2/")).alias("url"),
        F.concat(F.lit("<table><tr><td>menu</td></tr></table><table>"), body, F.lit("</table>")).alias("html"))


# Pages of 6 rows starting at Born:, of 7, or of 9 and 10 with three facts before it, are all used.
BIOGRAPHIES = f"""WITH {POSITION_SQL}, b AS (
    SELECT c_custkey AS k, c_nationkey AS n, 'Player ' || c_custkey AS player, 'Team ' || c_nationkey AS team,
      REPLACE(COALESCE(position, 'none'), ',', '') AS position FROM customer LEFT JOIN positions ON o_orderkey = c_custkey)
  SELECT player, team, '1998/1999' AS season_id, 'Player-' || k AS player_slug,
    'https://example.org/player_summary/Player-' || k || '/2/' AS player_link,
    CAST(DATE '1970-01-01' + CAST(k % 9000 AS INTEGER) AS DATE) AS dob, 'Nation ' || n AS country,
    (k % 60 + 150) || ' cm' AS height, CASE WHEN k % 5 <> 0 THEN (k % 40 + 60) || ' kg' ELSE '' END AS weight,
    position, CASE WHEN k % 3 <> 0 THEN 'left' END AS foot, CAST(k % 60 + 150 AS DOUBLE) AS height_cm,
    CASE WHEN k % 5 <> 0 THEN CAST(k % 40 + 60 AS DOUBLE) END AS weight_kg, {CLASS_SQL} AS field_position,
    player || '_' || team || '_1998/1999' AS player_key FROM b"""


@query("biographies_from_pages", BIOGRAPHIES)
def _biographies(spark, sf_dir):
    return ingest.biographies_from_pages(biography_pages(spark, sf_dir), people(spark, sf_dir))


@query("slice_after_marker", """SELECT c_custkey AS page_id, 2 AS table_no,
    STRFTIME(DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER), '%d/%m/%Y') AS dob,
    'Nation ' || c_nationkey AS country, CASE WHEN c_custkey % 3 <> 0 THEN 'left' END AS foot FROM customer""")
def _slice(spark, sf_dir):
    rows = html.tables_by_shape(html.html_tables(biography_pages(spark, sf_dir)), 6, 10, n_cols=2)
    named = html.name_columns(rows, ["label", "info"])
    return html.slice_after_marker(named, F.col("label") == "Born:", F.col("info"), {"dob": 1, "country": 3, "foot": 7})


@query("flag_after_marker", f"""WITH {LINEUPS} SELECT contest_id AS page_id, CASE WHEN is_home = 1 THEN 2 ELSE 4 END AS table_no,
    number, CASE WHEN i < 12 THEN 1 ELSE 0 END AS is_starting FROM lineups
    UNION ALL SELECT contest_id, CASE WHEN is_home = 1 THEN 2 ELSE 4 END, 'Substitutes', 0 FROM squads""")
def _flag(spark, sf_dir):
    rows = html.tables_by_shape(html.html_tables(match_pages(spark, sf_dir)), 11, 21)
    named = html.name_columns(rows, ["number", None, "subbed_time"])
    return html.flag_after_marker(named, F.col("subbed_time").startswith("Sub"), "is_starting").select(
        "page_id", "table_no", "number", "is_starting")


def statistics_pages(spark, sf_dir):
    """Statistics of a customer's orders, up to ROWS_PER_PAGE rows to an address page."""
    orders = table(spark, sf_dir, "orders").withColumn("k", F.floor(F.col("o_orderkey") / ROWS_PER_PAGE))
    year = F.year("o_orderdate").cast("string")
    row = row_of("", F.concat(F.col("o_orderpriority"), F.lit(" & co.")), year, F.concat(F.lit("Team "), F.col("o_custkey") % 20),
                 *[F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % n).cast("string") for n in (38, 11, 30, 7, 5, 6, 2)],
                 "-")
    return page_of(orders, F.col("k"), "o_orderkey", row, F.concat(
        F.lit("https://example.org/player_summary/Player-"), F.col("page_id"), F.lit("/2/")))


def _stat(name: str, n: int) -> str:
    return f"CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % {n} AS INTEGER) END AS {name}"


STATISTICS = f"""SELECT DISTINCT REGEXP_REPLACE(o_orderpriority, '-', '') || '  co' AS league, CAST(YEAR(o_orderdate) AS VARCHAR) AS season,
    'Team ' || (o_custkey % 20) AS team, {_stat('matches', 38)}, {_stat('goals', 11)}, {_stat('starts', 30)},
    {_stat('sub_in', 7)}, {_stat('sub_out', 5)}, {_stat('yellows', 6)}, {_stat('two_yellows', 2)}, CAST(NULL AS INTEGER) AS red,
    'Player-' || (o_orderkey // {ROWS_PER_PAGE}) AS player_name,
    'https://example.org/player_summary/Player-' || (o_orderkey // {ROWS_PER_PAGE}) || '/2/' AS player_link
  FROM orders WHERE o_orderkey // {ROWS_PER_PAGE} IN (SELECT c_custkey FROM customer)"""


@query("season_stats_from_pages", STATISTICS)
def _statistics(spark, sf_dir):
    return ingest.season_stats_from_pages(statistics_pages(spark, sf_dir), people(spark, sf_dir))


@query("resolve_candidate", """WITH c AS (SELECT c_custkey, c_nationkey, i, 'P' || c_custkey || CASE WHEN i > 1 THEN '_' || i ELSE '' END AS url
      FROM customer, (SELECT UNNEST(RANGE(1, 8)) AS i) AS n),
    e AS (SELECT DISTINCT 'P' || (o_custkey % 1000) || CASE WHEN o_orderkey % 7 > 0 THEN '_' || (o_orderkey % 7 + 1) ELSE '' END AS url,
      CAST(o_custkey % 25 AS INTEGER) AS c_nationkey FROM orders)
    SELECT c_custkey, COALESCE(MIN_BY(c.url, CASE WHEN e.url IS NOT NULL THEN i END), 'P' || c_custkey) AS url_to_use
    FROM c LEFT JOIN e ON e.url = c.url AND e.c_nationkey = c.c_nationkey GROUP BY c_custkey""")
def _resolve(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    candidates = keys.withColumn("ordinal", F.explode(F.sequence(F.lit(1), F.lit(7)))).withColumn(
        "url", F.concat(F.lit("P"), F.col("c_custkey"), F.when(F.col("ordinal") > 1, F.concat(F.lit("_"), "ordinal")).otherwise("")))
    suffix = F.when(F.col("o_orderkey") % 7 > 0, F.concat(F.lit("_"), F.col("o_orderkey") % 7 + 1)).otherwise("")
    found = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("P"), F.col("o_custkey") % 1000, suffix).alias("url"),
        (F.col("o_custkey") % 25).cast("int").alias("c_nationkey"))
    return resolve_candidate(keys, candidates, found, key=["c_custkey"], on=["c_nationkey"]).select("c_custkey", "url_to_use")
