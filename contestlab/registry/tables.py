"""Queries for sources, sinks and table-level operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contestlab.functions import count_where, missing_flag, n_distinct, sum_where, mean_where
from contestlab.operators import checks, frames
from contestlab.registry import query, views
from contestlab.registry.views import table
from contestlab.session import pinned, scratch_path
from contestlab.sources import tables

LEDGER = f"WITH {views.LEDGER} "


@query("scan_table", "SELECT * FROM orders")
def _scan(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/orders.parquet")


@query("scan_filtered", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000""")
def _scan_filtered(spark, sf_dir):
    return tables.read_table(
        spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey", "o_totalprice"],
        where=(F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 100000))


@query("append_distinct", LEDGER + "SELECT DISTINCT season, home, away, winner FROM ledger")
def append_distinct(spark, sf_dir):
    target = scratch_path(spark, "append")
    games = views.ledger(spark, sf_dir).select("season", "home", "away", "winner")
    early, late = games.filter(F.col("season") <= 1998), games.filter(F.col("season") >= 1997)
    for batch in (early, late, late):
        tables.append_distinct(batch, target, partition_by=["season"])
    return tables.read_table(spark, target, games.schema)


@query("append_distinct_catalog", LEDGER + "SELECT DISTINCT season, home, away, winner FROM ledger")
def append_distinct_catalog(spark, sf_dir):
    """The same into a table of the catalog, known by its name."""
    name = f"appended_{uuid.uuid4().hex}"
    games = views.ledger(spark, sf_dir).select("season", "home", "away", "winner")
    for batch in (games.filter(F.col("season") <= 1998), games.filter(F.col("season") >= 1997), games):
        tables.append_distinct(batch, name, partition_by=["season"])
    out = pinned(tables.read_table(spark, name).select("season", "home", "away", "winner"))
    tables.drop_table(spark, name)
    return out


@query("csv_roundtrip", LEDGER + "SELECT * FROM ledger")
def _csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    games = views.ledger(spark, sf_dir)
    tables.write_csv(games, path)
    return tables.read_csv(spark, path, games.schema)


@query("delim_roundtrip", "SELECT c_custkey, c_name, c_mktsegment || ', \"' || c_nationkey || '\"' AS note FROM customer")
def _delim(spark, sf_dir):
    path = scratch_path(spark, "delim")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.concat("c_mktsegment", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"')).alias("note"))
    tables.write_csv(people, path, sep="~")
    return tables.read_csv(spark, path, people.schema, sep="~")


# Texts that are hard to keep: markers of missing values, line breaks, separators, quotes, backslashes, blanks.
HARD_TEXTS = """CASE c_custkey % 8 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN c_name || chr(10) || chr(13) || 'x'
    WHEN 4 THEN '\\N' WHEN 5 THEN ' "' || c_name || '", ' WHEN 6 THEN c_name || '\\n\\' ELSE c_name END"""


@query("csv_every_text", f"SELECT c_custkey, {HARD_TEXTS} AS note, CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END AS balance FROM customer")
def _csv_texts(spark, sf_dir):
    path = scratch_path(spark, "texts")
    kind, name = F.col("c_custkey") % 8, F.col("c_name")
    note = (F.when(kind == 0, "NA").when(kind == 1, "").when(kind == 2, None).when(kind == 3, F.concat(name, F.lit("\n\rx")))
            .when(kind == 4, "\\N").when(kind == 5, F.concat(F.lit(' "'), name, F.lit('", '))).when(kind == 6, F.concat(name, F.lit("\\n\\"))).otherwise(name))
    people = table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_acctbal")).alias("balance"))
    tables.write_csv(people, path)
    return tables.read_csv(spark, path, people.schema)


@query("tables_of_folder", """SELECT title, COUNT(*) AS n_rows FROM (VALUES ('first'), ('second')) AS t(title), orders
    WHERE (title = 'first') = (o_orderkey % 2 = 1) GROUP BY title""")
def _folder(spark, sf_dir):
    """Tables below a folder by name and size, one of three dropped before."""
    root = scratch_path(spark, "root")
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    for name, part in (("first", 1), ("second", 0), ("third", 1)):
        tables.append_distinct(keys.filter(F.col("o_orderkey") % 2 == part), f"{root}/{name}")
    tables.drop_table(spark, f"{root}/third")
    sizes = [tables.read_table(spark, f"{root}/{n}").select(F.lit(n).alias("title")) for n in tables.list_tables(spark, root)]
    return frames.union_all(*sizes).groupBy("title").agg(F.count(F.lit(1)).alias("n_rows"))


@query("append_distinct_folders", LEDGER + """SELECT DISTINCT CASE WHEN season > 1996 THEN season END AS season, winner, day FROM ledger""")
def _append_folders(spark, sf_dir):
    """Partitions by two columns with missing values, filled in batches that share some."""
    target = scratch_path(spark, "folders")
    games = views.ledger(spark, sf_dir).select(F.when(F.col("season") > 1996, F.col("season")).alias("season"), "winner", "day")
    for batch in (games.filter("season IS NULL OR season < 1999"), games.filter("season IS NULL OR season > 1997"), games.filter("winner IS NULL")):
        tables.append_distinct(batch, target, partition_by=["season", "winner"])
    return tables.read_table(spark, target, games.schema)


@query("season_worklist", LEDGER + """SELECT season AS season_start, season + 1 AS season_end, title,
      'https://example.org/all_matches/' || path || '-' || season || '-' || (season + 1) || '/' AS url, n_games
    FROM (SELECT season, COUNT(*) AS n_games FROM ledger GROUP BY season) AS s,
         (VALUES ('First', 'first-league'), ('Second', 'second-league')) AS l(title, path)""")
def _worklist(spark, sf_dir):
    games = views.ledger(spark, sf_dir)
    first, last = games.agg(F.min("season"), F.max("season")).first()
    work = tables.season_worklist(
        spark, first, last + 1, {"First": "first-league", "Second": "second-league"}, "https://example.org")
    counts = games.groupBy(F.col("season").alias("season_start")).agg(F.count(F.lit(1)).alias("n_games"))
    return work.join(counts, "season_start").select("season_start", "season_end", "title", "url", "n_games")


@query("project", "SELECT o_orderkey, o_orderstatus FROM orders")
def _project(spark, sf_dir):
    return table(spark, sf_dir, "orders").drop("o_totalprice").select("o_orderkey", "o_orderstatus")


@query("rename", "SELECT o_orderkey AS match_id, o_custkey AS side FROM orders")
def _rename(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").withColumnsRenamed(
        {"o_orderkey": "match_id", "o_custkey": "side"})


@query("prefix_columns", LEDGER + "SELECT contest_id, home_goals AS x_home_goals, away_goals AS x_away_goals FROM ledger")
def _prefix(spark, sf_dir):
    return frames.prefix_columns(views.ledger(spark, sf_dir).select("contest_id", "home_goals", "away_goals"),
                                 ["home_goals", "away_goals"], "x_")


@query("derive", LEDGER + """SELECT contest_id, 1 AS is_starting, home_goals - away_goals AS diff,
    home_goals + away_goals AS total, 'ledger' AS origin FROM ledger""")
def _derive(spark, sf_dir):
    return views.ledger(spark, sf_dir).withColumns({
        "is_starting": F.lit(1), "diff": F.col("home_goals") - F.col("away_goals"),
        "total": F.col("home_goals") + F.col("away_goals"), "origin": F.lit("ledger"),
    }).select("contest_id", "is_starting", "diff", "total", "origin")


@query("nested_case", LEDGER + """SELECT contest_id, CASE WHEN home_goals > 2 THEN 'many' WHEN home_goals > 0 THEN 'some'
    WHEN home_goals = 0 THEN 'none' END AS grade FROM ledger""")
def _case(spark, sf_dir):
    goals = F.col("home_goals")
    return views.ledger(spark, sf_dir).select(
        "contest_id", F.when(goals > 2, "many").when(goals > 0, "some").when(goals == 0, "none").alias("grade"))


@query("filter_range", LEDGER + """SELECT contest_id, season, winner FROM ledger
    WHERE season BETWEEN 1996 AND 1998 AND (winner <> 'Draw' OR home = 3)""")
def _filter(spark, sf_dir):
    return views.ledger(spark, sf_dir).filter(
        F.col("season").between(1996, 1998) & ((F.col("winner") != "Draw") | (F.col("home") == 3))
    ).select("contest_id", "season", "winner")


@query("distinct_players", f"WITH {views.LINEUP} SELECT DISTINCT player, team, season FROM lineup")
def _distinct(spark, sf_dir):
    return views.lineup(spark, sf_dir).select("player", "team", "season").distinct()


@query("fill_missing", LEDGER + """SELECT contest_id, day, COALESCE(home_goals, 0) AS home_goals,
    COALESCE(winner, '0') AS winner FROM ledger""")
def _fill(spark, sf_dir):
    return frames.fill_missing(views.ledger(spark, sf_dir).select("contest_id", "day", "home_goals", "winner"))


@query("fill_default", LEDGER + """SELECT contest_id, COALESCE(home_goals, 40) AS home_goals, away_goals,
    COALESCE(winner, ' ') AS winner FROM ledger""")
def _default(spark, sf_dir):
    games = views.ledger(spark, sf_dir).select("contest_id", "home_goals", "away_goals", "winner")
    return frames.fill_missing(games, num=40, text=" ", subset=["home_goals", "winner"])


@query("drop_incomplete", LEDGER + "SELECT contest_id, home_goals, winner FROM ledger WHERE home_goals IS NOT NULL AND winner IS NOT NULL")
def _incomplete(spark, sf_dir):
    return frames.drop_incomplete(views.ledger(spark, sf_dir).select("contest_id", "home_goals", "winner"))


@query("blank_to_null", """SELECT o_orderkey, NULLIF(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS status,
    o_orderpriority FROM orders""")
def _blank(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return frames.blank_to_null(table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), "o_orderpriority"))


@query("missing_flag", LEDGER + "SELECT contest_id, CAST(winner IS NULL AS INTEGER) AS unplayed FROM ledger")
def _missing(spark, sf_dir):
    return views.ledger(spark, sf_dir).select("contest_id", missing_flag("winner").alias("unplayed"))


@query("locf", """SELECT event_id, event_type, LAST_VALUE(mark IGNORE NULLS) OVER
      (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS mark
    FROM (SELECT event_id, event_type, CASE WHEN event_id % 5 = 2 THEN user_id END AS mark FROM events) AS t""")
def _locf(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 5 == 2, F.col("user_id")).alias("mark"))
    return frames.locf(marked, ["mark"], ["event_type"], ["event_id"])


@query("seed_first_row", LEDGER + """SELECT contest_id, season, CASE WHEN ROW_NUMBER() OVER
    (PARTITION BY season ORDER BY day, contest_id) = 1 THEN 'first' ELSE winner END AS label FROM ledger""")
def _seed(spark, sf_dir):
    games = views.ledger(spark, sf_dir).select("contest_id", "season", "day", F.col("winner").alias("label"))
    return frames.seed_first_row(games, "label", "first", ["season"], ["day", "contest_id"]).drop("day")


@query("record_number", "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rec_no FROM orders")
def _number(spark, sf_dir):
    return frames.record_number(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query("record_number_texts", """SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderstatus
    ORDER BY CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority || '/' || o_custkey END NULLS FIRST, o_orderkey) AS rec_no FROM orders""")
def _number_texts(spark, sf_dir):
    """Rows in the order of texts, some missing, of groups that are cut into blocks of 2,000 rows."""
    text = F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 7 > 0, text).alias("text"))
    numbered = frames.record_number(rows, ["text", "o_orderkey"], group=["o_orderstatus"], block_rows=2_000)
    return numbered.select("o_orderkey", "rec_no")


@query("left_join_fixture", f"""WITH {views.LINEUP} SELECT l.contest_id, l.player, l.team, g.day, g.winner
    FROM lineup l LEFT JOIN (SELECT * FROM ledger WHERE season > 1996) g ON g.contest_id = l.contest_id""")
def _left(spark, sf_dir):
    games = views.ledger(spark, sf_dir).filter(F.col("season") > 1996).select("contest_id", "day", "winner")
    return views.lineup(spark, sf_dir).select("contest_id", "player", "team").join(games, "contest_id", "left")


@query("natural_left_join", LEDGER + """, n AS (SELECT season, winner, COUNT(*) AS games FROM ledger
      WHERE season > 1997 GROUP BY season, winner)
    SELECT l.contest_id, l.season, l.winner, n.games FROM ledger l LEFT JOIN n
    ON n.season = l.season AND n.winner IS NOT DISTINCT FROM l.winner""")
def _natural(spark, sf_dir):
    games = views.ledger(spark, sf_dir).select("contest_id", "season", "winner")
    counts = games.filter(F.col("season") > 1997).groupBy("season", "winner").agg(F.count(F.lit(1)).alias("games"))
    return frames.natural_left_join(games, counts)


@query("lookup_first", """SELECT c_custkey, (SELECT MIN_BY(o_orderpriority, o_orderkey) FROM orders
    WHERE o_custkey = c_custkey) AS first_priority FROM customer""")
def _lookup(spark, sf_dir):
    return frames.lookup_first(
        table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders"),
        {"c_custkey": "o_custkey"}, "o_orderpriority", ["o_orderkey"], "first_priority")


@query("join_complete", f"""WITH {views.LINEUP} SELECT l.contest_id, player, team, winner FROM lineup l
    JOIN ledger g ON g.contest_id = l.contest_id WHERE winner IS NOT NULL""")
def _complete(spark, sf_dir):
    return frames.join_complete(
        views.lineup(spark, sf_dir).select("contest_id", "player", "team"),
        views.ledger(spark, sf_dir).select("contest_id", "winner"), ["contest_id"])


@query("distinct_in_group", LEDGER + """SELECT home, season, COUNT(DISTINCT away) AS opponents,
    COUNT(DISTINCT winner) + MAX(CAST(winner IS NULL AS INTEGER)) AS results FROM ledger GROUP BY home, season""")
def _distinct_in(spark, sf_dir):
    return views.ledger(spark, sf_dir).groupBy("home", "season").agg(
        n_distinct("away").alias("opponents"), n_distinct("winner").alias("results"))


@query("median_in_group", """SELECT l_returnflag, l_linestatus, ROUND(MEDIAN(l_extendedprice), 6) AS price
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _median(spark, sf_dir):
    medians = frames.median_in(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "price")
    return medians.withColumn("price", F.round("price", 6))


@query("conditional_aggregates", LEDGER + """SELECT home, CAST(SUM(CASE WHEN winner = 'Home' THEN home_goals END) AS BIGINT)
      AS goals_in_wins, COUNT(CASE WHEN winner = 'Draw' THEN 1 END) AS draws,
      COALESCE(FLOOR((200 * SUM(CASE WHEN winner = 'Away' THEN home_goals END) + COUNT(CASE WHEN winner = 'Away' THEN 1 END))
        // (2 * COUNT(CASE WHEN winner = 'Away' THEN 1 END))) / 100.0, 0) AS goals_per_loss FROM ledger GROUP BY home""")
def _conditional(spark, sf_dir):
    return views.ledger(spark, sf_dir).groupBy("home").agg(
        sum_where("home_goals", F.col("winner") == "Home").alias("goals_in_wins"),
        count_where(F.col("winner") == "Draw").alias("draws"),
        mean_where("home_goals", F.col("winner") == "Away").alias("goals_per_loss"))


@query("frequency", LEDGER + "SELECT season, winner, COUNT(*) AS n FROM ledger GROUP BY season, winner")
def _frequency(spark, sf_dir):
    return frames.frequency(views.ledger(spark, sf_dir), "season", "winner")


@query("global_counts", """SELECT 'orders' AS table_name, COUNT(*) AS n_rows, 6 AS n_cols, COUNT(DISTINCT o_custkey) AS n_distinct
    FROM orders UNION ALL SELECT 'lineitem', COUNT(*), 11, COUNT(DISTINCT l_suppkey) FROM lineitem
    UNION ALL SELECT 'customer', COUNT(*), 5, NULL FROM customer""")
def _counts(spark, sf_dir):
    return frames.union_all(
        checks.table_shape(table(spark, sf_dir, "orders"), "orders", "o_custkey"),
        checks.table_shape(table(spark, sf_dir, "lineitem"), "lineitem", "l_suppkey"),
        checks.table_shape(table(spark, sf_dir, "customer"), "customer"))


@query("check_balanced", LEDGER + """SELECT MIN(n) AS smallest, MAX(n) AS largest, MIN(n) = MAX(n) AS balanced
    FROM (SELECT COUNT(*) AS n FROM ledger GROUP BY season) AS t""")
def _balanced(spark, sf_dir):
    return checks.check_balanced(views.ledger(spark, sf_dir), "season")


@query("coverage", """SELECT (SELECT COUNT(*) FROM customer) AS n_a, (SELECT COUNT(DISTINCT o_custkey) FROM orders) AS n_b,
    (SELECT COUNT(DISTINCT o_custkey) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS n_both""")
def _coverage(spark, sf_dir):
    return checks.coverage(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


@query("spot_check", f"""WITH {views.LINEUP} SELECT 'lineup' AS table_name, player, team, season, contest_id, CAST(NULL AS BIGINT) AS mins
      FROM lineup WHERE player = 7 AND season = 1998
    UNION ALL SELECT 'player_season', l_suppkey, CAST(l_suppkey % 10 + l_partkey % 2 AS INTEGER), CAST(YEAR(l_shipdate) AS INTEGER),
      NULL, l_linenumber FROM lineitem WHERE l_suppkey = 7 AND YEAR(l_shipdate) = 1998""")
def _spot(spark, sf_dir):
    seasons = views.player_season(spark, sf_dir).select("player", "team", "season", F.col("matches").cast("bigint").alias("mins"))
    return checks.spot_check(
        {"lineup": views.lineup(spark, sf_dir).select("player", "team", "season", "contest_id"), "player_season": seasons},
        (F.col("player") == 7) & (F.col("season") == 1998))


@query("sort_multi", LEDGER + "SELECT season, home, contest_id FROM ledger ORDER BY season, home, contest_id")
def _sort(spark, sf_dir):
    return frames.sort_rows(views.ledger(spark, sf_dir).select("season", "home", "contest_id"), "season", "home",
                            tie_break=["contest_id"])


@query("sort_desc", LEDGER + "SELECT season, contest_id FROM ledger ORDER BY season DESC, contest_id")
def _sort_desc(spark, sf_dir):
    return frames.sort_rows(views.ledger(spark, sf_dir).select("season", "contest_id"), F.col("season").desc(),
                            tie_break=["contest_id"])


@query("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 6")
def _first(spark, sf_dir):
    return frames.first_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 6, ["o_orderkey"])


@query("last_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 6")
def _last(spark, sf_dir):
    return frames.last_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 6, ["o_orderkey"])


@query("union_by_name", """SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price FROM customer
    UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part""")
def _union(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_retailprice").alias("price"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return frames.union_all(people, parts)
