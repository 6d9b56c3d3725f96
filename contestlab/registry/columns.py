"""Queries for the scalar expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contestlab import functions as fn
from contestlab.registry import query, views
from contestlab.registry.views import table

LEDGER = f"WITH {views.LEDGER} "


@query("make_keys", LEDGER + """SELECT contest_id, home || '_' || season || '_' || COALESCE(winner, 'NA') AS key
    FROM ledger""")
def _keys(spark, sf_dir):
    return views.ledger(spark, sf_dir).select("contest_id", fn.key_of("home", "season", "winner").alias("key"))


@query("season_short", LEDGER + """SELECT contest_id, season || '/' || (season + 1) AS short,
    CAST(season AS VARCHAR) AS start FROM ledger""")
def _short(spark, sf_dir):
    long_name = F.concat(fn.season_label("season"), F.lit(" "), F.coalesce("winner", F.lit("open")))
    return views.ledger(spark, sf_dir).select(
        "contest_id", F.substring(long_name, 1, 9).alias("short"), F.substring(long_name, 1, 4).alias("start"))


@query("slug", """SELECT c_custkey, REPLACE(REPLACE(name, ' ', '-'), '&-', '') AS slug,
      'https://example.org/report/2017-2018-' || REPLACE(REPLACE(name, ' ', '-'), '&-', '') || '-' ||
      REPLACE(c_name, ' ', '-') || '/' AS report
    FROM (SELECT *, c_mktsegment || ' & Sons of ' || c_name AS name FROM customer) AS t""")
def _slug(spark, sf_dir):
    named = table(spark, sf_dir, "customer").withColumn(
        "name", F.concat("c_mktsegment", F.lit(" & Sons of "), "c_name"))
    return named.select(
        "c_custkey", fn.slug("name").alias("slug"),
        fn.report_id("https://example.org/report/", F.lit(2017), F.lit(2018), "name", "c_name").alias("report"))


@query("replace_first", """SELECT doc_id, REGEXP_REPLACE(text, '-', ' ') AS text,
    REGEXP_REPLACE(source || '-' || lang || '-x', '-', ' ') AS label FROM documents""")
def _replace_first(spark, sf_dir):
    label = F.concat_ws("-", "source", "lang", F.lit("x"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.replace_first("text", "-", " ").alias("text"), fn.replace_first(label, "-", " ").alias("label"))


@query("clean_text", r"""SELECT doc_id, REGEXP_REPLACE(text, '[\r\n\t]', '', 'g') AS one_line,
      REGEXP_REPLACE(text, '\p{P}', '', 'g') AS no_marks, REGEXP_REPLACE(text, '[0-9]+', '', 'g') AS no_digits,
      TRIM(REGEXP_REPLACE(REGEXP_REPLACE(REGEXP_REPLACE(REPLACE(REGEXP_REPLACE(text, '[\r\n\t]', '', 'g'),
        '-', ' '), '\p{P}', '', 'g'), '[0-9]+', '', 'g'), ' +', ' ', 'g')) AS name FROM documents""")
def _clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.strip_control("text").alias("one_line"), fn.strip_punct("text").alias("no_marks"),
        fn.strip_digits("text").alias("no_digits"), fn.normalise_name("text").alias("name"))


@query("contains_ci", """SELECT doc_id, CONTAINS(LOWER(text), 'the') AS has_the,
    CONTAINS(LOWER(text), 'license') AS has_license FROM documents""")
def _contains(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.contains_ci("text", "The").alias("has_the"), fn.contains_ci("text", "LICENSE").alias("has_license"))


@query("split_key", LEDGER + """SELECT contest_id, CAST(home AS VARCHAR) AS first_piece,
    COALESCE(winner, 'NA') AS third_piece, CAST(NULL AS VARCHAR) AS fifth_piece FROM ledger""")
def _split(spark, sf_dir):
    keyed = views.ledger(spark, sf_dir).withColumn("key", fn.key_of("home", "season", "winner"))
    return keyed.select("contest_id", fn.piece("key", "_", 1).alias("first_piece"),
                        fn.piece("key", "_", 3).alias("third_piece"), fn.piece("key", "_", 5).alias("fifth_piece"))


# Position words, combined by order key for the classifier queries.
POSITIONS = ["Central Midfielder", "Left Back", "Right Winger", "Forward", "Goalkeeper", "Coach"]

POSITION_SQL = """positions AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN
    w[CAST(o_orderkey % 6 AS INTEGER) + 1] || ', ' || w[CAST(o_custkey % 6 AS INTEGER) + 1] END AS position FROM orders,
    (SELECT ['Central Midfielder', 'Left Back', 'Right Winger', 'Forward', 'Goalkeeper', 'Coach'] AS w) AS words)"""


def positions(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in POSITIONS])
    text = F.concat(F.get(words, (F.col("o_orderkey") % 6).cast("int")), F.lit(", "),
                    F.get(words, (F.col("o_custkey") % 6).cast("int")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, text).alias("position"))


CLASS_SQL = """CASE WHEN position LIKE '%Midfielder%' AND position LIKE '%Back%' THEN 'Defense and Midfield'
    WHEN position LIKE '%Midfielder%' AND (position LIKE '%Winger%' OR position LIKE '%Forward%') THEN 'Midfield and Attack'
    WHEN position LIKE '%Winger%' OR position LIKE '%Forward%' THEN 'Attack'
    WHEN position LIKE '%Midfielder%' THEN 'Midfielder' WHEN position LIKE '%Back%' THEN 'Defense'
    WHEN position LIKE '%keeper%' THEN 'Goalkeeper' ELSE 'Other' END"""


@query("classify_rules", f"WITH {POSITION_SQL} SELECT o_orderkey, position, {CLASS_SQL} AS class FROM positions")
def _classify(spark, sf_dir):
    return positions(spark, sf_dir).withColumn("class", fn.field_position("position"))


@query("parse_measure", """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL
    ELSE CAST(150 + c_custkey % 60 AS DOUBLE) END AS height, CAST(c_custkey % 97 AS DOUBLE) AS plain FROM customer""")
def _measure(spark, sf_dir):
    text = F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(
        F.concat((F.col("c_custkey") % 60 + 150).cast("string"), F.lit(" cm")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.parse_measure(text, " cm").alias("height"),
        fn.parse_measure((F.col("c_custkey") % 97).cast("string")).alias("plain"))


@query("to_text", LEDGER + """SELECT contest_id, STRFTIME(day, '%d/%m/%Y') AS day_text,
    CAST(season AS VARCHAR) AS season_text FROM ledger""")
def _text(spark, sf_dir):
    return views.ledger(spark, sf_dir).select(
        "contest_id", fn.to_text("day", "dd/MM/yyyy").alias("day_text"), fn.to_text("season").alias("season_text"))


@query("parse_date", LEDGER + """SELECT contest_id, CASE WHEN contest_id % 7 <> 0 THEN day END AS day,
    day AS birthday FROM ledger""")
def _date(spark, sf_dir):
    texts = views.ledger(spark, sf_dir).select(
        "contest_id",
        F.when(F.col("contest_id") % 7 != 0, fn.to_text("day", "dd/MM/yyyy")).otherwise("no day").alias("a"),
        fn.to_text("day", "ddMMyyyy").alias("b"))
    return texts.select("contest_id", fn.parse_date("a").alias("day"), fn.parse_date("b", "ddMMyyyy").alias("birthday"))


@query("year_of", LEDGER + "SELECT contest_id, CAST(YEAR(day) AS INTEGER) AS year FROM ledger")
def _year(spark, sf_dir):
    return views.ledger(spark, sf_dir).select("contest_id", F.year("day").alias("year"))


@query("has_finished", LEDGER + """SELECT contest_id, CAST(day < DATE '1999-07-15' AS INTEGER) AS finished,
    CAST(STRFTIME(day, '%d/%m/%Y') < '15/07/1999' AS INTEGER) AS finished_literal FROM ledger""")
def _finished(spark, sf_dir):
    as_of = date(1999, 7, 15)
    return views.ledger(spark, sf_dir).select(
        "contest_id", fn.has_finished("day", as_of).alias("finished"),
        fn.has_finished("day", as_of, "literal").alias("finished_literal"))


SCORES = """scores AS (SELECT contest_id, home_goals * 5 AS fh, away_goals AS fa, home_goals * 2 AS hh, 0 AS ha,
    (home_goals * 5) || ':' || away_goals || ' (' || (home_goals * 2) || ':0)' AS score FROM ledger)"""


def _int(at: int) -> str:
    return f"TRY_CAST(SUBSTR(score, {at}, 1) AS INTEGER)"


@query("parse_score", f"""WITH {views.LEDGER}, {SCORES} SELECT contest_id, score, fh AS ft_home, fa AS ft_away,
    hh AS ht_home, CASE WHEN score IS NOT NULL THEN ha END AS ht_away, {_int(1)} AS lit_ft_home,
    {_int(3)} AS lit_ft_away, {_int(6)} AS lit_ht_home, {_int(8)} AS lit_ht_away FROM scores""")
def _score(spark, sf_dir):
    text = F.concat((F.col("home_goals") * 5).cast("string"), F.lit(":"), F.col("away_goals").cast("string"),
                    F.lit(" ("), (F.col("home_goals") * 2).cast("string"), F.lit(":0)"))
    scored = views.ledger(spark, sf_dir).select("contest_id", text.alias("score")).withColumns(
        {"s": fn.parse_score("score"), "t": fn.parse_score("score", "literal")})
    names = ["ft_home", "ft_away", "ht_home", "ht_away"]
    return scored.select("contest_id", "score", *[f"s.{n}" for n in names], *[F.col(f"t.{n}").alias(f"lit_{n}") for n in names])


@query("winner", LEDGER + "SELECT contest_id, winner, home_goals - away_goals AS diff FROM ledger")
def _winner(spark, sf_dir):
    return views.ledger(spark, sf_dir).select(
        "contest_id", fn.winner("home_goals", "away_goals").alias("winner"),
        fn.goal_diff("home_goals", "away_goals").alias("diff"))


@query("points", LEDGER + """SELECT contest_id, CASE winner WHEN 'Home' THEN 3 WHEN 'Draw' THEN 1 WHEN 'Away' THEN 0 END
    AS home_points, CASE winner WHEN 'Home' THEN 0 WHEN 'Draw' THEN 1 WHEN 'Away' THEN 3 END AS away_points FROM ledger""")
def _points(spark, sf_dir):
    return views.ledger(spark, sf_dir).select(
        "contest_id", fn.points("winner", F.lit(True)).alias("home_points"),
        fn.points("winner", F.lit(False)).alias("away_points"))


@query("rounding", """SELECT l_orderkey, l_linenumber, l_quantity, ROUND(l_quantity / 8, 2) AS half_up,
    ROUND_EVEN(l_quantity / 8, 2) AS half_even FROM lineitem""")
def _rounding(spark, sf_dir):
    eighth = F.col("l_quantity") / 8
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", fn.round_to(eighth, 2).alias("half_up"),
        fn.round_to(eighth, 2, "literal").alias("half_even"))


@query("season_label", LEDGER + """SELECT contest_id, season || '/' || (season + 1) AS label, season AS start,
    (season + 1) || '/' || (season + 2) AS next_label FROM ledger""")
def _label(spark, sf_dir):
    label = fn.season_label("season")
    return views.ledger(spark, sf_dir).select(
        "contest_id", label.alias("label"), fn.season_start(label).alias("start"),
        fn.next_season_label(label).alias("next_label"))
