import re
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from contestlab import schemas
from contestlab.plans import ingest, matches, modelling, squads
from contestlab.session import scratch_path
from contestlab.sources import html, tables
from tests.conftest import rows


def test_append_distinct_is_idempotent(spark):
    target = scratch_path(spark, "t")
    assert not tables.table_exists(spark, target)
    first = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    second = spark.createDataFrame([("b", None), ("c", 3), ("c", 3)], "k string, n int")
    want = sorted([("a", 1), ("b", None), ("c", 3)], key=repr)
    tables.append_distinct(first, target)
    for _ in range(2):
        tables.append_distinct(second, target)
        assert rows(tables.read_table(spark, target, first.schema)) == want
    assert tables.table_exists(spark, target)


def test_append_by_key_and_partition(spark):
    target = scratch_path(spark, "t")
    one = spark.createDataFrame([(2018, "a", 1), (2018, "a", 2), (2019, "b", 1)], "season int, k string, n int")
    tables.append_distinct(one, target, keys=["season", "k"], partition_by=["season"])
    tables.append_distinct(one.withColumn("n", F.lit(9)).union(one.limit(1).withColumn("season", F.lit(2020))),
                           target, keys=["season", "k"], partition_by=["season"])
    assert rows(tables.read_table(spark, target, one.schema).select("season", "k", "n")) == [
        (2018, "a", 1), (2019, "b", 1), (2020, "a", 1)]
    plan = tables.read_table(spark, target, one.schema, where=F.col("season") == 2018, columns=["k"])
    assert "PartitionFilters: [isnotnull(season" in plan._jdf.queryExecution().executedPlan().toString()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_append_reads_only_the_partitions_it_touches(spark):
    target = scratch_path(spark, "t")
    schema = "season int, league string, n int"
    stored = spark.range(2000).select((F.col("id") % 20).cast("int").alias("season"), F.when(F.col("id") % 3 > 0, "x").alias("league"),
                                      F.col("id").cast("int").alias("n"))
    stored = stored.union(spark.createDataFrame([(None, None, 1), (None, "x", 2)], schema))
    tables.append_distinct(stored, target, partition_by=["season", "league"])
    batch = spark.createDataFrame([(3, "x", 43), (3, "x", -1), (None, None, 1), (None, "x", 3), (30, None, 1), (4, "", 24), (4, None, 24)], schema)
    missing = tables.new_rows(batch, target, partition_by=["season", "league"])
    assert rows(missing) == sorted([(3, "x", -1), (None, "x", 3), (30, None, 1)], key=repr)
    plan = _plan(missing)
    assert plan.count("FileScan") == 1
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert re.search(r"season#\d+ IN \(", pruned) and "isnull(season" in pruned and "isnull(league" in pruned
    (Path(target) / "season=12" / "league=x" / "part-unreadable.parquet").write_bytes(b"PAR1 no table PAR1")  # whoever reads it fails
    for _ in range(2):
        tables.append_distinct(batch, target, partition_by=["season", "league"])
    others = F.col("season").isNull() | (F.col("season") != 12)
    assert tables.read_table(spark, target, stored.schema, where=others).count() == 1905


@pytest.mark.parametrize("limits", [{"PRUNED": 3}, {"HASHES": 0}, {"HASHES": 0, "BITMAP_ROWS": 0}, {"PRUNED": 3, "HASHES": 0}])
def test_append_of_large_batches_stores_the_same(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(tables, name, value)
    target = scratch_path(spark, "t")
    schema = "season int, k string, v double"
    old = [(i % 9, f"k{i}" if i % 5 else None, float(i)) for i in range(300)] + [(None, None, None), (1, "zero", 0.0), (1, "nan", float("nan"))]
    new = [(i % 9, f"k{i}" if i % 5 else None, float(i)) for i in range(200, 500)] + [(None, None, None), (1, "zero", -0.0), (1, "nan", float("nan"))]
    for batch in (old, new, new):
        tables.append_distinct(spark.createDataFrame(batch, schema), target, partition_by=["season"])
    got = tables.read_table(spark, target).count()
    assert got == 503


def test_bitmap_lets_all_known_and_few_other_rows_pass(spark, monkeypatch):
    monkeypatch.setattr(tables, "HASHES", 0)
    batch = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    stored = spark.range(500, 20_500).select(F.col("id").cast("string").alias("k"))
    passed = {int(r.k) for r in tables._perhaps_in(stored, batch, 1000, ["k"], bits=1 << 16).collect()}
    assert passed >= set(range(500, 1000)) and len(passed) < 1500


def test_keys_without_the_partition_column_are_compared_everywhere(spark):
    target = scratch_path(spark, "t")
    one = spark.createDataFrame([(2018, "a"), (2019, "b")], "season int, k string")
    tables.append_distinct(one, target, keys=["k"], partition_by=["season"])
    tables.append_distinct(one.withColumn("season", F.col("season") + 1), target, keys=["k"], partition_by=["season"])
    assert rows(tables.read_table(spark, target, one.schema).select("season", "k")) == [(2018, "a"), (2019, "b")]


def test_catalog_append_compares_as_stored(spark):
    tables.append_distinct(spark.createDataFrame([(1, "a"), (None, None)], "n long, t string"), "stored_as", partition_by=["t"])
    try:
        tables.append_distinct(spark.createDataFrame([("a", 1), ("", None), ("b", 2)], "t string, n int"), "stored_as", partition_by=["t"])
        assert rows(tables.read_table(spark, "stored_as").select("n", "t")) == sorted([(1, "a"), (2, "b"), (None, None)], key=repr)
    finally:
        tables.drop_table(spark, "stored_as")


def test_list_and_drop(spark):
    root = scratch_path(spark, "root")
    for name in ("x", "y"):
        spark.range(2).write.parquet(f"{root}/{name}")
    assert tables.list_tables(spark, root) == ["x", "y"]
    tables.drop_table(spark, f"{root}/x")
    assert tables.list_tables(spark, root) == ["y"]
    spark.range(3).write.mode("overwrite").saveAsTable("kept")
    assert tables.table_exists(spark, "kept") and "kept" in tables.list_tables(spark)
    assert tables.read_table(spark, "kept", where=F.col("id") > 0).count() == 2
    tables.drop_table(spark, "kept")
    assert not tables.table_exists(spark, "kept")


@pytest.mark.parametrize("sep", [",", "~"])
def test_delimited_roundtrip(spark, sep):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, 'a,"b"~c', date(2020, 1, 2)), (2, "", None), (3, None, None), (4, "x\ny", None)],
                               "i int, t string, d date")
    tables.write_csv(df, path, sep=sep)
    assert rows(tables.read_csv(spark, path, df.schema, sep=sep, multi_line=True)) == rows(df)


HARD = ["NA", "", None, "a\nb", "\r\n", "\n", "\\", "\\N", "\\n", "\\\\n", "\\\n", "\\\\\n", "\\0", "\x00", "a\x00\\", " x ", "\t", '"', '""', ',"', '"a,b"', "~", "#c",
        "null", "\\N\\N", "é 日本 😀", "'", "x" * 20_000, "\u2028\x85", "\\\r", "NaN"]


@pytest.mark.parametrize("sep", [",", "~", "\t"])
def test_every_text_survives_the_defaults(spark, sep):
    path = scratch_path(spark, "csv")
    data = [(i, t, HARD[-1 - i], None if i % 3 else i / 7, datetime(2020, 1, 2, 3, 4, 5, 123456 + i), None if i % 2 else 10**15 + i) for i, t in enumerate(HARD)]
    df = spark.createDataFrame(data, "i int, t string, u string, d double, at timestamp_ntz, n long").withColumn("z", F.col("at").cast("timestamp"))
    tables.write_csv(df.repartition(2), path, sep=sep)
    back = tables.read_csv(spark, path, df.schema, sep=sep)
    assert rows(back) == rows(df)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:  # files are split between lines, as no field breaks one
        parts = tables.read_csv(spark, path, df.schema, sep=sep)
        assert parts.rdd.getNumPartitions() > 10 and rows(parts) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_marker_of_missing_values_is_for_other_programs(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, "a\\n", 2.5), (2, None, None), (3, "", 0.0), (4, "NA", 1.0)], "i int, t string, d double")
    tables.write_csv(df.coalesce(1), path, missing="NA")
    text = next(Path(path).glob("part-*.csv")).read_text()
    assert text == 'i,t,d\n1,a\\n,2.5\n2,NA,NA\n3,"",0.0\n4,NA,1.0\n'
    assert rows(tables.read_csv(spark, path, df.schema, missing="NA")) == rows(df.withColumn("t", F.nullif("t", F.lit("NA"))))


def test_worklist(spark):
    got = tables.season_worklist(spark, 2017, 2019, {"First": "one", "Second": "two"}, "https://example.org")
    assert rows(got.select("season_start", "season_end", "title")) == [
        (2017, 2018, "First"), (2017, 2018, "Second"), (2018, 2019, "First"), (2018, 2019, "Second")]
    assert got.first().url == "https://example.org/all_matches/one-2017-2018/"
    with pytest.raises(ValueError):
        tables.season_worklist(spark, 2019, 2019, {}, "")


PAGE = """<html><table><tr><th>a<th>b</tr><tr><td> 1 <td>x<br>y</tr><tr><td colspan=2>wide</td></tr></table>
<p>text & <table><tr><td>outer<table><tr><td>inner</td></tr></table>tail</td><td>2</td><td>3</td></tr><tr><td>s</tr></table>
<table></table><table><tr><td>open"""


def test_html_tables(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "v", None), (3, "w", "no table")], schemas.PAGES)
    got = rows(html.html_tables(pages), "table_no", "row_no")
    assert got == [
        (1, 1, 1, ["1", "x\ny"], 2), (1, 1, 2, ["wide", "wide"], 2),
        (1, 2, 1, ["outertail", "2", "3"], 2), (1, 2, 2, ["s", None, None], 2),
        (1, 3, 1, ["inner"], 1), (1, 5, 1, ["open"], 1)]


def test_html_tables_odd_markup(spark):
    page = """<!-- <table><tr><td>no</td></tr></table> --><script>"<table><tr><td>no"</script>
      <TABLE class='a>b'><tr><td title="x > y" colspan = '2'>a &lt; b &amp;c <b>bold</b> 1 < 2</td><td>z</TD></tr>
      <tr><th>h<td 5">q<!-- gone --></tr></TABLE></table>"""
    got = rows(html.html_tables(spark.createDataFrame([(1, "u", page)], schemas.PAGES)), "row_no")
    assert got == [(1, 1, 1, ["a < b &c bold 1 < 2"] * 2 + ["z"], 2), (1, 1, 2, ["h", "q", None], 2)]


def table(*lines):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in lines) + "</table>"


def test_fixtures_golden(spark):
    head = ["1. Round"] * 8
    page = table(
        ["18/08/2017", "", "A & B", "-", "C D", "2:1 (1:0)", "", ""], ["", "15:00", "E", "-", "F", "10:0 (4:0)", "", ""],
        ["2. Round"] * 8, ["25/08/2017", "", "F", "-", "E", "", "", ""])
    pages = spark.createDataFrame([(1, "s1", page), (2, "s2", table(head))], schemas.PAGES)
    work = spark.createDataFrame([("s1", 2017, 2018, "First", "one"), ("s2", 2017, 2018, "Second", "two")],
                                 "url string, season_start int, season_end int, title string, path string")
    got = ingest.fixtures_from_pages(pages, work, as_of=date(2017, 8, 20)).orderBy("day", "home_team").collect()
    assert [(r.home_team, r.day, r.round_no, r.ft_home, r.winner, r.has_finished) for r in got] == [
        ("A & B", date(2017, 8, 18), 1, 2, "Home", 1), ("E", date(2017, 8, 18), 1, 10, "Home", 1),
        ("F", date(2017, 8, 25), 2, None, None, 0)]
    assert got[0].match_id == "https://example.org/report/one-2017-2018-A-B-C-D/"
    assert got[0].asDict().keys() == set(schemas.FIXTURE.fieldNames())
    literal = ingest.fixtures_from_pages(pages, work, as_of=date(2017, 8, 20), mode="literal").filter("home_team = 'E'").first()
    assert (literal.ft_home, literal.ft_away) == (1, None) and "first-league" in literal.match_id


def squad(n, bench_after):
    lines = [[str(i), f"Ann Ó'Dea-{i}\n46", "70'" if i == 12 else ""] for i in range(1, n + 1)]
    lines.insert(bench_after, ["Substitutes"] * 3)
    return table(*lines)


def test_lineups_golden(spark):
    pages = spark.createDataFrame(
        [(1, "m1", squad(13, 11) + table(["x"]) + squad(12, 11)), (2, "m2", squad(13, 11)), (3, "m3", "")], schemas.PAGES)
    games = spark.createDataFrame([(f"m{i}", "Home T", "Away T", "2017/2018") for i in (1, 2, 3)],
                                  "match_id string, home_team string, away_team string, season_id string")
    got = ingest.lineups_from_pages(pages, games)
    assert got.count() == 25
    assert rows(got.groupBy("team", "is_home", "is_starting").count()) == [
        ("Away T", 0, 0, 1), ("Away T", 0, 1, 11), ("Home T", 1, 0, 2), ("Home T", 1, 1, 11)]
    r = got.filter("number = '12' and is_home = 1").first()
    assert (r.player, r.subbed_time, r.match_id) == ("Ann ÓDea", "70'", "m1")
    assert r.player_link == "https://example.org/player_summary/Ann-Ó'Dea-12/2/"
    assert r.player_key == "Ann ÓDea_Home T_2017/2018"


def test_lineups_shuffle_and_sort_tables_not_players(spark):
    """Rows of a table meet only after the join; repeated pages, page numbers, addresses, games and numbers give each row once."""
    odd = table(*[["7", "Same", ""]] * 11, [" 8", "Two &amp; B "], ["Substitutes"] * 3, ["9", "Sub", "Sub"])
    pages = spark.createDataFrame(
        [(1, "m1", squad(13, 11) + squad(12, 11))] * 2 + [(2, "m2", odd + table(["x"]) + odd), (3, "m2", squad(12, 5) + odd)] +
        [(4, "m3", odd), (4, "m4", table(["x"]) + odd.replace("7", "5")), (None, "m5", odd + odd), (None, "m6", odd), (6, None, odd + odd),
         (7, "m7", odd + odd + odd), (8, "m8", None)], schemas.PAGES)
    games = spark.createDataFrame([(f"m{i}", "H", "A", "2017/2018") for i in range(1, 9)] + [("m1", "H", "B", "2017/2018"), (None, "H", "A", "s")],
                                  "match_id string, home_team string, away_team string, season_id string")
    got = ingest.lineups_from_pages(pages, games)
    by_row = html.tables_by_shape(html.html_tables(pages, with_url=True), 11, 21)
    by_table = html.table_columns(pages, ["number", "player", "subbed_time"], 11, 21, with_url=True)
    again = by_table.select("page_id", "table_no", F.posexplode(F.arrays_zip("number", "player", "subbed_time")), "n_rows", "url").select(
        "page_id", "table_no", F.col("pos") + 1, F.array("col.number", "col.player", "col.subbed_time"), "n_rows", "url")
    cells = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.get("cells", i))
    assert rows(again) == rows(by_row.select("page_id", "table_no", "row_no", cells, "n_rows", "url")) and again.count() > 100
    flat = html.flag_after_marker(html.name_columns(html.require_tables(by_row, 2), ingest.LINEUP_COLUMNS),
                                  F.col("subbed_time").startswith("Sub"), "is_starting")
    players = flat.filter("number != 'Substitutes'").join(games.withColumnRenamed("match_id", "url"), "url")
    want = players.selectExpr("number", "is_starting", "if(nth = 1, home_team, away_team) team", "int(nth = 1) is_home", "url", "player").distinct()
    assert rows(got.select("number", "is_starting", "team", "is_home", "match_id")) == rows(want.drop("player"))
    assert {r.match_id for r in got.select("match_id").collect()} == {"m1", "m2", "m3", "m4", "m5", "m6"}
    exploded, _, below = _plan(got).partition("Generate posexplode")
    assert "Window" in below and "Window" not in exploded and "array<string>" in by_table.schema.simpleString()


def test_lineups_are_never_broadcast(spark):
    """The planner takes texts and arrays of stored tables for a few bytes, so that lists that grow with the pages looked small enough for
    the driver."""
    pages = spark.createDataFrame([(i, f"m{i}", squad(13, 11) + squad(12, 11)) for i in (1, 2)] + [(None, None, squad(13, 11) * 2)], schemas.PAGES)
    games = spark.createDataFrame([(f"m{i}", "H", "A", "2017/2018") for i in (1, 1, 2)] + [(None, "H", "A", "s")],
                                  "match_id string, home_team string, away_team string, season_id string")
    stored = []
    for df in (pages, games):
        stored.append(scratch_path(spark, "t"))
        df.write.parquet(stored[-1])
    got = ingest.lineups_from_pages(*map(spark.read.parquet, stored))
    plan = _plan(got)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert rows(got.groupBy("match_id", "is_home").count()) == [("m1", 0, 12), ("m1", 1, 13), ("m2", 0, 12), ("m2", 1, 13)]


def test_biographies_and_statistics(spark):
    bio = table(["Born:", "12/05/1990"], ["Place:", "x"], ["Nationality:", "Spain"], ["Height:", "180 cm"],
                ["Weight:", "75 kg"], ["Position:", "Left Back"], ["Foot:", "left"])
    late = table(["Fact:", "x"], *[["Born:", "01/02/1991"]] + [["l", "v"]] * 5)  # Born not first, too short
    stats = table(["", "Cup!", "2017/2018", "T", "3", "1", "2", "1", "0", "0", "0", "-"])
    link = "https://example.org/player_summary/{}/2/".format
    pages = spark.createDataFrame(
        [(1, link("Al-Bo"), bio + stats), (2, link("Cy"), late), (3, link("Dee"), "")], schemas.PAGES)
    people = spark.createDataFrame([(p, t, "2017/2018") for p in ("Al Bo", "Cy", "Dee") for t in ("T", "U")],
                                   "player string, team string, season_id string")
    got = {(r.player, r.team): r for r in ingest.biographies_from_pages(pages, people).collect()}
    assert len(got) == 6
    r = got["Al Bo", "U"]
    assert (r.dob, r.country, r.height_cm, r.weight_kg, r.position, r.foot, r.field_position) == (
        date(1990, 5, 12), "Spain", 180.0, 75.0, "Left Back", "left", "Defense")
    assert got["Cy", "T"].dob is None and got["Cy", "T"].field_position == "Other"
    seasons = ingest.season_stats_from_pages(pages, people).collect()
    assert len(seasons) == 1
    s = seasons[0]
    assert (s.league, s.season, s.matches, s.red, s.player_name) == ("Cup", "2017/2018", 3, None, "Al-Bo")


def test_pages_to_model_table(spark):
    """From stored pages of one season to the table a model is trained on."""
    season = table(["18/08/2017", "", "A", "-", "B", "2:1 (1:0)", "", ""])[:-8] + table(
        ["2. Round"] * 8, ["25/08/2017", "", "B", "-", "A", "", "", ""])[7:]
    base = "https://example.org"
    report = f"{base}/report/one-2017-2018-A-B/"
    stats = table(*[["", c, s, "T", "3", "1", "2", "1", "0", "0", "0", "0"]
                    for c, s in (("Cup", "2016/2017"), ("Pr League", "2016/2017"), ("Pr League", "2017/2018"))])
    names = [f"{base}/player_summary/Ann-Ó'Dea-{i}/2/" for i in range(1, 14)]
    pages = spark.createDataFrame(
        [(1, "s", season), (2, report, squad(13, 11) + squad(12, 11))], schemas.PAGES)
    work = spark.createDataFrame([("s", 2017, 2018, "First", "one")],
                                 "url string, season_start int, season_end int, title string, path string")
    fixtures = ingest.fixtures_from_pages(pages, work, as_of=date(2018, 1, 1))
    lineups = ingest.lineups_from_pages(pages, fixtures)
    people = lineups.select("player", "team", "season_id").distinct()
    link = ingest.BASE + "/player_summary/Ann-ÓDea/2/"
    statistics = ingest.season_stats_from_pages(
        spark.createDataFrame([(3, link, stats), (4, names[0], stats)], schemas.PAGES), people)
    summary = squads.player_summary(squads.player_season_of(statistics), {"pl": "Pr League", "cl": "Ch League"})
    windows = squads.player_windows(summary, 2, 2016, 2018)
    ledger = matches.ledger_of(fixtures)
    feats = squads.lineup_features(squads.lineup_of(lineups), windows)
    got = squads.match_model_table(ledger, feats).collect()
    assert [(r.contest_id, r.winner, r.home_lineup_n_teams) for r in got] == [(report, "Home", 1.0)]
    rows_ = matches.match_features(ledger).orderBy("round_no").collect()
    assert [(r.round_no, r.winner, r.home_points_before, r.away_points_before) for r in rows_] == [
        (1, "Home", None, None), (2, None, 0, 3)]
    literal = matches.match_features(ledger, "literal")
    assert rows(literal.select("round_no", "winner")) == [(1, "Home"), (2, "0")]
    assert matches.training_set(literal).count() == 1


def test_split_exact_and_hash(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    split = modelling.split_exact(df, 0.9, "k", 456).cache()
    assert split.count() == 1003 and split.filter("is_train").count() == 903
    again = modelling.split_exact(df.repartition(7), 0.9, "k", 456)
    assert again.exceptAll(split).count() == 0
    assert abs(modelling.split_hash(df, 0.8, "k", 1).filter("is_train").count() - 802) < 60
    assert modelling.split_exact(df, 1.0, "k", 1).filter("is_train").count() == 1003


def test_evaluation_golden(spark):
    pred = spark.createDataFrame([("Home", "Home"), ("Home", "Away"), ("Away", "Away"), ("Draw", "Home")],
                                 "winner string, predicted string")
    assert modelling.accuracy(pred).first()[0] == 0.5
    assert modelling.accuracy(pred, mode="literal").first()[0] is None
    table_ = modelling.confusion_matrix(pred, ["Away", "Draw", "Home"])
    assert rows(table_) == [("Away", 1, 0, 0), ("Draw", 0, 0, 1), ("Home", 1, 0, 1)]
    assert modelling.mean_per_class_error(pred).first()[0] == pytest.approx(0.5)
    weights = {r.winner: r.weight for r in modelling.class_weights(pred, "winner").collect()}
    assert weights == {"Home": 4 / 6, "Away": 4 / 3, "Draw": 4 / 3}
    indexed, labels = modelling.label_index(pred.filter("winner != 'Draw'"), "winner")
    assert labels == ["Away", "Home"] and {(r.winner, r.label) for r in indexed.collect()} == {("Away", 0.0), ("Home", 1.0)}


@pytest.fixture(scope="module")
def separable(spark):
    return spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
        F.get(F.array(F.lit("Away"), F.lit("Draw"), F.lit("Home")), (F.col("id") % 3).cast("int")).alias("winner")).cache()


def test_search_score_and_save(spark, separable):
    candidates = {
        "good": LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=20),
        "none": LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=0),
    }
    found = modelling.search_models(separable, "winner", ["x", "y"], "k", candidates=candidates,
                                    metric="mean_per_class_error", folds=2, balance=True)
    board = found.leaderboard.orderBy("rank").collect()
    assert [r.model for r in board] == ["good", "none"] and board[0].mean_per_class_error == 0
    scored = modelling.score(found.best, separable, found.labels, probabilities=True)
    assert modelling.accuracy(scored).first()[0] == 1.0
    assert scored.filter(F.abs(F.col("home") + F.col("draw") + F.col("away") - 1) > 1e-9).count() == 0
    path = scratch_path(spark, "model")
    modelling.save_model(found.best, path)
    again = modelling.score(modelling.load_model(path), separable, found.labels)
    assert modelling.accuracy(again).first()[0] == 1.0


def test_log_result_is_kept_once(spark):
    target = scratch_path(spark, "log")
    result = spark.createDataFrame([(0.35,)], "accuracy double")
    for day in (date(2020, 2, 1), date(2020, 2, 1), date(2020, 2, 3)):
        tables.log_result(result, target, "windows", day)
    assert rows(tables.read_table(spark, target, tables.MODEL_RESULT)) == [
        ("windows", 0.35, "2020-02-01"), ("windows", 0.35, "2020-02-03")]


@pytest.mark.parametrize("page, wanted", [
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "b"], ["a", "c"]]),
    ("<table><tr><td>a<td rowspan='3' colspan=2>b</tr><tr><td>c</tr><tr></tr><tr><td>d</table>",
     [["a", "b", "b"], ["c", "b", "b"], [None, "b", "b"], ["d", None, None]]),
    ("<table><tr><td rowspan=0>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>", [["a", "b"], ["a", "c"], ["a", "d"]]),
])
def test_spanning_cells_are_repeated(spark, page, wanted):
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert [r.cells for r in html.html_tables(df).orderBy("row_no").collect()] == wanted


def test_spans_are_clamped_and_the_address_comes_along(spark):
    page = "<table><tr><td colspan=99999999>a</td></tr></table>"
    row = html.html_tables(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"), with_url=True).first()
    assert len(row.cells) == 1000 and row.url == "u"


def test_append_to_a_catalog_table(spark):
    a, b = spark.createDataFrame([("a", 1), ("b", None)], "k string, p int"), spark.createDataFrame([("b", None), ("c", 1), ("c", 1)], "k string, p int")
    for batch in (a, a, b):
        tables.append_distinct(batch, "appended_rows", partition_by=["p"])
    assert tables.table_exists(spark, "appended_rows")
    assert rows(tables.read_table(spark, "appended_rows").select("k", "p")) == sorted([("a", 1), ("b", None), ("c", 1)], key=repr)
    tables.drop_table(spark, "appended_rows")
    assert not tables.table_exists(spark, "appended_rows")


def test_rows_without_a_label_have_no_weight(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "y string")
    assert rows(modelling.class_weights(df, "y")) == sorted([("a", 0.75), ("a", 0.75), ("b", 1.5), (None, None)], key=repr)


def test_split_marks_the_exact_number(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for frac in (0.0, 0.123, 0.5, 1.0):
        assert modelling.split_exact(df, frac, "k", 1).filter("is_train").count() == round(1000 * frac)
    plan = modelling.split_exact(df, 0.5, "k", 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Range") == 1


def test_a_search_over_the_default_candidates(spark):
    df = spark.createDataFrame([(i, float(i % 5), "ab"[i % 2], "xy"[i % 3 > 0]) for i in range(60)], "k long, n double, y string, t string")
    found = modelling.search_models(df, "y", ["n", "t"], "k", folds=2, balance=True)
    board = found.leaderboard.orderBy("rank").collect()
    assert [r["rank"] for r in board] == [1, 2, 3, 4] and {r.status for r in board} == {"fitted"} and found.complete
    assert {r.model for r in board} == {"logistic_regression", "random_forest", "boosted_trees", "perceptron"}
    unseen = spark.createDataFrame([(1, 0.0, "a", "new"), (2, 0.0, "a", None)], df.schema)
    assert {r.predicted for r in modelling.score(found.best, unseen, found.labels).collect()} <= {"a", "b"}


def test_fixture_plan_reads_the_pages_once_and_shuffles_them_once(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "s1", "<table></table>")], schemas.PAGES).write.parquet(path)
    work = spark.createDataFrame([("s1", 2017, 2018, "First", "one")], "url string, season_start int, season_end int, title string, path string")
    plan = ingest.fixtures_from_pages(spark.read.parquet(path), work)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(page_id" in x]) == 1


def _read(page, **options):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([page])], ["page_id", "html"])
    yield from html._reader(**options)([batch])


WIDE = "<table>" + "<tr>" + "<td colspan=1000 rowspan=65534>x</td>" * 1000 + "</tr>" + "<tr></tr>" * 6000 + "</table>"
DEEP = "<table><tr><td rowspan=65534>x<td colspan=1000 rowspan=65534>y</tr>" + "<tr></tr>" * 6000 + "<tr><td>end</table>"


@pytest.mark.parametrize("page", [WIDE, DEEP, WIDE + DEEP])
def test_wide_spans_need_little_memory(page):
    import tracemalloc

    assert 50_000 < len(page) < 300_000
    tracemalloc.start()
    n = sum(b.num_rows for b in _read(page))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n > 0 and most < 200e6


def test_spans_beyond_the_budget_are_not_repeated(spark):
    page = table(["a", "b"]) + "<table><tr><td colspan=40>c<td>d</tr><tr><td>e</tr></table>" + table(["f"])
    df = spark.createDataFrame([(1, "u", page)], schemas.PAGES)
    full = [(r.table_no, r.cells, r.n_rows) for r in html.html_tables(df).orderBy("table_no", "row_no").collect()]
    assert full == [(1, ["a", "b"], 1), (2, ["c"] * 40 + ["d"], 2), (2, ["e"] + [None] * 40, 2), (3, ["f"], 1)]
    bare = [(r.table_no, r.cells, r.n_rows) for r in html.html_tables(df, page_cells=20).orderBy("table_no", "row_no").collect()]
    assert bare == [(1, ["a", "b"], 1), (2, ["c", "d"], 2), (2, ["e", None], 2), (3, ["f"], 1)]


def test_large_tables_are_streamed_like_small_ones():
    page = "<table><tr><th>h<th>i</tr>" + "".join(f"<tr><td rowspan={1 + i % 3}>{i}<td>b{i}</tr>" for i in range(3000)) + "</table>"
    small = [r for b in _read(page) for r in b.to_pylist()]
    streamed = [r for b in _read(page, batch_cells=50) for r in b.to_pylist()]
    assert small == streamed and {r["n_rows"] for r in small} == {len(small)} and len(small) == 3000
    assert len({len(r["cells"]) for r in small}) == 1


@pytest.mark.parametrize("page", [
    table(["a", "b &amp; c"], ["", " d "]), "<p>a < b</p>" + table(["x"]) + "text" + table(["1", "2"], ["3"]),
    "<table><tr><th>h</th><th>i</th></tr>\n<tr id=\"r\"> <td class=\"x\" colspan=\"2\">Substitutes</td></tr></table>",
    "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr><tr></tr></table>",
    "<table><tr><td colspan=40>a</td><td>b</td></tr><tr><td>don't</td></tr></table>", "<table></table>",
    "<table><tr><td title=\"</tr>\">a</td></tr></table>", "<table><tr><td a\"=\"b>c</td></tr></table>" + table(["\""]),
])
def test_plain_pages_read_like_any_other(page):
    for options in ({}, {"page_cells": 12}):
        plain = [r for b in _read(page, **options) for r in b.to_pylist()]
        tagged = [r for b in _read("<!-- read tag by tag -->" + page, **options) for r in b.to_pylist()]
        assert plain == tagged


def test_plain_pages_are_not_read_tag_by_tag():
    def seconds(page):
        took = []
        for _ in range(5):
            began = time.process_time()
            assert sum(b.num_rows for b in _read(page)) == 20_000
            took.append(time.process_time() - began)
        return min(took)

    page = table(*[[str(i), "name", ""] for i in range(20_000)])
    assert seconds(page) < 0.6 * seconds("<!-- read tag by tag -->" + page)
