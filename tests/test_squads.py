from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from contestlab.plans import squads
from tests.conftest import rows

LEAGUES = {"pl": "Pr League", "cl": "Ch League"}


@pytest.fixture(scope="module")
def player_season(spark):
    data = [
        ("x", 2012, "t", "Pr League", 10, 2, 10, 3, 4), ("x", 2012, "t", "Ch League", 4, 1, 4, 0, 0),
        ("x", 2013, "t", "Pr League", 20, 5, 20, 0, 0), ("x", 2015, "u", "Cup", 2, 0, 2, 0, 0),
        ("y-z", 2013, "t", "Pr League", 1, 1, 0, 1, 0), ("y-z", 2015, "t", None, 1, 0, 1, 0, 1),
    ]
    return spark.createDataFrame(
        data, "player string, season int, team string, league string, matches int, goals int, starts int, sub_in int, sub_out int")


def test_summary(player_season):
    got = {(r.player, r.season): r for r in squads.player_summary(player_season, LEAGUES).collect()}
    r = got["x", 2012]
    assert (r.diff_leagues, r.mins, r.pl_mins, r.cl_mins, r.goals, r.cl_goals) == (2, 880 + 360, 880, 360, 3, 1)
    assert got["y-z", 2015].diff_leagues == 1  # a missing league counts as one
    assert got["y-z", 2015].pl_mins == 0
    literal = squads.player_summary(player_season, LEAGUES, "literal").filter("player = 'y z' and season = 2013").first()
    assert literal.pl_mins == 0 and literal.mins == 20


def test_season_windows_bridge_a_gap(player_season):
    got = rows(squads.season_windows(player_season, 2, 2010, 2018))
    assert got == [(2012, 2012, 2013), (2013, 2012, 2013), (2013, 2013, 2015), (2015, 2013, 2015)]
    assert squads.season_windows(player_season, 4, 2010, 2018).count() == 0
    assert squads.season_windows(player_season, 2, 2013, 2013).count() == 0


def test_player_windows(player_season):
    summary = squads.player_summary(player_season, LEAGUES)
    got = {(r.player, r.window_end): r for r in squads.player_windows(summary, 2, 2010, 2018).collect()}
    r = got["x", 2013]
    assert (r.n_teams, r.window_matches, r.window_goals, r.window_pl_minutes) == (1, 17.0, 4.0, (880 + 1800) / 2)
    assert r.mins_league_share == round((880 + 1800) / (880 + 360 + 1800), 2)
    assert got["x", 2015].n_teams == 2
    literal = squads.player_windows(summary, 2, 2010, 2018, mode="literal").filter(
        "player = 'x' and window_end = 2013").first()
    assert literal.mins_league_share == r.mins_league_share / 2


def test_fixed_windows_need_both_spans(player_season):
    summary = squads.player_summary(player_season, LEAGUES)
    got = squads.fixed_windows(summary, (2012, 2013), 2013).orderBy("player").collect()
    assert [(r.player, r.window_goals, r.mr_window_goals) for r in got] == [("x", 8, 5), ("y-z", 1, 1)]
    assert [r.player for r in squads.fixed_windows(summary, (2012, 2012), 2013).collect()] == ["x"]


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(
        [(1, "t", "u", "Home"), (2, "u", "t", "Draw"), (3, "t", "u", None), (4, "t", "u", "Away")],
        "contest_id long, home string, away string, winner string")


@pytest.fixture(scope="module")
def lineup(spark):
    data = [(1, "x", "t", 2013, 1, " "), (2, "x", "t", 2013, 1, " "), (3, "x", "t", 2013, 1, " "),
            (4, "x", "t", 2013, 0, "70'"), (1, "y", "t", 2013, 0, " "), (1, "z", "u", 2013, 1, " ")]
    return spark.createDataFrame(
        data, "contest_id long, player string, team string, season int, is_starting int, subbed_time string")


def test_player_record(lineup, games):
    got = {r.player: tuple(r)[3:] for r in squads.player_record(lineup, games).collect()}
    assert got == {"x": (2.0, 1, 1, 0, 0.0, 0, 0, 1), "z": (0.0, 0, 0, 1, 0.0, 0, 0, 0)}
    literal = {r.player: tuple(r)[3:] for r in squads.player_record(lineup, games, "literal").collect()}
    # an unknown result counts three times and voids the average; an unused substitute is kept
    assert literal["x"] == (0.0, 2, 2, 1, 0.0, 0, 0, 1)
    assert literal["y"] == (0.0, 0, 0, 0, 3.0, 1, 0, 0)


def test_lineup_features_and_model_table(spark, lineup, games, player_season):
    windows = squads.player_windows(squads.player_summary(player_season, LEAGUES), 2, 2010, 2018)
    windows = windows.unionByName(windows.filter("player = 'x'").withColumn("player", F.lit("z")))
    feats = squads.lineup_features(lineup, windows)
    assert [(r.contest_id, r.team) for r in feats.orderBy("contest_id", "team").collect()] == [
        (1, "t"), (1, "u"), (2, "t"), (3, "t")]
    table = squads.match_model_table(games, feats)
    assert [(r.contest_id, r.winner) for r in table.collect()] == [(1, "Home")]
    assert len(table.columns) == 2 + 2 * 13
    any_window = squads.lineup_features(lineup, windows, on="name", starters_only=False)
    assert any_window.filter("contest_id = 4").count() == 1
    assert squads.lineup_features(lineup, windows, lag_seasons=1).count() == 0


def test_namesakes_stay_apart(spark):
    data = [("A Name", link, label, "t", "Pr League", 1, 1, 1, 0, 0) for link, label in
            (("/p/1", "2017"), ("/p/2", "2017"), ("/p/2", "2017/2018"))]
    statistics = spark.createDataFrame(
        data, "player_name string, player_link string, season string, team string, league string, matches int, goals int, starts int, sub_in int, sub_out int")
    summary = squads.player_summary(squads.player_season_of(statistics), LEAGUES)
    assert sorted((r.player_link, r.season_id, r.season, r.n_matches) for r in summary.collect()) == [
        ("/p/1", "2017", 2017, 1), ("/p/2", "2017", 2017, 1), ("/p/2", "2017/2018", 2017, 1)]
    assert [r.window_matches for r in squads.player_windows(summary, 1, 2010, 2018).collect()] == [3.0]


def test_literal_sums_are_lost_to_one_missing_value(spark):
    data = [("x", 2012, "t", "Pr League", 1, None, 1, 0, 0), ("x", 2012, "t", "Ch League", 2, 2, 2, 0, 0)]
    df = spark.createDataFrame(data, "player string, season int, team string, league string, matches int, goals int, starts int, sub_in int, sub_out int")
    literal, intended = (squads.player_summary(df, LEAGUES, m).first() for m in ("literal", "intended"))
    assert (literal.goals, literal.pl_goals, literal.cl_goals, literal.n_matches) == (0, 0, 2, 3)
    assert (intended.goals, intended.pl_goals, intended.cl_goals) == (2, 0, 2)


def test_all_windows_of_a_player_meet_its_line_ups_as_one_row(spark):
    lineup = spark.createDataFrame([(k % 7, f"t{k % 2}", None if k % 11 == 0 else f"p{k % 5}", 2013, 1) for k in range(60)] + [(9, None, "p1", 2013, 1)],
                                   "contest_id int, team string, player string, season int, is_starting int")
    windows = spark.createDataFrame(
        [(None if k % 6 == 5 else f"p{k % 6}", 2010 + k // 6, k % 4, None if k % 3 == 0 else k * 0.5, Decimal(k) / 4,
          None if k % 4 == 0 else float("nan") if k == 7 else (k * 7 % 10) / 10, None) for k in range(24)],
        "player string, window_end int, n int, mean double, whole decimal(10,2), a_share double, b_share double")
    got = squads.lineup_features(lineup, windows, on="name")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RepartitionByExpression [contest_id") < plan.index("Join") < plan.rindex("Aggregate [player")
    want = lineup.alias("l").join(windows.alias("w"), F.col("l.player").eqNullSafe(F.col("w.player"))).groupBy("contest_id", "team").agg(
        *[c.alias(n) for n, c in squads.lineup_measures(windows).items()])
    assert got.dtypes == want.dtypes
    assert str(rows(got)) == str(rows(want))
