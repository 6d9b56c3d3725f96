from datetime import date, timedelta
import random

import pytest
from pyspark.sql import functions as F

from contestlab.operators import sides as ops
from contestlab.plans import matches
from tests.conftest import rows

START = date(2018, 8, 1)


def season_of(spark, pts, season=2018, team="a"):
    data = [(f"{season}-{i}", START + timedelta(days=7 * i + 365 * (season - 2018)), season, team, 1, None, p)
            for i, p in enumerate(pts)]
    return spark.createDataFrame(
        data, "contest_id string, day date, season int, team string, is_home int, winner string, pts int")


@pytest.fixture(scope="module")
def ledger(spark):
    """Two seasons of a round robin of six sides, some matches unplayed, two sides replaced."""
    rng, data, n = random.Random(3), [], 0
    for season in (2018, 2019):
        teams = ["a", "b", "c", "d", "e" if season == 2018 else "g", "f" if season == 2018 else "h"]
        for rnd in range(10):
            order = teams[:1] + [teams[1:][(i + rnd) % 5] for i in range(5)]
            for h, a in ((order[0], order[5]), (order[1], order[4]), (order[2], order[3])):
                n += 1
                open_ = season == 2019 and rnd >= 8
                day = START + timedelta(days=365 * (season - 2018) + 7 * rnd + rng.randint(0, 2))
                data.append((n, day, season, h, a, None if open_ else rng.choice(["Home", "Away", "Draw"]), rnd + 1))
    return spark.createDataFrame(
        data, "contest_id long, day date, season int, home string, away string, winner string, round_no int").cache()


def test_points_and_form_golden(spark):
    df = season_of(spark, [3, 1, 0, 3, 3, 0])
    intended = ops.side_scan(df).orderBy("day").collect()
    assert [r.running_points for r in intended] == [3, 4, 4, 7, 10, 10]
    assert [r.points_before for r in intended] == [None, 3, 4, 4, 7, 10]
    assert [r.form for r in intended] == [0, 3, 4, 4, 7, 10]
    assert [r.form for r in ops.form(df, games=4).orderBy("day").collect()] == [0, 3, 4, 4, 7, 7]
    assert [r.form for r in ops.form(df, mode="literal").orderBy("day").collect()] == [0, 3, 4, 4, 3, 4]


def test_missing_result(spark):
    df = season_of(spark, [3, None, 1])
    assert [r.running_points for r in ops.running_points(df).orderBy("day").collect()] == [3, 3, 4]
    assert [r.running_points for r in ops.running_points(df, "literal").orderBy("day").collect()] == [3, None, None]


def test_season_end_and_carried_total(spark):
    df = season_of(spark, [3, 1, 0, 3])
    literal = ops.season_end(ops.side_scan(df, mode="literal"), "literal").orderBy("day").collect()
    assert [r.season_end for r in literal] == [None, 0, 1, 1]
    assert [r.season_end for r in ops.season_end(df).orderBy("day").collect()] == [0, 0, 0, 1]
    scanned = ops.side_scan(df, mode="literal")
    assert rows(ops.prior_season_points(scanned, "literal")) == [("a", 2019, 4)]
    assert rows(ops.prior_season_points(df)) == [("a", 2019, 7)]


@pytest.mark.parametrize("total, wanted", [(10, (1, 0)), (4, (0, 1)), (6, (0, 0))])
def test_race_flags_golden(spark, total, wanted):
    df = spark.createDataFrame([(5, total, None)], "seq int, running_points int, points_before int")
    got = ops.race_flags(df, as_of="after").first()
    assert (got.in_title_race, got.in_relegation_race) == wanted
    none = ops.race_flags(df).first()
    assert (none.in_title_race, none.in_relegation_race) == (0, 0)


def test_sides_invariants(ledger):
    unfolded = ops.sides(ledger)
    per_match = unfolded.groupBy("contest_id", "winner").agg(F.count("*").alias("n"), F.sum("pts").alias("p")).collect()
    assert all(r.n == 2 for r in per_match)
    assert all(r.p == {"Draw": 2, None: None}.get(r.winner, 3) for r in per_match)


def places(df):
    """League table by brute force: team totals before each day, dense rank from the top."""
    data = [r.asDict() for r in df.collect()]
    out = {}
    for r in data:
        table = {}
        for q in data:
            if q["season"] == r["season"]:
                table.setdefault(q["team"], 0)
                if q["day"] < r["day"]:
                    table[q["team"]] += q["pts"] or 0
        out[(r["contest_id"], r["team"])] = 1 + len({v for v in table.values() if v > table[r["team"]]})
    return out


def test_standing_is_the_league_table(ledger):
    unfolded = ops.sides(ledger)
    got = {(r.contest_id, r.team): r.standing for r in ops.standing(unfolded).collect()}
    assert got == places(unfolded)


def test_promoted_sides(ledger):
    feats = matches.match_features(ledger)
    assert feats.count() == 60
    second = feats.filter("season = 2019").collect()
    for r in second:
        assert (r.home_was_promo, r.home_prior_year == 40) == ((1, True) if r.home in "gh" else (0, r.home_prior_year == 40))
        assert r.away_was_promo == (1 if r.away in "gh" else 0)
    assert {r.home_was_promo for r in feats.filter("season = 2018").collect()} == {1}


@pytest.mark.parametrize("mode", ["intended", "literal"])
def test_features_same_when_seasons_are_cut(ledger, mode):
    plain = matches.match_features(ledger, mode)
    cut = matches.match_features(ledger, mode, block_rows=3)
    assert rows(plain, "contest_id") == rows(cut, "contest_id")


def test_features_do_not_depend_on_partitioning(spark, ledger):
    want = rows(matches.match_features(ledger), "contest_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert rows(matches.match_features(ledger.repartition(int(n), "winner")), "contest_id") == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_training_and_next_round(ledger):
    feats = matches.match_features(ledger).cache()
    train = matches.training_set(feats, drop_seasons=[2018])
    assert train.count() == 24
    upcoming = matches.next_round(feats, 9, drop_seasons=[2018])
    assert "winner" not in upcoming.columns
    assert upcoming.count() == feats.filter("season = 2019 and round_no = 9 and home_points_before != 0").count() > 0


def test_plan_has_no_cartesian_product_and_shares_the_side_shuffle(ledger):
    plan = matches.match_features(ledger, "literal")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scan = ops.side_scan(ops.sides(ledger))._jdf.queryExecution().executedPlan().toString()
    assert scan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in matches.match_features(ledger)._jdf.queryExecution().executedPlan().toString()


def test_a_postponed_match_counts_when_it_is_played(spark):
    games = spark.createDataFrame([
        (1, date(2019, 4, 1), 2018, "a", "b", "Home", 1, "L"),  # round 1, played in April
        (2, date(2018, 8, 8), 2018, "a", "c", "Draw", 2, "L"),
        (3, date(2019, 4, 9), 2018, "c", "a", None, 3, "L"),
    ], "contest_id long, day date, season int, home string, away string, winner string, round_no int, league string")
    got = {r.contest_id: r for r in matches.match_features(games).collect()}
    assert (got[2].home_points_before, got[2].home_form, got[2].round_no) == (None, 0, 2)
    assert (got[1].home_points_before, got[3].away_points_before, got[3].away_form) == (1, 4, 4)
    literal = {r.contest_id: r for r in matches.match_features(games, "literal").collect()}
    assert literal[2].home_points_before == 3  # there the round comes first


def test_leagues_are_kept_apart(spark):
    games = spark.createDataFrame([
        (1, date(2018, 8, 1), 2018, "a", "b", "Home", "one"), (2, date(2018, 8, 1), 2018, "x", "y", "Home", "two"),
        (3, date(2018, 8, 9), 2018, "x", "y", "Home", "two"), (4, date(2018, 8, 20), 2018, "a", "b", "Home", "one"),
        (5, date(2018, 8, 20), 2018, "x", "y", None, "two"), (6, date(2019, 8, 1), 2019, "a", "x", None, "two"),
    ], "contest_id long, day date, season int, home string, away string, winner string, league string")
    got = {r.contest_id: r for r in matches.match_features(games).collect()}
    assert (got[4].home_standing, got[4].away_standing) == (1, 2)  # not behind x, which has more points elsewhere
    assert (got[6].home_was_promo, got[6].away_was_promo, got[6].away_prior_year) == (1, 0, 6)


def test_match_features_run_few_jobs_while_the_plan_is_built(spark, ledger):
    ledger = spark.createDataFrame(ledger.collect(), ledger.schema)  # filling a cache would be a job of its own
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "match features")
    plan = matches.match_features(ledger)._jdf.queryExecution().executedPlan().toString()
    jobs = len(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4
    assert plan.count("Exchange hashpartitioning") <= 12
