"""Joins on hot keys: the rows of a plain join, dealt evenly."""

import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contestlab.operators.joins import hot_keys, salted_join
from contestlab.plans import squads


@pytest.fixture(scope="module")
def appearances(spark):
    """One player has half of all rows, an unknown one an eighth."""
    player = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 8 == 1, None).otherwise(F.col("id") % 900)
    return spark.range(40_000).select(
        F.col("id").alias("contest_id"), player.cast("int").alias("player"), (F.col("id") % 3 + 2000).cast("int").alias("season")).cache()


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(p, s, float((p or 0) + s)) for p in [None, *range(0, 1200, 3), 7] for s in (2000, 2001)]
    return spark.createDataFrame(rows, "who int, year int, fact double").cache()


def plain(appearances, facts, how):
    known = {}
    for r in facts.collect():
        known.setdefault((r.who, r.year), []).append(r.fact)
    out = Counter()
    for r in appearances.collect():
        found = known.get((r.player, r.season), [None] if how == "left" else [])
        out.update((r.contest_id, r.player, r.season, f) for f in found)
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [None, 10**9, 2000, 500])
def test_rows_are_those_of_a_plain_join(appearances, facts, how, hot_rows):
    got = salted_join(appearances, facts, {"player": "who", "season": "year"}, how=how, hot_rows=hot_rows)
    assert got.columns == ["contest_id", "player", "season", "fact"]
    assert Counter(map(tuple, got.collect())) == plain(appearances, facts, how)


def test_hot_keys_are_found_with_their_counts(appearances):
    hot = hot_keys(appearances, ["player"], 2000)
    hashes = {r.player: r.h for r in appearances.select("player", F.xxhash64("player").alias("h")).distinct().collect()}
    assert hot == {hashes[7]: 11, hashes[None]: 3}  # 20,014 and 5,000 rows
    assert hot_keys(appearances.limit(0), ["player"], 10) == {}


def test_tasks_are_even(spark, appearances, facts):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = {}
        for hot_rows in (None, 300):
            joined = salted_join(appearances, facts.dropDuplicates(["who"]).drop("year"), {"player": "who"}, hot_rows=hot_rows)
            parts = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
            sizes[hot_rows] = [r.n for r in parts]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sizes[None]) > 5 * statistics.median(sizes[None])  # as it is without
    assert max(sizes[300]) < 2 * statistics.median(sizes[300])


def test_names_on_both_sides_are_refused(appearances, facts):
    with pytest.raises(ValueError, match="season"):
        salted_join(appearances, facts.withColumnRenamed("fact", "season"), {"player": "who"})
    with pytest.raises(ValueError, match="no full join"):
        salted_join(appearances, facts, {"player": "who"}, how="full")


@pytest.mark.parametrize("on", ["season", "name"])
def test_line_ups_of_a_hot_player(spark, on):
    lineup = spark.createDataFrame(
        [(i, "hot" if i % 2 else f"p{i % 30}", "t" if i % 4 < 2 else "u", 2001 + i % 3, 1) for i in range(600)],
        "contest_id long, player string, team string, season int, is_starting int")
    windows = spark.createDataFrame(
        [(p, y, n, n * 1.5, round(n / 90, 2)) for n, p in enumerate(["hot", *(f"p{i}" for i in range(30))]) for y in (2001, 2002, 2003)],
        "player string, window_end int, n_teams long, window_goals double, goals_league_share double")
    want = squads.lineup_features(lineup, windows, on, hot_rows=None)
    got = squads.lineup_features(lineup, windows, on, hot_rows=20)
    assert got.columns == ["contest_id", "team", "lineup_n_teams", "lineup_window_goals", "lineup_goals_league_share"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() == 600
