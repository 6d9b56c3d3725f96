import random
import statistics

import pytest
from pyspark.sql import functions as F

from contestlab.operators import checks, frames
from tests.conftest import rows


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([("a", 1, None), ("a", 2, "x"), (None, 3, ""), ("b", None, "y")], "k string, n int, t string")


def test_missing_values(small):
    assert rows(frames.fill_missing(small)) == sorted(
        [("a", 1, "0"), ("a", 2, "x"), ("0", 3, ""), ("b", 0, "y")], key=repr)
    assert frames.fill_missing(small, num=40, subset=["n"]).filter("n = 40").count() == 1
    assert frames.drop_incomplete(small).count() == 1
    assert frames.drop_incomplete(small, ["k"]).count() == 3
    assert frames.blank_to_null(small).filter("t is null").count() == 2


def test_seed_first_row(small):
    got = frames.seed_first_row(small, "t", "first", ["k"], ["n"])
    assert rows(got) == sorted([("a", 1, "first"), ("a", 2, "x"), (None, 3, "first"), ("b", None, "first")], key=repr)


def test_joins_match_missing_with_missing(spark, small):
    extra = spark.createDataFrame([("a", 10), (None, 30)], "k string, v int")
    got = frames.natural_left_join(small, extra)
    assert sorted((r.n or 0, r.v) for r in got.collect() if r.v) == [(1, 10), (2, 10), (3, 30)]
    assert got.count() == 4
    with pytest.raises(ValueError):
        frames.natural_left_join(small, extra.toDF("x", "y"))
    assert rows(frames.join_complete(small, extra, ["k"]).select("n", "v")) == [(2, 10)]  # a missing key is incomplete


def test_lookup_first_keeps_the_row_count(spark, small):
    ref = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("z", 1, "no")], "key string, at int, v string")
    got = frames.lookup_first(small, ref, {"k": "key"}, "v", ["at"])
    assert got.count() == 4
    assert {(r.k, r.v) for r in got.collect()} == {("a", "early"), (None, None), ("b", None)}


def test_prior_period(spark):
    df = spark.createDataFrame([("a", 2018, 7)], "team string, season int, total int")
    assert rows(frames.prior_period(df, ["team"], "season", "total", "prior")) == [("a", 2019, 7)]


def test_resolve_candidate(spark):
    keys = spark.createDataFrame([("p", "t1"), ("q", "t2")], "player string, team string")
    cands = spark.createDataFrame(
        [("p", "t1", i, f"p{i}") for i in (1, 2, 3)] + [("q", "t2", i, f"q{i}") for i in (1, 2)],
        "player string, team string, ordinal int, url string")
    seen = spark.createDataFrame([("p3", "t1"), ("p2", "t1"), ("p2", "t1"), ("q2", "t9")], "url string, team string")
    got = frames.resolve_candidate(keys, cands, seen, key=["player"], on=["team"])
    assert rows(got.select("player", "url_to_use")) == [("p", "p2"), ("q", "q1")]


def test_union_order_and_counts(spark, small):
    both = frames.union_all(small, small.select(F.col("n").alias("m"), "k"))
    assert both.columns == ["k", "n", "t", "m"] and both.count() == 8
    assert [r.n for r in frames.first_n(small, 2, [F.col("n").asc_nulls_last()]).collect()] == [1, 2]
    assert [r.n for r in frames.last_n(small, 2, ["n"]).collect()] == [2, 3]
    assert rows(frames.frequency(small, "k")) == sorted([("a", 2), ("b", 1), (None, 1)], key=repr)


def test_contingency_keeps_zero_cells(spark):
    df = spark.createDataFrame([("H", "H"), ("H", "A"), ("A", "A"), ("D", "H")], "label string, pred string")
    got = frames.contingency(df, "label", "pred", ["A", "D", "H"], row_levels=["A", "D", "H"])
    assert rows(got) == [("A", 1, 0, 0), ("D", 0, 0, 1), ("H", 1, 0, 1)]


@pytest.mark.parametrize("direct_rows", [10_000, 40])
def test_median_narrowed_equals_direct(spark, direct_rows):
    rng = random.Random(1)
    data = [("hot", rng.choice([rng.random() * 100, 50.5, -3.25])) for _ in range(1501)]
    data += [("even", float(i)) for i in range(100)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.m for r in frames.median_in(df, ["k"], "v", "m", cells=8, direct_rows=direct_rows).collect()}
    assert got == {"hot": statistics.median(v for k, v in data if k == "hot"), "even": 49.5, "one": 4.0, "none": None}


def test_checks(spark, small):
    assert tuple(checks.check_balanced(small, "k").first()) == (1, 2, False)
    assert tuple(checks.table_shape(small, "small", "k").first()) == ("small", 4, 3, 2)
    other = spark.createDataFrame([("b",), ("c",)], "z string")
    assert tuple(checks.coverage(small, other, "k", "z").first()) == (2, 2, 1)
    assert checks.spot_check({"a": small, "b": small.select("k")}, F.col("k") == "a").count() == 4
