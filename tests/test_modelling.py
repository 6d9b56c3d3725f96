"""Naive Bayes against numpy, the rounds of a search, the exact split and the store of models."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from contestlab.plans import modelling
from contestlab.plans.bayes import GaussianBayes
from contestlab.plans.network import Perceptron
from contestlab.registry import model_queries
from contestlab.session import scratch_path
from tests.conftest import rows

LEVELS = ["Away", "Draw", "Home"]


@pytest.fixture(scope="module")
def games(spark):
    rng = np.random.default_rng(7)
    data = []
    for k in range(2400):
        y = int(rng.integers(0, 3))
        data.append((k, LEVELS[y], float(rng.normal(y, 1)), None if k % 9 == 0 else int(rng.integers(0, 4) + y), float(1e9 + rng.normal(-y, 2)), 5.0))
    return spark.createDataFrame(data, "k long, winner string, a double, b int, c double, d double").repartition(5).cache()


FEATURES = ["a", "b", "c", "d"]


def expected(data, labels, asked):
    """Shares by numpy, missing numbers left out."""
    x, y = np.array([[np.nan if v is None else v for v in r] for r in data], float), np.array(labels)
    least = 1e-9 * max(np.nanvar(x, axis=0))
    out = []
    for row in np.array([[np.nan if v is None else v for v in r] for r in asked], float):
        logs = []
        for v in sorted(set(labels)):
            own = x[y == v]
            mean, var = np.nanmean(own, axis=0), np.nanvar(own, axis=0) + least
            logs.append(math.log((y == v).mean()) - np.nansum(0.5 * (np.log(2 * np.pi * var) + (row - mean) ** 2 / var)))
        part = np.exp(np.array(logs) - max(logs))
        out.append(part / part.sum())
    return np.array(out)


def test_bayes_equals_numpy(spark, games):
    train, test = games.filter("k % 4 > 0"), games.filter("k % 4 = 0")
    indexed, labels = modelling.label_index(train, "winner")
    model = modelling.pipeline(GaussianBayes(featuresCols=FEATURES), FEATURES).fit(indexed)
    got = modelling.score(model, test, labels, probabilities=True).orderBy("k").collect()
    known, asked = train.orderBy("k").collect(), test.orderBy("k").collect()
    want = expected([[r[c] for c in FEATURES] for r in known], [r.winner for r in known], [[r[c] for c in FEATURES] for r in asked])
    assert np.abs(np.array([[r.away, r.draw, r.home] for r in got]) - want).max() < 1e-6
    assert [r.predicted for r in got] == [LEVELS[i] for i in want.argmax(axis=1)]
    path = scratch_path(spark, "bayes")
    modelling.save_model(model, path)
    again = modelling.score(modelling.load_model(path), test, labels, probabilities=True)
    assert rows(again, "k") == rows(modelling.score(model, test, labels, probabilities=True), "k")


def test_bayes_with_weights_and_rare_classes(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (0, 3.0, 1.0), (1, 5.0, 2.0), (3, None, 2.0), (None, 9.0, 1.0), (1, 7.0, None)],
                               "label int, x double, w double")
    model = GaussianBayes(featuresCols=["x"], weightCol="w").fit(df)
    assert model.getOrDefault("shares") == [0.5, 0.25, 0.0, 0.25]
    assert model.getOrDefault("means")[:2] == [1.5, 5.0]
    scored = model.transform(spark.createDataFrame([(1.0,), (5.0,), (None,)], "x double")).collect()
    assert [r.prediction for r in scored] == [0.0, 1.0, 0.0] and scored[2].probability == pytest.approx([0.5, 0.25, 0.0, 0.25])
    nothing = GaussianBayes(featuresCols=["x"]).fit(df.limit(0))
    assert nothing.getOrDefault("shares") == []


def test_rounds_keep_to_the_budget():
    for n in (1, 2, 3, 4, 7, 16, 40):
        for size in (1, 900, 10**5, 10**9):
            for budget in (None, 10**4, 10**7):
                rounds = modelling.halving(n, size, budget)
                assert rounds[0].candidates == n and all(a.candidates > b.candidates and a.share <= b.share for a, b in zip(rounds, rounds[1:]))
                assert rounds[-1].candidates <= 2 and all(0 < r.share <= 1 for r in rounds)
                if budget is None:
                    assert rounds[-1].share == 1
                else:
                    floor = sum(r.candidates * min(size, 1000) for r in rounds)
                    assert sum(r.candidates * r.share * size for r in rounds) <= max(budget, 0) * 1.001 + floor


def test_search_is_the_same_however_the_rows_lie(games):
    candidates = {name: GaussianBayes(featuresCols=list(name)) for name in ("abc", "a", "d", "cd", "b")}
    full = games.na.fill(0, ["b"])
    one = modelling.search_models(full, "winner", FEATURES, "k", candidates=candidates, folds=2)
    two = modelling.search_models(full.repartition(3, "a"), "winner", FEATURES, "k", candidates=candidates, folds=2)
    assert rows(one.leaderboard) == rows(two.leaderboard) and rows(one.rounds) == rows(two.rounds)
    board = one.leaderboard.orderBy("rank").collect()
    assert board[0].model == "abc" and {r.status for r in board} == {"fitted"} and len(board) == 5 and one.complete
    rounds = one.rounds.collect()
    sizes = {r.round: (len([x for x in rounds if x.round == r.round]), r.rows) for r in rounds}
    assert [sizes[i][0] for i in (1, 2, 3)] == [5, 3, 2] and sizes[1][1] < sizes[2][1] < sizes[3][1] == 2400
    kept = {i: {r.model for r in rounds if r.round == i and r.kept} for i in (1, 2, 3)}
    assert kept[1] == {r.model for r in rounds if r.round == 2} and kept[2] == {r.model for r in rounds if r.round == 3} and kept[3] == {"abc"}
    assert modelling.accuracy(modelling.score(one.best, full, one.labels)).first()[0] > 0.6


def test_every_candidate_is_judged_on_all_rows_where_no_budget_asks_for_less(spark, games, monkeypatch):
    candidates = {name: GaussianBayes(featuresCols=list(name)) for name in ("abc", "a", "d", "cd", "b")}
    found = modelling.search_models(games, "winner", FEATURES, "k", candidates=candidates, folds=2, halve=False)
    assert rows(found.rounds.select("round", "rows", "kept")) == [(1, 2400, False)] * 4 + [(1, 2400, True)]
    board = found.leaderboard.orderBy("rank").collect()
    assert board[0].model == "abc" and [r.rows for r in board] == [2400] * 5 and found.complete
    assert [r.accuracy for r in board] == sorted((r.accuracy for r in board), reverse=True)
    for limit in ({"budget_rows": 10}, {"budget_seconds": 5}):
        with pytest.raises(ValueError, match="budget"):
            modelling.search_models(games, "winner", FEATURES, "k", candidates=candidates, halve=False, **limit)
    # the query's own candidates, over its own rows
    orders = spark.range(3000).selectExpr("id AS contest_id", "concat('T', id % 3) AS winner", *[f"(id * {i + 3}) % 7 AS {c}" for i, c in enumerate(model_queries.FEATURES)])
    own = {name: GaussianBayes(featuresCols=model_queries.FEATURES[i:i + 2]) for i, name in enumerate("pqrs")}
    searched = []
    plain = modelling.search_models
    monkeypatch.setattr(model_queries, "_halves", lambda *_: (orders, None))
    monkeypatch.setattr(modelling, "search_models", lambda *a, **b: searched.append(plain(*a, candidates=own, **b)) or searched[-1])
    assert rows(model_queries._leaderboard(spark, None)) == [(name, "fitted", True) for name in "pqrs"]
    assert {r.rows for r in searched[0].leaderboard.collect()} == {3000} and searched[0].rounds.count() == 4


def test_samples_of_later_rounds_hold_the_earlier_ones(games):
    number = modelling.sample_number("k", 456)
    got = games.select("k", (number < 2**31).alias("half"), (number < 2**30).alias("quarter")).collect()
    assert all(r.half for r in got if r.quarter) and 400 < sum(r.quarter for r in got) < sum(r.half for r in got) < 1400


def test_a_clock_ends_the_search_after_a_round(games):
    candidates = {name: GaussianBayes(featuresCols=list(name)) for name in ("a", "d", "c")}
    found = modelling.search_models(games, "winner", FEATURES, "k", candidates=candidates, folds=2, budget_seconds=0)
    assert not found.complete and found.leaderboard.count() == 3 and {r.round for r in found.rounds.collect()} == {1}
    small = modelling.search_models(games, "winner", FEATURES, "k", candidates=candidates, folds=2, budget_rows=10)
    assert small.complete and max(r.rows for r in small.rounds.collect()) < 1200


def test_rows_without_a_label_are_left_out(games):
    holes = games.withColumn("winner", F.when(F.col("k") % 5 > 0, F.col("winner")))
    found = modelling.search_models(holes, "winner", FEATURES, "k", candidates={"a": GaussianBayes(featuresCols=["a"])}, folds=2, balance=True)
    assert found.labels == LEVELS and found.rounds.first().rows == 1920


@pytest.mark.parametrize("edge_rows", [100_000, 2])
def test_split_reads_the_input_twice(spark, monkeypatch, edge_rows):
    monkeypatch.setattr(modelling, "EDGE_ROWS", edge_rows)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(20_000).mapInArrow(counted, "id long")
    split = modelling.split_exact(df, 0.37, "id", 3)
    assert read.value == 40_000
    assert split.filter("is_train").count() == 7400
    order = sorted((r.h, r.id) for r in spark.range(20_000).select(modelling.key_hash("id", 3).alias("h"), "id").collect())
    assert {r.id for r in split.filter("is_train").collect()} == {i for _, i in order[:7400]}


def test_split_of_few_rows_and_edges(spark):
    for n, frac, want in ((0, 0.5, 0), (1, 0.9, 1), (1, 0.1, 0), (3, 0.5, 2), (5, 1.0, 5), (5, 0.0, 0)):
        assert modelling.split_exact(spark.range(n), frac, "id", 1).filter("is_train").count() == want


def test_store_keeps_versions_and_checks_tables(spark, games):
    store = scratch_path(spark, "store")
    indexed, labels = modelling.label_index(games.na.fill(0, ["b"]), "winner")
    with pytest.raises(ValueError, match="no version"):
        modelling.open_model(spark, store)
    for n, features in enumerate((["a"], ["b", "c"]), 1):
        plan = modelling.pipeline(LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=5), features)
        assert modelling.store_model(plan.fit(indexed), store, games, features, labels) == n
    latest, first = modelling.open_model(spark, store), modelling.open_model(spark, store, 1)
    assert (latest.version, latest.features, latest.labels) == (2, {"b": "int", "c": "double"}, LEVELS)
    assert first.features == {"a": "double"}
    full = games.na.fill(0, ["b"])
    assert latest.score(full, probabilities=True).columns[-4:] == ["predicted", "away", "draw", "home"]
    assert modelling.accuracy(first.score(full)).first()[0] > 0.4
    with pytest.raises(ValueError, match="b is bigint, not int"):
        latest.score(full.withColumn("b", F.col("b").cast("long")))
    with pytest.raises(ValueError, match="c is missing"):
        latest.score(full.drop("c"))
    with pytest.raises(ValueError, match="no version 9"):
        modelling.open_model(spark, store, 9)
    folders = [s.getPath().getName() for s in modelling.folder(spark, store)[0].listStatus(modelling.folder(spark, store)[1])]
    assert sorted(folders) == ["version=1", "version=2"]


def test_the_perceptron_descends_over_packed_rows_that_count_alike(spark):
    draw = np.random.default_rng(7)
    x, y = draw.normal(size=(41, 3)), draw.integers(0, 3, 41)
    rows_of = [(Vectors.dense(v), float(c)) for v, c in zip(x, y)]
    few, most = (spark.createDataFrame(part, ["scaled", "label"]).coalesce(1) for part in (rows_of[:2], rows_of[2:]))
    data = few.union(most)
    fit = modelling.perceptron(3, 3, hidden=(4,), epochs=0, rate=0.5, seed=5)
    weights = fit.fit(data).weights.toArray()
    for _ in range(6):
        a, b, c, d = weights[:12].reshape(3, 4).T, weights[12:16], weights[16:28].reshape(4, 3).T, weights[28:]
        inner = 1 / (1 + np.exp(-(x @ a.T + b)))
        outer = np.exp(inner @ c.T + d)
        delta = outer / outer.sum(axis=1, keepdims=True) - np.eye(3)[y]
        back = delta @ c * inner * (1 - inner)
        slopes = [(back.T @ x).T.ravel(), back.sum(axis=0), (delta.T @ inner).T.ravel(), delta.sum(axis=0)]
        weights = weights - 0.5 * np.concatenate(slopes) / len(y)
    model = fit.copy({fit.maxIter: 6}).fit(data)
    assert isinstance(fit, Perceptron) and isinstance(model, MultilayerPerceptronClassificationModel)
    assert model.getLayers() == [3, 4, 3]
    np.testing.assert_allclose(model.weights.toArray(), weights, atol=1e-5)
    path = scratch_path(spark, "network")
    modelling.save_model(PipelineModel(stages=[model]), path)
    kept = modelling.load_model(path).transform(data).select("prediction").collect()
    assert kept == model.transform(data).select("prediction").collect()


def test_a_search_fits_no_more_models_than_it_judges(spark, games, monkeypatch):
    fitted, plain = [], GaussianBayes._fit
    monkeypatch.setattr(GaussianBayes, "_fit", lambda self, rows: fitted.append(rows.count()) or plain(self, rows))
    found = modelling.search_models(games, "winner", FEATURES, "k", candidates={c: GaussianBayes(featuresCols=[c]) for c in FEATURES[:2]}, folds=3)
    assert len(fitted) == 2 * 3 + 1 and fitted[-1] == games.count()  # every fold once, and the best on all rows
    assert sum(fitted[:3]) == sum(fitted[3:6]) == 2 * games.count()
    with pytest.raises(ValueError, match="fold"):
        modelling.search_models(games.limit(1), "winner", FEATURES, "k", candidates={"a": GaussianBayes(featuresCols=["a"])})
    assert found.complete
