"""Splitting, training, scoring and evaluating classifiers of the match result."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

from contestlab.operators.frames import contingency
from contestlab.plans.bayes import GaussianBayes
from contestlab.plans.network import Perceptron
from contestlab.session import pinned
from contestlab.sources.tables import folder, list_tables

MAX_BROADCAST_LABELS = 10_000
EDGE_ROWS = 100_000  # rows that are sorted to find the last training row, at most
CARD = "features array<struct<name:string,type:string>>, labels array<string>"
PART_ROWS = 100_000  # rows of a partition that models are fitted on, about


# Splitting

def key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))


def split_exact(df: DataFrame, frac: float, key: str, seed: int) -> DataFrame:
    """Mark exactly round(n * frac) rows as training rows (`is_train`), chosen by the hash of a
    unique key.

    The input is read twice: rows are counted per hash prefix, 4,096 numbers that also tell n, and the rows of the
    prefix that the cut falls into are written apart. There the hash and key of the last training row are found, by
    longer prefixes while they are many. The mark is then one comparison, in one narrow pass."""
    keys = df.select(key_hash(key, seed).alias("_h"), F.col(key).alias("_k"))
    prefix, left, edge = "", None, None
    while True:
        at = F.substring("_h", 1, len(prefix) + 3)
        cells = sorted((keys if edge is None else edge).groupBy(at.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        if left is None:
            total = sum(n for _, n in cells)
            left = round(total * frac)
            if not 0 < left < total:
                return df.withColumn("is_train", F.lit(left > 0))
        for p, n in cells:
            if left <= n:
                prefix = p
                break
            left -= n
        edge = keys.filter(F.col("_h").startswith(prefix)) if edge is None else edge.filter(F.col("_h").startswith(prefix))
        edge = pinned(edge)
        if n <= EDGE_ROWS or len(prefix) >= 30:
            break
    last = edge.orderBy("_h", "_k").limit(left).orderBy(F.desc("_h"), F.desc("_k")).first()
    cut = F.struct(F.lit(last["_h"]).alias("_h"), F.lit(last["_k"]).cast(df.schema[key].dataType).alias("_k"))
    return df.withColumn("is_train", F.struct(key_hash(key, seed).alias("_h"), F.col(key).alias("_k")) <= cut)


def split_hash(df: DataFrame, frac: float, key: str, seed: int) -> DataFrame:
    """Mark about n * frac rows as training rows, in one narrow pass."""
    number = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("is_train", number < F.lit(int(frac * 2**32)))


# Labels

def label_index(df: DataFrame, label: str, name: str = "label") -> tuple[DataFrame, list[str]]:
    """Number the labels in alphabetic order, unused ones left out; returns the labels as well."""
    model = StringIndexer(inputCol=label, outputCol=name, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df), list(model.labels)


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight every row by n / (classes * rows of its class), of the rows with a label; others have no weight."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    n, classes = counts.agg(F.sum("_n"), F.count(F.lit(1))).first()
    if classes <= MAX_BROADCAST_LABELS:
        counts = F.broadcast(counts)
    weight = F.lit(float(n or 0)) / (F.col("_n") * F.lit(classes))
    return df.join(counts, label, "left").withColumn(name, weight).select(*df.columns, name)


# Evaluation

def confusion_matrix(pred: DataFrame, levels: Sequence[str], label: str = "winner",
                     prediction: str = "predicted") -> DataFrame:
    return contingency(pred, label, prediction, levels, row_levels=levels)


def accuracy(pred: DataFrame, label: str = "winner", prediction: str = "predicted", mode: str = "intended") -> DataFrame:
    """Share of right predictions, one row. Literal mode adds up the first three diagonal cells of
    the table of occurring labels and predictions, NULL if there are fewer than three of either."""
    if mode != "literal":
        return pred.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
    cells = pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))  # classes squared
    placed = cells.withColumns({
        "i": F.dense_rank().over(Window.orderBy(label)), "j": F.dense_rank().over(Window.orderBy(prediction))})
    diagonal = F.sum(F.when((F.col("i") == F.col("j")) & (F.col("i") <= 3), F.col("n")).otherwise(0))
    enough = (F.max("i") >= 3) & (F.max("j") >= 3)
    return placed.agg(F.when(enough, diagonal / F.sum("n")).alias("accuracy"))


def mean_per_class_error(pred: DataFrame, label: str = "winner", prediction: str = "predicted") -> DataFrame:
    """1 minus the average recall of the classes, one row."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    recalls = pred.groupBy(label).agg(F.avg(F.coalesce(hit, F.lit(0.0))).alias("recall"))
    return recalls.agg((1 - F.avg("recall")).alias("mean_per_class_error"))


def review(pred: DataFrame, ledger: DataFrame, key: str = "contest_id", prediction: str = "predicted") -> DataFrame:
    """Predictions beside the details of their matches."""
    return ledger.join(pred.select(key, prediction), key)


class MeanPerClassError(Evaluator):
    def _evaluate(self, dataset: DataFrame) -> float:
        return mean_per_class_error(dataset, "label", "prediction").first()[0]

    def isLargerBetter(self) -> bool:
        return False


class Accuracy(Evaluator):
    def _evaluate(self, dataset: DataFrame) -> float:
        return accuracy(dataset, "label", "prediction").first()[0]

    def isLargerBetter(self) -> bool:
        return True


METRICS = {"accuracy": Accuracy, "mean_per_class_error": MeanPerClassError}


# Training

def perceptron(n_features: int, n_classes: int, hidden: Sequence[int] = (8, 8, 8, 8), epochs: int = 500,
               rate: float = 0.001, seed: int = 456) -> Perceptron:
    """Feed-forward network trained by plain gradient descent at a fixed rate."""
    return Perceptron(
        layers=[n_features, *hidden, n_classes], solver="gd", stepSize=rate, maxIter=epochs, seed=seed,
        featuresCol="scaled", labelCol="label")


def default_candidates(n_features: int, n_classes: int, weight: str | None = None, seed: int = 456) -> dict[str, Estimator]:
    logistic = LogisticRegression(featuresCol="scaled", labelCol="label", maxIter=50)
    forest = RandomForestClassifier(featuresCol="scaled", labelCol="label", numTrees=20, maxDepth=5, seed=seed)
    if weight:
        logistic, forest = logistic.setWeightCol(weight), forest.setWeightCol(weight)
    trees = GBTClassifier(featuresCol="scaled", labelCol="label", maxIter=5, maxDepth=3, seed=seed)
    boosted = OneVsRest(classifier=trees, featuresCol="scaled", labelCol="label", parallelism=n_classes)
    if weight:
        boosted = boosted.setWeightCol(weight)
    return {
        "logistic_regression": logistic, "random_forest": forest, "boosted_trees": boosted,
        "perceptron": perceptron(n_features, n_classes, epochs=50, seed=seed),
    }


def _texts(df: DataFrame | None, features: Sequence[str]) -> list[str]:
    return [c for c in features if df is not None and isinstance(df.schema[c].dataType, StringType)]


def input_size(df: DataFrame, features: Sequence[str]) -> int:
    """Numbers a model gets: one per number column, one per value of a text column, and one for values not seen."""
    texts = _texts(df, features)
    values = df.agg(*[F.count_distinct(c) for c in texts]).first() if texts else ()
    return len(features) - len(texts) + sum(n + 1 for n in values)


def pipeline(classifier: Estimator, features: Sequence[str], df: DataFrame | None = None) -> Pipeline:
    """Scaled numbers and a classifier. Text columns, which `df` tells apart, become one number per value;
    a missing or unseen value has a number of its own."""
    if isinstance(classifier, GaussianBayes):  # reads the columns themselves
        return Pipeline(stages=[classifier])
    texts = _texts(df, features)
    coded = [StringIndexer(inputCols=texts, outputCols=[f"_{c}_index" for c in texts], handleInvalid="keep"),
             OneHotEncoder(inputCols=[f"_{c}_index" for c in texts], outputCols=[f"_{c}_values" for c in texts], dropLast=False)]
    inputs = [f"_{c}_values" if c in texts else c for c in features]
    return Pipeline(stages=[
        *(coded if texts else []),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        classifier,
    ])


@dataclass
class Search:
    leaderboard: DataFrame  # rank, model, metric, status, round (the last one), rows (of its sample)
    rounds: DataFrame       # round, rows, model, metric, kept
    best: PipelineModel
    labels: list[str]
    complete: bool  # whether no round was left out


@dataclass
class Round:
    """Candidates of a round and the share of all rows they are judged on."""

    number: int
    candidates: int
    share: float


def halving(candidates: int, rows: int, budget_rows: int | None = None, keep: int = 2) -> list[Round]:
    """Rounds that end with at most `keep` candidates, each with `keep` times the rows of the one before.

    The last round sees all rows, or as many as let all rounds together fit no more than `budget_rows` rows (a row counts
    once for each candidate that it is fitted for); the first one no fewer than 1,000, or all."""
    field = [candidates]
    while field[-1] > keep:
        field.append(-(-field[-1] // keep))
    weights = [n * float(keep) ** (i - len(field) + 1) for i, n in enumerate(field)]
    last = min(1.0, (budget_rows or float("inf")) / max(rows * sum(weights), 1))
    least = min(1.0, 1000 / max(rows, 1))
    return [Round(i + 1, n, min(1.0, max(last * float(keep) ** (i - len(field) + 1), least))) for i, n in enumerate(field)]


def sample_number(key: str, seed: int) -> Column:
    """A number from 0 up to 2^32 that only the key and the seed decide: rows below a bound are part of those below a higher one."""
    return F.conv(F.substring(key_hash(key, seed), 9, 8), 16, 10).cast("long")


def search_models(train: DataFrame, label: str, features: Sequence[str], key: str, *,
                  candidates: Mapping[str, Estimator] | None = None, metric: str = "accuracy", budget_rows: int | None = None,
                  folds: int = 3, seed: int = 456, balance: bool = False, budget_seconds: float | None = None, keep: int = 2,
                  halve: bool = True) -> Search:
    """Rank the candidates by successive halving and return the best one fitted on all rows.

    Every candidate is cross-validated on a sample; the better half is judged again on a sample twice as large, which holds the
    first one, and so on (see `halving`). Samples and folds follow the hash of `key`, and rows are dealt into
    partitions by it, so that the ranking is the same on any machine; of equal ones the first name wins. The budget is a number of rows.
    Whoever wants a clock as well gives `budget_seconds`: no round after the first begins later than that. Without `halve`, there
    is one round, in which every candidate is cross-validated on all rows, and no budget. With
    `balance`, models that take no weights see the rows of rarer labels repeated instead. Rows without a label are left out.
    """
    if not halve and (budget_rows, budget_seconds) != (None, None):
        raise ValueError("a budget needs rounds to save on")
    indexed, labels = label_index(train.filter(F.col(label).isNotNull()), label)
    if balance:
        indexed = class_weights(indexed, "label")
    numbers = input_size(train, features)
    candidates = dict(candidates or default_candidates(numbers, len(labels), "weight" if balance else None, seed))
    fold = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("long") % folds
    n = indexed.count()
    indexed = indexed.withColumns({"_fold": fold.cast("int"), "_number": sample_number(key, seed)})
    indexed = pinned(indexed.repartition(-(-n // PART_ROWS) or 1, key).sortWithinPartitions(key))
    evaluator = METRICS[metric]()
    sign = -1 if evaluator.isLargerBetter() else 1
    began, board, found = time.monotonic(), [], {}
    alive = list(candidates)
    plan = halving(len(alive), n, budget_rows, keep) if halve else [Round(1, len(alive), 1.0)]
    for turn in plan:
        if board and budget_seconds is not None and time.monotonic() - began > budget_seconds:
            break
        sample = indexed.filter(F.col("_number") < F.lit(int(turn.share * 2**32))).drop("_number")
        sizes = dict(sample.groupBy("_fold").count().collect())
        size = sum(sizes.values())
        for i in range(folds):
            if not 0 < sizes.get(i, 0) < size:
                raise ValueError(f"no rows to fit or to judge on at fold {i}")
        judged = []
        for name in alive:
            estimator = candidates[name]
            rows = repeated(sample, "weight") if balance and not estimator.hasParam("weightCol") else sample
            value = cross_validated(pipeline(estimator, features, train), rows, evaluator, folds)
            judged.append((sign * value, name, value))
        judged.sort()
        last = turn is plan[-1]
        alive = [name for _, name, _ in judged[:1 if last else -(-len(judged) // keep)]]
        for _, name, value in judged:
            board.append((turn.number, size, name, float(value), name in alive))
            found[name] = (turn.number, size, float(value))
    order = sorted(found, key=lambda name: (-found[name][0], sign * found[name][2], name))
    winner = candidates[order[0]]
    rows = indexed.drop("_fold", "_number")
    best = pipeline(winner, features, train).fit(repeated(rows, "weight") if balance and not winner.hasParam("weightCol") else rows)
    spark = train.sparkSession
    leaderboard = spark.createDataFrame(
        [(i, name, found[name][2], "fitted", found[name][0], found[name][1]) for i, name in enumerate(order, 1)],
        f"rank int, model string, {metric} double, status string, round int, rows long")
    rounds = spark.createDataFrame(board, f"round int, rows long, model string, {metric} double, kept boolean")
    return Search(leaderboard, rounds, best, labels, board[-1][0] == len(plan))


def cross_validated(estimator: Estimator, df: DataFrame, evaluator: Evaluator, folds: int, fold: str = "_fold") -> float:
    """Mean of the metric over the folds, each judged by a model of the others; no model of all rows is fitted."""
    values = []
    for i in range(folds):
        model = estimator.fit(df.filter(F.col(fold) != i))
        values.append(evaluator.evaluate(model.transform(df.filter(F.col(fold) == i))))
    return sum(values) / folds


def repeated(df: DataFrame, weight: str) -> DataFrame:
    """Every row about as often as its weight says against the smallest one, the fraction by a hash of the row. Rows without a
    weight are left out."""
    least = df.agg(F.min(weight)).first()[0] or 1.0
    times = F.col(weight) / F.lit(least)
    draw = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) / F.lit(float(1 << 20))
    copies = (F.floor(times) + (draw < times - F.floor(times)).cast("int")).cast("int")
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def score(model: Model, df: DataFrame, labels: Sequence[str], *, probabilities: bool = False,
          name: str = "predicted") -> DataFrame:
    """Predicted label of every row and, if asked for, one probability column per label."""
    scored = model.transform(df)
    names = F.array(*[F.lit(v) for v in labels])
    out = {name: F.get(names, F.col("prediction").cast("int"))}
    if probabilities:
        if "probability" not in scored.columns:
            raise ValueError("this model gives no class probabilities")
        shares = F.col("probability")
        if not isinstance(scored.schema["probability"].dataType, ArrayType):
            shares = vector_to_array(shares)
        out |= {v.lower(): F.get(shares, F.lit(i)) for i, v in enumerate(labels)}
    return scored.withColumns(out).select(*df.columns, *out)


# Storing

def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class Stored:
    """A model of a store with what it needs to be used: the columns it reads, their types and the order of its labels."""

    version: int
    model: PipelineModel
    features: dict[str, str]
    labels: list[str]

    def score(self, df: DataFrame, **options) -> DataFrame:
        """`score` by this model, after its columns have been found in the table with the types it was fitted on."""
        there = dict(df.dtypes)
        wrong = [f"{c} is {there.get(c, 'missing')}, not {t}" for c, t in self.features.items() if there.get(c) != t]
        if wrong:
            raise ValueError("the table does not fit the model: " + "; ".join(wrong))
        return score(self.model, df, self.labels, **options)


def _versions(spark: SparkSession, store: str) -> list[int]:
    return sorted(int(n[8:]) for n in list_tables(spark, store) if n.startswith("version=") and n[8:].isdigit())


def store_model(model: PipelineModel, store: str, train: DataFrame, features: Sequence[str], labels: Sequence[str]) -> int:
    """Add a model to a store, a folder with one folder per version; returns the version.

    The model and its card (columns, types, labels) are written beside the store and moved in as a whole, so that a reader
    never sees a part; a version that another writer took meanwhile is passed over. Versions are never overwritten."""
    spark = train.sparkSession
    fs, root = folder(spark, store)
    draft = f"{store.rstrip('/')}/_draft-{uuid.uuid4().hex}"
    model.write().save(f"{draft}/model")
    kinds = dict(train.dtypes)
    card = [([(c, kinds[c]) for c in features], list(labels))]
    spark.createDataFrame(card, CARD).coalesce(1).write.json(f"{draft}/card")
    version = max(_versions(spark, store), default=0) + 1
    while True:
        target = folder(spark, f"{store.rstrip('/')}/version={version}")[1]
        if not fs.exists(target) and fs.rename(folder(spark, draft)[1], target):
            return version
        version += 1


def open_model(spark: SparkSession, store: str, version: int | None = None) -> Stored:
    """The latest version of a store, or the one asked for."""
    there = _versions(spark, store)
    if not there or (version is not None and version not in there):
        raise ValueError(f"{store} has no version {version or ''}".rstrip())
    version = version or there[-1]
    path = f"{store.rstrip('/')}/version={version}"
    card = spark.read.schema(CARD).json(f"{path}/card").first()
    return Stored(version, PipelineModel.load(f"{path}/model"), {f.name: f.type for f in card.features}, list(card.labels))
