"""A quality classifier over document statistics.

Random Fourier features approximate a Gaussian kernel between standardised statistics. Every
partition sums its part of the normal equations of a ridge regression; the sums are added and
solved on the driver, and an isotonic regression turns raw scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from contestlab.llm.common import small_batches, stored, whole
from contestlab.llm.textstats import CLASSES, class_counts, let, words_of

FEATURES = 256        # random features
RIDGE = 1e-4          # per training row
SAMPLE = 200_000      # labelled rows that are fitted, at most
PARTS = 16            # partitions of the fit, so that a fixed number of sums reaches the driver
RATIOS = ("space", "upper", "symbol", "digit", "mark", "other")


def statistics(docs: DataFrame, text: str, out: str = "stats") -> DataFrame:
    """An array of numbers per document, from the whole text; all are defined for an empty text."""
    names = list(CLASSES)
    df = class_counts(docs, text, "classes_").withColumn("hashes_", F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn("lines_", F.split(text, "\n", -1))
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.greatest(F.size("hashes_"), F.lit(1)).cast("double")
    lines = F.size("lines_").cast("double")
    count = lambda c: F.col("classes_")[names.index(c)]
    windows = F.transform(F.sequence(F.lit(0), F.size("hashes_") - 3), lambda i: F.xxhash64(
        F.get("hashes_", i), F.get("hashes_", i + 1), F.get("hashes_", i + 2)))
    repeats = F.when(F.size("hashes_") > 3, let(windows, lambda w: 1 - F.size(F.array_distinct(w)) / F.size(w)))
    stats = [
        F.log1p(F.size("hashes_").cast("double")), (chars - count("space")) / n,
        *[count(c) / chars for c in RATIOS], F.sqrt(count("symbol") / n), F.sqrt(count("upper") / n), F.sqrt(count("mark") / n),
        F.size(F.array_distinct("hashes_")) / n, F.coalesce(repeats, F.lit(0.0)),
        F.size(F.array_distinct("lines_")) / lines, F.log1p(chars / lines),
        F.regexp_count(text, F.lit(r"[.!?][\x20\x09-\x0D]")) / n,
    ]
    return df.withColumn(out, F.array(*[s.cast("double") for s in stats])).drop("classes_", "hashes_", "lines_")


def remainder_of(key: Column, parts: int = 4) -> Column:
    """crc32 of the key as text, modulo `parts`; a missing key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(parts))


@dataclass
class Model:
    """Everything a task needs to score: fixed-size arrays."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score; a thousandth of it keeps the order of raw scores inside a step."""
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, *self.steps) + 0.001 / (1 + np.exp(-4 * (raw - 0.5)))


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean raw score and share of label 1 per block, both ascending."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of raw, sum of labels, rows
    for x, y in zip(raw[order], label[order], strict=True):
        blocks.append([x, y, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(stats: DataFrame, labels: DataFrame, *, key: str, label: str, features: int = FEATURES, ridge: float = RIDGE,
        sample: int = SAMPLE, seed: int = 11) -> Model:
    """Fit on labelled rows that are not held out.

    `stats` has columns key and stats, one row per document. Means and deviations are those of all
    documents. At most about `sample` labelled rows are used, picked by a hash of the key. Rows whose
    remainder is 3 calibrate, the others fit. Rows with a missing key or label are left out; a key
    labelled twice counts twice. Without labels of both kinds the score is their mean (0.5 without any).
    """
    small_batches(stats.sparkSession)
    first = stats.select(F.size("stats").alias("n")).first()
    width = first.n if first else 1
    at = [F.col("stats")[i] for i in range(width)]
    moments = stats.agg(*[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    mean = np.array([m or 0.0 for m in moments[:width]])
    scale = np.array([s if s and s > 1e-9 else 1.0 for s in moments[width:]])
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y")).where(
        F.col("k").isNotNull() & F.col("y").isNotNull() & (remainder_of(F.col("k")) != 2))
    n = known.count()
    keep = F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / max(n, 1)))
    rows = stored(known.where(keep).join(stats, F.col("k") == F.col("key")).select("k", "y", "stats")
                  .repartition(PARTS, "k"), "labelled-statistics")
    rng = np.random.default_rng(seed)
    model = Model(mean, scale, rng.normal(size=(width, features)) / np.sqrt(width), rng.uniform(0, 2 * np.pi, features),
                  np.zeros(features + 1), (np.zeros(1), np.full(1, 0.5)))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b, rows = np.zeros((features + 1, features + 1)), np.zeros(features + 1), 0
        for batch in batches:
            if len(batch):
                x = model.features(np.stack(batch.stats))
                a, b, rows = a + x.T @ x, b + x.T @ batch.y.to_numpy(), rows + len(batch)
        yield pd.DataFrame({"a": [a.tobytes()], "b": [b.tobytes()], "rows": [rows]})

    fitted = rows.where(remainder_of(F.col("k")) != 3).mapInPandas(sums, "a binary, b binary, rows long").collect()
    a = sum((np.frombuffer(r.a).reshape(features + 1, -1) for r in fitted), np.zeros((features + 1, features + 1)))
    b = sum((np.frombuffer(r.b) for r in fitted), np.zeros(features + 1))
    total = sum(r.rows for r in fitted)
    if total == 0:
        return model
    model.weights = np.linalg.solve(a + ridge * total * np.eye(features + 1), b)

    def raws(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"raw": model.raw(np.stack(batch.stats)), "y": batch.y.to_numpy()})

    held = rows.where(remainder_of(F.col("k")) == 3).mapInPandas(raws, "raw double, y double").toPandas()  # a part of the sample
    share = b[-1] / total
    if held.empty or not 0 < share < 1:
        model.steps = (np.zeros(1), np.full(1, share))
    else:
        model.steps = isotonic(held.raw.to_numpy(), held.y.to_numpy())
    return model


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = 0.7, **options) -> DataFrame:
    """One row per input row: key, held_out, score from 0 to 1 and predicted (1 where the score reaches the threshold).

    A score depends on the text alone; a missing text is an empty one, and equal texts score equal.
    An empty table gives no rows. Other columns are not read. See `fit` for what is learnt from which rows.
    """
    rows = statistics(docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text")), "text").drop("text")
    rows = stored(rows, "document-statistics")
    model = fit(rows, labels, key=key, label=label, **options)
    return rows.select("key", (remainder_of(F.col("key")) == 2).alias("held_out"),
                       scorer(model)("stats").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats)) if len(stats) else np.zeros(0))

    return score
