"""Gradient descent of Spark's perceptron over packed blocks of rows, one job per pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

BLOCK_ROWS = 8_192  # rows of a block, about


class Perceptron(MultilayerPerceptronClassifier):
    """Spark's network with its start, step and end, and its own model.

    By `gd`, the rows are packed once into blocks of single precision, features by rows, which are kept serialized. A pass is one job:
    every task adds the gradients of its blocks in double precision, and the driver gets one vector of the size of the weights per
    partition. Each row counts alike, while Spark's descent gives each of its blocks the same weight, however few rows it has."""

    def _fit(self, dataset: DataFrame):
        if self.getSolver() != "gd":
            return super()._fit(dataset)
        few = dataset.limit(1)
        weights = super(Perceptron, self.copy({self.maxIter: 0}))._fit(few).weights.toArray()
        layers, rate, tol = self.getLayers(), self.getStepSize(), self.getTol()
        features = vector_to_array(self.getFeaturesCol(), "float32").alias("x")
        rows = dataset.select(features, F.col(self.getLabelCol()).cast("double").alias("y"))
        blocks = rows.mapInArrow(_packer(BLOCK_ROWS), "n long, x binary, y binary").rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for turn in range(self.getMaxIter()):
                found = blocks.mapPartitions(_gradient(layers, weights)).collect()
                n = sum(n for n, _ in found)
                if not n:
                    break
                step = rate / n * np.sum([g for _, g in found], axis=0)
                weights = weights - step
                if turn and np.linalg.norm(step) < tol * max(np.linalg.norm(weights), 1.0):
                    break
        finally:
            blocks.unpersist()
        model = super(Perceptron, self.copy({self.maxIter: 0, self.initialWeights: weights.tolist()}))._fit(few)
        return self._copyValues(model)


# Everything the functions need is defined inside, so that workers need no copy of this package.


def _packer(block_rows: int) -> Callable:
    """Batch function for `mapInArrow`: features and labels of consecutive rows as bytes."""

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def block(held):
            x = np.ascontiguousarray(np.concatenate([x for x, _ in held]).T)
            y = np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int64()), "x": pa.array([x.tobytes()], pa.binary()),
                                               "y": pa.array([y.tobytes()], pa.binary())})

        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = batch.columns
            if x.null_count or y.null_count:
                raise ValueError("rows without features or a label")
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = y.to_numpy(zero_copy_only=False).astype(np.int32)
            for at in range(0, len(y), block_rows):
                held.append((x[at:at + block_rows], y[at:at + block_rows]))
                n += len(held[-1][1])
                if n >= block_rows:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return pack


def _gradient(layers: Sequence[int], weights: np.ndarray) -> Callable:
    """Function for `mapPartitions`: number of rows and summed gradient of the cross entropy, in the order of Spark's weights:
    per layer the matrix, column by column, and the bias. Hidden layers are logistic, the last one is a softmax."""

    def gradient(blocks: Iterator) -> Iterator:
        import numpy as np

        parts, at = [], 0
        for wide, high in zip(layers, layers[1:]):
            matrix = weights[at:at + wide * high].reshape(wide, high).T.astype(np.float32)
            at += wide * high
            parts.append((np.ascontiguousarray(matrix), weights[at:at + high].reshape(high, 1).astype(np.float32)))
            at += high
        sums = [(np.zeros((high, wide)), np.zeros(high)) for wide, high in zip(layers, layers[1:])]
        rows = 0
        for n, x, y in blocks:
            rows += n
            outs = [np.frombuffer(x, np.float32).reshape(-1, n)]
            for matrix, bias in parts:
                z = matrix @ outs[-1]
                z += bias
                if len(outs) < len(parts):
                    np.negative(z, out=z)
                    np.minimum(z, 80, out=z)  # exp stays finite; the result is 0 in single precision all the same
                    np.exp(z, out=z)
                    z += 1
                    np.reciprocal(z, out=z)
                else:
                    z -= z.max(axis=0)
                    np.exp(z, out=z)
                    z /= z.sum(axis=0)
                outs.append(z)
            delta = outs[-1]
            delta[np.frombuffer(y, np.int32), np.arange(n)] -= 1
            for i in range(len(parts) - 1, -1, -1):
                sums[i][0][:] += delta @ outs[i].T
                sums[i][1][:] += delta.sum(axis=1)
                if i:
                    delta = parts[i][0].T @ delta
                    delta *= outs[i]
                    delta *= 1 - outs[i]
        yield rows, np.concatenate([part for matrix, bias in sums for part in (matrix.T.ravel(), bias)])

    return gradient
