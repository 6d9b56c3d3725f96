"""Importance resampling of documents towards a target distribution of n-grams.

Runs of one and two words are hashed into buckets. The gain of a bucket is the logarithm of its share in the
target texts over its share in the documents; a document's weight is the mean gain of its features. Adding
seeded Gumbel noise and taking the highest scores draws without replacement in proportion to the weights.

Texts are read twice: once for the counts of the buckets, once for the weights. Both times a batch is cut
into words by Arrow kernels, words become dictionary indices, an index and its neighbour make a pair, and
only distinct words and pairs are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from contestlab.llm.common import stored
from contestlab.llm.words import in_parts, words_of

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
SHARE = (25, 100)  # of the documents with enough words, this part is drawn
BAND = 100  # scores are whole numbers of at most some 10^5; so many share a band of the histogram
_INDEX = (1 << 33) - 1  # the bits of a monotonically increasing id that count inside a partition


def _features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature, rows ascending, and the number of words per row."""
    words = words_of(texts)
    distinct = np.fromiter((crc32(w) % buckets for w in words.dictionary), np.int64, len(words.dictionary))
    codes, row = words.codes, words.row
    follows = row[1:] == row[:-1]
    size = max(len(words.dictionary), 1)
    pairs, at = np.unique(codes[:-1][follows] * size + codes[1:][follows], return_inverse=True)
    first = [crc32(w + b" ") for w in words.dictionary]  # a pair's checksum goes on from that of its first word
    second = words.dictionary
    hashed = np.fromiter((crc32(second[b], first[a]) % buckets for a, b in zip((pairs // size).tolist(), (pairs % size).tolist())),
                         np.int64, len(pairs))
    rows = np.concatenate([row, row[1:][follows]])
    order = np.argsort(rows, kind="stable")
    return np.concatenate([distinct[codes], hashed[at]])[order], rows[order], words.lengths


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows. A task sends one row per bucket, the driver receives at most `buckets`."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in in_parts(batches):
            total += np.bincount(_features(part.column("text"), buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's share of a bucket over the source's), every bucket counted once more than found."""
    s, t, size = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """floor(1000 * a Gumbel variable) that the seed and the key decide; a missing key counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, gains: np.ndarray, *, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """key, n_words, n_features and weight per row; the columns of `carry` come along in a struct `carried`."""
    buckets = len(gains)

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            bucket, row, n_words = _features(part.column("text"), buckets)
            n = np.bincount(row, minlength=len(n_words))
            ends = np.cumsum(n)
            total = np.zeros(len(n), np.int64)
            total[n > 0] = np.add.reduceat(gains[bucket], (ends - n)[n > 0]) if len(bucket) else 0
            rest = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                [*(name for name in part.schema.names if name != "text"), "n_words", "n_features", "weight"])

    kept = [F.struct(*[docs[c] for c in carry]).alias("carried")] if carry else []
    rows = docs.select(docs[key].alias("key"), *kept, docs[text].cast("string").alias("text"))
    fields = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(weights, T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))]))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows numbered 1, 2, ... over the whole table, in the given order; equal rows fall into several tasks if need be.

    Rows are written in sorted ranges; a row's number is its place in its range and the rows of the ranges before.
    """
    tie = F.monotonically_increasing_id()
    ranges = df.withColumn("tie_", tie).repartitionByRange(*order, "tie_").sortWithinPartitions(*order, "tie_")
    ranges = stored(ranges.select(*df.columns, F.spark_partition_id().alias("part_"), tie.bitwiseAND(F.lit(_INDEX)).alias("at_")), "ranges")
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("part_").agg(F.count(F.lit(1)).alias("n_"))  # one row per range
    sizes = sizes.select("part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("before_"))
    return ranges.join(F.broadcast(sizes), "part_").select(*df.columns, (F.col("before_") + F.col("at_") + 1).alias(name))


def resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE, seed: int = SEED,
             carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: key, n_words, n_features, weight, score and rank (long; null where not drawn).

    Words are runs of digits, letters and characters beyond ASCII, only A-Z lower-cased. Features are all runs of
    one and two words. Among the rows with `least_words` words the share's part with the highest scores is drawn, ties to
    the smaller key, a missing key first. Rows alike in score and key are ranked in any order among themselves.

    A missing or empty text has no feature and weight 0. Equal texts weigh the same; their noise depends on the key, so
    repeated rows score the same. An empty table gives no rows; without target texts the weights favour rare
    buckets alone. Other columns are not read, but those named in `carry` (the text, say) come along in `carried`.
    """
    gains = gains_of(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    rows = weigh(docs, gains, key=key, text=text, carry=carry)
    rows = stored(rows.withColumn("score", F.col("weight") + noise(F.col("key"), seed)), "resample-scores")
    able = rows.where(F.col("n_words") >= least_words)
    band = F.floor(F.col("score") / BAND)
    counts = sorted(able.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)  # some hundred bands
    quota, taken, least = sum(r.n for r in counts) * share[0] // share[1], 0, None
    for r in counts:
        if taken >= quota:
            break
        taken, least = taken + r.n, r.band
    if least is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    near = (F.col("n_words") >= least_words) & (band >= least)  # all rows drawn and the rest of the last band
    ranked = numbered(rows.where(near), [F.desc("score"), F.asc_nulls_first("key")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return ranked.unionByName(rows.where(~near).withColumn("rank", F.lit(None).cast("long")))
