"""Removal of repeated passages: runs of consecutive sentences that an earlier document already has.

Every document is cut into sentences. From each sentence on, and up to each sentence, the shortest
run of several sentences with enough words is hashed. Runs are joined over all documents, and every
sentence of a run that is not the first of its kind is removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from contestlab.llm.common import discard, small_batches, stored, whole
from contestlab.operators.joins import BITMAP_ROWS, bitmap, marked as marked_rows

SENTENCES = 2   # of a run, at least
WORDS = 20      # of a run, at least
LONE = 40       # a sentence of so many words is a run of its own
REACH = 8       # of so many consecutive words one at least ends a sentence
_CUT = re.compile(r"[.!?,;:]+[\x20\t]+|\n+")
_WORD = re.compile(r"\S+\s*")
_COUNT = -1  # in place of an end: the start is the number of sentences
_BATCH = 20_000  # rows of one output batch


def _cut(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the sentences end, the hash of each word in lower case, and where each word ends with its blanks."""
    parts = _WORD.findall(text)
    words = text.lower().split()
    words = words if len(words) == len(parts) else [p.rstrip().lower() for p in parts]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    lead = len(text) - int(lengths.sum())
    ends = lead + lengths.cumsum()
    marks = np.array([m.end() for m in _CUT.finditer(text)], dtype=np.int64)
    marked = np.zeros(len(parts), dtype=bool)
    marked[np.searchsorted(ends, marks[marks > lead])] = True
    cuts = [marks, [len(text)]]
    if len(hashes) >= REACH:  # the first least hash of each window of words without a marked one
        order = np.where(marked, np.uint64(0), (hashes >> np.uint64(32)) + np.uint64(1))
        order = order << np.uint64(31) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width < REACH:
            order = np.minimum(order[:-width], order[width:])
            width *= 2
        picked = np.zeros(len(parts), dtype=bool)
        picked[(order & np.uint64((1 << 31) - 1)).astype(np.int64)] = True
        cuts.append(ends[picked & ~marked])
    cuts = np.unique(np.concatenate(cuts).astype(np.int64))
    return cuts[cuts > 0], hashes, ends


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, with the blanks that follow it; they cover the whole text.

    Sentences end at marks, and where `REACH` consecutive words have no mark, after the one of the least
    hash: equal passages are cut alike, except for 15 words at most where they begin and end. So 51
    words have 21 or more that are cut alike, wherever they lie.
    """
    ends = _cut(text)[0].tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True)) if ends else []


def runs(text: str) -> tuple[list[tuple[int, int, bytes]], list[tuple[int, int]]]:
    """The runs that are first of their kind in the text, as start, end and 16-byte hash, and the spans of the others."""
    starts, ends, hashes, first, _ = _found(text)
    spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
    return ([(*x, h) for x, h, own in zip(spans, hashes, first, strict=True) if own],
            [x for x, own in zip(spans, first, strict=True) if not own])


def _found(text: str) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Of every run its start, end, hash and whether it is the first of its kind in the text; and where the sentences end."""
    ends, hashes, words = _cut(text)
    upto = np.searchsorted(words, ends, side="right")  # words that end within the sentences so far
    if len(ends):
        upto[-1] = len(words)
    real = np.diff(upto, prepend=0) > 0  # blank lines join nothing
    starts, stops, total = np.concatenate([[0], ends[:-1]])[real] if len(ends) else ends, ends[real], np.concatenate([[0], upto[real]])
    n, at = len(stops), np.arange(len(total))
    # The shortest run from each sentence on, and up to each: two sentences and `WORDS` words, or one of `LONE` words.
    last = np.minimum(np.maximum(np.searchsorted(total, total + WORDS), at + SENTENCES), np.maximum(np.searchsorted(total, total + LONE), at + 1))
    begin = np.maximum(np.minimum(np.searchsorted(total, total - WORDS, side="right") - 1, at - SENTENCES),
                       np.minimum(np.searchsorted(total, total - LONE, side="right") - 1, at - 1))
    pairs = np.unique(np.concatenate([(at * (n + 1) + last)[last <= n], (begin * (n + 1) + at)[begin >= 0]]))
    i, j = pairs // (n + 1), pairs % (n + 1)
    raw, digest = hashes.tobytes(), xxhash.xxh3_128_digest
    found = [digest(raw[a:b]) for a, b in zip((8 * total[i]).tolist(), (8 * total[j]).tolist(), strict=True)]
    first = np.ones(len(found), dtype=bool)
    if len(set(found)) < len(found):
        seen: set[bytes] = set()
        for k, h in enumerate(found):
            first[k] = h not in seen
            seen.add(h)
    return starts[i], stops[j - 1], found, first, ends


def without(text: str, starts, stops, ends: np.ndarray | None = None) -> tuple[str, int]:
    """The text without the given spans, and how many sentences went. `ends` says where they end, if known."""
    ends = _cut(text)[0] if ends is None else ends
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    cover = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(cover, np.searchsorted(begins, np.asarray(starts, dtype=np.int64)), 1)
    np.add.at(cover, np.searchsorted(begins, np.asarray(stops, dtype=np.int64)), -1)
    kept = cover.cumsum()[:-1] <= 0
    edges = np.flatnonzero(np.diff(kept, prepend=False, append=False))  # where what stays begins and ends
    bounds = np.concatenate([begins, [len(text)]])[edges].astype(np.int64).tolist()
    return "".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)), len(ends) - int(kept.sum())


_RUNS = pa.schema([("key", pa.int64()), ("t1", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                   ("h1", pa.int64()), ("h2", pa.int32()), ("again", pa.bool_()), ("ends", pa.list_(pa.int32()))])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []  # per text: key, t1, starts and ends of runs, hashes, first, ends of sentences
    size = 0

    def flush() -> pa.RecordBatch:
        keys, t1s, starts, ends, hashes, first, cuts = zip(*held, strict=True)
        many = [len(x) for x in starts]
        raw = np.frombuffer(b"".join(h for own in hashes for h in own), dtype="<i8").reshape(-1, 2)
        own = np.concatenate(first)
        again = np.concatenate([~own, np.zeros(len(held), dtype=bool)])  # a row for every run, and one for the text itself
        none = np.concatenate([~own, np.ones(len(held), dtype=bool)])
        text = np.concatenate([np.zeros(len(own), dtype=bool), np.ones(len(held), dtype=bool)])
        pad = np.zeros(len(held), dtype=np.int64)
        columns = [
            np.concatenate([np.repeat(np.array(keys, dtype=np.int64), many), keys]), np.concatenate([np.repeat(np.array(t1s, dtype=np.int64), many), t1s]),
            np.concatenate([*starts, [len(x) for x in cuts]]), np.concatenate([*ends, pad + _COUNT]),
            np.concatenate([raw[:, 0], pad]), np.concatenate([raw[:, 1].astype(np.int32).astype(np.int64), pad])]
        masks = [None, None, None, None, none, none]
        arrays = [pa.array(c, f.type, mask=m) for c, f, m in zip(columns, _RUNS, masks, strict=False)]
        offsets = np.cumsum(np.concatenate([np.zeros(len(own) + 1, dtype=np.int64), [len(x) for x in cuts]]))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(cuts), pa.int32()))
        return pa.RecordBatch.from_arrays([*arrays, pa.array(again, pa.bool_(), mask=text), lists], schema=_RUNS)

    for batch in batches:
        for key, t1, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            held.append((key, t1, *_found(text)))
            size += len(held[-1][2]) + 1
            if size >= _BATCH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key (long), t1, n_sentences, n_removed (long) and kept, the text that stays.

    A run stays in the document with the smallest key that holds it, there at its first place. Sentences
    (and clauses) end at a mark of .!?,;: followed by a blank, at a line break, or after a picked word; they are compared in lower case with single blanks. A missing key sorts first; rows that share a key count as
    one document, equal rows get equal results. A missing or empty text has no sentences. An empty table
    gives no rows; other columns are not read.

    Run hashes are combined before they are shuffled, and a bitmap of those that occur twice keeps most others from being shuffled
    again (if they are no more than it can tell apart). Verdicts come back to the runs by a broadcast for
    the hashes that make up over a thousandth of all runs (a thousand at most), by a shuffle for the others.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("key"), F.col(key).isNull().alias("unkeyed"),
                       whole(F.col(text)).alias("text"))
    docs = docs.withColumn("t1", F.xxhash64(F.lit(1), "text"))
    found = stored(docs.select("key", "t1", "text").mapInArrow(
        _emit, "key long, t1 long, start int, end int, h1 long, h2 int, again boolean, ends array<int>"), "span-runs")
    fresh = found.where("NOT again").drop("ends")
    holders = fresh.groupBy("h1", "h2").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    holders = stored(holders, "span-holders")
    if holders.count() <= BITMAP_ROWS:  # most runs occur once: they need not be shuffled again
        fresh = marked_rows(fresh, bitmap(holders, F.col("h1")), F.col("h1"))
    few = F.lit(found.count() / 1000)
    hot = F.broadcast(holders.where(F.col("n") > few).drop("n"))
    marked = fresh.join(hot, ["h1", "h2"], "left")
    gone = marked.where("key > first").select("key", "t1", "start", "end")
    gone = gone.unionByName(
        marked.where("first IS NULL").drop("first").join(holders.where(F.col("n") <= few).drop("n"), ["h1", "h2"])
        .where("key > first").select("key", "t1", "start", "end"))
    gone = gone.unionByName(found.where("again OR again IS NULL").select("key", "t1", "start", "end", "ends"), allowMissingColumns=True)
    spans = stored(gone.groupBy("key", "t1").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"), F.max(F.when(F.col("end") == _COUNT, F.col("ends"))).alias("ends")), "span-gone")
    discard(found, holders)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, removed, count = [], [], []
            for t, gone, ends in zip(batch.text, batch.spans, batch.ends, strict=True):
                gone = [(s["start"], s["end"]) for s in gone if s["end"] != _COUNT]
                left, n = without(t, *zip(*gone, strict=True), np.asarray(ends, dtype=np.int64)) if gone else (t, 0)
                kept.append(left)
                removed.append(n)
                count.append(len(ends))
            yield pd.DataFrame({"key": batch.key, "unkeyed": batch.unkeyed, "t1": batch.t1, "n_sentences": count,
                                "n_removed": removed, "kept": kept})

    out = docs.join(spans, ["key", "t1"]).select("key", "unkeyed", "t1", "text", "spans", "ends").mapInPandas(
        cut, "key long, unkeyed boolean, t1 long, n_sentences long, n_removed long, kept string")
    return out.select(F.when(~F.col("unkeyed"), F.col("key")).alias("key"), "t1", "n_sentences", "n_removed", "kept")
