"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are cut into words once and kept as rows of (term, frequency) for the terms of the queries. A task
reads its documents in blocks. In a block every term has a list of its documents by falling impact. A query
reads the lists of its terms from the top; every document met is completed by direct accesses, which tell
its impact and its position in all lists. The first position of a list that no document has marked bounds what
an unseen document can still gain there, so reading stops once the sum of these bounds is below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from contestlab.llm.common import stored
from contestlab.llm.words import in_parts, words_of

TOP = 50
ITEMS = 1_000           # queries of one pass over the documents, about
ITEM_BYTES = 16 << 20   # bytes of their texts, about
POSTINGS = 1 << 20      # pairs of a document and a term in a block, about
STEP = 64               # positions read at first; twice as many in each later round
SLICES = 64             # of the tasks, merged before the whole


@dataclass
class Queries:
    """The queries of a pass: their keys, the terms of all of them, and per query the places of its terms."""

    keys: list
    terms: list[bytes]
    wanted: list[np.ndarray]


def _queries(rows: list) -> Queries:
    words = words_of(pa.array([r.text for r in rows], pa.large_string()))
    ends = np.cumsum(words.lengths)
    wanted = [np.unique(words.codes[end - n:end]) for n, end in zip(words.lengths, ends)]
    return Queries([r.item for r in rows], words.dictionary, wanted)


def forward(docs: DataFrame, terms: list[bytes], *, key: str, text: str) -> DataFrame:
    """key, n (words), terms (places in `terms`, ascending) and tfs per row."""
    size = max(len(terms), 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.large_binary())
        for part in in_parts(batches):
            words = words_of(part.column("text"))
            place = pc.fill_null(pc.index_in(pa.array(words.dictionary, pa.large_binary()), value_set=known), -1)
            term = place.to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
            pairs, tf = np.unique(words.row[term >= 0] * size + term[term >= 0], return_counts=True)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(pairs // size, minlength=words.texts))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(words.lengths), pa.ListArray.from_arrays(offsets, pa.array((pairs % size).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))], ["key", "n", "terms", "tfs"])

    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    ints = T.ArrayType(T.IntegerType())
    return rows.mapInArrow(cut, T.StructType([rows.schema["key"], T.StructField("n", T.LongType()), T.StructField("terms", ints),
                                              T.StructField("tfs", ints)]))


def _frequencies(index: DataFrame, size: int) -> np.ndarray:
    """Documents per term, summed by task before they are sent."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=size)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in index.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


class Block:
    """Impact lists of some documents, and where in them each document stands."""

    def __init__(self, keys: pa.Array, n: np.ndarray, term: np.ndarray, tf: np.ndarray, ends: np.ndarray,
                 weights: np.ndarray, total_docs: int, total_words: int):
        self.keys, self.ends = keys, ends
        sizes = np.diff(ends, prepend=0)
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 50 + (50 * n * total_docs) // max(total_words, 1)
        self.term, self.impact = term, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((-self.impact, term))
        self.listed_doc, self.listed_impact = doc[order], self.impact[order]
        lengths = np.bincount(term, minlength=len(weights))
        self.list_end = np.cumsum(lengths)
        self.list_start = self.list_end - lengths
        self.position = np.empty(len(term), np.int64)
        self.position[order] = np.arange(len(term)) - self.list_start[term[order]]
        self.tie = _places(keys)

    def entries_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of the given documents, and for each the document's place among them."""
        start = np.where(docs > 0, self.ends[docs - 1], 0)
        sizes = self.ends[docs] - start
        at = np.repeat(np.arange(len(docs)), sizes)
        return np.arange(len(at)) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes), at


def best_positions(block: Block, wanted: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of the block that may be among the `top` best and their scores, and the number of positions read.

    Those scoring below `least`, the score of as many documents known already, need not be found.
    """
    start, end = block.list_start[wanted], block.list_end[wanted]
    lists, start, size = wanted[end > start], start[end > start], (end - start)[end > start]
    mine = np.full(len(block.list_start), -1)
    mine[lists] = np.arange(len(lists))
    offset = np.cumsum(size) - size
    marked = np.zeros(size.sum(), bool)
    best = np.zeros(len(lists), np.int64)  # the first position of each list that is not marked
    met = np.zeros(len(block.ends), bool)
    docs, scores, kth, step, read = np.zeros(0, np.int64), np.zeros(0, np.int64), least, STEP, 0
    while True:
        open_ = best < size
        bound = int(block.listed_impact[(start + best)[open_]].sum())
        if bound == 0 or bound < kth:  # a document at the k-th score may still win by its key, so equality goes on
            return docs, scores, read
        many = np.minimum(step, size - best)
        places = np.arange(many.sum()) + np.repeat(start + best - (np.cumsum(many) - many), many)
        read += len(places)
        new = np.unique(block.listed_doc[places])
        new = new[~met[new]]
        met[new] = True
        entry, at = block.entries_of(new)
        which = mine[block.term[entry]]
        entry, at, which = entry[which >= 0], at[which >= 0], which[which >= 0]
        marked[offset[which] + block.position[entry]] = True
        sums = np.zeros(len(new), np.int64)
        np.add.at(sums, at, block.impact[entry])
        docs, scores = np.concatenate([docs, new]), np.concatenate([scores, sums])
        if len(scores) >= top:
            kth = max(least, int(np.partition(scores, -top)[-top]))
            docs, scores = docs[scores >= kth], scores[scores >= kth]
        for i in np.flatnonzero(open_):
            rest = marked[offset[i] + best[i]:offset[i] + size[i]]
            ahead = int(rest.argmin())
            best[i] = size[i] if rest[ahead] else best[i] + ahead
        step *= 2


def _searched(index: DataFrame, queries: Queries, weights: np.ndarray, total_docs: int, total_words: int, top: int,
              postings: int) -> DataFrame:
    """query, key and score of every task's best documents per query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.RecordBatch] = {}

        def judge(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            keys, lists, tfs = (rows[c].chunk(0) for c in ("key", "terms", "tfs"))
            block = Block(keys, rows["n"].to_numpy(), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                          tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                          np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)), weights, total_docs, total_words)
            for q, wanted in enumerate(queries.wanted):
                known = best.get(q)
                least = known["score"][-1].as_py() if known is not None and len(known) == top else 0
                docs, scores, _ = best_positions(block, wanted, top, least)
                docs, scores = docs[scores > 0], scores[scores > 0]
                first = np.lexsort((block.tie[docs], -scores))[:top]
                if not len(first):
                    continue
                found = pa.RecordBatch.from_arrays([keys.take(pa.array(docs[first])), pa.array(scores[first])], ["key", "score"])
                if known is not None:
                    both = pa.Table.from_batches([known, found]).combine_chunks().to_batches()[0]
                    by_score = np.lexsort((_places(both["key"]), -both["score"].to_numpy()))
                    found = both.take(pa.array(by_score[:top]))
                best[q] = found

        held, size = [], 0
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                held.append(part)
                size += len(part.column("terms").flatten())
                if size >= postings:
                    judge(held)
                    held, size = [], 0
        if held:
            judge(held)
        for q, found in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q)), found["key"], found["score"]], ["query", "key", "score"])

    fields = [T.StructField("query", T.LongType()), index.schema["key"], T.StructField("score", T.LongType())]
    return index.where(F.size("terms") > 0).mapInArrow(search, T.StructType(fields))


def _places(keys: pa.Array) -> np.ndarray:
    """Place of every key in their order, a missing one first."""
    out = np.empty(len(keys), np.int64)
    out[pc.array_sort_indices(keys, null_placement="at_start").to_numpy()] = np.arange(len(keys))
    return out


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The `top` rows of every query, first among the rows of a slice of the tasks, then among all."""
    order = [F.desc("score"), F.asc_nulls_first("key")]
    rows = rows.withColumn("slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    for by in (["query", "slice"], ["query"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return rows.drop("slice")


def rank(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", top: int = TOP, items_at_once: int = ITEMS, postings: int = POSTINGS) -> DataFrame:
    """item, rank (from 1), key and score of the `top` best rows of every item, scores above 0 only.

    Terms are runs of digits, letters and characters beyond ASCII, only A-Z lower-cased. Scores are whole numbers
    (see `Block`), equal ones go by ascending key, a missing key first. A missing or empty text has no terms: such
    a document is never found and does not count, such an item has no rows. Repeated documents are ranked as often
    as they occur, repeated items answered as often. Empty tables give no rows. Other columns are not read.

    Items are dealt into passes of about `items_at_once`, whose terms each task holds; each pass reads the documents
    once. A task holds a block of about `postings` pairs of a document and a term.
    """
    rows = items.select(items[item].alias("item"), items[item_text].cast("string").alias("text")).where(F.length("text") > 0)
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "search-items")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(-(-size.n // items_at_once), -(-size.bytes // ITEM_BYTES), 1)
    out = None
    for i in range(passes):
        mine = rows.where(F.pmod("place", F.lit(passes)) == i)
        found = _answers(docs, _queries(mine.collect()), items.schema[item].dataType, key=key, text=text, top=top, postings=postings)
        out = found if out is None else out.unionByName(found)
    return out


def _answers(docs: DataFrame, queries: Queries, item_type: T.DataType, *, key: str, text: str, top: int, postings: int) -> DataFrame:
    spark, terms = docs.sparkSession, max(len(queries.terms), 1)
    index = stored(forward(docs, queries.terms, key=key, text=text), "search-index")
    totals = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    df = _frequencies(index, terms)
    weights = np.floor(1000 * np.log((2 * totals.docs + 2) / (2 * df + 1))).astype(np.int64)
    best = _best(_searched(index, queries, weights, totals.docs, totals.words, top, postings), top)
    names = T.StructType([T.StructField("query", T.LongType()), T.StructField("item", item_type)])
    known = spark.createDataFrame([(q, k) for q, k in enumerate(queries.keys)], names)  # as many rows as queries of a pass
    return best.join(F.broadcast(known), "query").select("item", F.col("rank").cast("int").alias("rank"), "key", "score")
