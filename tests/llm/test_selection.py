"""Resampling, toxicity and ranked search against brute force, on rows with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import os
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contestlab.llm import resample, search, toxicity
from contestlab.llm.words import in_parts, words_of
from tests.llm.test_operators import ROWS, SCHEMA, prose

TERM = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# words

def test_words_of_slices_equal_the_pattern():
    texts = [r[1] for r in ROWS] + ["A-Z ÀÉ x\x00y", " nbsp", "0.5", "-", "x" * 10**6, "word " * 200_000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    got = []
    for part in in_parts([batch.slice(3), batch.slice(0, 3)], part_bytes=3000):
        words = words_of(part.column("text"))
        ends = np.cumsum(words.lengths)
        got += [[words.dictionary[i].decode() for i in words.codes[e - n:e]] for n, e in zip(words.lengths, ends)]
    assert got == [terms(t) for t in texts[3:] + texts[:3]]


# resampling

def features(text):
    words = terms(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def resampled(rows, target, buckets, least, share):
    s, t = np.zeros(buckets), np.zeros(buckets)
    for text in [r[1] for r in rows]:
        for f in features(text):
            s[crc32(f.encode()) % buckets] += 1
    for text in target:
        for f in features(text):
            t[crc32(f.encode()) % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for r in rows:
        own = [gain[crc32(f.encode()) % buckets] for f in features(r[1])]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], len(terms(r[1])), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((o for o in out if o[1] >= least), key=lambda o: (-o[4], o[0] is not None, o[0] or 0))
    return out, able[:share[0] * len(able) // share[1]]


@pytest.mark.parametrize("share", [(25, 100), (1, 1), (0, 1)])
def test_resampling(spark, docs, nothing, share):
    target = [prose(30), None, "", "tok tok tok", "Éa ñ"]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, wanted, buckets=50, least_words=5, share=share).collect()
    want, drawn = resampled(ROWS, target, 50, 5, share)
    assert Counter((r.key, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    ranks = sorted((r["rank"], r.key, r.score) for r in got if r["rank"] is not None)
    assert ranks == [(i, o[0], o[4]) for i, o in enumerate(drawn, 1)]
    assert resample.resample(nothing, wanted).isEmpty()


def test_resampling_carries_texts_and_does_without_target(docs, nothing):
    got = resample.resample(docs, nothing, buckets=50, carry=["text", "key"]).collect()
    assert Counter((r.key, r.carried.text, r.carried.key) for r in got) == Counter((r[0], r[1], r[5]) for r in ROWS)


def test_rows_alike_are_numbered_in_several_ranges(spark):
    rows = spark.createDataFrame([(1, None)] * 900 + [(2, i) for i in range(100)], "score int, key long").repartition(7)
    got = resample.numbered(rows, [F.desc("score"), F.asc_nulls_first("key")], "no").collect()
    assert sorted(r.no for r in got) == list(range(1, 1001))
    assert sorted((r.no, r.key) for r in got if r.score == 2) == [(i + 1, i) for i in range(100)]


# ranked search

ITEMS = [(1, ROWS[5][1][:200]), (2, "tok TOK the same line"), (3, None), (4, ""), (5, "nosuchword"), (6, ROWS[20][1]), (6, ROWS[20][1]),
         (None, "Éa 日本語 one b"), (7, "!!")]


def found(rows, items, top):
    parts = [Counter(terms(r[1])) for r in rows]
    docs, words = sum(map(bool, parts)), sum(sum(p.values()) for p in parts)
    out = []
    for item, text in items:
        scored = []
        wanted = set(terms(text))
        weight = {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * sum(t in p for p in parts) + 1))) for t in wanted}
        for r, p in zip(rows, parts):
            m = 50 + (50 * sum(p.values()) * docs) // max(words, 1)
            score = sum(weight[t] * ((10**9 * p[t]) // (1000 * p[t] + 20 * m)) for t in wanted if t in p)
            scored += [(r[0], score)] if score > 0 else []
        scored.sort(key=lambda x: (-x[1], x[0] is not None, x[0] or 0))
        out += [(item, i, *x) for i, x in enumerate(scored[:top], 1)]
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"top": 3, "postings": 40}, {"top": 10, "postings": 400, "items_at_once": 2}])
def test_ranked_search(spark, docs, nothing, options):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = search.rank(docs, items, **options)
    assert Counter(map(tuple, got.collect())) == found(ROWS, ITEMS, options.get("top", 50))
    assert [t for _, t in got.dtypes] == ["int", "int", "bigint", "bigint"]
    assert search.rank(nothing, items).isEmpty() and search.rank(docs, items.limit(0)).isEmpty()


def blocks(n, lists, rng):
    pairs = np.unique(rng.integers(0, n * lists, 6 * n))
    doc, term = pairs // lists, (pairs % lists).astype(np.int64)
    tf = rng.integers(1, 4, len(pairs)) + np.where(rng.random(len(pairs)) < 0.01, 60, 0)
    return search.Block(pa.array(rng.permutation(n)), rng.integers(5, 90, n), term, tf, np.cumsum(np.bincount(doc, minlength=n)),
                        rng.integers(1, 5000, lists), n, 40 * n)


def test_positions_stop_early_and_miss_nothing():
    rng, saved = np.random.default_rng(3), 0
    for trial in range(60):
        n, lists, top = int(rng.integers(20, 3000)), int(rng.integers(2, 30)), int(rng.integers(1, 12))
        block = blocks(n, lists, rng)
        wanted = rng.choice(lists, size=min(lists, int(rng.integers(1, 9))), replace=False)
        total = np.zeros(n, np.int64)
        doc = np.repeat(np.arange(n), np.diff(block.ends, prepend=0))
        mine = np.isin(block.term, wanted)
        np.add.at(total, doc[mine], block.impact[mine])
        kth = max(1, np.sort(total)[-top])
        least = int(rng.choice([0, kth, total.max()]))
        docs, scores, read = search.best_positions(block, wanted, top, least)
        want = {(int(d), int(total[d])) for d in np.flatnonzero(total >= max(kth, least))}
        assert want <= set(zip(docs.tolist(), scores.tolist())) and (total[docs] == scores).all()
        saved += read < mine.sum()
    assert saved > 20  # lists that are read to the end are the exception


# toxicity

def test_label_model_finds_accuracies_and_links(spark):
    rng = np.random.default_rng(5)
    n, right, cast = 20_000, np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9]), 0.7
    y = (rng.random(n) < 0.3).astype(int)
    votes = np.where(rng.random((n, 7)) < right, y[:, None], 1 - y[:, None]) + 1
    votes = np.where(rng.random((n, 7)) < cast, votes, 0)
    votes[:, 6] = np.where(rng.random(n) < 0.9, votes[:, 5], votes[:, 6])  # nearly a copy of the voter before
    known = rng.random(n) < 0.05
    rows = [(bytes(v.tolist()), float(c) if k else None) for v, c, k in zip(votes.astype(np.uint8), y, known)]
    table = spark.createDataFrame(rows, "votes binary, y double").groupBy("votes", "y").agg(F.count(F.lit(1)).alias("n"))
    model = toxicity.fit_labels(table.repartition(3), 7)
    assert model.parent[6] == 5 or model.parent[5] == 6
    assert np.abs(model.accuracies()[:5] - right[:5]).max() < 0.03 and abs(model.prior[1] - 0.3) < 0.03
    guess = model.posterior(votes.astype(np.int64)) > 0.5
    naive = (votes == 2).sum(axis=1) > (votes == 1).sum(axis=1)
    assert (guess == y).mean() > max(0.95, (naive == y).mean())


def abused(rng, i):
    text = prose(rng.randint(60, 150), rng).split(" ")
    for _ in range(4):
        text.insert(rng.randrange(len(text)), rng.choice(["Grumf", "snorgel", "vexqu"]) + rng.choice(["", "ant", "ist!", "é"]))
    return " ".join(text)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    rows = [(i, abused(rng, i) if i % 6 == 0 else prose(rng.randint(60, 150), rng), "en", "a", None, "", i, "r") for i in range(900)]
    return rows, [(r[0], None if i % 50 == 3 else int(i % 6 == 0)) for i, r in enumerate(rows) if i % 2 == 0 or i % 3]


def test_toxicity_learns_stems_and_scores_held_out_rows(spark, labelled):
    rows, marks = labelled
    hard = [(900 + i, r[1], *r[2:]) for i, r in enumerate(ROWS)] + [(None, rows[0][1], *rows[0][2:]), rows[0], (None, rows[1][1], *rows[1][2:])]
    docs = spark.createDataFrame(rows + hard, SCHEMA).repartition(4)
    labels = spark.createDataFrame([*marks, marks[0], (None, 1), (10**9, 1)], "doc_id long, toxic int")
    out = toxicity.classify(docs, labels)
    assert out.columns == ["key", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) + len(hard)
    by_text, score = {}, {}
    text_of = {r[0]: r[1] for r in rows + hard if r[0] is not None}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (crc32(("" if r.key is None else str(r.key)).encode()) % 4 == 2)
        if r.key is not None:
            by_text.setdefault(text_of[r.key] or "", set()).add(r.score)
            score[r.key] = r.score
    assert all(len(s) == 1 for s in by_text.values())  # equal texts score equal
    held = [i for i in range(900) if crc32(str(i).encode()) % 4 == 2]
    assert sum((score[i] >= 0.3) == (i % 6 == 0) for i in held) >= 0.98 * len(held)
    assert sum(score[r[0]] >= 0.3 for r in hard if r[0] is not None and r[0] >= 900) <= 2


def test_held_out_labels_change_nothing(spark, labelled):
    rows, marks = labelled
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(k, 1 - y if y is not None and crc32(str(k).encode()) % 4 == 2 else y) for k, y in marks]
    run = lambda m: {r.key: round(r.score, 9) for r in toxicity.classify(docs, spark.createDataFrame(m, "doc_id long, toxic int")).collect()}
    assert run(marks) == run(flipped)


def test_toxicity_without_labels_or_rows(spark, docs, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.classify(docs, none).collect())
    assert toxicity.classify(nothing, none).isEmpty()
    one = spark.createDataFrame([(r[0], 1) for r in ROWS[:20]], "doc_id long, toxic int")
    assert toxicity.classify(docs, one).count() == len(ROWS)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the generated tables")
def test_held_out_toxic_documents_are_caught(spark):
    """Junk is labelled toxic at random, so documents of good quality tell. (The smaller tables have two labelled toxic
    documents in some languages: at sf0.01, 8 of 11 held-out ones are caught, 3 German ones are not.)"""
    out = entry.queries()["op12_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1")
    got = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    caught = [r.predicted for r in got if r.toxic]
    left = [r.predicted for r in got if not r.toxic]
    assert sum(caught) >= 0.98 * len(caught) and sum(left) <= 0.02 * len(left)
