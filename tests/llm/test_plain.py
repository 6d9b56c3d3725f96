"""Whole operators against versions that use none of their functions."""

import base64
import math
import os
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from contestlab.llm import digest, quality_model, spans
from tests.llm.test_operators import KEYED, ROWS, edited, prose

# repeated spans, as their docstrings say


def plain_sentences(text):
    """Sentences as (start, end, words), by looking at every window of eight words."""
    found = list(re.finditer(r"\S+\s*", text))
    words = [m[0].rstrip().lower() for m in found]
    cuts = {m.end() for m in re.finditer(r"[.!?,;:]+[\x20\t]+|\n+", text)}
    marked = [any(m.start() < c <= m.end() for c in cuts) for m in found]
    order = [xxhash.xxh3_64_intdigest(w) >> 32 for w in words]
    for i in range(len(words) - 7):
        if not any(marked[i:i + 8]):
            least = min(range(i, i + 8), key=lambda k: (order[k], k))
            cuts.add(found[least].end())
    ends = sorted((cuts | {len(text)}) - {0})
    out, at = [], 0
    for start, end in zip([0, *ends], ends):
        own = []
        while at < len(found) and (found[at].end() <= end or end == len(text)):
            own.append(words[at])
            at += 1
        out.append((start, end, own))
    return out


def plain_runs(text):
    at = [s for s in plain_sentences(text) if s[2]]
    fits = lambda i, j: (n := sum(len(s[2]) for s in at[i:j])) >= 20 and (j - i >= 2 or n >= 40)
    found = set()
    for i in range(len(at)):
        found |= {(i, j) for j in [next((j for j in range(i + 1, len(at) + 1) if fits(i, j)), None)] if j}
        found |= {(k, i + 1) for k in [next((k for k in range(i, -1, -1) if fits(k, i + 1)), None)] if k is not None}
    return [(at[i][0], at[j - 1][1], tuple(w for s in at[i:j] for w in s[2])) for i, j in sorted(found)]


def plain_removal(rows):
    rank = lambda k: -1 if k is None else k
    first = {}
    for key, text in rows:
        for _, _, words in plain_runs(text):
            first[words] = min(first.get(words, 10**9), rank(key))
    out = []
    for key, text in rows:
        gone, seen = set(), set()
        for start, end, words in plain_runs(text):
            if words in seen or first[words] < rank(key):
                gone |= set(range(start, end))
            seen.add(words)
        at = plain_sentences(text) if text else []
        kept = [s for s in at if s[0] not in gone]
        out.append((key, len(at), len(at) - len(kept), "".join(text[s:e] for s, e, _ in kept)))
    return Counter(out)


def test_span_dedup_equals_the_plain_version(spark):
    passage = prose(70)
    rows = [(r[0], r[1] or "") for r in ROWS if len(r[1] or "") < 4000]
    rows += [(1000 + i, prose(15 * i) + " " + passage + " " + prose(9 * i)) for i in range(8)] + [(1100, passage + "\n" + passage), (1101, edited(passage, 2))]
    got = spans.remove_repeats(spark.createDataFrame([(k, t or None) for k, t in rows], "doc_id long, text string").repartition(4)).collect()
    assert Counter((r.key, r.n_sentences, r.n_removed, r.kept) for r in got) == plain_removal(rows)
    assert sum(r.n_removed for r in got) > 20


# fingerprints, as their docstrings say


def plain_levels(raw):
    """Entropy steps of every window of 64 bytes."""
    gain = [0] + [round(n * math.log2(n) * 2**20) for n in range(1, 65)]
    return [(gain[64] - sum(gain[c] for c in Counter(raw[i:i + 64]).values())) * 1000 // gain[64] for i in range(len(raw) - 63)]


def plain_chain(pieces):
    """Bits of each filter of 128 features."""
    pieces = list(dict.fromkeys(pieces))
    bits = []
    for at in range(0, len(pieces), 128):
        own = set()
        for p in pieces[at:at + 128]:
            h = xxhash.xxh3_128_digest(p)
            own |= {int.from_bytes(h[2 * k:2 * k + 2], "little") % 2048 for k in range(5)}
        bits.append(own)
    return bits


def plain_print(text, rank):
    raw, short = text.encode(), []
    if len(text) < 1024:
        short = [raw[i:i + 6] for i in range(max(len(raw) - 5, min(len(raw), 1)))]
    if len(text) < 512:
        return [], plain_chain(short)
    ranks = [rank[x] for x in plain_levels(raw)]
    won = Counter(min(range(i, i + 64), key=lambda k: (ranks[k], k)) for i in range(len(ranks) - 63))
    chosen = sorted(i for i, n in won.items() if n >= 16) or sorted(i for i, n in won.items() if n == max(won.values()))
    return plain_chain([raw[i:i + 64] for i in chosen]), plain_chain(short)


def plain_likeness(a, b):
    for kind in (1, 0):
        x, y = sorted((a[kind], b[kind]), key=lambda c: (len(c), sum(map(len, c))))
        if x and y:
            score = 0
            for own in x:
                best = 0.0
                for other in y:
                    chance = len(own) * len(other) / 2048
                    best = max(best, (len(own & other) - chance) / max(min(len(own), len(other)) - chance, 1e-9))
                score += len(own) * min(best, 1)
            return score / sum(map(len, x))
    return None  # by sampled features, or empty


def test_fingerprints_equal_the_plain_version(spark):
    texts = [r[1] or "" for r in KEYED if len(r[1] or "") < 2500][:45]
    rows = [(i, t) for i, t in enumerate(texts)]
    count = Counter(x for t in texts for x in plain_levels(t.encode()))
    rank = {x: i for i, x in enumerate(sorted(range(1001), key=lambda x: (count[x], x)))}
    got = {r.key: r for r in digest.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    shown = lambda c: [np.flatnonzero(np.unpackbits(np.frombuffer(f, np.uint8))).tolist() for f in c]
    parts = lambda f: [[set(x) for x in shown([raw[i:i + 256] for i in range(0, len(raw), 256)])]
                       for raw in (base64.b64decode(x) for x in (f.split(".") + ["", ""])[:2])]
    prints = {t: plain_print(t, rank) for t in texts}
    compared = 0
    for i, t in enumerate(texts):
        other = texts[(i + 1) % len(texts)]
        n = len(t) // 4
        changed = t[:len(t) - n] + other[:n]
        edit = plain_print(changed, rank)
        assert parts(got[i].fingerprint) == list(prints[t]) and parts(got[i].edited_fingerprint) == list(edit), i
        for value, want in ((got[i].near_edited, plain_likeness(prints[t], edit)), (got[i].near_next, plain_likeness(prints[t], prints[other]))):
            if want is not None:
                compared += 1
                assert value == pytest.approx(want, abs=1e-5), (i, len(t), len(other))
    assert compared > 60


# quality classifier


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(4)
    stats = rng.normal(size=(900, 5)) * [1, 2, 0.5, 3, 1] + [0, 5, 0, -2, 1]
    label = (np.abs(stats[:, 0]) + rng.normal(size=900) * 0.3 < 0.8).astype(float)
    rows = spark.createDataFrame([(i, [float(x) for x in s]) for i, s in enumerate(stats)], "key long, stats array<double>")
    labels = spark.createDataFrame([(i, float(y)) for i, y in enumerate(label)], "doc_id long, quality double")
    return stats, label, quality_model.fit(rows, labels, key="doc_id", label="quality", features=200)


def test_random_features_approximate_the_kernel(fitted):
    stats, _, _ = fitted
    rng = np.random.default_rng(9)
    wide = quality_model.Model(stats.mean(axis=0), stats.std(axis=0), rng.normal(size=(5, 20_000)) / np.sqrt(5), rng.uniform(0, 2 * np.pi, 20_000),
                               np.zeros(20_001), (np.zeros(1), np.zeros(1)))
    x = wide.features(stats[:60])[:, :-1]
    z = (stats[:60] - stats.mean(axis=0)) / stats.std(axis=0)
    kernel = np.exp(-((z[:, None] - z[None, :]) ** 2).sum(axis=2) / (2 * 5))
    assert np.abs(x @ x.T - kernel).max() < 0.06


def test_summed_equations_equal_one_ridge_regression(fitted):
    import zlib

    stats, label, model = fitted
    part = np.array([zlib.crc32(str(i).encode()) % 4 for i in range(900)])
    z = np.clip((stats - stats.mean(axis=0)) / stats.std(axis=0), -8, 8)
    x = np.hstack([np.cos(z @ model.directions + model.phases) * np.sqrt(2 / 200), np.ones((900, 1))])
    mine = part < 2
    want = np.linalg.solve(x[mine].T @ x[mine] + quality_model.RIDGE * mine.sum() * np.eye(201), x[mine].T @ label[mine])
    assert np.allclose(x @ want, model.raw(stats), atol=1e-6)
    held = part == 2
    assert ((model.score(stats[held]) > 0.5) == label[held]).mean() > max(label.mean(), 1 - label.mean()) + 0.1  # labels are noisy
    raw, order = model.raw(stats[part == 3]), np.argsort(model.raw(stats[part == 3]), kind="stable")
    fit = label[part == 3][order].copy()
    for _ in range(len(fit)):  # means of the pieces of least sum that are too high, until the order is right
        bad = next((i for i in range(len(fit) - 1) if fit[i] > fit[i + 1] + 1e-12), None)
        if bad is None:
            break
        low = bad
        while low > 0 and fit[low - 1] == fit[bad]:
            low -= 1
        high = bad + 1
        while high + 1 < len(fit) and fit[high + 1] == fit[bad + 1]:
            high += 1
        fit[low:high + 1] = fit[low:high + 1].mean()
    x, y = quality_model.isotonic(raw, label[part == 3])
    assert (np.diff(y) > 0).all() and np.allclose(np.unique(np.round(fit, 9)), np.round(y, 9))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the generated tables")
def test_held_out_accuracy_of_the_quality_classifier(spark):
    out = entry.queries()["op10_quality_classifier"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = out.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    right = sum(r.quality == r.predicted for r in got) / len(got)
    good = [r.predicted for r in got if r.quality == 1]
    print("held-out accuracy", right, "of good ones kept", sum(good) / len(good), "of", len(got))
    assert right >= 0.97 and sum(good) >= 0.98 * len(good)
