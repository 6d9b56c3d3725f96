"""Each operator against a brute-force version, on texts with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contestlab.llm import bpe, digest, lines, mixing, near, quality_model, quality_rules, queries, secrets, sharding, spans
from contestlab.llm.common import WORD

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, t1 int, rank string"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(300)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) + ("." if rng.random() < 0.12 else "") for _ in range(n))


def edited(text, changes, rng=RNG):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = "x" + rng.choice(VOCAB)
    return " ".join(words)


def sample_rows():
    base, passage = prose(220), prose(70)
    texts = [None, "", "   \n\t", "one", "a\n\nb\n", base, base, edited(base, 3), edited(base, 9), edited(base, 40),
             "the same line here\n" + prose(60), "THE SAME LINE HERE \nother\nthe same line here", prose(40) + " " + passage + " " + prose(40),
             passage, prose(30) + "\n" + passage, "x" * 5000, prose(3000), "Éa ñ 日本語 😀 " * 30, prose(12), prose(12), "tok " * 200]
    texts += [edited(base, i % 5) for i in range(30)] + [prose(RNG.randint(1, 120)) for _ in range(60)]
    rows = [(i * 3, t, [None, "en", "de"][i % 3], [None, "a", "b", "c"][i % 4], None, f"k{i}", i, None) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (9, "other text under a used key", "en", "a", 1, "", 1, "r"), (None, base, "en", "a", 1, "", 1, "r"),
                   (None, "no key at all\nthe same line here", None, None, None, None, None, None)]


ROWS = sample_rows()
KEYED = [r for i, r in enumerate(ROWS) if r[0] is not None and r[0] not in {q[0] for q in ROWS[:i]}]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.createDataFrame(KEYED, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# mixing

def mixed(df):
    return mixing.mix_sources(df, "doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)), F.array("source"))


def test_mix_meets_targets(docs, nothing):
    mix = mixed(docs)
    rows = mix.rows.collect()
    assert len(rows) == len(ROWS) and mixed(nothing).rows.isEmpty()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixed(docs.repartition(5)).rows.collect()), key=repr)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    taken = Counter()
    for r in rows:
        taken[r.pattern[0]] += r.taken
    assert all(int(mix.targets[s]) == taken[s] for s in mix.targets)
    assert abs(sum(mix.targets.values()) - sum(mix.sizes.values())) < 1e-6


def test_targets_stop_at_the_limit():
    assert mixing.targets_of({"a": 1, "b": 99}, {"a": 5, "b": 2}) == {"a": 3.0, "b": 97.0}
    assert mixing.targets_of({"a": 0}, {"a": 5}) == {"a": 0.0}
    assert mixing.cycled_weights([None, "b", "a", "c"]) == {"a": 5, "b": 2, "c": 1, None: 5}


def test_flow_against_all_assignments():
    rng = random.Random(2)
    for _ in range(40):
        patterns = {("a",): rng.randint(0, 3), ("a", "b"): rng.randint(0, 3), ("b", "c"): rng.randint(0, 3)}
        quota = {s: rng.randint(0, 4) for s in "abc"}
        load = mixing.route(patterns, quota, 2)
        best = None
        for ab in range(7):
            for bc in range(7):
                for x in range(ab + 1):  # words of (a, b) for a
                    for y in range(bc + 1):  # words of (b, c) for b
                        a = min(quota["a"] - x, 2 * patterns["a",])
                        if ab > 2 * patterns["a", "b"] or bc > 2 * patterns["b", "c"] or a < 0 or ab - x + y > quota["b"] or bc - y > quota["c"]:
                            continue
                        cost = sum(max(0, n - patterns[p]) for p, n in ((("a",), a), (("a", "b"), ab), (("b", "c"), bc)))
                        best = max(best or (-1, 0), (a + ab + bc, -cost))
        cost = sum(max(0, load[p] - patterns[p]) for p in patterns)
        assert (sum(load.values()), -cost) == best


# byte-level BPE

def test_bpe_equals_the_library(spark, docs, nothing):
    import public_tokenizers
    import tiktoken

    v = queries.vocabulary()
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    hard = ["a" * 700, "." * 300 + "-" * 333 + " " * 400 + "\n" * 50, "don't I'll 12345 <|endoftext|>   x İ", "aaaaabaaaaab",
            "\x00\x01\t\r\n  \v\f x\x85y", "=-=-" * 60] + ["".join(RNG.choice("a-. =_0Is") for _ in range(60)) for _ in range(60)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string"))
    texts = Counter()
    for t in [r[1] or "" for r in ROWS] + hard:
        ids = enc.encode_ordinary(t)
        texts[" ".join(map(str, ids)), len(ids), sha(" ".join(map(str, ids))), sha(t)] += 1
    got = bpe.encode_documents(df, v, with_ids=True).collect()
    assert Counter((r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == texts
    for options in ({"sample": 0, "common": 0}, {"sample": 20_000, "common": 40}):  # what is folded beforehand changes nothing
        again = bpe.encode_documents(df, v, with_ids=True, **options).collect()
        assert Counter((r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in again) == texts
    assert bpe.encode_documents(nothing, v).isEmpty()


def test_bpe_table_ends_where_rows_do_not_fit():
    rights = [*range(16), *range(16, 256, 16)]  # two rows of these meet wherever they lie less than a row apart
    tokens = [bytes([b]) for b in range(256)] + [bytes([a, b]) for a in range(256) for b in rights]
    for v in (bpe.Vocabulary({t: i for i, t in enumerate(tokens)}, "."), queries.vocabulary()):
        merges = v.merges()
        assert {a + b for a, b in merges} == {t for t in v.ranks if len(t) > 1}
        table, ranks = bpe.Displaced.of(v, merges), v.ranks
        found = lambda a, b: table.slots[at] ^ (a << 32) if 0 <= (at := table.starts[a] + b) < len(table.slots) else 1 << 32  # noqa: E731, B023
        assert all(found(ranks[a], ranks[b]) == ranks[a + b] for a, b in merges)
        others = {(RNG.randrange(len(ranks)), RNG.randrange(len(ranks))) for _ in range(5000)} - {(ranks[a], ranks[b]) for a, b in merges}
        assert all(found(a, b) >= 1 << 32 for a, b in others)


def test_bpe_of_vocabularies_in_any_order(spark):
    import tiktoken

    for seed in range(3):
        rng = random.Random(seed)
        longer = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(60)})
        rng.shuffle(longer)  # parts may rank behind what they make, and some tokens are never made
        v = bpe.Vocabulary({t: i for i, t in enumerate([bytes([b]) for b in range(256)] + longer)}, "[^ ]+| ")
        enc = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=v.ranks, special_tokens={})
        texts = ["".join(rng.choice("aabbcc ") for _ in range(30)) for _ in range(60)] + ["".join(rng.choice("abc") for _ in range(150)) for _ in range(30)]
        got = bpe.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), v, with_ids=True, sample=0).collect()
        assert {r.key: r.ids for r in got} == {i: " ".join(map(str, enc.encode_ordinary(t))) for i, t in enumerate(texts)}


# secrets

BASE = [("assign", re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    return sorted((m.start(), k, m.end(), name) for k, (name, p, group, least) in enumerate(BASE) for m in p.finditer(text) if len(m[group]) >= least)


def test_secret_scan(spark, nothing):
    rng = random.Random(9)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    hidden = "qZ7xK2mP9vR4tW8yB3nL6jH1" + "cF5dG0sA"
    texts = [f'pre 😀 PassWord = "{h[:20]}" mid {h} end' for h in hexes] + [prose(80) + " parse_http_response_header2 " for _ in range(60)]
    texts += [None, "", "secret=token : abcdefgh", "token=api_key=secretvalue", "AKIA" + "B" * 15 + " AKIA" + "C" * 16, f"see {hidden} there",
              f"call parse_http_response_header2 now", "é" * 50 + "api-key api_key:'abc.def-1'"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    got = {r.key: r.spans for r in secrets.scan(df).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.end, s.name) for s in got[i] if s.kind < 3] == base_spans(t or ""), t
    added = {texts[i][s.start:s.end] for i, spans_ in got.items() for s in spans_ if s.kind == 3}
    assert added == {hidden}
    assert secrets.scan(nothing).isEmpty()


def test_very_long_runs_neither_recurse_nor_stall(spark):
    runs = ["-", "_", "/", "+", "=", "a", "A", "0", ".", "_b", "1-", "a1", "1a", "Z9_", "password", "token=", "AKIA", "f0", " ", "\n", "'"]
    texts = ["see a" + (run * (10**6 // len(run))) + " end" for run in runs] + ["a" + "-" * 2000 + " end", "a" + "_b" * 20_000]
    tokens = " ".join(f"name{i}_of_part" for i in range(100_000))
    rng = random.Random(4)
    mixed = [" ".join("".join(rng.choice("abcXYZ0189") for _ in range(16)) for _ in range(3000)) + " token=abcdef123"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, tokens, *mixed])], "doc_id long, text string").repartition(4)
    began = time.time()
    got = {r.key: r.spans for r in secrets.scan(df).collect()}
    assert time.time() - began < 60
    for i, text in enumerate([*texts, tokens, *mixed]):
        assert [(x.start, x.kind, x.end, x.name) for x in got[i] if x.kind < 3] == base_spans(text)


def test_spans_of_many_matches_equal_those_of_few(spark, monkeypatch):
    text = " ".join(f"x{'y' * (i % 5)} token_{i:08d}" for i in range(700))
    df = spark.createDataFrame([(text,)], "t string")
    got = [tuple(x) for x in df.select(secrets.matches_at(F.col("t"), "token_[0-9]{8}").alias("m")).first().m]
    assert got == [(m.start(), m.end(), m[0]) for m in re.finditer("token_[0-9]{8}", text)]
    monkeypatch.setattr(secrets, "BLOCK", 7)
    again = [tuple(x) for x in df.select(secrets.matches_at(F.col("t"), "token_[0-9]{8}").alias("m")).first().m]
    assert again == got


def test_short_and_digit_free_secrets(spark):
    rng = random.Random(10)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    hidden = ["qZ7xK2mP9vR4tW8y", "hQzXvKpWrTjYnLsBmGqD", "kR8vZq2Lx7Wm", "Xw7QpZr9TkLs4vNy"]
    ordinary = ["-" * 30, "=-" * 15, "a" * 25, "4417467210607149", "2024-05-12-2024", "ABCD_EFGH_ABCD_EFGH"]
    numbers = [f"{rng.randrange(10**15, 10**16)} and {rng.randrange(10**4)}-{rng.randrange(10**2):02}-{rng.randrange(10**4):04}" for _ in range(60)]
    texts = [f"password={h[:20]} mid {h} end" for h in hexes] + [prose(80) + " abcd_efgh_abcd_efgh " + n for n in numbers]
    texts += [f"see {h} there" for h in hidden[:3]] + [f"see {hidden[3]}{hexes[0][:30]} there"] + [f"see {x} there" for x in ordinary]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r.spans for r in secrets.scan(df).collect()}
    added = sorted(texts[i][s.start:s.end] for i, spans_ in got.items() for s in spans_ if s.kind == 3)
    assert added == sorted(hidden) and all(s.value == texts[i][s.start:s.end] for i, spans_ in got.items() for s in spans_ if s.kind == 3)


# fingerprints

def test_levels_are_entropies():
    data = np.frombuffer((prose(400) + "é" * 80 + "a" * 200).encode(), np.uint8)
    found = digest.levels(data)
    for i in range(0, len(found), 17):
        count = np.bincount(data[i:i + 64])
        entropy = -sum(c / 64 * np.log2(c / 64) for c in count if c)
        assert abs(found[i] - entropy / 6 * digest.LEVELS) <= 1.01


def test_fingerprints(keyed, docs, nothing):
    table = digest.rarity(keyed)
    rows = sorted((r[0], r[1] or "") for r in KEYED)
    got = {r.key: r for r in digest.fingerprints(keyed).collect()}
    raw = {k: t.encode() for k, t in rows}
    chain = {k: digest.filters(raw[k], digest.select([raw[k]], table)[0]) for k, _ in rows}
    for (k, t), (following, other) in zip(rows, rows[1:] + rows[:1]):
        e = t[:len(t) - len(t) // 4] + other[:len(t) // 4]
        own = digest.filters(e.encode(), digest.select([e.encode()], table)[0])
        r = got[k]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), sha(e), digest.shown(chain[k]), digest.shown(own))
        assert r.near_edited == digest.likeness(chain[k], own) and r.near_next == digest.likeness(chain[k], chain[following])
        assert 0 <= r.near_next <= 1 and (len(t) < 200 or len(set(t.split())) < 20 or r.near_edited > 0.4)
    assert digest.fingerprints(docs).count() == len(ROWS) and digest.fingerprints(nothing).isEmpty()


def test_edited_texts_of_every_length_are_alike():
    rng = random.Random(14)
    table = np.random.default_rng(3).permutation(digest.LEVELS + 1).astype(np.int16)
    text = prose(400, rng)
    for n in [*range(150, 601), *range(601, 1400, 7)]:
        for following in ("", "short", prose(20, rng)):
            r = digest.compare([text[:n], following], table)[0]
            assert r[0] == n and r[4] > 0.5, (n, following, r[4])
    for n in (185, 505, 1020):  # a near copy on the other side of a bound
        a, b = ((x, digest.filters(x, digest.select([x], table)[0])) for x in (text[:n].encode(), text[:n + 10].encode()))
        assert digest.likeness(a[1], b[1]) > 0.6


def test_texts_of_unlike_length_share_a_kind():
    rng = random.Random(15)
    table = np.random.default_rng(3).permutation(digest.LEVELS + 1).astype(np.int16)
    chains = lambda t: digest.filters(t.encode(), digest.select([t.encode()], table)[0])
    long, other = prose(700, rng), "".join(rng.choice("klmnopqrst .") for _ in range(4000))
    for n in (300, 400, 505, 511):
        for at in (0, 700, 2000):
            assert digest.likeness(chains(long[at:at + n]), chains(long)) > 0.5  # its features may lie in two filters of the long one
        assert digest.likeness(chains(other[:n]), chains(long)) < 0.2
    assert digest.likeness(chains(""), chains(long)) == 0 == digest.likeness(chains("abc"), chains(long))


# lines

def test_line_dedup(docs, nothing):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    first = {}
    rank = lambda k: -1 if k is None else k
    for r in ROWS:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), 10**9), rank(r[0]))
    want = Counter()
    for r in ROWS:
        all_lines = (r[1] or "").split("\n")
        kept = [x for x in all_lines if first.get(key(x), rank(r[0])) == rank(r[0])]
        want[r[0], len(all_lines), len(all_lines) - len(kept), "\n".join(kept)] += 1
    for batches, fan in ((4, 3), (7, 2), (1, 2)):
        got = lines.dedup_lines(docs, batches=batches, fan=fan).collect()
        assert Counter((r.key, r.n_lines, r.n_dropped, r.kept) for r in got) == want
    assert lines.dedup_lines(nothing).isEmpty()


# sharding

@pytest.mark.parametrize("rounds", [0, 3])
def test_sharding(spark, docs, nothing, rounds):
    def run(df):
        text = F.coalesce("text", F.lit(""))
        return sharding.shard_documents(df, F.col("doc_id"), F.octet_length(text).cast("long") + 1, F.crc32(text), F.md5(text), rounds=rounds)

    many = docs.unionByName(spark.range(300).selectExpr("id + 10000 AS doc_id", "concat('t', id % 90) AS text", "'' lang", "'' source", "1L n_chars",
                                                        "'' key", "1 t1", "'' rank"))
    rows = run(many).collect()
    count = Counter(r.shard for r in rows)
    assert len(rows) == len(ROWS) + 300 and set(count) == set(range(8)) and max(count.values()) - min(count.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(count[s])) for s in count)
    if rounds:
        places = defaultdict(set)
        for r in rows:
            places[r.crc].add(r.shard)
        assert sum(len(p) > 1 for p in places.values()) <= 5
    assert run(nothing).isEmpty() and run(docs.limit(3)).count() == 3


def sharded(spark, groups, alone):
    """Shards of the rows of each group, for groups of the given sizes and documents without links."""
    edges = np.cumsum([0, *groups]).tolist()
    group = F.expr(f"CASE WHEN id < {edges[-1]} THEN array_size(filter(array({', '.join(map(str, edges[1:]))}), e -> e <= id)) END")
    df = spark.range(edges[-1] + alone).select("id", group.alias("g"))
    out = sharding.shard_documents(df, F.col("id"), F.lit(1), F.crc32(F.col("id").cast("string")), F.col("g"))
    rows = out.join(df, out.key == df.id).groupBy("g", "shard").agg(F.count("*").alias("n")).collect()
    load, places = Counter(), defaultdict(set)
    for r in rows:
        load[r.shard] += r.n
        if r.g is not None:
            places[r.g].add(r.shard)
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= 1 and sum(load.values()) == edges[-1] + alone
    return places


def test_groups_are_in_the_least_number_of_shards(spark):
    # a third of all rows, one group of nearly a shard, some over a sixteenth of one, and many of medium size
    places = sharded(spark, [13333, 4500, *[500] * 6, *[280] * 10, *[90] * 60], 40000 - 13333 - 4500 - 3000 - 2800 - 5400)
    assert len(places[0]) == 3 and all(len(places[g]) == 1 for g in range(1, 78))


def test_full_shards_split_few_groups(spark):
    sizes = [*[120] * 60, *[37] * 200, *[5] * 80]
    places = sharded(spark, [5000, *sizes], 0)
    assert len(places[0]) == 2 and sum(len(p) > 1 for g, p in places.items() if g) < 8


def test_the_cut_falls_from_round_to_round(spark):
    """Chains of groups: each document is linked by its text and by a chain to documents of other texts."""
    rng = random.Random(12)
    data = [(i, f"t{i // 3}", f"chain{i // 24}", None) for i in range(2400)] + [(2400 + i, f"alone{i}", None, None) for i in range(800)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string, chain string, other string").repartition(5)
    report: list = []
    out = sharding.shard_documents(df, F.col("doc_id"), F.lit(1), F.crc32("text"), F.array("text", "chain", "other"), report=report)
    shard = {r.key: r.shard for r in out.collect()}
    count = Counter(shard.values())
    assert len(shard) == 3200 and set(count.values()) == {400}
    links = defaultdict(list)
    for i, text, chain, _ in data:
        links[text].append(shard[i])
        if chain:
            links[chain].append(shard[i])
    cut = sum(len(at) - max(Counter(at).values()) for at in links.values())
    assert len(report) > 1 and all(a >= b for a, b in zip(report, report[1:])) and report[-1] < report[0] / 20
    assert cut <= max(report[-1], 60)  # nearly all chains are whole, as the shards have room for them


def test_a_document_follows_its_neighbours_where_they_have_moved(spark):
    # a large group settles first; documents that share a second link with some of it are drawn to its shard
    rows = [(i, "big", f"pair{i}" if i < 40 else None) for i in range(90)] + [(100 + i, f"own{i}", f"pair{i}") for i in range(40)]
    rows += [(1000 + i, f"alone{i}", None) for i in range(1470)]
    df = spark.createDataFrame(rows, "doc_id long, text string, second string")
    out = sharding.shard_documents(df, F.col("doc_id"), F.lit(1), F.crc32("text"), F.array("text", "second"))
    shard = {r.key: r.shard for r in out.collect()}
    home = {shard[i] for i in range(90)}
    assert len(home) == 1 and {shard[100 + i] for i in range(40)} == home


# quality rules

def test_quality_rules(docs, nothing):
    got = quality_rules.judge(docs).collect()
    want = Counter()
    for r in ROWS:
        t, w = r[1] or "", words(r[1])
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        twice = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)}
        seen, repeats = set(), 0
        for x in t.split("\n"):
            if words(x):
                repeats += x in seen
                seen.add(x)
        want[r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeats, len(twice), len(w) < 50 or 100 * len(twice) > 50 * len(w)] += 1
    assert Counter((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed) and quality_rules.judge(nothing).isEmpty()


def test_distance_from_the_language(spark):
    rng = random.Random(4)
    speech = lambda n, vocab: " ".join(rng.choice(vocab[:8]) if rng.random() < 0.5 else rng.choice(vocab) for _ in range(n))
    rows = [(i, speech(150, VOCAB), "en") for i in range(60)]
    rows += [(100, " ".join(w.upper() + "!!" for w in speech(150, VOCAB).split()), "en"), (101, " ".join(w + "%%%" for w in speech(150, VOCAB).split()), "en"),
             (102, "zz " * 0 + " ".join(f"q{rng.randrange(10**6)}" for _ in range(150)), "en"), (103, speech(150, VOCAB).upper(), None),
             (104, speech(150, VOCAB), None)]
    other = [w[::-1] + "o" for w in VOCAB]
    rows += [(200 + i, speech(150, other), "rare") for i in range(3)] + [(210, speech(150, other), None)]
    got = {r.key: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept for i in (100, 101, 102))
    assert not got[103].kept and got[104].kept and got[210].kept  # without a language: the nearest one judges
    assert all(got[i].kept for i in (200, 201, 202)) and got[210].word_distance < 0.4 and got[210].lang is None
    alone = quality_rules.judge(spark.createDataFrame([(1, speech(80, VOCAB), None)], "doc_id long, text string, lang string")).first()
    assert alone.kept and alone.word_distance is None  # no language in the table
    p, q = np.array([3.0, 1, 0]), np.array([1.0, 1, 2])
    a, b = p / p.sum(), q / q.sum()
    kl = lambda x, m: sum(u * np.log2(u / v) for u, v in zip(x, m) if u)
    found = spark.range(1).select(quality_rules.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    assert found == pytest.approx(np.sqrt((kl(a, (a + b) / 2) + kl(b, (a + b) / 2)) / 2))


def test_verdicts_equal_plain_histograms(spark):
    """Distances and verdicts of whole texts by counting in Python."""
    rng = random.Random(31)
    rows = []
    for lang, vocab in (("en", VOCAB[:150]), ("de", [w + "en" for w in VOCAB[100:]])):
        for i in range(25):
            n = rng.choice([30, 55, 90, 200])
            text = " ".join(rng.choice(vocab[:10]) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n))
            rows.append((len(rows), text.upper() if i % 9 == 0 else text + "#$%" * (n // 2) if i % 11 == 0 else text, lang))
    got = {r.key: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}

    def classes(text):
        kinds = [re.compile(p) for p in ("[a-z]", r"[\x20\x09-\x0D]", "[A-Z]", r"[#*$%&|<>]", "[0-9]", r"[\x00-\x7F]", ".")]
        return Counter(next(i for i, k in enumerate(kinds) if k.match(c)) for c in text)

    def distance(a, b):
        out, n, m = 0.0, sum(a.values()), sum(b.values())
        for x in {*a, *b}:
            p, q = a[x] / n, b[x] / m
            out += sum(u * np.log2(u / ((p + q) / 2)) for u in (p, q) if u) / 2
        return math.sqrt(max(out, 0))

    for lang in ("en", "de"):
        own = [r for r in rows if r[2] == lang]
        count = Counter(w for r in own for w in words(r[1]))
        top = {w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:quality_rules.COMMON]}
        binned = lambda text: Counter(w if w in top else None for w in words(text))
        of_words, of_classes = sum((binned(r[1]) for r in own), Counter()), sum((classes(r[1]) for r in own), Counter())
        for key, text, _ in own:
            n, r = len(words(text)), got[key]
            if n < quality_rules.MIN_WORDS:
                assert r.base_failed and not r.kept and r.word_distance is None
                continue
            a, b = distance(binned(text), of_words), distance(classes(text), of_classes)
            assert (r.word_distance, r.class_distance) == (pytest.approx(a, abs=1e-9), pytest.approx(b, abs=1e-9))
            assert r.kept == (not r.base_failed and max(a, b) <= quality_rules.BOUND + quality_rules.SLACK / math.sqrt(n))
    assert 5 < sum(not r.kept for r in got.values()) < 45


# near duplicates

def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes_of(rows):
    sets = [shingles(r[1]) for r in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if union == 0 or 10 * len(sets[i] & sets[j]) >= 8 * union:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    rank = lambda k: -1 if k is None else k
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min((least.get(root(i), (10**9, 0)), (rank(r[0]), r[0])), key=lambda x: x[0])
    return [(r[0], least[root(i)][1], links[i], root(i)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [500, 7])
def test_near_duplicates(docs, nothing, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    got = near.near_duplicates(docs).collect()
    assert Counter((r.key, r.class_id, r.n_links) for r in got) == Counter(c[:3] for c in classes_of(ROWS))
    if block == 500:
        assert near.near_duplicates(nothing).isEmpty()


def test_prefixes_shorten_until_the_recall_is_met():
    assert near.found_share(0.8, near.DEPTH) < near.RECALL <= near.found_share(0.8, near.LEAST_DEPTH)
    assert all(near.found_share(s / 100, d) <= near.found_share(s / 100, d - 1) for s in range(80, 101) for d in range(2, 7))


def test_a_large_group_does_not_decide_for_a_lone_pair():
    close = {0.99: 5e7}
    assert near.wanted_depth(close, near.DEPTH) == near.DEPTH
    assert near.wanted_depth(close | {0.8: 1}, near.DEPTH) == 4 and near.found_share(0.8, 4) >= near.LEAST_RECALL > near.found_share(0.8, 5)
    assert near.wanted_depth({0.8: 1}, near.DEPTH) == near.wanted_depth({0.8: 1e9}, 4) == 3 + (near.found_share(0.8, 4) >= near.RECALL)
    assert near.wanted_depth({}, near.DEPTH) == near.DEPTH


def test_a_pair_at_the_bound_beside_a_hot_group(spark, monkeypatch):
    depths = []
    monkeypatch.setattr(near, "_edges_at", lambda nodes, depth, f=near._edges_at: depths.append(depth) or f(nodes, depth))
    rng = random.Random(21)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(400)]
    pair = [rng.choice(words) for _ in range(300)]
    other = list(pair)
    for at in (30, 80, 130, 180, 230, 280):  # 30 of 296 runs of five words differ: a similarity of 266 / 326
        other[at] = "changed"
    rows = [(i, " ".join(base[:-1] + [f"end{i}"])) for i in range(120)] + [(500, " ".join(pair)), (501, " ".join(other))]
    got = {r.key: (r.class_id, r.n_links) for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[500] == got[501] == (500, 1) and all(got[i] == (0, 119) for i in range(120))
    assert depths[0] == near.DEPTH and depths[-1] <= 4


# repeated spans

def test_span_dedup(docs, nothing):
    first = defaultdict(lambda: 10**9)
    rank = lambda k: -1 if k is None else k
    for r in ROWS:
        for _, _, h in spans.runs(r[1] or "")[0]:
            first[h] = min(first[h], rank(r[0]))
    want = Counter()
    for r in ROWS:
        runs, again = spans.runs(r[1] or "")
        gone = again + [(a, b) for a, b, h in runs if first[h] < rank(r[0])]
        want[(r[0], *spans.without(r[1] or "", [a for a, _ in gone], [b for _, b in gone]))] += 1
    got = spans.remove_repeats(docs).collect()
    assert Counter((r.key, r.kept, r.n_removed) for r in got) == want
    assert spans.remove_repeats(nothing).isEmpty()


def test_a_planted_passage_goes_from_all_but_one(spark):
    rng = random.Random(8)
    passage = " ".join(rng.choice(VOCAB) for _ in range(30)) + ". " + " ".join(rng.choice(VOCAB) for _ in range(30)) + "."
    rows = [(i, prose(50, rng) + " " + passage + " " + prose(50, rng)) for i in range(6)] + [(10, prose(100, rng))]
    got = {r.key: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    middle = " ".join(passage.split()[8:52])
    assert middle in got[0].kept and got[0].n_removed == 0 and got[10].n_removed == 0
    assert not any(middle in got[i].kept for i in range(1, 6))
    assert all("".join(rows[i][1][a:b] for a, b in spans.sentences(rows[i][1])) == rows[i][1] for i in range(7))


def test_passages_of_51_words_are_found_wherever_they_lie():
    rng = random.Random(12)
    plain = lambda n, gap=" ": gap.join(rng.choice(VOCAB) for _ in range(n))
    for k in range(600):
        gap = "\t" if k % 5 == 0 else " "
        passage = plain(51, gap)
        hosts = [gap.join([plain(rng.randint(3, 40), gap), passage, plain(rng.randint(3, 40), gap)]) for _ in range(2)]
        places = []
        for host in hosts:
            start = host.index(passage)
            places.append({h for a, b, h in spans.runs(host)[0] if a >= start and b <= start + len(passage) + 1})
        assert places[0] & places[1], passage


# quality classifier

def test_classifier(spark, docs, nothing):
    rng = random.Random(6)
    rows = [(i, prose(rng.randint(20, 200), rng) if i % 3 else " ".join(w + "###" for w in prose(rng.randint(20, 200), rng).split())) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(None, 1, 0), (5000, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_model.classify(spark.createDataFrame(rows, "doc_id long, text string").withColumn("stats", F.lit(1)), labels).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.key).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.key % 3 > 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality_model.classify(docs, labels).count() == len(ROWS)  # nulls, empties and repeats have scores
    assert quality_model.classify(nothing, labels).isEmpty() and quality_model.classify(docs, labels.limit(0)).first().score >= 0


def test_isotonic_pools_violators():
    x, y = quality_model.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert x.tolist() == [1, 2.5, 4] and y.tolist() == [0, 0.5, 1]
