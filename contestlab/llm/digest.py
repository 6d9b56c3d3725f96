"""Similarity digests of improbable features.

Every window of 64 bytes has an entropy; the rarer its entropy among the windows of all documents,
the higher its rank. Windows that have the best rank of many neighbourhoods are the features of a
document; they go into a chain of Bloom filters, and two documents are compared by the bits their
filters share beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from contestlab.llm.common import small_batches, whole

WINDOW = 64         # bytes of a feature
REACH = 64          # features of a neighbourhood
SHORT = 6           # bytes of a feature in texts too short to choose from
POPULAR = 16        # neighbourhoods in which a feature must have the best rank
BITS = 2048         # of one filter
HASHES = 5          # bits set by one feature
PER_FILTER = 128    # features of one filter
LEVELS = 1000       # entropies are counted in so many steps
LEAST = WINDOW + 2 * REACH - 2  # bytes that decide whether a feature in them is popular
LONG = 512          # code points from which a text has popular features
BRIEF = 1024        # code points below which it has short features; in between it has both kinds, so that close lengths compare
SAMPLED = 16        # of the short features of texts below LONG or from BRIEF on, one in so many is compared where nothing else can be
_CHUNK = 1 << 17    # bytes computed at a time
_FLUSH = 1 << 20    # bytes of text compared at a time, or one document

_GAIN = np.zeros(WINDOW + 2, dtype=np.int64)  # n log2 n in fixed point, so that sums are exact
_GAIN[1:] = np.round(np.arange(1, WINDOW + 2) * np.log2(np.arange(1, WINDOW + 2)) * 2**20).astype(np.int64)
_STEP = np.diff(_GAIN)  # what one more equal byte adds
_MIX = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_SHIFTS = np.arange(HASHES, dtype=np.uint64) * np.uint64(11)  # 11 bits of a hash for each bit of a filter of 2,048
_MOST = int(_GAIN[WINDOW])


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy of every window of the bytes, from 0 to LEVELS; empty where there is no whole window.

    A window that moves by one byte changes two counts: the byte that leaves occurs so often in the 64
    bytes from its place on, the byte that enters so often in the 64 up to its place.
    """
    out = np.zeros(max(0, len(data) - WINDOW + 1), dtype=np.int16)
    for a in range(0, len(out), _CHUNK):
        part = data[a:a + _CHUNK + WINDOW - 1]
        ahead, behind = np.zeros(len(part), dtype=np.uint8), np.zeros(len(part), dtype=np.uint8)
        for lag in range(1, WINDOW):
            same = (part[lag:] == part[:-lag]).view(np.uint8)
            ahead[:-lag] += same
            behind[lag:] += same
        start = _GAIN[np.bincount(part[:WINDOW], minlength=1)].sum()
        total = start + np.concatenate([[0], np.cumsum(_STEP[behind[WINDOW:]] - _STEP[ahead[:len(part) - WINDOW]])])
        out[a:a + len(total)] = (_MOST - total) * LEVELS // _MOST
    return out


def popularity(ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per feature, the neighbourhoods (those with a true start) whose leftmost best rank it has."""
    out = np.zeros(len(ranks), dtype=np.int16)
    for a in range(0, max(0, len(ranks) - REACH + 1), _CHUNK):
        part = ranks[a:a + _CHUNK + REACH - 1].astype(np.int32) << 18 | np.arange(min(_CHUNK + REACH - 1, len(ranks) - a), dtype=np.int32)
        width = 1
        while width < REACH:
            part = np.minimum(part[:-width], part[width:])
            width *= 2
        best = (part & (1 << 18) - 1)[starts[a:a + len(part)]]
        count = np.bincount(best)
        out[a:a + len(count)] += count.astype(np.int16)
    return out


def is_long(text: bytes) -> bool:
    return _reaches(text, LONG)


def _reaches(text: bytes, points: int) -> bool:
    return len(text) >= 4 * points or len(text) >= points <= len(text.decode(errors="ignore"))


def select(texts: list[bytes], table: np.ndarray, always: bool = True) -> list[np.ndarray]:
    """Places of the features of each text: the popular ones, or every window of a text too short to choose from.

    A text that repeats itself closely may have no popular one; then the most popular ones are taken, if `always`.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ranks = table[levels(data)]
    ends = np.cumsum([len(t) for t in texts])
    starts = np.zeros(max(len(ranks) - REACH + 1, 0), dtype=bool)
    for end, t in zip(ends, texts, strict=True):
        if is_long(t):
            starts[end - len(t):end - (WINDOW + REACH - 2)] = True
    popular = popularity(ranks, starts)
    out = []
    for end, t in zip(ends, texts, strict=True):
        first, features = end - len(t), len(t) - WINDOW + 1
        if not is_long(t):
            out.append(np.arange(max(len(t) - SHORT + 1, min(len(t), 1))))
            continue
        mine = popular[first:first + features]
        at = np.flatnonzero(mine >= POPULAR)
        out.append(at if len(at) or not always else np.flatnonzero(mine == mine.max()))
    return out


def filters(text: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three chains of filters, one row of BITS each: of the popular features (at `places`), of all short ones, and of sampled short ones."""
    long, brief = is_long(text), not _reaches(text, BRIEF)
    popular = [text[p:p + WINDOW] for p in places.tolist()] if long else []
    n = max(len(text) - SHORT + 1, min(len(text), 1)) if brief else 0
    sampled = _sampled(text) if long != brief else np.zeros(0, dtype=np.uint64)  # in between a text compares with both
    return _chain(popular), _chain([text[p:p + SHORT] for p in range(n)]), _bits((sampled[:, None] >> _SHIFTS) & np.uint64(BITS - 1))


def _sampled(text: bytes) -> np.ndarray:
    """Hashes of the distinct short features that a hash picks, in order: of equal features in all texts or in none."""
    out = [np.zeros(0, dtype=np.uint64)]
    for at in range(0, len(text) - SHORT + 1, _CHUNK):
        data = np.frombuffer(text, dtype=np.uint8, offset=at, count=min(_CHUNK + SHORT - 1, len(text) - at)).astype(np.uint64)
        x = np.zeros(len(data) - SHORT + 1, dtype=np.uint64)
        for k in range(SHORT):
            x |= data[k:len(x) + k] << np.uint64(8 * k)
        for factor in _MIX:
            x *= factor
            x ^= x >> np.uint64(32)
        out.append(x[x >> np.uint64(55) < np.uint64(512 // SAMPLED)])
    found = np.concatenate(out)
    return found[np.sort(np.unique(found, return_index=True)[1])]


def _chain(pieces: list[bytes]) -> np.ndarray:
    """Chained filters of the distinct features in order."""
    pieces = list(dict.fromkeys(pieces))
    if not pieces:
        return np.zeros((0, BITS), dtype=bool)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), dtype="<u2").reshape(len(pieces), -1)
    return _bits(hashes[:, :HASHES] % BITS)


def _bits(places: np.ndarray) -> np.ndarray:
    """Chained filters of features, each given by the places of its bits."""
    out = np.zeros((-(-len(places) // PER_FILTER), BITS), dtype=bool)
    out[np.arange(len(places))[:, None] // PER_FILTER, places] = True
    return out


Chains = tuple[np.ndarray, np.ndarray, np.ndarray]


def likeness(a: Chains, b: Chains) -> float:
    """By the short features if both texts have all of them, else by the popular ones, else by sampled short ones; 1 for empty texts."""
    for kind in (1, 0, 2):
        if len(a[kind]) and len(b[kind]):
            return _overlap(a[kind], b[kind])
    return float(not any(len(x) for x in (*a, *b)))


def _overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the shorter chain of each filter's best overlap: 0 for what chance gives, 1 where the smaller is within the other."""
    if (len(a), a.sum()) > (len(b), b.sum()):
        a, b = b, a
    x, y = a.sum(axis=1)[:, None], b.sum(axis=1)[None, :]
    shared = a.astype(np.float32) @ b.T.astype(np.float32)
    chance = x * y / BITS
    score = np.clip((shared - chance) / np.maximum(np.minimum(x, y) - chance, 1e-9), 0, 1).max(axis=1)
    return float((score * x[:, 0]).sum() / x.sum())


def shown(chains: Chains) -> str:
    """The chains parted by points, those of popular, of all short and of sampled features; points at the end and empty texts show nothing."""
    return ".".join(base64.b64encode(np.packbits(c, axis=1).tobytes()).decode() for c in chains).rstrip(".")


def rarity(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy level: the fewer windows of all documents have it, the lower. One sum per level is collected."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(LEVELS + 1, dtype=np.int64)
        for batch in batches:
            for texts in _portions(t.encode() for t in batch[text]):
                found = levels(np.frombuffer(b"".join(texts), dtype=np.uint8))
                keep, end = np.ones(len(found), dtype=bool), 0
                for t in texts:
                    end += len(t)
                    keep[max(0, end - WINDOW + 1):end] = False  # windows that reach into the next text
                total += np.bincount(found[keep], minlength=LEVELS + 1)
        yield pd.DataFrame({"level": np.arange(LEVELS + 1), "n": total})

    counts = np.zeros(LEVELS + 1, dtype=np.int64)
    rows = docs.select(whole(F.col(text)).alias(text)).mapInPandas(count, "level int, n long")
    for r in rows.groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[r.level] = r.n
    order = np.lexsort((np.arange(LEVELS + 1), counts))
    table = np.empty(LEVELS + 1, dtype=np.int16)
    table[order] = np.arange(LEVELS + 1)
    return table


def _portions(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= _FLUSH:
            yield held
            held, size = [], 0
    if held:
        yield held


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare(texts: list[str], table: np.ndarray) -> list[tuple]:
    """For each text but the last, against its edited version and against the text that follows."""
    raw = [t.encode() for t in texts]
    popular = select(raw, table, always=False)
    places = [at if len(at) else select([r], table)[0] for r, at in zip(raw, popular, strict=True)]
    chains = [filters(r, at) for r, at in zip(raw, places, strict=True)]
    edits, tails, keeps = [], [], []
    for t, r, following in zip(texts, raw, texts[1:]):
        edited = edited_text(t, following).encode()
        keep = len(t[:len(t) - len(t) // 4].encode())
        # a feature of the kept part whose neighbourhoods lie within it is chosen in both texts or in neither
        keep = keep if keep >= LEAST and is_long(r) and is_long(edited) else 0
        edits.append(edited)
        keeps.append(keep)
        tails.append(edited[max(0, keep - LEAST + 1):])
    out = []
    for i, (edited, keep, at) in enumerate(zip(edits, keeps, _tail_places(tails, keeps, table), strict=True)):
        if keep:
            edge = keep - (WINDOW + REACH - 1)
            old = popular[i][popular[i] <= edge]
            new = at + keep - LEAST + 1
            at = np.concatenate([old, new[new > edge]])
            if not len(at):
                at = select([edited], table)[0]
        chain = filters(edited, at)
        out.append((len(texts[i]), hashlib.sha256(edited).hexdigest(), shown(chains[i]), shown(chain),
                    likeness(chains[i], chain), likeness(chains[i], chains[i + 1])))
    return out


def _tail_places(tails: list[bytes], keeps: list[int], table: np.ndarray) -> list[np.ndarray]:
    """Places of popular features in the ends of edited texts, by the rule of long texts where the whole text is long."""
    out = []
    for t, keep, at in zip(tails, keeps, select(tails, table, always=False), strict=True):
        if keep and not is_long(t):  # judged as part of a long text
            ranks = table[levels(np.frombuffer(t, dtype=np.uint8))]
            at = np.flatnonzero(popularity(ranks, np.ones(max(0, len(ranks) - REACH + 1), dtype=bool)) >= POPULAR)
        out.append(at)
    return out


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", table: np.ndarray | None = None) -> DataFrame:
    """One row per input row: key (long), n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next larger key, after the last the first; a missing key sorts
    first, rows that share a key are ordered by a hash of their text. A missing text is an empty one,
    whose fingerprint is empty; it is alike (1) to empty texts only. Texts of less than 1024 code points are
    compared by all their short features, others by popular ones, which texts from 512 on have; one below
    512 and one of 1024 or more by a sixteenth of their short features, picked by a hash. A single document is its own
    successor. An empty table gives no rows; other columns are not read.

    Documents are dealt into consecutive ranges of the key, a few per partition, and the first document of
    a range is also sent to the range before. A task holds a megabyte of texts at a time, or one document.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    least = -(2**63)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("key"), F.col(key).isNull().alias("unkeyed"),
                       whole(F.col(text)).alias("text"))
    table = rarity(rows) if table is None else table
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = 4 * parts
    cuts = rows.select(F.percentile_approx("key", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0]
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts or [least]))])
    rows = rows.withColumn("block", F.size(F.filter(cuts, lambda c: c < F.col("key"))))
    firsts = {r.block: r.first for r in rows.groupBy("block").agg(F.min("key").alias("first")).collect()}
    order = sorted(firsts)
    back = {b: order[i - 1] for i, b in enumerate(order)}
    top = max(order, default=0) + 1
    first = F.get(F.array(*[F.lit(firsts.get(b)).cast("long") for b in range(top)]), F.col("block"))
    before = F.get(F.array(*[F.lit(back.get(b)).cast("int") for b in range(top)]), F.col("block"))
    homes = F.array_compact(F.array(
        F.struct(F.col("block").alias("block"), F.lit(0).alias("tail")),
        F.when(F.col("key") == first, F.struct(before.alias("block"), F.lit(1).alias("tail")))))
    dealt = rows.select("key", "unkeyed", "text", F.explode(homes).alias("home")).select("key", "unkeyed", "text", "home.*")
    dealt = dealt.repartition(parts, "block").sortWithinPartitions("block", "tail", "key", F.xxhash64("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # documents of one block that still wait for their successor
        size, closed = 0, None

        def flush(docs: list[tuple]) -> pd.DataFrame:
            found = compare([d[2] for d in docs], table)
            cols = list(zip(*[(k, u, *f) for (k, u, _), f in zip(docs, found)], strict=True))
            return pd.DataFrame(dict(zip(_COLUMNS, cols, strict=True)))

        for batch in batches:
            for k, u, t, block, tail in batch.itertuples(index=False):
                if block == closed:  # more rows with the key of the successor
                    continue
                held.append((k, u, t))
                size += len(t)
                if len(held) > 1 and (size >= _FLUSH or tail):
                    yield flush(held)
                    held, size = held[-1:], len(t)
                if tail:
                    held, size, closed = [], 0, block

    out = dealt.mapInPandas(run, "key long, unkeyed boolean, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
    return out.select(F.when(~F.col("unkeyed"), F.col("key")).alias("key"), *_COLUMNS[2:])


_COLUMNS = ["key", "unkeyed", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
