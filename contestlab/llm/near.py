"""Jaccard join on word shingles through an LSH forest of MinHash signatures.

Each tree of the forest is a sorted trie over a few MinHash values. Texts that share a prefix of a
tree are candidates; the prefix is shortened until the recall that the found similarities imply meets
the target. Candidates are grouped, and inside a group every pair is verified on the whole shingle
sets, in blocks. Texts with equal shingle sets are one node throughout.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from contestlab.llm.common import WORD, discard, small_batches, stored, whole
from contestlab.llm.graph import components

WIDTH = 5          # words of a shingle
TENTHS = 8         # least similarity, in tenths
TREES, DEPTH = 21, 6
LEAST_DEPTH = 3
RECALL = 0.99999
LEAST_RECALL = 0.9999  # of the links of any one similarity
ERROR = 0.04           # of an estimated similarity, a little over its standard deviation
PLAUSIBLE = 0.6    # estimated similarity under which a candidate is not a link: over five deviations below 0.8
BLOCK = 500        # nodes compared with as many others in one step
KNOWN_WORDS = 200_000  # whose hashes a task keeps
_PORTION = 1 << 18  # words whose signatures are computed together

_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
_P = _RNG.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_words = re.compile(WORD).findall


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct shingle hashes per text; keeps the hashes of words it has seen, up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = _words(text)
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        try:
            h = np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.array([known[w] for w in words], dtype=np.uint64)
        width = min(WIDTH, len(h))  # a text of fewer words is one shingle
        n = len(h) - width + 1
        total = np.full(n, width, dtype=np.uint64)
        for k in range(width):
            total = _mixed(total + h[k:k + n] * _P[k])
        return np.unique(total)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row per set; sets must not be empty."""
    x, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), TREES * DEPTH), dtype=np.uint32)
    for i in range(TREES * DEPTH):
        h = ((x * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32)
        out[:, i] = np.minimum.reduceat(h, starts)
    return out


_SIGNED = pa.schema([("key", pa.int64()), ("unkeyed", pa.bool_()), ("t1", pa.int64()), ("node", pa.binary()), ("trees", pa.list_(pa.int64())), ("low", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the hash of its shingle set, its MinHash values, and their low bytes."""
    shingle = Shingler()

    def flush(rows, sets):
        full = [i for i, s in enumerate(sets) if len(s)]
        sig = np.zeros((len(sets), TREES * DEPTH), dtype=np.uint32)
        if full:
            sig[full] = signatures([sets[i] for i in full])
        keys, unkeyed, t1 = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), pa.array(unkeyed, pa.bool_()), pa.array(t1, pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            pa.array([r if len(s) else None for r, s in zip(sig.astype(np.int64), sets, strict=True)], pa.list_(pa.int64())),
            pa.array([r.tobytes() for r in sig.astype(np.uint8)], pa.binary())], schema=_SIGNED)

    rows, sets, size = [], [], 0
    for batch in batches:
        for key, unkeyed, t1, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.append((key, unkeyed, t1))
            sets.append(shingle(text))
            size += len(sets[-1])
            if size >= _PORTION or len(rows) >= 2000:
                yield flush(rows, sets)
                rows, sets, size = [], [], 0
    if rows:
        yield flush(rows, sets)


def found_share(similarity, depth: int):
    """Probability that texts of a similarity share a prefix in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal leading columns, from sorted rows."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


def _forest(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect."""
    up = list(range(size))
    out = []
    for i, j in pairs.tolist():
        a, b = i, j
        while up[a] != a:
            up[a] = a = up[up[a]]
        while up[b] != b:
            up[b] = b = up[up[b]]
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _emit(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("bin", pa.int32()), ("n", pa.int64())])


def _candidates(depth: int):
    """Edges between plausible candidates of each block of a bucket, and how often each similarity was seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(101, dtype=np.int64)
        out: list[tuple] = []
        for (tree, _, i, j), rows in _groups(batches, 4):
            left = [r for r in rows if r[0] == i]
            right = left if i == j else [r for r in rows if r[0] == j]
            if not left or not right:
                continue
            low = [np.frombuffer(b"".join(r[2] for r in side), dtype=np.uint8).reshape(len(side), -1) for side in (left, right)]
            pairs = []
            for x in range(len(left)):
                first = x + 1 if i == j else 0
                if first >= len(right):
                    break
                same = low[1][first:] == low[0][x]
                share = same.mean(axis=1)
                near = np.flatnonzero(share >= PLAUSIBLE)
                if not len(near):
                    continue
                pairs.append(np.stack([np.full(len(near), x), near + first], axis=1))
                # a pair counts in the first tree that finds it
                match = same[near, :tree * DEPTH].reshape(len(near), tree, DEPTH)[:, :, :depth].all(axis=2).any(axis=1)
                seen += np.bincount(np.round(share[near][~match] * 100).astype(int), minlength=101)
            if not pairs:
                continue
            pairs = np.concatenate(pairs)
            if i == j:
                out += [(left[x][1], right[y][1], None, None) for x, y in _forest(pairs, len(left))]
            else:
                pairs[:, 1] += len(left)
                both = left + right
                out += [(both[x][1], both[y][1], None, None) for x, y in _forest(pairs, len(both))]
            if len(out) >= 5000:
                yield _emit(_EDGES, out)
                out = []
        out += [(None, None, k, int(n)) for k, n in enumerate(seen) if n]
        if out:
            yield _emit(_EDGES, out)

    return run


def _blocked(df: DataFrame, size: str, node: str) -> DataFrame:
    """Each row in all pairs (i, j) of blocks that its block is part of; a group of up to BLOCK nodes is one block."""
    blocks = F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")
    df = df.withColumn("side", F.pmod(F.xxhash64(F.lit(3), node), blocks).cast("int")).withColumn("blocks", blocks)
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("side")).alias("i"), F.greatest(k, F.col("side")).alias("j")))
    return df.withColumn("pair", F.explode(pairs)).withColumn("i", F.col("pair.i")).withColumn("j", F.col("pair.j")).drop("pair", "blocks")


def _edges_at(nodes: DataFrame, depth: int) -> DataFrame:
    """Candidate edges by prefixes of `depth`, stored, with the counts of similarities among them."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prefixes = F.array(*[F.xxhash64(F.lit(t), *[F.col("trees")[t * DEPTH + k] for k in range(depth)]) for t in range(TREES)])
    places = nodes.where("trees IS NOT NULL").select("node", F.posexplode(prefixes).alias("tree", "prefix"))
    buckets = places.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = stored(places.join(buckets, ["tree", "prefix"]), "forest-members")
    rows = _blocked(members, "m", "node").join(nodes.select("node", "low"), "node").select("tree", "prefix", "i", "j", "side", "node", "low")
    rows = rows.repartition(parts, "tree", "prefix", "i", "j").sortWithinPartitions("tree", "prefix", "i", "j")
    out = stored(rows.mapInArrow(_candidates(depth), "a binary, b binary, bin int, n long"), "forest-edges")
    discard(members)
    return out


def wanted_depth(links: dict[float, float], depth: int, recall: float = RECALL) -> int:
    """The longest prefix, of `depth` at most, that finds the target share of all links and enough of each similarity.

    Similarities are estimates, so the least one may be off by `ERROR`."""
    lowest = max(min(links, default=1.0) - ERROR, TENTHS / 10)
    for d in range(depth, LEAST_DEPTH, -1):
        found = sum(n * found_share(s, d) for s, n in links.items())
        if found >= recall * sum(links.values()) and found_share(lowest, d) >= LEAST_RECALL:
            return d
    return LEAST_DEPTH


def candidate_groups(nodes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Columns node and root: groups of nodes that plausible candidates connect.

    Starts with whole tries. The similarities found, each divided by its chance to be found, tell how many
    links there are; the prefix is cut to the longest one that would find the target share of them, and of every
    hundredth of similarity that has any no less than `LEAST_RECALL`, so that one large group of close copies does not
    decide for pairs that are just similar enough. Then the estimate is made again.
    """
    depth = DEPTH
    while True:
        edges = _edges_at(nodes, depth)
        seen = {r.bin / 100: r.n for r in edges.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
        links = {max(s, TENTHS / 10): n / found_share(s, depth) for s, n in seen.items() if s >= TENTHS / 10 - 0.04}
        want = wanted_depth(links, depth, recall)
        if want == depth:
            return components(edges.where("a IS NOT NULL").select("a", "b"))
        discard(edges)
        depth = want


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links inside blocks of a group: edges that connect them, and per node the documents it is linked to."""
    out: list[tuple] = []
    for (_, i, j), rows in _groups(batches, 3):
        left = [r for r in rows if r[0] == i]
        both = left if i == j else left + [r for r in rows if r[0] == j]
        if len(both) < 2 or not left:
            continue
        sets = [np.array(r[3], dtype=np.int64) for r in both]
        sizes = np.array([len(s) for s in sets])
        shared = _overlaps(sets, sizes)
        similar = 10 * shared >= TENTHS * (sizes[:, None] + sizes[None, :] - shared)
        np.fill_diagonal(similar, False)
        if i != j:
            similar[:len(left), :len(left)] = False
            similar[len(left):, len(left):] = False
        weight = np.array([r[2] for r in both])
        linked = similar @ weight
        out += [(both[k][1], None, int(linked[k])) for k in np.flatnonzero(linked)]
        out += [(both[x][1], both[y][1], None) for x, y in _forest(np.argwhere(np.triu(similar)), len(both))]
        if len(out) >= 5000:
            yield _emit(_LINKS, out)
            out = []
    if out:
        yield _emit(_LINKS, out)


def _overlaps(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Sizes of all intersections; shingles that only one set has are left out of the products."""
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[at] > 1
    owner, at = owner[keep], at[keep]
    _, at = np.unique(at, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    width = max(256, 4_000_000 // len(sets))
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [start, start + width])
        part = np.zeros((len(sets), min(width, int(at[-1]) + 1 - start)), dtype=np.float32)
        part[owner[a:b], at[a:b] - start] = 1
        out += part @ part.T
    return np.round(out).astype(np.int64)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, t1 (a hash of the text), class_id, n_links, n_copies (long) and class_node.

    Documents are linked if the sets of their runs of five words have a Jaccard similarity of 0.8 or more,
    computed exactly on whole texts; a class is what links connect, named by its smallest key. `n_links`
    counts the other rows a row is linked to, `n_copies` the rows with an equal set, itself included. A text
    of one to four words is a set of one run; texts without words, missing ones too, are copies of each
    other. A missing key sorts first and names a class null; `class_node` (binary) tells such classes apart. Repeated rows are copies. An empty table
    gives no rows; other columns are not read.

    Copies are summed before anything is paired. Buckets and groups of any size are cut into blocks of
    `BLOCK` nodes, and a task holds two blocks; per block only connecting edges and sums leave it, not pairs.
    The work in a bucket grows with the square of its different texts.
    """
    spark = docs.sparkSession
    small_batches(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("key"), F.col(key).isNull().alias("unkeyed"),
                       whole(F.col(text)).alias("text"))
    rows = rows.select("key", "unkeyed", F.xxhash64(F.lit(1), "text").alias("t1"), "text")
    signed = stored(rows.mapInArrow(_sign, "key long, unkeyed boolean, t1 long, node binary, trees array<long>, low binary"), "near-signed")
    nodes = stored(signed.groupBy("node").agg(
        F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("trees").alias("trees"), F.first("low").alias("low")), "near-nodes")
    grouped = stored(candidate_groups(nodes), "near-groups")

    sized = grouped.join(grouped.groupBy("root").agg(F.count(F.lit(1)).alias("m")), "root").join(nodes.select("node", "rep", "copies"), "node")
    picked = rows.join(sized.withColumnRenamed("rep", "key"), "key").select("text", "node", "root", "m", "copies")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, schema = Shingler(), pa.schema([("node", pa.binary()), ("root", pa.binary()), ("m", pa.int64()), ("copies", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for batch in batches:
            out = []
            for text, node, root, m, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingle(text)
                if xxhash.xxh3_128_digest(s.tobytes()) == node:  # a repeated key may have other texts
                    out.append((node, root, m, copies, s.astype(np.int64)))
                if len(out) >= 500:
                    yield _emit(schema, out)
                    out = []
            if out:
                yield _emit(schema, out)

    sets = picked.mapInArrow(shingled, "node binary, root binary, m long, copies long, shingles array<long>")
    sets = stored(sets.dropDuplicates(["node"]), "near-sets")
    pairs = _blocked(sets, "m", "node").select("root", "i", "j", "side", "node", "copies", "shingles")
    pairs = pairs.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    links = stored(pairs.mapInArrow(_verify, "a binary, b binary, n long"), "near-links")
    discard(sets, grouped)
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    classes = components(links.where("b IS NOT NULL").select("a", "b"))
    classes = classes.join(nodes.select("node", "rep"), "node")
    classes = classes.join(classes.groupBy("root").agg(F.min("rep").alias("class")), "root").select("node", "class", "root")
    facts = nodes.select("node", "rep", "copies").join(classes, "node", "left").join(counts, "node", "left").select(
        "node", F.coalesce("class", "rep").alias("class"), F.coalesce("root", "node").alias("class_node"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies")
    out = signed.select("key", "unkeyed", "t1", "node").join(stored(facts, "near-facts"), "node")
    return out.select(F.when(~F.col("unkeyed"), F.col("key")).alias("key"), "t1",
                      F.when(F.col("class") > -(2**63), F.col("class")).alias("class_id"), "n_links", F.col("copies").alias("n_copies"), "class_node")
