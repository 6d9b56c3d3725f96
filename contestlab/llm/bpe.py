"""Byte-level BPE over the distinct words of blocks of documents.

A task cuts a block of texts into words and passes each distinct word on once; Spark's higher-order
functions fold the ranked merges over the word's bytes, looking pairs up in a literal rank map; the
next step in the same task puts the ids of each text together and decodes them again by concatenating
the tokens' bytes. No text is shuffled.

The most frequent words of a bounded sample of the texts are folded once, beforehand, and both steps get the list of
them; a block folds only the words that are not on it. What the sample holds decides how much work is saved,
never a result.

A state of the fold is an array of ranks. A round looks all pairs up in a table of displaced rows, two reads of an array for each,
and merges the leftmost pair of the lowest rank. A long word would take as many rounds as it has tokens to merge. Its state is
a text with one character per token, of three bytes each, in the order of ranks. So the pair to merge next is the one with
the smallest merged character, and all places of that pair are merged by one `replace`, from left to right.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from contestlab.llm.common import small_batches, stored, whole
from contestlab.llm.textstats import let

_BASE = 0x0800              # character of rank 0; up to U+D7FF every character takes three bytes in UTF-8
_MARK = "\ue000"             # ends a finished state
BLOCK = 8 << 20             # characters whose distinct words are encoded together, or one document
_ROWS = 2_000               # of an Arrow batch between the steps
SAMPLE = 128 << 20          # bytes of text, about, whose words may be folded beforehand
COMMON = 300_000            # words that are, at most; each Python step holds only its half of what is known of them
_LONGEST = 24               # bytes of such a word
SHORT = 48                  # bytes of a word that is folded as an array, at most
_OWNER = 32                 # bits of a slot below the rank that owns it


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of the tokens and the pattern that cuts a text into words."""

    ranks: dict[bytes, int]
    pattern: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def symbol(self, token: bytes) -> str:
        return chr(_BASE + self.ranks[token])

    def merges(self) -> list[tuple[bytes, bytes]]:
        """The two parts that every longer token is put together from, where the merges of its own bytes come to it.

        Inside any word, the merges between two places that no merge has crossed are those of the bytes between them alone.
        So a token comes from the one pair that its own bytes end in, and other ways to cut it never meet.
        """
        return [pair for t in self.ranks if len(t) > 1 and (pair := self._parts(t))]

    def _parts(self, token: bytes) -> tuple[bytes, bytes] | None:
        ranks, none = self.ranks, float("inf")
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == none:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def early(self, merges: list[tuple[bytes, bytes]]) -> set[bytes]:
        """Tokens that are part of one of lower rank: a merge to them may make a pair that goes before their other places."""
        if len(self.ranks) > 0xD800 - _BASE or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary needs all single bytes and at most 53,248 tokens")
        return {t for a, b in merges for t in (a, b) if self.ranks[t] > self.ranks[a + b]}


@dataclass(frozen=True)
class RankMap:
    """The merges as two literals: a perfect hash of the pairs, packed so tightly that it stays in a core's cache.

    A pair belongs to a group; the group's byte in `turns` is hashed with the pair to its slot of
    `slots`, which holds the pair, its token and the token's sign, 10 bytes together. A pair without a merge
    finds another pair there.
    """

    turns: bytes
    slots: bytes

    @classmethod
    def of(cls, vocabulary: Vocabulary, merges: list[tuple[bytes, bytes]]) -> RankMap:
        size = max(1024, 1 << (len(merges) * 6 // 5).bit_length())
        early = vocabulary.early(merges)
        groups: list[list[tuple[bytes, bytes]]] = [[] for _ in range(size // 4)]
        for a, b in merges:
            pair = (vocabulary.symbol(a) + vocabulary.symbol(b)).encode()
            groups[xxhash.xxh64_intdigest(pair, 42) % len(groups)].append((pair, vocabulary.symbol(a + b).encode() + (b"1" if a + b in early else b"0")))
        turns, slots = bytearray(len(groups)), [b"-" * 10] * size
        taken = [False] * size
        for g in sorted(range(len(groups)), key=lambda g: -len(groups[g])):
            for turn in range(256):
                at = [xxhash.xxh64_intdigest(bytes([turn]), xxhash.xxh64_intdigest(pair, 42)) % size for pair, _ in groups[g]]
                if len(set(at)) == len(at) and not any(taken[x] for x in at):
                    break
            else:
                raise ValueError("no place for a group of merges")
            turns[g] = turn
            for x, (pair, token) in zip(at, groups[g], strict=True):
                taken[x], slots[x] = True, pair + token
        return cls(bytes(turns), b"".join(slots))

    def tokens(self, pairs: Column, turns: Column, slots: Column) -> Column:
        """The merged symbol of every pair of an array with its sign, or null, all as bytes. The literals come bound, see `encode_word`."""
        def slot(pair: Column) -> Column:
            # both tables have a power of two of places
            group = F.xxhash64(pair).bitwiseAND(F.lit(len(self.turns) - 1).cast("long")).cast("int")
            place = F.xxhash64(pair, F.substring(turns, group + 1, F.lit(1)))
            return place.bitwiseAND(F.lit(len(self.slots) // 10 - 1).cast("long")).cast("int") * 10

        return F.zip_with(pairs, F.transform(pairs, slot), lambda p, at: F.when(
            F.substring(slots, at + 1, F.lit(6)) == p, F.substring(slots, at + 7, F.lit(4))))


def encode_word(symbols: Column, table: RankMap) -> Column:
    """The merges folded over a word, given as one symbol per byte.

    The rule is: merge the pair of the lowest rank, of several the leftmost. All places of that pair are
    merged at once, but only the leftmost if the token is part of one of lower rank.
    """
    def pairs_of(state: Column) -> Column:
        raw = state.cast("binary")
        return F.transform(F.sequence(F.lit(0), (F.octet_length(state) / 3).cast("int") - 2),
                           lambda i: F.substring(raw, 3 * i + 1, F.lit(6)))

    def step(state: Column, tokens_of) -> Column:
        return let(pairs_of(state), lambda p: let(tokens_of(p), lambda t: let(F.array_min(t), lambda best: F.when(
            best.isNull(), F.concat(state, F.lit(_MARK))).otherwise(let(first(t, best), lambda at: merge(state, F.get(p, at), best, at))))))

    def first(tokens: Column, best: Column) -> Column:
        return F.array_position(tokens, best).cast("int") - 1

    def merge(state: Column, pair: Column, best: Column, at: Column) -> Column:
        symbol = F.substring(best, F.lit(1), F.lit(3)).cast("string")
        return F.when(F.substring(best, F.lit(4), F.lit(1)).cast("string") == "0", F.replace(state, pair.cast("string"), symbol)).otherwise(
            F.concat(F.substring(state, F.lit(1), at), symbol, F.substring(state, at + 3, F.length(state))))

    def fold(turns: Column, slots: Column) -> Column:
        tokens_of = lambda pairs: table.tokens(pairs, turns, slots)
        steps = F.sequence(F.lit(1), F.greatest(F.length(symbols), F.lit(1)))
        done = lambda s: (F.octet_length(s) <= 3) | F.endswith(s, F.lit(_MARK))
        return F.rtrim(F.aggregate(steps, symbols, lambda s, _: F.when(done(s), s).otherwise(step(s, tokens_of))), F.lit(_MARK))

    return let(F.lit(table.turns), lambda turns: let(F.lit(table.slots), lambda slots: fold(turns, slots)))


def _fit(free: np.ndarray, rights: np.ndarray, rng: np.random.Generator) -> int | None:
    """A start from which all places of a row are free: one of some random starts, else the first of all."""
    low, high = -rights.min(), len(free) - rights.max()
    for starts in (rng.integers(low, high, 500), np.arange(low, high)):
        for right in rights:
            starts = starts[free[starts + right]]
        if len(starts):
            return int(starts[0])
    return None


@dataclass(frozen=True)
class Displaced:
    """The merges as rows of ranks, a row for every left part, laid over each other: the token of a pair stands as far behind
    the start of its left part's row as the right part's rank says, beside the rank that owns the place."""

    starts: list[int]
    slots: list[int]

    @classmethod
    def of(cls, vocabulary: Vocabulary, merges: list[tuple[bytes, bytes]]) -> Displaced:
        ranks, rows = vocabulary.ranks, defaultdict(list)
        for a, b in merges:
            rows[ranks[a]].append((ranks[b], ranks[a + b]))
        most = max(ranks.values()) + 1
        free, rng = np.ones(most + max(1024, 2 * len(merges)), dtype=bool), np.random.default_rng(5)
        starts, laid = np.zeros(most, dtype=np.int64), []
        for a in sorted(rows, key=lambda a: (-len(rows[a]), a)):
            rights, tokens = np.array(rows[a], dtype=np.int64).T
            while (start := _fit(free, rights, rng)) is None:
                free = np.append(free, np.ones(most, dtype=bool))  # room for any row
            starts[a], free[start + rights] = start, False
            laid.append((start + rights, (a << _OWNER) + tokens))
        slots = np.full(len(free), most << _OWNER, dtype=np.int64)
        for places, tokens in laid:
            slots[places] = tokens
        return cls(starts.tolist(), slots.tolist())

    def fold(self, ranks: Column) -> Column:
        """The ranks of a word's tokens from those of its bytes: the leftmost pair of the lowest rank is merged until no pair is a token."""
        starts, slots = (F.split(F.lit(",".join(map(str, x))), ",").cast(kind) for x, kind in ((self.starts, "array<int>"), (self.slots, "array<bigint>")))

        def token(a: Column, b: Column) -> Column:
            # a place that another rank owns leaves bits above `_OWNER`
            return F.get(slots, F.get(starts, a) + b).bitwiseXOR(F.shiftleft(a.cast("long"), _OWNER))

        def merged(state: Column, tokens: Column, best: Column) -> Column:
            at = F.array_position(tokens, best).cast("int")
            return let(at, lambda at: F.concat(F.slice(state, F.lit(1), at - 1), F.array(best.cast("int")), F.slice(state, at + 2, F.size(state))))

        def step(state: Column) -> Column:
            return let(F.zip_with(state, F.slice(state, F.lit(2), F.size(state)), token), lambda tokens: let(F.array_min(tokens), lambda best: F.when(
                best < F.lit(1 << _OWNER), merged(state, tokens, best)).otherwise(F.array_append(state, F.lit(-1)))))

        rounds = F.sequence(F.lit(1), F.size(ranks))
        folded = F.aggregate(rounds, ranks, lambda s, _: F.when(F.element_at(s, -1) < 0, s).otherwise(step(s)))
        return F.filter(folded, lambda x: x >= 0)


_CUT = pa.schema([("word", pa.string()), ("ranks", pa.list_(pa.int32())), ("key", pa.int64()), ("unkeyed", pa.bool_()), ("places", pa.list_(pa.int32()))])


def _symbols(vocabulary: Vocabulary):
    """A word as the fold takes it: one symbol per byte, or the one symbol of a word that is a token and needs no merges."""
    ranks, of_byte = vocabulary.ranks, {b: vocabulary.symbol(bytes([b])) for b in range(256)}

    def symbols(word: str) -> str:
        raw = word.encode()
        rank = ranks.get(raw)
        return chr(_BASE + rank) if rank is not None else raw.decode("latin-1").translate(of_byte)

    return symbols


def _short(vocabulary: Vocabulary):
    """Words of at most `SHORT` bytes as lists of the ranks of their bytes, or of the one rank of a word that is a token; others missing."""
    ranks, of_byte = vocabulary.ranks, [vocabulary.ranks[bytes([b])] for b in range(256)]

    def short(word: str) -> list[int] | None:
        raw = word.encode()
        rank = ranks.get(raw)
        return [rank] if rank is not None else [of_byte[b] for b in raw] if len(raw) <= SHORT else None

    return short


def _counter(vocabulary: Vocabulary):
    """Words of texts, those that need merges and are not long, and how often a task finds them."""
    split, short = regex.compile(vocabulary.pattern).findall, _short(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(split(text))
        words = [(s, n) for w, n in found.items() if 1 < len(s := short(w) or ()) <= _LONGEST]
        for at in range(0, len(words), 20 * _ROWS):
            part = words[at:at + 20 * _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in part], _CUT.field("ranks").type), pa.array([n for _, n in part])], ["word", "n"])

    return count


@dataclass(frozen=True)
class Known:
    """Words that are folded beforehand, and for each the number of its tokens, its ids as text and its bytes."""

    words: dict[str, int]
    sizes: list[int]
    ids: list[str]
    raw: list[bytes]


def common_words(rows: DataFrame, vocabulary: Vocabulary, table: Displaced, sample: int, most: int) -> Known:
    """At most `most` words, the most frequent of those that occur twice or more in about `sample` bytes of the texts."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    picked = rows.select("text") if size <= sample else rows.select("text").sample(sample / size, seed=17)
    found = picked.mapInArrow(_counter(vocabulary), "word array<int>, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = stored(found.where("n > 1"), "bpe-words")
    least, kept = 2, 0
    for r in sorted(found.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):  # one row per count
        kept += r.words
        if kept > most:
            least = r.n + 1
            break
    folded = found.where(F.col("n") >= least).select("word", table.fold(F.col("word")).alias("folded"))
    tokens, names = _named(vocabulary)
    words, sizes, ids, raw = {}, [], [], []
    for batch in folded.toArrow().to_batches(_ROWS):  # as rows of Python objects they would take some hundred MB
        for before, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words[b"".join(map(tokens.__getitem__, before)).decode()] = len(sizes)
            sizes.append(len(after))
            ids.append(" ".join(map(names.__getitem__, after)))
            raw.append(b"".join(map(tokens.__getitem__, after)))
    return Known(words, sizes, ids, raw)


def _named(vocabulary: Vocabulary) -> tuple[dict[int, bytes], dict[int, str]]:
    """Bytes and number as text of every token by its rank."""
    return {rank: token for token, rank in vocabulary.ranks.items()}, {rank: str(rank) for rank in vocabulary.ranks.values()}


class _Places(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


def _cutter(vocabulary: Vocabulary, before: dict[str, int]):
    """Rows of distinct words of a block, without those known before, then rows of its texts as places among both."""
    split, short, symbols = regex.compile(vocabulary.pattern).findall, _short(vocabulary), _symbols(vocabulary)

    def block(texts: list[tuple]) -> Iterator[pa.RecordBatch]:
        known = _Places(before)
        rows = [(k, u, list(map(known.__getitem__, split(t)))) for k, u, t in texts]
        words = list(islice(known, len(before), None))
        for at in range(0, len(words), 20 * _ROWS):
            part = words[at:at + 20 * _ROWS]
            ranks = list(map(short, part))
            long = [symbols(w) if r is None else None for w, r in zip(part, ranks, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(long, pa.string()), pa.array(ranks, _CUT.field("ranks").type),
                                              *[pa.nulls(len(part), f.type) for f in list(_CUT)[2:]]], schema=_CUT)
        for at in range(0, len(rows), _ROWS):
            keys, unkeyed, places = zip(*rows[at:at + _ROWS], strict=True)
            ends = np.cumsum([0, *map(len, places)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(places), dtype=np.int32, count=ends[-1])
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(keys), f.type) for f in list(_CUT)[:2]], pa.array(keys, pa.int64()), pa.array(unkeyed, pa.bool_()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], schema=_CUT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= BLOCK:
                    yield from block(held)
                    held, size = [], 0
        if held:
            yield from block(held)

    return cut


def _joiner(vocabulary: Vocabulary, known: Known, with_ids: bool):
    """The ids and the decoded bytes of each text, from the encoded words of its block and those known before."""
    tokens, names = _named(vocabulary)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, ids, raw = list(known.sizes), list(known.ids), list(known.raw)  # of the words of the open block: tokens, ids as text, bytes
        in_words, known_words = False, len(known.sizes)
        for batch in batches:
            word, ranks, key, unkeyed, places = batch.columns
            n_words = key.null_count
            # a batch may end one block and begin the next: runs of words and of texts alternate
            for is_text, start, stop in _runs(key.is_valid().to_numpy(zero_copy_only=False) if n_words else np.ones(len(word), dtype=bool)):
                if not is_text:
                    if not in_words:
                        del sizes[known_words:], ids[known_words:], raw[known_words:]
                        in_words = True
                    for w, long in zip(ranks.slice(start, stop - start).to_pylist(), word.slice(start, stop - start).to_pylist(), strict=True):
                        w = w if long is None else [ord(c) - _BASE for c in long]
                        sizes.append(len(w))
                        ids.append(" ".join(map(names.__getitem__, w)))
                        raw.append(b"".join(map(tokens.__getitem__, w)))
                    continue
                in_words = False
                part, size = places.slice(start, stop - start), np.array(sizes or [0], dtype=np.int64)
                flat, ends = part.flatten().to_numpy(), np.concatenate([[0], np.cumsum(part.value_lengths().to_numpy())])
                out = []
                for a, b in zip(ends, ends[1:], strict=False):
                    at = flat[a:b]
                    count, at = int(size[at].sum()), at.tolist()
                    shown = " ".join(map(ids.__getitem__, at))
                    decoded = hashlib.sha256(b"".join(map(raw.__getitem__, at))).hexdigest()
                    out.append((count, hashlib.sha256(shown.encode()).hexdigest(), decoded, *([shown] if with_ids else [])))
                yield pa.RecordBatch.from_arrays([key.slice(start, stop - start), unkeyed.slice(start, stop - start),
                                                  *[pa.array(c) for c in zip(*out, strict=True)]], names=columns)

    columns = ["key", "unkeyed", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    return join


def _runs(flags: np.ndarray) -> Iterator[tuple[bool, int, int]]:
    """Runs of equal flags: the flag, where it starts and where it stops."""
    edges = [0, *(np.flatnonzero(np.diff(flags)) + 1).tolist(), len(flags)]
    return ((bool(flags[a]), a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", text: str = "text",
                     with_ids: bool = False, sample: int = SAMPLE, common: int = COMMON) -> DataFrame:
    """One row per input row: key (long), n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids joined by blanks.

    The hashes are of the decimal ids joined by one blank, and of the bytes that the ids decode to. A missing
    or empty text has no tokens. Special tokens are not known: their names are ordinary text. Equal texts
    have equal ids, whatever block they fall into; repeated rows and keys are kept. An empty table gives
    no rows; other columns are not read. A task holds one block: `BLOCK` characters, or one document.
    Up to `common` words of a sample of about `sample` bytes are folded beforehand; any sample gives the same rows.
    """
    small_batches(docs.sparkSession)
    merges = vocabulary.merges()
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("key"), F.col(key).isNull().alias("unkeyed"),
                       whole(F.col(text)).alias("text"))
    table = Displaced.of(vocabulary, merges)
    known = common_words(rows, vocabulary, table, sample, common)
    cut = rows.mapInArrow(_cutter(vocabulary, known.words), "word string, ranks array<int>, key long, unkeyed boolean, places array<int>")
    word, ranks = F.col("word"), F.col("ranks")
    done = cut.withColumns({"word": F.when(F.length(word) > 1, encode_word(word, RankMap.of(vocabulary, merges))).otherwise(word),
                            "ranks": F.when(F.size(ranks) > 1, table.fold(ranks)).otherwise(ranks)})
    out = done.mapInArrow(_joiner(vocabulary, replace(known, words={}), with_ids), "key long, unkeyed boolean, n_tokens long, ids_sha256 string, decoded_sha256 string"
                          + (", ids string" if with_ids else ""))
    return out.select(F.when(~F.col("unkeyed"), F.col("key")).alias("key"), *out.columns[2:])
