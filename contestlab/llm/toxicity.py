"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its posteriors.

Voters are lexicons and patterns. Words that begin alike share a stem; the stems that tell labelled rows
apart are one voter each, beside voters of their sum, fixed lexicons of common insults and threats, and patterns of style.
The label model is a mixture of two tree-shaped distributions, one of toxic and one of clean texts: every voter
depends on the class and on one other voter at most, along the strongest correlations. Expectation-maximisation
fits it on the votes of all documents, with the class of labelled rows given. A logistic regression then learns its posteriors
from counts and votes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from contestlab.llm.common import stored, whole
from contestlab.llm.quality_model import remainder_of
from contestlab.llm.words import in_parts, whole_texts, words_of

SAMPLE = 200_000       # labelled rows that stems are found on, at most about
FIT = 200_000          # rows with posteriors that the linear classifier is fitted on, at most about
PARTS = 16             # partitions of sums, so that a fixed number reaches the driver
STEM = range(3, 9)     # code points of a stem; a word is one as well
CANDIDATES = 50_000    # stems of toxic rows that are counted in clean ones, the most frequent first
LEXICON = 256          # stems that are kept
OWN_VOTER = 48         # of these, so many of the best have a voter of their own
TIMES = (1, 2, 3)      # occurrences that a stem may ask for before it votes
LINK = 0.002           # least conditional mutual information, in nats, of two voters that are linked
ROUNDS = 8

# Common English words of abuse and of threat.
INSULTS = ("idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "fool",
           "jerk", "ugly", "creep", "coward", "liar", "pig", "bastard", "bitch", "asshole")
THREATS = ("kill", "hurt", "punch", "burn", "destroy", "hate", "die", "shoot", "beat")
#: Patterns of style, counted in the text as it is; RE2 reads them in linear time.
PATTERNS = {
    "capital": r"[A-Z]", "mark": r"[!?]{2,}", "masked": r"[A-Za-z][*#@$%]+[A-Za-z]", "symbol": r"[#*$%&|<>]",
    "second_person": r"(?i)\b(?:you|your|you're|u)\b", "line": r"\n",
}
ABSTAIN, CLEAN, TOXIC = 0, 1, 2
START = np.array([[0.10, 0.35, 0.05], [0.25, 0.05, 0.20]])  # half a row of votes per class to begin with: voters are rather right than wrong


@dataclass
class Lexicon:
    """Stems in order of their gain, and how many occurrences each asks for."""

    stems: list[str] = field(default_factory=list)
    least: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def voters(self) -> int:
        return min(len(self.stems), OWN_VOTER) + 4 + 6

    def stem_of(self) -> Callable[[str], int]:
        """The stem of a word, -1 without one; no stem begins another."""
        place = {s: i for i, s in enumerate(self.stems)}
        lengths = sorted({len(s) for s in self.stems if not s.endswith("=")})
        heads = {s.rstrip("=")[:STEM[0]] for s in self.stems}

        def find(word: str) -> int:
            if word[:STEM[0]] not in heads:
                return -1
            for n in lengths:
                if n > len(word):
                    break
                if (i := place.get(word[:n])) is not None:
                    return i
            return place.get(f"{word}=", -1)

        return find


def _stems(word: str) -> list[str]:
    """The beginnings of a word, and the word itself marked by = where it is longer or shorter than any of them."""
    out = [word[:n] for n in STEM if n <= len(word)]
    return out if len(word) in STEM else [*out, f"{word}="] if len(word) > 1 else out


def _counted(rows: DataFrame, wanted: list[str] | None) -> DataFrame:
    """stem and, for each of TIMES, the texts that hold it so often; of all stems or of those wanted. One row per task and stem."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else frozenset(wanted)
        for part in in_parts(batches):
            words = words_of(part.column("text"), lower=pc.utf8_lower)
            place: dict[str, int] = defaultdict()
            place.default_factory = place.__len__
            found = [[place[s] for s in _stems(w.decode()) if known is None or s in known] for w in words.dictionary]
            size = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for own in found for i in own), np.int64, int(size.sum()))
            start, many = (np.cumsum(size) - size)[words.codes], size[words.codes]
            at = np.arange(many.sum()) + np.repeat(start - (np.cumsum(many) - many), many)
            pairs, times = np.unique(np.repeat(words.row, many) * max(len(place), 1) + flat[at], return_counts=True)
            stem = pairs % max(len(place), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(place), pa.string()), *(pa.array(np.bincount(stem[times >= t], minlength=len(place))) for t in TIMES)],
                ["stem", *(f"n{t}" for t in TIMES)])

    counts = rows.select("text").mapInArrow(count, "stem string, " + ", ".join(f"n{t} long" for t in TIMES))
    return counts.groupBy("stem").agg(*[F.sum(f"n{t}").alias(f"n{t}") for t in TIMES])


def find_lexicon(rows: DataFrame) -> Lexicon:
    """Stems that labelled rows (text, y from 0 to 1) of the two classes hold unlike often."""
    toxic, clean = rows.where("y >= 0.5"), rows.where("y < 0.5")
    n1, n0 = toxic.count(), clean.count()
    if not n1 or not n0:
        return Lexicon()
    frequent = _counted(toxic, None).where(F.col("n1") >= max(3, n1 // 200)).orderBy(F.desc("n1"), "stem").limit(CANDIDATES).collect()
    there = {r.stem: r[1:] for r in frequent}
    elsewhere = {r.stem: r[1:] for r in _counted(clean, list(there)).collect()}
    a = np.array(list(there.values()), float).reshape(-1, len(TIMES))
    b = np.array([elsewhere.get(s, (0,) * len(TIMES)) for s in there], float).reshape(-1, len(TIMES))
    gain = _gain(a, n1, b, n0)
    best, names = gain.argmax(axis=1), list(there)
    least_gain = 2 * np.log(max(len(names), 2))  # of so many stems that tell nothing, less than one reaches it by chance
    stems, least = [], []
    for i in sorted(range(len(names)), key=lambda i: (-gain[i].max(), -len(names[i]), names[i])):
        if gain[i].max() < least_gain or len(stems) == LEXICON:
            break
        bare = names[i].rstrip("=")
        if not any(bare.startswith(s.rstrip("=")) or s.startswith(bare) for s in stems):
            stems.append(names[i])
            least.append(TIMES[best[i]])
    return Lexicon(stems, np.array(least, np.int64))


def _gain(a: np.ndarray, n1: int, b: np.ndarray, n0: int) -> np.ndarray:
    """Likelihood ratio statistic of a text's class and a mark that `a` of n1 and `b` of n0 texts have; 0 where it speaks for clean."""
    def part(k: np.ndarray, n: float, p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    both = (a + b) / (n1 + n0)
    return np.where(a * n0 > b * n1, 2 * (part(a, n1, a / n1) + part(b, n0, b / n0) - part(a, n1, both) - part(b, n0, both)), 0)


def vote(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """key, votes (a byte per voter) and counts (numbers of the linear classifier) per row of (key, text)."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stem_of, stems = lexicon.stem_of(), len(lexicon.stems)
        own = min(stems, OWN_VOTER)
        for part in in_parts(batches):
            texts = whole_texts(part.column("text"))
            words = words_of(texts, lower=pc.utf8_lower)
            n, size = words.lengths, max(stems, 1)
            spelled = [w.decode() for w in words.dictionary]

            def hits(of: Callable[[str], int], kinds: int) -> np.ndarray:
                kind = np.fromiter(map(of, spelled), np.int64, len(spelled))[words.codes]
                return np.bincount(words.row[kind >= 0] * kinds + kind[kind >= 0], minlength=len(n) * kinds).reshape(-1, kinds)

            by_stem = hits(stem_of, size)
            fixed = {w: 0 for w in INSULTS} | {w: 1 for w in THREATS}
            seeds = hits(lambda w: fixed.get(w, -1), 2)
            style = {k: pc.count_substring_regex(texts, p).to_numpy(zero_copy_only=False) for k, p in PATTERNS.items()}
            chars = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), 1)
            enough = by_stem >= np.pad(lexicon.least, (0, size - stems), constant_values=1)
            total, kinds, most = by_stem.sum(axis=1), enough.sum(axis=1), np.maximum(n, 1)
            dense = total / most
            votes = np.zeros((len(n), lexicon.voters), np.uint8)
            votes[:, :own] = np.where(enough[:, :own], TOXIC, ABSTAIN)
            pooled = [
                np.select([kinds >= 1, total == 0], [TOXIC, CLEAN], ABSTAIN), np.select([kinds >= 2, kinds == 0], [TOXIC, CLEAN], ABSTAIN),
                np.select([total >= 4, total <= 1], [TOXIC, CLEAN], ABSTAIN), np.select([dense >= 0.005, dense < 0.001], [TOXIC, CLEAN], ABSTAIN),
            ]
            patterns = [
                np.select([seeds[:, 0] >= 2, (seeds[:, 0] == 0) & (n >= 50)], [TOXIC, CLEAN], ABSTAIN), np.where(seeds[:, 1] > 0, TOXIC, ABSTAIN),
                np.where((seeds.sum(axis=1) > 0) & (style["second_person"] > 0), TOXIC, ABSTAIN),
                np.select([style["capital"] > 0.3 * chars, style["capital"] < 0.05 * chars], [TOXIC, CLEAN], ABSTAIN),
                np.where(style["mark"] + style["masked"] > 0.02 * most, TOXIC, ABSTAIN), np.where(style["symbol"] > 0.1 * most, TOXIC, CLEAN),
            ]
            votes[:, own:] = np.stack([*pooled, *patterns], axis=1)
            counts = np.stack([
                np.log1p(total), np.log1p(kinds), np.minimum(100 * dense, 5), np.log1p(n), np.log1p(seeds[:, 0]), np.log1p(seeds[:, 1]),
                style["capital"] / chars, style["symbol"] / chars, np.minimum(style["mark"] / most, 1), np.minimum(style["masked"] / most, 1),
                np.minimum(style["line"] / most, 1)], axis=1)
            rest = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([row.tobytes() for row in votes], pa.binary()), pa.array(list(counts), pa.list_(pa.float64()))],
                [*(name for name in part.schema.names if name != "text"), "votes", "counts"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(judge, f"{kept}, votes binary, counts array<double>")


@dataclass
class LabelModel:
    """Class shares and, per class and voter, the chance of a vote given that of the voter's parent (itself: none)."""

    prior: np.ndarray
    parent: np.ndarray
    chance: np.ndarray  # class, voter, vote of the parent, vote
    cast: np.ndarray    # class, voter, vote: shares of all rows

    @classmethod
    def of(cls, counts: np.ndarray, parent: np.ndarray) -> LabelModel:
        """The model that expected counts of (class, voter, parent's vote, vote) make most likely, nearly."""
        shares = counts[:, 0].sum(axis=(1, 2)) + [0.45, 0.05]
        given = counts.sum(axis=2, keepdims=True) + START[:, None, None, :]
        back = 0.5 * given / given.sum(axis=3, keepdims=True)  # half a row as the voter votes at large
        chance = (counts + back) / (counts + back).sum(axis=3, keepdims=True)
        return cls(shares / shares.sum(), parent, chance, given[:, :, 0] / given.sum(axis=(0, 2, 3))[None, :, None])

    def log_joint(self, votes: np.ndarray) -> np.ndarray:
        """Log of the chance of class and votes; rows by class."""
        voter = np.arange(votes.shape[1])
        given = np.where(self.parent == voter, 0, votes[:, self.parent])
        return np.stack([np.log(self.prior[y]) + np.log(self.chance[y][voter, given, votes]).sum(axis=1) for y in (0, 1)], axis=1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        joint = self.log_joint(votes)
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Per voter the share of its votes, abstentions left out, that are for the class of the row."""
        right = self.cast[0][:, CLEAN] + self.cast[1][:, TOXIC]
        return right / (self.cast[:, :, CLEAN] + self.cast[:, :, TOXIC]).sum(axis=0)


def _expected(patterns: DataFrame, voters: int, model: LabelModel | None, pairs: bool) -> np.ndarray:
    """Expected counts by class: of votes by voter and parent's vote, or of the votes of all pairs of voters.

    `patterns` has votes, y and n, a row for every pattern that occurs. Given classes count as they are; without a
    model only rows with one count. Each task sums its part; as many sums as `PARTS` reach the driver.
    """
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0.0
        for batch in batches:
            if not len(batch):
                continue
            votes = np.frombuffer(b"".join(batch.votes), np.uint8).reshape(len(batch), voters).astype(np.int64)
            y = batch.y.to_numpy(float)
            guess = np.where(np.isnan(y), 0.0 if model is None else model.posterior(votes), y)
            seen = ~np.isnan(y) if model is None else np.ones(len(y), bool)
            sums = []
            for share in (1 - guess, guess):
                weight = share * seen * batch.n.to_numpy(float)
                if pairs:
                    hot = (votes[:, :, None] == np.arange(3)).reshape(len(votes), -1).astype(float)
                    sums.append((hot * weight[:, None]).T @ hot)
                else:
                    parent = np.arange(voters) if model is None else model.parent
                    given = np.where(parent == np.arange(voters), 0, votes[:, parent])
                    at = (np.arange(voters) * 9 + given * 3 + votes).ravel()
                    sums.append(np.bincount(at, np.repeat(weight, voters), minlength=9 * voters).reshape(voters, 3, 3))
            total = total + np.stack(sums)
        if not np.isscalar(total):
            yield pd.DataFrame({"sums": [total.tobytes()]})

    shape = (2, 3 * voters, 3 * voters) if pairs else (2, voters, 3, 3)
    parts = patterns.mapInPandas(add, "sums binary").collect()
    return sum((np.frombuffer(r.sums).reshape(shape) for r in parts), np.zeros(shape))


def _tree(pairs: np.ndarray, voters: int, link: float) -> np.ndarray:
    """Parents along a maximum spanning forest of the mutual information of two voters given the class."""
    joint = pairs.reshape(2, voters, 3, voters, 3) / max(pairs[:, :3, :3].sum(), 1e-12)
    single = np.einsum("yaiaj->yai", joint * np.eye(3)[None, None, :, None, :])
    share = single.sum(axis=2)[:, :1]
    apart = single[:, :, :, None, None] * single[:, None, None, :, :] / np.maximum(share, 1e-12)[:, :, None, None, None]
    info = np.where(joint > 0, joint * np.log(np.maximum(joint, 1e-300) / np.maximum(apart, 1e-300)), 0).sum(axis=(0, 2, 4))
    parent, reached = np.arange(voters), np.zeros(voters, bool)
    near, by = np.zeros(voters), np.arange(voters)
    for _ in range(voters):
        i = int(np.where(reached, -1, near).argmax())
        reached[i] = True
        parent[i] = by[i] if near[i] >= link else i
        closer = ~reached & (info[i] > near)
        near[closer], by[closer] = info[i][closer], i
    return parent


def fit_labels(patterns: DataFrame, voters: int, *, link: float = LINK, rounds: int = ROUNDS) -> LabelModel:
    """Accuracies first as labelled rows show them, voters apart; then the links; then both classes by rounds over all rows."""
    model = LabelModel.of(_expected(patterns, voters, None, pairs=False), np.arange(voters))
    for turn in range(rounds):
        if turn == 2:
            parent = _tree(_expected(patterns, voters, model, pairs=True), voters, link)
            apart = np.repeat(model.chance[:, :, :1], 3, axis=2)  # whatever the parent votes
            model = LabelModel(model.prior, parent, apart, model.cast)
        model = LabelModel.of(_expected(patterns, voters, model, pairs=False), model.parent)
    return model


def _inputs(votes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.hstack([votes == TOXIC, votes == CLEAN, counts, np.ones((len(votes), 1))]).astype(float)


def fit_linear(rows: DataFrame, voters: int, model: LabelModel, *, ridge: float = 1e-3, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a logistic regression on the model's posteriors (given classes as they are), by Newton steps of sums per task."""
    weights: np.ndarray | None = None

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            votes = np.frombuffer(b"".join(batch.votes), np.uint8).reshape(len(batch), voters)
            x, y = _inputs(votes, np.stack(batch.counts)), batch.y.to_numpy(float)
            y = np.where(np.isnan(y), model.posterior(votes.astype(np.int64)), y)
            w = np.zeros(x.shape[1]) if weights is None else weights
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            curve = x.T @ (x * np.maximum(p * (1 - p), 1e-4)[:, None])
            yield pd.DataFrame({"a": [curve.tobytes()], "b": [(x.T @ (y - p)).tobytes()], "n": [len(batch)]})

    for _ in range(rounds):
        parts = rows.mapInPandas(add, "a binary, b binary, n long").collect()
        total = sum(r.n for r in parts)
        if not total:
            break
        slope = sum(np.frombuffer(r.b) for r in parts)
        curve = sum(np.frombuffer(r.a).reshape(len(slope), -1) for r in parts)
        old = np.zeros(len(slope)) if weights is None else weights
        weights = old + np.linalg.solve(curve + ridge * total * np.eye(len(slope)), slope - ridge * total * old)
    return weights if weights is not None else np.zeros(2 * voters + 12)


def classify(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
             threshold: float = 0.3, sample: int = SAMPLE, fit: int = FIT, seed: int = 13) -> DataFrame:
    """One row per input row: key, held_out, score from 0 to 1 and predicted (1 where the score reaches the threshold).

    Only labels of keys whose remainder is not 2 are learnt from: stems on at most about `sample` of those rows, the
    classes given to the label model on all of them. Votes, accuracies and correlations cover all documents; the
    linear classifier is fitted on at most about `fit` rows, picked by a hash. A key labelled twice has the
    mean of its labels. Rows with a missing key have no label; a missing label does not count.

    A score depends on the text alone; a missing text is an empty one, and equal texts score equal. Without
    labels of both kinds there are no stems, and the fixed lexicons and patterns vote alone. An empty table gives no rows. Other
    columns are not read.
    """
    docs = docs.select(docs[key].alias("key"), whole(docs[text]).alias("text"))
    known = labels.select(labels[key].alias("key"), labels[label].cast("double").alias("y")).where(
        F.col("key").isNotNull() & F.col("y").isNotNull() & (remainder_of(F.col("key")) != 2))
    known = stored(known.groupBy("key").agg(F.avg("y").alias("y")), "toxic-labels")
    n = known.count()
    picked = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1_000_000))
    lexicon = find_lexicon(docs.join(known.where(picked < int(1_000_000 * min(1.0, sample / max(n, 1)))), "key"))
    votes = stored(vote(docs, lexicon), "votes")
    named = votes.where(F.col("key").isNotNull()).join(known, "key", "left")
    marked = stored(named.unionByName(votes.where(F.col("key").isNull()).withColumn("y", F.lit(None).cast("double"))).select("key", "votes", "counts", "y"), "votes-labelled")
    patterns = stored(marked.groupBy("votes", "y").agg(F.count(F.lit(1)).alias("n")).repartition(PARTS), "vote-patterns")
    model = fit_labels(patterns, lexicon.voters)
    rows = marked.count()
    few = F.pmod(F.xxhash64("key", "votes", "counts", F.lit(seed)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, fit / max(rows, 1)))
    weights = fit_linear(stored(marked.where(few).repartition(PARTS), "votes-fitted"), lexicon.voters, model)
    voters = lexicon.voters

    @F.pandas_udf("double")
    def score(votes: pd.Series, counts: pd.Series) -> pd.Series:
        if not len(votes):
            return pd.Series(np.zeros(0))
        x = _inputs(np.frombuffer(b"".join(votes), np.uint8).reshape(len(votes), voters), np.stack(counts))
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))))

    return votes.select("key", (remainder_of(F.col("key")) == 2).alias("held_out"), score("votes", "counts").alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
