"""Secret scan: three fixed patterns, and tokens that look random rather than like an identifier.

Two character Markov models are trained from samples that the fixed patterns label: the random
model from the values they find, the identifier model from the tokens of identifier form in documents
where they find nothing. A token is a secret when its log-likelihood ratio is high enough: in total where it
is short, per character where it is long.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from contestlab.llm.common import stored, whole
from contestlab.llm.textstats import let

# The three patterns and the least lengths of a match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex")

#: Maximal runs of token characters of at least so many, the candidates of the models; = only ends one, elsewhere it parts a name and its value.
LEAST = 12
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}=*" % LEAST
#: Tokens labelled as ordinary have 8 characters or more: letters in parts joined by _ / or -, four digits at most and only at the end
#: of a part, or plain numbers. The run is taken whole and its form is tested apart: a repeated group would make Java's matcher recurse.
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_/-]{8,}+(?![A-Za-z0-9+/_=-])"
NAMED, NOT_NAMED = "^[A-Za-z]", "[0-9][A-Za-z]|[0-9]{5}"
NUMBER, NOT_NUMBER = "^[0-9]", "[A-Za-z]|[_/-]{2}|[_/-]$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
UNIFORM = 0.3  # share of the uniform model in the random one
BACK_OFF = 5.0  # weight of single characters in the identifier model
REPEAT = 0.2  # chance of the identifier model that a character is the one before again
MARGIN = 0.7  # nats per character
OWN = 2  # occurrences of an ordinary token with letters that do not count: neither it nor a copy of its document vouches for it
FULL = 19  # character pairs; a shorter token needs the margin of so many
LEAST_PAIRS = 1000  # a model of fewer character pairs is not used
BLOCK = 256  # matches whose spans are gathered at a time
CHARACTER = "(?s)."


def matches_at(text: Column, pattern: str, value: int | None = None) -> Column:
    """Matches from left to right as structs of start, end (code points, end exclusive) and value (a group)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if value is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))

    def placed(f: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(f)), lambda g: F.length(g))
        steps = F.transform(F.arrays_zip(f.alias("m"), gaps.alias("gap"), values.alias("value")), lambda x: F.struct(
            x["gap"].alias("gap"), F.length(x["m"]).alias("length"), x["value"].alias("value")))
        return let(steps, lambda s: F.when(F.size(s) <= BLOCK, _laid_out(s, F.lit(0))).otherwise(_in_blocks(s)))

    return let(found, lambda f: F.when(F.size(f) > 0, placed(f)))


def _laid_out(steps: Column, start: Column) -> Column:
    """Spans of matches, each with the gap before it and its length."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.aggregate(steps, F.struct(start.alias("at"), none.alias("spans")), lambda s, x: F.struct(
        (s["at"] + x["gap"] + x["length"]).alias("at"),
        F.concat(s["spans"], F.array(F.struct(
            (s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["length"]).alias("end"),
            x["value"].alias("value")))).alias("spans")), lambda s: s["spans"])


def _in_blocks(steps: Column) -> Column:
    """The same block by block: an array that grows by one is copied each time, so only short ones may grow."""
    def started(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["gap"] + x["length"]))
        starts = F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])
        return F.flatten(F.zip_with(blocks, starts, _laid_out))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
                         lambda k: F.slice(steps, k * BLOCK + 1, F.lit(BLOCK)))
    return let(blocks, started)


def _named(spans: Column, kind: str, order: int) -> Column:
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,name:string,value:string>>")
    return F.coalesce(F.transform(spans, lambda x: F.struct(
        x.start.alias("start"), F.lit(order).alias("kind"), x.end.alias("end"), F.lit(kind).alias("name"),
        x.value.alias("value"))), empty)


def _is_ordinary(token: Column) -> Column:
    return (token.rlike(NAMED) & ~token.rlike(NOT_NAMED)) | (token.rlike(NUMBER) & ~token.rlike(NOT_NUMBER))


def _pairs(tokens: Column) -> Column:
    """The character pairs of tokens."""
    characters = F.transform(tokens, lambda t: F.regexp_extract_all(t, F.lit(CHARACTER), F.lit(0)))
    return F.flatten(F.transform(characters, lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: F.concat(a, b))))


def train(rows: DataFrame) -> Column | None:
    """Log-likelihood ratio of random against identifier for every pair of characters, as a literal array.

    `rows` has arrays `random` and `ordinary` of sample tokens. Counts are summed over all rows; the
    table has one number per pair of the alphabet, whatever the size of the corpus. The random model is
    blended with the uniform one, as secrets come in more alphabets than the samples have; the
    identifier model backs off to its single characters and expects repeats. None where either model has too few pairs.
    """
    size = len(ALPHABET)
    counts = np.zeros((2, size, size))
    samples = F.array(F.struct(F.lit(0).alias("model"), F.col("random").alias("tokens")),
                      F.struct(F.lit(1).alias("model"), F.col("ordinary").alias("tokens")))
    pairs = (rows.select(F.explode(samples).alias("s")).select("s.model", F.explode("s.tokens").alias("token"))
             .groupBy("model", "token").agg(F.count(F.lit(1)).alias("n"))  # a token is cut once, not once per use
             .withColumn("n", F.col("n") - F.when((F.col("model") == 1) & F.col("token").rlike("[A-Za-z]"), OWN).otherwise(0))
             .where((F.length("token") > 1) & (F.col("n") > 0))
             .select("model", "n", F.explode(_pairs(F.array("token"))).alias("pair"))
             .groupBy("model", "pair").agg(F.sum("n").alias("n")))
    for r in pairs.collect():  # at most two models times the pairs of the alphabet
        a, b = ALPHABET.find(r.pair[0]), ALPHABET.find(r.pair[1])
        if a >= 0 and b >= 0:
            counts[r.model, a, b] += r.n
    if counts.sum(axis=(1, 2)).min() < LEAST_PAIRS:
        return None
    after = counts.sum(axis=2, keepdims=True)
    drawn = (1 - UNIFORM) * counts[0] / np.maximum(after[0], 1) + UNIFORM / size
    single = counts[1].sum(axis=0) + 0.5
    named = (counts[1] + BACK_OFF * single / single.sum()) / (after[1] + BACK_OFF)
    named = (1 - REPEAT) * named + REPEAT * np.eye(size)
    ratio = np.log(drawn / named).ravel().tolist()
    return F.array(*[F.lit(round(x, 6)) for x in ratio])


def is_random(token: Column, table: Column, margin: float) -> Column:
    """Whether the log-likelihood ratio of the token exceeds `margin` for each of its pairs, and of `FULL` pairs at least.

    The different pairs alone must reach the margin of `FULL` pairs, as a pattern that repeats itself is
    no evidence. Tokens without small letters are judged as if written in small ones.
    """
    size = len(ALPHABET)

    def total(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + F.get(table, x))

    def judged(pairs: Column) -> Column:
        enough = F.greatest(F.size(pairs), F.lit(FULL)) * F.lit(margin)
        return (total(pairs) > enough) & (total(F.array_distinct(pairs)) > FULL * margin)

    folded = F.when(token.rlike("[a-z]"), token).otherwise(F.lower(token))
    places = let(folded, lambda t: F.transform(
        F.regexp_extract_all(t, F.lit(CHARACTER), F.lit(0)), lambda c: F.instr(F.lit(ALPHABET), c)))
    codes = let(places, lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: (a - 1) * size + b - 1))
    return let(codes, judged)


def _uncovered(token: Column, base: Column) -> Column:
    """The parts of a token of `LEAST` characters or more that no span covers; spans are sorted by start."""
    def part(start: Column, end: Column) -> Column:
        piece = F.struct(start.alias("start"), token.kind.alias("kind"), end.alias("end"), token["name"].alias("name"),
                         F.substring(token.value, start - token.start + 1, end - start).alias("value"))
        return F.when(end - start >= LEAST, F.array(piece)).otherwise(
            F.array().cast("array<struct<start:int,kind:int,end:int,name:string,value:string>>"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,name:string,value:string>>")
    touching = F.filter(base, lambda b: (b.start < token.end) & (token.start < b.end))
    return F.aggregate(touching, F.struct(token.start.alias("at"), none.alias("parts")), lambda s, b: F.struct(
        F.greatest(s["at"], b.end).alias("at"), F.concat(s["parts"], part(s["at"], b.start)).alias("parts")),
        lambda s: F.concat(s["parts"], part(s["at"], token.end)))


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per input row: key and `spans`, an array of (start, kind, end, name, value) by start, then kind.

    Kinds 0 to 2 are the fixed patterns, leftmost and not overlapping within a kind, whatever the models
    say: assignments with a value of 6 characters or more, access keys of 20, hex runs of 24. Kind 3,
    `random`, are maximal runs of 12 or more token characters, or what spans of the first three leave of
    them, whose ratio exceeds `margin` for each pair of characters, and that of 19 pairs in total. Plain
    numbers are samples of the identifier model, as nothing tells a secret one from others. A missing
    text is an empty one; equal texts get equal spans. An empty table gives no rows, and with too few samples no span of kind 3 is
    added. Other columns are not read. Repeated rows count as often in the samples as they occur.
    """
    docs = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"))
    t = F.col("text")
    assign = F.filter(matches_at(t, ASSIGN, 2), lambda x: F.length(x.value) >= 6)
    base = F.array_sort(F.concat(_named(assign, "assign", 0), _named(matches_at(t, ACCESS), "access", 1),
                                 _named(matches_at(t, HEX), "hex", 2)))
    rows = docs.select("key", "text", base.alias("base"))
    tokens = _named(matches_at(t, TOKEN), "random", 3)
    free = F.when(F.size("base") == 0, tokens).otherwise(F.flatten(F.transform(tokens, lambda x: _uncovered(x, F.col("base")))))
    rows = rows.select("key", "base", free.alias("free"), F.transform("base", lambda b: b.value).alias("random"),
                       F.when(F.size("base") == 0, F.filter(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0)), _is_ordinary)).alias("ordinary"))
    samples = rows.select("random", "ordinary")
    found = stored(rows.select("key", "base", "free"), "secret-candidates")
    table = train(samples)
    if table is None:
        return found.select("key", F.col("base").alias("spans"))
    more = F.filter("free", lambda x: is_random(x.value, table, margin))
    return found.select("key", F.when(F.size("free") == 0, F.col("base")).otherwise(
        F.array_sort(F.concat("base", more))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["name"], x.start, x.end)), ",")
