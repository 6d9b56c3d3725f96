"""Statistics of a text as column expressions: character classes, words, lines and repetition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from contestlab.llm.common import BLANKS, SPACE

# Character classes in the order in which they are taken out of the text.
CLASSES = {
    "lower": "[a-z]+", "space": SPACE + "+", "upper": "[A-Z]+", "symbol": r"[#*$%&|<>]+", "digit": "[0-9]+",
    "mark": r"[\x00-\x7F]+", "other": None,
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are not blanks."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def class_counts(df: DataFrame, text: str, out: str = "classes") -> DataFrame:
    """An array of code points per class. Each class is cut out of what the ones before it left, so the texts shrink."""
    rest, counts = F.col(text), []
    for i, pattern in enumerate(CLASSES.values()):
        if pattern is None:  # all that is left
            counts.append(F.length(rest).cast("double"))
            break
        df = df.withColumn(f"rest{i}", F.regexp_replace(rest, pattern, ""))
        counts.append((F.length(rest) - F.length(f"rest{i}")).cast("double"))
        rest = F.col(f"rest{i}")
    return df.withColumn(out, F.array(*counts)).drop(*[f"rest{i}" for i in range(len(CLASSES))])


def repeated_words(df: DataFrame, hashes: str, out: str, width: int = 3) -> DataFrame:
    """Adds the number of words in windows of `width` words that occur at least twice in the text.

    Takes an array of word hashes; windows are compared by a 64-bit hash within one text only. The upper
    bits of a window's hash and its place share one number, so that sorting plain numbers brings equal
    windows together; neighbours are then compared by the whole hash.
    """
    n = F.size(hashes)
    windows = F.when(n > width, F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])))
    df = df.withColumn("windows_", windows)
    df = df.withColumn("windows_", F.when(F.size(F.array_distinct("windows_")) < F.size("windows_"), F.col("windows_")))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size("windows_").cast("long")))) - 1
    df = df.withColumn("mask_", mask)
    df = df.withColumn("order_", F.transform("windows_", lambda h, i: h.bitwiseAND(F.bitwise_not("mask_")).bitwiseOR(i.cast("long"))))
    df = df.withColumn("order_", F.sort_array("order_"))

    def window(x: Column) -> Column:
        return F.get("windows_", x.bitwiseAND(F.col("mask_")).cast("int"))

    twice = F.filter("order_", lambda x, i: (window(x) == window(F.get("order_", i - 1))) | (window(x) == window(F.get("order_", i + 1))))
    covered = F.flatten(F.transform(twice, lambda x: let(x.bitwiseAND(F.col("mask_")), lambda p: F.array(*[p + k for k in range(width)]))))
    return df.withColumn(out, F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))).drop("windows_", "mask_", "order_")


def repeated_lines(lines: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    return let(F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
