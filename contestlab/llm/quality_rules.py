"""Quality rules: counts of repetition and symbols, and the distance of a text from its language.

The distance is Jensen-Shannon's (square root of the divergence, base 2) between histograms of the
text and of all texts of its language: one of character classes, one of the language's common words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from contestlab.llm.common import stored, whole
from contestlab.llm.textstats import CLASSES, class_counts, let, repeated_lines, repeated_words, words_of

COMMON = 24            # words of a language in its histogram; all other words are one bin
MIN_WORDS = 50         # below, histograms say nothing
LANGUAGES = 200        # with most words, among which that of a text without one is looked for
BOUND, SLACK = 0.24, 1.2  # a text of n words may be BOUND + SLACK / sqrt(n) away from its language
_MARKS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # one character per common word, to count them by


def js_distance(p: Column, q: Column) -> Column:
    """Between two arrays of counts with a sum above zero."""
    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def distance(t: Column) -> Column:
        terms = F.zip_with(p, q, lambda x, y: let(
            F.struct((x / t.p).alias("a"), (y / t.q).alias("b")),
            lambda z: part(z.a, (z.a + z.b) / 2) + part(z.b, (z.a + z.b) / 2)))
        return F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2))

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), distance)


def references(docs: DataFrame, lang: str, text: str, common: int = COMMON) -> DataFrame:
    """One row per language: its most frequent words with their counts, and that of all others.

    Words are counted on the map side first; each task passes on only its most frequent words per language.
    """
    docs = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("ref_lang"), whole(F.col(text)).alias("text"))
    words = stored(docs.select("ref_lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("ref_lang", "word").agg(
        F.count(F.lit(1)).alias("n")), "word-counts")
    rank = F.row_number().over(Window.partitionBy("ref_lang").orderBy(F.desc("n"), "word"))
    top = words.withColumn("rank", rank).where(F.col("rank") <= common).groupBy("ref_lang").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    sums = words.groupBy("ref_lang").agg(F.sum("n").alias("words"))
    counts = F.transform("top", lambda x: x.n.cast("double"))
    rest = F.col("words") - F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return stored(sums.join(top, "ref_lang").select(
        "ref_lang", "words", F.map_from_entries(F.transform("top", lambda x, i: F.struct(
            F.xxhash64(x.word), F.substring(F.lit(_MARKS), i + 1, F.lit(1))))).alias("ref_marks"),
        F.concat(counts, F.array(rest)).alias("ref_words")), "language-references")


def _nearest(rows: DataFrame, known: DataFrame) -> DataFrame:
    """`like`: the language of a row, or of one without that whose common words it has most of (of equal ones the one with most
    words in all). All common words stand in one map, in a table of one row."""
    order = Window.orderBy(F.desc("words"), "ref_lang")
    first = known.orderBy(F.desc("words"), "ref_lang").limit(LANGUAGES).withColumn("place", -F.row_number().over(order))
    by_word = first.select("ref_lang", "place", F.explode(F.map_keys("ref_marks")).alias("word")).groupBy("word").agg(
        F.collect_list(F.struct("place", "ref_lang")).alias("of"))
    one = by_word.agg(F.map_from_entries(F.collect_list(F.struct("word", "of"))).alias("speakers")).withColumn("all_rows", F.lit(1))
    one = one.join(first.agg(F.max(F.struct("place", "ref_lang")).alias("largest")).withColumn("all_rows", F.lit(1)), "all_rows")
    found = F.flatten(F.filter(F.transform("hashes", lambda h: F.try_element_at("speakers", h)), lambda x: x.isNotNull()))
    most = let(found, lambda all_: F.array_max(F.transform(F.array_distinct(all_), lambda x: F.struct(
        F.size(F.filter(all_, lambda y: y == x)).alias("n"), x["place"].alias("place"), x["ref_lang"].alias("ref_lang")))))
    rows = rows.withColumn("all_rows", F.lit(1)).join(F.broadcast(one), "all_rows", "left").drop("all_rows")
    guessed = F.coalesce(most["ref_lang"], F.col("largest")["ref_lang"])
    return rows.withColumn("like", F.when(F.col("lang").isNotNull(), F.col("lang")).otherwise(guessed)).drop("speakers", "largest")


def judge(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: key, lang and the columns

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, class_distance,
    word_distance (double, null where a guard holds), kept.

    A text fails by its base counts (fewer than 50 words, or over half of its words in repeated
    windows of three) or when a distance exceeds its bound, which widens for short texts. No distance
    is taken of texts under `MIN_WORDS` words. A text without a language is compared with the one whose common
    words it has most of, among the `LANGUAGES` largest (with the largest, if it has none); without any language in the
    table there is no distance. A missing text has no words and fails. References are counted over all rows,
    so repeated rows weigh as often as they occur; ties between common words go to the smaller word. An
    empty table gives no rows. Columns other than the three are not read.
    """
    docs = docs.select(F.col(key).alias("key"), whole(F.col(text)).alias("text"), F.col(lang).alias("lang"))
    known = references(docs, "lang", "text")
    rows = class_counts(docs, "text").withColumn("hashes", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))
    rows = _nearest(rows, known).join(known, F.col("like") == F.col("ref_lang"), "left").drop("ref_lang", "words")
    # each common word as one character, so that a histogram is a count of characters
    n = F.size("hashes").cast("long")
    marks = F.array_join(F.transform("hashes", lambda h: F.coalesce(F.try_element_at("ref_marks", h), F.lit("-"))), "")
    rows = repeated_words(rows, "hashes", "repeats").withColumn("marks", F.when((n >= MIN_WORDS) & F.col("ref_words").isNotNull(), marks))
    common = [(F.length("marks") - F.length(F.replace("marks", F.lit(m)))).cast("double") for m in _MARKS[:COMMON]]
    others = (F.length("marks") - F.length(F.replace("marks", F.lit("-"), F.lit("")))).cast("double")
    bins = F.concat(F.slice(F.array(*common), F.lit(1), F.size("ref_words") - 1), F.array(others))
    space, symbol = (F.col("classes")[list(CLASSES).index(c)] for c in ("space", "symbol"))
    rows = stored(rows.select(
        "key", "lang", "like", "classes", n.alias("n_words"), (F.length("text") - space).cast("long").alias("word_chars"),
        symbol.cast("long").alias("n_symbols"), repeated_lines(F.split("text", "\n", -1)).cast("long").alias("n_dup_lines"),
        F.col("repeats").cast("long").alias("n_repeat_words"),
        F.when(F.col("marks").isNotNull(), js_distance(bins, F.col("ref_words"))).alias("word_distance")), "quality-rows")

    by_class = rows.groupBy(F.col("lang").alias("ref_lang")).agg(
        F.array(*[F.sum(F.col("classes")[i]) for i in range(len(CLASSES))]).alias("ref_classes"))
    rows = rows.join(by_class, F.col("like") == F.col("ref_lang"), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn(
        "class_distance", F.when(F.col("word_distance").isNotNull(), js_distance(F.col("classes"), F.col("ref_classes"))))
    bound = BOUND + SLACK / F.sqrt("n_words")
    far = F.coalesce(F.greatest("class_distance", "word_distance") > bound, F.lit(False))
    return rows.withColumn("kept", ~(F.col("base_failed") | far)).drop("classes", "like", "ref_lang", "ref_classes")
