from datetime import date

import pytest
from pyspark.sql import functions as F

from contestlab import functions as fn
from tests.conftest import rows


def one(spark, **columns):
    """Evaluate expressions over one row of nothing."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


SCORES = [
    ("2:1 (1:0)", (2, 1, 1, 0), "Home", 1, (3, 0)),
    ("0:0 (0:0)", (0, 0, 0, 0), "Draw", 0, (1, 1)),
    ("1:3 (1:1)", (1, 3, 1, 1), "Away", -2, (0, 3)),
    ("10:0 (4:0)", (10, 0, 4, 0), "Home", 10, (3, 0)),
    (None, (None,) * 4, None, None, (None, None)),
]


def test_scores_results_and_points(spark):
    df = spark.createDataFrame([(s,) for s, *_ in SCORES], "score string")
    df = df.withColumn("s", fn.parse_score("score")).withColumn("w", fn.winner("s.ft_home", "s.ft_away"))
    got = df.select(
        "score", "s", "w", fn.goal_diff("s.ft_home", "s.ft_away").alias("d"),
        fn.points("w", F.lit(1)).alias("h"), fn.points("w", F.lit(0)).alias("a")).collect()
    assert [(r.score, tuple(r.s), r.w, r.d, (r.h, r.a)) for r in got] == SCORES


def test_literal_score_misreads_two_digits(spark):
    r = one(spark, s=fn.parse_score(F.lit("10:0 (4:0)"), "literal"))
    assert tuple(r.s) == (1, None, None, None)


@pytest.mark.parametrize("position, wanted", [
    ("Defensive Midfielder, Left Back", "Defense and Midfield"),
    ("Midfielder, Left Winger", "Midfield and Attack"),
    ("Midfielder, Forward", "Midfield and Attack"),
    ("Left Winger", "Attack"),
    ("Central Midfielder", "Midfielder"),
    ("Centre Back", "Defense"),
    ("Goalkeeper", "Goalkeeper"),
    (None, "Other"),
])
def test_position_classes(spark, position, wanted):
    assert one(spark, c=fn.field_position(F.lit(position).cast("string"))).c == wanted


def test_texts(spark):
    r = one(
        spark,
        slug=fn.slug(F.lit("A & B Town")),
        plain=fn.strip_digits(fn.strip_punct(F.lit("O'Neil 46"))),
        first=fn.replace_first(F.lit("Siem-de-Jong"), "-", " "),
        none=fn.replace_first(F.lit("Siem"), "-", " "),
        name=fn.normalise_name(F.lit(" Siem-de-Jong\n 7 ")),
        key=fn.key_of(F.lit("a"), F.lit(None).cast("string"), F.lit(3)),
        mark=fn.strip_punct(F.lit("a$b’c!")),
        second=fn.piece(F.lit("x_y"), "_", 2), third=fn.piece(F.lit("x_y"), "_", 3),
        link=fn.player_link(F.lit("Jan de Vries\n46'"), "https://example.org"))
    assert r.slug == "A-B-Town"
    assert r.plain == "ONeil "
    assert (r.first, r.none) == ("Siem de-Jong", "Siem")
    assert r["name"] == "Siem de Jong"
    assert r.key == "a_NA_3"
    assert r.mark == "a$bc"
    assert (r.second, r.third) == ("y", None)
    assert r.link == "https://example.org/player_summary/Jan-de-Vries/2/"


def test_values(spark):
    r = one(
        spark,
        mins=fn.minutes_played(F.lit(10), F.lit(3), F.lit(4)),
        cm=fn.parse_measure(F.lit("183 cm"), " cm"), bad=fn.parse_measure(F.lit("tall"), " cm"),
        label=fn.season_label(F.lit(2017)), start=fn.season_start(F.lit("2017/2018")),
        following=fn.next_season_label(F.lit("2017/2018")),
        day=fn.parse_date(F.lit("31/12/2019")), no_day=fn.parse_date(F.lit("31/13/2019")),
        up=fn.round_to(F.lit(0.125), 2), even=fn.round_to(F.lit(0.125), 2, "literal"),
        none=fn.rate(F.lit(1), F.lit(0)))
    assert (r.mins, r.cm, r.bad) == (880, 183.0, None)
    assert (r.label, r.start, r.following) == ("2017/2018", 2017, "2018/2019")
    assert (r.day, r.no_day) == (date(2019, 12, 31), None)
    assert (r.up, r.even, r.none) == (0.13, 0.12, None)


def test_has_finished_literal_compares_texts(spark):
    day = F.to_date(F.lit("2020-01-05"))
    as_of = date(2019, 12, 4)
    r = one(spark, a=fn.has_finished(day, as_of), b=fn.has_finished(F.to_date(F.lit("2020-01-01")), as_of, "literal"),
            c=fn.has_finished(F.lit(None).cast("date"), as_of))
    assert (r.a, r.b, r.c) == (0, 1, None)


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([(1, 3), (1, None), (0, 1), (1, 0)], "s int, p int")
    r = df.agg(
        fn.mean_where("p", F.col("s") == 1).alias("m"), fn.mean_where("p", F.col("s") == 5).alias("e"),
        fn.count_where(F.col("p") == 3).alias("n"), fn.sum_where("p", F.col("s") == 1).alias("t"),
        fn.n_distinct("p").alias("d"), fn.ratio_of_sums("p", F.lit(0)).alias("z")).first()
    assert tuple(r) == (1.5, 0.0, 1, 3, 4, 0.0)
    assert rows(df.select(fn.missing_flag("p").alias("m"))) == [(0,), (0,), (0,), (1,)]
