import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from contestlab.operators import scans
from contestlab.operators.scans import dense_rank_in, locf, ordered_scan, record_number


@pytest.fixture(scope="module")
def games(spark):
    """One group with most rows, one day with most of its rows, a NULL group, missing points."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        team = "hot" if i % 3 else rng.choice(["a", "b", None])
        day = 5 if team == "hot" and i % 2 else rng.randint(1, 30)
        pts = rng.choice([0, 1, 3, 3, None])
        data.append((team, day, i * 7, pts))
    rng.shuffle(data)
    return spark.createDataFrame(data, "team string, day int, id long, pts int").repartition(5).cache()


def _expected(games):
    out = {}
    pdf = games.toPandas()
    for _, part in pdf.groupby(pdf.team.fillna("-")):
        part = part.sort_values(["day", "id"])
        filled = part.pts.fillna(0)
        run = filled.cumsum()
        trail = filled.shift(1).rolling(5, min_periods=1).sum()
        last = part.pts.ffill()
        for n, (i, r, t, l, before) in enumerate(zip(part.id, run, trail, last, filled.shift(1)), 1):
            out[i] = (n, int(r), 0 if pd.isna(t) else int(t), None if pd.isna(l) else int(l))
    return out


@pytest.mark.parametrize("block_rows", [None, 97])
def test_scan_equals_plain_loop(games, block_rows):
    scanned = ordered_scan(
        games, ["team"], ["day", "id"],
        prefix={"n": F.lit(1), "run": F.col("pts")}, carry_last={"known": F.col("pts")}, reach=5,
        compute=lambda w: {"trail": F.coalesce(F.sum("pts").over(w.rowsBetween(-5, -1)), F.lit(0))},
        block_rows=block_rows)
    got = {r.id: (r.n, r.run, r.trail, r.known) for r in scanned.collect()}
    assert got == _expected(games)
    assert scanned.columns == ["team", "day", "id", "pts", "n", "run", "known", "trail"]


@pytest.mark.parametrize("block_rows", [None, 100])
def test_record_number_over_whole_table(games, block_rows):
    got = record_number(games, ["id"], block_rows=block_rows)
    assert [r.rec_no for r in got.orderBy("id").collect()] == list(range(1, 3001))


@pytest.mark.parametrize("block_rows", [None, 50])
@pytest.mark.parametrize("descending", [False, True])
def test_dense_rank_same_on_both_ways(games, block_rows, descending):
    ranked = dense_rank_in(games, ["team"], "pts", "rank", descending=descending, block_rows=block_rows)
    want = {3: 1, 1: 2, 0: 3} if descending else {0: 1, 1: 2, 3: 3}
    assert ranked.count() == 3000
    assert {(r.pts, r["rank"]) for r in ranked.select("pts", "rank").distinct().collect()} == {
        *want.items(), (None, None)}


@pytest.mark.parametrize("block_rows", [None, 2])
def test_locf_golden(spark, block_rows):
    df = spark.createDataFrame(
        [(1, 1, "d1"), (1, 2, None), (1, 3, None), (1, 4, "d2"), (1, 5, None), (2, 1, None), (2, 2, "x")],
        "page int, row int, day string")
    got = [r.day for r in locf(df, ["day"], ["page"], ["row"], block_rows=block_rows).orderBy("page", "row").collect()]
    assert got == ["d1", "d1", "d1", "d2", "d2", None, "x"]
    literal = locf(df, ["day"], ["page"], ["row"], mode="literal", block_rows=block_rows)
    assert literal.count() == 6


@pytest.fixture(scope="module")
def names(spark):
    """Texts with long common prefixes, missing ones and ties, almost all in one group."""
    rng = random.Random(11)
    texts = [None, "", "a"] + ["common prefix of some length / " + "x" * (i % 9) + str(i % 50) for i in range(60)] + ["\u00e9t\u00e9", "z" * 70]
    data = [("hot" if i % 9 else "b", rng.choice(texts), i, rng.choice([1, None])) for i in range(400)]
    return spark.createDataFrame(data, "g string, t string, id long, v int").repartition(4).cache()


@pytest.mark.parametrize("descending", [False, True])
def test_text_orders_are_cut_like_any_other(names, descending):
    def run(block_rows):
        scanned = ordered_scan(names, ["g"], ["t", "id"], prefix={"no": F.lit(1)}, carry_last={"last": F.col("v")}, block_rows=block_rows)
        ranked = dense_rank_in(names, ["g"], "t", "rank", descending=descending, block_rows=block_rows // 4)
        places = {r.id: r["rank"] for r in ranked.collect()}
        return sorted(((r.g, r.t, r.id, r["last"], r.no, places[r.id]) for r in scanned.collect()), key=repr)

    want = run(2_000_000)
    assert run(80) == want
    by_group = {}
    for g, t, i, v, no, rank in want:
        by_group.setdefault(g, []).append(((t is not None, (t or "").encode(), i), no, rank, t))
    for part in by_group.values():
        assert [no for _, no, _, _ in sorted(part)] == list(range(1, len(part) + 1))
        order = sorted({t.encode() for *_, t in part if t is not None}, reverse=descending)
        assert all(rank == (None if t is None else order.index(t.encode()) + 1) for _, _, rank, t in part)


def test_equal_rows_end_the_cutting(spark):
    same = spark.createDataFrame([("g", "t", 1)] * 60, "g string, t string, id int")
    assert sorted(r.rec_no for r in record_number(same, ["t", "id"], group=["g"], block_rows=10).collect()) == list(range(1, 61))


def _numbers(df, order, block_rows):
    numbered = record_number(df, order, group=["g"], block_rows=block_rows)
    return {r.id: r.rec_no for r in numbered.select("id", "rec_no").collect()}


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("kind, values", [
    ("double", [None, -INF, -1e300, -9e18, -0.0, 0.0, 1.0, 2.0, 3.0, 1e300, INF, NAN]),
    ("float", [None, -INF, -1.5, 0.0, 1.5, INF, NAN]),
    ("bigint", [None, -2**63, -2**62 - 1, -2**62, -1, 0, 1, 2**53, 2**53 + 1, 2**53 + 2, 2**63 - 2, 2**63 - 1]),
    ("string", [None, "", "\x00", "\x00\x00", "a", "a\x00", "a\x00b", "ab", "abcdef", "abcdef\x00", "abcdefg", "\u00e9", "\U0001f600"]),
    ("binary", [None, b"", b"\x00", b"\x7f", b"\x80", b"\xff", b"\xff\xff"]),
    ("boolean", [None, False, True]),
    ("decimal(9,2)", [None, "-12.50", "-0.01", "0.00", "0.01", "12.49", "12.50"]),
    ("decimal(38,20)", [None, "-123456789012345678.00000000000000000001", "-123456789012345678.00000000000000000000", "-0.5", "0",
                        "0.00000000000000000001", "0.5", "999999999999999999.00000000000000000000", "999999999999999999.00000000000000000001"]),
    ("timestamp", [None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "9999-12-31 23:59:59.999998",
                   "9999-12-31 23:59:59.999999"]),
    ("date", [None, "0001-01-01", "1969-12-31", "1970-01-01", "9999-12-31"]),
])
def test_every_type_is_cut_in_the_order_of_sorting(spark, kind, values):
    plain = isinstance(values[-1], (float, int, bytes)) or kind in ("string", "boolean")
    rows = [(i, v if plain else (None if v is None else str(v)), "hot" if i % 7 else "b") for i, v in enumerate(values * 3)]
    df = spark.createDataFrame(rows, f"id int, raw {kind if plain else 'string'}, g string").withColumn("v", F.col("raw").cast(kind)).repartition(3)
    want = _numbers(df, ["v", "id"], None)
    assert all(_numbers(df, ["v", "id"], block) == want for block in ((1, 4) if kind in ("double", "string") else (1,)))


def test_missing_value_is_first_beside_very_small_numbers(spark):
    df = spark.createDataFrame([("g", v, i) for i, v in enumerate([None, -1e300, -9e18, 1.0, 2.0, 3.0])], "g string, v double, id int")
    assert _numbers(df, ["v"], 2) == _numbers(df, ["v"], None) == {i: i + 1 for i in range(6)}


def test_long_texts_are_cut_by_few_columns(spark):
    """100 KB of common beginning: one round finds where the texts part, whatever lies before."""
    head = "passage " * 12_500
    texts = [head + str(i * 37 % 200) for i in range(200)] + [head, head[:-1], "", None, head + "\x00"]
    df = spark.createDataFrame([("hot", t, i) for i, t in enumerate(texts)], "g string, t string, id int").repartition(4)
    want = {i: n for n, (_, _, i) in enumerate(sorted((t is not None, (t or "").encode(), i) for i, t in enumerate(texts)), 1)}
    assert _numbers(df, ["t"], 20) == want


def test_a_lead_may_be_missing(spark):
    df = spark.createDataFrame([("g", None if i < 3 else i // 4, i) for i in range(40)], "g string, v int, id int")
    got = record_number(df, ["v", "id"], group=["g"], leads=[F.col("v") * 2.5, F.col("id")], block_rows=3)
    assert {r.id: r.rec_no for r in got.collect()} == {i: i + 1 for i in range(40)}


def test_cutting_reads_the_rows_from_one_written_copy(spark, games):
    """The rows are written once; a round adds tables with one row per block, not a copy of the rows."""
    from contestlab.operators import scans

    written = []
    pinned = scans.pinned
    try:
        scans.pinned = lambda df: written.append(out := pinned(df)) or out
        assert record_number(games, ["day", "id"], group=["team"], block_rows=50).count() == 3000
    finally:
        scans.pinned = pinned
    sizes = [df.count() for df in written]
    assert sizes[0] == 3000 and max(sizes[1:]) < 1500 and len(sizes) > 5


def test_cells_are_found_by_halving(spark):
    marks = [float(m) for m in sorted([i // 3 for i in range(40)] + [100] * 23)]
    values = [-1.0, *[m / 2 for m in range(30)], 99.0, 100.0, 101.0, None]
    df = spark.createDataFrame([(marks, v) for v in values], "marks array<double>, at double")
    got = df.withColumn("cell", scans._cell_of(F.col("marks"), F.col("at")))
    assert {r["at"]: r["cell"] for r in got.collect()} == {
        v: 0 if v is None else sum(2 * (m < v) + (m == v) for m in marks) for v in values}
    assert "aggregate(marks" not in got._jdf.queryExecution().analyzed().toString()  # no mark after mark
