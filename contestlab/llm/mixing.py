"""Mixing sources to target weights.

A document belongs to one or more sources. Documents are summed by membership pattern, the words
that each source is to give are routed to the patterns as a min-cost flow in which every further
pass over a pattern costs more, and the words of the last, partial pass are filled with documents
in a seeded order. Only sums per source and pattern reach the driver; documents never do.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Hashable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from contestlab.llm.common import stored

CYCLE = (5, 2, 1)
LIMIT = 3
_BITS = 12  # of the seeded order that one histogram step resolves


def targets_of(sizes: Mapping[Hashable, int], weights: Mapping[Hashable, int], limit: int = LIMIT) -> dict:
    """Shares of the total by weight; a share above `limit` times its source stops there and the rest is shared anew."""
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        left, weight = total - sum(capped.values()), sum(weights[s] for s in rest)
        over = {s: limit * sizes[s] for s in rest if weights[s] * left > limit * sizes[s] * weight}
        if not over:
            return {s: float(capped[s]) if s in capped else weights[s] * left / weight for s in sizes}
        capped |= over


def cycled_weights(sources: Sequence[str | None], cycle: Sequence[int] = CYCLE) -> dict:
    """Weights repeating over the sources in code point order, a missing source last."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def route(capacity: Mapping[tuple, int], quota: Mapping[Hashable, int], limit: int = LIMIT) -> dict:
    """Words per pattern that fill the quotas at the least cost of repetition.

    Pass k over a pattern costs k - 1 for every word. Rerouting between sources and patterns is
    free, so the cheapest augmenting path ends in the pattern with the lowest pass; the flow is
    therefore the maximum flow with one pass, then extended with two passes, and so on.
    """
    flow: dict = defaultdict(int)  # (source, pattern) -> words
    load = dict.fromkeys(capacity, 0)
    given = dict.fromkeys(quota, 0)
    holds: dict = defaultdict(list)
    for p in capacity:
        for s in p:
            holds[s].append(p)
    for k in range(1, limit + 1):
        for s in quota:  # the direct arcs first; they are all there is where sources do not overlap
            for p in holds[s]:
                _push(flow, load, given, [s, p], min(quota[s] - given[s], k * capacity[p] - load[p]))
        while path := _augmenting(flow, load, given, holds, capacity, quota, k):
            room = [quota[path[0]] - given[path[0]], k * capacity[path[-1]] - load[path[-1]]]
            room += [flow[path[i + 1], path[i]] for i in range(1, len(path) - 1, 2)]
            _push(flow, load, given, path, min(room))
    return load


def _push(flow, load, given, path, amount) -> None:
    for i in range(0, len(path) - 1, 2):
        flow[path[i], path[i + 1]] += amount
    for i in range(1, len(path) - 1, 2):
        flow[path[i + 1], path[i]] -= amount
    given[path[0]] += amount
    load[path[-1]] += amount


def _augmenting(flow, load, given, holds, capacity, quota, k) -> list | None:
    """Shortest path source, pattern, source, ... from an unfilled source to a pattern with room."""
    came = {("s", s): None for s in quota if given[s] < quota[s]}
    queue = deque(came)
    while queue:
        at = queue.popleft()
        kind, name = at
        if kind == "p" and load[name] < k * capacity[name]:
            path = []
            while at is not None:
                path.append(at[1])
                at = came[at]
            return path[::-1]
        nexts = [("p", p) for p in holds[name]] if kind == "s" else [("s", s) for s in name if flow[s, name] > 0]
        for n in nexts:
            if n not in came:
                came[n] = at
                queue.append(n)
    return None


@dataclass
class Mix:
    """rows: key, size, pattern and words taken; sizes and targets by source."""

    rows: DataFrame
    sizes: dict
    targets: dict


def mix_sources(docs: DataFrame, key: str, size: Column, sources: Column, *, weights: Mapping | None = None,
                limit: int = LIMIT, seed: str = "mix", carry: Sequence[str] = ()) -> Mix:
    """Words to take of every document so that the sources meet their targets.

    `sources` is an array of names (a missing array: the one missing source; order and repeats do not
    matter). Every row is kept, with `taken` from 0 to `limit` times its size. All documents of a
    pattern get the same number of whole passes; the rest of the pattern's words goes to documents in
    the order of md5(seed, key), and the one document at the edge gives only the words still missing.
    Equal keys are taken in order of size, equal rows are interchangeable; a missing key is a key of
    its own. Empty documents give nothing; an empty table gives no rows. Other columns are not read,
    but for those named in `carry`, which come with the rows.

    The driver holds one number per source and pattern. Documents are cut by two histograms of the
    seeded order, 2 ** 12 cells per pattern each, so that only the last cell is ordered by a window.
    """
    spark = docs.sparkSession
    members = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    cell = lambda at: F.conv(F.substring(order, at, 3), 16, 10).cast("int")
    rows = stored(docs.select(
        F.col(key).alias("key"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"), members.alias("pattern"),
        order.alias("seeded"), cell(1).alias("c1"), cell(4).alias("c2"), *carry), "mix-rows")

    capacity = {tuple(r.pattern): r.size for r in rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()}
    sizes: dict = defaultdict(int)
    for pattern, n in capacity.items():
        for s in pattern:
            sizes[s] += n
    weights = weights or cycled_weights(list(sizes))
    targets = targets_of(sizes, weights, limit)
    load = route(capacity, {s: int(t) for s, t in targets.items()}, limit)

    def cut(df: DataFrame, at: str) -> list[tuple]:
        """Per pattern the cell in which the words run out and the words left when it begins."""
        cells = df.groupBy("pattern", at, "rest").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("pattern").orderBy(at))
        edge = cells.withColumn("upto", upto).where("upto - words <= rest AND rest < upto")
        return [tuple(r) for r in edge.selectExpr("pattern", at, "rest - upto + words").collect()]

    def beside(df: DataFrame, facts: list[tuple], schema: str) -> DataFrame:
        """Facts of the patterns: one short row each, and already on the driver, so they are sent whole to every task."""
        small = spark.createDataFrame(facts, f"match array<string>, {schema}")
        return df.join(F.broadcast(small), F.col("pattern").eqNullSafe(F.col("match")), "left").drop("match")

    dealt = beside(rows, [(list(p), load[p] // c if c else 0, load[p] % c if c else 0) for p, c in capacity.items()],
                   "passes long, rest long")
    first = cut(dealt, "c1")
    inner = beside(dealt.drop("rest"), first, "e1 int, rest long").where("c1 = e1")
    left = {tuple(p): (e, n) for p, e, n in cut(inner, "c2")}
    edges = [(p, e1, *left[tuple(p)]) for p, e1, _ in first]
    placed = beside(dealt, edges, "e1 int, e2 int, left_e2 long")
    at_edge = F.coalesce((F.col("c1") == F.col("e1")) & (F.col("c2") == F.col("e2")), F.lit(False))
    before = (F.col("c1") < F.col("e1")) | ((F.col("c1") == F.col("e1")) & (F.col("c2") < F.col("e2")))
    w = (Window.partitionBy("pattern").orderBy("seeded", "key", "size")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = placed.where(at_edge).withColumn("upto", F.sum("size").over(w)).withColumn(
        "more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left_e2") - F.col("upto") + F.col("size"))))
    rest = placed.where(~at_edge).withColumn("more", F.when(before, F.col("size")).otherwise(0))
    out = edge.drop("upto").unionByName(rest).select(
        "key", "size", "pattern", *carry, (F.col("passes") * F.col("size") + F.col("more")).cast("long").alias("taken"))
    return Mix(out, dict(sizes), targets)


def facts(spark, mix: Mix) -> DataFrame:
    """Size and target of every source, one row each."""
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("source_size", T.LongType()),
                           T.StructField("target", T.DoubleType())])
    return spark.createDataFrame([(s, mix.sizes[s], mix.targets[s]) for s in mix.sizes], schema)
