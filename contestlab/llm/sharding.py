"""Balanced label propagation: linked documents move to their neighbours' shards, counts stay even.

Documents that share a link are neighbours; those whose largest link is the same form a unit, which moves as one. All
documents start in the shard that a hash tells. In each round the shards of all documents are joined to the links,
every link counts its documents per shard, and joined back, every unit sums the counts of its links: so it sees where its
neighbours are now. It then moves to the shard with most of them that has room, under the quotas, until no unit
moves. Units that do not fit as they are go by size, and documents without links fill what is left, so that
every shard has its exact quota.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from contestlab.llm.common import stored

_CELLS = 1024  # of the seeded order of movers, per shard
_SPLIT = 256  # blocks in which a group over several shards is numbered, at least
_BLOCK = 50_000  # rows that one window task numbers, about


def _numbered(df: DataFrame, group: list[str], seeded: str, out: str, counts: int,
              least: int = 1, ties: tuple = ("key", "size", "crc")) -> DataFrame:
    """Gapless numbers from 0 in each group in the order of `seeded`, block by block of that order, `least` blocks or more."""
    blocks = max(least, -(-counts // _BLOCK))
    df = df.withColumn("block", F.floor((F.col(seeded).cast("double") + 2.0**63) / 2.0**64 * blocks).cast("long"))
    sizes = df.groupBy(*group, "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("block")) - F.col("n")
    sizes = sizes.select(*group, "block", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy(*group, "block").orderBy(seeded, *ties)) - 1
    return df.withColumn("rank", rank).join(sizes, [*group, "block"]).withColumn(
        out, F.col("before") + F.col("rank")).drop("block", "rank", "before")


def shard_documents(docs: DataFrame, key: Column, size: Column, crc: Column, link: Column, *, shards: int = 8,
                    rounds: int | None = None, seed: int = 7, report: list | None = None) -> DataFrame:
    """Rows key, size, crc, shard (0 to shards - 1) and slot, gapless from 0 in each shard.

    Shard counts differ by one at most. Documents with an equal `link` that is not null are linked; an array holds several links of
    a document (its text, its near copies, its site). A unit stays together if a shard has room for it when its
    turn comes: units larger than a sixteenth of a shard by size, then the others by rounds of propagation
    until no unit moves (`rounds` at most, if given), and what these leave by size again. A unit that no
    shard has room for fills the roomiest shards one after the other, so it is in as few as there can be.
    `report` is a list to which each round adds its cut: the documents that are not in the shard where most of
    their link's are, summed over the links, before the round; the last entry is what the rounds leave.

    Rows with missing or equal keys are rows like all others; equal rows are interchangeable. An empty table
    gives no rows, and fewer documents than shards leave the last shards empty. Columns are expressions over
    `docs`; other columns are not read.

    Rounds handle one row per link, unit and shard, and documents are joined with the shard of their unit once. The
    driver sees sums per shard and cell of the seeded order, how many units of each size the rounds left, the
    large units (32 a shard at most) and those that have to be split (fewer than shards besides the large ones).
    """
    seeded = F.xxhash64(F.lit(seed), key.cast("string"), crc)
    rows = docs.select(key.alias("key"), size.alias("size"), crc.alias("crc"), link.alias("link"), seeded.alias("seeded"))
    rows = rows.withColumn("shard", F.pmod(F.col("seeded"), F.lit(shards)).cast("int"))
    several = isinstance(rows.schema["link"].dataType, T.ArrayType)
    rows = _with_units(rows) if several else stored(rows, "shard-rows")
    total = rows.count()
    room = [total // shards + (s < total % shards) for s in range(shards)]
    votes = F.array(*[F.count(F.when(F.col("shard") == s, 1)) for s in range(shards)])
    groups = stored(rows.where(F.col("link").isNotNull()).groupBy("link").agg(F.count(F.lit(1)).alias("n"), votes.alias("votes"))
                    .where(F.lit(several) | (F.col("n") > 1)).withColumn("seeded", F.xxhash64(F.lit(seed), "link")), "shard-groups")
    pairs = _pairs(rows) if several else groups.select(F.col("link").alias("hub"), "link", F.posexplode("votes").alias("start", "n")).where("n > 0")
    large = F.col("n") > max(1, total // shards // 16)
    parts = []  # link, shard, and the numbers of the documents that go there
    for g in sorted(groups.where(large).select("link", "n", "votes", "seeded").collect(), key=lambda g: (-g.n, g.seeded)):
        parts += [(g.link, *part) for part in _parts(g.n, room, g.votes)]
    kind = rows.schema["link"].dataType
    first = _literal(docs, [p[:2] for p in parts if p[2] == 0], ["link", "settled"], [kind, "int"])
    settled, left = _propagated(groups.where(~large), stored(pairs, "shard-pairs"), first, room, rounds, report)
    for g in left:
        parts += [(g.link, *part) for part in _parts(g.n, room)]

    known = _literal(docs, parts, ["link", "to", "first", "last", "whole"], [kind, "int", "long", "long", "boolean"])
    columns = ["key", "size", "crc", "seeded"]
    marked = rows.join(F.broadcast(known.where("whole OR first = 0").select("link", "to", "whole")), "link", "left")
    kept = marked.where("whole").select(*columns, F.col("to").alias("shard"), F.lit(0).alias("last"))
    cut = marked.where("NOT whole").select(*columns, "link")
    cut = _numbered(cut, ["link"], "seeded", "at", max((p[3] for p in parts), default=0), _SPLIT)
    cut = cut.join(F.broadcast(known.where("NOT whole").drop("whole")), "link").where("first <= at AND at < last")
    cut = cut.select(*columns, F.col("to").alias("shard"), F.lit(0).alias("last"))
    alone = marked.where("whole IS NULL AND link IS NULL").select(*columns, "shard", F.lit(1).alias("last"))
    others = marked.where("whole IS NULL AND link IS NOT NULL").join(settled, "link", "left").select(
        *columns, F.coalesce("settled", "shard").alias("shard"), F.when(F.col("settled").isNull(), 1).otherwise(0).alias("last"))
    return _filled(stored(kept.unionByName(cut).unionByName(alone).unionByName(others), "shard-placed"), shards, total)


def _with_units(rows: DataFrame) -> DataFrame:
    """Rows whose `link` is that of their unit: of the links that other documents have too the largest, null without any; `links` holds all."""
    rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "shard-links")
    links = rows.select("id", F.explode(F.array_distinct("link")).alias("hub")).where(F.col("hub").isNotNull())
    sizes = links.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    units = links.join(sizes, "hub").groupBy("id").agg(
        F.max_by("hub", F.struct("n", F.xxhash64("hub"))).alias("unit"), F.collect_set("hub").alias("links"))
    rows = rows.join(units, "id", "left").select("key", "size", "crc", F.col("unit").alias("link"), "seeded", "shard", "links")
    return stored(rows, "shard-rows")


def _pairs(rows: DataFrame) -> DataFrame:
    """Documents per link, unit and shard at the start."""
    return rows.where(F.col("link").isNotNull()).select(F.explode("links").alias("hub"), "link", F.col("shard").alias("start")).groupBy(
        "hub", "link", "start").agg(F.count(F.lit(1)).alias("n"))


def _literal(df: DataFrame, rows: list[tuple], names: list[str], kinds: list) -> DataFrame:
    """A table of rows that the driver holds."""
    made = [F.struct(*[F.lit(x).cast(k).alias(n) for x, n, k in zip(r, names, kinds, strict=True)])
            for r in rows or [(None,) * len(names)]]
    return df.sparkSession.range(1).select(F.inline(F.array(*made))).where(F.lit(bool(rows)))


def _parts(n: int, room: list[int], votes: list[int] | None = None) -> list[tuple[int, int, int, bool]]:
    """Shards of a group of n, with the numbers of its documents there and whether it is whole; takes up their room.

    Of the shards that can hold what is left the one with most votes gets it, the tightest of equal ones; while there is
    none, the roomiest one is filled.
    """
    votes = votes or [0] * len(room)
    out, done = [], 0
    while done < n:
        fits = [s for s in range(len(room)) if room[s] >= n - done]
        s = min(fits, key=lambda s: (-votes[s], room[s], s)) if fits else max(range(len(room)), key=lambda s: (room[s], -s))
        take = min(n - done, room[s])
        room[s] -= take
        out.append((s, done, done + take, take == n))
        done += take
    return out


def _votes(pairs: DataFrame, settled: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """Columns link, votes (how many neighbours of other units a unit has in each shard now, over all its links) and own (its
    documents there); and the cut.

    Two joins: the units' shards with the links, which count their documents per shard, and these counts with the units.
    """
    def per_shard(value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("now") == s, value)), F.lit(0)) for s in range(shards)])

    now = pairs.join(settled, "link", "left").withColumn("now", F.coalesce("settled", "start"))
    hubs = stored(now.groupBy("hub").agg(F.sum("n").alias("all"), per_shard(F.col("n")).alias("here")), "shard-hubs")
    cut = hubs.agg(F.sum(F.col("all") - F.array_max("here"))).first()[0] or 0
    units = now.groupBy("hub", "link").agg(F.sum("n").alias("n"), per_shard(F.col("n")).alias("own")).join(hubs, "hub")
    votes = F.array(*[F.sum((F.get("here", F.lit(s)) - F.get("own", F.lit(s))) * F.col("n")) for s in range(shards)])
    own = F.array(*[F.sum(F.get("own", F.lit(s))) for s in range(shards)])
    return units.groupBy("link").agg(votes.alias("votes"), own.alias("own")), cut


def _propagated(groups: DataFrame, pairs: DataFrame, first: DataFrame, room: list[int], rounds: int | None,
                report: list | None) -> tuple[DataFrame, list]:
    """Columns link and settled (a shard) of the units that are placed whole, and the units no shard can hold; takes up `room`.

    Every round draws a unit to the shard with most of its neighbours that has room for it, of equal ones to that with most of
    its own documents, then by a draw in proportion to the room left. Units come in cells of the seeded order while their shard has room; those refused
    look again in the next round, when neighbours have moved. What the rounds leave is placed by size, as many of
    a size as a shard can hold. `first` has the shards of units placed before.
    """
    shards, turn, settled, waiting, cuts = len(room), 0, [], groups.select("link", "n", "seeded"), []
    while rounds is None or turn < rounds:
        votes, cut = _votes(pairs, _union([first, *settled]), shards)
        cuts.append(cut)
        rooms = F.array(*[F.lit(x) for x in room])
        ids = F.filter(F.array(*[F.lit(s) for s in range(shards)]), lambda s: F.get(rooms, s) >= F.col("n"))
        drawn = lambda s: (F.pmod(F.xxhash64(F.lit(turn), "link", s), F.lit(1 << 30)) + 1) / float(1 << 30)
        best = F.array_max(F.transform(ids, lambda s: F.struct(
            F.get("votes", s).alias("votes"), F.get("own", s).alias("own"), (F.log(drawn(s)) / F.get(rooms, s)).alias("draw"), s.alias("to"))))
        wishes = waiting.join(votes, "link").select("link", "n", "seeded", best["to"].alias("to"),
                                                    F.pmod(F.xxhash64(F.lit(turn), F.lit(1), "link"), F.lit(_CELLS)).cast("int").alias("cell"))
        wishes = stored(wishes, "shard-wishes")
        asked = np.zeros((shards, _CELLS + 1), dtype=np.int64)  # documents that come with so many cells
        for r in wishes.where("to IS NOT NULL").groupBy("to", "cell").agg(F.sum("n").alias("n")).collect():  # shards * cells at most
            asked[r.to, r.cell + 1] = r.n
        asked = asked.cumsum(axis=1)
        limit = [int(np.searchsorted(asked[s], room[s], side="right")) - 1 for s in range(shards)]
        moved = [int(asked[s, limit[s]]) for s in range(shards)]
        comes = F.coalesce(F.col("cell") < F.get(F.array(*[F.lit(x) for x in limit]), F.col("to")), F.lit(False))
        settled.append(wishes.where(comes).select("link", F.col("to").alias("settled")))
        waiting = wishes.where(~comes).select("link", "n", "seeded")
        room[:] = [room[s] - moved[s] for s in range(shards)]
        turn += 1
        if not any(moved) or waiting.isEmpty():
            break
    if report is not None:
        report += [*cuts, _votes(pairs, _union([first, *settled]), shards)[1]]

    sizes = sorted(((r.n, r.k) for r in waiting.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    if not sizes:
        return _union(settled) if settled else first.limit(0), []
    ranges = []  # size, shard, and the numbers of the groups that go there
    for n, k in sizes:
        at = 0
        for s in sorted(range(shards), key=lambda s: (-room[s], s)):
            take = min(k - at, room[s] // n)
            if take:
                ranges.append((n, s, at, at + take))
                room[s] -= take * n
                at += take
    ranked = _numbered(waiting.select("link", F.col("n").alias("each"), "seeded"), ["each"], "seeded", "at", max(k for _, k in sizes), ties=("link",))
    known = _literal(groups, ranges, ["n", "settled", "first", "until"], ["long", "int", "long", "long"])
    inside = (F.col("each") == F.col("n")) & (F.col("first") <= F.col("at")) & (F.col("at") < F.col("until"))
    ranked = ranked.join(F.broadcast(known), inside, "left").select("link", F.col("each").alias("n"), "seeded", "settled")
    ranked = stored(ranked, "shard-by-size")
    # the least of those left exceeds every room, and all documents fit: fewer than shards
    left = sorted(ranked.where("settled IS NULL").select("link", "n", "seeded").collect(), key=lambda g: (-g.n, g.seeded))
    return _union([*settled, ranked.where("settled IS NOT NULL").select("link", "settled")]), left


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _filled(placed: DataFrame, shards: int, total: int) -> DataFrame:
    """Exact quotas: numbers in each shard, linked documents first; what exceeds a quota fills the gaps elsewhere."""
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    held = {(r["shard"], r["last"]): r["n"] for r in placed.groupBy("shard", "last").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(held.values(), default=0)
    ranked = _numbered(placed, ["shard", "last"], "seeded", "at", most)
    linked = F.get(F.array(*[F.lit(held.get((s, 0), 0)) for s in range(shards)]), F.col("shard"))
    quota = F.get(F.array(*[F.lit(q) for q in quotas]), F.col("shard"))
    ranked = ranked.withColumn("slot", F.col("at") + F.when(F.col("last") == 1, linked).otherwise(0)).drop("at")
    ranked = stored(ranked.withColumn("over", F.col("slot") >= quota), "shard-ranked")
    stay = ranked.where("NOT over").select("key", "size", "crc", "shard", "slot")
    gaps, edges = [], [0]  # places still open, as consecutive ranges over all shards
    for s in range(shards):
        n = held.get((s, 0), 0) + held.get((s, 1), 0)
        gaps.append((s, min(n, quotas[s]), edges[-1]))
        edges.append(edges[-1] + max(0, quotas[s] - n))
    over = _numbered(ranked.where("over").drop("slot").withColumn("all", F.lit(0)), ["all"], "seeded", "at", edges[-1])
    place = F.lit(None)
    for s, first, start in reversed(gaps):
        inside = (F.col("at") >= start) & (F.col("at") < edges[s + 1])
        place = F.when(inside, F.struct(F.lit(s).alias("shard"), (F.col("at") - start + first).alias("slot"))).otherwise(place)
    over = over.select("key", "size", "crc", place.alias("place")).select("key", "size", "crc", "place.shard", "place.slot")
    return stay.unionByName(over)
