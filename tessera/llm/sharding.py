"""Operator 4, sharding by balanced label propagation.

Documents start in hashed shards and move towards the shard where most of the
documents linked with them are. The links are groups (by default equal texts).
Documents of a group that stand in one shard are interchangeable, so they move as
one unit and a round joins units, not documents. Shards exchange units: a round's
moves are counted by pair of shards, and each pair gets a net quota, so that a full
shard takes in what it gives away (plus a slack that shrinks to zero). Last, each
group goes whole to the shard that holds most of it or, where that is full, to one
with room. Documents without links fill the shards up: row counts end at most one
apart, whatever the groups are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, staged

ROUNDS = 5
UNITS = 16           # a unit has at most about 1/UNITS of a shard's rows
LEVELS = 64          # hash levels that break ties between moves of equal gain
BUCKET_ROWS = 50_000
SLACK = 0.1          # of its capacity that a shard may hold above it in the first round; none in the last
BALANCING = 500      # most steps to balanced quotas


def _capacity(n: int, shards: int, shard) -> F.Column:
    """Rows of a shard: as even as n allows."""
    return F.lit(n // shards) + (shard < n % shards).cast("long")


def _quotas(asked: np.ndarray, room: np.ndarray, seed: int) -> np.ndarray:
    """Rows that may move from shard i to shard j: at most ``asked``, and into a shard at most its room and what leaves it.

    Two shards first swap as much as both ask for. Of the rest, a shard asked
    for too much scales its inflow down; that lowers the outflow of others, so it
    is repeated until no shard takes too much. Fractions are rounded by chance (of
    a fixed seed), so that small flows are not lost.
    """
    swapped = np.minimum(asked, asked.T)
    x = (asked - swapped).astype(float)
    for _ in range(BALANCING):
        flow_in, allowed = x.sum(0), np.maximum(room + x.sum(1), 0)
        if (flow_in <= allowed + 0.5).all():
            break
        x *= np.minimum(1, allowed / np.maximum(flow_in, 1e-9))
    return np.minimum(swapped + np.floor(x + np.random.default_rng(seed).random(x.shape)), asked).astype(int)


def propagate(units: DataFrame, n: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``units`` (hub, part, size, shard) after ``rounds`` rounds of moves between the shards.

    A group prefers the shard that holds most of it (ties: by hash). A unit elsewhere
    asks to move there if that lowers the number of cut links. In a shard above its
    limit (capacity and the round's slack) whole groups, chosen by hash, ask to move to
    shards below theirs. ``_quotas`` bounds the moves of each pair of shards; a
    pair takes them in the order of their gain as far as its quota goes. Moves are
    counted by (pair, gain class, hash level). The driver sees one number for each
    shard and each pair of shards. Units of a group with one ``part`` that meet are one from then on.
    """
    spark = units.sparkSession
    capacity = np.array([n // shards + (s < n % shards) for s in range(shards)])
    hashed = lambda *salt: F.pmod(F.xxhash64("hub", *[F.lit(x) for x in salt]), F.lit(1 << 20)) / (1 << 20)
    for k in range(rounds):
        limit = (capacity * (1 + SLACK * (rounds - 1 - k) / rounds)).astype(int)
        load = np.zeros(shards, dtype=int)
        for r in units.groupBy("shard").agg(F.sum("size").alias("load")).collect():        # one row per shard
            load[r["shard"]] = r["load"]
        room = limit - load
        held = units.groupBy("hub", "shard").agg(F.sum("size").alias("here"))
        best = (held.groupBy("hub").agg(F.max(F.struct("here", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("best"),
                                        F.sum("here").alias("members"))
                .select("hub", F.col("best.shard").alias("best"), F.col("best.here").alias("there"), "members"))
        moves = units.join(held, ["hub", "shard"]).join(best, "hub")
        gain = F.col("there") - (F.col("here") - F.col("size"))
        to = F.when((F.col("best") != F.col("shard")) & (gain > 0), F.col("best"))
        free, over = np.maximum(room, 0), np.maximum(-room, 0)
        if over.any() and free.any():
            leaves = F.element_at(F.array(*[F.lit(float(o / max(1, x))) for o, x in zip(over, load)]), F.col("shard") + 1)
            drawn = F.coalesce(*[F.when(hashed(k, 1) < float(e), F.lit(s)) for s, e in enumerate(np.cumsum(free) / free.sum()) if free[s]],
                               F.lit(int(free.argmax())))
            whole = (F.col("members") == F.col("here")) & (F.col("size") == F.col("here"))
            to = F.coalesce(to, F.when(whole & (hashed(k) < leaves), drawn))
        moves = (moves.withColumn("to", to.cast("int")).where("to is not null").withColumn("gain", F.greatest(gain, F.lit(1)))
                 .withColumn("level", F.floor(-F.log2("gain")) * LEVELS + F.pmod(F.xxhash64("hub", "part", F.lit(k)), F.lit(LEVELS)))
                 .select("hub", "part", "shard", "to", "level", "size"))
        moves = staged(moves, "moves")
        asked = np.zeros((shards, shards), dtype=int)
        for r in moves.groupBy("shard", "to").agg(F.sum("size").alias("n")).collect():      # one row per pair of shards
            asked[r["shard"], r["to"]] = r["n"]
        if not asked.any():
            break
        quota = _quotas(asked, room, k)
        quota = spark.createDataFrame([(int(i), int(j), int(quota[i, j])) for i, j in zip(*np.nonzero(quota))],
                                      "shard int, to int, quota long")
        below = Window.partitionBy("shard", "to").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
        limits = (moves.groupBy("shard", "to", "level").agg(F.sum("size").alias("asked"))
                  .withColumn("asked", F.sum("asked").over(below)).join(quota, ["shard", "to"])
                  .where("asked <= quota").groupBy("shard", "to").agg(F.max("level").alias("last")))
        taken = (moves.join(limits, ["shard", "to"]).where(F.col("level") <= F.col("last"))
                 .select("hub", "part", "shard", "to"))
        units = staged(units.join(taken, ["hub", "part", "shard"], "left")
                       .groupBy("hub", "part", F.coalesce("to", "shard").alias("shard")).agg(F.sum("size").alias("size"))
                       .select("hub", "part", "size", "shard"), "units")
    return units


def _numbered(rows: DataFrame, n: int, order: list, by: list[str], size=None) -> DataFrame:
    """``rows`` with ``rank``: the sum of ``size`` (default: 1) before each within ``by``, counted in hash buckets of bounded size."""
    size = F.lit(1) if size is None else size
    buckets = max(1, n // BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = rows.groupBy(*by, "bucket").agg(F.sum(size).alias("n"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select(*by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*by, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("rank", F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .join(offset, [*by, "bucket"]).withColumn("rank", F.col("rank") + F.col("first")).drop("bucket", "first"))


def _put(groups: list[tuple], room: list[int]) -> list[tuple]:
    """(hub, shard, first, last) of ``groups`` (hub, members, shard that holds most), the largest first; ``room`` shrinks.

    A group goes whole to its shard, else to the fullest one with room for it, else
    over the shards with most room. ``first`` and ``last`` bound the members' numbers.
    """
    out = []
    for hub, members, best in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = 0
        while at < members:
            left = members - at
            fits = [s for s, r in enumerate(room) if r >= left]
            to = best if not at and best in fits else min(fits, key=lambda s: room[s]) if fits else max(
                range(len(room)), key=lambda s: room[s])
            k = min(left, room[to])
            out.append((hub, to, at, at + k))
            room[to] -= k
            at += k
    return out


def _ranges(room: list[int]) -> list[tuple[int, int, int]]:
    """(shard, first, last) that number the rooms of all shards one after the other."""
    out, at = [], 0
    for s, r in enumerate(room):
        out.append((s, at, at + r))
        at += r
    return out


def place(units: DataFrame, n: int, shards: int) -> DataFrame:
    """``hub, shard, first, last``: where a group's members of these numbers go; all of a group in one row if it stays whole.

    Groups of more than 1/UNITS of a shard are few (their number is bounded by
    shards and UNITS) and are placed first, on the driver. The others go to
    the shard that holds most of them as far as it has room; the rest
    fill the rooms of all shards in one sequence. The groups that lie
    across the ends of rooms, fewer than there are shards, are placed last.
    """
    spark, schema = units.sparkSession, "hub binary, shard int, first long, last long"
    held = units.groupBy("hub", "shard").agg(F.sum("size").alias("held"))
    best = F.max(F.struct("held", F.xxhash64("hub", "shard").alias("tie"), "shard")).alias("best")
    groups = staged(held.groupBy("hub").agg(F.sum("held").alias("members"), best)
                    .select("hub", "members", F.col("best.shard").alias("shard")), "wholes")
    most = max(1, n // shards // UNITS)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    listed = lambda df: [(bytes(r["hub"]), r["members"], r["shard"]) for r in df.collect()]
    pieces = _put(listed(groups.where(F.col("members") > most)), room)
    small = _numbered(groups.where(F.col("members") <= most), n, ["hub"], ["shard"], F.col("members"))
    limit = F.element_at(F.array(*[F.lit(r).cast("long") for r in room]), F.col("shard") + 1)
    small = staged(small.withColumn("stays", F.col("rank") + F.col("members") <= limit).drop("rank"), "small")

    def take(df):
        for r in df.groupBy("shard").agg(F.sum("members").alias("n")).collect():     # one row per shard
            room[r["shard"]] -= r["n"]
        return df.select("hub", "shard", F.lit(0).cast("long").alias("first"), F.col("members").cast("long").alias("last"))

    stay = take(small.where("stays"))
    rest = _numbered(small.where("not stays").drop("stays").withColumn("all", F.lit(0)), n, ["hub"], ["all"], F.col("members"))
    to = F.coalesce(*[F.when((F.col("rank") >= a) & (F.col("rank") + F.col("members") <= b), F.lit(s))
                      for s, a, b in _ranges(room)])
    rest = staged(rest.select("hub", "members", F.col("shard").alias("held_by"), to.cast("int").alias("shard")), "rest")
    moved = take(rest.where("shard is not null"))
    pieces += _put(listed(rest.where("shard is null").select("hub", "members", F.col("held_by").alias("shard"))), room)
    return staged(stay.unionByName(moved).unionByName(spark.createDataFrame(
        [(bytearray(h), s, a, b) for h, s, a, b in pieces], schema)), "places")


def balanced_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    group_col: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``: the shards' row counts are at most one apart.
    Documents are linked when ``group_col`` is equal (default: the text, a null
    text as empty); a group is kept in one shard where the capacity allows, and
    cut over as few as fit otherwise. ``size`` is the text's UTF-8 bytes (null:
    none) plus 16. ``slot`` numbers a shard's rows from 0. ``grown_shard`` is null
    (it belongs to another law). Rows with equal or null ids keep a row each.
    """
    text = F.coalesce("text", F.lit(""))
    if group_col is None:
        base = documents(docs, id_col, text_col).withColumn("hub", F.unhex(F.md5(text)))
    else:
        base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                           F.unhex(F.md5(F.coalesce(F.col(group_col).cast("string"), F.lit("")))).alias("hub"))
    rows = staged(base.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"), "hub", F.monotonically_increasing_id().alias("row")),
                  "sizes")
    n = rows.count()
    start = F.pmod(F.xxhash64("row", "doc_id"), F.lit(shards)).cast("int")
    hubs = rows.groupBy("hub").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    hubs = staged(hubs, "groups")            # so the join below reads plain exchanges, of which a hot group can be split
    linked = rows.join(hubs, "hub").withColumn("shard", start)
    # a unit: the members of a group that stand in one shard; of a group above the bound, in parts that stay apart
    most = max(1, n // shards // UNITS)
    part = F.when(F.col("members") > most, F.col("shard") + shards * F.pmod(
        F.xxhash64("row", F.lit(1)), F.ceil(F.col("members") / (most * shards)))).otherwise(F.lit(0))
    linked = linked.withColumn("part", part)
    units = staged(linked.groupBy("hub", "part", "shard").agg(F.count(F.lit(1)).alias("size"))
                   .select("hub", "part", "size", "shard"), "units")
    units = propagate(units, n, shards, rounds)
    places = place(units, n, shards)
    cut = places.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hub")      # few: see place()
    whole = places.join(F.broadcast(cut), "hub", "left_anti").select("hub", "shard")
    fits = linked.select("row", "hub").join(staged(whole, "whole"), "hub").select("row", "shard")
    parted = _numbered(linked.select("row", "hub").join(F.broadcast(cut), "hub"), n, ["row"], ["hub"])
    parted = (parted.join(F.broadcast(places.join(F.broadcast(cut), "hub")), "hub")
              .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))).select("row", "shard"))
    fits = staged(fits.unionByName(parted), "placed")
    load = fits.groupBy("shard").agg(F.count(F.lit(1)).alias("load"))
    room = (rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(load, "shard", "left")
            .withColumn("room", _capacity(n, shards, F.col("shard")) - F.coalesce("load", F.lit(0))))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)       # one row per shard
    room = room.withColumn("to_rank", F.sum("room").over(upto)).select("shard", (F.col("to_rank") - F.col("room")).alias("from_rank"), "to_rank")
    edges = [(r["shard"], r["from_rank"], r["to_rank"]) for r in room.collect()]   # one row per shard
    free = rows.join(fits, "row", "left_anti").withColumn("all", F.lit(0))
    free = _numbered(free, n, ["row"], ["all"])
    fill = F.coalesce(*[F.when((F.col("rank") >= a) & (F.col("rank") < b), F.lit(s)) for s, a, b in edges])
    shard = fits.unionByName(free.select("row", fill.cast("int").alias("shard")))
    done = staged(rows.join(shard, "row").select("row", "doc_id", "size", "text_crc32", "shard"), "shards")
    return (_numbered(done, n, ["doc_id", "row"], ["shard"])
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.col("rank").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
