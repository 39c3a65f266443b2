"""Sharding: minimax contiguous partition of ordered atomic groups (DataFrame functions only).

Equal texts form one group. Groups are ordered by the first 60 bits of the MD5 of
their text (texts that share them are one group). A binary search finds the
smallest capacity for which a greedy walk over the ordered groups needs no more
than ``shards`` shards, and the shards are cut there. The law is ``bytes``: with
sizes near equal, the largest shard exceeds the mean by less than one group.

The search reads no list of all groups. It begins with the sizes of ``2**bits``
ranges of the order and two bounds: ranges taken as whole give a capacity that
suffices, ranges that may be cut anywhere one that is needed. Only the ranges in
which a cut can lie for a capacity between the two are then split into 64 each, by
one aggregate over the rows, until the bounds meet at single groups; so the driver
holds a table of a fixed order of size at every scale, and the capacity is exact.

Slots come from two levels of counts: rows are numbered inside (range, salt)
cells and offset by the cells before them; ranges with more than ``cell_rows``
rows get more salts, so a text that holds a third of all rows is numbered by
many tasks.

Defined results: a null text counts as empty (size 1, crc 0) and forms a group
with the empty text; null doc_ids are kept; an empty table gives no rows; shards
may stay empty when there are fewer groups than shards.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate, pairwise, zip_longest

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.llm.common import stored


POSITION_BITS = 60


def walk(ends: list[int], capacity: int, whole: list[bool] | None) -> list[int] | None:
    """Byte offsets at which shards end, filled one after the other; None if a range doesn't fit.

    ``ends`` are the running sums of the ranges' sizes from 0. Ranges that are not ``whole`` (None: all are) may be cut.
    """
    at, cuts = 0, []
    while at < ends[-1]:
        stop = min(at + capacity, ends[-1])
        k = bisect_right(ends, stop) - 1
        if stop > ends[k] and (whole is None or whole[k]):
            stop = ends[k]
        if stop <= at:
            return None
        cuts.append(stop)
        at = stop
    return cuts


def smallest_capacity(ends: list[int], shards: int, whole: list[bool] | None) -> int:
    low = -(-ends[-1] // shards)
    high = low + max(b - a for a, b in pairwise(ends))
    while low < high:
        middle = (low + high) // 2
        cuts = walk(ends, middle, whole)
        if cuts is not None and len(cuts) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def uncertain(sizes: list[int], single: list[bool], shards: int) -> tuple[int, list[int]]:
    """(capacity that suffices, ranges to split): none if no smaller capacity is possible."""
    ends = [0, *accumulate(sizes)]
    large = [k for k, n in enumerate(sizes) if not single[k] and n * shards * 16 > ends[-1]]
    if large:           # at most 16 for each shard
        return 0, large
    high, low = smallest_capacity(ends, shards, None), smallest_capacity(ends, shards, single)
    if low == high:
        return high, []
    # a shard's end lies between those of whole ranges at the lower bound and of divisible ones at the upper bound
    split: set[int] = set()
    for first, last in zip_longest(walk(ends, low, None), walk(ends, high, single), fillvalue=ends[-1]):
        split.update(k for k in range(bisect_right(ends, first) - 1, min(len(sizes), bisect_left(ends, last)))
                     if not single[k])
    return high, sorted(split)


def _sizes(rows: DataFrame, *keys) -> list:
    return rows.groupBy(*keys).agg(F.sum("size").alias("bytes"), F.min("position").alias("low"),
                                   F.max("position").alias("high")).collect()


def capacity_and_starts(rows: DataFrame, shards: int, bits: int, more: int = 6) -> tuple[int, list[int]]:
    """(smallest feasible capacity of single groups, first position of each shard) for rows (position, size)."""
    start = F.shiftright("position", POSITION_BITS - bits)
    # (first position in it, prefix, bits of the prefix, bytes, a single group)
    ranges = sorted((r["low"], r["prefix"], bits, r["bytes"], r["low"] == r["high"])
                    for r in _sizes(rows.withColumn("prefix", start), "prefix"))
    while ranges:
        capacity, split = uncertain([r[3] for r in ranges], [r[4] for r in ranges], shards)
        if not split:
            break
        chosen = ",".join(f"{ranges[k][2]}:{ranges[k][1]}" for k in split)
        depths = sorted({ranges[k][2] for k in split})
        table = rows.sparkSession.range(1).select(F.explode(F.split(F.lit(chosen), ",")).alias("key")).select(
            F.split("key", ":")[0].cast("int").alias("depth"), F.split("key", ":")[1].cast("long").alias("prefix"))
        inside = rows.withColumn("depth", F.explode(F.array(*map(F.lit, depths)))) \
            .withColumn("prefix", F.expr(f"shiftright(position, {POSITION_BITS} - depth)")) \
            .join(F.broadcast(table), ["depth", "prefix"]) \
            .withColumn("deeper", F.least(F.lit(POSITION_BITS), F.col("depth") + more)) \
            .withColumn("part", F.expr(f"shiftright(position, {POSITION_BITS} - deeper)"))
        gone = set(split)
        ranges = sorted([r for k, r in enumerate(ranges) if k not in gone] + [
            (r["low"], r["part"], r["deeper"], r["bytes"], r["low"] == r["high"]) for r in _sizes(inside, "deeper", "part")])
    if not ranges:
        return 0, [0]
    ends = [0, *accumulate(r[3] for r in ranges)]
    cuts = walk(ends, capacity, None)
    return capacity, [0] + [ranges[bisect_left(ends, c)][0] for c in cuts[:-1]]


def shard_by_bytes(documents: DataFrame, shards: int = 16, bits: int = 14, cell_rows: int = 20_000) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(text.cast("binary"))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(digest, 1, POSITION_BITS // 4), 16, 10).cast("long").alias("position"))
    rows = stored(rows, "sharding")
    _, starts = capacity_and_starts(rows.select("position", "size"), shards, bits)
    rows = rows.withColumn("range", F.shiftright("position", POSITION_BITS - bits).cast("int"))
    cells = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    starts = F.array(*[F.lit(s).cast("long") for s in starts])
    shard = (F.size(F.filter(starts, lambda s: s <= F.col("position"))) - 1).alias("shard")

    # salts: a cell per cell_rows rows of a range; the salt is a range of the id's hash, so cells are ordered
    salts = cells.select("range", F.ceil(F.col("n") / cell_rows).cast("int").alias("salts"))
    salted = rows.join(F.broadcast(salts), "range") \
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts").cast("long")).cast("int")) \
        .select("doc_id", "size", "text_crc32", "range", "salt", shard)
    before = Window.partitionBy("shard").orderBy("range", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("shard", "range", "salt").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("shard", "range", "salt").orderBy("doc_id", "text_crc32", "size")
    return salted.withColumn("place", F.row_number().over(within) - 1) \
        .join(offsets, ["shard", "range", "salt"]) \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                (F.col("offset") + F.col("place")).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
