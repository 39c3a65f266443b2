"""Mixing sources to target weights by repetition rates.

Sizes (words) are summed per source, each source gets a target, and a document is
emitted floor(rate) times, rate = target / source size, plus one more copy with
probability rate - floor(rate), decided by a hash of seed, doc_id and text. So a
source's expected size is its target and a rerun takes the same copies.

Targets: the sources, ordered by code point with null last, get the weights in turn
and share ``share`` times the whole size by them; a target above ``cap`` times its
source is stopped there and the excess is shared anew by weight among the others,
until none is above. All sources that are not stopped then have the same target per
weight, the level. Every round of sharing is one aggregate over the table of sources,
so their number is not bounded by a driver or a task.

The table of sources is broadcast when it has at most ``broadcast_sources`` rows and
``broadcast_bytes`` bytes of names; otherwise it is joined, with the sources repeated
over ``salts``, so that a source with a third of all rows is spread.

Defined results: a null text has size 0; an empty string is a source, and null is one;
sources without words have target and rate 0; a null doc_id is hashed as empty, so rows
without id differ by their text; rows equal in id and text share their draw; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import named, numbered, stored

WORD = "[^\\x20\\x09-\\x0D]++"


def _measured(documents: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """(kept, source, size, draw): draw is a hash in [0, 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                    F.md5(text.cast("binary")))
    draw = F.conv(F.substring(F.md5(mark.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return documents.select(F.struct(*named(keep)).alias("kept"), F.col("source").cast("string").alias("source"),
                            F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), draw.alias("draw")) \
        .withColumn("size", F.coalesce("size", F.lit(0).cast("long")))


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target, rate) of a table (source, size) of any length."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    sources = numbered(sources, [F.asc_nulls_last("source")], "mixing_sources").withColumn("weight", turn).drop("place")
    most = cap * F.col("source_size")
    goal = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:     # each round stops more sources than the one before, or is the last
        stopped = most < level * F.col("weight")
        got = sources.agg(F.sum(F.when(stopped, most)).alias("fixed"),
                          F.sum(F.when(~stopped, F.col("weight"))).alias("free")).first()
        following = (goal - (got["fixed"] or 0.0)) / got["free"] if got["free"] else level
        if following <= level:
            break
        level = following
    target = F.least(most, F.lit(level) * F.col("weight"))
    return sources.withColumn("target", target).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def _with_targets(rows: DataFrame, found: DataFrame, broadcast_sources: int, broadcast_bytes: int, salts: int) -> DataFrame:
    # null is a source: it is joined by a flag beside the empty string
    key = [F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none")]
    found = found.select(*key, "source_size", "target", "rate")
    rows = rows.select("kept", "size", "draw", *key)
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("name")), F.lit(0)).alias("bytes")).first()
    if size["n"] <= broadcast_sources and size["bytes"] <= broadcast_bytes:
        return rows.join(F.broadcast(found), ["name", "none"])
    salt = F.pmod(F.xxhash64("draw", "size"), F.lit(salts)).alias("salt")
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return rows.select("*", salt).join(spread, ["name", "none", "salt"])


def repetitions(documents: DataFrame, keep: list[str], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
                cap: float = 2.0, seed: int = 11, broadcast_sources: int = 50_000, broadcast_bytes: int = 4 << 20,
                salts: int = 64) -> DataFrame:
    """(kept struct, size, source_size, target, rate, copies) of every document; ``kept`` holds the columns ``keep``."""
    rows = _measured(documents, keep, seed)
    if "text" not in keep:      # narrow rows are written once, so that texts are read and counted once
        rows = stored(rows, "mixing")
    found = stored(targets(rows.select("source", "size"), weights, share, cap), "mixing_targets")
    whole = F.floor("rate")
    copies = (whole + F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    return _with_targets(rows, found, broadcast_sources, broadcast_bytes, salts).select(
        "kept", "size", "source_size", "target", "rate", copies.alias("copies"))


def mix(documents: DataFrame, **parameters) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with the columns of ``documents``."""
    taken = repetitions(documents, documents.columns, **parameters).filter("copies > 0")
    return taken.select("kept", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("kept.*")
