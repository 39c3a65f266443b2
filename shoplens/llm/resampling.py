"""Importance resampling to a target distribution over hashed n-grams.

Features of a text are its runs of 1 to ``longest`` consecutive words, hashed into
``buckets``. A bucket's gain is 1000 times the logarithm of its smoothed share in the
target over that in the corpus; a document's weight is the sum of its features' gains.
A Gumbel variable from a hash of the doc_id is added, and the highest scores are drawn
without replacement (about proportional to exp(weight / 1000)).

Segment deduplication: a newline is no part of any word, so texts are cut into lines at
newlines. Equal lines are grouped, the features of each distinct line are found once and
stored with the line's number of occurrences; corpus counts are the lines' counts times
their occurrences, and a document's sums are those of its lines. Runs of words that go
over a line's end belong to no line: they are found per document and added separately
(with ``longest`` = 1 there are none).

Documents refer to their lines by 128-bit digests. Lines that make up a ten-thousandth of
all lines or more, at most 10,000 of them, are broadcast; the others are joined, so that a
line found in a third of all documents is no task of its own.

Defined results: null and empty texts have no features, weight 0 and can't be drawn; a
null doc_id is hashed as empty and comes last among ties; repeated rows are rows of their
own with the same score; empty tables give no rows, an empty target flat counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import WORD_TABLE, broadcast, named, numbered, stored, texts, utf8, words_of

#: No more than this many lines can each make up this share of all lines.
HOT_LINES = 10_000
FEATURES = "words long, n long, buckets binary"
CHUNK = 4 << 20


def line_features(lines: list[str], longest: int, buckets: int) -> tuple[list[int], list[int], list[bytes]]:
    """(words, features, bucket numbers as little-endian 32-bit) of each line."""
    words, n, found = [], [], []
    size, at = 0, 0
    for i, t in enumerate(lines):       # some megabytes of words at a time
        size += len(t)
        if size >= CHUNK or i == len(lines) - 1:
            for out, some in zip((words, n, found), _line_features(lines[at:i + 1], longest, buckets)):
                out.extend(some)
            size, at = 0, i + 1
    return words, n, found


def _line_features(lines: list[str], longest: int, buckets: int) -> tuple[list[int], list[int], list[bytes]]:
    split = [words_of(t) for t in lines]
    words = [len(w) for w in split]
    if longest == 1:
        n = words
        grams = [g for w in split for g in w]
    else:
        each = [[b" ".join(w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1)] for w in split]
        n = [len(g) for g in each]
        grams = [x for g in each for x in g]
    found = (np.fromiter(map(zlib.crc32, grams), "u4", len(grams)) % np.uint32(buckets)).astype("<u4").tobytes()
    cuts = np.cumsum([0, *n]) * 4
    return words, n, [found[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def crossing_features(text: str | None, longest: int, buckets: int) -> bytes:
    """Bucket numbers of the runs whose first and last word are on different lines."""
    lines = [x.split() for x in utf8(text or "").split(b"\n")]
    if len(lines) < 2:
        return b""
    lines = [x.translate(WORD_TABLE).split() for x in utf8(text).split(b"\n")]
    words = [w for x in lines for w in x]
    line = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    found = [zlib.crc32(b" ".join(words[i:i + m])) % buckets for m in range(2, longest + 1)
             for i in np.flatnonzero(line[:max(0, len(line) - m + 1)] != line[m - 1:]).tolist()]
    return np.array(found, "<u4").tobytes()


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def distinct_lines(documents: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(line digest, occurrences, words, n, buckets) of every distinct line that holds a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n, found = line_features(texts(b, "line"), longest, buckets)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(found, pa.binary())],
                ["line", "occurrences", "words", "n", "buckets"])

    lines = documents.select(F.explode(_lines("text")).alias("line")).filter(F.col("line") != "")
    lines = lines.groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))
    return lines.select("line", _digest(F.col("line")).alias("digest"), "occurrences") \
        .mapInArrow(run, "line binary, occurrences long, " + FEATURES).filter("n > 0")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def crossing(rows: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(row, n, buckets) of the features over line ends of every (row, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [crossing_features(t, longest, buckets) for t in texts(b)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(found, pa.binary())],
                ["row", "n", "buckets"])
    return rows.select("row", "text").mapInArrow(run, "row long, n long, buckets binary").filter("n > 0")


def counts(features: DataFrame, times: str, buckets: int) -> np.ndarray:
    """Corpus counts of the buckets: each row's features times its occurrences, summed in every task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "i8")
        for b in batches:
            at = np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4")
            of = np.repeat(b.column(2).to_numpy(), b.column(1).to_numpy())
            total += np.bincount(at, of, buckets).astype("i8")      # whole numbers under 2^53
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(total[some])], ["bucket", "n"])
    rows = features.select("buckets", "n", F.expr(times).cast("long").alias("times")).mapInArrow(run, "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()     # at most one row for each bucket
    out = np.zeros(buckets, "i8")
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(s_all + b)) / (float(s + 1) * float(t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], "i8")


def _weights(features: DataFrame, columns: list[str], gain) -> DataFrame:
    """The columns and each row's sum of gains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = gain.value
        for b in batches:
            k = b.num_columns
            n = b.column(k - 2).to_numpy()          # never 0
            each = of[np.frombuffer(b"".join(b.column(k - 1).to_pylist()), "<u4")]
            sums = np.add.reduceat(each, np.cumsum(n) - n) if len(n) else np.zeros(0, "i8")
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(k - 1)), pa.array(sums)], [*columns, "n", "weight"])
    kinds = dict(features.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", n long, weight long"
    return features.select(*columns, "n", "buckets").mapInArrow(run, schema)


def _corpus(documents: DataFrame, longest: int, buckets: int, tag: str) -> tuple[DataFrame, np.ndarray]:
    lines = stored(distinct_lines(documents, longest, buckets), tag)
    return lines, counts(lines, "occurrences", buckets)


def weigh(documents: DataFrame, target: DataFrame, keep: list[str], longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(row, kept, doc_id, words, n_features, weight) of every document; ``kept`` holds the columns ``keep``."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*named(keep)).alias("kept"), F.col("doc_id").cast("long").alias("doc_id"),
        F.transform(F.filter(_lines("text"), lambda x: x != ""), _digest).alias("lines"),
        *([F.col("text")] if longest > 1 else []))
    rows = stored(rows, "resampling")
    lines, source = _corpus(documents, longest, buckets, "resampling_lines")
    _, aim = _corpus(target, longest, buckets, "resampling_target")
    parts = []
    if longest > 1:
        over = stored(crossing(rows, longest, buckets), "resampling_crossing")
        source = source + counts(over, "1", buckets)
        aim = aim + counts(crossing(target.select(F.lit(0).cast("long").alias("row"), "text"), longest, buckets), "1", buckets)
    gain = broadcast(documents.sparkSession, gains(source, aim))
    if longest > 1:
        parts.append(_weights(over, ["row"], gain).select("row", F.lit(0).cast("long").alias("words"), "n", "weight"))
    weights = stored(_weights(lines, ["line", "occurrences", "words"], gain), "resampling_weights")
    all_lines = weights.agg(F.sum("occurrences")).first()[0] or 0
    often = F.col("occurrences") * HOT_LINES >= all_lines
    hot, rest = weights.filter(often).drop("occurrences"), weights.filter(~often).drop("occurrences")
    links = rows.select("row", F.explode("lines").alias("line"))
    parts.append(links.join(F.broadcast(hot), "line").select("row", "words", "n", "weight"))
    parts.append(links.join(F.broadcast(hot.select("line")), "line", "left_anti").join(rest, "line")
                 .select("row", "words", "n", "weight"))
    each = parts[0]
    for p in parts[1:]:
        each = each.unionByName(p)
    sums = each.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("words", "n", "weight")])
    zero = F.lit(0).cast("long")
    return rows.select("row", "kept", "doc_id").join(sums, "row", "left").select(
        "row", "kept", "doc_id", F.coalesce("words", zero).alias("words"), F.coalesce("n", zero).alias("n_features"),
        F.coalesce("weight", zero).alias("weight"))


def resample(documents: DataFrame, target: DataFrame, keep: list[str], percent: int = 10, least_words: int = 20,
             seed: int = 2024, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(kept, doc_id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    mark = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(mark.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    chance = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    weighed = weigh(documents, target, keep, longest, buckets)
    weighed = stored(weighed.withColumn("score", (F.col("weight") + chance).cast("long")), "resampling_scores")
    able = F.col("words") >= least_words
    drawn = percent * weighed.filter(able).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.asc("row")]
    placed = numbered(weighed.filter(able), order, "resampling_places").withColumn(
        "rank", F.when(F.col("place") < drawn, F.col("place") + 1)).drop("place")
    return placed.unionByName(weighed.filter(~able).withColumn("rank", F.lit(None).cast("long"))) \
        .select("kept", "doc_id", "n_features", "weight", "score", "rank")


def draw(documents: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn documents, with all their columns."""
    return resample(documents, target, documents.columns, **parameters).filter(F.col("rank").isNotNull()).select("kept.*")
