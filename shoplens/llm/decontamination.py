"""Benchmark decontamination: Wu-Manber search for the word windows of test items.

A window is ``window`` consecutive words of an item; an item with fewer words
(but not none) is one window. Windows of equal length form one pattern set. The
search holds the document's word under the window's end: a block of the last two
words gives the shift, which skips every position where no pattern can end; a
zero shift opens the bucket of the patterns with that block as suffix, and a
direct comparison of all words confirms the occurrence.

Items are taken in blocks of bounded size (``block_bytes`` of text); each block's
tables are broadcast for one pass over the documents. With more than one block
the word ranges found are merged per document afterwards.

Defined results: null and empty documents have no words and no hits; items
without words never occur; repeated item rows count once per item_id; items with
equal windows are all reported; an empty benchmark hits nothing. Null item_ids
and null item texts take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import broadcast, keep_rows, stored, texts, words_of


@dataclass
class Patterns:
    """One pattern set: all patterns have ``length`` words."""
    length: int
    shift: dict = field(default_factory=dict)
    buckets: dict = field(default_factory=dict)

    @property
    def block(self) -> int:
        return min(2, self.length)

    def add(self, words: tuple[bytes, ...], item: int) -> None:
        b, n = self.block, self.length
        for end in range(b, n + 1):
            key = words[end - b:end]
            self.shift[key] = min(self.shift.get(key, n), n - end)
        for found, items in self.buckets.setdefault(words[n - b:], []):
            if found == words:
                items.add(item)
                return
        self.buckets[words[n - b:]].append((words, {item}))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        """(start, items) of every occurrence."""
        b, n = self.block, self.length
        jump, shift, buckets = n - b + 1, self.shift.get, self.buckets
        end, stop = n, len(words)
        while end <= stop:
            key = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            s = shift(key, jump)
            if s:
                end += s
                continue
            window = tuple(words[end - n:end])
            for pattern, items in buckets[key]:
                if pattern == window:
                    yield end - n, items
            end += 1


def compile_items(items: list[tuple[int, str]], window: int = 10) -> list[Patterns]:
    sets: dict[int, Patterns] = {}
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            sets.setdefault(n, Patterns(n)).add(tuple(w[i:i + n]), item)
    return list(sets.values())


def scan(sets: list[Patterns], text: str | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """(words, merged hit word ranges, items) of a whole text."""
    words = words_of(text)
    spans, items = [], set()
    for p in sets:
        for start, found in p.search(words):
            spans.append((start, start + p.length))
            items |= found
    return len(words), merge(spans), items


def merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items, hashed into as many blocks as keep each near ``block_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // block_bytes
    return [items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<long>, ranges array<struct<begin:long,stop:long>>")


def find(documents: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """Hits of every document: counts, items, their digest and the hit word ranges."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def row(doc_id, n, ranges, items):
        hit = sum(b - a for a, b in ranges)
        return (doc_id, n, hit, len(items), _digest(items), hit > 0, sorted(items), ranges)

    def to_batch(rows):
        cols = list(zip(*rows)) or [[]] * 8
        kinds = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.list_(pa.int64()),
                                    pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))]
        cols[7] = [[{"begin": a, "stop": b} for a, b in r] for r in cols[7]]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "ranges"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    def one_pass(frame, tables):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sets = tables.value
            for b in batches:
                yield to_batch([row(d, *scan(sets, t)) for d, t in zip(b.column(0).to_pylist(), texts(b))])
        return frame.mapInArrow(run, RESULT)

    blocks = item_blocks(benchmark, block_bytes)
    made = [broadcast(spark, compile_items([tuple(r) for r in block.collect()], window)) for block in blocks]
    if len(made) == 1:
        return one_pass(docs, made[0])
    keyed = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "decontamination")
    return _merge_blocks(keyed, made, row)


def _merge_blocks(keyed: DataFrame, made: list, row) -> DataFrame:
    """One pass per block of items, then the union of what the passes found, per document row."""
    def hits(tables):
        def run(batches):
            for b in batches:
                out = [(k, d, *scan(tables.value, t)) for k, d, t in zip(b.column(2).to_pylist(), b.column(0).to_pylist(), texts(b))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.int64()),
                     pa.array([[x for r in o[3] for x in r] for o in out], pa.list_(pa.int64())),
                     pa.array([sorted(o[4]) for o in out], pa.list_(pa.int64()))],
                    ["__row", "doc_id", "n_words", "flat", "items"])
        return keyed.mapInArrow(run, "__row long, doc_id long, n_words long, flat array<long>, items array<long>")

    found = hits(made[0])
    for tables in made[1:]:
        found = found.unionByName(hits(tables))
    found = found.groupBy("__row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                       F.flatten(F.collect_list("flat")).alias("flat"),
                                       F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                f = r["flat"]
                x = row(r["doc_id"], r["n_words"], merge(zip(f[::2], f[1::2])), set(r["items"]))
                rows.append(dict(zip(["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                                      "items", "ranges"], [*x[:7], [{"begin": a, "stop": e} for a, e in x[7]]])))
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
    return found.mapInArrow(finish, RESULT)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                     ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.int64())),
                     ("ranges", pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())])))])


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10,
                        block_bytes: int = 8 << 20) -> DataFrame:
    """The documents without any hit word, with all their columns; one pass per block of items."""
    for block in item_blocks(benchmark, block_bytes):
        tables = broadcast(documents.sparkSession, compile_items([tuple(r) for r in block.collect()], window))
        documents = keep_rows(documents, lambda batch, t=tables: [not any(True for p in t.value for _ in p.search(words_of(x)))
                                                                  for x in batch])
    return documents
