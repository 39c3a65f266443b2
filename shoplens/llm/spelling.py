"""Spelling variants: words that differ by one code point, grouped under their frequent form.

Words are maximal runs of ASCII and Latin-1 letters, A-Z lower-cased. To have known
variants, one code point is deleted from the runs chosen by a hash of (doc_id, run).

Reduced-alphabet generation: every letter is hashed to one of ``symbols`` symbols. Two
words at one edit have reduced words that are equal or at one edit, so each word generates
the full one-edit neighbourhood of its reduced word (and that itself) as 64-bit polynomial
hashes, all words of a length in one array. Hashes that occur among the reduced words of the vocabulary
are joined with it, and the pairs are verified on the original strings by edit distance.
A bitmap of the reduced vocabulary's hashes, of at most ``2 ** bitmap_bits`` bits, is broadcast to drop most
of the hashes that join with nothing before the shuffle; it never drops one that joins.

A word's form is its near word of largest count, if that is at least ``ratio`` times the
word's; counts grow along forms, so following them ends: roots are found by joins that
double the way followed each round.

Defined results: null and empty texts have no words; a null doc_id is hashed as empty;
repeated rows count each; a very long word is generated in blocks of places; an empty
table, or one without words that occur often enough, gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import BASE, INVERSE, broadcast, mix, stored, texts

#: Latin-1 bytes: ASCII letters in lower case, U+00C0 to U+00FF as they are, all else a blank.
LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
#: Hashes made at a time by one task, and by a task in all.
BLOCK, TASK = 1 << 20, 1 << 23
BATCH_BYTES = 16 << 20


def runs_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, one Latin-1 byte for each code point."""
    return text.encode("latin-1", "replace").translate(LETTERS).split() if text else []


def spelled(doc_id, run: bytes, modulus: int) -> bytes:
    """The run, less one code point if ``modulus`` divides the hash of (doc_id, run)."""
    name = "" if doc_id is None else str(doc_id)
    h = zlib.crc32(f"{name}:".encode() + (run if run.isascii() else run.decode("latin-1").encode()))
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(documents: DataFrame, least_length: int, modulus: int, flush: int = 200_000) -> DataFrame:
    """(word, n): occurrences of the words of at least ``least_length`` code points, counted per task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in c], pa.string()), pa.array(list(c.values()), pa.int64())], ["word", "n"])
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b)):
                # shorter runs can't become long enough
                for r, n in Counter([r for r in runs_of(text) if len(r) >= least_length]).items():
                    word = spelled(doc_id, r, modulus)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > flush:
                    yield out(total)
                    total = Counter()
        if total:
            yield out(total)

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def reduced(words: list[bytes], symbols: int) -> np.ndarray:
    """(words x length) symbols, from 1, of words of one length."""
    codes = np.frombuffer(b"".join(words), "u1").reshape(len(words), -1).astype("u8")
    return (mix((codes + np.uint64(1)) * BASE) >> np.uint64(32)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, BASE, "u8")
    p[0] = 1
    return np.multiply.accumulate(p)


def hashes(words: list[bytes], symbols: int) -> np.ndarray:
    """Polynomial hash of each reduced word, mixed."""
    lengths = np.array([len(w) for w in words])
    out = np.zeros(len(words), "u8")
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        out[at] = mix(np.sum(reduced([words[i] for i in at.tolist()], symbols) * _powers(n), axis=1))
    return out


def neighbourhood(s: np.ndarray, symbols: int) -> Iterator[np.ndarray]:
    """Hashes of the one-edit neighbourhoods of reduced words (words x length), in blocks (words x some).

    A word's hash is the sum of its symbols times powers of the base by place; an edit changes one term and moves the
    places behind it, so every neighbour's hash comes from prefix sums.
    """
    count, length = s.shape
    powers, sym = _powers(length + 1), np.arange(1, symbols + 1, dtype="u8")
    prefix = np.zeros((count, length + 1), "u8")
    np.cumsum(s * powers[:length], axis=1, out=prefix[:, 1:])
    whole = prefix[:, length:]
    yield mix(whole)
    step = max(1, BLOCK // (count * symbols))
    for lo in range(0, length, step):           # one symbol deleted, or replaced by each symbol
        hi = min(length, lo + step)
        yield mix(prefix[:, lo:hi] + (whole - prefix[:, lo + 1:hi + 1]) * INVERSE)
        other = (whole - s[:, lo:hi] * powers[lo:hi])[:, :, None] + sym * powers[lo:hi, None]
        yield mix(other.reshape(count, -1))
    for lo in range(0, length + 1, step):       # each symbol inserted before each place and at the end
        hi = min(length + 1, lo + step)
        moved = prefix[:, lo:hi] + (whole - prefix[:, lo:hi]) * BASE
        yield mix((moved[:, :, None] + sym * powers[lo:hi, None]).reshape(count, -1))


def bitmap(vocabulary: DataFrame, bits: int) -> np.ndarray:
    """One bit for each value of the low ``bits`` bits of ``key``: set if the vocabulary has it. At most 2**bits / 8 bytes."""
    inside = min(19, bits)
    low = F.col("key").bitwiseAND((1 << bits) - 1)

    def pack(rows: pa.Table) -> pa.Table:
        marks = np.zeros(1 << inside, bool)
        marks[rows.column("low").to_numpy() & ((1 << inside) - 1)] = True
        return pa.table({"part": pa.array([rows.column("part")[0].as_py()], pa.int64()),
                         "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    parts = vocabulary.select(low.alias("low"), F.shiftright(low, inside).alias("part")).distinct() \
        .groupBy("part").applyInArrow(pack, "part long, bits binary").collect()
    out = np.zeros(1 << (bits - 3), "u1")
    size = 1 << (inside - 3)
    for r in parts:
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["bits"], "u1")
    return out


def generated(vocabulary: DataFrame, symbols: int, bits: int) -> DataFrame:
    """(key, word): the hashes of every word's neighbourhood that the bitmap does not rule out, each once a word."""
    shared = broadcast(vocabulary.sparkSession, bitmap(vocabulary, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, low = shared.value, np.uint64((1 << bits) - 1)
        for b in batches:
            words = [w.encode("latin-1") for w in b.column(0).to_pylist()]
            lengths = np.array([len(w) for w in words])
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                some = max(1, BLOCK // (2 * n * symbols))
                for lo in range(0, len(at), some):
                    rows = at[lo:lo + some]
                    keys, owners = [], []
                    for block in neighbourhood(reduced([words[i] for i in rows.tolist()], symbols), symbols):
                        place = block & low
                        found = np.flatnonzero((marks[place >> np.uint64(3)] >> (place & np.uint64(7)).astype("u1")) & 1)
                        keys.append(block.ravel()[found])
                        owners.append(found // block.shape[1])
                    key, owner = np.concatenate(keys), np.concatenate(owners)
                    order = np.lexsort((key, owner))
                    key, owner = key[order], owner[order]
                    first = np.ones(len(key), bool)
                    first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                    key, owner = key[first].view("i8"), rows[owner[first]]
                    each = max(1, BATCH_BYTES // (2 * n))
                    for i in range(0, len(key), each):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key[i:i + each]), b.column(0).take(pa.array(owner[i:i + each]))], ["key", "word"])

    return vocabulary.select("word").mapInArrow(run, "key long, word string")


def vocabulary(documents: DataFrame, least_length: int, least_count: int, modulus: int, symbols: int) -> DataFrame:
    """(word, n, key): the words that occur often enough, with the hash of their reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = hashes([w.encode("latin-1") for w in b.column(0).to_pylist()], symbols)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(key.view("i8"))], ["word", "n", "key"])
    words = word_counts(documents, least_length, modulus).filter(F.col("n") >= least_count)
    return words.mapInArrow(run, "word string, n long, key long")


def near_words(words: DataFrame, symbols: int = 12, bitmap_bits: int = 28) -> DataFrame:
    """(word, n, near, near_n) of all pairs of words at one edit, both ways round, of a table (word, n, key)."""
    size = words.agg(F.count(F.lit(1)).alias("n"), F.sum((2 * F.length("word") + 1) * symbols).alias("hashes")).first()
    bits = min(bitmap_bits, max(10, (16 * size["n"]).bit_length()))
    spread = words.repartition(1 + (size["hashes"] or 0) // TASK, "key")
    pairs = generated(spread, symbols, bits).join(words.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form) without circles: each round follows twice as many forms."""
    rows = stored(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = rows.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if rows.join(on, "root", "left_semi").isEmpty():
            return rows
        rows = stored(rows.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")


def variants(documents: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10, modulus: int = 31,
             symbols: int = 12, bitmap_bits: int = 28) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    words = stored(vocabulary(documents, least_length, least_count, modulus, symbols), "spelling_words")
    best = near_words(words, symbols, bitmap_bits).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"), (-F.col("best.less")).alias("near_n"))
    found = stored(found, "spelling_forms")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.when(F.col("form").isNotNull(), F.col("near_n")).alias("form_n"))
