"""Helpers shared by the text operators: row keys, stored intermediates, bounded fits, Arrow passes."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplens.spark import shared_dir

#: Word bytes of a lower-cased text: ASCII letters and digits and every byte of a non-ASCII character.
WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words: maximal runs of ASCII letters, digits and non-ASCII characters."""
    return utf8(text).translate(WORD_TABLE).split() if text else []


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def named(columns: list[str]) -> list[Column]:
    """Columns by their whole names, whatever signs these hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to a new folder of the shared storage and read it back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``rows`` with ``place``, their position from 0 in the given order (which should leave no ties).

    The rows are dealt out by ranges and sorted inside them; a place is the count of the ranges before plus the
    position inside the range. Only one count for each range goes through a single task.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.select(F.struct(*named(rows.columns)).alias("row"), F.monotonically_increasing_id().alias("at")), tag)
    part, inside = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranged.withColumn("part", part).join(F.broadcast(offsets), "part") \
        .select("row.*", (F.col("before") + inside).alias("place"))


def hashed_share(column: str, share: float) -> Column:
    """True for about ``share`` of the values of a column, chosen by their hash; whole rows, any order of reading."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(1 << 24)) < int(share * (1 << 24)) + 1


def bounded_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows at most, by the key's hash (all rows of a smaller table). Reads only the key to count."""
    n = rows.select(key).count()
    return rows if n <= bound else rows.filter(hashed_share(key, bound / n))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let no Arrow batch of the session hold more rows: whole texts are held several times over on both sides of a
    worker's pipe. Results don't depend on it; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def release() -> None:
    """Give freed memory back, at the end of a task at least: its worker lives on, idle or in the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def fit_in_task(rows: DataFrame, fit: Callable[[list[dict]], object]) -> object:
    """Fit a model on a bounded sample inside one executor task; only the model comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in b.to_pylist()]
        got.sort(key=lambda r: tuple((v is None, v if v is not None else 0) for v in r.values()))
        model = pickle.dumps(fit(got))
        del got
        release()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])
    made = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else fit([])     # an empty partition runs no Python


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label): null ids and labels are dropped, so are documents with contradicting labels."""
    return (labels.select(F.col("doc_id"), F.col(column).cast("int").alias("label")).dropna()
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__high"))
            .filter(F.col("label") == F.col("__high")).drop("__high"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def keep_rows(df: DataFrame, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """Filter rows by their whole text; all columns pass through, whatever they are called."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(texts(b)), pa.bool_()))
        release()
    return df.mapInArrow(run, df.schema)


def distinct_texts(rows: list[dict]) -> list[dict]:
    """Training rows without copies: of rows that share either of two min-hashed word 5-grams only one stays."""
    import zlib
    seen: set[tuple[int, int]] = set()
    kept = []
    for r in rows:
        w = words_of(r["text"])
        grams = [b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
        marks = {(0, min(map(zlib.crc32, grams))), (1, min(map(zlib.adler32, (g[::-1] for g in grams))))}
        if not marks & seen:
            kept.append(r)
        seen |= marks
    return kept


BASE = np.uint64(0x9E3779B97F4A7C15)           # odd: invertible modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = {"up": np.ones(1, "u8"), "down": np.ones(1, "u8")}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, base, "u8")
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: White space of bytes.split.
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of all texts, end of each text's words): polynomials from one prefix sum."""
    data = np.frombuffer(b" " + b" ".join(some) + b" ", "u1")
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, "u8")
    np.cumsum((data.astype("u8") + np.uint64(1)) * up[:-1], out=prefix[1:])
    ends = np.cumsum([len(s) + 1 for s in some]) + 1   # where the next text begins
    return mix((prefix[stops] - prefix[starts]) * down[starts]), np.searchsorted(starts, ends)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights (last one: bias) by Newton's method; a few columns only."""
    x = np.column_stack([x, np.ones(len(x))]).astype("f8")
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def broadcast(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)
