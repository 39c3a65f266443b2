"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of word 5-grams (one gram of all words for shorter documents).
Equal sets form a node, so copies are compared once. Nodes whose MinHash values
agree on a band share a bucket. Inside a bucket pairs are compared value by value
in steps; with m of n values equal and a uniform prior, the posterior of J >= t is
a binomial tail, and a pair is dropped as soon as it falls below ``tolerance``.
What is left connects nodes to candidate groups; inside a group all pairs are
verified exactly on their whole gram sets.

No pairs are emitted: a bucket gives back a spanning forest of its surviving
pairs, a group its nodes' link counts and a spanning forest of the verified
links, so rows grow with the documents and not with the square of a group. Large
buckets and groups are cut into chunks, and pairs of chunks are tasks of their
own.

Result per document: ``class_id`` (smallest doc_id of the documents connected by
links), ``copy_id`` (smallest doc_id with the same grams), ``n_links`` (documents
with J >= threshold, copies included) and ``n_linked_sets`` (different sets).

Defined results: null and empty documents have no grams, are in a class of their
own and have no links; rows without doc_id are not compared and have a null
class; repeated rows count as copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import BASE, WORD_TABLE, mix, release, stored, texts, utf8, word_hashes

BANDS, ROWS, STEP = 25, 5, 25
HASHES = BANDS * ROWS


def gram_sets(batch: list[str | None], grams: int = 5, chunk: int = 1 << 20) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit gram hashes of each text, whole texts, in vectorised chunks of texts."""
    some: list[bytes] = []
    size = 0
    for t in batch:
        some.append(utf8(t or "").translate(WORD_TABLE))
        size += len(some[-1]) + 1
        if size >= chunk:
            yield from _gram_sets(some, grams)
            some, size = [], 0
    yield from _gram_sets(some, grams)


def _gram_sets(some: list[bytes], grams: int) -> Iterator[np.ndarray]:
    if not some:
        return
    words, cuts = word_hashes(some)
    n = len(words) - grams + 1
    rolled = np.zeros(max(n, 0), "u8")
    for k in range(grams if n > 0 else 0):
        rolled = rolled * BASE + words[k:k + n]
    rolled = mix(rolled)
    at = 0
    for stop in cuts:
        if stop - at >= grams:
            yield np.unique(rolled[at:stop - grams + 1])
        elif stop > at:
            h = np.zeros(1, "u8")
            for w in words[at:stop]:
                h = h * BASE + w
            yield mix(h + np.uint64(stop - at))
        else:
            yield np.zeros(0, "u8")
        at = stop


_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 31, HASHES, "u4") * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, "u4")


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x HASHES) smallest permuted values; all sets must be non-empty."""
    out = np.empty((len(sets), HASHES), "u4")
    lo = 0
    while lo < len(sets):
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 1 << 16):
            total += len(sets[hi])
            hi += 1
        x = (np.concatenate(sets[lo:hi]) >> np.uint64(32)).astype("u4")
        offsets = np.cumsum([0] + [len(s) for s in sets[lo:hi - 1]])
        for j in range(HASHES):
            y = x * _A[j] + _B[j]
            y ^= y >> np.uint32(15)
            out[lo:hi, j] = np.minimum.reduceat(y * np.uint32(0x2C1B3C6D), offsets)
        lo = hi
    return out


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _text_hash() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("text_hash")


def sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, signature, keys): node and the rest are null for documents without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(gram_sets(texts(b)))
            there = [i for i, s in enumerate(sets) if len(s)]
            node, sig, keys = ([None] * len(sets) for _ in range(3))
            if there:
                m = minhashes([sets[i] for i in there])
                band = np.zeros((len(there), BANDS), "u8") + np.arange(1, BANDS + 1, dtype="u8")
                for r in range(ROWS):
                    band = mix(band * BASE + m[:, r::ROWS].astype("u8"))
                low = (m & np.uint32(0xFFFF)).astype("<u2")
                for k, i in enumerate(there):
                    node[i], sig[i], keys[i] = digest(sets[i]), low[k].tobytes(), band[k].view("i8")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(node, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "node", "signature", "keys"])
        release()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash())
    return docs.mapInArrow(run, "doc_id long, text_hash binary, node binary, signature binary, keys array<long>")


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """After n compared values: the fewest matches whose posterior P(J >= threshold) is not below the tolerance."""
    def posterior(m: int, n: int) -> float:
        return sum(comb(n + 1, k) * threshold ** k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))
    return {n: next(m for m in range(n + 1) if posterior(m, n) >= tolerance) for n in range(STEP, HASHES + 1, STEP)}


def surviving(one: np.ndarray, many: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which rows of ``many`` keep up with ``one`` at every step of the comparison."""
    left = np.arange(len(many))
    matches = np.zeros(len(many), "i4")
    for n in range(STEP, HASHES + 1, STEP):
        matches = matches + (many[left, n - STEP:n] == one[n - STEP:n]).sum(1)
        stay = matches >= least[n]
        left, matches = left[stay], matches[stay]
        if not len(left):
            break
    return left


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal keys of a partition that is sorted by it; one run is held at a time."""
    held: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        k = t.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]
        if held and held[-1].column(key)[0].as_py() != k[0]:
            yield pa.concat_tables(held)
            held = []
        for a, z in zip(cuts[:-2], cuts[1:-1]):
            yield pa.concat_tables([*held, t.slice(a, z - a)])
            held = []
        held.append(t.slice(cuts[-2]))
    if held:
        yield pa.concat_tables(held)


def chunked(rows: DataFrame, count: str, chunk: int, key: str, keys: list[str]) -> DataFrame:
    """Adds ``__chunk`` and the group key ``__tile``: rows of a large key go to every pair of chunks with theirs."""
    n = F.ceil(F.col(count) / chunk).cast("int")
    rows = rows.withColumn("__n", n).withColumn("__chunk", F.pmod(F.xxhash64(key), F.col("__n").cast("long")).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return rows.withColumn("__tile", F.xxhash64(*keys, F.least("__chunk", "__other"), F.greatest("__chunk", "__other"))) \
        .withColumn("__within", F.col("__chunk") == F.col("__other")).drop("__n", "__other")


def _bucket_forest(least):
    def run(batches):
        for t in grouped(batches, "__tile"):
            nodes = t.column("node").to_pylist()
            if len(nodes) < 2:
                continue
            order = sorted(range(len(nodes)), key=nodes.__getitem__)
            sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u2").reshape(-1, HASHES)
            child, root = [], []
            todo = np.array(order)
            while len(todo) > 1:                     # breadth first; who is reached leaves the open set at once
                start, todo = int(todo[0]), todo[1:]
                queue = [start]
                while queue and len(todo):
                    hit = surviving(sig[queue.pop()], sig[todo], least)
                    if len(hit):
                        reached = todo[hit].tolist()
                        queue += reached
                        child += [nodes[i] for i in reached]
                        root += [nodes[start]] * len(reached)
                        todo = np.delete(todo, hit)
            if child:
                yield pa.RecordBatch.from_arrays([pa.array(child, pa.binary()), pa.array(root, pa.binary())], ["u", "v"])
        release()
    return run


def components(edges: DataFrame, rounds: int = 30) -> DataFrame:
    """(node, root): connected components by alternating large and small stars; linear rows in every round.

    Raises if the edges still change in the last round, so that no class comes back split.
    """
    edges = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "join_edges")
    mark = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                       "join_edges")
        new = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark or not new[0]:
            break
        mark = new
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _group_links(threshold: float):
    def jaccard_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Boolean matrix over left x right, exact, from shared grams in blocks of columns."""
        size = np.array([len(s) for s in sets])
        if len(left) * len(right) <= 16:
            both = np.array([[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in right] for a in left])
        else:
            both = np.zeros((len(left), len(right)), "f4")
            flat = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), size)
            uniq, column, times = np.unique(flat, return_inverse=True, return_counts=True)
            number = np.cumsum(times > 1) - 1          # grams of one document only can't be shared
            shared = times[column] > 1
            owner, column = owner[shared], number[column[shared]]
            order = np.argsort(column, kind="stable")
            owner, column = owner[order], column[order]
            width = 4096
            total = int(number[-1]) + 1 if len(number) else 0
            at = np.searchsorted(column, np.arange(0, total + width, width))
            for k in range(len(at) - 1):
                block = np.zeros((len(sets), width), "f4")
                block[owner[at[k]:at[k + 1]], column[at[k]:at[k + 1]] - k * width] = 1
                both += block[left] @ block[right].T
        union = size[left][:, None] + size[right][None, :] - both
        return both >= threshold * union - 1e-6

    def run(batches):
        for t in grouped(batches, "__tile"):
            first: dict[bytes, int] = {}
            nodes = t.column("node").to_pylist()
            for i, node in enumerate(nodes):
                first.setdefault(node, i)
            t = t.take(list(first.values()))
            nodes = list(first)
            if len(nodes) < 2:
                continue
            chunk, weight = t.column("__chunk").to_numpy(), t.column("size").to_numpy()
            sets = [np.frombuffer(x, "u8") for x in t.column("grams").to_pylist()]
            every = np.arange(len(nodes))
            if len(np.unique(chunk)) == 1:
                if not t.column("__within")[0].as_py():
                    continue
                left = right = every
            else:
                left, right = every[chunk == chunk.min()], every[chunk != chunk.min()]
            links = jaccard_links(sets, left, right)
            near = np.zeros((len(nodes), len(nodes)), bool)
            near[np.ix_(left, right)] |= links
            near[np.ix_(right, left)] |= links.T
            np.fill_diagonal(near, False)
            root = np.full(len(nodes), -1)
            for s in every:
                if root[s] < 0 and near[s].any():
                    front = np.array([s])
                    root[s] = s
                    while len(front):
                        reach = near[front].any(0) & (root < 0)
                        root[reach] = s
                        front = np.flatnonzero(reach)
            some = np.flatnonzero(root >= 0)
            if len(some):
                linked = near[some].astype("i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[i] for i in some], pa.binary()), pa.array([nodes[root[i]] for i in some], pa.binary()),
                     pa.array(linked @ weight), pa.array(linked.sum(1))], ["node", "root", "links", "sets"])
        release()
    return run


def join(documents: DataFrame, threshold: float = 0.8, tolerance: float = 1e-4, chunk: int = 1024,
         broadcast_rows: int = 500_000) -> DataFrame:
    """(doc_id, class_id, copy_id, n_links, n_linked_sets) for every document."""
    return _classes(documents, threshold, tolerance, chunk, broadcast_rows).drop("text_hash", "root")


def _classes(documents: DataFrame, threshold: float, tolerance: float = 1e-4, chunk: int = 1024,
             broadcast_rows: int = 500_000) -> DataFrame:
    """The columns of ``join``, the hash of the row's text and the node that stands for its class (null: alone)."""
    rows = stored(sketches(documents), "join_sketch")
    nodes = rows.filter("doc_id is not null and node is not null").groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("size"),
        F.first("signature").alias("signature"), F.first("keys").alias("keys"))
    nodes = stored(nodes, "join_nodes")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    full = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = chunked(keyed.join(full, "key").join(nodes.select("node", "signature"), "node"), "n", 4 * chunk, "node", ["key"])
    members = members.select("__tile", "node", "signature").repartition("__tile").sortWithinPartitions("__tile")
    forest = members.mapInArrow(_bucket_forest(least_matches(threshold, tolerance)), "u binary, v binary")
    groups = stored(components(forest), "join_groups")

    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = groups.join(sizes, "root").join(nodes.select("node", "copy_id", "size"), "node")
    wanted = stored(wanted.select(F.col("copy_id").alias("doc_id"), "node", "root", "n", "size"), "join_wanted")
    # fixed-width rows of at most 72 bytes, so the count is a bound of the broadcast size
    small = wanted if wanted.count() > broadcast_rows else F.broadcast(wanted)
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small, "doc_id")

    def with_grams(batches):
        for b in batches:
            sets = list(gram_sets(texts(b)))
            same = pa.array([digest(s) == n for s, n in zip(sets, b.column(b.schema.get_field_index("node")).to_pylist())], pa.bool_())
            kept = b.select(["node", "root", "n", "size"]).append_column("grams", pa.array([s.tobytes() for s in sets], pa.binary()))
            yield kept.filter(same)
        release()

    found = found.select("text", "node", "root", "n", "size").mapInArrow(
        with_grams, "node binary, root binary, n long, size long, grams binary")
    tiles = chunked(found, "n", chunk, "node", ["root"]).select("__tile", "__chunk", "__within", "node", "size", "grams")
    links = stored(tiles.repartition("__tile").sortWithinPartitions("__tile").mapInArrow(
        _group_links(threshold), "node binary, root binary, links long, sets long"), "join_links")

    classes = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"), F.sum("sets").alias("sets"))
    info = nodes.select("node", "copy_id", "size").join(classes, "node", "left").join(counted, "node", "left") \
        .filter("size > 1 or root is not null")
    info = stored(info.withColumn("root", F.coalesce("root", "node")), "join_info")
    names = info.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    info = info.join(names, "root").select(
        "node", "root", "class_id", "copy_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("sets", F.lit(0)).alias("n_linked_sets"))
    named = F.col("doc_id").isNotNull()
    return rows.select("doc_id", "text_hash", "node").join(info, "node", "left").select(
        "doc_id", "text_hash", "root", F.when(named, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(named, F.coalesce("copy_id", "doc_id")).alias("copy_id"),
        F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(named, F.coalesce("n_linked_sets", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_linked_sets"))


def keep_one(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One document of each class stays (the one with the smallest doc_id; one row of repeated rows).

    Rows are told apart by doc_id and text: of a class's texts under that doc_id the one with the smallest hash stays.
    Rows without doc_id can't be told apart and all stay.
    """
    columns = documents.columns
    kept = _classes(documents, threshold).filter("class_id = doc_id").groupBy(
        F.col("doc_id").alias("__kept"), F.coalesce("root", "text_hash")).agg(F.min("text_hash").alias("__of"))
    named = documents.filter("doc_id is not null").withColumn("__hash", _text_hash())
    one = named.join(kept, (F.col("doc_id") == F.col("__kept")) & F.col("__hash").eqNullSafe(F.col("__of")), "left_semi") \
        .dropDuplicates(["doc_id", "__hash"]).drop("__hash")
    return one.unionByName(documents.filter("doc_id is null")).select(*columns)
