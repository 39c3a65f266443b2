"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity``. Pieces are dealt into
partitions of about ``partition_rows`` rows by a hash; each partition is packed
best-fit decreasing, and dual-feasible functions give a lower bound of the bins
that any packing of its pieces needs. Where the bin count equals the bound the
partition is certified: its bins are final, but for those with room that another
partition could use. Partitions with a gap, and the open bins of all others, give
their pieces back; these are dealt anew and repacked in the next round, as long as
that lowers the number of bins. After that each partition gives back its emptiest bins
alone, one and as many as its gap, so that every round has fewer partitions, down to one.
At most ``rounds`` rounds are made; the gaps that are left stay in the result.

A tokenizer encodes whole texts. White space separates the tokenizer's words, so
each white-space separated string is encoded once per worker and remembered (at
most two generations of ``CACHE_STRINGS`` strings) and new strings are encoded together.

Defined results: a null or empty text is its end id alone; repeated rows are
packed as documents of their own, dealt out by a number of the row and not by the id;
pieces of equal length are placed in the order of (doc_id, piece, row); an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import release, stored, texts, utf8

CACHE_STRINGS = 400_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Text -> little-endian 32-bit ids. Strings between ASCII white space are encoded independently of each other.

    Where the tokenizer reads ASCII capitals as small letters, a run of letters as one word, and a sign behind it by
    itself (all tried out when it is loaded), strings are remembered in small letters, runs of small ASCII letters go to
    its model directly, and a run with one sign is put together from the two. A tokenizer for which white space does not part
    strings is refused.
    """
    SIGNS = b".,;:!?"

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        tried = ["word", "Ab", "x,", "12", "it's", "é", "...", "Q1."]
        for x in tried:
            for y in tried:
                if any(ids(x + blank + y) != ids(x) + ids(y) for blank in (" ", "\n", " \t ")):
                    raise ValueError(f"{file}: white space does not part strings, so whole texts are needed")
        self.small = all(ids(c) == ids(c.lower()) and ids(f"a{c}é") == ids(f"a{c.lower()}é") for c in map(chr, range(65, 91)))
        words = ["word", "a", "é", "ßu", "ñoño", "strasse"]
        self.apart = all(ids(w + chr(c)) == ids(w) + ids(chr(c)) for w in words for c in self.SIGNS)
        self.plain = all(self._of_letters(w) == np.array(ids(w), "<u4").tobytes() for w in words if w.isascii())

    def _of_letters(self, word: str) -> bytes:
        """Ids of a run of small letters, which the tokenizer neither changes nor parts: the model alone."""
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(word)])

    def _learn(self, words: set[bytes]) -> None:
        """Put strings into ``known``: runs of small letters one by one, the others as one text, whose tokens belong to
        the string that their offset lies in."""
        if len(self.known) + len(words) > CACHE_STRINGS:      # strings met again since the last change stay
            self.known, self.older = {}, self.known
        known, older, signs = self.known, self.older, self.SIGNS if self.apart else b""
        mixed, letters, signed = set(), set(), []
        for w in words:
            ids = older.get(w)
            if ids is not None:
                known[w] = ids
                continue
            if len(w) > 1 and w[-1] in signs and _is_letters(w[:-1]):
                signed.append(w)
                if w[-1:] not in known:
                    mixed.add(w[-1:])
                w = w[:-1]
                if w in known:
                    continue
            (letters if self.plain and w.isalpha() and w.islower() else mixed).add(w)
        for w in letters:
            known[w] = older.get(w) or self._of_letters(w.decode())
        if mixed:
            strings = [w.decode("utf-8", "replace") for w in mixed]
            got = self.tokenizer.encode(" ".join(strings), add_special_tokens=False)
            starts = np.array([o[0] for o in got.offsets], "i8")
            cuts = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in strings])).tolist()
            ids = np.array(got.ids, "<u4").tobytes()
            known.update((w, ids[4 * a:4 * z]) for w, a, z in zip(mixed, [0, *cuts], cuts))
        for w in signed:
            known[w] = known[w[:-1]] + known[w[-1:]]

    def encode(self, batch: list[str | None]) -> Iterator[bytes]:
        for lo in range(0, len(batch), 64):
            raw = [utf8(t or "") for t in batch[lo:lo + 64]]
            split = [(t.lower() if self.small else t).split() for t in raw]
            found = [list(map(self.known.get, s)) for s in split]
            # nothing, or no ids at all
            gaps = [list(compress(range(len(s)), map(not_, f))) for s, f in zip(split, found)]
            missing = {s[i] for s, g in zip(split, gaps) for i in g}
            missing = missing.difference(self.known)
            if missing:
                before = self.known
                self._learn(missing)
                get = self.known.get if self.known is before else lambda w, b=before: self.known.get(w, b.get(w))
            else:
                get = self.known.get
            for s, f, g in zip(split, found, gaps):
                for i in g:
                    f[i] = get(s[i])
                yield b"".join(f)


def _is_letters(word: bytes) -> bool:
    """Nothing but letters, also in small letters (some capitals become a letter and a mark)."""
    return word.isalpha() if word.isascii() else word.decode("utf-8", "replace").lower().isalpha()


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """One per worker process."""
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


def pieces(documents: DataFrame, capacity: int, tokenizer: str, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and its end id, cut where longer than capacity."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(public_tokenizers.path(tokenizer))
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(texts(b))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, v in zip(out, (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(out)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
            del b, out
            release()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the fill of each bin; ties keep the order given."""
    n = len(lengths)
    bins, offsets, fill = np.zeros(n, "i8"), np.zeros(n, "i8"), []
    rooms: list[int] = []                       # distinct rooms of open bins, ascending
    open_: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        k = bisect_left(rooms, need)
        if k == len(rooms):
            b = len(fill)
            fill.append(0)
            room = capacity
        else:
            room = rooms[k]
            b = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(k)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += need
        left = room - need
        if left:
            if left not in open_:
                open_[left] = []
                insort(rooms, left)
            open_[left].append(b)
    return bins, offsets, np.array(fill, "i8")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins any packing needs: the best of two families of dual-feasible functions over the length histogram."""
    if not len(lengths):
        return 0
    x, n = np.unique(lengths, return_counts=True)
    best = -(-int((x * n).sum()) // capacity)
    for k in range(1, 21):                      # f(x) = x where (k+1)x/C is whole, else floor((k+1)x/C)/k, in units of 1/(kC)
        whole = (k + 1) * x % capacity == 0
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    for a in x[x * 2 <= capacity]:              # large pieces count as whole bins, those under a not at all
        value = np.where(x > capacity - a, capacity, np.where(x >= a, x, 0))
        best = max(best, -(-int((value * n).sum()) // capacity))
    return best


def _packer(capacity: int, useful_room: int) -> Callable[[pa.Table], pa.Table]:
    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32", "row")])
        lengths = rows.column("length").to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        gap = len(fill) - lower_bound(lengths, capacity)
        room = capacity - fill
        useful = room > 0 if gap > 0 else room >= useful_room
        # of a certified partition less than one bin is lost by rounding up, of others by the gap more
        few = np.zeros(len(fill), bool)
        few[np.argsort(fill, kind="stable")[:gap + 1]] = True
        for name, values in (("bin", bins), ("offset", offsets), ("gap", np.full(len(bins), gap, "i8")),
                             ("wide", useful[bins]), ("narrow", (useful & few)[bins])):
            rows = rows.append_column(name, pa.array(values))
        return rows
    return pack


def pack(documents: DataFrame, capacity: int = 2048, tokenizer: str = "word_bpe_49k.json", end_id: int = 0,
         partition_rows: int = 50_000, rounds: int = 16) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, gap) of every piece of every document.

    ``gap``: by how many bins the piece's partition exceeds its lower bound.
    """
    first = pieces(documents, capacity, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id())
    rest = stored(first, "packing")
    n, out, before, way = rest.count(), None, None, "wide"
    for r in range(rounds):
        parts = 1 + n // partition_rows
        key = F.pmod(F.xxhash64("row", F.lit(r)), F.lit(parts)).alias("part")
        packed = rest.select("doc_id", "piece", "start", "length", "ids_crc32", "row", key).groupBy("part").applyInArrow(
            _packer(capacity, capacity // 64),
            PIECE + ", row long, part long, bin long, offset long, gap long, wide boolean, narrow boolean")
        packed = stored(packed, "packing")
        head = F.col("offset") == 0
        size = packed.agg(F.count_if(head).alias("bins"), *[F.count_if(c).alias(c) for c in ("wide", "narrow")],
                          *[F.count_if(F.col(c) & head).alias(f"{c}_bins") for c in ("wide", "narrow")]).first()
        if before is not None and size["bins"] >= before:       # dealing all bins with room again gains no more
            way = "narrow"
        last = r == rounds - 1 or parts == 1 or not size[way] or (way == "narrow" and size[way] == n)
        done = (packed if last else packed.filter(~F.col(way))).select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.lit(r) * F.lit(1 << 56) + F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"), "offset", "gap")
        out = done if out is None else out.unionByName(done)
        if last:
            break
        rest, n, before = packed.filter(F.col(way)), size[way], size[f"{way}_bins"]
    return out
