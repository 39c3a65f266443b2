"""Scores of whole documents under a gated recurrent language model.

Tokens are white-space separated words (A-Z lower-cased) and one end per text.
The output softmax is factored by classes: P(token | past) = P(class | state)
P(token | class, state). The most frequent words, as many as are broadcast with
their counts, are spread over about sqrt(V) classes by frequency, with fewer words
in the classes of frequent ones; each has an input vector of its own, and inside its
class its probability depends on the state as well. Classes lie in about
sqrt(classes) groups, and P(class | state) is P(group | state) P(class | group, state).
The rare words beyond them belong to one of ``tail_classes`` classes by a hash of
their last bytes; inside a tail class a word has its corpus probability (count + 1) /
(N_class + V_class + 1), with one part left for unseen words. The end of a text
is a class of its own.

Corpus statistics (counts, N, V, class totals) come from all training documents.
The recurrent model is trained by truncated backpropagation in numpy: first in one
task on a bounded sample (``warm_rows``), then in shards of a fixed size on every
training document, and the shards' models are averaged, every row of a weight by the
tokens that have used it, so that training grows with the corpus. For scoring, documents run through the
network in slots of a batch; a slot's state is carried from window to window
until its document ends, so the log-likelihood is that of the complete text.

Counts of at most ``cached_words`` frequent words are broadcast (a fixed bound, and
with it that of the network's words); the rest of a text's words are joined with the counts.

Defined results: null and empty texts are their end alone; repeated rows are
scored each; without any training document all words are unseen; rows without
doc_id are scored but not learned from.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import bounded_sample, broadcast, release, remainder, stored, utf8


def tokens(text: str | None) -> list[bytes]:
    """Words of a text; bytes.lower and bytes.split touch ASCII only."""
    return utf8(text).lower().split() if text else []


def word_lists(column: pa.Array, chunk: int = 1 << 20) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The same of a column of texts, about ``chunk`` bytes at a time: (words of some texts, where each text's begin and end)."""
    column = pc.fill_null(column, "")
    size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype="i8")
    cuts = [0, *(np.flatnonzero(np.diff(size // chunk)) + 1).tolist(), len(column)]
    for lo, hi in zip(cuts, cuts[1:]):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(column.slice(lo, hi - lo)))
        words, ends = lists.values.cast(pa.binary()), lists.offsets.to_numpy()
        full = pc.not_equal(pc.binary_length(words), 0)         # white space around a text leaves empty ones
        yield words.filter(full), np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[ends]


@dataclass(frozen=True)
class Shape:
    hidden: int = 24
    head_classes: int = 316
    head_words: int = 100_000
    tail_classes: int = 39
    window: int = 48
    slots: int = 512
    train_window: int = 32
    train_slots: int = 256      # of the warm start
    corpus_slots: int = 1024


@dataclass
class Vocabulary:
    """Symbols are head words, then tail classes, then the end; the state reads and the class softmax predicts them."""
    shape: Shape
    head: dict[bytes, int]

    def __post_init__(self):
        s = self.shape
        # class k begins at about (k / head_classes)^2 of the words, the most frequent first
        k = np.arange(s.head_classes + 1)
        cuts = np.round(s.head_words * (k / max(1, s.head_classes)) ** 2).astype("i8")
        self.bounds = np.maximum(cuts, np.minimum(k, s.head_words))
        self.end = s.head_words + s.tail_classes
        self.symbols = self.end + 1
        self.classes = s.head_classes + s.tail_classes + 1
        ids = np.arange(self.symbols)
        self.class_table = np.where(ids < s.head_words, np.searchsorted(self.bounds, ids, "right") - 1,
                                    ids - s.head_words + s.head_classes).astype("i2")
        # about sqrt(classes) groups of neighbouring classes
        self.groups = np.unique(np.linspace(0, self.classes, math.ceil(math.sqrt(self.classes)) + 1).round().astype("i8"))
        self.group_table = (np.searchsorted(self.groups, np.arange(self.classes), "right") - 1).astype("i2")

    def tail(self, word: bytes) -> int:
        return zlib.crc32(word[-4:]) % self.shape.tail_classes

    def tails(self, words: pa.Array) -> np.ndarray:
        """``tail`` of each word."""
        ends = pc.binary_slice(words, -4).dictionary_encode()
        return np.array([self.tail(w) for w in ends.dictionary.to_pylist()], "i4")[ends.indices.to_numpy()]

    def symbol(self, word: bytes) -> int:
        k = self.head.get(word)
        return self.shape.head_words + self.tail(word) if k is None else k

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return self.class_table[symbols]


class Network:
    """One gated recurrent layer: update and reset gates z, r and candidate n; h' = n + z (h - n).

    The softmax has three levels, each exact and of the state: group of classes, class in its group, word in its class.
    Their tables hold the bias as a last column.
    """
    TABLES = ("inputs", "word_w")      # a row for a word: a step changes some of the rows
    NAMES = ("inputs", "recur", "group_w", "class_w", "word_w", "start")

    def __init__(self, vocab: Vocabulary, seed: int = 5):
        s, rng = vocab.shape, np.random.default_rng(seed)
        self.vocab = vocab

        def table(rows: int) -> np.ndarray:
            w = rng.standard_normal((rows, s.hidden + 1), "f4")
            w *= np.float32(0.1)
            w[:, -1] = 0
            return w
        self.inputs = rng.standard_normal((vocab.symbols, 3 * s.hidden), "f4")
        self.inputs *= np.float32(0.1)
        self.recur = rng.normal(0, 1 / math.sqrt(s.hidden), (s.hidden, 3 * s.hidden)).astype("f4")
        self.group_w, self.class_w, self.word_w = table(len(vocab.groups) - 1), table(vocab.classes), table(s.head_words)
        self.start = np.zeros(s.hidden, "f4")

    @classmethod
    def of(cls, vocab: Vocabulary, weights) -> "Network":
        """A network of given weights, none drawn."""
        net = cls.__new__(cls)
        net.vocab = vocab
        return net.set_weights(weights)

    def weights(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def set_weights(self, weights) -> "Network":
        for n, w in zip(self.NAMES, weights):
            setattr(self, n, w)
        return self

    def states(self, h: np.ndarray, symbols: np.ndarray, lengths: np.ndarray | None = None, keep: bool = False):
        """State before each step of a window (steps x slots), the state after it and what backpropagation needs.

        ``lengths`` (falling) are the slots' steps, all if not given; a slot keeps its state after its last one.
        """
        n = h.shape[1]
        before = np.empty((len(symbols), *h.shape), "f4")
        saved, h = [], h.copy()
        # a plane for each of z, r and n, so that all but the sum of both parts runs over whole arrays
        recur, inputs = self.recur.reshape(n, 3, n).transpose(1, 0, 2), self.inputs.reshape(-1, 3, n)
        for t, m in enumerate(active(lengths, *symbols.shape)):
            before[t] = h
            x, p = inputs[symbols[t, :m]].transpose(1, 0, 2), h[:m]
            g = p @ recur
            zr, c = g[:2], g[2]
            zr += x[:2]
            np.negative(zr, zr)
            np.exp(zr, zr)
            zr += 1
            np.reciprocal(zr, zr)
            if keep:
                saved.append((zr, c, c := zr[1] * c))
            else:
                c *= zr[1]
            c += x[2]
            np.tanh(c, c)
            p -= c
            p *= zr[0]
            p += c
        return before, h, saved

    def softmaxes(self, goal: np.ndarray):
        """Softmaxes over rows lo to hi of a table, for tokens a to b of ``goal`` (sorted by class): what each should give."""
        v = self.vocab
        classes = v.class_of(goal)
        groups = v.group_table[classes]
        yield "group_w", 0, len(v.groups) - 1, 0, len(goal), groups
        cuts = np.searchsorted(groups, np.arange(len(v.groups)))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b, lo = int(cuts[k]), int(cuts[k + 1]), int(v.groups[k])
            yield "class_w", lo, int(v.groups[k + 1]), a, b, classes[a:b] - lo
        cuts = np.searchsorted(classes, np.arange(v.shape.head_classes + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b, lo, hi = int(cuts[k]), int(cuts[k + 1]), int(v.bounds[k]), int(v.bounds[k + 1])
            if hi - lo > 1:
                yield "word_w", lo, hi, a, b, goal[a:b] - lo

    def by_class(self, states: np.ndarray, symbols: np.ndarray, at: np.ndarray | None = None):
        """(order, states with a one for the bias, symbols), sorted by class; ``at`` has the symbols' rows of states."""
        order = np.argsort(self.vocab.class_of(symbols), kind="stable")
        sorted_states = np.ones((len(order), states.shape[1] + 1), "f4")
        np.take(states, order if at is None else at[order], axis=0, out=sorted_states[:, :-1], mode="clip")
        return order, sorted_states, symbols[order]

    def predict(self, states: np.ndarray, symbols: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Natural log of P(class) and, for head words, of P(word | class) as well; ``at`` as in ``by_class``."""
        out = np.zeros(len(symbols))
        order, states, goal = self.by_class(np.asarray(states, "f4"), symbols, at)
        got, ones, row = np.zeros(len(order)), np.ones(len(self.vocab.class_table) + 1, "f4"), np.arange(len(order))
        for name, lo, hi, a, b, want in self.softmaxes(goal):
            z = states[a:b] @ getattr(self, name)[lo:hi].T
            got[a:b] += z[row[:b - a], want]
            np.exp(z, z)
            got[a:b] -= np.log(z @ ones[:hi - lo])
        out[order] = got
        return out

    def gradients(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray):
        """Gradients of the mean loss over a window; the state that enters it is a constant (truncation)."""
        grads, rows, last = self.row_gradients(h, inputs, targets, real)
        for name in self.TABLES:
            grads[name] = np.zeros_like(getattr(self, name))
        for name, some, g, _ in rows:
            grads[name][some] = g
        return grads, last

    def row_gradients(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray,
                      sums: np.ndarray | None = None):
        """The same, of the tables only the rows that are not zero: (name, rows, gradients, tokens that used them).

        ``real`` marks the first steps of each slot. Tokens are held step by step, the longest slots first. Gradients of
        word_w are written to ``sums``, if given; classes that follow each other come as one run of rows.
        """
        n, lengths = self.vocab.shape.hidden, real.sum(0)
        slots = np.argsort(-lengths, kind="stable")
        lengths, real, inputs, targets = lengths[slots], real[:, slots], inputs[:, slots], targets[:, slots]
        before, last, saved = self.states(h[slots], inputs, lengths, keep=True)
        used = np.flatnonzero(real)
        after = np.concatenate([before[1:], last[None]]).astype("f4", copy=False)
        order, states, goal = self.by_class(after.reshape(-1, n), targets[real], used)
        count, row = len(order), np.arange(len(order))
        weight, ones = np.float32(1 / max(1, count)), np.ones(len(self.vocab.class_table) + 1, "f4")
        grads = {"group_w": None, "class_w": np.zeros_like(self.class_w), "start": np.zeros_like(self.start)}
        runs, times = [], []
        sums = np.empty_like(self.word_w) if sums is None else sums
        push = np.empty((count, n), "f4")
        for name, lo, hi, a, b, want in self.softmaxes(goal):
            w, state = getattr(self, name)[lo:hi], states[a:b]
            z = state @ w.T
            np.exp(z, z)
            z *= (weight / (z @ ones[:hi - lo]))[:, None]
            z[row[:b - a], want] -= weight
            if name == "word_w":
                np.matmul(z.T, state, out=sums[lo:hi])
                if not runs or runs[-1][1] != lo:
                    runs.append([lo, hi])
                    times.append([])
                runs[-1][1] = hi
                times[-1].append((hi - lo, b - a))
            elif name == "class_w":
                grads[name][lo:hi] = z.T @ state
            else:
                grads[name] = z.T @ state
            if name == "group_w":
                np.matmul(z, w[:, :-1], out=push[a:b])
            else:
                push[a:b] += z @ w[:, :-1]
        table_rows = [("word_w", slice(lo, hi), sums[lo:hi], np.repeat(*reversed(np.array(of).T)))
                      for (lo, hi), of in zip(runs, times)]
        back = np.empty_like(push)
        back[order] = push
        carry = np.zeros(h.shape, "f4")
        # columns: what n passes to the state before it, then z, r and n themselves; both triples are read as they lie
        gates, turned = np.empty((count, 4 * n), "f4"), np.roll(self.recur, n, axis=1)
        at = count
        for t, m in reversed(list(enumerate(active(lengths, *inputs.shape)))):
            (z, r), g, c = saved[t]
            at -= m
            d, gate = back[at:at + m], gates[at:at + m]
            d += carry[:m]
            keep, leave = d * z, 1 - z
            dc = 1 - c * c
            dc *= d
            dc *= leave
            leave *= keep
            np.multiply(dc, r, out=gate[:, :n])
            np.multiply(before[t, :m] - c, leave, out=gate[:, n:2 * n])
            gate[:, 3 * n:] = dc
            dc *= g
            dc *= r - r * r
            gate[:, 2 * n:3 * n] = dc
            keep += gate[:, :3 * n] @ turned.T
            carry[:m] = keep
        grads["recur"] = np.roll(before.reshape(-1, n)[used].T @ gates[:, :3 * n], -n, axis=1)
        table_rows.append(("inputs", *row_sums(inputs[real], gates[:, n:])))
        left = np.empty_like(last)
        left[slots] = last
        return grads, table_rows, left


def active(lengths: np.ndarray | None, steps: int, slots: int) -> list[int]:
    """Slots of each step, if slots have falling lengths."""
    return [slots] * steps if lengths is None else np.searchsorted(-lengths, -np.arange(steps), "left").tolist()


def row_sums(ids: np.ndarray, values: np.ndarray, few: int = 16):
    """(distinct ids, sums of their rows, number of rows): whole passes for the first rows of all ids, then the longer ones."""
    order = np.argsort(ids)
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, "i8")
    times = np.diff(np.append(first, len(ids)))
    by = np.argsort(-times, kind="stable")
    first, times = first[by], times[by]
    sums = values[order[first]]
    for j in range(1, few + 1):
        m = int(np.searchsorted(-times, -j, "left"))
        if j < few:
            sums[:m] += values[order[first[:m] + j]]
    for i in range(m):
        sums[i] += values[order[first[i] + few:first[i] + times[i]]].sum(0)
    return ids[first], sums, times


def streams(symbol_lists: Iterator[np.ndarray], vocab: Vocabulary, slots: int, window: int):
    """Windows of a batch: (fresh slots, inputs, targets, real, documents). A slot holds one document until its end.

    When documents run out and few slots are left, windows are up to eight times as long (no more tokens than others).
    """
    short = window
    held: list = [None] * slots
    more = True
    while True:
        fresh = np.zeros(slots, bool)
        for i in range(slots):
            if held[i] is None and more:
                nxt = next(symbol_lists, None)
                if nxt is None:
                    more = False
                else:
                    held[i], fresh[i] = [nxt[0], nxt[1], 0], True
        live = [i for i in range(slots) if held[i] is not None]
        if not live:
            return
        window = min(8 * short, short * slots // len(live)) if not more else short
        window = min(window, max(short, max(len(held[i][1]) - held[i][2] for i in live)))
        inputs = np.full((window, slots), vocab.end)
        targets = np.full((window, slots), vocab.end)
        real = np.zeros((window, slots), bool)
        who = [None] * slots
        for i in live:
            name, ids, at = held[i]
            part = ids[at:at + window]
            targets[:len(part), i] = part
            inputs[1:len(part), i] = part[:-1]
            inputs[0, i] = ids[at - 1] if at else vocab.end
            real[:len(part), i] = True
            who[i] = name
            held[i] = [name, ids, at + window] if at + window < len(ids) else None
        yield fresh, inputs, targets, real, who


#: Step size of the tables' rows as a multiple of the rate.
TABLE_RATE = 6.0


def train_network(network: Network, documents: Iterator[np.ndarray], rate: float, slots: int | None = None):
    """Adam over the windows of a stream of documents; the state runs on from window to window.

    Rows of the tables have a step size each (Adagrad; the bias one of its own), so that a step touches only the rows it
    has used. Returns the tokens seen, and for every row of every weight those that used it.
    """
    shape, v = network.vocab.shape, network.vocab
    slots = slots or shape.train_slots
    moments = {n: [np.zeros_like(getattr(network, n)), np.zeros_like(getattr(network, n))]
               for n in network.NAMES if n not in network.TABLES}
    uses = {n: np.zeros(len(getattr(network, n))) for n in network.NAMES}
    # column by column: its passes run over many rows at once, not over one short row after the other
    network.word_w = np.asfortranarray(network.word_w)
    sums = np.empty_like(network.word_w)
    squares = {n: np.zeros((len(getattr(network, n)), 2), "f4", "F") for n in network.TABLES}
    width = {"inputs": 3 * shape.hidden, "word_w": shape.hidden}        # columns but for the bias
    h = np.zeros((slots, shape.hidden), "f4")
    seen, step = 0, 0
    for fresh, inputs, targets, real, _ in streams(((None, d) for d in documents), v, slots, shape.train_window):
        h[fresh] = network.start
        live = np.flatnonzero(real.any(0))      # the last documents of a stream leave slots empty
        grads, rows, h[live] = network.row_gradients(h[live], inputs[:, live], targets[:, live], real[:, live], sums)
        step += 1
        seen += int(real.sum())
        parts = []
        for name, _, g, _ in rows:
            n = width[name]
            own = np.zeros((len(g), 2), "f4", "F")
            np.einsum("ij,ij->i", g[:, :n], g[:, :n], out=own[:, 0])
            if g.shape[1] > n:
                np.square(g[:, n], own[:, 1])
            parts.append(own)
        norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()) + sum(float(own.sum()) for own in parts))
        clip = min(1.0, 1.0 / (norm + 1e-9))
        lr = rate / math.sqrt(1 + step / 150)
        for name, g in grads.items():
            m, s = moments[name]
            g *= clip
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w = getattr(network, name)
            w -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
        for (name, some, g, times), own in zip(rows, parts):
            n = width[name]
            uses[name][some] += times
            own[:, 0] /= n
            own *= clip * clip
            own += squares[name][some]
            squares[name][some] = own
            by = (clip * TABLE_RATE * rate) / (np.sqrt(own) + np.float32(1e-8))
            g[:, :n] *= by[:, :1]
            g[:, n:] *= by[:, 1:]
            getattr(network, name)[some] -= g
    for name in moments:
        uses[name] += seen
    return seen, uses


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Position of each word in ``known``, -1 if it isn't there."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy()


def symbols_of(vocab: Vocabulary, columns: Iterator[pa.Array]) -> Iterator[np.ndarray]:
    """The symbols of each text of some columns."""
    head = pa.array(sorted(vocab.head, key=vocab.head.get), pa.binary())
    for column in columns:
        for words, cuts in word_lists(column):
            ids = places(words, head)
            late = np.flatnonzero(ids < 0)
            ids = ids.copy()
            ids[late] = vocab.shape.head_words + vocab.tails(words.take(pa.array(late)))
            for lo, hi in zip(cuts, cuts[1:]):
                yield np.append(ids[lo:hi], np.int32(vocab.end))


def word_counts(training: DataFrame, flush: int = 1_500_000) -> DataFrame:
    """(word, n) over all training texts: counted per task and about ``flush`` words, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            found = pc.value_counts(pa.chunked_array(held, pa.binary()))
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])
        held, size = [], 0
        for b in batches:
            for words, _ in word_lists(b.column("text")):
                held.append(words)
                size += len(words)
                if size > flush:
                    yield out(held)
                    held, size = [], 0
        if size:
            yield out(held)
    return training.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, bound: int) -> list:
    """At most ``bound`` words, most frequent first: those above a count that a histogram of counts gives.

    The histogram has at most some thousand steps, so nothing but the chosen words reaches the driver.
    """
    step = F.floor(F.log2("n") * 64).alias("step")
    steps = sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    least, total = None, 0
    for r in steps:
        total += r["words"]
        if total > bound:
            break
        least = r["step"]
    chosen = [] if least is None else counts.filter(F.floor(F.log2("n") * 64) >= least).collect()
    return sorted(chosen, key=lambda r: (-r["n"], bytes(r["word"])))


@dataclass
class Statistics:
    total: int                  # N: all training tokens, ends included
    distinct: int               # V: distinct ones
    ends: int
    tail_total: list[int]
    tail_distinct: list[int]
    cached: dict[bytes, int]


def statistics(counts: DataFrame, ends: int, vocab: Vocabulary, head: dict[bytes, int],
               cached: dict[bytes, int]) -> Statistics:
    k = vocab.shape.tail_classes
    suffix = F.expr("substring(word, greatest(1, octet_length(word) - 3), 4)")
    # head words are looked up as a literal set of fixed size
    rows = counts.withColumn("tail", (F.crc32(suffix) % k).cast("int")).groupBy("tail").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    total, distinct = [0] * k, [0] * k
    for r in rows:
        total[r["tail"]], distinct[r["tail"]] = r["n"], r["v"]
    n_all, v_all = sum(total), sum(distinct)
    for w, n in head.items():
        total[vocab.tail(w)] -= n
        distinct[vocab.tail(w)] -= 1
    return Statistics(n_all + ends, v_all + (ends > 0), ends, total, distinct, cached)


def _train_everywhere(training: DataFrame, vocab: Vocabulary, weights, rate: float,
                      shards: int = 1) -> tuple[list[np.ndarray], int]:
    """(weights, tokens learned from): every shard goes on from the given weights over all of its part of the corpus.

    Splits are put together to at most ``shards`` shards, whose number follows from the bytes of the corpus and not from
    the cores: a lost executor costs the shards it was at.
    """
    return _train(training.select("text").coalesce(shards), vocab, weights, rate, vocab.shape.corpus_slots, shards)


def _warm(sample: DataFrame, vocab: Vocabulary, weights, rate: float) -> list[np.ndarray]:
    """The weights after one task has gone over a bounded sample in order."""
    rows = sample.select("doc_id", "text").repartition(1).sortWithinPartitions("doc_id", "text")
    return _train(rows, vocab, weights, rate, vocab.shape.train_slots, 1)[0]


def _train(rows: DataFrame, vocab: Vocabulary, weights, rate: float, slots: int, models: int,
           block_rows: int = 256, fan: int = 64) -> tuple[list[np.ndarray], int]:
    """(weights, tokens learned from): a model for each of at most ``models`` partitions, begun at the given weights.

    What the models change is averaged row by row, weighted by the tokens that used the row; rows that no model has
    used stay. Weights come back in blocks of rows, ``fan`` models first added up to one; the driver takes the blocks
    from the shared storage a part of them at a time and changes the given arrays in place.
    """
    shared = broadcast(rows.sparkSession, (vocab, weights))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, start = shared.value
        net = Network.of(v, [w.copy() for w in start])
        seen, uses = train_network(net, symbols_of(v, (b.column("text") for b in batches)), rate, slots)
        model = TaskContext.get().partitionId() // fan
        for i, (name, old) in enumerate(zip(net.NAMES, start)):
            for at in range(0, len(old) if seen else 0, block_rows):
                used = uses[name][at:at + block_rows]
                if used.any():
                    step = (getattr(net, name)[at:at + block_rows] - old[at:at + block_rows]).reshape(len(used), -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([model], pa.int32()), pa.array([i], pa.int32()), pa.array([at], pa.int32()),
                         pa.array([used.tobytes()], pa.binary()),
                         pa.array([(step * used[:, None]).astype("f4").tobytes()], pa.binary())],
                        ["model", "part", "at", "uses", "sums"])
        del net, uses
        release()

    def add(table: pa.Table) -> pa.Table:
        def total(column, kind, to):
            out = 0.0
            for x in table[column]:
                out = out + np.frombuffer(x.as_py(), kind).astype("f8")
            return pa.array([out.astype(to).tobytes()], pa.binary())
        return pa.table({"model": pa.array([table["model"][0].as_py() // fan], pa.int32()),
                         "part": pa.array([table["part"][0].as_py()], pa.int32()),
                         "at": pa.array([table["at"][0].as_py()], pa.int32()),
                         "uses": total("uses", "f8", "f8"), "sums": total("sums", "f4", "f4")})

    schema = "model int, part int, at int, uses binary, sums binary"
    made = rows.mapInArrow(local, schema)
    while True:
        made = made.groupBy("model", "part", "at").applyInArrow(add, schema)
        models = -(-models // fan)
        if models <= 1:
            break
    seen = 0
    for r in stored(made, "lm_model").coalesce(8).toLocalIterator():
        uses = np.frombuffer(r["uses"], "f8")
        step = np.frombuffer(r["sums"], "f4").reshape(len(uses), -1) / np.maximum(uses, 1)[:, None]
        part = weights[r["part"]][r["at"]:r["at"] + len(uses)]
        part += step.reshape(part.shape).astype("f4")
        if Network.NAMES[r["part"]] == "start":
            seen = int(uses[0])
    shared.destroy()
    release()
    return weights, seen


def score(documents: DataFrame, modulus: int = 7, held: int = 2, shape: Shape = Shape(), cached_words: int = 100_000,
          warm_rows: int = 2_000, rate: float = 0.02, shard_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document.

    A model is trained for each ``shard_bytes`` of training text (or for each split, if those are larger).
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rest = remainder("doc_id", modulus)
    training = docs.filter(~rest.isin(held, -1))
    counts = stored(word_counts(training), "lm_counts")
    ends, size = training.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    cached = {bytes(r["word"]): r["n"] for r in most_frequent(counts, cached_words)}
    head = dict(islice(cached.items(), shape.head_words))
    # a smaller vocabulary has fewer classes; words of like frequency share one
    shape = replace(shape, head_words=len(head), head_classes=min(shape.head_classes, math.ceil(math.sqrt(len(head)))))
    vocab = Vocabulary(shape, {w: i for i, w in enumerate(head)})
    stats = statistics(counts, ends, vocab, head, cached)

    network = Network(vocab)
    release()
    if ends:
        _start_biases(network, vocab, head, stats)
        weights = _warm(bounded_sample(training, "doc_id", warm_rows), vocab, network.weights(), rate)
        network.set_weights(_train_everywhere(training, vocab, weights, rate / 10, 1 + size // shard_bytes)[0])

    shared, total = broadcast(spark, (vocab, network.weights(), stats)), stats.total
    del cached, head, vocab, stats, network
    weights = None
    release()
    scored = docs.withColumn("held_out", rest == held).mapInArrow(
        _scorer(shared), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
        "rare array<binary>").withColumn("row", F.struct(F.spark_partition_id().alias("p"), "row"))
    scored = stored(scored, "lm_scored")
    # what is missing for a rare word with count c: log10(c + 1) in both scores, and a known token
    rare = scored.select("row", F.explode("rare").alias("word"))
    late = rare.join(counts, "word").groupBy("row").agg(
        F.count(F.lit(1)).alias("known"), F.sum(F.log10(F.col("n") + 1)).alias("gain"))
    gain = F.coalesce("gain", F.lit(0.0))
    return scored.drop("rare").join(late, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + gain).alias("base_score"),
        (F.col("model") + gain).alias("score"))


def _start_biases(network: Network, vocab: Vocabulary, head: dict[bytes, int], stats: Statistics) -> None:
    """Begin at the corpus frequencies."""
    n = np.zeros(vocab.shape.head_words)
    for w, i in vocab.head.items():
        n[i] = head[w] + 0.5
    of = np.bincount(vocab.class_table[:len(n)], n, vocab.shape.head_classes)
    network.word_w[:, -1] = np.log(n / of[vocab.class_table[:len(n)]])
    mass = np.concatenate([of, np.array(stats.tail_total) + 0.5, [stats.ends + 0.5]])
    groups = np.bincount(vocab.group_table, mass, len(vocab.groups) - 1)
    network.class_w[:, -1] = np.log(mass / groups[vocab.group_table])
    network.group_w[:, -1] = np.log(groups / groups.sum())


class Lookup:
    """Symbols and gains of all words of some texts at once."""

    def __init__(self, vocab: Vocabulary, stats: Statistics, inside: np.ndarray):
        words = list(stats.cached)
        self.vocab, self.inside, self.words = vocab, inside, pa.array(words, pa.binary())
        gain = np.log10(np.array(list(stats.cached.values()), "f8") + 1)
        # what a cached tail word adds to the model's score beside the network's part
        tail = [0.0 if w in vocab.head else g - inside[vocab.tail(w)] for w, g in zip(words, gain.tolist())]
        # the last ones are those of the words that are not cached
        self.gain, self.tail = np.append(gain, 0.0), np.append(tail, 0.0)
        self.symbol = np.array([*map(vocab.symbol, words), 0], "i4")

    def read(self, column: pa.Array) -> Iterator[tuple]:
        """(rare words, where each text's begin and end, gains, tail gains, symbols, where each text's words begin and end)."""
        for words, cuts in word_lists(column):
            at = places(words, self.words)
            gain, tail, symbol = self.gain[at], self.tail[at], self.symbol[at]
            late = np.flatnonzero(at < 0)
            rare = words.take(pa.array(late))
            of = self.vocab.tails(rare)
            tail[late] = -self.inside[of]
            symbol[late] = self.vocab.shape.head_words + of
            yield rare, np.searchsorted(late, cuts), gain, tail, symbol, cuts


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights, stats = shared.value
        net = Network.of(vocab, weights)
        s = vocab.shape
        base = math.log10(stats.total + stats.distinct + 1)
        inside = np.log10(np.array(stats.tail_total, "f8") + stats.tail_distinct + 1)
        cached = Lookup(vocab, stats, inside)
        end_gain, end_known = math.log10(stats.ends + 1), int(stats.ends > 0)
        at = 0
        for b in batches:
            size = b.num_rows
            model, rows = np.zeros(size), []
            rare_words, rare_cuts = [], [0]

            def read():
                for rare, beyond, gain, tail, ids, cuts in cached.read(b.column("text")):
                    rare_words.append(rare)
                    rare_cuts.extend((rare_cuts[-1] + beyond[1:]).tolist())
                    for lo, hi, late in zip(cuts[:-1].tolist(), cuts[1:].tolist(), np.diff(beyond).tolist()):
                        n = hi - lo
                        rows.append((n + 1, end_known + n - late, end_gain + float(gain[lo:hi].sum()) - (n + 1) * base,
                                     float(tail[lo:hi].sum())))
                        yield len(rows) - 1, np.append(ids[lo:hi], np.int32(vocab.end))

            slots = min(s.slots, size)
            h = np.zeros((slots, s.hidden), "f4")
            for fresh, inputs, targets, real, who in streams(read(), vocab, slots, s.window):
                h[fresh] = net.start
                lengths = real.sum(0)
                live = np.argsort(-lengths, kind="stable")[:np.count_nonzero(lengths)]
                before, last, _ = net.states(h[live], inputs[:, live], lengths[live])
                after = np.concatenate([before[1:], last[None]])
                some = real[:, live]
                got = net.predict(after.reshape(-1, s.hidden), targets[:, live][some], np.flatnonzero(some))
                model += np.bincount(np.broadcast_to([who[i] for i in live], some.shape)[some], got, minlength=size)
                h[live] = last
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(at, at + size)), b.column(0), b.column(2),
                 pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.float64()),
                 pa.array(model / math.log(10) + np.array([r[3] for r in rows])),
                 pa.ListArray.from_arrays(pa.array(rare_cuts, pa.int32()), pa.concat_arrays(rare_words))],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])
            at += size
    return run
