"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are byte n-grams of the lower-cased text in which every run of other
characters than letters is one blank, so grams know where words begin and end.
A gram's hash picks a row of the embedding table; the rows of all grams of a text
are averaged and a linear softmax gives the language. Both are trained by
stochastic gradient descent in numpy on a bounded sample of documents
(``max_training_rows``), each cut into consecutive segments so that short texts
are seen as well. A part of the sample that is held back calibrates the softmax
(temperature) and the rejection: below the confidence at which the calibrated
error rate passes ``max_error`` a prediction is marked as rejected.

Defined results: ``und`` with score 0 for null texts and texts without a letter;
rows with equal texts get equal results; without any training document every
text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import bounded_sample, broadcast, fit_in_task, remainder, texts, utf8

ORDERS = (1, 2, 3, 4)
#: Letters and, beside them, numbers that are no decimal digits.
_LETTERLIKE = re.compile(r"[^\W\d_]")
UND = "und"


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTERLIKE.finditer(text))


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    bits: int = 16
    table: np.ndarray | None = None        # (buckets, languages): embedding rows times the output weights
    bias: np.ndarray | None = None
    temperature: float = 1.0
    reject_below: float = 0.0


#: Lower-cased bytes; digits, white space and ASCII signs become blanks.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def _clean(text: str) -> bytes:
    return b" " + b" ".join(utf8(text).translate(_LETTERS).split()) + b" "


def _grams(data: bytes, bits: int) -> list[np.ndarray]:
    """Bucket of every gram, an array per order; grams of one order begin at successive bytes."""
    b = np.frombuffer(data, "u1").astype("u4")
    h = np.zeros(len(b), "u4")
    out = []
    for n in ORDERS:
        if len(b) < n:
            break
        h = h[:len(b) - n + 1] * np.uint32(0x01000193) ^ b[n - 1:]
        x = h * np.uint32(0x9E3779B1)
        out.append((x ^ (x >> np.uint32(15))) >> np.uint32(0) & np.uint32((1 << bits) - 1))
    return out


def buckets(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's grams and their shares."""
    g = np.concatenate(_grams(_clean(text), bits))
    ids, n = np.unique(g, return_counts=True)
    return ids, (n / n.sum()).astype("f4")


def segments(text: str, cut: int) -> list[str]:
    """The whole text in consecutive segments of ``cut`` characters."""
    return [text[a:a + cut] for a in range(0, len(text), cut)]


def fit(rows: list[dict], bits: int = 16, size: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 7,
        segment_chars: int = 400, max_error: float = 0.02) -> Model:
    """Train on (text, lang) rows."""
    rows = [r for r in rows if r["lang"] is not None and r["text"] and has_letter(r["text"])]
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model()
    rng = np.random.default_rng(seed)
    known = {x: i for i, x in enumerate(languages)}
    data = []
    for r in rows:
        t, part = r["text"], bool(rng.random() < 0.15)
        # a segment for every part of the text, in lengths from a few words to all of it
        cut = int(rng.choice([30, 100, segment_chars, len(t)]))
        for segment in segments(t, cut):
            if has_letter(segment):
                data.append((*buckets(segment, bits), known[r["lang"]], part))
    train = [d for d in data if not d[3]] or data
    check = [d for d in data if d[3]] or data
    emb = rng.normal(0, 0.1, (1 << bits, size)).astype("f4")
    out = np.zeros((size, len(languages)), "f4")
    bias = np.zeros(len(languages), "f4")
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            ids, share, y, _ = train[i]
            lr = rate * (1 - step / steps) + 1e-3
            mean = share @ emb[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= lr * 0.1 * p
            emb[ids] -= np.float32(lr * 10) * share[:, None] * back[None, :]
            step += 1
    model = Model(languages, bits, emb @ out, bias)
    z = np.array([share @ model.table[ids] + bias for ids, share, _, _ in check])
    y = np.array([d[2] for d in check])

    def loss(t):
        s = z / t
        m = s.max(1)
        return (m + np.log(np.exp(s - m[:, None]).sum(1)) - s[np.arange(len(y)), y]).mean()
    model.temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    p = softmax(z / model.temperature)
    order = np.argsort(-p.max(1), kind="stable")
    errors = np.cumsum(p.argmax(1)[order] != y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(errors <= max_error)
    model.reject_below = float(p.max(1)[order][good[-1]]) if len(good) else 1.0
    return model


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def logits(model: Model, text: str, block: int = 1 << 20) -> np.ndarray:
    """Mean over all grams of the whole text, summed in blocks."""
    data = _clean(text)
    total, n = np.zeros(len(model.languages)), 0
    reach = max(ORDERS) - 1
    for at in range(0, len(data), block):
        for order, g in zip(ORDERS, _grams(data[at:at + block + reach], model.bits)):
            g = g[:block] if at + block < len(data) else g
            if len(g) < 5_000:
                total += model.table[g].sum(0, dtype="f8")
            else:
                total += np.bincount(g, minlength=1 << model.bits) @ model.table
            n += len(g)
    return total / max(n, 1) + model.bias


def train(documents: DataFrame, modulus: int = 5, held: int = 0, max_training_rows: int = 4_000) -> Model:
    rows = documents.select("doc_id", "lang", "text").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~remainder("doc_id", modulus).isin(held, -1))
    return fit_in_task(bounded_sample(rows, "doc_id", max_training_rows), lambda got: fit(got))


def predict(documents: DataFrame, model: Model, modulus: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every document, from whole texts only."""
    shared = broadcast(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            lang, score = [], []
            for t in texts(b):
                if t and m.languages and has_letter(t):
                    p = softmax((logits(m, t) / m.temperature)[None])[0]
                    k = int(p.argmax())
                    lang.append(m.languages[k])
                    score.append(float(p[k]))
                else:
                    lang.append(UND)
                    score.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang), pa.array(score, pa.float64()),
                 pa.array([x < m.reject_below or n == UND for x, n in zip(score, lang)], pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            (remainder("doc_id", modulus) == held).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
