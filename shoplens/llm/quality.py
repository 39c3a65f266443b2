"""Quality classifier: Naive Bayes support vectors.

A text's n-gram indicators (words, and n-grams of word shapes) are scaled by the
log-ratio of the two classes' smoothed counts; a linear hinge-loss model is fitted
on them by dual coordinate descent and calibrated to a probability. A word's
shape keeps its signs and folds runs of lower-case letters, upper-case letters
and digits to one character; a word that repeats the one before it has the shape
of a repetition.

Learned from a bounded sample of labelled documents (``max_training_rows``),
without their copies. Defined results: null and empty texts have no indicators
and get the score of the bias; repeated rows get equal scores; without labels of
both classes every score is the share of label 1 (1 without any label).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import (bounded_sample, broadcast, distinct_texts, fit_in_task, fit_logistic, labelled,
                                 remainder, sigmoid, texts, utf8)

_SHAPE = bytes(0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x39 if 0x30 <= c <= 0x39 else c
               for c in range(256))
_RUNS = re.compile(rb"([aA9])\1+")


@dataclass
class Model:
    weights: dict = field(default_factory=dict)   # indicator -> ratio times weight
    bias: float = 0.0
    calibration: tuple[float, float] = (1.0, 0.0)


def indicators(text: str | None, among=None) -> set:
    """Distinct words (lower-cased bytes) and shape n-grams (tuples of one to three shapes) of a whole text."""
    if not text:
        return set()
    raw = utf8(text)
    words = raw.split()
    shapes = _RUNS.sub(rb"\1", raw.translate(_SHAPE)).split()
    shapes = [b"=" if w == v else s for s, w, v in zip(shapes, words, [b"", *words])]
    out = set(raw.lower().split())
    out.update(zip(shapes))
    out.update(zip(shapes, shapes[1:]))
    out.update(zip(shapes, shapes[1:], shapes[2:]))
    return out


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray,
                            epochs: int = 30, seed: int = 3) -> np.ndarray:
    """Weights of min |w|^2/2 + sum cost_i max(0, 1 - y_i w.x_i); the last feature of each row is the bias."""
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norms = np.array([float(v @ v) for _, v in rows]) + 1e-12
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            ids, v = rows[i]
            g = y[i] * float(w[ids] @ v) - 1
            new = min(max(alpha[i] - g / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                w[ids] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


def fit(rows: list[dict], least: int = 5, size: int = 200_000, smoothing: float = 1.0, cost: float = 0.1,
        blend: float = 0.25) -> Model:
    """Train on (text, label) rows; the ``size`` indicators of most documents are used."""
    rows = distinct_texts([r for r in rows if r["text"]])
    y = np.array([1.0 if r["label"] else -1.0 for r in rows])
    if not len(y) or abs(y.sum()) == len(y):
        return Model({}, 0.0, (0.0, 40.0 if not len(y) or y[0] > 0 else -40.0))
    docs: Counter = Counter()
    for r in rows:
        docs.update(indicators(r["text"]))
    used = sorted((g for g, n in docs.items() if n >= least), key=lambda g: (-docs[g], repr(g)))[:size]
    del docs
    index = {g: i for i, g in enumerate(used)}
    ids = [np.sort(np.fromiter((index[g] for g in indicators(r["text"]) if g in index), "i4")) for r in rows]
    counts = np.full((2, len(used)), smoothing)
    for i, row in enumerate(ids):
        counts[int(y[i] > 0), row] += 1
    ratio = np.log(counts[1] / (y > 0).sum()) - np.log(counts[0] / (y < 0).sum())
    x = [(np.append(row, len(used)), _scaled(ratio[row])) for row in ids]
    share = (y > 0).mean()
    w = dual_coordinate_descent(x, y, len(used) + 1, np.where(y > 0, cost * 0.5 / share, cost * 0.5 / (1 - share)))
    # the hinge model's weights are drawn towards their mean size, as is usual for this classifier
    w[:-1] = (1 - blend) * w[:-1] + blend * np.abs(w[:-1]).mean()
    value = ratio * w[:-1]
    model = Model({g: float(value[i]) for g, i in index.items() if value[i]}, float(w[-1]))
    margins = np.array([value[row].sum() / max(1, np.count_nonzero(value[row])) ** 0.5 + w[-1] for row in ids])
    a, b = fit_logistic(margins[:, None], (y > 0).astype("f8"), ridge=0.01)
    model.calibration = (float(a), float(b))
    return model


def _scaled(ratio: np.ndarray) -> np.ndarray:
    """Indicator values of a row: ratios over the root of their number, so long texts don't outweigh short ones."""
    return np.append(ratio / np.sqrt(max(1, len(ratio))), 1.0)


def margin(model: Model, found: set) -> float:
    hits = [model.weights[g] for g in found if g in model.weights]
    return sum(hits) / max(1, len(hits)) ** 0.5 + model.bias


def train(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0,
          max_training_rows: int = 10_000) -> Model:
    known = labelled(labels, "quality").filter(remainder("doc_id", modulus) != held)
    sample = bounded_sample(known, "doc_id", max_training_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    return fit_in_task(rows, lambda got: fit(got))


def score(documents: DataFrame, model: Model, modulus: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    shared = broadcast(documents.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            x = np.array([margin(m, indicators(t)) for t in texts(b)])
            p = sigmoid(m.calibration[0] * x + m.calibration[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= threshold).astype("i4"))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            (remainder("doc_id", modulus) == held).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
