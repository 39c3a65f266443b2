"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps letters to lower-case base letters (homoglyphs, full-width forms,
accents) and digit substitutions to letters, one character for one, so places in
the folded text are places in the text. The lexicon holds word stems; a match
begins at a word's start, the longest stem counts, and a match inside an
exception phrase does not count. The sum of the weights is normalised by the
text's length and calibrated to a probability. Stems have 4 to 10 characters (a longer word
is met by its first ten), shorter entries are whole words, and an exception phrase is two
words of any length with one blank between, up to the second's end.

Stems, weights, exception phrases and calibration are learned from a bounded
sample of labelled documents (``max_training_rows``), without their copies.

Defined results: null and empty texts have no match and get the base probability
of a text without matches; repeated rows get equal scores; with no labels (or
one class only) nothing matches and every score is 0.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import (bounded_sample, broadcast, distinct_texts, fit_in_task, fit_logistic, keep_rows,
                                 labelled, remainder, sigmoid, texts)

#: Cyrillic and Greek letters that look like Latin ones.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁҽαβεικνορτυχω", "abekmhopctyxijsdeabeikvoptuxw", strict=True))
#: Digits and signs written in place of letters.
SUBSTITUTIONS = dict(zip("013457@$", "oieastas", strict=True))
STEM_LENGTHS = range(4, 11)      # entries shorter than that are whole words
_TWO_WORDS = re.compile(r"[^ ]+ [^ ]+")


class _Fold(dict):
    """Character -> folded character, filled as characters are met."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        base = unicodedata.normalize("NFKD", c)[0].lower()[0]
        base = HOMOGLYPHS.get(base, SUBSTITUTIONS.get(base, base))
        if base == "ß":
            base = "s"
        self[code] = out = ord(base if base.isalpha() or base.isdigit() else " ")
        return out


_FOLD = _Fold()


def fold(text: str) -> str:
    """Same length as the text; letters folded, everything that is no word character a blank."""
    return text.translate(_FOLD)


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    calibration: tuple[float, float, float] = (0.0, 0.0, -40.0)

    def automaton(self):
        """Entries are (length, weight, fallback): an exception phrase that does not end at a word's end falls back to
        the longest stem that it begins with."""
        auto = ahocorasick.Automaton()
        for stem, w in self.weights.items():
            auto.add_word(" " + stem, (len(stem), w, None))
        for phrase in map(fold, self.exceptions):
            stem = next((phrase[:k] for k in range(len(phrase), 0, -1) if phrase[:k] in self.weights
                         and (k >= STEM_LENGTHS[0] or phrase[k:k + 1] in ("", " "))), None)
            auto.add_word(" " + phrase, (len(phrase), 0.0, stem and (len(stem), self.weights[stem])))
        if len(auto):
            auto.make_automaton()
        return auto


def matches(auto, folded: str):
    """(end, length, weight) of the longest entries met; ``folded`` begins with a blank. Short ones match whole words,
    exception phrases up to a word's end."""
    start: int | None = 0
    while start is not None and len(auto):
        at, start = start, None
        for end, (length, w, fallback) in auto.iter_long(folded, at):
            whole = folded[end + 1:end + 2] in ("", " ")
            if w or whole:
                if whole or length >= STEM_LENGTHS[0]:
                    yield end, length, w
                continue
            # no exception after all: the text behind its stem is read again
            begin = end - length
            stem, weight = fallback or (0, 0.0)
            if stem:
                yield begin + stem, stem, weight
            start = begin + max(1, stem) + (1 if stem else 0)
            break


def weigh(auto, text: str | None) -> tuple[float, int, int]:
    """(sum of weights, matches, words) of a whole text; exception phrases match with weight 0."""
    if not text:
        return 0.0, 0, 0
    folded = fold(text)
    total, n = 0.0, 0
    for end, length, w in matches(auto, " " + folded):
        if w and any(map(str.isalpha, text[end - length:end])):
            total += w
            n += 1
    return total, n, len(folded.split())


def features(total: float, words: int) -> tuple[float, float]:
    """Length-normalised weight, and the weight itself on a log scale."""
    return 100 * total / (words + 10), math.log1p(max(0.0, total))


def probability(lexicon: Lexicon, auto, text: str | None) -> float:
    total, _, words = weigh(auto, text)
    a, b = features(total, words)
    wa, wb, bias = lexicon.calibration
    return float(sigmoid(np.float64(wa * a + wb * b + bias)))


def learn(rows: list[dict], min_share: float = 0.005, min_log_odds: float = math.log(4), size: int = 4096) -> Lexicon:
    """Lexicon of (text, label) rows; at most ``size`` stems and short words, those of most documents first."""
    rows = distinct_texts([r for r in rows if r["text"]])
    bad = [r["text"] for r in rows if r["label"]]
    good = [r["text"] for r in rows if not r["label"]]
    if not bad or not good:
        return Lexicon()

    least = max(4, min_share * len(bad))
    words = [Counter(map(sys.intern, fold(t).split())) for t in bad]     # a word is held once, not once a document
    among: set[str] = set()
    for k in STEM_LENGTHS:          # a stem can't be in more documents than the stem one shorter
        docs: Counter = Counter()
        for of in words:
            docs.update({w[:k] for w in of if len(w) >= k and (k == STEM_LENGTHS[0] or w[:k - 1] in among)})
        among |= {s for s, n in docs.items() if n >= least}
    docs = Counter(w for of in words for w in of if len(w) < STEM_LENGTHS[0])
    short = {w for w, n in docs.items() if n >= least}

    def stems(counted):
        docs, uses, total = Counter(), Counter(), 0
        for of in counted:
            total += sum(of.values())
            mine: Counter = Counter()
            for w, n in of.items():
                if w in short:
                    mine[w] += n
                for k in STEM_LENGTHS:
                    if k > len(w) or w[:k] not in among:
                        break
                    mine[w[:k]] += n
            docs.update(mine.keys())
            uses.update(mine)
        return docs, uses, total

    docs, uses, n_bad = stems(words)
    good_docs, good_uses, n_good = stems(Counter(fold(t).split()) for t in good)
    chosen: dict[str, float] = {}
    for s in sorted(among | short, key=lambda s: (len(s), s)):
        w = math.log((uses[s] + 0.5) / (n_bad + 1)) - math.log((good_uses[s] + 0.5) / (n_good + 1))
        by_docs = math.log((docs[s] + 0.5) / (len(bad) + 1)) - math.log((good_docs[s] + 0.5) / (len(good) + 1))
        shorter = next((chosen[s[:k]] for k in range(len(s) - 1, 3, -1) if s[:k] in chosen), 0.0)
        if min(w, by_docs) >= min_log_odds and w > shorter + 0.7:
            chosen[s] = w
    chosen = dict(sorted(chosen.items(), key=lambda x: (-docs[x[0]], x[0]))[:size])
    lexicon = Lexicon(chosen)
    lexicon.exceptions = _exceptions(lexicon, bad, good)
    auto = lexicon.automaton()
    x = [features(t, n) for t, _, n in (weigh(auto, r["text"]) for r in rows)]
    lexicon.calibration = tuple(fit_logistic(np.array(x), np.array([r["label"] for r in rows], "f8"), ridge=0.01))
    return lexicon


def _exceptions(lexicon: Lexicon, bad: list[str], good: list[str], least: int = 5) -> list[str]:
    """Two-word phrases around a match that five or more good documents use and no bad one."""
    auto = lexicon.automaton()
    counts = []
    for group in (bad, good):
        docs = Counter()
        for t in group:
            folded, mine = " " + fold(t), set()
            for end, length, _ in matches(auto, folded):
                found = _TWO_WORDS.match(folded, end - length + 1)
                if found:
                    mine.add(found.group())
            docs.update(mine)
        counts.append(docs)
    return sorted(p for p, n in counts[1].items() if n >= least and not counts[0][p])


def train(documents: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2,
          max_training_rows: int = 20_000) -> Lexicon:
    """Learn from labelled documents whose crc32(doc_id) mod ``modulus`` is not ``held``."""
    known = labelled(labels, "toxic").filter(remainder("doc_id", modulus) != held)
    sample = bounded_sample(known, "doc_id", max_training_rows)
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    return fit_in_task(rows, lambda got: learn(got))


def score(documents: DataFrame, lexicon: Lexicon, modulus: int = 4, held: int = 2,
          threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_matches) for every document."""
    model = broadcast(documents.sparkSession, lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, auto = model.value, model.value.automaton()
        for b in batches:
            weighed = [weigh(auto, t) for t in texts(b)]
            x = np.array([features(t, n) for t, _, n in weighed]).reshape(-1, 2)
            p = sigmoid(x @ np.array(lex.calibration[:2]) + lex.calibration[2])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= threshold).astype("i4")),
                 pa.array([m for _, m, _ in weighed], pa.int64())],
                ["doc_id", "held_out", "score", "predicted", "n_matches"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            (remainder("doc_id", modulus) == held).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_matches long")


def reject(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = broadcast(documents.sparkSession, lexicon)
    made = {}

    def keep(batch: list[str | None]) -> list[bool]:
        lex = model.value
        if "auto" not in made:
            made["auto"] = lex.automaton()
        return [probability(lex, made["auto"], t) < threshold for t in batch]

    return keep_rows(documents, keep)
