"""Mixing, resampling and spelling variants against plain versions of themselves."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from fixtures import documents
from shoplens.llm import mixing, resampling, spelling
from shoplens.llm.common import numbered

PLAIN = [None, None, None]


def frame(spark, rows):
    """Documents of (doc_id, text, source)."""
    return documents(spark, [(d, t, None, s, None) for d, t, s in rows])


def shared_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """{source: target}: stop what is above, share the excess anew."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        each = left / sum(w[s] for s in open_)
        left = 0.0
        for s in list(open_):
            out[s] += each * w[s]
            if out[s] >= cap * sizes[s]:
                left += out[s] - cap * sizes[s]
                out[s] = cap * sizes[s]
                open_.discard(s)
    return out


def test_numbered_places(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "id * 7919 % 31 AS k")
    got = numbered(rows, [F.desc("k"), F.asc("id")], "numbered").collect()
    want = sorted(((r["k"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(5000))


@pytest.mark.parametrize("few", [50_000, 0])
def test_mixing_against_plain_version(spark, few):
    rng = random.Random(1)
    names = [None, "", "é", "z", "a b", "\U0001F600", "hot"]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40])) + rng.choice(["", " \n", " "]),
             "hot" if i % 3 == 0 else rng.choice(names)) for i in range(900)] + [(None, "x y", "none"), (5, None, "nothing"), (5, "", "nothing")]
    docs = frame(spark, rows)
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = shared_targets(sizes)
    got = mixing.repetitions(docs, ["doc_id", "source"], broadcast_sources=few, salts=4).collect()
    assert len(got) == len(rows)
    for r in got:
        s = r["kept"]["source"]
        assert (r["source_size"], r["target"]) == (sizes[s], pytest.approx(want[s]))
        assert r["copies"] in (math.floor(r["rate"]), math.ceil(r["rate"])) and r["copies"] <= 2
    assert sorted(r["size"] for r in got) == sorted(size(t) for _, t, _ in rows)
    taken, var = Counter(), Counter()
    for r in got:
        taken[r["kept"]["source"]] += r["copies"] * r["size"]
        var[r["kept"]["source"]] += r["size"] ** 2 / 4
    assert all(abs(taken[s] - want[s]) <= 4 * math.sqrt(var[s]) for s in sizes)
    made = mixing.mix(docs, broadcast_sources=few)
    assert made.columns == docs.columns and made.count() == sum(r["copies"] for r in got)


def test_mixing_shares_the_excess_until_none_is_above(spark):
    sizes = [("a", 1), ("b", 1000), ("c", 30), ("d", 0), (None, 10), ("e", 400)]
    for share in (0.5, 1.5, 1.99, 2.0, 3.0):
        got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, size long"),
                                                                 (5, 2, 1), share, 2.0).collect()}
        assert got == pytest.approx(shared_targets(dict(sizes), share=share))


def features(text, longest):
    w = brute.words(text)
    return Counter(zlib.crc32(" ".join(w[i:i + m]).encode()) % 50 for m in range(1, longest + 1) for i in range(len(w) - m + 1))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_against_plain_version(spark, longest, monkeypatch):
    rng = random.Random(longest)
    lines = ["a b", "", "É x-a", "  ", "one", "b b b\ta", "A", "!", "çà u"]
    rows = [(i % 190, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(200)] + [(7, None), (None, "a b a b\r\na"), (None, "a b c")]
    target = ["a b a\none b", "", None, "x"]
    if longest == 2:    # hardly any line is broadcast
        monkeypatch.setattr(resampling, "HOT_LINES", 2)
    docs, aim = frame(spark, [(*r, None) for r in rows]), spark.createDataFrame([(t,) for t in target], "text string")
    of = [features(t, longest) for _, t in rows]
    s, t = sum(of, Counter()), sum((features(x, longest) for x in target), Counter())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)]
    want = []
    for (d, text), c in zip(rows, of):
        weight = sum(n * gain[b] for b, n in c.items())
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        want.append((d, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), len(brute.words(text))))
    able = sorted((w for w in want if w[4] >= 5), key=lambda w: (-w[3], w[0] is None, w[0] or 0, -w[1]))
    ranks = {}
    for n, w in enumerate(able[:30 * len(able) // 100], 1):
        ranks.setdefault(w[:4], []).append(n)
    got = resampling.resample(docs, aim, ["doc_id", "text"], percent=30, least_words=5, longest=longest, buckets=50).collect()
    key = lambda r: (r["doc_id"], r["n_features"], r["weight"], r["score"])
    assert Counter(map(key, got)) == Counter(w[:4] for w in want)
    found = {}
    for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"]):
        found.setdefault(key(r), []).append(r["rank"])
    assert found == ranks and len(ranks) > 20
    drawn = resampling.draw(docs, aim, percent=30, least_words=5, longest=longest, buckets=50)
    assert drawn.columns == docs.columns and drawn.count() == sum(map(len, ranks.values()))


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, least=3, count=2, ratio=3, modulus=5):
    c = Counter()
    for d, t in rows:
        runs = "".join(x if x in brute.LETTERS else " " for x in t or "").translate(brute.LOWER).split()
        for r in runs:
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            if h % modulus == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            c[r] += 1
    c = {w: n for w, n in c.items() if len(w) >= least and n >= count}
    near = {w: [x for x in c if one_edit(w, x)] for w in c}
    form = {}
    for w in c:
        best = min(near[w], key=lambda x: (-c[x], x), default=None)
        form[w] = best if best is not None and c[best] >= ratio * c[w] else None
    out = {}
    for w in c:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, c[w], len(near[w]), c[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("symbols", [2, 12])
def test_spelling_against_plain_version(spark, symbols):
    rng = random.Random(symbols)
    bits = ["a", "b", "é", "É", "Ab", "×", "÷"]
    words = ["".join(rng.choices(bits, k=rng.randint(1, 6))) for _ in range(120)]
    rows = [(i if i % 9 else None, rng.choice([" ", "_", "œ", "1"]).join(rng.choices(words, [1 / (k + 1) for k in range(120)], k=60)))
            for i in range(120)] + [(1, None), (2, "")]
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
           for r in spelling.variants(frame(spark, [(*r, None) for r in rows]), least_length=3, ratio=3, modulus=5, symbols=symbols).collect()}
    want = plain_variants(rows)
    assert got == want and sum(v[0] is not None for v in want.values()) > 20 and any(v[0] != v[1] for v in want.values() if v[0])


def test_spelling_full_bitmap_and_long_words(spark):
    long = "ab" * 400
    rows = [(i, f"{long} {long[:-1]} x{long} {long[:50]}c{long[50:]} abcdefgh abcdefg abcdefghi") for i in range(3)]
    docs = frame(spark, [(*r, None) for r in rows])
    one = {r["word"]: r["n_near"] for r in spelling.variants(docs, modulus=10**9).collect()}
    few = {r["word"]: r["n_near"] for r in spelling.variants(docs, modulus=10**9, bitmap_bits=3).collect()}
    assert one == few and one[long] == 3 and one["abcdefgh"] == 2 and one["abcdefg"] == 1


def test_neighbourhood_holds_every_edit():
    for word in ([1], [1, 1, 2, 3], [3, 2, 2, 1, 3, 3]):
        s = np.array([word], "u8")
        got = {int(x) for b in spelling.neighbourhood(s, 3) for x in b.ravel()}
        edits = [word] + [word[:i] + word[i + 1:] for i in range(len(word))] \
            + [word[:i] + [k] + word[i + 1:] for i in range(len(word)) for k in (1, 2, 3)] \
            + [word[:i] + [k] + word[i:] for i in range(len(word) + 1) for k in (1, 2, 3)]
        want = {int(spelling.mix(np.array([sum(x * pow(int(spelling.BASE), i, 1 << 64) for i, x in enumerate(e)) % (1 << 64)], "u8"))[0])
                for e in edits}
        assert got == want


def test_roots_follow_long_chains(spark):
    chain = spark.createDataFrame([(f"w{i:03d}", f"w{i + 1:03d}") for i in range(70)], "word string, form string")
    assert {r["root"] for r in spelling.roots(chain).collect()} == {"w070"}
