"""Operators against brute force, exact round trips, held-out accuracy and DuckDB SQL."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from fixtures import SF, documents, table
from shoplens.llm import decontamination, lm_scoring, ngram_join, packing, pii, queries, sharding, toxicity
from tools.check_oracle import compare, duck_connect


def texts(spark, sf=SF):
    return [(r["doc_id"], r["text"]) for r in table(spark, "documents", sf).select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    n, problems = compare(spark, duck_connect(SF), queries.QUERIES[name], queries.SQL[name], SF)
    assert n and not problems, problems


def auc(rows):
    pairs = sorted(rows)
    ranks = defaultdict(list)
    for i, (s, _) in enumerate(pairs):
        ranks[s].append(i)
    pos = [sum(ranks[s]) / len(ranks[s]) for s, y in pairs if y]
    n, m = len(pos), len(pairs) - len(pos)
    return (sum(pos) - n * (n - 1) / 2) / (n * m)


@pytest.mark.parametrize("name,label,sf,least", [("op6_quality", "quality", "/root/testdata/sf0.01", 0.95),
                                                ("op10_toxicity", "toxic", "/root/testdata/sf0.1", 0.95)])
def test_held_out_ranking(spark, name, label, sf, least):
    scored = queries.QUERIES[name](spark, sf).join(table(spark, "labels", sf), "doc_id").filter("held_out").collect()
    assert auc([(r["score"], r[label]) for r in scored]) >= least


def test_held_out_language(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op1_language_id"](spark, sf).filter("held_out").join(
        table(spark, "documents", sf).select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in rows]) >= 0.95


def test_keep_one_tells_rows_of_one_id_apart(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (2, b + " z"), (3, c), (3, c), (3, c + " y"), (4, ""), (4, None), (4, "")]
    kept = ngram_join.keep_one(documents(spark, [(*r, None, None, None) for r in rows])).collect()
    got = Counter((r["doc_id"], r["text"]) for r in kept)
    assert {k: n for k, n in got.items() if k[0] in (1, 2, 4)} == {(1, a): 1, (1, b): 1, (4, ""): 1, (4, None): 1}
    assert sum(n for k, n in got.items() if k[0] == 3) == 1


def test_components_do_not_come_back_split(spark):
    edges = spark.range(64).selectExpr("cast(lpad(id * 37 % 65, 3, '0') AS binary) u",
                                       "cast(lpad((id + 1) * 37 % 65, 3, '0') AS binary) v")
    with pytest.raises(RuntimeError):
        ngram_join.components(edges, rounds=1)
    got = ngram_join.components(edges).collect()
    assert len(got) == 65 and len({bytes(r["root"]) for r in got}) == 1


def test_language_training_reads_whole_texts(monkeypatch):
    from shoplens.llm import language_id
    read, inner = Counter(), language_id.buckets

    def spy(text, bits):
        read[text] += 1
        return inner(text, bits)
    monkeypatch.setattr(language_id, "buckets", spy)
    rows = [{"text": f"{k}" + "".join(f"w{k}x{i:03d} " for i in range(500)), "lang": "ab"[k % 2]} for k in range(8)]
    language_id.fit(rows, bits=8, epochs=1)
    whole = "".join(read)
    assert all(sum(len(s) * n for s, n in read.items() if f"w{k}x" in s) >= 2900 for k in range(8))
    assert len(whole) >= sum(len(r["text"]) for r in rows) * 0.95


def test_lm_base_score_and_counts(spark):
    docs = texts(spark)
    token = lambda t: (t or "").encode().lower().split()
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    c = Counter(w for d, t in docs if not held[d] for w in token(t))
    ends = sum(not h for h in held.values())
    total, distinct = sum(c.values()) + ends, len(c) + 1
    # few cached words, so that most counts come by the join
    out = {r["doc_id"]: r for r in lm_scoring.score(table(spark, "documents"), cached_words=1000).collect()}
    assert len(out) == len(docs)
    for d, t in docs:
        w = token(t)
        base = sum(math.log10((c[x] + 1) / (total + distinct + 1)) for x in w) + math.log10((ends + 1) / (total + distinct + 1))
        r = out[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[d], len(w) + 1, sum(x in c for x in w) + 1, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    assert sum(r["score"] for r in out.values()) > sum(r["base_score"] for r in out.values())


def test_lm_learns_from_every_training_token(spark, monkeypatch):
    # 2.6 million training tokens: more than the two million that were enough for any corpus
    frame = spark.range(0, 3000, 1, 4).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(1, 1000), i -> concat('w', (id + i * i) % 23))) AS text")
    made, inner = [], lm_scoring._train_everywhere

    def spy(*args):
        made.append(inner(*args))
        return made[-1]
    monkeypatch.setattr(lm_scoring, "_train_everywhere", spy)
    shape = lm_scoring.Shape(hidden=4, head_classes=4, head_words=16, tail_classes=3)
    rows = lm_scoring.score(frame, shape=shape, warm_rows=50).select("train_tokens").distinct().collect()
    (_, seen), = made
    assert seen == rows[0]["train_tokens"] > 2_000_000


def test_lm_classes_cover_the_broadcast_words(spark, monkeypatch):
    frame = spark.range(0, 60, 1, 2).selectExpr(
        "id AS doc_id", "concat_ws(' ', transform(sequence(0, 2999 - 40 * id), i -> concat('w', i))) AS text")
    made, inner = [], lm_scoring._train_everywhere

    def spy(*args):
        made.append((args[1], inner(*args)[0]))
        return made[-1][1], 0
    monkeypatch.setattr(lm_scoring, "_train_everywhere", spy)
    lm_scoring.score(frame, warm_rows=20)
    (vocab, weights), = made
    words = {w for r in frame.filter(~F.expr("pmod(crc32(cast(cast(doc_id AS string) AS binary)), 7)").isin(2)).collect()
             for w in lm_scoring.tokens(r["text"])}
    assert set(vocab.head) == words and len(words) > 2000
    net = lm_scoring.Network(vocab).set_weights(weights)
    last = vocab.class_table == vocab.shape.head_classes - 1
    ids = np.flatnonzero(last)
    inside = []
    for state in np.random.default_rng(3).normal(size=(2, vocab.shape.hidden)).astype("f4"):
        log = net.predict(np.tile(state, (len(ids), 1)), ids)
        inside.append(np.exp(log) / np.exp(log).sum())
    assert len(ids) > 50 and not np.allclose(inside[0], inside[1], rtol=1e-3)
    assert len({vocab.symbol(w) for w in words}) == len(words)


def test_lm_state_is_carried_across_windows():
    shape = lm_scoring.Shape(hidden=6, head_classes=2, head_words=10, tail_classes=3, window=4, slots=3)
    vocab = lm_scoring.Vocabulary(shape, {b"w%d" % i: i for i in range(10)})
    net, rng = lm_scoring.Network(vocab), np.random.default_rng(1)
    docs = [rng.integers(0, vocab.symbols, n).astype("i4") for n in (1, 4, 17, 30, 2)]

    def total(window, slots):
        out, h = np.zeros(len(docs)), np.zeros((slots, shape.hidden), "f4")
        for fresh, i, t, real, who in lm_scoring.streams(iter(enumerate(docs)), vocab, slots, window):
            h[fresh] = net.start
            before, last, _ = net.states(h, i)
            after = np.concatenate([before[1:], last[None]])
            for s, d in enumerate(who):
                if d is not None:
                    out[d] += net.predict(after[real[:, s], s], t[real[:, s], s]).sum()
            h = last
        return out
    assert np.allclose(total(4, 3), total(100, 1), rtol=1e-4)
    states = rng.normal(size=(1, shape.hidden)).astype("f4").repeat(vocab.symbols, 0)
    assert np.exp(net.predict(states, np.arange(vocab.symbols))).sum() == pytest.approx(1, abs=1e-4)


def test_lm_gradients():
    shape = lm_scoring.Shape(hidden=4, head_classes=2, head_words=6, tail_classes=2)
    vocab = lm_scoring.Vocabulary(shape, {b"w%d" % i: i for i in range(6)})
    net, rng = lm_scoring.Network(vocab), np.random.default_rng(2)
    for n in net.NAMES:
        setattr(net, n, rng.normal(0, 0.5, getattr(net, n).shape))
    i, t = rng.integers(0, vocab.symbols, (5, 3)), rng.integers(0, vocab.symbols, (5, 3))
    real, h = np.ones((5, 3), bool), np.zeros((3, 4))

    def loss():
        before, last, _ = net.states(h, i)
        return -net.predict(np.concatenate([before[1:], last[None]])[real], t[real]).mean()
    grads, _ = net.gradients(h, i, t, real)
    for n in ("inputs", "recur", "group_w", "class_w", "word_w"):
        w, k = getattr(net, n).reshape(-1), int(np.abs(grads[n]).argmax())
        keep, eps = w[k], 1e-2
        w[k] = keep + eps
        up = loss()
        w[k] = keep - eps
        assert (up - loss()) / (2 * eps) == pytest.approx(float(grads[n].reshape(-1)[k]), rel=0.05)
        w[k] = keep


def test_lm_slots_of_different_lengths():
    shape = lm_scoring.Shape(hidden=4, head_classes=3, head_words=40, tail_classes=2)
    vocab = lm_scoring.Vocabulary(shape, {b"w%d" % i: i for i in range(40)})
    net, rng = lm_scoring.Network(vocab), np.random.default_rng(6)
    i, t = rng.integers(0, vocab.symbols, (7, 5)), rng.integers(0, vocab.symbols, (7, 5))
    h, lengths = rng.normal(size=(5, 4)).astype("f4"), [3, 7, 1, 7, 5]
    real = np.arange(7)[:, None] < np.array(lengths)
    grads, last = net.gradients(h, i, t, real)
    alone = [net.gradients(h[[j]], i[:n, [j]], t[:n, [j]], real[:n, [j]]) for j, n in enumerate(lengths)]
    for name in ("inputs", "recur", "group_w", "class_w", "word_w"):
        whole = sum(g[name] * n for (g, _), n in zip(alone, lengths)) / sum(lengths)
        assert np.allclose(grads[name], whole, atol=1e-6)
    assert np.allclose(last, np.concatenate([x for _, x in alone]), atol=1e-6)


def test_lm_models_are_added_up_in_a_tree(spark):
    # nine shards, two at a time: the same weights as in one step, from all tokens
    shape = lm_scoring.Shape(hidden=4, head_classes=3, head_words=9, tail_classes=2)
    vocab = lm_scoring.Vocabulary(shape, {b"w%d" % i: i for i in range(9)})
    rows = spark.range(0, 180, 1, 9).selectExpr("concat_ws(' ', transform(sequence(0, id % 40), i -> concat('w', (i * id) % 11))) AS text")
    made = [lm_scoring._train(rows, vocab, lm_scoring.Network(vocab).weights(), 0.02, 16, 9, fan=fan) for fan in (2, 64)]
    assert made[0][1] == made[1][1] == sum(i % 40 + 2 for i in range(180))
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(made[0][0], made[1][0]))


def test_models_come_to_the_driver_a_part_at_a_time(spark, monkeypatch):
    rows = spark.createDataFrame([(f"w{i % 5} w{i % 3}",) for i in range(40)], "text string").repartition(3)
    vocab = lm_scoring.Vocabulary(lm_scoring.Shape(hidden=4, head_classes=2, head_words=5, tail_classes=2),
                                  {b"w%d" % i: i for i in range(5)})
    start = lm_scoring.Network(vocab).weights()

    def collect(self):
        raise AssertionError("the whole model is collected at once")
    monkeypatch.setattr(type(rows), "collect", collect)
    weights, seen = lm_scoring._train(rows, vocab, [w.copy() for w in start], 0.02, 16, 3)
    assert seen == 120 and not np.array_equal(weights[0], start[0])


def test_a_network_of_given_weights_draws_none(monkeypatch):
    vocab = lm_scoring.Vocabulary(lm_scoring.Shape(hidden=4, head_classes=2, head_words=5, tail_classes=2),
                                  {b"w%d" % i: i for i in range(5)})
    weights = lm_scoring.Network(vocab).weights()
    monkeypatch.setattr(np.random, "default_rng", None)
    assert all(a is b for a, b in zip(lm_scoring.Network.of(vocab, weights).weights(), weights))


def test_lm_words_of_a_column():
    # read as Arrow arrays: the same words and symbols as text by text
    rng = random.Random(8)
    signs = [" ", "\t", "\x0b", "\x0c", "\x1c", "\x85", "\u3000", "A", "b", "Zz", "\u0130", "\u00c9", "longer", "\U0001f600"]
    some = [None, "", "  ", " a", "a "] + ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(300)]
    want = [lm_scoring.tokens(t) for t in some]
    column = pa.array([None, *some, "cut off"]).slice(1, len(some))
    for chunk in (1, 100, 1 << 20):
        got = [words.to_pylist()[lo:hi] for words, cuts in lm_scoring.word_lists(column, chunk) for lo, hi in zip(cuts, cuts[1:])]
        assert got == want
    head = {w: i for i, w in enumerate(sorted({w for words in want[:60] for w in words}))}
    vocab = lm_scoring.Vocabulary(lm_scoring.Shape(hidden=4, head_classes=3, head_words=len(head), tail_classes=7), head)
    symbols = list(lm_scoring.symbols_of(vocab, iter([column, column.slice(0, 0)])))
    assert [s.tolist() for s in symbols] == [[*map(vocab.symbol, words), vocab.end] for words in want]
    assert any(vocab.symbol(w) >= len(head) for words in want for w in words)


def test_lm_gradients_of_classes_side_by_side_come_as_one_run():
    shape = lm_scoring.Shape(hidden=4, head_classes=5, head_words=60, tail_classes=2)
    vocab = lm_scoring.Vocabulary(shape, {b"w%d" % i: i for i in range(60)})
    net, rng = lm_scoring.Network(vocab), np.random.default_rng(9)
    t = rng.integers(vocab.bounds[1], 60, (40, 6))
    t[(t >= vocab.bounds[2]) & (t < vocab.bounds[3])] = vocab.end       # class 2 is not used
    i, real, h = np.roll(t, 1, 0), np.ones(t.shape, bool), np.zeros((6, 4), "f4")
    sums = np.empty_like(np.asfortranarray(net.word_w))
    _, rows, _ = net.row_gradients(h, i, t, real, sums)
    found = [(r.start, r.stop) for name, r, _, _ in rows if name == "word_w"]
    assert found == [(vocab.bounds[1], vocab.bounds[2]), (vocab.bounds[3], 60)]
    whole = net.gradients(h, i, t, real)[0]["word_w"]
    for name, r, g, times in rows:
        if name == "word_w":
            assert np.shares_memory(g, sums) and np.allclose(g, whole[r], atol=1e-7)
            of = vocab.class_of(np.arange(r.start, r.stop))
            assert times.tolist() == np.bincount(vocab.class_of(t.reshape(-1)), minlength=vocab.classes)[of].tolist()


def test_lm_row_sums():
    rng = np.random.default_rng(7)
    ids = np.concatenate([rng.integers(0, 300, 900), np.full(500, 7), np.full(16, 400), np.full(17, 401)])
    values = rng.normal(size=(len(ids), 3))
    found, sums, times = lm_scoring.row_sums(ids, values)
    assert sorted(found) == sorted(set(ids))
    for k, x, n in zip(found, sums, times):
        assert n == (ids == k).sum() and np.allclose(x, values[ids == k].sum(0))


def test_windows_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(4)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 10, 11, 14]))) for i in range(40)}
    items = {i: t for i, t in items.items() if len(t.split()) > 4} | {100: "W0-w1!w2", 101: "é"}
    docs = [(i, " ".join(rng.choices([*vocabulary, "é", "W0,"], k=rng.randint(0, 300)))) for i in range(30)]
    frame = documents(spark, [(*d, None, None, None) for d in docs])
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    one = {r["doc_id"]: r for r in decontamination.find(frame, bench).collect()}
    many = {r["doc_id"]: r for r in decontamination.find(frame, bench, block_bytes=200).collect()}
    clean = {r["doc_id"] for r in decontamination.remove_contaminated(frame, bench, block_bytes=200).collect()}
    for d, t in docs:
        n, hit, found = brute.hits(t, items)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        for got in (one[d], many[d]):
            assert (got["n_words"], got["n_hit"], got["n_items"], got["items_sha256"]) == (n, hit, len(found), sha)
        assert (d in clean) == (hit == 0)


@pytest.mark.parametrize("bits", [2, 6, 14])
def test_shard_capacity_is_that_of_single_groups(spark, bits):
    # a hot text, copies and sizes far apart; the search may begin with ranges far larger than a group
    rng = random.Random(bits)
    some = [f"{i} " + "x" * rng.choice([1, 5, 30, 200, 900]) for i in range(700)]
    whole = some + ["hot " * 30] * 900 + rng.choices(some, k=300) + [None, ""]
    rows = sharding.shard_by_bytes(spark.createDataFrame(list(enumerate(whole)), "doc_id long, text string"), bits=bits).collect()
    groups = Counter()
    for t in whole:
        raw = (t or "").encode()
        groups[hashlib.md5(raw).hexdigest()[:15]] += len(raw) + 1
    sizes = [n for _, n in sorted(groups.items())]

    def needed(capacity):
        n, fill = 1, 0
        for s in sizes:
            n, fill = (n, fill + s) if fill + s <= capacity else (n + 1, s)
        return n
    best = next(c for c in range(max(max(sizes), -(-sum(sizes) // 16)), sum(sizes) + 1) if needed(c) <= 16)
    found = Counter()
    for r in rows:
        found[r["shard"]] += r["size"]
    assert len(rows) == len(whole) and max(found.values()) == best
    assert len({r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"hot " * 30)}) == 1


def test_shard_search_against_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        sizes = [rng.choice([1, 2, 7, 40]) for _ in range(rng.randint(1, 40))]
        shards = rng.randint(1, 6)
        found = sharding.smallest_capacity([0, *itertools.accumulate(sizes)], shards, None)

        def needed(capacity):
            n, fill = 1, 0
            for s in sizes:
                n, fill = (n, fill + s) if fill + s <= capacity else (n + 1, s)
            return n
        assert found == next(c for c in range(max(sizes), sum(sizes) + 1) if needed(c) <= shards)


def test_shards(spark):
    docs = dict(texts(spark))
    rows = sharding.shard_by_bytes(table(spark, "documents"), cell_rows=7).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    size, slots, home = Counter(), defaultdict(list), {}
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert home.setdefault(raw, r["shard"]) == r["shard"] and 0 <= r["shard"] < 16
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for t in docs.values():
        raw = (t or "").encode()
        groups[hashlib.md5(raw).hexdigest()[:15]] += len(raw) + 1
    ordered = [groups[k] for k in sorted(groups)]

    def needed(capacity):
        n, fill = 1, 0
        for g in ordered:
            n, fill = (n, fill + g) if fill + g <= capacity else (n + 1, g)
        return n
    best = next(c for c in range(max(ordered), sum(ordered) + 1) if needed(c) <= 16)
    assert max(size.values()) == best


def test_spans_against_brute_force(spark):
    rng = random.Random(9)
    bits = ["a", "B.", "@", "x@y.z", "1", "12", "255", "256", ".", "-", " ", "+1", "+49", "(456)", "4111111111111111",
            "4111 1111-1111 1111", "00010.2.3.4", "_%", "é", "\n", "_q@r.s.t", "9.8.7.6.5.4.3.2"]
    docs = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(400)]
    rows = {r["doc_id"]: r for r in pii.detect(documents(spark, [(*d, None, None, None) for d in docs]), threshold=2.0).collect()}
    for d, t in docs:
        spans = brute.base_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert (rows[d]["spans"], rows[d]["base_sha256"]) == (joined, hashlib.sha256(joined.encode()).hexdigest()), t
        assert [rows[d][f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in spans) for k in brute.KINDS]


def test_span_classifier_adds_obvious_spans(spark):
    docs = [(i, f"call me at phone +1 (456) 555-{1000 + i} or mail u{i}@mail.example.com now", None, None, None) for i in range(60)]
    docs += [(900, "my phone (456) 555-1234 is new", None, None, None), (901, "write to joe (at) example (dot) com today", None, None, None),
             (902, "the numbers 123 456 and 7890 and 555 1234", None, None, None)]
    rows = {r["doc_id"]: r for r in pii.detect(documents(spark, docs)).collect()}
    assert rows[900]["spans"] == "phone:9:23" and rows[901]["spans"] == "email:9:35" and rows[902]["spans"] == ""
    assert rows[900]["n_phone"] == 0 and rows[900]["n_added"] == 1


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    docs = texts(spark) + [(10**6, None), (10**6 + 1, "A b <|endoftext|> é it's"), (10**6 + 2, "word " * 5000),
                           (10**6 + 3, "e\u0301te\u0301 \u0130stanbul \ufb01x a\u00a0b \u200b \u0301x \x1c \x85y \U0001F600\U0001F600 \ud55c\uae00")]
    frame = documents(spark, [(*d, None, None, None) for d in docs])
    rows = packing.pack(frame, partition_rows=50).collect()
    by_doc, by_seq = defaultdict(dict), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]][r["piece"]] = r
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        cut = [ids[i:i + 2048] for i in range(0, len(ids), 2048)]
        assert sorted(by_doc[d]) == list(range(len(cut)))
        for n, part in enumerate(cut):
            r = by_doc[d][n]
            assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * n, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    lengths = np.array([r["length"] for r in rows])
    assert len(by_seq) <= packing.lower_bound(lengths, 2048) + 1
    assert {r["gap"] for r in rows} <= {0, 1}
    with pytest.raises(ValueError, match="white space"):
        packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_many_partitions_reach_the_bound(spark):
    frame = table(spark, "documents", "/root/testdata/sf0.01")
    rows = packing.pack(frame, partition_rows=40)
    lengths = np.array([r["length"] for r in rows.select("length").collect()])
    bins = rows.select("sequence_id").distinct().count()
    assert bins <= packing.lower_bound(lengths, 2048) * 1.005 + 1


def test_encoder_agrees_with_the_tokenizer_on_odd_strings():
    import public_tokenizers
    enc = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    bits = ["a", "B", "é", "É", "\u0130", "ß", ".", ",", "!", "'s", "'", "1", "²", "\ufb01", " ", "  ", "\n", "x\u0301",
            "\u0301", "\ud55c", "\u200b", "\U0001F600", "...", "?!", "<|endoftext|>", "\u01c5", "\u0149", "ª", "word", "The"]
    some = ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(4000)]
    for _ in range(2):      # new strings, then known ones
        for t, ids in zip(some, enc.encode(some)):
            assert np.frombuffer(ids, "<u4").tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, ascii(t)


def test_lower_bound_is_one():
    rng = np.random.default_rng(0)
    for _ in range(60):
        x = rng.integers(1, 21, 9)
        assert packing.lower_bound(x, 20) <= len(packing.best_fit_decreasing(x, 20)[2])
    assert packing.lower_bound(np.array([11] * 5), 20) == 5


def test_join_against_brute_force(spark):
    docs = texts(spark)
    rng = random.Random(3)
    some = [t for _, t in docs if t and len(t.split()) > 60][:20]
    for n, t in enumerate(some):       # near copies around the threshold
        for k in (1, 3, 8):
            w = t.split()
            for _ in range(max(1, len(w) * k // 100)):
                w[rng.randrange(len(w))] = "changed"
            docs.append((10**6 + 10 * n + k, " ".join(w)))
    frame = documents(spark, [(*d, None, None, None) for d in docs])
    want = brute.classes(docs)
    for chunk in (1024, 4):
        got = {r["doc_id"]: r for r in ngram_join.join(frame, chunk=chunk).collect()}
        assert {d: (r["class_id"], r["n_links"]) for d, r in got.items()} == want


def test_pruning_keeps_what_can_reach_the_threshold():
    least = ngram_join.least_matches(0.8, 1e-4)
    assert all(least[n] <= 0.8 * n for n in least) and least[125] > 125 * 0.5
    x = np.random.default_rng(1).integers(0, 9, (50, 125)).astype("u2")
    x[7] = x[0]
    assert ngram_join.surviving(x[0], x, least).tolist() == [0, 7]


def test_folding_and_exceptions():
    assert toxicity.fold("1d10t ÉТОС") == "idiot etoc" and len(toxicity.fold("ﬁx İ")) == len("ﬁx İ")
    lex = toxicity.Lexicon({"idiot": 3.0, "trash": 2.0}, ["trash can"], (1, 1, -3))
    auto = lex.automaton()
    assert toxicity.weigh(auto, "An 1D1OT, an idiots trash") == (8.0, 3, 5)
    assert toxicity.weigh(auto, "the trash can is full")[:2] == (0.0, 0) and toxicity.weigh(auto, "10107 x")[0] == 0


def test_exception_phrases_end_at_a_word():
    lex = toxicity.Lexicon({"trash": 2.0, "canoe": 1.0, "xq": 4.0, "idiot": 3.0}, ["trash can", "xq is", "no stem"], (1, 1, -3))
    auto = lex.automaton()
    weights = {"the trash canoe": 3.0, "the trash can": 0.0, "trash can idiot": 3.0, "trash cans": 2.0, "the trash": 2.0,
               "xq is": 0.0, "xq isnt": 4.0, "xq": 4.0, "no stems idiot": 3.0, "no stem idiot": 3.0, "trash canidiot": 2.0,
               "trash cane idiot trash can": 5.0}
    assert {t: toxicity.weigh(auto, t)[0] for t in weights} == weights


def test_short_toxic_words_are_learned_as_whole_words():
    rng = random.Random(2)
    plain = [f"plain{chr(97 + i)}" for i in range(26)] + ["zogan", "xqmany"]
    rows = [{"text": " ".join(rng.choices(plain, k=30) + [f"one{i}"] + (["zog, xq!"] if i % 2 else [])), "label": i % 2}
            for i in range(400)]
    lex = toxicity.learn(rows)
    assert {"zog", "xq"} <= set(lex.weights)
    auto = lex.automaton()
    assert [toxicity.weigh(auto, t)[1] for t in ("zog", "a ZOG xq b", "zogan xqmany", "xq zogs")] == [1, 2, 0, 1]
    assert toxicity.probability(lex, auto, "plaina xq plainb") > 0.5 > toxicity.probability(lex, auto, "plaina xqmany")


def test_labelled_samples_are_those_before_the_cut():
    from inspect import signature

    from shoplens.llm import quality
    bounds = [signature(m.train).parameters["max_training_rows"].default for m in (toxicity, quality)]
    assert bounds == [20_000, 10_000]


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as P
    model = toxicity.train(table(spark, "documents"), table(spark, "labels"))
    auto = model.automaton()
    docs = [(d, t) for d, t in texts(spark) if toxicity.probability(model, auto, t) < 0.3]
    of = brute.classes(docs)
    docs = [(d, t) for d, t in docs if of[d][0] == d]
    items = {r["item_id"]: r["text"] for r in table(spark, "benchmark").collect()}
    docs = [(d, brute.redact(t)) for d, t in docs if not brute.hits(t, items)[1]]
    enc = packing.Encoder(__import__("public_tokenizers").path("word_bpe_49k.json"))
    want = Counter()
    for (d, _), ids in zip(docs, enc.encode([t for _, t in docs])):
        ids += bytes(4)
        want.update((d, i // 8192, zlib.crc32(ids[i:i + 8192])) for i in range(0, len(ids), 8192))
    got = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in P.run(spark, SF).collect())
    assert got == want
