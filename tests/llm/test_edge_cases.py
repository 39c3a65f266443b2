"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

import pytest

from fixtures import ROWS, documents, empty, table
from shoplens.llm import (decontamination, language_id, lm_scoring, mixing, neighbours, ngram_join, packing, pii, quality,
                          resampling, sharding, spelling, toxicity)

ITEMS = [(1, "three four five six seven eight nine ten eleven twelve"), (2, "two three four five six seven eight nine ten eleven"),
         (3, ""), (4, None), (5, "été über"), (None, "one"), (2, "two three four five six seven eight nine ten eleven")]


def labels(spark, rows=((5, 1, 0), (7, 0, 1), (7, 0, None), (None, 1, 1), (8, 1, 1), (8, 0, 0))):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


RUNS = {
    "op1": lambda s, d: language_id.predict(d, language_id.train(d)),
    "op2": lambda s, d: lm_scoring.score(d),
    "op3": lambda s, d: decontamination.find(d, s.createDataFrame(ITEMS, "item_id long, text string")),
    "op4": lambda s, d: sharding.shard_by_bytes(d),
    "op5": lambda s, d: pii.detect(d),
    "op6": lambda s, d: quality.score(d, quality.train(d, labels(s))),
    "op7": lambda s, d: packing.pack(d),
    "op9": lambda s, d: ngram_join.join(d),
    "op10": lambda s, d: toxicity.score(d, toxicity.train(d, labels(s))),
    "op11": lambda s, d: mixing.repetitions(d, ["doc_id", *d.columns[5:]]).select("kept.doc_id", "*"),
    "op12": lambda s, d: resampling.resample(d, s.createDataFrame(ITEMS, "item_id long, text string"), d.columns),
}


@pytest.mark.parametrize("op", RUNS)
def test_every_row_gets_its_result(spark, op):
    out = RUNS[op](spark, documents(spark)).collect()
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in out if op != "op7" or r["piece"] == 0)
    assert ids == sorted(r[0] if r[0] is not None else -1 for r in ROWS)


@pytest.mark.parametrize("op", RUNS)
def test_empty_table(spark, op):
    assert RUNS[op](spark, empty(spark)).collect() == []


def test_words_of_awkward_texts(spark):
    got = {r["word"]: (r["n"], r["form"]) for r in spelling.variants(documents(spark)).collect()}
    assert got == {} or all(n >= 2 and len(w) >= 7 for w, (n, _) in got.items())
    assert spelling.variants(empty(spark)).collect() == []
    rows = [(None, "Letters letters lettersx", None, None, None)] * 3 + [(1, "x" * 30_000, None, None, None)] * 2
    got = {r["word"]: (r["n"], r["n_near"]) for r in spelling.variants(documents(spark, rows), modulus=10**9).collect()}
    assert got == {"letters": (6, 1), "lettersx": (3, 1), "x" * 30_000: (2, 0)}


def test_mix_and_draw_pass_columns_through(spark):
    rows, items = documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    for made in (lambda d: mixing.mix(d), lambda d: resampling.draw(d, items, percent=100, least_words=0)):
        assert made(rows).dtypes == rows.dtypes and made(empty(spark)).collect() == []
    assert resampling.draw(rows, items, percent=100, least_words=0).count() == len(ROWS)
    assert resampling.draw(rows, items.limit(0), percent=100).count() == 2     # the long text and the one of row 7 have 20 words


def test_defined_results(spark):
    rows = documents(spark)
    und = {r["doc_id"]: r for r in RUNS["op1"](spark, rows).collect()}
    assert all(und[i]["lang_pred"] == "und" and und[i]["score"] == 0 for i in (1, 2, 3, 10))
    signs = documents(spark, [(i, t, None, None, None) for i, t in enumerate(["½ ² ①", "Ⅳ ٣", "1½ x"])])
    model = language_id.train(rows)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(signs, model).collect()}
    assert got[0] == got[1] == "und" != got[2]
    assert und[8]["lang_pred"] in ("en", "es")
    found = {r["doc_id"]: r for r in RUNS["op3"](spark, rows).collect()}
    assert (found[1]["n_words"], found[1]["n_hit"], found[4]["n_words"]) == (0, 0, 80_000)
    assert (found[5]["n_hit"], found[5]["items"], found[8]["items"]) == (10, [2], [5])
    joined = {r["doc_id"]: r for r in RUNS["op9"](spark, rows).collect()}
    assert joined[6]["class_id"] == 5 and joined[6]["n_links"] == 2 and joined[5]["n_linked_sets"] == 0
    assert joined[1]["class_id"] == 1 and joined[2]["class_id"] == 2 and joined[None]["class_id"] is None
    spans = {r["doc_id"]: r for r in RUNS["op5"](spark, rows).collect()}
    assert spans[7]["spans"] == "email:5:22,email:79:85,ip:68:76,card:45:64,phone:26:43"


def test_redaction_leaves_everything_else_alone(spark):
    texts = ["a\u0001b", "\u0001\u0001 x@y.de\u0001\u0001\u0001+49 123 456 789\u0002\u0001", "\u0002\u0001\u0002", "x@y.de\u0002"]
    want = ["a\u0001b", "\u0001\u0001 <EMAIL>\u0001\u0001\u0001<PHONE>\u0002\u0001", "\u0002\u0001\u0002", "<EMAIL>\u0002"]
    docs = spark.createDataFrame([(i, t, "kept", "kept", 1, "kept", "kept") for i, t in enumerate(texts)],
                                 "doc_id long, text string, __text string, value string, parts int, row string, `a.b` string")
    got = pii.redact(docs)
    assert got.dtypes == docs.dtypes
    assert [tuple(r)[1:] for r in got.orderBy("doc_id").collect()] == [(t, "kept", "kept", 1, "kept", "kept") for t in want]
    spans = {r["doc_id"]: r["spans"] for r in pii.detect(docs).collect()}
    assert spans[1] == "email:3:9,phone:12:27" and spans[0] == ""


def test_texts_with_very_many_numbers_are_read_in_linear_time(spark):
    import time
    numbers = lambda n: ", ".join(str(10 + i % 90) for i in range(n))
    seconds = []
    for n in (1_000, 128_000):
        docs = spark.createDataFrame([(1, numbers(n) + ", 4111 1111 1111 1111"), (2, "a@b.cd " * (n // 4))], "doc_id long, text string")
        start = time.time()
        got = {r["doc_id"]: r for r in pii.detect(docs).collect()}
        seconds.append(time.time() - start)
        assert got[1]["spans"] == f"card:{4 * n}:{4 * n + 19}" and got[2]["n_email"] == n // 4
        assert got[2]["spans"].endswith(f"email:{7 * (n // 4) - 7}:{7 * (n // 4) - 1}")
    assert seconds[1] < seconds[0] + 60, seconds


def test_repeated_rows_are_dealt_to_several_partitions(spark):
    docs = spark.range(3000).selectExpr("cast(null AS long) AS doc_id", "repeat('word ', 300) AS text")
    rows = packing.pack(docs, partition_rows=100)
    parts = rows.selectExpr("(sequence_id >> 24) AS part").groupBy("part").count().collect()
    assert len(parts) > 10 and max(r["count"] for r in parts) < 400
    assert rows.count() == 3000 and rows.select("sequence_id").distinct().count() <= 501


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, None, 1), (4, [], 1),
            (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (None, [1.0, 0.1], 1),
            (9, [4.0, 4.0], 1), (10, [1.0], 1), (100, [0.0, 0.0], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    got = neighbours.search(spark.createDataFrame(rows, schema)).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 0.0), (0, 2, 0.0), (0, 9, 5.0)]
    assert neighbours.search(spark.createDataFrame([], schema)).collect() == []
    # a repeated query id is one query, that of its smallest vector
    rows = [(0, [9.0, 9.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [9.0, 9.0], 1), (2, [1.0, 1.0], 1)]
    got = neighbours.search(spark.createDataFrame(rows, schema)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got][:2] == [(0, 1, 1, 0.0), (0, 2, 2, 1.0)] and len(got) == 3


def test_pipeline_stages_keep_columns(spark):
    import corpus_pipeline as P
    rows, sf = documents(spark), "/root/testdata/sf0.001"
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == rows.columns and out.dtypes == rows.dtypes, name
        ids = [r["doc_id"] for r in out.collect()]
        assert set(ids) <= {r[0] for r in ROWS} and stage(spark, empty(spark), sf).collect() == []
        if name == "ngram_join":
            assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11] and None in ids
        if name == "pii":
            by = {r["doc_id"]: r for r in out.collect()}
            assert by[7]["text"] == "mail <EMAIL> or <PHONE>, <CARD> at <IP>\u0001\U0001F600 <EMAIL>"
            assert by[7]["n_chars"] == len(by[7]["text"]) and by[1]["text"] is None and by[2]["text"] == ""
    assert table(spark, "documents").columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_workers_hold_few_texts_at_a_time(spark):
    import corpus_pipeline as P
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows, found = documents(spark, [(i, f"text {i}", None, None, None) for i in range(2500)]).coalesce(1), []

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])
    try:
        for setting, most in (("10000", 1000), ("0", 1000), ("300", 300)):
            spark.conf.set(key, setting)
            P.drop_contaminated(spark, rows, "/root/testdata/sf0.001")
            found.append((max(r["n"] for r in rows.mapInArrow(sizes, "n long").collect()), most))
    finally:
        spark.conf.set(key, before)
    assert all(a == b for a, b in found), found


def test_rejecting_builds_its_automaton_once_a_task(spark, monkeypatch):
    made, inner = [], toxicity.Lexicon.automaton
    monkeypatch.setattr(toxicity.Lexicon, "automaton", lambda self: made.append(1) or inner(self))
    monkeypatch.setattr(toxicity, "keep_rows", lambda rows, keep: keep)
    keep = toxicity.reject(documents(spark), toxicity.Lexicon({"vile": 9.0}, [], (10.0, 0.0, -5.0)))
    assert [keep(["vile", None]), keep(["kind"])] == [[False, True], [True]] and len(made) == 1
