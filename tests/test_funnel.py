import random
from collections import Counter

from helpers import actions_df, at
from shoplens.operators import funnel as FN
from shoplens.params import TaskParams

P = TaskParams(start_date="2019-06-01", end_date="2019-06-30", target_page_flow=(1, 2, 3))


def brute_pairs(rows):
    by = {}
    for r in rows:
        by.setdefault(r["session_id"], []).append(r)
    out = Counter()
    for acts in by.values():
        acts.sort(key=lambda r: (r["_t"], r["event_id"]))
        for a, b in zip(acts, acts[1:]):
            out[(a["session_id"], a["page_id"], b["page_id"])] += 1
    return out


def test_pairs_match_brute_force_across_slices(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        t = rnd.randrange(0, 500)  # many ties and many 10-second slices
        rows.append(dict(session_id=f"s{rnd.randrange(4)}", page_id=rnd.randrange(5), action_time=at(t), event_id=i,
                         _t=t))
    df = actions_df(spark, [{k: v for k, v in r.items() if k != "_t"} for r in rows])
    for width in (10, 3600):
        got = Counter(tuple(r) for r in FN.page_pairs(df, P.with_(pair_slice_seconds=width)).collect())
        assert got == brute_pairs(rows)


def test_pairs_of_one_second_and_of_equal_rows(spark):
    """One session and second hold all actions: they are spread over the ranges, and the pairs are exact."""
    rnd = random.Random(5)
    rows = [dict(session_id="hot", page_id=rnd.randrange(6), action_time=at(9), event_id=i, _t=9) for i in range(3000)]
    rows += [dict(session_id=s, page_id=1, action_time=at(3), event_id=0, _t=3) for s in ("a", "a", "z", None, None)]
    df = actions_df(spark, [{k: v for k, v in r.items() if k != "_t"} for r in rows])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # the rows are few
    try:
        pairs = FN.page_pairs(df, P)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter(tuple(r) for r in pairs.collect()) == brute_pairs(rows)
    stored = spark.read.parquet(*pairs.inputFiles())
    sizes = [r["count"] for r in stored.groupBy((stored["at"] / (1 << 33)).cast("long")).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * len(rows)
    assert FN.page_pairs(df.limit(0), P).count() == 0
    # without an event id equal times are ordered by page
    same = FN.page_pairs(df.where("session_id = 'hot'").drop("event_id"), P).where("from_page > to_page").count()
    assert same == 0


def test_convert_rate_missing_pair_and_single_action(spark):
    rows = [
        dict(session_id="a", page_id=1, action_time=at(0)), dict(session_id="a", page_id=2, action_time=at(1)),
        dict(session_id="b", page_id=1, action_time=at(0)), dict(session_id="b", page_id=2, action_time=at(1)),
        dict(session_id="c", page_id=1, action_time=at(0)),  # single action
        dict(session_id="d", page_id=1, action_time=at(0)),
    ]
    rates = FN.page_convert_rate(actions_df(spark, rows), P).orderBy("step_no").collect()
    assert [(r.step, r.n, r.rate) for r in rates] == [("1_2", 2, 0.5), ("2_3", 0, 0.0)]
    packed = FN.pack_convert_rate(FN.page_convert_rate(actions_df(spark, rows), P), P).first()
    assert packed.convertRate == "1_2=0.50|2_3=0.00"


def test_zero_start_and_self_and_repeated_pairs(spark):
    rows = [dict(session_id="a", page_id=p, action_time=at(i)) for i, p in enumerate([2, 2, 1, 2, 1, 2])]
    p = P.with_(target_page_flow=(3, 2, 2, 1, 2))  # steps 3_2, 2_2, 2_1, 1_2
    r = {x.step: (x.n, x.rate) for x in FN.page_convert_rate(actions_df(spark, rows), p).collect()}
    assert r["3_2"] == (0, None)  # no start-page views: NULL rate
    assert r["2_2"] == (1, None)  # previous step count 0
    assert r["2_1"] == (2, 2.0)
    assert r["1_2"] == (2, 1.0)
    p2 = P.with_(target_page_flow=(1, 2, 1, 2))  # 1_2 listed twice: counted once, reported twice
    r2 = [(x.step_no, x.step, x.n) for x in FN.page_convert_rate(actions_df(spark, rows), p2).orderBy("step_no").collect()]
    assert r2 == [(1, "1_2", 2), (2, "2_1", 2), (3, "1_2", 2)]


def test_start_count(spark):
    rows = [dict(page_id=1), dict(page_id=1), dict(page_id=3)]
    assert FN.page_start_count(actions_df(spark, rows), P).first().n == 2


def test_pair_counts_in_one_pass_match_brute_force(spark):
    rnd = random.Random(11)
    rows = [dict(session_id=f"s{rnd.randrange(3)}", page_id=rnd.randrange(4), action_time=at(t), event_id=i, _t=t)
            for i, t in enumerate(rnd.randrange(0, 300) for _ in range(300))]
    df = actions_df(spark, [{k: v for k, v in r.items() if k != "_t"} for r in rows])
    flow = (1, 2, 3, 1, 2, 2)
    want = Counter()
    for (_, a, b), n in brute_pairs(rows).items():
        if (a, b) in set(zip(flow, flow[1:])):
            want[f"{a}_{b}"] += n
    for width in (7, 100, 3600):  # 3600: every action of a session in one slice
        got = FN.page_pair_count(df, P.with_(target_page_flow=flow, pair_slice_seconds=width)).collect()
        assert {r.step: r.n for r in got} == want
    assert FN.page_pair_count(df, P.with_(target_page_flow=(1,))).count() == 0
    assert FN.page_pair_count(df.limit(0), P).count() == 0
