from collections import Counter

from helpers import actions_df
from shoplens.operators import categories as C
from shoplens.params import TaskParams

P = TaskParams(start_date="2019-06-01", end_date="2019-06-30", task_id="t")


def plain_counts(rows):
    """{(session, category): [clicks, orders, pays]}"""
    out = {}
    for r in rows:
        ids = lambda c: [int(x) for x in (r.get(c) or "").split(",") if x]
        click = r.get("click_category_id", -1)
        for kind, some in enumerate(([] if click in (-1, None) else [click], ids("order_category_ids"), ids("pay_category_ids"))):
            for c in some:
                out.setdefault((r["session_id"], c), [0, 0, 0])[kind] += 1
    return out


def nested_counts(acts):
    return C.session_category_counts(C.session_rows(acts))


def test_multi_action_row_counts_every_source(spark):
    acts = actions_df(spark, [
        dict(session_id="a", click_category_id=1, order_category_ids="1,2,2", pay_category_ids="3"),
        dict(session_id="b", order_category_ids="", pay_category_ids=None),
    ])
    sc = nested_counts(acts)
    got = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in C.category_totals(sc).collect()}
    assert got == {1: (1, 1, 0), 2: (0, 2, 0), 3: (0, 0, 1)}
    assert {r.category_id: r.n for r in C.kind_totals(sc, "order").collect()} == {1: 1, 2: 2}
    assert C.session_rows(acts).where("session_id = 'b'").first().categories == []


def test_top_categories_sort_key_and_ties(spark):
    big = 3_000_000_000  # counts beyond 2^31 keep their order
    rows = [(i, c, o, p) for i, c, o, p in [(1, 5, 0, 0), (2, 5, 1, 0), (3, 5, 1, 1), (4, 5, 1, 1), (5, big, 0, 0)]]
    df = spark.createDataFrame(rows, "category_id long, click_count long, order_count long, pay_count long")
    top = [r.categoryid for r in C.top_categories(df, P.with_(top_categories=4)).collect()]
    assert top == [5, 3, 4, 2]


def test_top_sessions_per_category(spark):
    rows = []
    for cat in (1, 2):
        for sess, n in (("s1", 1), ("s2", 3), ("s3", 3), ("s4", 2)):
            rows += [dict(session_id=sess, click_category_id=cat)] * n
    rows += [dict(session_id="s9", click_category_id=7)] * 10  # not a top category
    acts = actions_df(spark, rows)
    top = spark.createDataFrame([("t", 1, 0, 0, 0), ("t", 2, 0, 0, 0)],
                                "taskid string, categoryid long, clickCount long, orderCount long, payCount long")
    got = [(r.categoryid, r.sessionid, r.clickCount)
           for r in C.top_sessions_from_counts(nested_counts(acts), top, P.with_(top_sessions=3)).collect()]
    assert sorted(got) == sorted([(c, s, n) for c in (1, 2) for s, n in (("s2", 3), ("s3", 3), ("s4", 2))])


def test_nested_counts_equal_plain_ones(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        kind = rnd.randrange(4)
        rows.append(dict(session_id=f"s{rnd.randrange(30)}", search_keyword=rnd.choice(["x", "y", None]),
                         click_category_id=rnd.randrange(8) if kind == 0 else -1,
                         order_category_ids=f"{rnd.randrange(8)},{rnd.randrange(8)}" if kind == 1 else None,
                         pay_category_ids=str(rnd.randrange(8)) if kind == 2 else None))
    want = {k: n for k, n in plain_counts(rows).items() if k[0] < "s2"}
    found = C.session_rows(actions_df(spark, rows)).where(F.col("session_id") < "s2")
    sc = C.session_category_counts(found)
    got = [((r.session_id, r.category_id), [r.click_count, r.order_count, r.pay_count]) for r in sc.collect()]
    assert len(got) == len(want) and dict(got) == want
    total = Counter()
    for (_, c), n in want.items():
        total.update({(c, kind): x for kind, x in enumerate(n)})
    assert {(r.category_id, i): r[i + 1] for r in C.category_totals(sc).collect() for i in range(3)} == total
    for i, kind in enumerate(("click", "order", "pay")):
        assert {r.category_id: r.n for r in C.kind_totals(sc, kind).collect()} == {c: n for (c, k), n in total.items() if k == i and n}
    top = C.top_categories(C.category_totals(sc), P.with_(top_categories=3))
    best = sorted({c for c, _ in total}, key=lambda c: (-total[c, 0], -total[c, 1], -total[c, 2], c))[:3]
    ranked = {(c, s, n[0]) for c in best for (s, x), n in sorted(
        ((k, n) for k, n in want.items() if k[1] == c and n[0]), key=lambda y: (-y[1][0], y[0][0]))[:P.top_sessions]}
    assert {(r.categoryid, r.sessionid, r.clickCount) for r in C.top_sessions_from_counts(sc, top, P).collect()} == ranked


def test_profile_of_session_rows_equals_profile_of_actions(spark):
    import random
    from helpers import at
    from shoplens.operators import sessions as S
    rnd = random.Random(5)
    rows = [dict(session_id=f"s{rnd.randrange(12)}", user_id=rnd.randrange(5), action_time=at(rnd.randrange(3000)),
                 search_keyword=rnd.choice([None, "", " ", "a", "b", "c"]),
                 click_category_id=rnd.choice([-1, None, 3, 20, 100]),
                 order_category_ids=rnd.choice([None, "", "3,3,9"]), pay_category_ids=rnd.choice([None, "20"]))
            for _ in range(400)]
    acts = actions_df(spark, rows)
    got, want = C.session_rows(acts).drop("categories"), S.session_profile(acts)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert C.session_rows(acts.limit(0)).count() == 0
