from pyspark.sql import functions as F

from helpers import actions_df, at, users_df
from shoplens.operators import sessions as S
from shoplens.params import TaskParams

P = TaskParams(start_date="2019-06-01", end_date="2019-06-30")

VISITS = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def bucket_sessions(spark):
    rows = []
    for i, v in enumerate(VISITS):  # two actions, v seconds apart
        rows += [dict(session_id=f"v{i}", action_time=at(0)), dict(session_id=f"v{i}", action_time=at(v))]
    for i, n in enumerate(STEPS):  # n actions within one second
        rows += [dict(session_id=f"s{i}", action_time=at(0)) for _ in range(n)]
    return S.session_profile(actions_df(spark, rows))


def test_visit_bucket_edges(spark):
    prof = bucket_sessions(spark).where(F.col("session_id").startswith("v"))
    got = {r.bucket: r.session_count for r in S.bucket_counts(prof, "visit").collect()}
    assert got == {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
                   "3m_10m": 2, "10m_30m": 2, "30m": 1}  # 0 s falls in no bucket


def test_step_bucket_edges(spark):
    prof = bucket_sessions(spark).where(F.col("session_id").startswith("s"))
    got = {r.bucket: r.session_count for r in S.bucket_counts(prof, "step").collect()}
    assert got == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 1}


def test_aggr_stat_ratios(spark):
    prof = bucket_sessions(spark).where(F.col("session_id").startswith("v"))
    r = S.session_aggr_stat(prof, P.with_(task_id="t1")).first()
    assert r.taskid == "t1" and r.session_count == 18
    assert r.visit_length_1s_3s_ratio == 0.11  # 2/18
    assert r.visit_length_30m_ratio == 0.06  # 1/18 = 0.0555.. -> 0.06
    assert r.step_length_1_3_ratio == 1.0  # every visit session has 2 steps -> 1_3
    assert r.step_length_60_ratio == 0.0


def test_profile_lists_and_order(spark):
    rows = [
        dict(session_id="a", action_time=at(50), search_keyword="abc", user_id=9),
        dict(session_id="a", action_time=at(10), search_keyword="ab", user_id=3),
        dict(session_id="a", action_time=at(30), click_category_id=57),
        dict(session_id="a", action_time=at(20), click_category_id=44),
        dict(session_id="a", action_time=at(40), click_category_id=48),
        dict(session_id="a", action_time=at(45), click_category_id=44),
        dict(session_id="a", action_time=at(46), search_keyword=""),
    ]
    r = S.session_profile(actions_df(spark, rows)).first()
    assert r.search_keywords == "ab,abc"
    assert r.click_category_ids == "44,48,57"
    assert r.user_id == 1  # smallest user id (default rows have user 1)
    assert r.visit_length == 40 and r.step_length == 7
    assert r.start_time == "2019-06-10 10:00:10"


def test_profile_numeric_category_order(spark):
    rows = [dict(session_id="a", click_category_id=c) for c in (100, 9, 20)]
    assert S.session_profile(actions_df(spark, rows)).first().click_category_ids == "9,20,100"


def _full(spark):
    acts = actions_df(spark, [
        dict(session_id="s1", user_id=1, search_keyword="k1", click_category_id=-1),
        dict(session_id="s2", user_id=2, click_category_id=5),
        dict(session_id="s3", user_id=3, search_keyword="k2"),
        dict(session_id="s4", user_id=4),
        dict(session_id="s5", user_id=99),  # no such user: dropped by the inner join
    ])
    users = users_df(spark, [
        dict(user_id=1, age=20, professional="dev", city="c=1", sex="male"),
        dict(user_id=2, age=50, professional="ops|x", city="c2", sex="female"),
        dict(user_id=3, age=None, professional=None, city=None, sex=None),
        dict(user_id=4, age=51, professional="", city="", sex=""),
    ])
    return S.session_full_info(S.session_profile(acts), users)


def ids(df):
    return sorted(r.session_id for r in df.select("session_id").collect())


def test_filters_each_on_and_off(spark):
    full = _full(spark)
    assert ids(S.filter_sessions(full, P)) == ["s1", "s2", "s3", "s4"]
    assert ids(S.filter_sessions(full, P.with_(start_age=20, end_age=50))) == ["s1", "s2"]
    assert ids(S.filter_sessions(full, P.with_(start_age=20))) == ["s1", "s2", "s3", "s4"]  # one bound: no filter
    assert ids(S.filter_sessions(full, P.with_(professionals="dev,ops|x"))) == ["s1", "s2"]
    assert ids(S.filter_sessions(full, P.with_(cities=["c=1"]))) == ["s1"]
    assert ids(S.filter_sessions(full, P.with_(sex="female"))) == ["s2"]
    assert ids(S.filter_sessions(full, P.with_(sex=""))) == ["s1", "s2", "s3", "s4"]
    assert ids(S.filter_sessions(full, P.with_(keywords="k2,zz"))) == ["s3"]
    assert ids(S.filter_sessions(full, P.with_(category_ids="5,6"))) == ["s2"]
    both = P.with_(start_age=20, end_age=50, sex="male", keywords=["k1"])
    assert ids(S.filter_sessions(full, both)) == ["s1"]


def test_filtered_actions_and_date_range(spark):
    acts = actions_df(spark, [
        dict(session_id="s1", user_id=1, date="2019-06-10"),
        dict(session_id="s1", user_id=1, date="2019-07-10"),
        dict(session_id="s2", user_id=2, date="2019-06-10"),
    ])
    users = users_df(spark, [dict(user_id=1, age=30), dict(user_id=2, age=70)])
    p = P.with_(start_age=20, end_age=50)
    fs = S.filtered_sessions(acts, users, p)
    fa = S.filtered_actions(acts, fs, p).collect()
    assert [(r.session_id, r.date) for r in fa] == [("s1", "2019-06-10")]


def test_missing_date_raises(spark):
    import pytest
    acts = actions_df(spark, [dict()])
    with pytest.raises(ValueError):
        S.actions_by_date(acts, TaskParams())


def test_member_filter_reads_data_as_csv(spark):
    acts = actions_df(spark, [dict(session_id="a", user_id=1), dict(session_id="b", user_id=2),
                              dict(session_id="c", user_id=3)])
    users = users_df(spark, [dict(user_id=1, professional="dev,ops"), dict(user_id=2, professional="-1"),
                             dict(user_id=3, professional="qa")])
    full = S.session_full_info(S.session_profile(acts), users)
    assert ids(S.filter_sessions(full, P.with_(professionals="ops,qa"))) == ["a", "c"]
    assert ids(S.filter_sessions(full, P.with_(professionals="-1"))) == []
