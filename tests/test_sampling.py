from collections import Counter

from pyspark.sql import functions as F

from shoplens.operators import sampling as SM
from shoplens.params import TaskParams


def sessions_df(spark, starts):
    rows = [(f"s{i}", t, [], []) for i, t in enumerate(starts)]
    return spark.createDataFrame(rows, "session_id string, start_time string, search_keyword_list array<string>, "
                                       "click_category_list array<bigint>")


def one_day(spark):
    starts = [f"2019-06-10 {h:02d}:{m:02d}:00" for h, n in ((0, 40), (1, 30), (2, 20), (3, 9), (4, 1))
              for m in range(n)]
    return sessions_df(spark, starts)


def test_floor_quota_one_day(spark):
    p = TaskParams(start_date="2019-06-10", end_date="2019-06-10", sample_size=100)
    q = {r.hour: (r.session_count, r.quota) for r in SM.sample_quota(SM.hourly_counts(one_day(spark)), p).collect()}
    # 100 sessions, 100 per day: quota = floor(n / 100 * 100) = n
    assert q == {"00": (40, 40), "01": (30, 30), "02": (20, 20), "03": (9, 9), "04": (1, 1)}
    p2 = p.with_(sample_size=10)
    q2 = {r.hour: r.quota for r in SM.sample_quota(SM.hourly_counts(one_day(spark)), p2).collect()}
    assert q2 == {"00": 4, "01": 3, "02": 2, "03": 0, "04": 0}


def test_largest_remainder_fills_the_day(spark):
    p = TaskParams(start_date="2019-06-10", end_date="2019-06-10", sample_size=10, allocation="largest_remainder")
    q = {r.hour: r.quota for r in SM.sample_quota(SM.hourly_counts(one_day(spark)), p).collect()}
    assert sum(q.values()) == 10 and q["03"] == 1  # remainder 0.9 beats 0.1


def test_extract_invariants_and_reproducible(spark):
    p = TaskParams(start_date="2019-06-10", end_date="2019-06-10", sample_size=10, allocation="largest_remainder")
    sess = one_day(spark)
    a = SM.random_extract(sess, p).collect()
    b = SM.random_extract(sess, p).collect()
    assert sorted(a) == sorted(b)
    ids = [r.sessionid for r in a]
    assert len(ids) == len(set(ids)) == 10
    per_hour = Counter(r.startTime[11:13] for r in a)
    quota = {r.hour: r.quota for r in SM.sample_quota(SM.hourly_counts(sess), p).collect()}
    assert all(per_hour[h] <= quota[h] for h in per_hour)
    other = SM.random_extract(sess, p.with_(sample_seed="other")).collect()
    assert sorted(r.sessionid for r in other) != sorted(ids)


def test_three_days_quota(spark):
    starts = [f"2019-06-{d:02d} 10:{m:02d}:00" for d in (10, 11, 12) for m in range(5)]
    p = TaskParams(start_date="2019-06-10", end_date="2019-06-12", sample_size=10)
    q = SM.sample_quota(SM.hourly_counts(sessions_df(spark, starts)), p).agg(F.sum("quota")).first()[0]
    assert q == 9  # 10 // 3 = 3 per day


def test_session_detail(spark):
    from helpers import actions_df
    acts = actions_df(spark, [dict(session_id="s1"), dict(session_id="s1"), dict(session_id="s2")])
    sample = spark.createDataFrame([("t", "s1", "x", "", "")],
                                   "taskid string, sessionid string, startTime string, searchKeywords string, "
                                   "clickCategoryIds string")
    d = SM.session_detail(acts, sample, TaskParams(task_id="t")).collect()
    assert len(d) == 2 and {r.sessionid for r in d} == {"s1"}


def test_extract_scans_once_and_shuffles_sessions_once(spark):
    from shoplens.plans import catalog
    from shoplens.plans.defaults import QUERY_PARAMS as QP
    sf, p = "/root/testdata/sf0.01", QP.with_(allocation="largest_remainder")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        rows = catalog._filtered(spark, sf, p).select(*SM.SAMPLED_COLUMNS)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("events.parquet") == 1 and plan.count("Exchange hashpartitioning(session_id") == 1
        drawn = catalog._extract(spark, sf, p)
        files = drawn.inputFiles()
        assert files and all("sampled_sessions" in f for f in files)
        # the lists are put together after the draw
        plan = drawn._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("array_join(search_keyword_list") < plan.index("LeftSemi")
        assert "Exchange hashpartitioning(session_id" not in drawn._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert drawn.count() == 100


def test_salted_two_level_draw_is_exact(spark):
    import hashlib
    p = TaskParams(start_date="2019-06-10", end_date="2019-06-10", sample_size=10)
    sess = one_day(spark)
    quota = {r.hour: r.quota for r in SM.sample_quota(SM.hourly_counts(sess), p).collect()}
    rows = [(r.session_id, r.start_time[11:13]) for r in sess.collect()]
    want = set()
    for hour, q in quota.items():
        ids = sorted((hashlib.md5((p.sample_seed + sid).encode()).hexdigest(), sid) for sid, h in rows if h == hour)
        want |= {sid for _, sid in ids[:q]}
    for groups in (1, 3, 32):
        got = {r.sessionid for r in SM.random_extract(sess, p.with_(salt_groups=groups)).collect()}
        assert got == want, groups
