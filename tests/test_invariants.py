"""Invariants from the survey's test plan, on the sf0.01 test data, plus a
property test of the exact HALF_UP ratio."""

from fractions import Fraction
import random

from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.operators import categories as C, funnel as FN, sampling as SM, sessions as S
from shoplens.plans.defaults import QUERY_PARAMS as P
from shoplens.sources.binding import Tables

SF = "/root/testdata/sf0.01"


def test_histogram_sums_to_sessions_with_length(spark):
    t = Tables(spark, SF)
    fs = S.filtered_sessions(t.actions("B2"), t.users(), P)
    total = sum(r.session_count for r in S.bucket_counts(fs, "visit").collect())
    assert total == fs.where(F.col("visit_length") >= 1).count()
    steps = sum(r.session_count for r in S.bucket_counts(fs, "step").collect())
    assert steps == fs.count()


def test_sample_within_quota_and_distinct(spark):
    t = Tables(spark, SF)
    fs = S.filtered_sessions(t.actions(), t.users(), P)
    p = P.with_(allocation="largest_remainder")
    sample = SM.random_extract(fs, p)
    rows = sample.collect()
    assert len(rows) == len({r.sessionid for r in rows}) > 0
    per_hour = sample.groupBy(F.substring("startTime", 1, 10).alias("date"),
                              F.substring("startTime", 12, 2).alias("hour")).count()
    quota = SM.sample_quota(SM.hourly_counts(fs), p)
    over = per_hour.join(quota, ["date", "hour"]).where(F.col("count") > F.col("quota")).count()
    assert over == 0
    per_day = quota.groupBy("date").agg(F.sum("quota").alias("q")).collect()
    days = len(per_day)
    # the sample size is spread over the days as a whole: a day gets its share rounded down or up
    assert all(r.q <= -(-p.sample_size // days) for r in per_day)


def test_funnel_counts_bounded_by_pairs(spark):
    acts = S.actions_by_date(Tables(spark, SF).actions(), P)
    pairs = FN.page_pairs(acts, P)
    n_pairs = pairs.count()
    assert n_pairs == acts.count() - acts.select("session_id").distinct().count()
    rates = FN.page_convert_rate(acts, P).collect()
    assert sum(r.n for r in rates) <= n_pairs


def test_top_sessions_ranks_have_no_gaps(spark):
    t = Tables(spark, SF)
    rows = S.session_full_info(C.session_rows(S.actions_by_date(t.actions(), P)), t.users())
    sc = C.session_category_counts(S.filter_sessions(rows, P))
    top = C.top_categories(C.category_totals(sc), P)
    ts = C.top_sessions_from_counts(sc, top, P)
    per_cat = {r.categoryid: r["count"] for r in ts.groupBy("categoryid").count().collect()}
    assert len(per_cat) == P.top_categories and all(1 <= n <= P.top_sessions for n in per_cat.values())


def test_ratio_half_up_matches_exact_rational_rounding(spark):
    rnd = random.Random(11)
    pairs = [(k, n) for n in [rnd.randrange(1, 10**6) for _ in range(300)] for k in [rnd.randrange(0, n + 1)]]
    pairs += [(57, 200), (1, 200), (5, 1000), (0, 1)]
    df = spark.createDataFrame(pairs, "k long, n long")
    got = {(r.k, r.n): r.v for r in df.select("k", "n", X.ratio_half_up("k", "n").alias("v")).collect()}

    def exact(k, n):
        q = Fraction(k, n) * 100
        return int(q + Fraction(1, 2)) / 100  # floor(x + 1/2) = HALF_UP for x >= 0

    assert all(got[(k, n)] == exact(k, n) for k, n in pairs)
