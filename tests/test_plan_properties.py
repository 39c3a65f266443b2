"""Scale properties of the registered queries, checked on their physical plans."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
STREAM = {k for k in QUERIES if k.endswith("_stream")} | {"sink_roundtrip"}


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAM))
def test_no_cross_products(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["top10_session", "area_top3_product", "ad_province_top3",
                                  "session_random_extract", "session_random_extract_lr"])
def test_per_group_top_k_is_limited_before_the_exchange(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", ["session_profile", "category_full_count", "area_product_click_count",
                                  "ad_stat", "ad_user_click_count", "page_pair_count", "session_aggr_stat"])
def test_aggregates_combine_map_side(spark, name):
    assert "partial_" in _plan(spark, name)


@pytest.fixture
def no_runtime_help(spark):
    """Plans as a large run gets them: nothing is small enough to broadcast, nothing is re-planned."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _exchanges(plan):
    return re.findall(r"Exchange (\w+\([^)]*\))", re.sub(r"#\d+L?", "", plan))


CATEGORY_QUERIES = ["category_ids", "category_click_count", "category_order_count", "category_pay_count",
                    "category_full_count", "top10_category"]


@pytest.mark.parametrize("name", CATEGORY_QUERIES)
def test_category_chain_reads_the_log_and_shuffles_sessions_once(spark, no_runtime_help, name):
    """Every stage: nothing is stored, the profile, the filter and the counts share one exchange by session."""
    df = QUERIES[name](spark, SF)
    assert {f.rsplit("/", 1)[1] for f in df.inputFiles()} <= {"events.parquet", "customer.parquet", "nation.parquet",
                                                             "part.parquet"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") == 1 and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    by = [e for e in _exchanges(plan) if "session_id" in e]
    # one for the (session, category) counts, reduced in the scan tasks, and one for the sessions
    assert sorted(re.sub(r", \d+.*", ")", e) for e in by) == ["hashpartitioning(session_id)", "hashpartitioning(session_id, category_id)"] \
        or [e.startswith("hashpartitioning(session_id") for e in by] == [True, True]
    assert "LeftSemi" not in plan


def test_top_sessions_read_only_the_stored_session_rows(spark, no_runtime_help):
    df = QUERIES["top10_session"](spark, SF)
    assert df.inputFiles() and all("session_categories" in f for f in df.inputFiles())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(e.startswith("hashpartitioning(session_id") for e in _exchanges(plan))
    rows = spark.read.parquet(*df.inputFiles()).count()
    assert 0 < rows < spark.read.parquet(f"{SF}/events.parquet").count()


@pytest.mark.parametrize("name", ["page_convert_rate", "page_pair_count", "page_convert_rate_packed"])
def test_funnel_reads_the_log_once_and_orders_it_once(spark, no_runtime_help, name):
    plan = _plan(spark, name)
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning(session_id") == 2  # by (session, slice); then one row per slice


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top10_category")


@pytest.mark.parametrize("name", ["session_profile", "product_clicks", "actions_by_date", "page_pair_count"])
def test_date_range_reaches_the_reader(spark, name):
    assert "GreaterThanOrEqual(ts" in _plan(spark, name) and "LessThan(ts" in _plan(spark, name)


@pytest.mark.parametrize("name", ["ad_stat", "ad_click_trend", "ad_clean_clicks", "ad_province_top3"])
def test_a_small_blacklist_goes_to_the_scan(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "rightHint=(strategy=broadcast)" in plan
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert not any("userid" in e for e in _exchanges(physical)) and "SortMergeJoin" not in physical


def test_page_pairs_order_by_ranges(spark, no_runtime_help):
    df = QUERIES["page_pairs"](spark, SF)
    assert df.inputFiles() and all("page_order" in f for f in df.inputFiles())
    # a range is the only key that rows are dealt by; no session, slice or second is one
    keys = {e for e in _exchanges(df._jdf.queryExecution().executedPlan().toString()) if e.startswith("hash")}
    assert keys and all("part" in k and "session" not in k for k in keys)
