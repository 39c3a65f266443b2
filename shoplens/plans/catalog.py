"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``shoplens.sources.binding`` and
runs one operator (or one small chain) of the jobs over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.functions.sql import register_sql_functions
from shoplens.operators import ads, area, categories, funnel, sampling, scalars, sessions
from shoplens.plans import defaults as D
from shoplens.plans.defaults import QUERY_PARAMS as P
from shoplens.sources.binding import TESTDATA_AREA_LEVELS, Tables
from shoplens.sinks import register_views, write_task_result
from shoplens.spark import shared_dir, stored
from shoplens.streaming import ad_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DATES = tuple(P.require_dates())


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ area
@register("product_clicks")
def q_product_clicks(spark, sf_dir):
    return area.product_clicks(Tables(spark, sf_dir).actions(dates=DATES), P)


@register("area_clicks")
def q_area_clicks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return area.area_clicks(area.product_clicks(t.actions(dates=DATES), P), t.cities())


@register("area_product_click_count")
def q_area_product_click_count(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return area.area_product_click_count(area.product_clicks(t.actions(dates=DATES), P), t.cities())


@register("area_product_info")
def q_area_product_info(spark, sf_dir):
    t = Tables(spark, sf_dir)
    counts = area.area_product_click_count(area.product_clicks(t.actions(dates=DATES), P), t.cities())
    return area.area_product_info(counts, t.products())


@register("area_top3_product")
def q_area_top3_product(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return area.area_top3_job(t.actions(dates=DATES), t.cities(), t.products(), P, TESTDATA_AREA_LEVELS)


# ------------------------------------------------------------------ sessions
def _range_actions(spark, sf_dir):
    return sessions.actions_by_date(Tables(spark, sf_dir).actions(dates=DATES), P)


def _filtered(spark, sf_dir, p=P, mode="B1"):
    t = Tables(spark, sf_dir)
    return sessions.filtered_sessions(t.actions(mode, DATES), t.users(), p)


@register("actions_by_date")
def q_actions_by_date(spark, sf_dir):
    return sessions.select_actions(sessions.actions_by_date(Tables(spark, sf_dir).actions(dates=DATES), P))


@register("session_profile")
def q_session_profile(spark, sf_dir):
    acts = sessions.actions_by_date(Tables(spark, sf_dir).actions(dates=DATES), P)
    return sessions.select_profile(sessions.session_profile(acts))


@register("session_full_info")
def q_session_full_info(spark, sf_dir):
    t = Tables(spark, sf_dir)
    prof = sessions.session_profile(sessions.actions_by_date(t.actions(dates=DATES), P))
    return sessions.select_profile(sessions.session_full_info(prof, t.users()), full=True)


@register("session_filter")
def q_session_filter(spark, sf_dir):
    return sessions.select_profile(_filtered(spark, sf_dir), full=True)


_NO_AGE = P.with_(start_age=None, end_age=None)


@register("session_filter_age")
def q_session_filter_age(spark, sf_dir):
    return _filtered(spark, sf_dir).select("session_id", "age")


@register("session_filter_members")
def q_session_filter_members(spark, sf_dir):
    p = _NO_AGE.with_(professionals=D.FILTER_PROFESSIONALS, cities=D.FILTER_CITIES)
    return _filtered(spark, sf_dir, p).select("session_id", "professional", "city")


@register("session_filter_sex")
def q_session_filter_sex(spark, sf_dir):
    return _filtered(spark, sf_dir, _NO_AGE.with_(sex=D.FILTER_SEX)).select("session_id", "sex")


@register("session_filter_keywords")
def q_session_filter_keywords(spark, sf_dir):
    p = _NO_AGE.with_(keywords=D.FILTER_KEYWORDS)
    return _filtered(spark, sf_dir, p).select("session_id", "search_keywords")


@register("session_filter_categories")
def q_session_filter_categories(spark, sf_dir):
    p = _NO_AGE.with_(category_ids=D.FILTER_CATEGORIES)
    return _filtered(spark, sf_dir, p).select("session_id", "click_category_ids")


def _filtered_actions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    acts = t.actions(dates=DATES)
    return sessions.filtered_actions(acts, sessions.filtered_sessions(acts, t.users(), P), P)


@register("filtered_actions")
def q_filtered_actions(spark, sf_dir):
    return sessions.select_actions(_filtered_actions(spark, sf_dir))


@register("session_visit_buckets")
def q_session_visit_buckets(spark, sf_dir):
    return sessions.bucket_counts(_filtered(spark, sf_dir, mode="B2"), "visit")


@register("session_step_buckets")
def q_session_step_buckets(spark, sf_dir):
    return sessions.bucket_counts(_filtered(spark, sf_dir), "step")


@register("session_aggr_stat")
def q_session_aggr_stat(spark, sf_dir):
    return sessions.session_aggr_stat(_filtered(spark, sf_dir, mode="B2"), P)


# ------------------------------------------------------------------ sampling
_LR = P.with_(allocation="largest_remainder")


@register("session_hourly_count")
def q_session_hourly_count(spark, sf_dir):
    return sampling.hourly_counts(_filtered(spark, sf_dir))


@register("session_sample_quota")
def q_session_sample_quota(spark, sf_dir):
    return sampling.sample_quota(sampling.hourly_counts(_filtered(spark, sf_dir)), P)


@register("session_sample_quota_lr")
def q_session_sample_quota_lr(spark, sf_dir):
    return sampling.sample_quota(sampling.hourly_counts(_filtered(spark, sf_dir)), _LR)


def _extract(spark, sf_dir, p):
    # read by the hourly counts, the draw and the lists: one row per filtered session, from one scan of the log
    rows = _filtered(spark, sf_dir, p).select(*sampling.SAMPLED_COLUMNS)
    return sampling.random_extract(stored(rows, "sampled_sessions"), p)


@register("session_random_extract")
def q_session_random_extract(spark, sf_dir):
    return _extract(spark, sf_dir, P.with_(sample_size=D.FLOOR_SAMPLE_SIZE))


@register("session_random_extract_lr")
def q_session_random_extract_lr(spark, sf_dir):
    return _extract(spark, sf_dir, _LR)


@register("session_detail")
def q_session_detail(spark, sf_dir):
    return sampling.session_detail(_range_actions(spark, sf_dir), _extract(spark, sf_dir, _LR), _LR)


# ------------------------------------------------------------------ categories
def _session_rows(spark, sf_dir):
    """The filtered sessions with their nested category counts: one scan, one session shuffle."""
    t = Tables(spark, sf_dir)
    rows = categories.session_rows(sessions.actions_by_date(t.actions(dates=DATES), P))
    return sessions.filter_sessions(sessions.session_full_info(rows, t.users()), P)


def _session_categories(spark, sf_dir):
    return categories.session_category_counts(_session_rows(spark, sf_dir))


@register("category_ids")
def q_category_ids(spark, sf_dir):
    return _session_categories(spark, sf_dir).select("category_id").distinct()


@register("category_click_count")
def q_category_click_count(spark, sf_dir):
    return categories.kind_totals(_session_categories(spark, sf_dir), "click")


@register("category_order_count")
def q_category_order_count(spark, sf_dir):
    return categories.kind_totals(_session_categories(spark, sf_dir), "order")


@register("category_pay_count")
def q_category_pay_count(spark, sf_dir):
    return categories.kind_totals(_session_categories(spark, sf_dir), "pay")


@register("category_full_count")
def q_category_full_count(spark, sf_dir):
    return categories.category_totals(_session_categories(spark, sf_dir))


@register("top10_category")
def q_top10_category(spark, sf_dir):
    return categories.top_categories(categories.category_totals(_session_categories(spark, sf_dir)), P)


@register("top10_session")
def q_top10_session(spark, sf_dir):
    # read twice (totals, then ranking): one row per filtered session, stored in place of the log's rows
    rows = stored(_session_rows(spark, sf_dir).select("session_id", "categories"), "session_categories")
    sc = categories.session_category_counts(rows)
    top = categories.top_categories(categories.category_totals(sc), P)
    return categories.top_sessions_from_counts(sc, top, P)


# ------------------------------------------------------------------ funnel

@register("page_pairs")
def q_page_pairs(spark, sf_dir):
    return funnel.page_pairs(_range_actions(spark, sf_dir), P)


@register("page_pair_count")
def q_page_pair_count(spark, sf_dir):
    return funnel.page_pair_count(_range_actions(spark, sf_dir), P)


@register("page_start_count")
def q_page_start_count(spark, sf_dir):
    return funnel.page_start_count(_range_actions(spark, sf_dir), P)


@register("page_convert_rate")
def q_page_convert_rate(spark, sf_dir):
    return funnel.page_convert_rate(_range_actions(spark, sf_dir), P)


@register("page_convert_rate_packed")
def q_page_convert_rate_packed(spark, sf_dir):
    return funnel.pack_convert_rate(funnel.page_convert_rate(_range_actions(spark, sf_dir), P), P)


# ------------------------------------------------------------------ ads (batch)
def _clicks(spark, sf_dir):
    return ads.parse_ad_lines(Tables(spark, sf_dir).ad_lines())


@register("ad_log_parse")
def q_ad_log_parse(spark, sf_dir):
    return _clicks(spark, sf_dir).select("ts_ms", "province", "city", "userid", "adid")


@register("ad_user_click_count")
def q_ad_user_click_count(spark, sf_dir):
    return ads.user_click_count(_clicks(spark, sf_dir))


@register("ad_blacklist")
def q_ad_blacklist(spark, sf_dir):
    return ads.blacklist(ads.user_click_count(_clicks(spark, sf_dir)), P)


for _name in ("ad_clean_clicks", "ad_stat", "ad_province_top3", "ad_click_trend"):
    def _q(spark, sf_dir, _name=_name):
        return ads.ad_tables(Tables(spark, sf_dir).ad_lines(), P)[_name]
    _q.__name__ = f"q_{_name}"
    register(_name)(_q)


# ------------------------------------------------------------------ ads (Structured Streaming)
_STREAM_RUNS: dict[tuple, str] = {}


def _stream_out(spark, sf_dir):
    """Run the streaming ad job once per session and data folder (availableNow)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAM_RUNS:
        base = shared_dir(spark, "ad_stream")
        p = P.with_(stream_state_partitions=spark.sparkContext.defaultParallelism)
        ad_stream.run_available_now(lambda: ad_stream.testdata_lines(spark, sf_dir), f"{base}/out", f"{base}/ckpt", p)
        _STREAM_RUNS[key] = f"{base}/out"
    return _STREAM_RUNS[key]


@register("ad_user_click_count_stream")
def q_ad_user_click_count_stream(spark, sf_dir):
    return ad_stream.read_user_click_count(spark, _stream_out(spark, sf_dir))


@register("ad_blacklist_stream")
def q_ad_blacklist_stream(spark, sf_dir):
    return ad_stream.read_blacklist(spark, _stream_out(spark, sf_dir))


@register("ad_stat_stream")
def q_ad_stat_stream(spark, sf_dir):
    return ad_stream.read_ad_stat(spark, _stream_out(spark, sf_dir))


@register("ad_province_top3_stream")
def q_ad_province_top3_stream(spark, sf_dir):
    return ad_stream.read_province_top(spark, _stream_out(spark, sf_dir))


@register("ad_click_trend_stream")
def q_ad_click_trend_stream(spark, sf_dir):
    return ad_stream.read_click_trend(spark, _stream_out(spark, sf_dir))


# ------------------------------------------------------------------ scalars and packed records
@register("time_scalars")
def q_time_scalars(spark, sf_dir):
    return scalars.time_scalars(_range_actions(spark, sf_dir))


@register("string_scalars")
def q_string_scalars(spark, sf_dir):
    return scalars.string_scalars(_range_actions(spark, sf_dir))


def _packed(spark, sf_dir):
    return scalars.pack_profile(sessions.session_profile(_range_actions(spark, sf_dir)))


@register("packed_field_read")
def q_packed_field_read(spark, sf_dir):
    return scalars.packed_field_read(_packed(spark, sf_dir), "searchKeywords")


@register("packed_field_write")
def q_packed_field_write(spark, sf_dir):
    return scalars.packed_field_write(_packed(spark, sf_dir), "clickCategoryIds", "none")


# ------------------------------------------------------------------ SQL surface and sinks
# Each statement reads the views before it; the log is reduced to one row per (city, product) first.
AREA_SQL_VIEWS = {
    "city_product_clicks": """
        SELECT city_id, click_product_id AS productid, count(*) AS clicks
        FROM user_visit_action
        WHERE date BETWEEN :first_day AND :last_day AND click_product_id <> -1
        GROUP BY ALL""",
    "area_product_clicks": """
        SELECT area, productid, sum(clicks) AS clickCount,
               group_concat_distinct(collect_set(concat_long_string(city_id, city_name, ':'))) AS cityInfos
        FROM city_product_clicks JOIN city_info USING (city_id)
        WHERE EXISTS (SELECT 1 FROM product_info WHERE product_id = productid)
        GROUP BY ALL""",
    "area_top_products": """
        SELECT * EXCEPT (place)
        FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY clickCount DESC, productid) AS place
              FROM area_product_clicks)
        WHERE place <= :k""",
}
AREA_TOP_SQL = """
    SELECT :task AS taskid, area, coalesce(element_at(:levels, area), :other_level) AS areaLevel, productid, cityInfos,
           clickCount, product_name AS productName,
           CASE get_json_field(extend_info, 'product_status') WHEN '0' THEN 'Self' ELSE 'Third Party' END AS productStatus
    FROM area_top_products JOIN product_info ON product_id = productid"""


@register("area_top3_product_sql")
def q_area_top3_product_sql(spark, sf_dir):
    """The area job through the SQL surface: base and intermediate views (K8), SQL functions (G1-G3), bound arguments."""
    t = Tables(spark, sf_dir)
    register_sql_functions(spark)
    views = {"user_visit_action": t.actions(), "product_info": t.products(), "city_info": t.cities()}
    args = {"first_day": P.start_date, "last_day": P.end_date, "k": P.top_products, "task": P.task_id,
            "other_level": X.DEFAULT_AREA_LEVEL,
            "levels": F.create_map(*[F.lit(x) for level, areas in TESTDATA_AREA_LEVELS.items()
                                     for area in areas for x in (area, level)])}
    register_views(views)
    try:
        for name, text in AREA_SQL_VIEWS.items():
            register_views({name: spark.sql(text, args={k: v for k, v in args.items() if f":{k}" in text})})
        return spark.sql(AREA_TOP_SQL, args={k: v for k, v in args.items() if f":{k}" in AREA_TOP_SQL})
    finally:        # the result is resolved; a view left behind would hide the catalog's table of its name
        for name in (*views, *AREA_SQL_VIEWS):
            spark.catalog.dropTempView(name)


@register("sink_roundtrip")
def q_sink_roundtrip(spark, sf_dir):
    """K1-K7: write the top-10 categories with the task-partitioned sink, read back."""
    path = shared_dir(spark, "sink_roundtrip")
    result = q_top10_category(spark, sf_dir)
    write_task_result(result, path)
    return spark.read.parquet(path).select("taskid", "categoryid", "clickCount", "orderCount", "payCount")
