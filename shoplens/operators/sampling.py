"""Time-proportional random sample of sessions.

Per day ``sample_size // days`` sessions are drawn; each hour of the day gets
``floor(hour_sessions / day_sessions * per_day)`` of them, capped by the hour's
sessions (``allocation='floor'``, the fixed rule, which draws nothing over more
days than ``sample_size``), or ``sample_size`` itself is spread over the days and
each day's total over its hours by largest remainders
(``allocation='largest_remainder'``), so that date ranges of any length yield the
whole sample where the days have sessions enough.

"Random" is a seeded hash order: ``md5(seed || session_id)``, so the draw is
reproducible and identical in the SQL oracle. Plan at scale: the hourly counts
are a tiny table (at most 24 rows per day of the date range), so its windows
are cheap and it is broadcast under that parameter-derived bound. The per-hour
draw is ``row_number`` filtered by the literal ``sample_size``, which Spark
plans as a partial ``WindowGroupLimit`` before each exchange, and it runs in two
levels: per (date, hour, salt) and then per (date, hour), so the last task of a
busy hour merges at most ``sample_size * salt_groups`` rows however many
map tasks fed it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.common import bounded_broadcast
from shoplens.params import TaskParams


def _days_in_range(p: TaskParams) -> int:
    start, end = (date.fromisoformat(d) for d in p.require_dates())
    return max((end - start).days + 1, 0)


def with_date_hour(sessions: DataFrame) -> DataFrame:
    """Split ``start_time`` (``yyyy-MM-dd HH:mm:ss``) into ``date`` and ``hour``."""
    return sessions.withColumn("date", F.substring("start_time", 1, 10)).withColumn(
        "hour", F.substring("start_time", 12, 2)
    )


def hourly_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour)."""
    return with_date_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))


def sample_quota(hourly: DataFrame, p: TaskParams) -> DataFrame:
    """``date, hour, session_count, quota`` from the hourly counts."""
    all_rows = Window.partitionBy()
    per_day_w = Window.partitionBy("date")
    n = F.col("session_count")
    days = F.size(F.collect_set("date").over(all_rows))
    size = F.lit(int(p.sample_size))
    if p.allocation == "largest_remainder":
        # the days' shares are equal, so the rounding is cumulative: day i of n gets floor(i s/n) - floor((i-1) s/n),
        # which sums to the sample size over any number of days and spreads single sessions over the range
        i = F.dense_rank().over(Window.partitionBy().orderBy("date"))
        per_day = (F.floor(i * size / days) - F.floor((i - 1) * size / days)).cast("bigint")
    else:
        per_day = F.floor(size / days).cast("bigint")
    day_total = F.sum(n).over(per_day_w)
    q = hourly.withColumn("per_day", per_day).withColumn("exact", (n / day_total) * F.col("per_day"))
    q = q.withColumn("base", F.floor("exact").cast("bigint"))
    if p.allocation == "largest_remainder":
        rank = F.row_number().over(Window.partitionBy("date").orderBy((F.col("exact") - F.col("base")).desc(), F.col("hour")))
        short = F.col("per_day") - F.sum("base").over(per_day_w)
        q = q.withColumn("base", F.col("base") + F.when(rank <= short, 1).otherwise(0))
    return q.select("date", "hour", n, F.least(F.col("base"), n).cast("bigint").alias("quota"))


#: What the sample needs of a session.
SAMPLED_COLUMNS = ["session_id", "start_time", "search_keyword_list", "click_category_list"]


def random_extract(sessions: DataFrame, p: TaskParams) -> DataFrame:
    """The sampled sessions with the reference's output columns.

    ``sessions`` is read three times, so callers store it (``SAMPLED_COLUMNS``
    are enough): by the hourly counts, by the draw, which ranks lean
    (session_id, start_time) rows, and for the lists, which are put together
    for the picked sessions only.
    """
    s = with_date_hour(sessions.select("session_id", "start_time"))
    # at most 24 rows per day of the parameter's date range: a proven bound
    quota = bounded_broadcast(sample_quota(hourly_counts(sessions), p).select("date", "hour", "quota"),
                              _days_in_range(p) * 24)
    k = int(p.sample_size)
    s = s.withColumn("_order", F.md5(F.concat(F.lit(p.sample_seed), F.col("session_id"))))
    # two-level top-k: first per (date, hour, salt), then per (date, hour) over
    # at most k rows per salt group. Exact: an hour's k first sessions are
    # among the k first of their own salt groups.
    salt = F.pmod(F.xxhash64("session_id"), F.lit(max(int(p.salt_groups), 1)))
    w1 = Window.partitionBy("date", "hour", "_salt").orderBy("_order", "session_id")
    pre = s.withColumn("_salt", salt).withColumn("_rn1", F.row_number().over(w1)).where(F.col("_rn1") <= k)
    w = Window.partitionBy("date", "hour").orderBy("_order", "session_id")
    ranked = pre.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    picked = ranked.join(quota, ["date", "hour"], "inner").where(F.col("rn") <= F.col("quota"))
    # the quotas sum to at most sample_size
    chosen = sessions.join(bounded_broadcast(picked.select("session_id"), k), "session_id", "left_semi")
    return chosen.select(
        F.lit(p.task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        F.col("start_time").alias("startTime"),
        F.array_join("search_keyword_list", ",").alias("searchKeywords"),
        F.array_join(F.col("click_category_list").cast("array<string>"), ",").alias("clickCategoryIds"),
    )


def session_detail(actions: DataFrame, sample: DataFrame, p: TaskParams) -> DataFrame:
    """Every action of the sampled sessions (declared-only table in the reference)."""
    # the sample holds at most sample_size sessions (per_day * days <= sample_size)
    keep = bounded_broadcast(sample.select(F.col("sessionid").alias("session_id")), p.sample_size)
    picked = actions.join(keep, "session_id", "left_semi")
    return picked.select(
        F.lit(p.task_id).alias("taskid"),
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        F.col("action_time").alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"),
    )
