"""Popular categories and their most active sessions.

Plan at scale: each action contributes (category, kind) entries for its click,
its ordered ids and its paid ids; one ``inline`` expands them inside the scan
stage and one hash aggregate with a map-side partial phase counts all three
kinds at once, replacing the reference's three counts plus three joins. A hot
category is therefore collapsed per task before the only exchange.

The session job's chain reads the log once and shuffles sessions once
(``session_rows``): actions become one row per session with the profile and, nested in
it, the counts of every touched category. The session filter is then a filter on that
row, so its categories need no join with the filtered sessions; totals and the
per-category ranking ``inline`` the nested counts. The top-k
categories are a ``TakeOrderedAndProject`` (k rows reach the driver side of the
plan, nothing else). The per-category session ranking is a semi-join against
those k ids (broadcast, bounded by k) followed by a literal-bounded
``row_number`` that Spark runs as a partial ``WindowGroupLimit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.operators.common import bounded_broadcast
from shoplens.operators.sessions import profile_columns
from shoplens.params import TaskParams

CLICK, ORDER, PAY = 0, 1, 2
_ENTRY = "struct<category_id:bigint,kind:int>"


def _entries(ids, kind: int):
    # (id, kind) pairs without a lambda, so the expression stays in generated code
    return F.arrays_zip(ids, F.array_repeat(F.lit(kind), F.size(ids))).cast(f"array<{_ENTRY}>")


def _all_entries():
    click = F.col("click_category_id")
    click_arr = F.when(click.isNotNull() & (click != -1), F.array(click)).otherwise(F.array().cast("array<bigint>"))
    return F.concat(
        _entries(click_arr, CLICK),
        _entries(X.split_ids(F.col("order_category_ids")), ORDER),
        _entries(X.split_ids(F.col("pay_category_ids")), PAY),
    )


def session_rows(actions: DataFrame) -> DataFrame:
    """A1 with the counts of A8-A11 nested: ``sessions.session_profile`` and ``categories``, one row per session.

    ``categories`` is an array of (category_id, click_count, order_count, pay_count),
    each touched category once. Two aggregates over one scan: per (session,
    category or NULL), where a session with a third of all actions is collapsed
    in the scan tasks, then per session over these rows. An action that touches
    several categories counts as one step.
    """
    kw, k, one = F.col("search_keyword"), F.col("e.kind"), F.col("category_id").isNotNull()
    entries = actions.select(
        "session_id", "user_id",
        X.action_seconds(F.col("action_time")).alias("t"),
        F.when(X.is_not_blank(kw), kw).alias("keyword"),
        F.posexplode_outer(_all_entries()).alias("place", "e"),
    )
    touched = entries.groupBy("session_id", F.col("e.category_id").alias("category_id")).agg(
        F.min("user_id").alias("user_id"),
        F.min("t").alias("start_sec"),
        F.max("t").alias("end_sec"),
        F.count_if(F.coalesce(F.col("place"), F.lit(0)) == 0).alias("steps"),
        F.collect_set("keyword").alias("keywords"),
        F.count_if(k == CLICK).alias("click_count"),
        F.count_if(k == ORDER).alias("order_count"),
        F.count_if(k == PAY).alias("pay_count"),
    )
    counts = F.struct("category_id", "click_count", "order_count", "pay_count")
    return profile_columns(touched.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("start_sec").alias("start_sec"),
        F.max("end_sec").alias("end_sec"),
        F.sum("steps").alias("step_length"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("search_keyword_list"),
        F.array_sort(F.collect_list(F.when(F.col("click_count") > 0, F.col("category_id")))).alias("click_category_list"),
        F.collect_list(F.when(one, counts)).alias("categories"),
    ), "categories")


#: The former name, still in use.
session_cells = session_rows


def session_category_counts(rows: DataFrame) -> DataFrame:
    """``session_id, category_id, click_count, order_count, pay_count`` of ``session_rows`` (J2: those that are left)."""
    return rows.select("session_id", F.inline("categories"))


def category_totals(counts: DataFrame) -> DataFrame:
    """J3 from per-session counts: ``category_id, click_count, order_count, pay_count``."""
    return counts.groupBy("category_id").agg(
        F.sum("click_count").cast("bigint").alias("click_count"),
        F.sum("order_count").cast("bigint").alias("order_count"),
        F.sum("pay_count").cast("bigint").alias("pay_count"),
    )


def kind_totals(counts: DataFrame, kind: str) -> DataFrame:
    """A9-A11 from per-session counts: ``category_id, n`` (categories with n > 0)."""
    col = F.col(f"{kind}_count")
    return counts.where(col > 0).groupBy("category_id").agg(F.sum(col).cast("bigint").alias("n"))


def top_sessions_from_counts(counts: DataFrame, top: DataFrame, p: TaskParams) -> DataFrame:
    """Per top category, the k sessions with most clicks on it (ties by session id)."""
    ids = bounded_broadcast(top.select(F.col("categoryid").alias("category_id")), p.top_categories)
    clicks = counts.where(F.col("click_count") > 0).join(ids, "category_id", "left_semi")
    return _rank_sessions(clicks.select("category_id", "session_id", "click_count"), p)


def _rank_sessions(counts: DataFrame, p: TaskParams) -> DataFrame:
    # two-level top-k (per category and session-hash salt, then per category),
    # so the last task of a hot category merges at most k rows per salt group;
    # exact, since a category's k best sessions are among their salt group's k best
    k = int(p.top_sessions)
    order = (F.col("click_count").desc(), F.col("session_id").asc())
    salt = F.pmod(F.xxhash64("session_id"), F.lit(max(int(p.salt_groups), 1)))
    w1 = Window.partitionBy("category_id", "_salt").orderBy(*order)
    pre = counts.withColumn("_salt", salt).withColumn("_rn1", F.row_number().over(w1)).where(F.col("_rn1") <= k)
    w = Window.partitionBy("category_id").orderBy(*order)
    ranked = pre.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return ranked.select(
        F.lit(p.task_id).alias("taskid"),
        F.col("category_id").alias("categoryid"),
        F.col("session_id").alias("sessionid"),
        F.col("click_count").alias("clickCount"),
    )


def top_categories(full_count: DataFrame, p: TaskParams) -> DataFrame:
    """O1/O2: top-k by (clicks, orders, pays) descending; ties by lower id."""
    top = full_count.orderBy(
        F.col("click_count").desc(), F.col("order_count").desc(), F.col("pay_count").desc(), F.col("category_id").asc()
    ).limit(int(p.top_categories))
    return top.select(
        F.lit(p.task_id).alias("taskid"),
        F.col("category_id").alias("categoryid"),
        F.col("click_count").alias("clickCount"),
        F.col("order_count").alias("orderCount"),
        F.col("pay_count").alias("payCount"),
    )
