"""Session profile, user join, filters and visit/step statistics.

Covers S1, S4, F1-F6, J1, J2, P3, A1-A5, A17 and X11.

Plan at scale: the profile is one hash aggregate keyed by ``session_id`` with a
partial (map-side) phase, so a session holding a large share of all actions is
collapsed inside each scan task before the exchange; keyword and category sets
are deduplicated in that partial phase as well. The user join is an equi-join
that AQE may turn into a broadcast from runtime sizes; skewed users are split by
AQE's skew-join handling. Bucket statistics are a single global aggregate of
``count_if`` columns (partial per task, one tiny final row), not a per-bucket
group-by, so no bucket can become a hot key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.params import TaskParams
from shoplens.schemas import ACTION_COLUMNS

# Visit-length buckets in whole seconds and step-length buckets in
# actions, with the reference's labels, in its order. An upper bound of None
# means unbounded. A visit of 0 s falls in no bucket.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

PROFILE_COLUMNS = ["session_id", "user_id", "search_keywords", "click_category_ids",
                   "visit_length", "step_length", "start_time"]
FULL_INFO_COLUMNS = PROFILE_COLUMNS + ["age", "professional", "sex", "city"]


def actions_by_date(actions: DataFrame, p: TaskParams) -> DataFrame:
    """Actions with ``start_date <= date <= end_date`` (both required)."""
    start, end = p.require_dates()
    return actions.where(F.col("date").between(start, end))


def session_profile(actions: DataFrame) -> DataFrame:
    """A1: one row per session.

    ``user_id`` is the smallest user id of the session, ``start_time`` the
    earliest action, ``visit_length`` seconds from first to last action,
    ``step_length`` the number of actions, and the keyword / clicked category
    lists are exact distinct sets, keywords sorted as strings and category ids
    numerically (``*_list`` array columns are kept for the filters).
    """
    t = X.action_seconds(F.col("action_time"))
    kw = F.col("search_keyword")
    cat = F.col("click_category_id")
    return profile_columns(actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min(t).alias("start_sec"),
        F.max(t).alias("end_sec"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set(F.when(X.is_not_blank(kw), kw))).alias("search_keyword_list"),
        F.array_sort(F.collect_set(F.when(cat != -1, cat))).alias("click_category_list"),
    ))


def profile_columns(per_session: DataFrame, *more: str) -> DataFrame:
    """The columns of the profile (and ``more``) from the aggregates of one session per row."""
    return per_session.select(
        "session_id",
        "user_id",
        F.array_join("search_keyword_list", ",").alias("search_keywords"),
        F.array_join(F.col("click_category_list").cast("array<string>"), ",").alias("click_category_ids"),
        (F.col("end_sec") - F.col("start_sec")).alias("visit_length"),
        F.col("step_length"),
        X.format_seconds("start_sec").alias("start_time"),
        "search_keyword_list",
        "click_category_list",
        *more,
    )


def session_full_info(profile: DataFrame, users: DataFrame) -> DataFrame:
    """Profile joined to the user dimension (sessions without a user drop)."""
    u = users.select("user_id", "age", "professional", "sex", "city")
    return profile.join(u, "user_id", "inner")


def session_predicates(p: TaskParams) -> list[Column]:
    """One predicate per set parameter; unset parameters pass everything.

    The age range applies only when both bounds are set; NULL data fails every
    set predicate; keywords and categories match on any overlap.
    """
    preds: list[Column] = []
    if p.start_age is not None and p.end_age is not None:
        preds.append(F.col("age").between(int(p.start_age), int(p.end_age)))
    if p.professionals:
        preds.append(_csv_overlap("professional", p.professionals))
    if p.cities:
        preds.append(_csv_overlap("city", p.cities))
    if p.sex:
        preds.append(F.col("sex") == F.lit(p.sex))
    if p.keywords:
        wanted = F.array(*[F.lit(k) for k in p.keywords])
        preds.append(F.coalesce(F.arrays_overlap("search_keyword_list", wanted), F.lit(False)))
    if p.category_ids:
        wanted = F.array(*[F.lit(int(c)).cast("bigint") for c in p.category_ids])
        preds.append(F.coalesce(F.arrays_overlap("click_category_list", wanted), F.lit(False)))
    return preds


def _csv_overlap(col: str, values) -> Column:
    """F3 on a scalar field: the field, read as a CSV list, shares a value with
    the parameter list; NULL and ``-1`` data fail."""
    c = F.col(col)
    wanted = F.array(*[F.lit(str(v)) for v in values])
    return F.coalesce(c.isNotNull() & (c != "-1") & F.arrays_overlap(F.split(c, ","), wanted), F.lit(False))


def filter_sessions(full_info: DataFrame, p: TaskParams) -> DataFrame:
    """sessions that pass every set predicate."""
    preds = session_predicates(p)
    return full_info.where(reduce(and_, preds)) if preds else full_info


def filtered_sessions(actions: DataFrame, users: DataFrame, p: TaskParams) -> DataFrame:
    """S1 -> A1 -> J1 -> F6 as one lazy chain."""
    profile = session_profile(actions_by_date(actions, p))
    return filter_sessions(session_full_info(profile, users), p)


def filtered_actions(actions: DataFrame, sessions: DataFrame, p: TaskParams) -> DataFrame:
    """Actions (in the date range) of the sessions that passed the filter."""
    keep = sessions.select("session_id")
    return actions_by_date(actions, p).join(keep, "session_id", "left_semi")


def _bucket_cond(col: Column, lo: int, hi: int | None) -> Column:
    return (col >= lo) if hi is None else col.between(lo, hi)


def bucket_counts(sessions: DataFrame, kind: str) -> DataFrame:
    """A2/A3/A4: ``bucket, session_count`` for every bucket (zeros included)."""
    if kind == "visit":
        col, buckets = F.col("visit_length"), VISIT_BUCKETS
    elif kind == "step":
        col, buckets = F.col("step_length"), STEP_BUCKETS
    else:
        raise ValueError(kind)
    wide = sessions.agg(*[F.count_if(_bucket_cond(col, lo, hi)).alias(label) for label, lo, hi in buckets])
    return wide.unpivot([], [b[0] for b in buckets], "bucket", "session_count")


def session_aggr_stat(sessions: DataFrame, p: TaskParams) -> DataFrame:
    """Session count and 15 bucket ratios, rounded HALF_UP to 2 places.

    Sessions of 0 s are counted in ``session_count`` but in no bucket, so the
    visit ratios need not sum to 1.
    """
    v, s = F.col("visit_length"), F.col("step_length")
    counts = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[F.count_if(_bucket_cond(v, lo, hi)).alias(f"v_{label}") for label, lo, hi in VISIT_BUCKETS],
        *[F.count_if(_bucket_cond(s, lo, hi)).alias(f"s_{label}") for label, lo, hi in STEP_BUCKETS],
    )
    n = F.col("session_count")
    return counts.select(
        F.lit(p.task_id).alias("taskid"),
        n,
        *[X.ratio_half_up(F.col(f"v_{label}"), n).alias(f"visit_length_{label}_ratio") for label, _, _ in VISIT_BUCKETS],
        *[X.ratio_half_up(F.col(f"s_{label}"), n).alias(f"step_length_{label}_ratio") for label, _, _ in STEP_BUCKETS],
    )


def select_profile(df: DataFrame, full: bool = False) -> DataFrame:
    return df.select(*(FULL_INFO_COLUMNS if full else PROFILE_COLUMNS))


def select_actions(df: DataFrame) -> DataFrame:
    return df.select(*ACTION_COLUMNS)
