"""Ad click analytics (X21, T3-T8): one transform per result table.

The same functions serve batch DataFrames and the micro-batches of the
streaming job (``shoplens.streaming.ad_stream``). Every result is a hash
aggregate with a map-side partial phase, so a hot ad or user is collapsed per
task before the exchange; the per-province top-k is a literal-bounded
``row_number`` (partial ``WindowGroupLimit``).

Blacklist semantics: a user is blacklisted when, on some day, their clicks on
one ad reach ``blacklist_threshold``. The batch form applies the final list as
a second pass over all clicks (``clean_clicks``); the streaming job applies
the list as of the last start of its statistics, which equals the batch form whenever the
per-user counts are complete before the statistics are computed (as with
``availableNow`` runs, see the streaming module).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.common import BROADCAST_MAX_ROWS
from shoplens.params import TaskParams
from shoplens.spark import stored


def parse_ad_lines(lines: DataFrame) -> DataFrame:
    """``value`` text ``epoch_ms province city userid adid`` -> typed columns.

    Lines without exactly five fields, or with non-numeric ids, are left out here
    (a stream must not stop on one bad record); ``rejected_lines`` has them.
    """
    return _typed(lines).where(_well_formed()).drop("value", "n_fields")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """``value, n_fields`` of the lines that ``parse_ad_lines`` leaves out."""
    return _typed(lines).where(~F.coalesce(_well_formed(), F.lit(False))).select("value", "n_fields")


def _well_formed() -> Column:
    return ((F.col("n_fields") == 5) & F.col("ts_ms").isNotNull() & F.col("userid").isNotNull()
            & F.col("adid").isNotNull())


def _typed(lines: DataFrame) -> DataFrame:
    parts = F.split(F.col("value"), " ")
    return lines.select(
        "value", F.size(parts).alias("n_fields"),
        F.get(parts, 0).try_cast("bigint").alias("ts_ms"),
        F.get(parts, 1).alias("province"),
        F.get(parts, 2).alias("city"),
        F.get(parts, 3).try_cast("bigint").alias("userid"),
        F.get(parts, 4).try_cast("bigint").alias("adid"),
    )


def with_time_keys(clicks: DataFrame) -> DataFrame:
    """Event time ``ts`` plus ``date`` (yyyyMMdd), ``hour`` (HH) and ``minute`` (mm)."""
    ts = F.timestamp_millis(F.col("ts_ms"))
    return clicks.withColumn("ts", ts).select(
        "*",
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.date_format("ts", "HH").alias("hour"),
        F.date_format("ts", "mm").alias("minute"),
    )


def user_click_count(clicks: DataFrame) -> DataFrame:
    """``date, userid, adid, clickCount``."""
    return with_time_keys(clicks).groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("clickCount"))


def blacklist(user_counts: DataFrame, p: TaskParams) -> DataFrame:
    """T4: users with at least ``blacklist_threshold`` clicks on one ad in one day."""
    return user_counts.where(F.col("clickCount") >= int(p.blacklist_threshold)).select("userid").distinct()


def _allowed(clicks: DataFrame, black: DataFrame) -> DataFrame:
    return clicks.join(black.select("userid"), "userid", "left_anti")


def clean_clicks(clicks: DataFrame, black: DataFrame) -> DataFrame:
    """T5: clicks of users not on the blacklist (dropped in the scan where the list is ``Listed.small``)."""
    return _allowed(clicks, black).select("ts_ms", "province", "city", "userid", "adid")


@dataclass(frozen=True)
class Listed:
    """A stored blacklist: 8 bytes a user, so its count says whether it can be broadcast."""
    users: DataFrame
    small: bool

    @classmethod
    def store(cls, black: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> "Listed":
        return cls.of_stored(stored(black.select("userid"), "ad_blacklist"), max_rows)

    @classmethod
    def of_stored(cls, users: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> "Listed":
        small = users.count() <= max_rows
        return cls(F.broadcast(users) if small else users, small)


def clean(clicks: DataFrame, black: Listed) -> DataFrame:
    """Clicks of users not listed, all columns kept."""
    return _allowed(clicks, black.users)


def _count_allowed(clicks: DataFrame, keys: list[str], black: Listed | None) -> DataFrame:
    """Clicks per key without blacklisted users.

    A small list is broadcast and its users' clicks go in the scan, so that one exchange of counts is left. With a
    larger one clicks are counted per user and key first: the anti-join and its exchange then see one row for each
    of them (map-side collapsed, also for a hot user) and not every click.
    """
    if black is None or black.small:
        kept = clicks if black is None else _allowed(clicks, black.users)
        return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("clickCount"))
    per_user = clicks.groupBy("userid", *keys).agg(F.count(F.lit(1)).alias("n"))
    return _allowed(per_user, black.users).groupBy(*keys).agg(F.sum("n").cast("bigint").alias("clickCount"))


def ad_stat(clicks: DataFrame, black: Listed | None = None) -> DataFrame:
    """``date, province, city, adid, clickCount`` of users not on the blacklist."""
    return _count_allowed(with_time_keys(clicks), ["date", "province", "city", "adid"], black)


def province_top(stat: DataFrame, p: TaskParams) -> DataFrame:
    """Top-k ads per (date, province) by clicks summed over cities; ties by ad id."""
    per_prov = stat.groupBy("date", "province", "adid").agg(F.sum("clickCount").cast("bigint").alias("clickCount"))
    w = Window.partitionBy("date", "province").orderBy(F.col("clickCount").desc(), F.col("adid").asc())
    ranked = per_prov.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= int(p.top_ads))
    return ranked.select("date", "province", "adid", "clickCount")


def with_trend_keys(clicks: DataFrame, p: TaskParams | None = None) -> DataFrame:
    """``date``, ``hour`` and ``minute`` of the start of a click's ``trend_window`` (default one minute)."""
    width = p.trend_window if p is not None else "1 minute"
    start = F.window(F.timestamp_millis(F.col("ts_ms")), width).start
    return clicks.select(
        *clicks.columns,
        F.date_format(start, "yyyyMMdd").alias("date"),
        F.date_format(start, "HH").alias("hour"),
        F.date_format(start, "mm").alias("minute"),
    )


def click_trend(clicks: DataFrame, p: TaskParams | None = None, black: Listed | None = None) -> DataFrame:
    """``date, hour, minute, adid, clickCount`` per tumbling event-time window
    of ``trend_window`` (default one minute), keyed by the window's start."""
    return _count_allowed(with_trend_keys(clicks, p), ["date", "hour", "minute", "adid"], black)


def ad_tables(lines: DataFrame, p: TaskParams, max_listed: int = BROADCAST_MAX_ROWS) -> dict[str, DataFrame]:
    """All ad result tables from one batch of log lines; the blacklist is stored first."""
    clicks = parse_ad_lines(lines)
    counts = user_click_count(clicks)
    black = Listed.store(blacklist(counts, p), max_listed)
    stat = ad_stat(clicks, black)
    return {
        "ad_log_parse": clicks,
        "ad_user_click_count": counts,
        "ad_blacklist": black.users,
        "ad_clean_clicks": clean_clicks(clicks, black.users),
        "ad_stat": stat,
        "ad_province_top3": province_top(stat, p),
        "ad_click_trend": click_trend(clicks, p, black),
    }
