"""The scalar helpers applied over whole tables.

These wrap ``shoplens.functions.columns`` into queries over the action log
and the session profiles, so every helper is exercised on real rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import columns as X

# The reference instant used by the comparison helpers.
REFERENCE_TIME = "2024-01-15 12:00:00"
EPOCH_TIME = "2024-01-01 0:00:00"


def time_scalars(actions: DataFrame) -> DataFrame:
    """One column per time helper, per action."""
    ts = X.parse_action_time(F.col("action_time"))
    return actions.select(
        "event_id",
        X.format_date(ts).alias("date_str"),
        X.date_hour(ts).alias("date_hour"),
        X.date_key(ts).alias("date_key"),
        F.date_format(X.parse_date_key(X.date_key(ts)), "yyyy-MM-dd").alias("date_key_parsed"),
        X.minute_key(ts).alias("minute_key"),
        X.format_time(ts).alias("time_str"),
        X.is_before(F.col("action_time"), F.lit(REFERENCE_TIME)).alias("before_ref"),
        X.is_after(F.col("action_time"), F.lit(REFERENCE_TIME)).alias("after_ref"),
        X.seconds_between(F.col("action_time"), F.lit(EPOCH_TIME)).alias("seconds_since_start"),
    )


def string_scalars(actions: DataFrame) -> DataFrame:
    """One column per string helper, per action."""
    orders = F.col("order_category_ids")
    return actions.select(
        "event_id",
        X.is_blank(orders).alias("order_blank"),
        X.is_not_blank(F.col("search_keyword")).alias("keyword_set"),
        X.trim_comma(F.concat(F.lit(","), F.coalesce(orders, F.lit("")), F.lit(","))).alias("order_trimmed"),
        X.trim_comma(F.coalesce(orders, F.lit(""))).alias("order_trimmed_plain"),
        X.pad2(F.col("page_id").cast("string")).alias("page_padded"),
        F.size(X.split_ids(orders)).cast("bigint").alias("order_id_count"),
    )


def pack_profile(profile: DataFrame) -> DataFrame:
    """Sessions as the reference's packed ``k=v|k=v`` records: ``id, packed``."""
    def kv(key, col):
        return F.concat(F.lit(key + "="), F.coalesce(col.cast("string"), F.lit("")))
    packed = F.concat_ws(
        "|",
        kv("sessionid", F.col("session_id")),
        kv("searchKeywords", F.col("search_keywords")),
        kv("clickCategoryIds", F.col("click_category_ids")),
        kv("visitLength", F.col("visit_length")),
        kv("stepLength", F.col("step_length")),
        kv("startTime", F.col("start_time")),
    )
    return profile.select(F.col("session_id").alias("id"), packed.alias("packed"))


def packed_field_read(packed: DataFrame, field: str) -> DataFrame:
    """``id, value`` of one field of each packed record."""
    return packed.select("id", X.packed_field(F.col("packed"), field).alias("value"))


def packed_field_write(packed: DataFrame, field: str, value: str) -> DataFrame:
    """``id, value`` = the record with one field replaced."""
    return packed.select("id", X.set_packed_field(F.col("packed"), field, value).alias("value"))
