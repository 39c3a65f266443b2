"""Top products per area.

Plan at scale: the click scan is pruned to two columns with the date and
``click_product_id != -1`` predicates above the parquet reader; clicks are
reduced per (city, product) with a map-side partial aggregate before the only
exchange of raw data, so a hot product is collapsed inside each scan task; the
city dimension then joins the reduced table (broadcast when the planner's size
estimate allows it). In the full job only products that exist take part (a
semi-join on the product key, one narrow column), the per-area top-k is a
``row_number`` filter with a literal bound, which Spark plans as a partial
``WindowGroupLimit`` before the exchange (an area holding most products ships
only k rows per task), and product names and status are joined for those k
rows per area alone.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.params import TaskParams


def product_clicks(actions: DataFrame, p: TaskParams) -> DataFrame:
    """S3: ``(city_id, click_product_id)`` of product clicks in the date range."""
    start, end = p.require_dates()
    return actions.where(F.col("date").between(start, end) & (F.col("click_product_id") != -1)).select(
        "city_id", "click_product_id"
    )


def area_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks joined to the city dimension -> ``city_id, city_name, area, pid``."""
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id", "inner").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("pid")
    )


def area_product_click_count(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """A16 + G1 + G2: clicks and the distinct ``id:name`` city list per (area, pid).

    Clicks are first reduced to one row per (city, product) (map-side partial
    aggregate), so the dimension join and the (area, product) aggregate work on
    that reduced table whatever the size of the city dimension.
    """
    per_city = clicks.groupBy("city_id", F.col("click_product_id").alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    base = per_city.join(cities.select("city_id", "city_name", "area"), "city_id", "inner").select(
        "area", "pid", X.concat_long_string("city_id", "city_name", ":").alias("city_info"), "n"
    )
    return base.groupBy("area", "pid").agg(
        F.sum("n").cast("bigint").alias("click_count"),
        X.group_concat_distinct(F.col("city_info")).alias("city_infos"),
    )


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """J5 + G3 + X18: add product name and status (``Self`` / ``Third Party``)."""
    prod = products.select(
        F.col("product_id").alias("pid"),
        "product_name",
        X.product_status(F.col("extend_info")).alias("product_status"),
    )
    return counts.join(prod, "pid", "inner").select(
        "area", "city_infos", "pid", "product_name", "product_status", "click_count"
    )


def _top_k_per_area(df: DataFrame, p: TaskParams) -> DataFrame:
    """W1 + F12: ``row_number`` per area by clicks (ties: lower pid first), ``rn <= k``."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("pid").asc())
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= p.top_products).drop("rn")


def _present(top: DataFrame, p: TaskParams, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """X19 + P2: output columns of the area result table."""
    return top.select(
        F.lit(p.task_id).alias("taskid"),
        F.col("area"),
        X.area_level(F.col("area"), levels).alias("areaLevel"),
        F.col("pid").alias("productid"),
        F.col("city_infos").alias("cityInfos"),
        F.col("click_count").alias("clickCount"),
        F.col("product_name").alias("productName"),
        F.col("product_status").alias("productStatus"),
    )


def area_top3_job(actions: DataFrame, cities: DataFrame, products: DataFrame, p: TaskParams,
                  levels: Mapping[str, Sequence[str]] = X.REFERENCE_AREA_LEVELS) -> DataFrame:
    """The whole area job as one lazy plan.

    Only products that exist take part in the ranking (a semi-join on the
    product key, one narrow column); names and status are then joined for the
    k rows per area alone, so the product dimension is never joined to every
    (area, product) count. ``product_id`` is the product key.
    """
    counts = area_product_click_count(product_clicks(actions, p), cities)
    known = counts.join(products.select(F.col("product_id").alias("pid")), "pid", "left_semi")
    return _present(area_product_info(_top_k_per_area(known, p), products), p, levels)
