"""Bind the driver's test tables to the jobs' input schemas.

``events`` becomes the user action log, ``customer`` (+ ``nation``) the user
dimension, ``part`` the product dimension and ``nation`` + ``region`` the city
dimension. The same mapping is written as SQL in ``shoplens.plans.oracle`` so
that DuckDB can check every query independently.

Fixed values of the binding: ``k`` is the integer field ``k`` of
``events.props``; page = k % 10; keyword = 'kw' || (k % 10) on views;
clicked category = k and clicked product = (event_id * 7 + k) % 100 on clicks;
ordered categories = "k,(k+7)%100" on signups; paid category = k on purchases;
city = user_id % 25; age = (custkey * 7) % 60; sex = male for even custkeys;
product status = p_size % 2; ad id = k % 20.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.columns import TIME_FORMAT

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    # a typed parse of the one field needed (cheaper per row than a JSON-path lookup)
    return F.from_json(F.col("props"), "k bigint")["k"]


def actions_from_events(events: DataFrame, session_mode: str = "B1", keep_event_id: bool = True) -> DataFrame:
    """``events`` -> ``user_visit_action`` (13 columns, plus ``event_id`` for ties).

    ``session_mode`` B1: one session per user and day; B2: ``event_id div 2``
    (two consecutive events), which spreads visit lengths over all buckets.
    """
    # one formatted time string per row; date and day key are cut from it
    e = events.select("event_id", "user_id", "event_type", _k().alias("k"),
                      F.date_format("ts", TIME_FORMAT).alias("action_time"))
    typ = F.col("event_type")
    k = F.col("k")
    day = F.substring("action_time", 1, 10)
    if session_mode == "B1":
        session = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.translate(day, "-", ""))
    elif session_mode == "B2":
        session = F.expr("event_id div 2").cast("string")
    else:
        raise ValueError(f"unknown session mode {session_mode!r}")
    order_ids = F.when(typ == "signup", F.concat(k.cast("string"), F.lit(","), ((k + 7) % 100).cast("string")))
    pay_ids = F.when(typ == "purchase", k.cast("string"))
    cols = [
        day.alias("date"),
        F.col("user_id").cast("bigint").alias("user_id"),
        session.alias("session_id"),
        (k % 10).alias("page_id"),
        F.col("action_time"),
        F.when(typ == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(typ == "click", k).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(typ == "click", (F.col("event_id") * 7 + k) % 100).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        order_ids.alias("order_category_ids"),
        order_ids.alias("order_product_ids"),
        pay_ids.alias("pay_category_ids"),
        pay_ids.alias("pay_product_ids"),
        (F.col("user_id") % 25).cast("bigint").alias("city_id"),
    ]
    if keep_event_id:
        cols.append(F.col("event_id"))
    return e.select(*cols)


def within_days(events: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Events of a date range, as a bound on the stored ``ts`` itself, which the file reader can prune by."""
    kind = events.schema["ts"].dataType
    after = date.fromisoformat(last_day) + timedelta(days=1)
    return events.where((F.col("ts") >= F.lit(first_day).cast(kind)) & (F.col("ts") < F.lit(after.isoformat()).cast(kind)))


def users_from_customer(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``customer`` (+ nation name as the user's city) -> ``user_info``."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.join(n, "c_nationkey", "left").select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        ((F.col("c_custkey") * 7) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("city"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def products_from_part(part: DataFrame) -> DataFrame:
    """``part`` -> ``product_info`` with a JSON ``extend_info``."""
    return part.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def cities_from_nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    """``nation`` joined to ``region`` -> city dimension (city, name, area)."""
    r = region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return nation.join(r, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


# Area grades for the bound city dimension (a parameter of the area job).
TESTDATA_AREA_LEVELS = {
    "A_Level": ("AFRICA", "AMERICA"),
    "B_Level": ("ASIA", "EUROPE"),
    "C_Level": ("MIDDLE EAST",),
}


def ad_lines_from_events(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Click events -> ad log text lines ``epoch_ms province city userid adid``.

    Province is the area of the user's city; spaces of names become ``_``. Works on a
    batch or a streaming ``events`` DataFrame (stream-static join).
    """
    clicks = events.where(F.col("event_type") == "click").select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        (F.col("user_id") % 25).cast("bigint").alias("city_id"),
        F.col("user_id"),
        (_k() % 20).alias("adid"),
    )
    joined = clicks.join(cities, "city_id", "inner")
    return joined.select(
        F.concat_ws(
            " ",
            F.col("ts_ms").cast("string"),
            F.regexp_replace(F.col("area"), " ", "_"),
            F.regexp_replace(F.col("city_name"), " ", "_"),
            F.col("user_id").cast("string"),
            F.col("adid").cast("string"),
        ).alias("value")
    )


class Tables:
    """Lazy access to the bound inputs of one test-data directory.

    Instances are shared per (session, folder) and memoise the *plans* of the
    bound inputs (no data is cached), so repeated queries skip re-reading
    parquet footers and re-building the binding expressions on the driver.
    """

    _shared: dict[tuple, "Tables"] = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), spark.sparkContext.applicationId, sf_dir)
        inst = cls._shared.get(key)
        if inst is None:
            inst = super().__new__(cls)
            inst.spark, inst.sf_dir, inst._plans = spark, sf_dir, {}
            cls._shared[key] = inst
        return inst

    def _memo(self, key, build):
        if key not in self._plans:
            self._plans[key] = build()
        return self._plans[key]

    def raw(self, name: str) -> DataFrame:
        return self._memo(("raw", name), lambda: read_table(self.spark, self.sf_dir, name))

    def actions(self, session_mode: str = "B1", dates: tuple[str, str] | None = None) -> DataFrame:
        """The action log; ``dates`` (first and last day) lets the scan skip the rest."""
        def build():
            events = self.raw("events")
            return actions_from_events(within_days(events, *dates) if dates else events, session_mode)

        return self._memo(("actions", session_mode, dates), build)

    def users(self) -> DataFrame:
        return self._memo("users", lambda: users_from_customer(self.raw("customer"), self.raw("nation")))

    def products(self) -> DataFrame:
        return self._memo("products", lambda: products_from_part(self.raw("part")))

    def cities(self) -> DataFrame:
        return self._memo("cities", lambda: cities_from_nation_region(self.raw("nation"), self.raw("region")))

    def ad_lines(self) -> DataFrame:
        return self._memo("ad_lines", lambda: ad_lines_from_events(self.raw("events"), self.cities()))
