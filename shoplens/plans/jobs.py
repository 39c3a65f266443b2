"""The four analysis jobs as end-to-end Spark applications.

Each job takes the bound inputs, a ``TaskParams`` and a result writer, builds
its lazy plans from ``shoplens.operators`` and writes every result table.

The session job reads the log once for all but the session detail: its filtered
sessions, one row each with their category counts nested, are written once as
Parquet in the cluster's shared folder (``spark.checkpoint.dir``) and read by all
sinks. A lost executor does not force the log to be
re-aggregated, no machine-local storage is involved, and the planner decides
joins by the stored sizes.

Usage (one job per call)::

    python -m shoplens.plans.jobs session --input /data/sf --output /results/run1 \
        --params '{"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": 20, "endAge": 50}'
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import ads, area, categories, funnel, sampling, sessions
from shoplens.params import TaskParams
from shoplens.schemas import AD_LOG, CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION, conform
from shoplens.sinks import own_rows, replace_table, write_result, write_task_result
from shoplens.sources.binding import TESTDATA_AREA_LEVELS, Tables
from shoplens.spark import get_session, stored
from shoplens.streaming import ad_stream

Writer = Callable[[DataFrame, str], None]


def path_writer(base: str, task_id: str | None = None) -> Writer:
    """Write each result under ``base/<table>``, partitioned by task id (retry-safe, also for empty results)."""
    return lambda df, table: write_task_result(df, f"{base.rstrip('/')}/{table}", task_id=task_id)


def table_writer(fmt: str, task_id: str, prefix: str = "", options: dict | None = None, mode: str = "append") -> Writer:
    """Write each result to a JDBC table (``fmt='jdbc'``) or a catalog table (``fmt='table'``).

    An append is not idempotent: a rerun needs a task id of its own. ``mode='replace'`` (catalog
    tables only) puts the result in place of the whole table, by one switch.
    """
    if mode == "replace" and fmt != "table":
        raise ValueError("only catalog tables can be replaced")

    def write(df: DataFrame, table: str) -> None:
        own = own_rows(df, task_id)
        if mode == "replace":
            replace_table(own, prefix + table)
        else:
            write_result(own, prefix + table, "append", fmt, options)
    return write


def session_job(actions: DataFrame, users: DataFrame, p: TaskParams, write: Writer) -> None:
    """Profile -> filter -> statistics, sample, top categories and top sessions."""
    rows = categories.session_rows(sessions.actions_by_date(actions, p))
    filtered = stored(sessions.filter_sessions(sessions.session_full_info(rows, users), p), "filtered_sessions")
    write(sessions.session_aggr_stat(filtered, p), "session_aggr_stat")
    sample = stored(sampling.random_extract(filtered, p), "sampled_sessions")
    write(sample, "session_random_extract")
    write(sampling.session_detail(sessions.actions_by_date(actions, p), sample, p), "session_detail")
    sc = categories.session_category_counts(filtered)
    top = stored(categories.top_categories(categories.category_totals(sc), p), "top_categories")
    write(top, "top10_category")
    write(categories.top_sessions_from_counts(sc, top, p), "top10_session")


def page_job(actions: DataFrame, p: TaskParams, write: Writer) -> None:
    rates = funnel.page_convert_rate(sessions.actions_by_date(actions, p), p)
    write(funnel.pack_convert_rate(rates, p), "page_split_convert_rate")


def area_job(actions: DataFrame, cities: DataFrame, products: DataFrame, p: TaskParams, write: Writer,
             levels=None) -> None:
    kw = {} if levels is None else {"levels": levels}
    write(area.area_top3_job(actions, cities, products, p, **kw), "area_top3_product")


def ad_batch_job(lines: DataFrame, p: TaskParams, write: Writer) -> None:
    """T3-T8 in batch: parsed clicks, counts, blacklist and statistics each feed several
    results, so each is stored once in the shared folder."""
    def out(df: DataFrame, name: str) -> None:
        write(df.withColumn("taskid", F.lit(p.task_id)), name)

    out(ads.rejected_lines(lines), "ad_rejected")
    clicks = stored(ads.parse_ad_lines(lines), "ad_clicks")
    counts = stored(ads.user_click_count(clicks), "ad_user_click_count")
    out(counts, "ad_user_click_count")
    black = ads.Listed.store(ads.blacklist(counts, p))
    out(black.users, "ad_blacklist")
    stat = stored(ads.ad_stat(clicks, black), "ad_stat")
    out(stat, "ad_stat")
    out(ads.province_top(stat, p), "ad_province_top3")
    out(ads.click_trend(clicks, p, black), "ad_click_trend")


def stream_job(lines: Callable[[], DataFrame], output: str, checkpoint: str, p: TaskParams, interval: str | None) -> None:
    """The ad stream: user counts with the blacklist, and statistics, until stopped (no ``interval``: all there is, once)."""
    if interval is None:
        ad_stream.run_available_now(lines, output, checkpoint, p)
    else:
        ad_stream.run_continuously(lines, output, checkpoint, p, interval)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shoplens.plans.jobs")
    ap.add_argument("job", choices=["session", "page", "area", "ads", "stream", "fold"])
    ap.add_argument("--input", help="folder with the driver's parquet tables (test binding)")
    ap.add_argument("--catalog", action="store_true",
                    help="read catalog tables user_visit_action, user_info, product_info, city_info, ad_log")
    ap.add_argument("--output", required=True, help="result folder (shared storage), or a prefix of the table names")
    ap.add_argument("--format", choices=["files", "jdbc", "table"], default="files")
    ap.add_argument("--mode", choices=["append", "replace"], default="append",
                    help="tables: add the rows, or put them in place of the table")
    ap.add_argument("--option", action="append", default=[], help="key=value of the JDBC writer: url, driver, user, ...")
    ap.add_argument("--params", default="{}", help="task parameters as JSON (reference keys)")
    ap.add_argument("--task-id", default="task")
    ap.add_argument("--brokers", help="stream: Kafka bootstrap servers (otherwise the events files of --input)")
    ap.add_argument("--topic", help="stream: Kafka topic")
    ap.add_argument("--group-id", help="stream: Kafka consumer group")
    ap.add_argument("--checkpoint", help="stream: folder of offsets and state (shared storage)")
    ap.add_argument("--trigger", help="stream: time between micro-batches, such as '5 seconds'; unset: read what is there and end")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    existing = SparkSession.getActiveSession()
    spark: SparkSession = existing or get_session(a.master)
    p = TaskParams.from_json(json.loads(a.params)).with_(task_id=a.task_id)
    if a.job == "fold":  # merge the finished batches of a stream's output folder
        print(json.dumps(ad_stream.fold_batches(spark, a.output)))
        if existing is None:
            spark.stop()
        return
    if a.job == "stream":
        if not a.checkpoint or not (a.input or (a.brokers and a.topic)):
            ap.error("stream needs --checkpoint and either --brokers with --topic or --input")
        if a.brokers:
            source = lambda: ad_stream.kafka_lines(spark, a.brokers, a.topic, a.group_id)
        else:
            source = lambda: ad_stream.testdata_lines(spark, a.input)
        stream_job(source, a.output, a.checkpoint, p, a.trigger)
        if existing is None:
            spark.stop()
        return
    if a.format == "files":
        write = path_writer(a.output, a.task_id)
    else:
        write = table_writer(a.format, a.task_id, a.output, dict(o.split("=", 1) for o in a.option), a.mode)
    if a.catalog:
        def table(name: str, schema) -> Callable[[], DataFrame]:
            return lambda: conform(spark.table(name), schema, name)
        actions = table("user_visit_action", USER_VISIT_ACTION)() if a.job != "ads" else None
        users, products = table("user_info", USER_INFO), table("product_info", PRODUCT_INFO)
        cities, lines, levels = table("city_info", CITY_INFO), table("ad_log", AD_LOG), None
    else:
        if not a.input:
            ap.error("--input or --catalog is required")
        t = Tables(spark, a.input)
        dates = tuple(p.require_dates()) if a.job != "ads" else None
        actions, users, products, cities, lines = t.actions(dates=dates), t.users, t.products, t.cities, t.ad_lines
        levels = TESTDATA_AREA_LEVELS
    if a.job == "session":
        session_job(actions, users(), p, write)
    elif a.job == "page":
        page_job(actions, p, write)
    elif a.job == "area":
        area_job(actions, cities(), products(), p, write, levels)
    else:
        ad_batch_job(lines(), p, write)
    if existing is None:
        spark.stop()


if __name__ == "__main__":
    main()
