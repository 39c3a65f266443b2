"""Structured Streaming form of the ad click job.

Three streaming queries read the same log lines:

* ``counts``: clicks per (day window, user, ad). Each micro-batch (update mode) hands the changed totals to
  ``foreachBatch``, which writes them and the users that have newly reached the threshold (each user once).
* ``stats``: clicks of users not on the blacklist per (day window, province, city, ad) and per (day window,
  minute, ad), in one aggregate, so both are made of the same clicks. The top ads are ranked again for
  the (date, province) groups that a batch changed, and only for those.
* ``rejected``: log lines that can't be read, as they came.

Both aggregates keep their totals in Spark's state by day windows with the same watermark, so they have one
rule for late clicks: a click goes if its day ended before the watermark. State of such days is evicted.
What was dropped is recorded per query and batch (``read_late``).

Micro-batches write into folders keyed by the batch id; a retried batch overwrites its own. Readers merge the
folders into the result tables (the highest total per key, as totals only grow; the newest ranking per group).
``fold_batches`` keeps that cheap: it merges the finished batches into one folder that readers then take in their place.

A query's plan holds the blacklist as it was when the query started: a streaming plan lists the files
of a static side once. ``run_continuously`` therefore starts ``stats`` again from its checkpoint when the list has grown,
at most every ``blacklist_refresh`` seconds. ``run_available_now`` finishes ``counts`` first, and its outputs equal the
batch transforms of ``shoplens.operators.ads`` but for late clicks.

Locally the source is the ``events`` parquet file (``pathGlobFilter``); on a
cluster it is Kafka (``kafka_lines``), whose connector jar is not bundled with
PySpark and must be supplied by the deployment.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import ads
from shoplens.params import TaskParams
from shoplens.sources.binding import ad_lines_from_events, cities_from_nation_region, read_table

COUNTS, BLACKLIST, STAT, TREND = "ad_user_click_count", "ad_blacklist", "ad_stat", "ad_click_trend"
TOP, REJECTED, LATE = "ad_province_top", "ad_rejected", "ad_late"


# ------------------------------------------------------------------ sources
def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                  file_name: str = "events.parquet") -> DataFrame:
    """Stream the ``events`` parquet file(s) of a folder (schema from the files)."""
    schema = spark.read.parquet(os.path.join(sf_dir, file_name) if "*" not in file_name else sf_dir).schema
    reader = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", file_name)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(sf_dir)


def testdata_lines(spark: SparkSession, sf_dir: str, stream_dir: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Ad log lines derived from a streamed ``events`` table (stream-static join
    with the city dimension)."""
    events = events_stream(spark, stream_dir or sf_dir, max_files_per_trigger,
                           "*.parquet" if stream_dir else "events.parquet")
    cities = cities_from_nation_region(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
    return ad_lines_from_events(events, cities)


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str, group_id: str | None = None,
                starting_offsets: str = "latest") -> DataFrame:
    """Kafka topic -> ``value`` strings (needs the Kafka connector on the classpath)."""
    options = kafka_options(bootstrap_servers, topic, group_id, starting_offsets)
    return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest") -> dict[str, str]:
    """Source options: ``startingOffsets`` counts at the first start only, later ones go on from the checkpoint."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": starting_offsets}
    return {**options, "kafka.group.id": group_id} if group_id else options


# ------------------------------------------------------------------ sinks
def _write_batch(df: DataFrame, out_dir: str, table: str, batch_id: int, files: int = 4) -> None:
    """Overwrite this batch's own folder (idempotent on retry) with few files.

    ``repartition`` and not ``coalesce``: only the finished rows are brought together, the stages before them
    keep all their tasks.
    """
    df.repartition(max(int(files), 1)).write.mode("overwrite").parquet(f"{out_dir}/{table}/batch_id={batch_id}")


def _parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty while its folder is absent."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _batches(spark: SparkSession, out_dir: str, table: str, schema: T.StructType) -> DataFrame:
    return _parquet(spark, f"{out_dir}/{table}", T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))


def _folded_upto(spark: SparkSession, out_dir: str, table: str) -> int:
    """The last batch in the newest finished fold, -1 without one."""
    marks = _parquet(spark, f"{out_dir}/folds/{table}", T.StructType([T.StructField("upto", T.LongType())]))
    newest = marks.agg(F.max("upto")).first()[0]
    return -1 if newest is None else newest


def _read(spark: SparkSession, out_dir: str, table: str, schema: T.StructType, last: int | None = None) -> DataFrame:
    """The newest fold of an output table and the batches after it (to batch ``last``)."""
    upto = _folded_upto(spark, out_dir, table)
    batches = _batches(spark, out_dir, table, schema).where(F.col("batch_id") > upto)
    if last is not None:
        batches = batches.where(F.col("batch_id") <= last)
    rows = batches.drop("batch_id")
    return rows if upto < 0 else _parquet(spark, _fold_path(out_dir, table, upto), schema).unionByName(rows)


def _fold_path(out_dir: str, table: str, upto: int) -> str:
    return f"{out_dir}/folded/{table}/upto={upto}"


COUNTS_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("userid", T.LongType()),
    T.StructField("adid", T.LongType()), T.StructField("clickCount", T.LongType()),
])
BLACKLIST_SCHEMA = T.StructType([T.StructField("userid", T.LongType())])
STAT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("adid", T.LongType()),
    T.StructField("clickCount", T.LongType()),
])
TREND_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("hour", T.StringType()),
    T.StructField("minute", T.StringType()), T.StructField("adid", T.LongType()),
    T.StructField("clickCount", T.LongType()),
])
# a trend window may span midnight: its clicks are counted by the day they fall on, the reader adds the days
STORED_TREND_SCHEMA = T.StructType([T.StructField("day", T.StringType()), *TREND_SCHEMA.fields])
TOP_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("province", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("top", T.ArrayType(T.StructType([T.StructField("adid", T.LongType()),
                                                   T.StructField("clickCount", T.LongType())]))),
])
REJECTED_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("n_fields", T.IntegerType())])
LATE_SCHEMA = T.StructType([T.StructField("query", T.StringType()), T.StructField("batch", T.LongType()),
                            T.StructField("dropped", T.LongType())])


# ------------------------------------------------------------------ queries
def start_counts(lines: DataFrame, out_dir: str, checkpoint_dir: str, p: TaskParams, trigger: dict | None = None):
    """T3/T4 as a stateful streaming aggregate with a watermark."""
    spark = lines.sparkSession
    counts = (_timed(ads.parse_ad_lines(lines), p)
              .groupBy(F.window("ts", "1 day").alias("day"), "userid", "adid")
              .agg(F.count(F.lit(1)).alias("clickCount"))
              .select(_day().alias("date"), "userid", "adid", "clickCount"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()       # written and searched for the blacklist: the state stage runs once
        try:
            _write_batch(batch, out_dir, COUNTS, batch_id, p.stream_output_files)
            # a listed user goes on clicking: only those not listed by an earlier batch are written
            known = _read(spark, out_dir, BLACKLIST, BLACKLIST_SCHEMA, batch_id - 1)
            _write_batch(ads.blacklist(batch, p).join(known, "userid", "left_anti"), out_dir, BLACKLIST, batch_id, 1)
        finally:
            batch.unpersist()

    return _start_stateful(counts, sink, f"{checkpoint_dir}/counts", p, trigger)


def _timed(clicks: DataFrame, p: TaskParams) -> DataFrame:
    return clicks.withColumn("ts", F.timestamp_millis("ts_ms")).withWatermark("ts", p.watermark_delay)


def _day():
    return F.date_format(F.col("day.start"), "yyyyMMdd")


def _start_stateful(totals: DataFrame, sink, checkpoint: str, p: TaskParams, trigger: dict | None):
    writer = totals.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return _start_with_state_partitions(writer, totals.sparkSession, p.stream_state_partitions)


def _start_with_state_partitions(writer, spark: SparkSession, n: int | None):
    """Start a stateful query with ``n`` state partitions.

    The number of state-store partitions is taken from
    ``spark.sql.shuffle.partitions`` when a checkpoint is first started and is
    fixed afterwards, so it is set only for the start call and restored.
    """
    if not n:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def start_stats(lines: DataFrame, out_dir: str, checkpoint_dir: str, p: TaskParams, trigger: dict | None = None):
    """Statistics, top ads and trend of clicks by users not on the blacklist (as stored when this starts).

    A click is counted under two keys, its place and its minute; both are collapsed in the scan tasks before the
    exchange to the state, so a hot ad or province is a few rows of each task.
    """
    spark = lines.sparkSession
    black = ads.Listed.of_stored(read_blacklist(spark, out_dir))
    clicks = ads.with_trend_keys(ads.parse_ad_lines(lines), p)
    none = F.lit(None).cast("string")
    place = F.struct(F.lit(STAT).alias("kind"), F.col("province").alias("province"), F.col("city").alias("city"),
                     none.alias("start"), none.alias("hour"), none.alias("minute"))
    minute = F.struct(F.lit(TREND).alias("kind"), none.alias("province"), none.alias("city"),
                      F.col("date").alias("start"), F.col("hour").alias("hour"), F.col("minute").alias("minute"))
    totals = (ads.clean(_timed(clicks, p), black).select("ts", "adid", F.inline(F.array(place, minute)))
              .groupBy(F.window("ts", "1 day").alias("day"), "kind", "province", "city", "start", "hour", "minute", "adid")
              .agg(F.count(F.lit(1)).alias("clickCount"))
              .withColumn("day", _day()).withColumn("date", F.coalesce("start", "day")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()       # three tables are made of it: the state stage runs once
        try:
            for table, schema in ((STAT, STAT_SCHEMA), (TREND, STORED_TREND_SCHEMA)):
                rows = batch.where(F.col("kind") == table).select(*schema.fieldNames())
                _write_batch(rows, out_dir, table, batch_id, p.stream_output_files)
            _write_batch(changed_top(batch.where(F.col("kind") == STAT), batch_id), out_dir, TOP, batch_id, 1)
        finally:
            batch.unpersist()

    def changed_top(stat: DataFrame, batch_id: int) -> DataFrame:
        groups = stat.select("date", "province").distinct()
        first, last = groups.agg(F.min("date"), F.max("date")).first()
        # the bounds let the reader skip files of other days
        rows = _read(spark, out_dir, STAT, STAT_SCHEMA, batch_id).where(F.col("date").between(first, last))
        ranked = ads.province_top(_highest(rows.join(groups, ["date", "province"], "left_semi")), p)
        return (ranked.groupBy("date", "province").agg(F.collect_list(F.struct("adid", "clickCount")).alias("top"))
                .select("date", "province", F.lit(batch_id).cast("bigint").alias("version"), "top"))

    return _start_stateful(totals, sink, f"{checkpoint_dir}/stats", p, trigger)


def start_rejected(lines: DataFrame, out_dir: str, checkpoint_dir: str, p: TaskParams, trigger: dict | None = None):
    """Log lines that can't be read, kept as they came."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, out_dir, REJECTED, batch_id, 1)

    writer = (ads.rejected_lines(lines).writeStream.foreachBatch(sink)
              .option("checkpointLocation", f"{checkpoint_dir}/rejected"))
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


# ------------------------------------------------------------------ readers
def _highest(rows: DataFrame) -> DataFrame:
    keys = [c for c in rows.columns if c != "clickCount"]
    return rows.groupBy(*keys).agg(F.max("clickCount").alias("clickCount"))


def _newest(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("date", "province").agg(F.max("version").alias("version"), F.max_by("top", "version").alias("top")))


# what the rows of several batches of a table come to; update-mode totals only grow
_MERGED: dict[str, tuple[T.StructType, Callable[[DataFrame], DataFrame]]] = {
    COUNTS: (COUNTS_SCHEMA, _highest),
    BLACKLIST: (BLACKLIST_SCHEMA, DataFrame.distinct),
    STAT: (STAT_SCHEMA, _highest),
    TREND: (STORED_TREND_SCHEMA, _highest),
    TOP: (TOP_SCHEMA, _newest),
    REJECTED: (REJECTED_SCHEMA, lambda rows: rows),
}


def _merged(spark: SparkSession, out_dir: str, table: str, last: int | None = None) -> DataFrame:
    schema, merge = _MERGED[table]
    return merge(_read(spark, out_dir, table, schema, last))


def fold_batches(spark: SparkSession, out_dir: str) -> dict[str, int]:
    """Fold the finished batches of every table into one folder; returns the last batch folded per table.

    Run it now and then beside the stream. The newest batch stays out, as only it
    can still be rewritten by a retry. Readers turn to a fold when its mark is
    written, after the rows; a fold that broke off is done again from the start.
    Nothing is deleted: batch folders up to the returned number and older folds
    can go once no reader that began before the fold is left.
    """
    folded = {}
    for table, (schema, _) in _MERGED.items():
        newest = _batches(spark, out_dir, table, schema).agg(F.max("batch_id")).first()[0]
        if newest is None or newest - 1 <= _folded_upto(spark, out_dir, table):
            continue
        upto = newest - 1
        _merged(spark, out_dir, table, upto).write.mode("overwrite").parquet(_fold_path(out_dir, table, upto))
        spark.createDataFrame([(upto,)], "upto long").write.mode("append").parquet(f"{out_dir}/folds/{table}")
        folded[table] = upto
    return folded


def read_user_click_count(spark: SparkSession, out_dir: str) -> DataFrame:
    """Latest total per (date, user, ad)."""
    return _merged(spark, out_dir, COUNTS)


def read_blacklist(spark: SparkSession, out_dir: str) -> DataFrame:
    return _merged(spark, out_dir, BLACKLIST)


def read_ad_stat(spark: SparkSession, out_dir: str) -> DataFrame:
    return _merged(spark, out_dir, STAT)


def read_rejected(spark: SparkSession, out_dir: str) -> DataFrame:
    """Log lines that could not be read, as they came."""
    return _merged(spark, out_dir, REJECTED)


def read_province_top(spark: SparkSession, out_dir: str) -> DataFrame:
    """The top ads per (date, province), as ranked when a batch last changed the group."""
    return _merged(spark, out_dir, TOP).select("date", "province", F.inline("top"))


def read_click_trend(spark: SparkSession, out_dir: str) -> DataFrame:
    keys = [c for c in TREND_SCHEMA.fieldNames() if c != "clickCount"]
    return _merged(spark, out_dir, TREND).groupBy(*keys).agg(F.sum("clickCount").alias("clickCount"))


def read_late(spark: SparkSession, out_dir: str) -> DataFrame:
    """``query, batch, dropped``: totals of a batch's scan tasks that came behind the watermark and were dropped.

    Clicks of one key and task are one of them, as Spark counts them after the partial aggregation.
    """
    return _batches(spark, out_dir, LATE, LATE_SCHEMA).select(*LATE_SCHEMA.fieldNames())


# ------------------------------------------------------------------ runs
def record_late(query, name: str, out_dir: str, spark: SparkSession) -> None:
    """Write what the recent batches of a query dropped; a batch recorded again overwrites itself."""
    for progress in query.recentProgress:
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if dropped:
            row = spark.createDataFrame([(name, progress.batchId, dropped)], LATE_SCHEMA)
            row.write.mode("overwrite").parquet(f"{out_dir}/{LATE}/batch_id={progress.batchId}/of={name}")


def run_available_now(lines_factory, out_dir: str, checkpoint_dir: str, p: TaskParams) -> None:
    """Process everything available: counts first, then statistics."""
    for name, start in (("counts", start_counts), ("stats", start_stats), ("rejected", start_rejected)):
        lines = lines_factory()
        query = start(lines, out_dir, checkpoint_dir, p, {"availableNow": True})
        try:
            query.awaitTermination()
        finally:
            record_late(query, name, out_dir, lines.sparkSession)


def run_continuously(lines_factory, out_dir: str, checkpoint_dir: str, p: TaskParams, interval: str) -> None:
    """Run all queries with a processing-time trigger until one ends; its error is raised and the others stop.

    While the blacklist has grown, ``stats`` is stopped and started again from its checkpoint every
    ``blacklist_refresh`` seconds. A batch cut short by that is done again from the state before it.
    """
    starts = {"counts": start_counts, "stats": start_stats, "rejected": start_rejected}
    spark = lines_factory().sparkSession

    def start(name: str):
        return starts[name](lines_factory(), out_dir, checkpoint_dir, p, {"processingTime": interval})

    def listed() -> int:
        return read_blacklist(spark, out_dir).count()

    running, known = {}, listed()
    try:
        for name in starts:
            running[name] = start(name)
        while _all_active(running.values(), p.blacklist_refresh):
            for name, query in running.items():
                record_late(query, name, out_dir, spark)
            if (now := listed()) > known:
                running["stats"].stop()
                record_late(running["stats"], "stats", out_dir, spark)
                running["stats"], known = start("stats"), now
    finally:
        for query in running.values():
            query.stop()
        for name, query in running.items():
            record_late(query, name, out_dir, spark)
    for query in running.values():
        if error := query.exception():
            raise error


def _all_active(queries, seconds: float) -> bool:
    """Whether the queries all go on for some seconds; other streams of the session don't matter."""
    end = time.monotonic() + seconds
    while all(query.isActive for query in queries):
        if time.monotonic() >= end:
            return True
        time.sleep(0.2)
    return False
