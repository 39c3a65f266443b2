"""Rows are neither lost nor kept silently: samples, reruns, log lines, parameters."""

import pytest
from pyspark.sql import functions as F

from shoplens.functions import columns as X
from shoplens.operators import ads, sampling
from shoplens.params import TaskParams
from shoplens.plans import jobs
from shoplens.plans.catalog import QUERIES
from shoplens.sinks import write_task_result
from shoplens.sources.binding import ad_lines_from_events
from shoplens.spark import shared_dir
from shoplens.streaming import ad_stream


@pytest.mark.parametrize("days,want", [(120, 100), (7, 35), (30, 100), (100, 100)])
def test_sample_over_any_date_range(spark, days, want):
    hourly = spark.range(days * 5).select(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")), "yyyy-MM-dd").alias("date"),
        F.format_string("%02d", F.col("id") % 3).alias("hour")).groupBy("date", "hour").agg(F.count("*").alias("session_count"))
    p = TaskParams(start_date="2024-01-01", end_date="2024-12-31", allocation="largest_remainder")
    assert sampling.sample_quota(hourly, p).agg(F.sum("quota")).first()[0] == want


def test_floor_extract_compares_rows(spark):
    assert QUERIES["session_random_extract"](spark, "/root/testdata/sf0.01").count() > 50


def test_empty_rerun_clears_its_task(spark, tmp_dir):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "taskid string, v int")
    for task in "ab":
        write_task_result(one.where(one.taskid == task), f"{tmp_dir}/t", task_id=task)
    write_task_result(one.limit(0), f"{tmp_dir}/t", task_id="a")
    assert [(r["taskid"], r["v"]) for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == [("b", 2)]
    with pytest.raises(ValueError):
        write_task_result(one, f"{tmp_dir}/t", task_id="../x")
    with pytest.raises(Exception, match="another task"):
        write_task_result(one, f"{tmp_dir}/u", task_id="a")
    with pytest.raises(Exception, match="another task"):
        write_task_result(spark.createDataFrame([(None, 1)], "taskid string, v int"), f"{tmp_dir}/v", task_id="a")


def test_bad_lines_are_kept_apart_and_spaced_names_survive(spark, tmp_dir):
    lines = spark.createDataFrame([("1 p c 2 3",), ("1 p c 2",), ("x p c 2 3",), (None,), ("1 p c d 2 3",)], "value string")
    assert ads.parse_ad_lines(lines).count() == 1 and ads.rejected_lines(lines).count() == 4
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cities = spark.range(25).select(F.col("id").alias("city_id"), F.lit("New York City").alias("city_name"), F.lit("a b").alias("area"))
    made = ad_lines_from_events(events, cities)
    assert ads.parse_ad_lines(made).count() == made.count() > 0
    lines.write.parquet(f"{tmp_dir}/in/f1")
    stream = spark.readStream.schema("value string").parquet(f"{tmp_dir}/in/*")
    ad_stream.start_rejected(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", TaskParams(), {"availableNow": True}).awaitTermination()
    assert ad_stream.read_rejected(spark, f"{tmp_dir}/out").count() == 4


def test_hot_blacklisted_user_is_reduced_before_the_join(spark):
    rows = [(f"{i * 1000} p c {7 if i % 10 else i} {i % 3}",) for i in range(3000)]
    lines = spark.createDataFrame(rows, "value string").repartition(4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for most in (0, 10):    # a list too long to broadcast, and a short one
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if most == 0 else threshold)
        tables = ads.ad_tables(lines, TaskParams(blacklist_threshold=50), max_listed=most)
        clean = tables["ad_clean_clicks"]
        assert clean.where("userid = 7").count() == 0 and clean.count() == 300
        for name, fn in (("ad_stat", ads.ad_stat), ("ad_click_trend", ads.click_trend)):
            assert sorted(tables[name].collect()) == sorted(fn(clean).collect())
            plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
            join = plan.index("LeftAnti")
            assert ("Aggregate [userid" in plan[join:]) == (most == 0)
        assert {r["userid"] for r in tables["ad_blacklist"].collect()} == {7}
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == threshold


def test_unreadable_blacklist_is_an_error(spark, tmp_dir):
    spark.createDataFrame([("x",)], "userid string").write.json(f"{tmp_dir}/o/{ad_stream.BLACKLIST}/batch_id=0")
    with pytest.raises(Exception):
        ad_stream.read_blacklist(spark, f"{tmp_dir}/o").collect()
    assert ad_stream.read_blacklist(spark, f"{tmp_dir}/none").collect() == []


def test_long_strings_are_not_cut(spark):
    got = spark.createDataFrame([("1",), ("12",), ("123",), ("",), (None,)], "c string").select(X.pad2("c").alias("c")).collect()
    assert [r["c"] for r in got] == ["01", "12", "123", "00", None]


@pytest.mark.parametrize("bad", [{"start_date": "2024-1-5"}, {"end_date": "2024-02-31"}, {"trend_window": "30 seconds"},
                                 {"trend_window": "soon"}])
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        TaskParams(**bad)


def test_json_parameters():
    p = TaskParams.from_json({"startDate": "2024-01-05", "sampleSize": 7, "watermarkDelay": "1 hour", "sex": ""})
    assert (p.sample_size, p.watermark_delay, p.sex) == (7, "1 hour", None)
    with pytest.raises(ValueError, match="startAges"):
        TaskParams.from_json({"startAges": 3})


def test_jobs_write_jdbc_tables(spark):
    opts = {"url": "jdbc:derby:memory:jobs;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    if not spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource("org/apache/derby/jdbc/EmbeddedDriver.class"):
        pytest.skip("Derby JDBC driver not on the classpath")
    from shoplens.sources.binding import Tables
    from shoplens.plans.defaults import QUERY_PARAMS as P
    t = Tables(spark, "/root/testdata/sf0.001")
    jobs.page_job(t.actions(), P, jobs.table_writer("jdbc", P.task_id, "R_", opts))
    back = spark.read.format("jdbc").options(dbtable="R_page_split_convert_rate", **opts).load()
    assert back.count() == 1


def test_shared_folder_keeps_its_scheme(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or ""
    assert shared_dir(spark, "x").startswith(base.rstrip("/"))
