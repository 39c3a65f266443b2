import os
import threading
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shoplens.operators import ads as AD
from shoplens.params import TaskParams
from shoplens.streaming import ad_stream as ST

P = TaskParams(blacklist_threshold=3, watermark_delay="10 minutes", top_ads=2, stream_state_partitions=2)
DAY = 1560168000000  # 2019-06-10 12:00:00 UTC


def line(ms, prov="P1", city="C1", user=1, ad=1):
    return f"{ms} {prov} {city} {user} {ad}"


def batch1():
    return ([line(DAY + i * 1000, user=1, ad=1) for i in range(3)]  # user 1 reaches the threshold
            + [line(DAY + 60_000, user=2, ad=1), line(DAY + 61_000, user=2, ad=2),
               line(DAY + 62_000, prov="P2", city="C2", user=3, ad=5), "short line", "x P1 C1 1 1"])


def batch2():
    return [line(DAY + 120_000, user=2, ad=2), line(DAY + 121_000, prov="P2", city="C3", user=4, ad=5),
            line(DAY - 86_400_000, user=5, ad=9)]  # a day behind the watermark: late


def lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_parse_drops_bad_lines(spark):
    got = AD.parse_ad_lines(lines_df(spark, batch1())).collect()
    assert len(got) == 6 and {r.userid for r in got} == {1, 2, 3}


def test_batch_tables(spark):
    t = AD.ad_tables(lines_df(spark, batch1() + batch2()), P)
    assert [r.userid for r in t["ad_blacklist"].collect()] == [1]
    assert 1 not in {r.userid for r in t["ad_clean_clicks"].collect()}
    stat = {(r.date, r.province, r.city, r.adid): r.clickCount for r in t["ad_stat"].collect()}
    assert stat[("20190610", "P1", "C1", 2)] == 2 and stat[("20190610", "P1", "C1", 1)] == 1
    top = {(r.province, r.adid): r.clickCount for r in t["ad_province_top3"].where(F.col("date") == "20190610").collect()}
    assert top == {("P1", 2): 2, ("P1", 1): 1, ("P2", 5): 2}
    trend = {(r.hour, r.minute, r.adid): r.clickCount for r in t["ad_click_trend"].collect() if r.date == "20190610"}
    assert trend[("12", "01", 2)] == 1 and trend[("12", "02", 2)] == 1


def _write_file(spark, d, name, lines):
    lines_df(spark, lines).coalesce(1).write.mode("overwrite").parquet(os.path.join(d, name))


def _stream_lines(spark, src):
    return lambda: spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src + "/*")


READERS = {"ad_user_click_count": ST.read_user_click_count, "ad_blacklist": ST.read_blacklist,
           "ad_stat": ST.read_ad_stat, "ad_province_top3": ST.read_province_top, "ad_click_trend": ST.read_click_trend}


def assert_equals_batch(spark, out, lines, p=P, tables=tuple(READERS)):
    want = AD.ad_tables(lines_df(spark, lines), p)
    for name in tables:
        got = READERS[name](spark, out)
        assert sorted(got.collect()) == sorted(want[name].select(*got.columns).collect()), name


def test_stream_equals_batch_restart_and_late_rows(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _write_file(spark, src, "f1", batch1())
    _write_file(spark, src, "f2", batch2()[:2])
    # Spark drops rows behind the watermark of the previous micro-batch, so the
    # late row arrives in a third file (third batch)
    _write_file(spark, src, "f3", batch2()[2:])
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, P)

    # every table leaves the late row out, and what was dropped is on record
    counts = {tuple(r) for r in ST.read_user_click_count(spark, out).collect()}
    assert_equals_batch(spark, out, batch1() + batch2()[:2])
    late = {(r.query, r.batch): r.dropped for r in ST.read_late(spark, out).collect()}
    assert late == {("counts", 2): 1, ("stats", 2): 2}  # a click is two totals of the statistics
    assert {r.value for r in ST.read_rejected(spark, out).collect()} == {"short line", "x P1 C1 1 1"}

    # restart from the checkpoint: nothing new, nothing counted twice
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, P)
    assert {tuple(r) for r in ST.read_user_click_count(spark, out).collect()} == counts
    # a new file continues from the saved state
    _write_file(spark, src, "f4", [line(DAY + 180_000, user=2, ad=2)])
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, P)
    again = {(r.date, r.userid, r.adid): r.clickCount for r in ST.read_user_click_count(spark, out).collect()}
    assert again[("20190610", 2, 2)] == 3
    assert {r.userid for r in ST.read_blacklist(spark, out).collect()} == {1, 2}


def test_folded_output_equals_unfolded(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    readers = (*READERS.values(), ST.read_rejected)

    def tables():
        return [sorted(read(spark, out).collect()) for read in readers]

    assert ST.fold_batches(spark, out) == {}  # nothing written yet
    for i, lines in enumerate((batch1(), batch2()[:1], batch2()[1:2])):
        _write_file(spark, src, f"f{i}", lines)
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, P)
    before = tables()
    folded = ST.fold_batches(spark, out)
    assert folded[ST.STAT] == 1 and folded[ST.COUNTS] == 1  # batches 0 and 1; 2 could still be rewritten
    assert tables() == before
    assert ST.fold_batches(spark, out) == {} and tables() == before

    _write_file(spark, src, "f9", [line(DAY + 180_000, user=2, ad=2)])
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, P)
    after = tables()
    assert after != before
    # user 2 is blacklisted by now: batch 3 adds to the counts, not to the statistics
    assert ST.fold_batches(spark, out)[ST.COUNTS] >= 2 and tables() == after
    want = AD.ad_tables(lines_df(spark, batch1() + batch2()[:2] + [line(DAY + 180_000, user=2, ad=2)]), P)
    assert after[0] == sorted(want["ad_user_click_count"].collect())


def test_testdata_stream_source(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    lines = ST.testdata_lines(spark, sf)
    assert lines.isStreaming
    q = lines.writeStream.format("memory").queryName("adlines_probe").trigger(availableNow=True).start()
    q.awaitTermination()
    n = spark.sql("SELECT count(*) FROM adlines_probe").first()[0]
    ev = spark.read.parquet(f"{sf}/events.parquet").where("event_type = 'click'").count()
    assert n == ev > 0


def test_trend_window_width(spark):
    clicks = AD.parse_ad_lines(lines_df(spark, [line(DAY + s * 1000, ad=1) for s in (0, 59, 60, 299, 300)]))
    one = {(r.hour, r.minute): r.clickCount for r in AD.click_trend(clicks, P).collect()}
    assert one == {("12", "00"): 2, ("12", "01"): 1, ("12", "04"): 1, ("12", "05"): 1}
    five = {(r.hour, r.minute): r.clickCount for r in AD.click_trend(clicks, P.with_(trend_window="5 minutes")).collect()}
    assert five == {("12", "00"): 4, ("12", "05"): 1}


def test_kafka_options():
    assert ST.kafka_options("b1:9092,b2:9092", "ad_clicks") == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "ad_clicks", "startingOffsets": "latest"}
    got = ST.kafka_options("b1:9092", "ad_clicks", "ad-stat", "earliest")
    assert got["kafka.group.id"] == "ad-stat" and got["startingOffsets"] == "earliest"


def test_top_ads_after_every_batch_and_users_listed_once(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    p = P.with_(blacklist_threshold=4)
    files = [[line(DAY + 100 * n + i, prov=f"P{(n + i) % 3}", city=f"C{i % 4}", user=10 + i + 10 * n, ad=(n * i) % 5) for i in range(9)]
             for n in range(4)] + [[line(DAY + 1000 + i, user=7, ad=1) for i in range(5)],
                                   [line(DAY + 2000 + i, user=7, ad=1) for i in range(3)]]
    seen = []
    for n, lines in enumerate(files):
        _write_file(spark, src, f"f{n}", lines)
        ST.run_available_now(_stream_lines(spark, src), out, ckpt, p)
        seen += lines
        assert_equals_batch(spark, out, seen, p)
    # user 7 goes on clicking after being listed, and is written once
    assert [r.userid for r in spark.read.parquet(f"{out}/{ST.BLACKLIST}").where("userid = 7").collect()] == [7]
    # a batch ranks the groups it changed and no others
    ranked = spark.read.parquet(f"{out}/{ST.TOP}").where("batch_id = 0").select("province").collect()
    assert {r.province for r in ranked} == {"P0", "P1", "P2"}
    _write_file(spark, src, "g0", [line(DAY + 3000, prov="P2", user=20, ad=4)])
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, p)
    last = spark.read.parquet(f"{out}/{ST.TOP}")
    assert [r.province for r in last.where(f"batch_id = {last.agg(F.max('batch_id')).first()[0]}").collect()] == ["P2"]
    assert_equals_batch(spark, out, seen + [line(DAY + 3000, prov="P2", user=20, ad=4)], p)


def test_trend_windows_over_midnight(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    p = P.with_(trend_window="7 minutes")
    midnight = 1560211200000
    lines = [line(midnight + s * 1000, user=s % 50 + 100, ad=s % 2) for s in range(-600, 600, 20)]
    _write_file(spark, src, "f0", lines[:30])
    _write_file(spark, src, "f1", lines[30:])
    ST.run_available_now(_stream_lines(spark, src), out, ckpt, p)
    assert_equals_batch(spark, out, lines, p)


def test_state_of_past_days_is_evicted(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    rows = []
    for day in range(4):
        lines = [line(DAY + day * 86_400_000 + i, user=i, ad=i % 3) for i in range(20)]
        _write_file(spark, src, f"f{day}", lines)
        rows += lines
    for start in (ST.start_counts, ST.start_stats):
        query = start(_stream_lines(spark, src)(), out, ckpt, P, {"availableNow": True})
        query.awaitTermination()
        totals = [op.numRowsTotal for pr in query.recentProgress for op in pr.stateOperators]
        one_day = totals[0]
        assert totals[-1] == one_day and max(totals) <= 3 * one_day  # the open day, and days the watermark has yet to pass
    assert_equals_batch(spark, out, rows, tables=("ad_user_click_count", "ad_stat", "ad_province_top3", "ad_click_trend"))


def test_processing_time_run_cut_short_in_a_batch(spark, tmp_dir, monkeypatch):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    _write_file(spark, src, "f1", batch1())
    _write_file(spark, src, "f2", batch2()[:2])
    trigger = {"processingTime": "1 second"}
    write, broken = ST._write_batch, []

    def failing(df, out_dir, table, batch_id, files=4):
        write(df, out_dir, table, batch_id, files)
        if batch_id == 1 and table in (ST.COUNTS, ST.TREND):
            broken.append(table)
            raise OSError("executor gone")  # tables of this batch are written, its commit is not

    for start, table in ((ST.start_counts, ST.COUNTS), (ST.start_stats, ST.TREND)):
        with monkeypatch.context() as m:
            m.setattr(ST, "_write_batch", failing)
            query = start(_stream_lines(spark, src)(), out, ckpt, P, trigger)
            with pytest.raises(StreamingQueryException):
                query.awaitTermination(120)
        assert broken.pop() == table
        query = start(_stream_lines(spark, src)(), out, ckpt, P, trigger)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    assert_equals_batch(spark, out, batch1() + batch2()[:2])


def test_continuous_run_takes_up_a_grown_blacklist(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    p = P.with_(blacklist_refresh=1)
    _write_file(spark, src, "f1", batch1())
    failed = []

    def run():
        try:
            ST.run_continuously(_stream_lines(spark, src), out, ckpt, p, "1 second")
        except Exception as ex:  # noqa: BLE001 - shown by the assertion below
            failed.append(ex)

    job = threading.Thread(target=run, daemon=True)
    job.start()

    def wait(done, seconds=90):
        end = time.monotonic() + seconds
        while not done() and time.monotonic() < end:
            time.sleep(0.5)
        assert done() and not failed, failed

    wait(lambda: {r.userid for r in ST.read_blacklist(spark, out).collect()} == {1})
    time.sleep(6)  # past the next look at the list
    _write_file(spark, src, "f2", [line(DAY + 60_000, user=1, ad=8), line(DAY + 61_000, user=2, ad=9)])
    wait(lambda: 9 in {r.adid for r in ST.read_ad_stat(spark, out).collect()})
    assert 8 not in {r.adid for r in ST.read_ad_stat(spark, out).collect()}  # a listed user's click
    for query in spark.streams.active:
        query.stop()
    job.join(60)
    assert not job.is_alive()


def test_continuous_run_raises_the_error_of_a_query(spark, tmp_dir, monkeypatch):
    src = f"{tmp_dir}/src"
    _write_file(spark, src, "f1", batch1())
    write = ST._write_batch

    def failing(df, out_dir, table, batch_id, files=4):
        if table == ST.TREND:
            raise OSError("disk gone")
        write(df, out_dir, table, batch_id, files)

    monkeypatch.setattr(ST, "_write_batch", failing)
    with pytest.raises(StreamingQueryException, match="disk gone"):
        ST.run_continuously(_stream_lines(spark, src), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", P, "1 second")
    assert not spark.streams.active
