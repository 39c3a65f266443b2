import json
import os

from shoplens.plans import jobs
from shoplens.plans.defaults import QUERY_PARAMS as P
from shoplens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_jobs_write_their_tables(spark, tmp_dir):
    out = os.path.join(tmp_dir, "results")
    for job in ("session", "page", "area", "ads"):
        jobs.main([job, "--input", SF, "--output", out, "--task-id", "t1", "--master", "local[4]",
                   "--params", '{"startDate": "2024-01-01", "endDate": "2024-12-31", "startAge": 20, "endAge": 50}'])
    names = set(os.listdir(out))
    assert {"session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_session",
            "page_split_convert_rate", "area_top3_product", "ad_stat", "ad_blacklist"} <= names


def test_session_job_matches_queries(spark, tmp_dir):
    from shoplens.sources.binding import Tables
    got = {}
    t = Tables(spark, SF)
    jobs.session_job(t.actions(), t.users(), P, lambda df, name: got.__setitem__(name, df.collect()))
    assert sorted(got["top10_category"]) == sorted(QUERIES["top10_category"](spark, SF).collect())
    assert sorted(got["top10_session"]) == sorted(QUERIES["top10_session"](spark, SF).collect())


def test_ad_batch_job_matches_queries(spark):
    from shoplens.sources.binding import Tables
    got = {}
    jobs.ad_batch_job(Tables(spark, SF).ad_lines(), P, lambda df, name: got.__setitem__(name, df.drop("taskid").collect()))
    for name in ("ad_user_click_count", "ad_blacklist", "ad_stat", "ad_province_top3", "ad_click_trend"):
        assert sorted(got[name]) == sorted(QUERIES[name](spark, SF).collect()), name


def test_stream_command_reads_what_is_there_and_ends(spark, tmp_dir):
    out = os.path.join(tmp_dir, "stream")
    jobs.main(["stream", "--input", SF, "--output", out, "--checkpoint", os.path.join(tmp_dir, "ckpt"),
               "--params", json.dumps({"blacklistThreshold": P.blacklist_threshold})])
    stat = jobs.ad_stream.read_ad_stat(spark, out)
    assert sorted(stat.collect()) == sorted(QUERIES["ad_stat"](spark, SF).collect())
