"""Co-located action table: the session aggregates need no shuffle of the log."""

from shoplens.operators import categories as C, sessions as S
from shoplens.plans.defaults import QUERY_PARAMS as P
from shoplens.sinks import save_bucketed_actions
from shoplens.sources.binding import Tables

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_actions_avoid_the_session_shuffle(spark):
    t = Tables(spark, SF)
    save_bucketed_actions(t.actions(), "uva_bucketed", 4)
    acts = spark.table("uva_bucketed")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # inspect the static plan
    try:
        prof = S.session_profile(S.actions_by_date(acts, P))
        assert "Exchange hashpartitioning(session_id" not in _plan(prof)
        sc = C.session_category_counts(C.session_cells(S.actions_by_date(acts, P)))
        assert "Exchange" not in _plan(sc)
        assert "PartitionFilters" in _plan(S.actions_by_date(acts, P))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    base = S.session_profile(S.actions_by_date(t.actions(), P)).drop("search_keyword_list", "click_category_list")
    got = prof.drop("search_keyword_list", "click_category_list")
    assert sorted(base.collect()) == sorted(got.collect())
