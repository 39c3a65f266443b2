from shoplens.operators.common import bounded_broadcast, broadcast_if_small


def _join_plan(spark, right):
    left = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only hints may broadcast
    try:
        return left.join(right, "k", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_if_small_checks_the_count(spark):
    small = spark.range(10).withColumnRenamed("id", "k").checkpoint(eager=True)
    assert "BroadcastHashJoin" in _join_plan(spark, broadcast_if_small(small))
    assert "BroadcastHashJoin" not in _join_plan(spark, broadcast_if_small(small, max_rows=5))


def test_bounded_broadcast_uses_the_proven_bound(spark):
    side = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _join_plan(spark, bounded_broadcast(side, 10))
    assert "BroadcastHashJoin" not in _join_plan(spark, bounded_broadcast(side, 10, max_rows=5))
