"""Page-flow conversion.

Consecutive page pairs need each session's actions in time order. A plain
``lead`` over ``partitionBy(session_id)`` would put a hot session (one that
holds a large share of all actions) into a single task. The pairs as rows
(``page_pairs``) come from ranges of the order, which split anywhere; the counts
split the order by time slices, which costs no stored table: ``lead`` runs per
(session, slice) and the pairs that cross a slice boundary come from a second,
much smaller window over one row per (session, slice) holding the slice's first
and last page. The union is exactly
the set of consecutive pairs of the whole session. With the default 10-minute
slices, the first window's largest group is one session's actions within ten
minutes and the second window holds at most 144 rows per session and day, so
both are bounded by time rather than by data volume.

Counting reads the log once: target pairs and start-page views are counted in
the pass that orders a slice, so that one small row per (session, slice) is
dealt to the second window. The rate chain runs on one row per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions import columns as X
from shoplens.params import TaskParams
from shoplens.spark import stored

STEPS_SCHEMA = T.StructType([
    T.StructField("step_no", T.LongType(), False),
    T.StructField("from_page", T.LongType(), False),
    T.StructField("to_page", T.LongType(), False),
    T.StructField("step", T.StringType(), False),
])


def _steps(p: TaskParams) -> list[tuple[int, int, int, str]]:
    flow = list(p.target_page_flow)
    return [(i + 1, a, b, f"{a}_{b}") for i, (a, b) in enumerate(zip(flow, flow[1:]))]


def target_steps(spark: SparkSession, p: TaskParams) -> DataFrame:
    """Flow ``1,2,3`` -> steps (1, 1, 2, '1_2'), (2, 2, 3, '2_3')."""
    return spark.createDataFrame(_steps(p), STEPS_SCHEMA)


def _within_slices(actions: DataFrame, p: TaskParams) -> DataFrame:
    """Every action with the next page of its (session, slice) and its place there.

    Order is by action time (seconds), then ``event_id`` when the input has
    it, else ``page_id`` (equal time and page give the same pair either way).
    """
    tie = "event_id" if "event_id" in actions.columns else "page_id"
    width = int(p.pair_slice_seconds)
    a = actions.select(
        "session_id",
        "page_id",
        X.action_seconds(F.col("action_time")).alias("t"),
        F.col(tie).alias("tie"),
    ).withColumn("slice", F.floor(F.col("t") / width))

    w = Window.partitionBy("session_id", "slice").orderBy("t", "tie")
    return a.select(
        "session_id",
        "slice",
        "page_id",
        F.lead(F.struct(F.col("page_id").alias("p"))).over(w).alias("nxt"),
        F.row_number().over(w).alias("rn"),
    )


def _edge_pages() -> tuple[Column, Column]:
    # aggregates over one (session, slice): its first and its last page
    return (F.first(F.when(F.col("rn") == 1, F.col("page_id")), ignorenulls=True).alias("first_page"),
            F.first(F.when(F.col("nxt").isNull(), F.col("page_id")), ignorenulls=True).alias("last_page"))


def page_pairs(actions: DataFrame, p: TaskParams) -> DataFrame:
    """``session_id, from_page, to_page`` for consecutive actions.

    The actions are dealt out by ranges of (session, time, tie) and sorted inside
    them, so that a session, a slice or one second with any share of the log is
    spread over as many ranges as its rows need. The sorted rows are stored with
    their range and place; ``lead`` runs inside a range, and the one pair over
    each range's end is the last row of a range with the first of the next.
    """
    tie = "event_id" if "event_id" in actions.columns else "page_id"
    order = ["session_id", "t", "tie", "row"]
    # the row number only parts rows that are equal otherwise, whose order does not matter
    rows = actions.select("session_id", "page_id", X.action_seconds(F.col("action_time")).alias("t"),
                          F.col(tie).alias("tie"), F.monotonically_increasing_id().alias("row"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "session_id", "page_id", F.monotonically_increasing_id().alias("at"))
    placed = stored(placed, "page_order").withColumn("part", F.shiftright("at", 33))

    page = F.struct("session_id", "page_id").alias("page")
    follows = Window.partitionBy("part").orderBy("at")
    inside = placed.select(page, F.lead(page).over(follows).alias("nxt")).where(F.col("nxt").isNotNull())
    # one row per range: its first and its last page
    ends = placed.groupBy("part").agg(F.min_by(page, "at").alias("first"), F.max_by(page, "at").alias("last"))
    over = ends.select(F.col("last").alias("page"), F.lead("first").over(Window.orderBy("part")).alias("nxt"))
    same = F.col("nxt").isNotNull() & F.col("page.session_id").eqNullSafe(F.col("nxt.session_id"))
    return inside.unionByName(over).where(same).select(
        F.col("page.session_id").alias("session_id"), F.col("page.page_id").alias("from_page"),
        F.col("nxt.page_id").alias("to_page"))


def flow_counts(actions: DataFrame, p: TaskParams) -> DataFrame:
    """F10/F11/A13/A14 in one pass over the log: one row with ``views`` of the
    start page and the count ``n_<step>`` of every distinct step of the flow.

    A (session, slice) is reduced to its counts and its first and last page in
    the partitioning of the ordering window; only these rows are dealt again,
    by session, to add the pairs that cross slice edges.
    """
    steps = sorted({(a, b, name) for _, a, b, name in _steps(p)})
    page, to_page = F.col("page_id"), F.col("nxt.p")
    per_slice = _within_slices(actions, p).groupBy("session_id", "slice").agg(
        F.count_if(page == int(p.target_page_flow[0])).alias("views"),
        *[F.count_if((page == a) & (to_page == b)).alias(f"n_{name}") for a, b, name in steps],
        *_edge_pages(),
    )
    w = Window.partitionBy("session_id").orderBy("slice")
    linked = per_slice.withColumn("next_page", F.lead("first_page").over(w))
    crossing = [F.when((F.col("last_page") == a) & (F.col("next_page") == b), 1).otherwise(0) for a, b, _ in steps]
    return linked.agg(
        F.coalesce(F.sum("views"), F.lit(0)).cast("bigint").alias("views"),
        *[F.coalesce(F.sum(F.col(f"n_{name}") + c), F.lit(0)).cast("bigint").alias(f"n_{name}")
          for (_, _, name), c in zip(steps, crossing)],
    )


def page_pair_count(actions: DataFrame, p: TaskParams) -> DataFrame:
    """``step, n`` for target pairs that occur (a pair listed twice in
    the flow is counted once)."""
    names = sorted({name for _, _, _, name in _steps(p)})
    items = [F.struct(F.lit(name).alias("step"), F.col(f"n_{name}").alias("n")) for name in names]
    rows = F.array(*items).cast("array<struct<step:string,n:bigint>>")
    return flow_counts(actions, p).select(F.inline(rows)).where(F.col("n") > 0)


def page_start_count(actions: DataFrame, p: TaskParams) -> DataFrame:
    """``n`` = actions on the first page of the flow."""
    start = int(p.target_page_flow[0])
    return actions.agg(F.count_if(F.col("page_id") == start).alias("n"))


def page_convert_rate(actions: DataFrame, p: TaskParams) -> DataFrame:
    """``step_no, step, n, rate``; the first step is divided by the start
    page's views, each later one by the previous step's count. A missing pair
    counts 0; a zero denominator gives a NULL rate."""
    chain = [(0, None, "views")] + [(no, name, f"n_{name}") for no, _, _, name in _steps(p)]
    rows = F.array(*[F.struct(F.lit(no).alias("step_no"), F.lit(name).cast("string").alias("step"), F.col(c).alias("n"))
                     for no, name, c in chain]).cast("array<struct<step_no:bigint,step:string,n:bigint>>")
    counted = flow_counts(actions, p).select(F.inline(rows))
    prev = F.lag("n").over(Window.orderBy("step_no"))  # one row per step: parameter-sized
    return counted.select("step_no", "step", "n", X.ratio_half_up(F.col("n"), prev).alias("rate")).where(
        F.col("step_no") > 0
    )


def pack_convert_rate(rates: DataFrame, p: TaskParams) -> DataFrame:
    """``taskid, convertRate`` with ``step=rate`` items joined by ``|`` in
    step order (rates with two decimals; a NULL rate prints as ``null``)."""
    item = F.concat(
        F.col("step"), F.lit("="), F.coalesce(F.format_string("%.2f", F.col("rate")), F.lit("null"))
    )
    packed = rates.agg(F.array_sort(F.collect_list(F.struct("step_no", item.alias("item")))).alias("items"))
    return packed.select(
        F.lit(p.task_id).alias("taskid"),
        F.array_join(F.transform("items", lambda s: s["item"]), "|").alias("convertRate"),
    )
