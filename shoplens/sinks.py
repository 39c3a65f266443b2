"""Result sinks (K1-K8).

``write_result`` covers the reference's JDBC appends and managed-table
replacement. Appends are not idempotent under task or job retry, so
``write_task_result`` offers the retry-safe form: results partitioned by task
id with dynamic partition overwrite, so re-running a task replaces only its
own rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_result(df: DataFrame, target: str, mode: str = "append", fmt: str = "parquet",
                 options: dict | None = None) -> None:
    """K1-K7: write ``df`` to a JDBC table, a managed table or a path.

    ``fmt='jdbc'``: ``target`` is the table name and ``options`` carry ``url``,
    ``user``, ``password`` and ``driver``. ``fmt='table'``: ``saveAsTable``
    (``mode='overwrite'`` replaces it, as the reference's drop-and-save).
    Any other ``fmt`` is a file format and ``target`` a path.
    """
    opts = dict(options or {})
    w = df.write.mode(mode)
    if fmt == "jdbc":
        w.format("jdbc").options(dbtable=target, **opts).save()
    elif fmt == "table":
        w.options(**opts).saveAsTable(target)
    else:
        w.format(fmt).options(**opts).save(target)


def own_rows(df: DataFrame, task_id: str, task_col: str = "taskid") -> DataFrame:
    """``df`` if all its rows are of the task; writing another task's row fails."""
    other = F.concat(F.lit("a row of another task: "), F.coalesce(F.col(task_col).cast("string"), F.lit("null")))
    return df.where(F.when(F.col(task_col) == task_id, F.lit(True)).otherwise(F.raise_error(other).cast("boolean")))


def replace_table(df: DataFrame, table: str) -> None:
    """K7: replace a catalog table as a whole, without a moment in which it is missing or half written.

    The rows are written as a new version beside the old ones under the warehouse
    folder; then one catalog statement points the table to it. A reader has the old
    or the new version; a failed write changes nothing. Old versions stay, for
    readers that are still at them, until the storage's retention removes them.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"\w+(\.\w+)?", table):
        raise ValueError(f"{table!r} does not name a table")
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}_versions/{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists(table)
    if exists:
        old, new = ({f.name: f.dataType for f in x.schema} for x in (spark.table(table), df))
        if list(old.items()) != list(new.items()):
            odd = sorted(c for c in {**old, **new} if old.get(c) != new.get(c)) or list(new)
            raise ValueError(f"{table}: the new rows differ from the table in {', '.join(odd)}")
    df.write.parquet(path)
    location = path.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'" if exists
              else f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def write_task_result(df: DataFrame, path: str, task_col: str = "taskid", fmt: str = "parquet",
                      task_id: str | None = None) -> None:
    """Idempotent result write: overwrite only the partitions of the task ids in ``df``.

    A rerun without rows holds no task id, so its old rows would stay. With
    ``task_id`` the task's own folder is replaced, by an empty one if need be.
    """
    if task_id is not None:
        if not re.fullmatch(r"[A-Za-z0-9_-]+", task_id):
            raise ValueError(f"task id {task_id!r} can't name a folder")
        own_rows(df, task_id, task_col).drop(task_col).write.mode("overwrite").format(fmt).save(f"{path}/{task_col}={task_id}")
        return
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(task_col)
       .format(fmt)
       .save(path))


def register_views(views: dict[str, DataFrame]) -> None:
    """K8: expose intermediate results to SQL as temporary views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def save_bucketed_actions(df: DataFrame, table: str, num_buckets: int, partition_by_date: bool = True) -> None:
    """K7 for the action log, laid out for the session jobs.

    Partitioning by ``date`` lets the date-range scan prune whole folders;
    bucketing and sorting by ``session_id`` co-locates every session, so the
    profile aggregate, the per-(session, category) counts and the joins on
    ``session_id`` read already-clustered buckets instead of shuffling the log
    (``spark.sql.sources.bucketing.enabled``, on by default).
    """
    w = df.write.mode("overwrite").format("parquet")
    if partition_by_date:
        w = w.partitionBy("date")
    w.bucketBy(int(num_buckets), "session_id").sortBy("session_id").saveAsTable(table)
