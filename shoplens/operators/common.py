"""Shared plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest table (in rows) that a broadcast hint may ship to every executor.
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(df: DataFrame, row_bound: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only for a side whose row count is *proven* to be at most
    ``row_bound`` (derived from parameters: flow length, k of a top-k, days of a
    date range), and only when that bound is below ``max_rows``.

    Data-dependent sides (dimensions, blacklists, session sets) get no hint: the
    planner broadcasts them only when its size estimate is under
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-decides from runtime
    sizes, falling back to a shuffle join beyond it.
    """
    return F.broadcast(df) if int(row_bound) <= max_rows else df


def broadcast_if_small(materialised: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a stored side when a count shows at most ``max_rows`` rows;
    otherwise return it unchanged for a shuffle join (with AQE skew handling).

    Counting reads the stored files' row counts, not the log they came from.
    """
    return F.broadcast(materialised) if materialised.count() <= max_rows else materialised
