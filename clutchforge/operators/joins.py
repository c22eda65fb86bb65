"""Join helpers: size-checked broadcast and the as-of lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when the optimizer's size estimate is below this.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (no job runs). None if unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  (remote / connect sessions)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side whose estimated size is within ``max_bytes``.

    Above the limit (or without an estimate) no hint is given: the planner
    uses a shuffle join and AQE may still switch to a broadcast once the real
    size is measured (spark.sql.adaptive.autoBroadcastJoinThreshold).
    """
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def one_row(df: DataFrame) -> DataFrame:
    """Broadcast a global aggregate (one row by construction)."""
    return F.broadcast(df)


def asof_lookup(
    facts: DataFrame,
    fact_date: Column,
    snapshots: DataFrame,
    snap_date_col: str,
    max_days_back: int,
    min_days_back: int = 1,
    out_col: str = "asof_date",
) -> DataFrame:
    """Add ``out_col`` = latest snapshot date within [fact_date - max, fact_date - min].

    Only the distinct snapshot dates take part in the range condition: the
    fact's distinct dates are joined to them (both sides are date lists, a
    few thousand rows per decade), so no fact row is compared with every
    snapshot row. The result is joined back on the fact date.
    """
    fdates = facts.select(fact_date.alias("_fd")).where(F.col("_fd").isNotNull()).distinct()
    sdates = snapshots.select(F.col(snap_date_col).alias("_sd")).where(F.col("_sd").isNotNull()).distinct()
    cand = fdates.join(
        broadcast_if_small(sdates),
        (F.col("_sd") >= F.date_sub(F.col("_fd"), max_days_back))
        & (F.col("_sd") <= F.date_sub(F.col("_fd"), min_days_back)),
    )
    best = cand.groupBy("_fd").agg(F.max("_sd").alias(out_col))
    return (facts.withColumn("_fd", fact_date)
            .join(broadcast_if_small(best), "_fd", "left")
            .drop("_fd"))
