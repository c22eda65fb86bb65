"""Statistics of the rows before a row, for groups of any size.

A window function sends a group to one task. Here rows get their position from
``sequence_index`` (a range exchange that cuts large groups), and:

* ``sums_of_last`` (``rows between k preceding and 1 preceding``) cuts a group into segments of
  ``segment_rows`` positions and hands the last k rows of each to the next one as a halo. A
  segment with its halo has all the rows a frame needs, and is a window partition of bounded size.
* ``near_latest`` drops rows that are many days older than another row of their key, as far as a batch shows it:
  a pass without a shuffle before a window that hangs on the key's latest day.
* ``sums_before`` (all rows of an earlier time; rows of the same time don't see each other)
  first adds up the rows of each time, so that its running sums are over one row per time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import sequence_index

SEGMENT_ROWS = 50_000


def sums_of_last(df: DataFrame, group_cols: list[str], order: list[Column], sums: dict[str, str], k: int, count_out: str,
                 segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Add, for each ``column -> output`` of ``sums``, the column's sum over the ``k`` rows of the group before the row
    (null where there are none), and how many these are. ``order`` must be a total order inside a group."""
    segment_rows = max(segment_rows, k)
    placed = sequence_index(df, group_cols, order, out="_pos")
    segment, inside = F.floor(F.col("_pos") / segment_rows), F.col("_pos") % segment_rows
    home = F.struct(segment.alias("at"), F.lit(False).alias("halo"))
    next_one = F.when(inside >= segment_rows - k, F.struct((segment + 1).alias("at"), F.lit(True).alias("halo")))
    dealt = placed.select("*", F.explode(F.array_compact(F.array(home, next_one))).alias("_segment"))
    frame = Window.partitionBy(*group_cols, F.col("_segment.at")).orderBy("_pos").rowsBetween(-k, -1)
    out = dealt.select("*", F.count(F.lit(1)).over(frame).alias(count_out),
                       *[F.sum(c).over(frame).alias(o) for c, o in sums.items()])
    return out.where(~F.col("_segment.halo")).drop("_segment", "_pos")


def _near_latest(key: str, day: str, days: int):
    """mapInArrow body of ``near_latest``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pc.dictionary_encode(batch.column(key))
            at = pc.fill_null(codes.indices, len(codes.dictionary)).to_numpy(zero_copy_only=False)
            unknown = batch.column(day).is_null().to_numpy(zero_copy_only=False)
            d = pc.fill_null(batch.column(day).cast(pa.int32()).cast(pa.int64()), 0).to_numpy(zero_copy_only=False).copy()
            d[unknown] = -1 << 40  # before any day
            latest = np.full(len(codes.dictionary) + 1, -1 << 40)
            np.maximum.at(latest, at, d)
            yield batch.filter(pa.array(d >= latest[at] - days))

    return run


def near_latest(df: DataFrame, key: str, day: str, days: int) -> DataFrame:
    """``df`` without rows whose ``day`` (a date) is more than ``days`` before that of another row of their ``key`` in the
    same batch, or unknown where that one's is known. All rows up to ``days`` before the key's latest day are there, and of
    a key without days all; older ones may be. Where rows of a key lie together, few older ones are left."""
    return df.mapInArrow(_near_latest(key, day, days), df.schema)


def sums_before(df: DataFrame, group_cols: list[str], time_col: str, sums: dict[str, str]) -> DataFrame:
    """One row per group and time: for each ``column -> output`` of ``sums`` (integers) the column's sum over the
    group's rows of an earlier time. Rows of unknown time count nowhere. Join it to rows by group and time."""
    per_time = df.where(F.col(time_col).isNotNull()).groupBy(*group_cols, time_col).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in sums])
    placed = sequence_index(per_time, group_cols, [F.col(time_col).asc()], out="_pos", sum_cols=tuple(sums))
    return placed.select(*group_cols, time_col, *[(F.col(f"running_{c}") - F.col(c)).alias(o) for c, o in sums.items()])
