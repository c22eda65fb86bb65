"""Position of a row inside an ordered group, without one task per group.

``row_number() over (partition by k order by o)`` sends every row of a key to
one task, so a key holding a third of the data runs in one task. Here the rows
are range-partitioned on ``(k, o)`` instead: the range partitioner samples the
data and cuts a hot key across many tasks. Each task numbers its rows locally
(rows arrive sorted, numbering is vectorised with numpy); a key that crosses
task boundaries gets the row counts of its earlier tasks added. At most
``tasks - 1`` keys cross a boundary, so the offset table has fewer than
``2 * tasks`` rows and is broadcast with that bound.

Ties: with ``rank_out``, also give the position of the first row with the same
``(k, tie_cols)`` (that is ``rank() - 1``). ``tie_cols`` must be the leading
order keys. A tie run that crosses a task boundary is the last run of its
first task, so its global start is ``offset + rows_in_task - run_rows_in_task``,
again from a bounded table of counts.

Consistency: the task numbers must be the same in the numbering pass and in
the count pass. The range partitioner's sample is seeded by the RDD id, so
two separately planned range exchanges can cut differently. Both passes are
therefore derived from the same Python pass output, whose input subtree is
identical and so planned as one reused exchange (spark.sql.exchange.reuse,
on by default). If exchange reuse is switched off, the partitioned rows are
first checkpointed to the shared checkpoint folder. Lost shuffle output is
recomputed from the same shuffle dependency, i.e. with the same cut points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_tasks
from .joins import broadcast_if_small

_PID = "_seq_pid"
_LOCAL = "_seq_local"
_LRANK = "_seq_lrank"


def _same_as_prev(frame: pd.DataFrame, prev: tuple | None) -> np.ndarray:
    """Row i equals row i-1 on all columns (null == null); row 0 is compared with ``prev``."""
    n = len(frame)
    same = np.ones(n, dtype=bool)
    for c in frame.columns:
        v = frame[c]
        sh = v.shift(1)
        eq = (v == sh) | (v.isna() & sh.isna())
        same &= eq.to_numpy(dtype=bool)
    if prev is None:
        same[0] = False
    elif frame.shape[1]:
        first = frame.iloc[0].tolist()
        same[0] = all((a == b) or (pd.isna(a) and pd.isna(b)) for a, b in zip(first, prev))
    return same


def _run_start(new: np.ndarray) -> np.ndarray:
    """Index where the run of each row starts; -1 for a run continued from before row 0."""
    pos = np.arange(len(new))
    return np.maximum.accumulate(np.where(new, pos, -1))


def _local_positions(group_cols: list[str], tie_cols: list[str] | None, sum_cols: tuple[str, ...] = ()):
    """mapInPandas body: local position (and local tie start, running sums) per group, rows sorted."""

    def run(batches):
        prev_g, prev_t = None, None
        carry_n, carry_t = 0, 0   # rows of the open group, local start of the open tie run
        carry_s = {c: 0 for c in sum_cols}  # running sums of the open group
        for pdf in batches:
            if pdf.empty:
                extra = {_LOCAL: pd.Series(dtype="int64")}
                if tie_cols is not None:
                    extra[_LRANK] = pd.Series(dtype="int64")
                for c in sum_cols:
                    extra["_seq_sum_" + c] = pd.Series(dtype="int64")
                yield pdf.assign(**extra)
                continue
            pos = np.arange(len(pdf), dtype=np.int64)
            g_same = _same_as_prev(pdf[group_cols], prev_g)
            gs = _run_start(~g_same)
            local = np.where(gs < 0, pos + carry_n, pos - gs)
            out = pdf.assign(**{_LOCAL: local})
            # running sums restart at each group start; the first group may continue
            grp_id = np.cumsum(~g_same)
            for c in sum_cols:
                v = pdf[c].fillna(0).to_numpy(dtype=np.int64)
                cs = pd.Series(v).groupby(grp_id).cumsum().to_numpy(dtype=np.int64)
                cs = np.where(grp_id == 0, cs + carry_s[c], cs)
                out["_seq_sum_" + c] = cs
                carry_s[c] = int(cs[-1])
            if tie_cols is not None:
                t_same = _same_as_prev(pdf[group_cols + tie_cols], prev_t) & g_same
                ts = _run_start(~t_same)
                out[_LRANK] = np.where(ts < 0, carry_t, local[np.maximum(ts, 0)])
                carry_t = int(out[_LRANK].iloc[-1])
                prev_t = tuple(pdf[group_cols + tie_cols].iloc[-1].tolist())
            carry_n = int(local[-1]) + 1
            prev_g = tuple(pdf[group_cols].iloc[-1].tolist())
            yield out

    return run


def _on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = left[_PID] == right[_PID]
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def sequence_index(
    df: DataFrame,
    group_cols: list[str],
    order: list[Column],
    out: str = "seq",
    rank_out: str | None = None,
    tie_cols: list[str] | None = None,
    num_tasks: int | None = None,
    size_out: str | None = None,
    sum_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside ``group_cols`` by ``order``.

    ``order`` must be a total order inside a group (end it with key columns),
    otherwise the positions of equal rows are arbitrary. ``size_out`` adds the
    number of rows of the group (a per-group table, broadcast when small).
    ``sum_cols`` (integer columns) add ``running_<col>``: the sum of the column
    over the group's rows up to and including this one, in ``order``.
    """
    spark = df.sparkSession
    n = num_tasks or shuffle_tasks(spark)
    keys = [F.col(c) for c in group_cols] + list(order)
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id()))
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        ranged = ranged.checkpoint(eager=True)
    want_rank = rank_out is not None
    fields = ranged.schema.fields + [T.StructField(_LOCAL, T.LongType(), False)]
    if want_rank:
        fields.append(T.StructField(_LRANK, T.LongType(), False))
    fields += [T.StructField("_seq_sum_" + c, T.LongType(), False) for c in sum_cols]
    local = ranged.mapInPandas(_local_positions(group_cols, tie_cols if want_rank else None, tuple(sum_cols)),
                               T.StructType(fields))

    # Rows per (task, group); only groups found in more than one task get an offset.
    counts = local.groupBy(_PID, *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias("_s_" + c)
                                         for c in sum_cols])
    gw = Window.partitionBy(*group_cols)
    before = gw.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    spans = (counts.withColumn("_tasks", F.count(F.lit(1)).over(gw))
             .filter(F.col("_tasks") > 1)
             .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))
             .select(_PID, *group_cols, "_n", "_off",
                     *[F.coalesce(F.sum("_s_" + c).over(before), F.lit(0).cast("long")).alias("_soff_" + c)
                       for c in sum_cols]))
    o = spans.alias("o")  # fewer than 2 * n rows
    res = (local.join(F.broadcast(o), _on(local, o, group_cols), "left")
           .select(local["*"], F.coalesce(o["_off"], F.lit(0).cast("long")).alias("_off"),
                   *[F.coalesce(o["_soff_" + c], F.lit(0).cast("long")).alias("_soff_" + c) for c in sum_cols]))
    res = res.withColumn(out, F.col(_LOCAL) + F.col("_off"))
    for c in sum_cols:
        res = (res.withColumn("running_" + c, F.col("_seq_sum_" + c) + F.col("_soff_" + c))
               .drop("_seq_sum_" + c, "_soff_" + c))

    if want_rank:
        tkeys = group_cols + list(tie_cols)
        tw = Window.partitionBy(*tkeys)
        runs = (local.groupBy(_PID, *tkeys).agg(F.count(F.lit(1)).alias("_m"))
                .withColumn("_tasks", F.count(F.lit(1)).over(tw))
                .filter(F.col("_tasks") > 1)
                .withColumn("_first", F.min(_PID).over(tw)))
        r = runs.alias("r")
        s = spans.alias("s")
        first = (r.filter(F.col("r." + _PID) == F.col("r._first"))
                 .join(F.broadcast(s), _on(r, s, group_cols), "inner")
                 .select(*[F.col("r." + c) for c in tkeys],
                         (F.col("s._off") + F.col("s._n") - F.col("r._m")).alias("_gstart")))
        fix = (runs.select(_PID, *tkeys).alias("a")
               .join(first.alias("b"), [F.col("a." + c).eqNullSafe(F.col("b." + c)) for c in tkeys])
               .select(*[F.col("a." + c) for c in [_PID] + tkeys], "b._gstart")
               .alias("f"))  # fewer than 2 * n rows
        cur = res.alias("cur")
        res = (cur.join(F.broadcast(fix), _on(cur, fix, tkeys), "left")
               .select(cur["*"], F.col("f._gstart").alias("_gstart"))
               .withColumn(rank_out, F.coalesce(F.col("_gstart"), F.col(_LRANK) + F.col("_off")))
               .drop("_gstart"))
    if size_out is not None:
        sizes = counts.groupBy(*group_cols).agg(F.sum("_n").alias(size_out))
        sizes = broadcast_if_small(sizes).alias("z")
        cur = res.alias("cur2")
        cond = F.lit(True)
        for c in group_cols:
            cond = cond & F.col("cur2." + c).eqNullSafe(F.col("z." + c))
        res = cur.join(sizes, cond, "left").select(cur["*"], F.col("z." + size_out))
    return res.drop(_PID, _LOCAL, "_off", *([_LRANK] if want_rank else []))
