"""Rank statistics inside groups that may be few and large (tiers).

A window ``over (partition by tier)`` with four tiers runs in four tasks no
matter how big the cluster is, and an exact ``percentile_cont`` aggregate
merges every value of a tier in one task. Both helpers here place rows with
the skew-safe ``sequence_index`` instead. Several statistics are handled in
one pass: the rows are unpivoted to (stat, group, value) and placed once with
``(stat, group)`` as the group key, then pivoted back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small
from .sequence import sequence_index


def _long(df: DataFrame, keep: list[str], stats: list[str]) -> DataFrame:
    """(keep..., _stat, _v) rows, one per input row and statistic (one scan)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("_stat"), F.col(s).cast("double").alias("_v"))
                                for s in stats])).alias("_p")
    return df.select(*keep, pairs).select(*keep, "_p._stat", "_p._v")


def percent_ranks(df: DataFrame, group_cols: list[str], stats: dict[str, str], key_cols: list[str]) -> DataFrame:
    """Add ``percent_rank() over (partition by group order by stat asc nulls last)``
    for each ``stat -> output`` in ``stats``. ``key_cols`` identify a row.

    rank - 1 is the number of rows of the group with a smaller value, so it
    is read off a value histogram: one aggregate to (stat, group, value) ->
    count (map-side combined), running counts over the histogram, and an
    equi-join back. The histogram holds distinct values, not rows: for the
    rounded averages ranked here its size is fixed by value range and
    precision, whatever the number of players. Nulls sort last.
    """
    long = _long(df, key_cols + group_cols, list(stats))
    g = ["_stat"] + group_cols
    hist = long.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # window over distinct values of one (stat, group): bounded by the value domain
    w = Window.partitionBy(*g)
    ranks = hist.select(*g, "_v",
                        (F.sum("_c").over(w.orderBy(F.col("_v").asc_nulls_last())
                                          .rowsBetween(Window.unboundedPreceding, -1))).alias("_below"),
                        F.sum("_c").over(w).alias("_n"))
    ranks = ranks.withColumn("_below", F.coalesce("_below", F.lit(0)))
    pr = F.when(F.col("_n") > 1, F.col("_below") / (F.col("_n") - 1)).otherwise(F.lit(0.0)).cast("double")
    lg, rk = long.alias("l"), ranks.alias("r")
    cond = [F.col("l." + c).eqNullSafe(F.col("r." + c)) for c in g + ["_v"]]
    pr = F.when(F.col("r._n") > 1, F.col("r._below") / (F.col("r._n") - 1)).otherwise(F.lit(0.0)).cast("double")
    j = lg.join(rk, cond, "left").select(*[F.col("l." + c).alias(c) for c in key_cols],
                                         F.col("l._stat").alias("_stat"), pr.alias("_pr"))
    wide = j.groupBy(*key_cols).agg(*[F.max(F.when(F.col("_stat") == s, F.col("_pr"))).alias(o)
                                      for s, o in stats.items()])
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in key_cols]  # a key may be null
    return df.alias("d").join(wide.alias("w"), same, "left").select("d.*", *[F.col(f"w.{o}") for o in stats.values()])


def percentiles_cont(df: DataFrame, group_cols: list[str], stats: dict[str, str], p: float,
                     key_cols: list[str]) -> DataFrame:
    """Exact ``percentile_cont(p) within group (order by stat)`` per group for each
    ``stat -> output``; nulls ignored. The two rows around position p * (n - 1)
    are picked by filter and interpolated."""
    long = _long(df, key_cols + group_cols, list(stats)).where(F.col("_v").isNotNull())
    g = ["_stat"] + group_cols
    placed = sequence_index(long, g, [F.col("_v").asc()] + [F.col(c).asc() for c in key_cols],
                            out="_pos", size_out="_n")
    rn = (F.col("_n") - 1) * F.lit(p)
    lo, hi = F.floor(rn), F.ceil(rn)
    picked = placed.where((F.col("_pos") == lo) | (F.col("_pos") == hi)).select(
        *g, "_v", "_pos", rn.alias("_rn"), lo.alias("_lo"), hi.alias("_hi"))
    per = picked.groupBy(*g).agg(
        F.max(F.when(F.col("_pos") == F.col("_lo"), F.col("_v"))).alias("_lo_v"),
        F.max(F.when(F.col("_pos") == F.col("_hi"), F.col("_v"))).alias("_hi_v"),
        F.max("_rn").alias("_rn"), F.max("_lo").alias("_lo"))
    val = F.when(F.col("_hi_v") == F.col("_lo_v"), F.col("_lo_v")).otherwise(
        F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * (F.col("_rn") - F.col("_lo")))
    wide = per.groupBy(*group_cols).agg(*[F.max(F.when(F.col("_stat") == s, val)).alias(o)
                                          for s, o in stats.items()])
    groups = df.select(*group_cols).distinct()
    return groups.join(broadcast_if_small(wide), group_cols, "left")


def cohort_ranks(df: DataFrame, cohort: Column, probed: Column, stats: dict[str, str], key_cols: list[str]) -> DataFrame:
    """Add, for each ``stat -> output``, which share of another cohort's rows has a smaller value.

    A row belongs to ``cohort`` and is ranked in the values of cohort ``probed`` (null: in none).
    All statistics are done together: values are counted once per (stat, cohort, value), each
    entry counts as members of its cohort and, with no members, as a question to the cohorts it is ranked in;
    running counts over the entries, placed by the sequence operator, answer them, and
    rows meet the answers by an equi-join. Null values have no rank and no part in a cohort."""
    keys = ["_stat", "_cohort", "_v"]
    long = _long(df.select("*", cohort.alias("_own"), probed.alias("_probed")), key_cols + ["_own", "_probed"], list(stats)) \
        .where(F.col("_v").isNotNull())
    counted = long.groupBy("_stat", "_own", "_probed", "_v").agg(F.count(F.lit(1)).alias("_n"))
    entry = F.explode(F.array(F.struct(F.col("_own").alias("_cohort"), F.col("_n").alias("_members")),
                              F.struct(F.col("_probed").alias("_cohort"), F.lit(0).cast("bigint").alias("_members"))))
    entries = counted.select("_stat", "_v", entry.alias("_e")).select("_stat", "_e._cohort", "_v", "_e._members") \
        .where(F.col("_cohort").isNotNull()).groupBy(*keys).agg(F.sum("_members").alias("_members"))
    placed = sequence_index(entries, ["_stat", "_cohort"], [F.col("_v").asc()], out="_pos", sum_cols=("_members",))
    sizes = entries.groupBy("_stat", "_cohort").agg(F.sum("_members").alias("_size"))
    answers = placed.join(broadcast_if_small(sizes), ["_stat", "_cohort"]).where("_size > 0").select(
        *keys, ((F.col("running__members") - F.col("_members")) / F.col("_size")).alias("_share"))
    ranked = long.withColumnRenamed("_probed", "_cohort").join(answers, keys)
    wide = ranked.groupBy(*key_cols).agg(*[F.max(F.when(F.col("_stat") == s, F.col("_share"))).alias(o) for s, o in stats.items()])
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in key_cols]
    return df.alias("d").join(wide.alias("w"), same, "left").select("d.*", *[F.col(f"w.{o}") for o in stats.values()])
