"""Skew-safe positions, ranks and running sums against Spark's window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from clutchforge.operators.sequence import sequence_index


def _frame(spark, n=12000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.03 else f"k{rnd.randint(0, 40)}")
        v = None if rnd.random() < 0.05 else rnd.randint(0, 25)
        rows.append((k, v, rnd.randint(0, 1), i))
    return spark.createDataFrame(rows, "k string, v int, y int, id long")


def test_grouped_positions_ranks_and_sums_match_windows(spark):
    df = _frame(spark)
    got = sequence_index(df, ["k"], [F.col("v").asc_nulls_last(), F.col("id")], out="pos",
                         rank_out="rk", tie_cols=["v"], sum_cols=("y",), size_out="n", num_tasks=7)
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last(), F.col("id"))
    exp = df.select("id", (F.row_number().over(w) - 1).alias("pos2"),
                    (F.rank().over(Window.partitionBy("k").orderBy(F.col("v").asc_nulls_last())) - 1).alias("rk2"),
                    F.sum("y").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("y2"),
                    F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n2"))
    bad = got.join(exp, "id").where("pos != pos2 or rk != rk2 or running_y != y2 or n != n2")
    assert got.count() == df.count()
    assert bad.count() == 0


def test_global_order_with_ties(spark):
    df = _frame(spark, n=8000, seed=3)
    got = sequence_index(df, [], [F.col("v").desc_nulls_first(), F.col("id")], out="pos",
                         rank_out="rk", tie_cols=["v"], num_tasks=5)
    exp = df.select("id", (F.row_number().over(Window.orderBy(F.col("v").desc_nulls_first(), "id")) - 1).alias("pos2"),
                    (F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())) - 1).alias("rk2"))
    assert got.join(exp, "id").where("pos != pos2 or rk != rk2").count() == 0


def test_hot_key_is_spread_over_tasks(spark):
    df = _frame(spark, n=20000, seed=11)
    ranged = df.repartitionByRange(8, "k", "v", "id").withColumn("pid", F.spark_partition_id())
    tasks_with_hot = ranged.where("k = 'hot'").select("pid").distinct().count()
    assert tasks_with_hot > 1
