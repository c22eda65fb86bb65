"""Frames and cohort ranks against Spark's own windows and plain Python, with a hot group cut over many tasks."""

import datetime
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clutchforge.operators.frames import sums_before, sums_of_last
from clutchforge.operators.ranking import cohort_ranks


def _matches(spark, n=3000, seed=4):
    r = random.Random(seed)
    day = lambda: datetime.date(2024, 1, 1) + datetime.timedelta(r.randrange(60))
    rows = [(i, "hot" if r.random() < 0.5 else r.choice(["a", "b", "c", None]), r.choice(["m1", "m2", None]), day(), r.randrange(2))
            for i in range(n)]
    rows += [(n + i, "once", "m1", day(), 1) for i in range(1)] + [(n + 10, "hot", "m1", None, 1)]
    return spark.createDataFrame(rows, "id long, team string, map string, day date, win long")


@pytest.mark.parametrize("k, segment", [(10, 50), (1, 1), (10, 3), (7, 10 ** 6), (200, 64)])
def test_last_rows_of_a_hot_group(spark, k, segment):
    df = _matches(spark).where("day is not null")
    order = [F.col("day").asc(), F.col("id").asc()]
    got = sums_of_last(df, ["team"], order, {"win": "wins"}, k, "n", segment_rows=segment)
    w = Window.partitionBy("team").orderBy("day", "id").rowsBetween(-k, -1)
    want = df.select("*", F.count(F.lit(1)).over(w).alias("n"), F.sum("win").over(w).alias("wins"))
    key = lambda rows: sorted((r.id, r.team, r.n, r.wins) for r in rows.select("id", "team", "n", "wins").collect())
    assert key(got) == key(want)


def test_no_partition_of_a_frame_is_larger_than_a_segment(spark):
    df = _matches(spark).where("day is not null")
    plan = sums_of_last(df, ["team"], [F.col("day").asc(), F.col("id").asc()], {"win": "wins"}, 5, "n", segment_rows=100)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in text.splitlines() if "Window [" in line and "sum(win" in line)
    assert re.search(r"\], \[team#\d+, _w0#\d+L\], \[_pos", window)  # partitioned by team and segment


@pytest.mark.parametrize("group", [["team"], ["team", "map"]])
def test_rows_of_one_day_do_not_see_each_other(spark, group):
    df = _matches(spark)
    sums = sums_before(df.withColumn("one", F.lit(1).cast("bigint")), group, "day", {"one": "n", "win": "wins"})
    rows = [tuple(r) for r in df.select(*group, "day", "win").collect()]
    want = {}
    for *g, d, _ in rows:
        if d is not None:
            earlier = [w for *h, e, w in rows if h == g and e is not None and e < d]
            want[(*g, d)] = (len(earlier), sum(earlier))
    assert {tuple(r)[:-2]: (r.n, r.wins) for r in sums.select(*group, "day", "n", "wins").collect()} == want


def test_ranks_in_another_cohort(spark):
    r = random.Random(8)
    rows = [(i, r.choice([1, 2, 2, 2, 3, 5, None]), r.choice([None, *range(8)]), round(r.random(), 2)) for i in range(400)]
    rows += [(900, 2, 4.0, None), (None, 2, 4.0, 0.5)]
    df = spark.createDataFrame([(i, t, None if a is None else float(a), b) for i, t, a, b in rows], "id long, tier int, a double, b double")
    got = cohort_ranks(df, F.col("tier"), F.when(F.col("tier") > 1, F.col("tier") - 1), {"a": "ra", "b": "rb"}, ["id"]).collect()
    assert len(got) == len(rows)
    for x in got:
        for stat, rank in (("a", x.ra), ("b", x.rb)):
            v = x[stat]
            cohort = [y[stat] for y in got if x.tier and x.tier > 1 and y.tier == x.tier - 1 and y[stat] is not None]
            want = None if v is None or not cohort else sum(c < v for c in cohort) / len(cohort)
            assert rank == want, (x, want)
