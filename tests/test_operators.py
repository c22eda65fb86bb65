"""Dedupe, joins, ranking helpers, DQ rules and expressions on small frames."""

from pyspark.sql import functions as F

from clutchforge.functions.expr import exact_avg, normalize_team_name, strict_greatest, surrogate_key, tier
from clutchforge.operators import dq
from clutchforge.operators.dedupe import asc_nulls_last, desc_nulls_last, keep_first, keep_unambiguous, keep_unique, whole_row
from clutchforge.operators.joins import asof_lookup, broadcast_if_small
from clutchforge.operators.ranking import percent_ranks, percentiles_cont


def test_keep_first_orders_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", "2024-01-02", 1), ("a", None, 9), ("a", "2024-01-02", 5),
                                ("b", None, 1), ("b", None, 2)], "k string, d string, x int")
    got = keep_first(df, ["k"], desc_nulls_last(F.col("d")) + [whole_row(df)])
    rows = {r.k: (r.d, r.x) for r in got.collect()}
    assert rows == {"a": ("2024-01-02", 5), "b": (None, 2)}


def test_keep_first_ascending_numeric(spark):
    df = spark.createDataFrame([("a", 3), ("a", None), ("a", 1)], "k string, r int")
    got = keep_first(df, ["k"], asc_nulls_last(F.col("r")) + [whole_row(df)]).collect()
    assert got[0].r == 1


def test_unique_and_unambiguous(spark):
    df = spark.createDataFrame([("x", "EU"), ("x", "EU"), ("y", "NA"), ("z", "EU"), ("z", "NA")], "n string, r string")
    assert {r.n for r in keep_unique(df, ["n"], ["r"]).collect()} == {"y"}
    assert {(r.n, r.r) for r in keep_unambiguous(df, ["n"], "r").collect()} == {("x", "EU"), ("y", "NA")}


def test_asof_lookup_walks_back_with_tolerance(spark):
    facts = spark.createDataFrame([(1, "2024-02-10"), (2, "2024-02-01"), (3, "2024-03-30")], "id int, d string") \
        .withColumn("d", F.to_date("d"))
    snaps = spark.createDataFrame([("2024-02-01",), ("2024-03-01",)], "sd string").withColumn("sd", F.to_date("sd"))
    got = {r.id: r.asof_date for r in asof_lookup(facts, F.col("d"), snaps, "sd", 15, 1).collect()}
    assert str(got[1]) == "2024-02-01"      # 9 days back
    assert got[2] is None                    # same day does not count
    assert got[3] is None                    # 29 days back is beyond the tolerance


def test_percent_ranks_and_percentiles_match_sql(spark):
    rows = [(i, i % 3, float(i % 7) if i % 11 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g int, v double")
    got = percent_ranks(df, ["g"], {"v": "pr"}, ["id"])
    df.createOrReplaceTempView("pr_in")
    exp = spark.sql("select id, percent_rank() over (partition by g order by v asc nulls last) as pr2 from pr_in")
    assert got.join(exp, "id").where("abs(pr - pr2) > 1e-12").count() == 0
    pc = {r.g: r.p85 for r in percentiles_cont(df, ["g"], {"v": "p85"}, 0.85, ["id"]).collect()}
    ex = {r.g: r.p for r in spark.sql(
        "select g, percentile_cont(0.85) within group (order by v) as p from pr_in group by g").collect()}
    assert all(abs(pc[k] - ex[k]) < 1e-12 for k in ex)


def test_dq_rules(spark):
    df = spark.createDataFrame([("1", "csapi"), (None, "other"), ("1", None)], "id string, source string")
    rr = {(r.rule, r.column): r.failures for r in dq.model_rules(
        dq.Model("t", "id", ("id",), {"source": ("csapi",)}), df).collect()}
    assert rr == {("not_null", "id"): 1, ("accepted_values", "source"): 1}
    assert dq.unique("t", df, ["id"]).collect()[0].failures == 1
    parent = spark.createDataFrame([("1",)], "id string")
    child = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    assert dq.relationship("t", child, "id", parent, "id").collect()[0].failures == 1


def test_expressions(spark):
    df = spark.createDataFrame([(" Team_Vitality ", 5, None, 1.05), ("NAVI", 25, 3, 1.045)],
                               "name string, wr int, x int, r double")
    out = df.select(normalize_team_name("name").alias("n"), tier("wr").alias("t"),
                    strict_greatest("wr", "x").alias("g"), surrogate_key("x").alias("sk")).collect()
    assert [o.n for o in out] == ["vitality", "navi"]
    assert [o.t for o in out] == [1, 2]
    assert out[0].g is None and out[1].g == 25
    assert out[0].sk == "8ed3b4fc16ec0b24de8e6abd8de1d4fb" or len(out[0].sk) == 32
    avg = df.agg(exact_avg("r").alias("a")).collect()[0].a
    assert avg == 1.0475


def test_broadcast_only_small_sides(spark):
    small = spark.range(10)
    hinted = broadcast_if_small(small, max_bytes=10 ** 9)
    assert hinted is not small
    assert broadcast_if_small(small, max_bytes=1) is small
