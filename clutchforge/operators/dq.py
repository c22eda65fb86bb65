"""Data-quality rules evaluated as Spark jobs.

Every rule returns one row ``(table, rule, column, failures, ...)``; zero failures
means pass. Row-level rules of one table (not-null, accepted values,
expressions) are folded into a single aggregate pass; uniqueness is one
``groupBy`` with partial aggregation; relationships are a left-anti join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Model:
    """The row rules of a table; ``key`` names rows in reports. Nulls are the not-null rules' business alone."""
    name: str
    key: str
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()

    def rules(self, kinds: tuple[str, ...]) -> list[tuple[str, str, Column]]:
        """(rule, column, whether a row fails it) of the rules of some kinds."""
        out = [("not_null", c, F.col(c).isNull()) for c in self.not_null]
        out += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*values)) for c, values in self.accepted.items()]
        out += [("expression_is_true", f"{c} >= 0", F.col(c) < 0) for c in self.non_negative]
        return [r for r in out if r[0] in kinds]


def model_rules(model: Model, df: DataFrame, kinds: tuple[str, ...] = ("not_null", "accepted_values", "expression_is_true")) -> DataFrame:
    """One row per rule from one aggregate over ``df``: table, rule, column, failures, sample_key (the smallest
    key of the rows that fail; null where none does, or none has a key)."""
    rules = model.rules(kinds)
    key = F.col(model.key).cast("string")
    agg = df.agg(*[c for i, (_, _, fails) in enumerate(rules) for c in (
        F.count_if(fails).alias(f"_n{i}"), F.min(F.when(fails, key)).alias(f"_k{i}"))])
    rows = [F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.col(f"_n{i}").cast("bigint").alias("failures"),
                     F.col(f"_k{i}").alias("sample_key")) for i, (rule, column, _) in enumerate(rules)]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select(F.lit(model.name).alias("table"), "r.*")


def unique(table: str, df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table"), F.lit("unique").alias("rule"), F.lit(",".join(cols)).alias("column"),
        "failures")


def relationship(table: str, child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    c = child.select(F.col(child_col).alias("_k")).where(F.col("_k").isNotNull())
    p = parent.select(F.col(parent_col).alias("_k"))
    orphans = c.join(p, "_k", "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit(table).alias("table"), F.lit("relationships").alias("rule"), F.lit(child_col).alias("column"),
        "failures")


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, stacked; ``is_empty`` marks a failing table."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
        F.lit(name).alias("table"), "row_count") for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("is_empty", F.col("row_count") == 0)


def stack(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
