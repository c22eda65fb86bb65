"""Keep one row per key: the "row_number() = 1" pattern as an aggregation.

``row_number() over (partition by key order by ...) = 1`` sorts every row of a
key in one task. Written as ``max(struct(ordering..., row))`` it becomes an
aggregate with a map-side partial step: copies of a hot key collapse to one
row per task before the shuffle, so a key holding a third of the data costs
the same as any other. The struct ends with the row itself, which breaks ties
and is the result, so a row is sorted and shuffled once, not as a value and again
as its own tie-break. The helpers below build ordering fields for each SQL direction.
Structs compare field by field with null smallest.

``keep_first_laid_out`` also leaves the rows in key ranges, for a table whose readers sum by
leading keys: the ranges are made of the rows themselves and the aggregate runs inside them,
so there is one shuffle and not one for the dedupe and one for the layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def desc_nulls_last(c: Column) -> list[Column]:
    return [c.isNotNull(), c]


def desc_nulls_first(c: Column) -> list[Column]:
    return [c.isNull(), c]


def asc_nulls_last(c: Column) -> list[Column]:
    """Ascending for numeric columns (by negation)."""
    return [c.isNotNull(), -c]


def asc_nulls_first(c: Column) -> list[Column]:
    return [c.isNull(), -c]


def whole_row(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """Final tie-break over every column (descending, nulls last) so the pick is deterministic."""
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])


def keep_first(df: DataFrame, keys: list[str | Column], ordering: list[Column]) -> DataFrame:
    """One row per ``keys``: the row whose ``struct(*ordering)`` is largest, of equal ones the largest row."""
    order = [c.alias(f"_o{i}") for i, c in enumerate(ordering)]
    named = tuple(k for k in keys if isinstance(k, str))  # the same in a group, so not moved twice
    winner = F.max(F.struct(*order, whole_row(df, named).alias("_row")))
    return df.groupBy(*keys).agg(winner.alias("_keep")).select(
        *[F.col(c) if c in named else F.col(f"_keep._row.{c}").alias(c) for c in df.columns])


# Keys whose hash is one of ``HASH_BUCKETS`` values that hold more rows than ``MOST_ROWS`` are collapsed map-side first.
HASH_BUCKETS = 1 << 16
MOST_ROWS = 500_000


def keep_first_laid_out(df: DataFrame, keys: list[str | Column], ordering: list[Column], parts: int,
                        most_rows: int = MOST_ROWS) -> DataFrame:
    """``keep_first``, its rows in ``parts`` ranges of ``keys``. A key is in one range, so keys of very many rows
    (found by counting rows per hash; at most rows / ``most_rows`` hashes come to the driver) take the way of ``keep_first``."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys]), F.lit(HASH_BUCKETS))
    full = [r[0] for r in df.groupBy(bucket.alias("_b")).count().where(F.col("count") > most_rows).select("_b").collect()]
    if not full:
        return keep_first(df.repartitionByRange(parts, *keys), keys, ordering)
    few = df.where(~bucket.isin(full)).repartitionByRange(parts, *keys)
    many = keep_first(df.where(bucket.isin(full)), keys, ordering).repartitionByRange(parts, *keys)
    return keep_first(few, keys, ordering).unionByName(many)


def keep_unique(df: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Keys that occur exactly once (``qualify count(*) over (partition by key) = 1``)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.max(c).alias(c) for c in value_cols]
    return df.groupBy(*keys).agg(*aggs).filter(F.col("_n") == 1).drop("_n")


def keep_unambiguous(df: DataFrame, keys: list[str | Column], value_col: str, out: str | None = None) -> DataFrame:
    """Keys whose ``value_col`` has one distinct value (``having count(distinct v) = 1``)."""
    return (df.groupBy(*keys)
            .agg(F.count_distinct(value_col).alias("_d"), F.max(value_col).alias(out or value_col))
            .filter(F.col("_d") == 1).drop("_d"))
