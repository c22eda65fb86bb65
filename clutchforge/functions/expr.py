"""Column expressions shared by the jobs (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"
PROFILE_KEY = "__profile__"
UNRANKED = 999
# Source priority for player rows (lower wins); anything else gets 5.
PLAYER_SOURCE_PRIORITY = {"faceit": 2, "pandascore": 3, "csapi": 4}
# Ranking source priority for the team dimension (lower wins).
RANKING_SOURCE_PRIORITY = {"liquipedia": 1, "csapi": 2}
# Tier boundaries on world ranking: 1-10, 11-30, 31-50, everything else 4.
TIER_BOUNDS = ((1, 1, 10), (2, 11, 30), (3, 31, 50))
DEFAULT_TIER = 4
# Round outcome words per side.
CT_OUTCOMES = ("ct_win", "bomb_defused", "stopwatch")
T_OUTCOMES = ("t_win", "bomb_exploded")
# Lenient boolean words.
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the columns as text, nulls replaced by a marker, joined by '-'."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def normalize_team_name(c: str | Column) -> Column:
    """trim, drop a leading 'team' + separators (any case), lower-case, keep [a-z0-9]."""
    stripped = F.regexp_replace(F.trim(col(c)), r"(?i)^team[\s_-]+", "")
    return F.regexp_replace(F.lower(stripped), r"[^a-z0-9]+", "")


def source_priority(c: str | Column, table: dict[str, int], default: int) -> Column:
    out = None
    for name, prio in table.items():
        out = (F.when(col(c) == name, F.lit(prio)) if out is None
               else out.when(col(c) == name, F.lit(prio)))
    return out.otherwise(F.lit(default))


def tier(world_ranking: str | Column) -> Column:
    wr = col(world_ranking)
    out = None
    for t, lo, hi in TIER_BOUNDS:
        cond = wr.between(lo, hi)
        out = F.when(cond, F.lit(t)) if out is None else out.when(cond, F.lit(t))
    return out.otherwise(F.lit(DEFAULT_TIER))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, null when the denominator is 0 or null."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def strict_greatest(*cols: str | Column) -> Column:
    """greatest() that returns null when any argument is null (warehouse rule)."""
    cs = [col(c) for c in cols]
    cond = cs[0].isNotNull()
    for c in cs[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.greatest(*cs))


def flag(cond: Column) -> Column:
    """1/0 from a predicate; null predicate counts as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def round_side(outcome: str | Column) -> Column:
    o = F.lower(F.trim(col(outcome)))
    return F.when(o.isin(*CT_OUTCOMES), F.lit("ct")).when(o.isin(*T_OUTCOMES), F.lit("t"))


def lenient_bool(c: str | Column) -> Column:
    s = F.lower(F.trim(col(c).cast("string")))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def region_label(c: str | Column) -> Column:
    s = F.trim(col(c))
    return F.when(s.isNull() | (s == "") | (F.lower(s) == "global"), F.lit("Unknown")).otherwise(s)


def team_label(name: str | Column, team_id: str | Column) -> Column:
    n = F.trim(col(name))
    i = F.trim(col(team_id).cast("string"))
    return (F.when(n.isNotNull() & (n != ""), n)
            .when(i.isNotNull() & (i != ""), F.concat(F.lit("Team "), i))
            .otherwise(F.lit("Unknown team")))


def score_pair(text: str | Column) -> tuple[Column, Column]:
    """'a-b' -> (a, b) as bigint, null on anything else."""
    m = r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    t = col(text)
    a = F.when(t.rlike(m), F.regexp_extract(t, m, 1).cast("bigint"))
    b = F.when(t.rlike(m), F.regexp_extract(t, m, 2).cast("bigint"))
    return a, b


def iso_date_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd")


def exact_avg(c: str | Column) -> Column:
    """Average of a double column that does not depend on summation order.

    Double sums change in the last bits with the order rows arrive in, i.e.
    with partitioning, and averages that sit exactly on a threshold or a
    rounding boundary then flip. The values are summed as decimal(28,10)
    (exact, order-independent) and divided once.
    """
    d = col(c).cast("decimal(28,10)")
    return F.try_divide(F.sum(d), F.count(d)).cast("double")
