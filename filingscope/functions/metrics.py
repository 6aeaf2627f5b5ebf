"""Column expressions shared by the models and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingscope.rules import CATEGORIES


def drop_pct(previous: str, current: str) -> Column:
    """Percentage lost since the previous value, 0 for growth, at most 100.

    Decimal arithmetic, multiplied before dividing, so that the only rounding is that of the quotient:
    tier limits such as 24.995 must not depend on binary fractions.
    """
    prev = f"CAST({previous} AS DECIMAL(20,2))"
    lost = f"({prev} - CAST({current} AS DECIMAL(20,2)))"
    return F.expr(f"CASE WHEN {previous} > 0 AND {current} < {previous} THEN LEAST({lost} * 100 / {prev}, 100) ELSE 0 END")


def drop_pct_integer(previous: str, current: str, growth_counts: bool) -> Column:
    """The same with integer division, i.e. whole multiples of 100.

    With ``growth_counts`` there is no guard against growth, which then comes out negative.
    """
    applies = f"{previous} > 0 AND {current} IS NOT NULL" + ("" if growth_counts else f" AND {current} < {previous}")
    lost = f"(CAST({previous} AS BIGINT) - {current})"
    return F.expr(f"CASE WHEN {applies} THEN CAST(LEAST({lost} DIV {previous} * 100, 100) AS DECIMAL(20,0)) ELSE 0 END")


def category(score: str, cutoffs: Mapping[str, float]) -> Column:
    """Category of a score; ``cutoffs`` lists the lowest score of each, most severe first."""
    branches = " ".join(f"WHEN {score} >= {lowest} THEN '{name}'" for name, lowest in cutoffs.items())
    return F.expr(f"CASE {branches} ELSE '{CATEGORIES[-1]}' END")


def severity(category_column: str = "risk_category") -> Column:
    """1 for the most severe category up to 4; NULL for anything else."""
    branches = " ".join(f"WHEN '{name}' THEN {rank}" for rank, name in enumerate(CATEGORIES, start=1))
    return F.expr(f"CASE {category_column} {branches} END")


def tier(value: str, tiers: Sequence[tuple[int, int]], otherwise: int = 0) -> str:
    """SQL text for the points of the first limit that ``value`` exceeds."""
    branches = " ".join(f"WHEN {value} > {limit} THEN {points}" for limit, points in tiers)
    return f"CASE {branches} ELSE {otherwise} END"


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Exact quotient of two counts, rounded half up; NULL for an empty denominator."""
    quotient = F.try_divide(numerator.cast("decimal(20,0)"), denominator.cast("decimal(20,0)"))
    return F.round(quotient, scale)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` with two decimals, rounded half up."""
    return ratio(part.cast("decimal(20,0)") * 100, whole, 2)


def clip(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Bound a value; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def rounded(value: Column, decimals: int = 6) -> Column:
    """Rounding half up by the same double arithmetic any SQL engine has."""
    unit = float(10**decimals)
    return F.floor(value * unit + 0.5) / unit
