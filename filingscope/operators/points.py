"""Additive point models: the change model, the single-filing model and the quick preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingscope import rules
from filingscope.functions.metrics import category, tier
from filingscope.schemas import KEY, RISK_SCORE, conform


def _points(rule: rules.PointRule) -> str:
    return f"CASE WHEN {rule.condition} THEN {rule.points} ELSE 0 END"


def risk_points(changes: DataFrame) -> DataFrame:
    """Points of every rule of the change model, one column per rule, and their sum."""
    points = changes.selectExpr(*KEY, *[f"{_points(r)} AS {r.name}" for r in rules.CHANGE_POINTS])
    return points.withColumn("score", F.expr(" + ".join(r.name for r in rules.CHANGE_POINTS)))


# The explanation kept with each change-model score.
FACTORS_SQL = f"""NAMED_STRUCT(
    'aum_drop_pct', COALESCE(CAST(raum_drop_pct AS DOUBLE), 0D),
    'client_drop_pct', COALESCE(CAST(client_drop_pct AS DOUBLE), 0D),
    'acct_drop_pct', COALESCE(CAST(acct_drop_pct AS DOUBLE), 0D),
    'new_disc', INT(COALESCE(new_disc_flag, FALSE)),
    'cco_changed', INT(COALESCE(cco_changed, FALSE)),
    'trend_down', INT(COALESCE(trend_down_flag, FALSE)),
    'owner_moves_12m', COALESCE(owner_moves_12m, 0),
    'adviser_age_yrs', COALESCE(adviser_age_years, 0),
    'small_raum', INT(COALESCE(raum < {rules.SMALL_RAUM}, FALSE)))"""


def score_changes(changes: DataFrame) -> DataFrame:
    """Score, factors and category of every filing change."""
    total = " + ".join(_points(r) for r in rules.CHANGE_POINTS)
    scored = (
        changes.where("sec_number IS NOT NULL AND filing_date IS NOT NULL")
        .selectExpr(*KEY, f"{total} AS score", f"{FACTORS_SQL} AS factors")
        .withColumn("risk_category", category("score", rules.CHANGE_CUTOFFS))
    )
    return conform(scored, RISK_SCORE)


SINGLE_FACTORS = {
    "disciplinary_risk": f"""CASE WHEN disciplinary_disclosures > 0
        THEN LEAST({rules.DISCLOSURE_POINTS_CAP}, disciplinary_disclosures * {rules.DISCLOSURE_POINTS_EACH}) END""",
    "size_factor_risk": f"CASE WHEN raum <> 0 THEN {tier('raum', rules.SIZE_POINTS, rules.SIZE_POINTS_ELSE)} END",
    "client_concentration_risk": f"""CASE WHEN client_count <> 0 AND raum <> 0
        THEN {tier('raum / client_count', rules.CONCENTRATION_POINTS)} END""",
    "filing_compliance_risk": "0",
    "cco_stability_risk": "0",
    "aum_volatility_risk": "0",
}


def score_single_filings(history: DataFrame) -> DataFrame:
    """Single-filing model over the filings with assets.

    A factor whose input is missing or zero is NULL, and so absent from the factors document. The three
    factors without data behind them stay at 0.
    """
    scored = history.where("raum > 0").selectExpr(*KEY, *[f"{sql} AS {n}" for n, sql in SINGLE_FACTORS.items()])
    return scored.selectExpr(
        *KEY,
        " + ".join(f"COALESCE({n}, 0)" for n in SINGLE_FACTORS) + " AS score",
        f"STRUCT({', '.join(SINGLE_FACTORS)}) AS factors",
    ).withColumn("risk_category", category("score", rules.SINGLE_CUTOFFS))


def preview_scores(history: DataFrame) -> DataFrame:
    """Ten points per disclosure plus a few for size."""
    return (
        history.where("sec_number IS NOT NULL")
        .selectExpr(
            *KEY,
            f"COALESCE(disciplinary_disclosures, 0) * {rules.DISCLOSURE_POINTS_EACH} AS disciplinary_risk",
            f"{tier('raum', rules.PREVIEW_SIZE_POINTS)} AS size_risk",
        )
        .withColumn("overall_risk", F.expr("disciplinary_risk + size_risk"))
    )
