"""Weighted statistical model: six components between 0 and 1 per firm, keyed by the firm id.

Every component comes from one ordered pass over each firm's history and one aggregation on the same
partitioning, so the whole model costs a single exchange of the history.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingscope import rules
from filingscope.functions.metrics import category, clip
from filingscope.operators.history import firm_window
from filingscope.operators.quantiles import exact_percentiles


def firm_measures(history: DataFrame) -> DataFrame:
    """The raw measures behind the components, one row per firm.

    ``history``: crd, filing_date, raum, total_clients, total_accounts, cco_id, disclosure_flag, with one
    row per firm and date. "Previous" means the previous filing that has the value at all.
    """
    before = firm_window("crd").rowsBetween(Window.unboundedPreceding, -1)
    stepped = history.select(
        "*",
        F.last("raum", ignorenulls=True).over(before).cast("double").alias("prev_raum"),
        F.last("cco_id", ignorenulls=True).over(before).alias("prev_cco"),
    )
    officer = F.col("cco_id").isNotNull()
    officer_change = officer & (F.col("prev_cco").isNull() | (F.col("cco_id") != F.col("prev_cco")))
    counted = F.col("total_clients").isNotNull() & F.col("total_accounts").isNotNull()
    change = F.try_divide(F.col("raum").cast("double"), F.col("prev_raum")) - 1
    measures = stepped.groupBy("crd").agg(
        F.count_if(F.col("disclosure_flag") == "Y").alias("disclosure_count"),
        F.count("*").alias("filing_count"),
        _years("filing_date").alias("years_active"),
        F.count("raum").alias("aum_data_points"),
        F.stddev_samp(change).alias("aum_volatility"),
        F.avg(change).alias("aum_trend"),
        F.max(F.struct("filing_date", "raum")).getField("raum").cast("double").alias("aum"),
        F.max(F.when(counted, F.struct("filing_date", "total_clients", "total_accounts"))).alias("counted"),
        F.count_if(officer).alias("officer_filings"),
        F.count_if(officer_change).alias("cco_changes"),
        _years(F.when(officer, F.col("filing_date"))).alias("officer_years"),
    )
    return measures.select(
        "*",
        F.col("counted.total_clients").alias("total_clients"),
        F.col("counted.total_accounts").alias("total_accounts"),
        _client_ratio(F.col("counted.total_clients"), F.col("counted.total_accounts")).alias("client_account_ratio"),
    ).drop("counted")


def _years(date: Column | str) -> Column:
    return F.datediff(F.max(date), F.min(date)) / rules.DAYS_PER_YEAR


def _client_ratio(clients: Column, accounts: Column) -> Column:
    return F.when(
        clients.isNotNull() & accounts.isNotNull(), clients.cast("double") / F.greatest(accounts, F.lit(1))
    )


def ratio_scale(history: DataFrame) -> DataFrame:
    """The 95th percentile of clients per account over all filings: one row, one column."""
    ratios = history.select(_client_ratio(F.col("total_clients"), F.col("total_accounts")).alias("ratio"))
    return exact_percentiles(ratios, "ratio", {"scale": rules.RATIO_QUANTILE})


def disclosure_risk() -> Column:
    return clip(F.log1p(_per_year("disclosure_count")) / F.log(F.lit(10.0)))


def aum_volatility_risk() -> Column:
    scaled = F.least(F.col("aum_volatility") * rules.VOLATILITY_SCALE, F.lit(1.0))
    return F.when(F.col("aum_data_points") >= 2, F.coalesce(scaled, F.lit(0.0))).otherwise(0.0)


def client_concentration_risk(scale: Column) -> Column:
    return F.coalesce(clip(F.try_divide(F.col("client_account_ratio"), scale)), F.lit(0.0))


def filing_compliance_risk() -> Column:
    return clip(F.lit(1.0) - _per_year("filing_count") / float(rules.EXPECTED_FILINGS_PER_YEAR))


def cco_stability_risk() -> Column:
    share = F.least(F.col("cco_changes") / float(rules.OFFICER_CHANGES_CAP), F.lit(1.0))
    return F.when(F.col("officer_filings") >= 2, share).otherwise(0.0)


def size_deviation() -> Column:
    optimal = float(rules.OPTIMAL_RAUM)
    return F.abs(F.coalesce("aum", F.lit(0.0)) - optimal) / optimal


def size_factor_risk() -> Column:
    return F.tanh(size_deviation())


def _per_year(count: str) -> Column:
    return F.col(count) / F.greatest(F.col("years_active"), F.lit(rules.MIN_YEARS))


def model_factors() -> Column:
    """The measures behind a firm's score, for drill-down.

    A firm with fewer than two filings that have assets has no volatility and no trend, one with fewer than two that
    name an officer no changes and no tenure: these are 0 here, as the components count them. The measures themselves
    stay as counted. Two filings with assets of which the first has zero give no change: volatility and trend are NULL.
    """
    moves = F.col("aum_data_points") >= 2
    officers = F.col("officer_filings") >= 2
    tenure = F.col("officer_years") / F.greatest(F.col("cco_changes"), F.lit(1))
    return F.struct(
        "disclosure_count",
        _per_year("disclosure_count").alias("disclosure_rate"),
        "years_active",
        F.when(moves, F.col("aum_volatility")).otherwise(0.0).alias("aum_volatility"),
        F.when(moves, F.col("aum_trend")).otherwise(0.0).alias("aum_trend"),
        "aum_data_points",
        "client_account_ratio",
        "total_clients",
        "total_accounts",
        _per_year("filing_count").alias("filing_frequency"),
        (_per_year("filing_count") / float(rules.EXPECTED_FILINGS_PER_YEAR)).alias("compliance_ratio"),
        "filing_count",
        F.when(officers, F.col("cco_changes")).otherwise(0).alias("cco_changes"),
        F.when(officers, tenure).otherwise(0.0).alias("avg_tenure_years"),
        "aum",
        size_deviation().alias("size_deviation"),
    )


def weighted_scores(
    history: DataFrame, measures: DataFrame | None = None, calculated: Column | None = None
) -> DataFrame:
    """Components, weighted total, category and factors per firm, and when they were ``calculated`` (default: now)."""
    calculated = F.current_timestamp() if calculated is None else calculated
    measures = firm_measures(history) if measures is None else measures
    components = measures.select(
        "crd",
        disclosure_risk().alias("disclosure_risk"),
        aum_volatility_risk().alias("aum_volatility_risk"),
        client_concentration_risk(ratio_scale(history).scalar()).alias("client_concentration_risk"),
        filing_compliance_risk().alias("filing_compliance_risk"),
        cco_stability_risk().alias("cco_stability_risk"),
        size_factor_risk().alias("size_factor_risk"),
        model_factors().alias("risk_factors"),
        calculated.alias("last_calculation_date"),
    )
    weighted = [F.coalesce(name, F.lit(0.0)) * weight for name, weight in rules.COMPONENT_WEIGHTS.items()]
    return components.withColumn("overall_risk_score", clip(reduce(add, weighted))).withColumn(
        "risk_category", category("overall_risk_score", rules.WEIGHTED_CUTOFFS)
    )


def period_changes(history: DataFrame) -> DataFrame:
    """Relative asset change from one filing with assets on record to the next; NULL after a zero."""
    w = firm_window("crd")
    known = history.select("crd", "filing_date", F.col("raum").cast("double").alias("raum")).where("raum IS NOT NULL")
    return known.select("crd", "filing_date", "raum", (F.try_divide(F.col("raum"), F.lag("raum").over(w)) - 1).alias("aum_change"))
