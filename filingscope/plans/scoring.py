"""Whole scoring runs: from filings to scores, and the views that SQL users query."""

from __future__ import annotations

from pyspark.sql import DataFrame

from filingscope.operators.changes import filing_changes
from filingscope.operators.history import dedupe_filings
from filingscope.operators.points import score_changes, score_single_filings
from filingscope.plans import reports


def score_filings(filings: DataFrame, pct_mode: str = "fractional", tiebreak: str | None = None) -> DataFrame:
    """Scores of the change model. With ``tiebreak`` the filings may repeat a firm and date."""
    history = filings if tiebreak is None else dedupe_filings(filings, tiebreak)
    return score_changes(filing_changes(history, pct_mode))


def register_views(filings: DataFrame, scores: DataFrame) -> None:
    """Temporary views over a filing history and its scores: the two tables, the single-filing scores and
    the standing statistics."""
    views = {
        "filings": filings,
        "risk_scores": scores,
        "single_filing_scores": score_single_filings(filings),
        "dashboard_stats": reports.dashboard_stats(filings),
        "risk_stats": reports.risk_stats_latest(scores),
        "risk_statistics": reports.risk_statistics_latest(scores),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def register_functions(filings: DataFrame, scores: DataFrame) -> None:
    """Temporary SQL table functions with arguments, over the views of :func:`register_views`:

    ``risk_statistics_of(category)``: the statistics of the newest date, of one category or (null) of all;
    ``firms_in_category(category, lowest)``: the firms of a category, or of all, with at least that score.
    """
    register_views(filings, scores)
    spark = scores.sparkSession
    of_category = "(wanted IS NULL OR risk_category = wanted)"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION risk_statistics_of(wanted STRING)
        RETURNS TABLE (risk_category STRING, firm_count BIGINT, percentage DOUBLE, avg_score DOUBLE)
        RETURN SELECT risk_category, firm_count, CAST(percentage AS DOUBLE), CAST(avg_score AS DOUBLE)
        FROM risk_statistics WHERE {of_category}"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION firms_in_category(wanted STRING, lowest INT)
        RETURNS TABLE (sec_number STRING, filing_date DATE, score INT, risk_category STRING, firm_name STRING)
        RETURN SELECT s.sec_number, s.filing_date, s.score, s.risk_category, COALESCE(f.firm_name, 'Unknown')
        FROM risk_scores s LEFT JOIN filings f ON f.sec_number = s.sec_number AND f.filing_date = s.filing_date
        WHERE {of_category} AND s.score >= lowest"""
    )
