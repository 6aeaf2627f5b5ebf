"""Firm lists, search, pages and details."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope import rules
from filingscope.functions.text import contains_text
from filingscope.operators.history import latest_per_firm, latest_per_firm_ties, only_keys
from filingscope.schemas import KEY

SORTABLE = ("crd", "aum", "overall_risk_score", "risk_category")
MODEL_COLUMNS = ("overall_risk_score", "risk_category", *rules.COMPONENT_WEIGHTS)
DRILL_DOWN = ("last_calculation_date", "risk_factors")  # shown where the scores have them


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of the conditions that were asked for; true if there are none."""
    return reduce(and_, conditions, F.lit(True))


def _in_category(category: str | None) -> list[Column]:
    return [] if category is None else [F.col("risk_category") == category]


def firms_by_category(scores: DataFrame, filings: DataFrame, category: str | None = None, limit: int = 100) -> DataFrame:
    """Highest scores, optionally of one category, with the firm's name in that filing.

    The list is cut before the names are joined: the join is one to one, so it cannot change the cut.
    """
    return _named(scores.where(all_of(_in_category(category))), filings, limit)


def top_risky_firms(scores: DataFrame, filings: DataFrame, limit: int = 10) -> DataFrame:
    return _named(scores.where(F.col("risk_category").isin("High", "Critical")), filings, limit)


def _named(scores: DataFrame, filings: DataFrame, limit: int) -> DataFrame:
    order = [F.desc("score"), F.desc("filing_date"), F.col("sec_number")]
    top = scores.orderBy(*order).limit(limit)
    return (
        top.join(only_keys(filings.select(*KEY, "firm_name"), top), KEY, "left")
        .withColumn("firm_name", F.coalesce("firm_name", F.lit("Unknown")))
        .orderBy(*order)
    )


def with_latest_profile(scores: DataFrame, filings: DataFrame) -> DataFrame:
    """Every score beside its firm's newest filing (not the filing that was scored)."""
    latest = latest_per_firm(filings.select(*KEY, "firm_name", "raum", "client_count", "account_count"))
    return scores.join(latest.withColumnRenamed("filing_date", "latest_filing_date"), "sec_number", "left").withColumn(
        "firm_name", F.coalesce("firm_name", F.lit("Unknown"))
    )


def firms_latest_profile(scores: DataFrame, filings: DataFrame, category: str | None = None, limit: int = 100) -> DataFrame:
    return _highest(with_latest_profile(scores.where(all_of(_in_category(category))), filings), limit)


def _highest(firms: DataFrame, limit: int) -> DataFrame:
    return firms.orderBy(
        F.desc("score"), F.desc_nulls_first("latest_filing_date"), "sec_number", "filing_date"
    ).limit(limit)


def explore(
    scores: DataFrame,
    filings: DataFrame,
    search: str | None = None,
    category: str | None = None,
    band: str | None = None,
    new_disclosures: bool = False,
    limit: int = 50,
) -> DataFrame:
    """Interactive filters over scores with the latest profile, all applied before the cut."""
    on_scores = _in_category(category)
    if band is not None:
        lowest, below = rules.SCORE_BANDS[band]
        on_scores += [F.col("score") >= lowest] if lowest is not None else []
        on_scores += [F.col("score") < below] if below is not None else []
    if new_disclosures:
        on_scores.append(F.col("factors.new_disc") != 0)
    firms = with_latest_profile(scores.where(all_of(on_scores)), filings)
    if search:
        firms = firms.where(
            contains_text(F.col("firm_name"), search, ignore_case=True)
            | contains_text(F.col("sec_number"), search, ignore_case=True)
        )
    return _highest(firms, limit)


def firm_details(filings: DataFrame, weighted: DataFrame, crd: int | None = None) -> DataFrame:
    """Newest filing and model score per firm, or of one firm."""
    wanted = filings if crd is None else filings.where(F.col("crd") == crd)
    latest = latest_per_firm(
        wanted.select("crd", "filing_date", "raum", "total_clients", "total_accounts"), firm="crd"
    )
    return _with_model(latest, weighted)


def _with_model(latest: DataFrame, weighted: DataFrame, *extra: str) -> DataFrame:
    shown = [*MODEL_COLUMNS, *[c for c in DRILL_DOWN if c in weighted.columns]]
    return latest.join(weighted.select("crd", *shown), "crd", "left").select(
        "crd",
        F.col("raum").alias("aum"),
        "total_clients",
        "total_accounts",
        F.col("filing_date").alias("last_filing_date"),
        *extra,
        *shown,
    )


def search_firms(
    filings: DataFrame,
    weighted: DataFrame,
    search: str | None = None,
    category: str | None = None,
    min_aum: float | None = None,
    max_aum: float | None = None,
) -> DataFrame:
    """Firms at their newest filing (all of them if several share the date) with their model score.

    ``search`` looks into the firm id and, where the filings have one, the firm name.
    """
    name = [c for c in ("firm_name",) if c in filings.columns]
    conditions = _in_category(category)
    if search:
        conditions.append(reduce(or_, [contains_text(F.col(c), search) for c in ("crd", *name)]))
    if min_aum is not None:
        conditions.append(F.col("aum") >= min_aum)
    if max_aum is not None:
        conditions.append(F.col("aum") <= max_aum)
    newest = latest_per_firm_ties(
        filings.select("crd", "filing_date", "raum", "total_clients", "total_accounts", *name), firm="crd"
    )
    return _with_model(newest, weighted, *name).where(all_of(conditions))


def firm_page(firms: DataFrame, sort_by: str = "crd", descending: bool = False, page: int = 1, page_size: int = 20) -> DataFrame:
    """One page, with the total number of firms and pages. Unknown sort columns fall back to the firm id."""
    column = sort_by if sort_by in SORTABLE else "crd"
    lead = F.desc_nulls_first(column) if descending else F.asc_nulls_last(column)
    # counting the id alone lets Spark drop the join with the scores, unless a filter needs them
    total = firms.select("crd").agg(F.count("*")).scalar()
    return (
        firms.orderBy(lead, "crd", "last_filing_date")
        .offset((page - 1) * page_size)
        .limit(page_size)
        .withColumn("total", total)
        .withColumn("total_pages", F.ceil(F.col("total") / page_size))
    )


def firm_page_after(
    firms: DataFrame,
    after: tuple | None = None,
    sort_by: str = "crd",
    descending: bool = False,
    page_size: int = 20,
) -> DataFrame:
    """The page that follows a row of the last one, in the order of :func:`firm_page`.

    ``after`` is that row's (sort value, firm id, last filing date); None asks for the first page. The place is a
    condition on the rows, so a page costs the same wherever it stands: no earlier page is sorted or skipped.
    """
    column = sort_by if sort_by in SORTABLE else "crd"
    lead = F.desc_nulls_first(column) if descending else F.asc_nulls_last(column)
    if after is not None:
        value, crd, day = after
        same = (F.col("crd") > crd) | ((F.col("crd") == crd) & (F.col("last_filing_date") > day))
        if value is None:
            level = F.col(column).isNull()
            further = F.col(column).isNotNull() if descending else F.lit(False)
        else:
            level = F.col(column) == value
            further = F.col(column) < value if descending else (F.col(column) > value) | F.col(column).isNull()
        firms = firms.where(further | (level & same))
    return firms.orderBy(lead, "crd", "last_filing_date").limit(page_size)
