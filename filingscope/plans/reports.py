"""Reports over filings and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingscope import rules
from filingscope.functions.metrics import percent, ratio, severity
from filingscope.operators.factors import mentions, parse_factors
from filingscope.operators.history import latest_date, latest_per_firm, only_keys, since
from filingscope.operators.quantiles import exact_percentiles
from filingscope.schemas import KEY


# --- category statistics -----------------------------------------------------------------------------


def _latest_by_category(scores: DataFrame) -> DataFrame:
    """Count, sum, lowest and highest score per category on the newest date, in one pass.

    The scores shrink to one row per date and category first; the newest date is taken from those few rows.
    """
    per_date = scores.groupBy("filing_date", "risk_category").agg(
        F.count("*").alias("firm_count"),
        F.sum("score").alias("score_sum"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )
    newest = F.max("filing_date").over(Window.partitionBy())
    return per_date.withColumn("newest", newest).where("filing_date = newest").drop("newest")


def _share_of_total(count: str) -> Column:
    """Percentage of the grand total; for inputs of one row per category."""
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()))


def risk_statistics_latest(scores: DataFrame) -> DataFrame:
    """Per category on the newest date: filings, share, average score."""
    return (
        _latest_by_category(scores)
        .select(
            "risk_category",
            "firm_count",
            _share_of_total("firm_count").alias("percentage"),
            ratio(F.col("score_sum"), F.col("firm_count")).alias("avg_score"),
        )
        .orderBy(severity())
    )


def risk_stats_latest(scores: DataFrame) -> DataFrame:
    """Per category on the newest date: filings, average, lowest and highest score."""
    return (
        _latest_by_category(scores)
        .select(
            "risk_category",
            "firm_count",
            (F.col("score_sum") / F.col("firm_count")).alias("avg_score"),
            "min_score",
            "max_score",
        )
        .orderBy(severity())
    )


def risk_statistics_all_dates(scores: DataFrame) -> DataFrame:
    """Per category over all dates: distinct firms, share, average score. A firm can be in several categories."""
    return (
        scores.groupBy("risk_category")
        .agg(
            F.countDistinct("sec_number").alias("firm_count"),
            ratio(F.sum("score"), F.count("*")).alias("avg_score"),
        )
        .select("risk_category", "firm_count", _share_of_total("firm_count").alias("percentage"), "avg_score")
        .orderBy(severity())
    )


def category_summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Per category over all scores: count, average, lowest, highest."""
    return (
        scores.groupBy("risk_category")
        .agg(
            F.count("*").alias("count"),
            F.avg(score).alias("avg_score"),
            F.min(score).alias("min_score"),
            F.max(score).alias("max_score"),
        )
        .orderBy(F.desc("avg_score"))
    )


def dashboard_summary(scores: DataFrame, filings: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Category statistics with the number of firms and of recent filings beside them.

    Each firm is summed up first, where its scores already are; firms per category and in total then come
    from the same pass.
    """
    names = rules.CATEGORIES
    per_firm = scores.groupBy("sec_number").agg(
        *[F.expr(f"COUNT_IF(risk_category = '{name}') AS n_{name}") for name in names],
        *[F.expr(f"SUM(CASE WHEN risk_category = '{name}' THEN score END) AS s_{name}") for name in names],
    )
    totals = per_firm.agg(
        F.expr("COUNT(*) AS total_firms"),
        *[F.expr(f"COUNT_IF(n_{name} > 0) AS f_{name}") for name in names],
        *[F.expr(f"SUM(n_{name}) AS n_{name}") for name in names],
        *[F.expr(f"SUM(s_{name}) AS s_{name}") for name in names],
    )
    rows = ", ".join(f"'{name}', f_{name}, n_{name}, s_{name}" for name in names)
    return (
        totals.selectExpr("total_firms", f"STACK({len(names)}, {rows}) AS (risk_category, firm_count, n, score_sum)")
        .where("firm_count > 0")
        .select(
            "risk_category",
            "firm_count",
            _share_of_total("firm_count").alias("percentage"),
            ratio(F.col("score_sum"), F.col("n")).alias("avg_score"),
            "total_firms",
        )
        .withColumn("recent_filings", recent_filings(filings, days, as_of).scalar())
        .orderBy(severity())
    )


def category_distribution(scores: DataFrame) -> DataFrame:
    """Count and share of the four categories, with their descriptions; categories without a score count 0."""
    spark = scores.sparkSession
    all_categories = spark.createDataFrame(
        [(i, name, rules.CATEGORY_DESCRIPTIONS[name]) for i, name in enumerate(reversed(rules.CATEGORIES))],
        "position int, risk_category string, description string",
    )
    counts = scores.groupBy("risk_category").agg(F.count("*").alias("count"))
    return (
        all_categories.join(counts, "risk_category", "left")
        .fillna(0, ["count"])
        .select("position", "risk_category", "description", "count", _share_of_total("count").alias("percentage"))
        .orderBy("position")
    )


def category_cards(scores: DataFrame) -> DataFrame:
    """Distinct firms: in total and per category, as one row of columns.

    One row of flags per firm, then sums: scores come partitioned by firm, so this needs no further shuffle,
    where a distinct count per category would multiply the rows.
    """
    per_firm = scores.groupBy("sec_number").agg(
        *[F.expr(f"INT(BOOL_OR(risk_category = '{name}'))").alias(name) for name in rules.CATEGORIES]
    )
    return per_firm.agg(
        F.count("*").alias("total_firms"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(f"{name.lower()}_firms") for name in rules.CATEGORIES],
    )


def risk_trends(filings: DataFrame, scores: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Filings per day and category of the firm, one column per category, over the last ``days``."""
    dated = since(filings, days, as_of).select("crd", "filing_date").join(scores.select("crd", "risk_category"), "crd", "left")
    names = [*reversed(rules.CATEGORIES), "Unscored"]
    return (
        dated.withColumn("risk_category", F.coalesce("risk_category", F.lit("Unscored")))
        .groupBy("filing_date")
        .pivot("risk_category", names)
        .agg(F.count(F.lit(1)))
        .na.fill(0, names)
        .select("filing_date", *[F.col(n).alias(n.lower()) for n in names])
        .orderBy("filing_date")
    )


def overview_stats(
    filings: DataFrame, change_scores: DataFrame, weighted: DataFrame, days: int = 30, as_of: Column | None = None
) -> DataFrame:
    """Headline figures as (metric, value): firms, assets on the newest date, recent activity and disclosures,
    severe alerts, and the category distribution on the newest date. Recent are the ``days`` before ``as_of``
    (default: the newest date in the data)."""
    recent = F.col("filing_date") >= F.date_sub(latest_date(filings) if as_of is None else as_of, days)
    newest = filings.groupBy("filing_date").agg(F.sum("raum").alias("raum"))
    per_firm = filings.groupBy("crd").agg(
        F.bool_or(recent).alias("recent"), F.bool_or(recent & (F.col("disclosure_flag") == "Y")).alias("disclosed")
    )
    firms = per_firm.agg(
        F.count("*").alias("total_firms"),
        F.count_if("recent").alias("firms_with_recent_activity"),
        F.count_if("disclosed").alias("new_disclosures"),
    )
    assets = newest.agg(F.coalesce(F.max_by("raum", "filing_date"), F.lit(0)).alias("total_aum"))
    alerts = weighted.agg(F.count_if(F.col("risk_category").isin("Critical", "High")).alias("high_severity_alerts"))
    distribution = risk_statistics_latest(change_scores).select(
        F.concat(F.lit("risk_distribution."), "risk_category").alias("metric"),
        F.col("firm_count").cast("double").alias("value"),
    )
    parts = [_as_metrics(part) for part in (firms, assets, alerts)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(distribution)


def _as_metrics(row: DataFrame) -> DataFrame:
    return row.select(*[F.col(c).cast("double").alias(c) for c in row.columns]).unpivot(
        [], row.columns, "metric", "value"
    )


def risk_run_summary(scores: DataFrame) -> DataFrame:
    """After a scoring run: statistics on the newest date beside the number of scores and the newest date."""
    per_date = scores.groupBy("filing_date", "risk_category").agg(F.count("*").alias("firm_count"))
    whole = Window.partitionBy()
    return (
        per_date.select(
            "risk_category",
            "filing_date",
            "firm_count",
            F.sum("firm_count").over(whole).alias("total_scores"),
            F.max("filing_date").over(whole).alias("latest_date"),
        )
        .where("filing_date = latest_date")
        .drop("filing_date")
        .orderBy(severity())
    )


# --- filing profiles ---------------------------------------------------------------------------------


def dashboard_stats(filings: DataFrame) -> DataFrame:
    raum = F.col("raum")
    return filings.agg(
        F.countDistinct("sec_number").alias("total_firms"),
        F.count("*").alias("total_filings"),
        F.max("filing_date").alias("latest_filing_date"),
        F.avg("raum").alias("avg_raum"),
        F.count_if(raum >= 1_000_000_000).alias("firms_over_1b"),
        F.count_if(raum >= 100_000_000).alias("firms_over_100m"),
        F.count_if(raum < 100_000_000).alias("firms_under_100m"),
    )


def filing_census(filings: DataFrame) -> DataFrame:
    """Rows, firms, dates and their range, and rows without a key."""
    return filings.agg(
        F.count("*").alias("total_filings"),
        F.countDistinct("sec_number").alias("unique_firms"),
        F.countDistinct("filing_date").alias("unique_dates"),
        F.min("filing_date").alias("first_date"),
        F.max("filing_date").alias("last_date"),
        F.count_if(F.col("sec_number").isNull()).alias("null_sec_numbers"),
        F.count_if(F.col("filing_date").isNull()).alias("null_filing_dates"),
    )


def recent_filings(filings: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Number of filings in the ``days`` before ``as_of`` (default: the newest date in the data).

    One pass: the filings shrink to a count per date before the newest date is needed.
    """
    per_date = filings.groupBy("filing_date").agg(F.count("*").alias("n"))
    anchor = F.max("filing_date").over(Window.partitionBy()) if as_of is None else as_of
    return (
        per_date.withColumn("anchor", anchor)
        .where(F.col("filing_date") >= F.date_sub("anchor", days))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("recent_filings"))
    )


def raum_counts(filings: DataFrame) -> DataFrame:
    """Filings by presence of assets, and how many of those without assets have disclosures."""
    raum = F.col("raum")
    excluded = raum.isNull() | (raum == 0)
    return filings.agg(
        F.count("*").alias("total_firms"),
        F.count_if(raum > 0).alias("firms_with_raum"),
        F.count_if(raum == 0).alias("firms_raum_zero"),
        F.count_if(raum.isNull()).alias("firms_raum_null"),
        F.count_if(excluded).alias("missing_firms"),
        F.count_if(excluded & (F.col("disciplinary_disclosures") > 0)).alias("missing_with_disclosures"),
    )


def raum_status() -> Column:
    raum = F.col("raum")
    return F.when(raum > 0, "RAUM > 0").when(raum == 0, "RAUM = 0").when(raum.isNull(), "RAUM = NULL")


def _disclosed() -> Column:
    return F.count_if(F.col("disciplinary_disclosures") > 0)


def raum_status_breakdown(filings: DataFrame) -> DataFrame:
    return (
        filings.groupBy(raum_status().alias("raum_status"))
        .agg(
            F.count("*").alias("total_firms"),
            _disclosed().alias("firms_with_disclosures"),
            percent(_disclosed(), F.count("*")).alias("disclosure_pct"),
        )
        .orderBy("raum_status")
    )


def scoring_coverage(filings: DataFrame) -> DataFrame:
    """Over each firm's newest filing with assets: how many have disclosures."""
    latest = latest_per_firm(filings.where("raum > 0").select(*KEY, "disciplinary_disclosures"))
    return latest.agg(
        F.count("*").alias("firms_processed"),
        _disclosed().alias("with_disclosures"),
        percent(_disclosed(), F.count("*")).alias("disclosure_pct"),
    )


def disclosure_counts(filings: DataFrame) -> DataFrame:
    n = F.col("disciplinary_disclosures")
    return filings.agg(
        F.count("*").alias("total_firms"),
        F.count_if(n > 0).alias("with_disclosures"),
        F.count_if(n == 0).alias("zero_disclosures"),
        F.count_if(n.isNull()).alias("null_disclosures"),
        F.sum(n).alias("total_disclosures"),
    )


def value_histogram(filings: DataFrame, column: str) -> DataFrame:
    return filings.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.asc_nulls_last(column))


def count_anomalies(filings: DataFrame) -> DataFrame:
    """Missing, negative, zero and huge client and account counts."""

    def classes(column: str, label: str) -> list[Column]:
        c = F.col(column)
        return [
            F.count_if(c.isNull()).alias(f"null_{label}"),
            F.count_if(c < 0).alias(f"negative_{label}"),
            F.count_if(c == 0).alias(f"zero_{label}"),
            F.count_if(c > 1_000_000).alias(f"huge_{label}"),
            F.max(c).alias(f"max_{label}"),
        ]

    return filings.agg(
        F.count("*").alias("total_records"), *classes("client_count", "clients"), *classes("account_count", "accounts")
    )


def raum_percentiles(filings: DataFrame) -> DataFrame:
    """Count, range, average, median, 95th and 99th percentile of the assets, in one row."""
    wanted = {"median_raum": 0.5, "p95_raum": 0.95, "p99_raum": 0.99}
    percentiles = exact_percentiles(filings, "raum", wanted).select(F.struct(*wanted).alias("p")).scalar()
    return filings.agg(
        F.count("*").alias("total_firms"),
        F.count_if(F.col("raum") > 0).alias("firms_with_raum"),
        F.min("raum").alias("min_raum"),
        F.max("raum").alias("max_raum"),
        F.avg("raum").alias("avg_raum"),
    ).select("*", *[percentiles.getField(name).alias(name) for name in wanted])


def filings_by_date(filings: DataFrame) -> DataFrame:
    return filings.groupBy("filing_date").agg(F.count("*").alias("count")).orderBy(F.desc("filing_date"))


def filings_by_year(filings: DataFrame) -> DataFrame:
    return filings.groupBy(F.year("filing_date").alias("year")).agg(F.count("*").alias("count")).orderBy("year")


def multi_filing_firms(filings: DataFrame, limit: int = 10) -> DataFrame:
    """Firms with more than one filing with assets, most filings first."""
    return (
        filings.where("raum > 0")
        .groupBy("sec_number")
        .agg(F.count("*").alias("filing_count"))
        .where("filing_count > 1")
        .orderBy(F.desc("filing_count"), "sec_number")
        .limit(limit)
    )


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, non-null and distinct values and the value range (as text) per column.

    Counts and ranges are one row of partial aggregates. Values are made distinct by hash and only then counted by column:
    a smallest text per group would make Spark sort every value of every column.
    """
    texts = df.select(*[F.col(c).cast("string").alias(str(i)) for i, c in enumerate(columns)])
    places = [str(i) for i in range(len(columns))]
    measures = {"non_null": F.count, "min_text": F.min, "max_text": F.max}
    whole = texts.agg(
        F.count("*").alias("rows"), *[f(p).alias(f"{name}_{p}") for p in places for name, f in measures.items()]
    )
    shown = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("total_rows"),
            *[F.col(f"{name}_{p}").alias(name) for name in measures],
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.lit(p).alias("place"),
        )
        for p, c in zip(places, columns)
    ]
    values = texts.unpivot([], places, "place", "value").where("value IS NOT NULL").distinct()
    counted = values.groupBy("place").agg(F.count("*").alias("distinct_values"))
    return (
        whole.select(F.explode(F.array(*shown)).alias("r"))
        .select("r.*")
        .join(counted, "place", "left")
        .select(
            "column_name", "total_rows", "non_null", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
            "min_text", "max_text", "data_type",
        )
    )


def column_ranges(df: DataFrame, columns: Sequence[str], samples: int = 10) -> DataFrame:
    """Smallest and largest value of each column in the order of its type, shown as text, and its ``samples``
    smallest distinct values. Numbers are ordered as numbers, dates as dates, other values as text.

    The ranges are one row of partial aggregates. Values are made distinct by one exchange on the value, as for a
    distinct count; each task then cuts its own to ``samples`` per column before they meet.
    """
    edges = df.agg(
        *[f(c).cast("string").alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("min", F.min), ("max", F.max))]
    )
    shown = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"min_{i}").alias("min_value"), F.col(f"max_{i}").alias("max_value"))
            for i, c in enumerate(columns)
        ]
    )
    numbers = {c: isinstance(df.schema[c].dataType, T.NumericType) for c in columns}
    exact = "decimal(38,10)"  # doubles beyond it are ordered by their text

    def number(c: str) -> Column:
        return F.expr(f"try_cast(`{c}` AS {exact})") if numbers[c] else F.lit(None).cast(exact)

    values = F.array(
        *[F.struct(F.lit(c).alias("column_name"), number(c).alias("number"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    distinct = df.select(F.explode(values).alias("v")).select("v.*").where("value IS NOT NULL").distinct()
    first = Window.partitionBy("column_name").orderBy(F.asc_nulls_last("number"), "value")
    kept = distinct.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= samples)
    listed = kept.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct("nth", "value"))).alias("kept"))
    listed = listed.select("column_name", F.transform("kept", lambda x: x["value"]).alias("sample_values"))
    ranges = edges.select(F.explode(shown).alias("r")).select("r.*")
    return ranges.join(listed, "column_name", "left")


# --- top lists ---------------------------------------------------------------------------------------


def top_filings(filings: DataFrame, by: Sequence[str], columns: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` filings by descending ``by``, missing values last, key as tiebreak."""
    order = [F.desc_nulls_last(c) for c in by]
    return filings.orderBy(*order, *[F.col(c) for c in KEY]).select(*columns).limit(limit)


def disclosed_firms(filings: DataFrame, scores: DataFrame, limit: int = 10, how: str = "inner") -> DataFrame:
    """Filings with disclosures and their score, most disclosures first; ``how="left"`` keeps unscored ones."""
    return (
        filings.where("disciplinary_disclosures > 0")
        .join(scores.select(*KEY, "score", "risk_category"), KEY, how)
        .orderBy(F.desc("disciplinary_disclosures"), F.desc_nulls_last("score"), *KEY)
        .select(*KEY, "firm_name", "raum", "disciplinary_disclosures", "score", "risk_category")
        .limit(limit)
    )


def excluded_disclosed_firms(filings: DataFrame, limit: int = 10) -> DataFrame:
    """Newest filings with disclosures that no score covers, because they have no assets."""
    return (
        filings.where("disciplinary_disclosures > 0 AND (raum = 0 OR raum IS NULL)")
        .orderBy(F.desc("filing_date"), "sec_number")
        .select("firm_name", "sec_number", "raum", "disciplinary_disclosures", "filing_date")
        .limit(limit)
    )


def coverage_gap(filings: DataFrame, documents: DataFrame, factor: str = "disciplinary_risk") -> DataFrame:
    """How many filings should carry a disciplinary factor, and how many scores do."""
    with_raum = F.col("raum") > 0
    expected = filings.agg(
        F.count_if(with_raum).alias("firms_with_raum"),
        F.count_if(with_raum & (F.col("disciplinary_disclosures") > 0)).alias("firms_with_disclosures"),
    )
    carried = documents.agg(
        F.struct(
            F.count("*").alias("total"), F.count_if(mentions("factors_json", factor)).alias("with_factor")
        )
    ).scalar()
    return expected.select(
        "*",
        carried.getField("total").alias("total_risk_scores"),
        carried.getField("with_factor").alias("with_disciplinary"),
        (F.col("firms_with_disclosures") - carried.getField("with_factor")).alias("missing"),
    )


def top_with_factors(scores: DataFrame, filings: DataFrame, limit: int = 10) -> DataFrame:
    """Highest scores with firm data and one row per factor of the parsed document."""
    top = scores.select(*KEY, "score", "risk_category", "factors_json").orderBy(F.desc("score"), *KEY).limit(limit)
    return top.join(only_keys(filings, top), KEY, "left").select(
        *KEY,
        F.coalesce("firm_name", F.lit("Unknown")).alias("firm_name"),
        "score",
        "risk_category",
        "raum",
        "client_count",
        "disciplinary_disclosures",
        F.explode(parse_factors("factors_json")).alias("factor", "value"),
    )


def disclosure_lists(scores: DataFrame) -> DataFrame:
    """Disclosures of a score as an array, and what a firm card shows of it."""
    listed = F.when(
        F.col("factors.new_disc") == 1,
        F.array(F.struct(F.lit(True).alias("is_new"), F.col("risk_category").alias("severity"))),
    ).otherwise(F.array().cast("array<struct<is_new:boolean,severity:string>>"))
    return scores.select(*KEY, listed.alias("disclosures")).select(
        *KEY,
        F.size("disclosures").alias("disclosures"),
        F.size(F.filter("disclosures", lambda d: d.is_new)).alias("new_disclosures"),
        F.exists("disclosures", lambda d: d.severity.isin("High", "Critical")).alias("has_high_severity"),
        F.try_element_at(F.slice("disclosures", 1, 2), F.lit(1)).getField("severity").alias("first_severity"),
    )
