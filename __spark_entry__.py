"""Registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from filingscope.functions import metrics, text  # noqa: E402
from filingscope.operators import changes as ch  # noqa: E402
from filingscope.operators import components as comp  # noqa: E402
from filingscope.operators import factors as fac  # noqa: E402
from filingscope.operators import history as hist  # noqa: E402
from filingscope.operators import points as pts  # noqa: E402
from filingscope.operators import quantiles as quant  # noqa: E402
from filingscope.plans import firms, reports  # noqa: E402
from filingscope.plans.scoring import register_functions, register_views, score_filings  # noqa: E402
from filingscope.schemas import FILING, KEY, WEIGHTED_SCORE, conform  # noqa: E402
from filingscope.session import shared_dir  # noqa: E402
from filingscope.sinks import snapshots  # noqa: E402
from filingscope.sinks import tables as sinks  # noqa: E402
from filingscope.sources import archives, csv_files, derive, links, normalize  # noqa: E402
from filingscope.sources.tables import filings, model_input, table  # noqa: E402
from filingscope.streaming import incremental  # noqa: E402

try:  # the package for training data and its pipeline may be absent; anything else that is missing is an error
    import corpus_pipeline
    from filingscope.llm import queries as llm_queries
except ModuleNotFoundError as absent:
    if absent.name not in ("corpus_pipeline", "filingscope.llm", "filingscope.llm.common"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

CHANGE_COLUMNS = ch.NEEDED
PROFILE = (*KEY, "firm_name", "raum", "client_count", "account_count")
FORM_COLUMNS = (
    "sec_number", "crd_number", "filing_date", "raum", "client_count", "account_count", "cco_name",
    "disciplinary_disclosures", "firm_name", "firm_type", "sec_region", "main_office_country",
)


def edge(df: DataFrame) -> DataFrame:
    """Results as a JSON client sees them: ISO dates, plain numbers."""

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def rounded(df: DataFrame, *columns: str, decimals: int = 6) -> DataFrame:
    return df.withColumns({c: metrics.rounded(F.col(c).cast("double"), decimals) for c in columns})


# --- shared inputs -----------------------------------------------------------------------------------


def change_rows(spark: SparkSession, sf: str, mode: str = "fractional") -> DataFrame:
    return ch.filing_changes(filings(spark, sf, CHANGE_COLUMNS), mode)


def scores(spark: SparkSession, sf: str, mode: str = "fractional") -> DataFrame:
    return score_filings(filings(spark, sf, CHANGE_COLUMNS), mode)


def flat_scores(df: DataFrame) -> DataFrame:
    return df.select(*KEY, "score", "risk_category", "factors.*")


def score_documents(spark: SparkSession, sf: str) -> DataFrame:
    return scores(spark, sf).withColumn("factors_json", fac.factors_json())


def single_scores(spark: SparkSession, sf: str) -> DataFrame:
    columns = (*KEY, "raum", "client_count", "disciplinary_disclosures")
    return pts.score_single_filings(filings(spark, sf, columns))


def single_documents(spark: SparkSession, sf: str) -> DataFrame:
    return single_scores(spark, sf).withColumn("factors_json", fac.factors_json())


def weighted_drill_down(spark: SparkSession, sf: str) -> DataFrame:
    """Scores with their factors document, calculated on the newest filing date."""
    history = model_input(spark, sf)
    found = comp.weighted_scores(history, calculated=hist.latest_date(history).cast("timestamp"))
    return conform(found.withColumn("risk_factors", F.to_json("risk_factors")), WEIGHTED_SCORE)


def weighted(spark: SparkSession, sf: str) -> DataFrame:
    return weighted_drill_down(spark, sf).drop(*firms.DRILL_DOWN)


def form(spark: SparkSession, sf: str, **options: bool) -> DataFrame:
    return derive.form_rows(filings(spark, sf, FORM_COLUMNS), **options)


# --- flagship ----------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """How many filings fall into each risk category on the newest date."""
    return edge(reports.risk_statistics_latest(scores(spark, "/root/testdata/sf0.001")))


# --- queries with more than one step -----------------------------------------------------------------


def _asof(spark: SparkSession, sf: str, inner: bool = False) -> DataFrame:
    raw = filings(spark, sf, (*KEY, "filing_key", "raum", "cco_name"), unique=False)
    found = hist.asof_previous(raw, raw, ["filing_date", "raum", "cco_name"])
    found = found.where("prev_filing_date IS NOT NULL") if inner else found
    return found.select("sec_number", "filing_date", "filing_key", "prev_filing_date", "prev_raum", "prev_cco_name")


def _component(name: str, column: Callable[[DataFrame], Column], *measures: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        history = model_input(spark, sf)
        result = comp.firm_measures(history).select("crd", *measures, column(history).alias(name))
        return rounded(result, name, *[m for m in measures if dict(result.dtypes)[m] == "double"])

    return run


def _factor_contribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fac.factor_contribution(score_documents(spark, sf)), "avg_value")


def _weighted_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        reports.category_summary(weighted(spark, sf), "overall_risk_score"), "avg_score", "min_score", "max_score"
    )


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Integer-division scores, and the severe ones of the fractional model to put over them."""

    def stored(mode: str, created: Column) -> DataFrame:
        kept = scores(spark, sf, mode).select(*KEY, "score", "risk_category")
        return kept.withColumn("created_at", created)

    existing = stored("as_written", F.col("filing_date"))
    updates = stored("fractional", F.date_add("filing_date", 1)).where("risk_category IN ('High', 'Critical')")
    return existing, updates


def _upsert(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.upsert(*_upsert_sides(spark, sf), KEY, created_at="created_at")


def _upsert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a stored table, of which only the buckets with updates are written again."""
    root = shared_dir(spark, "scores")
    existing, updates = _upsert_sides(spark, sf)
    snapshots.replace_table(existing, root, KEY)
    snapshots.upsert_table(updates, root, KEY, created_at="created_at")
    return snapshots.read(spark, root)


def _replace_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table of scores, replaced by some of its own rows."""
    root = shared_dir(spark, "scores")
    snapshots.replace_table(scores(spark, sf).select(*KEY, "score", "risk_category"), root, KEY)
    snapshots.replace_table(snapshots.read(spark, root).where("risk_category IN ('High', 'Critical')"), root, KEY)
    return snapshots.read(spark, root)


def _incremental_store(spark: SparkSession, sf: str) -> DataFrame:
    """The history in four batches: the years before 1996 (a tenth of the filings with wrong assets, another tenth
    missing), the later years, the missing filings, and corrections of the wrong ones."""
    store = shared_dir(spark, "store")
    whole = conform(filings(spark, sf), FILING).join(
        filings(spark, sf, (*KEY, "filing_key")).select(*KEY, F.pmod("filing_key", F.lit(10)).alias("tenth")), KEY
    ).persist(StorageLevel.DISK_ONLY)  # joined once, not for each of the batches
    early, named = F.col("filing_date") < "1996-01-01", F.date_format("filing_date", "MMddyyyy")

    def file(suffix: str) -> Column:
        return F.concat(F.lit("ia"), named, F.lit(f"{suffix}.csv")).alias("source_file")

    wrong = F.when(F.col("tenth") == 3, F.col("raum") * 0 + 7).otherwise(F.col("raum")).cast("decimal(20,2)")
    batches = [
        whole.where(early & (F.col("tenth") != 5)).withColumn("raum", wrong).select("*", file("")),
        whole.where(~early).select("*", file("")),
        whole.where(early & (F.col("tenth") == 5)).select("*", file("")),
        whole.where(early & (F.col("tenth") == 3)).select("*", file("-2")),
    ]
    for number, batch in enumerate(batches):
        incremental.load_batch(spark, store, batch, number, buckets=8)
    whole.unpersist()
    return flat_scores(incremental.current_scores(spark, store))


def _append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Scores appended to a table in two goes, by year of filing."""
    path = shared_dir(spark, "appended")
    rows = scores(spark, sf).select(*KEY, "score", "risk_category", F.year("filing_date").alias("filing_year"))
    for part in ("filing_date < '1996-01-01'", "filing_date >= '1996-01-01'"):
        sinks.append(rows.where(part), path, partition_by=["filing_year"])
    return spark.read.parquet(path).select(rows.columns)


def _file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of files as they lie in a folder: one of each kind for every filing date."""
    dates = filings(spark, sf, KEY).select("filing_date", F.date_format("filing_date", "MMddyyyy").alias("day")).distinct()
    kinds = {"in/ia": ".csv", "in/ia-": ".XLSX", "in/": "exempt.csv", "in/FOIA": ".csv", "in/._ia": ".csv", "in/note": ".txt"}
    names = F.array(*[F.concat(F.lit(a), "day", F.lit(b)) for a, b in kinds.items()])
    return dates.select("filing_date", F.explode(names).alias("path"))


def _pending_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are to be loaded and that the manifest, of the years before 1996, does not name."""
    listed = _file_names(spark, sf).where(csv_files.loadable(F.col("path")))
    return csv_files.new_files(listed, listed.where("filing_date < '1996-01-01'")).select("path")


def _firm_detail_one(spark: SparkSession, sf: str) -> DataFrame:
    history = model_input(spark, sf)
    return firms.firm_details(history, weighted(spark, sf), crd=history.agg(F.min("crd")).first()[0])


FACTOR_SCALES = ("disclosure_rate", "years_active", "aum_volatility", "aum_trend", "client_account_ratio", "filing_frequency",
                 "compliance_ratio", "avg_tenure_years", "aum", "size_deviation")


def _weighted_factors(spark: SparkSession, sf: str) -> DataFrame:
    """The factors document of each firm, read back and laid out as columns."""
    kinds = comp.weighted_scores(model_input(spark, sf)).schema["risk_factors"].dataType
    read = weighted_drill_down(spark, sf).select("crd", F.from_json("risk_factors", kinds).alias("factors"))
    return rounded(read.select("crd", "factors.*"), *FACTOR_SCALES)


def _factors_shown(df: DataFrame) -> DataFrame:
    """The document's fields that stand for it, as an answer's own columns."""
    read = F.from_json("risk_factors", "disclosure_count bigint, cco_changes bigint, filing_count bigint")
    return df.withColumn("factors", read).select(
        *[c for c in df.columns if c not in firms.DRILL_DOWN],
        F.date_format("last_calculation_date", "yyyy-MM-dd HH:mm:ss").alias("last_calculation_date"),
        "factors.*",
    )


def _firm_detail_factors(spark: SparkSession, sf: str) -> DataFrame:
    return _factors_shown(firms.firm_details(model_input(spark, sf), weighted_drill_down(spark, sf)))


def _firm_page_factors(spark: SparkSession, sf: str) -> DataFrame:
    found = firms.search_firms(model_input(spark, sf), weighted_drill_down(spark, sf))
    return _factors_shown(firms.firm_page(found, sort_by="overall_risk_score", descending=True))


def _column_ranges(spark: SparkSession, sf: str) -> DataFrame:
    rows = filings(spark, sf)
    return reports.column_ranges(rows, rows.columns).withColumn("sample_values", F.concat_ws(" | ", "sample_values"))


def _load_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """One line for every member of archives of which some are damaged, encrypted, empty or without rows."""
    packed = derive.archives(form(spark, sf), damaged=True)
    entries = archives.zip_entries(packed)
    listed = archives.zip_entries(packed, contents=False).select(archives.member_name())
    return normalize.load_ledger(listed, archives.member_outcomes(entries))


def _file_name_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Every filing date in each of the name forms, read back from the name."""
    dates = filings(spark, sf, KEY).select("filing_date").distinct()
    long, short = F.date_format("filing_date", "MMddyyyy"), F.date_format("filing_date", "MMddyy")
    names = F.array(
        F.concat(F.lit("ia"), long, F.lit(".zip")),
        F.concat(F.lit("IA"), short, F.lit(".xlsx")),
        F.concat(F.lit("raw/ia-"), short, F.lit(".zip")),
        F.concat(F.lit("ia"), short, F.lit("-2.zip")),
        F.concat(F.lit("summary"), short, F.lit(".csv")),
    )
    named = dates.select(F.explode(names).alias("file_name"))
    return named.select(
        "file_name",
        text.file_name_date(F.col("file_name")).alias("file_date"),
        text.archive_year(F.col("file_name")).alias("archive_year"),
    )


def _money(spark: SparkSession, sf: str) -> DataFrame:
    return filings(spark, sf, (*KEY, "raum")).select(
        *KEY,
        text.money_label("raum").alias("label"),
        text.money_short("raum").alias("short_label"),
        text.money_grouped("raum").alias("grouped"),
    )


def _normalized(spark: SparkSession, sf: str) -> DataFrame:
    rows = form(spark, sf)
    return normalize.normalize(rows, source_file=derive.monthly_name(F.col("filed")))


def _typed(rows: DataFrame) -> DataFrame:
    return normalize.accepted(rows).select(*[f.name for f in FILING])


def _csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """The history written in two layouts (comma and Latin-1, pipe and UTF-8 with fewer columns), read back."""
    folder = shared_dir(spark, "form-files")
    early, late = F.col("filed") < "1998-01-01", F.col("filed") >= "1998-01-01"
    counted = form(spark, sf, disclosure_counts=True, blank_keys=False).where(early)
    derive.write_form_files(counted, f"{folder}/early", ",", "ISO-8859-1")
    flagged = form(spark, sf, blank_keys=False).where(late).drop("5F(2)(f)", "5D(n)(1)")
    derive.write_form_files(flagged, f"{folder}/late", "|", "UTF-8")
    return _typed(csv_files.read_filing_csv(spark, folder, dates="column"))


def _archive_rows(spark: SparkSession, sf: str) -> DataFrame:
    members = archives.zip_entries(derive.archives(form(spark, sf)))
    return _typed(archives.member_rows(members))


def _archive_census(spark: SparkSession, sf: str) -> DataFrame:
    census = archives.archive_census(derive.archives(form(spark, sf)))
    return archives.multi_file_archives(census).select("archive", "files", "csv_files", "workbooks", "other_files")


def _workbook_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = archives.workbook_rows(derive.workbooks(form(spark, sf)))
    return _typed(archives.normalize_rows(rows, dates="column"))


def _incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The history arrives as files in about three batches, in no date order; scores end up as in one run."""
    folder = shared_dir(spark, "arrivals")
    rows = form(spark, sf, disclosure_counts=True, blank_keys=False)
    derive.write_form_files(rows.repartition(6, "filed", "SEC#"), f"{folder}/source")
    count = csv_files.list_files(spark, f"{folder}/source", csv_files.CSV_NAMES).count()
    query = incremental.ingest_stream(
        spark,
        f"{folder}/source",
        f"{folder}/store",
        f"{folder}/progress",
        max(1, -(-count // 3)),
        dates="column",
        buckets=8,
    )
    query.awaitTermination()
    return flat_scores(incremental.current_scores(spark, f"{folder}/store"))


def _views(spark: SparkSession, sf: str) -> DataFrame:
    register_views(filings(spark, sf, (*CHANGE_COLUMNS, "firm_name")), scores(spark, sf))
    return spark.sql(
        """SELECT t.risk_category, t.firm_count, s.min_score, s.max_score,
        (SELECT total_firms FROM dashboard_stats) AS total_firms,
        (SELECT total_filings FROM dashboard_stats) AS total_filings
        FROM risk_statistics t JOIN risk_stats s ON s.risk_category = t.risk_category"""
    )


def _functions(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of each category, asked for one by one in SQL, beside the number of its firms with 50 points or more."""
    register_functions(filings(spark, sf, (*CHANGE_COLUMNS, "firm_name")), scores(spark, sf))
    parts = [
        f"""SELECT s.*, (SELECT COUNT(*) FROM firms_in_category('{name}', 50)) AS high_scores
        FROM risk_statistics_of('{name}') s"""
        for name in ("Low", "Medium", "High", "Critical")
    ]
    return spark.sql(" UNION ALL ".join(parts))


def _merged_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles out of one sketch per date, and whether their true ranks are as near as the sketch's size promises."""
    rows = filings(spark, sf, (*KEY, "raum")).select("filing_date", F.col("raum").cast("double").alias("raum"))
    wanted = {"median": 0.5, "p95": 0.95, "p99": 0.99}
    merged = quant.merged_percentiles(quant.quantile_sketches(rows, "raum", "filing_date"), wanted)
    found = merged.select(F.struct(*wanted).alias("p")).scalar()
    counts = rows.select("raum", found.alias("p")).agg(
        F.count("raum").alias("values"),
        *[F.count_if(F.col("raum") < F.col(f"p.{n}")).alias(f"{n}_below") for n in wanted],
        *[F.count_if(F.col("raum") <= F.col(f"p.{n}")).alias(f"{n}_upto") for n in wanted],
    )

    def within(name: str) -> Column:
        rank, slack = F.col("values") * wanted[name], F.col("values") * quant.RANK_ERROR + 1
        return ((F.col(f"{name}_below") <= rank + slack) & (F.col(f"{name}_upto") >= rank - slack)).alias(f"{name}_within")

    return counts.select("values", *map(within, wanted))


def _page_after(spark: SparkSession, sf: str) -> DataFrame:
    """The second page by assets, asked for by the last row of the first."""
    found = firms.search_firms(model_input(spark, sf), weighted(spark, sf))
    *_, last = firms.firm_page_after(found, sort_by="aum", descending=True).collect()
    return firms.firm_page_after(found, (last.aum, last.crd, last.last_filing_date), "aum", True)


def _firm_page(spark: SparkSession, sf: str, **search) -> DataFrame:
    page = {k: search.pop(k) for k in ("sort_by", "descending", "page", "page_size") if k in search}
    found = firms.search_firms(model_input(spark, sf), weighted(spark, sf), **search)
    return firms.firm_page(found, **page)


def queries() -> dict[str, Query]:
    plans: dict[str, Query] = {
        # changes and scores
        "filing_changes": change_rows,
        "filing_changes_as_written": lambda s, d: change_rows(s, d, "as_written"),
        "filing_changes_require_prev": lambda s, d: ch.filing_changes(
            filings(s, d, CHANGE_COLUMNS), require_previous=True, null_disclosures_as_zero=True
        ),
        "population_report": lambda s, d: ch.population_report(change_rows(s, d)),
        "risk_points": lambda s, d: pts.risk_points(change_rows(s, d)),
        "risk_scores": lambda s, d: flat_scores(scores(s, d)),
        "risk_scores_as_written": lambda s, d: flat_scores(scores(s, d, "as_written")),
        "risk_factors_json": lambda s, d: score_documents(s, d).select(*KEY, "factors_json"),
        "client_drop_top": lambda s, d: ch.largest_drops(filings(s, d, (*KEY, "client_count")), "client_count"),
        "account_drop_top": lambda s, d: ch.largest_drops(filings(s, d, (*KEY, "account_count")), "account_count"),
        "account_drop_top_as_written": lambda s, d: ch.largest_drops(
            filings(s, d, (*KEY, "account_count")), "account_count", integer_division=True
        ),
        # history
        "dedupe_filings": lambda s, d: hist.dedupe_filings(
            filings(s, d, (*KEY, "filing_key", "raum", "cco_name"), unique=False)
        ),
        "duplicate_filings": lambda s, d: hist.duplicate_filings(
            filings(s, d, (*KEY, "filing_key", "raum"), unique=False)
        ),
        "asof_previous_filing": _asof,
        "asof_previous_filing_inner": lambda s, d: _asof(s, d, inner=True),
        "latest_per_firm": lambda s, d: hist.latest_per_firm(
            filings(s, d, (*KEY, "filing_key", "raum", "firm_name"), unique=False), "filing_key"
        ),
        "latest_per_firm_ties": lambda s, d: hist.latest_per_firm_ties(
            filings(s, d, (*KEY, "filing_key", "raum"), unique=False)
        ),
        # category reports
        "risk_statistics_latest": lambda s, d: reports.risk_statistics_latest(scores(s, d)),
        "risk_stats_latest_minmax": lambda s, d: reports.risk_stats_latest(scores(s, d)),
        "risk_statistics_all_dates": lambda s, d: reports.risk_statistics_all_dates(scores(s, d)),
        "category_summary": lambda s, d: rounded(reports.category_summary(scores(s, d)), "avg_score"),
        "category_cards": lambda s, d: reports.category_cards(scores(s, d)),
        "dashboard_summary": lambda s, d: reports.dashboard_summary(scores(s, d), filings(s, d, KEY)),
        "risk_run_summary": lambda s, d: reports.risk_run_summary(scores(s, d)),
        # filing profiles
        "dashboard_stats": lambda s, d: rounded(
            reports.dashboard_stats(filings(s, d, (*KEY, "raum"))), "avg_raum", decimals=2
        ),
        "filing_census": lambda s, d: reports.filing_census(filings(s, d, KEY)),
        "asset_filing_census": lambda s, d: reports.filing_census(filings(s, d, (*KEY, "raum")).where("raum > 0")),
        "filing_sample": lambda s, d: reports.top_filings(filings(s, d, PROFILE), [], PROFILE, 10),
        "standing_views": _views,
        "sql_functions": _functions,
        "recent_filings": lambda s, d: reports.recent_filings(filings(s, d, KEY)),
        "raum_counts": lambda s, d: reports.raum_counts(filings(s, d, (*KEY, "raum", "disciplinary_disclosures"))),
        "raum_status_breakdown": lambda s, d: reports.raum_status_breakdown(
            filings(s, d, (*KEY, "raum", "disciplinary_disclosures"))
        ),
        "scoring_coverage": lambda s, d: reports.scoring_coverage(
            filings(s, d, (*KEY, "raum", "disciplinary_disclosures"))
        ),
        "disclosure_counts": lambda s, d: reports.disclosure_counts(filings(s, d, (*KEY, "disciplinary_disclosures"))),
        "disclosure_histogram": lambda s, d: reports.value_histogram(
            filings(s, d, (*KEY, "disciplinary_disclosures")), "disciplinary_disclosures"
        ),
        "count_anomalies": lambda s, d: reports.count_anomalies(
            filings(s, d, (*KEY, "client_count", "account_count"))
        ),
        "raum_percentiles": lambda s, d: rounded(
            reports.raum_percentiles(filings(s, d, (*KEY, "raum"))),
            *("avg_raum", "median_raum", "p95_raum", "p99_raum"),
            decimals=2,
        ),
        "raum_percentiles_merged": _merged_percentiles,
        "filings_by_date": lambda s, d: reports.filings_by_date(filings(s, d, KEY)),
        "filings_by_year": lambda s, d: reports.filings_by_year(filings(s, d, KEY)),
        "multi_filing_firms": lambda s, d: reports.multi_filing_firms(filings(s, d, (*KEY, "raum"))),
        "column_profile": lambda s, d: reports.column_profile(filings(s, d), filings(s, d).columns),
        "column_ranges": _column_ranges,
        # firm lists
        "firms_by_category": lambda s, d: firms.firms_by_category(
            scores(s, d), filings(s, d, (*KEY, "firm_name"))
        ).select("sec_number", "firm_name", "score", "risk_category", "filing_date"),
        "firms_latest_profile": lambda s, d: firms.firms_latest_profile(
            scores(s, d), filings(s, d, PROFILE), category="Critical"
        ).drop("factors"),
        "top_risky_firms": lambda s, d: firms.top_risky_firms(
            scores(s, d), filings(s, d, (*KEY, "firm_name"))
        ).drop("factors"),
        "firm_explorer": lambda s, d: firms.explore(
            scores(s, d), filings(s, d, PROFILE), search="CUSTOMER#0000001", band="60-79 (High)", new_disclosures=True
        ).drop("factors"),
        "firm_page": lambda s, d: _firm_page(s, d, page=2),
        "firm_page_search": lambda s, d: _firm_page(
            s, d, search="1", min_aum=1e8, max_aum=1e11, sort_by="aum", descending=True
        ),
        "firm_page_after": _page_after,
        "firm_detail": lambda s, d: firms.firm_details(model_input(s, d), weighted(s, d)),
        "firm_detail_one": _firm_detail_one,
        "top_raum": lambda s, d: reports.top_filings(
            filings(s, d, PROFILE).where("raum > 0"), ["raum"], ["sec_number", "firm_name", "raum", "filing_date"], 10
        ),
        "top_disclosures": lambda s, d: reports.top_filings(
            filings(s, d, (*KEY, "firm_name", "disciplinary_disclosures")).where("disciplinary_disclosures > 0"),
            ["disciplinary_disclosures"],
            [*KEY, "firm_name", "disciplinary_disclosures"],
            10,
        ),
        "disclosed_firms": lambda s, d: reports.disclosed_firms(
            filings(s, d, (*KEY, "firm_name", "raum", "disciplinary_disclosures")), scores(s, d)
        ),
        "disclosed_firms_left": lambda s, d: reports.disclosed_firms(
            filings(s, d, (*KEY, "firm_name", "raum", "disciplinary_disclosures")), scores(s, d), 5, "left"
        ),
        "excluded_disclosed_firms": lambda s, d: reports.excluded_disclosed_firms(
            filings(s, d, (*KEY, "firm_name", "raum", "disciplinary_disclosures"))
        ),
        "coverage_gap": lambda s, d: reports.coverage_gap(
            filings(s, d, (*KEY, "raum", "disciplinary_disclosures")), single_documents(s, d)
        ),
        "coverage_gap_change_model": lambda s, d: reports.coverage_gap(
            filings(s, d, (*KEY, "raum", "disciplinary_disclosures")), score_documents(s, d)
        ),
        "disclosure_arrays": lambda s, d: reports.disclosure_lists(scores(s, d)),
        # factors
        "factor_contribution": _factor_contribution,
        "factor_contribution_single": lambda s, d: rounded(
            fac.factor_contribution(single_documents(s, d)), "avg_value"
        ),
        "factor_presence": lambda s, d: fac.factor_presence(score_documents(s, d)),
        "top_factors": lambda s, d: reports.top_with_factors(
            score_documents(s, d), filings(s, d, (*PROFILE, "disciplinary_disclosures"))
        ),
        # single-filing model and preview
        "single_filing_score": lambda s, d: flat_scores(single_scores(s, d)),
        "single_filing_json": lambda s, d: single_documents(s, d).select(*KEY, "factors_json"),
        "single_filing_summary": lambda s, d: rounded(reports.category_summary(single_scores(s, d)), "avg_score"),
        "single_filing_top": lambda s, d: firms.firms_by_category(
            single_scores(s, d), filings(s, d, (*KEY, "firm_name")), limit=10
        ).drop("factors"),
        "preview_score": lambda s, d: pts.preview_scores(filings(s, d, (*KEY, "raum", "disciplinary_disclosures"))),
        # weighted model
        "disclosure_component": _component(
            "disclosure_risk", lambda _: comp.disclosure_risk(), "disclosure_count", "filing_count", "years_active"
        ),
        "aum_volatility_component": _component(
            "aum_volatility_risk", lambda _: comp.aum_volatility_risk(), "aum_data_points", "aum_volatility", "aum_trend"
        ),
        "concentration_component": _component(
            "client_concentration_risk",
            lambda h: comp.client_concentration_risk(comp.ratio_scale(h).scalar()),
            "client_account_ratio",
            "total_clients",
            "total_accounts",
        ),
        "filing_compliance_component": _component(
            "filing_compliance_risk", lambda _: comp.filing_compliance_risk(), "filing_count", "years_active"
        ),
        "cco_component": _component(
            "cco_stability_risk", lambda _: comp.cco_stability_risk(), "officer_filings", "cco_changes", "officer_years"
        ),
        "size_component": _component("size_factor_risk", lambda _: comp.size_factor_risk(), "aum"),
        "ratio_scale": lambda s, d: rounded(comp.ratio_scale(model_input(s, d)), "scale"),
        "period_changes": lambda s, d: rounded(comp.period_changes(model_input(s, d)), "aum_change"),
        "weighted_score": weighted,
        "weighted_factors": _weighted_factors,
        "firm_detail_factors": _firm_detail_factors,
        "firm_page_factors": _firm_page_factors,
        "weighted_summary": _weighted_summary,
        "category_distribution_filled": lambda s, d: reports.category_distribution(weighted(s, d)),
        "risk_trends": lambda s, d: reports.risk_trends(model_input(s, d), weighted(s, d), days=365),
        "overview_stats": lambda s, d: reports.overview_stats(model_input(s, d), scores(s, d), weighted(s, d)),
        "overview_stats_as_of": lambda s, d: reports.overview_stats(
            model_input(s, d), scores(s, d), weighted(s, d), days=90, as_of=F.lit("1998-06-30").cast("date")
        ),
        # ingest
        "file_name_dates": _file_name_dates,
        "money_format": _money,
        "page_links": lambda s, d: links.page_links(table(s, d, "pages")),
        "archive_links": lambda s, d: links.archive_links(
            derive.listing_pages(filings(s, d, KEY)), first_year=1998
        ),
        "normalize_raw": lambda s, d: _typed(_normalized(s, d)),
        "normalize_raw_counts": lambda s, d: _typed(
            normalize.normalize(
                form(s, d, disclosure_counts=True),
                source_file=derive.monthly_name(F.col("filed")),
                disclosure_variant="counts",
            )
        ),
        "load_report": lambda s, d: normalize.load_report(_normalized(s, d)),
        "load_totals": lambda s, d: normalize.load_totals(normalize.load_report(_normalized(s, d))),
        "loadable_files": lambda s, d: _file_names(s, d).select(
            "path",
            csv_files.loadable(F.col("path")).alias("loadable"),
            csv_files.loadable(F.col("path"), include_exempt=True).alias("loadable_exempt"),
        ),
        "pending_files": _pending_files,
        "load_report_files": _load_report_files,
        "failed_files": lambda s, d: normalize.failed_files(_load_report_files(s, d)),
        "csv_ingest": _csv_files,
        "zip_members": _archive_rows,
        "archive_census": _archive_census,
        "workbook_rows": _workbook_rows,
        "incremental_ingest": _incremental,
        "incremental_store": _incremental_store,
        # sinks
        "upsert_scores": _upsert,
        "upsert_roundtrip": _upsert_roundtrip,
        "append_roundtrip": _append_roundtrip,
        "replace_roundtrip": _replace_roundtrip,
        "score_documents": lambda s, d: sinks.as_documents(
            reports.risk_statistics_all_dates(scores(s, d)).select("risk_category", "firm_count")
        ),
    }
    return {name: _edged(plan) for name, plan in plans.items()} | training_data_queries()


def training_data_queries() -> dict[str, Query]:
    """Those of the package for training data, if it is there."""
    plans = llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}
    return {name: _importable(plan) for name, plan in plans.items()}


def _importable(plan: Query) -> Query:
    """Python workers find this folder's package wherever the driver was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        known = environment.get("PYTHONPATH", "")
        if HERE not in known.split(os.pathsep):
            environment["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, known]))
        return plan(spark, sf_dir)

    return run


def _edged(plan: Query) -> Query:
    return lambda spark, sf_dir: edge(plan(spark, sf_dir))


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLES

    return dict(ORACLES) | (llm_queries.oracle_sql() if llm_queries else {})
