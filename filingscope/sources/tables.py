"""Filings out of the order tables: one order is one raw filing of its customer.

Only what is asked for is joined: line items are read only for counts, customers only for the profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingscope.operators.history import dedupe_filings

KEY_COLUMNS = ("sec_number", "crd_number", "filing_date", "filing_key")
ORDER_COLUMNS = ("raum", "cco_name")
LINE_COLUMNS = ("client_count", "account_count", "disciplinary_disclosures")
PROFILE_COLUMNS = ("firm_name", "firm_type", "sec_region", "main_office_country")
ALL_COLUMNS = (*KEY_COLUMNS, *ORDER_COLUMNS, *LINE_COLUMNS, *PROFILE_COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sec_number(custkey: str) -> str:
    digits = f"STRING({custkey})"
    return f"CONCAT('801-', CASE WHEN LENGTH({digits}) < 6 THEN LPAD({digits}, 6, '0') ELSE {digits} END)"


# Price times 100, 1000, 10000 or 100000 by firm: whole dollars, so integers until the last cast.
RAUM_SQL = """CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 0
    ELSE BIGINT(ROUND(o_totalprice * 100)) * CASE o_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 ELSE 1000 END
    END AS DECIMAL(20,2))"""


def _order_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        f"{_sec_number('o_custkey')} AS sec_number",
        "STRING(o_custkey) AS crd_number",
        "DATE(o_orderdate) AS filing_date",
        "o_orderkey AS filing_key",
        f"{RAUM_SQL} AS raum",
        "o_orderpriority AS cco_name",
    )


def _line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .withColumnRenamed("l_orderkey", "filing_key")
        .groupBy("filing_key")
        .agg(
            F.expr("INT(COUNT(*)) AS client_count"),
            F.expr("INT(SUM(l_quantity)) AS account_count"),
            F.expr("INT(COUNT_IF(l_returnflag = 'R' AND l_discount >= 0.08D)) AS disciplinary_disclosures"),
        )
    )


def firm_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per firm. The two dimension tables have 25 and 5 rows, whatever the scale."""
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .selectExpr(
            f"{_sec_number('c_custkey')} AS sec_number",
            "c_name AS firm_name",
            "c_mktsegment AS firm_type",
            "r_name AS sec_region",
            "n_name AS main_office_country",
        )
    )


def filings(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = ALL_COLUMNS, unique: bool = True
) -> DataFrame:
    """The filing history with the given columns, one row per firm and date if ``unique``.

    Order of work: drop repeated filings first, since that needs the orders alone; then fetch line facts on
    the order key; last join the profile on the firm, whose partitioning the per-firm windows reuse.
    """
    own = [c for c in (*KEY_COLUMNS, *ORDER_COLUMNS) if c in columns or c in ("sec_number", "filing_date", "filing_key")]
    result = _order_filings(spark, sf_dir).select(*own)
    if unique:
        result = dedupe_filings(result)
    wanted_facts = [c for c in LINE_COLUMNS if c in columns]
    if wanted_facts:
        facts = _line_facts(spark, sf_dir).select("filing_key", *wanted_facts)
        result = result.join(facts, "filing_key", "left").fillna(
            0, [c for c in ("client_count", "disciplinary_disclosures") if c in wanted_facts]
        )
    wanted_profile = [c for c in PROFILE_COLUMNS if c in columns]
    if wanted_profile:
        result = result.join(firm_profiles(spark, sf_dir).select("sec_number", *wanted_profile), "sec_number", "left")
    return result.select(*columns)


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the weighted model, keyed by the numeric firm id."""
    history = filings(
        spark,
        sf_dir,
        ("crd_number", "filing_date", "raum", "client_count", "account_count", "cco_name", "disciplinary_disclosures"),
    )
    return history.select(
        F.col("crd_number").cast("long").alias("crd"),
        "filing_date",
        "raum",
        F.col("client_count").alias("total_clients"),
        F.col("account_count").alias("total_accounts"),
        F.col("cco_name").alias("cco_id"),
        F.when(F.col("disciplinary_disclosures") > 0, "Y").otherwise("N").alias("disclosure_flag"),
    )
