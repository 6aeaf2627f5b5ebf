"""Typed table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = ["sec_number", "filing_date"]

FILING = T.StructType(
    [
        T.StructField("sec_number", T.StringType(), False),
        T.StructField("crd_number", T.StringType()),
        T.StructField("filing_date", T.DateType(), False),
        T.StructField("firm_name", T.StringType()),
        T.StructField("legal_name", T.StringType()),
        T.StructField("sec_region", T.StringType()),
        T.StructField("sec_status", T.StringType()),
        T.StructField("sec_status_date", T.DateType()),
        T.StructField("raum", T.DecimalType(20, 2)),
        T.StructField("client_count", T.IntegerType()),
        T.StructField("account_count", T.IntegerType()),
        T.StructField("cco_name", T.StringType()),
        T.StructField("cco_phone", T.StringType()),
        T.StructField("cco_email", T.StringType()),
        T.StructField("firm_type", T.StringType()),
        T.StructField("umbrella_registration", T.BooleanType()),
        T.StructField("website", T.StringType()),
        T.StructField("main_office_city", T.StringType()),
        T.StructField("main_office_state", T.StringType()),
        T.StructField("main_office_country", T.StringType()),
        T.StructField("disciplinary_disclosures", T.IntegerType()),
    ]
)

# The percentages are wider than a 0-100 range needs: integer-division mode goes far below zero.
CHANGE = T.StructType(
    [
        T.StructField("sec_number", T.StringType(), False),
        T.StructField("filing_date", T.DateType(), False),
        T.StructField("raum_drop_pct", T.DecimalType(12, 2)),
        T.StructField("client_drop_pct", T.DecimalType(12, 2)),
        T.StructField("acct_drop_pct", T.DecimalType(12, 2)),
        T.StructField("new_disc_flag", T.BooleanType()),
        T.StructField("cco_changed", T.BooleanType()),
        T.StructField("trend_down_flag", T.BooleanType()),
        T.StructField("owner_moves_12m", T.IntegerType()),
        T.StructField("adviser_age_years", T.IntegerType()),
        T.StructField("raum", T.DecimalType(20, 2)),
    ]
)

FACTORS = T.StructType(
    [
        T.StructField("aum_drop_pct", T.DoubleType()),
        T.StructField("client_drop_pct", T.DoubleType()),
        T.StructField("acct_drop_pct", T.DoubleType()),
        T.StructField("new_disc", T.IntegerType()),
        T.StructField("cco_changed", T.IntegerType()),
        T.StructField("trend_down", T.IntegerType()),
        T.StructField("owner_moves_12m", T.IntegerType()),
        T.StructField("adviser_age_yrs", T.IntegerType()),
        T.StructField("small_raum", T.IntegerType()),
    ]
)

RISK_SCORE = T.StructType(
    [
        T.StructField("sec_number", T.StringType(), False),
        T.StructField("filing_date", T.DateType(), False),
        T.StructField("score", T.IntegerType(), False),
        T.StructField("factors", FACTORS),
        T.StructField("risk_category", T.StringType(), False),
    ]
)

COMPONENT = T.DecimalType(5, 4)
WEIGHTED_SCORE = T.StructType(
    [
        T.StructField("crd", T.LongType(), False),
        T.StructField("overall_risk_score", COMPONENT),
        T.StructField("risk_category", T.StringType()),
        T.StructField("disclosure_risk", COMPONENT),
        T.StructField("aum_volatility_risk", COMPONENT),
        T.StructField("client_concentration_risk", COMPONENT),
        T.StructField("filing_compliance_risk", COMPONENT),
        T.StructField("cco_stability_risk", COMPONENT),
        T.StructField("size_factor_risk", COMPONENT),
        T.StructField("risk_factors", T.StringType()),
        T.StructField("last_calculation_date", T.TimestampType()),
    ]
)

LOADED_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("message", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("files_processed", T.IntegerType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: cast what is there, NULL for what is not."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{field.name}`' if field.name in present else 'NULL'} AS {field.dataType.simpleString()})"
            f" AS `{field.name}`"
            for field in schema
        ]
    )


def describe_columns(df: DataFrame, containing: str | None = None) -> DataFrame:
    """One row per column: position, name, type, nullability; optionally only names containing a text."""
    rows = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema)
        if containing is None or containing.lower() in field.name.lower()
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, is_nullable boolean"
    )
