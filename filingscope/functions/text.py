"""Text expressions: money labels, search, file-name dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _in_units(amount: str, unit: int, suffix: str, decimals: int = 1) -> str:
    return f"CONCAT('$', STRING(CAST(CAST({amount} AS DECIMAL(20,2)) / {unit} AS DECIMAL(20,{decimals}))), '{suffix}')"


def money_label(amount: str) -> Column:
    """$1.2T / $3.4B / $5.6M, below a million grouped digits; N/A for NULL."""
    return F.expr(
        f"""CASE WHEN {amount} IS NULL THEN 'N/A'
        WHEN {amount} >= 1000000000000 THEN {_in_units(amount, 10**12, 'T')}
        WHEN {amount} >= 1000000000 THEN {_in_units(amount, 10**9, 'B')}
        WHEN {amount} >= 1000000 THEN {_in_units(amount, 10**6, 'M')}
        ELSE CONCAT('$', FORMAT_NUMBER({amount}, 0)) END"""
    )


def money_short(amount: str) -> Column:
    """Card form: millions with one decimal, else whole thousands; N/A for NULL."""
    return F.expr(
        f"""CASE WHEN {amount} IS NULL THEN 'N/A' WHEN {amount} >= 1000000 THEN {_in_units(amount, 10**6, 'M')}
        ELSE {_in_units(amount, 1000, 'K', 0)} END"""
    )


def money_grouped(amount: str) -> Column:
    """Whole dollars with thousands separators; N/A for NULL or zero."""
    return F.expr(
        f"CASE WHEN {amount} IS NULL OR {amount} = 0 THEN 'N/A' ELSE CONCAT('$', FORMAT_NUMBER({amount}, 0)) END"
    )


def contains_text(column: Column, needle: str, ignore_case: bool = False) -> Column:
    text = column.cast("string")
    return F.lower(text).contains(needle.lower()) if ignore_case else text.contains(needle)


def file_name_date(name: Column) -> Column:
    """Date in a file name ``iaMMDDYYYY…`` or ``iaMMDDYY…`` (20yy), with an optional dash; else NULL.

    Eight digits are tried first: the first six of them also look like a short date.
    """
    base = F.lower(F.element_at(F.split(name, "/"), -1))
    digits8 = F.regexp_extract(base, r"ia-?(\d{8})(?!\d)", 1)
    digits6 = F.regexp_extract(base, r"ia-?(\d{6})(?!\d)", 1)
    full = F.when(digits8 != "", digits8).when(
        digits6 != "", F.concat(F.substring(digits6, 1, 4), F.lit("20"), F.substring(digits6, 5, 2))
    )
    return F.try_to_date(full, "MMddyyyy")


def arrival_order(path: Column) -> Column:
    """Orders files of filings: by date, then by the number of the correction (``-2``), then by name."""
    name = F.element_at(F.split(path, "/"), -1)
    suffix = F.regexp_extract(name, r"[-_](\d{1,4})\.[A-Za-z]+$", 1)
    return F.struct(
        file_name_date(path).alias("date"), F.coalesce(suffix.try_cast("int"), F.lit(0)).alias("number"), name.alias("name")
    )


def archive_year(name: Column) -> Column:
    """Year in an archive name ``ia[-]MMDDYY[YY][-_n].zip``; NULL if the name has another form."""
    base = F.element_at(F.split(name, "/"), -1)
    digits = F.regexp_extract(base, r"ia-?(\d{6,8})[-_]?\d*\.zip", 1)
    return (
        F.when(F.length(digits) == 6, F.concat(F.lit("20"), F.substring(digits, 5, 2)))
        .when(F.length(digits) >= 8, F.substring(digits, 5, 4))
        .cast("int")
    )
