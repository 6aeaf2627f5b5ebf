"""Reading the factors document of scores back: contribution of each factor, text search, emptiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope.functions.metrics import percent

FACTOR_MAP = "map<string,double>"


def factors_json() -> Column:
    """The factors struct as a JSON document; NULL factors are left out."""
    return F.to_json("factors")


def parse_factors(document: Column | str) -> Column:
    return F.from_json(document, FACTOR_MAP)


def factor_contribution(documents: DataFrame, column: str = "factors_json") -> DataFrame:
    """Per factor: how many scores carry it, how many with a value above zero, average and maximum.

    Over every score. Only (factor, value) pairs leave the scan, and those are summed up before the shuffle.
    """
    pairs = documents.select(F.explode(parse_factors(column)).alias("factor", "value"))
    above = F.count_if(F.col("value") > 0)
    return pairs.groupBy("factor").agg(
        F.count("*").alias("scores"),
        above.alias("non_zero"),
        percent(above, F.count("*")).alias("non_zero_pct"),
        F.avg("value").alias("avg_value"),
        F.greatest(F.max("value"), F.lit(0.0)).alias("max_value"),
        (above > 0).alias("working"),
    )


def factor_presence(documents: DataFrame, column: str = "factors_json") -> DataFrame:
    """How many scores have factors at all."""
    empty = F.col(column).isNull() | (F.col(column) == "{}")
    return documents.agg(
        F.count("*").alias("total"),
        F.count_if(empty).alias("empty_factors"),
        F.count_if(~empty).alias("has_factors"),
    )


def mentions(column: str, factor: str) -> Column:
    """Whether the document text contains a factor name."""
    return F.coalesce(F.col(column).contains(factor), F.lit(False))
