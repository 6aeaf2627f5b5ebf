"""Writing tables: append, replace, upsert, run log, JSON documents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingscope.schemas import RUN_LOG, conform


def append(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    _write(df, path, "append", schema, partition_by)


def replace(df: DataFrame, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table. ``df`` must not read ``path`` itself."""
    _write(df, path, "overwrite", schema, partition_by)


def _write(df: DataFrame, path: str, mode: str, schema: T.StructType | None, partition_by: Sequence[str]) -> None:
    rows = conform(df, schema) if schema is not None else df
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str], created_at: str | None = None) -> DataFrame:
    """``existing`` with the rows of ``updates`` added or, where the key exists, replaced.

    One full join on the key. With ``created_at``, an updated row keeps the creation time it had. Two updates of one
    key are an error, since neither is the later one.
    """
    rest = [c for c in existing.columns if c not in key]
    old = existing.select(*key, F.struct(*rest).alias("old"))
    new = updates.groupBy(*key).agg(F.count("*").alias("times"), F.max(F.struct(*rest)).alias("new"))
    repeated = F.raise_error(F.concat(F.lit("repeated key in updates: "), F.to_json(F.struct(*key))))
    new = new.select(*key, F.when(F.col("times") == 1, F.col("new")).otherwise(repeated).alias("new"))
    merged = old.join(new, list(key), "full")

    def pick(name: str):
        newer = F.when(F.col("new").isNotNull(), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        if name == created_at:
            newer = F.coalesce(f"old.{name}", f"new.{name}")
        return newer.alias(name)

    return merged.select(*key, *[pick(c) for c in rest]).select(*existing.columns)


def as_documents(df: DataFrame) -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("document"))


def log_run(
    spark: SparkSession,
    path: str,
    run_type: str,
    status: str,
    started_at: datetime,
    completed_at: datetime | None = None,
    files: int = 0,
    records: int = 0,
    error: str | None = None,
) -> None:
    """Append one entry to the run log."""
    row = (run_type, status, files, records, error, started_at, completed_at)
    append(spark.createDataFrame([row], RUN_LOG), path)
