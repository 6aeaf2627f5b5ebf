"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept, which are written as Parquet below the shared folder and read
again. All but the last return the columns of ``documents``. What each does with nulls, empty and repeated rows is
what its operator states; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filingscope.llm.common import documents, written
from filingscope.llm.language import keep_identified
from filingscope.llm.line_runs import without_copies
from filingscope.llm.overlap_join import one_of_each
from filingscope.llm.packing import pack_documents, vocabulary_path
from filingscope.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("language identification", language),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", packing),
]

#: No SQL trains a classifier or packs by a histogram; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
