"""Helpers that the operators share: reading, shared intermediate tables, words of Arrow columns."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingscope.session import shared_dir

MIX = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, so that no other column can clash with an operator's own."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage, and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: int | str, size: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """The rows in order, in parts of about ``size`` bytes of text, or one longer text: bounds a worker's memory."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.nonzero(part[1:] != part[:-1])[0] + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles while many small objects without any are made: they go by their counts of references."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def words_of(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of a column of texts in order, and the row that each belongs to."""
    texts = pc.ascii_lower(texts) if lower else texts
    lists = pc.ascii_split_whitespace(texts)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    words = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    some = pc.greater(pc.binary_length(words), 0)
    if not pc.all(some).as_py() and len(words):
        words, rows = words.filter(some), rows[some.to_numpy(zero_copy_only=False)]
    return words, rows


def word_hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of each word among the distinct ones, and the 64-bit hashes of the distinct ones."""
    coded = words.dictionary_encode()
    hashes = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    return coded.indices.to_numpy(zero_copy_only=False), np.array(hashes, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
