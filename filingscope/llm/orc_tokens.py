"""Token ids as ORC files in ascending order of documents.

One row per document: ids as a list of integers, which ORC run-length encodes; light indexes every thousand rows and
a Bloom filter on ``doc_id``, so that a reader skips stripes and row groups from their metadata. Documents are dealt
out by ranges of ``doc_id`` and sorted, so files hold disjoint, ascending ranges and any stripe can be read alone. A
row carries the number of its file and the ids before it in the file; the totals of the files make them global.

Nulls: a null text is an empty document (the end id alone); rows with a null ``doc_id`` come first. Rows with equal
ids stand side by side, ordered by text. An empty table gives an empty folder and result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingscope.session import shared_dir

from .common import documents, partitions, slices, texts
from .packing import END_ID, vocabulary_path
from .public_ids import token_ids

FILE_SCHEMA = "doc_id bigint, part int, before bigint, n_tokens bigint, ids array<int>"
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = token_ids(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, 1):
                ids = [x + end for x in coder.encode_all(some.column(1).to_pylist())]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<i4")))
                starts = before + offsets[:-1].astype(np.int64)
                before += int(counts.sum())
                columns = [some.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(counts)]
                yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "part", "before", "n_tokens", "ids"])

    rows = texts(docs)
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    writer = rows.mapInArrow(encoded, FILE_SCHEMA).write.option("compression", "zstd")
    writer = writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    writer = writer.option("orc.create.index", "true").option("orc.row.index.stride", str(INDEX_STRIDE))
    writer.option("orc.stripe.size", str(STRIPE_BYTES)).orc(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows as they are. Filters on ``doc_id`` reach the files' statistics and Bloom filters."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Replaces ``part`` and ``before`` by ``start``: the ids of all documents before it. Reads two columns more."""
    files = stored(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("tokens"))  # one row per file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    joined = rows.join(files, "part").withColumn("start", F.col("base") + F.col("before"))
    return joined.drop("part", "before", "base")


def _checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(4)
        flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]
        columns = [*batch.columns[:4], pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "n_tokens", "ids_crc32"])


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "orc-tokens")
    write_tokens(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), path)
    digest = "doc_id bigint, part int, before bigint, n_tokens bigint, ids_crc32 bigint"
    sums = stored(spark, path).mapInArrow(_checksums, digest)
    return with_starts(sums, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
