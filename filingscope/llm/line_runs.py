"""Line dedup with a suffix array over line ids, built by distributed prefix doubling.

Lines with a word are the symbols; a line's id is a hash of its text without outer white space. Level 0 ranks the
line ids; each further level ranks pairs of ranks that stand ``2**level`` lines apart in one document, which orders
all suffixes by twice as many lines. A suffix whose rank nobody shares can take no part in a longer repeat and drops
out, so the tables shrink quickly. The suffixes that share their first ``n`` lines are an interval of the suffix
array with a longest common prefix of ``n`` lines or more; ranks of two overlapping powers of two name that interval
for any ``n``.

A run of lines is deleted if it has ``min_words`` words or more, stands somewhere earlier (smaller ``doc_id``, then
earlier line), and is maximal. Every maximal run is the union of the shortest windows of ``min_words`` words that
start or end at one of its lines, and those have at most ``min_words`` lines, so a handful of levels is enough however
long the runs are. Of every deleted line an earlier copy stays.

Nulls: a null text has no lines; a null ``doc_id`` counts as the largest. Blank lines are no part of runs and stay.
Rows with equal id and text count as one document and are treated alike. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, partitions, written

MIN_WORDS = 30
AT = ("did", "th")  # names a document: its id (null: the largest) and a hash of its text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("did"),
        F.xxhash64(text).alias("th"),
        text.alias("body"),
    )


def windows(words: list[int], least: int) -> list[set[int]]:
    """For each line, the numbers of lines of the shortest windows with ``least`` words that start there: the one
    that starts with this line, and those that end with some line and could not start later."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    found: list[set[int]] = [set() for _ in words]
    ends = np.searchsorted(total, total[:-1] + least, "left")
    starts = np.searchsorted(total, total[1:] - least, "right") - 1
    for i in range(n):
        if ends[i] <= n:
            found[i].add(int(ends[i]) - i)
        if starts[i] >= 0:
            found[int(starts[i])].add(i + 1 - int(starts[i]))
    return found


def lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line with a word: document, ``ln`` (its number among such lines), ``line_no`` (among all lines,
    from 0), ``h`` (line id), ``lens`` (lines of the windows that start here)."""
    schema = "did bigint, th bigint, ln int, line_no int, h bigint, lens array<int>"

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for did, th, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbered = [(i, s) for i, line in enumerate(body.split("\n")) if (s := line.strip(SPACE))]
                lens = windows([len(WORD.findall(s)) for _, s in numbered], min_words)
                n = len(numbered)
                columns[0] += [did] * n
                columns[1] += [th] * n
                columns[2] += range(n)
                columns[3] += [i for i, _ in numbered]
                columns[4] += [xxhash.xxh3_64_intdigest(s.encode()) - 2**63 for _, s in numbered]
                columns[5] += [sorted(x) for x in lens]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in schema.split(", ")])

    found = _keyed(docs).select(*AT, "body").mapInArrow(split, schema)
    return found.dropDuplicates([*AT, "ln"])


def ranked(classes: DataFrame, *keys: str) -> DataFrame:
    """Adds ``rank``: the place of each row (distinct keys) in the order of its keys, from 0."""
    spark = classes.sparkSession
    names = list(classes.columns)

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            extra = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            at += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*names, "part", "at"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    ordered = classes.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    ordered = written(ordered.mapInArrow(number, f"{kept}, part int, at bigint"), "line-ranks")
    offset, before = 0, []
    for r in sorted(ordered.groupBy("part").count().collect(), key=lambda r: r["part"]):  # one row per partition
        before.append((r["part"], offset))
        offset += r["count"]
    parts = spark.createDataFrame(before, "part int, before bigint")
    return ordered.join(F.broadcast(parts), "part").select(*names, (F.col("before") + F.col("at")).alias("rank"))


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows ``(did, th, ln, keys)`` whose keys occur twice or more, with the ``rank`` of the keys."""
    classes = rows.groupBy(*keys).agg(F.count("*").alias("members")).where("members > 1").select(*keys)
    return rows.join(ranked(classes, *keys), list(keys)).select(*AT, "ln", "rank")


def levels(rows: DataFrame, longest: int) -> list[DataFrame]:
    """The suffixes (document and line) that share their first ``2**level`` lines with others, and their ranks."""
    found = [written(_shared(rows.select(*AT, "ln", "h"), "h"), "line-level")]
    while 2 ** len(found) <= longest:
        shift = 2 ** (len(found) - 1)
        first = found[-1].withColumnRenamed("rank", "r1")
        second = found[-1].select(*AT, (F.col("ln") - shift).alias("ln"), F.col("rank").alias("r2"))
        pairs = first.join(second, [*AT, "ln"])
        found.append(written(_shared(pairs, "r1", "r2"), "line-level"))
    return found


def copies(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Windows of lines that stand somewhere earlier: ``did``, ``th``, ``ln``, ``n`` (lines)."""
    suffixes = levels(rows, min_words)
    starts = rows.select(*AT, "ln", F.explode("lens").alias("n")).withColumn("level", F.length(F.bin("n")) - 1)
    ranks = reduce(DataFrame.unionByName, [r.withColumn("level", F.lit(level)) for level, r in enumerate(suffixes)])
    # All levels go through one pair of joins: with a pair for each, the driver plans them all anew after every stage.
    named = starts.join(ranks.withColumnRenamed("rank", "head"), [*AT, "ln", "level"])
    named = named.withColumn("tail_ln", F.expr("ln + n - shiftleft(1, level)"))
    tail = ranks.select(*AT, F.col("ln").alias("tail_ln"), "level", F.col("rank").alias("tail"))
    named = named.join(tail, [*AT, "tail_ln", "level"]).select(*AT, "ln", "n", "head", "tail")
    named = written(named, "line-windows")
    place = F.struct("did", "th", "ln")
    first = named.groupBy("n", "head", "tail").agg(F.min(place).alias("first"), F.count("*").alias("members"))
    again = named.join(first.where("members > 1").drop("members"), ["n", "head", "tail"]).where(place != F.col("first"))
    return again.select(*AT, "ln", "n")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``did``, ``th`` and ``removed``: the numbers (from 0, ascending) of each document's lines to delete."""
    rows = written(lines(docs, min_words), "lines")
    inside = copies(rows, min_words).select(*AT, F.explode(F.sequence("ln", F.col("ln") + F.col("n") - 1)).alias("ln"))
    numbered = inside.distinct().join(rows.select(*AT, "ln", "line_no"), [*AT, "ln"])
    return numbered.groupBy(*AT).agg(F.sort_array(F.collect_list("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (the input's columns), ``body`` (the text without later copies), ``n_lines``, ``removed``."""
    found = _keyed(docs).join(repeated_lines(docs, min_words), list(AT), "left")
    split = F.split("body", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("removed"))
    shorter = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    return found.select(
        "row",
        F.when(F.col("removed").isNull(), F.col("body")).otherwise(shorter).alias("body"),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents without later copies of line runs, with the input's columns. Documents that consist of nothing
    but copies go; documents that had no word to begin with stay as they are."""
    found = dedup_lines(docs)
    empty = (F.size("removed") > 0) & ~F.col("body").rlike(r"[^\x20\x09-\x0D]")
    text = F.when(F.size("removed") > 0, F.col("body")).otherwise(F.col("row.text"))
    return found.where(~empty).select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.size("removed").cast("long")
    return found.select("row.doc_id", "n_lines", removed.alias("n_removed"), F.col("body").alias("text"))
