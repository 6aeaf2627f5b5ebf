"""Incremental loading: new monthly files in, scores of the firms they touch out.

The stream carries file names only. Its checkpoint remembers which files were taken, each micro-batch reads its files as
the batch reader does. What a batch brings is one write to the store (see :mod:`filingscope.sinks.snapshots`): filings,
scores, rejected rows and one line per file change together, or not at all. A batch that is run again goes on from the
commit before it, so its first attempt no longer counts.

Filings and scores are dealt into buckets by firm. For each firm the store keeps a state: the last filing, the last
drops and the first date. Filings that are newer than their firm's last one are scored by it alone, so a month costs its
own filings and one state per firm, however much history there is. A late or corrected filing changes scores that
are there: its firm's whole history is scored again, for which its bucket is read and the bucket's scores written anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from filingscope.functions.text import arrival_order
from filingscope.operators.changes import NEEDED, filing_changes, firm_state
from filingscope.operators.history import dedupe_filings
from filingscope.operators.points import score_changes
from filingscope.schemas import FILING, KEY, LOADED_FILE, RISK_SCORE
from filingscope.sinks import snapshots
from filingscope.sources.csv_files import (
    CSV_NAMES,
    empty_files,
    list_files,
    loadable,
    new_files,
    one_spelling,
    read_filing_csv,
)
from filingscope.sources.normalize import accepted, load_ledger, rejected

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
SOURCE = T.StructField("source_file", T.StringType())
BATCH = T.StructField("batch_id", T.LongType())
STORED_FILING = T.StructType([*FILING.fields, SOURCE, BATCH])
STORED_REJECT = T.StructType([*FILING.fields, SOURCE, T.StructField("reject_reason", T.StringType()), BATCH])
STORED_FILE = T.StructType([*LOADED_FILE.fields, BATCH])
FIRM = ["sec_number"]
NOT_LOADED = "not loaded yet"


def new_file_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """File names as they arrive, any spelling of ``.csv``; contents are pruned from the read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_NAMES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
        .where(loadable(F.col("path")))
    )


def stored_filings(spark: SparkSession, store: str) -> DataFrame:
    """Every accepted row that was loaded, corrected ones too."""
    return snapshots.read(spark, store, "filings", schema=STORED_FILING)


def current_filings(spark: SparkSession, store: str) -> DataFrame:
    """One row per firm and date. Corrections are told by the files' names, however the files fell into batches; a
    file of the same name that comes again in a later batch replaces the earlier one."""
    return _newest(stored_filings(spark, store)).drop("batch_id", "source_file")


def _newest(rows: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """One row per firm and date. A file's place in the order of arrival is told once for each name, not for each row: the
    patterns for it cost more than all else that is done with a row. ``named``: rows that name all files, if they
    are read more easily than ``rows``."""
    files = (rows if named is None else named).select("source_file").distinct()
    files = files.withColumn("file", arrival_order(F.col("source_file")))
    arrival = F.struct("file", "batch_id", "source_file").alias("arrival")
    told = rows.join(F.broadcast(files), "source_file", "left").select(*rows.columns, arrival)
    return dedupe_filings(told, "arrival").drop("arrival")


def current_scores(spark: SparkSession, store: str) -> DataFrame:
    """The scores of all current filings."""
    return snapshots.read(spark, store, "scores", schema=RISK_SCORE)


def stored_rejects(spark: SparkSession, store: str) -> DataFrame:
    """Rows and files that were not accepted, with the reason."""
    return snapshots.read(spark, store, "rejects", schema=STORED_REJECT)


def loaded_files(spark: SparkSession, store: str) -> DataFrame:
    """One line per file that a batch took: what came of it. Serves ``new_files`` as the manifest."""
    return snapshots.read(spark, store, "files", schema=STORED_FILE)


def unloaded_files(spark: SparkSession, source: str, store: str) -> DataFrame:
    """The filing files below ``source`` that no batch took: those that arrived since, and empty ones, of which Spark's
    streams make no row. With :func:`loaded_files` every file is told of."""
    listed = list_files(spark, source, CSV_NAMES).where(loadable(F.col("path")))
    waiting = new_files(listed, loaded_files(spark, store)).select("path", F.lit(NOT_LOADED).alias("message"))
    empty = empty_files(spark, source).select(F.col("source_file").alias("path"), F.col("reason").alias("message"))
    return waiting.unionByName(empty)


def _before(spark: SparkSession, store: str, batch_id: int) -> snapshots.Commit | None:
    """The commit that the batch goes on from: the newest of an earlier batch."""
    at = snapshots.latest(spark, store)
    while at is not None and at.note["batch_id"] >= batch_id:
        at = snapshots.latest(spark, store, before=at.number)
    return at


def load_batch(
    spark: SparkSession,
    store: str,
    filings: DataFrame,
    batch_id: int,
    rejects: DataFrame | None = None,
    files: DataFrame | None = None,
    buckets: int = snapshots.BUCKETS,
) -> None:
    """Store a batch of filings and bring the scores of the firms in it up to date.

    Late filings need no watermark. Which buckets hold a late filing is all that reaches the driver.
    """
    base = _before(spark, store, batch_id)
    write = snapshots.Write(spark, store, buckets, base)
    batch = F.lit(batch_id).cast("bigint").alias("batch_id")
    rows = write.put("filings", filings.select(*[f.name for f in FILING], "source_file", batch), FIRM)
    fresh = _newest(rows).select(*NEEDED).persist(StorageLevel.DISK_ONLY)  # scores, state and what is late are all told by it
    held = [fresh]
    dealt = snapshots.touched(rows, FIRM, write.buckets)
    if base is None:
        scores, state, again = score_changes(filing_changes(fresh)), firm_state(fresh), []
    else:
        known = snapshots.read(spark, store, "state", base, dealt)
        first = fresh.groupBy(*FIRM).agg(F.min("filing_date").alias("first"))
        late = first.join(known, FIRM).where(F.col("first") <= F.col("last.filing_date")).select(*FIRM)
        held.append(late := late.persist(StorageLevel.DISK_ONLY))
        again = snapshots.touched(late, FIRM, write.buckets)
        newer = fresh.join(late, FIRM, "left_anti") if again else fresh
        scores, state = score_changes(filing_changes(newer, carried=known)), firm_state(newer, known)
        if again:
            stored = snapshots.read(spark, store, "filings", base, again).unionByName(rows)
            # dealt by firm and in order of dates once, for the scores and for the state
            history = _newest(stored.join(late.hint("shuffle_hash"), FIRM, "left_semi"), stored).select(*NEEDED)
            held.append(history := history.persist(StorageLevel.DISK_ONLY))
            rest = snapshots.read(spark, store, "scores", base, again).join(late, FIRM, "left_anti")
            scores = scores.unionByName(rest).unionByName(score_changes(filing_changes(history)))
            state = state.unionByName(firm_state(history))
        state = state.unionByName(known.join(first, FIRM, "left_anti"))
    write.put("scores", scores, FIRM, replaced=again)
    write.put("state", state, FIRM, replaced=dealt)
    if rejects is not None:
        write.put("rejects", rejects.select(*[f.name for f in STORED_REJECT.fields[:-1]], batch), ["source_file"])
    if files is not None:
        write.put("files", files.select(*LOADED_FILE.names, batch), ["path"])
    write.commit(batch_id=batch_id)
    for table in held:
        table.unpersist()


def ingest_stream(
    spark: SparkSession,
    source: str,
    store: str,
    checkpoint: str,
    files_per_batch: int = 100,
    dates: str = "file_name",
    read: Callable[..., DataFrame] = read_filing_csv,
    buckets: int = snapshots.BUCKETS,
) -> StreamingQuery:
    """Load the files that are new since the last run, then stop. Files of a batch are bounded by
    ``files_per_batch``, so their names fit on the driver. A new store is dealt into ``buckets``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        taken = batch.collect()
        if not taken:
            return
        rows = read(session, [file.path for file in taken], dates=dates).persist(StorageLevel.DISK_ONLY)
        files = session.createDataFrame(taken, batch.schema).withColumn("path", one_spelling(F.col("path")))
        listed = load_ledger(files.select(F.col("path").alias("source_file")), rows)
        ledger = files.join(listed.withColumnRenamed("source_file", "path"), "path")
        load_batch(session, store, accepted(rows), batch_id, rejected(rows), ledger, buckets)
        rows.unpersist()

    return (
        new_file_stream(spark, source, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, store: str) -> None:
    """Brings the store's writes together in one, superseded scores and states left out. Filings all stay, corrected
    ones too. Earlier files remain until :func:`~filingscope.sinks.snapshots.expire`."""
    snapshots.compact(spark, store)
