"""Tables in files that change as a whole or not at all.

A folder holds one table or several that change together. A write puts its rows below ``<table>/write=<id>/bucket=<b>``
and counts once its commit, one small file, is there; readers start from the newest commit. A write that fails leaves
files that no commit names, and rows may be read from the table they are about to replace.

Rows are dealt into a fixed number of buckets by a hash of their key. A commit names the writes that count and, for
every table and bucket, the first of them that does: a write either adds rows to a bucket or takes the place of all
earlier ones, and the files of the other buckets stay as they are. Two writers that start from the same commit cannot both
commit: the second one's is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingscope.sinks.tables import upsert

BUCKETS = 64
TABLE = "rows"


class Commit(NamedTuple):
    number: int
    buckets: int
    writes: list[str]  # that count, oldest first; each begins with the number of its commit
    since: dict[str, list[int]]  # by table: for each bucket, the number of the first write that counts
    columns: dict[str, str]  # by table: the schema as JSON
    key: dict[str, list[str]]  # by table: what the buckets are dealt by
    note: dict[str, Any]


NEWEST: Any = object()


class WriteConflict(Exception):
    """Another write was committed in the meantime."""


def _folder(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path, as Hadoop knows them."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _commit_file(root: str, number: int) -> str:
    return f"{root}/commits/{number:08d}.json"


def commits(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commits, in order."""
    files, where = _folder(spark, f"{root}/commits")
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))


def _load(spark: SparkSession, root: str, number: int) -> Commit | None:
    text = spark.read.text(_commit_file(root, number), wholetext=True).first()
    try:
        return Commit(**json.loads(text.value)) if text else None
    except json.JSONDecodeError:  # its writer died in between
        return None


def latest(spark: SparkSession, root: str, before: int | None = None) -> Commit | None:
    """The newest whole commit, or the newest one before a number."""
    numbers = [n for n in commits(spark, root) if before is None or n < before]
    return next((c for n in reversed(numbers) if (c := _load(spark, root, n))), None)


def commit(spark: SparkSession, root: str, made: Commit) -> None:
    """Makes a write count. The file is only ever created, so of two writers with one number the second one fails."""
    files, where = _folder(spark, _commit_file(root, made.number))
    if files.exists(where):
        raise WriteConflict(f"{root}: commit {made.number} is there already")
    try:
        out = files.create(where, False)
    except Exception as problem:
        if files.exists(where):
            raise WriteConflict(f"{root}: commit {made.number} is there already") from problem
        raise
    out.write(bytearray(json.dumps(made._asdict()).encode()))
    out.close()


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class Write:
    """One write to the tables below ``root``: rows are put, then all of it is committed.

    ``base`` is the commit to go on from (default: the newest), None to begin anew.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, base: Commit | None = NEWEST):
        numbers = commits(spark, root)
        self.base = latest(spark, root) if base is NEWEST else base
        self.spark, self.root = spark, root
        self.number = (numbers[-1] if numbers else 0) + 1
        self.id = f"{self.number:08d}-{uuid.uuid4().hex[:12]}"
        self.buckets = self.base.buckets if self.base else buckets
        self.since = {t: list(s) for t, s in self.base.since.items()} if self.base else {}
        self.columns = dict(self.base.columns) if self.base else {}
        self.key = dict(self.base.key) if self.base else {}

    def put(self, table: str, rows: DataFrame, key: Sequence[str], replaced: Iterable[int] = ()) -> DataFrame:
        """Adds rows to a table; in the ``replaced`` buckets they take the place of what was there. Returns the rows
        as they are stored, before the commit."""
        self.columns[table] = rows.schema.json()
        self.key[table] = list(key)
        path = f"{self.root}/{table}/write={self.id}"
        dealt = rows.withColumn("bucket", bucket_of(key, self.buckets))
        dealt.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
        since = self.since.setdefault(table, [self.number] * self.buckets)
        for b in replaced:
            since[b] = self.number
        stored = T.StructType([*rows.schema.fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(stored).option("basePath", path).parquet(path).drop("bucket")

    def commit(self, **note: Any) -> Commit:
        earlier = self.base.writes if self.base else []
        first = min((n for since in self.since.values() for n in since), default=0)
        writes = [w for w in [*earlier, self.id] if int(w.split("-")[0]) >= first]
        made = Commit(self.number, self.buckets, writes, self.since, self.columns, self.key, note)
        commit(self.spark, self.root, made)
        return made


def read(
    spark: SparkSession,
    root: str,
    table: str = TABLE,
    at: Commit | None = None,
    buckets: Iterable[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The rows of a table at a commit (default: the newest). With ``buckets`` only their files are opened. A table that
    was never written is empty, if its ``schema`` is given."""
    at = latest(spark, root) if at is None else at
    if at is None or table not in at.since:
        if schema is None:
            raise FileNotFoundError(f"no table {table} below {root}")
        return spark.createDataFrame([], schema)
    rows = T.StructType.fromJson(json.loads(at.columns[table]))
    first = min(at.since[table])
    files, _ = _folder(spark, root)
    paths = [f"{root}/{table}/write={w}" for w in at.writes if int(w.split("-")[0]) >= first]
    paths = [p for p in paths if files.exists(_folder(spark, p)[1])]
    stored = T.StructType(
        [*rows.fields, T.StructField("write", T.StringType()), T.StructField("bucket", T.IntegerType())]
    )
    if not paths:
        return spark.createDataFrame([], rows)
    found = spark.read.schema(stored).option("basePath", f"{root}/{table}").parquet(*paths)
    if len(set(at.since[table])) > 1:  # both columns are folder names, so the files are left out before they are opened
        oldest = F.element_at(F.array(*[F.lit(n) for n in at.since[table]]), F.col("bucket") + 1)
        found = found.where(F.substring("write", 1, 8).cast("int") >= oldest)
    if buckets is not None:
        found = found.where(F.col("bucket").isin([int(b) for b in buckets]))
    return found.select(*[f.name for f in rows])


def touched(rows: DataFrame, key: Sequence[str], buckets: int) -> list[int]:
    """The buckets that the rows' keys belong to: one number per bucket reaches the driver."""
    return sorted(r.b for r in rows.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def replace_table(df: DataFrame, root: str, key: Sequence[str] | None = None, buckets: int = BUCKETS) -> Commit:
    """The table becomes these rows, which may be read from the table itself. ``key`` (default: all columns) deals them
    into buckets."""
    write = Write(df.sparkSession, root, buckets)
    write.put(TABLE, df, key or df.columns, replaced=range(write.buckets))
    return write.commit()


def upsert_table(
    updates: DataFrame, root: str, key: Sequence[str], created_at: str | None = None, buckets: int = BUCKETS
) -> Commit:
    """Adds the rows of ``updates`` or puts them in the place of those with their key (see
    :func:`~filingscope.sinks.tables.upsert`). Only the buckets they belong to are read and written again. The table is
    dealt by ``key``; one that is dealt otherwise is dealt anew, as a whole."""
    spark = updates.sparkSession
    write = Write(spark, root, buckets)
    if write.base is None:
        wanted, existing = range(write.buckets), updates.limit(0)
    elif write.key[TABLE] != list(key):
        wanted, existing = range(write.buckets), read(spark, root, at=write.base)
    else:
        wanted = touched(updates, key, write.buckets)
        existing = read(spark, root, at=write.base, buckets=wanted)
    write.put(TABLE, upsert(existing, updates, key, created_at), key, replaced=wanted)
    return write.commit()


def compact(spark: SparkSession, root: str, **note: Any) -> Commit:
    """Every table in one write, each row in its newest form; no row changes."""
    write = Write(spark, root)
    for table, key in write.key.items():
        write.put(table, read(spark, root, table, write.base), key, replaced=range(write.buckets))
    return write.commit(**(note or write.base.note))


def expire(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Deletes the files that none of the last ``keep`` commits names, and the older commits. Nothing may be writing to
    the tables, and what still reads an older commit fails. Returns the folders that went."""
    numbers = commits(spark, root)
    kept = [c for n in numbers[-max(1, keep) :] if (c := _load(spark, root, n))]
    if not kept:
        return []
    named = {w for c in kept for w in c.writes}
    gone = []
    for table in {t for c in kept for t in c.since}:
        files, where = _folder(spark, f"{root}/{table}")
        for status in files.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("write=") and name.removeprefix("write=") not in named:
                files.delete(status.getPath(), True)
                gone.append(f"{table}/{name}")
    for number in numbers:
        if number < kept[0].number:
            files, where = _folder(spark, _commit_file(root, number))
            files.delete(where, False)
    return sorted(gone)


def tables(spark: SparkSession, root: str) -> Mapping[str, Sequence[str]]:
    """Names and keys of the tables below ``root``."""
    at = latest(spark, root)
    return at.key if at else {}
