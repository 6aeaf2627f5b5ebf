"""Monthly CSV files with drifting headers, two separators and two encodings.

A file of usual size is one row of a scan: its header, separator and encoding are values of that row, its records are
exploded from it and cut into fields, of which those wanted are taken by the header's positions. So every byte is read
once, however many layouts there are, and nothing of the files reaches the driver.

Larger files are split between tasks. Spark reads many CSV files under one schema by position, so these are
grouped by layout (header line and encoding), found by a filter-only scan, and every layout is read with its own schema.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingscope.rules import DATA_EXTENSIONS, HEADERS
from filingscope.sources.normalize import (
    EMPTY_FILE,
    LATE_HEADER,
    NO_HEADER,
    NO_ROWS,
    NamedColumns,
    PositionedColumns,
    normalize,
    whole_file_rejects,
)

KEY_HEADER = HEADERS["sec_number"]
CORRUPT = "_corrupt_record"
CSV_NAMES = "*.[cC][sS][vV]"
WHOLE_FILE_BYTES = 64 << 20  # up to this size a file is one row of a scan


class Layout(NamedTuple):
    header: str
    encoding: str
    multi_line: bool = False  # a quoted value spans lines

    @property
    def separator(self) -> str:
        return "|" if self.header.count("|") > self.header.count(",") else ","

    @property
    def names(self) -> list[str]:
        return [name.strip() for name in next(csv.reader([self.header], delimiter=self.separator))]


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def one_spelling(path: Column) -> Column:
    """Spark writes a local path with one slash or three; it is kept with three."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def loadable(path: Column, include_exempt: bool = False) -> Column:
    """Whether a file is a filing file: right extension, no resource-fork stub, no FOIA export, and no
    exempt-adviser file unless asked for."""
    name = F.lower(base_name(path))
    extension = reduce(lambda a, b: a | b, [name.endswith(e) for e in DATA_EXTENSIONS])
    keep = extension & ~name.startswith("._") & ~(name.endswith(".csv") & name.contains("foia"))
    return keep if include_exempt else keep & ~name.contains("exempt")


def list_files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """Files below ``path`` at any depth: path, length, modification time. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path if isinstance(path, str) else list(path))
        .select(one_spelling(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))
    )


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest of loaded files does not name."""
    return files.join(manifest.select("path").distinct(), "path", "left_anti")


def fetch_due(run_log: DataFrame, as_of: Column, hours: float = 24) -> DataFrame:
    """One row telling whether the last completed fetch is at least ``hours`` old (true if there was none)."""
    last = run_log.where("run_type = 'fetch' AND status = 'completed'").agg(F.max("completed_at").alias("last_fetch"))
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("last_fetch")) / 3600
    return last.select("last_fetch", F.coalesce(age >= hours, F.lit(True)).alias("due"))


def find_layouts(spark: SparkSession, paths: str | Sequence[str], include_exempt: bool = False) -> dict[Layout, list[str]]:
    return inspect_files(spark, paths, include_exempt)[0]


def inspect_files(
    spark: SparkSession, paths: str | Sequence[str], include_exempt: bool = False
) -> tuple[dict[Layout, list[str]], dict[str, str]]:
    """Files by layout, and the files that cannot be read with the reason. One row per file reaches the driver, as
    Spark's own file listing does.

    The header is the first line, and names the key column. A file with any line that is not UTF-8 is read as
    Latin-1. A file with an odd number of quotes in some line has values that span lines.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", CSV_NAMES)
    texts = reader.text(paths if isinstance(paths, str) else list(paths))
    lines = (
        texts
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
        .where(loadable(F.col("path"), include_exempt))
    )
    at = F.monotonically_increasing_id()  # follows the line order within a file's first split
    marked = lines.select(
        "path",
        at.alias("at"),
        F.when((F.col("start") == 0) & F.col("value").contains(KEY_HEADER), F.col("value")).alias("header"),
        F.when((F.col("start") == 0) & (F.trim("value") != ""), at).alias("line"),
        F.is_valid_utf8("value").alias("valid"),
        (F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)) == 1).alias("open"),
    )
    found = marked.groupBy("path").agg(
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("at"))).alias("header"),
        F.min(F.when(F.col("header").isNotNull(), F.col("at"))).alias("header_at"),
        F.min("line").alias("first_at"),
        F.bool_and("valid").alias("utf8"),
        F.bool_or("open").alias("multi_line"),
    )
    layouts: dict[Layout, list[str]] = defaultdict(list)
    unreadable: dict[str, str] = {}
    for row in found.orderBy("path").collect():
        if row.header is None:
            unreadable[row.path] = NO_HEADER
        elif row.header_at != row.first_at:
            unreadable[row.path] = LATE_HEADER
        else:
            header = row.header.removeprefix("\ufeff").rstrip("\r")
            layouts[Layout(header, "UTF-8" if row.utf8 else "ISO-8859-1", row.multi_line)].append(row.path)
    seen = {_plain(path) for group in (unreadable, *layouts.values()) for path in group}
    named = spark.createDataFrame([(path,) for path in texts.inputFiles()], "path string")
    for row in named.where(loadable(F.col("path"), include_exempt)).collect():
        if _plain(row.path) not in seen:  # no line at all
            unreadable[row.path] = EMPTY_FILE
    return dict(layouts), unreadable


def _plain(path: str) -> str:
    """One spelling for a local path, which Spark writes with one slash or three."""
    return path.replace("file:///", "file:/", 1)


def read_layout(
    spark: SparkSession, layout: Layout, paths: Sequence[str], multi_line: bool = False
) -> tuple[DataFrame, NamedColumns, Column]:
    """Text rows of the files of one layout, access to them by header, and the too-many-fields test.

    Short rows are padded with NULL. Spark marks short and long rows alike, so the fields of the marked
    (rare) rows are counted. Columns are read by position: headers may repeat or differ in case only.
    """
    names = layout.names
    positions = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(p, T.StringType()) for p in [*positions, CORRUPT]])
    rows = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("sep", layout.separator)
        .option("encoding", layout.encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")  # with pruning, the parser no longer sees how long a row is
        .csv(list(paths))
        .select("*", F.col("_metadata.file_path").alias("path"))
    )
    columns: dict[str, Column] = {}
    for name, position in zip(names, positions):
        columns.setdefault(name, F.col(position))
    outside_quotes = f"[{layout.separator}]" + '(?=(?:[^"]*"[^"]*")*[^"]*$)'
    fields = F.size(F.split(F.col(CORRUPT), outside_quotes))
    too_long = F.col(CORRUPT).isNotNull() & (fields > len(names))
    return rows, NamedColumns(columns), too_long


def _fields(line: Column, separator: Column) -> Column:
    """The fields of a record. In a quoted one a doubled quote stands for a quote; a quote elsewhere is itself."""

    def quoted(mark: str) -> Column:
        found = F.regexp_extract_all(
            F.concat(separator, line), F.lit(f'(?s){mark}("[^"]*+(?:""[^"]*+)*+"(?={mark}|\\z)|[^{mark}]*+)'), F.lit(1)
        )
        inside = lambda f: F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))
        is_quoted = lambda f: f.startswith('"') & f.endswith('"') & (F.length(f) > 1)
        return F.transform(found, lambda f: F.when(is_quoted(f), inside(f)).otherwise(f))

    cut = F.when(separator == "|", F.split(line, "[|]")).otherwise(F.split(line, ","))
    return F.when(~line.contains('"'), cut).when(separator == "|", quoted("[|]")).otherwise(quoted("[,]"))


def _records(body: Column, separator: Column) -> Column:
    """The records of a text; a line break inside a quoted field ends none."""

    def quoted(mark: str) -> Column:
        field = rf'(?:"[^"]*+(?:""[^"]*+)*+"(?=[{mark}\r\n]|\z)|[^{mark}\r\n]*+)'
        return F.regexp_extract_all(body, F.lit(rf"(?s)({field}(?:[{mark}]{field})*+)(?:\r\n?|\n|\z)"), F.lit(1))

    plain = F.split(body, "\r\n?|\n")
    return F.when(~body.contains('"'), plain).when(separator == "|", quoted("|")).otherwise(quoted(","))


def text_rows(
    files: DataFrame, dates: str = "file_name", disclosure_variant: str = "flag_or_counts"
) -> DataFrame:
    """The rows of CSV files (``source_file``, ``content``), normalised. One pass: a file's header stays with its rows.

    The first line that is not blank is the header, and names the key column. A file that is not UTF-8 is Latin-1.
    What cannot be read, and a file without rows, is one rejected row with the reason; so is a file for which the column
    ``unreadable``, if there is one, names it (``content`` then is null).
    """
    known = F.col("unreadable") if "unreadable" in files.columns else F.lit(None).cast("string")
    text = F.col("content").cast("string")
    decoded = F.when(F.is_valid_utf8(text), text).otherwise(F.decode("content", "ISO-8859-1"))
    first = F.regexp_extract("text", r"\A\s*+([^\r\n]*+)", 1)
    counted = lambda mark: F.length("first") - F.length(F.replace(F.col("first"), F.lit(mark), F.lit("")))
    opened = (
        files.select("source_file", known.alias("unreadable"), F.ltrim(decoded, F.lit("\ufeff")).alias("text"))
        .withColumn("first", first)
        .withColumn("separator", F.when(counted("|") > counted(","), "|").otherwise(","))
    )
    problem = (
        F.when(F.col("unreadable").isNotNull(), F.col("unreadable"))
        .when(F.col("first") == "", EMPTY_FILE)
        .when(~F.col("text").contains(KEY_HEADER), NO_HEADER)
        .when(~F.col("first").contains(KEY_HEADER), LATE_HEADER)
    )
    separator = F.col("separator")
    body = F.regexp_replace("text", r"\A\s*+[^\r\n]*+(?:\r\n?|\n)?", "")
    headed = opened.select(
        "source_file",
        "separator",
        problem.alias("problem"),
        F.transform(_fields(F.col("first"), separator), lambda n: F.trim(n)).alias("names"),
        F.when(problem.isNull(), F.filter(_records(body, separator), lambda r: F.trim(r) != "")).alias("records"),
    )
    placed = headed.select(
        "source_file",
        "problem",
        F.size("names").alias("width"),
        PositionedColumns.positions("names").alias("at"),
        F.transform("records", lambda r: _fields(r, separator)).alias("fields"),
    )
    # the values come out of the explode as plain columns, so that no filter on them is spelled out in terms of the text
    rows = placed.select("source_file", "problem", "width", F.inline_outer(PositionedColumns.records("at", "fields")))
    problem = F.when(F.col("fields").isNull(), F.coalesce("problem", F.lit(NO_ROWS)))
    too_long = F.col("fields") > F.col("width")
    return normalize(rows, PositionedColumns(), F.col("source_file"), dates, disclosure_variant, too_long, problem)


def read_filing_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    dates: str = "file_name",
    disclosure_variant: str = "flag_or_counts",
    include_exempt: bool = False,
    layouts: dict[Layout, list[str]] | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """All filing CSV files below ``paths`` as normalised rows (see :func:`normalize`).

    A file that cannot be read, or has no rows, is one rejected row with the reason and the file's name. Files above
    ``whole_file_bytes`` are read by layout. ``layouts`` may name the files of each layout where they are known; then
    all are read so. Spark cannot split a file with line breaks inside quotes between tasks.
    """
    if layouts is not None:
        return _by_layout(spark, layouts, {}, dates, disclosure_variant)
    found = _found(spark, paths).where(loadable(F.col("path"), include_exempt))
    usual = found.where(F.col("length") <= whole_file_bytes)
    rows = text_rows(usual.select(one_spelling(F.col("path")).alias("source_file"), "content"), dates, disclosure_variant)
    rows = rows.unionByName(whole_file_rejects(empty_files(spark, paths, include_exempt)))
    large = [r.path for r in found.where(F.col("length") > whole_file_bytes).select("path").collect()]
    if not large:
        return rows
    return rows.unionByName(_by_layout(spark, *inspect_files(spark, large, include_exempt), dates, disclosure_variant))


def _found(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", CSV_NAMES)
        .load(paths if isinstance(paths, str) else list(paths))
    )


def empty_files(spark: SparkSession, paths: str | Sequence[str], include_exempt: bool = False) -> DataFrame:
    """Files that are listed but of which no scan makes a row, with the reason. Names alone are compared."""
    found = _found(spark, paths)
    listed = found.sparkSession.createDataFrame([(path,) for path in found.inputFiles()], "listed string")
    seen = found.select(one_spelling(F.col("_metadata.file_path")).alias("listed"))
    missing = listed.select(one_spelling(F.col("listed")).alias("listed")).join(seen, "listed", "left_anti")
    name = F.url_decode(F.replace(F.col("listed"), F.lit("+"), F.lit("%2B")))
    empty = missing.select(name.alias("source_file"), F.lit(EMPTY_FILE).alias("reason"))
    return empty.where(loadable(F.col("source_file"), include_exempt))


def _by_layout(
    spark: SparkSession,
    layouts: dict[Layout, list[str]],
    unreadable: dict[str, str],
    dates: str,
    disclosure_variant: str,
) -> DataFrame:
    parts = [whole_file_rejects(spark.createDataFrame(sorted(unreadable.items()), "source_file string, reason string"))]
    for layout, files in layouts.items():
        rows, raw, too_long = read_layout(spark, layout, files, layout.multi_line)
        parts.append(normalize(rows, raw, F.col("path"), dates, disclosure_variant, too_long))
    return reduce(DataFrame.unionByName, parts).withColumn("source_file", one_spelling(F.col("source_file")))
