"""ZIP archives and workbooks: binary files opened inside tasks, one archive at a time.

The functions run in Python workers are closures, so that workers need not import this package.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingscope.rules import DATA_EXTENSIONS
from filingscope.sources.csv_files import base_name, loadable, text_rows
from filingscope.sources.normalize import (
    BROKEN_ARCHIVE,
    BROKEN_MEMBER,
    ENCRYPTED_MEMBER,
    NO_MEMBER,
    UNSUPPORTED,
    MapColumn,
    normalize,
    whole_file_rejects,
)

MEMBER_SCHEMA = "archive string, entry string, member string, content binary, error string"
ROW_SCHEMA = "source_file string, row_number long, fields map<string,string>, error string"


def read_binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "content")
    )


def zip_entries(archives: DataFrame, extensions: tuple[str, ...] | None = DATA_EXTENSIONS, contents: bool = True) -> DataFrame:
    """Files inside ZIP archives (``path``, ``content``), named without their folders.

    An archive that cannot be opened gives one row with an error and no entry, as does one without a wanted entry; a
    damaged or encrypted member gives its own row with an error, and the others are read. ``extensions=None`` lists every
    entry.
    """

    def open_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import struct
        import zipfile
        import zlib

        import pyarrow as pa

        types = {"archive": pa.string(), "entry": pa.string(), "member": pa.string(), "content": pa.binary(), "error": pa.string()}
        damage = (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError, OSError, ValueError, struct.error)

        def members(content: bytes) -> Iterator[tuple]:
            some = False
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    entry = info.filename
                    if extensions is not None and not entry.lower().endswith(extensions):
                        continue
                    some, data, error = True, None, None
                    if contents and info.flag_bits & 1:
                        error = ENCRYPTED_MEMBER
                    elif contents:
                        try:
                            data = archive.read(info)
                        except damage:
                            error = BROKEN_MEMBER
                    yield entry, entry.rsplit("/", 1)[-1], data, error
            if not some:
                yield None, None, None, NO_MEMBER

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types.values())]
            return pa.RecordBatch.from_arrays(columns, names=list(types))

        rows, size = [], 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):  # one archive's bytes at a time
                path = path.as_py()
                try:
                    for member in members(content.as_py()):
                        rows.append((path, *member))
                        size += len(member[2] or b"")
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                except damage as problem:
                    rows.append((path, None, None, None, str(problem) or BROKEN_ARCHIVE))
        if rows:
            yield batch_of(rows)

    return archives.select("path", "content").mapInArrow(open_archives, MEMBER_SCHEMA)


def archive_census(archives: DataFrame) -> DataFrame:
    """Per archive: real files in it (no folders, no resource forks), data files by type, any error."""
    entries = zip_entries(archives, extensions=None, contents=False)
    real = F.col("entry").isNotNull() & ~F.col("entry").startswith("__MACOSX/") & ~F.col("entry").endswith("/")
    name = F.lower("entry")
    workbook = name.endswith(".xlsx") | name.endswith(".xls")
    return entries.groupBy("archive").agg(
        F.count_if(real).alias("files"),
        F.count_if(real & workbook).alias("workbooks"),
        F.count_if(real & name.endswith(".csv")).alias("csv_files"),
        F.count_if(real & ~workbook & ~name.endswith(".csv")).alias("other_files"),
        F.max("error").alias("error"),
    )


def multi_file_archives(census: DataFrame) -> DataFrame:
    return census.where("files > 1")


def member_name() -> Column:
    """The archive's name and the entry's, so that equal names in different places stay apart."""
    return F.concat(base_name(F.col("archive")), F.lit("!/"), F.col("entry")).alias("source_file")


def member_rows(members: DataFrame, **options: str) -> DataFrame:
    """The rows of CSV members, normalised as those of CSV files are."""
    csv_members = members.where(F.lower("member").endswith(".csv") & F.col("content").isNotNull())
    return text_rows(csv_members.select(member_name(), "content"), **options)


def workbook_rows(workbooks: DataFrame) -> DataFrame:
    """Rows of the first sheet of ``.xlsx`` workbooks (``path``, ``content``) as header-to-text maps.

    A workbook is a ZIP of XML parts and holds at most 1,048,576 rows per sheet, so one fits in a task.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import re
        import zipfile
        import zlib
        from xml.etree import ElementTree

        import pyarrow as pa

        types = {
            "source_file": pa.string(), "row_number": pa.int64(), "fields": pa.map_(pa.string(), pa.string()), "error": pa.string(),
        }
        at_once = 4 << 20  # a sheet up to this size is parsed whole, a larger one row by row

        def text_of(node) -> str:
            parts = [t.text for t in node.iter() if t.text and t.tag.endswith("}t")]
            return parts[0] if len(parts) == 1 else "".join(parts)

        def position(reference: str) -> int:
            number = 0
            for letter in re.match("[A-Z]+", reference).group():
                number = number * 26 + ord(letter) - 64
            return number - 1

        def first_sheet(book: zipfile.ZipFile) -> str:
            sheet = next(n for n in ElementTree.fromstring(book.read("xl/workbook.xml")).iter() if n.tag.endswith("}sheet"))
            link = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
            for relation in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
                if relation.attrib["Id"] == link:
                    return "xl/" + relation.attrib["Target"].removeprefix("/xl/")
            raise KeyError(link)

        def row_nodes(book: zipfile.ZipFile, name: str):
            if book.getinfo(name).file_size <= at_once:
                try:
                    sheet = ElementTree.fromstring(book.read(name))
                except (zipfile.BadZipFile, zlib.error, ElementTree.ParseError):
                    sheet = None  # damaged: read row by row as far as it goes
                if sheet is not None:
                    yield from (node for node in sheet.iter() if node.tag.endswith("}row"))
                    return
            with book.open(name) as sheet:
                for _, node in ElementTree.iterparse(sheet):
                    if node.tag.endswith("}row"):
                        yield node
                        node.clear()

        def rows_of(content: bytes):
            with zipfile.ZipFile(io.BytesIO(content)) as book:
                shared = []
                if "xl/sharedStrings.xml" in book.namelist():
                    shared = [text_of(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
                for node in row_nodes(book, first_sheet(book)):
                    cells, index = {}, -1
                    for cell in node:
                        if not cell.tag.endswith("}c"):
                            continue
                        index += 1
                        kind, reference = cell.get("t"), cell.get("r")
                        if kind == "inlineStr":
                            value = text_of(cell)
                        else:
                            value = next((v.text for v in cell if v.tag.endswith("}v")), None)
                            if kind == "s" and value is not None:
                                value = shared[int(value)]
                        if value:
                            cells[index if reference is None else position(reference)] = value
                    yield cells

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), types.values())]
            return pa.RecordBatch.from_arrays(columns, names=list(types))

        rows = []
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):  # one workbook's bytes at a time
                path, header = path.as_py(), None
                try:
                    for number, cells in enumerate(rows_of(content.as_py())):
                        if header is None:
                            header = {at: name.strip() for at, name in cells.items()}
                            continue
                        fields = {header[at]: text for at, text in cells.items() if at in header}
                        rows.append((path, number, list(fields.items()), None))
                        if len(rows) >= 1000:
                            yield batch_of(rows)
                            rows = []
                except (zipfile.BadZipFile, KeyError, StopIteration, ElementTree.ParseError) as problem:
                    rows.append((path, None, None, f"unreadable workbook: {problem}"))
        if rows:
            yield batch_of(rows)

    return workbooks.select("path", "content").mapInArrow(parse, ROW_SCHEMA)


def workbook_census(workbooks: DataFrame) -> DataFrame:
    """Sheets per workbook, read from the archive's table of contents."""
    parts = zip_entries(workbooks, extensions=(".xml",), contents=False)
    sheet = F.coalesce(F.col("entry").rlike(r"^xl/worksheets/[^/]+\.xml$"), F.lit(False))
    return parts.groupBy(F.col("archive").alias("path")).agg(
        F.count_if(sheet).alias("sheets"), F.max("error").alias("error")
    )


def file_types(files: DataFrame) -> DataFrame:
    """Number of files per kind of a file listing."""
    name = F.lower(base_name(F.col("path")))
    kind: Column = (
        F.when(name.endswith(".xlsx") | name.endswith(".xls"), "workbook").when(name.endswith(".csv"), "csv").otherwise("other")
    )
    return files.groupBy(kind.alias("kind")).agg(F.count("*").alias("files"))


def normalize_rows(rows: DataFrame, dates: str = "file_name", disclosure_variant: str = "flag_or_counts") -> DataFrame:
    """Rows of archive members or workbooks as normalised rows; unreadable files and long rows are rejected."""
    return normalize(
        rows, MapColumn("fields"), F.col("source_file"), dates, disclosure_variant, F.col("error").isNotNull()
    )


def _entry_name() -> Column:
    return F.when(F.col("entry").isNull(), base_name(F.col("archive"))).otherwise(member_name())


def _entry_problem() -> Column:
    """Why an archive or a member of it cannot be read."""
    return (
        F.when(F.col("error").isin(NO_MEMBER, BROKEN_MEMBER, ENCRYPTED_MEMBER), F.col("error"))
        .when(F.col("error").isNotNull(), BROKEN_ARCHIVE)
        .when(F.lower("member").endswith(".xls"), UNSUPPORTED)
    )


def member_problems(entries: DataFrame) -> DataFrame:
    """Archives and members that cannot be read, one rejected row each."""
    told = entries.select(_entry_name().alias("source_file"), _entry_problem().alias("reason"))
    return whole_file_rejects(told.where("reason IS NOT NULL"))


def member_outcomes(entries: DataFrame, **options: str) -> DataFrame:
    """:func:`member_rows` and :func:`member_problems` of the same entries in one pass, so that each archive is opened
    once. Of a rejected row only the file and the reason are told."""
    csv_member = F.lower("member").endswith(".csv") & F.col("content").isNotNull()
    told = entries.select(
        _entry_name().alias("source_file"), F.when(csv_member, F.col("content")).alias("content"), _entry_problem().alias("unreadable")
    )
    return text_rows(told.where("content IS NOT NULL OR unreadable IS NOT NULL"), **options)


def read_filing_archives(spark: SparkSession, path: str, include_exempt: bool = False, **options: str) -> DataFrame:
    """The CSV files and workbooks inside the ZIP archives below ``path`` as normalised rows."""
    entries = zip_entries(read_binary(spark, path, "*.[zZ][iI][pP]"))
    wanted = entries.where(F.col("member").isNull() | loadable(F.col("member"), include_exempt))
    books = wanted.where(F.lower("member").endswith(".xlsx") & F.col("content").isNotNull())
    sheets = normalize_rows(workbook_rows(books.select(member_name().alias("path"), "content")), **options)
    return member_rows(wanted, **options).unionByName(sheets).unionByName(member_problems(wanted))


def read_filing_workbooks(spark: SparkSession, path: str, include_exempt: bool = False, **options: str) -> DataFrame:
    """The workbooks below ``path`` as normalised rows."""
    books = read_binary(spark, path, "*.[xX][lL][sS][xX]").where(loadable(F.col("path"), include_exempt))
    return normalize_rows(workbook_rows(books), **options)
