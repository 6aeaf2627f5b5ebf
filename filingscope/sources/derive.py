"""Raw inputs derived from a filing history: form rows as text, CSV files, archives, workbooks, listing pages.

They give the ingest operators whole-table input wherever no real monthly files are at hand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope.rules import FILING_DATE_HEADER, HEADERS

FORM_DATE = "MM/dd/yyyy"


def form_rows(filings: DataFrame, disclosure_counts: bool = False, blank_keys: bool = True) -> DataFrame:
    """Filings as rows of the raw form: untidy text under the form's headers, plus ``filing_date``.

    Keys are padded with blanks, and blank altogether where ``raum`` is unknown if ``blank_keys``. Disclosures
    are item 11's yes/no answer or, with ``disclosure_counts``, the counts of two of its sections.
    """
    raum, clients = F.col("raum"), F.col("client_count")
    key = F.concat(F.lit(" "), "sec_number", F.lit(" "))
    key = F.when(raum.isNull(), F.lit("  ")).otherwise(key) if blank_keys else key
    half = F.floor(clients / 2).cast("int")
    umbrella = F.when(F.col("firm_type") == "BUILDING", "Y").when(F.col("firm_type") == "MACHINERY", "No")
    listed = F.coalesce("disciplinary_disclosures", F.lit(0))
    values = {
        HEADERS["sec_number"]: key,
        HEADERS["crd_number"]: F.lpad("crd_number", 12, "0"),
        HEADERS["firm_name"]: F.concat(F.lit("Société "), "firm_name"),
        HEADERS["sec_region"]: F.col("sec_region"),
        HEADERS["sec_status_date"]: F.date_format("filing_date", FORM_DATE),
        HEADERS["raum"]: F.coalesce(raum.cast("string"), F.lit("N/A")),
        HEADERS["account_count"]: F.concat(F.col("account_count").cast("string"), F.lit(".0")),
        HEADERS["cco_name"]: F.col("cco_name"),
        HEADERS["firm_type"]: F.col("firm_type"),
        HEADERS["umbrella_registration"]: umbrella,
        HEADERS["main_office_country"]: F.col("main_office_country"),
        "5D(a)(1)": half.cast("string"),
        "5D(b)(1)": (clients - half).cast("string"),
        "5D(n)(1)": F.lit("none"),
        FILING_DATE_HEADER: F.date_format("filing_date", FORM_DATE),
    }
    if disclosure_counts:
        values["11A(1) Count"] = F.least(listed, F.lit(1)).cast("string")
        values["11H(2) Count"] = (listed - F.least(listed, F.lit(1))).cast("string")
    else:
        values["11"] = F.when(listed > 0, "Y").otherwise("N")
    return filings.select(*[c.alias(name) for name, c in values.items()], F.col("filing_date").alias("filed"))


def monthly_name(date: Column) -> Column:
    return F.concat(F.lit("ia"), F.date_format(date, "MMddyyyy"), F.lit(".csv"))


def write_form_files(rows: DataFrame, path: str, separator: str = ",", encoding: str = "UTF-8") -> None:
    rows.drop("filed").write.mode("append").option("header", "true").option("sep", separator).option(
        "encoding", encoding
    ).csv(path)


def _packets(rows: DataFrame, line: Callable[[list[Column]], Column]) -> DataFrame:
    """All rows of a firm and year in one packet, each spelled out by ``line``: one row per firm and date, so at most 366."""
    names = [c for c in rows.columns if c != "filed"]
    key = F.trim(F.col(f"`{HEADERS['crd_number']}`"))
    text = line([F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names])
    return rows.groupBy(key.alias("crd"), F.year("filed").alias("year")).agg(
        F.sort_array(F.collect_list(F.struct(F.date_format("filed", "MMddyyyy").alias("day"), text.alias("line")))).alias("rows")
    )


def _csv_line(cells: list[Column]) -> Column:
    """A record as a CSV writer spells it: quoted where a field has a separator, a quote or a line break."""
    quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells]
    return F.concat_ws(",", *[F.when(c.rlike('[",\r\n]'), q).otherwise(c) for c, q in zip(cells, quoted)])


def _sheet_line(cells: list[Column]) -> Column:
    """A record as a row of a sheet."""
    texts = cells
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        texts = [F.replace(c, F.lit(mark), F.lit(name)) for c in texts]
    between = '</t></is></c><c t="inlineStr"><is><t>'
    return F.concat(F.lit('<row><c t="inlineStr"><is><t>'), F.concat_ws(between, *texts), F.lit("</t></is></c></row>"))


def _zip_writer() -> Callable[[list[tuple]], bytes]:
    """A closure that packs (name, data, flags, change of the checksum) uncompressed, dated 1980-01-01. Python's writer takes
    some 50 microseconds a member, most of the time of archives as small as these."""

    def zipped(members: list[tuple[str, bytes, int, int]]) -> bytes:
        import struct
        import zlib

        parts, listed, at = [], [], 0
        for name, data, flags, change in members:
            encoded, size, crc = name.encode(), len(data), zlib.crc32(data)
            parts += (struct.pack("<4s5H3L2H", b"PK\3\4", 20, 0, 0, 0, 33, crc, size, size, len(encoded), 0), encoded, data)
            entry = struct.pack(
                "<4s6H3L5H2L", b"PK\1\2", 20, 20, flags, 0, 0, 33, crc ^ change, size, size, len(encoded), 0, 0, 0, 0, 0, at
            )
            listed += (entry, encoded)
            at += 30 + len(encoded) + size
        listing = b"".join(listed)
        end = struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, len(members), len(members), len(listing), at, 0)
        return b"".join((*parts, listing, end))

    return zipped


def archives(rows: DataFrame, damaged: bool = False) -> DataFrame:
    """ZIP archives (``path``, ``content``), one per firm and year, with a CSV per filing, a note and a stub.

    With ``damaged``, of five firms one has files without rows, one empty files, one files whose checksum is wrong and
    one encrypted files.
    """
    names = [c for c in rows.columns if c != "filed"]
    zipped = _zip_writer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import csv
        import io

        import pyarrow as pa

        text = io.StringIO()
        csv.writer(text).writerow(names)
        header = text.getvalue().encode()

        def packed(crd: str, filed: list[dict]) -> bytes:
            kind = int(crd) % 5 if damaged else 0
            flags, change = (1 if kind == 4 else 0), (1 if kind == 3 else 0)
            members = []
            for row in filed:
                data = b"" if kind == 2 else header if kind == 1 else header + row["line"].encode() + b"\r\n"
                members.append((f"form/ia{row['day']}.csv", data, flags, change))
            members.append(("readme.txt", f"{len(filed)} filings".encode(), 0, 0))
            members.append(("__MACOSX/._readme.txt", b"", 0, 0))
            return zipped(members)

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                firms = batch.slice(start, 500).to_pylist()
                paths = [f"{f['crd']}-{f['year']}.zip" for f in firms]
                contents = pa.array([packed(f["crd"], f["rows"]) for f in firms], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), contents], names=["path", "content"])

    return _packets(rows, _csv_line).mapInArrow(pack, "path string, content binary")


def workbooks(rows: DataFrame) -> DataFrame:
    """Workbooks (``path``, ``content``), one per firm and year, with a row per filing."""
    names = [c for c in rows.columns if c != "filed"]
    zipped = _zip_writer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xml.sax.saxutils import escape

        import pyarrow as pa

        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        book = (
            f'<workbook xmlns="{main}" xmlns:r="{office}">'
            '<sheets><sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>'
        )
        links = (
            f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
            f'Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
        )
        header = "<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(c)}</t></is></c>' for c in names) + "</row>"

        def packed(filed: list[dict]) -> bytes:
            body = header + "".join(row["line"] for row in filed)
            sheet = f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>'
            parts = {"xl/workbook.xml": book, "xl/_rels/workbook.xml.rels": links, "xl/worksheets/sheet1.xml": sheet}
            return zipped([(name, part.encode(), 0, 0) for name, part in parts.items()])

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                firms = batch.slice(start, 500).to_pylist()
                paths = [f"{f['crd']}-{f['year']}.xlsx" for f in firms]
                contents = pa.array([packed(f["rows"]) for f in firms], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), contents], names=["path", "content"])

    return _packets(rows, _sheet_line).mapInArrow(pack, "path string, content binary")


def listing_pages(filings: DataFrame) -> DataFrame:
    """One page per month that links an archive per filing date, plus an exempt one (at most 31 each)."""
    day = F.date_format("filing_date", "MMddyyyy")
    dates = filings.select("filing_date").distinct()
    anchor = F.concat(
        F.lit('<li><a class="file" href="/files/ia'), day, F.lit('.zip">Registered <b>'), day, F.lit("</b></a></li>"),
        F.lit('<li><a href="/files/ia-'), day, F.lit('.zip">Exempt Reporting</a></li>'),
        F.lit('<li><a href="https://example.org/ia'), day, F.lit('-2.ZIP">Upper</a></li><li><a href="/about">About</a></li>'),
    )
    return (
        dates.groupBy(F.trunc("filing_date", "month").alias("month"))
        .agg(F.array_join(F.sort_array(F.collect_list(anchor)), "\n").alias("anchors"))
        .select(
            (F.year("month") * 100 + F.month("month")).cast("long").alias("page_id"),
            F.concat(F.lit("https://data.example.org/list/"), F.date_format("month", "yyyy-MM")).alias("url"),
            F.concat(F.lit("<html><body><ul>"), "anchors", F.lit("</ul></body></html>")).alias("html"),
        )
    )
