import io
import zipfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingscope.functions.text import archive_year, file_name_date
from filingscope.schemas import FILING, conform, describe_columns
from filingscope.sources import archives, csv_files, links, normalize

HEADER = "SEC#,Organization CRD#,Primary Business Name,5F(2)(c),5F(2)(f),5D(a)(1),5D(b)(1),11,Umbrella Registration"


@pytest.fixture
def folder(tmp_path):
    """Monthly files of every kind the loader meets."""
    files = {
        "ia01032022.csv": (HEADER + "\n801-1,007,Café Capital,1000.50,12.0,3,4,Y,Yes\n801-2,008,Beta,n/a,x,,2,N,N\n").encode("latin-1"),
        "deep/ia020122.csv": "SEC#|Primary Business Name|5F(2)(c)|Count of 11A|Count of 11H|Latest ADV Filing Date\n"
        "801-1|Café Capital|900|1|2|02/01/2022\n  |No Key|1|0|0|02/01/2022\n",
        "ia-030122-2.csv": HEADER + '\n801-3,009,"Gamma, LLC",5,1,1,1,N,\n801-4,010,Short,7\n801-5,011,Long,1,1,1,1,N,N,extra,"a,b"\n',
        "ia040122exempt.csv": HEADER + "\n801-9,1,Exempt,1,1,1,1,N,N\n",
        "FOIA050122.csv": HEADER + "\n801-9,1,Foia,1,1,1,1,N,N\n",
        "._ia01032022.csv": "stub",
        "ia060122.txt": HEADER + "\n801-9,1,Text,1,1,1,1,N,N\n",
        "iaX.csv": HEADER + "\n801-6,1,Undated,1,1,1,1,N,N\n",
    }
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(tmp_path)


def test_csv_files_of_all_kinds(spark, folder):
    rows = csv_files.read_filing_csv(spark, folder)
    good = {r.sec_number + r.filing_date.isoformat(): r for r in normalize.accepted(rows).collect()}
    assert sorted(good) == ["801-12022-01-03", "801-12022-02-01", "801-22022-01-03", "801-32022-03-01", "801-42022-03-01"]
    first = good["801-12022-01-03"]
    assert (first.crd_number, first.firm_name, first.raum, first.account_count) == ("007", "Café Capital", Decimal("1000.50"), 12)
    assert (first.client_count, first.disciplinary_disclosures, first.umbrella_registration) == (7, 1, True)
    second = good["801-22022-01-03"]
    assert (second.raum, second.account_count, second.client_count, second.umbrella_registration) == (None, None, 2, False)
    piped = good["801-12022-02-01"]
    assert (piped.firm_name, piped.disciplinary_disclosures, piped.client_count, piped.account_count) == ("Café Capital", 3, 0, None)
    assert good["801-32022-03-01"].firm_name == "Gamma, LLC"
    assert (good["801-42022-03-01"].raum, good["801-42022-03-01"].account_count) == (Decimal("7.00"), None)
    reasons = [r.reject_reason for r in normalize.rejected(rows).collect()]
    assert sorted(reasons) == sorted([normalize.MISSING_DATE, normalize.MISSING_KEY, normalize.TOO_MANY_FIELDS])


def test_exempt_files_on_request_and_date_column(spark, folder):
    assert normalize.accepted(csv_files.read_filing_csv(spark, folder, include_exempt=True)).where("firm_name = 'Exempt'").count() == 1
    by_column = normalize.accepted(csv_files.read_filing_csv(spark, folder, dates="column")).collect()
    assert [(r.sec_number, r.filing_date) for r in by_column] == [("801-1", date(2022, 2, 1))]


def test_load_report(spark, folder):
    report = normalize.load_report(csv_files.read_filing_csv(spark, folder))
    by_file = {r.source_file.rsplit("/", 1)[-1]: (r.rows_loaded, r.rows_rejected, r.success) for r in report.collect()}
    assert by_file["ia-030122-2.csv"] == (2, 1, True)
    assert by_file["iaX.csv"] == (0, 1, False)
    assert normalize.failed_files(report).first().message == "No valid records"
    totals = normalize.load_totals(report).first()
    assert (totals.files, totals.files_failed, totals.rows_loaded, totals.rows_rejected) == (4, 1, 5, 3)


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "ia01032022.csv").write_text(HEADER + '\n801-1,7,"Two\nLines",5,1,1,1,Y,N\n801-2,8,One,5,1,1,1,Y,N\n')
    rows = normalize.accepted(csv_files.read_filing_csv(spark, str(tmp_path))).collect()
    assert sorted((r.sec_number, r.firm_name) for r in rows) == [("801-1", "Two\nLines"), ("801-2", "One")]


def test_every_file_is_accounted_for(spark, tmp_path):
    good = HEADER + "\n801-1,7,Alpha,5,1,1,1,Y,N\n"
    (tmp_path / "ia01032022.csv").write_text(good)
    (tmp_path / "ia02032022.csv").write_text("Adviser data\n" + good)
    (tmp_path / "ia03032022.csv").write_text("a,b\n1,2\n")
    (tmp_path / "ia04032022.csv").write_text("")
    rows = csv_files.read_filing_csv(spark, str(tmp_path))
    report = {r.source_file.rsplit("/", 1)[-1]: tuple(r)[1:] for r in normalize.load_report(rows).collect()}
    assert report == {
        "ia01032022.csv": (1, 0, True, "Success"),
        "ia02032022.csv": (0, 0, False, normalize.LATE_HEADER),
        "ia03032022.csv": (0, 0, False, normalize.NO_HEADER),
        "ia04032022.csv": (0, 0, False, normalize.EMPTY_FILE),
    }
    assert normalize.failed_files(normalize.load_report(rows)).count() == 3
    bad = [str(tmp_path / "ia03032022.csv")]
    assert normalize.accepted(csv_files.read_filing_csv(spark, bad)).count() == 0


def test_long_fields_and_broken_archives(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({"ia01032022.csv": HEADER + f'\n801-1,7,"{"x" * 200_000}",5,1,1,1,Y,N\n', "ia0103.xls": "x"}))
    (tmp_path / "b.zip").write_bytes(zipped({"ia01032022.csv": HEADER + "\n801-2,7,Beta,5,1,1,1,Y,N\n"}))
    (tmp_path / "c.zip").write_bytes(b"no archive")
    rows = archives.read_filing_archives(spark, str(tmp_path))
    report = {r.source_file: (r.rows_loaded, r.message) for r in normalize.load_report(rows).collect()}
    assert report == {
        "a.zip!/ia01032022.csv": (1, "Success"),
        "b.zip!/ia01032022.csv": (1, "Success"),
        "a.zip!/ia0103.xls": (0, normalize.UNSUPPORTED),
        "c.zip": (0, normalize.BROKEN_ARCHIVE),
    }


def test_layouts_by_header_and_encoding(spark, folder):
    layouts = csv_files.find_layouts(spark, folder)
    assert {(layout.separator, layout.encoding): len(paths) for layout, paths in layouts.items()} == {
        (",", "ISO-8859-1"): 1, ("|", "UTF-8"): 1, (",", "UTF-8"): 2,
    }
    known = csv_files.read_filing_csv(spark, folder, layouts=layouts)
    assert known.count() == csv_files.read_filing_csv(spark, folder).count()


def test_file_listing_and_manifest(spark, folder):
    files = csv_files.list_files(spark, folder)
    assert {r.kind: r.files for r in archives.file_types(files).collect()} == {"csv": 6, "other": 1}  # Spark lists no dot files
    seen = files.where("path LIKE '%.csv'")
    assert csv_files.new_files(files, seen).count() == 1


def test_fetch_is_due_after_the_interval(spark):
    schema = "run_type string, status string, completed_at timestamp"
    log = spark.createDataFrame([("fetch", "completed", datetime(2024, 1, 1)), ("load", "completed", datetime(2024, 1, 3))], schema)
    now = F.lit("2024-01-01 23:00:00").cast("timestamp")
    assert not csv_files.fetch_due(log, now).first().due
    assert csv_files.fetch_due(log, now, hours=23).first().due
    assert csv_files.fetch_due(log.limit(0), now).first().due


@pytest.mark.parametrize("variant, expected", [("flag_or_counts", 5), ("counts", 10)])
def test_disclosure_variants(spark, variant, expected):
    names = ["Count 11A", "Count 11H(2)", "11 Count other", "Count of 12"]
    df = spark.createDataFrame([("2", "3", "10", "99")], names)
    fields = df.select(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"`{n}`") for n in names])).alias("m"))
    assert df.select(normalize.disclosures(normalize.NamedColumns.of(df), variant)).first()[0] == expected
    assert fields.select(normalize.disclosures(normalize.MapColumn("m"), variant)).first()[0] == expected


def test_untidy_values(spark):
    texts = [" 12 ", "12.0", "1,234", "1e3", "", None, "abc", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(normalize.whole(F.col("t"))).collect()] == [12, 12, None, 1000, None, None, None, None]
    dates = spark.createDataFrame([(t,) for t in ["01/02/2020", "2020-01-02", "43832", "soon", None]], "t string")
    assert [r[0] for r in dates.select(normalize.any_date(F.col("t"))).collect()] == [date(2020, 1, 2)] * 3 + [None] * 2


@pytest.mark.parametrize(
    "name, day, year",
    [
        ("ia07012025.csv", date(2025, 7, 1), None),
        ("/x/ia010220.xlsx", date(2020, 1, 2), None),
        ("ia-050324.zip", date(2024, 5, 3), 2024),
        ("ia020119-2.zip", date(2019, 2, 1), 2019),
        ("ia020119_2.zip", date(2019, 2, 1), 2019),
        ("ia07012025.zip", date(2025, 7, 1), 2025),
        ("ia13402020.csv", None, None),
        ("adv.zip", None, None),
    ],
)
def test_dates_in_names(spark, name, day, year):
    row = spark.createDataFrame([(name,)], "n string").select(file_name_date(F.col("n")), archive_year(F.col("n"))).first()
    assert tuple(row) == (day, year)


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def test_archives(spark, tmp_path):
    (tmp_path / "two.zip").write_bytes(
        zipped({"a/ia01032022.csv": HEADER + "\n801-1,7,Alpha,1,1,1,1,Y,N\n801-2,8,Long,1,1,1,1,Y,N,x\n", "b.XLSX": "x", "n.txt": "n", "__MACOSX/._b": ""})
    )
    (tmp_path / "one.zip").write_bytes(zipped({"ia020122.csv": (HEADER + "\n801-3,9,Caf\xe9,1\n").encode("latin-1")}))
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    found = archives.read_binary(spark, str(tmp_path), "*.zip")
    census = {r.archive.rsplit("/", 1)[-1]: r for r in archives.archive_census(found).collect()}
    assert (census["two.zip"].files, census["two.zip"].workbooks, census["two.zip"].csv_files) == (3, 1, 1)
    assert census["bad.zip"].files == 0 and "zip" in census["bad.zip"].error
    assert archives.multi_file_archives(archives.archive_census(found)).count() == 1
    entries = archives.zip_entries(found)
    assert {r.member for r in entries.collect()} == {"ia01032022.csv", "b.XLSX", "ia020122.csv", None}
    typed = archives.read_filing_archives(spark, str(tmp_path))
    assert typed.where("reject_reason IS NOT NULL").count() == 3  # the long row, the unreadable workbook and archive
    good = {r.sec_number: r for r in normalize.accepted(typed).collect()}
    assert set(good) == {"801-1", "801-3"}
    assert (good["801-3"].firm_name, good["801-3"].filing_date, good["801-3"].client_count) == ("Café", date(2022, 2, 1), 0)


def test_workbooks(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    names = HEADER.split(",") + ["SEC Status Effective Date"]
    shared = "".join(f"<si><t>{n}</t></si>" for n in names)
    head = "".join(f'<c r="{chr(65 + i)}1" t="s"><v>{i}</v></c>' for i in range(len(names)))
    body = '<c r="A2" t="inlineStr"><is><r><t>801</t></r><r><t>-1</t></r></is></c><c r="D2"><v>1234.5</v></c><c r="H2" t="str"><v>Y</v></c><c r="J2"><v>43832</v></c>'
    book = {
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Type="{rel}/worksheet" Target="/xl/worksheets/first.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}>{shared}</sst>",
        "xl/worksheets/first.xml": f'<worksheet {main}><sheetData><row r="1">{head}</row><row r="2">{body}</row></sheetData></worksheet>',
        "xl/worksheets/second.xml": f"<worksheet {main}><sheetData/></worksheet>",
    }
    (tmp_path / "ia010220.xlsx").write_bytes(zipped(book))
    (tmp_path / "broken.xlsx").write_bytes(b"no workbook")
    found = archives.read_binary(spark, str(tmp_path), "*.xlsx")
    rows = archives.workbook_rows(found)
    typed = archives.read_filing_workbooks(spark, str(tmp_path))
    (row,) = normalize.accepted(typed).collect()
    assert (row.sec_number, row.filing_date, row.raum) == ("801-1", date(2020, 1, 2), Decimal("1234.50"))
    assert (row.disciplinary_disclosures, row.sec_status_date) == (1, date(2020, 1, 2))
    assert rows.where("error IS NOT NULL").count() == 1
    sheets = {r.path.rsplit("/", 1)[-1]: r.sheets for r in archives.workbook_census(found).collect()}
    assert sheets == {"ia010220.xlsx": 2, "broken.xlsx": 0}


def test_links(spark):
    html = (
        '<a class="x" href="/files/ia010120.zip"><b>January</b> 2020</a><a href="ia010119.zip">Old</a>'
        "<A HREF='https://other.org/ia-050324.ZIP'>upper</A><a href='/f/ia020120.zip'>Exempt Reporting Adviser</a><a name='n'>none</a>"
    )
    pages = spark.createDataFrame([(1, "https://host.org/list", html)], "page_id long, url string, html string")
    assert [(r.position, r.label, r.link) for r in links.page_links(pages).orderBy("position").collect()] == [
        (0, "January 2020", "https://host.org/files/ia010120.zip"),
        (1, "Old", "https://host.org/ia010119.zip"),
        (2, "upper", "https://other.org/ia-050324.ZIP"),
        (3, "Exempt Reporting Adviser", "https://host.org/f/ia020120.zip"),
    ]
    assert [r.href for r in links.archive_links(pages).collect()] == ["/files/ia010120.zip"]


def test_links_that_are_easy_to_misread(spark):
    html = (
        '<a data-href="/wrong" href=/plain?a=1&amp;b=2 title="x > y">R&amp;D</a><!-- <a href="/hidden">no</a> -->'
        "<script>var s = '<a href=\"/script\">no</a>';</script><a data-href='/only-data'>no</a><a href='/open'>one<a href=\"/two\">two</a>"
    )
    pages = spark.createDataFrame([(1, "https://host.org/list", html)], "page_id long, url string, html string")
    assert [(r.position, r.href, r.label) for r in links.page_links(pages).orderBy("position").collect()] == [
        (0, "/plain?a=1&b=2", "R&D"), (1, "/open", "one"), (2, "/two", "two"),
    ]


def test_schema_tools(spark):
    df = conform(spark.createDataFrame([("801-1", "2020-01-02", "5")], "sec_number string, filing_date string, raum string"), FILING)
    assert df.schema["raum"].dataType.simpleString() == "decimal(20,2)" and df.first().filing_date == date(2020, 1, 2)
    described = describe_columns(df, containing="COUNT").collect()
    assert [(r.column_name, r.data_type) for r in described] == [
        ("client_count", "int"), ("account_count", "int"), ("main_office_country", "string"),
    ]


def damaged_zip():
    """A good member, one without rows, an empty one, one with lines above the header, a damaged and an encrypted one."""
    buffer = io.BytesIO()
    row = HEADER + "\n801-1,7,Alpha,5,1,1,1,Y,N\n"
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in {"01": row, "02": HEADER, "03": "", "04": "Title\n" + row, "05": row, "06": row, "07": row * 50}.items():
            archive.writestr(f"ia{name}032022.csv", text)
        archive.filelist[4].CRC ^= 1
        archive.filelist[5].flag_bits |= 1
        at = archive.filelist[6].header_offset + 60
    content = bytearray(buffer.getvalue())
    content[at : at + 20] = b"\xff" * 20  # not a deflate stream any more
    return bytes(content)


def test_one_damaged_member_costs_only_itself(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(damaged_zip())
    (tmp_path / "b.zip").write_bytes(zipped({"ia01032022.csv": HEADER + "\n801-2,7,Beta,5,1,1,1,Y,N\n"}))
    (tmp_path / "c.zip").write_bytes(zipped({"notes.txt": "x"}))
    (tmp_path / "d.zip").write_bytes(b"PK no archive")
    rows = archives.read_filing_archives(spark, str(tmp_path))
    report = {r.source_file: (r.rows_loaded, r.rows_rejected, r.message) for r in normalize.load_report(rows).collect()}
    assert report == {
        "a.zip!/ia01032022.csv": (1, 0, "Success"),
        "a.zip!/ia02032022.csv": (0, 0, normalize.NO_ROWS),
        "a.zip!/ia03032022.csv": (0, 0, normalize.EMPTY_FILE),
        "a.zip!/ia04032022.csv": (0, 0, normalize.LATE_HEADER),
        "a.zip!/ia05032022.csv": (0, 0, normalize.BROKEN_MEMBER),
        "a.zip!/ia06032022.csv": (0, 0, normalize.ENCRYPTED_MEMBER),
        "a.zip!/ia07032022.csv": (0, 0, normalize.BROKEN_MEMBER),
        "b.zip!/ia01032022.csv": (1, 0, "Success"),
        "c.zip": (0, 0, normalize.NO_MEMBER),
        "d.zip": (0, 0, normalize.BROKEN_ARCHIVE),
    }
    listed = spark.createDataFrame([("a.zip!/ia01032022.csv",), ("gone.csv",), ("gone.csv",)], "source_file string")
    ledger = {r.source_file: (r.rows_loaded, r.message) for r in normalize.load_ledger(listed, rows).collect()}
    assert ledger == {"a.zip!/ia01032022.csv": (1, "Success"), "gone.csv": (0, normalize.NO_ROWS)}


def test_records_as_a_csv_reader_sees_them(spark, tmp_path):
    """Quotes, line breaks and separators in all places, against Python's reader."""
    import csv
    import random

    rng = random.Random(5)
    for separator, name in ((",", "ia01032022.csv"), ("|", "ia02032022.csv")):
        parts = ["x", "7", " ", '"', ",", "|", "\n", "\r\n", "é", "''", "a,b", '""']
        lines = [[f"801-{i}", "1", "".join(rng.choices(parts, k=rng.randint(0, 6))), "5", "1", "1", "1", "Y", "N"] for i in range(300)]
        with open(tmp_path / name, "w", newline="") as file:
            writer = csv.writer(file, delimiter=separator)
            writer.writerows([HEADER.split(","), *lines])
        with open(tmp_path / name, newline="") as file:
            want = {r[0]: r[2] or None for r in list(csv.reader(file, delimiter=separator))[1:]}
        rows = normalize.accepted(csv_files.read_filing_csv(spark, str(tmp_path / name)))
        assert {r.sec_number: r.firm_name for r in rows.collect()} == want
    odd = HEADER + '\r801-1,1,5" disk,5,1,1,1,Y,N\r\r801-2,1,"open,5,1,1,1,Y,N\r801-3,1,"a" b,5,1,1,1,Y,N'
    (tmp_path / "ia03032022.csv").write_text(odd)
    rows = normalize.accepted(csv_files.read_filing_csv(spark, str(tmp_path / "ia03032022.csv")))
    assert {r.sec_number: r.firm_name for r in rows.collect()} == {"801-1": '5" disk', "801-2": '"open', "801-3": '"a" b'}


def test_large_files_are_read_by_layout_with_the_same_rows(spark, folder):
    whole, split = (csv_files.read_filing_csv(spark, folder, whole_file_bytes=size) for size in (1 << 20, 10))
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))


class Captured:
    """Stands for a frame and gives the function that would run in its tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):  # noqa: N802
        return function


def test_archives_are_opened_in_small_batches():
    import pyarrow as pa

    content = zipped({"ia01032022.csv": "a", "ia02032022.csv": "b"})
    batch = pa.RecordBatch.from_pydict({"path": [f"{i}.zip" for i in range(1500)], "content": [content] * 1500})
    sizes = [b.num_rows for b in archives.zip_entries(Captured())(iter([batch]))]
    assert sum(sizes) == 3000 and max(sizes) <= 1000


def test_derived_archives_hold_what_a_csv_writer_writes(spark):
    import csv

    from filingscope.sources import derive

    cells = ['a "b", c', "x\ny", "é & <z>", "", " plain "]
    names = ["Organization CRD#", "n,1", "n2", "n3", "n4", "n5"]
    row = spark.createDataFrame([("7", *cells, date(2022, 1, 3))], [*names, "filed"])
    (packed,) = derive.archives(row).collect()
    text = io.StringIO()
    csv.writer(text).writerows([names, ["7", *cells]])
    with zipfile.ZipFile(io.BytesIO(packed.content)) as archive:
        assert archive.testzip() is None
        assert archive.namelist() == ["form/ia01032022.csv", "readme.txt", "__MACOSX/._readme.txt"]
        assert archive.read("form/ia01032022.csv").decode() == text.getvalue()
    (parsed,) = archives.workbook_rows(derive.workbooks(row)).collect()
    assert parsed.fields == {n: c for n, c in zip(names, ["7", *cells]) if c}


def test_one_pass_tells_the_outcomes_of_rows_and_problems(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(damaged_zip())
    (tmp_path / "c.zip").write_bytes(zipped({"notes.txt": "x", "old.xls": "x"}))
    (tmp_path / "d.zip").write_bytes(b"PK no archive")
    (tmp_path / "e.zip").write_bytes(zipped({"notes.txt": "x"}))
    entries = archives.zip_entries(archives.read_binary(spark, str(tmp_path), "*.zip"))
    two = archives.member_rows(entries).unionByName(archives.member_problems(entries))
    one = archives.member_outcomes(entries)
    assert sorted(normalize.load_report(one).collect()) == sorted(normalize.load_report(two).collect())
    good = [sorted(map(str, normalize.accepted(rows).collect())) for rows in (one, two)]
    assert good[0] == good[1] and len(good[0]) == 1


def test_the_report_opens_each_archive_once_for_rows_and_problems(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["load_report_files"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapIn") == 4  # packed and opened, for the outcomes and for the listing


def test_small_sheets_are_parsed_at_once_and_large_ones_row_by_row(monkeypatch):
    from xml.etree import ElementTree

    import pyarrow as pa

    def book(rows, end="</sheetData></worksheet>"):
        line = '<row><c t="inlineStr"><is><t>{}</t></is></c></row>'
        sheet = "<worksheet xmlns='urn:m'><sheetData>" + "".join(line.format(f"v{i}") for i in range(rows)) + end
        return zipped(
            {
                "xl/workbook.xml": '<workbook xmlns="urn:m" xmlns:r="urn:r"><sheets><sheet r:id="r1"/></sheets></workbook>',
                "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>',
                "xl/worksheets/s.xml": sheet,
            }
        )

    def parsed(content):
        batch = pa.RecordBatch.from_pydict({"path": ["b.xlsx"], "content": [content]})
        return [r for b in archives.workbook_rows(Captured())(iter([batch])) for r in b.to_pylist()]

    large, torn = parsed(book(90_000)), parsed(book(40, "<row>"))
    assert [r["fields"] for r in large] == [[("v0", f"v{i}")] for i in range(1, 90_000)]
    assert len(torn) == 40 and torn[-1]["error"].startswith("unreadable workbook") and torn[-2]["fields"] == [("v0", "v39")]
    monkeypatch.setattr(ElementTree, "iterparse", None)
    assert len(parsed(book(100))) == 99
