"""Raw text rows of the filing form -> typed filings.

A raw row is either a set of text columns named by the form's headers, or one ``map<string,string>`` column
from header to text. Headers drift between months; an absent one gives NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope import rules
from filingscope.functions.text import file_name_date
from filingscope.schemas import FILING

DATE_PATTERNS = ("MM/dd/yyyy", "yyyy-MM-dd", "MM/dd/yyyy hh:mm:ss a")
MISSING_KEY = "missing SEC number"
MISSING_DATE = "missing filing date"
TOO_MANY_FIELDS = "too many fields"
NO_HEADER = "no header line with the key column"
LATE_HEADER = "lines above the header"
EMPTY_FILE = "empty file"
BROKEN_ARCHIVE = "archive cannot be read"
BROKEN_MEMBER = "archive member cannot be read"
ENCRYPTED_MEMBER = "archive member is encrypted"
NO_MEMBER = "no data file in the archive"
UNSUPPORTED = "file type is not supported"
NO_ROWS = "No valid records"
WHOLE_FILE = (
    NO_HEADER, LATE_HEADER, EMPTY_FILE, NO_ROWS, BROKEN_ARCHIVE, BROKEN_MEMBER, ENCRYPTED_MEMBER, NO_MEMBER, UNSUPPORTED,
)


class NamedColumns:
    """Access to raw values held in one column per header."""

    def __init__(self, columns: Mapping[str, Column]):
        self.columns = columns

    @classmethod
    def of(cls, df: DataFrame) -> NamedColumns:
        return cls({name: F.col(f"`{name}`") for name in df.columns})

    def value(self, header: str) -> Column:
        return self.columns.get(header, F.lit(None)).cast("string")

    def has(self, header: str) -> Column:
        return F.lit(header in self.columns)

    def sum_where(self, wanted) -> Column:
        return _sum([c for name, c in self.columns.items() if wanted(name)])


class MapColumn:
    """Access to raw values held in one map column."""

    def __init__(self, fields: str):
        self.fields = F.col(fields)

    def value(self, header: str) -> Column:
        return F.try_element_at(self.fields, F.lit(header))

    def has(self, header: str) -> Column:
        return F.map_contains_key(self.fields, header)

    def sum_where(self, wanted) -> Column:
        chosen = F.map_values(F.map_filter(self.fields, lambda name, _: wanted(name)))
        return F.aggregate(chosen, F.lit(0), lambda total, text: total + F.coalesce(whole(text), F.lit(0)))


class PositionedColumns:
    """Access to raw values that were picked from a record's fields by the places of the wanted headers in the file's
    header line. What a record gives (see :meth:`records`) are the columns that are read here."""

    WANTED = tuple(
        dict.fromkeys(
            [*rules.HEADERS.values(), rules.FILING_DATE_HEADER, rules.DISCLOSURE_HEADER, *rules.CLIENT_HEADERS]
        )
    )

    #: What is summed over the headers that match, as SQL over a header ``n``.
    SUMMED = {
        "sections": "CONTAINS(n, 'Count') AND ("
        + " OR ".join(f"CONTAINS(n, '{s}')" for s in rules.DISCLOSURE_COUNT_SECTIONS)
        + ")",
        "eleven": "STARTSWITH(n, '11') AND CONTAINS(n, 'Count')",
    }

    @classmethod
    def positions(cls, names: str) -> Column:
        """A struct with the place of each wanted header (null: absent) and the places of the headers to be summed."""
        places = {
            f"h{i}": f"INT(NULLIF(ARRAY_POSITION({names}, '{header}'), 0)) - 1" for i, header in enumerate(cls.WANTED)
        }
        for name, wanted in cls.SUMMED.items():
            marked = f"TRANSFORM({names}, (n, i) -> IF({wanted}, i, NULL))"
            places[name] = f"FILTER({marked}, i -> i IS NOT NULL)"
        return F.expr(_struct(places))

    @classmethod
    def records(cls, at: str, fields: str) -> Column:
        """For each record its wanted values, the sums, the number of its fields and whether item 11 is in the header."""
        values = {f"h{i}": f"NULLIF(GET(f, {at}.h{i}), '')" for i in range(len(cls.WANTED))}
        number = "TRY_CAST(TRY_CAST(GET(f, i) AS DECIMAL(20,2)) AS INT)"
        for name in cls.SUMMED:
            values[name] = f"AGGREGATE({at}.{name}, 0, (t, i) -> t + COALESCE({number}, 0))"
        values["fields"] = "SIZE(f)"
        values["flagged"] = f"{at}.h{cls.WANTED.index(rules.DISCLOSURE_HEADER)} IS NOT NULL"
        return F.expr(f"TRANSFORM({fields}, f -> {_struct(values)})")

    def value(self, header: str) -> Column:
        return F.col(f"h{self.WANTED.index(header)}")

    def has(self, header: str) -> Column:
        if header != rules.DISCLOSURE_HEADER:
            raise ValueError(f"not kept: whether {header!r} is there")
        return F.col("flagged")

    def sum_where(self, wanted) -> Column:
        return F.coalesce("sections" if wanted is _is_section_count else "eleven", F.lit(0))


def _struct(parts: Mapping[str, str]) -> str:
    return f"NAMED_STRUCT({', '.join(f"'{name}', {sql}" for name, sql in parts.items())})"


def amount(text: Column) -> Column:
    return text.try_cast("decimal(20,2)")


def whole(text: Column) -> Column:
    """Whole number; ``12.0`` counts as 12, anything that is not a number as NULL."""
    return text.try_cast("decimal(20,2)").try_cast("int")


def cleaned(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def yes_no(text: Column) -> Column:
    return F.when(text.isin("Y", "Yes"), True).when(text.isin("N", "No"), False)


def any_date(text: Column) -> Column:
    """A date in one of the usual patterns, or a spreadsheet day number."""
    serial = F.when(text.rlike(r"^\d{5}(\.0)?$"), F.date_add(F.lit("1899-12-30").cast("date"), whole(text)))
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in DATE_PATTERNS], serial)


def _sum(columns: list[Column]) -> Column:
    return reduce(add, [F.coalesce(whole(c), F.lit(0)) for c in columns], F.lit(0))


def _text_contains(name: str | Column, part: str):
    return name.contains(part) if isinstance(name, Column) else part in name


def _is_section_count(name):
    sections = [_text_contains(name, s) for s in rules.DISCLOSURE_COUNT_SECTIONS]
    if isinstance(name, Column):
        return reduce(lambda a, b: a | b, sections) & _text_contains(name, "Count")
    return any(sections) and _text_contains(name, "Count")


def _is_eleven_count(name):
    if isinstance(name, Column):
        return name.startswith("11") & name.contains("Count")
    return name.startswith("11") and "Count" in name


def disclosures(raw: NamedColumns | MapColumn | PositionedColumns, variant: str = "flag_or_counts") -> Column:
    """Number of disciplinary disclosures.

    ``flag_or_counts``: the yes/no answer to item 11 as 1/0 if the form has it, else the sum of the counts of
    sections 11A-11H. ``counts``: the sum of all counts of item 11.
    """
    if variant == "counts":
        return raw.sum_where(_is_eleven_count)
    if variant != "flag_or_counts":
        raise ValueError(f"unknown disclosure variant {variant!r}")
    flag = F.when(raw.value(rules.DISCLOSURE_HEADER) == "Y", 1).otherwise(0)
    return F.when(raw.has(rules.DISCLOSURE_HEADER), flag).otherwise(raw.sum_where(_is_section_count))


def normalize(
    df: DataFrame,
    raw: NamedColumns | MapColumn | PositionedColumns | None = None,
    source_file: Column | None = None,
    dates: str = "file_name",
    disclosure_variant: str = "flag_or_counts",
    malformed: Column | None = None,
    problem: Column | None = None,
) -> DataFrame:
    """Typed filings plus ``source_file`` and ``reject_reason`` (NULL for a usable row).

    ``dates``: ``file_name`` takes the date of the monthly file, ``column`` the form's own filing date. ``problem`` is
    the reason for which a row stands for a whole file.
    """
    raw = NamedColumns.of(df) if raw is None else raw
    source = F.lit(None).cast("string") if source_file is None else source_file
    texts = {name: raw.value(header) for name, header in rules.HEADERS.items()}
    date = file_name_date(source) if dates == "file_name" else any_date(raw.value(rules.FILING_DATE_HEADER))
    values = {
        **texts,
        "sec_number": cleaned(texts["sec_number"]),
        "crd_number": cleaned(texts["crd_number"]),
        "sec_status_date": any_date(texts["sec_status_date"]),
        "filing_date": date,
        "raum": amount(texts["raum"]),
        "account_count": whole(texts["account_count"]),
        "client_count": reduce(
            add, [F.coalesce(whole(raw.value(h)), F.lit(0)) for h in rules.CLIENT_HEADERS], F.lit(0)
        ),
        "umbrella_registration": yes_no(texts["umbrella_registration"]),
        "disciplinary_disclosures": disclosures(raw, disclosure_variant),
    }
    bad = F.lit(False) if malformed is None else malformed
    typed = df.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in FILING],
        source.alias("source_file"),
        bad.alias("too_long"),
        (F.lit(None).cast("string") if problem is None else problem).alias("problem"),
    )
    reason = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("too_long"), TOO_MANY_FIELDS)
        .when(F.col("sec_number").isNull(), MISSING_KEY)
        .when(F.col("filing_date").isNull(), MISSING_DATE)
    )
    return typed.withColumn("reject_reason", reason).drop("too_long", "problem")


def whole_file_rejects(files: DataFrame) -> DataFrame:
    """One rejected row for each file (``source_file``, ``reason``) that cannot be read at all."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in FILING]
    return files.select(*empty, "source_file", F.col("reason").alias("reject_reason"))


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where("reject_reason IS NULL").drop("reject_reason")


def rejected(normalized: DataFrame) -> DataFrame:
    return normalized.where("reject_reason IS NOT NULL")


def load_report(normalized: DataFrame) -> DataFrame:
    """Per file: rows loaded and rejected, whether anything was loaded, and why not."""
    good = F.count_if(F.col("reject_reason").isNull())
    whole_file = F.col("reject_reason").isin(*WHOLE_FILE)
    return (
        normalized.groupBy("source_file")
        .agg(
            good.alias("rows_loaded"),
            F.count_if(F.col("reject_reason").isNotNull() & ~whole_file).alias("rows_rejected"),
            F.max(F.when(whole_file, F.col("reject_reason"))).alias("problem"),
        )
        .withColumn("success", F.col("rows_loaded") > 0)
        .withColumn("message", F.when(F.col("success"), "Success").otherwise(F.coalesce("problem", F.lit(NO_ROWS))))
        .drop("problem")
    )


def load_ledger(listed: DataFrame, normalized: DataFrame) -> DataFrame:
    """The load report with a line for every file that is ``listed`` (``source_file``), also for those of which no row
    came. The rows are counted before they meet the listing."""
    counted = load_report(normalized)
    return listed.select("source_file").distinct().join(counted, "source_file", "left").select(
        "source_file",
        F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
        F.coalesce("rows_rejected", F.lit(0)).cast("bigint").alias("rows_rejected"),
        F.coalesce("success", F.lit(False)).alias("success"),
        F.coalesce("message", F.lit(NO_ROWS)).alias("message"),
    )


def load_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("files"),
        F.count_if("success").alias("files_loaded"),
        F.count_if(~F.col("success")).alias("files_failed"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"),
    )


def failed_files(report: DataFrame, limit: int = 10) -> DataFrame:
    return report.where(~F.col("success")).orderBy("source_file").select("source_file", "message").limit(limit)
