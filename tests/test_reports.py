import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingscope.functions.text import money_grouped, money_label, money_short
from filingscope.plans import firms, reports
from filingscope.plans.scoring import register_functions, score_filings

D1, D2 = date(2020, 1, 2), date(2020, 2, 3)
SCORE = "sec_number string, filing_date date, score int, risk_category string, factors struct<new_disc:int>"
FILED = "sec_number string, filing_date date, firm_name string, raum decimal(20,2), client_count int, account_count int"


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(
        [
            ("a", D1, 85, "Critical", (1,)), ("a", D2, 10, "Low", (0,)), ("b", D2, 65, "High", (1,)),
            ("c", D2, 35, "Medium", (0,)), ("d", D2, 5, "Low", (0,)), ("e", D1, 62, "High", (0,)),
        ],
        SCORE,
    )


@pytest.fixture
def filed(spark):
    return spark.createDataFrame(
        [
            ("a", D1, "Alpha Old", Decimal(10), 1, 1), ("a", D2, "Alpha", Decimal(20), 2, 2),
            ("b", D2, "Beta", Decimal(30), 3, 3), ("c", D2, None, None, None, None), ("e", D1, "Echo", Decimal(5), 1, 1),
        ],
        FILED,
    )


def test_statistics_on_the_newest_date_in_severity_order(scores):
    rows = reports.risk_statistics_latest(scores).collect()
    assert [(r.risk_category, r.firm_count, float(r.percentage), float(r.avg_score)) for r in rows] == [
        ("High", 1, 25.0, 65.0), ("Medium", 1, 25.0, 35.0), ("Low", 2, 50.0, 7.5),
    ]


def test_statistics_over_all_dates_count_firms_per_category(scores):
    rows = reports.risk_statistics_all_dates(scores).collect()
    assert [(r.risk_category, r.firm_count, float(r.percentage)) for r in rows] == [
        ("Critical", 1, 16.67), ("High", 2, 33.33), ("Medium", 1, 16.67), ("Low", 2, 33.33),
    ]
    summary = reports.dashboard_summary(scores, scores, days=0).collect()
    assert [(r.firm_count, float(r.percentage)) for r in summary] == [(1, 16.67), (2, 33.33), (1, 16.67), (2, 33.33)]
    assert {(r.total_firms, r.recent_filings) for r in summary} == {(5, 4)}


def test_cards_and_distribution_show_absent_categories(scores):
    low = scores.where("risk_category = 'Low'")
    assert reports.category_cards(low).first().asDict() == {
        "total_firms": 2, "critical_firms": 0, "high_firms": 0, "medium_firms": 0, "low_firms": 2,
    }
    assert [(r.risk_category, r["count"], float(r.percentage)) for r in reports.category_distribution(low).collect()] == [
        ("Low", 2, 100.0), ("Medium", 0, 0.0), ("High", 0, 0.0), ("Critical", 0, 0.0),
    ]


def test_firm_lists(scores, filed):
    rows = firms.firms_by_category(scores, filed, limit=4).collect()
    assert [(r.sec_number, r.score, r.firm_name) for r in rows] == [
        ("a", 85, "Alpha Old"), ("b", 65, "Beta"), ("e", 62, "Echo"), ("c", 35, "Unknown"),
    ]
    assert [r.firm_name for r in firms.top_risky_firms(scores, filed).collect()] == ["Alpha Old", "Beta", "Echo"]
    profile = firms.firms_latest_profile(scores, filed, "Critical").first()
    assert (profile.firm_name, profile.latest_filing_date, profile.filing_date) == ("Alpha", D2, D1)


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, ["a", "b", "e", "c", "a", "d"]),
        ({"search": "ALPH"}, ["a", "a"]),
        ({"search": "B"}, ["b"]),
        ({"band": "60-79 (High)"}, ["b", "e"]),
        ({"band": "80+ (Critical)"}, ["a"]),
        ({"band": "Below 60 (Medium/Low)", "category": "Low"}, ["a", "d"]),
        ({"new_disclosures": True}, ["a", "b"]),
        ({"new_disclosures": True, "limit": 1}, ["a"]),
    ],
)
def test_explorer_filters_before_the_cut(scores, filed, options, expected):
    assert [r.sec_number for r in firms.explore(scores, filed, **options).collect()] == expected


def test_pages(spark):
    filings = spark.createDataFrame(
        [(i, D1, Decimal(100 - i), 1, 1) for i in range(1, 8)] + [(1, date(2019, 1, 1), Decimal(1), 1, 1)],
        "crd long, filing_date date, raum decimal(20,2), total_clients int, total_accounts int",
    )
    names = list(firms.MODEL_COLUMNS)
    model = spark.createDataFrame([(i, 0.1 * i, "Low" if i < 4 else "High", *[0.0] * 6) for i in range(1, 7)], ["crd", *names])
    found = firms.search_firms(filings, model)
    page = firms.firm_page(found, page=2, page_size=3).collect()
    assert [r.crd for r in page] == [4, 5, 6] and {(r.total, r.total_pages) for r in page} == {(7, 3)}
    by_score = firms.firm_page(found, "overall_risk_score", descending=True, page_size=2).collect()
    assert [r.crd for r in by_score] == [7, 6]  # no score sorts first, as descending NULLs do
    assert [r.crd for r in firms.firm_page(found, "no such column", page_size=2).collect()] == [1, 2]
    narrowed = firms.search_firms(filings, model, category="High", min_aum=95)
    assert sorted(r.crd for r in narrowed.collect()) == [4, 5]
    assert sorted(r.crd for r in firms.search_firms(filings, model, search="7").collect()) == [7]
    named = filings.withColumn("firm_name", F.concat(F.lit("Firm "), F.col("crd").cast("string")))
    assert {r.firm_name for r in firms.search_firms(named, model, search="m 3").collect()} == {"Firm 3"}
    assert firms.firm_details(filings, model, crd=1).collect()[0].aum == Decimal(99)


def test_trends_and_overview(spark, scores):
    filings = spark.createDataFrame(
        [(1, D1, Decimal(5), "Y"), (1, D2, Decimal(7), "N"), (2, D2, None, "Y"), (3, D2, Decimal(1), "N")],
        "crd long, filing_date date, raum decimal(20,2), disclosure_flag string",
    )
    model = spark.createDataFrame([(1, "High"), (2, "Low")], "crd long, risk_category string")
    rows = reports.risk_trends(filings, model, days=60).collect()
    assert [(r.filing_date, r.low, r.medium, r.high, r.critical, r.unscored) for r in rows] == [
        (D1, 0, 0, 1, 0, 0), (D2, 1, 0, 1, 0, 1),
    ]
    stats = {r.metric: r.value for r in reports.overview_stats(filings, scores, model).collect()}
    assert stats == {
        "total_firms": 3, "firms_with_recent_activity": 3, "new_disclosures": 1, "total_aum": 8.0,
        "high_severity_alerts": 1, "risk_distribution.High": 1, "risk_distribution.Medium": 1, "risk_distribution.Low": 2,
    }


@pytest.mark.parametrize(
    "amount, label, short, grouped",
    [
        ("1500000000000", "$1.5T", "$1500000.0M", "$1,500,000,000,000"),
        ("2340000000", "$2.3B", "$2340.0M", "$2,340,000,000"),
        ("32761550000", "$32.8B", "$32761.6M", "$32,761,550,000"),
        ("1000000", "$1.0M", "$1.0M", "$1,000,000"),
        ("999999", "$999,999", "$1000K", "$999,999"),
        ("0", "$0", "$0K", "N/A"),
        (None, "N/A", "N/A", "N/A"),
    ],
)
def test_money(spark, amount, label, short, grouped):
    df = spark.createDataFrame([(None if amount is None else Decimal(amount),)], "a decimal(20,2)")
    assert tuple(df.select(money_label("a"), money_short("a"), money_grouped("a")).first()) == (label, short, grouped)


def test_disclosure_lists(scores):
    rows = {(r.sec_number, r.filing_date): r for r in reports.disclosure_lists(scores).collect()}
    assert (rows["a", D1].disclosures, rows["a", D1].has_high_severity, rows["a", D1].first_severity) == (1, True, "Critical")
    assert (rows["e", D1].disclosures, rows["e", D1].has_high_severity, rows["e", D1].first_severity) == (0, False, None)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (3, "y")], "n int, t string")
    rows = {r.column_name: r for r in reports.column_profile(df, ["n", "t"]).collect()}
    assert (rows["n"].non_null, rows["n"].distinct_values, rows["n"].data_type) == (3, 2, "int")
    assert (rows["t"].non_null, rows["t"].min_text, rows["t"].max_text) == (2, "x", "y")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("sort_by", ["crd", "aum", "risk_category", "unknown"])
def test_pages_by_key_are_the_pages_by_number(spark, sort_by, descending):
    rng = random.Random(4)
    rows = [
        (i // 2, rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, "High", "Low"]), date(2020, 1, 1 + i % 2))
        for i in range(50)
    ]
    found = spark.createDataFrame(rows, "crd long, aum double, risk_category string, last_filing_date date").repartition(3)
    column = sort_by if sort_by != "unknown" else "crd"
    after, walked = None, []
    for number in range(1, 9):
        page = firms.firm_page_after(found, after, sort_by, descending, page_size=7).collect()
        numbered = firms.firm_page(found, sort_by, descending, number, page_size=7).drop("total", "total_pages")
        assert page == numbered.collect()
        walked += page
        after = (page[-1][column], page[-1].crd, page[-1].last_filing_date) if page else after
    assert len(walked) == 50


def test_functions_with_arguments(spark, history):
    filed = history(("801-1", "2020-01-01", 100), ("801-1", "2020-02-01", 50), ("801-2", "2020-02-01", 70, 10, 10, "A", 3))
    filed = filed.withColumn("firm_name", F.lit("Alpha"))
    register_functions(filed, score_filings(filed))
    every = spark.sql("SELECT * FROM risk_statistics_of(NULL)").collect()
    assert sum(r.firm_count for r in every) == 2
    one = spark.sql(f"SELECT * FROM risk_statistics_of('{every[0].risk_category}')").collect()
    assert [tuple(r) for r in one] == [tuple(every[0])]
    scores = spark.sql("SELECT score FROM firms_in_category(NULL, 0)").collect()
    highest = max(r.score for r in scores)
    assert len(scores) == 3
    found = spark.sql(f"SELECT * FROM firms_in_category(NULL, {highest})").collect()
    assert found and all(r.score == highest and r.firm_name == "Alpha" for r in found)


def test_column_ranges_are_ordered_by_type(spark):
    rows = [(9, "b", date(2020, 1, 2)), (10, "a", date(2019, 5, 1)), (None, "a", None), (100, None, None), (-3, "c", None)]
    df = spark.createDataFrame(rows, "n int, t string, d date").withColumn("none", F.lit(None).cast("double"))
    found = {r.column_name: r for r in reports.column_ranges(df, ["n", "t", "d", "none"], samples=3).collect()}
    assert (found["n"].min_value, found["n"].max_value, found["n"].sample_values) == ("-3", "100", ["-3", "9", "10"])
    assert (found["t"].min_value, found["t"].max_value, found["t"].sample_values) == ("a", "c", ["a", "b", "c"])
    assert found["d"].sample_values == ["2019-05-01", "2020-01-02"]
    assert (found["none"].min_value, found["none"].sample_values) == (None, None)
    empty = reports.column_ranges(df.limit(0), ["n", "t"]).collect()
    assert {(r.column_name, r.min_value, r.sample_values) for r in empty} == {("n", None, None), ("t", None, None)}


def test_column_profile_sorts_no_values(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, None, "é"), (None, None, "b"), (10, None, "")], "n int, e string, t string")
    profile = reports.column_profile(df, df.columns)
    assert {r.column_name: tuple(r)[1:] for r in profile.collect()} == {
        "n": (4, 3, 3, "1", "2", "int"),
        "e": (4, 0, 0, None, None, "string"),
        "t": (4, 4, 3, "", "é", "string"),
    }
    plan = profile._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate(key=[column_name" not in plan and "SortAggregate(key=[place" not in plan
