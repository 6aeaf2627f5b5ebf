"""As-of and latest lookups against brute force on repeated dates."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from filingscope.operators.history import (
    asof_previous,
    dedupe_filings,
    duplicate_filings,
    latest_per_firm,
    latest_per_firm_ties,
    since,
)

SCHEMA = "sec_number string, filing_date date, filing_key long, v int"


def sample(n=200):
    random.seed(3)
    return [
        (f"f{random.randrange(6)}", date(2020, 1, 1) + timedelta(days=random.randrange(25)), key, random.randrange(1000))
        for key in range(n)
    ]


def test_asof_previous_matches_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r.filing_key: (r.prev_filing_date, r.prev_v) for r in asof_previous(df, df, ["filing_date", "v"]).collect()}
    assert len(found) == len(rows)
    for firm, day, key, _ in rows:
        earlier = [(d, k, v) for f, d, k, v in rows if f == firm and d < day]
        expected = (max(earlier)[0], max(earlier)[2]) if earlier else (None, None)
        assert found[key] == expected


def test_asof_against_another_table(spark):
    left = spark.createDataFrame([("f", date(2020, 1, 5), 1, 0), ("f", date(2020, 1, 1), 2, 0), ("g", date(2020, 1, 5), 3, 0)], SCHEMA)
    right = spark.createDataFrame([("f", date(2020, 1, 1), 7, 70), ("f", date(2020, 1, 4), 8, 80), ("f", date(2020, 1, 5), 9, 90)], SCHEMA)
    found = {r.filing_key: r.prev_v for r in asof_previous(left, right, ["v"]).collect()}
    assert found == {1: 80, 2: None, 3: None}


def test_latest(spark):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    latest = {r.sec_number: r.filing_key for r in latest_per_firm(df, "filing_key").collect()}
    ties = {(r.sec_number, r.filing_key) for r in latest_per_firm_ties(df).collect()}
    for firm in {r[0] for r in rows}:
        newest = max(r[1] for r in rows if r[0] == firm)
        keys = [r[2] for r in rows if r[0] == firm and r[1] == newest]
        assert latest[firm] == max(keys)
        assert {(firm, k) for k in keys} == {t for t in ties if t[0] == firm}


def test_since_counts_from_the_newest_date_or_a_given_one(spark):
    df = spark.createDataFrame([("f", date(2020, 1, d), d, 0) for d in (1, 11, 21, 31)], SCHEMA)
    assert sorted(r.filing_key for r in since(df, 20).collect()) == [11, 21, 31]
    assert sorted(r.filing_key for r in since(df, 5, F.lit("2020-01-26").cast("date")).collect()) == [21, 31]


def test_duplicates_are_what_dedupe_drops(spark):
    rows = sample(80) + [("f0", date(2020, 1, 1), 5, 1), ("f0", date(2020, 1, 1), 5, 1), ("f0", date(2020, 1, 1), 5, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    both = [tuple(r) for part in (dedupe_filings(df), duplicate_filings(df)) for r in part.collect()]
    assert sorted(both) == sorted(rows)
