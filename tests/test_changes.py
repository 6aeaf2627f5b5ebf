"""Hand-worked rows for the change model, tier limits and integer-division mode."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from filingscope.operators.changes import COMPARED, filing_changes, largest_drops, population_report
from filingscope.operators.history import dedupe_filings, duplicate_filings, with_previous
from filingscope.operators.points import risk_points, score_changes

M = 1_000_000


def scored(changes):
    return [r.asDict() for r in score_changes(changes).orderBy("sec_number", "filing_date").collect()]


def changed(changes):
    return [r.asDict() for r in changes.orderBy("sec_number", "filing_date").collect()]


@pytest.mark.parametrize("raum, score", [(60 * M, 5), (40 * M, 10), (50 * M, 5), (49_999_999.99, 10)])
def test_first_filing_scores_age_and_size_only(history, raum, score):
    rows = filing_changes(history(("f", "2020-01-02", raum)))
    (row,) = changed(rows)
    assert row["raum_drop_pct"] == row["client_drop_pct"] == row["acct_drop_pct"] == 0
    assert not (row["new_disc_flag"] or row["cco_changed"] or row["trend_down_flag"])
    (result,) = scored(rows)
    assert (result["score"], result["risk_category"]) == (score, "Low")


@pytest.mark.parametrize(
    "before, after, stored, points",
    [
        (100, 75, "25.00", 25 + 10),  # trend mean 8.33
        (100, 85, "15.00", 15),
        (1000, 750.6, "24.94", 0 + 10),  # between the tiers
        (100000, 75004, "25.00", 25 + 10),  # 24.996 rounds up into the tier
        (100000, 75005, "25.00", 25 + 10),  # 24.995, half up
        (100000, 75010, "24.99", 0 + 10),
        (1000, 751, "24.90", 15 + 10),
        (1000, 750.9, "24.91", 0 + 10),
        (10000, 8501, "14.99", 0),
        (100, 120, "0.00", 0),
    ],
)
def test_asset_drop_tiers(history, before, after, stored, points):
    rows = filing_changes(history(("f", "2015-01-02", before * M), ("f", "2020-01-02", after * M)))
    last = changed(rows)[-1]
    assert last["raum_drop_pct"] == Decimal(stored)
    assert scored(rows)[-1]["score"] == points


@pytest.mark.parametrize(
    "counts, mode, client_pct, account_pct",
    [
        ((100, 50, 10, 10), "fractional", 50, 0),
        ((100, 50, 10, 10), "as_written", 0, 0),
        ((100, 0, 10, 10), "fractional", 100, 0),
        ((100, 0, 10, 10), "as_written", 100, 0),
        ((10, 10, 10, 120), "fractional", 0, 0),
        ((10, 10, 10, 120), "as_written", 0, -1100),
        ((10, 10, 10, 0), "as_written", 0, 100),
        ((10, 10, 0, 5), "as_written", 0, 0),
        ((10, 10, 10, None), "as_written", 0, 0),
        ((0, 10, None, 5), "fractional", 0, 0),
    ],
)
def test_count_drops_in_both_modes(history, counts, mode, client_pct, account_pct):
    clients, clients_now, accounts, accounts_now = counts
    rows = filing_changes(
        history(
            ("f", "2015-01-02", 100 * M, clients, accounts), ("f", "2020-01-02", 100 * M, clients_now, accounts_now)
        ),
        mode,
    )
    last = changed(rows)[-1]
    assert (last["client_drop_pct"], last["acct_drop_pct"]) == (client_pct, account_pct)


def test_unknown_officers_are_no_change(history):
    rows = history(
        *[("f", f"202{i}-01-02", 60 * M, 1, 1, officer) for i, officer in enumerate(["A", None, "B", "C"])]
    )
    assert [r["cco_changed"] for r in changed(filing_changes(rows))] == [False, False, False, True]


def test_new_disclosures_and_unknown_ones(history):
    rows = history(
        *[("f", f"202{i}-01-02", 60 * M, 1, 1, "A", n) for i, n in enumerate([0, 1, None, 1, 1])]
    )
    assert [r["new_disc_flag"] for r in changed(filing_changes(rows))] == [False, True, False, False, False]
    draft = filing_changes(rows, require_previous=True, null_disclosures_as_zero=True)
    assert [r["new_disc_flag"] for r in changed(draft)] == [True, False, True, False]


def test_previous_filing_is_looked_up_before_the_asset_filter(history):
    rows = filing_changes(
        history(("f", "2020-01-02", 100 * M), ("f", "2020-02-03", 0), ("f", "2020-03-02", 80 * M), ("f", "2020-04-02", None))
    )
    kept = changed(rows)
    assert [r["filing_date"] for r in kept] == [date(2020, 1, 2), date(2020, 3, 2)]
    assert kept[1]["raum_drop_pct"] == 0


def test_trend_uses_unrounded_drops_of_kept_filings(history):
    # 21.00 exactly over three filings is a mean of 7; 20.9949 rounds to 20.99 and stays below
    exact = filing_changes(history(("f", "2020-01-02", 100 * M), ("f", "2020-02-03", 79 * M)))
    below = filing_changes(history(("f", "2020-01-02", 100 * M), ("f", "2020-02-03", 79.0051 * M)))
    assert changed(exact)[-1]["trend_down_flag"] and not changed(below)[-1]["trend_down_flag"]


def test_age_counts_calendar_years_since_the_first_kept_filing(history):
    rows = history(("f", "2019-12-31", 0), ("f", "2020-12-31", 60 * M), ("f", "2021-01-01", 60 * M), ("f", "2023-01-01", 60 * M))
    assert [r["adviser_age_years"] for r in changed(filing_changes(rows))] == [0, 1, 3]


def test_owner_moves_input(spark, history):
    moves = spark.createDataFrame([("f", date(2020, 1, 2), 2)], "sec_number string, filing_date date, owner_moves_12m int")
    rows = filing_changes(history(("f", "2020-01-02", 60 * M), ("g", "2020-01-02", 60 * M)), owner_moves=moves)
    assert [r["score"] for r in scored(rows)] == [15, 5]


@pytest.mark.parametrize("score, category", [(29, "Low"), (30, "Medium"), (59, "Medium"), (60, "High"), (79, "High"), (80, "Critical")])
def test_category_limits(spark, score, category):
    from filingscope.functions.metrics import category as categorize
    from filingscope.rules import CHANGE_CUTOFFS

    df = spark.createDataFrame([(score,)], "score int")
    assert df.select(categorize("score", CHANGE_CUTOFFS)).first()[0] == category


def test_score_is_the_sum_of_its_points_and_bounded(spark, history):
    rows = filing_changes(
        history(
            *[("f", f"20{10 + i}-01-02", (100 - 13 * i) * M, 40 - 9 * i, 60 - 16 * i, "AB"[i % 2], i) for i in range(4)]
        )
    )
    points = risk_points(rows).collect()
    by_key = {r.filing_date: r.score for r in score_changes(rows).collect()}
    for row in points:
        parts = [v for k, v in row.asDict().items() if k not in ("sec_number", "filing_date", "score")]
        assert sum(parts) == row.score == by_key[row.filing_date]
        assert 0 <= row.score <= 130


def test_dedupe_keeps_the_highest_and_reports_the_rest(spark):
    rows = spark.createDataFrame(
        [("f", date(2020, 1, 2), 1, "a"), ("f", date(2020, 1, 2), 3, "b"), ("f", date(2020, 1, 2), 2, "c"), ("g", date(2020, 1, 2), 9, "d")],
        "sec_number string, filing_date date, filing_key long, v string",
    )
    assert {r.v for r in dedupe_filings(rows).collect()} == {"b", "d"}
    assert {r.v for r in duplicate_filings(rows).collect()} == {"a", "c"}


def test_order_and_partitioning_of_the_input_do_not_matter(history):
    rows = [("f%d" % (i % 3), f"20{10 + i // 3}-0{1 + i % 9}-02", (500 - 37 * i % 290) * M, i, 2 * i, "AB"[i % 2], i % 4) for i in range(30)]
    one = score_changes(filing_changes(history(*rows).coalesce(1)))
    other = score_changes(filing_changes(history(*reversed(rows)).repartition(7)))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_lag_equals_the_range_frame_form(history):
    rows = history(*[("f", f"20{10 + i}-01-02", i * M) for i in range(6)])
    from pyspark.sql import Window

    w = Window.partitionBy("sec_number").orderBy(F.unix_date("filing_date")).rangeBetween(Window.unboundedPreceding, -1)
    frame = rows.select("filing_date", F.last("raum").over(w).alias("prev_raum")).orderBy("filing_date").collect()
    lagged = with_previous(rows, COMPARED).select("filing_date", "prev_raum").orderBy("filing_date").collect()
    assert frame == lagged


def test_a_hot_firm_costs_one_row_per_date(spark):
    hot = spark.range(60_000).selectExpr(
        "'f' AS sec_number", "DATE_ADD(DATE'2020-01-01', INT(id % 50)) AS filing_date", "id AS filing_key",
        "CAST(100 AS DECIMAL(20,2)) AS raum",
    )
    kept = dedupe_filings(hot)
    assert kept.count() == 50
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_largest_drops_and_population_report(history):
    rows = history(("f", "2020-01-02", M, 100, 10), ("f", "2020-02-02", M, 40, 20), ("g", "2020-01-02", M, 3, 8), ("g", "2020-02-02", M, 2, 1))
    assert [(r.sec_number, float(r.drop_pct)) for r in largest_drops(rows, "client_count").collect()] == [("f", 60.0), ("g", 33.33)]
    assert [float(r.drop_pct) for r in largest_drops(rows, "account_count", integer_division=True).collect()] == [0.0]
    assert population_report(filing_changes(rows)).first().asDict() == {
        "records": 4, "new_disclosures": 0, "officer_changes": 0, "large_raum_drops": 0,
    }
