"""Single-filing and weighted model, factor documents."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from filingscope.operators import components as comp
from filingscope.operators.factors import factor_contribution, factor_presence, factors_json, mentions
from filingscope.operators.points import preview_scores, score_single_filings

MODEL = "crd long, filing_date date, raum decimal(20,2), total_clients int, total_accounts int, cco_id string, disclosure_flag string"


def single(history, *args):
    return score_single_filings(history(("f", "2020-01-02", *args))).withColumn("doc", factors_json()).first()


@pytest.mark.parametrize(
    "raum, clients, disclosures, score, category",
    [
        (20_000_000_000, 1, 3, 25 + 5 + 15, "High"),
        (2_000_000_000, 1000, 1, 10 + 10 + 10, "High"),
        (200_000_000, 1000, 0, 15 + 5, "Medium"),
        (50_000_000, 1000, 0, 20 + 0, "Medium"),
        (100_000_000, 10, 2, 20 + 20 + 10, "Critical"),  # the limits are exclusive: 100M scores 20, 10M a head 10
        (20_000_000_000, 0, 0, 5, "Low"),
    ],
)
def test_single_filing_points(history, raum, clients, disclosures, score, category):
    row = single(history, raum, clients, 10, "A", disclosures)
    assert (row.score, row.risk_category) == (score, category)


def test_factors_without_input_are_absent(history):
    assert single(history, 50_000_000, 0, 10, "A", None).doc == (
        '{"size_factor_risk":20,"filing_compliance_risk":0,"cco_stability_risk":0,"aum_volatility_risk":0}'
    )


def test_filings_without_assets_are_not_scored(history):
    assert score_single_filings(history(("f", "2020-01-02", 0), ("g", "2020-01-02", None))).count() == 0


def test_preview(history):
    rows = preview_scores(history(("f", "2020-01-02", 2e9, 1, 1, "A", 2), ("g", "2020-01-02", None, 1, 1, "A", None)))
    assert sorted(r.overall_risk for r in rows.collect()) == [0, 25]


def test_factor_documents(spark):
    docs = spark.createDataFrame([('{"a":1,"b":0}',), ('{"a":3}',), ("{}",), (None,)], "factors_json string")
    stats = {r.factor: r for r in factor_contribution(docs).collect()}
    assert (stats["a"].scores, stats["a"].avg_value, stats["a"].max_value, stats["a"].working) == (2, 2.0, 3.0, True)
    assert (stats["b"].non_zero, stats["b"].working, stats["b"].max_value) == (0, False, 0.0)
    assert factor_presence(docs).first().asDict() == {"total": 4, "empty_factors": 2, "has_factors": 2}
    assert docs.where(mentions("factors_json", "b")).count() == 1


def model_rows(spark, *rows):
    return spark.createDataFrame([(c, date.fromisoformat(d), *rest) for c, d, *rest in rows], MODEL)


@pytest.fixture
def model(spark):
    from decimal import Decimal as D

    return model_rows(
        spark,
        (1, "2019-01-01", D(100), 10, 100, "A", "Y"),
        (1, "2020-01-01", D(110), 10, 100, None, "N"),
        (1, "2021-01-01", None, None, 100, "B", "Y"),
        (1, "2022-01-01", D(99), 30, 60, "B", "N"),
        (2, "2020-01-01", D(5_000_000_000), 1, 0, "A", "N"),
        (3, "2020-01-01", D(0), 4, 4, "A", "N"),
        (3, "2020-07-01", D(50), 4, 4, "A", "N"),
        (3, "2021-01-01", None, 4, 4, "A", "N"),
    )


def test_measures(model):
    m = {r.crd: r for r in comp.firm_measures(model).collect()}
    years = 1096 / 365.25
    assert (m[1].disclosure_count, m[1].filing_count) == (2, 4)
    assert m[1].years_active == pytest.approx(years)
    changes = [0.1, 99 / 110 - 1]
    mean = sum(changes) / 2
    assert m[1].aum_trend == pytest.approx(mean)
    assert m[1].aum_volatility == pytest.approx(math.sqrt(sum((c - mean) ** 2 for c in changes)))
    assert (m[1].total_clients, m[1].total_accounts, m[1].aum) == (30, 60, 99.0)
    assert (m[1].officer_filings, m[1].cco_changes) == (3, 2)  # the first officer counts as a change
    assert m[2].aum_volatility is None and m[2].client_account_ratio == 1.0
    assert m[3].aum_volatility is None and m[3].aum is None  # only change is from zero; newest assets unknown


def test_components_and_total(model):
    rows = {r.crd: r for r in comp.weighted_scores(model).collect()}
    scale = comp.ratio_scale(model).first().scale
    years = 1096 / 365.25
    assert rows[1].disclosure_risk == pytest.approx(math.log1p(2 / years) / math.log(10))
    assert rows[1].aum_volatility_risk == 1.0
    assert rows[1].client_concentration_risk == pytest.approx(min(0.5 / scale, 1))
    assert rows[1].filing_compliance_risk == pytest.approx(1 - 4 / years / 4)
    assert rows[1].cco_stability_risk == pytest.approx(0.4)
    assert rows[2].cco_stability_risk == 0.0 and rows[2].aum_volatility_risk == 0.0
    assert rows[2].size_factor_risk == 0.0
    assert rows[3].size_factor_risk == pytest.approx(math.tanh(1))
    for r in rows.values():
        weights = (0.35, 0.20, 0.15, 0.15, 0.10, 0.05)
        parts = (
            r.disclosure_risk, r.aum_volatility_risk, r.client_concentration_risk, r.filing_compliance_risk,
            r.cco_stability_risk, r.size_factor_risk,
        )
        assert r.overall_risk_score == pytest.approx(sum(w * p for w, p in zip(weights, parts)))
        assert all(0 <= p <= 1 for p in parts)


def test_scale_of_zero_gives_no_concentration(spark):
    from decimal import Decimal as D

    rows = comp.weighted_scores(model_rows(spark, (1, "2020-01-01", D(1), 0, 5, "A", "N")))
    assert rows.select(F.col("client_concentration_risk")).first()[0] == 0.0


def test_factors_of_short_histories_are_zero(model):
    rows = {r.crd: r.risk_factors for r in comp.weighted_scores(model).collect()}
    assert (rows[2].aum_volatility, rows[2].aum_trend) == (0.0, 0.0)  # one filing with assets
    assert (rows[2].cco_changes, rows[2].avg_tenure_years) == (0, 0.0)  # one filing with an officer
    assert rows[1].cco_changes == 2 and rows[1].aum_trend == pytest.approx((0.1 + 99 / 110 - 1) / 2)
    assert rows[3].aum_volatility is None  # two filings with assets, the only change is from zero


def test_time_of_calculation(model):
    stated = comp.weighted_scores(model, calculated=F.lit("2024-02-29").cast("timestamp"))
    assert {str(r.last_calculation_date) for r in stated.collect()} == {"2024-02-29 00:00:00"}
    assert comp.weighted_scores(model).schema["last_calculation_date"].dataType.simpleString() == "timestamp"
