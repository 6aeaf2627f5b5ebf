import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingscope.operators.quantiles import RANK_ERROR, exact_percentiles, merged_percentiles, quantile_sketches

WANTED = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}

random.seed(7)
CASES = {
    "one": [3.5],
    "two": [1.0, 2.0],
    "ties": [5.0] * 100 + [7.0],
    "signs": [-3.0, -2.5, 0.0, 0.0, 1e-9, 4.0, 1e12],
    "narrow": [1e9 + i / 100 for i in range(3000)],
    "wide": [random.lognormvariate(10, 6) for _ in range(3000)],
    "mixed": [random.gauss(0, 50) for _ in range(2000)] + [12.25] * 1500,
}


@pytest.mark.parametrize("name", CASES)
def test_matches_linear_interpolation(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5)
    row = exact_percentiles(df, "x", WANTED).first()
    for label, p in WANTED.items():
        assert row[label] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), label


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_percentiles(df, "x", {"p50": 0.5}).first().p50 is None


def test_probability_must_be_one(spark):
    with pytest.raises(ValueError):
        exact_percentiles(spark.range(3).selectExpr("double(id) AS x"), "x", {"p": 1.5})


def test_sketches_by_date_answer_for_any_dates(spark):
    rng = random.Random(1)
    rows = [(day, rng.choice([None, rng.gauss(day, 5), float(day)])) for day in range(40) for _ in range(rng.randint(0, 400))]
    rows += [(99, None)] * 5
    sketches = quantile_sketches(spark.createDataFrame(rows, "day int, v double").repartition(5), "v", "day")
    for chosen in (range(100), range(3), range(7, 30)):
        values = sorted(v for d, v in rows if d in chosen and v is not None)
        got = merged_percentiles(sketches.where(F.col("day").isin(list(chosen))), {"a": 0.05, "b": 0.5, "c": 0.99}).first()
        assert got["values"] == len(values)
        for name, p in (("a", 0.05), ("b", 0.5), ("c", 0.99)):
            below, upto = bisect.bisect_left(values, got[name]), bisect.bisect_right(values, got[name])
            slack = RANK_ERROR * len(values) + 1
            assert below < upto and below - slack <= p * len(values) <= upto + slack
    by_half = merged_percentiles(sketches.withColumn("half", F.col("day") < 20), {"m": 0.5}, "half").collect()
    assert len(by_half) == 2
