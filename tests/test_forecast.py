import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.forecast import (
    PurchaseModel,
    ValueModel,
    alive_probability,
    expected_purchases_array,
    expected_value,
    with_forecast,
)

MODEL = PurchaseModel(r=0.243, alpha=4.414, a=0.793, b=2.426)
VALUES = ValueModel(p=6.25, q=3.74, v=15.44)


def simulated(model, x, recency, age, days, n=400_000, seed=3):
    """Expected purchases by sampling the model's posterior with importance weights."""
    rng = np.random.default_rng(seed)
    lam = rng.gamma(model.r + x, 1 / (model.alpha + age), n)
    p = rng.beta(model.a, model.b, n)
    # likelihood of the history given (lambda, p), relative to the gamma that was sampled
    alive = (1 - p) ** x
    dead = p * (1 - p) ** (x - 1) * np.exp(lam * (age - recency)) if x > 0 else 0 * p
    gain = (1 - np.exp(-lam * p * days)) / p
    return float(np.sum(alive * gain) / np.sum(alive + dead))


@pytest.mark.parametrize("x,recency,age,days", [(2, 30.43, 38.86, 39.0), (0, 0.0, 20.0, 30.0), (5, 100.0, 120.0, 365.0), (26, 30.84, 31.0, 31.0)])
def test_expected_purchases_against_simulation(x, recency, age, days):
    got = expected_purchases_array(MODEL, np.array([float(x)]), np.array([recency]), np.array([age]), days)[0]
    assert got == pytest.approx(simulated(MODEL, x, recency, age, days), rel=0.03)


def test_published_example():
    # two purchases, the last at 30.43 of 38.86 weeks: 1.226 expected in the next 39 weeks
    got = expected_purchases_array(MODEL, np.array([2.0]), np.array([30.43]), np.array([38.86]), 39.0)[0]
    assert got == pytest.approx(1.226, abs=0.002)


def test_large_counts_converge():
    got = expected_purchases_array(MODEL, np.array([5000.0]), np.array([699.0]), np.array([700.0]), 365.0)[0]
    assert math.isfinite(got) and got > 0


def test_closed_forms(spark):
    df = spark.createDataFrame([(2.0, 30.43, 38.86, 10.0), (0.0, 0.0, 5.0, 10.0)], "x double, t double, a double, m double")
    rows = df.select(
        alive_probability(MODEL, F.col("x"), F.col("t"), F.col("a")).alias("p"), expected_value(VALUES, F.col("x"), F.col("m")).alias("v")
    ).collect()
    assert rows[0]["p"] == pytest.approx(1 / (1 + 0.793 / 3.426 * ((4.414 + 38.86) / (4.414 + 30.43)) ** 2.243))
    assert rows[1]["p"] == 1.0
    assert rows[0]["v"] == pytest.approx(6.25 * (15.44 + 20) / (12.5 + 2.74))
    assert rows[1]["v"] == pytest.approx(6.25 * 15.44 / 2.74)


def test_forecast_columns_and_eligibility(spark):
    names = ["order_header_count", "recency_in_days", "age_in_days", "avg_order_value_per_order_header", "has_billing_documents"]
    schema = "primary_key string, " + ", ".join(
        f"c_{n}_since_s {t}" for n, t in zip(names, ["bigint", "int", "int", "double", "boolean"])
    )
    df = spark.createDataFrame(
        [("ok", 4, 80, 100, 20.0, True), ("flag", 4, 80, 100, 20.0, False), ("value", 4, 80, 100, 0.0, True), ("recency", 4, 100, 100, 20.0, True), ("none", None, None, None, None, None)],
        schema,
    )
    got = {r["primary_key"]: r for r in with_forecast(df, "c", "s", MODEL, VALUES).collect()}
    ok = got["ok"]
    assert ok["c_30_day_total_value_forecast"] == pytest.approx(
        ok["c_alive_probability_forecast"] * ok["c_30_day_frequency_forecast"] * ok["c_30_day_average_monetary_value_forecast"]
    )
    assert 0 < ok["c_7_day_frequency_forecast"] < ok["c_365_day_frequency_forecast"]
    months = [expected_purchases_array(MODEL, np.array([4.0]), np.array([80.0]), np.array([100.0]), 30.0 * m)[0] for m in range(13)]
    value = ok["c_7_day_average_monetary_value_forecast"]
    lifetime = sum(value * (months[m] - (months[m - 1] if m > 1 else 0)) / 1.01**m for m in range(1, 13))
    assert ok["c_total_lifetime_value_forecast"] == pytest.approx(lifetime)
    for key in ("flag", "value", "recency", "none"):
        assert all(got[key][c] is None for c in got[key].asDict() if c.endswith("_forecast"))
