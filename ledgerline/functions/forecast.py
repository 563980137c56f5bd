"""Scoring with a beta-geometric purchase model and a gamma-gamma value model.

Formulas: Fader, Hardie, Lee (2005), "Counting your customers the easy way"; Fader, Hardie
(2013), "The gamma-gamma model of monetary value".  Parameters come fitted from elsewhere.
Only the expected number of purchases needs a special function and so a vectorised UDF.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.columns import quoted

# Forecast windows in days, months of lifetime value, days per month, discount.
DURATIONS = (7, 14, 30, 60, 90, 182, 365)
LIFETIME_MONTHS = 12
DAYS_PER_MONTH = 30
MONTHLY_DISCOUNT = 0.01


@dataclass(frozen=True)
class PurchaseModel:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class ValueModel:
    p: float
    q: float
    v: float


def alive_probability(model: PurchaseModel, x: Column, recency: Column, age: Column) -> Column:
    """Chance that a customer still buys; certain without a repeat purchase."""
    odds = (model.a / (model.b + x - 1)) * F.pow(
        (model.alpha + age) / (model.alpha + recency), model.r + x
    )
    return F.when(x > 0, 1 / (1 + odds)).otherwise(F.lit(1.0))


def expected_value(model: ValueModel, x: Column, mean: Column) -> Column:
    """Expected value of a purchase: the customer's mean drawn towards the population's."""
    return model.p * (model.v + x * mean) / (model.p * x + model.q - 1)


def _hypergeometric(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """2F1(a, b; c; z) by its series, for |z| < 1; an error where it has not converged."""
    term = np.ones_like(z)
    total = np.ones_like(z)
    for n in range(100_000):
        term = term * ((a + n) * (b + n) / ((c + n) * (n + 1))) * z
        total = total + term
        if not np.any(np.abs(term) > 1e-14 * np.abs(total)):
            return total
    raise ArithmeticError("the series of the purchase forecast does not converge")


def expected_purchases_array(
    model: PurchaseModel, x: np.ndarray, recency: np.ndarray, age: np.ndarray, days: float
) -> np.ndarray:
    """Expected purchases in the next days.

    Euler's transformation turns the model's 2F1 into one whose first two parameters do not
    grow with x, so the series converges for every customer.
    """
    r, alpha, a, b = model.r, model.alpha, model.a, model.b
    z = days / (alpha + age + days)
    c = a + b + x - 1
    inner = 1 - (1 - z) ** (a - 1) * _hypergeometric(a + b - 1 - r, a - 1, c, z)
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.where(
            x > 0, a / (b + x - 1) * ((alpha + age) / (alpha + recency)) ** (r + x), 0.0
        )
    return c / (a - 1) * inner / (1 + odds)


def expected_purchases(
    model: PurchaseModel, x: Column, recency: Column, age: Column, days: Sequence[int]
) -> Column:
    """Struct of expected purchases, one field ``d<days>`` per window, from one pass over the rows."""
    names = [f"d{d}" for d in days]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def score(x: pd.Series, recency: pd.Series, age: pd.Series) -> pd.DataFrame:
        arrays = [s.to_numpy(dtype=float) for s in (x, recency, age)]
        return pd.DataFrame(
            {n: expected_purchases_array(model, *arrays, float(d)) for n, d in zip(names, days)}
        )

    return score(x.cast("double"), recency.cast("double"), age.cast("double"))


def with_forecast(
    df: DataFrame,
    name: str,
    since: str,
    purchases: PurchaseModel,
    values: ValueModel,
    durations: Sequence[int] = DURATIONS,
) -> DataFrame:
    """Forecast columns from the RFM columns of one horizon.

    Rows without activity, with a mean value of zero or less, or whose last purchase is not
    before the reference day get nulls.
    """

    def rfm(metric: str) -> Column:
        return quoted(f"{name}_{metric}_since_{since}")

    x, recency, age = rfm("order_header_count"), rfm("recency_in_days"), rfm("age_in_days")
    mean = rfm("avg_order_value_per_order_header")
    scored = F.coalesce(rfm("has_billing_documents") & (mean > 0) & (recency < age), F.lit(False))
    months = [m * DAYS_PER_MONTH for m in range(1, LIFETIME_MONTHS + 1)]
    days = sorted({*durations, *months})

    def shown(c: Column) -> Column:
        return F.when(F.col("__scored"), c)

    staged = df.withColumn("__scored", scored).withColumn(
        "__expected",
        expected_purchases(
            purchases,
            F.coalesce(x, F.lit(0)),
            F.coalesce(recency, F.lit(0)),
            F.coalesce(age, F.lit(0)),
            days,
        ),
    )
    alive = alive_probability(purchases, x.cast("double"), recency, age)
    each = expected_value(values, x, mean)
    lifetime = F.lit(0.0)
    for i, upto in enumerate(months):
        gained = F.col(f"__expected.d{upto}")
        if i:
            gained = gained - F.col(f"__expected.d{months[i - 1]}")
        lifetime = lifetime + each * gained / F.lit((1 + MONTHLY_DISCOUNT) ** (i + 1))
    out = {
        f"{name}_alive_probability_forecast": shown(alive),
        f"{name}_total_lifetime_value_forecast": shown(lifetime),
    }
    for d in durations:
        count = F.col(f"__expected.d{d}")
        out |= {
            f"{name}_{d}_day_frequency_forecast": shown(count),
            f"{name}_{d}_day_average_monetary_value_forecast": shown(each),
            f"{name}_{d}_day_total_value_forecast": shown(alive * count * each),
        }
    return staged.withColumns(out).drop("__scored", "__expected")
