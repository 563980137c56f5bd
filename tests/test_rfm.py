import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.joins import merge_metric_sets
from ledgerline.operators.rfm import (
    Horizon,
    InvoiceColumns,
    RfmSpec,
    default_horizons,
    enrich_with_rfm,
    label_sets,
    rfm_metrics,
    rfm_with_ranks,
)

AS_OF = dt.date(2024, 6, 30)
HORIZONS = [Horizon.since("2024-01-01"), Horizon("recent", dt.date(2024, 6, 1)), Horizon("odd", dt.date(2024, 3, 15))]
SCHEMA = (
    "item_key string, header_key string, product_key string, sold_to_key string, billing_date date, "
    "currency string, billed_quantity double, net_value double, sales_value double, specialty_flag boolean, source_flag boolean"
)


def frame(n=600):
    rng = random.Random(7)
    data = []
    for i in range(n):
        value = rng.randint(-2, 50) / 4
        data.append(
            (
                f"i{i % 550}", f"h{i // 3}", f"p{rng.randint(0, 9)}", rng.choice(["hot"] * 5 + [f"c{rng.randint(0, 20)}"]),
                dt.date(2023, 12, 20) + dt.timedelta(rng.randint(0, 192)), rng.choice(["USD", "USD", "EUR", None]),
                float(rng.randint(0, 5)), value, value, rng.choice([True, False, None]), rng.choice([True, False]),
            )
        )
    data.append(("z1", "z1", None, "late", AS_OF, "USD", 1.0, 5.0, 5.0, True, True))
    data.append(("z2", "z2", "p1", None, dt.date(2024, 2, 1), "USD", 1.0, 5.0, 5.0, True, True))
    return data


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(frame(), SCHEMA).cache()


def test_one_pass_equals_merged_single_passes(spark, items, rows):
    together = rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS, exact=True))
    apart = merge_metric_sets(
        [rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, [h], exact=True)) for h in HORIZONS], "primary_key"
    )
    assert rows(together) == rows(apart.select(together.columns))


def test_against_pandas(items):
    pdf = pd.DataFrame(frame(), columns=[c.split()[0] for c in SCHEMA.split(", ")])
    got = rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS, exact=True)).toPandas().set_index("primary_key")
    keep = pdf[(pdf.currency == "USD") & (pdf.billed_quantity > 0) & (pdf.net_value > 0)]
    for h in HORIZONS:
        part = keep[keep.billing_date >= h.start]
        for key, g in part.groupby(part.sold_to_key.fillna("")):
            r = got.loc[key]
            assert r[f"c_order_count_since_{h.alias}"] == g.item_key.nunique()
            assert r[f"c_unique_product_count_since_{h.alias}"] == g.product_key.nunique()
            assert r[f"c_unique_order_date_count_since_{h.alias}"] == g.billing_date.nunique()
            assert r[f"c_total_order_value_since_{h.alias}"] == g.sales_value.sum()
            assert r[f"c_total_order_value_specialty_only_since_{h.alias}"] == g[g.specialty_flag == True].sales_value.sum()  # noqa: E712
            assert r[f"c_age_in_days_since_{h.alias}"] == (AS_OF - g.billing_date.min()).days
            assert r[f"c_recency_in_days_since_{h.alias}"] == (g.billing_date.max() - g.billing_date.min()).days
        absent = set(got.index) - set(part.sold_to_key.fillna(""))
        assert got.loc[list(absent), [c for c in got.columns if c.endswith(f"since_{h.alias}")]].isna().all().all()


def test_flag_and_division_by_zero(items):
    got = {r["primary_key"]: r for r in rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS, exact=True)).collect()}
    late = got["late"]
    assert late["c_age_in_days_since_recent"] == 0
    assert late["c_total_order_value_per_day_since_recent"] is None
    assert late["c_has_billing_documents_since_recent"] is False
    assert late["c_unique_product_count_since_recent"] == 0
    assert got[""]["c_has_billing_documents_since_recent"] is None


def test_sketches_are_close(items):
    exact = rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS, exact=True))
    near = rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS))
    assert near.columns == exact.columns
    joined = exact.alias("e").join(near.alias("n"), "primary_key")
    c = "c_order_count_since_2024_01_01"
    assert joined.filter(F.abs(F.col(f"e.{c}") - F.col(f"n.{c}")) > 0.05 * F.col(f"e.{c}") + 1).isEmpty()
    value = "c_total_order_value_since_2024_01_01"
    assert joined.filter(~F.col(f"e.{value}").eqNullSafe(F.col(f"n.{value}"))).isEmpty()


def test_ranks(items):
    spec = RfmSpec(AS_OF, HORIZONS[:2], exact=True)
    pdf = rfm_with_ranks(items, ["product_key"], "p", spec).toPandas()
    for h in HORIZONS[:2]:
        m = f"p_order_count_since_{h.alias}"
        part = pdf[pdf[m].notna()].sort_values([m, "primary_key"], ascending=[False, True])
        assert list(part[f"rank_of_{m}"]) == list(range(1, len(part) + 1))
        for _, r in part.iterrows():
            assert r[f"cumulative_sum_of_{m}"] == part[part[m] >= r[m]][m].sum()
        assert part[f"cumulative_sum_of_pcntg_of_total_{m}"].iloc[-1] == 1.0
        assert pdf[pdf[m].isna()][f"rank_of_{m}"].isna().all()


def test_enrichment_keeps_every_entity(spark, items):
    entities = spark.createDataFrame([("hot",), ("nobody",), (None,)], "primary_key string")
    got = enrich_with_rfm(entities, items, {"c": ["sold_to_key"]}, RfmSpec(AS_OF, HORIZONS, exact=True), ranks=False)
    assert got.count() == 3
    assert got.filter("primary_key = 'nobody'").first()["c_order_count_since_recent"] is None


@pytest.mark.parametrize("exact", [True, False])
def test_roles_together_equal_roles_apart(spark, items, rows, exact):
    spec = RfmSpec(AS_OF, HORIZONS, exact=exact)
    roles = {"c": ["sold_to_key"], "p": ["product_key", "sold_to_key"]}
    entities = spark.createDataFrame([("hot",), ("p1_||_hot",), ("c3",)], "primary_key string")
    together = enrich_with_rfm(entities, items, roles, spec, ranks=False)
    apart = entities
    for name, groups in roles.items():
        apart = apart.join(rfm_metrics(items, groups, name, spec), "primary_key", "left")
    assert rows(together) == rows(apart.select(together.columns))


def test_labels(spark):
    df = spark.createDataFrame([("a", True, False), ("a", False, False), ("b", None, True)], "g string, specialty_flag boolean, source_flag boolean")
    got = {r["primary_key"]: (r["spd_labels"], r["source_labels"]) for r in label_sets(df, ["g"], InvoiceColumns()).collect()}
    assert got == {"a": (["NON-SPD", "SPD"], ["NON-SOURCE"]), "b": (["NON-SPD"], ["SOURCE"])}


def test_default_horizons():
    hs = default_horizons(dt.date(2024, 3, 31))
    assert [h.alias for h in hs][:3] == ["2022_01_01", "2023_01_01", "1_months_ago_to_date"]
    assert hs[2].start == dt.date(2024, 2, 29) and hs[-1].start == dt.date(2023, 3, 31) and len(hs) == 9


def test_hot_group_is_combined_before_the_shuffle(items):
    plan = rfm_metrics(items, ["sold_to_key"], "c", RfmSpec(AS_OF, HORIZONS, exact=True))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in text and "Window" not in text and "Expand" not in text
