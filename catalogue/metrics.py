"""Queries on recency, frequency, value, ranks and ABC classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import HORIZONS, ITEMS, items, rfm_sql, spec
from ledgerline.functions.exact import exact_sum
from ledgerline.operators.joins import attach_totals
from ledgerline.operators.pareto import abc_classification
from ledgerline.operators.rfm import (
    InvoiceColumns,
    eligible_items,
    label_sets,
    rfm_metrics,
    rfm_with_ranks,
)

_ONE = [HORIZONS[0]]
_RANK = [HORIZONS[0], HORIZONS[4]]


def rfm_by_customer(spark, sf):
    return rfm_metrics(items(spark, sf), ["sold_to_key"], "customer", spec(horizons=_ONE))


def rfm_multi_horizon(spark, sf):
    return rfm_metrics(items(spark, sf), ["sold_to_key"], "customer", spec())


def rfm_by_pair(spark, sf):
    return rfm_metrics(
        items(spark, sf), ["ship_to_key", "product_key"], "pair", spec(horizons=[HORIZONS[1], HORIZONS[8]])
    )


def rank_share_cumulative(spark, sf):
    ranked = rfm_with_ranks(items(spark, sf), ["product_key"], "product", spec(horizons=_RANK))
    metrics = [
        f"product_{m}_since_{h.alias}" for h in _RANK for m in ("order_count", "total_order_value")
    ]
    prefixes = (
        "",
        "rank_of_",
        "cumulative_sum_of_",
        "total_",
        "pcntg_of_total_",
        "cumulative_sum_of_pcntg_of_total_",
    )
    return ranked.select(
        "primary_key",
        *[F.col(p + m).cast("double").alias(p + m) for m in metrics for p in prefixes],
        *[f"rank_of_product_total_order_value_per_day_since_{h.alias}" for h in _RANK],
    )


def _rank_sql() -> str:
    out = []
    for h in _RANK:
        for m in ("order_count", "total_order_value"):
            c = f"product_{m}_since_{h.alias}"
            v = f"CAST({c} AS DOUBLE)"
            run = f"CAST(sum(CAST({v} AS DECIMAL(18, 4))) OVER (ORDER BY {c} DESC NULLS LAST) AS DOUBLE)"
            total = f"CAST(sum(CAST({v} AS DECIMAL(18, 4))) OVER () AS DOUBLE)"
            present = f"product_order_count_since_{h.alias} IS NOT NULL"
            out += [
                f"{v} AS {c}",
                f"CASE WHEN {present} THEN CAST(row_number() OVER (ORDER BY {c} DESC NULLS LAST, primary_key) AS DOUBLE) END AS rank_of_{c}",
                f"CASE WHEN {present} THEN {run} END AS cumulative_sum_of_{c}",
                f"CASE WHEN {present} THEN {total} END AS total_{c}",
                f"{v} / nullif({total}, 0) AS pcntg_of_total_{c}",
                f"CASE WHEN {present} THEN {run} / nullif({total}, 0) END AS cumulative_sum_of_pcntg_of_total_{c}",
            ]
        d = f"product_total_order_value_per_day_since_{h.alias}"
        out.append(
            f"CASE WHEN product_order_count_since_{h.alias} IS NOT NULL THEN row_number() OVER (ORDER BY {d} DESC NULLS LAST, primary_key) END AS rank_of_{d}"
        )
    return f"WITH {ITEMS}, m AS ({rfm_sql('product_key', 'product', _RANK)}) SELECT primary_key, {', '.join(out)} FROM m"


def label_sets_by_product(spark, sf):
    labels = label_sets(items(spark, sf), ["product_key"], InvoiceColumns())
    return labels.select(
        "primary_key",
        F.array_join("spd_labels", "|").alias("spd_labels"),
        F.array_join("source_labels", "|").alias("source_labels"),
        F.size("spd_labels").alias("spd_labels_count"),
        F.size("source_labels").alias("source_labels_count"),
    )


def abc_by_trade_name(spark, sf):
    return abc_classification(
        items(spark, sf, products=True),
        "sales_value",
        group=["product_key"],
        partition=["trade_name"],
        metric_name="sales_in_usd",
    )


def abc_whole_dataset(spark, sf):
    return abc_classification(items(spark, sf), "sales_value", group=["sold_to_key"]).select(
        "sold_to_key", "group_value", "group_rank", "group_cumulative", "group_share",
        "group_cumulative_share", "group_class", "group_id", "partition_class", "dataset_value",
    )


def abc_average(spark, sf):
    return abc_classification(
        items(spark, sf, products=True),
        "billed_quantity",
        group=["manufacturer_key"],
        partition=["generic_name"],
        aggregate="avg",
    ).select(
        "generic_name", "manufacturer_key", "group_value", "group_rank", "group_cumulative",
        "group_share", "group_class", "partition_value", "partition_cumulative", "partition_class",
        "dataset_value",
    )


def _abc_sql(group: str, partition: str, metric: str, avg: bool = False) -> str:
    """ABC in SQL; ``partition`` is a column name."""
    figure = "CAST(sum(CAST(s AS DECIMAL(18, 4))) AS DOUBLE) / nullif(sum(n), 0)" if avg else "CAST(sum(CAST(s AS DECIMAL(18, 4))) AS DOUBLE)"
    if avg:
        def running(v, over):
            return f"CAST(sum(CAST({v} AS DECIMAL(18, 4))) OVER ({over}) AS DOUBLE) / nullif(count({v}) OVER ({over}), 0)"
    else:
        def running(v, over):
            return f"CAST(sum(CAST({v} AS DECIMAL(18, 4))) OVER ({over}) AS DOUBLE)"

    def label(level):
        return f"""CASE WHEN ({level}_cumulative_share <= 0.8 AND {level}_value > 0) OR {level}_share >= 0.8 THEN 'A'
             WHEN {level}_cumulative_share > 0.8 AND {level}_cumulative_share <= 0.95 THEN 'B' ELSE 'C' END AS {level}_class"""

    return f"""WITH {ITEMS},
src AS (SELECT *, 'all' AS everything FROM items),
g AS (SELECT {partition}, {group}, sum({metric}) AS s, count({metric}) AS n FROM src GROUP BY ALL),
d AS (SELECT {figure} AS dataset_value FROM g),
p0 AS (SELECT {partition}, {figure} AS partition_value FROM g GROUP BY 1),
p1 AS (SELECT *, row_number() OVER (ORDER BY partition_value DESC NULLS LAST, {partition}) AS partition_rank,
         {running('partition_value', 'ORDER BY partition_value DESC NULLS LAST')} AS partition_cumulative
       FROM p0 CROSS JOIN d),
p2 AS (SELECT *, partition_value / nullif(dataset_value, 0) AS partition_share,
         partition_cumulative / nullif(dataset_value, 0) AS partition_cumulative_share FROM p1),
p3 AS (SELECT *, {label('partition')} FROM p2),
g0 AS (SELECT {partition}, {group}, {figure} AS group_value FROM g GROUP BY 1, 2),
g1 AS (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY group_value DESC NULLS LAST, {group}) AS group_rank,
         {running('group_value', f'PARTITION BY {partition} ORDER BY group_value DESC NULLS LAST')} AS group_cumulative
       FROM g0),
g2 AS (SELECT g1.*, p3.* EXCLUDE ({partition}), group_value / nullif(partition_value, 0) AS group_share,
         group_cumulative / nullif(partition_value, 0) AS group_cumulative_share
       FROM g1 JOIN p3 USING ({partition})),
g3 AS (SELECT *, {label('group')} FROM g2)
"""


_ABC_TRADE = _abc_sql("product_key", "trade_name", "sales_value") + """
SELECT *, '{"trade_name":"' || trade_name || '"}' AS partition_block_id,
       '{"product_key":"' || product_key || '"}' AS group_id,
       'sales_value' AS metric_col, 'sales_in_usd' AS metric_name, 'sum' AS agg_fn_name,
       CAST(0.8 AS DOUBLE) AS a_class_max, CAST(0.95 AS DOUBLE) AS b_class_max FROM g3"""

_ABC_ALL = _abc_sql("sold_to_key", "everything", "sales_value") + """
SELECT sold_to_key, group_value, group_rank, group_cumulative, group_share, group_cumulative_share,
       group_class, '{"sold_to_key":"' || sold_to_key || '"}' AS group_id, partition_class, dataset_value FROM g3"""

_ABC_AVG = _abc_sql("manufacturer_key", "generic_name", "billed_quantity", avg=True) + """
SELECT generic_name, manufacturer_key, group_value, group_rank, group_cumulative, group_share,
       group_class, partition_value, partition_cumulative, partition_class, dataset_value FROM g3"""


def global_totals(spark, sf):
    """Share of each manufacturer in the one-row totals, and its specialty part."""
    source = items(spark, sf)
    totals = source.agg(exact_sum("sales_value").alias("total_sales_value"))
    by_maker = source.groupBy("manufacturer_key").agg(
        exact_sum("sales_value").alias("sales_value"),
        exact_sum(F.when(F.col("specialty_flag"), F.col("sales_value")).otherwise(0)).alias(
            "specialty_value"
        ),
    )
    return attach_totals(by_maker, totals, []).withColumn(
        "share", F.try_divide("sales_value", "total_sales_value")
    )


def rfm_eligibility(spark, sf):
    kept = eligible_items(items(spark, sf), spec())
    return kept.groupBy("currency", F.year("billing_date").cast("long").alias("billing_year")).agg(
        F.count("*").alias("item_count"), exact_sum("net_value").alias("net_value")
    )


QUERIES = {
    "rfm_by_customer": (rfm_by_customer, f"WITH {ITEMS} {rfm_sql('sold_to_key', 'customer', _ONE)}"),
    "rfm_multi_horizon": (rfm_multi_horizon, f"WITH {ITEMS} {rfm_sql('sold_to_key', 'customer')}"),
    "rfm_by_pair": (
        rfm_by_pair,
        f"WITH {ITEMS} "
        + rfm_sql("concat_ws('_||_', ship_to_key, product_key)", "pair", [HORIZONS[1], HORIZONS[8]]),
    ),
    "rank_share_cumulative": (rank_share_cumulative, _rank_sql()),
    "label_sets_by_product": (
        label_sets_by_product,
        f"""WITH {ITEMS}, f AS (SELECT product_key AS primary_key, bool_or(specialty_flag) AS s1, bool_or(NOT specialty_flag) AS s0,
              bool_or(source_flag) AS o1, bool_or(NOT source_flag) AS o0 FROM items GROUP BY 1)
        SELECT primary_key,
          concat_ws('|', CASE WHEN s0 THEN 'NON-SPD' END, CASE WHEN s1 THEN 'SPD' END) AS spd_labels,
          concat_ws('|', CASE WHEN o0 THEN 'NON-SOURCE' END, CASE WHEN o1 THEN 'SOURCE' END) AS source_labels,
          CAST(s0 AS INTEGER) + CAST(s1 AS INTEGER) AS spd_labels_count,
          CAST(o0 AS INTEGER) + CAST(o1 AS INTEGER) AS source_labels_count FROM f""",
    ),
    "abc_by_trade_name": (abc_by_trade_name, _ABC_TRADE),
    "abc_whole_dataset": (abc_whole_dataset, _ABC_ALL),
    "abc_average": (abc_average, _ABC_AVG),
    "global_totals": (
        global_totals,
        f"""WITH {ITEMS} SELECT manufacturer_key, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value,
          CAST(sum(CAST(CASE WHEN specialty_flag THEN sales_value ELSE 0 END AS DECIMAL(18, 4))) AS DOUBLE) AS specialty_value,
          (SELECT CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) FROM items) AS total_sales_value,
          CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) / (SELECT CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) FROM items) AS share
        FROM items GROUP BY 1""",
    ),
    "rfm_eligibility": (
        rfm_eligibility,
        f"""WITH {ITEMS} SELECT currency, year(billing_date) AS billing_year, count(*) AS item_count,
          CAST(sum(CAST(net_value AS DECIMAL(18, 4))) AS DOUBLE) AS net_value FROM items
        WHERE currency = 'USD' AND billed_quantity > 0 AND net_value > 0
          AND billing_date >= DATE '{min(h.start for h in HORIZONS)}' GROUP BY ALL""",
    ),
}
