"""Queries on daily series, trends and transaction blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import AS_OF, ITEMS, items, table
from ledgerline.functions.exact import exact_sum
from ledgerline.functions.dates import date_parts, months_before
from ledgerline.operators.blocks import block_labels, transaction_blocks
from ledgerline.plans.series import series_pre_aggregate
from ledgerline.operators.series import (
    change_intervals,
    daily_series,
    rolling_trend,
    union_of_sets,
)

_KEYS = [
    "product_key", "trade_name", "ean_code", "drug_code",
    "sold_to_key", "bill_to_key", "ship_to_key", "account_key", "affiliate_a1_key", "affiliate_a2_key", "affiliate_a3_key",
    "manufacturer_key", "specialty_flag", "source_flag",
]  # and four parts of the date
_SETS = {"product": "product_key", "sold_to": "sold_to_key", "bill_to": "bill_to_key", "account": "account_key"}
_CUTOFF = months_before(AS_OF, 6)


def pre_aggregate(spark, sf, prune=False):
    """Daily figures by all eighteen columns; codes and affiliates are derived from the keys, some
    are missing, and no customer has an affiliate of the third kind, so pruning takes that away."""
    product, customer = F.col("product_key").cast("long"), F.col("sold_to_key").cast("long")
    keyed = items(spark, sf, products=True, since=_CUTOFF).withColumns(
        {
            "ean_code": F.when(product % 4 != 0, F.concat(F.lit("400"), F.lpad("product_key", 10, "0"))),
            "drug_code": F.when(product % 3 != 0, F.lpad("product_key", 11, "0")),
            "affiliate_a1_key": (customer % 7).cast("string"),
            "affiliate_a2_key": F.when(customer % 2 == 0, (customer % 11).cast("string")),
            "affiliate_a3_key": F.when(customer < 0, F.col("sold_to_key")),
        }
    )
    return series_pre_aggregate(keyed, _KEYS, AS_OF, prune=prune)


def ts_pre_agg(spark, sf):
    daily = pre_aggregate(spark, sf, prune=True)
    return daily.withColumns({f"{n}_set": F.array_join(f"{n}_set", "|") for n in _SETS})


_KEYED = """keyed AS (SELECT *, CASE WHEN CAST(product_key AS BIGINT) % 4 <> 0 THEN '400' || lpad(product_key, 10, '0') END AS ean_code,
    CASE WHEN CAST(product_key AS BIGINT) % 3 <> 0 THEN lpad(product_key, 11, '0') END AS drug_code,
    CAST(CAST(sold_to_key AS BIGINT) % 7 AS VARCHAR) AS affiliate_a1_key,
    CASE WHEN CAST(sold_to_key AS BIGINT) % 2 = 0 THEN CAST(CAST(sold_to_key AS BIGINT) % 11 AS VARCHAR) END AS affiliate_a2_key,
    CAST(NULL AS VARCHAR) AS affiliate_a3_key FROM items)"""

_PRE = f"""{_KEYED}, pre AS (SELECT {', '.join(_KEYS)},
    CAST(year(billing_date) AS INTEGER) AS billing_year, CAST(month(billing_date) AS INTEGER) AS billing_month,
    CAST(weekofyear(billing_date) AS INTEGER) AS billing_weekofyear, CAST(dayofyear(billing_date) AS INTEGER) AS billing_dayofyear,
    billing_date, count(item_key) AS item_count, CAST(sum(CAST(billed_quantity AS DECIMAL(18, 4))) AS DOUBLE) AS billed_quantity,
    CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value
  FROM keyed WHERE billing_date >= DATE '{_CUTOFF}' GROUP BY ALL)"""

_PRE_SQL = f"""WITH {ITEMS}, {_PRE}
SELECT * EXCLUDE (affiliate_a3_key), sales_value / nullif(billed_quantity, 0) AS avg_unit_price,
  {', '.join(f"coalesce({c}, '') AS {n}_set, CAST({c} IS NOT NULL AS INTEGER) AS {n}_count" for n, c in _SETS.items())},
  concat_ws('_||_', {', '.join(f'CAST({k} AS VARCHAR)' for k in _KEYS)}, billing_year, billing_month, billing_weekofyear, billing_dayofyear) AS _group_id
FROM pre"""


def ts_set_union(spark, sf):
    sets = ["sold_to_set", "bill_to_set", "account_set"]
    merged = union_of_sets(pre_aggregate(spark, sf), ["billing_date", "product_key"], sets)
    return merged.select(
        "billing_date", "product_key",
        *[F.array_join(s, "|").alias(s) for s in sets],
        *[F.size(s).alias(f"{s}_size") for s in sets],
    )


def ts_rolling_30_90(spark, sf):
    daily = items(spark, sf).groupBy("product_key", "billing_date").agg(
        exact_sum("sales_value").alias("sales_value")
    )
    return rolling_trend(daily, ["product_key"], "billing_date", "sales_value", scale=4)


def _rolling_sql(daily: str, key: str) -> str:
    w30 = f"(PARTITION BY {key} ORDER BY billing_date RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"
    w90 = f"(PARTITION BY {key} ORDER BY billing_date RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW)"
    past = "total_sales_value_of_past_30_days"

    def mean(c, w):
        return f"CAST(sum(CAST({c} AS DECIMAL(18, 4))) OVER {w} AS DOUBLE) / count({c}) OVER {w}"

    return f"""r1 AS (SELECT *, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) OVER {w30} AS DOUBLE) AS {past},
    {mean('sales_value', w30)} AS rolling_30_day_avg_of_daily_sales_value,
    {mean('sales_value', w90)} AS rolling_90_day_avg_of_daily_sales_value FROM {daily}),
  r2 AS (SELECT *, {mean(past, w30)} AS rolling_30_day_avg_of_{past},
    {mean(past, w90)} AS rolling_90_day_avg_of_{past} FROM r1),
  trend AS (SELECT *, rolling_30_day_avg_of_{past} - rolling_90_day_avg_of_{past} AS absolute_diff_of_30_vs_90_day_rolling_avg_of_{past},
    (rolling_30_day_avg_of_{past} - rolling_90_day_avg_of_{past}) / nullif(abs(rolling_90_day_avg_of_{past}), 0)
      AS percentage_diff_of_30_vs_90_day_rolling_avg_of_{past} FROM r2)"""


_DAILY = "daily AS (SELECT product_key, billing_date, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value FROM items GROUP BY ALL)"


def ts_cumulative_distinct(spark, sf):
    return daily_series(
        items(spark, sf),
        ["manufacturer_key"],
        "billing_date",
        ["sales_value", "billed_quantity"],
        {"product": "product_key", "ship_to": "ship_to_key"},
        cumulative=["product", "ship_to"],
    )


_CUMULATIVE_SQL = f"""WITH {ITEMS},
daily AS (SELECT manufacturer_key, billing_date, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value,
    CAST(sum(CAST(billed_quantity AS DECIMAL(18, 4))) AS DOUBLE) AS billed_quantity, count(DISTINCT product_key) AS product_count,
    count(DISTINCT ship_to_key) AS ship_to_count FROM items GROUP BY ALL),
f1 AS (SELECT manufacturer_key, product_key, min(billing_date) AS billing_date FROM items GROUP BY ALL),
n1 AS (SELECT manufacturer_key, billing_date, count(*) AS n FROM f1 GROUP BY ALL),
f2 AS (SELECT manufacturer_key, ship_to_key, min(billing_date) AS billing_date FROM items WHERE ship_to_key IS NOT NULL GROUP BY ALL),
n2 AS (SELECT manufacturer_key, billing_date, count(*) AS n FROM f2 GROUP BY ALL),
c AS (SELECT daily.*,
    CAST(sum(coalesce(n1.n, 0)) OVER w AS BIGINT) AS cumulative_product_count,
    CAST(sum(coalesce(n2.n, 0)) OVER w AS BIGINT) AS cumulative_ship_to_count
  FROM daily LEFT JOIN n1 USING (manufacturer_key, billing_date) LEFT JOIN n2 USING (manufacturer_key, billing_date)
  WINDOW w AS (PARTITION BY manufacturer_key ORDER BY billing_date))
SELECT *, lag(cumulative_product_count) OVER (PARTITION BY manufacturer_key ORDER BY billing_date) AS lagged_cumulative_product_count,
  lag(cumulative_ship_to_count) OVER (PARTITION BY manufacturer_key ORDER BY billing_date) AS lagged_cumulative_ship_to_count FROM c"""

_PARTITION = ["trade_name", "unit_of_measure"]


def _priced(spark, sf):
    return items(spark, sf, products=True).withColumn(
        "unit_price", F.floor(F.try_divide("sales_value", "billed_quantity") * 10000) / 10000
    )


def _blocks(spark, sf, kind):
    blocks = transaction_blocks(
        _priced(spark, sf), _PARTITION, absolute=1_000_000, exact=True, kinds=[kind]
    )
    return blocks[kind].withColumn("median_unit_price", F.round("median_unit_price", 5))


def txn_blocks_relative(spark, sf):
    return _blocks(spark, sf, "relative")


def txn_blocks_absolute(spark, sf):
    return _blocks(spark, sf, "absolute")


def txn_block_labels(spark, sf):
    return block_labels(_priced(spark, sf), _PARTITION, absolute=1_000_000)


_LABELLED = f"""priced AS (SELECT *, floor(sales_value / nullif(billed_quantity, 0) * 10000) / 10000 AS unit_price FROM items),
c0 AS (SELECT *,
    row_number() OVER (PARTITION BY trade_name, unit_of_measure ORDER BY billing_date, item_key) AS row_rank,
    CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) OVER (PARTITION BY trade_name, unit_of_measure ORDER BY billing_date, item_key
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_total_sales_value,
    CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) OVER (PARTITION BY trade_name, unit_of_measure) AS DOUBLE) AS total_sales_value FROM priced),
c1 AS (SELECT *, cumulative_total_sales_value / nullif(total_sales_value, 0) AS cumulative_total_sales_value_pcntg FROM c0),
c2 AS (SELECT *, CAST(greatest(floor(cumulative_total_sales_value_pcntg / CAST(0.01 AS DOUBLE)), 0) AS BIGINT) AS relative_size_transaction_block_label,
    CAST(greatest(floor(cumulative_total_sales_value / 1000000), 0) AS BIGINT) AS absolute_size_transaction_block_label FROM c1)"""


def _blocks_sql(kind: str) -> str:
    return f"""WITH {ITEMS}, {_LABELLED}
SELECT concat_ws('_||_', trade_name, unit_of_measure, {kind}_size_transaction_block_label) AS {kind}_size_transaction_block_id,
  trade_name, unit_of_measure, min(billing_date) AS earliest_txn_date, max(billing_date) AS latest_txn_date,
  CAST(date_diff('day', min(billing_date), max(billing_date)) AS INTEGER) AS txn_block_duration_in_days,
  count(DISTINCT item_key) AS uniq_txn_count, count(DISTINCT sold_to_key) AS uniq_customer_count,
  count(DISTINCT product_key) AS uniq_product_count, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS total_sales_value,
  CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) / count(sales_value) AS avg_sales_value, min(unit_price) AS min_unit_price,
  round(median(unit_price), 5) AS median_unit_price,
  CAST(sum(CAST(unit_price AS DECIMAL(18, 4))) AS DOUBLE) / count(unit_price) AS avg_unit_price, max(unit_price) AS max_unit_price
FROM c2 GROUP BY trade_name, unit_of_measure, {kind}_size_transaction_block_label"""


def trend_islands(spark, sf):
    daily = items(spark, sf).groupBy("manufacturer_key", "billing_date").agg(
        exact_sum("sales_value").alias("sales_value")
    )
    trend = rolling_trend(daily, ["manufacturer_key"], "billing_date", "sales_value", scale=4)
    change = "percentage_diff_of_30_vs_90_day_rolling_avg_of_total_sales_value_of_past_30_days"
    flagged = trend.withColumn("dropping", F.col(change) < -0.1)
    return change_intervals(flagged, ["manufacturer_key"], "billing_date", "dropping", [change])


_CHANGE = "percentage_diff_of_30_vs_90_day_rolling_avg_of_total_sales_value_of_past_30_days"
_ISLANDS_SQL = f"""WITH {ITEMS}, daily AS (SELECT manufacturer_key, billing_date, CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value FROM items GROUP BY ALL),
{_rolling_sql('daily', 'manufacturer_key')},
s AS (SELECT *, CAST(coalesce({_CHANGE} < -0.1, false) AS INTEGER) AS state FROM trend),
l AS (SELECT *, CAST(state <> lag(state, 1, 0) OVER (PARTITION BY manufacturer_key ORDER BY billing_date) AS INTEGER) AS flip FROM s),
i AS (SELECT *, CAST(sum(flip) OVER (PARTITION BY manufacturer_key ORDER BY billing_date) AS BIGINT) AS interval_number FROM l)
SELECT manufacturer_key, interval_number, max(state) = 1 AS dropping, min(billing_date) AS interval_start,
  max(billing_date) AS interval_end, arg_max({_CHANGE}, billing_date) AS "last_{_CHANGE}"
FROM i GROUP BY ALL"""


def date_functions(spark, sf):
    from ledgerline.functions.dates import month_difference

    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    shipped, ordered = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    return lines.groupBy(
        *[c.alias(n) for n, c in date_parts(shipped, "ship").items()],
        month_difference(shipped, ordered).alias("month_gap"),
    ).agg(F.count("*").alias("item_count"), F.sum(F.datediff(shipped, ordered)).alias("day_gap"))


QUERIES = {
    "ts_pre_agg": (ts_pre_agg, _PRE_SQL),
    "ts_set_union": (
        ts_set_union,
        f"""WITH {ITEMS}, {_PRE}, t AS (SELECT billing_date, product_key,
            list_sort(list(DISTINCT sold_to_key)) AS a, list_sort(list(DISTINCT bill_to_key)) AS b, list_sort(list(DISTINCT account_key)) AS c
          FROM pre GROUP BY ALL)
        SELECT billing_date, product_key, array_to_string(a, '|') AS sold_to_set, array_to_string(b, '|') AS bill_to_set,
          array_to_string(c, '|') AS account_set, CAST(len(a) AS INTEGER) AS sold_to_set_size,
          CAST(len(b) AS INTEGER) AS bill_to_set_size, CAST(len(c) AS INTEGER) AS account_set_size FROM t""",
    ),
    "ts_rolling_30_90": (
        ts_rolling_30_90,
        f"WITH {ITEMS}, {_DAILY}, {_rolling_sql('daily', 'product_key')} SELECT * FROM trend",
    ),
    "ts_cumulative_distinct": (ts_cumulative_distinct, _CUMULATIVE_SQL),
    "txn_blocks_relative": (txn_blocks_relative, _blocks_sql("relative")),
    "txn_blocks_absolute": (txn_blocks_absolute, _blocks_sql("absolute")),
    "txn_block_labels": (
        txn_block_labels,
        f"""WITH {ITEMS}, {_LABELLED} SELECT trade_name, unit_of_measure, item_key, billing_date, cumulative_total_sales_value,
          total_sales_value, cumulative_total_sales_value_pcntg, relative_size_transaction_block_label,
          absolute_size_transaction_block_label, count(*) AS items, max(row_rank) AS row_rank,
          concat_ws('_||_', trade_name, unit_of_measure, relative_size_transaction_block_label) AS relative_size_transaction_block_id,
          concat_ws('_||_', trade_name, unit_of_measure, absolute_size_transaction_block_label) AS absolute_size_transaction_block_id
        FROM c2 GROUP BY ALL""",
    ),
    "trend_islands": (trend_islands, _ISLANDS_SQL),
    "date_functions": (
        date_functions,
        """SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(month(l_shipdate) AS INTEGER) AS ship_month,
          CAST(weekofyear(l_shipdate) AS INTEGER) AS ship_weekofyear, CAST(dayofyear(l_shipdate) AS INTEGER) AS ship_dayofyear,
          CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS INTEGER) AS month_gap,
          count(*) AS item_count, CAST(sum(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS BIGINT) AS day_gap
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    ),
}
