"""The given tables seen as invoice data, once for Spark and once as SQL.

The reference day and the horizon starts are fixed inside the tables' date range, so results
do not depend on the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.keys import KEY_DELIMITER
from ledgerline.operators.rfm import RfmSpec, default_horizons

AS_OF = dt.date(2001, 11, 5)
STARTS = ("2000-01-01", "2001-01-01")
HORIZONS = default_horizons(AS_OF, STARTS)


def spec(exact: bool = True, horizons=None) -> RfmSpec:
    return RfmSpec(AS_OF, horizons or HORIZONS, exact=exact)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(
    spark: SparkSession, sf_dir: str, products: bool = False, since: dt.date | None = None
) -> DataFrame:
    """Invoice items: one row per line item with every role, date, measure and flag.

    Ship-to is unknown for urgent orders, and some returns carry a negative value.  ``since``
    compares the stored time stamp itself, so that the scan skips row groups.
    """
    lines = table(spark, sf_dir, "lineitem")
    if since is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(str(since)).cast("timestamp_ntz"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if products:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
        joined = joined.join(part, joined.l_partkey == part.p_partkey, "left")
    customer, payer = F.col("o_custkey"), F.col("o_custkey") - F.col("o_custkey") % 3
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    returned = (
        (F.col("l_linestatus") == "O")
        & (F.col("l_returnflag") == "R")
        & (F.col("o_orderstatus") == "P")
    )
    columns = {
        "item_key": F.concat_ws(KEY_DELIMITER, "l_orderkey", "l_linenumber"),
        "header_key": F.col("l_orderkey").cast("string"),
        "product_key": F.col("l_partkey").cast("string"),
        "sold_to_key": customer.cast("string"),
        "bill_to_key": payer.cast("string"),
        "ship_to_key": F.when(
            F.col("o_orderpriority") != "1-URGENT", (customer - customer % 5).cast("string")
        ),
        "account_key": F.concat_ws(KEY_DELIMITER, customer.cast("string"), "o_orderstatus"),
        "payer_account_key": F.concat_ws(KEY_DELIMITER, payer.cast("string"), "o_orderstatus"),
        "manufacturer_key": F.col("l_suppkey").cast("string"),
        "plant_key": (F.col("l_suppkey") % 25).cast("string"),
        "billing_date": F.col("l_shipdate").cast("date"),
        "currency": F.when(F.col("o_orderpriority") == "5-LOW", "EUR").otherwise("USD"),
        "billed_quantity": F.col("l_quantity"),
        "net_value": net,
        "sales_value": net * F.when(returned, -1).otherwise(1),
        "specialty_flag": F.col("l_returnflag") == "R",
        "source_flag": F.col("l_linestatus") == "F",
    }
    if products:
        columns |= {
            "trade_name": F.col("p_brand"),
            "generic_name": F.col("p_type"),
            "unit_of_measure": F.when(F.col("p_size") <= 25, "EA").otherwise("BX"),
        }
    return joined.select([c.alias(name) for name, c in columns.items()])


ITEMS = """items AS (
  SELECT concat_ws('_|_', l_orderkey, l_linenumber) AS item_key,
         CAST(l_orderkey AS VARCHAR) AS header_key,
         CAST(l_partkey AS VARCHAR) AS product_key,
         CAST(o_custkey AS VARCHAR) AS sold_to_key,
         CAST(o_custkey - o_custkey % 3 AS VARCHAR) AS bill_to_key,
         CASE WHEN o_orderpriority <> '1-URGENT'
              THEN CAST(o_custkey - o_custkey % 5 AS VARCHAR) END AS ship_to_key,
         concat_ws('_|_', o_custkey, o_orderstatus) AS account_key,
         concat_ws('_|_', o_custkey - o_custkey % 3, o_orderstatus) AS payer_account_key,
         CAST(l_suppkey AS VARCHAR) AS manufacturer_key,
         CAST(l_suppkey % 25 AS VARCHAR) AS plant_key,
         CAST(l_shipdate AS DATE) AS billing_date,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'EUR' ELSE 'USD' END AS currency,
         l_quantity AS billed_quantity,
         round(l_extendedprice * (1 - l_discount), 4) AS net_value,
         round(l_extendedprice * (1 - l_discount), 4)
           * CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' AND o_orderstatus = 'P'
                  THEN -1 ELSE 1 END AS sales_value,
         l_returnflag = 'R' AS specialty_flag,
         l_linestatus = 'F' AS source_flag,
         p_brand AS trade_name, p_type AS generic_name,
         CASE WHEN p_size <= 25 THEN 'EA' ELSE 'BX' END AS unit_of_measure
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey)"""


def rfm_sql(group: str, name: str, horizons=None, source: str = "items", keep: str = "") -> str:
    """The SQL counterpart of the RFM operator, written per horizon with FILTER clauses."""
    horizons = horizons or HORIZONS
    as_of = f"DATE '{AS_OF}'"
    inner, outer = [], []
    for i, h in enumerate(horizons):
        where = f"FILTER (WHERE billing_date >= DATE '{h.start}')"
        inner += [
            f"min(billing_date) {where} AS f{i}",
            f"max(billing_date) {where} AS l{i}",
            f"nullif(count(*) {where}, 0) AS n{i}",
            f"CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) {where} AS DOUBLE) AS v{i}",
            f"CAST(sum(CAST(CASE WHEN specialty_flag THEN sales_value ELSE 0 END AS DECIMAL(18, 4))) {where} AS DOUBLE) AS s{i}",
            f"CAST(sum(CAST(billed_quantity AS DECIMAL(18, 4))) {where} AS DOUBLE) AS u{i}",
            *[
                f"count(DISTINCT {c}) {where} AS c{i}_{j}"
                for j, c in enumerate(
                    ("item_key", "header_key", "billing_date", "product_key", "sold_to_key")
                )
            ],
        ]

        def out(metric):
            return f"{name}_{metric}_since_{h.alias}"

        def count(j):
            return f"CASE WHEN n{i} IS NOT NULL THEN c{i}_{j} END"

        age = f"date_diff('day', f{i}, {as_of})"
        outer += [
            f"CAST({age} AS INTEGER) AS {out('age_in_days')}",
            f"CAST(date_diff('day', f{i}, l{i}) AS INTEGER) AS {out('recency_in_days')}",
            f"CAST(date_diff('day', l{i}, {as_of}) AS INTEGER) AS {out('days_since_last_order')}",
            *[
                f"{count(j)} AS {out(m)}"
                for j, m in enumerate(
                    (
                        "order_count",
                        "order_header_count",
                        "unique_order_date_count",
                        "unique_product_count",
                        "unique_sold_to_customer_count",
                    )
                )
            ],
            f"v{i} AS {out('total_order_value')}",
            f"s{i} AS {out('total_order_value_specialty_only')}",
            f"u{i} AS {out('total_units_billed')}",
            f"v{i} / nullif(c{i}_0, 0) AS {out('avg_order_value')}",
            f"v{i} / nullif({age}, 0) AS {out('total_order_value_per_day')}",
            f"v{i} / nullif(c{i}_2, 0) AS {out('avg_order_value_per_order_date')}",
            f"v{i} / nullif(c{i}_1, 0) AS {out('avg_order_value_per_order_header')}",
            f"CASE WHEN n{i} IS NOT NULL THEN {age} > 5 END AS {out('has_billing_documents')}",
        ]
    first = min(h.start for h in horizons)
    return f"""SELECT primary_key{keep}, {', '.join(outer)}
FROM (SELECT {group} AS primary_key, {', '.join(inner)}
      FROM {source}
      WHERE currency = 'USD' AND billed_quantity > 0 AND net_value > 0
        AND billing_date >= DATE '{first}'
      GROUP BY 1) g"""


RANKED = ("order_count", "total_order_value", "total_order_value_per_day")
# sums of a ratio have no exact value to compare; its rank has
UNSUMMED = RANKED[2:]


def ranked_rfm_sql(group: str, name: str, horizons=None, source: str = "items") -> str:
    """The metrics with rank, running sum, total and shares of the ranked ones."""
    out = []
    for h in horizons or HORIZONS:
        number = f"{name}_order_count_since_{h.alias}"
        for m in RANKED:
            c = f"{name}_{m}_since_{h.alias}"
            place = f"({number} IS NULL), {c} DESC NULLS LAST"
            shown = "CASE WHEN {0} IS NOT NULL THEN {1} END AS {2}_{3}"
            out.append(
                shown.format(number, f"row_number() OVER (ORDER BY {place}, primary_key NULLS FIRST)", "rank_of", c)
            )
            if m in UNSUMMED:
                continue
            run = f"CAST(sum(CAST({c} AS DECIMAL(18, 4))) OVER (ORDER BY {place}) AS DOUBLE)"
            total = f"CAST(sum(CAST({c} AS DECIMAL(18, 4))) OVER () AS DOUBLE)"
            out += [
                shown.format(number, run, "cumulative_sum_of", c),
                shown.format(number, total, "total", c),
                f"{c} / nullif({total}, 0) AS pcntg_of_total_{c}",
                shown.format(number, f"{run} / nullif({total}, 0)", "cumulative_sum_of_pcntg_of_total", c),
            ]
    return f"SELECT g.*, {', '.join(out)} FROM ({rfm_sql(group, name, horizons, source)}) g"


def compared(df: DataFrame) -> DataFrame:
    """Without running sums and totals of ratios."""
    prefixes = ("cumulative_sum_of_", "total_", "pcntg_of_total_")
    ratio = [f"_{m}_since_" for m in UNSUMMED]
    return df.drop(*[c for c in df.columns if c.startswith(prefixes) and any(r in c for r in ratio) and not c.startswith("rank_of_")])
