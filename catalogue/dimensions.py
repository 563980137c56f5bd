"""Queries on dimensions and the time series of every level."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.facts import PARTNERS, RELATIONS, customers_of, relations_of
from catalogue.tables import AS_OF, HORIZONS, ITEMS, compared, items, ranked_rfm_sql, spec, table
from catalogue.time import _rolling_sql, pre_aggregate
from ledgerline.functions.dates import months_before
from ledgerline.operators.rfm import label_sets, InvoiceColumns
from ledgerline.operators.sets import union_by_name
from ledgerline.plans.dimensions import (
    affiliations,
    area_metrics,
    customer_accounts,
    customers,
    partner_tables,
    plant_products,
    product_rollup,
    products,
    tidy_passthrough,
    vendors,
)
from ledgerline.plans.series import LEVELS, UNUSED_LEVELS, row_filters, series_metrics

_H = list(HORIZONS)
_SPEC = dict(horizons=_H)


def _without_ids(df):
    return compared(df.drop(*[c for c in df.columns if c.endswith("time_series_id")]))


def _customer_base(spark, sf):
    """Customers with the attributes a master record has, derived from the given ones."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("primary_key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("class_key"),
        F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("region"),
        F.concat_ws("-", (F.col("c_nationkey") + 10000).cast("string"), F.col("c_custkey").cast("string")).alias("postal_code"),
        F.when(F.col("c_acctbal") < -500, "X").alias("deletion_flag"),
    )


def _customer_dimension(spark, sf):
    nation = table(spark, sf, "nation")
    classes = (
        table(spark, sf, "customer").select(F.col("c_mktsegment").alias("primary_key")).distinct()
        .withColumn("class_description", F.initcap("primary_key"))
    )
    states = nation.select(
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("state_code"),
        F.concat(F.lit("geo-"), F.col("n_name")).alias("state_geo_id"),
    )
    zips = nation.select(
        F.concat(F.lit("geo-"), F.col("n_name"), F.lit("_||_"), (F.col("n_nationkey") + 10000).cast("string")).alias("zip_code_geo_id"),
        F.concat_ws(",", F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")).alias("zip_centroid"),
    )
    territories = (
        table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("primary_key"))
        .agg(F.min("o_orderpriority").alias("territory"))
    )
    return customers(
        _customer_base(spark, sf), classes, states, zips, territories, relations_of(spark, sf),
        items(spark, sf), spec(**_SPEC), sentinel="0", ranks=True,
    )


def customer_dimension(spark, sf):
    return _without_ids(_customer_dimension(spark, sf))


_CUSTOMER_CTE = f"""{RELATIONS}, {PARTNERS},
m1 AS ({ranked_rfm_sql('sold_to_key', 'customer', _H)}),
m2 AS ({ranked_rfm_sql("coalesce(ship_to_key, '')", 'customer_shipto', _H)}),
m3 AS ({ranked_rfm_sql('bill_to_key', 'customer_billto', _H)}),
dim AS (SELECT CAST(c_custkey AS VARCHAR) AS primary_key, c_name AS name, c_mktsegment AS class_key, 'R' || c_nationkey AS region,
  (c_nationkey + 10000) || '-' || c_custkey AS postal_code, CAST(NULL AS VARCHAR) AS deletion_flag,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS class_description, 'R' || c_nationkey AS state_code,
  CAST(c_nationkey + 10000 AS VARCHAR) AS zip_code, 'geo-' || n_name AS state_geo_id,
  'geo-' || n_name || '_||_' || (c_nationkey + 10000) AS zip_code_geo_id, n_nationkey || ',' || n_regionkey AS zip_centroid,
  t.territory, p.* EXCLUDE (primary_key), m1.* EXCLUDE (primary_key), m2.* EXCLUDE (primary_key), m3.* EXCLUDE (primary_key)
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS territory FROM orders GROUP BY 1) t ON t.o_custkey = c_custkey
LEFT JOIN partners p ON p.primary_key = CAST(c_custkey AS VARCHAR)
LEFT JOIN m1 ON m1.primary_key = CAST(c_custkey AS VARCHAR)
LEFT JOIN m2 ON m2.primary_key = CAST(c_custkey AS VARCHAR)
LEFT JOIN m3 ON m3.primary_key = CAST(c_custkey AS VARCHAR)
WHERE c_acctbal >= -500)"""


def account_dimension(spark, sf):
    accounts = table(spark, sf, "orders").select(
        F.concat_ws("_|_", F.col("o_custkey").cast("string"), "o_orderstatus").alias("primary_key"),
        F.col("o_custkey").cast("string").alias("customer_key"),
        F.col("o_orderstatus").alias("trade_class"),
        F.lit(None).cast("string").alias("deletion_flag"),
    ).distinct()
    classes = (
        table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("trade_class"))
        .agg(F.count("*").alias("class_orders"))
    )
    dimension = customer_accounts(
        accounts, customer_dimension(spark, sf), classes, items(spark, sf), spec(**_SPEC), ranks=True
    )
    return _without_ids(dimension)


_ACCOUNT_SQL = f"""WITH {ITEMS}, {_CUSTOMER_CTE},
a1 AS ({ranked_rfm_sql('account_key', 'customer_account', _H)}), a2 AS ({ranked_rfm_sql('payer_account_key', 'customer_account_billto', _H)}),
acc AS (SELECT DISTINCT concat_ws('_|_', o_custkey, o_orderstatus) AS primary_key, CAST(o_custkey AS VARCHAR) AS customer_key,
  o_orderstatus AS trade_class, CAST(NULL AS VARCHAR) AS deletion_flag FROM orders)
SELECT acc.*, class_orders, dim.* EXCLUDE (primary_key, deletion_flag), a1.* EXCLUDE (primary_key), a2.* EXCLUDE (primary_key)
FROM acc LEFT JOIN dim ON dim.primary_key = acc.customer_key
LEFT JOIN (SELECT o_orderstatus, count(*) AS class_orders FROM orders GROUP BY 1) c ON c.o_orderstatus = trade_class
LEFT JOIN a1 ON a1.primary_key = acc.primary_key LEFT JOIN a2 ON a2.primary_key = acc.primary_key"""


def partner_function_tables(spark, sf):
    tables = partner_tables(relations_of(spark, sf))
    return union_by_name([df.withColumn("output", F.lit(name)) for name, df in tables.items()])


def affiliation_metrics(spark, sf):
    """Customers as others' affiliation A3: items carry the smallest A3 partner of their customer."""
    dimension = customers_of(spark, sf)
    partner = (
        relations_of(spark, sf).filter("role = 'A3'").groupBy("customer_key")
        .agg(F.min("partner_key").alias("affiliation_key"))
    )
    affiliated = items(spark, sf).join(partner, F.col("sold_to_key") == F.col("customer_key"), "left")
    return _without_ids(
        affiliations(dimension, affiliated, "A3", "affiliation_key", spec(**_SPEC), ranks=True)
    )


_AFFILIATION_SQL = f"""WITH {ITEMS}, {RELATIONS},
p AS (SELECT customer_key, min(partner_key) AS affiliation_key FROM relations WHERE role = 'A3' GROUP BY 1),
src AS (SELECT * FROM items LEFT JOIN p ON sold_to_key = customer_key),
m AS ({ranked_rfm_sql("coalesce(affiliation_key, '')", 'customer_affiliation__A3', _H, source='src')})
SELECT c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, m.*
FROM customer JOIN m ON m.primary_key = CAST(c_custkey AS VARCHAR)
WHERE customer_affiliation__A3_has_billing_documents_since_{_H[0].alias} IS NOT NULL"""


def _product_base(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("primary_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("trade_name"),
        F.col("p_type").alias("generic_name"),
        F.col("p_size").cast("string").alias("drug_code"),
        F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("material_number"),
        F.concat(F.col("p_size").cast("string"), F.lit("X10 EA")).alias("size_text"),
        F.col("p_size").alias("pack_size"),
        F.lit(None).cast("int").alias("pack_quantity"),
        F.when(F.col("p_size") > 30, "TB").otherwise("CP").alias("form"),
        F.col("p_type").alias("product_group"),
    )


def _product_dimension(spark, sf):
    base = _product_base(spark, sf)
    master = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("primary_key"),
        F.col("p_brand").alias("trade_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
    )
    return products(
        base, master, items(spark, sf), spec(**_SPEC), {"material_number": "product_number"},
        ["brand#1", "brand#20"], prune=False,
    )


def product_dimension(spark, sf):
    df = _without_ids(_product_dimension(spark, sf))
    return df.withColumns({c: F.array_join(c, "|") for c in ("spd_labels", "source_labels")})


_LABELS = """labels AS (SELECT product_key AS primary_key,
    concat_ws('|', CASE WHEN bool_or(NOT specialty_flag) THEN 'NON-SPD' END, CASE WHEN bool_or(specialty_flag) THEN 'SPD' END) AS spd_labels,
    concat_ws('|', CASE WHEN bool_or(NOT source_flag) THEN 'NON-SOURCE' END, CASE WHEN bool_or(source_flag) THEN 'SOURCE' END) AS source_labels,
    CAST(bool_or(NOT specialty_flag) AS INTEGER) + CAST(bool_or(specialty_flag) AS INTEGER) AS spd_labels_count,
    CAST(bool_or(NOT source_flag) AS INTEGER) + CAST(bool_or(source_flag) AS INTEGER) AS source_labels_count
  FROM items GROUP BY 1)"""

_PRODUCT_SQL = f"""WITH {ITEMS}, {_LABELS}, m AS ({ranked_rfm_sql('product_key', 'product', _H)})
SELECT CAST(p_partkey AS VARCHAR) AS primary_key, p_name AS product_name, p_brand AS trade_name, p_type AS generic_name,
  CAST(p_size AS VARCHAR) AS drug_code, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS material_number, p_size || 'X10 EA' AS size_text,
  p_size AS pack_size, CAST(NULL AS INTEGER) AS pack_quantity, CASE WHEN p_size > 30 THEN 'TB' ELSE 'CP' END AS form,
  p_type AS product_group, CAST(round(p_retailprice, 2) AS DOUBLE) AS list_price, CAST(p_size * 10 AS DOUBLE) AS corrected_pack_qty,
  CASE WHEN p_partkey > 0 THEN CAST(p_partkey AS VARCHAR) END AS product_number,
  labels.* EXCLUDE (primary_key), m.* EXCLUDE (primary_key),
  contains(upper(p_brand), 'BRAND#1') OR contains(upper(p_brand), 'BRAND#20') AS is_exclusive
FROM part LEFT JOIN labels ON labels.primary_key = CAST(p_partkey AS VARCHAR) LEFT JOIN m ON m.primary_key = CAST(p_partkey AS VARCHAR)"""


def _rollup(spark, sf, attribute):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_key"), F.col("p_size").cast("string").alias("drug_code")
    )
    source = items(spark, sf, products=True).join(part, "product_key")
    labels = label_sets(source, ["product_key"], InvoiceColumns())
    dimension = _product_base(spark, sf).join(labels, "primary_key", "left")
    rolled = product_rollup(
        dimension, source, attribute, attribute, spec(**_SPEC), ranks=True,
        lists={"product_key": "primary_key", "trade_name": "trade_name", "form": "form"},
        first={"first_group": "product_group"},
    )
    lists = ("product_key_list", "trade_name_list", "form_list", "spd_labels", "source_labels")
    return _without_ids(rolled).withColumns({c: F.array_join(c, "|") for c in lists})


def generic_name_rollup(spark, sf):
    return _rollup(spark, sf, "generic_name")


def trade_name_rollup(spark, sf):
    return _rollup(spark, sf, "trade_name")


def drug_code_rollup(spark, sf):
    return _rollup(spark, sf, "drug_code")


def _rollup_sql(attribute: str, column: str) -> str:
    return f"""WITH {ITEMS}, src AS (SELECT items.*, CAST(p_size AS VARCHAR) AS drug_code FROM items JOIN part ON CAST(p_partkey AS VARCHAR) = product_key),
m AS ({ranked_rfm_sql(attribute, attribute, _H, source='src')}),
f AS (SELECT product_key, specialty_flag, source_flag FROM items),
r AS (SELECT CAST({column} AS VARCHAR) AS primary_key, min(p_type) AS first_group,
  array_to_string(list_sort(list(DISTINCT CAST(p_partkey AS VARCHAR))), '|') AS product_key_list,
  array_to_string(list_sort(list(DISTINCT p_brand)), '|') AS trade_name_list,
  array_to_string(list_sort(list(DISTINCT CASE WHEN p_size > 30 THEN 'TB' ELSE 'CP' END)), '|') AS form_list,
  CAST(count(DISTINCT p_partkey) AS INTEGER) AS product_key_count, CAST(count(DISTINCT p_brand) AS INTEGER) AS trade_name_count,
  CAST(count(DISTINCT p_size > 30) AS INTEGER) AS form_count,
  bool_or(specialty_flag) AS s1, bool_or(NOT specialty_flag) AS s0, bool_or(source_flag) AS o1, bool_or(NOT source_flag) AS o0
  FROM part LEFT JOIN f ON f.product_key = CAST(p_partkey AS VARCHAR) GROUP BY 1)
SELECT r.* EXCLUDE (s1, s0, o1, o0),
  concat_ws('|', CASE WHEN s0 THEN 'NON-SPD' END, CASE WHEN s1 THEN 'SPD' END) AS spd_labels,
  concat_ws('|', CASE WHEN o0 THEN 'NON-SOURCE' END, CASE WHEN o1 THEN 'SOURCE' END) AS source_labels,
  CAST(s0 AS INTEGER) + CAST(s1 AS INTEGER) AS spd_labels_count, CAST(o0 AS INTEGER) + CAST(o1 AS INTEGER) AS source_labels_count,
  m.* EXCLUDE (primary_key) FROM r LEFT JOIN m ON m.primary_key = r.primary_key"""


def vendor_dimension(spark, sf):
    base = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("primary_key"),
        F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("vendor_code"),
        F.col("s_name").alias("name"),
    )
    return _without_ids(vendors(base, items(spark, sf), spec(**_SPEC), ranks=True))


def plant_product_flags(spark, sf):
    """Plant and product combinations; a column without values is dropped, then columns are ordered."""
    base = items(spark, sf).select("plant_key", "product_key", "ship_to_key").distinct()
    return plant_products(base.withColumn("unused", F.lit(None).cast("string")), "plant_key", ["3", "7", "11"])


def plant_passthrough(spark, sf):
    nation = table(spark, sf, "nation")
    return tidy_passthrough(
        nation.withColumns(
            {"blank": F.lit(None).cast("string"), "big_region": F.when(F.col("n_regionkey") > 2, F.col("n_regionkey"))}
        )
    )


def _areas(spark, sf):
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_key"),
        F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("state_code"),
        (F.col("c_nationkey") + 10000).cast("string").alias("zip_code"),
    )
    billed = items(spark, sf).join(customer, F.col("sold_to_key") == F.col("customer_key"))
    return nation, billed


def state_metrics(spark, sf):
    nation, billed = _areas(spark, sf)
    states = nation.select(
        F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("state_code"),
        F.concat(F.lit("geo-"), F.col("n_name")).alias("state_geo_id"),
    )
    return _without_ids(
        area_metrics(states, billed, "state_code", "state_geo_id", "state", spec(**_SPEC), ranks=True)
    )


def zip_metrics(spark, sf):
    nation, billed = _areas(spark, sf)
    zips = nation.select(
        (F.col("n_nationkey") + 10000).cast("string").alias("zip_code"),
        F.concat(F.lit("zip-"), F.col("n_name")).alias("zip_code_geo_id"),
    )
    return _without_ids(
        area_metrics(zips, billed, "zip_code", "zip_code_geo_id", "zip_code", spec(**_SPEC), ranks=True)
    )


def _area_sql(code: str, geo: str, name: str, value: str, geo_value: str) -> str:
    return f"""WITH {ITEMS}, src AS (SELECT items.*, {value.replace('n_nationkey', 'c_nationkey')} AS {code}
  FROM items JOIN customer ON CAST(c_custkey AS VARCHAR) = sold_to_key),
m AS ({ranked_rfm_sql(code, name, _H, source='src')})
SELECT {geo_value} AS primary_key, {value} AS {code}, m.* EXCLUDE (primary_key)
FROM nation LEFT JOIN m ON m.primary_key = {value}"""


_LEVELS = {l.group_type: l for l in (*LEVELS, *UNUSED_LEVELS)}
_COLUMNS = {"product": "product_key", "sold_to": "sold_to_key", "bill_to": "bill_to_key", "account": "account_key"}


def _series(level_name: str, filter_id: str):
    level = _LEVELS[level_name]

    def build(spark, sf):
        daily = pre_aggregate(spark, sf, prune=True)
        return series_metrics(daily, level, filter_id, row_filters()[filter_id], scale=4)

    condition = {"all": "true", "pd_only": "NOT specialty_flag", "spd_only": "specialty_flag"}[filter_id]
    keys = ", ".join(level.keys)
    same = " AND ".join(f"x.{k} IS NOT DISTINCT FROM d.{k}" for k in level.keys)
    counts = ", ".join(f"count(DISTINCT {_COLUMNS[m]}) AS {m}_count" for m in level.members)
    firsts = "".join(
        f""", f_{m} AS (SELECT {keys}, {_COLUMNS[m]} AS member, min(billing_date) AS billing_date FROM src
              WHERE {_COLUMNS[m]} IS NOT NULL GROUP BY ALL),
            n_{m} AS (SELECT {keys}, billing_date, count(*) AS n FROM f_{m} GROUP BY ALL)"""
        for m in level.cumulative
    )
    over = f"(PARTITION BY {keys} ORDER BY billing_date)"
    fresh = "".join(
        f", coalesce((SELECT n FROM n_{m} x WHERE {same} AND x.billing_date = d.billing_date), 0) AS new_{m}"
        for m in level.cumulative
    )
    running = "".join(
        f", CAST(sum(new_{m}) OVER {over} AS BIGINT) AS cumulative_{m}_count" for m in level.cumulative
    )
    lagged = "".join(
        f", lag(cumulative_{m}_count) OVER {over} AS lagged_cumulative_{m}_count" for m in level.cumulative
    )
    dropped = ", ".join(["billing_date", *[f"new_{m}" for m in level.cumulative]])
    sql = f"""WITH {ITEMS}, src AS (SELECT * FROM items WHERE billing_date >= DATE '{months_before(AS_OF, 6)}' AND {condition}),
d AS (SELECT {keys}, billing_date, count(*) AS item_count, CAST(sum(CAST(billed_quantity AS DECIMAL(18, 4))) AS DOUBLE) AS billed_quantity,
  CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value, {counts} FROM src GROUP BY {keys}, billing_date){firsts},
e AS (SELECT d.*{fresh} FROM d), c AS (SELECT *{running} FROM e), c2 AS (SELECT *{lagged} FROM c),
{_rolling_sql('c2', keys)},
o AS (SELECT * EXCLUDE ({dropped}), CAST(billing_date AS TIMESTAMP) AS billing_date,
  sales_value / nullif(billed_quantity, 0) AS avg_unit_price, concat_ws('_||_', {keys}) AS _group_id,
  '{level.group_type}' AS _group_type_id, '{filter_id}' AS _filter_id FROM trend)
SELECT *, _group_type_id || '_||_' || _filter_id || '_||_' || _group_id AS _time_series_group_id,
  CAST(billing_date AS VARCHAR) || '_||_' || _group_type_id || '_||_' || _filter_id || '_||_' || _group_id AS primary_key FROM o"""
    return build, sql


QUERIES = {
    "customer_dimension": (customer_dimension, f"WITH {ITEMS}, {_CUSTOMER_CTE} SELECT * FROM dim"),
    "customer_account_dimension": (account_dimension, _ACCOUNT_SQL),
    "partner_function_tables": (
        partner_function_tables,
        f"WITH {RELATIONS} SELECT DISTINCT *, role AS output FROM relations WHERE role IN ('A1', 'A2', 'A3', 'AL')",
    ),
    "affiliation_metrics": (affiliation_metrics, _AFFILIATION_SQL),
    "product_dimension": (product_dimension, _PRODUCT_SQL),
    "generic_name_rollup": (generic_name_rollup, _rollup_sql("generic_name", "p_type")),
    "trade_name_rollup": (trade_name_rollup, _rollup_sql("trade_name", "p_brand")),
    "drug_code_rollup": (drug_code_rollup, _rollup_sql("drug_code", "p_size")),
    "vendor_dimension": (
        vendor_dimension,
        f"""WITH {ITEMS}, m AS ({ranked_rfm_sql('manufacturer_key', 'manufacturer', _H)})
        SELECT CAST(s_suppkey AS VARCHAR) AS primary_key, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS vendor_code, s_name AS name,
          CAST(s_suppkey AS VARCHAR) AS vendor_number, s_name || ' (' || s_suppkey || ')' AS title, m.* EXCLUDE (primary_key)
        FROM supplier LEFT JOIN m ON m.primary_key = CAST(s_suppkey AS VARCHAR)""",
    ),
    "plant_product_flags": (
        plant_product_flags,
        f"WITH {ITEMS} SELECT DISTINCT plant_key, product_key, ship_to_key, plant_key IN ('3', '7', '11') AS specialty_flag FROM items",
    ),
    "plant_passthrough": (
        plant_passthrough,
        "SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_regionkey > 2 THEN n_regionkey END AS big_region FROM nation",
    ),
    "state_metrics": (
        state_metrics, _area_sql("state_code", "state_geo_id", "state", "'R' || n_nationkey", "'geo-' || n_name")
    ),
    "zip_metrics": (
        zip_metrics,
        _area_sql("zip_code", "zip_code_geo_id", "zip_code", "CAST(n_nationkey + 10000 AS VARCHAR)", "'zip-' || n_name"),
    ),
    **{
        f"series_{level}__{name}": _series(level, name)
        for level in _LEVELS
        for name in _LEVELS[level].filters
    },
}
