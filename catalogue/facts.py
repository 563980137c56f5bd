"""Queries on facts: star joins, business rules, sales items, pairs and join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import AS_OF, HORIZONS, ITEMS, items, rfm_sql, spec, table
from ledgerline.functions.exact import exact_sum
from ledgerline.functions.dates import months_before
from ledgerline.functions.keys import foreign_key, pair_key, primary_key
from ledgerline.operators.filters import filled, genuine_relations, is_member, is_subset, members
from ledgerline.operators.joins import (
    Dimension,
    attach_totals,
    containment_flag,
    enrich,
    membership_flag,
    merge_metric_sets,
    null_safe_left_join,
    partner_columns,
    subset_pairs,
)
from ledgerline.operators.rfm import rfm_metrics
from ledgerline.operators.rollups import attribute_rollup, entity_pairs
from ledgerline.plans.facts import (
    InvoiceRules,
    contract_filter_view,
    enriched_invoices,
    invoice_title,
    raw_invoices,
    sales_items,
)
from ledgerline.plans.series import customer_pairs

ROLES = ["sold_to_key", "bill_to_key", "ship_to_key"]
_FACT_FROM = months_before(AS_OF, 25)


def customers_of(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("primary_key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
    )


def products_of(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("primary_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_size").alias("pack_size"),
        F.col("p_retailprice").alias("list_price"),
    )


def fact_star_enrich(spark, sf):
    vendors = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("primary_key"), F.col("s_name").alias("name")
    )
    plants = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("primary_key"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region"),
    )
    customers = customers_of(spark, sf)
    dimensions = [
        Dimension(customers, "primary_key", "ship_to_key", {"ship_to_name": "name", "ship_to_type": "segment"}),
        Dimension(customers, "primary_key", "sold_to_key", {"sold_to_name": "name", "sold_to_nation": "nation"}),
        Dimension(vendors, "primary_key", "manufacturer_key", {"manufacturer_name": "name"}),
        Dimension(plants, "primary_key", "plant_key", {"plant_name": "name", "plant_region": "region"}),
        Dimension(
            products_of(spark, sf), "primary_key", "product_key",
            {"product_name": "product_name", "pack_size": "pack_size"},
        ),
    ]
    fact = enriched_invoices(
        items(spark, sf, products=True, since=_FACT_FROM),
        dimensions,
        AS_OF,
        title=invoice_title("header_key", "item_key", "ship_to_key", "billing_date"),
    )
    return fact.drop("unit_of_measure")


_FACT_SQL = f"""WITH {ITEMS}
SELECT i.* EXCLUDE (unit_of_measure), s.c_name AS ship_to_name, s.c_mktsegment AS ship_to_type, b.c_name AS sold_to_name,
  CAST(b.c_nationkey AS VARCHAR) AS sold_to_nation, s_name AS manufacturer_name, n_name AS plant_name,
  CAST(n_regionkey AS VARCHAR) AS plant_region, p_name AS product_name, p_size AS pack_size,
  sales_value / nullif(billed_quantity, 0) AS unit_price,
  {', '.join(f"concat_ws('_||_', {r}, {m}) AS customer_{n}_{k}_pair_foreign_key" for m, k in (('product_key', 'product'), ('trade_name', 'trade_name')) for r, n in (('sold_to_key', 'soldto'), ('bill_to_key', 'billto'), ('ship_to_key', 'shipto')))},
  'Invoice: ' || header_key || ', Item: ' || item_key || ', Ship To: ' || ship_to_key || ' on ' || CAST(billing_date AS VARCHAR) AS title
FROM items i LEFT JOIN customer s ON CAST(s.c_custkey AS VARCHAR) = ship_to_key
LEFT JOIN customer b ON CAST(b.c_custkey AS VARCHAR) = sold_to_key
LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = manufacturer_key
LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = plant_key
LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_key
WHERE billing_date >= DATE '{_FACT_FROM}'"""


RULES = InvoiceRules(
    keep={"l_linestatus": ["F"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
    exclude={"l_returnflag": ["N"]},
    exclude_prefix={"o_orderpriority": ["2"]},
    excluded_order_types=["P"],
    service_types=["PROMO"],
    negative_categories=["R"],
    specialty_plants=["3", "7", "11"],
    source_contracts=["A"],
    ship_to_role="WE",
)


def fact_business_filter(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("header_key"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("product_key"),
        "l_linenumber", "l_linestatus", "l_returnflag",
        F.col("l_returnflag").alias("document_category"),
        F.col("l_returnflag").alias("contract_type"),
        (F.col("l_suppkey") % 25).cast("string").alias("plant_key"),
        F.col("l_quantity").alias("billed_quantity"),
        F.col("l_extendedprice").alias("subtotal"),
        F.round(F.col("l_extendedprice") * F.col("l_discount"), 4).alias("rebate"),
        F.col("l_tax").alias("strength"),
    )
    orders = table(spark, sf, "orders")
    headers = orders.select(F.col("o_orderkey").alias("header_key"), "o_orderpriority", "o_custkey")
    kinds = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("order_type"))
    kinds_of_product = table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_type").alias("product_type")
    )
    partners = orders.select(
        F.col("o_orderkey").alias("header_key"),
        F.when(F.col("o_totalprice") > 100000, "WE").otherwise("AG").alias("role"),
        F.col("o_custkey").cast("string").alias("partner_key"),
    )
    return raw_invoices(headers, lines, kinds, kinds_of_product, partners, RULES)


_BUSINESS_SQL = """SELECT l_orderkey AS header_key, l_orderkey AS order_key, l_partkey AS product_key, l_linenumber, l_linestatus,
  l_returnflag, l_returnflag AS document_category, l_returnflag AS contract_type, CAST(l_suppkey % 25 AS VARCHAR) AS plant_key,
  l_quantity AS billed_quantity, l_extendedprice AS subtotal, round(l_extendedprice * l_discount, 4) AS rebate,
  l_tax AS strength, o_orderpriority, o_custkey,
  CASE WHEN o_totalprice > 100000 THEN CAST(o_custkey AS VARCHAR) END AS ship_to_key,
  (l_extendedprice - round(l_extendedprice * l_discount, 4)) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sales_value,
  l_quantity * l_tax * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS total_unit_strength,
  l_suppkey % 25 IN (3, 7, 11) AS specialty_flag, l_returnflag = 'A' AS source_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE l_linestatus = 'F' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM') AND l_returnflag <> 'N'
  AND o_orderstatus <> 'P' AND p_type <> 'PROMO'"""


def sales_item_fact(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    orders = lines.select(
        F.concat_ws("_|_", "l_orderkey", "l_linenumber").alias("primary_key"),
        F.col("l_partkey").cast("string").alias("product_key"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("product_code"),
        # customers beyond the tables' range have no row in the dimension
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("none"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_key"),
        F.col("o_orderstatus").alias("account_key"),
        F.col("l_orderkey").cast("string").alias("document_number"),
        F.col("l_linenumber").cast("string").alias("item_number"),
        F.col("o_orderdate").cast("date").alias("document_date"),
        F.col("l_quantity").alias("order_quantity"),
    )
    customers = customers_of(spark, sf).withColumnRenamed("name", "customer_name")
    accounts = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderstatus").alias("primary_key"))
        .agg(F.count("*").alias("account_documents"))
    )
    return sales_items(orders, products_of(spark, sf), customers, accounts)


_SALES_SQL = """WITH a AS (SELECT o_orderstatus AS account_key, count(*) AS account_documents FROM orders GROUP BY 1),
s AS (SELECT concat_ws('_|_', l_orderkey, l_linenumber) AS primary_key, CAST(l_partkey AS VARCHAR) AS product_key,
    lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS product_code,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS customer_key,
    o_orderstatus AS account_key, CAST(l_orderkey AS VARCHAR) AS document_number, CAST(l_linenumber AS VARCHAR) AS item_number,
    CAST(o_orderdate AS DATE) AS document_date, l_quantity AS order_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT s.*, p_name AS product_name, p_size AS pack_size, p_retailprice AS list_price, c_name AS customer_name,
  c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, account_documents, product_key AS product_number,
  'Sales Document ' || document_number || ', Item ' || item_number || ' (CIN: ' || product_key ||
    CASE WHEN c_name IS NOT NULL THEN ') for ' || c_name || ' on ' ELSE ') on ' END || CAST(document_date AS VARCHAR) AS title
FROM s LEFT JOIN part ON product_key = CAST(p_partkey AS VARCHAR)
LEFT JOIN customer ON customer_key = CAST(c_custkey AS VARCHAR) LEFT JOIN a USING (account_key)"""


def contract_view(spark, sf):
    details = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("primary_key"),
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("trade_name"),
        F.col("p_type").alias("product_group"),
    )
    return contract_filter_view(
        items(spark, sf, products=True),
        details,
        {
            "billing_document_fk": "item_key", "product_fk": "product_key",
            "customer_payer_fk": "bill_to_key", "customer_sold_to_fk": "sold_to_key",
            "billing_date": "billing_date", "billed_quantity": "billed_quantity",
            "sales_value": "sales_value", "specialty_flag": "specialty_flag",
        },
    )


def pairs_of(spark, sf):
    return entity_pairs(items(spark, sf), ROLES, "product_key", "customer_product_pair")


_PAIRS_SQL = """SELECT DISTINCT customer_key, {member}, concat_ws('_||_', customer_key, {member}) AS primary_key,
  '{kind}' AS _group_type, 'all' AS _filter_id
FROM (SELECT sold_to_key AS customer_key, {member} FROM items UNION SELECT bill_to_key, {member} FROM items
      UNION SELECT ship_to_key, {member} FROM items)
WHERE customer_key IS NOT NULL AND customer_key <> '' AND {member} IS NOT NULL AND {member} <> ''"""


def _pair_plan(spark, sf, member, name, dimension):
    horizons = list(HORIZONS)
    pairs = customer_pairs(
        items(spark, sf, products=True),
        customers_of(spark, sf).withColumnsRenamed({"name": "customer_name"}),
        dimension,
        member,
        name,
        spec(horizons=horizons),
    )
    return pairs.drop(*[c for c in pairs.columns if c.endswith("time_series_id")])


def customer_product_pairs(spark, sf):
    return _pair_plan(spark, sf, "product_key", "customer_product_pair", products_of(spark, sf))


def _rolled(spark, sf, column):
    return (
        table(spark, sf, "part")
        .groupBy(F.col(column).alias("primary_key"))
        .agg(F.count("*").alias("member_products"))
    )


def customer_generic_pairs(spark, sf):
    return _pair_plan(spark, sf, "generic_name", "customer_generic_name_pair", _rolled(spark, sf, "p_type"))


def customer_trade_pairs(spark, sf):
    return _pair_plan(spark, sf, "trade_name", "customer_trade_name_pair", _rolled(spark, sf, "p_brand"))


def _pair_plan_sql(member: str, name: str, dimension: str, columns: str) -> str:
    roles = (("soldto", "sold_to_key"), ("billto", "bill_to_key"), ("shipto", "ship_to_key"))
    metrics = ", ".join(
        f"m_{r} AS ({rfm_sql(f'''concat_ws('_||_', {key}, {member})''', f'customer_{r}_{name}', list(HORIZONS))})"
        for r, key in roles
    )
    joins = " ".join(f"LEFT JOIN m_{r} USING (primary_key)" for r, _ in roles)
    return f"""WITH {ITEMS}, pairs AS ({_PAIRS_SQL.format(member=member, kind=name)}), {metrics}
SELECT * EXCLUDE (k) FROM pairs {joins}
LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS customer_name, c_mktsegment AS segment,
             CAST(c_nationkey AS VARCHAR) AS nation FROM customer) USING (customer_key)
LEFT JOIN (SELECT {columns} FROM {dimension}) d ON d.k = {member}"""


def skew_safe_left_join(spark, sf):
    left = items(spark, sf).select("item_key", "ship_to_key", "sales_value", "billing_date")
    joined = null_safe_left_join(left, customers_of(spark, sf), [("ship_to_key", "primary_key")])
    return joined.groupBy("ship_to_key", "name", "segment").agg(
        F.count("*").alias("item_count"), exact_sum("sales_value").alias("sales_value")
    )


def inner_enrichment(spark, sf):
    """Items of customers in two segments: inner join on differently named keys."""
    chosen = members(customers_of(spark, sf), "segment", ["BUILDING", "MACHINERY"])
    kept = enrich(items(spark, sf), chosen, [("bill_to_key", "primary_key")])
    return kept.groupBy("bill_to_key", "name", "segment").agg(
        F.count("*").alias("item_count"), exact_sum("net_value").alias("net_value")
    )


def semi_join_members(spark, sf):
    """Items whose product is in the table of the large products."""
    large = table(spark, sf, "part").filter("p_size >= 40").select(F.col("p_partkey").cast("string"))
    return (
        members(items(spark, sf), "product_key", large)
        .groupBy("product_key")
        .agg(F.count("*").alias("item_count"))
    )


def containment_list(spark, sf):
    flagged = containment_flag(table(spark, sf, "part"), "p_name", ["ring", "Large Bolt"], "is_exclusive")
    return flagged.select("p_partkey", "p_name", "is_exclusive")


def containment_table(spark, sf):
    part = table(spark, sf, "part")
    tokens = (
        part.filter((F.col("p_brand") == "Brand#3") & (F.col("p_size") > 40))
        .select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token"))
    )
    return containment_flag(part, "p_name", tokens, "has_token").select("p_partkey", "p_name", "has_token")


def array_subset_links(spark, sf):
    source = items(spark, sf)
    small = source.select("header_key", F.col("product_key").alias("element"))
    large = source.select("sold_to_key", F.col("product_key").alias("element"))
    return subset_pairs(small, large, "header_key", "sold_to_key")


_SUBSET_SQL = f"""WITH {ITEMS}, s AS (SELECT DISTINCT header_key, product_key FROM items), l AS (SELECT DISTINCT sold_to_key, product_key FROM items),
n AS (SELECT header_key, count(*) AS n FROM s GROUP BY 1)
SELECT header_key, sold_to_key FROM s JOIN l USING (product_key) JOIN n USING (header_key)
GROUP BY header_key, sold_to_key, n HAVING count(*) = n"""


def array_predicates(spark, sf):
    """Orders by whether their statuses lie within a fixed list, as subset and size tests."""
    sets = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("l_returnflag")).alias("flags")
    )
    allowed = F.array(F.lit("A"), F.lit("N"))
    return sets.select(
        "l_orderkey",
        is_subset(F.col("flags"), allowed).alias("inside"),
        (F.col("flags") != F.array(F.lit("R"))).alias("not_only_returns"),
        F.size("flags").alias("flag_count"),
        F.array_contains("flags", "R").alias("has_return"),
        F.array_join(F.array_union("flags", allowed), "|").alias("joined"),
    )


def relations_of(spark, sf):
    """Partner relations: one per order, the role from its priority."""
    role = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "A1")
        .when(F.col("o_orderpriority") == "2-HIGH", "A2")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "A3")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "PG")
        .otherwise("AL")
    )
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_key"),
        (F.col("o_orderkey") % 1500).cast("string").alias("partner_key"),
        role.alias("role"),
    )


RELATIONS = """relations AS (SELECT CAST(o_custkey AS VARCHAR) AS customer_key, CAST(o_orderkey % 1500 AS VARCHAR) AS partner_key,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'A1' WHEN '2-HIGH' THEN 'A2' WHEN '3-MEDIUM' THEN 'A3'
    WHEN '4-NOT SPECIFIED' THEN 'PG' ELSE 'AL' END AS role FROM orders)"""

PARTNERS = """partners AS (SELECT primary_key,
  {cols}
  FROM (SELECT customer_key AS primary_key, role, min(partner_key) AS partner FROM relations
        WHERE role IN ('A1', 'A2', 'A3', 'PG') AND customer_key <> partner_key AND partner_key <> '0' GROUP BY ALL)
  LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = partner GROUP BY 1)""".format(
    cols=",\n  ".join(
        f"max(CASE WHEN role = '{r}' THEN partner END) AS partner_key_{r}, max(CASE WHEN role = '{r}' THEN c_name END) AS partner_name_{r}"
        for r in ("A1", "A2", "A3", "PG")
    )
)


def partner_pivot(spark, sf):
    roles = ["A1", "A2", "A3", "PG"]
    genuine = genuine_relations(relations_of(spark, sf), "customer_key", "partner_key", "role", roles, "0")
    return partner_columns(genuine, customers_of(spark, sf), "customer_key", "partner_key", "role", roles)


def membership(spark, sf):
    """Customers with a flag that tells whether an urgent order exists."""
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").cast("string").alias("listed")
    )
    return membership_flag(customers_of(spark, sf), "primary_key", urgent, "listed", "is_listed")


def outer_metric_merge(spark, sf):
    """Two horizons measured apart and merged; the same as one pass over both."""
    source = items(spark, sf)
    sets = [
        rfm_metrics(source, ["manufacturer_key"], "maker", spec(horizons=[h]))
        for h in (HORIZONS[0], HORIZONS[3])
    ]
    return merge_metric_sets(sets, "primary_key")


def key_builder(spark, sf):
    source = items(spark, sf)
    return source.select(
        "item_key",
        "billing_date",
        "net_value",
        primary_key("src", ["ship_to_key", "product_key"]).alias("skipping_key"),
        foreign_key("src", ["ship_to_key", "product_key"]).alias("strict_key"),
        pair_key("ship_to_key", "product_key").alias("pair_key"),
        is_member(F.col("ship_to_key"), ["5", "10"]).alias("is_listed"),
        filled("ship_to_key").alias("is_filled"),
    )


def attribute_rollup_by_type(spark, sf):
    part = table(spark, sf, "part").withColumn("labels", F.array("p_brand", "p_type"))
    rolled = attribute_rollup(
        part, "p_name",
        first={"first_brand": "p_brand"},
        lists={"product": "p_partkey", "brand": "p_brand"},
        counted=["product", "brand"],
        flattened={"labels": "labels"},
    )
    return rolled.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), "|") for c in ("product_list", "brand_list", "labels")}
    )


def share_of_partition(spark, sf):
    """Items' products as shares of their trade name: totals joined on their keys."""
    source = items(spark, sf, products=True)
    values = source.groupBy("trade_name", "product_key").agg(exact_sum("net_value").alias("net_value"))
    totals = values.groupBy("trade_name").agg(exact_sum("net_value").alias("trade_value"))
    return attach_totals(values, totals, ["trade_name"]).withColumn(
        "share", F.try_divide("net_value", "trade_value")
    )


QUERIES = {
    "fact_star_enrich": (fact_star_enrich, _FACT_SQL),
    "fact_business_filter": (fact_business_filter, _BUSINESS_SQL),
    "sales_item_fact": (sales_item_fact, _SALES_SQL),
    "contract_filter_view": (
        contract_view,
        f"""WITH {ITEMS} SELECT item_key AS billing_document_fk, product_key AS product_fk, bill_to_key AS customer_payer_fk,
          sold_to_key AS customer_sold_to_fk, billing_date, billed_quantity, sales_value, specialty_flag, p_type AS product_group,
          CASE WHEN p_size > 10 THEN p_name ELSE trade_name END AS trade_name
        FROM items LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_key""",
    ),
    "entity_pairs": (
        pairs_of,
        f"WITH {ITEMS} " + _PAIRS_SQL.format(member="product_key", kind="customer_product_pair"),
    ),
    "customer_product_pairs": (
        customer_product_pairs,
        _pair_plan_sql(
            "product_key", "customer_product_pair", "part",
            "CAST(p_partkey AS VARCHAR) AS k, p_name AS product_name, p_size AS pack_size, p_retailprice AS list_price",
        ),
    ),
    "customer_generic_name_pairs": (
        customer_generic_pairs,
        _pair_plan_sql(
            "generic_name", "customer_generic_name_pair",
            "(SELECT p_type, count(*) AS n FROM part GROUP BY 1)", "p_type AS k, n AS member_products",
        ),
    ),
    "customer_trade_name_pairs": (
        customer_trade_pairs,
        _pair_plan_sql(
            "trade_name", "customer_trade_name_pair",
            "(SELECT p_brand, count(*) AS n FROM part GROUP BY 1)", "p_brand AS k, n AS member_products",
        ),
    ),
    "skew_safe_left_join": (
        skew_safe_left_join,
        f"""WITH {ITEMS} SELECT ship_to_key, c_name AS name, c_mktsegment AS segment, count(*) AS item_count,
          CAST(sum(CAST(sales_value AS DECIMAL(18, 4))) AS DOUBLE) AS sales_value
        FROM items LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = ship_to_key GROUP BY ALL""",
    ),
    "inner_enrichment": (
        inner_enrichment,
        f"""WITH {ITEMS} SELECT bill_to_key, c_name AS name, c_mktsegment AS segment, count(*) AS item_count,
          CAST(sum(CAST(net_value AS DECIMAL(18, 4))) AS DOUBLE) AS net_value FROM items JOIN customer ON CAST(c_custkey AS VARCHAR) = bill_to_key
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL""",
    ),
    "semi_join_members": (
        semi_join_members,
        f"""WITH {ITEMS} SELECT product_key, count(*) AS item_count FROM items
        WHERE product_key IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size >= 40) GROUP BY 1""",
    ),
    "containment_flag": (
        containment_list,
        """SELECT p_partkey, p_name, contains(upper(p_name), 'RING') OR contains(upper(p_name), 'LARGE BOLT') AS is_exclusive FROM part""",
    ),
    "containment_flag_table": (
        containment_table,
        """WITH t AS (SELECT DISTINCT upper(split_part(p_name, ' ', 2)) AS token FROM part WHERE p_brand = 'Brand#3' AND p_size > 40)
        SELECT p_partkey, p_name, EXISTS (SELECT 1 FROM t WHERE token <> '' AND contains(upper(p_name), token)) AS has_token FROM part""",
    ),
    "array_subset_links": (array_subset_links, _SUBSET_SQL),
    "array_predicates": (
        array_predicates,
        """WITH s AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS flags FROM lineitem GROUP BY 1)
        SELECT l_orderkey, NOT list_contains(flags, 'R') AS inside, flags <> ['R'] AS not_only_returns,
          CAST(len(flags) AS INTEGER) AS flag_count, list_contains(flags, 'R') AS has_return,
          array_to_string(flags, '|') || CASE WHEN list_contains(flags, 'A') THEN '' ELSE '|A' END
            || CASE WHEN list_contains(flags, 'N') THEN '' ELSE '|N' END AS joined FROM s""",
    ),
    "partner_pivot": (partner_pivot, f"WITH {RELATIONS}, {PARTNERS} SELECT * FROM partners"),
    "membership_flag": (
        membership,
        """SELECT CAST(c_custkey AS VARCHAR) AS primary_key, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
          c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS is_listed FROM customer""",
    ),
    "outer_metric_merge": (
        outer_metric_merge,
        f"WITH {ITEMS} {rfm_sql('manufacturer_key', 'maker', [HORIZONS[0], HORIZONS[3]])}",
    ),
    "key_builder": (
        key_builder,
        f"""WITH {ITEMS} SELECT item_key, billing_date, net_value, concat_ws('_|_', 'src', ship_to_key, product_key) AS skipping_key,
          'src_|_' || ship_to_key || '_|_' || product_key AS strict_key, concat_ws('_||_', ship_to_key, product_key) AS pair_key,
          coalesce(ship_to_key IN ('5', '10'), false) AS is_listed, ship_to_key IS NOT NULL AS is_filled FROM items""",
    ),
    "attribute_rollup": (
        attribute_rollup_by_type,
        """SELECT p_name AS primary_key, min(p_brand) AS first_brand, array_to_string(list_sort(list(DISTINCT p_partkey)), '|') AS product_list,
          array_to_string(list_sort(list(DISTINCT p_brand)), '|') AS brand_list, CAST(count(DISTINCT p_partkey) AS INTEGER) AS product_count,
          CAST(count(DISTINCT p_brand) AS INTEGER) AS brand_count,
          array_to_string(list_sort(list_distinct(list_concat(list(DISTINCT p_brand), list(DISTINCT p_type)))), '|') AS labels,
          CAST(count(DISTINCT p_brand) + count(DISTINCT p_type) AS INTEGER) AS labels_count
        FROM part WHERE p_name IS NOT NULL AND p_name <> '' GROUP BY 1""",
    ),
    "share_of_partition": (
        share_of_partition,
        f"""WITH {ITEMS}, v AS (SELECT trade_name, product_key, CAST(sum(CAST(net_value AS DECIMAL(18, 4))) AS DOUBLE) AS net_value FROM items GROUP BY ALL),
        t AS (SELECT trade_name, CAST(sum(CAST(net_value AS DECIMAL(18, 4))) AS DOUBLE) AS trade_value FROM v GROUP BY 1)
        SELECT *, net_value / nullif(trade_value, 0) AS share FROM v JOIN t USING (trade_name)""",
    ),
}
