import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.metadata.schemas import FIELDS, LINKS, OBJECTS, Metadata
from ledgerline.operators.rfm import Horizon, RfmSpec
from ledgerline.plans import dimensions, facts, series, staging

AS_OF = dt.date(2024, 6, 30)
SPEC = RfmSpec(AS_OF, [Horizon.since("2024-01-01")], exact=True)
DAY = dt.date(2024, 6, 1)


@pytest.fixture(scope="module")
def items(spark):
    data = [
        ("i1", "h1", "p1", "c1", "c1", "c2", "c1a", "c1a", "m1", "w1", DAY, "USD", 2.0, 10.0, 10.0, True, False, "Alpha"),
        ("i2", "h1", "p2", "c1", "c2", None, "c1a", "c2a", "m1", "w1", DAY, "USD", 1.0, 5.0, 5.0, False, False, "Beta"),
        ("i3", "h2", "p1", "c2", "c2", "c2", "c2a", "c2a", "m2", "w2", DAY + dt.timedelta(3), "USD", 1.0, 7.0, 7.0, False, True, "Alpha"),
        ("i4", "h3", "p9", "c9", "c9", "c9", "c9a", "c9a", "m9", "w9", dt.date(2020, 1, 1), "USD", 1.0, 7.0, 7.0, False, True, "Old"),
    ]
    names = (
        "item_key string, header_key string, product_key string, sold_to_key string, bill_to_key string, ship_to_key string, "
        "account_key string, payer_account_key string, manufacturer_key string, plant_key string, billing_date date, currency string, "
        "billed_quantity double, net_value double, sales_value double, specialty_flag boolean, source_flag boolean, trade_name string"
    )
    return spark.createDataFrame(data, names).cache()


def test_products(spark, items):
    base = spark.createDataFrame(
        [("p1", "Alphamycin", "000071", "10X10 EA", 100, 1, "", "G"), ("p2", "Betadol", "0000", "473 ML", 473, 1, "", "G")],
        "primary_key string, trade_name string, material_number string, size_text string, pack_size int, pack_quantity int, form string, product_group string",
    )
    master = spark.createDataFrame([("p1", "other", "S1"), ("p2", "other", "S2")], "primary_key string, trade_name string, strength string")
    got = dimensions.products(base, master, items, SPEC, {"material_number": "cin"}, ["ALPHA"], prune=False)
    by_key = {r["primary_key"]: r for r in got.collect()}
    p1, p2 = by_key["p1"], by_key["p2"]
    assert (p1["trade_name"], p1["strength"], p1["cin"], p1["corrected_pack_qty"], p1["is_exclusive"]) == ("Alphamycin", "S1", "71", 100.0, True)
    assert (p2["cin"], p2["corrected_pack_qty"], p2["is_exclusive"]) == (None, 1.0, False)
    assert p1["spd_labels"] == ["NON-SPD", "SPD"] and p1["spd_labels_count"] == 2
    assert p1["product_order_count_since_2024_01_01"] == 2
    assert p1["rank_of_product_total_order_value_since_2024_01_01"] == 1
    assert p1["product_|_all_|_sales_value_|_time_series_id"] == "product_||_all_||_p1_||_sales_value"


def test_product_pruning_drops_constant_columns(spark, items):
    base = spark.createDataFrame(
        [("p1", "A", "1", "1EA", 1, 2, "x", "g", "same"), ("p2", "B", "2", "2EA", 2, 3, "y", "h", "same")],
        "primary_key string, trade_name string, material_number string, size_text string, pack_size int, pack_quantity int, form string, product_group string, client string",
    )
    master = spark.createDataFrame([("p1",), ("p2",)], "primary_key string")
    assert "client" not in dimensions.products(base, master, items, SPEC, {}, [], ranks=False).columns


def test_vendors(spark, items):
    base = spark.createDataFrame([("m1", "0000012", "Maker"), ("m3", "X", "Other")], "primary_key string, vendor_code string, name string")
    got = {r["primary_key"]: r for r in dimensions.vendors(base, items, SPEC, ranks=False).collect()}
    assert got["m1"]["title"] == "Maker (12)" and got["m3"]["title"] is None
    assert got["m1"]["manufacturer_total_order_value_since_2024_01_01"] == 15.0
    assert got["m3"]["manufacturer_total_order_value_since_2024_01_01"] is None


def test_partner_tables(spark, rows):
    df = spark.createDataFrame([("c", "p", "A1"), ("c", "p", "A1"), ("c", "q", "ZZ")], "customer_key string, partner_key string, role string")
    tables = dimensions.partner_tables(df)
    assert set(tables) == {"A1", "A2", "A3", "AL"}
    assert tables["A1"].count() == 1 and tables["AL"].count() == 0


def test_affiliations_keep_only_measured(spark, items):
    affiliated = items.withColumn("aff", F.when(F.col("sold_to_key") == "c1", "c2"))
    customers = spark.createDataFrame([("c1", None), ("c2", None)], "primary_key string, unused string")
    got = dimensions.affiliations(customers, affiliated, "A3", "aff", SPEC, ranks=False)
    assert [r["primary_key"] for r in got.collect()] == ["c2"]
    assert "unused" not in got.columns
    assert "customer_affiliation__A3_|_spd_only_|_item_count_|_time_series_id" in got.columns


def test_fact_title_needs_every_part(spark, items):
    fact = facts.enriched_invoices(items, [], AS_OF, title=facts.invoice_title("header_key", "item_key", "ship_to_key", "billing_date"))
    got = {r["item_key"]: r for r in fact.collect()}
    assert set(got) == {"i1", "i2", "i3"}
    assert got["i1"]["title"] == "Invoice: h1, Item: i1, Ship To: c2 on 2024-06-01"
    assert got["i2"]["title"] is None and got["i2"]["customer_shipto_product_pair_foreign_key"] == "p2"
    assert got["i1"]["unit_price"] == 5.0 and got["i1"]["customer_soldto_trade_name_pair_foreign_key"] == "c1_||_Alpha"


def test_raw_invoices_need_no_optional_rules(spark):
    make = spark.createDataFrame
    headers = make([("h1", "N"), ("h2", "M")], "header_key string, document_category string")
    lines = make([("h1", "o1", "p1", 10.0, 1.0, 2.0, 3.0, "w", "S"), ("h2", "o2", "p2", 10.0, 1.0, 2.0, 3.0, "x", None)], "header_key string, order_key string, product_key string, subtotal double, rebate double, billed_quantity double, strength double, plant_key string, contract_type string")
    orders = make([("o1", "TEL"), ("o2", "STD")], "order_key string, order_type string")
    products = make([("p1", "FERT")], "product_key string, product_type string")
    partners = make([("h1", "WE", "s2"), ("h1", "WE", "s1"), ("h1", "RE", "x")], "header_key string, role string, partner_key string")
    rules = facts.InvoiceRules(negative_categories=["N"], specialty_plants=["w"], source_contracts=["S"])
    got = {r["header_key"]: r for r in facts.raw_invoices(headers, lines, orders, products, partners, rules).collect()}
    assert (got["h1"]["sales_value"], got["h1"]["total_unit_strength"], got["h1"]["ship_to_key"]) == (-9.0, -6.0, "s1")
    assert (got["h1"]["specialty_flag"], got["h2"]["source_flag"], got["h2"]["ship_to_key"]) == (True, False, None)
    excluding = facts.InvoiceRules(excluded_order_types=["TEL"])
    assert [r["header_key"] for r in facts.raw_invoices(headers, lines, orders, products, partners, excluding).collect()] == ["h2"]


def test_all_series(spark, items):
    keys = ["product_key", "sold_to_key", "bill_to_key", "ship_to_key", "account_key", "manufacturer_key", "specialty_flag"]
    pre = series.series_pre_aggregate(items, keys, AS_OF)
    tables = series.all_series(pre)
    assert len(tables) == 9
    one = {r["primary_key"]: r for r in tables["manufacturer__all"].collect()}
    r = one["2024-06-01 00:00:00_||_manufacturer_||_all_||_m1"]
    assert (r["item_count"], r["sales_value"], r["product_count"], r["cumulative_product_count"]) == (2, 15.0, 2, 2)
    assert r["lagged_cumulative_product_count"] is None and r["bill_to_count"] == 2
    assert tables["manufacturer__spd_only"].count() == 1


def test_pairs(spark, items):
    customers = spark.createDataFrame([("c1", "One"), ("c2", "Two")], "primary_key string, name string")
    products = spark.createDataFrame([("p1", "P", "hidden")], "primary_key string, label string, name string")
    got = series.customer_pairs(items, customers, products, "product_key", "customer_product_pair", SPEC)
    by_key = {r["primary_key"]: r for r in got.collect()}
    assert set(by_key) == {"c1_||_p1", "c2_||_p1", "c1_||_p2", "c2_||_p2", "c9_||_p9"}
    r = by_key["c2_||_p1"]
    assert (r["name"], r["label"]) == ("Two", "P")
    assert r["customer_shipto_customer_product_pair_order_count_since_2024_01_01"] == 2
    assert r["customer_soldto_customer_product_pair_order_count_since_2024_01_01"] == 1
    assert by_key["c9_||_p9"]["customer_soldto_customer_product_pair_order_count_since_2024_01_01"] is None


def widest_join(df):
    """Columns of the widest rows that a join hands on."""
    nodes, widest = [df._jdf.queryExecution().optimizedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Join":
            widest = max(widest, node.output().size())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return widest


def test_pairs_join_no_wide_rows(spark, items):
    customers = spark.createDataFrame([("c1", "One"), ("c2", "Two")], "primary_key string, name string")
    products = spark.createDataFrame([("p1", "P")], "primary_key string, label string")
    got = series.customer_pairs(items, customers, products, "product_key", "customer_product_pair", SPEC)
    assert len([c for c in got.columns if "_since_" in c]) == 48
    assert widest_join(got) < 16


def test_accounts_join_no_wide_rows(spark, items):
    accounts = spark.createDataFrame(
        [("c1a", "c1", "G", None), ("c2a", "c2", "H", None), ("c3a", None, None, None), ("c4a", "c4", "G", "X")],
        "primary_key string, customer_key string, trade_class string, deletion_flag string",
    )
    customer = spark.createDataFrame(
        [("c1", *range(30)), ("c4", *range(30))], "primary_key string, " + ", ".join(f"x{i} int" for i in range(30))
    )
    classes = spark.createDataFrame([("G", "good")], "trade_class string, class_name string")
    got = dimensions.customer_accounts(accounts, customer, classes, items, SPEC, ranks=False)
    assert got.columns[:35] == ["primary_key", "customer_key", "trade_class", "deletion_flag", *[f"x{i}" for i in range(30)], "class_name"]
    # one field is not asked for: the others must not be taken apart below the joins for it
    fewer = got.drop("x3", *[c for c in got.columns if "recency" in c or c.endswith("time_series_id")])
    assert widest_join(fewer) < 16
    by_key = {r["primary_key"]: r for r in fewer.collect()}
    assert {k: (r["x7"], r["class_name"]) for k, r in by_key.items()} == {"c1a": (7, "good"), "c2a": (None, None), "c3a": (None, None)}
    number = "order_count_since_2024_01_01"
    told = {k: (r[f"customer_account_{number}"], r[f"customer_account_billto_{number}"]) for k, r in by_key.items()}
    assert told == {"c1a": (2, 1), "c2a": (1, 2), "c3a": (None, None)}
    of_customer = customer.select("primary_key", "x1", F.lit("G").alias("trade_class"))
    late = dimensions.customer_accounts(accounts.drop("trade_class"), of_customer, classes, items, SPEC, ranks=False)
    assert {r["primary_key"]: r["class_name"] for r in late.collect()} == {"c1a": "good", "c2a": None, "c3a": None}


# staging

def small_metadata(spark, pk=("ID",), extra_fields=()):
    fields = [("T", "Ident", "ID", "CHAR", None, None, None, 1), ("T", "Value", "V", "CHAR", None, None, None, 2), *extra_fields]
    return Metadata(
        spark.createDataFrame([("T", list(pk), None, [])], OBJECTS),
        spark.createDataFrame(fields, FIELDS),
        spark.createDataFrame([], LINKS),
    )


def test_cleaning_reports_drift_and_keeps_ties(spark):
    spec = staging.SourceSpec("src", (staging.TableSpec("T", comparison_columns=("TS",)),))
    meta = small_metadata(spark)
    raw = spark.createDataFrame([("1", " a ", 1, "new"), ("1", "b", 1, None), ("2", " ", 0, "x")], "ID string, V string, TS int, X string")
    out = staging.cleaned({"t": raw}, spec, "T", meta)
    assert out.first()["engine_schema_mismatch"].endswith("dictionary: X")
    assert {r["V"] for r in out.collect()} == {"a", "b", None}
    changes = staging.renamed(staging.enriched(out, spec, "T", meta, {}), "T", meta)
    assert "engine_schema_mismatch" not in changes.columns and "ident_|_id" in changes.columns
    assert staging.current(changes, spec, "T", meta).count() == 3  # equal comparison columns
    unique = staging.SourceSpec("src", (staging.TableSpec("T", comparison_columns=("TS",), unique_keys=True),))
    assert staging.current(changes, unique, "T", meta).count() == 2


def test_incremental_current_replaces_older_keys(spark, rows):
    spec = staging.SourceSpec("src", (staging.TableSpec("T", comparison_columns=("TS",), change_mode_column="MODE"),))
    meta = small_metadata(spark)
    old = spark.createDataFrame([("1", "old", 1, "U"), ("2", "old", 1, "U")], "primary_key string, v string, ts int, mode string")
    new = spark.createDataFrame([("2", "new", 2, "D"), ("3", "new", 2, "U")], "primary_key string, v string, ts int, mode string")
    assert rows(staging.current(new, spec, "T", meta, previous=old), "primary_key", "v") == [("1", "old"), ("3", "new")]


def test_unknown_tables_and_columns_are_refused(spark):
    spec = staging.SourceSpec("src", (staging.TableSpec("T", comparison_columns=("GONE",)),))
    with pytest.raises(ValueError):
        spec.table("U")
    with pytest.raises(ValueError):
        staging.current(spark.createDataFrame([("1",)], "primary_key string"), spec, "T", small_metadata(spark))


def test_enrichment_of_previous_rows(spark, rows):
    meta = Metadata(
        spark.createDataFrame([("T", ["ID"], None, []), ("L", ["K"], None, [])], OBJECTS),
        spark.createDataFrame([("T", None, "ID", "CHAR", None, None, None, 1), ("L", None, "K", "CHAR", None, None, None, 1), ("L", None, "N", "CHAR", None, None, None, 2)], FIELDS),
        spark.createDataFrame([("T", ["ID"], "L", ["K"], None)], LINKS),
    )
    spec = staging.SourceSpec("s", (staging.TableSpec("T", customizations=("L",)), staging.TableSpec("L")))
    frame = lambda data: spark.createDataFrame(data, "ID string")
    lookup = spark.createDataFrame([("1", "one"), ("2", "two")], "K string, N string")
    got = staging.enriched(frame([("1",), ("9",)]), spec, "T", meta, {"L": lookup}, frame([("2",), ("1",)]), {"L": lookup.filter("K = '2'")})
    assert got.columns == ["ID", "N_|_customization_field_L_|_ID"]
    assert rows(got) == [("1", "one"), ("2", "two"), ("9", None)]
    with pytest.raises(ValueError):
        staging.enriched(frame([("1",)]), spec, "T", meta, {"L": lookup.drop("K")})
