"""Queries on value cleaning, renaming and other projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import ITEMS, items, table
from ledgerline.functions.clean import (
    FieldType,
    apply_cleaners,
    clean_iso_stamps,
    parse_replication_stamp,
    to_boolean,
)
from ledgerline.functions.keys import with_foreign_keys, with_primary_key, with_series_ids, with_source, with_title
from ledgerline.functions.text import (
    camel_to_words,
    catalogue_type,
    key_positions,
    map_values,
    numeric_code,
    pack_quantity,
    postal_prefix,
    reference_table,
    strip_leading_zeros,
)
from ledgerline.operators.columns import (
    blanks_to_null,
    columns_by_null_count,
    contract,
    decimals_to_double,
    drop_binary,
    drop_constant_columns,
    drop_null_columns,
    rename,
    rename_mapping,
    with_literals,
    without_shared_columns,
)
from ledgerline.operators.filters import filled


def _raw_events(spark, sf):
    """Events as a source system would export them: text, with gaps and rubbish."""
    kind, n = F.col("event_type"), F.col("event_id")
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    return table(spark, sf, "events").select(
        n.alias("event_id"),
        F.when(kind == "error", "00000000").when(kind == "signup", "2024-13-45")
        .otherwise(F.date_format("ts", "yyyyMMdd")).alias("CREATED_ON"),
        F.when(kind == "click", "000000").when(kind == "view", F.date_format("ts", "HH:mm:ss"))
        .when(kind == "error", "noon").otherwise(F.date_format("ts", "HHmmss")).alias("CREATED_AT"),
        F.when(kind == "error", "0").otherwise(stamp).alias("STAMP"),
        F.when(kind == "purchase", "n.a.").otherwise(F.col("value").cast("string")).alias("AMOUNT"),
        F.when(kind == "view", "12x").otherwise(F.col("user_id").cast("string")).alias("USER"),
        F.base64(F.encode(kind, "UTF-8")).alias("GUID"),
        F.when(kind == "click", " N/A ").when(kind == "view", "Undefined").when(kind == "error", "")
        .when(kind == "signup", " (null)").otherwise(F.concat(F.lit("  "), kind, F.lit(" "))).alias("NOTE"),
        F.when(kind == "click", "Y").when(kind == "view", "inactive").when(kind == "error", "0")
        .when(kind == "signup", "maybe").otherwise("TRUE").alias("FLAG"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("CHANGED"),
        stamp.alias("REPLICATED"),
    )


FIELDS = [
    FieldType("CREATED_ON", "DATS"),
    FieldType("CREATED_AT", "TIMS"),
    FieldType("STAMP", "DEC", "TZNTSTMPS"),
    FieldType("AMOUNT", "DEC", "AMOUNT"),
    FieldType("USER", "INT4"),
    FieldType("GUID", "RAW"),
    FieldType("CHANGED", "date-time"),
    FieldType("ABSENT", "DATS"),
]


def clean_types(spark, sf):
    raw = parse_replication_stamp(_raw_events(spark, sf), "REPLICATED")
    flagged = raw.withColumn("FLAG", to_boolean(F.col("FLAG")))
    typed = apply_cleaners(flagged, ["distinct_rows", "typed_columns"], FIELDS)
    stamps = ("STAMP", "CHANGED", "REPLICATED_PARSED")
    return clean_iso_stamps(typed, FIELDS).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in stamps}
    )


_CLEAN_SQL = """SELECT event_id,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(ts AS DATE) END AS CREATED_ON,
  CASE WHEN event_type NOT IN ('click', 'error') AND strftime(ts, '%H%M%S') <> '000000' OR event_type = 'view'
       THEN CAST(strftime(ts, '%H%M%S') AS BIGINT) END AS CREATED_AT,
  CASE WHEN event_type <> 'error' THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS STAMP,
  CASE WHEN event_type <> 'purchase' THEN value END AS AMOUNT,
  CASE WHEN event_type <> 'view' THEN CAST(user_id AS INTEGER) END AS "USER",
  upper(hex(event_type)) AS GUID,
  CASE WHEN event_type = 'purchase' THEN 'purchase' END AS NOTE,
  CASE event_type WHEN 'click' THEN true WHEN 'purchase' THEN true WHEN 'signup' THEN NULL ELSE false END AS FLAG,
  CAST(ts AS TIMESTAMP) AS CHANGED,
  strftime(ts, '%Y%m%d%H%M%S') AS REPLICATED,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS REPLICATED_PARSED
FROM events"""


def blank_fields(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "   ").when(F.col("o_orderstatus") == "O", " O ")
        .otherwise(F.col("o_orderstatus")).alias("status"),
        F.encode("o_orderpriority", "UTF-8").alias("payload"),
        F.array(F.lit("")).alias("tags"),
    )
    return drop_binary(blanks_to_null(raw)).withColumn("tags", F.size("tags"))


def strip_zero_ids(spark, sf):
    key = F.lpad(F.col("p_partkey").cast("string"), 10, "0")
    return table(spark, sf, "part").select(
        "p_partkey",
        strip_leading_zeros(F.when(F.col("p_size") > 3, key).otherwise("00000")).alias("product_number"),
        numeric_code(F.when(F.col("p_size") > 3, key).otherwise("12-A")).alias("vendor_number"),
        postal_prefix(F.concat_ws("-", key, F.col("p_size").cast("string"))).alias("postal_code"),
    )


def pack_quantity_of_parts(spark, sf):
    n, kind = F.col("p_size").cast("string"), F.col("p_type")
    sizes = table(spark, sf, "part").select(
        "p_partkey",
        F.when(kind == "SMALL", F.concat(n, F.lit("X10 EA")))
        .when(kind == "MEDIUM", F.concat(F.lit("4X"), n, F.lit("X8 PC")))
        .when(kind == "LARGE", F.concat(F.lit("6X"), n, F.lit("X1.5ML")))
        .when(kind == "ECONOMY", F.concat(n, F.lit("X1000ML")))
        .when(kind == "PROMO", F.concat(n, F.lit("EA")))
        .when(F.col("p_size") > 40, F.lit("100+10 EA"))
        .when(F.col("p_size") > 30, F.concat(n, F.lit(" ML")))
        .when(F.col("p_size") > 20, F.concat(F.lit("   "), n))
        .when(F.col("p_size") > 10, F.lit(""))
        .alias("size_text"),
        F.when(F.col("p_size") > 35, 3).otherwise(0).alias("quantity"),
        F.col("p_size").alias("pack"),
        F.when(F.col("p_size") > 25, "TB").alias("form"),
        F.when(F.col("p_brand") == "Brand#1", "ZSERVICE").otherwise("GOODS").alias("product_group"),
    )
    return sizes.select(
        "p_partkey",
        pack_quantity(
            F.col("size_text"), F.col("quantity"), F.col("pack"), F.col("form"), F.col("product_group")
        ).alias("corrected_pack_qty"),
    )


_PACK_SQL = """SELECT p_partkey, CAST(CASE WHEN p_brand = 'Brand#1' THEN 1
  WHEN p_type = 'SMALL' THEN p_size * 10
  WHEN p_type = 'MEDIUM' THEN 4 * p_size * 8
  WHEN p_type = 'LARGE' THEN 6 * p_size
  WHEN p_type = 'ECONOMY' THEN p_size
  WHEN p_type = 'PROMO' THEN p_size
  WHEN p_size > 40 THEN p_size
  WHEN p_size > 35 THEN 3
  WHEN p_size > 30 THEN 1
  ELSE p_size END AS DOUBLE) AS corrected_pack_qty FROM part"""


def renamed_columns(spark, sf):
    """Orders under readable names, with a customization column, a foreign key and no label left out."""
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("VBELN"),
        F.col("o_orderstatus").alias("STATUS_|_customization_field_VBUK_|_MANDT_VBELN"),
        F.concat_ws("_|_", F.lit("src"), "o_custkey").alias("kunnr_|_foreign_key_KNA1"),
        F.col("o_totalprice").alias("NETWR"),
        F.col("o_orderpriority").alias("PRIO"),
        F.col("o_orderdate").cast("date").alias("ERDAT"),
    )
    mapping = rename_mapping(
        raw.columns,
        {"VBELN": "Sales Document (No.)", "NETWR": "Net Value/US$", "PRIO": "", "ERDAT": None},
        {"VBUK": {"STATUS": "Overall Status: All"}},
    )
    return rename(raw, mapping)


def keyed_rows(spark, sf):
    """Primary key, title, source with a name clash, foreign keys and literals on raw rows."""
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("VBELN"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("KUNNR"),
        F.col("o_orderpriority").alias("SOURCE"),
        F.lit("old").alias("SPRAS"),
    )
    df = with_literals(raw, {"SPRAS": "E", "MANDT": "100"})
    df = with_title(with_source(with_primary_key(df, "erp", ["MANDT", "VBELN", "KUNNR"]), "erp"))
    return with_foreign_keys(df, "erp", [("KNA1", ["MANDT", "KUNNR"]), ("NONE", ["MISSING"])])


def series_pointers(spark, sf):
    entities = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("primary_key"))
    return with_series_ids(entities, "primary_key", "vendor", ["all", "spd_only"], ["item_count", "sales_value"])


def mapped_values(spark, sf):
    """Value mapping, name splitting and references read from text."""
    kinds = {"SMALL": "int", "LARGE": "varchar", "PROMO": "datetime", "ECONOMY": "unknown"}
    return table(spark, sf, "part").select(
        "p_partkey",
        map_values(F.col("p_type"), {"SMALL": "S", "MEDIUM": "M", "LARGE": "L"}).alias("size_code"),
        catalogue_type(map_values(F.col("p_type"), kinds)).alias("engine_type"),
        camel_to_words(F.regexp_replace(F.initcap("p_name"), " ", "")).alias("words"),
        reference_table(
            F.concat(F.lit("Refers to table "), F.regexp_replace("p_name", " ", "_"), F.lit(" by key")),
            F.concat(F.lit("ln_"), F.lower("p_type")),
        ).alias("reference"),
    )


def key_position_lookup(spark, sf):
    """Which attribute of a product holds a wanted value first."""
    names = F.array(F.lit("type"), F.lit("brand"), F.lit("size_class"))
    size = F.when(F.col("p_size") > 25, "LARGE").otherwise("SMALL")
    elements = F.array(F.col("p_type"), F.col("p_brand"), size)
    wanted = F.array(F.lit("LARGE"), F.lit("none"), F.lit("Brand#7"), F.lit("SMALL"))
    found = key_positions(names, elements, wanted)
    return table(spark, sf, "part").select("p_partkey", F.array_join(found, "|").alias("resolved"))


def pruned_columns(spark, sf):
    """Column pruning by content: what is left, in order of its nulls, as rows of one table."""
    orders = table(spark, sf, "orders")
    wide = orders.select(
        "*",
        F.lit(None).cast("string").alias("empty"),
        F.lit(7).alias("constant"),
        F.when(F.col("o_orderstatus") == "F", "x").alias("third"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(15,2)")).alias("amount"),
    )
    kept = drop_constant_columns(
        drop_null_columns(decimals_to_double(wide)).withColumn(
            "third", F.coalesce("third", F.col("o_orderpriority"))
        ),
        exact=True,
    )
    ordered = contract(kept, columns_by_null_count(kept))
    return without_shared_columns(
        ordered, table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderkey"]
    )


def key_filter(spark, sf):
    return items(spark, sf).filter(filled("ship_to_key", "product_key")).groupBy("ship_to_key").agg(
        F.count("*").alias("item_count")
    )


QUERIES = {
    "clean_types": (clean_types, _CLEAN_SQL),
    "blank_to_null": (
        blank_fields,
        """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN ' O ' ELSE o_orderstatus END AS status,
          CAST(1 AS INTEGER) AS tags FROM orders""",
    ),
    "strip_zero_ids": (
        strip_zero_ids,
        """SELECT p_partkey, CASE WHEN p_size > 3 AND p_partkey > 0 THEN CAST(p_partkey AS VARCHAR) END AS product_number,
          CASE WHEN p_size > 3 THEN CAST(p_partkey AS VARCHAR) END AS vendor_number,
          lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS postal_code FROM part""",
    ),
    "pack_quantity": (pack_quantity_of_parts, _PACK_SQL),
    "renamed_columns": (
        renamed_columns,
        """SELECT o_orderkey AS "sales_document_no_|_vbeln",
          o_orderstatus AS "overall_status_all_|_status_|_customization_field_VBUK_|_MANDT_VBELN",
          concat_ws('_|_', 'src', o_custkey) AS "kunnr_|_foreign_key_KNA1", o_totalprice AS "net_valueusd_|_netwr",
          o_orderpriority AS "_|_prio", CAST(o_orderdate AS DATE) AS "ERDAT" FROM orders""",
    ),
    "keyed_rows": (
        keyed_rows,
        """WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS VBELN, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS KUNNR,
          o_orderpriority AS SOURCE, 'E' AS SPRAS, '100' AS MANDT FROM orders)
        SELECT *, concat_ws('_|_', 'erp', MANDT, VBELN, KUNNR) AS primary_key, 'erp' AS engine_source,
          concat_ws('_|_', 'erp', MANDT, VBELN, KUNNR) AS title, 'erp_|_100_|_' || KUNNR AS "mandt_kunnr_|_foreign_key_KNA1" FROM r""",
    ),
    "series_pointers": (
        series_pointers,
        "SELECT CAST(s_suppkey AS VARCHAR) AS primary_key, "
        + ", ".join(
            f"'vendor_||_{f}_||_' || s_suppkey || '_||_{m}' AS \"vendor_|_{f}_|_{m}_|_time_series_id\""
            for f in ("all", "spd_only")
            for m in ("item_count", "sales_value")
        )
        + " FROM supplier",
    ),
    "mapped_values": (
        mapped_values,
        """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'MEDIUM' THEN 'M' WHEN 'LARGE' THEN 'L' END AS size_code,
          CASE p_type WHEN 'SMALL' THEN 'integer' WHEN 'LARGE' THEN 'string' WHEN 'PROMO' THEN 'timestamp' END AS engine_type,
          lower(replace(p_name, ' ', '_')) AS words, 'ln_' || replace(p_name, ' ', '_') AS reference FROM part""",
    ),
    "key_position_lookup": (
        key_position_lookup,
        """SELECT p_partkey, concat_ws('|', CASE WHEN p_type = 'LARGE' THEN 'type' WHEN p_size > 25 THEN 'size_class' END,
          CASE WHEN p_brand = 'Brand#7' THEN 'brand' END,
          CASE WHEN p_type = 'SMALL' THEN 'type' WHEN p_size <= 25 THEN 'size_class' END) AS resolved FROM part""",
    ),
    "pruned_columns": (
        pruned_columns,
        """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
          CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE o_orderpriority END AS third,
          CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS DOUBLE) END AS amount FROM orders""",
    ),
    "key_filter": (
        key_filter,
        f"WITH {ITEMS} SELECT ship_to_key, count(*) AS item_count FROM items WHERE ship_to_key <> '' AND product_key <> '' GROUP BY 1",
    ),
}
