"""Queries on the stages from raw tables to current ones.

Orders play a change log of customers: raw text columns in two batch components, keyed by
customer, with a dictionary, a text table and a change mode.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import table
from ledgerline.metadata.schemas import FIELDS, LINKS, OBJECTS, Metadata
from ledgerline.plans.staging import (
    SourceSpec,
    TableSpec,
    cleaned,
    counts_report,
    current,
    enriched,
    final,
    renamed,
)

SOURCE = SourceSpec(
    "erp",
    tables=(
        TableSpec("ORD", comparison_columns=("ERDAT", "VBELN"), change_mode_column="MODE", unique_keys=True, customizations=("TXT",)),
        TableSpec("TXT", customization_only=True),
        TableSpec("NAT"),
    ),
    connector_prefixes=("HX_",),
)


def metadata(spark) -> Metadata:
    """The dictionary of the three raw tables."""

    def field(t, raw, label, kind="CHAR", literal=None, order=1):
        return (t, label, raw, kind, None, None, literal, order)

    fields = [
        field("ORD", "MANDT", "Client", literal="100", order=1),
        field("ORD", "KUNNR", "Sold-to (No.)", order=2),
        field("ORD", "VBELN", "Document", "INT4", order=3),
        field("ORD", "ERDAT", "Created on", "DATS", order=4),
        field("ORD", "NETWR", "Net Value", "DEC", order=5),
        field("ORD", "PRIO", "", order=6),
        field("ORD", "SPRAS", "Language", literal="E", order=7),
        field("TXT", "KUNNR", "Customer", order=1),
        field("TXT", "SPRAS", "Language", order=2),
        field("TXT", "NAME", "Name/Title", order=3),
        field("TXT", "SEGM", "Segment", order=4),
        field("NAT", "LAND", "Country", order=1),
    ]
    return Metadata(
        spark.createDataFrame(
            [("ORD", ["MANDT", "KUNNR", "SPRAS"], "Orders", ["TXT"]), ("TXT", ["KUNNR", "SPRAS"], None, []), ("NAT", ["LAND"], None, [])],
            OBJECTS,
        ),
        spark.createDataFrame(fields, FIELDS),
        spark.createDataFrame(
            [
                ("ORD", ["MANDT", "KUNNR", "SPRAS"], "TXT", ["MANDT", "KUNNR", "SPRAS"], None),
                ("ORD", ["PRIO"], "NAT", ["LAND"], None),
                ("ORD", ["MISSING"], "NAT", ["LAND"], None),
                ("ORD", ["KUNNR"], "ELSEWHERE", ["KUNNR"], None),
            ],
            LINKS,
        ),
    )


def _raw_orders(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("KUNNR"),
        F.col("o_orderkey").cast("string").alias("VBELN"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("ERDAT"),
        F.col("o_totalprice").cast("string").alias("NETWR"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_orderpriority")).alias("PRIO"),
        F.when(F.col("o_orderpriority") == "5-LOW", "D").otherwise("U").alias("MODE"),
        F.lit("1").alias("HX_SEQ"),
        "o_orderstatus",
    )
    return {
        "orders_open": raw.filter("o_orderstatus = 'O'").drop("o_orderstatus"),
        "orders_rest": raw.filter("o_orderstatus != 'O'").drop("o_orderstatus"),
    }


def _raw_texts(spark, sf):
    texts = table(spark, sf, "customer").select(
        F.lit("100").alias("MANDT"),
        F.col("c_custkey").cast("string").alias("KUNNR"),
        F.lit("E").alias("SPRAS"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("NAME"),
        F.col("c_mktsegment").alias("SEGM"),
    )
    return {"customer_texts": texts}


def cleaned_orders(spark, sf):
    return cleaned(_raw_orders(spark, sf), SOURCE, "ORD", metadata(spark))


def enriched_orders(spark, sf):
    meta = metadata(spark)
    texts = cleaned(_raw_texts(spark, sf), SOURCE, "TXT", meta)
    return enriched(cleaned_orders(spark, sf), SOURCE, "ORD", meta, {"TXT": texts})


def renamed_orders(spark, sf):
    return renamed(enriched_orders(spark, sf), "ORD", metadata(spark), ["TXT"])


def current_customers(spark, sf):
    return current(renamed_orders(spark, sf), SOURCE, "ORD", metadata(spark))


def final_customers(spark, sf):
    """The current table of two sources, the second without customizations."""
    meta = metadata(spark)
    second = current(
        renamed(cleaned_orders(spark, sf), "ORD", meta).withColumn("source", F.lit("other")),
        SOURCE, "ORD", meta,
    )
    return final([current_customers(spark, sf), second])


def staged_counts(spark, sf):
    return counts_report({"orders": cleaned_orders(spark, sf), "final": final_customers(spark, sf)})


_CLEANED = """cleaned AS (SELECT CAST(o_custkey AS VARCHAR) AS "KUNNR", CAST(o_orderkey AS INTEGER) AS "VBELN",
  CAST(o_orderdate AS DATE) AS "ERDAT", o_totalprice AS "NETWR", CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS "PRIO",
  CASE WHEN o_orderpriority = '5-LOW' THEN 'D' ELSE 'U' END AS "MODE", '1' AS "HX_SEQ",
  CASE WHEN o_orderstatus = 'O' THEN 'orders_open' ELSE 'orders_rest' END AS source_dataset_name, '100' AS "MANDT", 'E' AS "SPRAS",
  'erp_|_100_|_' || o_custkey || '_|_E' AS primary_key, 'erp' AS source, 'erp_|_100_|_' || o_custkey || '_|_E' AS title,
  'erp_|_100_|_' || o_custkey || '_|_E' AS "mandt_kunnr_spras_|_foreign_key_TXT",
  CASE WHEN o_orderstatus <> 'P' THEN 'erp_|_' || o_orderpriority END AS "prio_|_foreign_key_NAT" FROM orders)"""

_SUFFIX = "_|_customization_field_TXT_|_MANDT_KUNNR_SPRAS"
_ENRICHED = f"""{_CLEANED}, enriched AS (SELECT cleaned.*, CASE WHEN c_acctbal > 0 THEN c_name END AS "NAME{_SUFFIX}",
  c_mktsegment AS "SEGM{_SUFFIX}", CASE WHEN c_acctbal > 0 THEN c_name END AS title_1, c_mktsegment AS title_2
  FROM cleaned LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = "KUNNR")"""

_NAMES = {
    "KUNNR": "soldto_no_|_kunnr", "VBELN": "document_|_vbeln", "ERDAT": "created_on_|_erdat", "NETWR": "net_value_|_netwr",
    "PRIO": "_|_prio", "MODE": "mode", "HX_SEQ": "hx_seq", "source_dataset_name": "source_dataset_name", "MANDT": "client_|_mandt",
    "SPRAS": "language_|_spras", "primary_key": "primary_key", "source": "source",
    "mandt_kunnr_spras_|_foreign_key_TXT": "mandt_kunnr_spras_|_foreign_key_TXT", "prio_|_foreign_key_NAT": "prio_|_foreign_key_NAT",
    f"NAME{_SUFFIX}": f"nametitle_|_name{_SUFFIX}", f"SEGM{_SUFFIX}": f"segment_|_segm{_SUFFIX}", "title_1": "title_1", "title_2": "title_2",
}
_RENAMED = f"""{_ENRICHED}, renamed AS (SELECT {', '.join(f'"{a}" AS "{b}"' for a, b in _NAMES.items())}, title_1 AS title FROM enriched)"""
_CURRENT = f"""{_RENAMED}, latest AS (SELECT * FROM renamed QUALIFY row_number() OVER (PARTITION BY primary_key
  ORDER BY "created_on_|_erdat" DESC, "document_|_vbeln" DESC) = 1), current_rows AS (SELECT * FROM latest WHERE mode <> 'D')"""

_FINAL = f"""{_CURRENT}, final_rows AS (SELECT * FROM current_rows UNION ALL BY NAME SELECT * EXCLUDE (title_1, title_2, title,
  "nametitle_|_name{_SUFFIX}", "segment_|_segm{_SUFFIX}", source), primary_key AS title, 'other' AS source FROM current_rows)"""

QUERIES = {
    "staged_cleaned": (cleaned_orders, f"WITH {_CLEANED} SELECT * FROM cleaned"),
    "staged_enriched": (enriched_orders, f"WITH {_ENRICHED} SELECT * FROM enriched"),
    "staged_renamed": (renamed_orders, f"WITH {_RENAMED} SELECT * FROM renamed"),
    "staged_current": (current_customers, f"WITH {_CURRENT} SELECT * FROM current_rows"),
    "staged_final": (final_customers, f"WITH {_FINAL} SELECT * FROM final_rows"),
    "staged_counts": (
        staged_counts,
        f"""WITH {_FINAL} SELECT source, 'final' AS "table", count(*) AS count FROM final_rows GROUP BY ALL
        UNION ALL SELECT source, 'orders', count(*) FROM cleaned GROUP BY ALL""",
    ),
}
