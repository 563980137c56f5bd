"""Discovery from an application suite's own dictionary of tables, columns and keys.

The dictionary may list several keys for a table.  Audited keys of type S are preferred, type D
stands in for tables that have none, and the highest key id wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.metadata.schemas import Metadata, conformed
from ledgerline.operators.dedup import latest_rows
from ledgerline.operators.joins import missing_members

_TABLE = ["APPLICATION_ID", "TABLE_ID"]
_COLUMN = [*_TABLE, "COLUMN_ID"]


def _qualified(owner: str, name: str) -> Column:
    return F.concat(F.lit('"'), F.col(owner), F.lit('"."'), F.col(name), F.lit('"'))


def known_tables(dictionary: DataFrame, actual: DataFrame) -> DataFrame:
    """Dictionary tables that exist, with their owner."""
    return (
        dictionary.join(actual.select("OWNER", "TABLE_NAME").distinct(), "TABLE_NAME")
        .withColumnsRenamed({"OWNER": "owner", "TABLE_NAME": "table"})
        .distinct()
    )


def preferred_keys(keys: DataFrame) -> DataFrame:
    audited = keys.filter(F.col("AUDIT_KEY_FLAG") == "Y")
    real = audited.filter(F.col("PRIMARY_KEY_TYPE") == "S")
    fallback = missing_members(audited.filter(F.col("PRIMARY_KEY_TYPE") == "D"), real, _TABLE)
    return real.unionByName(fallback)


def _named_columns(key_columns: DataFrame, columns: DataFrame) -> DataFrame:
    return key_columns.join(columns.select(*_COLUMN, "COLUMN_NAME"), _COLUMN)


def primary_keys(
    tables: DataFrame, columns: DataFrame, keys: DataFrame, key_columns: DataFrame
) -> DataFrame:
    """One key per table: the highest key id, its columns in alphabetical order."""
    entries = preferred_keys(keys).select(*_TABLE, "PRIMARY_KEY_ID").join(
        _named_columns(key_columns, columns), [*_TABLE, "PRIMARY_KEY_ID"]
    )
    lists = (
        tables.select("owner", "table", *_TABLE)
        .join(entries, _TABLE)
        .groupBy("table", "owner", "PRIMARY_KEY_ID")
        .agg(F.sort_array(F.collect_list("COLUMN_NAME")).alias("key_fields"))
    )
    return latest_rows(lists, ["table"], ["PRIMARY_KEY_ID"])


def foreign_keys(
    tables: DataFrame, columns: DataFrame, keys: DataFrame, key_columns: DataFrame
) -> DataFrame:
    entries = keys.select(
        *_TABLE, "FOREIGN_KEY_ID", "PRIMARY_KEY_TABLE_ID", "PRIMARY_KEY_ID"
    ).join(_named_columns(key_columns, columns), [*_TABLE, "FOREIGN_KEY_ID"])
    return (
        tables.select("owner", F.col("table").alias("own_table"), "TABLE_ID")
        .join(entries, "TABLE_ID")
        .groupBy("own_table", "owner", "FOREIGN_KEY_ID", "PRIMARY_KEY_TABLE_ID", "PRIMARY_KEY_ID")
        .agg(F.sort_array(F.collect_list("COLUMN_NAME")).alias("own_fields"))
    )


def object_metadata(tables: DataFrame, keys: DataFrame) -> DataFrame:
    """Tables that have a key; among repeated entries the greatest key and description stays."""
    entries = (
        tables.select("table", "owner", "DESCRIPTION")
        .join(keys, ["table", "owner"])
        .select(
            _qualified("owner", "table").alias("object_name"),
            F.col("key_fields").alias("primary_key_raw_fields"),
            F.col("DESCRIPTION").alias("description"),
        )
        .distinct()
    )
    return latest_rows(entries, ["object_name"], ["primary_key_raw_fields", "description"])


def field_metadata(tables: DataFrame, columns: DataFrame) -> DataFrame:
    entries = (
        tables.select("owner", "table", *_TABLE)
        .join(columns.withColumnRenamed("DESCRIPTION", "field_description"), _TABLE)
        .select(
            _qualified("owner", "table").alias("object_name"),
            F.col("COLUMN_NAME").alias("field_name"),
            F.col("COLUMN_NAME").alias("raw_field_name"),
            F.col("COLUMN_TYPE").alias("field_type"),
            "field_description",
        )
        .distinct()
    )
    return latest_rows(entries, ["object_name", "field_name"], ["field_description"])


def link_metadata(primary: DataFrame, foreign: DataFrame) -> DataFrame:
    """Links from the referring table to the table whose key it uses."""
    return (
        primary.join(foreign, ["PRIMARY_KEY_ID", "owner"])
        .select(
            _qualified("owner", "own_table").alias("primary_object_name"),
            F.col("own_fields").alias("primary_object_raw_fields"),
            F.col("table").alias("foreign_object_name"),
            F.col("key_fields").alias("foreign_object_raw_fields"),
        )
        .distinct()
    )


def discover(views: dict[str, DataFrame]) -> Metadata:
    tables = known_tables(views["FND_TABLES"], views["ALL_TABLES"])
    columns = views["FND_COLUMNS"]
    primary = primary_keys(
        tables, columns, views["FND_PRIMARY_KEYS"], views["FND_PRIMARY_KEY_COLUMNS"]
    )
    foreign = foreign_keys(
        tables, columns, views["FND_FOREIGN_KEYS"], views["FND_FOREIGN_KEY_COLUMNS"]
    )
    return conformed(
        object_metadata(tables, primary),
        field_metadata(tables, columns),
        link_metadata(primary, foreign),
    )
