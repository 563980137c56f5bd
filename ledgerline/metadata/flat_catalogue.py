"""Discovery from sources that list their columns in one table.

Three kinds exist: two whose tables all share one fixed key column, one that marks key columns
and keeps a comment per column, and one historian whose metadata is constant.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions.text import camel_to_words
from ledgerline.metadata.schemas import FIELDS, LINKS, OBJECTS, Metadata, conformed, no_names
from ledgerline.operators.dedup import latest_rows


@dataclass(frozen=True)
class FlatNames:
    """Column names of a columns table and of its foreign-key table."""

    key: str
    table: str
    column: str
    type: str
    description: str
    link_table: str
    link_column: str
    target_table: str
    target_column: str
    link_name: str | None = None


# The two known layouts.
CRM = FlatNames(
    key="Id",
    table="TableName",
    column="ColumnName",
    type="DataTypeName",
    description="Description",
    link_table="TableName",
    link_column="ColumnName",
    target_table="ReferencedTableName",
    target_column="ReferencedColumnName",
    link_name="ForeignKeyName",
)
CLOUD_SUITE = FlatNames(
    key="InternalId",
    table="Table",
    column="Column",
    type="Type",
    description="Description",
    link_table="Table",
    link_column="Fk_Column",
    target_table="Pk_Table",
    target_column="Pk_Column",
)


def discover(columns: DataFrame, foreign_keys: DataFrame, names: FlatNames) -> Metadata:
    objects = (
        columns.select(F.col(names.table).alias("object_name"))
        .distinct()
        .select(
            "object_name",
            F.array(F.lit(names.key)).alias("primary_key_raw_fields"),
            F.initcap(F.regexp_replace(camel_to_words(F.col("object_name")), "_", " ")).alias(
                "description"
            ),
            no_names().alias("text_table_names"),
        )
    )
    fields = columns.select(
        F.col(names.table).alias("object_name"),
        F.col(names.column).alias("field_name"),
        F.col(names.column).alias("raw_field_name"),
        F.col(names.type).alias("field_type"),
        F.col(names.description).alias("field_description"),
    )
    own = names.link_table if names.link_table in foreign_keys.columns else f"Fk_{names.link_table}"
    described = (
        F.col(names.link_name)
        if names.link_name
        else F.concat_ws(" to ", F.col(own), F.col(names.target_table))
    )
    links = foreign_keys.select(
        F.col(own).alias("primary_object_name"),
        F.array(F.col(names.link_column)).alias("primary_object_raw_fields"),
        F.col(names.target_table).alias("foreign_object_name"),
        F.array(F.col(names.target_column)).alias("foreign_object_raw_fields"),
        described.alias("link_description"),
    )
    return conformed(objects, fields, links)


def discover_commented(columns: DataFrame) -> Metadata:
    """Columns table with comments and key marks; the greatest comment names a column.

    The source states no foreign keys, so there are no links.  Key columns are in name order.
    """
    latest = latest_rows(columns, ["TABLE_NAME", "COLUMN_NAME"], ["COMMENTS"])
    objects = (
        latest.filter(F.col("PRIMARY_KEY") == "PK")
        .groupBy(F.col("TABLE_NAME").alias("object_name"))
        .agg(F.sort_array(F.collect_set("COLUMN_NAME")).alias("primary_key_raw_fields"))
    )
    fields = latest.select(
        F.col("TABLE_NAME").alias("object_name"),
        F.col("COMMENTS").alias("field_name"),
        F.col("COLUMN_NAME").alias("raw_field_name"),
        F.col("DATA_TYPE").alias("field_type"),
    ).dropDuplicates()
    links = columns.sparkSession.createDataFrame([], LINKS)
    return conformed(objects, fields, links)


# The historian's element columns and key.
HISTORIAN_FIELDS = (
    "parentWebId",
    "webId",
    "id",
    "name",
    "description",
    "path",
    "hasChildren",
    "templateName",
    "type",
    "entityType",
)
HISTORIAN_KEY = "path"


def discover_historian(spark: SparkSession, object_name: str) -> Metadata:
    fields = [(object_name, f, f, "string", None, None, None, None) for f in HISTORIAN_FIELDS]
    objects = [(object_name, [HISTORIAN_KEY], "Elements of all roots in one table", [])]
    return conformed(
        spark.createDataFrame(objects, OBJECTS),
        spark.createDataFrame(fields, FIELDS),
        spark.createDataFrame([], LINKS),
    )
