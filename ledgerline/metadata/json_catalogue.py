"""Discovery from a data-catalogue export: one JSON document per table, columns as an object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerline.functions.text import reference_table
from ledgerline.metadata.schemas import Metadata, conformed

# Shape of one table document.
DOCUMENT = (
    "struct<"
    "name: string, "
    "schema: struct<description: string, properties: "
    "map<string, struct<description: string, type: string, format: string>>>, "
    "properties: struct<IdentifierPaths: array<string>>>"
)

# Fixed value: a column whose name holds this refers to another table.
REFERENCE_MARK = "ref"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per table.  Each export file is one JSON object that lists table documents."""
    return (
        spark.read.schema(f"objects array<{DOCUMENT}>")
        .option("multiLine", True)
        .json(path)
        .select(F.inline("objects"))
    )


def described_tables(documents: DataFrame) -> DataFrame:
    """Name, key, title and columns per table.

    The title is what follows the system and raw name in the text before the first comma; the
    first word of an identifier path is the key column.  A column without a description is
    described by its name, and a format is more specific than a type.
    """
    title = F.regexp_extract(
        F.split_part("schema.description", F.lit(", "), F.lit(1)), r"^[A-Z]+[\s.]\w+[\s.]([\s\S]+)", 1
    )
    columns = F.transform(
        F.map_entries("schema.properties"),
        lambda e: F.struct(
            e["key"].alias("column_name"),
            F.coalesce(e["value"]["description"], e["key"]).alias("column_desc"),
            F.coalesce(e["value"]["format"], e["value"]["type"]).alias("column_type"),
        ),
    )
    return documents.select(
        F.lower("name").alias("object_name"),
        F.nullif(title, F.lit("")).alias("description"),
        F.transform(
            "properties.IdentifierPaths", lambda p: F.regexp_extract(p, r"(\w+)", 1)
        ).alias("primary_key_raw_fields"),
        columns.alias("columns"),
    )


def field_metadata(tables: DataFrame) -> DataFrame:
    return tables.select("object_name", F.inline("columns")).select(
        "object_name",
        F.col("column_desc").alias("field_name"),
        F.col("column_name").alias("raw_field_name"),
        F.col("column_type").alias("field_type"),
        F.col("column_desc").alias("field_description"),
    )


def link_metadata(objects: DataFrame, fields: DataFrame) -> DataFrame:
    """Tables with reference columns, linked by key lists to the tables their texts name.

    A table whose references lead nowhere keeps one link without a target.
    """
    keys = objects.select("object_name", "primary_key_raw_fields")
    # the same projection and key as in the join of the owners, so that one reading serves both
    targets = keys.select(
        F.col("object_name").alias("known"),
        F.col("primary_key_raw_fields").alias("foreign_object_raw_fields"),
    )
    references = fields.filter(F.col("raw_field_name").contains(REFERENCE_MARK)).select(
        "object_name",
        reference_table(F.col("field_description"), F.col("object_name")).alias("target"),
    )
    followed = references.join(targets, F.col("target") == F.col("known"), "left")
    known_first = Window.partitionBy("object_name").orderBy(F.col("known").desc_nulls_last())
    return (
        followed.withColumn("place", F.row_number().over(known_first))
        .filter("known is not null or place = 1")
        .join(keys, "object_name")
        .select(
            F.col("object_name").alias("primary_object_name"),
            F.col("primary_key_raw_fields").alias("primary_object_raw_fields"),
            F.col("known").alias("foreign_object_name"),
            "foreign_object_raw_fields",
        )
    )


def discover(documents: DataFrame) -> Metadata:
    tables = described_tables(documents)
    fields = field_metadata(tables)
    objects = tables.select("object_name", "primary_key_raw_fields", "description")
    return conformed(objects, fields, link_metadata(objects, fields))
