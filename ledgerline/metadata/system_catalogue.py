"""Discovery from the system views of a relational database (tables, columns, keys, indexes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.text import camel_to_words, catalogue_type
from ledgerline.metadata.schemas import Metadata, conformed, no_names
from ledgerline.operators.rollups import ordered_names


def _words(c: Column) -> Column:
    return F.regexp_replace(camel_to_words(c), "__", "_")


def object_metadata(
    tables: DataFrame, indexes: DataFrame, index_columns: DataFrame, columns: DataFrame
) -> DataFrame:
    """Tables with the columns of their primary-key index in column order; none means an empty key."""
    keys = (
        indexes.filter("is_primary_key")
        .select("object_id", "index_id")
        .join(index_columns.select("object_id", "index_id", "column_id"), ["object_id", "index_id"])
        .join(columns.select("object_id", "column_id", "name"), ["object_id", "column_id"])
    )
    lists = ordered_names(
        keys, ["object_id", "index_id"], "column_id", {"primary_key_raw_fields": "name"}
    )
    return (
        tables.select(F.col("name").alias("object_name"), "object_id")
        .join(lists, "object_id", "left")
        .select(
            "object_name",
            F.coalesce("primary_key_raw_fields", no_names()).alias("primary_key_raw_fields"),
            no_names().alias("text_table_names"),
        )
    )


def _flagged(df: DataFrame, marks: DataFrame, flag: str) -> DataFrame:
    """Left join with distinct (object, column) marks as a boolean."""
    keys = ["object_id", "column_id"]
    joined = df.join(marks.select(*keys).distinct().withColumn(flag, F.lit(True)), keys, "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def field_metadata(views: dict[str, DataFrame], with_flags: bool = False) -> DataFrame:
    """All columns with a translated type.

    Index, key, constraint, property and computed-column views only tell what kind a column is;
    they are joined when ``with_flags`` asks for that.
    """
    columns = views["columns"].select(
        F.col("name").alias("raw_field_name"),
        "object_id",
        "column_id",
        "user_type_id",
        "default_object_id",
    )
    named = views["tables"].select(F.col("name").alias("table"), "object_id")
    types = views["types"].select(F.col("name").alias("type_name"), "user_type_id")
    fields = named.join(columns, "object_id", "left").join(types, "user_type_id", "left")
    flags: list[str] = []
    if with_flags:
        indexed = views["index_columns"].join(
            views["indexes"].select(
                "object_id", "index_id", "is_primary_key", "is_unique_constraint"
            ),
            ["object_id", "index_id"],
        )
        parents = [
            F.col("parent_object_id").alias("object_id"),
            F.col("parent_column_id").alias("column_id"),
        ]
        constrained = views["foreign_key_columns"].join(
            views["foreign_keys"].select(F.col("object_id").alias("constraint_object_id")),
            "constraint_object_id",
            "left_semi",
        )
        described = (
            views["extended_properties"]
            .filter((F.col("name") == "MS_Description") & (F.col("class_desc") == "OBJECT_OR_COLUMN"))
            .select(F.col("major_id").alias("object_id"), F.col("minor_id").alias("column_id"))
        )
        marks = {
            "is_primary_key": indexed.filter("is_primary_key"),
            "is_foreign_key": constrained.select(*parents),
            "is_checked": views["check_constraints"].select(*parents),
            "is_unique": indexed.filter("is_unique_constraint"),
            "is_described": described,
            "is_computed": views["computed_columns"],
        }
        for flag, rows in marks.items():
            fields = _flagged(fields, rows, flag)
        defaults = (
            views["default_constraints"]
            .select(F.col("object_id").alias("default_object_id"))
            .distinct()
            .withColumn("has_default", F.lit(True))
        )
        fields = fields.join(defaults, "default_object_id", "left").withColumn(
            "has_default", F.coalesce("has_default", F.lit(False))
        )
        flags = [*marks, "has_default"]
    return fields.select(
        _words(F.col("table")).alias("object_name"),
        _words(F.col("raw_field_name")).alias("field_name"),
        "raw_field_name",
        catalogue_type(F.col("type_name")).alias("field_type"),
        *flags,
    )


def link_metadata(
    tables: DataFrame, foreign_keys: DataFrame, foreign_key_columns: DataFrame, columns: DataFrame
) -> DataFrame:
    """One link per constraint name and table pair, fields in the referring table's column order."""
    pairs = foreign_key_columns.select(
        "constraint_object_id",
        F.col("parent_object_id").alias("from_id"),
        F.col("parent_column_id").alias("from_column"),
        F.col("referenced_object_id").alias("to_id"),
        F.col("referenced_column_id").alias("to_column"),
    )
    constraints = foreign_keys.select(
        F.col("object_id").alias("constraint_object_id"),
        F.regexp_replace("name", "FK_", "").alias("link_description"),
        F.col("parent_object_id").alias("from_table_id"),
        F.col("referenced_object_id").alias("to_table_id"),
    )

    def tables_as(side: str) -> DataFrame:
        return tables.select(
            F.col("object_id").alias(f"{side}_table_id"), F.col("name").alias(f"{side}_table")
        )

    def columns_as(side: str) -> DataFrame:
        return columns.select(
            F.col("object_id").alias(f"{side}_id"),
            F.col("column_id").alias(f"{side}_column"),
            F.col("name").alias(f"{side}_name"),
        )

    joined = (
        constraints.join(pairs, "constraint_object_id")
        .join(tables_as("from"), "from_table_id")
        .join(tables_as("to"), "to_table_id")
        .join(columns_as("from"), ["from_id", "from_column"])
        .join(columns_as("to"), ["to_id", "to_column"])
    )
    lists = ordered_names(
        joined,
        ["from_table", "to_table", "link_description"],
        "from_column",
        {"own": "from_name", "other": "to_name"},
    )
    return lists.select(
        F.col("from_table").alias("primary_object_name"),
        F.col("own").alias("primary_object_raw_fields"),
        F.col("to_table").alias("foreign_object_name"),
        F.col("other").alias("foreign_object_raw_fields"),
        "link_description",
    )


def discover(views: dict[str, DataFrame]) -> Metadata:
    return conformed(
        object_metadata(
            views["tables"], views["indexes"], views["index_columns"], views["columns"]
        ),
        field_metadata(views),
        link_metadata(
            views["tables"], views["foreign_keys"], views["foreign_key_columns"], views["columns"]
        ),
    )
