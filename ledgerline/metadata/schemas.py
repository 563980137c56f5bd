"""Schemas of the four metadata tables and helpers to bring a discovery result into them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

_NAMES = T.ArrayType(T.StringType())

OBJECTS = T.StructType(
    [
        T.StructField("object_name", T.StringType()),
        T.StructField("primary_key_raw_fields", _NAMES),
        T.StructField("description", T.StringType()),
        T.StructField("text_table_names", _NAMES),
    ]
)
FIELDS = T.StructType(
    [
        T.StructField("object_name", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("raw_field_name", T.StringType()),
        T.StructField("field_type", T.StringType()),
        T.StructField("field_description", T.StringType()),
        T.StructField("domain_name", T.StringType()),
        T.StructField("field_literal", T.StringType()),
        T.StructField("field_order", T.IntegerType()),
    ]
)
LINKS = T.StructType(
    [
        T.StructField("primary_object_name", T.StringType()),
        T.StructField("primary_object_raw_fields", _NAMES),
        T.StructField("foreign_object_name", T.StringType()),
        T.StructField("foreign_object_raw_fields", _NAMES),
        T.StructField("link_description", T.StringType()),
    ]
)
DIFFS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("has_changed", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Metadata:
    """Discovery result: objects with keys, fields, and foreign-key links."""

    objects: DataFrame
    fields: DataFrame
    links: DataFrame


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in order; a missing one is null of its type."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def conformed(objects: DataFrame, fields: DataFrame, links: DataFrame) -> Metadata:
    return Metadata(conform(objects, OBJECTS), conform(fields, FIELDS), conform(links, LINKS))


def no_names():
    """Empty list of names as a column."""
    return F.array().cast(_NAMES)
