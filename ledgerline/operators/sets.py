"""Unions and differences of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def wide_union(tables: Sequence[DataFrame]) -> DataFrame:
    """Union over all columns, in first-seen order, null where a table lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def lineage_union(tables: Mapping[str, DataFrame], column: str = "source_dataset_name") -> DataFrame:
    """Union of batch components with the component's name on every row."""
    return union_by_name([df.withColumn(column, F.lit(name)) for name, df in tables.items()])


def changed_names(current: DataFrame, previous: DataFrame, name: str) -> DataFrame:
    """Distinct names with a row on one side only."""
    previous = previous.select(current.columns)
    return (
        current.subtract(previous)
        .unionByName(previous.subtract(current))
        .select(F.col(name).alias("table_name"))
        .distinct()
    )


def change_flags(names: DataFrame, changed: Sequence[DataFrame]) -> DataFrame:
    """Every name with a flag that tells whether any of the change lists holds it."""
    hits = union_by_name(changed).distinct().withColumn("has_changed", F.lit(True))
    return (
        names.select("table_name")
        .distinct()
        .join(hits, "table_name", "left")
        .select("table_name", F.coalesce("has_changed", F.lit(False)).alias("has_changed"))
    )


def row_counts(tables: Mapping[str, DataFrame], source: str = "source") -> DataFrame:
    """Rows per source and table; each table is counted before the union."""
    return union_by_name(
        [
            df.groupBy(F.col(source).alias("source"))
            .agg(F.count("*").alias("count"))
            .select("source", F.lit(name).alias("table"), "count")
            for name, df in tables.items()
        ]
    )
