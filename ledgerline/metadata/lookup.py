"""Plan-time reads of metadata.  These are the only rows a pipeline brings to the driver: the
dictionary entries of the tables at hand."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.clean import FieldType
from ledgerline.operators.quality import require_single
from ledgerline.operators.sets import change_flags, changed_names

from ledgerline.metadata.schemas import Metadata


@dataclass(frozen=True)
class Link:
    foreign_object: str
    own_fields: tuple[str, ...]
    foreign_fields: tuple[str, ...]


def primary_key_fields(metadata: Metadata, table: str) -> list[str]:
    rows = metadata.objects.filter(F.col("object_name") == table).limit(2).collect()
    return list(require_single(rows, f"object {table}")["primary_key_raw_fields"])


def text_tables(metadata: Metadata, table: str) -> list[str]:
    rows = (
        metadata.objects.filter(
            (F.col("object_name") == table) & (F.size("text_table_names") > 0)
        )
        .select("text_table_names")
        .limit(2)
        .collect()
    )
    return list(require_single(rows, f"text tables of {table}")[0]) if rows else []


def field_rows(metadata: Metadata, tables: Sequence[str]) -> dict[str, list]:
    """Raw name, label, type, domain and literal per table, in field order."""
    rows = (
        metadata.fields.filter(F.col("object_name").isin(list(tables)))
        .orderBy("object_name", F.col("field_order").asc_nulls_last(), "raw_field_name")
        .collect()
    )
    found: dict[str, list] = {t: [] for t in tables}
    for row in rows:
        found[row["object_name"]].append(row)
    return found


def field_types(rows: Sequence) -> list[FieldType]:
    return [FieldType(r["raw_field_name"], r["field_type"], r["domain_name"]) for r in rows]


def labels(rows: Sequence) -> dict[str, str | None]:
    return {r["raw_field_name"]: r["field_name"] for r in rows}


def literals(rows: Sequence) -> dict[str, str]:
    return {r["raw_field_name"]: r["field_literal"] for r in rows if r["field_literal"] is not None}


def links_of(metadata: Metadata, table: str, targets: Sequence[str]) -> list[Link]:
    """Links from a table to any of the targets, in a fixed order."""
    rows = (
        metadata.links.filter(
            (F.col("primary_object_name") == table)
            & F.col("foreign_object_name").isin(list(targets))
        )
        .orderBy("foreign_object_name", "primary_object_raw_fields", "foreign_object_raw_fields")
        .collect()
    )
    return [
        Link(
            r["foreign_object_name"],
            tuple(r["primary_object_raw_fields"]),
            tuple(r["foreign_object_raw_fields"]),
        )
        for r in rows
    ]


def metadata_diffs(names: DataFrame, current: Metadata, previous: Metadata) -> DataFrame:
    """Which tables changed in objects, fields or links since the previous discovery."""
    return change_flags(
        names,
        [
            changed_names(current.objects, previous.objects, "object_name"),
            changed_names(current.fields, previous.fields, "object_name"),
            changed_names(current.links, previous.links, "primary_object_name"),
        ],
    )
