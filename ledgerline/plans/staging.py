"""From raw source tables to current, renamed tables.

    raw -> cleaned -> enriched -> renamed change log -> current -> one table over all sources

Each stage is a function from tables to a table; a job calls them in this order and writes where
it needs a boundary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.clean import apply_cleaners
from ledgerline.functions.keys import (
    ENGINE_PREFIX,
    customization_name,
    with_foreign_keys,
    with_primary_key,
    with_source,
    with_title,
)
from ledgerline.metadata import lookup
from ledgerline.metadata.schemas import Metadata
from ledgerline.operators.columns import (
    blanks_to_null,
    drop_binary,
    quoted,
    rename,
    rename_mapping,
    with_literals,
)
from ledgerline.operators.joins import enrich
from ledgerline.operators.quality import require_columns, with_schema_report
from ledgerline.operators.sets import lineage_union, row_counts, wide_union
from ledgerline.streaming.changelog import current_rows, fold_changes

MISMATCH_COLUMN = f"{ENGINE_PREFIX}schema_mismatch"
LINEAGE_COLUMN = "source_dataset_name"

# Counters that connectors add and no dictionary lists.
CONNECTOR_COLUMNS = ("ODQ_ENTITYCNTR",)


@dataclass(frozen=True)
class TableSpec:
    """One source table and how to treat it."""

    name: str
    cleaners: tuple[str, ...] = ()
    comparison_columns: tuple[str, ...] = ()
    change_mode_column: str | None = None
    unique_keys: bool = False
    customization_only: bool = False
    customizations: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceSpec:
    """One source system: its name, tables and defaults for all of them."""

    name: str
    tables: tuple[TableSpec, ...]
    cleaners: tuple[str, ...] = ("typed_columns",)
    comparison_columns: tuple[str, ...] = ()
    change_mode_column: str | None = None
    connector_prefixes: tuple[str, ...] = ()
    foreign_keys: bool = True

    def table(self, name: str) -> TableSpec:
        found = [t for t in self.tables if t.name == name]
        if len(found) != 1:
            raise ValueError(f"table {name} is listed {len(found)} times")
        return found[0]

    def comparison(self, table: TableSpec) -> list[str]:
        return [*self.comparison_columns, *table.comparison_columns]

    def change_mode(self, table: TableSpec) -> str | None:
        return table.change_mode_column or self.change_mode_column


def cleaned(
    components: Mapping[str, DataFrame], source: SourceSpec, table_name: str, metadata: Metadata
) -> DataFrame:
    """Typed rows with keys, title, source and foreign keys."""
    table = source.table(table_name)
    rows = lookup.field_rows(metadata, [table_name])[table_name]
    mode = source.change_mode(table)
    df = with_schema_report(
        lineage_union(components, LINEAGE_COLUMN),
        [r["raw_field_name"] for r in rows],
        [
            LINEAGE_COLUMN,
            *CONNECTOR_COLUMNS,
            *source.comparison(table),
            *([mode] if mode else []),
        ],
        source.connector_prefixes,
        MISMATCH_COLUMN,
    )
    df = apply_cleaners(df, [*source.cleaners, *table.cleaners], lookup.field_types(rows))
    df = with_literals(drop_binary(blanks_to_null(df)), lookup.literals(rows))
    df = with_primary_key(df, source.name, lookup.primary_key_fields(metadata, table_name))
    df = with_title(with_source(df.dropna(subset=["primary_key"]), source.name))
    if not source.foreign_keys:
        return df
    links = lookup.links_of(metadata, table_name, [t.name for t in source.tables])
    return with_foreign_keys(df, source.name, [(l.foreign_object, l.own_fields) for l in links])


def _customization(
    other: DataFrame, link: lookup.Link, fields: Sequence[str], titles: Sequence[str]
) -> DataFrame:
    """Link fields, the other columns under their customization names, and title candidates."""
    return other.select(
        *[quoted(c) for c in link.foreign_fields],
        *[
            quoted(c).alias(customization_name(c, link.foreign_object, link.own_fields))
            for c in fields
        ],
        *[quoted(c).alias(f"title_{i + 1}") for i, c in enumerate(titles)],
    )


def enriched(
    df: DataFrame,
    source: SourceSpec,
    table_name: str,
    metadata: Metadata,
    customizations: Mapping[str, DataFrame],
    previous: DataFrame | None = None,
    changed_customizations: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows with the columns of their customization tables.

    Text tables joined on the whole key (and literal fields) also bring title candidates.  With
    ``previous``, earlier rows that the changed customization rows touch are enriched again.
    """
    table = source.table(table_name)
    if table.customization_only:
        return df
    df = df.drop(MISMATCH_COLUMN)
    links = lookup.links_of(metadata, table_name, table.customizations)
    if not links:
        return df
    texts = set(lookup.text_tables(metadata, table_name))
    known = lookup.field_rows(metadata, [table_name, *{l.foreign_object for l in links}])
    key = set(lookup.primary_key_fields(metadata, table_name)) | set(
        lookup.literals(known[table_name])
    )
    earlier = previous.drop(MISMATCH_COLUMN) if previous is not None else None
    for link in links:
        other = customizations[link.foreign_object]
        require_columns(df, link.own_fields, f"link {table_name} to {link.foreign_object}")
        require_columns(other, link.foreign_fields, f"link {table_name} to {link.foreign_object}")
        spec = source.table(link.foreign_object)
        mode = source.change_mode(spec)
        declared = [r["raw_field_name"] for r in known[link.foreign_object]]
        extra = [*source.comparison(spec), *([mode] if mode else [])]
        fields = [
            c
            for c in dict.fromkeys([*declared, *extra])
            if c not in link.foreign_fields and c in other.columns
        ]
        titled = link.foreign_object in texts and key == set(link.own_fields)
        titles = [c for c in declared if c in fields] if titled else []
        pairs = list(zip(link.own_fields, link.foreign_fields))
        df = enrich(df, _customization(other, link, fields, titles), pairs, "left")
        if earlier is not None:
            changed = (changed_customizations or {}).get(link.foreign_object, other.limit(0))
            earlier = enrich(earlier, _customization(changed, link, fields, titles), pairs)
    return df.unionByName(earlier) if earlier is not None else df


def renamed(
    df: DataFrame, table_name: str, metadata: Metadata, customizations: Sequence[str] = ()
) -> DataFrame:
    """Readable column names; a title candidate replaces the title."""
    known = lookup.field_rows(metadata, [table_name, *customizations])
    labels = {t: lookup.labels(rows) for t, rows in known.items()}
    own = labels.pop(table_name)
    out = rename(df, rename_mapping(df.columns, own, labels))
    return out.withColumn("title", F.col("title_1")) if "title_1" in out.columns else out


def comparison_columns(
    source: SourceSpec, table_name: str, metadata: Metadata, present: Sequence[str]
) -> list[str]:
    """Comparison columns of the table and of its customizations, under their renamed names."""
    table = source.table(table_name)
    raw = source.comparison(table)
    if not table.customization_only:
        for link in lookup.links_of(metadata, table_name, table.customizations):
            raw += [
                customization_name(c, link.foreign_object, link.own_fields)
                for c in source.comparison(source.table(link.foreign_object))
            ]
    known = lookup.field_rows(metadata, [table_name, *table.customizations])
    labels = {t: lookup.labels(rows) for t, rows in known.items()}
    own = labels.pop(table_name)
    mapping = rename_mapping(raw, own, labels)
    wanted = list(dict.fromkeys(mapping[c] for c in raw))
    missing = [c for c in wanted if c not in present]
    if missing:
        raise ValueError(f"{table_name} has no comparison columns {missing}")
    return wanted


def current(
    changes: DataFrame,
    source: SourceSpec,
    table_name: str,
    metadata: Metadata,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Latest row per key without deleted ones; without comparison columns all rows stay."""
    table = source.table(table_name)
    df = changes.drop(MISMATCH_COLUMN)
    comparison = comparison_columns(source, table_name, metadata, df.columns)
    if not comparison:
        return df
    state = fold_changes(
        df,
        previous,
        "primary_key",
        comparison,
        late_safe=False,
        one_per_key=table.unique_keys,
        tie_break=[c for c in df.columns if c not in comparison] if table.unique_keys else (),
    )
    return current_rows(state, source.change_mode(table))


def final(tables: Sequence[DataFrame]) -> DataFrame:
    """One table over all sources."""
    return wide_union(tables)


def counts_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables)
