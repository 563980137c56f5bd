"""Projections: renames, literals, casts and column pruning by content.

Pruning by content needs one look at the data.  Each such operator runs exactly one wide
aggregate, whose single result row is the only thing that reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.functions.clean import blank_to_null
from ledgerline.functions.keys import CUSTOMIZATION_MARK, FOREIGN_KEY_MARK, KEY_DELIMITER

# Fixed values of the label grammar: characters a column name must not hold, one replacement.
FORBIDDEN_CHARACTERS = ".()/-,:=?+';"
CURRENCY_SPELLING = ("US$", "USD")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def column_label(raw: str, label: str | None) -> str:
    """``label_|_raw`` in lower case; no label keeps the raw name, an empty one keeps the delimiter."""
    if label is None:
        return raw
    name = f"{label}{KEY_DELIMITER}{raw}"
    name = name.translate({ord(ch): None for ch in FORBIDDEN_CHARACTERS})
    return name.replace(*CURRENCY_SPELLING).replace(" ", "_").lower()


def rename_mapping(
    columns: Iterable[str],
    labels: Mapping[str, str | None],
    customization_labels: Mapping[str, Mapping[str, str | None]] | None = None,
    keep: Sequence[str] = ("title",),
) -> dict[str, str]:
    """New name per column: foreign keys stay, customization columns use their own table's labels."""
    customization_labels = customization_labels or {}
    mark = re.escape(KEY_DELIMITER)
    foreign = re.compile(rf"\S+{mark}{FOREIGN_KEY_MARK}\S+")
    custom = re.compile(rf"(\S+){mark}{CUSTOMIZATION_MARK}(\S+){mark}(\S+)")

    def renamed(column: str, known: Mapping[str, str | None]) -> str:
        if column in known and column not in keep:
            return column_label(column, known[column])
        return column.lower()

    mapping = {}
    for column in columns:
        parts = custom.fullmatch(column)
        if foreign.match(column):
            mapping[column] = column
        elif parts:
            field, table, link = parts.groups()
            head = renamed(field, customization_labels.get(table, {}))
            mapping[column] = f"{head}{KEY_DELIMITER}{CUSTOMIZATION_MARK}{table}{KEY_DELIMITER}{link}"
        else:
            mapping[column] = renamed(column, labels)
    return mapping


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select([quoted(c).alias(mapping.get(c, c)) for c in df.columns])


def with_literals(df: DataFrame, literals: Mapping[str, str]) -> DataFrame:
    """Constant columns; an existing column of that name is replaced."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text becomes null in every string column; other types are left alone."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: blank_to_null(quoted(name)) for name in text})


def drop_binary(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)])


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal as double, also inside arrays, maps and structs."""

    def widened(t: T.DataType) -> T.DataType:
        if isinstance(t, T.DecimalType):
            return T.DoubleType()
        if isinstance(t, T.ArrayType):
            return T.ArrayType(widened(t.elementType), t.containsNull)
        if isinstance(t, T.MapType):
            return T.MapType(widened(t.keyType), widened(t.valueType), t.valueContainsNull)
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, widened(f.dataType), f.nullable) for f in t])
        return t

    return df.select(
        [
            quoted(f.name)
            if widened(f.dataType) == f.dataType
            else quoted(f.name).cast(widened(f.dataType)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _one_row(df: DataFrame, measures: Mapping[str, Column]) -> dict[str, int]:
    if not measures:
        return {}
    names = list(measures)
    row = df.agg(*[measures[n].alias(f"m{i}") for i, n in enumerate(names)]).first()
    return dict(zip(names, row))


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Without the columns that hold no value at all."""
    counts = _one_row(df, {c: F.count(quoted(c)) for c in df.columns if c not in keep})
    return df.drop(*[c for c, n in counts.items() if n == 0])


def drop_constant_columns(df: DataFrame, exact: bool = False) -> DataFrame:
    """Without the columns that hold at most one distinct value."""
    measure = F.count_distinct if exact else F.approx_count_distinct
    counts = _one_row(df, {c: measure(quoted(c)) for c in df.columns})
    return df.drop(*[c for c, n in counts.items() if n <= 1])


def columns_by_null_count(
    df: DataFrame, textual: bool = False, without_empty: bool = False
) -> list[str]:
    """Column names, fewest nulls first, on request without those that hold nothing else.

    ``textual`` compares the counts as text (10 before 2).
    """
    nulls = {c: F.count_if(quoted(c).isNull()) for c in df.columns}
    counts = _one_row(df, {**nulls, None: F.count("*")})
    rows = counts.pop(None)
    names = [c for c in counts if not without_empty or counts[c] < rows]
    if textual:
        return sorted(names, key=lambda c: f"{counts[c]}_{c}")
    return sorted(names, key=lambda c: (counts[c], c))


def order_by_null_count(
    df: DataFrame, textual: bool = False, without_empty: bool = False
) -> DataFrame:
    return df.select([quoted(c) for c in columns_by_null_count(df, textual, without_empty)])


def without_shared_columns(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop what ``other`` has as well, but for the join keys."""
    return df.drop(*[c for c in df.columns if c in set(other.columns) - set(keys)])


def contract(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed ordered output; a missing column is an analysis error."""
    return df.select([quoted(c) for c in columns])
