"""Key values and key column names.

Two delimiters exist: one inside source-system keys and column names, one between the
parts of analytical keys.  A primary key skips null parts; a foreign key is null as soon
as one part is null, so it never matches a partially known row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the key and column-name grammar.
KEY_DELIMITER = "_|_"
PAIR_DELIMITER = "_||_"
FOREIGN_KEY_MARK = "foreign_key_"
CUSTOMIZATION_MARK = "customization_field_"
ENGINE_PREFIX = "engine_"

# Metrics that get a time-series pointer on every entity unless the caller names others.
DEFAULT_SERIES_METRICS = (
    "item_count",
    "sold_to_count",
    "bill_to_count",
    "account_count",
    "billed_quantity",
    "sales_value",
    "avg_unit_price",
    "cumulative_product_count",
    "lagged_cumulative_product_count",
)


def _columns(parts: Iterable[str | Column]) -> list[Column]:
    return [F.col(p) if isinstance(p, str) else p for p in parts]


def primary_key(source: str, parts: Sequence[str | Column]) -> Column:
    """Source name and key parts joined; null parts are skipped, a blank source is left out."""
    head = [F.lit(source)] if source.strip() else []
    return F.concat_ws(KEY_DELIMITER, *head, *_columns(parts))


def foreign_key(source: str, parts: Sequence[str | Column]) -> Column:
    """Like :func:`primary_key` but null when any part is null."""
    columns = [F.lit(source), *_columns(parts)]
    return F.when(F.concat(*columns).isNotNull(), F.concat_ws(KEY_DELIMITER, *columns))


def foreign_key_name(fields: Sequence[str], target: str) -> str:
    return f"{'_'.join(fields).lower()}{KEY_DELIMITER}{FOREIGN_KEY_MARK}{target}"


def customization_name(field: str, table: str, link_fields: Sequence[str]) -> str:
    return f"{field}{KEY_DELIMITER}{CUSTOMIZATION_MARK}{table}{KEY_DELIMITER}{'_'.join(link_fields)}"


def pair_key(*parts: str | Column) -> Column:
    return F.concat_ws(PAIR_DELIMITER, *_columns(parts))


def role_pair_keys(roles: dict[str, str], members: dict[str, str]) -> dict[str, Column]:
    """Foreign keys into pair entities, one per customer role and member kind."""
    return {
        f"customer_{role}_{member}_pair_foreign_key": pair_key(role_column, member_column)
        for member, member_column in members.items()
        for role, role_column in roles.items()
    }


def with_series_ids(
    df: DataFrame,
    key: str,
    group_type: str,
    filters: Sequence[str] = ("all",),
    metrics: Sequence[str] = DEFAULT_SERIES_METRICS,
) -> DataFrame:
    """Pointer columns from an entity to its time series, one per metric and filter."""
    filters = list(filters) or ["all"]
    return df.withColumns(
        {
            KEY_DELIMITER.join([group_type, name, metric, "time_series_id"]): pair_key(
                F.lit(group_type), F.lit(name), F.col(key), F.lit(metric)
            )
            for metric in metrics
            for name in filters
        }
    )


def template(*parts: str | Column) -> Column:
    """Text from literals and columns (pass columns as ``Column``); null if any part is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def has_column(df: DataFrame, name: str) -> bool:
    """Case-insensitive presence test."""
    return name.lower() in {c.lower() for c in df.columns}


def with_source(df: DataFrame, source: str, column: str = "source") -> DataFrame:
    """Source-name column; a clash with a data column moves it to the engine's own prefix."""
    name = f"{ENGINE_PREFIX}{column}" if has_column(df, column) else column
    return df.withColumn(name, F.lit(source))


def with_primary_key(
    df: DataFrame, source: str, fields: Sequence[str], column: str = "primary_key"
) -> DataFrame:
    """Add the key unless the table brings one (an upper-case one is renamed)."""
    if column in df.columns:
        return df
    if column.upper() in df.columns:
        return df.withColumnRenamed(column.upper(), column)
    return df.withColumn(column, primary_key(source, fields))


def with_title(df: DataFrame, fallback: str = "primary_key", column: str = "title") -> DataFrame:
    """The table's own title in either case, else the key."""
    if "title" in df.columns:
        return df.withColumn(column, F.col("title"))
    if "TITLE" in df.columns:
        df = df.withColumnRenamed("TITLE", "title")
        return df.withColumn(column, F.col("title"))
    return df.withColumn(column, F.col(fallback))


def with_foreign_keys(
    df: DataFrame, source: str, links: Iterable[tuple[str, Sequence[str]]]
) -> DataFrame:
    """One column per link ``(target table, own fields)`` whose fields all exist."""
    present = set(df.columns)
    return df.withColumns(
        {
            foreign_key_name(fields, target): foreign_key(source, fields)
            for target, fields in links
            if set(fields) <= present
        }
    )
