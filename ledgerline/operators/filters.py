"""Row filters.  Each one is a plain predicate, so it reaches the scan when its columns are raw."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.dates import day, months_before
from ledgerline.operators.columns import quoted

DELETED = "D"


def not_deleted(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(quoted(flag).isNull())


def drop_deletions(df: DataFrame, mode_column: str, keep_unknown: bool = False) -> DataFrame:
    """Without deletion records.  An unknown mode is dropped too unless asked for."""
    if mode_column not in df.columns:
        mode_column = mode_column.lower()
    mode = quoted(mode_column)
    predicate = mode != DELETED
    return df.filter(predicate | mode.isNull() if keep_unknown else predicate)


def recent(df: DataFrame, date_column: str, as_of: dt.date, months: int) -> DataFrame:
    """Rows of the last months, with the cut-off as a literal so that it prunes files."""
    return df.filter(quoted(date_column) >= day(months_before(as_of, months)))


def filled(*columns: str) -> Column:
    """All columns hold non-empty text (or any non-text value)."""
    return reduce(
        lambda a, b: a & b,
        [quoted(c).isNotNull() & (F.length(quoted(c).cast("string")) > 0) for c in columns],
    )


def where_all(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, predicates)) if predicates else df


def members(df: DataFrame, column: str, allowed: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose value is in a short list, or in the first column of a table."""
    if isinstance(allowed, DataFrame):
        keys = allowed.select(F.col(allowed.columns[0]).alias(column)).distinct()
        return df.join(keys, column, "left_semi")
    return df.filter(quoted(column).isin(list(allowed)))


def is_member(c: Column, allowed: Sequence[str]) -> Column:
    """True or false, never null."""
    return F.coalesce(c.isin(list(allowed)), F.lit(False))


def business_rules(
    df: DataFrame,
    keep: dict[str, Sequence],
    exclude: dict[str, Sequence],
    exclude_prefix: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows inside every ``keep`` list and outside every ``exclude`` list and prefix list.

    An unknown value cannot be inside a keep list, and is not outside-proof either way for an
    exclude list: it stays.
    """
    predicates = [quoted(c).isin(list(values)) for c, values in keep.items()]
    predicates += [~is_member(quoted(c), values) for c, values in exclude.items()]
    for c, prefixes in (exclude_prefix or {}).items():
        for prefix in prefixes:
            predicates.append(~F.coalesce(quoted(c).startswith(prefix), F.lit(False)))
    return where_all(df, predicates)


def genuine_relations(
    df: DataFrame, owner: str, partner: str, role_column: str, roles: Sequence[str], sentinel: str | None
) -> DataFrame:
    """Partner relations of the given roles, without the placeholder partner and self-relations."""
    predicates = [quoted(role_column).isin(list(roles)), quoted(owner) != quoted(partner)]
    if sentinel is not None:
        predicates.append(quoted(partner) != sentinel)
    return where_all(df, predicates)


def is_subset(small: Column, large: Column) -> Column:
    """Every distinct element of ``small`` occurs in ``large``."""
    return F.size(F.array_intersect(large, small)) == F.size(F.array_distinct(small))


def differs_from(c: Column, constant: Sequence[str]) -> Column:
    return c != F.array(*[F.lit(v) for v in constant])


def sign_of(c: Column, negative: Sequence[str]) -> Column:
    """−1 for the listed categories, otherwise 1."""
    return F.when(c.isin(list(negative)), F.lit(-1)).otherwise(F.lit(1))
