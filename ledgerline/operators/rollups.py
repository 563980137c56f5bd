"""Attribute roll-ups and entity pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions.keys import pair_key
from ledgerline.operators.columns import quoted
from ledgerline.operators.filters import filled


def attribute_rollup(
    df: DataFrame,
    attribute: str,
    first: Mapping[str, str] | None = None,
    lists: Mapping[str, str] | None = None,
    counted: Sequence[str] = (),
    flattened: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per filled attribute value.

    ``first`` takes the smallest value (one fixed choice where any would do), ``lists`` the
    distinct values as a sorted list, ``flattened`` the distinct members of list columns;
    ``counted`` names the lists that also get a size column.
    """
    first, lists, flattened = dict(first or {}), dict(lists or {}), dict(flattened or {})
    return (
        df.filter(filled(attribute))
        .groupBy(quoted(attribute).alias("primary_key"))
        .agg(
            *[F.min(quoted(c)).alias(name) for name, c in first.items()],
            *[F.sort_array(F.collect_set(quoted(c))).alias(f"{name}_list") for name, c in lists.items()],
            *[
                F.sort_array(F.array_distinct(F.flatten(F.collect_set(quoted(c))))).alias(name)
                for name, c in flattened.items()
            ],
        )
        .withColumns({f"{name}_count": F.size(f"{name}_list") for name in counted if name in lists})
        .withColumns({f"{name}_count": F.size(name) for name in flattened})
    )


def entity_pairs(
    items: DataFrame,
    roles: Sequence[str],
    member: str,
    group_type: str,
    owner_name: str = "customer_key",
    filter_id: str = "all",
) -> DataFrame:
    """Distinct (customer, member) pairs over all customer roles of the items.

    Role-member combinations are made distinct before the roles are spread out, so the rows
    that meet in the shuffle are combinations and not items.
    """
    spread = (
        items.select(*[quoted(r) for r in roles], quoted(member))
        .distinct()
        .select(
            F.explode(F.array_distinct(F.array(*[quoted(r) for r in roles]))).alias(owner_name),
            quoted(member),
        )
    )
    return (
        spread.filter(filled(owner_name, member))
        .distinct()
        .withColumns(
            {
                "primary_key": pair_key(owner_name, quoted(member)),
                "_group_type": F.lit(group_type),
                "_filter_id": F.lit(filter_id),
            }
        )
    )


def ordered_names(
    df: DataFrame, keys: Sequence[str], position: str, names: Mapping[str, str]
) -> DataFrame:
    """Per key, parallel lists of the named columns in position order; null entries stay in place.

    One sort of each group's own (position, values) entries replaces a running list per row.
    """
    entry = F.struct(
        quoted(position).alias("__position"), *[quoted(c).alias(n) for n, c in names.items()]
    )
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.array_sort(F.collect_list(entry)).alias("__entries"))
        .select(
            *[quoted(k) for k in keys],
            *[F.col(f"__entries.{n}").alias(n) for n in names],
        )
    )
