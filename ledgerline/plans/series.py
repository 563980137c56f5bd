"""Pairs of entities and time series per entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.dates import date_parts
from ledgerline.functions.keys import pair_key, with_series_ids
from ledgerline.operators.columns import decimals_to_double, drop_null_columns, quoted
from ledgerline.operators.filters import recent, where_all
from ledgerline.operators.joins import null_safe_left_join
from ledgerline.operators.rfm import RfmSpec, enrich_with_rfm
from ledgerline.operators.rollups import entity_pairs
from ledgerline.operators.series import daily_pre_aggregate, daily_series, rolling_trend
from ledgerline.session import settled

SERIES_MONTHS = 6

# Names of members whose daily sets the series count.
SETS = {
    "product": "product_key",
    "sold_to": "sold_to_key",
    "bill_to": "bill_to_key",
    "account": "account_key",
}


@dataclass(frozen=True)
class Level:
    """One entity level of the time series.

    ``members`` are counted per day, those in ``cumulative`` also over time; ``filters`` lists
    the row subsets that get a series of their own.
    """

    group_type: str
    keys: tuple[str, ...]
    members: tuple[str, ...]
    cumulative: tuple[str, ...] = ()
    filters: tuple[str, ...] = ("all",)


_SPLIT = ("all", "pd_only", "spd_only")

# The five levels in use, then the two that are defined but switched off.
LEVELS = (
    Level("customer_account_product_pair", ("account_key", "product_key"), ("sold_to", "bill_to")),
    Level("customer_product_pair", ("sold_to_key", "product_key"), ("bill_to", "account")),
    Level(
        "product",
        ("product_key",),
        ("sold_to", "bill_to", "account"),
        ("sold_to", "bill_to", "account"),
    ),
    Level("customer_account", ("account_key",), ("product", "sold_to", "bill_to"), ("product",), _SPLIT),
    Level("manufacturer", ("manufacturer_key",), ("product", "sold_to", "bill_to", "account"), ("product", "account"), _SPLIT),
)
UNUSED_LEVELS = (
    Level("customer", ("sold_to_key",), ("product", "bill_to", "account"), ("product",), _SPLIT),
    Level("customer_shipto", ("ship_to_key",), ("product", "bill_to", "account"), ("product",), _SPLIT),
)


def row_filters(flag: str = "specialty_flag") -> dict[str, list[Column]]:
    return {
        "all": [],
        "pd_only": [F.col(flag) == F.lit(False)],
        "spd_only": [F.col(flag) == F.lit(True)],
    }


def series_pre_aggregate(
    items: DataFrame,
    keys: Sequence[str],
    as_of: dt.date,
    months: int = SERIES_MONTHS,
    sets: Mapping[str, str] = SETS,
    prune: bool = True,
) -> DataFrame:
    """Daily figures of the last months per key combination, without empty columns."""
    daily = daily_pre_aggregate(
        recent(items, "billing_date", as_of, months),
        keys,
        "billing_date",
        "item_key",
        "billed_quantity",
        "sales_value",
        sets,
        date_parts(F.col("billing_date")),
    )
    daily = decimals_to_double(daily)
    # looking for empty columns must not compute the aggregate a second time
    return drop_null_columns(settled(daily)) if prune else daily


def series_metrics(
    pre_aggregate: DataFrame,
    level: Level,
    filter_id: str = "all",
    predicates: Sequence[Column] = (),
    scale: int | None = None,
) -> DataFrame:
    """Daily figures, cumulative distinct members and rolling trends of one level and filter.

    ``scale`` as in :func:`rolling_trend`.
    """
    daily = daily_series(
        where_all(pre_aggregate, list(predicates)),
        list(level.keys),
        "billing_date",
        ["item_count", "billed_quantity", "sales_value"],
        {m: f"{m}_set" for m in level.members},
        level.cumulative,
    )
    daily = rolling_trend(daily, list(level.keys), "billing_date", "sales_value", scale=scale)
    day = F.col("billing_date").cast("timestamp_ntz")
    return (
        daily.withColumns(
            {
                "billing_date": day,
                "item_count": F.col("item_count").cast("long"),
                "avg_unit_price": F.try_divide("sales_value", "billed_quantity"),
                "_group_id": pair_key(*level.keys),
                "_group_type_id": F.lit(level.group_type),
                "_filter_id": F.lit(filter_id),
            }
        )
        .withColumn("_time_series_group_id", pair_key("_group_type_id", "_filter_id", "_group_id"))
        .withColumn("primary_key", pair_key(F.col("billing_date").cast("string"), "_time_series_group_id"))
    )


def all_series(
    pre_aggregate: DataFrame,
    levels: Sequence[Level] = LEVELS,
    flag: str = "specialty_flag",
    scale: int | None = None,
) -> dict[str, DataFrame]:
    """Every series table, called after its level and filter."""
    predicates = row_filters(flag)
    return {
        f"{level.group_type}__{name}": series_metrics(
            pre_aggregate, level, name, predicates[name], scale
        )
        for level in levels
        for name in level.filters
    }


def customer_pairs(
    items: DataFrame,
    customer_dimension: DataFrame,
    member_dimension: DataFrame,
    member: str,
    name: str,
    spec: RfmSpec,
) -> DataFrame:
    """Customer and product (or generic or trade name) pairs with metrics per customer role and
    the columns of both entities."""
    roles = {
        "soldto": spec.columns.sold_to,
        "billto": spec.columns.bill_to,
        "shipto": spec.columns.ship_to,
    }
    df = entity_pairs(items, list(roles.values()), member, name)
    groups = {f"customer_{role}_{name}": [key, member] for role, key in roles.items()}
    # the narrow tables first: rows that carry the metrics are not exchanged for them
    narrow, attributes = df.columns, {}
    for i, (dimension, key) in enumerate(((customer_dimension, "customer_key"), (member_dimension, member))):
        brought = {f"__dimension{i}_{c}": c for c in dimension.columns if c not in (key, "primary_key")}
        keyed = dimension.select(
            F.col("primary_key").alias(key), *[quoted(c).alias(alias) for alias, c in brought.items()]
        )
        df = null_safe_left_join(df, keyed, [(key, key)])
        attributes |= brought
    df = enrich_with_rfm(df, items, groups, spec, ranks=False)
    shown = {c: quoted(c) for c in narrow} | {c: quoted(c) for c in df.columns if c not in attributes}
    for alias, c in attributes.items():
        shown.setdefault(c, quoted(alias))  # of equal names, the one that came first
    return with_series_ids(df.select(*[v.alias(c) for c, v in shown.items()]), "primary_key", name)
