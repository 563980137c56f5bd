"""Recency, frequency and monetary value per group over several horizons.

All horizons come from one pass.  Each row belongs to the band between two neighbouring start
dates; sums, extremes and sketches are taken per group and band, and a horizon is the
sum of the bands after its start.  A distinct count since a date needs only the last date of
each member, because a member counts for every horizon that starts no later.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.dates import day, months_before
from ledgerline.functions.exact import add_totals, from_units, total_units
from ledgerline.functions.keys import pair_key
from ledgerline.operators.columns import quoted
from ledgerline.operators.joins import null_safe_left_join, null_safe_left_joins, require_new, spread
from ledgerline.operators.running import Order, running_totals
from ledgerline.session import settled

# The default horizons and the age at which a group counts as active.
FIXED_STARTS = ("2022-01-01", "2023-01-01")
ROLLING_MONTHS = (1, 2, 3, 4, 5, 6, 12)
MIN_AGE_DAYS = 5


@dataclass(frozen=True)
class InvoiceColumns:
    """Names of the invoice-item columns; callers with other names pass their own."""

    item_key: str = "item_key"
    header_key: str = "header_key"
    product_key: str = "product_key"
    sold_to: str = "sold_to_key"
    bill_to: str = "bill_to_key"
    ship_to: str = "ship_to_key"
    billing_date: str = "billing_date"
    currency: str = "currency"
    quantity: str = "billed_quantity"
    net_value: str = "net_value"
    sales_value: str = "sales_value"
    specialty_flag: str = "specialty_flag"
    source_flag: str = "source_flag"

    def renamed(self, **names: str) -> "InvoiceColumns":
        return replace(self, **names)


@dataclass(frozen=True)
class Horizon:
    alias: str
    start: dt.date

    @staticmethod
    def since(start: str) -> "Horizon":
        return Horizon(start.replace("-", "_"), dt.date.fromisoformat(start))


def default_horizons(
    as_of: dt.date,
    starts: Sequence[str] = FIXED_STARTS,
    months: Sequence[int] = ROLLING_MONTHS,
) -> list[Horizon]:
    """The fixed start dates, then the rolling months up to the reference day."""
    return [Horizon.since(s) for s in starts] + [
        Horizon(f"{m}_months_ago_to_date", months_before(as_of, m)) for m in months
    ]


@dataclass(frozen=True)
class RfmSpec:
    """What to measure and how.

    ``exact`` counts distinct members exactly; otherwise mergeable sketches estimate them.
    ``scale`` is the number of decimals of the money and quantity columns.
    """

    as_of: dt.date
    horizons: Sequence[Horizon]
    currency: str = "USD"
    columns: InvoiceColumns = field(default_factory=InvoiceColumns)
    exact: bool = False
    scale: int = 4

    def members(self) -> dict[str, str]:
        c = self.columns
        return {
            "order_count": c.item_key,
            "order_header_count": c.header_key,
            "unique_order_date_count": c.billing_date,
            "unique_product_count": c.product_key,
            "unique_sold_to_customer_count": c.sold_to,
        }


def eligible_items(items: DataFrame, spec: RfmSpec) -> DataFrame:
    """Items in the currency with positive quantity and value, from the earliest horizon on."""
    c = spec.columns
    return items.filter(
        (quoted(c.currency) == spec.currency)
        & (quoted(c.quantity) > 0)
        & (quoted(c.net_value) > 0)
        & (quoted(c.billing_date) >= day(min(h.start for h in spec.horizons)))
    )


def banded_metrics(
    items: DataFrame, roles: Mapping[str, Sequence[str | Column]], spec: RfmSpec
) -> DataFrame:
    """Sums, extremes and distinct counts (or sketches) per role, group and band.

    A role is a way of grouping the items, such as by payer or by recipient.  All roles are taken
    from one reading of the items.
    """
    c = spec.columns
    starts = sorted({h.start for h in spec.horizons})
    members = spec.members()
    members_list = F.array(
        *[
            F.struct(F.lit(i).alias("kind"), quoted(column).cast("string").alias("member"))
            for i, column in enumerate(members.values())
        ]
    )
    measured = [c.billing_date, c.sales_value, c.specialty_flag, c.quantity, *members.values()]
    eligible = eligible_items(items, spec)
    if len(roles) == 1:
        [(role, groups)] = roles.items()
        placed = eligible.withColumns({"role": F.lit(role), "group": pair_key(*groups)})
    else:
        place = F.array(
            *[
                F.struct(F.lit(role).alias("role"), pair_key(*groups).alias("group"))
                for role, groups in roles.items()
            ]
        )
        placed = eligible.select(
            *[quoted(m) for m in dict.fromkeys(measured)], F.inline(place)
        )
    billed = quoted(c.billing_date)

    def band(date: Column) -> Column:
        reached = F.lit(0)
        for start in starts:
            reached = reached + (date >= day(start)).cast("int")
        return reached

    measures = [
        F.min(billed).alias("first_date"),
        F.max(billed).alias("last_date"),
        total_units(quoted(c.sales_value), spec.scale).alias("value"),
        total_units(
            F.when(quoted(c.specialty_flag), quoted(c.sales_value)).otherwise(F.lit(0)), spec.scale
        ).alias("specialty_value"),
        total_units(quoted(c.quantity), spec.scale).alias("units"),
    ]
    if not spec.exact:
        measures += [
            F.hll_sketch_agg(quoted(column).cast("string")).alias(metric)
            for metric, column in members.items()
        ]
    banded = placed.groupBy("role", "group", band(billed).alias("band")).agg(*measures)
    if not spec.exact:
        return banded
    last_seen = (
        placed.select("role", "group", billed.alias("date"), F.inline(members_list))
        .filter("member is not null")
        .groupBy("role", "group", "kind", "member")
        .agg(F.max("date").alias("date"))
    )
    counted = last_seen.groupBy("role", "group", band(F.col("date")).alias("band")).agg(
        *[F.count_if(F.col("kind") == i).alias(m) for i, m in enumerate(members)]
    )
    return banded.unionByName(counted, allowMissingColumns=True)


def horizon_metrics(banded: DataFrame, name: str, spec: RfmSpec) -> DataFrame:
    """One row per group with every metric of every horizon from the bands of one role."""
    starts = sorted({h.start for h in spec.horizons})
    members = spec.members()
    aggregates = []
    for h in spec.horizons:
        inside = F.col("band") > starts.index(h.start)

        def only(column: str) -> Column:
            return F.when(inside, F.col(column))

        aggregates += [
            F.min(only("first_date")).alias(f"{h.alias}|first"),
            F.max(only("last_date")).alias(f"{h.alias}|last"),
            *[add_totals(only(m)).alias(f"{h.alias}|{m}") for m in ("value", "specialty_value", "units")],
            *[
                (F.sum(only(m)) if spec.exact else F.hll_union_agg(only(m))).alias(f"{h.alias}|{m}")
                for m in members
            ],
        ]
    # a group has few bands, so its narrow rows are exchanged and not their wide partial results;
    # the number of tasks is stated, for their results are far larger than what they read
    tasks = int(banded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exchanged = banded.repartition(tasks, "group")
    merged = exchanged.groupBy(F.col("group").alias("primary_key")).agg(*aggregates)

    counts, sums, ratios = {}, {}, {}
    for h in spec.horizons:

        def at(metric: str) -> Column:
            return quoted(f"{h.alias}|{metric}")

        def out(metric: str) -> str:
            return f"{name}_{metric}_since_{h.alias}"

        today = day(spec.as_of)
        present = at("first").isNotNull()
        age = F.datediff(today, at("first"))
        counts |= {
            out("age_in_days"): age,
            out("recency_in_days"): F.datediff(at("last"), at("first")),
            out("days_since_last_order"): F.datediff(today, at("last")),
            **{
                out(m): F.when(
                    present,
                    F.coalesce(
                        at(m) if spec.exact else F.hll_sketch_estimate(at(m)), F.lit(0)
                    ).cast("long"),
                )
                for m in members
            },
        }
        sums |= {
            out("total_order_value"): from_units(at("value"), spec.scale),
            out("total_order_value_specialty_only"): from_units(at("specialty_value"), spec.scale),
            out("total_units_billed"): from_units(at("units"), spec.scale),
        }
        total = quoted(out("total_order_value"))
        ratios |= {
            out("avg_order_value"): F.try_divide(total, quoted(out("order_count"))),
            out("total_order_value_per_day"): F.try_divide(total, quoted(out("age_in_days"))),
            out("avg_order_value_per_order_date"): F.try_divide(
                total, quoted(out("unique_order_date_count"))
            ),
            out("avg_order_value_per_order_header"): F.try_divide(
                total, quoted(out("order_header_count"))
            ),
            out("has_billing_documents"): F.when(
                total.isNotNull() | quoted(out("age_in_days")).isNotNull(),
                quoted(out("age_in_days")) > MIN_AGE_DAYS,
            ),
        }
    return merged.select(
        "primary_key", *[v.alias(k) for k, v in (counts | sums).items()]
    ).withColumns(ratios)


def rfm_metrics(items: DataFrame, groups: Sequence[str | Column], name: str, spec: RfmSpec) -> DataFrame:
    """One row per group with every metric of every horizon; empty horizons are null."""
    return horizon_metrics(banded_metrics(items, {name: groups}, spec), name, spec)


RANKED = ("order_count", "total_order_value", "total_order_value_per_day")


def ranked_columns(name: str, horizons: Sequence[Horizon], metrics: Sequence[str] = RANKED) -> list[str]:
    return [f"{name}_{m}_since_{h.alias}" for h in horizons for m in metrics]


def with_ranks_and_shares(
    df: DataFrame,
    metrics: Sequence[str],
    key: str = "primary_key",
    present: Mapping[str, str] | None = None,
    scale: int | None = 8,
) -> DataFrame:
    """Rank, cumulative sum, total, share and cumulative share of each metric over all rows.

    All metrics are laid out as (metric, key, value) rows and ranked in one distributed pass;
    equal values share the cumulative sum, and the key decides between equal ranks.  ``present``
    names for a metric the column that must be filled for a row to take part; a row that does
    not take part gets nulls.
    """
    present = dict(present or {})
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("metric"),
                quoted(m).cast("double").alias("value"),
                (quoted(present[m]).isNotNull() if m in present else F.lit(True)).alias("taken"),
            )
            for i, m in enumerate(metrics)
        ]
    )
    melted = (
        df.select(quoted(key).alias("key"), F.inline(entries)).filter("taken").drop("taken")
    )
    ranked = running_totals(
        settled(melted),
        partition=["metric"],
        peers=[Order("value", descending=True)],
        tie_break=[Order("key")],
        sums={"running": "value"},
        totals={"total": "running"},
        rank="place",
        scale=scale,
    )
    wide = ranked.groupBy(F.col("key").alias("__key")).agg(
        *[
            F.max(F.when(F.col("metric") == i, F.col(source))).alias(f"{prefix}_{m}")
            for i, m in enumerate(metrics)
            for prefix, source in (
                ("rank_of", "place"),
                ("cumulative_sum_of", "running"),
                ("total", "total"),
            )
        ]
    )
    joined = null_safe_left_join(df, wide, [(key, "__key")])
    return joined.withColumns(
        {
            column: F.try_divide(quoted(top), quoted(f"total_{m}"))
            for m in metrics
            for column, top in (
                (f"pcntg_of_total_{m}", m),
                (f"cumulative_sum_of_pcntg_of_total_{m}", f"cumulative_sum_of_{m}"),
            )
        }
    )


def ranked_metrics(metrics: DataFrame, name: str, spec: RfmSpec) -> DataFrame:
    """Metrics plus ranks; each horizon ranks the groups that have items in it.

    The metrics are written down first, so that they are computed once.
    """
    flag = {
        f"{name}_{m}_since_{h.alias}": f"{name}_order_count_since_{h.alias}"
        for h in spec.horizons
        for m in RANKED
    }
    return with_ranks_and_shares(settled(metrics), list(flag), present=flag)


def rfm_with_ranks(items: DataFrame, groups: Sequence[str | Column], name: str, spec: RfmSpec) -> DataFrame:
    return ranked_metrics(rfm_metrics(items, groups, name, spec), name, spec)


def packed_roles(
    entities: DataFrame,
    items: DataFrame,
    roles: Mapping[str, Sequence[str | Column]],
    spec: RfmSpec,
    ranks: bool = True,
) -> tuple[DataFrame, dict[str, Column]]:
    """Entities with one struct of metrics per role, and the columns to spread the structs out to.

    A role has some hundreds of columns; rows that wide should be laid out once, behind the last
    join, and not by every join.
    """
    banded = banded_metrics(items, roles, spec)
    if len(roles) > 1:
        banded = settled(banded)
    packed, shown = [], {}
    for i, name in enumerate(roles):
        metrics = horizon_metrics(banded.filter(F.col("role") == name), name, spec)
        if ranks:
            metrics = ranked_metrics(metrics, name, spec)
        columns = [c for c in metrics.columns if c != "primary_key"]
        require_new(columns, [*entities.columns, *shown])
        role = f"__role{i}"
        packed.append(metrics.select("primary_key", F.struct(*[quoted(c) for c in columns]).alias(role)))
        shown |= spread(role, columns)
    return null_safe_left_joins(entities, packed, [("primary_key", "primary_key")]), shown


def enrich_with_rfm(
    entities: DataFrame,
    items: DataFrame,
    roles: Mapping[str, Sequence[str | Column]],
    spec: RfmSpec,
    ranks: bool = True,
) -> DataFrame:
    """Entities with the metrics of the groups their ``primary_key`` names, one set per role.

    ``roles`` maps the name that the metric columns start with to the grouping columns.  The
    bands of several roles are written down once, so the items are read once for all of them.
    """
    joined, metrics = packed_roles(entities, items, roles, spec, ranks)
    return joined.select(
        *[quoted(c) for c in entities.columns], *[value.alias(c) for c, value in metrics.items()]
    )


def label_sets(items: DataFrame, groups: Sequence[str | Column], columns: InvoiceColumns) -> DataFrame:
    """Which flag labels occur per group, as sorted lists of at most two labels each.

    The labels are known in advance, so two flags per group replace collected sets.
    """

    def labels(flag: str, yes: str, no: str) -> Column:
        on = F.coalesce(quoted(flag), F.lit(False))
        return F.array_compact(
            F.array(
                F.when(F.bool_or(~on), F.lit(no)),
                F.when(F.bool_or(on), F.lit(yes)),
            )
        )

    return items.groupBy(pair_key(*groups).alias("primary_key")).agg(
        labels(columns.specialty_flag, "SPD", "NON-SPD").alias("spd_labels"),
        labels(columns.source_flag, "SOURCE", "NON-SOURCE").alias("source_labels"),
    )
