"""Daily aggregates and the time series built on them.

Everything after the daily aggregate works on (group, day) rows, so the rows of one group are
bounded by the number of days, however many items the group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerline.functions.exact import add_totals, exact_sum, from_units, total_units
from ledgerline.functions.keys import pair_key
from ledgerline.operators.columns import quoted

SHORT_DAYS, LONG_DAYS = 30, 90


def daily_pre_aggregate(
    items: DataFrame,
    keys: Sequence[str],
    date: str,
    item_key: str,
    quantity: str,
    value: str,
    sets: Mapping[str, str],
    extra_keys: Mapping[str, Column] | None = None,
    scale: int = 4,
) -> DataFrame:
    """Count, sums and member sets per day and key combination.

    The set of a column that is itself a key has at most that one member, so it is written
    down instead of collected; only other columns are collected.
    """
    keyed = items.withColumns(dict(extra_keys or {}))
    grouping = [*keys, *(extra_keys or {}), date]
    collected = {n: c for n, c in sets.items() if c not in grouping}
    daily = keyed.groupBy(*[quoted(k) for k in grouping]).agg(
        F.count(quoted(item_key)).alias("item_count"),
        exact_sum(quoted(quantity), scale).alias("billed_quantity"),
        exact_sum(quoted(value), scale).alias("sales_value"),
        *[F.sort_array(F.collect_set(quoted(c))).alias(f"{n}_set") for n, c in collected.items()],
    )
    return (
        daily.withColumns(
            {
                f"{n}_set": F.array_compact(F.array(quoted(c)))
                for n, c in sets.items()
                if n not in collected
            }
        )
        .withColumns({f"{n}_count": F.size(f"{n}_set") for n in sets})
        .withColumns(
            {
                "avg_unit_price": F.try_divide("sales_value", "billed_quantity"),
                "_group_id": pair_key(*[quoted(k).cast("string") for k in [*keys, *(extra_keys or {})]]),
            }
        )
    )


def _tagged(values: Column, kind: int) -> Column:
    """Array of members as an array of (kind, member)."""
    return F.transform(
        values, lambda m: F.struct(F.lit(kind).alias("kind"), m.cast("string").alias("member"))
    )


def union_of_sets(df: DataFrame, keys: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """Member sets of coarser groups from those of finer ones, sorted.

    Members are spread out and made distinct first, so duplicates vanish before the shuffle.  A
    group without members has empty sets.
    """
    exploded = df.select(
        *[quoted(k) for k in keys],
        F.inline_outer(
            F.flatten(
                F.array(
                    *[
                        _tagged(F.coalesce(quoted(s), F.array().cast("array<string>")), i)
                        for i, s in enumerate(sets)
                    ]
                )
            )
        ),
    ).distinct()
    return exploded.groupBy(*[quoted(k) for k in keys]).agg(
        *[
            F.sort_array(F.collect_set(F.when(F.col("kind") == i, F.col("member")))).alias(s)
            for i, s in enumerate(sets)
        ]
    )


def _member_rows(df: DataFrame, keys: list[str], date: str, members: Mapping[str, str]) -> DataFrame:
    """Distinct (keys, day, kind, member); member columns are single values or sets."""
    types = {f.name: f.dataType for f in df.schema.fields}
    listed = []
    for i, column in enumerate(members.values()):
        c = quoted(column)
        values = c if isinstance(types[column], T.ArrayType) else F.array(c)
        values = F.coalesce(values.cast("array<string>"), F.array().cast("array<string>"))
        listed.append(_tagged(values, i))
    return (
        df.select(*[quoted(k) for k in keys], quoted(date), F.inline(F.flatten(F.array(*listed))))
        .filter("member is not null")
        .distinct()
    )


def daily_series(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    sums: Sequence[str],
    members: Mapping[str, str],
    cumulative: Sequence[str] = (),
    scale: int = 4,
) -> DataFrame:
    """Sums and distinct member counts per group and day, with cumulative distinct counts.

    A member is new on the first day the group sees it, so the cumulative count is a running
    sum of new members; no growing set is carried along.  Sums and member rows meet in one
    aggregate instead of a join.
    """
    keys, members = list(keys), dict(members)
    columns = [quoted(k) for k in keys] + [quoted(date)]
    base = df.groupBy(*columns).agg(*[total_units(quoted(s), scale).alias(s) for s in sums])
    if members:
        seen = _member_rows(df, keys, date, members)
        first = F.min(quoted(date)).over(
            Window.partitionBy(*[quoted(k) for k in keys], "kind", "member")
        )
        marks = seen.withColumn("fresh", (quoted(date) == first).cast("long"))
        counted = marks.groupBy(*columns).agg(
            *[F.count_if(F.col("kind") == i).alias(f"{m}_count") for i, m in enumerate(members)],
            *[
                F.sum(F.when(F.col("kind") == i, F.col("fresh"))).alias(f"__new_{m}")
                for i, m in enumerate(members)
                if m in cumulative
            ],
        )
        base = base.unionByName(counted, allowMissingColumns=True)
    counts = [f"{m}_count" for m in members] + [f"__new_{m}" for m in members if m in cumulative]
    daily = base.groupBy(*columns).agg(
        *[from_units(add_totals(quoted(s)), scale).alias(s) for s in sums],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts],
    )
    ordered = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(quoted(date))
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = [m for m in members if m in cumulative]
    return (
        daily.withColumns(
            {f"cumulative_{m}_count": F.sum(f"__new_{m}").over(running) for m in fresh}
        )
        .withColumns(
            {
                f"lagged_cumulative_{m}_count": F.lag(f"cumulative_{m}_count").over(ordered)
                for m in fresh
            }
        )
        .drop(*[f"__new_{m}" for m in fresh])
    )


def cumulative_sets(df: DataFrame, keys: Sequence[str], date: str, column: str, output: str) -> DataFrame:
    """The growing member set itself, for callers that need the members and not their number.

    Carries every earlier member on every day; use the counts of :func:`daily_series` on
    anything large.
    """
    window = (
        Window.partitionBy(*[quoted(k) for k in keys])
        .orderBy(quoted(date))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    gathered = F.array_distinct(F.flatten(F.collect_set(quoted(column)).over(window)))
    return df.withColumn(output, F.sort_array(gathered)).withColumn(
        f"size_of_{output}", F.size(output)
    )


def rolling_trend(
    daily: DataFrame, keys: Sequence[str], date: str, value: str, scale: int | None = None
) -> DataFrame:
    """Trailing 30-day total, 30- and 90-day averages, and the difference of the two.

    Frames are calendar ranges that include the current day.  With ``scale`` the sums over the
    frames are rounded to so many decimals, for values known to have no more than that.
    """
    position = F.unix_date(quoted(date).cast("date"))
    ordered = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(position)
    short = ordered.rangeBetween(-SHORT_DAYS, Window.currentRow)
    long = ordered.rangeBetween(-LONG_DAYS, Window.currentRow)

    def summed(column: str, window) -> Column:
        total = F.sum(quoted(column)).over(window)
        return total if scale is None else F.round(total, scale)

    def mean(column: str, window) -> Column:
        total = summed(column, window)
        return F.try_divide(total, F.count(quoted(column)).over(window))

    past = f"total_{value}_of_past_30_days"
    short_mean = f"rolling_30_day_avg_of_{past}"
    long_mean = f"rolling_90_day_avg_of_{past}"
    change = f"absolute_diff_of_30_vs_90_day_rolling_avg_of_{past}"
    return (
        daily.withColumns(
            {
                past: summed(value, short),
                f"rolling_30_day_avg_of_daily_{value}": mean(value, short),
                f"rolling_90_day_avg_of_daily_{value}": mean(value, long),
            }
        )
        .withColumns({short_mean: mean(past, short), long_mean: mean(past, long)})
        .withColumn(change, quoted(short_mean) - quoted(long_mean))
        .withColumn(
            f"percentage_diff_of_30_vs_90_day_rolling_avg_of_{past}",
            F.try_divide(quoted(change), F.abs(quoted(long_mean))),
        )
    )


def change_intervals(
    df: DataFrame, keys: Sequence[str], date: str, flag: str, last: Sequence[str] = ()
) -> DataFrame:
    """Runs of days over which a flag keeps its value, with the last values of each run."""
    ordered = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(quoted(date))
    state = F.coalesce(quoted(flag).cast("int"), F.lit(0))
    flips = (state != F.lag(state, 1, 0).over(ordered)).cast("int")
    island = F.sum("__flip").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        df.withColumn("__flip", flips)
        .withColumn("interval_number", island)
        .groupBy(*[quoted(k) for k in keys], "interval_number")
        .agg(
            F.max(state.cast("boolean")).alias(flag),
            F.min(quoted(date)).alias("interval_start"),
            F.max(quoted(date)).alias("interval_end"),
            *[F.max_by(quoted(c), quoted(date)).alias(f"last_{c}") for c in last],
        )
    )
