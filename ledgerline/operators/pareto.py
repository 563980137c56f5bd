"""ABC classification of partitions, and of groups inside partitions, by share of a metric."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions.exact import add_totals, from_units, total_units
from ledgerline.operators.columns import quoted
from ledgerline.operators.joins import attach_totals
from ledgerline.operators.running import Order, running_totals
from ledgerline.session import settled

# The default upper shares of class A and class B.
A_MAX = 0.8
B_MAX = 0.95


def abc_class(value: Column, share: Column, cumulative: Column, a_max: float, b_max: float) -> Column:
    """A: positive and within the first share, or big enough alone.  B: within the next.  Else C."""
    return (
        F.when(((cumulative <= a_max) & (value > 0)) | (share >= a_max), "A")
        .when((cumulative > a_max) & (cumulative <= b_max), "B")
        .otherwise("C")
    )


def json_id(columns: Sequence[str]) -> Column:
    """Column names and values as a JSON object; null without columns."""
    if not columns:
        return F.lit(None).cast("string")
    return F.to_json(
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in columns]),
            F.array(*[quoted(c).cast("string") for c in columns]),
        )
    )


def abc_classification(
    df: DataFrame,
    metric: str,
    group: Sequence[str],
    partition: Sequence[str] = (),
    aggregate: str = "sum",
    metric_name: str | None = None,
    a_max: float = A_MAX,
    b_max: float = B_MAX,
    scale: int = 4,
) -> DataFrame:
    """One row per group and partition with both levels of the classification.

    The rows are aggregated once, to groups, which are written down; partitions and the whole
    table are sums of those.
    ``aggregate`` is ``sum`` or ``avg``; the running figure of an average is the average over
    the groups so far.
    """
    if aggregate not in ("sum", "avg"):
        raise ValueError(f"aggregate must be sum or avg, not {aggregate!r}")
    partition, group = list(partition), list(group)
    mean = aggregate == "avg"

    def figure(total: str, count: str) -> Column:
        whole = from_units(total, scale)
        return F.try_divide(whole, F.col(count)) if mean else whole

    sums = [add_totals("__sum").alias("__sum"), F.sum("__count").alias("__count")]
    groups = settled(
        df.groupBy(*[quoted(c) for c in partition + group]).agg(
            total_units(quoted(metric), scale).alias("__sum"),
            F.count(quoted(metric)).alias("__count"),
        )
    )
    # running sums in decimals only where no total has more of them
    digits = scale if groups.agg(F.bool_and("__sum.exact")).first()[0] else None
    blocks = groups.groupBy(*[quoted(c) for c in partition]).agg(*sums)
    dataset = blocks.agg(*sums).select(figure("__sum", "__count").alias("dataset_value"))

    def ranked(table: DataFrame, within: list[str], ties: list[str], level: str) -> DataFrame:
        value = f"{level}_value"
        measured = table.withColumn(value, figure("__sum", "__count")).withColumn(
            "__one", F.when(quoted(value).isNotNull(), 1)
        )
        run = running_totals(
            measured.drop("__sum", "__count"),
            partition=within,
            peers=[Order(value, descending=True)],
            tie_break=[Order(c) for c in ties],
            sums={"__running": value, "__seen": "__one"},
            rank=f"{level}_rank",
            scale=digits,
        )
        running = F.col("__running")
        return run.withColumn(
            f"{level}_cumulative",
            F.try_divide(running, F.col("__seen")) if mean else running,
        ).drop("__running", "__seen", "__one")

    def classified(table: DataFrame, level: str, whole: str) -> DataFrame:
        return table.withColumns(
            {
                f"{level}_share": F.try_divide(quoted(f"{level}_value"), quoted(whole)),
                f"{level}_cumulative_share": F.try_divide(
                    quoted(f"{level}_cumulative"), quoted(whole)
                ),
            }
        ).withColumn(
            f"{level}_class",
            abc_class(
                quoted(f"{level}_value"),
                quoted(f"{level}_share"),
                quoted(f"{level}_cumulative_share"),
                a_max,
                b_max,
            ),
        )

    blocks = attach_totals(ranked(blocks, [], partition, "partition"), dataset, [])
    blocks = classified(blocks, "partition", "dataset_value")
    detailed = attach_totals(ranked(groups, partition, group, "group"), blocks, partition)
    return classified(detailed, "group", "partition_value").withColumns(
        {
            "partition_block_id": json_id(partition),
            "group_id": json_id(group),
            "metric_col": F.lit(metric),
            "metric_name": F.lit(metric_name or metric),
            "agg_fn_name": F.lit(aggregate),
            "a_class_max": F.lit(a_max),
            "b_class_max": F.lit(b_max),
        }
    )
