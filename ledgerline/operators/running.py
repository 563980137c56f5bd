"""Row numbers and running sums within partitions that may be too big for one task.

A plain window sends each partition to one task, which is right for partitions of a moderate
size.  Partitions beyond that are cut into ranges of their order: bounds come from a sample of
about ``SAMPLED`` rows a range, a row's range is found by comparing it with the bounds, and the
window is partitioned by partition and range, so the rows are exchanged once.  Each range is
numbered and summed by itself, and the ranges before it contribute one small row each.

How many rows a range has follows from the number of rows: as many as give every task of a
shuffle one, at least ``FEWEST`` and at most ``MOST``.  There are never more than ``RANGES``
ranges beyond one per large partition, so the table of bounds that all tasks get is bounded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.operators.columns import quoted
from ledgerline.session import settled

_RANGE = "__range"
_BOUNDS = "__bounds"
FEWEST, MOST = 1000, 1_000_000  # rows of a range
RANGES = 100_000
SAMPLED = 64


@dataclass(frozen=True)
class Order:
    column: str
    descending: bool = False

    def expression(self) -> Column:
        c = quoted(self.column)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()


def _not_after(bound: Column, order: Sequence[Order], names: Sequence[str]) -> Column:
    """Does ``bound`` (fields f0, f1, ...) come no later than the row in this order?"""
    out = F.lit(True)
    for i, (o, name) in reversed(list(enumerate(zip(order, names, strict=True)))):
        b, x = bound[f"f{i}"], quoted(name)
        if o.descending:
            earlier = (b.isNotNull() & x.isNull()) | F.coalesce(b > x, F.lit(False))
        else:
            earlier = (b.isNull() & x.isNotNull()) | F.coalesce(b < x, F.lit(False))
        out = earlier | (b.eqNullSafe(x) & out)
    return out


def _same_keys(partition: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(partition):
        same = same & quoted(k).eqNullSafe(F.col(f"__k{i}"))
    return same


def _bounds(df: DataFrame, partition: Sequence[str], order: Sequence[Order], large: DataFrame, rows: int) -> DataFrame:
    """Sorted lower bounds of all ranges but the first, per large partition.

    The list is cut into pieces of about its root, so that a row is compared with few of them.
    """
    sample = (
        df.join(F.broadcast(large), _same_keys(partition), "inner")
        .where(F.rand(17) < SAMPLED / rows)
        .select(
            *[F.col(f"__k{i}") for i in range(len(partition))],
            F.ceil(F.col("__n") / rows).alias("__ranges"),
            *[quoted(o.column).alias(f"f{i}") for i, o in enumerate(order)],
        )
    )
    keys = [F.col(f"__k{i}") for i in range(len(partition))]
    fields = [f"f{i}" for i in range(len(order))]
    sorted_ = Window.partitionBy(*keys).orderBy(*[Order(f, o.descending).expression() for f, o in zip(fields, order, strict=True)])
    step = lambda place: F.floor(place * F.col("__ranges") / (F.col("__all") + 1))
    placed = sample.withColumns(
        {"__place": F.row_number().over(sorted_), "__all": F.count("*").over(Window.partitionBy(*keys))}
    )
    chosen = placed.where(step(F.col("__place")) != step(F.col("__place") - 1))
    listed = chosen.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__place", *fields))).alias("all"))
    width = F.greatest(F.ceil(F.sqrt(F.size("all"))), F.lit(1)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("all") - 1) / F.col("width")).cast("int")),
        lambda i: F.slice("all", i * F.col("width") + 1, F.col("width")),
    )
    told = listed.withColumn("width", width).withColumn("pieces", pieces)
    heads = F.transform("pieces", lambda p: p[0])
    return settled(told.select(*keys, F.struct("width", "pieces", heads.alias("heads")).alias(_BOUNDS)))


def _ranged(df: DataFrame, partition: Sequence[str], order: Sequence[Order], bounds: DataFrame) -> DataFrame:
    """Rows with the number of their range within the partition; below zero in those of one range."""
    names = [o.column for o in order]
    held = F.col(_BOUNDS)
    piece = F.size(F.filter(held["heads"], lambda b: _not_after(b, order, names)))
    inside = F.size(F.filter(F.get(held["pieces"], F.col("__piece") - 1), lambda b: _not_after(b, order, names)))
    number = F.when(F.col("__piece") == 0, 0).otherwise((F.col("__piece") - 1) * held["width"] + inside)
    single = -1 - F.pmod(F.xxhash64(F.lit(0), *[quoted(k) for k in partition]), F.lit(1024)).cast("int")
    joined = df.join(F.broadcast(bounds), _same_keys(partition), "left").withColumn("__piece", piece)
    ranged = joined.withColumn(_RANGE, F.when(held.isNull(), single).otherwise(number).cast("int"))
    return ranged.select(*[quoted(c) for c in df.columns], _RANGE)


def running_totals(
    df: DataFrame,
    partition: Sequence[str],
    peers: Sequence[Order],
    tie_break: Sequence[Order] = (),
    sums: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
    rank: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Add a row number and running sums per partition.

    Rows are ordered by ``peers`` then ``tie_break``.  Rows that agree on ``peers`` share their
    running sums (the SQL RANGE frame up to the current row); the row number tells them apart.

    ``sums`` maps an output column to the column it adds up; ``totals`` maps an output column
    to one of the ``sums`` outputs and holds its value over the whole partition.  With ``scale``
    values are added up as decimals with that many digits, so that the sums do not depend on
    the order of addition, and shown as doubles.
    """
    spark = df.sparkSession
    sums, totals = dict(sums or {}), dict(totals or {})
    order = [o.expression() for o in (*peers, *tie_break)]
    keys = [quoted(k) for k in partition]

    def addend(column: str) -> Column:
        return quoted(column) if scale is None else quoted(column).cast(f"decimal(38,{scale})")

    def shown(c: Column) -> Column:
        return c if scale is None else c.cast("double")

    counted = settled(
        df.select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)])
        .groupBy(*[f"__k{i}" for i in range(len(keys))])
        .agg(F.count("*").alias("__n"))
    )
    size = counted.agg(F.sum("__n").alias("all"), F.max("__n").alias("most")).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = min(MOST, max(FEWEST, -(-(size["all"] or 0) // tasks)))
    rows = max(rows, -(-(size["all"] or 0) // RANGES))

    def windows(table: DataFrame, within: Sequence[Column]) -> DataFrame:
        whole = Window.partitionBy(*within)
        up_to_peers = whole.orderBy(*[o.expression() for o in peers]).rangeBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        position = list(sums)
        return table.withColumns(
            {"__n": F.row_number().over(whole.orderBy(*order))}
            | {f"__s{i}": F.sum(addend(c)).over(up_to_peers) for i, c in enumerate(sums.values())}
            | {f"__t{position.index(of)}": F.sum(addend(sums[of])).over(whole) for of in totals.values()}
        )

    if (size["most"] or 0) <= rows:
        done = windows(df, keys)
        out = {name: quoted(name) for name in df.columns}
        if rank:
            out[rank] = F.col("__n").cast("long")
        out |= {name: shown(F.col(f"__s{i}")) for i, name in enumerate(sums)}
        out |= {name: shown(F.col(f"__t{list(sums).index(of)}")) for name, of in totals.items()}
        return done.select([c.alias(name) for name, c in out.items()])

    bounds = _bounds(df, partition, [*peers, *tie_break], counted.where(F.col("__n") > rows), rows)
    local = settled(windows(_ranged(df, partition, [*peers, *tie_break], bounds), [*keys, F.col(_RANGE)]))

    # One row per large partition and range: its size, its sums, and the sums at its first peers.
    peer = F.struct(*[quoted(o.column).alias(f"p{i}") for i, o in enumerate(peers)])
    state = F.struct(peer.alias("peer"), *[F.col(f"__s{i}") for i in range(len(sums))])
    edges = local.where(F.col(_RANGE) >= 0).groupBy(*keys, _RANGE).agg(
        F.count("*").alias("__rows"),
        F.min_by(state, "__n").alias("__first"),
        F.max_by(state, "__n").alias("__last"),
    )
    across = Window.partitionBy(*keys).orderBy(_RANGE)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    edges = edges.select(
        *keys,
        _RANGE,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
        *[F.sum(f"__last.__s{i}").over(before).alias(f"__before{i}") for i in range(len(sums))],
        *[F.sum(f"__last.__s{i}").over(whole).alias(f"__total{i}") for i in range(len(sums))],
        "__first",
        "__last",
    )

    def plus(offset: Column, value: Column) -> Column:
        return F.when(value.isNull(), offset).otherwise(value + F.coalesce(offset, F.lit(0)))

    # Peers cut by a range border take the sum at the last range that holds them.
    def at_edge(side: str) -> Column:
        return F.struct(
            F.col(f"{side}.peer").alias("peer"),
            F.struct(
                *[
                    plus(F.col(f"__before{i}"), F.col(f"{side}.__s{i}")).alias(f"s{i}")
                    for i in range(len(sums))
                ],
                F.lit(0).alias("none"),
            ).alias("reached"),
        )

    borders = (
        edges.select(*keys, _RANGE, F.inline(F.array(at_edge("__first"), at_edge("__last"))))
        .groupBy(*keys, "peer")
        .agg(F.max_by("reached", F.struct(F.col(_RANGE), "reached")).alias("reached"))
    )
    marked = borders.select(
        *[quoted(k).alias(f"__k{i}") for i, k in enumerate(partition)], "peer", "reached"
    )
    same = F.col("__last.peer").eqNullSafe(F.col("peer")) & _same_keys(partition)
    offsets = edges.join(marked, same, "left").select(
        *[quoted(k).alias(f"__k{i}") for i, k in enumerate(partition)],
        F.col(_RANGE).alias("__r"),
        "__rows_before",
        *[F.col(f"__before{i}") for i in range(len(sums))],
        *[F.col(f"__total{i}") for i in range(len(sums))],
        F.col("__last.peer").alias("__last_peer"),
        "reached",
    )

    # Joined on partition and range, so a big partition stays spread over its ranges.
    on = (F.col(_RANGE) == F.col("__r")) & _same_keys(partition)
    joined = local.join(offsets, on, "left")

    out = {name: quoted(name) for name in df.columns}
    if rank:
        out[rank] = F.col("__n") + F.coalesce("__rows_before", F.lit(0))
    for i, name in enumerate(sums):
        out[name] = shown(
            F.when(peer.eqNullSafe(F.col("__last_peer")), F.col(f"reached.s{i}")).otherwise(
                plus(F.col(f"__before{i}"), F.col(f"__s{i}"))
            )
        )
    position = {name: i for i, name in enumerate(sums)}
    for name, of in totals.items():
        out[name] = shown(F.coalesce(F.col(f"__total{position[of]}"), F.col(f"__t{position[of]}")))
    return joined.select([c.alias(name) for name, c in out.items()])
