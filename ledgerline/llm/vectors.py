"""Vectors that can be worked on, as rows of whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.columns import quoted

LARGEST = float(1 << 26)  # magnitude up to which sums and squares of the numbers stay exact


def is_finite(vector: Column) -> Column:
    """True for a vector of doubles that is not null and has only finite components."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~broken, F.lit(False))


def whole_vectors(
    vectors: DataFrame, vector_column: str, scale: int, offset: int, **columns: str
) -> DataFrame:
    """The named columns and ``x``: floor(scale * component) + offset, as longs.

    Vectors that are null or hold a null or non-finite component, or one whose number would be
    beyond 2^26, are dropped.
    """
    v = quoted(vector_column).cast("array<double>")
    small = ~F.exists(v, lambda c: F.abs(c * scale) > LARGEST)
    picked = [quoted(name).alias(alias) for alias, name in columns.items()]
    whole = F.transform(v, lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    return vectors.where(is_finite(v) & small).select(*picked, whole.alias("x"))


def common_width(rows: DataFrame) -> int | None:
    """The most common length of ``x``, the smallest of equally common ones; None without rows."""
    widths = rows.groupBy(F.size("x").alias("width")).count()
    first = widths.orderBy(F.desc("count"), "width").first()
    return None if first is None else first["width"]
