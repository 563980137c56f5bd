"""Latest-row selection and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.operators.columns import quoted


def latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    comparison: Sequence[str],
    one_per_key: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows with the greatest comparison columns per key, nulls lowest.

    Ties are all kept unless ``one_per_key``; then the smallest ``tie_break`` wins.  Spark limits
    each window group before the shuffle for a rank filter of this form, so a key that holds
    much of the table leaves every map task with its own best rows only.
    """
    order = [quoted(c).desc_nulls_last() for c in comparison]
    window = Window.partitionBy(*[quoted(k) for k in keys])
    if one_per_key:
        place = F.row_number().over(window.orderBy(*order, *[quoted(c).asc() for c in tie_break]))
    else:
        place = F.rank().over(window.orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: any of them, or the first in the given order."""
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(
        *[quoted(c).asc_nulls_first() for c in order]
    )
    return df.withColumn("__n", F.row_number().over(window)).filter("__n = 1").drop("__n")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the first in the order of all other columns, so that reruns agree."""
    return one_per_key(df, keys, sorted(c for c in df.columns if c not in keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
