"""Sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def full_refresh(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_batch(df: DataFrame, path: str, replace: bool = False) -> bool:
    """Append, or replace on a snapshot; nothing is written when there is nothing new.

    Tells whether it wrote.  A replacing run writes even an empty table.
    """
    if replace:
        full_refresh(df, path)
        return True
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def write_outputs(df: DataFrame, outputs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> None:
    """Several tables from one input, which is computed once and may spill to disk."""
    shared = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for path, build in outputs.items():
            full_refresh(build(shared), path)
    finally:
        shared.unpersist()
