"""Incremental runs: rebuild decisions, and a change log folded into the current state.

State is dealt to buckets by a hash of the key.  A micro-batch reads the buckets its changes fall
into, folds them and writes those buckets into a folder of its own; a manifest, one small file per
batch, then says for every bucket which batch wrote it last.  Buckets without changes are neither
read nor written.  The manifest is the commit: a batch that is run again after a failure reads the
state before it and overwrites only what it wrote itself, and a lost executor costs no state.
What neither the newest manifest nor the one before names is removed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.dedup import latest_rows
from ledgerline.operators.filters import drop_deletions
from ledgerline.operators.joins import enrich, upsert
from ledgerline.sources.readers import existing

BUCKETS = 64
BUCKET = "state_bucket"


def metadata_is_newer(
    metadata_written: dt.datetime, output_written: dt.datetime | None
) -> bool:
    """An output that was never written is older than any metadata."""
    return output_written is None or output_written < metadata_written


def must_rebuild(
    incremental: bool,
    metadata_newer: bool,
    metadata_changed: bool,
    columns: Iterable[str],
    previous_columns: Iterable[str] | None,
) -> bool:
    """Rebuild when not incremental, when newer metadata changed the table, or the columns differ."""
    if not incremental or previous_columns is None:
        return True
    return (metadata_newer and metadata_changed) or set(columns) != set(previous_columns)


def fold_changes(
    changes: DataFrame,
    state: DataFrame | None,
    key: str,
    comparison: Sequence[str],
    late_safe: bool = True,
    one_per_key: bool = True,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """New state from the last one and a batch of changes; deletions stay in it as marks.

    ``late_safe`` compares changes with the state as well, so the outcome does not depend on how
    changes are split into batches or in which order batches arrive.  Without it a batch's rows
    replace older state rows whatever their age.
    """
    if state is None:
        return latest_rows(changes, [key], comparison, one_per_key, tie_break)
    if late_safe:
        # Only state rows of changed keys are compared; against a batch that is small enough
        # to be broadcast the rest of the state is not even shuffled.
        state = state.select(changes.columns)
        changed = changes.select(F.col(key).alias("__changed")).distinct()
        same = F.col(key).eqNullSafe(F.col("__changed"))
        compared = changes.unionByName(state.join(changed, same, "left_semi"))
        latest = latest_rows(compared, [key], comparison, one_per_key, tie_break)
        return latest.unionByName(state.join(changed, same, "left_anti"))
    return upsert(latest_rows(changes, [key], comparison, one_per_key, tie_break), state, key)


def current_rows(state: DataFrame, mode_column: str | None) -> DataFrame:
    """State without deletion marks."""
    return drop_deletions(state, mode_column) if mode_column else state


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifests(spark: SparkSession, root: str) -> dict[int, dict[int, int]]:
    """Batch -> bucket -> batch that wrote the bucket; as many as are kept."""
    found = existing(
        lambda: spark.read.schema("batch long, bucket int, written long").parquet(f"{root}/manifest/*")
    )
    out: dict[int, dict[int, int]] = {}
    for r in found.collect() if found is not None else ():
        out.setdefault(r["batch"], {})[r["bucket"]] = r["written"]
    return out


def _folder(root: str, batch: int, bucket: int | None = None) -> str:
    return f"{root}/data/{batch:09d}" + ("" if bucket is None else f"/{BUCKET}={bucket}")


def _state(spark: SparkSession, root: str, written: dict[int, int]) -> DataFrame | None:
    paths = [_folder(root, batch, bucket) for bucket, batch in sorted(written.items())]
    return spark.read.parquet(*paths) if paths else None


def read_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The newest finished state, or the newest before a batch; none before the first."""
    kept = manifests(spark, root)
    done = [n for n in kept if before is None or n < before]
    return _state(spark, root, kept[max(done)]) if done else None


def _remove(folders: Iterable[str]) -> None:
    """Delete folders where the file system is known to this process; others stay, unread."""
    for folder in folders:
        try:
            store, path = fs.FileSystem.from_uri(folder)
            store.delete_dir(path)
        except (pa.ArrowInvalid, OSError):
            continue


def fold_batch(
    batch: DataFrame,
    number: int,
    root: str,
    key: str,
    comparison: Sequence[str],
    tie_break: Sequence[str] = (),
    late_safe: bool = True,
    buckets: int = BUCKETS,
) -> None:
    """Fold one batch into the state under ``root``."""
    spark = batch.sparkSession
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = [r[0] for r in batch.select(_bucket(key, buckets)).distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        kept = manifests(spark, root)
        before = max((n for n in kept if n < number), default=None)
        written = kept[before] if before is not None else {}
        state = _state(spark, root, {b: w for b, w in written.items() if b in touched})
        folded = fold_changes(batch, state, key, comparison, late_safe, True, tie_break)
        # large buckets are split among tasks, small ones share one
        dealt = folded.withColumn(BUCKET, _bucket(key, buckets)).hint("rebalance", BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(_folder(root, number))
        now = written | dict.fromkeys(touched, number)
        rows = spark.createDataFrame([(number, b, w) for b, w in sorted(now.items())], "batch long, bucket int, written long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/{number:09d}")
    finally:
        batch.unpersist()
    old = {n: m for n, m in kept.items() if before is not None and n < before}
    named = {(w, b) for m in (now, written) for b, w in m.items()}
    _remove(_folder(root, w, b) for w, b in {(w, b) for m in old.values() for b, w in m.items()} - named)
    _remove(f"{root}/manifest/{n:09d}" for n in old)


def run_changelog(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    key: str,
    comparison: Sequence[str],
    tie_break: Sequence[str] = (),
    late_safe: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Fold a stream of changes into the state until what is there now is used up."""

    def fold(batch: DataFrame, number: int) -> None:
        fold_batch(batch, number, root, key, comparison, tie_break, late_safe, buckets)

    return (
        changes.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def reenrich(
    added: DataFrame,
    previous: DataFrame,
    lookup: DataFrame,
    changed_lookup: DataFrame,
    pairs: Sequence[tuple[str, str]],
) -> DataFrame:
    """New rows with the whole lookup, plus earlier rows that changed lookup rows touch."""
    fresh = enrich(added, lookup, pairs, "left")
    return fresh.unionByName(enrich(previous, changed_lookup, pairs, "inner"))
