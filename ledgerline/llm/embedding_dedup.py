"""Near-duplicate vectors by random-hyperplane sign hashing.

In each of several tables the signs of a vector against seeded random hyperplanes are its code;
vectors of one label that share a code are compared by exact cosine in double precision.  Bits
per table follow the number of vectors, so that a bucket holds about ``BUCKET`` vectors at any
size of the data, and the number of tables follows from the bits: a pair right at the threshold
is missed by all tables with probability ``MISS`` at most.

Equal vectors are one class from the start.  A bucket larger than ``TILE`` is cut into tiles and
compared tile by tile in blocks, so no task holds more than two tiles however large a group of
neighbours is.  A pair that meets in several tables counts in the first.  Tasks return a count
per class and the edges of a spanning forest of each block, never all pairs; components are
found by distributed label passing over these edges.

Defined results: a null label, and a vector that is null, empty, zero or holds a null or
non-finite component, is linked with nothing; vectors of unlike length are not compared; rows
that share an id are the same vector as far as components go, each row counts its links; a null
id is a component of its own kind (null); an empty table gives an empty result; only the three
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.graph import components
from ledgerline.operators.columns import quoted
from ledgerline.session import settled

THRESHOLD = 0.93
BUCKET = 512
TILE = 2048
MISS = 1e-6


def tables_and_bits(vectors: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits per table for ``vectors`` vectors of a label, and the tables they call for."""
    bits = max(4, math.ceil(math.log2(max(vectors, 1) / BUCKET)))
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(MISS) / math.log1p(-(agree**bits))), bits


def _codes(unit: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    planes = np.random.default_rng((seed, unit.shape[1])).standard_normal((unit.shape[1], tables * bits))
    signs = (unit @ planes > 0).reshape(len(unit), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable index per node of a small graph."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
    seed: int = 5,
) -> DataFrame:
    """One row per row: id, ``n_links``, ``component_id``, ``kept``."""
    v = quoted(vector_column).cast("array<double>")
    fine = (
        quoted(label_column).isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(
        quoted(id_column).alias("id"),
        quoted(label_column).alias("label"),
        F.when(F.coalesce(fine, F.lit(False)), v).alias("v"),
    )
    # zero and minus zero are the same component
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("v", lambda x: (x + 0.0).cast("string"))), 256)
    rows = settled(rows.withColumn("node", F.when(F.col("v").isNotNull(), F.unhex(key))))
    classes = settled(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("id"))
        .withColumn("width", F.size("v"))
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    tables, bits = tables_and_bits(largest, threshold)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, out = batch.column("node"), []
            for x in batch.column("v"):
                e = x.values.to_numpy(zero_copy_only=False)
                e = e / np.abs(e).max()  # no overflow in the norm
                out.append(_codes((e / np.linalg.norm(e))[None, :], tables, bits, seed)[0])
            lists = pa.array([list(o) for o in out], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([nodes, lists], names=["node", "codes"])

    coded = classes.select("node", "v").mapInArrow(hashed, "node binary, codes array<long>")
    coded = settled(coded.join(classes, "node"))

    spread = coded.select("node", "label", "width", F.posexplode("codes").alias("table", "code"))
    bucket = ["label", "width", "table", "code"]
    sizes = settled(spread.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1"))
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    dealt = spread.join(sizes, bucket).select(
        "node", *bucket, tiles.alias("tiles"), F.pmod(F.xxhash64("node", "table"), tiles).cast("int").alias("tile")
    )
    # a tile meets itself and every other one: the task (low, high) holds both
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    met = dealt.withColumn("other", F.explode(every)).select(
        "node", *bucket, "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )
    full = met.join(coded.select("node", "v", "n", "codes"), "node")

    def compared(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table, low, high = key[2], key[4], key[5]
        group = group.sort_values("node", ignore_index=True)
        e = np.array(group["v"].tolist(), dtype=np.float64)
        e = e / np.abs(e).max(axis=1, keepdims=True)
        e /= np.sqrt((e * e).sum(axis=1, keepdims=True))
        codes = np.array(group["codes"].tolist(), dtype=np.int64)
        tile = group["tile"].to_numpy()
        left = np.flatnonzero(tile == low)
        right = left if low == high else np.flatnonzero(tile == high)
        found_a, found_b = [], []
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            a, b = np.nonzero(e[part] @ e[right].T >= threshold)
            a, b = part[a], right[b]
            if low == high:
                a, b = a[a < b], b[a < b]
            found_a.append(a)
            found_b.append(b)
        a = np.concatenate(found_a) if found_a else np.empty(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.empty(0, np.int64)
        first = np.ones(len(a), bool)
        for t in range(table):  # not counted yet in a table before this one
            first &= codes[a, t] != codes[b, t]
        label = _forest(len(group), a, b)
        n = group["n"].to_numpy()
        links = np.bincount(a[first], n[b[first]], len(group)) + np.bincount(b[first], n[a[first]], len(group))
        node = group["node"].to_numpy()
        keep = (links > 0) | (label != np.arange(len(group)))
        return pd.DataFrame({"node": node[keep], "links": links[keep].astype(np.int64), "root": node[label[keep]]})

    found = settled(
        full.groupBy(*bucket, "low", "high").applyInPandas(compared, "node binary, links long, root binary")
    )
    label = settled(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    links = settled(found.groupBy("node").agg(F.sum("links").alias("links")))
    placed = (
        rows.select("id", "node")
        .join(classes.select("node", "n"), "node", "left")
        .join(links, "node", "left")
        .join(label, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = settled(
        placed.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    )
    ended = placed.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return ended.select(
        F.col("id").alias(id_column),
        (F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
