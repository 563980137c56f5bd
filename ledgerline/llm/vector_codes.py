"""Compression of vectors to codes: a product quantiser whose Lloyd rounds walk cover trees.

A vector is cut into equal consecutive parts.  Every task packs its vectors into chunks and
builds, for each part position of a chunk, a cover tree over the distinct parts: the children of
a node lie within its radius and more than half that radius apart, and every point is one node.
A tree is stored in preorder with running sums of count and components, so the sum of a whole
subtree is the difference of two entries.  The trees are built once and written down.

Each Lloyd round sends the codebooks (entries times parts, whatever the data's size) to all
tasks.  From the root down, a node whose distances to two entries differ by more than twice its
radius cannot hold a point nearer to the farther one (triangle inequality), so that entry is
ruled out for the whole subtree; if one entry is left, the subtree goes to it by its cumulative
sum, and only ambiguous nodes hand on to their children.  A node's own point is compared exactly,
in integers.  A round returns counts and sums per part, entry and component, at most one row of
each per task.

All arithmetic that decides anything is in whole numbers, so results repeat bit by bit; distances
for ruling out are doubles with a margin on the safe side.

Defined results: vectors that are null, hold null or non-finite components, or components whose
number is beyond 2^26, are dropped, and so are those whose length is not the most common one;
a length that is no multiple of the number of parts is an error.  The first codebooks are the
parts of the rows of smallest ids, null ids last and equal ids by their numbers; with fewer rows
the codebooks are smaller, without rows the result is empty.  Rows that share an id are coded each
by itself.  Ties go to the lower index, entries without parts stay as they are.  Only the three
named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.vectors import common_width, whole_vectors
from ledgerline.operators.columns import quoted
from ledgerline.session import settled

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CHUNK = 1 << 18  # components in a chunk
LEAF = 8  # points that are not split any further
TREE = "array<struct<points:array<long>,ends:array<int>,radii:array<double>,counts:array<long>,rows:array<int>>>"


@dataclass(frozen=True)
class Tree:
    """Distinct points in preorder; the subtree of node i is i up to, not including, ``ends[i]``."""

    points: np.ndarray  # nodes x width
    ends: np.ndarray
    radii: np.ndarray  # no descendant is farther away
    counts: np.ndarray  # running number of rows, one entry more than nodes
    rows: np.ndarray  # node of every row

    @property
    def sums(self) -> np.ndarray:
        """Running component sums, one entry more than nodes."""
        weighted = self.points * np.diff(self.counts)[:, None]
        return np.vstack([np.zeros((1, self.points.shape[1]), np.int64), weighted.cumsum(axis=0)])


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x entries."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        apart = points[:, k, None] - entries[None, :, k]
        out += apart * apart
    return out


def build_tree(parts: np.ndarray) -> Tree:
    """Cover tree over the distinct rows of ``parts``."""
    distinct, rows, weight = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    real = distinct.astype(np.float64)
    order, ends, radii = [], {}, {}
    # (node, its other points, their distances from it); None closes a node
    stack: list[tuple[int, np.ndarray, np.ndarray] | int] = []

    def far(node: int, members: np.ndarray) -> np.ndarray:
        apart = real[members] - real[node]
        return np.sqrt((apart * apart).sum(axis=1))

    everyone = np.arange(1, len(distinct))
    stack.append((0, everyone, far(0, everyone)))
    while stack:
        top = stack.pop()
        if isinstance(top, int):
            ends[top] = len(order)
            continue
        node, members, away = top
        order.append(node)
        radius = float(away.max()) if len(members) else 0.0
        radii[node] = radius
        stack.append(node)
        if len(members) <= LEAF:
            nothing = np.empty(0, np.int64)
            stack += [(int(m), nothing, nothing) for m in members]
            continue
        # the node covers what lies within half its radius; the rest is dealt to children that
        # are that far apart from it and from each other
        groups = []
        inner = away <= radius / 2
        close, close_away = members[inner], away[inner]
        left = members[~inner]
        while len(left):
            child, left = int(left[0]), left[1:]
            apart = far(child, left)
            near = apart <= radius / 2
            groups.append((child, left[near], apart[near]))
            left = left[~near]
        if len(close):
            # its own finer level: the same point cannot be a node twice, so the nearest stands in
            child = int(close[np.argmin(close_away)])
            others = close[close != child]
            groups.append((child, others, far(child, others)))
        stack += groups
    order = np.array(order)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Tree(
        distinct[order],
        np.array([ends[n] for n in order.tolist()], np.int64),
        np.array([radii[n] for n in order.tolist()]),
        np.concatenate([[0], weight[order].cumsum()]).astype(np.int64),
        place[rows.ravel()],
    )


def _walk(tree: Tree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Node ranges from, to (exclusive) and the entry nearest to all their points."""
    nodes, allowed = np.array([0]), np.ones((1, len(entries)), bool)
    while len(nodes):
        square = _distances(tree.points[nodes], entries)
        # ruled out entries are farther for sure: the least over all is the least over the rest
        nearest = square.argmin(axis=1)
        away = np.sqrt(square.astype(np.float64))
        least = away[np.arange(len(nodes)), nearest]
        reach = 2 * tree.radii[nodes]
        margin = 1e-9 * (away + reach[:, None]) + 1e-9
        allowed = allowed & (away - least[:, None] <= reach[:, None] + margin)
        sure = allowed.sum(axis=1) == 1
        yield nodes[sure], tree.ends[nodes[sure]], nearest[sure]
        open_, mask = nodes[~sure], allowed[~sure]
        yield open_, open_ + 1, nearest[~sure]
        below, masks = [], []
        child, end = open_ + 1, tree.ends[open_]
        while len(child):
            inside = child < end
            child, end, mask = child[inside], end[inside], mask[inside]
            below.append(child)
            masks.append(mask)
            child = tree.ends[child]
        nodes = np.concatenate(below) if below else np.empty(0, np.int64)
        allowed = np.concatenate(masks) if masks else allowed[:0]


def totals(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and component sums of the rows nearest to each entry."""
    sums, count = tree.sums, np.zeros(len(entries), np.int64)
    total = np.zeros(entries.shape, np.int64)
    for start, end, entry in _walk(tree, entries):
        np.add.at(count, entry, tree.counts[end] - tree.counts[start])
        np.add.at(total, entry, sums[end] - sums[start])
    return count, total


def assigned(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row its nearest entry and the squared distance."""
    change = np.zeros(len(tree.points) + 1, np.int64)
    for start, end, entry in _walk(tree, entries):
        np.add.at(change, start, entry)
        np.add.at(change, end, -entry)
    nearest = change[:-1].cumsum()
    apart = tree.points - entries[nearest]
    return nearest[tree.rows], (apart * apart).sum(axis=1)[tree.rows]


def _lists(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), width)


def _packed(batches: Iterator[pa.RecordBatch], width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """One row per chunk: the ids, the labels and the tree of each part position."""
    most = max(1, CHUNK // max(width, 1))
    kept: list[pa.RecordBatch] = []

    def chunk(rows: pa.Table) -> pa.RecordBatch:
        x = _lists(rows.column("x").combine_chunks(), width)
        span = width // parts
        trees = []
        for p in range(parts):
            t = build_tree(x[:, p * span : (p + 1) * span])
            trees.append(
                {
                    "points": t.points.ravel(), "ends": t.ends.astype(np.int32), "radii": t.radii,
                    "counts": t.counts, "rows": t.rows.astype(np.int32),
                }
            )
        one = [pa.array([0, len(x)], pa.int32())]
        columns = [
            pa.ListArray.from_arrays(one[0], rows.column(name).combine_chunks()) for name in ("id", "label")
        ]
        columns.append(pa.array([trees], _TREE))
        return pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "trees"])

    held = 0
    for batch in batches:
        kept.append(batch)
        held += batch.num_rows
        while held >= most:
            table = pa.Table.from_batches(kept)
            yield chunk(table.slice(0, most))
            rest = table.slice(most)
            kept, held = rest.combine_chunks().to_batches(), rest.num_rows
    if held:
        yield chunk(pa.Table.from_batches(kept))


_TREE = pa.list_(
    pa.struct(
        [
            ("points", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("radii", pa.list_(pa.float64())),
            ("counts", pa.list_(pa.int64())), ("rows", pa.list_(pa.int32())),
        ]
    )
)


def _trees(column: pa.ListArray, span: int) -> Iterator[list[Tree]]:
    for chunk in column:
        trees = []
        for t in chunk:
            ends = t["ends"].values.to_numpy().astype(np.int64)
            points = t["points"].values.to_numpy().reshape(len(ends), span)
            rows = t["rows"].values.to_numpy().astype(np.int64)
            trees.append(Tree(points, ends, t["radii"].values.to_numpy(), t["counts"].values.to_numpy(), rows))
        yield trees


def _refined(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts x entries x span) after one Lloyd round."""
    parts, entries, span = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros(books.shape, np.int64)
        for batch in batches:
            for chunk in _trees(batch.column("trees"), span):
                for p, tree in enumerate(chunk):
                    n, s = totals(tree, books[p])
                    count[p] += n
                    total[p] += s
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()),
                pa.array(list(total[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "s"],
        )

    partial = trees.mapInArrow(summed, "part int, entry int, n long, s array<long>")
    whole = (
        partial.select("part", "entry", "n", F.posexplode_outer("s").alias("at", "s"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    after = books.copy()
    for r in whole.collect():  # at most parts x entries x span rows
        if r["at"] is not None:
            after[r["part"], r["entry"], r["at"]] = r["s"] // r["n"]
    return after


def coded(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """One row per vector kept: id, label, ``code`` (entry per part) and ``error``; and the
    codebooks, parts x entries x components, None without vectors."""
    kept = settled(whole_vectors(vectors, vector_column, scale, 0, id=id_column, label=label_column))
    types = [kept.schema[name].dataType.simpleString() for name in ("id", "label")]
    width = common_width(kept)
    if width is None:
        empty = kept.select("id", "label", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.select(
            F.col("id").alias(id_column), F.col("label").alias(label_column), "code", "error"
        ), None
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    span = width // parts
    fit = kept.where(F.size("x") == width)
    first = fit.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, span).transpose(1, 0, 2)

    chunks = settled(
        fit.mapInArrow(
            lambda batches: _packed(batches, width, parts),
            f"ids array<{types[0]}>, labels array<{types[1]}>, trees {TREE}",
        )
    )
    for _ in range(rounds):
        books = _refined(chunks.select("trees"), books)

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, chunk in enumerate(_trees(batch.column("trees"), span)):
                told = [assigned(tree, books[p]) for p, tree in enumerate(chunk)]
                code = np.stack([t[0] for t in told], axis=1)
                error = np.sum([t[1] for t in told], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values, batch.column("labels")[i].values,
                        pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(error, pa.int64()),
                    ],
                    names=["id", "label", "code", "error"],
                )

    out = chunks.mapInArrow(ended, f"id {types[0]}, label {types[1]}, code array<int>, error long")
    return out.select(F.col("id").alias(id_column), F.col("label").alias(label_column), "code", "error"), books


def label_errors(codes: DataFrame, label_column: str = "label") -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels, nulls together."""
    rows = settled(codes.withColumn("__label", quoted(label_column)))
    sums = settled(rows.groupBy("__label").agg(F.sum("error").alias("label_error")))
    sums = sums.withColumnRenamed("__label", "__of")
    return rows.join(sums, F.col("__label").eqNullSafe(F.col("__of"))).drop("__label", "__of")


def codebooks_sha256(books: np.ndarray | None) -> str:
    """Digest of all components by part, entry and position."""
    flat = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
