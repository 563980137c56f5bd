"""Near-duplicate documents by one-permutation MinHash.

One pass over the texts hashes each document's distinct five-word shingles once.  The hash picks
one of 128 bins and a value in it; a bin keeps its least value, and an empty bin borrows that of
a full bin picked by a universal hash of (bin, attempt), which is optimal densification.  Four
bins make a band, equal bands put documents into a bucket (two documents of similarity 0.75
share none of the 32 bands with probability 5e-6).

Documents with the same set are one class from the start.  In each bucket the classes are
paired with one of them, the centre, so candidates grow with the members of a bucket and not
with their pairs; each band elects centres of its own.  Candidates are confirmed on their full
shingle sets.  A link that no star holds is found afterwards: members that did not end up in the
largest component of their bucket are held against the members of other components.  Most such
pairs are ruled out exactly before they become rows: shingles that no other set holds are never
common, and what two sets share is at most what both hold of a third set, their bucket's pivot,
plus what either holds besides.  The few left are confirmed alike.  Components are those of all
confirmed links.

Shingles are held as 64-bit hashes of their words, sets as sorted arrays of them.

Defined results: a null text, or one without words, has an empty set and is linked with nothing;
a text of fewer words than a shingle has one shingle, its whole word sequence; rows that share
an id are the same document and lie in one component; rows with a null id take part, their
component is the least id reachable or null, and they are kept only if that is null; an empty
table gives an empty result; only the two named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.graph import components
from ledgerline.operators.columns import quoted
from ledgerline.session import settled

WORDS = 5
BINS = 128
ROWS = 4
SIMILARITY = 75  # percent
KNOWN = 60_000  # words whose hashes a task remembers
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, words: int = WORDS, known: dict | None = None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in UTF-8."""
    # lower() and split() of bytes know A-Z and the six ASCII blanks only, as the rule asks
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    known = {} if known is None else known
    hashes = []
    for t in tokens:
        h = known.get(t)
        if h is None:
            h = known[t] = xxhash.xxh64_intdigest(t)
        hashes.append(h)
    if len(known) > KNOWN:
        known.clear()
    h = np.array(hashes, dtype=np.uint64)
    n = max(1, len(h) - words + 1)
    width = min(words, len(h))
    out = np.full(n, np.uint64(width))
    for k in range(width):
        out = _mixed(out * _MULTIPLIER + h[k : k + n])
    return np.unique(out)


_PROBES: dict[int, np.ndarray] = {}


def _probes(attempt: int) -> np.ndarray:
    if attempt not in _PROBES:
        x = np.arange(BINS, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(attempt + 1)
        _PROBES[attempt] = (_mixed(x * _MULTIPLIER) % np.uint64(BINS)).astype(np.int64)
    return _PROBES[attempt]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least value of each bin, empty bins filled by optimal densification."""
    h = _mixed(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
    bins = (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    order = np.argsort(h)[::-1]  # the least value of a bin is written last
    out[bins[order]] = h[order]
    full = np.zeros(BINS, bool)
    full[bins] = True
    missing, attempt = np.flatnonzero(~full), 0
    while len(missing):
        donor = _probes(attempt)[missing]
        found = full[donor]
        out[missing[found]] = out[donor[found]]
        missing, attempt = missing[~found], attempt + 1
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.arange(BINS // ROWS, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * _MULTIPLIER + sig[k::ROWS])
    return keys.view(np.int64)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        counts, nodes, bands = [], [], []
        for text in batch.column("text").cast(pa.large_binary()):
            s = shingle_set(text.as_py(), known=known)
            counts.append(len(s))
            nodes.append(_fingerprint(s) if len(s) else None)
            bands.append(band_keys(signature(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("plain"),
                pa.array(counts, pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=["id", "plain", "n", "node", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        nodes, sets = [], []
        for node, text in zip(
            batch.column("node").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True
        ):
            s = shingle_set(text.as_py(), known=known)
            if _fingerprint(s) == node:  # else another text under the same id
                nodes.append(node)
                sets.append(s.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
            names=["node", "shingles"],
        )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those similar enough: 100 times the intersection against the union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    together = F.size("left") + F.size("right")
    enough = 100 * both >= SIMILARITY * (together - both)
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of the pivot's shingles a set holds, one bit each."""
    for batch in batches:
        masks = []
        for mine, theirs in zip(batch.column("shingles"), batch.column("pivots"), strict=True):
            x, y = (c.values.to_numpy(zero_copy_only=False) for c in (mine, theirs))
            bits = np.zeros(-(-len(y) // 64) * 64, np.uint8)
            bits[: len(y)] = np.isin(y, x, assume_unique=True)
            masks.append(np.packbits(bits).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("pivot"), pa.array(masks, pa.list_(pa.int64()))],
            names=["node", "pivot", "mask"],
        )


def _held(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0).cast("long"), lambda total, m: total + F.bit_count(m))


def _apart(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of unlike ``component`` that share a bucket and may be similar enough.

    ``buckets`` has band, key, node, n, component and hub.  What two sets have in common is at
    most what both hold of a third, the bucket's pivot, plus what either holds besides; shingles
    that no other set holds are never common.  Both bounds are exact, so no link is lost.
    """
    loose = settled(buckets.select("node", "n").distinct())
    name = F.xxhash64("node").alias("hi"), F.xxhash64("node", F.lit(1)).alias("lo")
    spread = sets.join(loose.select("node").hint("merge"), "node", "left_semi").select(*name, F.explode("shingles").alias("s"))
    lone = (
        spread.groupBy("s").agg(F.count("*").alias("c"), F.min("hi").alias("hi"), F.min("lo").alias("lo"))
        .where("c = 1").groupBy("hi", "lo").agg(F.count("*").alias("lone"))
    )
    known = (
        loose.select("node", "n", *name).join(settled(lone).hint("merge"), ["hi", "lo"], "left")
        .select("node", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("common"), "n")
    )
    # a set has no partner at all if too little of it is anywhere else
    able = settled(known.where(100 * F.col("common") >= SIMILARITY * F.col("n")).select("node", "common"))
    rows = settled(buckets.join(able.hint("merge"), "node"))
    pivots = rows.groupBy("band", "key").agg(
        F.min_by("node", F.xxhash64("node")).alias("pivot"),
        F.min("component").alias("least"), F.max("component").alias("most"),
    )
    pivots = settled(pivots.where("least != most").select("band", "key", "pivot"))
    rows = settled(rows.join(pivots.hint("merge"), ["band", "key"]))
    mine = sets.select("node", "shingles")
    theirs = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("pivots"))
    masks = (
        rows.select("node", "pivot").distinct().join(mine.hint("merge"), "node").join(theirs.hint("merge"), "pivot")
        .select("node", "pivot", "shingles", "pivots").mapInArrow(_masks, "node binary, pivot binary, mask array<long>")
    )
    told = settled(rows.join(settled(masks).hint("merge"), ["node", "pivot"]).withColumn("held", _held(F.col("mask"))))
    outside = told.where("component != hub").select(
        "band", "key", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "common", "component", "mask", "held")]
    )
    both = _held(F.zip_with("mask", "x_mask", lambda p, q: p.bitwiseAND(q)))
    besides = F.greatest(F.least(F.col("common") - F.col("held"), F.col("x_common") - F.col("x_held")), F.lit(0))
    possible = (100 + SIMILARITY) * (both + besides) >= SIMILARITY * (F.col("n") + F.col("x_n"))
    return (
        told.join(outside.hint("merge"), ["band", "key"])
        .where((F.col("component") != F.col("x_component")) & _similar_size(F.col("n"), F.col("x_n")) & possible)
        .select(F.least("node", "x_node").alias("a"), F.greatest("node", "x_node").alias("b"))
        .distinct()
    )


def _similar_size(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``."""
    source = docs.select(
        quoted(id_column).alias("id"),
        quoted(text_column).alias("text"),
        # tells apart the texts of rows that share an id, or have none
        F.xxhash64(quoted(text_column)).alias("plain"),
    )
    sketches = settled(
        source.mapInArrow(
            _sketches,
            f"id {docs.schema[id_column].dataType.simpleString()}, plain long, n long, node binary, bands array<long>",
        )
    )
    # one row per class of equal sets
    classes = settled(
        sketches.where("node is not null")
        .groupBy("node")
        .agg(F.min(F.struct("id", "plain")).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    member = F.struct("n", "node")
    buckets = classes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    # every band has an order of its own, so that a class is not the centre everywhere
    turn = F.xxhash64("band", "node")
    centres = buckets.groupBy("band", "key").agg(
        F.min_by(member, turn).alias("centre"), F.count("*").alias("members")
    )
    # plain tables on both sides of a join let adaptive execution split it at a hot key
    centres = settled(centres.where("members > 1"))
    starred = settled(
        buckets.join(centres, ["band", "key"]).select(
            "band", "key", "node", "n", F.col("centre.node").alias("centre"), F.col("centre.n").alias("m")
        )
    )

    # shingle sets of the classes that share a bucket with another one
    wanted = starred.select("node").distinct()
    texts = classes.select("node", F.col("row.id").alias("of"), F.col("row.plain").alias("same"))
    texts = texts.join(wanted, "node", "left_semi")
    sets = settled(
        source.join(texts, (F.col("plain") == F.col("same")) & F.col("id").eqNullSafe(F.col("of")))
        .select("node", "text")
        .mapInArrow(_sets, "node binary, shingles array<long>")
        .dropDuplicates(["node"])
    )

    star = (
        starred.where(F.col("node") != F.col("centre"))
        .where(_similar_size(F.col("n"), F.col("m")))
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"))
    )
    star = settled(star)
    # first the most promising pair of each class; pairs inside a component need no check then
    best = star.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    first = settled(_confirmed(best.select("a", "b"), sets))
    label = settled(components(first))
    open_ = _between(star.select("a", "b"), label).join(best, ["a", "b"], "left_anti")
    links = settled(first.unionAll(_confirmed(open_, sets)))
    label = settled(components(links))

    # what the stars cannot see: members outside the component most of their bucket is in
    named = settled(
        starred.select("band", "key", "node")
        .join(label.hint("merge"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    parts = named.groupBy("band", "key", "component").agg(F.count("*").alias("members"))
    hubs = settled(
        parts.groupBy("band", "key")
        .agg(F.max_by("component", F.struct("members", "component")).alias("hub"), F.count("*").alias("parts"))
        .where("parts > 1")
    )
    torn = settled(
        named.join(hubs.hint("merge"), ["band", "key"])
        .select("band", "key", "node", "component", "hub")
        .join(classes.select("node", "n").hint("merge"), "node")
    )
    rest = _apart(torn, sets).join(star.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    more = settled(_confirmed(rest, sets))
    if not more.isEmpty():
        label = settled(components(links.unionAll(more)))

    # components are named by the least id in them
    placed = sketches.select("id", "n", "node").join(label, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = settled(
        placed.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    )
    ended = placed.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return ended.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document, that of the least id, of each component.

    Documents without words stay, and so do rows with a null id; rows that repeat an id stay or
    go together.
    """
    told = near_duplicates(docs.select(quoted(id_column), quoted(text_column)), id_column, text_column)
    gone = settled(told.where("not kept").select(quoted(id_column).alias("__gone")).distinct())
    row = F.struct(*[quoted(c).alias(c) for c in docs.columns])
    left = docs.select(row.alias("row"), quoted(id_column).alias("__id")).join(
        gone.hint("merge"), F.col("__id") == F.col("__gone"), "left_anti"
    )
    return left.select("row.*")


def _between(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    told = pairs.join(a, "a", "left").join(b, "b", "left")
    same = F.coalesce(F.col("ca"), F.col("a")) == F.coalesce(F.col("cb"), F.col("b"))
    return told.where(~same).select("a", "b")
