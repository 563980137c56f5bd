"""Mixing sources to target weights.

Every source is cut into blocks of documents by a seeded hash, which puts its documents into a
random but repeatable order.  A source's target is met by whole passes over all its blocks plus
a last pass over the first blocks of that order; the block at the border is cut again and again
until the border lies at a document that does not fit.  That one is left out and the same descent
goes on behind it over the documents that still fit, until none is left; of those left out, the
smallest is added if going over is nearer to the target.  The blocks to draw are then shared out among output shards: a splitting tree
halves the shards and draws, at each node, how many blocks of each source go left from the
multivariate hypergeometric distribution, so that all shards have the same number of blocks and
all quotas are met exactly.  A shard draws that many blocks from the source's permuted blocks,
no block twice, and its documents are shuffled locally.

The driver sees one row per source and block (at most ``BLOCKS`` a source, whatever the size of
the data) and a table of shards; documents are assigned by expressions on their own row, so the
plan needs no shuffle until the mix itself is dealt out to its shards.

Defined results: null texts have size 0 and, like other texts without a word, are drawn with the
documents around them in the order; a null source is a source of its own, last in order;
a source of size 0 has target 0 and takes nothing; rows that share id and text are drawn
together; a null id is hashed as such; an empty table gives an empty mix.  Further columns travel
inside one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.columns import quoted
from ledgerline.session import settled

BLOCKS = 1024  # per source and level
_BITS = BLOCKS.bit_length() - 1
_DEPTH = 60 // _BITS  # levels
_END = 1 << (_BITS * _DEPTH)  # places in the order
ANY = (1 << 63) - 1  # no bound on a document's size
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight; none above ``most`` times its size, the excess reshared."""
    out = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left = total - sum(out)
        open_ = [i for i in open_ if i not in set(full)]
    return out


@dataclass(frozen=True)
class SourcePlan:
    source: str | None
    size: int
    target: float
    passes: int  # whole passes
    border: tuple[int, ...]  # first document left out of the last pass, one digit per level
    spans: tuple[tuple[int, int, int], ...]  # places from, to (exclusive), and largest size drawn
    extra: int | None  # order hash of one document more


def _digits(order: Column, level: int) -> Column:
    """Block number at a level: successive bits of the order hash."""
    return F.shiftrightunsigned(order, 64 - _BITS * (level + 1)).bitwiseAND(F.lit(BLOCKS - 1)).cast("int")


def _place(order: Column) -> Column:
    """The digits of all levels as one number."""
    return F.shiftrightunsigned(order, 64 - _BITS * _DEPTH)


def _same(source: Column, value: str | None) -> Column:
    return source.isNull() if value is None else source == value


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _with_size(docs: DataFrame, id_column: str, source_column: str, text_column: str, seed: int) -> DataFrame:
    return docs.select(
        quoted(id_column).alias("id"),
        quoted(source_column).cast("string").alias("source"),
        word_count(quoted(text_column)).alias("size"),
        # seeded order of documents; text takes part so that repeated ids are told apart
        F.xxhash64(F.lit(seed), quoted(id_column), quoted(text_column)).alias("order"),
        F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"),
    )


def _block_sizes(narrow: DataFrame, level: int) -> list:
    """One row per source and block: at most ``BLOCKS`` a source."""
    block = _digits(F.col("order"), level).alias("block")
    sums = F.sum("size").alias("size"), F.count("*").alias("n")
    return narrow.groupBy("source", block).agg(*sums).collect()


def _plan(sized: DataFrame, weights: Sequence[float], share: float, most: float):
    """Per source its target and border; also the size of every block."""
    narrow = settled(sized.select("source", "size", "order"))
    by_source: dict[str | None, dict[int, tuple[int, int]]] = {}
    for r in _block_sizes(narrow, 0):
        by_source.setdefault(r["source"], {})[r["block"]] = (r["size"], r["n"])
    sources = sorted((s for s in by_source if s is not None), key=lambda s: s.encode("utf-8"))
    sources += [None] if None in by_source else []
    sizes = [sum(size for size, _ in by_source[s].values()) for s in sources]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(sources))], share * sum(sizes), most)

    passes = [min(int(most), int(t // s)) if s else 0 for t, s in zip(aims, sizes, strict=True)]
    rest = {s: t - p * z for s, t, p, z in zip(sources, aims, passes, sizes, strict=True)}
    spans: dict[str | None, list[tuple[int, int, int]]] = {s: [] for s in sources}
    border: dict[str | None, tuple[int, ...]] = {}
    open_ = {s: (0, ANY) for s in sources if rest[s] > 0}  # next place, largest size that fits
    ready = by_source
    while open_:
        ends = {}
        path: dict[str | None, tuple[int, ...]] = dict.fromkeys(open_, ())
        level = 0
        while path:
            if ready is None:
                behind = [
                    _same(F.col("source"), s) & (_place(F.col("order")) >= open_[s][0])
                    & (F.col("size") <= open_[s][1]) & (F.col("size") > 0) & _in_block(F.col("order"), at)
                    for s, at in path.items()
                ]
                ready = {}
                for r in _block_sizes(narrow.where(_any(behind)), level):
                    ready.setdefault(r["source"], {})[r["block"]] = (r["size"], r["n"])
            deeper = {}
            for s, above in path.items():
                found, block = ready.get(s, {}), 0
                while block < BLOCKS and found.get(block, (0, 0))[0] <= rest[s]:
                    rest[s] -= found.get(block, (0, 0))[0]
                    block += 1
                at = (*above, block)
                if block < BLOCKS and found[block][1] > 1 and level + 1 < _DEPTH:
                    deeper[s] = at
                else:
                    ends[s] = at
            path, level, ready = deeper, level + 1, None
        going = {}
        for s, at in ends.items():
            start, limit = open_[s]
            width = 1 << (_BITS * (_DEPTH - len(at)))
            place = 0
            for digit in at:
                place = place * BLOCKS + digit
            place *= width
            border.setdefault(s, at)
            spans[s].append((start, place, limit))
            after = place + (width if at[-1] < BLOCKS else 0)
            if after < _END and rest[s] >= 1:
                going[s] = (after, int(rest[s]))
        open_ = going

    # one more where going over is nearer to the target than staying below
    left_out = [
        _same(F.col("source"), s) & (F.col("size") > 0) & (F.col("size") < 2 * rest[s])
        & ~_any([_in_span(F.col("order"), F.col("size"), *map(F.lit, span)) for span in spans[s]])
        for s in sources if rest[s] > 0
    ]
    extra: dict[str | None, int] = {}
    if left_out:
        found = narrow.where(_any(left_out)).groupBy("source", "order").agg(F.sum("size").alias("size"))
        least = found.groupBy("source").agg(F.min(F.struct("size", "order")).alias("least"))
        for r in least.collect():
            if r["least"]["size"] < 2 * rest[r["source"]]:
                extra[r["source"]] = r["least"]["order"]
    plans = [
        SourcePlan(s, z, t, p, border.get(s, ()), tuple(spans[s]), extra.get(s))
        for s, z, t, p in zip(sources, sizes, aims, passes, strict=True)
    ]
    return plans, {s: sorted(by_source[s]) for s in sources}


def _in_block(order: Column, border: Sequence[int]) -> Column:
    out = F.lit(True)
    for level, digit in enumerate(border):
        out = out & (_digits(order, level) == digit)
    return out


def _in_span(order: Column, size: Column, start: Column, end: Column, limit: Column) -> Column:
    return (_place(order) >= start) & (_place(order) < end) & (size <= limit)


def shard_quotas(blocks: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Splitting tree: blocks per shard and source.

    Each row of the result is a shard; columns add up to ``blocks`` exactly, and rows differ in
    their total by one block at most.
    """
    out = np.zeros((shards, len(blocks)), dtype=np.int64)
    stack = [(0, shards, np.asarray(blocks, dtype=np.int64), seed)]
    while stack:
        low, high, quota, key = stack.pop()
        if high - low == 1:
            out[low] = quota
            continue
        middle = (low + high) // 2
        total = int(quota.sum())
        left_total = total * (middle - low) // (high - low)
        rng = np.random.default_rng((seed, low, high))
        left = np.zeros_like(quota)
        remaining, wanted = total, left_total
        for i, q in enumerate(quota):  # one hypergeometric draw per source, given the others
            others = remaining - int(q)
            left[i] = rng.hypergeometric(int(q), others, wanted) if q and wanted else 0
            remaining, wanted = others, wanted - int(left[i])
        stack += [(low, middle, left, key), (middle, high, quota - left, key)]
    return out


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    shards: int = 64,
    seed: int = 17,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``row`` (its columns), ``id``, ``size``, ``source_size``,
    ``target``, ``order`` and ``shards``, the output shard of each of its copies.

    Sources are sorted by code point, null last, and weigh ``weights`` in turn.  All sources
    together get ``share`` of all words, none more than ``most`` times its own.
    """
    spark = docs.sparkSession
    sized = _with_size(docs, id_column, source_column, text_column, seed)
    plans, present = _plan(sized, weights, share, most)

    # blocks to draw of each source: its blocks once per pass, and those of the last pass
    draws: list[list[tuple[int, int]]] = []
    for p in plans:
        every = present[p.source]
        last = [b for b in every if p.border and b <= p.border[0]]
        draws.append([(k, b) for k in range(p.passes) for b in every] + [(p.passes, b) for b in last])
    quotas = shard_quotas([len(d) for d in draws], shards, seed)
    dealt = []
    for i, (p, d) in enumerate(zip(plans, draws, strict=True)):
        shuffled = np.random.default_rng((seed, 1 + i)).permutation(len(d))
        owner = np.repeat(np.arange(shards), quotas[:, i])
        shard_of = {d[j]: int(owner[k]) for k, j in enumerate(shuffled)}
        for block in sorted({b for _, b in d}):
            dealt.append((p.source, block, [shard_of.get((k, block)) for k in range(p.passes + 1)]))
    # at most BLOCKS rows a source, and small ones
    table = spark.createDataFrame(dealt, "m_source string, m_block int, m_shards array<int>")
    about = spark.createDataFrame(
        [
            (p.source, p.size, float(p.target), p.passes, list(p.spans), p.extra)
            for p in plans
        ],
        "s_source string, source_size long, target double, passes int, "
        "spans array<struct<start:long,end:long,limit:long>>, extra long",
    )
    drawn = F.exists(
        "spans", lambda x: _in_span(F.col("order"), F.col("size"), x["start"], x["end"], x["limit"])
    ) | F.col("order").eqNullSafe(F.col("extra"))
    told = sized.join(
        F.broadcast(about), F.col("source").eqNullSafe(F.col("s_source")), "left"
    ).withColumn("copies", F.col("passes") + drawn.cast("int"))
    placed = told.join(
        F.broadcast(table),
        F.col("source").eqNullSafe(F.col("m_source"))
        & (_digits(F.col("order"), 0) == F.col("m_block")),
        "left",
    )
    copies = F.coalesce(F.col("copies"), F.lit(0))
    # a document drawn behind the border comes without its block
    own = F.transform(
        F.sequence(F.lit(0), copies - 1),
        lambda k: F.coalesce(F.get("m_shards", k), F.pmod("order", F.lit(shards)).cast("int")),
    )
    return placed.select(
        "row", "id", "source", "size", "source_size", "target", "order",
        F.when(copies > 0, own)
        .otherwise(F.array().cast("array<int>")).alias("shards"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document as often as it is drawn,
    dealt out to its shards and shuffled within each."""
    seed = options.get("seed", 17)
    drawn = plan_mix(docs, **options).select(
        "row", "order", F.posexplode("shards").alias("copy", "shard")
    )
    return (
        drawn.repartition("shard", F.pmod("order", F.lit(8)))
        .sortWithinPartitions("shard", F.xxhash64(F.lit(seed + 1), "order", "copy"))
        .select("row.*")
    )
