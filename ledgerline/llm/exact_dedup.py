"""Exact duplicates by distributed most-significant-digit radix partitioning.

Documents are split by their byte length and first bytes, and the groups that still hold more
than one document are split again by the following block of bytes, until a group has a single
member or its texts have ended.  Texts are compared byte by byte, no digest decides equality.
Blocks grow eightfold from round to round, so the rounds follow the logarithm of the longest
repeated text.  A round counts groups with map-side partial sums and joins the counts back, a
join that adaptive execution splits where one group is hot; only texts that agree with another
one on every byte seen so far reach the next round.

Defined results: a null text counts as empty; empty texts are equal to each other; a null id
never wins against an id, and a group of null ids only keeps a null; rows that share text and
id get the same verdict (``without_copies`` leaves one of them); an empty table gives an empty
result; further columns travel inside one struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.operators.columns import quoted
from ledgerline.session import settled

FIRST_BLOCK = 64
GROWTH = 8


def _split(df: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join the number of each repeated key combination; unmatched rows are alone."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    # written down, so that numbers stay the same when a task is run again
    numbered = settled(repeated.withColumn("next", F.monotonically_increasing_id()))
    # the same plan at every size: texts are shuffled once, never kept back by a broadcast
    return df.join(numbered.hint("merge"), keys, "left")


def _partitioned(
    docs: DataFrame, id_column: str, text_column: str, keep_text: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows that are alone, and rows of repeated texts with (round, gid) of their group."""
    others = [c for c in docs.columns if c != text_column]
    text = quoted(text_column)
    body = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = docs.select(
        quoted(id_column).alias("id"),
        F.struct(*[quoted(c).alias(c) for c in others], F.lit(True).alias("__others")).alias("row")
        if keep_text
        else F.lit(None).cast("boolean").alias("row"),
        text.isNull().alias("was_null"),
        F.sha2(body, 256).alias("sha") if not keep_text else F.lit(None).cast("string").alias("sha"),
        body.alias("body"),
        F.octet_length(body).alias("len"),
    ).withColumn("block", F.substring("body", 1, FIRST_BLOCK))
    kept = ["id", "row", "was_null", "sha", "body"]

    def moved(df: DataFrame, round_: int) -> DataFrame:
        # texts of rows that are alone are not needed any more unless the caller wants them
        still = F.col("body") if keep_text else F.when(F.col("next").isNotNull(), F.col("body"))
        return df.select(
            "id", "row", "was_null", "sha", still.alias("body"), "len",
            F.col("next").alias("gid"), F.lit(round_).alias("round"),
        )

    current = settled(moved(_split(rows, ["len", "block"]), 0))
    seen, width, round_ = FIRST_BLOCK, FIRST_BLOCK * GROWTH, 0
    alone, ended = [], []
    while True:
        alone.append(current.where("gid is null").select(*kept))
        ended.append(
            current.where((F.col("gid").isNotNull()) & (F.col("len") <= seen)).select(
                *kept, "round", "gid"
            )
        )
        running = current.where((F.col("gid").isNotNull()) & (F.col("len") > seen))
        if running.isEmpty():
            break
        round_ += 1
        blocks = running.withColumn("block", F.substring("body", seen + 1, width))
        current = settled(moved(_split(blocks, ["gid", "block"]).drop("gid"), round_))
        seen, width = seen + width, width * GROWTH
    singles, groups = alone[0], ended[0]
    for a, e in zip(alone[1:], ended[1:], strict=True):
        singles, groups = singles.unionByName(a), groups.unionByName(e)
    return singles, groups


def _judged(docs: DataFrame, id_column: str, text_column: str, keep_text: bool):
    singles, groups = _partitioned(docs, id_column, text_column, keep_text)
    # a plain table again, so that adaptive execution can split the join at a hot group
    verdicts = settled(
        groups.groupBy("round", "gid").agg(
            F.max("id").alias("keep_id"), F.count("*").alias("group_size")
        )
    )
    return singles, groups.join(verdicts.hint("merge"), ["round", "gid"], "left")


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the largest id stays.
    """
    singles, groups = _judged(docs, id_column, text_column, keep_text=False)
    shown = [F.col("id").alias(id_column), "keep_id", "group_size"]
    return (
        singles.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
        .unionByName(groups.select("id", "keep_id", "group_size", "sha"))
        .select(*shown, F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest id."""
    singles, groups = _judged(docs, id_column, text_column, keep_text=True)
    whole = F.struct("row", "was_null", "body")
    stays = (
        groups.where(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("round", "gid")
        .agg(F.min_by(whole, F.to_json("row")).alias("whole"))
        .select("whole.*")
    )
    rows = singles.select("row", "was_null", "body").unionByName(stays)
    text = F.when(~F.col("was_null"), F.decode("body", "UTF-8"))
    return rows.select(
        *[
            text.alias(c) if c == text_column else F.col("row").getField(c).alias(c)
            for c in docs.columns
        ]
    )
