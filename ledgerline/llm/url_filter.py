"""URL filters: rules first, then a classifier over words cut out of host and path.

Rules name a host and a path: a rule fits its host and all subdomains of it if the URL's path
starts with the rule's; the longest rule that fits decides.  Every other URL is judged by its
words.  Runs of letters in host and path are cut into words by the most probable segmentation
(Viterbi) under a unigram model, whose counts are those of the words in the pages' own texts
plus the seed words; a stretch that is no word costs ten for the opening and ten a letter, so
``cheappills`` falls into two words and a name the model does not know stays whole.
A multinomial naive Bayes over the words of host and path gives the verdict.

The classifier learns from all pages.  Where no column of verdicts is given, a URL counts as
unwanted if its host holds one of the ``SEEDS``; the words that come along with them (and the
hosts that lack every seed) then get their weights from the counts.  Each word is smoothed by
one occurrence dealt to the classes by their sizes, so a word seen nowhere says nothing.

All URLs of one shape (same runs in the same order, numbers alike) are one row from the start,
so a host or a path that a third of the pages share is segmented and scored once.  The unigram
model is joined on the stretches that occur, never sent around whole; weights are whole
millionths, so sums do not depend on their order.

Defined results: a null URL, or one without ``://``, has an empty host and path, which no rule
fits, and is judged by the prior alone; texts of pages may be null; rows that repeat are judged
alike; an empty table gives an empty result; a run longer than ``LONGEST`` letters, the length
of a host label, is cut there; a tie goes to allow; of equally probable segmentations the one
with the longer last word is taken; only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.columns import quoted
from ledgerline.session import settled

# Words of unwanted hosts.
SEEDS = (
    "ads", "adserver", "adult", "bet", "bets", "betting", "casino", "cialis", "escort", "gambling", "jackpot",
    "keygen", "lottery", "malware", "payday", "phishing", "pills", "poker", "porn", "slots", "spam", "tracker",
    "viagra", "warez", "xxx",
)

LONGEST = 63
WORD = 24  # letters a word of the model has at most
UNIT = 1_000_000  # weights are whole millionths
RUN = r"\p{L}+|\p{N}+"


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rules(*texts: str) -> list[Rule]:
    """Rules from texts such as ``block example.com/de/``."""
    out = []
    for text in texts:
        verdict, name = text.split(" ", 1)
        host, slash, path = name.partition("/")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(host: Column, path: Column, listed: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    tried = [
        F.when(
            ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path),
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in sorted(listed, key=lambda r: (-len(r.name), r.name))
    ]
    return F.coalesce(*tried, F.lit(None).cast("struct<rule:string,verdict:string>"))


def runs(text: Column) -> Column:
    """Runs of letters, at most ``LONGEST`` long, and ``#`` for every number."""
    found = F.regexp_extract_all(F.lower(text), F.lit(RUN), F.lit(0))
    cut = F.transform(
        found,
        lambda r: F.when(r.rlike(r"^\p{N}"), F.array(F.lit("#"))).otherwise(
            F.regexp_extract_all(r, F.lit(f"(?s).{{1,{LONGEST}}}"), F.lit(0))
        ),
    )
    return F.flatten(cut)


def word_counts(texts: DataFrame, text_column: str, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """``word`` and ``n``: the words of 2 to ``WORD`` letters in texts without their tags, each
    seed once more."""
    plain = F.lower(F.regexp_replace(F.coalesce(quoted(text_column), F.lit("")), "<[^>]*>", " "))
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(2, WORD))
    added = texts.sparkSession.createDataFrame([(s,) for s in seeds], "word string")
    return words.unionAll(added).groupBy("word").agg(F.count("*").alias("n"))


def best_words(piece: str, logs: dict[tuple[int, int], float], opening: float) -> list[str]:
    """The most probable cut of ``piece``; ``logs`` has the words found in it by (start, end)."""
    ending: dict[int, list[int]] = {}
    for start, end in logs:
        ending.setdefault(end, []).append(start)
    best, unknown, back = [0.0], [-math.inf], [0]
    origin = [0]  # where the unknown stretch that ends here was opened
    for i in range(1, len(piece) + 1):
        opened, longer = best[i - 1] + opening, unknown[i - 1]
        unknown.append(max(opened, longer) - math.log(10))
        origin.append(i - 1 if opened > longer else origin[i - 1])
        score, start = unknown[i], origin[i]
        for s in sorted(ending.get(i, ())):
            if best[s] + logs[s, i] > score or (best[s] + logs[s, i] == score and s < start):
                score, start = best[s] + logs[s, i], s
        best.append(score)
        back.append(start)
    out, at = [], len(piece)
    while at:
        out.append(piece[back[at] : at])
        at = back[at]
    return out[::-1]


def segmented(pieces: DataFrame, words: DataFrame) -> DataFrame:
    """``piece`` and ``words`` for every row of ``pieces`` (distinct, at most ``LONGEST`` long)."""
    total = words.agg(F.sum("n")).first()[0] or 1
    starts = F.sequence(F.lit(1), F.length("piece") - 1)
    spread = (
        pieces.where(F.length("piece") > 1)
        .select("piece", F.explode(starts).alias("start"))
        .select("piece", "start", F.explode(F.sequence(F.lit(2), F.least(F.lit(WORD), F.length("piece") - F.col("start") + 1))).alias("long"))
        .select("piece", "start", "long", F.expr("substr(piece, start, long)").alias("word"))
    )
    found = settled(spread.join(words, "word").select("piece", "start", "long", "n"))
    held = found.groupBy("piece").agg(F.collect_list(F.struct("start", "long", "n")).alias("found"))
    opening = math.log(10 / total)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for piece, found in zip(batch.column("piece").to_pylist(), batch.column("found").to_pylist(), strict=True):
                logs = {(f["start"] - 1, f["start"] - 1 + f["long"]): math.log(f["n"] / total) for f in found or ()}
                out.append(best_words(piece, logs, opening))
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out, pa.list_(pa.string()))], names=["piece", "words"])

    return pieces.join(held, "piece", "left").mapInArrow(cut, "piece string, words array<string>")


def judged(
    pages: DataFrame,
    listed: Sequence[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    verdict_column: str | None = None,
    seeds: Sequence[str] = SEEDS,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict`` and ``score``, the log odds
    of a block by the classifier.

    ``verdict_column`` names known verdicts (block, allow or null) to learn from in place of seeds.
    """
    host, path = host_and_path(quoted(url_column).cast("string"))
    known = F.lit(None).cast("string") if verdict_column is None else quoted(verdict_column).cast("string")
    rows = pages.select(quoted(id_column).alias("id"), host.alias("host"), path.alias("path"), known.alias("known"))
    rows = rows.select("*", ruled(F.col("host"), F.col("path"), listed).alias("ruled"))
    runs_of = F.struct(runs(F.col("host")).alias("host"), runs(F.col("path")).alias("path"))
    shape = F.sha2(F.to_json(runs_of), 256)
    rows = settled(rows.select("*", runs_of.alias("runs")).withColumn("shape", F.unhex(shape)))
    block = F.count(F.when(F.col("known") == "block", 1))
    allow = F.count(F.when(F.col("known") == "allow", 1))
    shapes = settled(
        rows.groupBy("shape").agg(
            F.first("runs").alias("runs"), F.count("*").alias("n"), block.alias("block"), allow.alias("allow")
        )
    )
    spread = shapes.select(
        "shape", "n", "block", "allow",
        F.explode(
            F.concat(
                F.transform("runs.host", lambda r: F.struct(F.lit("host").alias("part"), r.alias("piece"))),
                F.transform("runs.path", lambda r: F.struct(F.lit("path").alias("part"), r.alias("piece"))),
            )
        ).alias("run"),
    ).select("shape", "n", "block", "allow", "run.part", "run.piece")
    pieces = settled(spread.select("piece").distinct())
    words = settled(word_counts(pages, text_column, seeds))
    cut = settled(segmented(pieces, words))
    tokens = settled(
        spread.join(cut, "piece").select("shape", "n", "block", "allow", "part", F.explode("words").alias("word"))
    )
    if verdict_column is None:
        # a URL whose host holds a seed is an example of what is unwanted
        seeded = settled(
            tokens.where((F.col("part") == "host") & F.col("word").isin(*seeds)).select("shape").distinct()
        ).withColumn("seeded", F.lit(True))
        classes = [
            t.join(seeded, "shape", "left").withColumns(
                {"block": F.when(F.col("seeded"), F.col("n")).otherwise(0), "allow": F.when(F.col("seeded"), 0).otherwise(F.col("n"))}
            )
            for t in (tokens, shapes)
        ]
        tokens, labelled = settled(classes[0]), classes[1]
    else:
        labelled = shapes
    sums = F.sum("block").alias("block"), F.sum("allow").alias("allow")
    prior = labelled.agg(*sums).first()
    counted = settled(tokens.groupBy("part", "word").agg(*sums))
    size = counted.agg(*sums).first()
    if prior["block"] and prior["allow"]:
        odds = size["block"] / size["allow"]
        share = size["block"] / (size["block"] + size["allow"])
        weight = F.log((F.col("block") + share) / (F.col("allow") + 1 - share) / odds)
        start = round(UNIT * math.log(prior["block"] / prior["allow"]))
    else:  # one class only: everything is of that class
        weight, start = F.lit(0.0), UNIT if prior["block"] else -UNIT
    weights = counted.select("part", "word", F.round(weight * UNIT).cast("long").alias("weight"))
    scores = settled(
        tokens.select("shape", "part", "word").join(weights, ["part", "word"])
        .groupBy("shape").agg(F.sum("weight").alias("weight"))
    )
    told = rows.join(scores, "shape", "left").withColumn(
        "score", F.coalesce(F.col("weight"), F.lit(0)) + F.lit(start).cast("long")
    )
    method = F.when(F.col("score") > 0, "block").otherwise("allow")
    return told.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", method).alias("verdict"),
        (F.col("score") / UNIT).alias("score"),
    )
