"""Language identification by interpolated Kneser-Ney character models.

Every learned language has a character model of order ``ORDER``: raw counts at the top, counts of
different left neighbours below, absolute discounts estimated from the counts of counts, each
order interpolated with the one below and the lowest with a uniform one.  The models of all
languages are kept together: for each order a sorted array of 64-bit hashes of the n-grams seen
in any language with a column of log probabilities per language, and one of contexts with their
back-off weights.  A text is looked up in them array by array; the language with the lowest
cross-entropy per character wins.

Texts are lower-cased, and every run of characters that are no letters is one blank.

The fit draws documents by a hash of their id until about ``SAMPLE_CHARS`` characters per
language are expected; the different n-grams of that sample reach the driver, so their number is
bounded by the parameter.  One in ten of the drawn documents is kept out of the counts to
calibrate: the sharpness of the score (the winner's probability), and the cross-entropy beyond
which a text is rejected as none of the languages.  Prediction covers every document and whole
texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is rejected;
so is every text if no language was learned; equal cross-entropies go to the language first in
order; rows without a language are not learned from; repeated rows are predicted each; an empty
table gives an empty result; columns of the input travel untouched, those named like the
results are replaced.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from ledgerline.operators.columns import quoted

ORDER = 5
SAMPLE_CHARS = 1_500_000  # characters per language in the fit
REJECT = 0.002  # share of genuine calibration texts that may be rejected
UNKNOWN = "und"
_BLANK = 32


def _letters() -> np.ndarray:
    """Lower-cased code point of each letter, 0 for all other characters.

    The last entry stands for all code points behind the last letter.
    """
    last = max(code for code in range(0x110000) if chr(code).isalpha())
    table = np.zeros(last + 2, np.uint32)
    for code in range(last + 1):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_TABLE: list[np.ndarray] = []
_FACTORS = np.random.default_rng(11).integers(1, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normalised(text: str | None) -> np.ndarray:
    """Code points of the text's letters, runs of others as one blank, a blank at either end."""
    if not text:
        return np.empty(0, np.uint32)
    if not _TABLE:
        _TABLE.append(_letters())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = _TABLE[0][np.minimum(codes, len(_TABLE[0]) - 1)]
    if not low.any():
        return np.empty(0, np.uint32)
    out = np.zeros(len(low) + 2, np.uint32)
    out[1:-1] = low
    blank = out == 0
    out[blank] = _BLANK
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return out[keep]


def _hashes(codes: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n characters up to each end."""
    out = np.full(len(ends), np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))
    for k in range(n):
        out += codes[ends - k].astype(np.uint64) * _FACTORS[k]
    return out


def _gram_hashes(grams: list[str], n: int) -> np.ndarray:
    if not grams:
        return np.empty(0, np.uint64)
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
    return _hashes(codes, np.arange(len(grams)) * n + n - 1, n)


@dataclass
class LanguageModels:
    languages: list[str]
    hashes: list[np.ndarray] = field(default_factory=list)  # per order, sorted
    logs: list[np.ndarray] = field(default_factory=list)  # per order: n-grams x languages
    contexts: list[np.ndarray] = field(default_factory=list)  # per order, sorted
    weights: list[np.ndarray] = field(default_factory=list)  # per order: contexts x languages
    uniform: float = 0.0
    sharpness: float = 1.0
    limit: np.ndarray | None = None  # largest cross-entropy accepted, per language

    def entropies(self, codes: np.ndarray) -> np.ndarray:
        """Cross-entropy per character in each language."""
        ends = np.arange(1, len(codes))  # the first blank is given
        total = np.zeros(len(self.languages))
        inner = ends[ends >= ORDER - 1]
        if len(inner):
            top = _hashes(codes, inner, ORDER)
            _, first, times = np.unique(top, return_index=True, return_counts=True)
            total += times @ self._logs(codes, inner[first], ORDER)
        for e in ends[ends < ORDER - 1]:
            total += self._logs(codes, np.array([e]), int(e) + 1)[0]
        return -total / len(ends)

    def _logs(self, codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
        """Log probabilities of the characters at ``ends``, given up to ``order`` - 1 before."""
        out = np.zeros((len(ends), len(self.languages)))
        open_ = np.arange(len(ends))
        for n in range(order, 0, -1):
            at = ends[open_]
            row = _found(self.hashes[n - 1], _hashes(codes, at, n))
            hit = row >= 0
            out[open_[hit]] += self.logs[n - 1][row[hit]]
            open_, at = open_[~hit], at[~hit]
            if not len(open_):
                return out
            known = _found(self.contexts[n - 1], _hashes(codes, at - 1, n - 1))
            out[open_[known >= 0]] += self.weights[n - 1][known[known >= 0]]
        out[open_] += self.uniform
        return out

    def predict(self, codes: np.ndarray) -> tuple[str, float, bool]:
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, True
        e = self.entropies(codes)
        best = int(e.argmin())
        score = 1 / np.exp(-(e - e[best]) * self.sharpness).sum()
        return self.languages[best], float(score), bool(self.limit is not None and e[best] > self.limit[best])


def _found(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Row of each wanted hash in a sorted array, -1 where it is not there."""
    if not len(table):
        return np.full(len(wanted), -1)
    row = np.searchsorted(table, wanted).clip(max=len(table) - 1)
    return np.where(table[row] == wanted, row, -1)


def kneser_ney(counts: dict[str, dict[str, int]]) -> LanguageModels:
    """Models from counts of n-grams of order ``ORDER`` per language."""
    languages = sorted(counts)
    by_order: list[list[dict[str, int]]] = [[] for _ in range(ORDER)]
    for language in languages:
        level = dict(counts[language])
        by_order[ORDER - 1].append(level)
        for n in range(ORDER - 1, 0, -1):
            level = Counter(g[1:] for g in level)  # different left neighbours
            by_order[n - 1].append(level)
    model = LanguageModels(languages)
    characters = len({g for level in by_order[0] for g in level}) + 1
    model.uniform = -math.log(characters)
    below: dict[str, int] = {}
    below_p = np.full((1, len(languages)), 1 / characters)
    for n in range(1, ORDER + 1):
        grams = sorted(set().union(*by_order[n - 1])) if languages else []
        contexts = sorted({g[:-1] for g in grams})
        row_of = {c: i for i, c in enumerate(contexts)}
        owner = np.array([row_of[g[:-1]] for g in grams], dtype=np.int64)
        lower = below_p[[below[g[1:]] for g in grams]] if n > 1 else np.repeat(below_p, len(grams), axis=0)
        p, weight = np.zeros((len(grams), len(languages))), np.ones((len(contexts), len(languages)))
        for i, level in enumerate(by_order[n - 1]):
            c = np.array([level.get(g, 0) for g in grams], dtype=np.float64)
            once, twice = (c == 1).sum(), (c == 2).sum()
            discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
            whole = np.bincount(owner, c, len(contexts))
            kinds = np.bincount(owner, c > 0, len(contexts))
            seen = whole > 0
            weight[seen, i] = discount * kinds[seen] / whole[seen]
            share = np.divide(np.maximum(c - discount, 0), whole[owner], out=np.zeros_like(c), where=seen[owner])
            p[:, i] = share + weight[owner, i] * lower[:, i]
        for keys, values, hashes, logs in (
            (grams, p, model.hashes, model.logs),
            (contexts, weight, model.contexts, model.weights),
        ):
            h = _gram_hashes(keys, n if keys is grams else n - 1) if n > 1 or keys is grams else np.full(len(keys), 0, np.uint64)
            order = np.argsort(h)
            hashes.append(h[order])
            logs.append(np.log(values[order]).astype(np.float32))
        below, below_p = {g: i for i, g in enumerate(grams)}, p
    return model


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for text, language in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            s = normalised(text.as_py()).tobytes().decode("utf-32-le")
            found[language].update(s[i : i + ORDER] for i in range(len(s) - ORDER + 1))
    rows = [(language, g, n) for language, grams in found.items() for g, n in grams.items()]
    if rows:
        a, b, c = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())], names=["lang", "gram", "n"]
        )


def fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    sample_chars: int = SAMPLE_CHARS,
) -> LanguageModels:
    """Models of the languages of ``docs``; only documents with a text and a language count."""
    told = docs.select(
        quoted(id_column).alias("id"), quoted(text_column).alias("text"), quoted(language_column).alias("lang")
    ).where("text is not null and lang is not null")
    sizes = told.groupBy("lang").agg(F.sum(F.length("text")).alias("chars")).collect()
    part = F.lit(0.0)
    for r in sizes:
        share = min(1.0, sample_chars / r["chars"]) if r["chars"] else 1.0
        part = F.when(F.col("lang") == r["lang"], share).otherwise(part)
    draw = F.xxhash64(F.lit(7), "id")
    chosen = told.where(F.pmod(draw, F.lit(1 << 30)) < part * (1 << 30)).withColumn(
        "aside", F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(10)) == 0
    )
    grams = (
        chosen.where("not aside").select("text", "lang")
        .mapInArrow(_counted, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for language, gram, n in zip(*(grams.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
        counts[language][gram] = n
    model = kneser_ney(counts)
    if model.languages:
        _calibrate(model, chosen.where("aside").select("text", "lang"))
    return model


def _calibrate(model: LanguageModels, aside: DataFrame) -> None:
    """Sharpness of the score by likelihood, and limits of the cross-entropy, on texts apart."""
    shared = aside.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = []
            for text in batch.column("text"):
                codes = normalised(text.as_py())
                out.append(m.entropies(codes).tolist() if len(codes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(out, pa.list_(pa.float64()))], names=["lang", "e"]
            )

    found = aside.mapInArrow(measured, "lang string, e array<double>").where("e is not null").toArrow().to_pylist()
    found = sorted((r for r in found if r["lang"] in model.languages), key=lambda r: (r["lang"], r["e"]))
    if not found:
        return
    e = np.array([r["e"] for r in found])
    truth = np.array([model.languages.index(r["lang"]) for r in found])
    gap = e - e.min(axis=1, keepdims=True)
    fits = []
    for s in np.geomspace(0.5, 200, 40):
        own = -gap[np.arange(len(e)), truth] * s - np.log(np.exp(-gap * s).sum(axis=1))
        fits.append((own.mean(), s))
    model.sharpness = float(max(fits)[1])
    right = e.argmin(axis=1) == truth
    model.limit = np.array(
        [
            np.quantile(e[right & (truth == i), i], 1 - REJECT) + 0.5 if (right & (truth == i)).any() else np.inf
            for i in range(len(model.languages))
        ]
    )


def identified(docs: DataFrame, model: LanguageModels, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    # bounded by the fit's sample, whatever the data
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column))
            told = [m.predict(normalised(t.as_py())) for t in texts]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            new = [
                pa.array([t[0] for t in told], pa.string()),
                pa.array([t[1] for t in told], pa.float64()),
                pa.array([t[2] for t in told], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*kept, *added])

    schema = StructType(
        [docs.schema[c] for c in kept]
        + [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    )
    return docs.mapInArrow(run, schema)
