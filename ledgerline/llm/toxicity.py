"""Toxicity severity by cumulative-link ordinal regression.

P(grade > k | x) = sigmoid(w . x - t_k) with ordered thresholds t_1 < t_2 < ...: one weight
vector serves all thresholds.  A document's expected severity is the sum of these probabilities
over k; it is rejected where a grade above 0 is more likely than not.

Features are sparse and binary: the words of the text and their beginnings of ``STEMS``
characters, hashed into ``2 ** BITS`` slots.  Each document counts a slot once, however long it
is.  Only features that speak for toxicity take part, with weights of 0 or more (the share of
toxic documents among those that hold it is above ``TELLING`` by the lower Wilson bound); ordinary
words neither excuse a document nor add up in a long one.

The labels say toxic or not; ``graded`` makes ordered grades of them: a toxic document's grade
follows how many of these features it holds.  A column of grades is used as it is if named.

The fit takes a sample of about ``SAMPLE`` labelled documents at most, chosen by a hash of their
id; the sample's feature lists, not its texts, reach the driver, so their number is bounded by
that parameter.  Scoring covers every document and whole texts.

Defined results: a null or empty text has no features and severity of the intercept alone, it is
never rejected; null labels are not learned from; without labels, or with one label only, nothing
is rejected and severity is 0; repeated rows are scored each; an empty table gives an empty
result; columns of the input travel untouched, ``severity``, ``grade`` and ``toxic`` of the
input are replaced where the names clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from ledgerline.operators.columns import quoted

BITS = 18
STEMS = (4, 5, 6, 7, 8)
SAMPLE = 15_000  # labelled documents in the fit
TELLING = 0.5
SURE = 2.5  # standard errors of the Wilson bound
GRADES = (1, 10, 24)  # telling features that make grades 1, 2 and 3
KNOWN = 60_000  # words whose slots a task remembers

_WORD = regex.compile(r"\p{L}+")


def features(text: str | None, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Sorted distinct slots of a text."""
    if not text:
        return np.empty(0, np.int32)
    out: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        slots = known.get(word)
        if slots is None:
            # marked, so that a stem and a word do not share a hash
            parts = (*("^" + word[:n] for n in STEMS if n < len(word)), "^" + word, word)
            slots = tuple(xxhash.xxh64_intdigest(p) >> (64 - BITS) for p in parts)
            if len(known) >= KNOWN:
                known.clear()
            known[word] = slots
        out.update(slots)
    return np.fromiter(sorted(out), np.int32, len(out))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # float32, one per slot
    thresholds: np.ndarray  # increasing; none if there was nothing to learn

    def exceeded(self, slots: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        z = float(self.weights[slots].sum(dtype=np.float64)) - self.thresholds
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Which slots speak for toxicity, as a mask."""
    seen, bad = np.zeros(2**BITS), np.zeros(2**BITS)
    for slots, t in zip(rows, toxic, strict=True):
        seen[slots] += 1
        bad[slots] += t
    n, z = np.maximum(seen, 1), SURE
    rate = bad / n
    low = (rate + z * z / (2 * n) - z * np.sqrt(rate * (1 - rate) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return low > TELLING


def graded(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Ordered grades of labelled documents, 0 where not toxic."""
    mask = telling(rows, toxic)
    hits = np.array([mask[s].sum() for s in rows], dtype=np.int64)
    grade = 1 + sum((hits >= more).astype(np.int64) for more in GRADES[1:])
    return np.where(toxic > 0, grade, 0)


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, rounds: int = 300, ridge: float = 1e-4, rate: float = 0.3
) -> OrdinalModel:
    """Weights and thresholds by Adam on the likelihood of the grades; deterministic."""
    weights = np.zeros(2**BITS)
    levels = int(grades.max(initial=0))
    if not rows or not levels or (grades > 0).all():
        return OrdinalModel(weights.astype(np.float32), np.empty(0))
    mask = telling(rows, grades > 0)
    rows = [r[mask[r]] for r in rows]
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if lengths.sum() else np.empty(0, np.int32)
    used, inside = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), lengths)
    above = (grades[:, None] > np.arange(levels)[None, :]).astype(np.float64)
    # ordered thresholds as a first one and positive steps
    share = above.mean(axis=0).clip(1e-3, 1 - 1e-3)
    first = np.log((1 - share) / share)
    params = np.concatenate([np.zeros(len(used)), first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    u = len(used)
    for step in range(1, rounds + 1):
        w, steps = params[:u], np.exp(params[u + 1 :])
        t = params[u] + np.concatenate([[0.0], np.cumsum(steps)])
        z = np.bincount(owner, w[inside], len(rows)) if u else np.zeros(len(rows))
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - t, -40, 40)))
        # grade g has P = p[g-1] - p[g]; its slope in z and in the thresholds around it
        edge = np.concatenate([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))], axis=1)
        slope = edge * (1 - edge)
        index = np.arange(len(rows))
        likely = np.maximum(edge[index, grades] - edge[index, grades + 1], 1e-9)
        gz = -(slope[index, grades] - slope[index, grades + 1]) / likely / len(rows)
        gt = np.zeros((len(rows), levels + 2))
        gt[index, grades] += slope[index, grades] / likely
        gt[index, grades + 1] -= slope[index, grades + 1] / likely
        gt = gt[:, 1:-1].sum(axis=0) / len(rows)
        gw = (np.bincount(inside, gz[owner], u) if u else np.zeros(0)) + ridge * w
        tail = np.cumsum(gt[::-1])[::-1]
        grad = np.concatenate([gw, tail[:1], tail[1:] * steps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) / (1 + step / 50)
        params[:u] = np.maximum(params[:u], 0)
    weights[used] = params[:u]
    t = params[u] + np.concatenate([[0.0], np.cumsum(np.exp(params[u + 1 :]))])
    return OrdinalModel(weights.astype(np.float32), t)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        lists = [features(t.as_py(), known) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array(lists, pa.list_(pa.int32()))], names=["grade", "slots"]
        )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_column: str = "toxic",
    grade_column: str | None = None,
    sample: int = SAMPLE,
) -> OrdinalModel:
    """Learn from the labelled documents."""
    told = labels.select(
        quoted(id_column).alias("id"), quoted(grade_column or toxic_column).cast("int").alias("grade")
    ).where("id is not null and grade is not null")
    # a bounded share of them, chosen by the id alone
    share = min(1.0, sample / max(1, told.count()))
    draw = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    chosen = told.where(draw).groupBy("id").agg(F.max("grade").alias("grade"))
    texts = docs.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"))
    # the ids are bounded by the sample, whatever the data; texts stay where they are
    known = texts.join(F.broadcast(chosen), "id").select("grade", "text")
    rows = known.mapInArrow(_slots, "grade int, slots array<int>")
    found = rows.toArrow()
    # in a fixed order, so that a fit does not depend on the order of tasks
    pairs = sorted(
        (
            (np.asarray(s.values, dtype=np.int32), g.as_py())
            for g, s in zip(found.column("grade"), found.column("slots"), strict=True)
        ),
        key=lambda x: (x[1], x[0].tobytes()),
    )
    slots, grades = [p[0] for p in pairs], np.array([p[1] for p in pairs], dtype=np.int64)
    return fit_ordinal(slots, grades if grade_column else graded(slots, grades))


def scored(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade), ``grade`` (the most exceeded thresholds) and
    ``toxic`` (a grade above 0 is more likely than not)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights, whatever the data
    added = ["severity", "grade", "toxic"]
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        m = shared.value
        for batch in batches:
            severity, grade, toxic = [], [], []
            for text in batch.column(batch.schema.get_field_index(text_column)):
                slots = features(text.as_py(), known)
                p = m.exceeded(slots)
                severity.append(float(p.sum()))
                grade.append(int((p > 0.5).sum()) if len(slots) else 0)
                toxic.append(bool(len(slots) and len(p) and p[0] > 0.5))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            new = [pa.array(severity, pa.float64()), pa.array(grade, pa.int32()), pa.array(toxic, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*kept, *added])

    schema = StructType(
        [docs.schema[c] for c in kept]
        + [StructField("severity", DoubleType()), StructField("grade", IntegerType()), StructField("toxic", BooleanType())]
    )
    return docs.mapInArrow(run, schema)
