"""Quality grades by ordinal regression on hashed text.

Texts become hashed counts of three-byte sequences. One weight vector is shared by all grades; ordered
thresholds cut its scale: P(grade <= k) = sigmoid(threshold k - score). The expected grade ranks documents, and
the tail probability P(grade >= g) selects them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.frames import add_columns, free_name
from stallwatch.llm.quality_rules import labelled_sample
from stallwatch.llm.words import ALNUM, U64, Words, chunks, mix

BITS = 11
#: Grade of each byte-sequence hash is looked up in a table of all two-byte starts and one of the third bytes.
_TABLES = [(mix(np.arange(256, dtype=U64) + U64(1000 * k)) >> U64(64 - BITS)).astype(np.int64) for k in (1, 2, 3)]


def hashed(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, bucket) of every three-byte sequence inside a document, and the texts' lengths."""
    words = Words(text, ALNUM)
    d = words.data
    sizes = np.diff(words.offsets)
    doc = np.repeat(np.arange(len(text)), sizes)
    if len(d) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), sizes
    a, b, c = (t[d] for t in _TABLES)
    bucket = (a[:-2] + 3 * b[1:-1] + 7 * c[2:]) & ((1 << BITS) - 1)
    inside = doc[:-2] == doc[2:]
    return doc[:-2][inside], bucket[inside], sizes


@dataclass
class GradeModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def scores(self, text: pa.Array) -> np.ndarray:
        doc, bucket, sizes = hashed(text)
        return np.bincount(doc, self.weights[bucket], len(text)) / np.maximum(sizes - 2, 1)

    def tails(self, text: pa.Array) -> np.ndarray:
        """(documents, grades - 1): P(grade >= 1), P(grade >= 2), ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - self.scores(text)[:, None], -500, 500)))


def fit_cumulative_link(x: np.ndarray, y: np.ndarray, grades: int, l2: float = 1e-3, steps: int = 120, rate: float = 0.5) -> GradeModel:
    """Maximum likelihood with a penalty, by Adam. Thresholds are a first one and positive gaps, so they stay ordered.
    x holds shares of buckets; they are centred and scaled for the descent and the weights scaled back."""
    n, dims = x.shape
    if not n:
        return GradeModel(np.zeros(dims), np.zeros(grades - 1))
    mean, spread = x.mean(0), x.std(0) + 1e-4
    z = ((x - mean) / spread).astype(np.float32)
    share = np.clip(np.array([(y <= k).mean() for k in range(grades - 1)]), 0.01, 0.99)
    cuts = np.maximum.accumulate(np.log(share / (1 - share)) + 0.01 * np.arange(grades - 1))
    params = np.concatenate([np.zeros(dims), cuts[:1], np.log(np.maximum(np.diff(cuts), 0.05))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, first, gaps = params[:dims], params[dims], np.exp(params[dims + 1 :])
        theta = np.concatenate([[-np.inf, first], first + np.cumsum(gaps), [np.inf]])
        f = (z @ w.astype(np.float32)).astype(float)
        hi, lo = (1 / (1 + np.exp(np.clip(f - theta[y + i], -500, 500))) for i in (1, 0))
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        df = (dhi - dlo) / n  # of the negative log-likelihood by the score
        dt = np.zeros(grades + 1)
        np.add.at(dt, y + 1, -dhi / n)
        np.add.at(dt, y, dlo / n)
        dt = dt[1:-1]
        g = np.concatenate([df.astype(np.float32) @ z + l2 * w, [dt.sum()], [dt[k + 1 :].sum() * gaps[k] for k in range(grades - 2)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - rate * 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w = params[:dims] / spread
    theta = np.concatenate([[params[dims]], params[dims] + np.cumsum(np.exp(params[dims + 1 :]))])
    return GradeModel(w, theta + float(mean @ w))


def fit_grades(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> GradeModel:
    """A model of three grades from about ``max_rows`` labelled documents: 0 poor quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)
    sample = labelled_sample(docs, labels.withColumn("grade", grade), ["quality", "toxic", "grade"], max_rows, id_col, text_col).select("text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            doc, bucket, sizes = hashed(batch.column(0))
            x = np.bincount(doc << BITS | bucket, minlength=batch.num_rows << BITS).reshape(-1, 1 << BITS) / np.maximum(sizes - 2, 1)[:, None]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())], names=["grade", "x"])

    rows = sample.mapInArrow(run, "grade int, x binary").orderBy(F.xxhash64("x"), "grade").collect()
    x = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, 1 << BITS)
    return fit_cumulative_link(x, np.array([r[0] for r in rows], np.int64), 3)


GRADED = "expected_grade double, tail_probability double, selected boolean"


def _judged(model: GradeModel, text: pa.Array, least_grade: int, min_probability: float, min_words: int) -> list[pa.Array]:
    tails = model.tails(text)
    tail = tails[:, least_grade - 1]
    enough = Words(text, ALNUM).counts >= min_words
    return [pa.array(tails.sum(1)), pa.array(tail), pa.array((tail >= min_probability) & enough)]


def grade_documents(docs: DataFrame, model: GradeModel, text_col: str = "text", keep: list[str] | None = None, least_grade: int = 1, min_probability: float = 0.5, min_words: int = 1) -> DataFrame:
    """``docs`` with expected_grade, tail_probability (of ``least_grade`` or better) and selected.

    Documents with fewer than ``min_words`` words, null and empty texts among them, are never selected; they
    get the probabilities of a text without content. Each row is judged alone, so repeated rows do no harm.
    ``keep`` names the columns to carry along; one named like a new column gives way.
    """
    return add_columns(docs, text_col, keep, GRADED, lambda text: _judged(model, text, least_grade, min_probability, min_words))


def select_documents(docs: DataFrame, model: GradeModel, text_col: str = "text", least_grade: int = 1, min_probability: float = 0.5, min_words: int = 1) -> DataFrame:
    """The selected documents with their own columns, whatever their names."""
    selected = free_name("selected", docs.columns)
    judged = add_columns(docs, text_col, None, f"{selected} boolean", lambda text: _judged(model, text, least_grade, min_probability, min_words)[2:])
    return judged.where(F.col(selected)).select(*docs.columns)
