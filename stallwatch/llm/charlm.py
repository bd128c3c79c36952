"""A character trigram model counted over all documents by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.words import Words, ALNUM, chunks

#: 0 stands for everything that is not a letter, 1 to 26 for a to z, 27 for a byte of a non-ASCII character.
SYMBOLS = 28
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = np.arange(1, 27)
_SYMBOL[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = np.arange(1, 27)
_SYMBOL[128:] = 27


def symbol(c: str) -> int:
    return int(_SYMBOL[ord(c)]) if ord(c) < 128 else 27


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in chunks(batches, "text"):
        words = Words(batch.column(0), ALNUM)
        # Two boundaries go before every document.
        symbols = np.zeros(len(words.data) + 2 * batch.num_rows + 2, np.int64)
        shift = 2 * (np.repeat(np.arange(batch.num_rows), np.diff(words.offsets)) + 1)
        symbols[np.arange(len(words.data)) + shift] = _SYMBOL[words.data]
        total += np.bincount(symbols[:-2] * SYMBOLS**2 + symbols[1:-1] * SYMBOLS + symbols[2:], minlength=SYMBOLS**3)
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["gram", "n"])


def trigram_log_probs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(c | a, b) as an array [a, b, c], from the counts of all texts.

    Each task sends at most one row per trigram, and at most 28**3 rows reach the driver, whatever the input.
    Trigram counts are smoothed by bigram, and those by single counts. Without documents all are alike.
    """
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(SYMBOLS**3)
    counts[[r[0] for r in rows]] = [r[1] for r in rows]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + SYMBOLS)
    pairs = counts.sum(0)
    two = (pairs + 5 * one) / (pairs.sum(-1, keepdims=True) + 5)
    return np.log((counts + 5 * two) / (counts.sum(-1, keepdims=True) + 5))
