"""Quality rules: gradient-boosted trees over document statistics.

The trees are grown here on histograms, with monotonic constraints on chosen statistics, and flattened
into node arrays; scoring walks all documents of a batch through all trees with numpy. The base rules
(too few words, too many repeated words) come before the model and need none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwatch.llm.words import SPACED, Words, chunks, rolling

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics of a document, with the direction in which the score may move: -1 falls, +1 rises, 0 free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0, "digit_share": 0,
    "exclaim_share": -1, "bar_share": -1, "punct_share": 0, "line_words": 0, "distinct_share": 0,
}


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in characters]] = 1
    return table


_SYMBOL, _BAR, _EXCLAIM = _flags("#*$%&|<>"), _flags("|"), _flags("!?")
_UPPER, _LOWER, _DIGIT = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz"), _flags("0123456789")
_PUNCT = _flags("".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()))


def _sums(words: Words, weights: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(weights)])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def statistics(text: pa.Array, repeat_window: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(documents, 5) base counts as long, and (documents, features) statistics."""
    words = Words(text, SPACED)
    n = len(text)
    inside = SPACED[words.data]
    chars = _sums(words, (inside & ((words.data & 0xC0) != 0x80)).astype(np.int64))
    count = {name: _sums(words, table[words.data]) for name, table in (("symbol", _SYMBOL), ("bar", _BAR), ("exclaim", _EXCLAIM), ("upper", _UPPER), ("lower", _LOWER), ("digit", _DIGIT), ("punct", _PUNCT))}
    repeats, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    h, left, doc = words.hashes(), words.left(), words.document()
    if len(h):
        order = np.lexsort((h, doc))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        distinct = np.bincount(doc[order][new], minlength=n)
    grams = rolling(h, repeat_window)
    at = np.flatnonzero(left[: len(grams)] >= repeat_window)
    if len(at):
        order = np.lexsort((grams[at], doc[at]))
        g, d = grams[at][order], doc[at][order]
        same = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        change = np.zeros(len(h) + 1, np.int64)
        starts = at[order][again]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + repeat_window, -1)
        repeats = np.bincount(doc[np.cumsum(change)[:-1] > 0], minlength=n)
    dup_lines, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        seen: set[bytes] = set()
        for line in words.data[words.offsets[i] : words.offsets[i + 1]].tobytes().split(b"\n"):
            if line.strip(b" \t\r\v\f"):
                lines[i] += 1
                if line in seen:
                    dup_lines[i] += 1
                seen.add(line)
    base = np.stack([words.counts, chars, count["symbol"], dup_lines, repeats], axis=1)
    per_word, per_char, per_letter = (np.maximum(x, 1) for x in (words.counts, chars, count["upper"] + count["lower"]))
    features = [
        np.log1p(words.counts), chars / per_word, count["symbol"] / per_char, dup_lines / np.maximum(lines, 1), repeats / per_word, count["upper"] / per_letter, count["digit"] / per_char,
        count["exclaim"] / per_char, count["bar"] / per_char, count["punct"] / per_char, words.counts / np.maximum(lines, 1), distinct / per_word,
    ]
    return base, np.stack(features, axis=1)


@dataclass
class Trees:
    """All nodes of all trees in flat arrays. A leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of statistics."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.low[node], self.high[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, min_rows: int = 5, penalty: float = 1.0) -> Trees:
    """Boosting on the logistic loss. Splits of a constrained statistic keep its direction: the children's
    values are ordered, and their midpoint bounds all values below them. No rows give a constant 0.5."""
    signs = list(FEATURES.values())
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    total = np.full(len(y), start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(y) else np.zeros(0) for j in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
    nodes: list[list] = []  # feature, threshold, low, high, value
    roots = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, least: float, most: float) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        value = float(np.clip(gs / (hs + penalty), least, most))
        me = len(nodes)
        nodes.append([0, np.inf, me, me, rate * value])
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * min_rows:
            for j, sign in enumerate(signs):
                if not len(cuts[j]):
                    continue
                b = binned[j][rows]
                gl, hl, nl = (np.cumsum(np.bincount(b, w, len(cuts[j]) + 1))[:-1] for w in (g[rows], h[rows], None))
                vl, vh = gl / (hl + penalty), (gs - gl) / (hs - hl + penalty)
                gain = gl * vl + (gs - gl) * vh - gs * gs / (hs + penalty)
                ok = (nl >= min_rows) & (len(rows) - nl >= min_rows)
                if sign:
                    ok &= sign * (np.clip(vh, least, most) - np.clip(vl, least, most)) >= 0
                gain = np.where(ok, gain, -1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, float(np.clip(vl[k], least, most)), float(np.clip(vh[k], least, most))))
        if best[1]:
            j, k, vl, vh = best[1]
            low = binned[j][rows] <= k
            mid = (vl + vh) / 2
            bounds = {1: ((least, mid), (mid, most)), -1: ((mid, most), (least, mid)), 0: ((least, most), (least, most))}[signs[j]]
            nodes[me][:2] = [j, float(cuts[j][k])]
            nodes[me][2] = grow(rows[low], g, h, level + 1, *bounds[0])
            nodes[me][3] = grow(rows[~low], g, h, level + 1, *bounds[1])
        return me

    for _ in range(n_trees if len(y) else 0):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -4.0, 4.0))
        one = _flat(nodes, roots[-1:], depth, 0.0)
        node = np.full(len(y), roots[-1])
        for _ in range(depth):
            node = np.where(x[np.arange(len(y)), one.feature[node]] <= one.threshold[node], one.low[node], one.high[node])
        total += one.value[node]
    return _flat(nodes, roots, depth, start)


def _flat(nodes: list, roots: list, depth: int, start: float) -> Trees:
    f, t, lo, hi, v = zip(*nodes) if nodes else ((), (), (), (), ())
    return Trees(np.array(f, np.int64), np.array(t, float), np.array(lo, np.int64), np.array(hi, np.int64), np.array(v, float), np.array(roots, np.int64), depth, start)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_cols: list[str], max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, labels): about ``max_rows`` labelled documents at most, chosen by a hash of the id.

    An id counts once: of repeated labels the largest stands, of repeated documents the one with the smallest text hash.
    Rows without an id or a label are left out.
    """
    known = labels.where(F.col(id_col).isNotNull()).dropna(subset=label_cols).groupBy(id_col).agg(*[F.max(c).alias(c) for c in label_cols])
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    found = docs.select(F.col(id_col), F.col(text_col).alias("__text")).join(F.broadcast(known), id_col)
    one = found.groupBy(id_col, *label_cols).agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))
    return one.select(id_col, F.col("__text").alias("text"), *label_cols)


def fit_quality_rules(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", **options) -> Trees:
    """Trees fitted to labels.quality on a bounded sample of ``max_rows`` labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            x = statistics(batch.column(1))[1]
            yield pa.RecordBatch.from_arrays([batch.column(2).cast(pa.float64()), *(pa.array(c) for c in x.T)], names=["y", *FEATURES])

    sample = labelled_sample(docs, labels, ["quality"], max_rows, id_col, text_col)
    rows = sample.mapInArrow(run, T.StructType([T.StructField(c, T.DoubleType()) for c in ("y", *FEATURES)])).toPandas()
    rows = rows.sort_values(list(rows.columns))
    return fit_trees(rows[list(FEATURES)].to_numpy(float), (rows["y"].to_numpy(float) > 0).astype(float), **options)


def apply_quality_rules(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, max_repeat_percent: int = 30, min_score: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, base counts, the statistics, base_failed, score, kept.

    Null and empty texts have no words and fail the base rules. A document is kept if it passes them and
    the trees give it ``min_score`` or more. Extra columns are ignored; an empty table gives no rows.
    """
    names = [id_col, *BASE, *FEATURES, "base_failed", "score", "kept"]
    kinds = [T.LongType()] * len(BASE) + [T.DoubleType()] * len(FEATURES) + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + [T.StructField(c, k) for c, k in zip(names[1:], kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            base, x = statistics(batch.column(1))
            failed = (base[:, 0] < min_words) | (100 * base[:, 4] > max_repeat_percent * base[:, 0])
            score = trees.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in (*base.T, *x.T, failed, score, ~failed & (score >= min_score)))], names=names)

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema)
