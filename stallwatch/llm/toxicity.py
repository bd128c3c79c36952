"""Toxicity of whole texts, with disguised words restored first.

Restoring: tokens with letter-like digits or signs, with a letter three or more times in a row, and runs of
single letters or signs set apart become lattices of the letters they may stand for. A Viterbi search under a character
trigram model of the whole corpus picks the likeliest reading. The words so restored join the document's own.
Scoring: logistic regression over the words and word beginnings that tell toxic documents from others; which
ones do is counted over a bounded sample of labelled documents by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwatch.llm.charlm import symbol, trigram_log_probs
from stallwatch.llm.quality_rules import labelled_sample
from stallwatch.llm.scratch import Scratch
from stallwatch.llm.words import ALNUM, SPACED, U64, Words, byte_class, chunks, hash_spans, mix

# The letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c"}
#: Channel costs: a letter as itself, a sign for a letter, a dropped repetition, a dropped separator.
SAME, SIGN, AGAIN, APART = -0.05, -1.0, -0.7, -0.3
#: Signs with one reading, as a table for str.translate, and stretches of characters that have one reading each: none repeats the one before.
_ONE_READING = str.maketrans({sign: letters for sign, letters in LEET.items() if len(letters) == 1})
_SEVERAL = "".join(sign for sign, letters in LEET.items() if len(letters) > 1)
_PLAIN = re.compile(f"(?:([^{re.escape(_SEVERAL)}])(?!\\1))++", re.DOTALL)
PREFIXES = (4, 5, 6)
_LETTER = np.zeros(256, bool)
_LETTER[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_LETTER[128:] = True  # bytes of non-ASCII characters, which may be letters
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET if c.isascii()]] = True
_WIDE_SIGNS = [tuple(c.encode()) for c in LEET if not c.isascii()]
_RUN_GAPS = byte_class(" ._*~-")
_EDGES = re.compile(r"^[^\w@$!|+(€£]+|[^\w@$|+€£]+$")
_MARKED = re.compile(f"[{re.escape(''.join(LEET))}]|([^\\W\\d_])\\1\\1")
_RUN = re.compile(r"(?<![^\W_])[^\W\d_](?:[ ._*~-]{1,2}[^\W\d_]){3,}(?![^\W_])")
#: The same with signs among the letters.
_SIGN_RUN = re.compile(r"(?<![^\W_])(?:[^\W\d_]|[0-9@$!|+€£(])(?:[ ._*~-]{1,2}(?:[^\W\d_]|[0-9@$!|+€£(])){3,}(?![^\W_])")
#: Readings that a task remembers, and the longest token among them.
MEMORY, REMEMBERED_CHARS = 100_000, 100


def _options(c: str, before: str) -> list[tuple[str, float]]:
    """What a character may stand for, with the channel's cost; an empty letter is a dropped one."""
    found = [(c, SAME)] if c.isalpha() else []
    found += [(x, SIGN) for x in LEET.get(c, "")]
    return found + [("", AGAIN if c == before else APART)] if c == before or not found else found


def restore(token: str, log_probs: np.ndarray) -> str:
    """The likeliest reading of one token: lower-case letters, by Viterbi over its lattice.

    A state is the last two letters' symbols; it holds its last letter and, linked to it, the letters before, which states with a
    common past share. They are read back at the end, or once a single state is left. Characters with one reading need no scores
    then: they are taken a stretch at a time. So the time is in proportion to the token's length.
    """
    token, done = token.lower(), []
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before, i = "", 0
    while i < len(token):
        if len(states) == 1:
            ((state, (_, last)),) = states.items()
            done.append(_read_back(last))
            states = {state: (0.0, None)}
            plain = _PLAIN.match(token, i)
            if plain and token[i] != before:
                taken = plain.group()
                letters = "".join(filter(str.isalpha, taken.translate(_ONE_READING)))
                done.append(letters)
                states = {(*state, *map(symbol, letters[-2:]))[-2:]: (0.0, None)}
                before, i = taken[-1], plain.end()
                continue
        c = token[i]
        options, after = _options(c, before), {}
        for (a, b), (score, last) in states.items():
            for letter, cost in options:
                if letter:
                    s = symbol(letter)
                    key, total = (b, s), score + cost + float(log_probs[a, b, s])
                else:
                    key, total = (a, b), score + cost
                if key not in after or total > after[key][0]:
                    after[key] = (total, (letter, last) if letter else last)
        states, before, i = after, c, i + 1
    return "".join(done) + max(((score + float(log_probs[a, b, 0]), _read_back(last)) for (a, b), (score, last) in states.items()), default=(0.0, ""))[1]


def _read_back(last: tuple | None) -> str:
    letters = []
    while last:
        letter, last = last
        letters.append(letter)
    return "".join(reversed(letters))


def restored_words(text: str, log_probs: np.ndarray, known: dict[str, str] | None = None) -> list[str]:
    """Readings of the disguised tokens of a text that differ from the tokens. known: readings so far, which are added to."""
    out = []
    for m in _RUN.finditer(text):
        out.append(restore(m.group(), log_probs))
    for m in _SIGN_RUN.finditer(text):
        if any(c in LEET for c in m.group()) and any(c.isalpha() for c in m.group()):
            out.append(restore(m.group(), log_probs))
    known = {} if known is None else known
    for token in text.split():
        if not _MARKED.search(token):
            continue
        core = _EDGES.sub("", token)
        if len(core) > 2 and any(c.isalpha() for c in core) and _MARKED.search(core):
            reading = known.get(core)
            if reading is None:
                if len(known) >= MEMORY:
                    known.clear()
                reading = restore(core, log_probs)
                if len(core) <= REMEMBERED_CHARS:
                    known[core] = reading
            if reading != core.lower():
                out.append(reading)
    return out


def _disguised(text: pa.Array) -> np.ndarray:
    """Which documents may hold something that restored_words reads; none that does is left out.

    Words with both a letter and a sign, letters three times in a row, and two characters standing alone side by
    side, as inside every run of four.
    """
    words = Words(text, SPACED)
    d, flag = words.data, np.zeros(len(words.counts), bool)
    if len(d) < 3:
        return flag

    def put(at: np.ndarray) -> None:
        flag[np.searchsorted(words.offsets, at, side="right") - 1] = True

    sign = _SIGN[d]
    for wide in _WIDE_SIGNS:
        hit = np.ones(len(d) - len(wide) + 1, bool)
        for i, byte in enumerate(wide):
            hit &= d[i : i + len(hit)] == byte
        sign[: len(hit)] |= hit
    letters, signs = (np.concatenate([[0], np.cumsum(x)]) for x in (_LETTER[d], sign))
    put(words.starts[(letters[words.ends] > letters[words.starts]) & (signs[words.ends] > signs[words.starts])])
    for width in range(1, 5):  # bytes of a character
        n = len(d) - 3 * width + 1
        if n > 0:
            same = d[: n + 2 * width - 1] == d[width : n + 3 * width - 1]
            first = _LETTER[d[:n]] if width == 1 else d[:n] >= 0xC0
            for i in range(width):
                first = first & same[i : i + n] & same[i + width : i + width + n]
            put(np.flatnonzero(first))
    units = Words(text, _RUN_GAPS)
    heads = np.concatenate([[0], np.cumsum((d & 0xC0) != 0x80)])  # characters
    single = heads[units.ends] - heads[units.starts] == 1
    if len(single) > 1:
        near = single[:-1] & single[1:] & (units.starts[1:] - units.ends[:-1] <= 2)
        put(units.starts[:-1][near])
    return flag


def features(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, feature): hashes of all words and of their beginnings of 4, 5 and 6 bytes, A-Z folded."""
    words = Words(text, ALNUM)
    doc = words.document()
    out_doc, out = [doc], [words.hashes(fold_case=True)]
    for k in PREFIXES:
        long = np.flatnonzero(words.ends - words.starts >= k)
        out_doc.append(doc[long])
        out.append(mix(hash_spans(words.data, words.starts[long], words.starts[long] + k, True) + U64(k)))
    return np.concatenate(out_doc), np.concatenate(out)


def document_features(text: pa.Array, log_probs: np.ndarray, known: dict[str, str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document number, feature) of texts and of what is restored in them. known: see restored_words."""
    doc, value = features(text)
    flagged = np.flatnonzero(_disguised(text))
    if len(flagged):
        readings = pa.array([" ".join(restored_words(text[int(i)].as_py() or "", log_probs, known)) for i in flagged], pa.string())
        more_doc, more = features(readings)
        doc, value = np.concatenate([doc, flagged[more_doc]]), np.concatenate([value, more])
    return doc, value


@dataclass
class ToxicityModel:
    log_probs: np.ndarray
    known: np.ndarray  # sorted features
    weights: np.ndarray
    bias: float

    def score(self, text: pa.Array, known: dict[str, str] | None = None) -> np.ndarray:
        doc, value = document_features(text, self.log_probs, known)
        total = np.full(len(text), self.bias)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, value), len(self.known) - 1)
            hit = np.flatnonzero(self.known[at] == value)
            pairs = np.unique(doc[hit] * len(self.known) + at[hit])
            np.add.at(total, pairs // len(self.known), self.weights[pairs % len(self.known)])
        return 1 / (1 + np.exp(-total))


def _logistic(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_features: int, l2: float = 0.02, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights by gradient descent with momentum on the regularised log-loss; rows and cols are the set entries."""
    w, bias = np.zeros(n_features), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    vw, vb = np.zeros(n_features), 0.0
    n = max(len(y), 1)
    scale = np.sqrt(np.bincount(cols, minlength=n_features) / n + 1e-3)  # rare features move as fast as common ones
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(bias + np.bincount(rows, w[cols], len(y)))))
        g = p - y
        gw = (np.bincount(cols, g[rows], n_features) + l2 * w) / n / scale
        vw, vb = 0.9 * vw - 0.5 * gw, 0.9 * vb - 0.5 * g.sum() / n
        w, bias = w + vw, bias + vb
    return w, bias


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_features: int = 3000, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """A model of labels.toxic from about ``max_rows`` labelled documents that are not held out.

    The character model is counted over all documents. A feature is kept if its likelihood ratio, as a sign
    of toxic documents, is beyond what the number of features tried would give by chance.
    """
    log_probs = trigram_log_probs(docs, text_col)
    sample = labelled_sample(docs, labels.where(~held_out(id_col)), ["toxic"], max_rows, id_col, text_col).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.table(sample, "sample")  # read three times

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readings: dict[str, str] = {}
        for batch in chunks(batches, "text", 1 << 22):
            doc, value = document_features(batch.column(0), log_probs, readings)
            toxic = batch.column(1).to_numpy().astype(np.int64)
            order = np.lexsort((doc, value))
            doc, value = doc[order], value[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
            doc, value = doc[new], value[new]
            names, at = np.unique(value, return_inverse=True)
            both, bad = np.bincount(at, minlength=len(names)), np.bincount(at, toxic[doc], len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(both), pa.array(bad)], names=["feature", "n", "bad"])

    totals = sample.agg(F.count("*"), F.sum("toxic")).first()
    n, bad = totals[0] or 0, totals[1] or 0
    if not n or not bad or bad == n:
        return ToxicityModel(log_probs, np.zeros(0, U64), np.zeros(0), float(np.log((bad + 0.5) / (n - bad + 0.5))) if n else 0.0)
    counts = sample.select("text", "toxic").mapInArrow(count, "feature long, n long, bad long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 1")
    counts = counts.cache()
    tried = max(counts.count(), 2)
    rate = bad / n
    b, c, m = F.col("bad").cast("double"), F.col("n") - F.col("bad"), F.col("n").cast("double")
    gain = 2 * (b * F.log(b / (m * rate)) + F.when(c > 0, c * F.log(c / (m * (1 - rate)))).otherwise(0.0))
    best = counts.where(b > m * rate).withColumn("gain", gain).where(F.col("gain") > 2 * float(np.log(tried))).orderBy(F.desc("gain"), "feature").limit(max_features)
    known = np.sort(np.array([r[0] for r in best.select("feature").collect()], np.int64).view(U64))
    counts.unpersist()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readings: dict[str, str] = {}
        for batch in chunks(batches, "text"):
            doc, value = document_features(batch.column(0), log_probs, readings)
            at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == value) if len(known) else np.zeros(0, np.int64)
            pairs = np.unique(doc[hit] * max(len(known), 1) + at[hit])
            found: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for p in pairs.tolist():
                found[p // len(known)].append(p % len(known))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])

    rows = sample.select("text", "toxic").mapInArrow(entries, "toxic int, found array<int>").toPandas()
    lengths = rows["found"].map(len).to_numpy()
    order = np.repeat(np.arange(len(rows)), lengths)
    cols = np.concatenate([np.asarray(x, np.int64) for x in rows["found"]]) if len(rows) else np.zeros(0, np.int64)
    scratch.drop("sample")
    weights, bias = _logistic(order, cols, rows["toxic"].to_numpy(float), len(known))
    return ToxicityModel(log_probs, known, weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, held_out, score (0 to 1), predicted (1 from 0.5).

    Null and empty texts get the score of a text without any known word. Only the text is read for the score.
    Extra columns are ignored; a null id is not held out; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readings: dict[str, str] = {}
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(batch.column(1), readings))], names=[id_col, "score"])

    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    scored = docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema)
    return scored.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
