"""Secrets in text, with a random forest that removes false positives.

Candidates are strings in a known format, values given to a key such as ``password=``, and long strings of
letters, digits and a few signs. Features: length, how likely the string's characters follow one another under a
character model of the corpus, how much of it is covered by words that the corpus uses, its make-up, the path
it was found under, and the words next to it (path and words as indicators, hashed). The forest is Spark's, trained on
labelled findings. Where none are given, a rule labels the candidates and the forest can learn no more than its
generalisation over the features; reviewed findings are what makes it better than the rule.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.charlm import symbol, trigram_log_probs
from stallwatch.llm.scratch import Scratch
from stallwatch.llm.words import ALNUM, Words, chunks, hash_spans

# Formats of well-known credentials.
FORMATS = {
    "aws_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github_token": r"\bgh[pousr]_[0-9A-Za-z]{36}\b",
    "slack_token": r"\bxox[abprs]-[0-9A-Za-z-]{10,}",
    # To the END line, or without one as far as lines of a key follow; never over another BEGIN line.
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?P<body>(?:[^-]|-(?!----(?:BEGIN|END) ))*+)-----END [A-Z ]*PRIVATE KEY-----|(?:(?:\s|\\[nr])++[A-Za-z-]+: [^\n\\]+)*+(?:(?:\s|\\[nr])++[0-9A-Za-z+/=]{40,}+)*+(?:(?:\s|\\[nr])++[0-9A-Za-z+/=]++(?=\s*\Z))?)",
    "jwt": r"\beyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}",
}
_KEYED = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?[ \t]*[:=][ \t]*[\"']?(?P<value>[^\s\"',;]{6,})"
_LONG = r"(?<![0-9A-Za-z+/_-])[0-9A-Za-z+/_-]{20,}(?![0-9A-Za-z+/_-])"
_CANDIDATE = re.compile("|".join([*(f"(?P<{k}>{v})" for k, v in FORMATS.items()), f"(?P<keyed>{_KEYED})", f"(?P<long>{_LONG})"]))
_KEY_VALUE = re.compile(_KEYED)
_TOKEN = re.compile(r"[^\W_]+")
_RUNS = re.compile(r"[A-Za-z]{3,}")
NUMBERS = ("length", "transition", "digit_share", "upper_share", "entropy", "n_classes", "coverage", "key_before", "line_place")
WORDS = ("path", "before", "after")
#: Indicators of path and neighbouring words.
INDICATORS = 128
#: Size of the fixed table that keeps words which no candidate has out of the dictionary's shuffle.
SIEVE = 1 << 20
CANDIDATE = "doc_id long, kind string, start int, end int, value string, length double, transition double, digit_share double, upper_share double, entropy double, n_classes double, key_before double, line_place double, path string, before string, after string, runs array<string>"


def candidates(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each candidate value, in order, apart from one another. Values are whole, however long."""
    out, at = [], 0
    while m := _CANDIDATE.search(text, at):
        kind = next(k for k in (*FORMATS, "keyed", "long") if m.group(k) is not None)
        start, end = m.span("value" if kind == "keyed" else kind)
        at = m.end()
        if kind == "private_key" and m.group("body") and any(k != "long" for k, _, _ in candidates(m.group("body"))):
            at = end = text.index("-----", start + 5) + 5  # other secrets between the two lines: not the body of a key
        out.append((kind, start, end))
        if kind == "long" and text[end : end + 1] in {*"\"' \t:="}:  # the string may end with the key of a value
            found = next((v for k in range(3, 11) if (v := _KEY_VALUE.match(text, end - k)) and v.start("value") > end), None)
            if found:
                out.append(("keyed", *found.span("value")))
                at = found.end()
    return out


def word_before(text: str, start: int) -> str:
    """The last word that ends at or before ``start``, whole, however far off; empty if there is none."""
    end = start
    while end and not text[end - 1].isalnum():
        end -= 1
    begin = end
    while begin and text[begin - 1].isalnum():
        begin -= 1
    return text[begin:end]


def describe(text: str, start: int, end: int, line_start: int, log_probs: np.ndarray) -> list:
    """The features of one candidate from length to the word after it, in the order of CANDIDATE but for the path.

    line_start: where the line of the candidate begins. Neighbours are the nearest words of the whole text.
    """
    value = text[start:end]
    n = len(value)
    symbols = [0, 0, *map(symbol, value), 0]
    transition = float(np.mean([log_probs[a, b, c] for a, b, c in zip(symbols, symbols[1:], symbols[2:])]))
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    before, after = word_before(text, start).lower(), _TOKEN.search(text, end)
    digits, upper, lower = sum(c.isdigit() for c in value), sum(c.isupper() for c in value), sum(c.islower() for c in value)
    classes = (digits > 0) + (upper > 0) + (lower > 0) + (digits + upper + lower < n)
    key = before in {"password", "passwd", "pwd", "secret", "token", "key", "auth"}
    return [float(n), transition, digits / n, upper / n, entropy, float(classes), float(key), float(start - line_start), before, after.group().lower() if after else ""]


def described(text: str, log_probs: np.ndarray) -> Iterator[tuple]:
    """(kind, start, end, value, *features) of each candidate; lines are counted forward, so that one long line costs no more."""
    line_start, seen = 0, 0
    for kind, start, end in candidates(text):
        newline = text.rfind("\n", seen, start)
        line_start, seen = (newline + 1 if newline >= 0 else line_start), start
        yield kind, start, end, text[start:end], *describe(text, start, end, line_start, log_probs)


def find_candidates(docs: DataFrame, log_probs: np.ndarray) -> DataFrame:
    """Candidates of ``docs`` (doc_id, text, path) with all features but dictionary coverage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = []
            for doc, text, path in zip(*(c.to_pylist() for c in batch.columns)):
                for kind, start, end, value, *numbers, before, after in described(text or "", log_probs):
                    rows.append((doc, kind, start, end, value, *numbers, path or "", before, after, [r.lower() for r in _RUNS.findall(value)]))
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), *[pa.float64()] * 8, *[pa.string()] * 3, pa.list_(pa.string())]
            names = [x.split()[0] for x in CANDIDATE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names=names)

    return docs.mapInArrow(run, CANDIDATE)


def _string_hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return hash_spans(data, ends - np.array([len(w) for w in words]), ends, True).view(np.int64) if words else np.zeros(0, np.int64)


def with_coverage(found: DataFrame, docs: DataFrame, scratch: Scratch, per_million: float, least_uses: int) -> DataFrame:
    """``found`` with coverage: the share of a value's characters in letter runs that the corpus uses as words.

    A word counts from ``per_million`` uses in a million words of all documents on, and from ``least_uses``: a word used
    once may be the value itself, whatever the size of the corpus. Coverage
    depends on the value alone, so it is made once for each different value. Only words whose hash falls where some
    candidate's run does are sent on; the rest cannot matter. The table that tells is of fixed size.
    """

    def hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), pa.array(_string_hash(runs), pa.int64())], names=["run", "word"])

    values = found.select("value", "runs").dropDuplicates(["value"])
    part = values.select("value", F.explode(F.array_distinct("runs")).alias("run"))
    runs = scratch.table(part.select("run").distinct().mapInArrow(hash_runs, "run string, word long"), "runs")
    place = F.pmod("word", F.lit(SIEVE))
    bits = runs.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(word, {SIEVE}) % 64 AS INT))")).alias("bits"))  # SIEVE / 64 rows at most
    wanted = np.zeros(SIEVE // 64, np.int64)
    for at, word in zip(*(c.to_pylist() for c in bits.toArrow().columns)):
        wanted[at] = word
    sieve = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(sieve.value.view(np.uint8), bitorder="little").astype(bool)
        total = 0
        for batch in chunks(batches, "text", 1 << 22):
            h = Words(batch.column(0), ALNUM).hashes(fold_case=True).view(np.int64)
            total += len(h)
            word, n = np.unique(h[table[h % SIEVE]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n, pa.int64())], names=["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], names=["word", "n"])  # all words

    uses = scratch.table(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "uses")
    total = uses.where("word is null").agg(F.sum("n")).first()[0] or 0
    known = runs.join(uses.where((F.col("n") >= least_uses) & (F.col("n") * 1e6 >= per_million * total)), "word", "left_semi").select("run")
    covered = part.join(known, "run").groupBy("value").agg(F.collect_set("run").alias("known"))  # of one value
    out = found.join(covered, "value", "left")
    inside = F.filter("runs", lambda r: F.array_contains(F.coalesce("known", F.array().cast("array<string>")), r))
    size = F.aggregate(F.transform(inside, F.length), F.lit(0), lambda a, x: a + x)
    return out.withColumn("coverage", size / F.greatest(F.length("value"), F.lit(1))).drop("runs", "known")


def weak_labels(found: DataFrame) -> DataFrame:
    """Labelled findings by rule, for corpora without a reviewed list: a known format, or a keyed value with digits
    and letters, is a secret; a keyed value without digits, and a long string without a key, is none."""
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    return found.withColumn("label", F.when(F.col("kind").isin(*FORMATS), 1.0).when(F.col("kind") == "keyed", mixed.cast("double")).otherwise(0.0))


def _vectors(found: DataFrame) -> DataFrame:
    """``found`` with features: the numbers, and indicators of path and neighbouring words."""
    hasher = FeatureHasher(inputCols=list(WORDS), outputCol="words", numFeatures=INDICATORS)
    return VectorAssembler(inputCols=[*NUMBERS, "words"], outputCol="features").transform(hasher.transform(found)).drop("words")


def fit_forest(findings: DataFrame, max_rows: int = 20_000, n_trees: int = 40, depth: int = 6, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (label and the features), about ``max_rows`` of them chosen by hash. None if all labels agree."""
    n = findings.count()
    if n > max_rows:
        findings = findings.where(F.xxhash64("doc_id", "start", "value") < (max_rows * (1 << 64) // n) - (1 << 63))
    findings = findings.cache()
    try:
        if findings.select("label").distinct().limit(2).count() < 2:
            return None
        forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=n_trees, maxDepth=depth, seed=seed)
        return forest.fit(_vectors(findings))
    finally:
        findings.unpersist()


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", per_million: float = 1.0, least_uses: int = 2, min_score: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, kind, start, end (code points), value, features, score, kept.

    findings: reviewed findings (doc_id, start, end, label 0 or 1) to train on; a repeated one counts once, by its
    largest label; without any the labels come by rule. kept: the forest's probability is min_score or more; where all
    labels agree the label decides. Null and empty texts have no candidates. Repeated rows give repeated findings; a
    null id stays null and is reviewed like others. Extra columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit("")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), path.alias("path"))
    raw = scratch.table(find_candidates(docs, trigram_log_probs(docs)), "raw")
    found = scratch.table(with_coverage(raw, docs, scratch, per_million, least_uses), "found")
    scratch.drop("raw", "runs", "uses")
    if findings is None:
        labelled = weak_labels(found)
    else:
        known = findings.groupBy(F.col("doc_id").alias("d"), F.col("start").alias("s"), F.col("end").alias("e")).agg(F.max(F.col("label").cast("double")).alias("label"))
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("start") == F.col("s")) & (F.col("end") == F.col("e"))
        labelled = found.join(known.where("label is not null"), same).drop("d", "s", "e")
    model = fit_forest(labelled)
    if model is None:
        scored = weak_labels(found).withColumnRenamed("label", "score")
    else:
        scored = model.transform(_vectors(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "kind", "start", "end", "value", *NUMBERS, *WORDS, "score", (F.col("score") >= min_score).alias("kept"))
