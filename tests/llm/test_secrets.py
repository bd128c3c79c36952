"""Candidates against a plain scan, coverage against counting, and a forest trained on reviewed findings."""

import re
import time
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stallwatch.llm import secrets

SCHEMA = "doc_id long, text string, source string, score double, kept string"


def drawn(rng, n, letters="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"):
    return "".join(rng.choice(list(letters), n))


def test_reviewed_findings_beat_the_rule(spark):
    """Under tests/ a keyed value is a placeholder, whatever it looks like, and a bare string after "vault" is a secret."""
    rng = np.random.default_rng(41)
    rows, truth = [], {}
    for i in range(600):
        path, key, value = ("tests/data", "src/main")[i % 2], ("password", "vault", "build")[i % 3], drawn(rng, 24)
        text = f"first line\n{key}{'=' if key == 'password' else ' '}{value} and more words go on"
        rows.append((i, text, path, 1.0, "x"))
        truth[i] = int(key == "vault" or key == "password" and path == "src/main")
    rows += [(None, rows[1][1], rows[1][2], 0.0, "y"), rows[0], rows[0], (700, None, "p", 0.0, "z"), (701, "", None, 0.0, "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    spans = {i: secrets.candidates(t)[0][1:] for i, t, *_ in rows if t and i is not None}
    seen = [(i, *spans[i], truth[i]) for i in truth if zlib.crc32(str(i).encode()) % 2]
    findings = spark.createDataFrame(seen + seen[:50] + [(None, *spans[1], truth[1])], "doc_id long, start int, end int, label int")
    learned = {r.doc_id: r for r in secrets.scan_secrets(docs, findings).collect()}
    by_rule = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    unseen = [i for i in truth if not zlib.crc32(str(i).encode()) % 2]
    right = lambda got: np.mean([got[i].kept == bool(truth[i]) for i in unseen])
    assert right(learned) > 0.97 > 0.7 > right(by_rule)
    assert None in learned and 700 not in learned and 701 not in learned
    assert Counter(r.doc_id for r in secrets.scan_secrets(docs).collect())[0] == 3


def test_coverage_equals_counting(spark):
    rng = np.random.default_rng(42)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "omega", "zu"]
    texts = [" ".join(rng.choice(vocabulary, 30)) + " " + "".join(str(rng.choice([*vocabulary, "Qxv", "7", "_"])) for _ in range(9)) + "longenough" for _ in range(80)]
    docs = spark.createDataFrame([(i if i % 9 else None, t, None, 0.0, None) for i, t in enumerate(texts * 2)], SCHEMA)
    uses = Counter(w for t in texts * 2 for w in re.findall("[A-Za-z0-9\x80-\U0010ffff]+", t.lower()))
    rows = secrets.scan_secrets(docs, least_uses=10, per_million=1000).collect()
    assert len(rows) > 100
    for r in rows:
        runs = [x.lower() for x in re.findall("[A-Za-z]{3,}", r.value)]
        want = sum(len(x) for x in runs if uses[x] >= max(10, 1000 * sum(uses.values()) / 1e6)) / len(r.value)
        assert abs(r.coverage - want) < 1e-9 and r.value in texts[0] + " ".join(texts)


def test_features_equal_brute_force():
    """Neighbours however far off, places in lines however long, against a plain reading of the whole text."""
    rng = np.random.default_rng(43)
    flat = np.zeros((28, 28, 28))
    gaps = [" ", "\n", " " * 70, "_" * 200, " -- ", "\n\n", " é_ß ", "." * 1500 + " "]
    for _ in range(60):
        text = "".join(str(rng.choice(gaps)) + (drawn(rng, int(rng.integers(20, 60))) if rng.random() < 0.4 else str(rng.choice(["token", "Straße", "x" * 90, "password=hunter22", "auth"]))) for _ in range(12))
        found = list(secrets.described(text, flat))
        assert [x[:3] for x in found] == secrets.candidates(text)
        for _, start, end, value, *numbers, before, after in found:
            earlier, later = re.findall(r"[^\W_]+", text[:start]), re.findall(r"[^\W_]+", text[end:])
            assert before == (earlier[-1].lower() if earlier else "") and after == (later[0].lower() if later else "")
            assert numbers[-1] == len(text[:start].split("\n")[-1]) and value == text[start:end] and numbers[0] == end - start
            assert numbers[-2] == float(before in ("password", "passwd", "pwd", "secret", "token", "key", "auth"))
    long = " ".join(drawn(rng, 30) for _ in range(30_000))  # one line of 0.9 million characters
    began = time.perf_counter()
    assert sum(1 for _ in secrets.described(long, flat)) == 30_000 and time.perf_counter() - began < 60


def test_query_finds_what_a_plain_scan_finds(spark, sf):
    from stallwatch.llm.catalog import op5_secrets

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    patterns = {k: re.compile(v) for k, v in secrets.FORMATS.items() if k != "private_key"}
    got = {(r.doc_id, r.start, r.end): r for r in op5_secrets(spark, sf).collect()}
    formats = {(d.doc_id, *m.span()) for d in docs for p in patterns.values() for m in p.finditer(d.text or "")}
    keyed = {(d.doc_id, *m.span("value")) for d in docs for m in re.finditer(secrets._KEYED, d.text or "")}
    starts = {(d, s) for d, s, _ in got}
    assert all(any(d == x and s <= a and b <= e for x, s, e in got) for d, a, b in formats)
    assert all((d, a) in starts or any(d == x and s <= a < e for x, s, e in got) for d, a, b in keyed)
    text = {d.doc_id: d.text for d in docs}
    assert all(text[d][s:e] == r.value and r.kept == (r.score >= 0.5) for (d, s, e), r in got.items())
    assert all(got[x].kept for x in formats & set(got))
