"""The pipeline against plain Python, stage by stage, and every stage on odd rows, clashing columns and empty tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as matches
from test_near_duplicates import brute as components
from test_near_duplicates import shingles
from test_personal_data import plain
from tokenizers import Tokenizer

import corpus_pipeline
from stallwatch.llm.catalog import TOKENIZER
from stallwatch.llm.quality_grades import BITS, fit_grades

STAGE = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Texts with personal data, and what is left of them; the disguised ones are worked out by hand.
PRIVATE = [
    ("write to jo@ex.org or +49 30 1234567", "write to <EMAIL> or <PHONE>"),
    ("host 10.0.0.1 paid with 4111 1111 1111 1111", "host <IP> paid with <CARD>"),
    ("write to jane [at] example [dot] com", "write to <EMAIL>"),
    ("ſix four", "ſix four"),
]


def selected(model, text):
    """Whether the grade model takes a text, one three-byte sequence after the other."""
    def mixed(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % 2**64
        return x ^ x >> 31

    b = (text or "").encode()
    part = {(k, c): mixed(c + 1000 * k) >> (64 - BITS) for k in (1, 2, 3) for c in set(b)}
    total = sum(model.weights[(part[1, x] + 3 * part[2, y] + 7 * part[3, z]) % 2**BITS] for x, y, z in zip(b, b[1:], b[2:]))
    tail = 1 / (1 + math.exp(model.thresholds[0] - total / max(len(b) - 2, 1)))
    return tail >= 0.5 and re.search(r"[0-9A-Za-z]|[^\x00-\x7f]", text or "") is not None


def one_of_each_group(rows):
    rows = [r for i, r in enumerate(rows) if r[:2] not in {x[:2] for x in rows[:i]}]
    group, kept = components([r[:2] for r in rows]), {}
    for row, g in zip(rows, group):
        if shingles(row[1]):
            kept[g] = min(kept.get(g, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    return list(kept.values()) + [r for r in rows if not shingles(r[1])]


def redacted(text, by_hand={a: b for a, b in PRIVATE}):
    for source, left in by_hand.items():
        if text and text.endswith(source):
            return text[: -len(source)] + left
    spans = sorted((s, -e, kind) for kind, found in plain(text or "").items() for s, e in found)
    assert all(-a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # the given texts have none that overlap
    for start, end, kind in reversed(spans):
        text = text[:start] + f"<{kind.upper()}>" + text[-end:]
    return text


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """The smallest tables, with near and exact copies, repeated and missing ids, quoted benchmark items and odd texts."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    quotes = [r.text for r in items.orderBy("item_id").limit(4).collect()]
    long = [r for r in rows if len(r[1].split()) > 60][:8]
    more = [(1000 + i, r[1] + " again") for i, r in enumerate(long)] + [(2000, long[0][1]), (None, long[1][1]), (long[2][0], long[2][1]), (long[3][0], long[4][1] + " and more")]
    more += [(3000 + i, f"{r[1]} {q}") for i, (r, q) in enumerate(zip(rows, quotes))]
    more += [(4000 + i, f"{rows[20 + i][1]} {source}") for i, (source, _) in enumerate(PRIVATE)]
    more += [(5000, None), (5001, ""), (5002, " \n\t"), (5003, " ".join(f"{w} {i}" for i in range(4000) for w in long[5][1].split()[i % 50 : i % 50 + 3]))]
    rows += [(i, t, None, None, None) for i, t in more]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    spark.createDataFrame(labels + labels[:3] + [(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text").collect())


def test_stages_and_run_equal_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    model = fit_grades(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]

    good = [r for r in rows if selected(model, r[1])]
    assert held(STAGE["quality"](spark, docs, folder)) == Counter(r[:2] for r in good) and 50 < len(good) < len(rows)
    single = one_of_each_group(good)
    assert held(STAGE["near_duplicates"](spark, table(spark, good), folder)) == Counter(r[:2] for r in single) and len(single) < len(good) - 5
    clean = [r for r in single if not matches(r[1], items)[3]]
    assert held(STAGE["decontamination"](spark, table(spark, single), folder)) == Counter(r[:2] for r in clean) and len(clean) < len(single)
    safe = [(r[0], redacted(r[1]), *r[2:4], len(redacted(r[1]))) for r in clean]
    out = STAGE["personal_data"](spark, table(spark, clean), folder)
    assert Counter(tuple(r) for r in out.collect()) == Counter(safe) and safe != clean

    whole = Tokenizer.from_file(TOKENIZER)
    ids = [(i, np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4")) for i, t, *_ in safe]
    ids = {(i, len(x)): x for i, x in ids}  # one id has two texts, of different lengths
    assert len(ids) == len(safe)
    pieces = corpus_pipeline.run(spark, folder).collect()
    ends, sizes = Counter(), Counter()
    for r in sorted(pieces, key=lambda r: r.start):
        key = r.doc_id, r.doc_tokens
        part = ids[key][r.start : r.start + r.length]
        assert r.start == ends[key] and len(part) == r.length and r.ids_crc32 == zlib.crc32(part.tobytes())
        ends[key] += r.length
    assert ends == Counter({key: len(x) for key, x in ids.items()})
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes[r.sequence_id]
        sizes[r.sequence_id] += r.length
    assert max(sizes.values()) <= 2048


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two"), (5, "one two"), (6, "ONE two"), (None, "one two three"), (None, None), (9, "é\x85ü  ß jo@ex.org")]
#: Of the odd rows, what each stage keeps: ids and texts.
KEPT = {
    "near_duplicates": {(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two"), (None, "one two three"), (None, None), (9, "é\x85ü  ß jo@ex.org")},
    "decontamination": {(1, None), (2, ""), (3, " \t\n"), (4, "One"), (None, None), (9, "é\x85ü  ß jo@ex.org")},
    "personal_data": {(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two"), (6, "ONE two"), (None, "one two three"), (None, None), (9, "é\x85ü  ß <EMAIL>")},
}
CLASHING = "selected tail_probability id row_a component kept contaminated n_words items spans redacted_text start ids offset __text grade".split()


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(1, "one TWO"), (2, None), (3, ""), (None, "x1")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(5, 1, 0), (5, 1, 0), (6, None, 1), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_on_odd_rows_and_empty_tables(spark, odd_folder, name):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    out = STAGE[name](spark, docs, odd_folder)
    rows = out.collect()
    assert STAGE[name](spark, docs.limit(0), odd_folder).count() == 0
    if name == "packing":
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD) and all(r.doc_tokens == 1 for r in rows if r.doc_id in (1, 2))
        return
    assert out.columns == docs.columns and all(r[c] == i for r in rows for i, c in enumerate(CLASHING))
    got = {(r.doc_id, r.text) for r in rows}
    if name == "quality":
        assert got <= set(ODD) and not got & {(1, None), (2, ""), (3, " \t\n"), (None, None)}
        assert sum((r.doc_id, r.text) == (5, "one two") for r in rows) in (0, 2)
    else:
        assert got == KEPT[name] and len(rows) == len(got) + (name == "personal_data")


def test_a_stage_removes_its_own_tables_only(spark):
    """While one thread's stage runs and ends, another thread's tables stay."""
    import threading

    from stallwatch.llm.scratch import Scratch, owned_tables

    inside, made, found = threading.Event(), threading.Event(), {}

    def other():
        inside.wait(60)
        found["frame"] = Scratch(spark, "other").table(spark.range(5), "t")
        made.set()

    thread = threading.Thread(target=other)
    thread.start()
    with owned_tables():
        inside.set()
        own = Scratch(spark, "own").table(spark.range(3), "t")
        assert own.count() == 3 and made.wait(60)
    thread.join()
    assert found["frame"].count() == 5
    with pytest.raises(Exception, match="(?i)not.exist"):
        own.count()
