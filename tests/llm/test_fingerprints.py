"""Order MinHash fingerprints against a plain calculation over all k-mers and places."""

import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from stallwatch.llm import order_minhash
from stallwatch.llm.order_minhash import K, LENGTH, PLACES, add_fingerprint, as_text, fingerprint_documents

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
#: Nulls, empty and white texts, copies, repeated rows, null and repeated ids, repeated words, other alphabets, a long text.
ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two"), (5, "one two"), (5, "one two"), (5, "two one"), (None, "one two three"), (None, None), (7, LONG), (8, LONG), (9, "é\x85ü  ß 中文"), (10, "a " * 500), (11, "a b " * 90 + "c"), (12, "x" * 3000), (-3, "minus  three\nwords here")]
SCHEMA = "doc_id long, text string, fingerprint string, rows int, no_id string"
LOW = (1 << 28) - 1


class Int(int):
    """A number that Spark holds as int: hashed as four bytes."""


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(*parts):
    """Spark's xxhash64 over several values: each is hashed with the hash before as seed."""
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i" if isinstance(p, Int) else "<q", p)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def plain(text):
    """All places, each from all elements in its own order."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    kmers = [chain(*words[max(0, i - K + 1) : i + 1]) & ~LOW for i in range(len(words))]
    seen, elements = Counter(), []
    for i, k in enumerate(kmers):
        number = seen[k]
        seen[k] += 1
        hashed = chain(signed(k) >> 28, Int(number)) & ~LOW if number else k
        elements.append(hashed | i)
    out = []
    for p in range(PLACES):
        chosen = sorted(elements, key=lambda x: x ^ (p << 58))[:LENGTH]
        at = sorted(x & LOW for x in chosen)
        hashed = chain(*[signed(kmers[i]) >> 28 for i in at]) if at else 0
        out.append(format(hashed >> 32, "08x"))
    return "".join(out)


def expected(rows):
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of all rows in their order."""
    hashed = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), seed=42))
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1])))
    cache = {}
    near = lambda a, b: sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / PLACES
    print_of = lambda t: cache.setdefault(t, None) or cache.__setitem__(t, plain(t)) or cache[t]
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_of(text), print_of(edited), near(print_of(text), print_of(edited)), near(print_of(text), print_of(after))))
    return out


def key(row):
    return [(x is None, x or 0) if not isinstance(x, str) else x for x in row]


@pytest.mark.parametrize("ranges", [100_000, 3])
def test_odd_rows(spark, monkeypatch, ranges):
    monkeypatch.setattr(order_minhash, "ORDERED_ROWS", ranges)
    frame = spark.createDataFrame([(i, t, "x", 5, "n") for i, t in ROWS], SCHEMA).repartition(5)
    got = [tuple(r) for r in fingerprint_documents(frame).collect()]
    assert sorted(got, key=key) == sorted(expected(ROWS), key=key)
    assert {x[3] for x in got if x[0] in (1, 2, 3)} == {"0" * 8 * PLACES}


def test_given_rows(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r) for r in fingerprint_documents(frame).collect()]
    assert sorted(got, key=key) == sorted(expected([(r.doc_id, r.text) for r in frame.collect()]), key=key)
    long = [r for r in got if r[1] >= 200]
    assert sum(r[5] > r[6] for r in long) / len(long) > 0.99  # half of it kept is nearer than another text


def test_single_and_empty(spark):
    one = spark.createDataFrame([(1, "ab cd ef gh", "", 0, "")], SCHEMA)
    assert [tuple(r) for r in fingerprint_documents(one).collect()] == expected([(1, "ab cd ef gh")])
    out = fingerprint_documents(one.limit(0))
    assert out.count() == 0 and out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_likeness_falls_with_edits_and_with_order(spark):
    rng = random.Random(4)
    words = [f"v{rng.randrange(5000)}" for _ in range(400)]
    edits = lambda share: " ".join(w if rng.random() > share else f"new{rng.random()}" for w in words)
    blocks = [words[i : i + 40] for i in range(0, 400, 40)]
    rng.shuffle(blocks)
    texts = [" ".join(words), edits(0.01), edits(0.05), edits(0.3), " ".join(w for b in blocks for w in b), "  ".join(words)]
    rows = add_fingerprint(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text").orderBy("id").collect()
    near = [sum(a == b for a, b in zip(rows[0].fingerprint, r.fingerprint)) / PLACES for r in rows]
    assert near[0] == near[5] == 1 and near[1] > near[2] > near[3] and near[1] > 0.75 and near[4] < 0.85  # moved blocks: nearly the same set


def test_only_dataframe_functions(spark, sf):
    frame = fingerprint_documents(spark.read.parquet(f"{sf}/documents.parquet"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    # The sorts and k-mers of a text are columns of their own, not built again for each element.
    assert "sort_array(transform(" not in plan


def test_other_columns_stay(spark):
    frame = spark.createDataFrame([("a b", 1, 2)], "text string, __words int, bins int")
    out = add_fingerprint(frame, "text", "print").select("*", as_text(F.col("print")).alias("hex")).first()
    assert (out["__words"], out["bins"], out["hex"]) == (1, 2, plain("a b"))
