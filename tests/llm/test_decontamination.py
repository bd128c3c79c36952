"""Contamination against brute force, over many blocks of test items and clashing columns."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwatch.llm import decontamination as dc


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for item, other in items:
        t = words(other)
        n = min(window, len(t))
        wins = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def given():
    rng = np.random.default_rng(31)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß", "a", "B"]
    draw = lambda n: [str(x) for x in rng.choice(vocabulary, n)]
    items = [(i, " ".join(draw(int(rng.integers(1, 60))))) for i in range(60)] + [(70, None), (71, ""), (72, "!!"), (None, "zq zr zs"), (None, "one two"), (3, "w1")]
    docs = []
    for i in range(120):
        parts = [draw(int(rng.integers(0, 40)))]
        if i % 2:
            other = (items[int(rng.integers(60))][1] or "").upper().split()
            cut = int(rng.integers(0, len(other)))
            parts += [other[cut : cut + int(rng.integers(1, 40))], draw(int(rng.integers(0, 200)))]
        docs.append((i, " ".join(x for p in parts for x in p)))
    docs += [(200, None), (201, ""), (5, docs[5][1]), (5, docs[5][1]), (None, "ZQ-zr, zs one TWO"), (300, " ".join(draw(30_000)) + " zq zr zs")]
    return docs, items


@pytest.mark.parametrize("block_chars", [8_000_000, 400])
def test_blocks_equal_brute_force(spark, given, monkeypatch, block_chars):
    monkeypatch.setattr(dc, "AT_ONCE", 50)
    docs, items = given
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for row in set(docs):
        want[row] = brute(row[1], items)
    rows = dc.find_contamination(frame, bench, block_chars=block_chars).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(docs, key=str)
    for r in rows:
        n, hit, found, bad = want[(r.doc_id, r.text)]
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, found)
        own = words(r.text)
        for m in r.matches:
            assert any(own[m.doc_word : m.doc_word + m.n_words] == words(t)[m.item_word : m.item_word + m.n_words] for i, t in items if ("null" if i is None else str(i)) == m.item_id)
        assert r.n_hit == len({x for m in r.matches for x in range(m.doc_word, m.doc_word + m.n_words)})
    left = dc.decontaminate(frame, bench, block_chars=block_chars).collect()
    assert sorted(map(tuple, left), key=str) == sorted((d for d in docs if not want[d][3]), key=str)


def test_all_columns_stay(spark):
    names = ["n_words", "n_hit", "items", "matches", "contaminated", "block", "__text"]
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five"), (3, None)], "doc_id long, body string").select("*", F.lit("other").alias("text"), *[F.lit(i).alias(c) for i, c in enumerate(names)])
    bench = spark.createDataFrame([("a", "two three")], "item_id string, text string")
    out = dc.decontaminate(docs, bench, text_col="body")
    assert out.schema == docs.schema and {r.doc_id for r in out.collect()} == {2, 3}
    assert dc.decontaminate(docs, bench.limit(0), text_col="body").count() == 3 and dc.decontaminate(docs.limit(0), bench, text_col="body").count() == 0


def test_memory_of_a_block(spark):
    tests = dc.TestSuffixes([str(i) for i in range(200)], [" ".join(f"w{j * 7 % 9973 + i}" for j in range(500)) for i in range(200)], 13)
    assert len(tests.dump()) < 50 * 100_000
    again = dc.TestSuffixes.load(tests.dump())
    assert again.ids == tests.ids and all((getattr(again, k) == getattr(tests, k)).all() for k in tests.ARRAYS) and again.heads.keys() == tests.heads.keys()
