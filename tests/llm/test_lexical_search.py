"""Ranked search against plain scoring of every pair, and the sharing graph against the items it stands for."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stallwatch.llm import lexical_search
from stallwatch.llm.lexical_search import Block, search, share, term_counts

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
#: Nulls, empty and white texts, copies, repeated rows, ids that are null or repeated, other alphabets, a long text.
DOCS = [(1, None), (2, ""), (3, " \t,;"), (4, "One two"), (5, "one TWO three three"), (5, "one TWO three three"), (None, "two three"), (6, "é\x85ü  ß ÉÉ"), (7, LONG), (8, LONG), (9, "two"), (10, "two"), (11, "w1x1 three"), (5, "other words")]
ITEMS = [(1, "one two two"), (2, None), (3, ""), (4, "zzz"), (5, "Three é\x85ü three three"), (5, "two"), (None, "w1x1 w2x2 one"), (6, LONG[:500])]


def terms(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def plain(docs, items, top=20):
    """[(item id, rank, doc id, score)] of all items."""
    own = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in own]
    n, words = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for (id, _), c, size in zip(docs, own, sizes):
            score = 0
            for t in terms(text):
                if c[t]:
                    m = 75 + (25 * size * n) // words
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, id is None, id or 0))
        out += [(item, k + 1, None if gone else id, -score) for k, (score, gone, id) in enumerate(sorted(found)[:top])]
    return out


def key(row):
    return [(x is None, x or 0) for x in row]


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(i, t, 7.0, 3) for i, t in DOCS], "doc_id long, text string, score double, rank int")
    items = spark.createDataFrame([(i, t, 7.0) for i, t in ITEMS], "item_id long, text string, term double")
    return docs, items


@pytest.mark.parametrize("block", [20_000, 3])
@pytest.mark.parametrize("top", [20, 2])
def test_against_all_pairs(frames, monkeypatch, block, top):
    docs, items = frames
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    got = [tuple(r) for r in search(docs.repartition(3), items, top=top).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=key) == sorted(plain(DOCS, ITEMS, top), key=key)


def test_ties_go_by_id_over_many_tasks(spark):
    docs = [(i, "same words here" if i % 2 else "other") for i in range(300)]
    got = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(40), spark.createDataFrame([("a", "same other")], "item_id string, text string")).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [("a", k + 1, 2 * k) for k in range(20)]


def test_empty_tables(spark, frames):
    docs, items = frames
    assert search(docs.limit(0), items).count() == 0 and search(docs, items.limit(0)).count() == 0
    out = search(docs.limit(0), items)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


@pytest.mark.parametrize("seed", range(4))
def test_sharing_graph(seed):
    rng = random.Random(seed)
    base = [rng.sample(range(60), 15) for _ in range(4)]
    items = [sorted({*rng.choice(base)[: rng.randint(0, 15)], *rng.sample(range(60), rng.randint(0, 8))}) for _ in range(25)]
    leaf, made, nodes = share(items, 60)
    leaves = 1 + max(leaf[e] for own in items for e in own)
    holds = [{e for own in items for e in own if leaf[e] == k} for k in range(leaves)]
    for a, b in made:
        assert not holds[a] & holds[b]  # no element twice
        holds.append(holds[a] | holds[b])
    for own, parts in zip(items, nodes):
        assert sorted(e for p in parts for e in holds[p]) == own
    assert len(made) + sum(map(len, nodes)) < sum(map(len, items))


def test_accumulators_are_whole_and_survive_a_file():
    texts = [t for _, t in DOCS]
    own = [Counter(terms(t)) for _, t in ITEMS]
    names = sorted({t for c in own for t in c})
    hashed = dict(zip(names, term_counts(pa.array(names))[1].view(np.int64)[np.argsort(term_counts(pa.array(names))[0])].tolist()))
    block = Block.load(Block.of([(i, str(i), [(hashed[t], q, 1 + len(t)) for t, q in c.items()]) for i, c in enumerate(own) if c]).dump())
    doc, term, tf, counts = term_counts(pa.array(texts, pa.string()))
    m = 75 + counts
    got = block.scores(len(texts), doc, term, tf, m)
    have = [Counter(terms(t)) for t in texts]
    want = [[sum(q * (1 + len(t)) * ((1_000_000_000 * h[t]) // (1000 * h[t] + 12 * int(k))) for t, q in c.items() if h[t]) for h, k in zip(have, m)] for c in own if c]
    assert got.tolist() == want


def test_given_tables_against_all_pairs(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    got = [tuple(r) for r in search(docs, items).select("item_id", F.col("rank"), "doc_id", "score").collect()]
    assert sorted(got) == sorted(want) and got
