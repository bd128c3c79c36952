"""Near-duplicates against all pairs by brute force: near texts, chains, repeated and missing ids, clashing columns, hot keys."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwatch.llm import neardup
from stallwatch.llm.scratch import Scratch


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def brute(rows, percent=80):
    """Component number of each row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def wanted(rows):
    group = brute(rows)
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    return sorted(((i, len(shingles(t)), least[g], least[g] is None or i == least[g]) for (i, t), g in zip(rows, group)), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def judged(spark, rows):
    return sorted((tuple(r) for r in neardup.near_duplicates(frame(spark, rows)).collect()), key=str)


def changed(rng, words, n):
    """The words with n of them replaced."""
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"new{rng.integers(1 << 40)}"
    return words


def text_of(rng, n=80):
    return [f"w{x}" for x in rng.integers(0, 1 << 30, n)]


def mixed_rows(rng, n_groups=40):
    """Groups of near texts and chains, with repeated and missing ids, single words, white texts and upper case."""
    rows, next_id = [], 100
    for _ in range(n_groups):
        now = text_of(rng, int(rng.integers(5, 120)))
        for _ in range(int(rng.integers(1, 7))):
            rows.append((next_id, " ".join(now)))
            next_id += 1
            now = changed(rng, now, int(rng.integers(0, max(2, len(now) // 12))))
    some = [rows[i] for i in rng.choice(len(rows), 30)]
    rows += some[:5] + [(None, t) for _, t in some[5:12]] + [(rows[0][0], t.upper()) for _, t in some[12:20]] + [(7, t + " x") for _, t in some[20:]]
    rows += [(None, " ".join(text_of(rng))), (1, None), (1, None), (2, ""), (None, " \n"), (3, "One"), (4, "one"), (5, "ONE  one")]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("blocks", [(500_000, 512), (150, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", blocks[0])
    monkeypatch.setattr(neardup, "BLOCK_ROWS", blocks[1])
    rows = mixed_rows(np.random.default_rng(11))
    assert len(set(brute(rows))) < len(rows) - 60
    assert judged(spark, rows) == wanted(rows)


@pytest.mark.parametrize("blocks", [(500_000, 512), (2000, 20)])
def test_hot_templates(spark, monkeypatch, blocks):
    """A third of the rows share a template; others are near it, near one another only, or share keys but are no links."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", blocks[0])
    monkeypatch.setattr(neardup, "BLOCK_ROWS", blocks[1])
    rng = np.random.default_rng(12)
    base = text_of(rng, 60)
    near = [changed(rng, base, 1) for _ in range(60)]
    off = changed(rng, base, 10)
    texts = near + [changed(rng, off, int(rng.integers(0, 4))) for _ in range(40)] + [changed(rng, base, int(rng.integers(4, 14))) for _ in range(40)] + [text_of(rng, 60) for _ in range(40)]
    rows = [(int(i), " ".join(texts[i])) for i in rng.permutation(len(texts))]
    rows = rows + [(1000 + i, t) for i, (_, t) in enumerate(rows[:40])]
    assert judged(spark, rows) == wanted(rows)


def test_template_family_is_dealt_out_in_proportion(spark, monkeypatch):
    """Texts of one template are near one another without links: rows dealt out grow with the texts, and planted links are found."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 5000)
    monkeypatch.setattr(neardup, "KEY_ROWS", 4)
    dealt = {}
    for n in (250, 500, 1000):
        rng = np.random.default_rng(16)
        template = text_of(rng, 100)
        texts = [changed(rng, template, 22) for _ in range(n)]
        crowd = changed(rng, template[:5], 5)  # the same rare words in every tenth text: a key of more than KEY_ROWS rows
        for i in range(0, n, 10):
            texts[i][:5] = crowd
        texts += [changed(rng, texts[i], 3) for i in range(0, n, 25)]
        sets = [np.sort(np.array([hash(x) for x in shingles(" ".join(t))], np.int64).view(np.uint64)) for t in texts]
        grouped = spark.createDataFrame([(i, 0, len(s), i) for i, s in enumerate(sets)], "node long, family long, n_shingles long, label long")
        full = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "node long, shingles binary")
        scratch = Scratch(spark, "test")
        links = {frozenset((r.a, r.b)) for r in neardup._inside(grouped, full, 80, scratch).collect()}
        assert links >= {frozenset((i, n + k)) for k, i in enumerate(range(0, n, 25))}
        assert all(neardup.similar(*(sets[i] for i in link), 80) for link in links)
        kept, pairs = (spark.read.parquet(scratch.path(x)) for x in ("prefixed", "prefix_pairs"))
        crowded = grouped.join(kept.where(F.col("n") > neardup.KEY_ROWS), "node", "left_semi")
        in_blocks = neardup._placed(neardup._sized(crowded), F.col("label") == F.col("main"), "node").count()
        old = neardup._placed(neardup._sized(grouped), F.col("label") == F.col("main"), "node").count()
        dealt[n] = (kept.count(), pairs.count(), in_blocks, old)
    for k in (0, 1):
        assert dealt[1000][k] <= 2.5 * dealt[500][k] <= 6.25 * dealt[250][k], dealt
    assert dealt[1000][2] * 20 < dealt[1000][3] and dealt[1000][3] > 3 * dealt[500][3], dealt


def test_unrelated_text_under_a_repeated_id_stays(spark):
    rng = np.random.default_rng(13)
    a, b = text_of(rng), text_of(rng)
    rows = [(3, " ".join(a)), (5, " ".join(changed(rng, a, 2))), (5, " ".join(b)), (None, " ".join(changed(rng, a, 1))), (5, None), (5, " ")]
    assert judged(spark, rows) == wanted(rows)
    assert {(r.doc_id, r.text) for r in neardup.drop_near_duplicates(frame(spark, rows)).collect()} == {rows[0], rows[2], rows[4], rows[5]}


def test_one_of_each_group_stays(spark):
    rows = mixed_rows(np.random.default_rng(14), 15)
    group = brute(rows)
    kept = [(r.doc_id, r.text) for r in neardup.drop_near_duplicates(frame(spark, rows)).collect()]
    assert len(kept) == len(set(kept))
    by_row = {}
    for row, g in zip(rows, group):
        by_row.setdefault(row, g)
    full = [r for r in kept if shingles(r[1])]
    assert len(full) == len({by_row[r] for r in full}) == len({g for r, g in zip(rows, group) if shingles(r[1])})
    assert {r for r in kept if not shingles(r[1])} == {r for r in rows if not shingles(r[1])}
    least = {g: min((r[0] is None, r[0] or 0) for r, h in zip(rows, group) if h == g) for g in set(group)}
    assert all((r[0] is None, r[0] or 0) == least[by_row[r]] for r in full)


def test_clashing_columns(spark):
    rng = np.random.default_rng(15)
    a = text_of(rng)
    rows = [(1, " ".join(a)), (2, " ".join(changed(rng, a, 1))), (3, None), (4, " ".join(text_of(rng)))]
    names = ["id", "text_hash", "row_a", "row_b", "node", "key", "family", "component", "kept", "signature", "n_shingles", "__id", "head"]
    docs = frame(spark, rows).select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    out = neardup.drop_near_duplicates(docs)
    assert out.schema == docs.schema and sorted(r.doc_id for r in out.collect()) == [1, 3, 4]
    assert all(r[c] == i for r in out.collect() for i, c in enumerate(names))
    assert neardup.near_duplicates(docs).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_given_documents_equal_all_pairs(spark):
    """Recall and precision on given texts, by an inverted list over all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    sets = [shingles(t) for _, t in rows]
    index, group = {}, list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, own in enumerate(sets):
        common = {}
        for x in own:
            for j in index.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            index[x].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == {(doc, least[root(i)]) for i, (doc, _) in enumerate(rows)}
