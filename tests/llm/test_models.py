"""Base counts against brute force, and the learned operators on rows that they did not learn from."""

import re
from collections import Counter

import numpy as np
import pytest

from stallwatch.llm import catalog, quality_grades, quality_rules, toxicity

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    for v in np.unique(score):  # ties share their mean rank
        order[score == v] = order[score == v].mean()
    good = label > 0
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def counts(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again)


def test_base_counts_equal_brute_force(spark, sf):
    rng = np.random.default_rng(51)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, None), (1, ""), (2, " \n\t\n"), (3, "a b\na b\n a b\na b"), (3, "a b\na b\n a b\na b")] + [(1000 + i, "".join(rng.choice(list("ab#|é \n\x85 "), 60))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    trees = quality_rules.fit_quality_rules(frame, spark.read.parquet(f"{sf}/labels.parquet"))
    got = sorted(((r.doc_id, *(r[c] for c in quality_rules.BASE), r.base_failed) for r in quality_rules.apply_quality_rules(frame, trees).collect()), key=str)
    want = [(i, *counts(t)) for i, t in docs]
    assert got == sorted(((*x, x[1] < 20 or 100 * x[5] > 30 * x[1]) for x in want), key=str)


@pytest.fixture(scope="module")
def given(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return spark.read.parquet(f"{SF}/documents.parquet"), labels, {r.doc_id: r for r in labels.collect()}


def test_toxicity_on_held_out_rows(spark, given):
    _, _, known = given
    rows = [r for r in catalog.op9_toxicity(spark, SF).collect() if r.held_out and r.doc_id in known]
    score, label = np.array([r.score for r in rows]), np.array([known[r.doc_id].toxic for r in rows])
    print("toxicity", auc(score, label), int(label.sum()), len(label))
    assert auc(score, label) > 0.8 and all(r.predicted == (r.score >= 0.5) for r in rows)


def test_grades_and_rules_on_held_out_rows(spark, given):
    docs, labels, known = given
    learn = labels.where(~toxicity.held_out())
    unseen = docs.join(labels.where(toxicity.held_out()).select("doc_id"), "doc_id")
    graded = quality_grades.grade_documents(unseen, quality_grades.fit_grades(docs, learn), keep=["doc_id"]).collect()
    ruled = quality_rules.apply_quality_rules(unseen, quality_rules.fit_quality_rules(docs, learn)).collect()
    quality = lambda rows: np.array([known[r.doc_id].quality for r in rows])
    found = auc(np.array([r.tail_probability for r in graded]), quality(graded)), auc(np.array([r.score for r in ruled]), quality(ruled))
    print("grades, rules", found, len(graded))
    assert min(found) > 0.8
