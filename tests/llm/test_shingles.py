import os
import random

import numpy as np
import plain
import pytest

from outletry.llm import shingles


def corpus(prose):
    r = random.Random(7)
    texts = {i: prose(i, r.choice([0, 1, 3, 5, 30, 80, 200])) for i in range(120)}
    shared = prose(999, 60)
    for i in range(120, 200):  # near copies
        w = texts[r.randrange(120)].split()
        for _ in range(r.randrange(4)):
            if w:
                w[r.randrange(len(w))] = f"edit{r.random()}"
        texts[i] = " ".join(w)
    for i in range(200, 280):  # a passage in many documents
        texts[i] = prose(i, 150) + " " + shared + " " + prose(i + 5000, 150)
    big = prose(1234, 120).split()
    for i in range(280, 400):  # a large group of copies and near copies
        w = list(big)
        if i % 2:
            w[r.randrange(len(w))] = f"e{i}"
        texts[i] = " ".join(w)
    return texts


def test_equals_brute_force(spark, prose):
    texts = corpus(prose)
    want = plain.join(texts)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    for at in (shingles.Join(), shingles.Join(leaf=6, chunk=25)):
        got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in shingles.join(d, at).collect()}
        assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()}
        assert got == want


def test_the_recall_sets_the_runs():
    at = shingles.Join()
    x = at.survival
    assert abs(x - (1 - np.exp(-at.draw * at.least * x))) < 1e-9 and (1 - x) ** at.runs <= 1 - at.recall < (1 - x) ** (at.runs - 1)
    assert shingles.Join(recall=0.9).runs < at.runs


def test_pairs_survive_deep_splitting(spark, prose):
    # All documents share under half of their shingles, so one bucket is split again and again; pairs are just similar.
    shared, texts, r = prose(77, 90), {}, random.Random(5)
    for i in range(240):
        w = prose(7000 + i // 2, 110, 100_000).split()
        if i % 2:
            for k in range(2):
                w[20 + 50 * k + r.randrange(10)] = f"edit{i}"
        texts[i] = shared + " " + " ".join(w)
    want = plain.join(texts)
    assert all(c == i - i % 2 for i, (c, _) in want.items())
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: (x["class_id"], x["n_links"]) for x in shingles.join(d, shingles.Join(leaf=4)).collect()}
    assert got == want


def test_what_a_split_saves_is_told_by_a_row_a_bucket(spark):
    r = random.Random(5)
    share = {1: 0, 2: 3, 3: 6, 4: 8}  # shingles that all sets of a bucket have in common, of 12
    pool = {100 * b + i: [1000 * b + t for t in range(share[b])] + r.sample(range(10**6, 10**6 + 400), 12 - share[b]) for b in share for i in range(30)}
    at = shingles.Join(leaf=12, look=1000)
    sets = spark.createDataFrame(list(pool.items()), "uid long, sample array<long>")
    paths = spark.createDataFrame([(u // 100, u) for u in pool], "node long, uid long")
    large = spark.createDataFrame([(b, 30) for b in share], "node long, n long")
    want = set()
    for b in share:
        mine = [set(s) for u, s in pool.items() if u // 100 == b]
        met = sum(len(x & y) for i, x in enumerate(mine) for j, y in enumerate(mine) if i != j)
        if 30 * (1 - at.draw * met / (29 * 12 * 30)) > at.leaf:
            want.add(b)
    d = shingles.splits(large, paths, sets, at)
    assert {x["node"] for x in d.collect()} == want and 0 < len(want) < 4
    assert "Generate" not in d._jdf.queryExecution().executedPlan().toString()  # once a row for each shingle of each set


def test_recall_of_a_query_set_against_all_rows(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    docs = spark.read.parquet(path).select("doc_id", "text")
    sets = {x["doc_id"]: plain.shingles(x["text"] or "") for x in docs.collect()}
    near = lambda a, b: bool(a and b) and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) / len(a | b) >= 0.8
    want = {q: sum(near(sets[q], s) for i, s in sets.items() if i != q) for q in sets if q % 50 == 0}
    got = {x["doc_id"]: x["n_links"] for x in shingles.join(docs).where("doc_id % 50 = 0").collect()}
    assert all(got[q] <= n for q, n in want.items()) and sum(got.values()) >= 0.999 * sum(want.values())


def test_many_large_groups_of_different_near_copies(spark, prose):
    texts, want = {}, {}
    for g in range(40):
        base = prose(9000 + g, 104).split()
        group = {}
        for k in range(70):
            w = list(base)
            w[random.Random(g * 100 + k).randrange(5, 99)] = f"edit{k}"
            group[g * 1000 + k] = " ".join(w)
        texts |= group
        want |= plain.join(group)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {x["doc_id"]: (x["class_id"], x["n_links"]) for x in shingles.join(d).collect()} == want


def test_one_of_each_class_stays(spark, prose):
    texts = corpus(prose)
    d = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, source string")
    out = shingles.keep_one(d)
    assert out.columns == d.columns
    assert sorted(x["doc_id"] for x in out.collect()) == sorted({c for c, _ in plain.join(texts).values()})


def test_odd_rows(spark, odd_documents):
    got = sorted((x["doc_id"] is None, x["doc_id"] or 0, x["n_links"], x["class_id"] or 0) for x in shingles.join(odd_documents).collect())
    assert len(got) == 10 and (False, 5, 1, 5) in got and (False, 1, 0, 1) in got and (False, 2, 0, 2) in got
    kept = shingles.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == 9
    assert shingles.join(odd_documents.limit(0)).count() == 0
    assert shingles.keep_one(odd_documents.limit(0)).count() == 0
