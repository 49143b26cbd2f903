import re
import zlib

import numpy as np

from outletry.llm import toxicity


def test_held_out_accuracy_and_sentences(spark, prose):
    bad = ["scum", "vermin", "swine"]
    rows, labels = [], []
    for i in range(700):
        words = prose(i, 60, 500).split()
        if toxic := i % 4 == 0:
            words.insert(30, bad[i % 3] + ("" if i % 2 else "."))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.learn_and_score(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))
    held = out[out.held_out]
    assert ((held.predicted == 1) == (held.doc_id % 4 == 0)).mean() > 0.95
    assert out.score.between(0, 1).all()
    text = dict(rows)
    hit = out[(out.doc_id % 4 == 0) & (out.predicted == 1)]
    assert np.mean([any(any(b in text[i][s["start"] : s["end"]].lower() for b in bad) for s in spans) for i, spans in zip(hit.doc_id, hit.sentences)]) > 0.95


def plain_score(model, text):
    """The formula by itself, over sentences cut at the marks that end one."""
    p = []
    for sentence in re.split(r"[.!?\n]", text):
        words = {x for x in re.split(r"[\W\d_]+", sentence.lower()) if x}
        weight = sum(model.words.get(f, 0) for w in words for f in [w] + [w[:n] + "*" for n in (5, 7) if len(w) > n])
        if sentence:
            p.append(1 / (1 + np.exp(-model.bias - weight)))
    p = np.array(p or [1 / (1 + np.exp(-model.bias))])
    r = np.maximum(p - model.floor, 0) / (1 - model.floor)
    return 1 - (1 - min(p.max(), model.floor)) * np.prod(1 - r), int((p >= 0.5).sum())


def test_score_is_the_noisy_or(spark, prose):
    m = toxicity.Model({"bad": 3.0, "worse": 2.2, "terri*": 4.0, "nice": -1.0, "w7": 0.3, "w12": 1.1}, -2.0)
    texts = ["good. bad! fine", "", "...", "terrible bad worse\nnice terrible? bad bad", "é Bad_worse 1bad2", *[prose(i, 3 * i, 20) + " bad" * (i % 3) for i in range(60)]]
    assert np.isclose(m.score("x bad")[0], 1 / (1 + np.exp(-1)))
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    for x in got:
        want, offending = plain_score(m, texts[x["doc_id"]])
        assert np.isclose(x["score"], want) and x["predicted"] == (want >= 0.5) and len(x["sentences"]) == offending


def test_long_clean_texts_stay_clean(spark, prose):
    m = toxicity.Model({"scum": 9.0, "w3": 0.8, "w5": -0.7}, -7.0)
    clean = ". ".join(prose(i, 9, 300).replace(".", "") for i in range(10_000))
    assert m.score(clean)[0] < 0.05 and m.score("unknown. " * 50_000)[0] < 0.05
    assert m.score(clean + " scum.")[0] > 0.5
    d = spark.createDataFrame([(1, clean), (2, clean + " scum.")], "doc_id long, text string")
    got = {x["doc_id"]: x for x in toxicity.score(d, m).collect()}
    assert got[1]["predicted"] == 0 and got[2]["predicted"] == 1
    assert clean[got[2]["sentences"][0]["start"] :][:5] != "scum" and got[2]["sentences"][0]["end"] <= len(clean) + 6


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 1, 1), (4, 0, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.learn_and_score(odd_documents, labels).collect()
    assert len(got) == 10 and all(0 <= x["score"] <= 1 for x in got)
    assert len({x["score"] for x in got if x["doc_id"] in (1, 2)}) == 1  # null is empty
    assert sum(x["held_out"] for x in got if x["doc_id"] is None) == 2
    assert toxicity.learn_and_score(odd_documents, labels.limit(0)).count() == 10
    assert toxicity.learn_and_score(odd_documents.limit(0), labels).count() == 0
