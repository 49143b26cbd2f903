"""Toxicity by multiple-instance learning (operator 2).

A document is a bag of sentences. Each sentence has a logistic score p over its
words; the document's is their noisy-or, 1 - prod(1 - p), which is what the labels of
documents train. So the model also tells which sentences offend. When documents are
scored, a sentence counts by what its p has over a floor: as r = (p - floor) / (1 - floor),
or not at all below it, so that no number of sentences without evidence makes a
document toxic. One leak a document, the best p up to the floor, keeps documents
without evidence in order:

    score = 1 - (1 - min(max p, floor)) * prod(1 - r)

which for one sentence is its p.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, small_batches

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
STEMS = (5, 7)


@dataclass(frozen=True)
class Training:
    """max_positive, max_negative: the bounded sample of labelled rows that the model is
    fitted on, chosen by a hash of the id among documents of at most `max_chars` code
    points, so the driver's memory has a bound. min_docs: words of fewer sampled documents
    have no weight. floor: a sentence's score from which it counts. steps, rate, l1:
    of the fit."""

    max_positive: int = 2000
    max_negative: int = 3000
    max_chars: int = 40_000
    min_docs: int = 8
    floor: float = 0.3
    steps: int = 250
    rate: float = 0.15
    l1: float = 3e-4
    seed: int = 7


def features(word: str) -> list[str]:
    """A word and its longer beginnings, by which inflected forms share what is learnt."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


class Model:
    """words: the weights of features, bias: of a sentence without any, floor: see above."""

    def __init__(self, words: dict[str, float], bias: float, floor: float = 0.3, remember: int = 300_000):
        self.words, self.bias, self.floor, self.remember, self.known = words, bias, floor, remember, {}

    def weight(self, word: str) -> float:
        """What a word adds to its sentence; so many words at most are remembered."""
        total = sum(self.words.get(f, 0.0) for f in features(word))
        if len(self.known) < self.remember:
            self.known[word] = total
        return total

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of every sentence, in code points."""
        known, weight, out = self.known, self.weight, []
        for m in _SENTENCE.finditer(text):
            found = {w: known.get(w) for w in _WORD.findall(m[0].lower())}
            z = self.bias + sum(weight(w) if x is None else x for w, x in found.items())
            out.append((m.start(), m.end(), z))
        return out

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and its offending sentences with theirs.

        A text without sentences scores as one sentence without known words.
        """
        log_not, best, worst, counts = 0.0, self.bias, [], math.log(self.floor / (1 - self.floor))
        for start, end, z in self.sentences(text):
            best = max(best, z)
            if z > counts:
                p = 1 / (1 + math.exp(-z)) if z < 700 else 1.0
                log_not += math.log(max((1 - p) / (1 - self.floor), 1e-300))
                if z >= 0:
                    worst.append((start, end, p))
        leak = min(self.floor, 1 / (1 + math.exp(-max(best, -700.0))))
        return min(1.0, max(0.0, -math.expm1(log_not + math.log1p(-leak)))), worst


def held_out(doc_id) -> "F.Column":
    """Whether a document is none that labels are learnt from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, at: Training) -> tuple[list[str], np.ndarray]:
    """Texts and labels to learn from: `max_positive` + `max_negative` rows at most.

    Several labels of a document count as toxic if one is; null labels and ids don't
    count. Rows of one id are one document: the shortest text of it, the first by hash.
    """
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    good = good.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.lit(at.seed), "doc_id"), F.col("doc_id")]
    texts = id_and_text(docs).withColumn("long", F.length("text"))
    short = texts.groupBy("doc_id").agg(F.min("long").alias("long")).where(F.col("long") <= at.max_chars).select("doc_id")
    good = good.join(short, "doc_id")
    ids = good.where("toxic = 1").orderBy(*order).limit(at.max_positive).unionByName(good.where("toxic = 0").orderBy(*order).limit(at.max_negative))
    first = F.min_by("text", F.struct("long", F.xxhash64("text")))
    rows = texts.where(F.col("long") <= at.max_chars).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(first.alias("text"))
    got = sorted((r["doc_id"], r["toxic"], r["text"]) for r in rows.collect())
    return [t for _, _, t in got], np.array([y for _, y, _ in got], float)


def fit(texts: list[str], y: np.ndarray, at: Training) -> Model:
    """Sentence weights by gradient steps on the noisy-or likelihood, classes weighted to balance."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model({}, float(np.log((share + 1e-3) / (1 - share + 1e-3))), at.floor)
    seen: dict[str, int] = {}
    toxic: dict[str, int] = {}
    for text, label in zip(texts, y, strict=True):
        for f in {f for w in set(_WORD.findall(text.lower())) for f in features(w)}:
            seen[f] = seen.get(f, 0) + 1
            if label:
                toxic[f] = toxic.get(f, 0) + 1
    names = sorted(f for f, n in seen.items() if n >= at.min_docs)
    number = {f: i for i, f in enumerate(names)}
    total, bad = np.array([seen[f] for f in names], float), np.array([toxic.get(f, 0) for f in names], float)
    del seen, toxic
    doc_of, sentence_of, word_of = array("i"), array("i"), array("i")
    for k, text in enumerate(texts):
        for m in list(_SENTENCE.finditer(text)) or [None]:
            for w in set(_WORD.findall(m[0].lower())) if m else ():
                for f in features(w):
                    if (i := number.get(f)) is not None:
                        sentence_of.append(len(doc_of))
                        word_of.append(i)
            doc_of.append(k)
    doc_of, sentence_of, word_of = (np.array(x, np.int32) for x in (doc_of, sentence_of, word_of))
    n_pos, n = y.sum(), len(y)
    weight = np.where(y == 1, 0.5 / n_pos, 0.5 / (n - n_pos))
    # Begin where each word's own log odds over documents point, shrunk; the steps do the rest.
    odds = np.log((bad + 0.5) / (n_pos + 1)) - np.log((total - bad + 0.5) / (n - n_pos + 1))
    w = np.where(np.abs(odds) > 2, odds, 0.0)
    per_doc = np.bincount(doc_of, minlength=n)
    b = -np.log(max(float(np.mean(per_doc)), 1.0)) - 3.0
    m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, at.steps + 1):
        z = b + np.bincount(sentence_of, w[word_of], minlength=len(doc_of))
        log_not = np.bincount(doc_of, -np.logaddexp(0, z), minlength=n)
        p = np.clip(-np.expm1(log_not), 1e-9, 1)
        # d(-log likelihood) / d(sum of softplus): -(1-p)/p for the toxic, 1 for the others.
        outer = weight * np.where(y == 1, -np.exp(log_not) / p, 1.0)
        gz = outer[doc_of] / (1 + np.exp(-z))
        g = np.append(np.bincount(word_of, gz[sentence_of], minlength=len(w)) + at.l1 * np.sign(w), gz.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        step = at.rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-6)
        w, b = w - step[:-1] * np.sqrt(1 - t / (at.steps + 1)), b - step[-1] * np.sqrt(1 - t / (at.steps + 1))
    return Model({x: float(v) for x, v in zip(names, w, strict=True) if abs(v) > 0.05}, float(b), at.floor)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every document with its score and its offending sentences.

    Only the text is scored. Null text is empty and gets the score of one sentence of
    unknown words; rows are scored each for itself, so repeated ones agree; a null
    id stays. No rows give none. Extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of `max_positive + max_negative` documents at most
    d = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = [shared.value.score(t) for t in batch["text"].to_pylist()]
            spans = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in scored], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            p = np.array([x for x, _ in scored], float)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32)), "sentences": spans})

    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, sentences array<struct<start:long,end:long,score:double>>")


def learn_and_score(docs: DataFrame, labels: DataFrame, at: Training = Training()) -> DataFrame:
    """Every document scored by a model of the labels that aren't held out, see :func:`sample` and :func:`score`.

    Without labels, or with labels of one kind, all sentences score the share of toxic ones.
    """
    return score(docs, fit(*sample(docs, labels, at), at))
