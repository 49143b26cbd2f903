import random
import re

import numpy as np
import plain
from pyspark.sql import functions as F

from outletry.llm import quality

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_equal_plain_ones(spark):
    r = random.Random(1)
    texts = ["", " ", "a", "a b c a b c", "x x x x", "l1\nl1\n \n\nl2\r\nl1", "#*$%&|<> é b"]
    texts += ["".join(r.choice(["a ", "b ", "c\n", "#", "\t", "é ", "w1 w2 w3 ", "\x0b"]) for _ in range(r.randrange(60))) for _ in range(150)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: tuple(x[f] for f in FIELDS) for x in quality.judge(d).collect()}
    assert got == {i: plain.quality(t) for i, t in enumerate(texts)}


def test_symbol_junk_goes_and_clean_stays(spark, prose):
    rows = [(i, prose(i, 200), "en", "a") for i in range(60)]
    rows += [(100 + i, " ".join(w + "***$$$" for w in prose(i, 200).split()), "en", "a") for i in range(10)]
    rows += [(200, "few words", "en", "a"), (201, "again and again " * 40, "en", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {x["doc_id"] for x in quality.judge(d).where("kept").collect()}
    assert kept == set(range(60))
    out = quality.keep_good(d)
    assert out.columns == d.columns and {x["doc_id"] for x in out.collect()} == kept


def prose_of(words, seed, n, share=0.2):
    """Invented words with so many common ones of a language among them."""
    r = random.Random(seed)
    return " ".join(r.choice(words) if r.random() < share else "".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


ENGLISH, GERMAN = "the of and to in a is that for it".split(), "der die und den von zu das mit sich des".split()


def test_long_texts_without_common_words_go_and_prose_stays(spark):
    rows = [(i, prose_of(ENGLISH, i, 300), "en") for i in range(60)] + [(100 + i, prose_of(GERMAN, i, 300), "de") for i in range(40)]
    rows += [(200 + i, prose_of(ENGLISH, 50 + i, 300, 0), "en") for i in range(6)] + [(210 + i, prose_of(GERMAN, 90 + i, 300, 0.01), "de") for i in range(4)]
    rows += [(300 + i, prose_of([], 70 + i, 300, 0), "pl") for i in range(10)]  # its common words aren't known, so it isn't judged by them
    rows += [(400, prose_of([], 99, 300, 0), "cs")]  # nor are those of a language of one document
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {x["doc_id"] for x in quality.judge(d).where("kept").collect()}
    assert kept == {i for i, *_ in rows if i < 200 or i >= 300}


def test_every_language_has_a_reference(spark):
    letters = lambda seed, first: prose_of([], seed, 200, 0).translate({ord("a") + k: first + k for k in range(10)})
    rows = [(i, prose_of(ENGLISH, i, 200), "en") for i in range(30)]
    rows += [(1000 + 10 * k + i, letters(10 * k + i, 0x430 if k % 2 else 0x4E00), f"l{k}") for k in range(90) for i in range(1 + k % 3)]
    rows += [(5000, " ".join(w + "***$$$" for w in prose_of([], 7, 200, 0).split()), "l5")]  # junk among clean ones of a small language
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {x["doc_id"] for x in quality.judge(d).where("not kept").collect()} == {5000}


def plain_verdicts(rows, at):
    """The verdicts by the definition, with plain loops."""

    def js(p, q):
        half = lambda a, m: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
        m = [(x + y) / 2 for x, y in zip(p, q)]
        return np.sqrt(max(0, half(p, m) + half(q, m)) / 2)

    def hists(t):
        words = plain.WORD.findall(t)
        kinds = [r"[a-z]", r"[A-Z]", None, r"[0-9]", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()-]", r"[#*$%&|<>]"]
        n = [len(re.findall(k, t)) if k else sum(c.isalpha() and not c.isascii() for c in t) for k in kinds]
        common = [words.count(w) for w in quality.WORDS]
        return [x / max(len(t), 1) for x in [*n, len(t) - sum(n)]], [x / max(len(words), 1) for x in [*common, len(words) - sum(common)]]

    docs = []
    for i, t, lang in rows:
        q = plain.quality(t)
        base = q[0] < at.min_words or 100 * q[4] > at.max_repeat_percent * q[0]
        docs.append((i, lang, base, [len(t) >= at.min_chars, q[0] >= at.min_hist_words], hists(t)))
    far: set = set()
    for h, limit in ((0, at.max_class_distance), (1, at.max_word_distance)):
        unit = lambda r: js([0.0] * (len(r) - 1) + [1.0], r) if h else 1.0  # noqa: B023, E731
        for lang in {x[1] for x in docs}:
            fit = [x[4][h] for x in docs if x[1] == lang and not x[2] and x[3][h]]
            if not fit or h and np.mean(fit, 0)[-1] > 1 - at.min_common:
                continue
            mean = np.mean(fit, 0)
            if not h:
                middle = np.array([sorted(x)[(len(fit) - 1) // 2] for x in zip(*fit)])
                mean = middle / middle.sum()
            near = [x for x in fit if js(x, mean) / unit(mean) <= limit]
            if near and not (h and np.mean(near, 0)[-1] > 1 - at.min_common):
                mean = np.mean(near, 0)
            far |= {x[0] for x in docs if x[1] == lang and x[3][h] and js(x[4][h], mean) / unit(mean) > limit}
    return {x[0] for x in docs if not x[2] and x[0] not in far}


def test_verdicts_equal_plain_ones(spark):
    r = random.Random(8)
    rows = []
    for i in range(240):
        lang = r.choice(["en", "de", "pl"])
        t = prose_of({"en": ENGLISH, "de": GERMAN, "pl": ["się", "jest"]}[lang], i, r.choice([20, 60, 120, 300]), r.choice([0, 0.02, 0.2, 0.4]))
        t = {0: t.upper(), 1: t.replace(" ", " | "), 2: " ".join(w + "%%%" for w in t.split()), 3: t.replace("a", "7"), 4: t.replace("a", "é")}.get(r.randrange(12), t)
        rows.append((i, t, lang))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert {x["doc_id"] for x in quality.judge(d).where("kept").collect()} == plain_verdicts(rows, quality.Limits())


def test_equal_hashes_are_told_apart_by_their_words(spark):
    # Of a text of n words only 64 - bits(n) bits of a window's hash are left; its words decide.
    words = " ".join(f"u{i}" for i in range(60_000))
    d = spark.createDataFrame([(1, words), (2, words + " u5 u6 u7")], "doc_id long, text string")
    assert {x["doc_id"]: x["n_repeat_words"] for x in quality.judge(d).collect()} == {1: 0, 2: 6}


def test_js_distance(spark):
    d = spark.sql("select array(0.5D, 0.5D) p, array(0.5D, 0.5D) q, array(1.0D, 0.0D) a, array(0.0D, 1.0D) b")
    x = d.select(quality.js_distance(F.col("p"), F.col("q")).alias("same"), quality.js_distance(F.col("a"), F.col("b")).alias("far")).first()
    assert x["same"] == 0 and abs(x["far"] - 1) < 1e-12


def test_odd_rows(spark, odd_documents):
    out = quality.judge(odd_documents).collect()
    assert len(out) == 10
    assert quality.judge(odd_documents.limit(0)).count() == 0
    assert set(quality.keep_good(odd_documents).columns) == set(odd_documents.columns)
