import random
import time

import plain
from pyspark.sql import functions as F

from outletry.llm import privacy


def found(df):
    d = privacy.find(df)
    return {x["doc_id"]: (x["b"], x["s"]) for x in d.select("doc_id", privacy.written(F.col("base")).alias("b"), privacy.written(F.col("spans")).alias("s")).collect()}


def test_base_spans_equal_plain_ones(spark):
    r = random.Random(2)
    pieces = ["a", "b.c", "@", ".", "-", " ", "%", "1", "12", "255", "256", "+1", "+", "(", ")", "4111 1111 1111 1111", "378282246310005", "é", "😀", "x@y.z", "1.2.3.4", "0", "\n"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 25))) for _ in range(600)]
    texts += ["a@b.c%d@e.f.g. 1.2.3.4.5 0001.2.3.4 1.2.3.999", "9" * 3000 + " " + "a" * 3000 + "@", "a@b" + ".c" * 5000, ""]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {i: b for i, (b, _) in got.items()} == {i: ",".join(plain.base_spans(t)) for i, t in enumerate(texts)}


def plain_over(tokens, spans):
    """Each token's first overlapping span, by comparing all."""
    return [next((s for s in sorted(spans) if s[0] < b and a < s[2]), None) for a, b in tokens]


def test_tokens_find_their_spans(spark):
    r = random.Random(6)
    rows = []
    for i in range(300):
        at, tokens, spans = 0, [], []
        for _ in range(r.randrange(6)):
            at += r.randrange(1, 6)
            tokens.append((at, at := at + r.randrange(1, 9)))
        for rank in range(4):
            at = 0
            for _ in range(r.randrange(4)):
                at += r.randrange(0, 7)
                spans.append((at, rank, at := at + r.randrange(1, 12), f"{rank}:{at}"))
        rows.append((i, tokens, sorted(spans)))
    d = spark.createDataFrame(rows, "id long, t array<struct<start:long,end:long>>, s array<struct<start:long,rank:int,end:long,found:string>>")
    for x in d.select("id", privacy._first_over(F.col("t"), F.col("s")).alias("o")).collect():
        _, tokens, spans = rows[x["id"]]
        assert [tuple(o) if o else None for o in x["o"]] == plain_over(tokens, spans)


def test_a_text_of_many_addresses_takes_linear_time(spark):
    def took(n):
        d = spark.createDataFrame([(1, " ".join(f"user{i}@example{i % 7}.com 10.0.{i % 256}.1" for i in range(n)))], "doc_id long, text string").cache()
        assert d.count() == 1
        began = time.perf_counter()
        (x,) = d.select(F.size(privacy.base_spans(F.col("text"))).alias("n"), F.size(privacy._occurrences(F.col("text"), privacy._base_found(F.col("text")), privacy.Bootstrap())).alias("m")).collect()
        assert x["n"] == 2 * n and x["m"] == 0  # no words stand before them
        return time.perf_counter() - began

    took(1000)
    assert took(24000) < 20 * took(3000)  # 64 times, if it were quadratic


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please call me on 555-01{i:02d}-{i} now, or call me on +1 555 010 {1000 + i} instead") for i in range(8)]
    rows += [(100, "nothing to see in room 12345 here")]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    for i in range(8):
        text = rows[i][1]
        at = text.index("555-01")
        assert f"context:{at}:{at + len(f'555-01{i:02d}-{i}')}" in got[i][1]
        assert set(got[i][0].split(",")) <= set(got[i][1].split(","))
    assert got[100] == ("", "")


def test_found_identifiers_are_marked_in_any_place(spark):
    rows = [(i, f"please call me on 555-01{i:02d}-{i} now, or call me on +1 555 010 {1000 + i} instead") for i in range(8)]
    one, two = "555-0101-1", "555-0102-2"
    rows += [(100, f"{one} first"), (101, f"ID {one}"), (102, f"on the list {one} or {two}"), (103, f"{'x' * 80} y {one}"), (104, "777-0101-1 first")]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    for i, text in rows[8:12]:
        spans = {f"context:{text.index(x)}:{text.index(x) + len(x)}" for x in (one, two) if x in text}
        assert set(got[i][1].split(",")) == spans
    assert got[104] == ("", "")


def test_redaction(spark):
    rows = [(1, "mail a@b.co or +1 (838) 555-1234!", 33), (2, None, 0), (3, "plain é", 7)]
    wide = [("é😀x " * 700, "a@b.co"), (" " + "y" * 1023, "1.2.3.4"), (" ", "z@b.co"), (" +", " "), ("", "4111 1111 1111 1111"), ("\n" * 2500, "")]
    rows += [(4, "".join(a + b for a, b in wide), 0)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {x["doc_id"]: (x["text"], x["n_chars"]) for x in privacy.redact(d).collect()}
    text = "".join(a + {"a": "<EMAIL>", "1": "<IP>", "z": "<EMAIL>", "4": "<CARD>"}.get(b[:1], b) for a, b in wide)
    assert got.pop(4) == (text, len(text))
    assert got == {1: ("mail <EMAIL> or <PHONE>!", 24), 2: (None, 0), 3: ("plain é", 7)}


def test_odd_rows(spark, odd_documents):
    assert privacy.find(odd_documents).count() == 10
    assert privacy.find(odd_documents.limit(0)).count() == 0
    out = privacy.redact(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == 10
