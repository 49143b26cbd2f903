import os
import random
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from outletry.llm import packing, token_files, tokens
from outletry.llm.common import fresh_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokens.vocabulary())
    return lambda text: t.encode(text, add_special_tokens=False).ids


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_encoder_equals_the_library(library):
    r, e = random.Random(4), tokens.Encoder(words=500)
    letters = "ab cd  \n\t_'s'll 'reA12³½é ß–“”.,!?%$#*\xa0　日本İΣσ\x1c\x85-()_`~\\/\"€ªº😀\x00"
    for k in range(4000):
        text = "".join(r.choice(letters) if k % 2 else chr(r.randrange(0x250)) for _ in range(r.choice([1, 2, 3, 8, 25])))
        assert ids(e(text)) == library(text), text
    for text in ("a <|endoftext|> b", "<|endoftext|>", "é<|endoftext|><|endoftext|>\n", "<|endoftext", "a<|endoftext|>\x1c2"):
        assert ids(e(text)) == library(text), text
    assert 50256 in ids(e("a <|endoftext|> b")) and 50256 not in ids(tokens.Encoder(special_as_text=True)("a <|endoftext|> b"))
    assert len(e.known) <= 600


def test_files_round_trip_and_random_access(spark, prose, library):
    docs = {i: prose(i, 30 + i % 400) for i in range(300)} | {300: "", 301: "x" * 400_000, 302: "end <|endoftext|> of"}
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    path = fresh_path(spark, "test")
    manifest = token_files.write_tokens(d, path)
    got = sorted((x["doc_id"], x["start"], x["ids"]) for x in token_files.read_tokens(manifest, True).collect())
    at = 0
    for (i, text), (doc_id, start, found) in zip(sorted(docs.items()), got, strict=True):
        assert (doc_id, start, found) == (i, at, [*library(text), 2])
        at += len(found)
    rows = sorted(manifest.collect(), key=lambda x: x["part"])
    assert sum(x["n_docs"] for x in rows) == len(docs)
    f = token_files.TokenFile(rows[-1]["path"])
    k = len(f.doc_ids) - 1
    assert [(f.doc_ids[p], ids(raw)) for p, raw in f.documents([0, k])] == [(f.doc_ids[0], [*library(docs[f.doc_ids[0]]), 2]), (f.doc_ids[k], [*library(docs[f.doc_ids[k]]), 2])]
    local = rows[0]["path"].removeprefix("file://")
    assert not [x for x in os.listdir(os.path.dirname(local)) if x.endswith(".tmp")]
    first = token_files.TokenFile(local)
    raw = open(local, "rb").read()
    plain, at = b"", 0
    for size in first.frames.sizes[:-1]:  # any Zstandard program reads the frames one after another
        plain += zstandard.ZstdDecompressor().decompress(raw[at : at + int(size)])
        at += int(size)
    assert len(plain) == 4 * int(first.tokens.sum())


def test_a_damaged_frame_is_noticed(spark):
    path = fresh_path(spark, "damage") + "/x"
    w = token_files.FramedWriter(path, "0")
    w.frame(b"hello" * 100)
    w.close(b"")
    r = token_files.FramedReader(path)
    r.checksums = r.checksums + np.uint32(1)
    with pytest.raises(ValueError):
        r.frame(0)


def test_cutting_stock_meets_the_demand():
    r = np.random.default_rng(5)
    for n, top in ((0, 512), (1, 512), (40, 512), (3000, 512), (3000, 1023)):
        lengths, counts = np.unique(r.integers(1, top + 1, n), return_counts=True)
        got: dict[int, int] = {}
        total = 0
        for times, pattern in packing.cutting_stock(lengths, counts.astype(float), packing.Pack()):
            assert sum(a * b for a, b in pattern.items()) <= 1024
            total += times
            for length, each in pattern.items():
                got[length] = got.get(length, 0) + times * each
        assert got == dict(zip(lengths.tolist(), counts.tolist()))
        if n == 3000 and top == 512:
            assert total <= 1.01 * np.dot(lengths, counts) / 1024 + 1


def test_packing(spark, prose, library):
    docs = {i: prose(i, 20 + 37 * i % 900) for i in range(150)} | {150: "", 151: "y " * 9000, 152: "<|endoftext|>"}
    out = packing.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3), with_ids=True).toPandas()
    for i, g in out.sort_values("start").groupby("doc_id"):
        assert [t for x in g["ids"] for t in x] == [*library(docs[i]), 0]
        assert list(g["start"]) == list(g["length"].cumsum() - g["length"]) and set(g["doc_tokens"]) == {g["length"].sum()}
        assert all(zlib.crc32(np.asarray(x, "<u4").tobytes()) == c for x, c in zip(g["ids"], g["ids_crc32"]))
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == list(g["length"].cumsum() - g["length"]) and g["length"].sum() <= 1024
    assert out["doc_id"].nunique() == len(docs)
    assert out["sequence_id"].nunique() <= 1.03 * out["length"].sum() / 1024 + 1


def test_odd_rows(spark, odd_documents):
    assert token_files.encode_to_files(odd_documents).count() == 10
    assert token_files.encode_to_files(odd_documents.limit(0)).count() == 0
    out = packing.pack(odd_documents).toPandas()
    assert (out["start"] == 0).sum() == 10
    assert packing.pack(odd_documents.limit(0)).count() == 0
