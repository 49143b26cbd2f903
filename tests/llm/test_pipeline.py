import os
import re

import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    before = {x["doc_id"]: x["text"] for x in docs.collect()}

    good = stages["quality"](spark, docs, SF).cache()
    kept = {x["doc_id"]: x["text"] for x in good.collect()}
    failing = {i for i, t in before.items() if (q := plain.quality(t))[0] < 50 or 100 * q[4] > 50 * q[0]}
    assert good.columns == columns and not failing & set(kept) and all(before[i] == t for i, t in kept.items())
    assert len(kept) > 0.8 * (len(before) - len(failing))

    single = stages["shingles"](spark, good, SF).cache()
    want = {c for c, _ in plain.join(kept).values()}
    assert single.columns == columns and {x["doc_id"] for x in single.collect()} == want

    clean = stages["privacy"](spark, single, SF).cache()
    for x in clean.collect():
        assert x["n_chars"] == len(x["text"]) and not re.search(plain.BASE["email"], x["text"])
        if not plain.base_spans(kept[x["doc_id"]]) and "<CONTEXT>" not in x["text"]:
            assert x["text"] == kept[x["doc_id"]]
    assert clean.columns == columns and clean.count() == len(want)

    mixed = stages["mixing"](spark, clean, SF).cache()
    assert mixed.columns == columns and {x["doc_id"] for x in mixed.select("doc_id").distinct().collect()} <= want

    packed = stages["packing"](spark, mixed, SF).toPandas()
    assert (packed["start"] == 0).sum() == mixed.count()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


@pytest.mark.parametrize("rows", [10, 0])
def test_the_pipeline_over_odd_rows(spark, odd_documents, tmp_path, rows):
    long = " ".join(f"word{i} the of" for i in range(60))
    more = spark.createDataFrame([(50, long, "en", "a", None), (50, long, "en", "a", None), (51, long.upper(), None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd_documents.limit(rows)
    extra = [c for c in docs.columns if c not in more.columns]
    docs = docs.unionByName(more.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in extra])) if rows else docs
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    if not rows:
        assert not len(out)
        return
    assert set(out.doc_id) <= {50, 51} and 50 in set(out.doc_id)  # the others are too short
    assert out.groupby("sequence_id")["length"].sum().max() <= 1024
    once = out[out.doc_id == 50].drop_duplicates(["start", "length"])
    assert once["length"].sum() == once["doc_tokens"].iloc[0]


def test_entry_lists_everything(spark):
    q = __spark_entry__.queries()
    assert {int(k[2:].split("_")[0]) for k in q if re.match(r"op\d+_", k)} == set(range(1, 11)) and "pipeline" in q
    assert set(__spark_entry__.oracle_sql()) <= set(q)


def test_sql_twins(spark):
    import duckdb

    from outletry.llm import queries

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF)
        cols = sorted(df.columns)
        r = con.sql(sql)
        at = [r.columns.index(c) for c in cols]
        assert sorted(repr(tuple(x[c] for c in cols)) for x in df.collect()) == sorted(repr(tuple(x[i] for i in at)) for x in r.fetchall()), name
