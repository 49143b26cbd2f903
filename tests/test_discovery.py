import pytest
from pyspark.sql import functions as F

from outletry.functions import url as U
from outletry.operators import build, chain, registry
from outletry.plans import discovery
from outletry.sources import fetch, tables
from outletry.streaming import upserts


def test_discovery_composes_sites_links_and_seeds(spark):
    found = spark.createDataFrame([("Krishi Bank", "https://k.com/bd/"), ("Gulf Bank", "https://g.com"), ("Poor Bank", "https://p.com")], "bank string, url string")
    links = [("Krishi Bank", "https://k.com/bd/branch", "", 0), ("Krishi Bank", "https://k.com/uk/branch", "", 1), ("Krishi Bank", "https://k.com/bd/loan", "", 2), ("Krishi Bank", "https://else.com/branch", "", 3), ("Krishi Bank", "https://k.com/bd/branch-list.pdf", "", 4), ("Krishi Bank", "https://k.com/bd/address.pdf", "", 5)]
    links += [("Gulf Bank", f"https://g.com/{i}/branch", "", i) for i in range(30)] + [("Gulf Bank", "https://gulf-sister.com/branch-network", "", 40), ("Gulf Bank", "https://g.com/branch.pdf", "", 41)]
    links = spark.createDataFrame(links, "bank string, url string, anchor string, ord int")
    seeds = spark.createDataFrame([("Krishi Bank", "https://k.com/bd/seed", 0)], "bank string, url string, ord int")
    got = {}
    for r in discovery.discover(found, links, seeds, pages=5).orderBy("bank", "ord").collect():
        got.setdefault(r["bank"], []).append(r["url"])
    assert got["Krishi Bank"][0] == "https://k.com/bd/seed" and set(got["Krishi Bank"][1:]) == {"https://k.com/bd/branch", "https://k.com/bd/branch-list.pdf"}
    assert len(got["Gulf Bank"]) == 6 and "https://g.com/branch.pdf" in got["Gulf Bank"] and got["Gulf Bank"][1] == "https://gulf-sister.com/branch-network" and got["Poor Bank"] == ["https://p.com"]


def test_sites_are_chosen_by_their_answers(spark):
    hints = spark.createDataFrame([("a", "https://a.com")], "bank string, url string")
    results = spark.createDataFrame([("a", 0, 0, "https://a2.com", "x", 0.9), ("b", 0, 0, "https://b.com", "x", 0.9)], "bank string, engine_rank int, rank int, url string, source string, score double")
    wiki = spark.createDataFrame([("c", "https://c.com")], "bank string, url string")
    status = spark.createDataFrame([("https://a.com", 500), ("https://a2.com", 200), ("https://b.com", 200)], "url string, status int")
    got = {r["bank"]: (r["url"], r["verified"]) for r in discovery.sites(hints, results, wiki, status).collect()}
    assert got == {"a": ("https://a2.com", True), "b": ("https://b.com", True), "c": ("https://c.com", False)}


@pytest.mark.parametrize("url, scope, want", [("https://x.com/bd/a", "https://x.com/bd", True), ("https://x.com/bdx", "https://x.com/bd", False), ("https://x.com/bd", "https://x.com/bd", True), ("https://y.com/", "https://x.com", False), ("https://kris.com/a", "https://x.com", True)])
def test_scope(spark, url, scope, want):
    d = spark.createDataFrame([(url, scope, ["kris"])], "u string, s string, t array<string>")
    assert d.select(U.in_scope(F.col("u"), F.col("s"), F.col("t"))).first()[0] is want


def test_registry_rows_of_a_pdf(spark):
    cells = [("d", 1, 0, r, c, t) for r, row in enumerate([["Annex", "", ""], ["Bank Name", "Branch Name", "FI Branch ID"], ["Krishi  Bank", "Savar", "150002"], ["", "", ""], ["Krishi Bank", "Gulshan", "150001"]]) for c, t in enumerate(row)]
    d = spark.createDataFrame(cells, "doc string, page int, tbl int, row int, col int, text string")
    got = [(r["bank_name"], r["branch_name"], r["fi_branch_id"], r["routing"]) for r in build.geo_rows(tables.pdf_rows(d)).orderBy("ord").collect()]
    assert got == [("Krishi Bank", "Savar", "150002", ""), ("Krishi Bank", "Gulshan", "150001", "")]


def test_small_pieces(spark):
    d = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, n int, v string")
    assert {r["k"]: r["v"] for r in chain.first_by_key(d, ["k"], ["n", "v"]).collect()} == {"a": "y", "b": "z"}
    r = spark.createDataFrame([("G", "old", None, "1"), ("H", "keep", "u", None)], "name string, address string, url string, phone string")
    s = spark.createDataFrame([("G", "new", "v", ["2", "3"])], "name string, new_address string, new_url string, phones array<string>")
    assert {x["name"]: tuple(x)[1:] for x in registry.enrich(r, s).collect()} == {"G": ("new", "v", "2; 3"), "H": ("keep", "u", None)}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    store = str(tmp_path / "store")
    part = lambda rows: spark.createDataFrame([(b, None, m, s) for b, s, m in rows], "_bank string, bank_url string, method string, status string").selectExpr("*", *[f"cast(null as {f.split(' ', 1)[1]}) as {f.split()[0]}" for f in tables.PART.split(", ")[4:]])
    upserts.merge_results(spark, part([(f"b{i}", "success", "1") for i in range(40)]), store)
    before = upserts._versions(spark, store)
    upserts.merge_results(spark, part([("b3", "failed", "2"), ("b4", "success", "2"), ("new", "failed", "2")]), store)
    after = upserts._versions(spark, store)
    assert sum(before.get(b) != v for b, v in after.items()) <= 3
    got = {r["_bank"]: r["method"] for r in upserts.read_store(spark, store).collect()}
    assert len(got) == 41 and (got["b3"], got["b4"], got["new"]) == ("1", "2", "2")
    upserts.merge_results(spark, part([("b4", "success", "2")]), store)  # once more changes nothing
    assert {r["_bank"]: r["method"] for r in upserts.read_store(spark, store).collect()} == got


def test_failing_requests_are_reported(spark):
    def get(url):
        raise OSError("no network")

    assert [tuple(r) for r in fetch.read_pages(spark, ["u"], get, tries=3, back_off=0.0).collect()] == [("u", 0, "", "")]
