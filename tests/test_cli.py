"""The whole path that a user runs: a bank of each kind, kept successes, repair without loss."""

import json

import pytest

from outletry import __main__ as cli
from outletry.operators import store
from outletry.plans import directory
from outletry.sources import tables


def table(names, road="Lake Road"):
    rows = "".join(f"<tr><td>{n} Branch</td><td>{i} {road}</td><td>02-95512345{i}</td></tr>" for i, n in enumerate(names))
    return f"<table><tr><th>Branch Name</th><th>Address</th><th>Phone</th></tr>{rows}</table>"


REGISTRY = {
    "banks": {"krishi": {"bank_id": "15", "name": "Krishi", "alt_keys": [], "branch_count": 1}, "dead": {"bank_id": "77", "name": "Dead", "alt_keys": [], "branch_count": 3}},
    "branches": {"krishi": {"gulshan": {"fi_branch_id": "150001", "routing": "011111111", "name": "Gulshan", "district": ""}}, "dead": {"motijheel": {"fi_branch_id": "770001", "routing": "", "name": "MOTIJHEEL", "district": "DHAKA"}, "dhaka motijheel": {"fi_branch_id": "", "routing": "022222222", "name": "dhaka motijheel", "district": ""}}},
}


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "seeds.csv").write_text("bank_name,bank_url,branch_page_url,constituents,registry\nKrishi Bank,https://k.com,https://k.com/branches,,\nOther Bank,https://o.com,,,\nMerged Bank,https://m.com,,Krishi Bank;Other Bank,\nDead Bank,https://d.com,,,yes\nSilent Bank,https://s.com,,,\n")
    (tmp_path / "registry.json").write_text(json.dumps(REGISTRY))
    frame = "<p>x</p><iframe src='/branch-list-frame'></iframe>"
    pages = [(1, "Krishi Bank", "https://k.com/branches", table(["Gulshan", "Savar", "Mirpur"])), (2, "Krishi Bank", "https://k.com/z-branch", table(["Extra", "Extra Two", "Extra Three"])), (3, "Other Bank", "https://o.com/branch", frame)]
    spark.createDataFrame(pages, "page_id long, bank string, url string, html string").write.parquet(str(tmp_path / "pages"))
    more = [(10, "Other Bank", "https://o.com/branch-list-frame", table(["Gulshan", "Khulna", "Sylhet"])), (11, "Other Bank", "https://o.com/else", table(["No", "Never", "Not"]))]
    spark.createDataFrame(more, "page_id long, bank string, url string, html string").write.parquet(str(tmp_path / "more"))
    return tmp_path


def parts(spark, place):
    return {r["_bank"]: r.asDict(recursive=True) for r in tables.read_parts(spark, f"{place}/parts/*/*.json").collect()}


def names(part):
    return [k for e in part["branch"] for k in e]


def test_a_bank_of_each_kind(spark, place):
    base = ["--csv", f"{place}/seeds.csv", "--pages", f"{place}/pages", "--more-pages", f"{place}/more", "--registry", f"{place}/registry.json", "--parts", f"{place}/parts", "--out", f"{place}/all.json"]
    assert cli.main([*base, "--max-pages", "1"]) == 0
    got = parts(spark, place)
    assert names(got["Krishi Bank"]) == ["Gulshan Branch", "Savar Branch", "Mirpur Branch"]  # one page: its seed
    assert names(got["Other Bank"]) == ["Gulshan Branch", "Khulna Branch", "Sylhet Branch"]  # from the frame alone
    assert got["Krishi Bank"]["branch"][0] == {"Gulshan Branch": ["0 Lake Road", None, "02-955123450", "150001", "011111111"]}
    dead = got["Dead Bank"]
    assert (dead["method"], dead["status"], dead["bank_id"], dead["branch"]) == ("registry", "success", "77", [{"Motijheel Branch": ["Dhaka", None, None, "770001", "022222222"]}])
    assert got["Silent Bank"]["status"] == got["Merged Bank"]["status"] == "failed" and got["Silent Bank"]["error"]
    # Now the merged bank's constituents are there; those that succeeded aren't done again.
    assert cli.main([*base, "--resume"]) == 0
    got = parts(spark, place)
    merged = got["Merged Bank"]
    assert (merged["method"], merged["constituents"], merged["merged_duplicates"], merged["total_branch"]) == ("merged-constituents", ["Krishi Bank", "Other Bank"], 1, 5)
    assert merged["branch"][0] == {"Gulshan Branch": ["0 Lake Road", None, "02-955123450", "150001", "011111111"]}
    (doc,) = (json.loads(r["value"]) for r in spark.read.text(f"{place}/all.json").collect())
    assert set(doc) == set(got) and doc["Merged Bank"]["total_branch"] == 5
    assert (place / "all.json.bak").exists()
    # A run that finds nothing keeps what succeeded.
    spark.createDataFrame([], "page_id long, bank string, url string, html string").write.parquet(f"{place}/none")
    assert cli.main([*["--csv", f"{place}/seeds.csv", "--pages", f"{place}/none", "--registry", f"{place}/registry.json", "--parts", f"{place}/parts"], "--bank", "krishi bank"]) == 0
    assert parts(spark, place)["Krishi Bank"]["status"] == "success"


def test_repair_keeps_what_it_does_not_touch(spark, place):
    old = [
        {"_bank": "M", "bank_url": "u", "method": "merged-constituents", "status": "success", "bank_id": None, "total_branch": 2, "total_sub_branch": 0, "error": None, "constituents": ["a", "b"], "merged_duplicates": 4, "branch": [{"Gulshan Branch": ["1 Road", None, None, "1", "2"]}, {"Branch Name": ["x", None, None, None, None]}], "sub_branch": []},
        {"_bank": "Krishi Bank", "bank_url": "u", "method": "html_table", "status": "success", "bank_id": "15", "branch": [{"Savar Branch": ["1 Road", None, None, None, None]}], "sub_branch": [], "total_branch": 1, "total_sub_branch": 0},
        {"_bank": "Old", "status": "success", "method": "x", "branch": [{"Gulshan Branch": {"address": "2 Road", "url": "http://p", "phone": "1"}}, {"name": "Savar Branch", "address": "3 Road"}, {"Mirpur Branch": ["4 Road"]}], "sub_branch": []},
        {"_bank": "Lost", "status": "failed", "error": "no records", "total_branch": 0, "total_sub_branch": 0, "branch": [], "sub_branch": []},
    ]
    for i, p in enumerate(old):
        (place / "parts" / f"slug={i}").mkdir(parents=True)
        (place / "parts" / f"slug={i}" / "x.json").write_text(json.dumps(p))
    before = parts(spark, place)
    assert before["Old"]["branch"] == [{"Gulshan Branch": ["2 Road", "http://p", "1", None, None]}, {"Savar Branch": ["3 Road", None, None, None, None]}, {"Mirpur Branch": ["4 Road", None, None, None, None]}]
    assert cli.main(["--upgrade-parts", "--dry-run", "--parts", f"{place}/parts", "--registry", f"{place}/registry.json"]) == 0
    assert parts(spark, place) == before
    all_ = stage_names(spark, place)
    assert cli.main(["--upgrade-parts", "--parts", f"{place}/parts", "--registry", f"{place}/registry.json"]) == 0
    changed = {d for d in stage_names(spark, place) if d not in all_}
    assert changed == {"slug=m", "slug=old"}  # what stayed the same isn't written
    m = json.loads(next((place / "parts" / "slug=m").glob("*.json")).read_text())
    assert (m["constituents"], m["merged_duplicates"], m["total_branch"], names(m)) == (["a", "b"], 4, 1, ["Gulshan Branch"])


def stage_names(spark, place):
    return {p.name for p in (place / "parts").iterdir() if p.is_dir()}


def test_a_failing_extractor_is_noted_and_left_out(spark, monkeypatch):
    def broken(elements, pages):
        raise ValueError("broken")

    monkeypatch.setitem(directory.EXTRACTORS, "html_cards", broken)
    pages = spark.createDataFrame([(1, "A", "https://k.com/branches", table(["Gulshan", "Savar", "Mirpur"]))], "page_id long, bank string, url string, html string")
    failures: list = []
    assert directory.extracted(pages, None, failures).count() == 3 and failures == [("html_cards", "broken")]
    with pytest.raises(ValueError):
        directory.extracted(pages)


def test_audit_has_a_total(spark):
    p = spark.createDataFrame([("A", "success"), ("B", "failed")], "_bank string, status string")
    r = spark.createDataFrame([("A", False, "x Branch", ""), ("A", True, "y", "1 Road")], "bank string, is_sub boolean, name string, address string")
    t = store.audit_total(store.audit(p, r, spark.createDataFrame([], "ord int, key string, branches int, subs int"))).first()
    assert (t["banks"], t["branches"], t["subs"], t["failed"], t["without_addresses"]) == (2, 1, 1, 1, 1)
