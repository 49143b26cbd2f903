import pytest
from pyspark.sql import functions as F

from outletry.functions import predicates as P
from outletry.functions import similarity as S
from outletry.functions import text as T
from outletry.functions import url as U


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


TEXT = [
    (T.clean_ws, "  a \t b\n", "a b"), (T.clean_ws, None, ""), (T.slugify, "Citibank N.A.", "citibank_n_a"), (T.slugify, "!!!", "bank"), (T.norm_key, "Citibank N.A.", "citibank n a"),
    (T.norm_key, "Bangladesh Krishi Bank (BKB)", "krishi"), (lambda c: T.norm_key(c, False), "Bangladesh Krishi Bank (BKB)", "krishi bkb"), (T.branch_key, "AGRABAD BRANCH", "agrabad"),
    (T.branch_key, "Agrabad Sub-Branch", "agrabad"), (T.branch_key, "আগ্রাবাদ শাখা", T), (T.find_phones, "Tel: 02-334431574, +880 1711-123456; 99", ["02-334431574", "+880 1711-123456"]),
    (T.find_phones, "123456789012345678", []), (T.unpair, "dduuttcchh", "dutch"), (T.unpair, "abab", "abab"), (T.office_title, "cox's bazar", "Cox's Bazar Branch"), (T.office_title, "HEAD OFFICE", "Head Office"),
    (T.routing_in, "Routing No: 012345678.", "012345678"), (T.routing_in, "Routing 12", ""), (T.drop_media, "0171; http://x/y ; /media/a", "0171"), (T.markdown_text, "**[Gulshan](http://x)**", "Gulshan"),
    (T.clean_address, "Address: 29 Dilkusha C/A, Email: a@b.com", "29 Dilkusha C/A"), (T.clean_address, "District", ""), (T.clean_address, "Division: Dhaka", ""), (T.clean_address, "12<br/>Road, Phone: 02-9551234", "12 Road,"),
    (T.labelled_phone, "x Cell: 01678 433 101", "01678 433 101"), (T.name_tokens, "Export Import (EXIM) Bank", ["export", "import", "exim"]), (T.squash, "Cox's-Bazar", "coxsbazar"),
]


@pytest.mark.parametrize("f, value, want", [t for t in TEXT if t[2] is not T])
def test_text(spark, f, value, want):
    assert one(spark, f(F.col("a")), a=value) == want


def test_best_address_line(spark):
    lines = ["Dhaka", "Gulshan Branch", "House 3, Road 7, Block F, Banani", "x"]
    assert one(spark, T.best_address_line(F.col("a"), F.col("n")), a=lines, n="Gulshan Branch") == lines[2]
    assert one(spark, T.best_address_line(F.col("a"), F.col("n")), a=["nothing"], n="") is None
    assert one(spark, T.longest(F.col("a")), a=["ab", "cd", "x"]) == "ab"


@pytest.mark.parametrize("name, kind, page, want", [("Subornochor branch", "", False, False), ("Gulshan Uposhakha", "", False, True), ("Motijheel", "", True, True), ("Motijheel Branch", "", True, False), ("X", "Sub Branch", False, True), ("X SUB BANCH", "", False, True), ("উপশাখা ঢাকা", "", False, True)])
def test_classify_sub(spark, name, kind, page, want):
    assert one(spark, T.classify_sub(F.col("n"), F.col("k"), F.col("p")), n=name, k=kind, p=page) is want


NAMES = [
    (P.is_booth, "Gulshan Branch ATM", True), (P.is_booth, "Atmaram Branch", False), (P.is_news, "AB Bank opened its 101st Branch", True), (P.is_news, "Opera House Branch", False), (P.is_generic_name, "Branch Name", True),
    (P.is_generic_name, "https://x/?page=3", True), (P.is_generic_name, "Gulshan Branch", False), (P.is_generic_name, "branch address:", True), (P.is_premises, "Ranu Plaza Holding No.136", True), (P.is_premises, "3rd Floor", True),
    (P.is_premises, "Shapla Branch", False), (P.is_promo, "Eid Offers", True), (P.is_promo, "Officers Branch", False), (P.is_digits, "12/34", True), (P.is_digits, "০২", True), (P.is_digits, "a1", False), (P.is_latin, "শাখা", False),
    (P.is_latin, "শাখা x", True), (P.is_sub_line, "ASAMPARA SUB BRANCH", True), (P.is_sub_line, "Sub Branch", False), (P.is_junk_part_name, "Banani Road No 11 Branch", False), (P.is_junk_part_name, "Holding No 4 Branch", True),
    (P.is_junk_part_name, "Bank smarter,", True), (P.is_non_branch_page, "https://x/branch-and-atm/", False), (P.is_non_branch_page, "https://x/atm_location", True), (P.is_coordinates, "23.7, 90.4", True), (P.is_generic_address, "Dhaka", True),
]


@pytest.mark.parametrize("f, value, want", NAMES)
def test_predicates(spark, f, value, want):
    assert one(spark, f(F.col("a")), a=value) is want


def test_records_that_stay(spark):
    keep = lambda n, a="", p="", u="": one(spark, P.keeps_record(F.col("n"), F.col("a"), F.col("p"), F.col("u")), n=n, a=a, p=p, u=u)
    assert keep("Gulshan Branch") and keep("Gulshan", "12 Lake Road") and keep("Gulshan", p="02-1") and not keep("Gulshan") and not keep("Bank smarter,", "x") and not keep("X Branch", "booth corner") and not keep("")


def test_blocked_pages(spark):
    b = lambda h, n: spark.createDataFrame([(h, n)], "h string, n int").select(P.looks_blocked(F.col("h"), F.col("n"))).first()[0]
    assert b("<title>Just a moment...</title>", 9000) and b("<script src='/cdn/challenge-platform/x'>", 10) and not b("<script src='/cdn/challenge-platform/x'>", 9000) and not b("<title>Branches</title>" + " " * 6000 + "captcha", 10)


def test_branch_lists(spark):
    f = lambda keys: spark.createDataFrame([(keys,)], "k array<array<string>>").select(P.is_branch_list(F.col("k"))).first()[0]
    assert f([["name", "address"], ["name", "phone"]]) and not f([["name", "url"], ["name", "url"]]) and not f([["address"]]) and not f([["address"], ["address"], None, None])


URLS = [
    (lambda a: U.domain_of(a), "HTTPS://WWW.Bank.com.bd:8080/x", "bank.com.bd:8080"), (lambda a: U.domain_of(a), None, ""), (lambda a: U.scope_of(a), "https://x.com/bd/en/", "https://x.com/bd/en"), (lambda a: U.scope_of(a), "https://x.com/", ""),
    (lambda a: U.is_pdf(a), "http://x/a.PDF?x=1", True), (lambda a: U.page_number(a, F.lit(3)), "http://x/a?b=1#c", "http://x/a?b=1&page=3"), (lambda a: U.page_is_sub(a), "http://x/sub-branches", True), (lambda a: U.is_aggregator(a), "m.facebook.com", True),
]


@pytest.mark.parametrize("f, value, want", URLS)
def test_urls(spark, f, value, want):
    assert one(spark, f(F.col("a")), a=value) == want


@pytest.mark.parametrize("href, want", [("/a", "http://x.com/a"), ("b/c", "http://x.com/d/b/c"), ("../q", "http://x.com/q"), ("//y.com/z", "http://y.com/z"), ("https://z.com/1", "https://z.com/1"), ("#t", ""), ("mailto:a@b", ""), ("", ""), ("?p=2", "http://x.com/d/e?p=2"), ("/a/../b", "http://x.com/b")])
def test_absolutize(spark, href, want):
    assert one(spark, U.absolutize(F.col("h"), F.col("b")), h=href, b="http://x.com/d/e") == want


def test_page_scores(spark):
    s = lambda u, a="": one(spark, U.score_page(F.col("u"), F.col("a")), u=u, a=a)
    assert s("http://x/branch") == 2.5 and s("http://x/sub-branch") == 6.5 and s("http://x/p", "Branch network") == pytest.approx(0.8 * 4.3) and s("http://x/loan") == -1 and s("http://x/a.jpg") == -1
    assert s("http://x/branch-" + "z" * 50) == pytest.approx(0.5) and s("http://x/launch-branch") == pytest.approx(1.0) and s("http://x/atm-list") < 0


def test_domain_score(spark):
    f = lambda d, t: one(spark, U.domain_score(F.col("d"), F.col("t")), d=d, t=t)
    assert f("export-import.com.bd", ["export", "import"]) == 1.0 and f("exim.com", ["exim", "other"]) == 0.5 and f("", ["a"]) == 0.0


def test_similarities(spark):
    two = lambda f, a, b: one(spark, f(F.col("a"), F.col("b")), a=a, b=b)
    assert two(S.edit_ratio, "zigatoalbranch", "zigatolabranch") == pytest.approx(1 - 2 / 14) and two(S.edit_ratio, "a", "abcdefghij") == 0.0
    assert one(spark, S.trigrams(F.col("a")), a="Ab-cd") == ["abc", "bcd"] and one(spark, S.trigrams(F.col("a")), a="x") == ["x"]
    assert two(S.text_similarity, "Hossain Tower, 75 Greenroad", "75 greenroad hossain tower") == 1.0
    assert two(S.fuzzy_subset, "Nawabgonj Dhaka", "Puraton Nawabganj, Dhaka") and not two(S.fuzzy_subset, "Sylhet Sadar", "Dhaka North")
    assert two(S.addresses_agree, "", "x") and two(S.addresses_agree, "12 Lake Road", "12 Lake Road, Dhaka") and not two(S.addresses_agree, "Sylhet Sadar", "Dhaka North")
    assert two(S.sequence_ratio, "agrabad", "agrabad chattogram") == pytest.approx(0.56)
