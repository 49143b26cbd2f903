"""Predicates on names, addresses, URLs and pages: Column to boolean Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import phrases, vocab
from .text import find_phones, keyword_hits, text_of


def _low(c: Column) -> Column:
    return F.lower(text_of(c))


def is_sub(c: Column) -> Column:
    return _low(c).rlike(vocab.SUB)


def is_sub_loose(c: Column) -> Column:
    return _low(c).rlike(vocab.SUB_LOOSE)


def is_sub_line(c: Column) -> Column:
    """A line that names a sub-branch, not the bare marker: three characters without a divider stand before it."""
    n = _low(c)
    head = F.concat(F.left(n, F.lit(1)), F.regexp_extract(F.substring(n, 2, 1 << 30), "^[^,;|:]*", 0))
    return ~n.rlike(r"^(\s|$)") & head.rlike(f"^...*{vocab.SUB_ENDS}")


def is_branch(c: Column) -> Column:
    return _low(c).rlike(vocab.BRANCH)


def is_booth(c: Column, signs: list[str] = vocab.BOOTH_SIGNS) -> Column:
    return _low(c).rlike(f"(^|[^a-z0-9])({phrases.anywhere(signs)})($|[^a-z0-9])")


def is_news(c: Column) -> Column:
    """A headline: what banks do, never what an outlet is called."""
    return _low(c).rlike(phrases.worded(vocab.NEWS))


def is_generic_name(c: Column) -> Column:
    """A header, label or heading in place of a name."""
    return F.rtrim(_low(c), F.lit(" :;,.|-")).rlike(phrases.whole(vocab.GENERIC))


def is_premises(c: Column) -> Column:
    return _low(c).rlike(vocab.PREMISES)


def is_promo(c: Column) -> Column:
    return _low(c).rlike(phrases.worded(vocab.PROMOS))


def is_generic_address(c: Column) -> Column:
    return _low(c).rlike(vocab.whole(vocab.GENERIC_ADDRESSES))


def is_latin(c: Column) -> Column:
    """Has a Latin letter, or no Bengali one."""
    return _low(c).rlike("[a-z]") | ~text_of(c).rlike(vocab.BENGALI)


def is_digits(c: Column) -> Column:
    """Digits and punctuation alone."""
    return text_of(c).rlike(r"(?U)^[\d\W]+$")


def is_coordinates(c: Column) -> Column:
    return text_of(c).rlike(r"^[0-9.,\s-]+$")


def has_address_word(c: Column, words: list[str] = vocab.ADDRESS_WORDS) -> Column:
    return keyword_hits(c, words) > 0


def is_junk_name(c: Column) -> Column:
    """Any of the reasons why a name names no outlet."""
    return is_booth(c) | is_news(c) | is_generic_name(c) | is_premises(c) | is_promo(c) | is_digits(c) | (F.btrim(text_of(c)) == "")


def is_junk_part_name(c: Column) -> Column:
    """The rule for stored parts: roads and floors are forgiven in a name with "branch"."""
    n = F.btrim(text_of(c))
    hard = _low(c).rlike(phrases.begun(vocab.PLOT_FORMS))
    premises = is_premises(n) & (~is_branch(n) | hard)
    return n.rlike("[,;]$") | is_booth(n) | is_news(n) | is_generic_name(n) | premises | is_promo(n) | is_digits(n) | (n == "")


def is_bare(name: Column, address: Column, phone: Column, url: Column, words: list[str] = vocab.ADDRESS_WORDS) -> Column:
    """No marker in the name, no phone, no link, and nothing like an address."""
    n, a = F.btrim(text_of(name)), F.btrim(text_of(address))
    return ~is_branch(n) & ~is_sub(n) & (F.btrim(text_of(phone)) == "") & (F.btrim(text_of(url)) == "") & ~(has_address_word(a, words) | (F.length(a) >= 40))


def keeps_record(name: Column, address: Column, phone: Column, url: Column, words: list[str] = vocab.ADDRESS_WORDS) -> Column:
    """Whether a record may be an outlet: no junk name, and some sign of a place."""
    n, a = F.btrim(text_of(name)), F.btrim(text_of(address))
    sliced = n.rlike("[,;]$") & (F.size(find_phones(a)) == 0)
    kiosk = (a != "") & (F.length(a) <= 60) & _low(a).rlike(vocab.bounded(["booth", "kiosk"]))
    return ~(is_junk_name(n) | sliced | kiosk | is_bare(name, address, phone, url, words))


def looks_blocked(html: Column, text_length: Column) -> Column:
    """An anti-robot page: by its title, its head, or a challenge script on a short page."""
    title = _low(F.regexp_extract(F.left(text_of(html), F.lit(4096)), r"(?is)<title[^>]*>(.*?)</title>", 1))
    head = F.lower(F.left(text_of(html), F.lit(5000)))
    phrase = vocab.any_of(vocab.BLOCK_PHRASES)
    return title.rlike(phrase) | F.contains(title, F.lit("captcha")) | head.rlike(phrase) | ((text_length < 800) & head.rlike(vocab.any_of(vocab.CHALLENGES)))


def is_non_branch_feed(c: Column) -> Column:
    return _low(c).rlike(vocab.bounded(vocab.NON_BRANCH_FEEDS))


def is_non_branch_page(url: Column) -> Column:
    """A path segment names a list of booths or agents, and the same one no branches."""
    path = F.regexp_extract(_low(url), r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.exists(F.split(path, "/"), lambda s: s.rlike(vocab.bounded(vocab.NON_BRANCH_PAGES)) & ~s.rlike(vocab.any_of(vocab.BRANCH_SEGMENTS)))


def is_branch_list(keys: Column) -> Column:
    """Whether records (an array of their keys' arrays, null for what is no record) are a list of branches."""
    records = F.filter(keys, lambda k: k.isNotNull())
    sample = F.slice(records, 1, 20)
    hits = F.size(F.filter(sample, lambda k: F.lower(F.array_join(k, " ")).rlike(vocab.any_of(vocab.LIST_KEYS))))
    return (F.size(records) >= 2) & (F.size(records) >= 0.6 * F.size(keys)) & (hits >= F.greatest(F.lit(2), F.floor(0.4 * F.size(sample))))
