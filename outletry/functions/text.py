"""Text functions: Column to Column, all built in.

Blanks are Unicode blanks (scraped text is full of no-break spaces), so patterns
with ``\\s`` say ``(?U)`` here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import phrases, vocab


def text_of(c: Column) -> Column:
    """The string, null as empty."""
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_ws(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends; null as empty."""
    return F.btrim(F.regexp_replace(text_of(c), r"(?U)\s+", " "))


def slugify(c: Column, most: int = 80) -> Column:
    """A file name: lower-case letters and digits, other runs as one underscore."""
    slug = F.left(F.btrim(F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(most))
    return F.when(slug == "", "bank").otherwise(slug)


def squash(c: Column) -> Column:
    """Lower-case ASCII letters and digits alone."""
    return F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9]", "")


def bengali_squash(c: Column) -> Column:
    """As :func:`squash`, but Bengali letters stay, so that such names keep a key."""
    return F.regexp_replace(F.lower(text_of(c)), "[^a-z0-9ঀ-৿]", "")


def norm_key(c: Column, drop_parens: bool = True, stop: list[str] = vocab.STOP_WORDS) -> Column:
    """An organisation's matching key: its words without stop words (and bracketed parts)."""
    s = F.regexp_replace(text_of(c), r"\([^)]*\)", " ") if drop_parens else text_of(c)
    words = F.split(F.btrim(F.regexp_replace(F.lower(s), "[^a-z0-9ঀ-৿]+", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*stop)), " ")


def branch_key(c: Column) -> Column:
    """An outlet's matching key: without words for its type and legal form."""
    kind = r"(?<![a-z0-9_])(?:sub[\s-]*branch(?:es)?|branch(?:es)?|up[oa]sh[aeo]kha|plc|ltd|limited)(?![a-z0-9_])"
    s = F.regexp_replace(F.lower(text_of(c)), kind, " ")
    s = F.regexp_replace(s, r"উপ\s*শাখা|শাখা", " ")
    return F.btrim(F.regexp_replace(s, "[^a-z0-9ঀ-৿]+", " "))


def find_phones(c: Column, prefix: str = r"(?:\+?880|0)", digits: tuple[int, int] = (8, 12), separators: int = 1, length: tuple[int, int] = (9, 14)) -> Column:
    """Phone numbers in order, repeats included: a prefix, then digits with separators between."""
    pattern = rf"(?<![0-9]){prefix}(?:[\s().-]{{0,{separators}}}[0-9]){{{digits[0]},{digits[1]}}}(?![0-9])"
    found = F.transform(F.regexp_extract_all(text_of(c), F.lit(pattern), 0), lambda x: clean_ws(F.btrim(x, F.lit(" -.,;"))))
    return F.filter(found, lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")).between(*length))


def joined_phones(phones: Column, most: int = 120) -> Column:
    """Distinct numbers in order, by "; "."""
    return F.left(F.array_join(F.array_distinct(phones), "; "), F.lit(most))


def routing_in(c: Column) -> Column:
    """The number behind a routing label, or empty."""
    label = phrases.pattern("routing_[no|number]_[:|-]_")
    return F.regexp_extract(F.lower(text_of(c)), f"{label}([0-9]{{6,9}})", 3)


def classify_sub(name: Column, kind: Column, page_sub: Column) -> Column:
    """Whether an outlet is a sub-branch: its own marker first, then "branch", then the page."""
    t = F.lower(F.concat_ws(" ", text_of(kind), text_of(name)))
    plain = t.rlike("(^|[^a-z0-9_])branch($|[^a-z0-9_])")
    return F.when(t.rlike(vocab.SUB), True).when(plain, False).otherwise(F.coalesce(page_sub.cast("boolean"), F.lit(False)))


def name_tokens(c: Column, stop: list[str] = vocab.STOP_WORDS) -> Column:
    """Tokens that identify an organisation: words of three letters, capitals, bracketed short names."""
    s, low = text_of(c), F.lower(text_of(c))
    words = F.filter(F.regexp_extract_all(low, F.lit("[a-z0-9]{3,}"), 0), lambda w: ~w.isin(*stop))
    caps = F.filter(F.transform(F.regexp_extract_all(s, F.lit(r"(?<![A-Za-z0-9_])[A-Z]{2,5}(?=[\s(])"), 0), F.lower), lambda w: ~w.isin(*stop))
    inside = F.transform(F.regexp_extract_all(low, F.lit(r"\(([a-z0-9&.-]{2,8})\)"), 1), lambda w: F.regexp_replace(w, "[^a-z0-9]", ""))
    found = F.array_distinct(F.concat(words, F.filter(F.concat(caps, inside), lambda w: F.length(w) >= 2)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.left(F.regexp_replace(low, "[^a-z0-9]", ""), F.lit(6))))


def keyword_hits(c: Column, words: list[str] = vocab.ADDRESS_WORDS) -> Column:
    """How many of the words occur in the text."""
    low = F.lower(text_of(c))
    return F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w)))


def best_address_line(lines: Column, name: Column, words: list[str] = vocab.ADDRESS_WORDS) -> Column:
    """The line most like an address (first of equals): ten a keyword and its length, up to 60."""
    hits = lambda x: keyword_hits(x, words)
    fit = F.filter(lines, lambda x: (x != "") & (x != text_of(name)) & ~F.lower(x).rlike(vocab.whole(vocab.GENERIC_ADDRESSES)) & ((hits(x) > 0) | F.contains(F.lower(x), F.lit("routing number"))))
    scored = F.transform(fit, lambda x, i: F.struct((hits(x) * 10 + F.least(F.length(x), F.lit(60))).alias("score"), (-i).alias("at"), x.alias("line")))
    return F.array_max(scored)["line"]


def longest(lines: Column) -> Column:
    """The longest line, first of equals; null if none."""
    return F.array_max(F.transform(lines, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("at"), x.alias("line"))))["line"]


def _labels(words: list[str]) -> str:
    """A label that begins with one of the words, with its colon or dash."""
    return rf"(?i)(?<![a-z0-9_])({vocab.any_of(words)})[a-z0-9_]*\s*[:-]"


_NUMBER = r"^[0-9+()\[\]/.,\s-]{6,60}"


def _phone_parts(address: Column) -> Column:
    """An address cut at its phone labels: an array of (label, rest, number), the first without a label.

    number: the digits and marks that the rest begins with, if they are six characters or more.
    """
    a, label = text_of(address), _labels(vocab.PHONE_LABELS)
    found = F.concat(F.array(F.lit("")), F.regexp_extract_all(a, F.lit(label), 0))
    part = lambda x, y: F.struct(x.alias("label"), y.alias("rest"), F.when(x != "", F.regexp_extract(y, _NUMBER, 0)).otherwise("").alias("number"))
    return F.zip_with(found, F.split(a, label, -1), part)


def clean_address(address: Column) -> Column:
    """An address without markup, labels, e-mails and a labelled phone; generic ones become empty."""
    markup = F.regexp_replace(text_of(address), r"(?i)<br\s*/?>", " ")
    parts = _phone_parts(markup)
    at = F.array_position(F.transform(parts, lambda p: p["number"] != ""), True) - 1
    rest = lambda p, i: F.when(i == at, F.concat(F.lit(" "), F.substring(p["rest"], F.length(p["number"]) + 1, F.length(p["rest"])))).otherwise(F.concat(p["label"], p["rest"]))
    a = F.when(F.length(F.regexp_replace(labelled_phone(markup), "[^0-9]", "")) >= 6, F.array_join(F.transform(parts, rest), "")).otherwise(markup)
    region = F.lower(a).rlike(rf"^\s*({vocab.any_of(vocab.REGION_LABELS)})\s*[:-]")
    a = F.when(F.lower(a).rlike(vocab.whole(vocab.GENERIC_ADDRESSES)) | ~a.rlike("[A-Za-zঀ-৿]") | region, "").otherwise(a)
    a = F.regexp_replace(a, rf"(?i)^\s*({vocab.any_of(vocab.PLACE_LABELS)})\s*[:-]\s*", "")
    a = F.regexp_replace(a, r"(?i)[\s\[]*e?mail\s*protected[\s\]]*", "")
    a = F.regexp_replace(a, r"[^\s@,;:()]+\s*@\s*[^\s@,;:()]+\.[A-Za-z]{2,}\s*,?\s*", "")
    # A label at the end has lost its value.
    bare = F.rtrim(a, F.lit(" \t\n:-"))
    last = F.regexp_extract(bare, "[A-Za-z0-9_]+$", 0)
    label = F.lower(last).rlike(f"^({vocab.any_of(vocab.MAIL_LABELS + vocab.PHONE_LABELS)})")
    return clean_ws(F.when(label, F.rtrim(F.left(bare, F.length(bare) - F.length(last)), F.lit(" \t\n,;"))).otherwise(a))


def labelled_phone(address: Column) -> Column:
    """The number behind the first phone label in an address that has one, or empty."""
    numbers = F.filter(F.transform(_phone_parts(address), lambda p: F.regexp_replace(p["number"], r"^\s+", "")), lambda x: F.length(x) >= 6)
    return F.coalesce(F.get(numbers, 0), F.lit(""))


def salvaged_name(name: Column, address: Column) -> Column:
    """The name; where it is empty, what stands before "Branch" in the first part of the address that has it."""

    def before(letter: str, word: str) -> Column:
        heads = F.transform(F.split(text_of(address), ","), lambda x: F.btrim(F.right(F.regexp_extract(x, rf"^(.*?){word}", 1), F.lit(45))))
        return F.get(F.filter(F.transform(heads, lambda x: F.regexp_extract(x, f"{letter}.+", 0)), lambda x: x != ""), 0)

    latin, bengali = before("[A-Za-z]", r"\s[Bb]ranch(?![A-Za-z0-9_])"), before(vocab.BENGALI, "শাখা")
    found = F.coalesce(F.concat(latin, F.lit(" Branch")), F.concat(bengali, F.lit(" শাখা")), F.lit(""))
    return F.when(text_of(name) != "", text_of(name)).otherwise(found)


def unpair(c: Column) -> Column:
    """A word whose letters all come twice (a PDF's shadow glyphs), halved."""
    halves = F.array_join(F.filter(F.split(c, ""), lambda x, i: i % 2 == 0), "")
    return F.when((F.length(c) >= 4) & (F.length(c) % 2 == 0) & c.rlike(r"^(?:(.)\1)+$"), halves).otherwise(c)


def office_title(c: Column) -> Column:
    """An office's name in title case, every letter after a non-letter raised, 's kept, with " Branch"."""
    parts = F.regexp_extract_all(F.lower(text_of(c)), F.lit(r"[a-z]+|[^a-z]+"), 0)
    title = F.regexp_replace(F.array_join(F.transform(parts, F.initcap), ""), r"'S(?![A-Za-z])", "'s")
    return F.when(title.rlike("(?i)branch|head office"), title).otherwise(F.concat(title, F.lit(" Branch")))


def drop_media(phone: Column) -> Column:
    """A phone field without the media links that leak into it."""
    parts = F.filter(F.split(text_of(phone), ";"), lambda p: (F.btrim(p) != "") & ~F.contains(p, F.lit("http")) & ~F.contains(p, F.lit("/media")) & ~F.contains(F.lower(p), F.lit(".webp")))
    has = text_of(phone).rlike("http|/media|(?i:\\.webp)")
    return F.when(has, F.array_join(parts, "; ")).otherwise(text_of(phone))


def split_head(cell: Column) -> Column:
    """(head, rest) of a cell: its first line if short, else the part before the first comma."""
    lines = F.filter(F.transform(F.split(text_of(cell), "\n"), clean_ws), lambda x: x != "")
    flat = F.array_join(lines, " ")
    by_line = F.struct(F.rtrim(F.get(lines, 0), F.lit(",; -")).alias("head"), F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(0))), " ").alias("rest"))
    by_comma = F.struct(clean_ws(F.substring_index(flat, ",", 1)).alias("head"), clean_ws(F.regexp_replace(flat, "^[^,]*,", "")).alias("rest"))
    none = F.struct(F.lit("").alias("head"), F.lit("").alias("rest"))
    return F.when((F.size(lines) >= 2) & (F.length(F.get(lines, 0)) <= 60), by_line).when(F.contains(flat, F.lit(",")), by_comma).otherwise(none)


def markdown_text(c: Column) -> Column:
    """A markdown cell: links as their labels, no back-ticks or stars around."""
    return F.btrim(clean_ws(F.regexp_replace(text_of(c), r"\[([^\]]*)\]\(([^)\s]+)\)", "$1")), F.lit("`* "))


def strip_regions(tokens: Column, regions: list[str]) -> Column:
    """Tokens without the regions (districts, north, south) they begin with; one stays at least."""
    if not regions:
        return tokens
    first = F.get(F.filter(F.transform(tokens, lambda t, i: F.when(~t.isin(*regions), i)), lambda i: i.isNotNull()), 0)
    begin = F.coalesce(first, F.size(tokens) - 1)
    return F.when(F.size(tokens) > 1, F.slice(tokens, begin + 1, F.greatest(F.size(tokens), F.lit(1)))).otherwise(tokens)
