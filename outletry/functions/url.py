"""URL functions: Column to Column."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import vocab
from .text import text_of


def domain_of(url: Column) -> Column:
    """The authority in lower case, with its port, without a leading www."""
    net = F.lower(F.regexp_extract(F.btrim(text_of(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(net, r"^www\.", "")


def is_followable(href: Column) -> Column:
    """A link that leads to a page."""
    return (F.btrim(text_of(href)) != "") & ~F.btrim(text_of(href)).rlike("^(javascript:|tel:|mailto:|data:|#)")


@F.pandas_udf(StringType())
def _join(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b: str, h: str) -> str:
        try:
            return urljoin(b, h)
        except ValueError:
            return ""

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)])


def absolutize(href: Column, base: Column) -> Column:
    """The link resolved against its page (RFC 3986), empty if it leads to none.

    Absolute and root-relative links, nearly all, never leave the JVM.
    """
    h, b = F.btrim(text_of(href)), text_of(base)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    plain = ~F.contains(h, F.lit("/.")) & ~F.contains(h, F.lit("//"))
    return F.when(~is_followable(href), "").when(h.rlike("^[a-z][a-z0-9+.-]*://[^/?#]+(/|$)") & ~F.contains(h, F.lit("/.")), h).when(h.startswith("/") & plain & (origin != ""), F.concat(origin, h)).otherwise(_join(b, h))


def root_relative(href: Column, base: Column) -> Column:
    """:func:`absolutize` for sites whose links are absolute or root-relative: built in alone."""
    h = F.btrim(text_of(href))
    origin = F.regexp_extract(text_of(base), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.when(~is_followable(href), "").when(h.startswith("/"), F.concat(origin, h)).otherwise(h)


def domain_score(domain: Column, tokens: Column) -> Column:
    """The share of tokens in the domain's first label, and a tenth for the country."""
    fit = F.filter(tokens, lambda t: F.length(t) >= 2)
    label = F.replace(F.substring_index(domain, ".", 1), F.lit("-"), F.lit(""))
    hits = F.size(F.filter(fit, lambda t: F.contains(label, t)))
    score = hits / F.greatest(F.size(fit), F.lit(1)) + F.when(domain.endswith(".bd"), 0.1).otherwise(0.0)
    return F.when((text_of(domain) == "") | (F.size(fit) <= 0), 0.0).otherwise(F.least(score, F.lit(1.0)))


def score_page(url: Column, anchor: Column, weights: list[tuple[str, str, float]] = vocab.URL_WEIGHTS) -> Column:
    """How likely a link leads to a list of branches; -1 for what never does.

    An article's penalty comes before the discount of a long last segment, which so
    shrinks it as well.
    """
    u, a = F.lower(F.coalesce(F.try_url_decode(F.replace(text_of(url), F.lit("+"), F.lit("%2B"))), text_of(url))), F.lower(text_of(anchor))
    never = u.rlike(rf"\.({vocab.any_of(vocab.MEDIA_EXTENSIONS)})($|\?)")
    other = u.rlike(vocab.any_of(vocab.OTHER_PAGES + vocab.NEWS_EVENTS)) & ~u.rlike("branch|শাখা|uposhakha")
    score = F.lit(0.0)
    for _, pattern, w in weights:
        score = score + F.when(u.rlike(pattern), w).when(a.rlike(pattern), w * 0.8).otherwise(0.0)
    score = score - F.when(u.rlike(vocab.any_of(vocab.NEWS_EVENTS + vocab.NEWS_MORE)), 1.5).otherwise(0.0)
    last = F.substring_index(F.rtrim(u, F.lit("/")), "/", -1)
    return F.when(never | other, -1.0).otherwise(F.round(score * F.when(F.length(last) > 40, 0.2).otherwise(1.0), 6))  # so that equal sums tie


def is_aggregator(domain: Column, names: list[str] = vocab.AGGREGATORS) -> Column:
    return text_of(domain).rlike(vocab.any_of(names))


def is_pdf(url: Column) -> Column:
    return F.lower(F.regexp_replace(text_of(url), "[?#].*$", "")).endswith(".pdf")


def page_is_sub(url: Column) -> Column:
    return F.lower(text_of(url)).rlike(r"sub[\s_+~-]*branch|up[oa][\s_+~-]*sha[\s_+~-]*kha|উপশাখা")


def scope_of(url: Column) -> Column:
    """A microsite's prefix: scheme, host and path without the last slash; empty for a bare host."""
    m = lambda i: F.regexp_extract(text_of(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)", i)
    path = F.rtrim(m(2), F.lit("/"))
    return F.when(path == "", "").otherwise(F.concat(m(1), path))


def in_scope(url: Column, site: Column, tokens: Column) -> Column:
    """http(s), of the site's domain or naming it, and inside the microsite's path."""
    dom = domain_of(url)
    near = (dom == domain_of(site)) | F.exists(tokens, lambda t: F.contains(dom, t) | F.contains(F.lower(text_of(url)), t))
    scope = scope_of(site)
    return text_of(url).rlike("^https?://") & near & ((scope == "") | (text_of(url) == scope) | text_of(url).startswith(F.concat(scope, F.lit("/"))))


def page_number(url: Column, n: Column) -> Column:
    """The URL of a listing's page n."""
    bare = F.regexp_replace(text_of(url), "#.*$", "")
    return F.concat(bare, F.when(F.contains(bare, F.lit("?")), "&page=").otherwise("?page="), n.cast("string"))
