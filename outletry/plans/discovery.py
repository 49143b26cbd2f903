"""From banks to the pages that are worth reading: sites chosen, links scored, the best kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletry.functions import url as U
from outletry.functions.text import name_tokens
from outletry.sources import fetch


def sites(hints: DataFrame, results: DataFrame, wiki: DataFrame, status: DataFrame) -> DataFrame:
    """(bank, url, source, verified): each bank's site, by its hint, search results or a list of banks.

    status: url, status of requests that were made for the candidates; those without one
    count as dead.
    """
    return fetch.website_choice(fetch.website_candidates(hints, results, wiki).join(status, "url", "left"))


def candidates(found: DataFrame, links: DataFrame) -> DataFrame:
    """Links (bank, url, anchor, ord) that may lead to outlets: bank, url, is_pdf, score, ord.

    found: bank, url of its site. A link counts if it is on the site's host or names a word of
    the bank, and below the site's path if that has one; PDFs from a score of 2 on.
    """
    s = found.select("bank", F.col("url").alias("site"), F.filter(name_tokens(F.col("bank")), lambda t: F.length(t) > 3).alias("words"))
    d = links.join(s, "bank").withColumns({"score": U.score_page(F.col("url"), F.col("anchor")), "is_pdf": U.is_pdf(F.col("url"))})
    fit = U.in_scope(F.col("url"), F.col("site"), F.col("words")) & (F.col("score") > F.when(F.col("is_pdf"), 1.999999).otherwise(0.0))
    return d.where(fit).select("bank", "url", "is_pdf", "score", "ord")


def discover(found: DataFrame, links: DataFrame, seeds: DataFrame, pages: int = 25, pdfs: int = 6) -> DataFrame:
    """(bank, url, is_pdf, ord): seeds in their order, then the best links; where a bank has neither, its site.

    found: bank, url; seeds: bank, url, ord.
    """
    best = fetch.top_pages(candidates(found, links), pages=pages, pdfs=pdfs).select("bank", "url", F.col("rank").alias("ord"))
    rows = fetch.seeds_first(seeds, best)
    alone = found.join(rows.select("bank").distinct(), "bank", "left_anti").select("bank", "url", F.lit(0).alias("ord"))
    return rows.unionByName(alone).withColumn("is_pdf", U.is_pdf(F.col("url")))
