"""Fetched pages: a data source with an injectable transport, and the rules around it.

The rules are Columns over recorded responses, so they run and are tested without a
network. TLS is always verified, and no anti-robot measure is worked around: a blocked
page is reported as blocked.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from outletry.functions import predicates
from outletry.functions.text import text_of

SCHEMA = "url string, status int, content_type string, body string"


class _Chunk(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(None)
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, urls: list[str], get: Callable, tries: int, size: int, pause: float, back_off: float):
        self.urls, self.get, self.tries, self.size, self.pause, self.back_off = urls, get, tries, size, pause, back_off

    def partitions(self) -> list[_Chunk]:
        return [_Chunk(self.urls[i : i + self.size]) for i in range(0, len(self.urls), self.size)] or [_Chunk([])]

    def read(self, partition: _Chunk) -> Iterator[tuple]:
        for url in partition.urls:
            for k in range(self.tries):
                if self.pause:
                    time.sleep(max(0.2, self.pause) * random.uniform(0.7, 1.3))
                try:
                    status, kind, body = self.get(url)
                except OSError:
                    status, kind, body = 0, "", ""
                if status and status < 500 and status != 429 or k == self.tries - 1:
                    yield url, status, kind, body
                    break
                time.sleep(self.back_off * (k + 1))


def read_pages(spark: SparkSession, urls: list[str], get: Callable[[str], tuple[int, str, str]], tries: int = 2, chunk: int = 50, pause: float = 0.0, back_off: float = 1.5) -> DataFrame:
    """Fetch URLs in parallel by a transport: a function of a URL to (status, content type, body).

    The transport is shipped to the workers; errors, 429 and 5xx are tried again. pause:
    seconds before each request, more or less; back_off: seconds after a failure, times
    the failures so far.
    """

    class PageSource(DataSource):  # local, so that it takes the transport along
        @classmethod
        def name(cls) -> str:
            return "outlet_pages"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> _Reader:
            return _Reader(urls, get, tries, chunk, pause, back_off)

    spark.dataSource.register(PageSource)
    return spark.read.format("outlet_pages").load()


def retry_class(status: Column) -> Column:
    """What a response of the rendering service calls for."""
    return F.when(status == 200, "use").when(status == 429, "wait").when(status.isin(402, 403), "disable").when(status >= 500, "retry_once").otherwise("give_up")


def fetch_decision(status: Column, content_type: Column, body: Column, text_length: Column) -> Column:
    """local_json, local_html, render (a shell of scripts, or blocked) or http_<status>."""
    kind, b = F.lower(text_of(content_type)), text_of(body)
    scripts = F.size(F.split(F.lower(b), "<script")) - 1
    fine = (kind.rlike("html|text") | (kind == "")) & ~predicates.looks_blocked(b, text_length) & ((text_length >= 500) | (scripts <= 3))
    return F.when(status.isNull() | (status != 200), F.concat(F.lit("http_"), F.coalesce(F.nullif(status, F.lit(0)).cast("string"), F.lit("error")))).when(F.contains(kind, F.lit("json")) & F.ltrim(b).rlike(r"^[\[{]"), "local_json").when(fine, "local_html").otherwise("render")


def visible_length(html: Column) -> Column:
    """Code points of a page's text without scripts, styles and tags, blanks folded."""
    bare = F.regexp_replace(text_of(html), r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->", " ")
    return F.length(F.btrim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\s+", " ")))


def top_pages(scored: DataFrame, key: str = "bank", least: float = 1.2, pages: int = 25, pdfs: int = 6) -> DataFrame:
    """(key, url, is_pdf, score, rank): each URL by its best score, the best of either kind.

    scored: key, url, is_pdf, score, ord; ties keep their order.
    """
    best = scored.groupBy(key, "url", "is_pdf").agg(F.max("score").alias("score"), F.min("ord").alias("ord"))
    fit = best.where(F.col("is_pdf") & (F.col("score") >= 2.0) | ~F.col("is_pdf") & (F.col("score") >= least))
    by = Window.partitionBy(key, "is_pdf").orderBy(F.desc("score"), "ord", "url")
    return fit.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= F.when(F.col("is_pdf"), pdfs).otherwise(pages)).drop("ord")


def seeds_first(seeds: DataFrame, found: DataFrame, key: str = "bank") -> DataFrame:
    """Seeds in their order, then found pages that are no seeds: (key, url, ord)."""
    rows = seeds.select(key, "url", F.lit(0).alias("wave"), "ord").unionByName(found.select(key, "url", F.lit(1).alias("wave"), "ord"))
    first = rows.groupBy(key, "url").agg(F.min(F.struct("wave", "ord")).alias("at"))
    return first.select(key, "url", (F.row_number().over(Window.partitionBy(key).orderBy("at", "url")) - 1).alias("ord"))


def official_site(results: DataFrame, tokens: DataFrame, key: str = "bank", least: float = 0.3) -> DataFrame:
    """Each bank's best search result (key, url, score) by domain; aggregators never."""
    from outletry.functions import url as U

    r = results.join(tokens, key).withColumn("domain", U.domain_of(F.col("url"))).where(~U.is_aggregator(F.col("domain")))
    r = r.withColumn("score", U.domain_score(F.col("domain"), F.col("tokens"))).where(F.col("score") >= least)
    return r.groupBy(key).agg(F.max_by("url", F.struct("score", -F.col("rank"))).alias("url"), F.max("score").alias("score"))


def wiki_match(banks: DataFrame, wiki: DataFrame, least: float = 0.6) -> DataFrame:
    """(bank, tokens) and (name, url, tokens): the page that has the largest share of a bank's tokens."""
    b = banks.select("bank", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    w = wiki.select("name", "url", F.explode("tokens").alias("token"))
    hits = b.join(w, "token").groupBy("bank", "n", "name", "url").agg(F.count_distinct("token").alias("k"))
    hits = hits.withColumn("share", F.col("k") / F.col("n")).where(F.col("share") >= least)
    return hits.groupBy("bank").agg(F.max_by(F.struct("name", "url", "share"), F.struct("share", "name")).alias("m")).select("bank", "m.*")


def website_choice(candidates: DataFrame, key: str = "bank") -> DataFrame:
    """Candidates (key, rank, url, source, status) to one site a bank: (key, url, source, verified).

    The first in their order that answers below 400 and is no aggregator; where none
    does, the first, unverified.
    """
    from outletry.functions import url as U

    live = (F.col("status") < 400) & ~U.is_aggregator(U.domain_of(F.col("url")))
    c = candidates.withColumn("dead", ~F.coalesce(live, F.lit(False)))
    best = c.groupBy(key).agg(F.min_by(F.struct("url", "source", "dead"), F.struct("dead", "rank")).alias("b"))
    return best.select(key, "b.url", "b.source", (~F.col("b.dead")).alias("verified"))


def website_candidates(hints: DataFrame, results: DataFrame, wiki: DataFrame, key: str = "bank", least: float = 0.3, most: int = 3) -> DataFrame:
    """(key, rank, url, source): the hint first, then good search results in their order, the list's page only if there is none.

    hints: key, url; results: key, engine_rank, rank, url, source, score; wiki: key, url.
    """
    by = Window.partitionBy(key).orderBy("engine_rank", "rank", "url")
    good = results.where(F.col("score") >= least).withColumn("n", F.row_number().over(by)).where(F.col("n") <= most)
    rows = hints.where("url is not null").select(key, F.lit(0).alias("wave"), F.lit(0).alias("n"), "url", F.lit("hint").alias("source")).unionByName(good.select(key, F.lit(1).alias("wave"), "n", "url", "source"))
    spare = wiki.join(rows.select(key).distinct(), key, "left_anti").select(key, F.lit(2).alias("wave"), F.lit(0).alias("n"), "url", F.lit("list").alias("source"))
    return rows.unionByName(spare).select(key, (F.row_number().over(Window.partitionBy(key).orderBy("wave", "n", "url")) - 1).alias("rank"), "url", "source")
