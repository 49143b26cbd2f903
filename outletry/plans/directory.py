"""The directory, end to end: recorded pages to resolved, enriched parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outletry.functions import predicates as P
from outletry.functions import url as U
from outletry.operators import build, chain, extract, feeds, registry, resolve, store
from outletry.sources import dom, tables
from outletry.sources.staging import stage

#: Offline extractors by name: (elements, pages) to records. Register more with :func:`register`.
EXTRACTORS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "json_api": extract.script_json, "modal_tables": extract.modal_tables, "html_table": extract.html_tables, "html_cards": extract.html_cards,
    "map_infowindow": lambda _, pages: extract.map_windows(pages),
    "markdown": lambda _, pages: extract.markdown_records(pages) if "markdown" in pages.columns else extract.markdown_records(pages.withColumn("markdown", F.lit(""))),
}


def register(name: str, priority: int, f: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    EXTRACTORS[name] = f
    chain.PRIORITY[name] = priority


def extracted(pages: DataFrame, recorded: dict[str, DataFrame] | None = None, failures: list | None = None) -> DataFrame:
    """Records of pages (page_id, bank, url, html, maybe markdown) by all extractors, then those that the chain keeps.

    recorded: records of feeds by their extractor's name. failures: where given, an extractor
    that fails is noted there as (name, message) and its records are left out; else
    its error is raised.
    """
    pages = pages.where(~P.is_non_branch_page(F.col("url")))
    elements = stage(dom.elements(pages), "elements")
    found = pages.sparkSession.createDataFrame([], FOUND)
    for name, f in EXTRACTORS.items():
        try:
            r = stage(f(elements, pages).select("page_id", "ord", *extract.RECORD), name)
        except Exception as e:
            if failures is None:
                raise
            failures.append((name, str(e)))
            continue
        found = found.unionByName(r.withColumns({"extractor": F.lit(name), "priority": F.lit(chain.PRIORITY[name])}))
    for name, r in (recorded or {}).items():
        found = found.unionByName(r.select("page_id", "ord", *extract.RECORD).withColumns({"extractor": F.lit(name), "priority": F.lit(chain.PRIORITY[name])}))
    kept = chain.select_extractors(found, "page_id").join(pages.select("page_id", "bank"), "page_id")
    by = Window.partitionBy("bank").orderBy("page_id", "priority", "ord", "name")
    return kept.withColumn("ord", F.row_number().over(by).cast("long"))


FOUND = "page_id long, ord int, name string, address string, url string, phone string, routing string, is_sub boolean, extractor string, priority int"


def second_wave(pages: DataFrame, first: DataFrame, more: DataFrame) -> DataFrame:
    """Of further recorded pages, those that pages without a winning extractor embed or link to.

    pages, more: page_id, bank, url, html; first: what :func:`extracted` gave for pages.
    """
    poor = pages.join(first.where("winner is not null").select("page_id").distinct(), "page_id", "left_anti")
    links = feeds.embedded_links(dom.elements(poor), poor).join(poor.select("page_id", "bank"), "page_id").select("bank", "url").distinct()
    return more.join(links, ["bank", "url"], "left_semi").join(pages.select("bank", "url"), ["bank", "url"], "left_anti")


def merged_parts(seeds: DataFrame, parts: DataFrame, ids: DataFrame) -> DataFrame:
    """Parts of the banks that are made of others, as far as all of these have parts that succeeded."""
    wanted = seeds.where(F.size(F.coalesce("constituents", F.array().cast("array<string>"))) > 0).select("bank", "website", "constituents")
    all_ = stage(store.constituents(wanted, parts, tables.records_of(parts), repeats=True), "constituents")
    kept = all_.where("nth = 1").withColumn("ord", F.row_number().over(Window.partitionBy("bank", "is_sub").orderBy("rank", "ord")))
    about = all_.groupBy("bank").agg(F.count_if(F.col("nth") > 1).cast("int").alias("n")).join(wanted, "bank").join(ids, "bank", "left")
    about = about.select("bank", F.col("website").alias("bank_url"), F.lit("merged-constituents").alias("method"), F.lit("success").alias("status"), "bank_id", "constituents", F.when(F.col("n") > 0, F.col("n")).alias("merged_duplicates"))
    return tables.to_parts(kept, about)


def registry_parts(seeds: DataFrame, ids: DataFrame, branches: DataFrame) -> DataFrame:
    """Parts of the banks that are to come from the registry alone, as far as it lists their offices.

    Offices without an id give their routing number to the one they name. A record's address
    is the office's district, if it is known; nothing else is.
    """
    listed = seeds.where("registry").join(ids.where("rkey is not null"), "bank")
    b = branches.join(listed.select("rkey").distinct(), "rkey", "left_semi")
    has = F.coalesce("fi_branch_id", F.lit("")) != ""
    regions = [r["w"] for r in b.select(F.explode(F.split(F.lower(F.coalesce("district", F.lit(""))), " ")).alias("w")).where("w <> ''").distinct().collect()]  # a country's districts
    offices = registry.merge_offices(b.where(has), b.where(~has), regions=sorted({*regions, "north", "south"}))
    where = b.select("rkey", "bkey", F.initcap(F.col("district")).alias("district"))
    r = listed.select("bank", "rkey").join(offices, "rkey").join(where, ["rkey", "bkey"], "left")
    r = r.select("bank", P.is_sub(F.col("office")).alias("is_sub"), F.col("nth").alias("ord"), F.col("office").alias("name"), F.nullif("district", F.lit("")).alias("address"), F.lit(None).cast("string").alias("page_url"), F.lit(None).cast("string").alias("phone"), "fi_branch_id", F.col("routing").alias("routing_no"))
    r = stage(r, "registry-records")
    about = listed.join(r.select("bank").distinct(), "bank", "left_semi").select("bank", F.col("website").alias("bank_url"), F.lit("registry").alias("method"), F.lit("success").alias("status"), "bank_id")
    return tables.to_parts(r, about)


def page_parts(pages: DataFrame, seeds: DataFrame, ids: DataFrame, branches: DataFrame, recorded: dict | None = None, more: DataFrame | None = None, pdfs: tuple | None = None, failures: list | None = None) -> DataFrame:
    """Parts of banks from their recorded pages, a second wave of pages, and PDFs.

    more: further recorded pages, of which those count that poor pages embed; their page_id
    differ from the first ones'. pdfs: (documents, rows, lines), see feeds.pdf_records;
    documents has doc, bank.
    """
    raw = stage(extracted(pages, recorded, failures), "extracted")
    if more is not None:
        wave = stage(second_wave(pages, raw, more).select(*[c for c in pages.columns if c in more.columns]), "second-wave")
        if not wave.isEmpty():
            raw = raw.unionByName(extracted(wave, None, failures).withColumn("ord", F.col("ord") + F.lit(1 << 40)))
    raw = raw.select("bank", "ord", *extract.RECORD, "extractor")
    if pdfs is not None:
        documents, rows, lines = pdfs
        found = feeds.pdf_records(rows, lines).join(documents.select("doc", "bank"), "doc")
        order = F.row_number().over(Window.partitionBy("bank").orderBy("doc", "at")).cast("long") + F.lit(1 << 50)
        raw = raw.unionByName(found.withColumn("ord", order).select("bank", "ord", *extract.RECORD, F.lit("pdf").alias("extractor")))
    by = Window.partitionBy("bank").orderBy("ord")
    raw = stage(raw.withColumn("ord", F.row_number().over(by).cast("long")), "found")
    resolved = stage(resolve.resolve(raw.drop("extractor")), "resolved")
    stored = stage(build.shape(resolved, ids.select("bank", "rkey"), branches), "stored")
    about = build.status_of(stored, seeds).join(chain.methods(raw, "bank"), "bank", "left").join(ids.select("bank", "bank_id"), "bank", "left").join(seeds.select("bank", F.col("website").alias("bank_url")), "bank", "left")
    return tables.to_parts(stored, about)


def first_pages(pages: DataFrame, seeds: DataFrame, most: int = 25) -> DataFrame:
    """Of each bank's recorded pages its seeds, and behind them the best by their address, `most` in all."""
    s = seeds.select("bank", F.posexplode("seed_pages").alias("at", "url"))
    d = pages.join(s, ["bank", "url"], "left")
    by = Window.partitionBy("bank").orderBy(F.col("at").isNull(), "at", F.desc(U.score_page(F.col("url"), F.lit(""))), "url", "page_id")
    return d.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= most).select(*pages.columns)


def directory(pages: DataFrame, seeds: DataFrame, banks: DataFrame, branches: DataFrame, recorded: dict | None = None, parts: DataFrame | None = None, more: DataFrame | None = None, pdfs: tuple | None = None, failures: list | None = None) -> DataFrame:
    """Parts of all seeds' banks: from their constituents' stored `parts`, else from the registry, else from pages.

    seeds: bank, website, and as far as they are there constituents and registry.
    """
    for column, kind in (("constituents", "array<string>"), ("registry", "boolean")):
        if column not in seeds.columns:
            seeds = seeds.withColumn(column, F.lit(None).cast(kind))
    ids = stage(registry.lookup_banks(seeds, banks).select("bank", "rkey", "bank_id"), "ids")
    out = []
    if parts is not None:
        out.append(stage(merged_parts(seeds, parts, ids.select("bank", "bank_id")), "merged-parts"))
        seeds = seeds.join(out[-1].select(F.col("_bank").alias("bank")), "bank", "left_anti")
    out.append(stage(registry_parts(seeds, ids, branches), "registry-parts"))
    seeds = stage(seeds.join(out[-1].select(F.col("_bank").alias("bank")), "bank", "left_anti"), "page-seeds")
    pages = pages.join(seeds.select("bank"), "bank", "left_semi")
    out.append(page_parts(pages, seeds, ids, branches, recorded, more, pdfs, failures))
    whole = out[0]
    for p in out[1:]:
        whole = whole.unionByName(p)
    return whole
