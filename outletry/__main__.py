"""python -m outletry: builds, repairs or audits a directory from recorded pages."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletry.operators import build, registry, store
from outletry.plans.directory import directory, first_pages
from outletry.sources import tables
from outletry.sources.staging import stage

LOG = logging.getLogger("outletry")


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="outletry", description=__doc__)
    p.add_argument("--csv", help="seeds")
    p.add_argument("--pages", help="Parquet of recorded pages: page_id, bank, url, html")
    p.add_argument("--more-pages", help="Parquet of further recorded pages, of which embedded ones are read")
    p.add_argument("--registry", help="registry JSON")
    p.add_argument("--parts", default="parts", help="folder of parts")
    p.add_argument("--out", help="where the merged document of all parts goes")
    p.add_argument("--bank", default="", help="only banks whose name holds this")
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--max-pages", type=int, default=25, help="pages of a bank")
    p.add_argument("--resume", action="store_true", help="skip banks whose part succeeded")
    p.add_argument("--force", action="store_true", help="with --resume: skip none")
    p.add_argument("--upgrade-parts", action="store_true", help="repair stored parts")
    p.add_argument("--dry-run", action="store_true", help="with --upgrade-parts: write nothing")
    p.add_argument("--audit", action="store_true", help="show what stored parts hold")
    p.add_argument("--build-ids", action="store_true", help="build the registry from --geo and --lines, and write it to --registry")
    p.add_argument("--geo", help="Parquet of registry rows (see operators.build), or of a PDF's cells: doc, page, tbl, row, col, text")
    p.add_argument("--lines", help="Parquet of routing lines: line, words")
    p.add_argument("--log", help="a file that also gets the log")
    return p


def stored_parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts of a folder, staged, since the folder may be written while they are in use; none if there is no folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], tables.PART)
    return stage(tables.read_parts(spark, f"{path}/*/*.json"), "parts")


def build_ids(spark: SparkSession, a: argparse.Namespace) -> int:
    if not (a.geo and a.lines and a.registry):
        LOG.error("--build-ids needs --geo, --lines and --registry")
        return 1
    geo = spark.read.parquet(a.geo)
    if "text" in geo.columns:
        geo = build.geo_rows(tables.pdf_rows(geo))
    b, br = build.build_registry(geo, spark.read.parquet(a.lines))
    tables.registry_to_json(b, br, [a.geo, a.lines]).coalesce(1).write.mode("overwrite").text(a.registry)
    return 0


def export(spark: SparkSession, a: argparse.Namespace, seeds: DataFrame | None) -> None:
    """The merged document of the parts of all banks that are seeds now."""
    if a.out:
        parts = stored_parts(spark, a.parts)
        store.backup(spark, a.out)
        store.merged_document(store.current(parts, seeds) if seeds is not None else parts).coalesce(1).write.mode("overwrite").text(a.out)


def repair(spark: SparkSession, a: argparse.Namespace, banks: DataFrame, branches: DataFrame) -> int:
    """Repairs stored parts; what a part says besides its records stays, and parts that don't change aren't written."""
    parts = stored_parts(spark, a.parts)
    ids = stage(registry.lookup_banks(parts.select(F.col("_bank").alias("bank")), banks).select("bank", "rkey", "bank_id"), "ids")
    old = stage(tables.records_of(parts), "old-records")
    new = stage(store.upgrade(old, ids.select("bank", "rkey"), branches), "new-records")
    about = parts.withColumnRenamed("_bank", "bank").drop("branch", "sub_branch", "total_branch", "total_sub_branch", "bank_id").join(ids.select("bank", "bank_id"), "bank", "left")
    fresh = stage(store.changed(parts, tables.to_parts(new, about), "_bank"), "changed-parts")
    LOG.info("upgrade: %s", build.upgrade_summary(old, new).first().asDict())
    LOG.info("%d parts change", fresh.count())
    if not a.dry_run:
        store.write_parts(fresh, a.parts)
        export(spark, a, tables.read_seeds(spark, a.csv) if a.csv else None)
    return 0


def run(spark: SparkSession, a: argparse.Namespace, banks: DataFrame, branches: DataFrame) -> int:
    """Builds parts; a failed result never replaces one that succeeded."""
    everything = stage(tables.read_seeds(spark, a.csv), "seeds")
    seeds = everything.where(F.contains(F.lower("bank"), F.lit(a.bank.lower())))
    seeds = seeds.orderBy("bank").limit(a.limit) if a.limit else seeds
    old = stored_parts(spark, a.parts)
    n = seeds.count()
    if a.resume and not a.force:
        seeds = store.resumable(seeds, old)
    seeds = stage(seeds, "wanted-seeds")
    skipped = n - seeds.count()
    if not n:
        LOG.error("no bank matches")
        return 1
    LOG.info("%d banks, %d of them skipped", n, skipped)
    pages = first_pages(spark.read.parquet(a.pages).join(seeds.select("bank"), "bank", "left_semi"), seeds, a.max_pages)
    more = spark.read.parquet(a.more_pages) if a.more_pages else None
    failures: list = []
    new = stage(directory(pages, seeds, banks, branches, parts=old, more=more, failures=failures), "new-parts")
    for name, message in failures:
        LOG.error("extractor %s failed: %s", name, message.splitlines()[0] if message else "")
    merged = store.no_clobber(old, new, "_bank").join(new.select("_bank"), "_bank", "left_semi")
    store.write_parts(stage(store.changed(old, merged, "_bank"), "changed-parts"), a.parts)
    export(spark, a, everything)
    LOG.info("summary: %s", build.run_summary(new, skipped).first().asDict())
    return 0


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", handlers=[logging.StreamHandler(), *([logging.FileHandler(a.log)] if a.log else [])])
    spark = SparkSession.builder.appName("outletry").getOrCreate()
    if a.build_ids:
        return build_ids(spark, a)
    if a.audit:
        parts = stored_parts(spark, a.parts)
        found = stage(store.audit(parts, tables.records_of(parts), spark.createDataFrame([], "ord int, key string, branches int, subs int")), "audit")
        found.orderBy("bank").show(1000, False)
        store.audit_total(found).show(truncate=False)
        return 0
    doc = spark.read.text(a.registry, wholetext=True) if a.registry else spark.createDataFrame([("{}",)], "value string")
    banks, branches = tables.registry_from_json(doc)
    return repair(spark, a, banks, branches) if a.upgrade_parts else run(spark, a, banks, branches)


if __name__ == "__main__":
    sys.exit(main())
