"""Which extractor's rows count, and where a listing's pages end: window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Priorities of the extractors; those from FALLBACK on count only where none before them wins.
PRIORITY = {"json_api": 0, "jquery_ajax": 1, "validator_key_ajax": 2, "modal_tables": 3, "html_table": 4, "html_cards": 5, "map_infowindow": 6, "datatables": 7, "aspx": 8, "markdown": 9}
FALLBACK = 7


def select_extractors(records: DataFrame, key: str = "page_id", least: int = 3, fallback: int = FALLBACK) -> DataFrame:
    """Rows (key, priority, name, ...) of the extractors that a first-winner chain would have run.

    The first with `least` named rows wins, and all before it stay; where none wins, the
    first later one with any row is added.
    """
    by = records.groupBy(key, "priority").agg(F.count_if(F.btrim(F.coalesce("name", F.lit(""))) != "").alias("named"))
    w = by.groupBy(key).agg(F.min(F.when((F.col("priority") < fallback) & (F.col("named") >= least), F.col("priority"))).alias("winner"), F.min(F.when(F.col("priority") >= fallback, F.col("priority"))).alias("spare"))
    keep = F.when(F.col("winner").isNotNull(), F.col("priority") <= F.col("winner")).otherwise((F.col("priority") < fallback) | (F.col("priority") == F.col("spare")))
    return records.join(w, key).where(keep).drop("spare")


def methods(records: DataFrame, key: str, method: str = "extractor") -> DataFrame:
    """(key, method): the distinct extractors, sorted, joined by +."""
    return records.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(method)), "+").alias("method"))


def method_counts(records: DataFrame, key: str, method: str = "extractor") -> DataFrame:
    return records.groupBy(key, method).agg(F.count("*").alias("n"))


def pages_until_stop(rows: DataFrame, key: str, page: str, signature: list[str]) -> DataFrame:
    """Rows of the pages before the first that adds no new signature to those before it.

    Each signature counts for the page where it is first seen, so no page is compared
    with a growing set.
    """
    first = rows.groupBy(key, *signature).agg(F.min(page).alias("first"))
    fresh = first.groupBy(key, F.col("first").alias(page)).agg(F.count("*").alias("fresh"))
    pages = rows.select(key, page).distinct().join(fresh, [key, page], "left")
    stop = pages.where("fresh is null").groupBy(key).agg(F.min(page).alias("stop"))
    return rows.join(stop, key, "left").where(F.col("stop").isNull() | (F.col(page) < F.col("stop"))).drop("stop")


def first_by_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by an order; ties must be broken by it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__nth", F.row_number().over(w)).where("__nth = 1").drop("__nth")
