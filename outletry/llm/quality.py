"""Quality rules by distribution divergence (operator 6), in Column functions only.

Each document gives two histograms: character classes, and the common words of
the languages below against all other words. The references are the mean
histograms of every language over the whole corpus (documents that pass the base
rules and the length guards, each with weight one, so long documents don't steer
them). A document is rejected when the Jensen-Shannon distance to its language's
reference is over a limit, for a histogram whose length guard it meets. Most words are no common ones, in any text, so word histograms are never
far apart: their distance counts in parts of the distance that a text without any
common word has to the same reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, if_small, let, stage, word_array

# The commonest function words of four languages.
COMMON_WORDS = (
    "the of and to in a is that for it was on be with as by at from this are "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la le et les des en un du une est pour que dans qui par plus pas au "
    "el los las y se por con para su al lo como más pero sus o este"
).split()
WORDS = tuple(dict.fromkeys(COMMON_WORDS))
CLASSES = ("lower", "upper", "other_letter", "digit", "blank", "stop", "symbol", "other")


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules.

    min_words, max_repeat_percent: the base rules. max_class_distance: Jensen-Shannon
    distance (base 2, 0 to 1) beyond which a document goes. max_word_distance: the same,
    as part of the distance of a text without common words. min_common: share of common
    words that a language's reference needs to judge words by; documents of other
    languages aren't judged by words. min_chars, min_hist_words: lengths under which
    a histogram is too thin to judge by, so it isn't used.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.25
    max_word_distance: float = 0.85
    min_common: float = 0.05
    min_chars: int = 200
    min_hist_words: int = 100


def _measured(docs: DataFrame, carry: bool) -> DataFrame:
    """One row a document with the base counts and both histograms; a single pass over the text.

    carry: the document's own row stays, in the column ``row``.
    """
    row = ["row"] if carry else []
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"), *[F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] * carry)
    d = d.withColumn("w", word_array(F.col("text"))).withColumn("n", F.size("w"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    d = d.withColumn("ls", lines)
    # A window's key: its hash above, its place in the low `b` bits; equal windows are neighbours once sorted.
    d = d.withColumn("b", F.length(F.bin(F.col("n"))))
    hashed = F.transform("w", lambda x, i: F.call_function("shiftleft", F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)), F.col("b")).bitwiseOR(i.cast("long")))
    d = d.withColumn("k", F.when(F.col("n") >= 4, F.sort_array(F.slice(hashed, F.lit(1), F.col("n") - 2))))
    top = lambda x: F.call_function("shiftright", x, F.col("b"))
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b")) - 1).cast("int")
    alike = F.filter("k", lambda x, i: (top(x) == top(F.get("k", i + 1))) | (top(x) == top(F.get("k", F.when(i > 0, i - 1)))))
    # Windows of equal hashes are few; they are sorted by their words, so that equal ones are neighbours whatever the hash did.
    window = lambda x: let(place(x), lambda p: F.struct(F.concat_ws(" ", F.get("w", p), F.get("w", p + 1), F.get("w", p + 2)).alias("g"), p.alias("p")))
    d = d.withColumn("c", F.array_sort(F.transform(alike, window)))
    twice = F.filter("c", lambda x, i: (x["g"] == F.get("c", i + 1)["g"]) | (x["g"] == F.get("c", F.when(i > 0, i - 1))["g"]))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    common = F.concat(F.lit(" "), F.array_join(F.filter("w", lambda x: x.isin(*WORDS)), "  "), F.lit(" "))
    rest = F.regexp_replace("text", r"[a-z\x20\x09-\x0D]+", "")
    d = d.select(
        *row, "doc_id", "lang", F.col("n").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length("text").cast("long").alias("n_chars"), rest.alias("rest"), common.alias("common"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n") >= 4, F.size(F.array_distinct(covered))).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    kept = lambda p: F.length("rest") - F.length(F.regexp_replace("rest", p, ""))
    d = d.withColumns({"n_symbols": kept(r"[#*$%&|<>]+").cast("long"), "upper": kept(r"[A-Z]+"), "digit": kept("[0-9]+"), "stop": kept(r"[.,;:!?'\"()-]+"), "other_letter": kept(r"[\p{L}&&[^A-Za-z]]+"), "rest_chars": F.length("rest")})
    count = lambda w: (F.length("common") - F.length(F.replace("common", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)
    d = d.withColumn("words", F.array(*[count(w) for w in WORDS]))
    blank = F.col("n_chars") - F.col("word_chars")
    classes = {
        "lower": F.col("n_chars") - F.col("rest_chars") - blank, "upper": F.col("upper"), "other_letter": F.col("other_letter"), "digit": F.col("digit"), "blank": blank, "stop": F.col("stop"), "symbol": F.col("n_symbols"),
        "other": F.col("rest_chars") - F.col("upper") - F.col("other_letter") - F.col("digit") - F.col("stop") - F.col("n_symbols"),
    }
    share = lambda x, of: x.cast("double") / F.greatest(of, F.lit(1)).cast("double")
    word_shares = F.transform("words", lambda x: share(x, F.col("n_words")))
    d = d.withColumn("word_hist", word_shares)
    return d.select(
        *row, "doc_id", "lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(*[share(classes[c], F.col("n_chars")) for c in CLASSES]).alias("class_hist"),
        F.concat("word_hist", F.array(F.lit(1.0) - F.aggregate("word_hist", F.lit(0.0), lambda a, x: a + x))).alias("word_hist"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares of equal length."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)) / 2)


def _references(measured: DataFrame, hist: str, size: int, enough: Column, at: Limits, middle: bool = False) -> DataFrame:
    """Staged (lang, own): the mean histogram of every language with a document that is long enough.

    middle: of each bin the median instead, scaled to a sum of one.
    """
    bins = [F.get(hist, F.lit(i)) for i in range(size)]
    own = F.array(*[F.percentile_approx(x, 0.5, 100_000) if middle else F.avg(x) for x in bins])
    rows = measured.where(enough).groupBy("lang").agg(own.alias("own"))
    if middle:
        total = F.aggregate("own", F.lit(0.0), lambda a, x: a + x)
        rows = rows.where(total > 0).withColumn("own", F.transform("own", lambda x: x / total))
    if hist == "word_hist":
        rows = rows.where(F.get("own", F.lit(size - 1)) <= 1 - at.min_common)
    return stage(rows, "quality-references")


def _with_distance(measured: DataFrame, hist: str, size: int, refs: DataFrame) -> DataFrame:
    """`measured` with the distance to its language's reference; null where there is none."""
    none = F.array(*[F.lit(0.0)] * (size - 1), F.lit(1.0))
    far = js_distance(F.col(hist), F.col("own"))
    if hist == "word_hist":
        far = far / js_distance(none, F.col("own"))
    joined = measured.join(if_small(refs, 10_000), "lang", "left")
    return joined.withColumn(hist.replace("hist", "distance"), F.when(F.col("own").isNotNull(), far)).drop("own")


def judge(docs: DataFrame, at: Limits = Limits(), carry: bool = False) -> DataFrame:
    """Every document with its counts, distances and verdict.

    Null text counts as empty; an empty or short document fails the base rule. A
    null or missing ``lang`` is a language of its own. A language's only document is
    its own reference. Repeated rows are judged alike, each for itself, so ties
    don't matter; extra columns are ignored. A language without a document fit for
    a reference has null distances, which reject nothing; so has word_distance where
    the language's own words can't be judged. No rows give none.
    """
    m = stage(_measured(docs, carry), "quality")
    failed = (F.col("n_words") < at.min_words) | (100 * F.col("n_repeat_words") > at.max_repeat_percent * F.col("n_words"))
    m = m.withColumn("base_failed", failed)
    guard = {"class_hist": F.col("n_chars") >= at.min_chars, "word_hist": F.col("n_words") >= at.min_hist_words}
    size = {"class_hist": len(CLASSES), "word_hist": len(WORDS) + 1}
    limit = {"class_hist": at.max_class_distance, "word_hist": at.max_word_distance}
    for h in guard:
        fit, d = guard[h] & ~F.col("base_failed"), h.replace("hist", "distance")
        # Medians of the few classes bear any junk below half; of most common words a document has none, so medians say nothing there.
        refs = _references(m, h, size[h], fit, at, middle=h == "class_hist")
        first = _with_distance(m, h, size[h], refs)
        # Then means without what is far from the first reference; where all is far, that stays.
        again = _references(first, h, size[h], fit & (F.coalesce(d, F.lit(0.0)) <= limit[h]), at)
        refs = stage(refs.join(again.withColumnRenamed("own", "better"), "lang", "left").select("lang", F.coalesce("better", "own").alias("own")), "quality-references")
        m = _with_distance(m, h, size[h], refs).withColumn(d, F.when(guard[h], F.col(d)))
    far = (F.coalesce("class_distance", F.lit(0.0)) > at.max_class_distance) | (F.coalesce("word_distance", F.lit(0.0)) > at.max_word_distance)
    return m.withColumn("kept", ~F.col("base_failed") & ~far)


def keep_good(docs: DataFrame, at: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with all their columns.

    The rows travel with their measures, so nothing is joined: repeated ids and
    rows are each judged by their own text.
    """
    return judge(docs, at, carry=True).where("kept").select("row.*")
