"""Personal data by patterns and bootstrapped context (operator 1), in Column functions only.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. They
seed the bootstrap: the two words before a seed are a lexical pattern, tokens that
look like identifiers are instances, and a graph joins each pattern to the
instances it precedes. A pattern is trusted by the share of its instances that are
known; an instance becomes known when the noisy-or of its trusted patterns is high
enough; this repeats. What becomes known so adds spans of the kind ``context``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small, let, scanned, stage

KINDS = ("email", "ip", "card", "phone", "context")
SPAN = "struct<start:bigint,rank:int,end:bigint>"

# The base patterns, each written so that a failed start never rescans the run it is
# in: a match begins where its run begins or where the last match ended, and nothing
# is given back. The matches are the same.
_BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TOKEN = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"
_BLOCK = 1024  # code points
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_OPEN, _CLOSE = r"^[\"'(<\[{]*", r"[.,;:!?)\"'\]}>]*$"


@dataclass(frozen=True)
class Bootstrap:
    """min_seeds: distinct known instances a pattern needs. min_trust: share of its
    instances that must be known. min_score: noisy-or from which an instance is
    known. rounds: of scoring. min_digits: what a token without @ needs to look like
    an identifier. context: code points before it that are searched for its words."""

    min_seeds: int = 3
    min_trust: float = 0.5
    min_score: float = 0.5
    rounds: int = 3
    min_digits: int = 4
    context: int = 64


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return x.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    n = F.length(_digits(x))
    return n.between(9, 15) if kind == "phone" else n.between(12, 19) & _luhn(_digits(x))


def _matches(text: Column, pattern: str, has: Column) -> Column:
    """All leftmost matches: array of (start, end, found, before), offsets in code points."""
    none = F.array().cast("array<string>")
    before = F.when(has, F.split(text, pattern, -1)).otherwise(none)
    found = F.when(has, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(none)
    pairs = F.filter(F.zip_with(before, found, lambda b, f: F.struct(b.alias("b"), f.alias("f"))), lambda x: x["f"].isNotNull())

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + F.length(x["b"])
        end = begin + F.length(x["f"])
        return end, F.struct(begin.alias("start"), end.alias("end"), x["f"].alias("found"), F.right(x["b"], F.lit(64)).alias("before"))

    return scanned(pairs, F.lit(0).cast("bigint"), add, "struct<start:bigint,end:bigint,found:string,before:string>")


def _base_found(text: Column) -> Column:
    """Array of (start, rank of kind, end, found) of the base kinds, by start, then kind."""
    has = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]{1}[ -]?[0-9]"), "phone": F.contains(text, F.lit("+"))}

    def of(rank: int, kind: str) -> Column:
        good = F.filter(_matches(text, _BASE[kind], has[kind]), lambda x: _valid(kind, x["found"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), x["found"].alias("found")))

    return F.array_sort(F.concat(*[of(rank, kind) for rank, kind in enumerate(_BASE)]))


def _plain(spans: Column) -> Column:
    """Spans without their texts."""
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Array of (start, rank of kind, end) of the base kinds, by start, then kind."""
    return _plain(_base_found(text))


_OVER = "struct<start:bigint,rank:int,end:bigint,found:string>"


def _first_over(tokens: Column, spans: Column) -> Column:
    """Each token's first span by start, then kind, that shares a code point with it (or null).

    Ends and beginnings of tokens and spans are swept in order of their place, so the time
    is in proportion to their number. Of each kind only the latest span can reach over a
    place, since those of a kind share none.
    """
    none = F.lit(None).cast(_OVER)
    event = lambda at, order, span, rank: F.struct(at.alias("at"), F.lit(order).alias("order"), rank.alias("rank"), span.alias("span"))
    span_of = lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["found"].alias("found"))
    no_rank = F.lit(-1)
    # At a place: a token closes, a token opens, spans begin.
    events = F.array_sort(F.concat(
        F.transform(tokens, lambda x: event(x["end"], 0, none, no_rank)),
        F.transform(tokens, lambda x: event(x["start"], 1, none, no_rank)),
        F.transform(spans, lambda x: event(x["start"], 2, span_of(x), x["rank"])),
    ))
    start = F.struct(F.array(*[none] * 4).alias("latest"), none.alias("first"), F.lit(False).alias("inside"))

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        open_, begins = x["order"] == 1, x["order"] == 2
        reach = F.filter(s["latest"], lambda y: y.isNotNull() & (y["end"] > x["at"]))
        over = F.get(F.array_sort(reach), F.lit(0))
        latest = F.when(begins, F.transform(s["latest"], lambda y, i: F.when(i == x["rank"], x["span"]).otherwise(y))).otherwise(s["latest"])
        first = F.when(open_, over).when(begins & s["inside"], F.coalesce(s["first"], x["span"])).otherwise(s["first"])
        state = F.struct(latest.alias("latest"), first.alias("first"), F.when(begins, s["inside"]).otherwise(open_).alias("inside"))
        return state, F.struct((x["order"] == 0).alias("closes"), s["first"].alias("first"))

    swept = scanned(events, start, step, f"struct<closes:boolean,first:{_OVER}>")
    return F.transform(F.filter(swept, lambda x: x["closes"]), lambda x: x["first"])


def _occurrences(text: Column, spans: Column, at: Bootstrap) -> Column:
    """Tokens that look like identifiers: (start, end, pattern, instance, known).

    pattern: the two words before it; empty where there are none, so that the token is
    marked if its identifier is found elsewhere but says nothing in the graph.
    """
    tokens = _matches(text, _TOKEN, text.rlike("[0-9@]"))

    def one(x: Column) -> Column:
        core = F.regexp_replace(F.regexp_replace(x["found"], _OPEN, ""), _CLOSE, "")
        begin = x["start"] + F.length(F.regexp_extract(x["found"], _OPEN, 0))
        words = F.regexp_extract(F.lower(F.right(x["before"], F.lit(at.context))), r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)
        return F.struct(begin.alias("start"), (begin + F.length(core)).alias("end"), F.regexp_replace(words, r"[\x20\x09-\x0D]+", " ").alias("pattern"), F.lower(core).alias("instance"))

    likely = lambda x: (F.length(_digits(x["instance"])) >= at.min_digits) | F.contains(x["instance"], F.lit("@"))

    def mark(x: Column, over: Column) -> Column:
        # A token where a base span begins stands for that span; one further inside it is no instance.
        instance = F.when(over.isNull(), x["instance"]).when(x["start"] <= over["start"], F.lower(over["found"]))
        pattern = F.when(x["pattern"].rlike("[0-9@]"), "").otherwise(x["pattern"])
        return F.struct(x["start"], x["end"], pattern.alias("pattern"), instance.alias("instance"), over.isNotNull().alias("known"))

    fit = lambda x: x["instance"].isNotNull() & F.when(x["known"], x["pattern"] != "").otherwise(likely(x))
    shaped = F.filter(F.transform(tokens, one), lambda x: x["start"] < x["end"])
    return let(shaped, lambda t: F.filter(F.zip_with(t, _first_over(t, spans), mark), fit))


def _discovered(occurrences: DataFrame, at: Bootstrap) -> DataFrame:
    """(instance): what becomes known only by its contexts.

    The graph has each (pattern, instance) once, counted before it is shuffled.
    """
    graph = stage(occurrences.where("pattern != ''").groupBy("pattern", "instance").agg(F.max("known").alias("seed")), "privacy-graph")
    known = graph.where("seed").select("instance").distinct()
    for _ in range(at.rounds):
        edges = graph.select("pattern", "instance").join(if_small(known.withColumn("known", F.lit(1))), "instance", "left")
        trust = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count("known").alias("k"))
        trust = trust.withColumn("trust", F.col("k") / F.col("n")).where((F.col("k") >= at.min_seeds) & (F.col("trust") >= at.min_trust))
        trust = stage(trust.select("pattern", "trust"), "privacy-trust")
        reached = graph.select("pattern", "instance").join(if_small(trust), "pattern")  # a common pattern has many instances
        score = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))))
        found = reached.groupBy("instance").agg(score.alias("score")).where(F.col("score") >= at.min_score).select("instance")
        known = stage(known.union(found).distinct(), "privacy-known")
    seeds = graph.where("seed").select("instance").distinct()
    return known.join(seeds, "instance", "left_anti")


def find(docs: DataFrame, at: Bootstrap = Bootstrap(), carry: bool = False) -> DataFrame:
    """Every row of ``docs`` with its spans: doc_id, base, spans (and ``row`` if `carry`).

    base and spans are arrays of (start, rank in KINDS, end), offsets in code points,
    sorted. Null text is empty and has none; a null doc_id stays; repeated rows have
    equal spans, each its own, and count once in the graph. Overlapping spans of
    different kinds all stay. An empty table gives no rows; extra columns are ignored.
    """
    row = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []
    d = docs.select(*row, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = d.withColumn("found", _base_found(F.col("t")))
    both = let(F.struct("t", "found"), lambda x: F.struct(_plain(x["found"]).alias("base"), _occurrences(x["t"], x["found"], at).alias("seen")))
    d = d.withColumn("both", both).select(*["row"] * carry, "doc_id", "both.base", "both.seen")
    d = stage(d.withColumn("uid", F.monotonically_increasing_id()), "privacy")
    seen = d.select("uid", F.inline("seen"))
    extra = seen.where(~F.col("known")).join(_discovered(seen, at), "instance")
    span = F.struct("start", F.lit(len(KINDS) - 1).alias("rank"), "end")
    extra = stage(extra.groupBy("uid").agg(F.collect_list(span).alias("extra")), "privacy-extra")  # one document's spans
    d = d.drop("seen").join(extra, "uid", "left")
    return d.select(*["row"] * carry, "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def count_of(spans: str, rank: int) -> Column:
    """How many spans are of a kind; long."""
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, at: Bootstrap = Bootstrap()) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets, as ``<EMAIL>``.

    Where spans overlap, the first by start covers their union. ``n_chars`` follows
    the new text; a text without spans, or null, stays as it is.
    """
    found = find(docs, at, carry=True)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def clean(x: Column) -> Column:
        blocks = F.regexp_extract_all(x["text"], F.lit(f"(?s).{{1,{_BLOCK}}}"), 0)
        return let(blocks, lambda b: joined(b, x["spans"]))

    def joined(blocks: Column, spans: Column) -> Column:
        # Begins of blocks are known, so a piece of the text is cut without reading what is before it.
        def piece(begin: Column, end: Column) -> Column:
            first = F.floor(begin / _BLOCK).cast("int")
            some = F.slice(blocks, first + 1, F.floor((end - 1) / _BLOCK).cast("int") - first + 1)
            return F.when(end > begin, F.substring(F.array_join(some, ""), (begin - first * _BLOCK + 1).cast("int"), (end - begin).cast("int"))).otherwise("")

        def step(at_: Column, s: Column) -> tuple[Column, Column]:
            fresh = s["start"] >= at_
            return F.greatest(at_, s["end"]), F.when(fresh, F.concat(piece(at_, s["start"]), F.get(names, s["rank"]))).otherwise("")

        length = (F.size(blocks) - 1) * _BLOCK + F.length(F.element_at(blocks, -1))
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(scanned(spans, F.lit(0).cast("bigint"), step, "string"), ""), piece(last, length))

    text = F.col("row.text")
    d = found.withColumn("clean", F.when(F.size("spans") > 0, let(F.struct(text.alias("text"), "spans"), clean)).otherwise(text))
    new = {"text": F.col("clean"), "n_chars": F.coalesce(F.length("clean"), F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    kind = dict(docs.dtypes)
    return d.select(*[(new[c].cast(kind[c]) if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
