"""Chat formatting with tool-call linking (operator 7), in Column and DataFrame functions only.

A message is a row (conv_id, turn, role, text). An assistant's or a tool's text that is
a JSON object with ``tool_calls`` makes calls, each with an ``id``, a ``name`` and
``arguments`` (an object, or its JSON text); a message of role ``tool`` whose text is
a JSON object with ``tool_call_id`` is a result. Results are joined to calls by
identifier. A tool that calls others hangs on the message that called it, so links
form trees: messages come in topological order, every tree at the turn of its root,
callers before what they called. Arguments are held against the tools' schemas; where
none are given, those that the corpus itself shows. Each message is serialised as
canonical JSON (fields in fixed order, no blanks), and so many turns make a chunk of
a conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, numbered, rows_of, stage


@dataclass(frozen=True)
class Tool:
    """required: names of arguments that must be there; types: name to JSON type
    (string, number, integer, boolean, object, array). Others are not allowed if
    `closed`."""

    name: str
    types: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    closed: bool = True


@dataclass(frozen=True)
class Format:
    """tools: whose arguments are checked; a call of another tool is not valid. None: the
    schemas are those of the table's own calls, see :func:`inferred`. usual: the share
    of a tool's calls with an argument from which it is required; rare: under this share
    an argument, or a type of it, isn't allowed. chunk: turns of a conversation in one output row; crowd: a chunk of more
    messages than so many times its turns is dealt into parts."""

    tools: tuple[Tool, ...] | None = None
    usual: float = 0.9
    rare: float = 0.02
    chunk: int = 256
    crowd: int = 4


# The JSON types, and how schema_of_variant names each.
_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(DECIMAL|DOUBLE|FLOAT)", "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY", "null": "^VOID$"}
_SCHEMA = "name string, required array<string>, types array<struct<k:string,t:string>>, closed boolean"
_MADE = "struct<content:string,tool_calls:array<struct<id:string,name:string,arguments:string>>>"
_GIVEN = "struct<content:string,tool_call_id:string>"


def shape(arguments: Column) -> Column:
    """The fields of an object (JSON text) with their JSON types, as array of (k, t); null if it is no object."""
    fields = F.try_variant_get(F.try_parse_json(arguments), "$", "map<string,variant>")
    told = lambda v: F.coalesce(*[F.when(F.schema_of_variant(v).rlike(pattern), F.lit(t)) for t, pattern in _TYPES.items()])
    return F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("k"), told(e["value"]).alias("t")))


def given(spark: SparkSession, tools: tuple[Tool, ...]) -> DataFrame:
    """The schemas of tools as a table."""
    rows = [{"name": x.name, "required": list(x.required), "types": [{"k": k, "t": t} for k, t in x.types.items()], "closed": x.closed} for x in tools]
    return rows_of(spark, rows, _SCHEMA)


def inferred(calls: DataFrame, at: Format) -> DataFrame:
    """Every tool's schema as its own calls show it: a row a name.

    An argument is required if a share of `usual` of the tool's calls have it; a type of an
    argument is allowed if a share of `rare` show it. Counts come from all calls.
    """
    fit = calls.where(F.col("shape").isNotNull()).select(F.coalesce("name", F.lit("")).alias("name"), "shape")
    total = fit.groupBy("name").agg(F.count("*").alias("total"))
    seen = fit.select("name", F.inline("shape")).groupBy("name", "k", "t").agg(F.count("*").alias("n"))
    known = F.collect_list(F.struct("k", "t", "n"))  # the types of one argument, then the arguments of one tool
    by_field = seen.groupBy("name", "k").agg(F.sum("n").alias("n"), known.alias("types"))
    fields = by_field.groupBy("name").agg(F.collect_list(F.struct("k", "n", "types")).alias("fields"))
    s = total.join(fields, "name", "left").withColumn("fields", F.coalesce("fields", F.array().cast("array<struct<k:string,n:bigint,types:array<struct<k:string,t:string,n:bigint>>>>")))
    required = F.transform(F.filter("fields", lambda f: f["n"] >= at.usual * F.col("total")), lambda f: f["k"])
    types = F.filter(F.flatten(F.transform("fields", lambda f: f["types"])), lambda x: x["n"] >= at.rare * F.col("total"))
    return s.select("name", required.alias("required"), F.transform(types, lambda x: F.struct(x["k"].alias("k"), x["t"].alias("t"))).alias("types"), F.lit(True).alias("closed"))


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` with valid: whether their arguments are an object that fits its tool's schema.

    All required fields are there, each of an allowed type (an integer is a number); a
    closed schema allows no others. A call of a tool without schema isn't valid.
    """
    s = if_small(stage(schemas.withColumnsRenamed({"name": "tool"}), "chat-schemas"))
    c = calls.join(s, F.coalesce("name", F.lit("")) == F.col("tool"), "left")
    names = F.transform("shape", lambda x: x["k"])
    allowed = lambda x: F.exists("types", lambda y: (y["k"] == x["k"]) & ((y["t"] == x["t"]) | (y["t"] == "number") & (x["t"] == "integer")))
    other = lambda x: ~F.col("closed") & ~F.exists("types", lambda y: y["k"] == x["k"])
    ok = (F.size(F.array_except("required", names)) == 0) & F.forall("shape", lambda x: allowed(x) | other(x))
    return c.withColumn("valid", F.coalesce(ok, F.lit(False))).drop("tool", "required", "types", "closed")


def canonical(arguments: Column) -> Column:
    """JSON text with sorted keys and no blanks; what is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), arguments)


def parsed(messages: DataFrame) -> DataFrame:
    """Staged distinct messages: uid, what they say, the calls they make (array) and the identifier they answer."""
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    m = m.groupBy(*m.columns).agg(F.count("*").alias("times"))
    json = F.col("text").rlike(r"^\s*\{")
    made = F.when(F.col("role").isin("assistant", "tool") & json & F.contains("text", F.lit("tool_calls")), F.from_json("text", _MADE))
    given = F.when((F.col("role") == "tool") & json, F.from_json("text", _GIVEN))
    m = m.withColumns({"made": made, "given": given})
    call = lambda c: F.struct(canonical(c["arguments"]).alias("arguments"), c["id"].alias("id"), c["name"].alias("name"), shape(c["arguments"]).alias("shape"))
    calls = F.transform("made.tool_calls", call)
    content = F.when(F.size("made.tool_calls") >= 1, F.col("made.content")).when(F.col("given.tool_call_id").isNotNull(), F.col("given.content")).otherwise(F.col("text"))
    m = m.select("conv_id", "turn", "role", "times", content.alias("content"), F.when(F.size(calls) >= 1, F.col("text")).alias("said"), F.when(F.size(calls) >= 1, calls).alias("calls"), F.col("given.tool_call_id").alias("answers"))
    return stage(m.withColumn("uid", F.monotonically_increasing_id()), "chat")


def anchors(links: DataFrame) -> DataFrame:
    """(uid, root, depth) of (uid, parent): where each one's chain of parents ends, and how far that is.

    Chains are doubled each round. What hangs on a circle has no end and is left out.
    """
    r = links.select("uid", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    n, reach = None, 1
    while True:
        s = r.select(F.col("uid").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        joined = stage(r.join(s, "root", "left"), "chat-links")
        if joined.where(F.col("further").isNotNull()).isEmpty():
            return r
        n = n or links.count()
        if reach > n:  # longer than any chain without a circle
            return joined.where(F.col("further").isNull()).select("uid", "root", "depth")
        r = joined.select("uid", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        reach *= 2


def conversations(messages: DataFrame, at: Format = Format()) -> DataFrame:
    """Chunks of conversations: conv_id, chunk, part, messages (JSON text) and counts.

    n_messages, n_repeats (further rows equal to a message), n_calls, n_results, n_linked
    (results with a call), n_unanswered (calls without result) and n_invalid (calls
    whose arguments don't fit). Of calls that repeat an identifier in a
    conversation, results hang on the first by turn, role and text. A result without its call keeps its
    own turn, and so do messages that call each other in a circle, with what hangs on
    them. Equal rows are one message; different messages of a turn are ordered by
    role, then text. Null text is empty; a null conv_id is a conversation, a null
    turn or role comes first. Chunks that hold over `crowd` times as many messages as
    turns are cut into parts in their order, so that parts read one after another
    are the chunk. No rows give none; extra columns are ignored.
    """
    spark = messages.sparkSession
    m = parsed(messages)
    same = lambda: [F.col("conv_id").eqNullSafe(F.col("c")), F.col("answers") == F.col("i")]
    calls = m.where(F.col("calls").isNotNull()).select("conv_id", "turn", "role", "said", "uid", F.posexplode("calls").alias("pos", "call")).select("conv_id", "turn", "role", "said", "uid", "pos", "call.*")
    first = calls.where(F.col("id").isNotNull()).groupBy(F.col("conv_id").alias("c"), F.col("id").alias("i")).agg(F.min(F.struct("turn", "role", "said", "uid")).alias("f"))
    first = if_small(stage(first.select("c", "i", F.col("f.uid").alias("parent")), "chat-first"))
    links = stage(m.where(F.col("answers").isNotNull()).join(first, same()).select("uid", "parent"), "chat-parents")
    roots = anchors(links).join(m.select(F.col("uid").alias("root"), F.col("turn").alias("at_turn")), "root").drop("root")
    # Calls, checked and told whether they are answered, go back to their messages.
    answered = stage(m.join(links.select("uid"), "uid", "left_semi").select(F.col("conv_id").alias("c"), F.col("answers").alias("i")).distinct().withColumn("met", F.lit(True)), "chat-answered")
    known = checked(calls, given(spark, at.tools) if at.tools is not None else inferred(calls, at))
    known = known.join(if_small(answered), [F.col("conv_id").eqNullSafe(F.col("c")), F.col("id") == F.col("i")], "left")
    back = known.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.struct("arguments", "id", "name", "valid").alias("call")))).alias("calls"),  # one message's calls
        F.count("*").alias("n_calls"), F.count_if(~F.col("valid")).alias("n_invalid"), F.count_if(F.col("met").isNull()).alias("n_unanswered"),
    )
    back = back.withColumn("calls", F.transform("calls", lambda x: x["call"]))
    m = m.drop("calls", "said").join(back, "uid", "left").join(roots, "uid", "left")
    linked = F.col("depth").isNotNull()
    m = m.withColumn("anchor", F.when(linked, F.col("at_turn")).otherwise(F.col("turn")))
    body = F.to_json(F.struct("content", F.when(F.col("answers").isNotNull(), linked).alias("linked"), "role", F.col("answers").alias("tool_call_id"), F.col("calls").alias("tool_calls")))
    m = m.select("conv_id", F.coalesce(F.floor(F.col("anchor") / at.chunk), F.lit(0)).cast("long").alias("chunk"), "anchor", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "turn", "role", body.alias("body"), "times", "answers", "n_calls", "n_invalid", "n_unanswered")
    limit = at.crowd * at.chunk
    m = stage(m, "chat-lines")
    crowd = stage(m.groupBy(F.col("conv_id").alias("c"), F.col("chunk").alias("k")).count().where(F.col("count") > limit), "chat-crowds")
    if crowd.isEmpty():
        m = m.withColumn("part", F.lit(0).cast("long"))
    else:
        here = [F.col("conv_id").eqNullSafe(F.col("c")), F.col("chunk") == F.col("k")]
        few = if_small(crowd.select("c", "k"))
        large = numbered(m.join(few, here, "left_semi"), ["conv_id", "chunk", "anchor", "depth", "turn", "role", "body"], "chat-order")
        begins = large.groupBy(F.col("conv_id").alias("c"), F.col("chunk").alias("k")).agg(F.min("no").alias("begin"))
        large = large.join(if_small(stage(begins, "chat-begins")), here).withColumn("part", F.floor((F.col("no") - F.col("begin")) / limit).cast("long"))
        m = m.join(few, here, "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(large.drop("no", "c", "k", "begin"))
    line = F.struct("anchor", "depth", "turn", "role", "body")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    out = m.groupBy("conv_id", "chunk", "part").agg(  # `crowd` times `chunk` messages at most
        F.array_sort(F.collect_list(line)).alias("lines"), F.count("*").alias("n_messages"), F.sum(F.col("times") - 1).cast("long").alias("n_repeats"), total("n_calls"),
        F.count("answers").alias("n_results"), F.count_if(F.col("depth") > 0).alias("n_linked"), total("n_unanswered"), total("n_invalid"),
    )
    text = F.concat(F.lit("["), F.array_join(F.transform("lines", lambda x: x["body"]), ","), F.lit("]"))
    return out.select("conv_id", "chunk", "part", "n_messages", "n_repeats", "n_calls", "n_results", "n_linked", "n_unanswered", "n_invalid", text.alias("messages"))
