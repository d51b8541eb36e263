"""Chat formatting: tool calls linked to their results, ordered, checked against schemas and written as canonical JSON.

Messages are rows (conv_id, turn, role, text). An assistant's text may be JSON ``{"tool_calls": [{"id", "name",
"arguments", "depends_on"}]}``, a tool's text ``{"tool_call_id", "content"}``; every other message is plain. DataFrame
and SQL functions only:

* calls and results meet in a hash join by conversation and identifier;
* calls are ordered by the longest chain of calls they depend on (level 0 depends on none): chains of single
  dependencies by pointer doubling, calls with several in rounds;
* arguments are checked against schema rows (name, field, type, required) through their VARIANT types;
* each message becomes one JSON object with sorted keys and no white space (VARIANT keeps object keys sorted).

One row comes back per message, call and result, never a whole conversation in one group.

Cases: text that is not such JSON, null or empty is a plain message; a call without a result is ``unanswered``, a result
without a call ``orphan``; of repeated identifiers in a conversation the first call (by turn, then position) is linked,
the others are ``repeated``; results may repeat and are linked each; dependencies on unknown calls are ignored, calls on
a cycle, or behind one, have no level; a call without an identifier is ``no identifier``: it has no level, links to
nothing and is checked like the others; a name without a schema is ``unknown tool``, of several schemas of a name the
smallest holds; arguments with a repeated key are no object; a message row that stands twice gives its rows twice, and its
calls, equal in turn and position, are both the first; a plain message or a result may be of any length, the arguments of a
call up to the 16 MB of a VARIANT; null conversation ids or turns stay rows of their own and link to nothing; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import materialise

_CALLS = "tool_calls array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>"
_RESULT = "tool_call_id string, content string"


def canonical(column: Column) -> Column:
    """A struct or map as JSON with sorted keys and without white space."""
    return F.to_json(F.parse_json(F.to_json(column, {"ignoreNullFields": "false"})))


def flat(**fields: Column) -> Column:
    """The same for fields that are strings, without parsing what was written: texts of any length."""
    struct = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.to_json(struct, {"ignoreNullFields": "false"})


def _parsed(messages: DataFrame) -> DataFrame:
    rows = messages.select(F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))
    return (rows.withColumn("calls", F.when(F.col("role") == "assistant", F.from_json("text", _CALLS))["tool_calls"])
            .withColumn("result", F.when(F.col("role") == "tool", F.from_json("text", _RESULT))))


def tool_calls(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, at, call_id, name, arguments, depends_on), one row per call, with or without an identifier."""
    return (_parsed(messages).where(F.size("calls") > 0)
            .select("conv_id", "turn", F.posexplode("calls").alias("at", "call"))
            .select("conv_id", "turn", "at", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"),
                    F.col("call.arguments").alias("arguments"), F.col("call.depends_on").alias("depends_on")))


def tool_results(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, content), one row per result."""
    return (_parsed(messages).where("result.tool_call_id is not null")
            .select("conv_id", "turn", F.col("result.tool_call_id").alias("call_id"), F.col("result.content")))


def plain_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the messages that hold neither a call nor a result."""
    return (_parsed(messages).where("coalesce(size(calls), 0) <= 0 and result.tool_call_id is null")
            .select("conv_id", "turn", "role", "text"))


def _jump(single: DataFrame) -> DataFrame:
    """(conv_id, call_id, to, dist): from calls with one dependency along such calls to the first call of another kind.

    Pointers double their reach each round, so a chain of n calls takes log2(n) rounds. Calls that still point to a
    call with one dependency after that are on a cycle, or lead into one, and are left out.
    """
    hops = materialise(single.withColumn("dist", F.lit(1).cast("long")), "hops")
    total, reach = hops.count(), 1
    while True:
        ahead = hops.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("dist").alias("_dist"))
        hops = materialise(hops.join(ahead, ["conv_id", "to"], "left").select(
            "conv_id", "call_id", F.coalesce("_to", "to").alias("to"),
            (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"), F.col("_to").isNotNull().alias("_moved")), "hops")
        moved, reach = hops.where("_moved").count(), 2 * reach
        if not moved or reach > 2 * total:
            return hops.where("not _moved").drop("_moved")
        hops = hops.drop("_moved")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that some order can reach; dependencies come at lower levels.

    Chains of calls with one dependency each are walked by pointer doubling. Calls with several are released in rounds,
    once all of theirs have a level: as many rounds as the longest chain of such calls is long.
    """
    calls = calls.where("conv_id is not null and call_id is not null")
    known = materialise(calls.select("conv_id", "call_id").distinct(), "calls")
    needs = calls.select("conv_id", "call_id", F.explode("depends_on").alias("need")).distinct()
    needs = materialise(needs.join(known.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"],
                                   "left_semi"), "needs")
    counts = materialise(needs.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("need").alias("to")),
                         "need-counts")
    done = known.join(counts, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0).cast("long"))
    hops = _jump(counts.where("n = 1").select("conv_id", "call_id", "to"))
    several = needs.join(counts.where("n > 1").select("conv_id", "call_id"), ["conv_id", "call_id"], "left_semi")
    anchors = hops.select("conv_id", F.col("call_id").alias("need"), "to", "dist")
    waiting = materialise(several.join(anchors, ["conv_id", "need"], "left").select(
        "conv_id", "call_id", F.coalesce("to", "need").alias("anchor"),
        (F.coalesce("dist", F.lit(0)) + 1).alias("dist")), "waiting")
    while not waiting.isEmpty():
        met = waiting.join(done.select("conv_id", F.col("call_id").alias("anchor"), "level"), ["conv_id", "anchor"], "left")
        ready = materialise(met.groupBy("conv_id", "call_id").agg(
            F.count("*").alias("all"), F.count("level").alias("have"), F.max(F.col("level") + F.col("dist")).alias("level"))
            .where(F.col("all") == F.col("have")).select("conv_id", "call_id", "level"), "ready")
        if ready.isEmpty():
            break  # only cycles are left, and what waits for them
        done = done.unionByName(ready)
        waiting = materialise(waiting.join(ready, ["conv_id", "call_id"], "left_anti"), "waiting")
    chained = hops.join(done.withColumnRenamed("call_id", "to"), ["conv_id", "to"]).select(
        "conv_id", "call_id", (F.col("level") + F.col("dist")).alias("level"))
    return done.unionByName(chained).withColumn("level", F.col("level").cast("int"))


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``errors``: sorted findings of the arguments against the tool's schema (empty: valid).

    ``schemas`` rows: name, fields array<struct<field, type, required>>. Types: string, integer, number, boolean,
    array, object, any.
    """
    parsed = F.try_parse_json("arguments")
    kind = F.schema_of_variant(parsed)
    # from_json reads nothing into a map but an object
    types = F.transform_values(F.from_json("arguments", "map<string,variant>"), lambda _, v: F.schema_of_variant(v))

    def fits(wanted: Column, found: Column) -> Column:
        whole = found.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$")
        return (F.when(wanted == "any", F.lit(True)).when(wanted == "string", found == "STRING")
                .when(wanted == "integer", whole | found.rlike(r"^DECIMAL\(\d+,0\)$"))
                .when(wanted == "number", whole | found.rlike("^(DECIMAL|DOUBLE|FLOAT)"))
                .when(wanted == "boolean", found == "BOOLEAN").when(wanted == "array", found.startswith("ARRAY"))
                .when(wanted == "object", found.startswith("OBJECT")).otherwise(F.lit(False)))

    fields = F.col("_fields")
    missing = F.transform(F.filter(fields, lambda f: f["required"] & ~F.array_contains(F.map_keys("_types"), f["field"])),
                          lambda f: F.concat(F.lit("missing "), f["field"]))
    wrong = F.transform(F.filter(fields, lambda f: F.array_contains(F.map_keys("_types"), f["field"])
                                 & ~fits(f["type"], F.element_at("_types", f["field"]))),
                        lambda f: F.concat(F.lit("type of "), f["field"]))
    unknown = F.transform(F.array_except(F.map_keys("_types"), F.transform(fields, lambda f: f["field"])),
                          lambda k: F.concat(F.lit("unexpected "), k))
    found = (F.when(F.col("_fields").isNull(), F.array(F.lit("unknown tool")))
             .when(F.col("_types").isNull(), F.array(F.lit("not an object")))
             .otherwise(F.sort_array(F.concat(missing, wrong, unknown))))
    known = schemas.groupBy("name").agg(F.min("fields").alias("_fields"))  # one schema a name
    joined = calls.join(known, "name", "left")
    types = F.when(kind.startswith("OBJECT"), types)
    return joined.withColumn("_types", types).withColumn("errors", found).drop("_types", "_fields")


def linked(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with ``status`` (answered, unanswered, repeated) and results with ``status`` (linked, orphan)."""
    key = ["conv_id", "call_id"]
    first = calls.groupBy(*key).agg(F.min(F.struct("turn", "at")).alias("first"))
    answered = results.select(*key).distinct().withColumn("_answered", F.lit(True))
    marked = calls.join(first, key, "left").join(answered.hint("shuffle_hash"), key, "left")
    repeated = (F.struct("turn", "at") != F.col("first"))
    marked = marked.withColumn("status", F.when(repeated, "repeated").when(F.col("_answered"), "answered")
                               .otherwise("unanswered")).drop("first", "_answered")
    owners = first.select(*key, F.col("first.turn").alias("call_turn"))
    kept = results.join(owners.hint("shuffle_hash"), key, "left").withColumn(
        "status", F.when(F.col("call_turn").isNull(), "orphan").otherwise("linked"))
    return marked, kept


def format_chat(spark: SparkSession, messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per message, call and result: conv_id, turn, at, kind, call_id, level, status, errors, json."""
    calls = materialise(tool_calls(messages), "tool-calls")
    results = tool_results(messages)
    order = materialise(levels(calls), "levels")
    none = F.lit(None)
    # calls without an identifier stay out of the joins: all of them would have one key
    marked, kept = linked(calls.where("call_id is not null"), results)
    nameless = calls.where("call_id is null").withColumn("status", F.lit("no identifier")).withColumn("level", none.cast("int"))
    marked = checked(marked.join(order, ["conv_id", "call_id"], "left").unionByName(nameless), schemas)
    arguments = F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("text"))))
    call_rows = marked.select(
        "conv_id", "turn", "at", F.lit("call").alias("kind"), "call_id", "level", "status", "errors",
        canonical(F.struct(F.lit("call").alias("kind"), F.col("call_id").alias("id"), "name",
                           arguments.alias("arguments"), "status")).alias("json"))
    result_rows = kept.join(order, ["conv_id", "call_id"], "left").select(
        "conv_id", "turn", F.lit(0).alias("at"), F.lit("result").alias("kind"), "call_id", "level", "status",
        none.cast("array<string>").alias("errors"),
        flat(kind=F.lit("result"), id=F.col("call_id"), content=F.col("content"), status=F.col("status")).alias("json"))
    text_rows = plain_messages(messages).select(
        "conv_id", "turn", F.lit(0).alias("at"), F.lit("message").alias("kind"), none.cast("string").alias("call_id"),
        none.cast("int").alias("level"), F.lit("plain").alias("status"), none.cast("array<string>").alias("errors"),
        flat(kind=F.lit("message"), role=F.col("role"), text=F.col("text")).alias("json"))
    return call_rows.unionByName(result_rows).unionByName(text_rows)
