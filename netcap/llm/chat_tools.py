"""Operator 10 - chat formatting: tool-call linking.

``link_tool_calls`` takes calls and results as two frames and hash-joins
them by (conv_id, call_id), orders the calls topologically (a call follows
the call whose result it uses), validates the arguments against the schema
of the tool and serialises one canonical JSON line per call or stray result.

Calls: conv_id, turn, call_id, parent_id (the call it depends on, or null),
name, arguments (JSON text). Results: conv_id, turn, call_id, content.

Topological level: 0 for a call without parent; else one more than its
parent. Parents are followed by pointer doubling, so a chain of d calls takes
log2(d) rounds, each one join; a frame is written per round in the shared
folder. Calls on or behind a cycle have level -1 and status ``cycle``. The
order of a conversation is (level, turn, call_id); no conversation is
gathered in one task.

Canonical JSON: keys in order, no white space, numbers in shortest form.

Defined results: a repeated call_id in a conversation: the first (turn, name,
arguments, parent) is the call, the others are dropped as repeats and counted
in ``repeats``; the same for results. Null conv_id or call_id: a call without
result, or a stray result, never joined. A parent that doesn't exist counts as none
(``missing_parent``). Invalid JSON: the line keeps the text as a string. Arguments that break
the schema keep their canonical form; both list their errors. Of a name that comes twice in an
object the last value counts. Extra columns are ignored; empty frames give an empty frame.

Schemas are dicts by the names of JSON Schema: ``type`` (object, array, string, integer,
number, boolean), ``properties``, ``required``, ``additionalProperties`` (False forbids unknown
fields), ``items``, ``minItems``, ``maxItems``, ``enum``, ``minimum``, ``maximum``, ``minLength``,
``maxLength`` (code points) and ``pattern`` (anywhere in the string). A flat ``{field: (type, required)}`` is
short for an object of these. Numbers of any length without a fraction are integers (1.0 is one; what
is written with an exponent is a double, and only whole from 10^38 on); a null counts as missing. Errors come field by field in order of names, items by place,
each with its path (``filters[2].op: not in enum``); of a value of the wrong type nothing else
is said. Schemas are walked when the query is built, values by expressions: no Python runs in tasks.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.llm.common import json_string, text_or_empty, written

# --- Fixed tool schemas of the registered query: field -> (kind, required) ---
TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "lookup": {"id": ("integer", True), "exact": ("boolean", False)},
    "summarise": {"text": ("string", True), "ratio": ("number", True)},
}
# --- end of fixed values ---

KINDS = {"string": "^STRING$", "boolean": "^BOOLEAN$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
         "array": "^ARRAY", "object": "^OBJECT"}
KEYWORDS = {"type", "properties", "required", "additionalProperties", "items", "minItems",
            "maxItems", "enum", "minimum", "maximum", "minLength", "maxLength", "pattern"}
_STRINGS = "array<string>"


def schema_of(tool: dict) -> dict:
    """A tool's schema in full; the flat form is written out."""
    if not all(isinstance(v, tuple) for v in tool.values()):
        return tool
    return {"type": "object", "properties": {f: {"type": kind} for f, (kind, _) in tool.items()},
            "required": [f for f, (_, required) in tool.items() if required]}


def _whole(value: Column) -> Column:
    """A number without a fraction. Integers beyond 38 digits are doubles in a variant."""
    held = F.schema_of_variant(value)
    return (held.rlike(r"^(BIGINT|DECIMAL\([0-9]+,0\))$")
            | ((held == "DOUBLE") & (F.abs(F.try_variant_get(value, "$", "double")) >= 1e38)))


def _beyond(value: Column, bound, below: bool) -> Column:
    """Below or above a bound: exactly where 38 digits hold the number, else as doubles."""
    exact = F.try_variant_get(value, "$", "decimal(38,9)")
    limit = F.lit(str(bound)).cast("decimal(38,9)")
    double, rough = F.try_variant_get(value, "$", "double"), F.lit(float(bound))
    return F.coalesce(exact < limit if below else exact > limit,
                      double < rough if below else double > rough)


def _errors(value: Column, schema: dict, path: Column) -> Column:
    """Errors of a variant that is there and not null, as an array of strings."""
    if set(schema) - KEYWORDS:
        raise ValueError(f"not known in a schema: {sorted(set(schema) - KEYWORDS)}")
    kind = schema.get("type")
    said = lambda wrong, text: F.when(wrong, F.concat(path, F.lit(f": {text}")))
    checks, deeper = [], []
    if "enum" in schema:
        allowed = [json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in schema["enum"]]
        checks.append(said(~F.to_json(value).isin(*allowed), "not in enum"))
    if kind in ("integer", "number"):
        for name, below in (("minimum", True), ("maximum", False)):
            if name in schema:
                checks.append(said(_beyond(value, schema[name], below),
                                   f"{'below' if below else 'above'} {schema[name]}"))
    elif kind == "string":
        text = F.try_variant_get(value, "$", "string")
        if "minLength" in schema:
            checks.append(said(F.length(text) < schema["minLength"], "too short"))
        if "maxLength" in schema:
            checks.append(said(F.length(text) > schema["maxLength"], "too long"))
        if "pattern" in schema:
            checks.append(said(~text.rlike(schema["pattern"]), "breaks its pattern"))
    elif kind == "array":
        items = F.try_variant_get(value, "$", "array<variant>")
        if "minItems" in schema:
            checks.append(said(F.size(items) < schema["minItems"], "too few items"))
        if "maxItems" in schema:
            checks.append(said(F.size(items) > schema["maxItems"], "too many items"))
        if "items" in schema:
            deeper.append(F.flatten(F.transform(items, lambda x, i: _present(
                x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), True))))
    elif kind == "object":
        fields = schema.get("properties", {})
        for field in sorted({*fields, *schema.get("required", ())}):
            if "'" in field:
                raise ValueError(f"no field may have a quote in its name: {field}")
            inner = F.try_variant_get(value, f"$['{field}']", "variant")
            deeper.append(_present(inner, fields.get(field, {}), _field_path(path, field),
                                   field in schema.get("required", ())))
        if schema.get("additionalProperties", True) is False:
            names = F.map_keys(F.try_variant_get(value, "$", "map<string, variant>"))
            unknown = F.array_sort(F.array_except(
                names, F.array(*[F.lit(f) for f in sorted(fields)]).cast(_STRINGS)))
            deeper.append(F.transform(unknown, lambda f: F.concat(
                _field_path(path, f), F.lit(": unknown field"))))
    inside = F.concat(F.array_compact(F.array(*checks).cast(_STRINGS)), *deeper)
    if kind is None:
        return inside
    fits = _whole(value) if kind == "integer" else F.schema_of_variant(value).rlike(KINDS[kind])
    return F.when(fits, inside).otherwise(F.array(F.concat(path, F.lit(f": not {kind}"))))


def _field_path(path: Column, field) -> Column:
    name = F.lit(field) if isinstance(field, str) else field
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def _present(value: Column, schema: dict, path: Column, required: bool) -> Column:
    """``_errors``, or what is to be said of a value that is missing or null."""
    missing = value.isNull() | F.is_variant_null(value)
    absent = F.array(F.concat(path, F.lit(": missing"))) if required else F.array().cast(_STRINGS)
    return F.when(missing, absent).otherwise(_errors(value, schema, path))


def argument_errors(name: Column, args: Column, tools: dict) -> Column:
    """Errors of the parsed arguments (a variant) as an array of strings."""
    whole = F.schema_of_variant(args)
    known = F.lit(False)
    per_tool = F.array().cast(_STRINGS)
    for tool, schema in tools.items():
        full = schema_of(schema)
        none = ["arguments: not an object", *[f"{f}: missing" for f in sorted(full.get("required", ()))]]
        errors = F.when(whole.rlike(KINDS["object"]), _errors(args, full, F.lit(""))).otherwise(
            F.array(*[F.lit(text) for text in none]))
        per_tool = F.when(name == tool, errors).otherwise(per_tool)
        known = known | F.coalesce(name == tool, F.lit(False))
    return (F.when(args.isNull(), F.array(F.lit("arguments: not JSON")))
            .when(~known, F.array(F.lit("name: unknown tool"))).otherwise(per_tool))


def topological_levels(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """conv_id, call_id, parent_id (unique, not null call_id) -> conv_id,
    call_id, level, missing_parent."""
    parents = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(1).alias("found"))
    linked = calls.select("conv_id", "call_id", "parent_id").join(
        parents, ["conv_id", "parent_id"], "left")
    state = linked.select(
        "conv_id", "call_id", F.when(F.col("found") == 1, F.col("parent_id")).alias("up"),
        F.col("found").cast("long").alias("steps"),
        (F.col("parent_id").isNotNull() & F.col("found").isNull()).alias("missing_parent"))
    state = written(spark, state.fillna(0, ["steps"]), "op10-levels")
    total, rounds = None, 0
    while True:
        pending = state.filter(F.col("up").isNotNull())
        open_now = pending.count()
        # After r rounds every chain of up to 2^r calls has reached its root.
        total = open_now if total is None else total
        if not open_now or (1 << rounds) > total:
            break
        jump = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next_up"),
                            F.col("steps").alias("more"))
        moved = pending.join(jump, ["conv_id", "up"]).select(
            "conv_id", "call_id", F.col("next_up").alias("up"),
            (F.col("steps") + F.col("more")).alias("steps"), "missing_parent")
        state = written(spark, moved.unionByName(state.filter(F.col("up").isNull())),
                        "op10-levels")
        rounds += 1
    return state.select("conv_id", "call_id", "missing_parent", F.when(
        F.col("up").isNull(), F.col("steps")).otherwise(F.lit(-1)).cast("long").alias("level"))


def _first_of(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row per (conv_id, call_id), the smallest by ``fields``; how many others there are."""
    return (df.groupBy("conv_id", "call_id")
            .agg(F.min(F.struct(*fields)).alias("v"), (F.count("*") - 1).alias("repeats"))
            .select("conv_id", "call_id", *[F.col(f"v.{f}") for f in fields], "repeats"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """conv_id, call_id, turn, result_turn, level, status, errors, repeats, line."""
    spark = calls.sparkSession
    fields = ["turn", "name", "arguments", "parent_id"]
    calls = calls.select("conv_id", "call_id", *fields)
    results = results.select("conv_id", "call_id", "turn", "content")
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    no_id = calls.filter(~whole).withColumn("repeats", F.lit(0).cast("long"))
    ids = _first_of(calls.filter(whole), fields)
    levels = topological_levels(spark, ids)
    ordered = (ids.join(levels, ["conv_id", "call_id"])
               .unionByName(no_id.withColumns({"missing_parent": F.lit(False),
                                               "level": F.lit(0).cast("long")}))
               .withColumn("is_call", F.lit(True)))
    answers = (_first_of(results.filter(whole), ["turn", "content"])
               .unionByName(results.filter(~whole)
                            .withColumn("repeats", F.lit(0).cast("long")))
               .withColumnsRenamed({"turn": "result_turn", "repeats": "result_repeats"})
               .withColumn("is_result", F.lit(True)))
    # A session setting of Spark: without it a repeated name would make the text no JSON.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    both = (ordered.join(answers, ["conv_id", "call_id"], "full")
            .withColumn("variant", F.try_parse_json("arguments")))
    errors = F.when(F.col("is_call"),
                    argument_errors(F.col("name"), F.col("variant"), tools)).otherwise(
                        F.array().cast("array<string>"))
    status = (F.when(F.col("is_call").isNull(), "stray_result")
              .when(F.col("level") == -1, "cycle")
              .when(F.size("errors") > 0, "invalid")
              .when(F.col("is_result").isNull(), "no_result")
              .when(F.col("missing_parent"), "missing_parent").otherwise("linked"))
    arguments = F.when(F.col("variant").isNotNull(), F.to_json("variant")).otherwise(
        json_string(F.col("arguments")))
    both = both.withColumn("errors", errors).withColumn("status", status)
    line = F.concat(
        F.lit('{"arguments":'), F.when(F.col("is_call"), arguments).otherwise(F.lit("null")),
        F.lit(',"call_id":'), json_string(F.col("call_id")),
        F.lit(',"name":'), json_string(F.col("name")),
        F.lit(',"parent_id":'), json_string(F.col("parent_id")),
        F.lit(',"result":'), json_string(F.col("content")),
        F.lit(',"status":"'), F.col("status"), F.lit('"}'))
    return both.select(
        "conv_id", "call_id", "turn", "result_turn", "level", "status",
        F.array_join("errors", "; ").alias("errors"),
        (F.coalesce("repeats", F.lit(0)) + F.coalesce("result_repeats", F.lit(0))).alias("repeats"),
        line.alias("line"))


def tool_traffic(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the ``conversations`` table stands for: every
    assistant turn is a call (tool by turn, arguments from its whole text, its
    parent the assistant turn two before), every user turn after the first is
    the result of the call one turn before. Where that turn is no assistant's,
    the result is a stray one."""
    c = conversations.select("conv_id", "turn", "role", text_or_empty(F.col("text")).alias("text"))
    key = lambda turn: F.md5(F.concat_ws(":", F.col("conv_id").cast("string"),
                                         turn.cast("string")))
    turn = F.col("turn")
    quoted = json_string(F.col("text"))
    n = F.length("text").cast("string")
    arguments = (
        F.when(turn % 3 == 0, F.concat(F.lit('{"text": '), quoted, F.lit(', "ratio": 0.50}')))
        .when(turn % 3 == 1, F.concat(F.lit('{ "query" : '), quoted, F.lit(', "limit":"'), n,
                                      F.lit('"}')))
        .otherwise(F.concat(F.lit('{"note": '), quoted, F.lit(',\n"id": '), n,
                            F.lit(', "exact": true}'))))
    # Calls of conversations divisible by 5 have their numbers as numbers.
    arguments = F.when(F.col("conv_id") % 5 == 0, F.regexp_replace(
        arguments, r'"limit":"([0-9]+)"\}$', r'"limit":$1}')).otherwise(arguments)
    name = F.element_at(F.array(F.lit("summarise"), F.lit("search"), F.lit("lookup")),
                        (turn % 3 + 1).cast("int"))
    calls = c.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", key(turn).alias("call_id"),
        F.when(turn >= 2, key(turn - 2)).alias("parent_id"), name.alias("name"),
        arguments.alias("arguments"))
    results = c.filter((F.col("role") == "user") & (turn > 0)).select(
        "conv_id", "turn", key(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
