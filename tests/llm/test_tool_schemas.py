"""Nested tool schemas against a plain validator."""

import json
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from netcap.llm import chat_tools

QUERY = {
    "type": "object", "required": ["filters", "page", "text"], "additionalProperties": False,
    "properties": {
        "text": {"type": "string", "minLength": 2, "maxLength": 5, "pattern": "^[a-zé]"},
        "page": {"type": "object", "required": ["size"], "properties": {
            "size": {"type": "integer", "minimum": 1, "maximum": 10 ** 20},
            "from": {"type": "number", "minimum": 0.5}}},
        "filters": {"type": "array", "minItems": 1, "maxItems": 3, "items": {
            "type": "object", "required": ["op"], "additionalProperties": False, "properties": {
                "op": {"type": "string", "enum": ["eq", "né", "a\"b"]},
                "values": {"type": "array", "items": {"type": "array", "items": {
                    "type": "integer"}}}}}},
        "exact": {"type": "boolean"}, "any": {}, "odd.name": {"enum": [1, None, True]}}}
TOOLS = {"query": QUERY, **chat_tools.TOOLS}


class Doubled(Decimal):
    """A number that is written with an exponent."""


def number(text):
    return Doubled(text) if "e" in text.lower() else Decimal(text)


def plain_kind(v):
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, str):
        return {"string"}
    if isinstance(v, (dict, list)):
        return {"object" if isinstance(v, dict) else "array"}
    whole = abs(v) >= 10 ** 38 if isinstance(v, Doubled) else v == int(v)
    return {"number", "integer"} if whole else {"number"}


def plain(v, schema, path=""):
    at = lambda f: f"{path}.{f}" if path else f
    kind = schema.get("type")
    if kind and kind not in plain_kind(v):
        return [f"{path}: not {kind}"]
    out = []
    if "enum" in schema and not any(type(x) is type(v) and x == v or (
            not isinstance(x, bool) and isinstance(x, int) and isinstance(v, Decimal) and x == v)
            for x in schema["enum"]):
        out.append(f"{path}: not in enum")
    if kind in ("integer", "number"):
        if "minimum" in schema and v < Decimal(str(schema["minimum"])):
            out.append(f"{path}: below {schema['minimum']}")
        if "maximum" in schema and v > Decimal(str(schema["maximum"])):
            out.append(f"{path}: above {schema['maximum']}")
    if kind == "string":
        if len(v) < schema.get("minLength", 0):
            out.append(f"{path}: too short")
        if len(v) > schema.get("maxLength", len(v)):
            out.append(f"{path}: too long")
        if "pattern" in schema and not re.search(schema["pattern"], v):
            out.append(f"{path}: breaks its pattern")
    if kind == "array":
        if len(v) < schema.get("minItems", 0):
            out.append(f"{path}: too few items")
        if len(v) > schema.get("maxItems", len(v)):
            out.append(f"{path}: too many items")
        for i, x in enumerate(v if "items" in schema else []):
            out += [f"{path}[{i}]: missing"] if x is None else plain(x, schema["items"], f"{path}[{i}]")
    if kind == "object":
        fields = schema.get("properties", {})
        for f in sorted({*fields, *schema.get("required", ())}):
            if v.get(f) is not None:
                out += plain(v[f], fields.get(f, {}), at(f))
            elif f in schema.get("required", ()):
                out.append(f"{at(f)}: missing")
        if schema.get("additionalProperties", True) is False:
            out += [f"{at(f)}: unknown field" for f in sorted(set(v) - set(fields))]
    return out


def made(rng, schema, rate):
    """JSON text that follows the schema, but for a share ``rate`` of places."""
    off = lambda: rng.random() < rate
    if off() or not schema:
        return rng.choice(['null', 'true', '"x"', '[]', '{}', '7', '1.0', '1.5', '2e0', '1e40',
                           '12345678901234567890', '-3', '9' * 45, '[null, [1]]'])
    if "enum" in schema:
        return json.dumps(rng.choice(schema["enum"]), ensure_ascii=rng.random() < 0.5)
    kind = schema.get("type")
    if kind == "string":
        return json.dumps(rng.choice(["A", "toolong", "", "éé" * 3] if off() else ["ab", "élan", "zz"]))
    if kind in ("integer", "number"):
        return rng.choice(["0", "0.5", "0.25", "4E2", "100000000000000000001", "3.25"] if off()
                          else ["1", "10.0", "99999999999999999999"])
    if kind == "boolean":
        return rng.choice(["true", "false"])
    if kind == "array":
        many = rng.choice([0, 4]) if off() else rng.randint(1, 3)
        return "[" + ", ".join(made(rng, schema.get("items", {}), rate) for _ in range(many)) + "]"
    fields = [f for f in schema["properties"] if not off()]
    if off():
        fields.append(rng.choice(["more", "zz", "é"]))
    if fields and rng.random() < 0.2:
        fields.append(rng.choice(fields))  # a name that comes twice
    rng.shuffle(fields)
    return "{" + ", ".join(f"{json.dumps(f)}: {made(rng, schema['properties'].get(f, {}), rate)}"
                           for f in fields) + "}"


def errors_of(spark, texts, tool="query"):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    df = spark.createDataFrame(list(enumerate(texts)), "n int, a string")
    rows = df.select("n", chat_tools.argument_errors(
        F.lit(tool), F.try_parse_json("a"), TOOLS).alias("e")).collect()
    return [r.e for r in sorted(rows, key=lambda r: r.n)]


def test_nested_schemas_equal_the_plain_validator(spark):
    rng = random.Random(5)
    texts = [t for t in (made(rng, QUERY, rng.choice([0, 0.02, 0.15])) for _ in range(600)) if t.startswith("{")]
    got = errors_of(spark, texts)
    bad = 0
    for text, errors in zip(texts, got, strict=True):
        want = plain(json.loads(text, parse_int=number, parse_float=number), QUERY)
        assert errors == want, text
        bad += bool(want)
    assert 100 < bad < len(texts) - 20


def test_numbers_names_and_unknown_fields(spark):
    ok = '"text": "ab", "filters": [{"op": "eq"}], "page": {"size": %s}'
    sizes = {"12345678901234567890": [], "100000000000000000001": ["page.size: above 100000000000000000000"],
             "1.0": [], "1e0": ["page.size: not integer"], "1.25": ["page.size: not integer"],
             "0": ["page.size: below 1"], "9" * 50: ["page.size: above 100000000000000000000"]}
    assert errors_of(spark, ["{%s}" % (ok % n) for n in sizes]) == list(sizes.values())
    # The last of a repeated name counts; paths name the place.
    twice = '{"text": 5, %s, "x": 1}' % (ok % 1)
    deep = ('{"text": "ab", "page": {"size": 1}, "filters": [{"op": "eq"}, {"op": "no", "to": 1, '
            '"values": [[1], [2, "3", null]]}]}')
    assert errors_of(spark, [twice, deep, "[]", "x", None]) == [
        ["x: unknown field"],
        ["filters[1].op: not in enum", "filters[1].values[1][1]: not integer",
         "filters[1].values[1][2]: missing", "filters[1].to: unknown field"],
        ["arguments: not an object", "filters: missing", "page: missing", "text: missing"],
        ["arguments: not JSON"], ["arguments: not JSON"]]
    flat = ['{"id": 123456789012345678901234567890}', '{"id": 1, "id": 2}', '{"id": 1, "more": 0}']
    assert errors_of(spark, flat, "lookup") == [[], [], []]


def test_schemas_that_are_not_understood_are_refused():
    for schema in ({"type": "object", "properties": {"a": {"oneOf": []}}},
                   {"type": "object", "properties": {"it's": {"type": "string"}}}):
        with pytest.raises(ValueError, match="not known|quote"):
            chat_tools._errors(F.lit(None), schema, F.lit(""))


def test_linked_calls_keep_long_integers_and_the_last_of_repeated_names(spark):
    calls = spark.createDataFrame([(1, 0, "a", None, "lookup",
                                    '{"id": 1, "id": 12345678901234567890, "exact": true}')],
                                  "conv_id long, turn long, call_id string, parent_id string, "
                                  "name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    row = chat_tools.link_tool_calls(calls, results).first()
    assert row.status == "no_result" and row.errors == ""
    assert row.line.startswith('{"arguments":{"exact":true,"id":12345678901234567890}')
