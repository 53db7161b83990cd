import json
import re

import pytest
from pyspark.sql import functions as F

from lograft.functions import docschema as DS

SCHEMA = {
    "type": "object",
    "required": ["id", "kind"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "pattern": "^[a-f0-9]{4}$"},
        "kind": {"enum": ["a", "b", 3, None, True]},
        "n": {"type": "integer", "minimum": 0, "exclusiveMaximum": 10},
        "share": {"type": ["number", "null"], "exclusiveMinimum": 0, "maximum": 1},
        "name": {"type": "string", "minLength": 2, "maxLength": 3},
        "fixed": {"const": "x"},
        "list": {"type": "array", "minItems": 1, "maxItems": 2,
                 "items": {"type": "object", "required": ["v"], "properties": {"v": {"type": "number"}}}},
        "tags": {"type": "object", "additionalProperties": {"type": "string", "maxLength": 2}},
        "free": {},
    },
}

GOOD = {"id": "00ff", "kind": "a"}
VALUES = [
    GOOD, {}, [], 1, "x", None, True, 1.5,
    {**GOOD, "id": "00FF"}, {**GOOD, "id": 1}, {**GOOD, "id": None}, {**GOOD, "id": {}}, {**GOOD, "id": "00ff0"},
    *[{**GOOD, "kind": k} for k in ("c", "b", 3, 3.0, 4, None, True, False, [], {}, "3", "true", "null")],
    *[{**GOOD, "n": n} for n in (0, -1, 9, 10, 9.0, 9.5, "5", None, 1e300, 12345678901234567890123, True)],
    *[{**GOOD, "share": n} for n in (0, 0.0, 0.5, 1, 1.0, 1.01, None, "0.5", [])],
    *[{**GOOD, "name": n} for n in ("", "a", "ab", "abc", "abcd", "\U0001F600\U0001F600", 12)],
    {**GOOD, "fixed": "x"}, {**GOOD, "fixed": "y"}, {**GOOD, "fixed": None},
    *[{**GOOD, "list": n} for n in ([], [{"v": 1}], [{}], [{"v": "1"}, {"v": 2}], [{"v": 1}] * 3, [1, None], [{}, {}], {}, [{"v": None}], [[]])],
    *[{**GOOD, "tags": n} for n in ({}, {"a": "b"}, {"a": "bcd", "c": "efg"}, {"a": 1}, {"a": None}, [], {"a'b": "x"}, {"": "xyz"})],
    {**GOOD, "free": [{"any": None}]}, {**GOOD, "extra": 1}, {**GOOD, "extra": None}, {"id": "q", "extra": 1, "n": -1, "list": [{}], "name": ""},
]


def kind(v):
    if v is None:
        return {"null"}
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, (int, float)):
        return {"number", "integer"} if float(v).is_integer() else {"number"}
    return {{str: "string", list: "array", dict: "object"}[type(v)]}


def same(a, b):
    return kind(a) & {"number", "boolean", "null", "string"} == kind(b) & {"number", "boolean", "null", "string"} and a == b


def plain(s, v, path="$"):
    """The rules as JSON Schema states them, value by value."""
    out = set()
    if "type" in s and not kind(v) & set([s["type"]] if isinstance(s["type"], str) else s["type"]):
        out.add((path, "type"))
    if "enum" in s and not any(same(v, e) for e in s["enum"]):
        out.add((path, "enum"))
    if "const" in s and not same(v, s["const"]):
        out.add((path, "const"))
    if isinstance(v, str):
        if "pattern" in s and not re.search(s["pattern"], v):
            out.add((path, "pattern"))
        if len(v) < s.get("minLength", 0):
            out.add((path, "minLength"))
        if len(v) > s.get("maxLength", 1 << 30):
            out.add((path, "maxLength"))
    if "number" in kind(v):
        for rule, wrong in (("minimum", lambda b: v < b), ("maximum", lambda b: v > b), ("exclusiveMinimum", lambda b: v <= b), ("exclusiveMaximum", lambda b: v >= b)):
            if rule in s and wrong(s[rule]):
                out.add((path, rule))
    if isinstance(v, list):
        if len(v) < s.get("minItems", 0):
            out.add((path, "minItems"))
        if len(v) > s.get("maxItems", 1 << 30):
            out.add((path, "maxItems"))
        for x in v:
            out |= plain(s.get("items", {}), x, path + "[]")
    if isinstance(v, dict):
        out |= {(f"{path}.{n}", "required") for n in s.get("required", []) if n not in v}
        for n, x in v.items():
            extra = s.get("additionalProperties", True)
            if n in s.get("properties", {}):
                out |= plain(s["properties"][n], x, f"{path}.{n}")
            elif extra is False:
                out.add((path, "additionalProperties"))
            elif extra is not True:
                out |= plain(extra, x, path + "{}")
    return out


def test_failures_equal_a_plain_check(spark):
    compiled = DS.compile_schema(json.dumps(SCHEMA))
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(VALUES)], "i int, text string")
    got = {r.i: r.f for r in df.select("i", compiled.failures(F.col("text")).alias("f")).collect()}
    for i, v in enumerate(VALUES):
        found = [(x.path, x.rule) for x in got[i]]
        assert len(found) == len(set(found)) and set(found) == plain(SCHEMA, v), v
    # every kind of rule is broken by some value
    assert {rule for v in VALUES for _, rule in plain(SCHEMA, v)} == DS.RULES - {"properties", "items"}


def test_text_that_is_no_json(spark):
    compiled = DS.compile_schema(SCHEMA)
    df = spark.createDataFrame([(0, None), (1, ""), (2, "{"), (3, '{"id":"00ff","kind":"a"} x'), (4, json.dumps(GOOD))], "i int, text string")
    got = {r.i: r.f if r.f is None else [tuple(x) for x in r.f] for r in df.select("i", compiled.failures(F.col("text")).alias("f")).collect()}
    assert got == {0: None, 1: [("$", "json")], 2: [("$", "json")], 3: [("$", "json")], 4: []}


def test_declared_type(spark):
    compiled = DS.compile_schema(SCHEMA)
    assert compiled.struct.simpleString() == ("struct<id:string,kind:string,n:bigint,share:double,name:string,fixed:string,"
                                              "list:array<struct<v:double>>,tags:map<string,string>,free:string>")
    row = spark.createDataFrame([('{"id":"00ff","n":3,"list":[{"v":1}],"tags":{"a":"b"}}',)], "text string").select(compiled.read(F.col("text")).alias("r")).first().r
    assert (row.id, row.n, row.list[0].v, row.tags) == ("00ff", 3, 1.0, {"a": "b"})


def test_versions(spark):
    archive = {"v1": DS.compile_schema({"required": ["a"]}), "v2": DS.compile_schema({"required": ["b"]})}
    df = spark.createDataFrame([("v1", '{"a":1}'), ("v2", '{"a":1}'), ("v3", "{}"), (None, "{}")], "key string, text string")
    got = [[tuple(x) for x in r.f] for r in df.select(DS.failures_by_version(F.col("text"), F.col("key"), archive).alias("f")).collect()]
    assert got == [[], [("$.b", "required")], [("$", "schema")], [("$", "schema")]]


@pytest.mark.parametrize("bad", [{"oneOf": []}, {"properties": {"a": {"format": "date"}}}, {"type": "text"}, {"items": {"$ref": "#"}},
                                 {"enum": [[1]]}, {"items": [{}]}, {"properties": {"a'": {}}}])
def test_unknown_rules_are_refused(bad):
    with pytest.raises(DS.UnsupportedSchema):
        DS.compile_schema(bad)
