"""Versioned schema documents compiled to columns.

`compile_schema(document)` turns a JSON schema document into a `StructType` to
read values with and a function that gives, for a parsed value, the array of
failures as `{path, rule}`: one expression of built-in functions, no per-row
Python. Supported rules, all of which must hold:

| Rule | Holds for |
|---|---|
| `type` | object, array, string, integer, number, boolean, null; one or a list of them |
| `required` | members that an object must have |
| `additionalProperties: false` | objects without members that are not declared |
| `additionalProperties`: schema | every member that is not declared |
| `items`, `minItems`, `maxItems` | arrays |
| `enum`, `const` | strings, numbers, booleans, null |
| `pattern` (Java syntax, searched), `minLength`, `maxLength` (code points) | strings |
| `minimum`, `maximum`, `exclusiveMinimum`, `exclusiveMaximum` | numbers |

As in JSON Schema, a rule about strings says nothing about a number, and so on.
A document with a keyword that is neither a rule above nor an annotation is
refused with `UnsupportedSchema`: a rule is never silently left out.

Values are read as variants, so a member of the wrong type is seen as what it
is and not as missing. Paths are written `$.a.b[].c{}`: `[]` stands for any item
and `{}` for any undeclared member; a failure is listed once however many items
have it. Text that is no JSON fails with rule `json` at `$`.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ip import let

ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}
RULES = {"type", "properties", "required", "additionalProperties", "items", "minItems", "maxItems", "enum", "const",
         "pattern", "minLength", "maxLength", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"}
KINDS = ("object", "array", "string", "integer", "number", "boolean", "null")
SCALARS = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}
FAILURE = "array<struct<path:string,rule:string>>"


class UnsupportedSchema(ValueError):
    """The document holds what this compiler does not check."""


@dataclass(frozen=True)
class Compiled:
    """A schema document as a declared type and a check."""

    document: dict
    struct: T.DataType

    def failures(self, text: Column) -> Column:
        """Failures of a JSON text; NULL text gives NULL."""
        # the parser stops after the first value: what follows it breaks one of the two frames
        whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() \
            & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
        return F.when(text.isNull(), F.lit(None).cast(FAILURE)) \
            .when(whole, let(F.try_parse_json(text), lambda v: F.array_distinct(_check(self.document, v, "$")))) \
            .otherwise(F.array(_failure("$", "json")))

    def read(self, text: Column) -> Column:
        """The text as the declared type (members that are not declared are left out)."""
        return F.from_json(text, self.struct)


def compile_schema(document: dict | str) -> Compiled:
    document = json.loads(document) if isinstance(document, str) else document
    _refuse(document, "$")
    return Compiled(document, _struct(document))


def failures_by_version(text: Column, key: Column, archive: dict[str, Compiled]) -> Column:
    """Failures by the schema that `key` names; an unknown key fails with rule
    `schema` at `$`."""
    out = F.array(_failure("$", "schema"))
    for name, compiled in archive.items():
        out = F.when(key == F.lit(name), compiled.failures(text)).otherwise(out)
    return out


def _refuse(s, path: str) -> None:
    if not isinstance(s, dict):
        raise UnsupportedSchema(f"{path}: a schema must be an object")
    unknown = set(s) - RULES - ANNOTATIONS
    if unknown:
        raise UnsupportedSchema(f"{path}: {', '.join(sorted(unknown))}")
    for kind in _kinds(s) or ():
        if kind not in KINDS:
            raise UnsupportedSchema(f"{path}: type {kind}")
    for value in [*s.get("enum", []), *([s["const"]] if "const" in s else [])]:
        if isinstance(value, (dict, list)):
            raise UnsupportedSchema(f"{path}: enum of objects or arrays")
    for name, sub in s.get("properties", {}).items():
        if "'" in name or "]" in name:
            raise UnsupportedSchema(f"{path}: member name {name!r}")
        _refuse(sub, f"{path}.{name}")
    for name in s.get("required", []):
        if "'" in name or "]" in name:
            raise UnsupportedSchema(f"{path}: member name {name!r}")
    if "items" in s:
        _refuse(s["items"], f"{path}[]")
    if isinstance(s.get("additionalProperties"), dict):
        _refuse(s["additionalProperties"], path + "{}")


def _kinds(s: dict) -> list[str] | None:
    t = s.get("type")
    return [t] if isinstance(t, str) else t


def _struct(s: dict) -> T.DataType:
    """The declared type: one kind (null aside) gives it, anything else is text."""
    kinds = [k for k in _kinds(s) or [] if k != "null"]
    if len(kinds) == 1 and kinds[0] in SCALARS:
        return SCALARS[kinds[0]]
    if kinds == ["array"]:
        return T.ArrayType(_struct(s.get("items", {})))
    if kinds == ["object"]:
        if s.get("properties"):
            return T.StructType([T.StructField(n, _struct(sub)) for n, sub in s["properties"].items()])
        extra = s.get("additionalProperties")
        return T.MapType(T.StringType(), _struct(extra) if isinstance(extra, dict) else T.StringType())
    return T.StringType()


def _failure(path: str, rule: str) -> Column:
    return F.struct(F.lit(path).alias("path"), F.lit(rule).alias("rule"))


def _kind_is(v: Column, kind: str) -> Column:
    """Is the variant `v` of a JSON kind? 1.0 is an integer, as in JSON Schema."""
    t = F.schema_of_variant(v)
    if kind == "object":
        return t.startswith("OBJECT")
    if kind == "array":
        return t.startswith("ARRAY")
    if kind == "string":
        return t == "STRING"
    if kind == "boolean":
        return t == "BOOLEAN"
    if kind == "null":
        return t == "VOID"
    number = (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL")
    if kind == "number":
        return number
    as_double = F.try_variant_get(v, "$", "double")
    return number & ((t == "BIGINT") | (as_double % 1 == 0))


def _present(v: Column) -> Column:
    return v.isNotNull()


def _if_present(s: dict, path: str, v: Column) -> Column:
    return F.when(_present(v), _check(s, v, path))


def _member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$['{name}']", "variant")


def _check(s: dict, v: Column, path: str) -> Column:
    """All failures of a present variant `v` below `path`."""
    bad = _value_rules(s, v, path)
    parts = [F.array_compact(F.array(*bad))] if bad else []
    for name, sub in s.get("properties", {}).items():
        if _says_something(sub):
            parts.append(let(_member(v, name), functools.partial(_if_present, sub, f"{path}.{name}")))
    if _says_something(s.get("items", {})):
        items = F.try_variant_get(v, "$", "array<variant>")
        parts.append(F.when(_kind_is(v, "array"), F.flatten(F.transform(items, lambda x: _check(s["items"], _null_item(x), path + "[]")))))
    extra = s.get("additionalProperties", True)
    if extra is not True:
        declared = list(s.get("properties", {}))
        members = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
        others = F.filter(members, lambda e: ~e["key"].isin(declared)) if declared else members
        if extra is False:
            parts.append(F.when(_kind_is(v, "object") & (F.size(others) > 0), F.array(_failure(path, "additionalProperties"))))
        else:
            parts.append(F.when(_kind_is(v, "object"), F.flatten(F.transform(others, lambda e: _check(extra, _null_item(e["value"]), path + "{}")))))
    none = F.array().cast(FAILURE)
    parts = [F.coalesce(p.cast(FAILURE), none) for p in parts]
    return F.concat(*parts) if parts else none


def _null_item(x: Column) -> Column:
    """A JSON null inside an array or map comes out as a NULL variant or as a
    variant null; both are the variant null."""
    return F.coalesce(x, F.parse_json(F.lit("null")))


def _says_something(s: dict) -> bool:
    return bool(set(s) & RULES)


def _value_rules(s: dict, v: Column, path: str) -> list[Column]:
    def fails(rule: str, wrong: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(False)), _failure(path, rule))

    out = []
    kinds = _kinds(s)
    if kinds:
        ok = F.lit(False)
        for kind in kinds:
            ok = ok | _kind_is(v, kind)
        out.append(fails("type", ~ok))
    for name in s.get("required", []):
        out.append(F.when(_kind_is(v, "object") & ~_present(_member(v, name)), _failure(f"{path}.{name}", "required")))
    text = F.when(_kind_is(v, "string"), F.try_variant_get(v, "$", "string"))
    if "pattern" in s:
        out.append(fails("pattern", ~text.rlike(s["pattern"])))
    if "minLength" in s:
        out.append(fails("minLength", F.char_length(text) < s["minLength"]))
    if "maxLength" in s:
        out.append(fails("maxLength", F.char_length(text) > s["maxLength"]))
    number = F.when(_kind_is(v, "number"), F.try_variant_get(v, "$", "double"))
    for rule, wrong in (("minimum", lambda b: number < b), ("maximum", lambda b: number > b),
                        ("exclusiveMinimum", lambda b: number <= b), ("exclusiveMaximum", lambda b: number >= b)):
        if rule in s:
            out.append(fails(rule, wrong(F.lit(float(s[rule])))))
    if "minItems" in s or "maxItems" in s:
        n = F.when(_kind_is(v, "array"), F.size(F.try_variant_get(v, "$", "array<variant>")))
        if "minItems" in s:
            out.append(fails("minItems", n < s["minItems"]))
        if "maxItems" in s:
            out.append(fails("maxItems", n > s["maxItems"]))
    for rule, values in (("enum", s.get("enum")), ("const", [s["const"]] if "const" in s else None)):
        if values is not None:
            same = F.lit(False)
            for value in values:
                same = same | F.coalesce(_equals(v, text, number, value), F.lit(False))
            out.append(fails(rule, ~same))
    return out


def _equals(v: Column, text: Column, number: Column, value) -> Column:
    if value is None:
        return _kind_is(v, "null")
    if isinstance(value, bool):
        return _kind_is(v, "boolean") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
    if isinstance(value, str):
        return text == F.lit(value)
    return number == F.lit(float(value))
