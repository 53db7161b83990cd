"""Documents derived from an `events` table, with every kind of schema rule
broken by `event_id % 20`, and the two schema versions they are checked against.

The version is 1 or 2 by `event_id div 20 % 2`; version 2 also requires `seq`,
which every second pair of twenties has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.docschema import compile_schema

VERSION_1 = {
    "type": "object",
    "required": ["id", "kind"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer"},
        "kind": {"type": "string", "pattern": "^[a-z_]+$"},
        "user": {"type": "integer", "minimum": 0},
        "channel": {"enum": ["development", "release", None]},
        "name": {"type": "string", "minLength": 1, "maxLength": 8},
        "ratio": {"type": ["number", "null"], "exclusiveMaximum": 1},
        "form": {"const": "ping"},
        "seq": {"type": "integer"},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "string"}},
        "labels": {"type": "object", "additionalProperties": {"type": "string"}},
    },
}
VERSION_2 = {**VERSION_1, "required": ["id", "kind", "seq"]}


def archive() -> dict:
    return {"1": compile_schema(VERSION_1), "2": compile_schema(VERSION_2)}


def events_to_documents(events: DataFrame) -> DataFrame:
    """(event_id, version, text)."""
    eid = F.col("event_id")
    r = eid % 20

    def pick(usual: Column | str, **broken: str) -> Column:
        out = F.lit(usual) if isinstance(usual, str) else usual
        for at, text in broken.items():
            out = F.when(r == int(at[1:]), F.lit(text)).otherwise(out)
        return out

    text = F.concat(
        F.lit('{"id":'), F.when(r == 0, F.concat(F.lit('"'), eid.cast("string"), F.lit('"'))).otherwise(eid.cast("string")),
        pick(F.concat(F.lit(',"kind":"'), F.col("event_type"), F.lit('"')), r1="", r2=',"kind":"No Kind"', r14=""),
        pick(F.concat(F.lit(',"user":'), F.col("user_id").cast("string")), r3=',"user":-1', r14=',"user":-0.5'),
        pick("", r4=',"other":null'),
        pick(',"tags":["x","y"]', r5=',"tags":[]', r6=',"tags":["a","b","c","d"]', r7=',"tags":["x",1,null]'),
        pick(',"channel":"release"', r10=',"channel":"nightly"', r16=',"channel":null'),
        pick(',"name":"n"', r11=',"name":""', r17=',"name":"longer than eight"'),
        pick(',"ratio":0.5', r12=',"ratio":1.0', r18=',"ratio":null'),
        pick(',"labels":{"a":"b"}', r13=',"labels":{"a":5,"b":{}}'),
        pick(',"form":"ping"', r15=',"form":"pong"'),
        F.when(F.floor(eid / 40) % 2 == 0, F.lit(',"seq":7')).otherwise(F.lit("")),
        pick("}", r8=""))
    version = F.when(r == 9, F.lit("3")).otherwise((F.floor(eid / 20) % 2 + 1).cast("string"))
    return events.select("event_id", version.alias("version"), text.alias("text"))
