"""IP address text -> 32 hex digits (IPv4 mapped into ::ffff:0:0/96). Built-in expressions only (no UDF): IPv6
`::` expansion and an embedded dotted IPv4 tail are string/array work.

The conversion is a DataFrame step (`with_ip_hex`) that stages its
intermediate values as columns: every value is computed once and referenced
by name, which keeps the expression small for the optimizer and codegen.

Binary values compare as unsigned bytes, so `lo <= ip <= hi` on the 16-byte
form is an address range test for both families.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Address text shapes.
IPV4_REGEX = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"
IPV4_TAIL_REGEX = r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})$"
V4_MAPPED_PREFIX = "00000000000000000000ffff"

_EMPTY = "array<string>"


def let(value: Column, fn) -> Column:
    """Bind `value` once and use it many times inside `fn` (a one-element
    `transform`): keeps the expression linear in size however often the
    value is referenced, also after the optimizer inlines it into filters."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def v4_hex(s: Column) -> Column:
    """8 hex digits of a dotted IPv4 text column, NULL if malformed."""
    def on_octets(o):
        ok = F.forall(o, lambda x: x <= 255)
        return F.when(ok, F.array_join(F.transform(o, lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), ""))
    return F.when(s.rlike(IPV4_REGEX), let(F.transform(F.split(s, r"\."), lambda x: x.cast("int")), on_octets))


def _v6_groups_hex(s2: Column) -> Column:
    """IPv6 text without a dotted tail -> 32 hex digits or NULL."""
    def on_halves(h):
        gap = F.size(h) == 2
        groups = lambda x: F.when(x == "", F.array().cast(_EMPTY)).otherwise(F.split(x, ":"))
        head = F.when(gap, groups(F.element_at(h, 1))).otherwise(F.split(s2, ":"))
        rest = F.when(gap, groups(F.element_at(h, 2))).otherwise(F.array().cast(_EMPTY))

        def on_parts(hr):
            hd, rs = hr.getField("h"), hr.getField("r")
            missing = F.lit(8) - F.size(hd) - F.size(rs)
            fill = F.when(gap & (missing >= 1), F.array_repeat(F.lit("0"), missing)) \
                .otherwise(F.array().cast(_EMPTY))

            def on_groups(g):
                ok = (F.size(g) == 8) & F.forall(g, lambda x: x.rlike("^[0-9a-f]{1,4}$")) & (F.size(h) <= 2)
                return F.when(ok, F.array_join(F.transform(g, lambda x: F.lpad(x, 4, "0")), ""))
            return let(F.concat(hd, fill, rs), on_groups)
        return let(F.struct(head.alias("h"), rest.alias("r")), on_parts)
    return let(F.split(s2, "::"), on_halves)


def ip_hex(addr) -> Column:
    """32 lowercase hex digits of the 16-byte address; NULL for NULL, `""`
    or malformed text. IPv4 stays in generated code; only IPv6 text goes
    through the bound (lambda) form."""
    a = F.col(addr) if isinstance(addr, str) else addr
    s = F.lower(F.trim(a))

    def v6(s):
        def on_tail(t):
            th = v4_hex(t)
            s2 = F.when(t != "", F.concat(F.regexp_replace(s, IPV4_TAIL_REGEX, ""), F.substring(th, 1, 4),
                                          F.lit(":"), F.substring(th, 5, 4))).otherwise(s)
            return F.when((t == "") | th.isNotNull(), _v6_groups_hex(s2))
        return let(F.regexp_extract(s, IPV4_TAIL_REGEX, 1), on_tail)

    return (F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
            .when(s.contains(":"), let(s, v6))
            .otherwise(F.concat(F.lit(V4_MAPPED_PREFIX), v4_hex(s))))


def with_ip_hex(df: DataFrame, addr_col: str, out_col: str) -> DataFrame:
    return df.withColumn(out_col, ip_hex(addr_col))
