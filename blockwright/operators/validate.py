"""Rules on the fields of nested blocks, compiled from the block's schema to one array of errors a block.

A family names the kind of each field, by its place (``fills[].time``) or by its bare name (``user``). The compiler walks
the schema: a list becomes one ``transform`` with positions, an optional message is checked where it is there, and every
field of a known kind adds a condition. Fields the schema lacks add nothing. An error is struct<path, reason>, the path with
positions in the source lists; null counts as the empty value, as wire formats leave empty values out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR = "array<struct<path:string,reason:string>>"
LONG_MOST = (1 << 63) - 1
#: Seconds of the years 1 to 9999.
CALENDAR = (-62135596800, 253402300799)


@dataclass(frozen=True)
class Checks:
    """``kinds``: place or bare name (``users[]``: the list's elements) -> kind (a key of KINDS, ``enum:NAME``, ``same:COLUMN``); a place wins over a name, and kind ``free`` ends the search."""

    kinds: dict[str, str]
    enums: dict[str, list[str]] = field(default_factory=dict)

    def kind(self, place: str) -> str | None:
        found = self.kinds.get(place, self.kinds.get(place.rsplit(".", 1)[-1]))
        return None if found == "free" else found


Reasons = list[tuple[Column, "str | Column"]]


def _empty(v: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return v.isNull() | (F.length(v) == 0)
    return v.isNull()


def _filled(v: Column, kind: T.DataType) -> Reasons:
    return [(_empty(v, kind), "empty")]


def _decimal_form(v: Column, kind: T.DataType) -> Reasons:
    """Text whose value decimal(38,10) holds exactly; zeros at either end don't count."""
    if not isinstance(kind, T.StringType):
        return []
    plain = v.rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    return [(~plain, "not a plain decimal"), (v.rlike(r"\.[0-9]{10}[0-9]*[1-9]"), "more than 10 fractional digits"), (v.rlike(r"^-?0*[1-9][0-9]{28}"), "more than 28 integer digits")]


def _decimal(v: Column, kind: T.DataType) -> Reasons:
    return [*_filled(v, kind), *_decimal_form(v, kind)]


def _decimal_or_empty(v: Column, kind: T.DataType) -> Reasons:
    return [(~_empty(v, kind) & bad, why) for bad, why in _decimal_form(v, kind)]


def _decimal_or_null(v: Column, kind: T.DataType) -> Reasons:
    return [(v.isNotNull() & bad, why) for bad, why in _decimal(v, kind)]


def _long(v: Column, kind: T.DataType) -> Reasons:
    return [(~v.between(0, LONG_MOST), "out of range of a long")]


def _parts(v: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Seconds and nanoseconds of a struct<seconds, nanos> or a timestamp."""
    if isinstance(kind, T.StructType):
        return F.coalesce(v["seconds"], F.lit(0)).cast("long"), F.coalesce(v["nanos"], F.lit(0)).cast("long")
    micros = F.unix_micros(v)
    return F.floor(micros / 1_000_000), F.pmod(micros, F.lit(1_000_000)) * 1000


def _nanoseconds(v: Column, kind: T.DataType) -> Reasons:
    s, n = _parts(v, kind)
    most = LONG_MOST // 10**9
    return [(v.isNull(), "missing"), (~n.between(0, 10**9 - 1), "nanoseconds outside a second"), (~s.between(-most, most) | ((s == most) & (n > LONG_MOST % 10**9)), "out of range of nanoseconds")]


def _milliseconds(v: Column, kind: T.DataType) -> Reasons:
    s, n = _parts(v, kind)
    return [(v.isNull(), "missing"), (~n.between(0, 10**9 - 1), "nanoseconds outside a second"), (n % 1_000_000 != 0, "not a whole millisecond"), (~s.between(*CALENDAR), "out of the calendar")]


def _present(v: Column, kind: T.DataType) -> Reasons:
    return [(v.isNull(), "missing")]


def _one(v: Column, kind: T.DataType) -> Reasons:
    n = F.coalesce(F.size(v), F.lit(0))
    return [(n != 1, F.concat(n.cast("string"), F.lit(" items, not 1")))]


def _case(v: Column, kind: T.StructType) -> Reasons:
    """A message of which exactly one field is there."""
    n = reduce(lambda a, b: a + b, [v[f.name].isNotNull().cast("int") for f in kind.fields]) if kind.fields else F.lit(0)
    return [(v.isNull() | (n == 0), "no case"), (n > 1, "several cases")]


KINDS: dict[str, Callable[[Column, T.DataType], Reasons]] = {
    "text": _filled, "bytes": _filled, "decimal": _decimal, "decimal or empty": _decimal_or_empty, "decimal or null": _decimal_or_null, "long": _long,
    "nanoseconds": _nanoseconds, "milliseconds": _milliseconds, "present": _present, "one": _one, "case": _case,
}


def _reasons(checks: Checks, kind: str, v: Column, dtype: T.DataType, block: Callable[[str], Column | None]) -> Reasons:
    name, _, argument = kind.partition(":")
    if name == "enum":
        labels = checks.enums[argument]
        known = v.isin(labels) if isinstance(dtype, T.StringType) else v.between(1, len(labels))
        return [(v.isNull() | ~known, F.concat(F.lit(f"no {argument}: "), F.coalesce(v.cast("string"), F.lit("unspecified"))))]
    if name == "same":
        other = block(argument)
        if other is None:
            return []
        if isinstance(dtype, T.StructType):  # a time against the block's own
            (s, n), micros = _parts(v, dtype), F.unix_micros(other)
            return [(v.isNotNull() & ((s != F.floor(micros / 1_000_000)) | (n != F.pmod(micros, F.lit(1_000_000)) * 1000)), f"differs from {argument}")]
        return [(v.isNotNull() & (v != other), f"differs from {argument}")]
    return KINDS[name](v, dtype)


def _compiled(checks: Checks, v: Column, dtype: T.DataType, place: str, path: Column, block) -> list[Column]:
    """Arrays of errors at ``v`` and below it."""
    out: list[Column] = []
    for kind in (checks.kind(place) or "").split(" and ") if place else []:
        if kind:
            found = F.lit(None).cast("string")
            for bad, why in reversed(_reasons(checks, kind, v, dtype, block)):  # a field's first error counts
                found = F.when(F.coalesce(bad, F.lit(False)), why if isinstance(why, Column) else F.lit(why)).otherwise(found)
            out.append(F.when(found.isNotNull(), F.array(F.struct(path.alias("path"), found.alias("reason")))).otherwise(F.array().cast(ERROR)))
    if isinstance(dtype, T.StructType):
        below = []
        for f in dtype.fields:
            below += _compiled(checks, v[f.name] if place else F.col(f"`{f.name}`"), f.dataType, f"{place}.{f.name}".lstrip("."), F.concat(path, F.lit(f".{f.name}")) if place else F.lit(f.name), block)
        if below:
            joined = F.concat(*below) if len(below) > 1 else below[0]
            out.append(F.when(v.isNotNull(), joined).otherwise(F.array().cast(ERROR)) if place else joined)
    elif isinstance(dtype, T.ArrayType):
        probe = _compiled(checks, F.lit(None), dtype.elementType, f"{place}[]", path, block)
        if probe:
            def element(x: Column, i: Column) -> Column:
                return F.concat(F.array().cast(ERROR), *_compiled(checks, x, dtype.elementType, f"{place}[]", F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), block))

            out.append(F.coalesce(F.flatten(F.transform(v, element)), F.array().cast(ERROR)))
    return out


def block_errors(schema: T.StructType, checks: Checks) -> Column | None:
    """All errors of a block, in the order of its fields; None where the schema has no field of a known kind."""
    names = set(schema.fieldNames())
    parts = _compiled(checks, F.lit(None), schema, "", F.lit(""), lambda c: F.col(f"`{c}`") if c in names else None)
    return F.concat(F.array().cast(ERROR), *parts) if parts else None


def with_errors(blocks: DataFrame, checks: Checks, name: str = "_errors") -> DataFrame:
    """``blocks`` with their errors, which ``flatten`` takes over rather than compute them once a table."""
    found = block_errors(blocks.schema, checks)
    return blocks.withColumn(name, found if found is not None else F.array().cast(ERROR))


def quarantine(checked: DataFrame, key: list[str], name: str = "_errors") -> DataFrame:
    """One row an error: key, path, reason."""
    return checked.select(*key, F.explode(name).alias("e")).select(*key, "e.path", "e.reason")
