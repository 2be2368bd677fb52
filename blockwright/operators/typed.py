"""Text fields of nested messages as typed values, rewritten inside their lists before anything is exploded.

A family names how the text of a field is read, by its place (``filings[].form13f.holdings[].value``) or its bare name. The
rewrite walks the schema. Every message that becomes a row of a table gets a list ``_issues`` of what did not convert
exactly, so typed tables and the table of issues come from one pass: each text is parsed once, its value goes to the field,
its issue to the list with the column's name and, for items of a list column, the item's position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.functions import parse as P

ISSUES = "array<struct<column_name:string,element:int,raw_value:string,issue:string>>"


@dataclass(frozen=True)
class Typing:
    """``kinds``: place or bare name -> kind. ``rows``: messages outside lists that are rows of their own; ``inline``: lists of messages that stay columns."""

    kinds: dict[str, str]
    rows: frozenset[str] = frozenset()
    inline: frozenset[str] = frozenset()

    def kind(self, place: str) -> str | None:
        found = self.kinds.get(place, self.kinds.get(place.rsplit(".", 1)[-1]))
        return None if found == "text" else found


def parsed(text: Column, kind: str) -> Column:
    """struct<value, issue> of a text, and what else a kind makes of it: ``decimal:SCALE``, ``amount:SCALE`` (the word Indefinite is no number),
    ``int:BITS``, ``date``, ``yn``; ``cusip``, ``lei`` and ``put_call`` keep the trimmed text and add its normal form."""
    return F.get(F.transform(F.array(F.nullif(F.trim(text), F.lit(""))), lambda t: _read(t, kind)), 0)  # trimmed once, however often a rule looks at it


def _read(text: Column, kind: str) -> Column:
    name, _, argument = kind.partition(":")
    if name == "decimal":
        return P.parse_decimal(text, int(argument))
    if name == "amount":
        found = P.amount_or_indefinite(text, int(argument))
        return F.struct(found["value"].alias("value"), found["issue"].alias("issue"), found["indefinite"].alias("is_indefinite"))
    if name == "int":
        return P.parse_int(text, int(argument))
    if name == "date":
        return P.parse_date(text)
    if name == "yn":
        return P.parse_yn(text)
    normal = {"cusip": P.cusip_norm, "lei": P.lei_norm, "put_call": P.put_call_norm}[name](text)
    return F.struct(text.alias("value"), F.lit(None).cast("string").alias("issue"), normal.alias("norm"))


def _extras(kind: str) -> list[str]:
    return {"amount": ["is_indefinite"], "cusip": ["norm"], "lei": ["norm"], "put_call": ["norm"]}.get(kind.partition(":")[0], [])


def _text_list(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType)


def _messages(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType)


def _entry(column: str, element: Column, raw: Column, issue: Column) -> Column:
    return F.struct(F.lit(column).alias("column_name"), element.cast("int").alias("element"), raw.alias("raw_value"), issue.alias("issue"))


# Functions of list items, made for one field each.
def _parser(kind: str):
    return lambda text: parsed(text, kind)


def _member_parser(members: list[tuple[str, str | None]]):
    return lambda m: F.struct(*[(parsed(m[g], k) if k else m[g]).alias(g) for g, k in members])


def _member_values(members: list[tuple[str, str | None]]):
    return lambda m: F.struct(*[(m[g]["value"] if k else m[g]).alias(g) for g, k in members])


def _item_entry(column: str, source: Column, member: str | None = None):
    def one(parsed_item: Column, i: Column) -> Column:
        raw, found = F.get(source, i), parsed_item
        return _entry(column, i, raw[member] if member else raw, (found[member] if member else found)["issue"])

    return one


def _typer(typing: Typing, dtype: T.StructType, place: str):
    return lambda m: typed_row(typing, m, dtype, place)


class _Row:
    """One row-making message: the parses it needs, then its typed fields and issues."""

    def __init__(self, typing: Typing, dtype: T.StructType, place: str):
        self.typing, self.dtype, self.place = typing, dtype, place

    def _walk(self, v: Column, dtype: T.StructType, place: str, prefix: str):
        for f in dtype.fields:
            yield f, v[f.name], f"{place}.{f.name}", prefix + f.name

    def parses(self, v: Column, dtype: T.StructType, place: str, prefix: str = "") -> dict[str, Column]:
        out: dict[str, Column] = {}
        for f, x, at, name in self._walk(v, dtype, place, prefix):
            kind = self.typing.kind(f"{at}[]" if isinstance(f.dataType, T.ArrayType) else at)
            if isinstance(f.dataType, T.StringType) and kind:
                out[name] = parsed(x, kind)
            elif _text_list(f.dataType) and kind:
                out[name] = F.transform(x, _parser(kind))
            elif _messages(f.dataType) and at in self.typing.inline:
                members = [(g.name, self.typing.kind(f"{at}[].{g.name}")) for g in f.dataType.elementType.fields]
                out[name] = F.transform(x, _member_parser(members))
            elif isinstance(f.dataType, T.StructType) and at not in self.typing.rows:
                out |= self.parses(x, f.dataType, at, f"{name}_")
        return out

    def built(self, v: Column, p: Column | None, dtype: T.StructType, place: str, prefix: str = "") -> tuple[list[Column], list[Column]]:
        fields: list[Column] = []
        issues: list[Column] = []

        for f, x, at, name in self._walk(v, dtype, place, prefix):
            kind = self.typing.kind(f"{at}[]" if isinstance(f.dataType, T.ArrayType) else at)
            if isinstance(f.dataType, T.StringType) and kind:
                fields += [p[name]["value"].alias(f.name), *[p[name][e].alias(f"{f.name}_{e}") for e in _extras(kind)]]
                if not kind.startswith(("cusip", "lei", "put_call")):
                    issues.append(F.when(p[name]["issue"].isNotNull(), F.array(_entry(name, F.lit(None), x, p[name]["issue"]))))
            elif _text_list(f.dataType) and kind:
                fields.append(F.transform(p[name], lambda y: y["value"]).alias(f.name))
                issues.append(F.filter(F.transform(p[name], _item_entry(name, x)), lambda y: y["issue"].isNotNull()))
            elif _messages(f.dataType) and at in self.typing.inline:
                members = [(g.name, self.typing.kind(f"{at}[].{g.name}")) for g in f.dataType.elementType.fields]
                fields.append(F.transform(p[name], _member_values(members)).alias(f.name))
                for g, k in members:
                    if k:
                        issues.append(F.filter(F.transform(p[name], _item_entry(f"{name}.{g}", x, g)), lambda y: y["issue"].isNotNull()))
            elif isinstance(f.dataType, T.StructType):
                if at in self.typing.rows:
                    fields.append(F.when(x.isNotNull(), typed_row(self.typing, x, f.dataType, at)).alias(f.name))
                else:
                    below, more = self.built(x, p, f.dataType, at, f"{name}_")
                    fields.append(F.when(x.isNotNull(), F.struct(*below)).alias(f.name))
                    issues += more
            elif _messages(f.dataType):
                fields.append(F.transform(x, _typer(self.typing, f.dataType.elementType, f"{at}[]")).alias(f.name))
            else:
                fields.append(x.alias(f.name))
        return fields, issues


def typed_row(typing: Typing, v: Column, dtype: T.StructType, place: str) -> Column:
    """The message ``v`` typed, with ``_issues``. Its parses are held in a list of one, so that each is computed once."""
    row = _Row(typing, dtype, place)

    def finished(raw: Column, p: Column | None) -> Column:
        fields, issues = row.built(raw, p, dtype, place)
        none = F.array().cast(ISSUES)
        return F.struct(*fields, (F.concat(none, *[F.coalesce(i, none) for i in issues])).alias("_issues"))

    parses = row.parses(v, dtype, place)
    if not parses:
        return finished(v, None)
    held = F.struct(v.alias("v"), F.struct(*[c.alias(k) for k, c in parses.items()]).alias("p"))
    return F.get(F.transform(F.array(held), lambda y: finished(y["v"], y["p"])), 0)


def merged_lists(parts: list[tuple[str, Column, T.ArrayType]], tag: str) -> Column:
    """Lists of messages after one another as one list, told apart by ``tag``; a field that a list's messages lack is null."""
    fields: dict[str, T.DataType] = {}
    for _, _, kind in parts:
        for f in kind.elementType.fields:
            fields.setdefault(f.name, f.dataType)

    def one(label: str, kind: T.ArrayType):
        have = set(kind.elementType.fieldNames())
        return lambda x: F.struct(F.lit(label).alias(tag), *[(x[n] if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields.items()])

    lists = [F.coalesce(F.transform(c, one(label, kind)), F.array()) for label, c, kind in parts]
    return F.concat(*lists) if len(lists) > 1 else lists[0]


def chained(message: Column, kind: T.StructType, nested: str) -> Column:
    """A message and those nested in it under one field, outermost first, as a list of messages without that field; as deep as the schema goes."""
    levels, common, v, t = [], None, message, kind
    while isinstance(t, T.StructType):
        names = [f for f in t.fields if f.name != nested]
        common = common if common is not None else {f.name: f.dataType for f in names}
        have = {f.name for f in names}
        levels.append(F.when(v.isNotNull(), F.struct(*[(v[n] if n in have else F.lit(None).cast(d)).alias(n) for n, d in common.items()])))
        below = t[nested].dataType if nested in t.fieldNames() else None
        v, t = v[nested] if below is not None else v, below
    return F.filter(F.array(*levels), lambda x: x.isNotNull())
