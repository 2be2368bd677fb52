"""Nested blocks to flat tables: one declarative spec a family, one explode a level.

A table spec is a path of array fields from the block down, the columns taken at each level, and what filters rows. Every
table starts with the canonical identity columns; positions are those in the source lists, also of rows that a filter drops.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.functions.schema import IDENTITY, partition_date


@dataclass(frozen=True)
class Level:
    """One list: ``path`` relative to the element above, ``position`` names the column of source positions.

    ``outer``: an empty or null list gives one row with null element and position."""

    path: str
    position: str
    outer: bool = False
    where: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    levels: tuple[Level, ...] = ()
    #: output column -> SQL over ``block``, ``e0`` (element of the first level), ``e1`` ...
    columns: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FlattenSpec:
    family: str
    tables: tuple[TableSpec, ...]
    #: what lists the errors of a block (SQL, or a column): a block with an entry gives no row in any table
    errors: str | Column | None = None


def _identity(blocks: DataFrame) -> list[Column]:
    have = [c for c in IDENTITY if c in blocks.columns]
    return [F.col(f"block.{c}").alias(c) for c in have]


def _narrowed(name: str, kind: T.DataType, later: list[str]) -> Column | None:
    """Of the struct ``name`` the fields that SQL texts still ask for; None where they ask for none. A struct named by itself stays whole."""
    text = "\n".join(later).replace("`", "")
    if not re.search(rf"\b{name}\b", text):
        return None
    if not isinstance(kind, T.StructType) or re.search(rf"\b{name}\b(?!\s*\.)", text):
        return F.col(name)
    kept = [f.name for f in kind.fields if re.search(rf"\b{name}\s*\.\s*{re.escape(f.name)}(?!\w)", text, re.IGNORECASE)]
    return F.struct(*[F.col(name)[f].alias(f) for f in kept]).alias(name) if kept else None


def flatten_table(blocks: DataFrame, spec: TableSpec) -> DataFrame:
    """One explode a level; what no later level and no column asks for is left behind, so that lists aren't copied to each of their elements."""
    named = [f"block.{c}" for c in IDENTITY if c in blocks.columns] + list(spec.columns.values())
    ahead = [[*named, *[level.where or "" for level in spec.levels[k:]], *[f"{'block' if j == 0 else f'e{j - 1}'}.{level.path}" for j, level in enumerate(spec.levels) if j >= k]] for k in range(len(spec.levels) + 1)]
    whole = any(re.search(r"\bblock\b(?!\s*\.)", text) for text in ahead[0])
    used = blocks.columns if whole else [c for c in blocks.columns if any(re.search(rf"\bblock\s*\.\s*{re.escape(c)}(?!\w)", text.replace("`", ""), re.IGNORECASE) for text in ahead[0])]
    df = blocks.select(F.struct(*[F.col(f"`{c}`") for c in used or blocks.columns]).alias("block"))
    held, above = ["block"], "block"
    for k, level in enumerate(spec.levels):
        explode = F.posexplode_outer if level.outer else F.posexplode
        kinds = {f.name: f.dataType for f in df.schema.fields}
        kept = {h: h if re.fullmatch(r"p\d+", h) else _narrowed(h, kinds[h], ahead[k + 1]) for h in held}
        held = [h for h in held if kept[h] is not None]
        df = df.select(*[kept[h] for h in held], explode(F.expr(f"{above}.{level.path}")).alias(f"p{k}", f"e{k}"))
        if level.where:
            df = df.where(F.expr(level.where))
        held += [f"p{k}", f"e{k}"]
        above = f"e{k}"
    positions = [F.col(f"p{k}").cast("long").alias(level.position) for k, level in enumerate(spec.levels)]
    out = df.select(*_identity(blocks), *positions, *[F.expr(sql).alias(name) for name, sql in spec.columns.items()])
    return out.withColumn("date", partition_date(F.col("timestamp"))) if "timestamp" in out.columns else out


def flatten(blocks: DataFrame, spec: FlattenSpec) -> dict[str, DataFrame]:
    """All tables of a family; blocks with errors go to ``quarantine`` as a whole; no list of errors (null) is no error.

    Blocks that already have ``_errors`` keep them: check them once and persist or write them, as every table is a job of its own.
    """
    out = {}
    checked = blocks
    if "_errors" not in blocks.columns and spec.errors is not None:
        checked = blocks.withColumn("_errors", spec.errors if isinstance(spec.errors, Column) else F.expr(spec.errors))
    if "_errors" in checked.columns:
        out["quarantine"] = checked.where(F.coalesce(F.size("_errors"), F.lit(0)) > 0).select("block_num", F.explode("_errors").alias("error"))
        blocks = checked.where(F.coalesce(F.size("_errors"), F.lit(0)) <= 0).drop("_errors")
    return out | {t.name: flatten_table(blocks, t) for t in spec.tables}


def numbered_over_lists(df: DataFrame, first: Column, second: Column, index: str = "index", source: str = "source") -> DataFrame:
    """Elements of two lists in one numbering: all of the first, then all of the second; ``source`` is 0 or 1."""
    tagged = lambda a, k: F.transform(F.coalesce(a, F.array()), lambda x: F.struct(F.lit(k).alias("source"), x.alias("element")))
    joined = F.concat(tagged(first, 0), tagged(second, 1))
    flat = df.select("*", F.posexplode(joined).alias("_i", "_x"))
    return flat.select(*df.columns, F.col("_i").cast("long").alias(index), F.col("_x.source").alias(source), F.col("_x.element").alias("element"))


def routed(events: DataFrame, table: Column, names: list[str], other: str | None = None) -> dict[str, DataFrame]:
    """Each event to exactly one table; labels outside the rule go to ``other`` where one is named."""
    marked = events.withColumn("_table", F.coalesce(table, F.lit(other)) if other else table)
    return {n: marked.where(F.col("_table") == n).drop("_table") for n in names}


def union_by_name(parts: list[DataFrame], order: list[str]) -> DataFrame:
    """All rows of tables with column subsets, in one column order; what a table lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select(*order)


def fixed_columns(array: Column, names: list[str]) -> list[Column]:
    """The first elements of a list as columns, null where the list is shorter."""
    return [F.get(array, i).alias(n) for i, n in enumerate(names)]


def first_variant(*variants: Column) -> Column:
    """The one payload that is present out of one field a fork."""
    return F.coalesce(*variants)


def unrolled(df: DataFrame, message: str, nested: str, depth: int, level: str = "nesting_level") -> DataFrame:
    """A chain of nested messages as one row a level; ``nested`` is the field that holds the next, down to ``depth``."""
    chain = [F.col(".".join([message] + [nested] * k)) for k in range(depth)]
    plain = [F.when(c.isNotNull(), c.dropFields(nested)) if k + 1 < depth else c for k, c in enumerate(chain)]
    return df.select("*", F.posexplode(F.array(*plain)).alias("_l", "_m")).where("_m is not null").select(*[c for c in df.columns if c != message], F.col("_l").cast("long").alias(level), "_m.*")


def cases(message: Column, kind: T.StructType) -> tuple[Column, dict[str, Column]]:
    """A message of which one field is there: that field's name, and every field of any case by name, null where the case lacks it."""
    label = F.coalesce(*[F.when(message[f.name].isNotNull(), F.lit(f.name)) for f in kind.fields])
    values: dict[str, list[Column]] = {}
    for f in kind.fields:
        for g in f.dataType.fields if isinstance(f.dataType, T.StructType) else []:
            values.setdefault(g.name, []).append(message[f.name][g.name])
    return label, {name: F.coalesce(*found) for name, found in values.items()}


def with_child_counts(blocks: DataFrame, lists: dict[str, str]) -> DataFrame:
    """Stored counts: output column -> list field; a missing list counts 0."""
    return blocks.withColumns({c: F.coalesce(F.size(F.expr(p)), F.lit(0)).cast("long") for c, p in lists.items()})


def renested(child: DataFrame, keys: list[str], position: str, name: str) -> DataFrame:
    """Children back to one ordered list a key, without the position."""
    rest = [c for c in child.columns if c not in (*keys, position)]
    rows = F.array_sort(F.collect_list(F.struct(position, *rest)))
    return child.groupBy(*keys).agg(F.transform(rows, lambda x: F.struct(*[x[c].alias(c) for c in rest])).alias(name))


def roundtrip_differences(blocks: DataFrame, child: DataFrame, keys: list[str], position: str, name: str) -> DataFrame:
    """Keys whose rebuilt list isn't the source list; an empty list and no list both have no children."""
    back = renested(child, keys, position, name).withColumnRenamed(name, "_rebuilt")
    both = blocks.select(*keys, name).join(back, keys, "full_outer")
    source = F.when(F.size(name) > 0, F.to_json(F.col(name)))
    return both.where(~source.eqNullSafe(F.to_json("_rebuilt"))).select(*keys)
