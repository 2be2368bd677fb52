"""Exact sums and guarded aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checked_sum(c: Column) -> Column:
    """The exact sum of decimals; null where it overflows, never rounded."""
    return F.try_sum(c)


def constant_or_null(c: Column) -> Column:
    """The value of all rows of a group where they agree, else null."""
    return F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c))


def only_if_single(c: Column) -> Column:
    return F.when(F.count(F.lit(1)) == 1, F.any_value(c))


def ordered_list(order: str, columns: list[str]) -> Column:
    """A group's rows as structs in order, without the ordering column."""
    rows = F.array_sort(F.collect_list(F.struct(order, *columns)))
    return F.transform(rows, lambda x: F.struct(*[x[c].alias(c) for c in columns]))


def distinct_list(c: str) -> Column:
    return F.array_sort(F.collect_set(c))


def ordinal_in_block(df: DataFrame, index: str, name: str, keys: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(*(keys or ["block_num"])).orderBy(index)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))


def row_before(df: DataFrame, keys: list[str], order: str, columns: list[str], name: str, width: int) -> DataFrame:
    """``name``: struct of the columns of the key's row before by ``order`` (a number), null for its first. Windows stay inside ranges of ``width`` units;
    between them the last row of each is carried on, so that no key is a single task."""
    row = F.struct(*columns)
    ranged = df.withColumn("_range", F.floor(F.col(order) / width))
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    ends = ranged.groupBy(*keys, "_range").agg(F.max_by(row, order).alias("_end"))
    carried = ends.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), F.lag("_end").over(Window.partitionBy(*keys).orderBy("_range")).alias("_from"))
    same = F.col("_range").eqNullSafe(F.col("_at"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    seen = ranged.withColumn("_in", F.lag(row).over(inside)).join(carried, same, "left")
    return seen.select(*df.columns, F.coalesce("_in", "_from").alias(name))


def change_within(df: DataFrame, keys: list[str], order: str, seconds: str, value: str, gap: int, name: str, width: int | None = None) -> DataFrame:
    """Change of a value from the row before, null across a gap of more than ``gap`` seconds.

    With ``width``, for ``seconds`` that are known and never fall along ``order``, windows stay inside ranges of so many seconds: a row also goes to the
    ranges that begin within ``gap`` after it, as the one before their first row, and no key is a single task.
    """
    ranges = [] if width is None else ["_range"]
    rows = df
    if width is not None:
        own, reach = F.floor(F.col(seconds) / width), F.floor((F.col(seconds) + gap) / width)
        rows = df.select("*", F.posexplode(F.coalesce(F.sequence(own, reach), F.array(own))).alias("_copy", "_range"))
    w = Window.partitionBy(*keys, *ranges).orderBy(order)
    near = F.lag(seconds).over(w) >= F.col(seconds) - gap
    out = rows.withColumn(name, F.when(near, F.col(value) - F.lag(value).over(w)))
    return out if width is None else out.where("_copy = 0").drop("_copy", "_range")


def last_known(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], width: int | None = None) -> DataFrame:
    """New columns (new name -> column): the last value of the key so far that isn't null, the row's own included.

    With ``width`` (the first order column numeric) windows stay inside ranges of that many units; between ranges one row a key and range is carried on.
    """
    if width is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.last(c, ignorenulls=True).over(w) for name, c in values.items()})
    kept = df.columns
    ranged = df.withColumn("_range", F.floor(F.col(order[0]) / width))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.groupBy(*keys, "_range").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_end{k}") for k, c in enumerate(values.values())])
    over = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a key and range
    carried = ends.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), *[F.last(f"_end{k}", ignorenulls=True).over(over).alias(f"_from{k}") for k in range(len(values))])
    same = F.col("_range").eqNullSafe(F.col("_at"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    seen = ranged.withColumns({f"_in{k}": F.last(c, ignorenulls=True).over(inside) for k, c in enumerate(values.values())}).join(carried, same, "left")
    new = {name: F.coalesce(f"_in{k}", f"_from{k}") for k, name in enumerate(values)}
    return seen.select(*[new.pop(c).alias(c) if c in new else F.col(c) for c in kept], *[c.alias(n) for n, c in new.items()])


def filled_forward(df: DataFrame, keys: list[str], order: str, columns: list[str], width: int | None = None) -> DataFrame:
    """Each null replaced by the last known value of its key so far; ``width`` as in ``last_known``."""
    return last_known(df, keys, [order], {c: c for c in columns}, width)


def reconciled(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, factor: str = "1") -> DataFrame:
    """Keys whose sums disagree after an exact conversion; a missing side counts 0."""
    x = left.groupBy(*keys).agg(F.sum(F.col(a) * F.lit(factor).cast("decimal(20,0)")).alias("_a"))
    y = right.groupBy(*keys).agg(F.sum(b).alias("_b"))
    both = x.join(y, keys, "full_outer").withColumns({"_a": F.coalesce("_a", F.lit(0)), "_b": F.coalesce("_b", F.lit(0))})
    return both.where("_a <> _b").select(*keys, F.col("_a").alias("converted"), F.col("_b").alias("reported"))
