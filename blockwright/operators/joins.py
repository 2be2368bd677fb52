"""Joins beyond plain equality: bands, as-of, time ranges, chains and lineages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def band_join(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, begin: str, end: str) -> DataFrame:
    """Points inside [begin, end] of the same key, both ends included; integers or times.

    A range goes to the one or two buckets it touches, of the smallest power of two that holds it; a point looks into its bucket of every such width there is
    (at most 64). So the equality key bounds the pairs by the matches, whatever a key's size.
    """
    def whole(df: DataFrame, c: str) -> Column:
        kind = df.select(c).schema[0].dataType
        return (F.col(c).cast("timestamp") if isinstance(kind, (T.DateType, T.TimestampNTZType)) else F.col(c) if isinstance(kind, (T.IntegralType, T.TimestampType)) else F.floor(c)).cast("long")

    shifted = lambda x, by: F.call_function("shiftright", x, by)
    bounded = ranges.where(F.col(begin) <= F.col(end)).withColumns({"_begin": whole(ranges, begin), "_end": whole(ranges, end)})
    half = F.shiftright("_end", 1) - F.shiftright("_begin", 1)  # can't overflow
    wide = bounded.withColumn("_width", F.least(F.length(F.bin(half)) + 1, F.lit(63)))
    held = wide.withColumn("_bucket", F.explode(F.sequence(shifted(F.col("_begin"), F.col("_width")), shifted(F.col("_end"), F.col("_width"))))).drop("_begin", "_end")
    seen = points.crossJoin(F.broadcast(wide.select("_width").distinct())).withColumn("_bucket", shifted(whole(points, point), F.col("_width")))
    return seen.join(held, [*keys, "_width", "_bucket"]).where(F.col(point).between(F.col(begin), F.col(end))).drop("_width", "_bucket")


def asof_join(facts: DataFrame, history: DataFrame, keys: list[str], time: str, valid_from: str, columns: list[str], width: int | None = None) -> DataFrame:
    """Each fact with the history row valid at its time (the latest with valid_from <= time), nulls where there is none.

    One union and one window over (key, time): linear in both sides, whatever the number of versions of a key. With ``width``
    (numeric times) the window stays inside ranges of that many units, and one row a key and range is carried on, so that a busy key is no single task.
    """
    from blockwright.operators.aggregates import last_known

    held = F.struct(*columns)
    left = facts.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), F.struct(*facts.columns).alias("_fact"), F.lit(None).cast(history.select(held.alias("h")).schema["h"].dataType).alias("_held"))
    right = history.select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_fact"].dataType).alias("_fact"), held.alias("_held"))
    seen = last_known(left.unionByName(right), keys, ["_t", "_side"], {"_now": "_held"}, width).where("_side = 1")
    return seen.select("_fact.*", *[F.col(f"_now.{c}").alias(c) for c in columns])


def range_join(facts: DataFrame, anchors: DataFrame, time: str, anchor: str, seconds: int) -> DataFrame:
    """Facts in the ``seconds`` before an anchor: [anchor - seconds, anchor). Epoch-second columns; a bucket of that width is the
    equality key and an anchor looks into two of them."""
    left = facts.withColumn("_b", F.floor(F.col(time) / seconds))
    right = anchors.withColumn("_b", F.explode(F.array(F.floor(F.col(anchor) / seconds), F.floor(F.col(anchor) / seconds) - 1)))
    return left.join(right, "_b").where((F.col(time) < F.col(anchor)) & (F.col(time) >= F.col(anchor) - seconds)).drop("_b")


def adjacent_legs(df: DataFrame, keys: list[str], index: str, same: list[str]) -> DataFrame:
    """Pairs (a, b) of rows that follow each other and agree on ``same``; structs of all columns. A window, not a self-join."""
    w = Window.partitionBy(*keys).orderBy(index)
    both = df.select(F.struct(*df.columns).alias("a"), F.lead(F.struct(*df.columns)).over(w).alias("b"))
    agree = F.col(f"b.{index}") == F.col(f"a.{index}") + 1
    for c in same:
        agree = agree & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return both.where(agree)


def spend_join(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs with the output they spend; a coinbase input has no previous output and drops out before the shuffle."""
    spends = inputs.where("prev_txid is not null and prev_vout is not null")
    spent = outputs.select(F.col("tx_hash").alias("prev_txid"), F.col("output_index").alias("prev_vout"), F.col("value_sats").alias("spent_sats"))
    return spends.join(spent, ["prev_txid", "prev_vout"])


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """All (root, node, depth) reachable along edges (parent, child), each pair once at its least depth; cycles end.

    Each round joins only the newest pairs, leaves out the ones seen, and appends its pairs to one stored table; rounds go on until one finds nothing.
    """
    from blockwright.sources.tables import shared_path

    spark, path = edges.sparkSession, shared_path(edges.sparkSession, "descendants")
    pairs = roots.select(F.col("node").alias("root"), "node", F.lit(0).alias("depth")).distinct()
    schema, k = pairs.schema, 0
    while True:
        pairs.write.parquet(f"{path}/round={k}")
        newest = spark.read.schema(schema).parquet(f"{path}/round={k}")
        seen = spark.read.schema(schema).parquet(path)
        if newest.isEmpty():
            return seen.select("root", "node", "depth")
        k += 1
        step = newest.join(edges, newest["node"] == edges["parent"]).select("root", F.col("child").alias("node"), F.lit(k).alias("depth")).distinct()
        pairs = step.join(seen.select("root", "node"), ["root", "node"], "left_anti").select("root", "node", "depth")


def last_in_chain(links: DataFrame) -> DataFrame:
    """For each (node, next): the node its chain ends at and how far; doubled jumps, so rounds grow with the log of the length.

    ``next`` null ends a chain; a next that has no row leaves the range and gives last = null (pending). Nodes on a cycle, or that lead into one,
    give no row. Only unfinished nodes go on to the next round; a round that finishes none leaves nothing but cycles, and is the last.
    """
    from blockwright.sources.tables import stored_table

    first = links.select("node", F.col("next").alias("up"), F.when(F.col("next").isNull(), F.col("node")).alias("last"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    ended = [stored_table(first.where("up is null"), "chain-ends")]
    open_ = stored_table(first.where("up is not null"), "chain-open")
    while True:
        done = ended[0]
        for part in ended[1:]:
            done = done.unionByName(part)
        far = done.unionByName(open_).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("last").alias("last2"), F.col("depth").alias("depth2"))
        stepped = open_.join(far, "up", "left").select("node", F.col("up2").alias("up"), F.col("last2").alias("last"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"))
        stepped = stored_table(stepped, "chain-step")
        now = stepped.where("up is null")
        if now.isEmpty():
            return done.select("node", "last", "depth")
        ended.append(now)
        open_ = stepped.where("up is not null")


def same_block_lineage(receipts: DataFrame, transactions: DataFrame) -> DataFrame:
    """The transaction a receipt was converted from in its own block; null where it came from elsewhere."""
    origin = transactions.select("block_num", F.col("converted_into_receipt_id").alias("receipt_id"), F.col("hash").alias("tx_hash"))
    return receipts.join(origin, ["block_num", "receipt_id"], "left")


def bounded_broadcast(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Broadcast a dimension only if it has at most so many rows; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def decoded(df: DataFrame, code: str, legend: dict[str, str], name: str) -> DataFrame:
    """Codes with their legend's text by a broadcast join (a legend is a literal of the caller); unknown codes give null."""
    table = df.sparkSession.createDataFrame(list(legend.items()), f"`{code}` string, `{name}` string")
    return df.join(F.broadcast(table), code, "left")


def differs(a: Column, b: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)
