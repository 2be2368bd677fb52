"""Work that grows with the rows, not with their pairs: rows that joins put out, and the same results."""

from pyspark.sql import functions as F

from blockwright.operators import crosschecks as C
from blockwright.operators import aggregates, joins, outcome
from blockwright.plans import market


def join_rows(df):
    """Rows of each join of the executed plan, the most first."""
    plan, out = df._jdf.queryExecution().executedPlan(), []
    plan.executeCollect()

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if name.endswith("JoinExec"):
            found = p.metrics().get("numOutputRows")
            out.extend([found.get().value()] if found.isDefined() else [])
        children = p.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return sorted(out, reverse=True)


def test_band_join_makes_no_pairs_of_a_key(spark):
    points = spark.range(-2000, 2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"), F.lit("p").alias("p"))
    ranges = spark.sql("SELECT id % 3 AS k, id * 50 AS a, id * 50 + CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN 39 ELSE -1 END AS b FROM range(-40, 40) UNION ALL VALUES (1L, -9223372036854775807L, 9223372036854775807L), (0L, NULL, 5L), (2L, 3L, NULL)")
    got = joins.band_join(points, ranges, ["k"], "x", "a", "b")
    plain = points.join(ranges, "k").where("x BETWEEN a AND b")
    assert got.columns == plain.columns and got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    assert join_rows(got.where("b < 9223372036854775807"))[0] <= 4 * 4000  # a point and width at most, and what matches
    dense = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    own = dense.where("x % 50 = 0").select("k", F.col("x").alias("a"), (F.col("x") + 4).alias("b"))
    few = joins.band_join(dense, own, ["k"], "x", "a", "b")
    assert few.count() == 300 and join_rows(few)[0] <= 3000


def test_band_join_of_times(spark):
    points = spark.sql("SELECT 1 AS k, timestamp_seconds(id) AS x FROM range(-300, 300)")
    ranges = spark.sql("SELECT 1 AS k, timestamp_millis(id * 7500 + 250) AS a, timestamp_millis(id * 7500 + 3000) AS b FROM range(-20, 20)")
    assert joins.band_join(points, ranges, ["k"], "x", "a", "b").count() == points.join(ranges, "k").where("x BETWEEN a AND b").count()


def test_uncovered_links_make_no_pairs_of_a_link(spark):
    n = 1000
    c = spark.range(n).select((F.col("id") % 7).alias("entity"), F.lit(1).alias("link"), (F.col("id") * 10).alias("observed_at"), F.lit(True).alias("listed"))
    p = spark.range(n).select(F.lit(1).alias("name"), (F.col("id") * 10 + 5).alias("observed_at"), (F.col("id") % 2 == 0).alias("listed"))
    plain = lambda a, b: sum(max(0, min(b, x + 10) - max(a, x)) for x in range(5, n * 10, 20))
    want = {10 * i: plain(10 * i, 10 * i + 70) if i + 7 < n else plain(10 * i, 10 * n + 100) for i in range(n)}
    for width in (None, 1 << 10):
        got = C.uncovered_links(c, p, ["entity"], "link", "name", width=width)
        assert {r["valid_from"]: r["covered"] for r in got.collect()} == want
        assert max(join_rows(got), default=0) <= 4 * n


def test_flatten_leaves_unused_lists_behind(spark):
    from blockwright.operators import flatten as FL

    blocks = spark.sql("SELECT id AS block_num, array(named_struct('a', id, 'big', array(1, 2), 'low', array(named_struct('x', 1, 'y', 2)))) AS rows, array(named_struct('t', 'unused')) AS other FROM range(3)")
    spec = FL.TableSpec("t", (FL.Level("rows", "i"), FL.Level("low", "j")), {"a": "e0.a", "x": "e1.x"})
    got = FL.flatten_table(blocks, spec)
    assert sorted(tuple(r) for r in got.collect()) == [(k, 0, 0, k, 1) for k in range(3)]
    assert "unused" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_tables_of_one_form_type_that_form_alone(spark):
    from blockwright.plans.queries_families import filed_blocks
    from blockwright.plans.specs import flatten_family

    from .conftest import DATA

    one = flatten_family(filed_blocks(spark, DATA), "sec", only={"form13f_holdings"})["form13f_holdings"]
    assert "tz_dropped" not in one._jdf.queryExecution().optimizedPlan().toString()
    assert "tz_dropped" in flatten_family(filed_blocks(spark, DATA), "sec", only={"parse_issues"})["parse_issues"]._jdf.queryExecution().optimizedPlan().toString()


def test_plain_texts_are_read_as_by_the_whole_road(spark):
    import datetime as dt
    from decimal import Decimal

    from blockwright.functions import parse as P

    texts = spark.createDataFrame([(t,) for t in ("5.", "+007.50", "-0", " 12.3 ", ".5", "1.2345678", "1" * 33, "N/A", "", None)], "t string")
    got = [tuple(r["p"]) for r in texts.select(P.parse_decimal(F.col("t"), 6).alias("p")).collect()]
    assert got == [(Decimal("5.000000"), None), (Decimal("7.500000"), None), (Decimal("0.000000"), None), (Decimal("12.300000"), None), (Decimal("0.500000"), None), (Decimal("1.234568"), "rounded"), (None, "out_of_range"), (None, "sentinel"), (None, None), (None, None)]
    days = spark.createDataFrame([(t,) for t in ("2021-03-04", " 2021-03-04 ", "2021-02-30", "0999-01-01", "2021-3-4", "2021-03-04Z", "")], "t string")
    day = dt.date(2021, 3, 4)
    assert [tuple(r["p"]) for r in days.select(P.parse_date(F.col("t")).alias("p")).collect()] == [(day, None), (day, None), (None, "out_of_range"), (None, "out_of_range"), (day, None), (day, "tz_dropped"), (None, None)]


def test_rows_before_in_small_ranges(spark, tmp_path):
    from pyspark.sql import Window

    from blockwright.operators import aggregates as A
    from blockwright.operators import layout

    rows = spark.range(400).where("id % 7 <> 0 AND NOT id BETWEEN 100 AND 230").select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 5 > 0, F.col("id") * 11 % 13).alias("v"))
    want = rows.withColumn("b", F.lag(F.struct("t", "v")).over(Window.partitionBy("k").orderBy("t")))
    got = A.row_before(rows, ["k"], "t", ["t", "v"], "b", 8)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    rows.coalesce(1).write.parquet(str(tmp_path / "x"))
    files = spark.read.parquet(str(tmp_path / "x"))
    assert layout.order_breaks(files, ["v"], width=8).count() == layout.order_breaks(files, ["v"], width=1 << 20).count() > 0
    assert "_range" in layout.order_breaks(files, ["v"])._jdf.queryExecution().optimizedPlan().toString()


def nodes(df):
    """The plan before execution, as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_votes_sorts_no_instructions_to_count_them(spark):
    tx = spark.createDataFrame([(1, 1, 0), (2, 2, 0), (3, 1, 0), (4, 1, 0), (5, 1, 1), (6, 1, 0), (7, 3, 0)], "k int, num_signatures int, num_lookups int")
    ins = spark.createDataFrame([(1, "vote", "tower_sync"), (2, "vote", "vote"), (3, "vote", "vote"), (3, None, None), (4, None, "vote"), (5, "vote", "vote"), (7, "vote", "vote")], "k int, program string, instruction_kind string")
    rest, votes = outcome.split_votes(tx, ins, ["k"])
    assert [r["k"] for r in votes.orderBy("k").collect()] == [1, 2] and [r["k"] for r in rest.orderBy("k").collect()] == [3, 4, 5, 6, 7]
    assert votes.columns == rest.columns == tx.columns and "SortAggregate" not in nodes(votes)


def test_shuffles_follow_bytes(spark):
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 200
    wide = spark.range(5_000_000).select(F.xxhash64("id").alias("k"), F.xxhash64(F.col("id") + 1).alias("v"))
    assert wide.groupBy("k").agg(F.max("v")).rdd.getNumPartitions() > 8  # the tests' number of shuffle partitions


def test_persistent_changes_deal_and_sort_changes_once(spark):
    names = "block_num long, tx_index int, call_index int, parent_index int, ordinal long, kind string, reason string, address string, state_reverted boolean"
    rows = [(1, 0, 1, 0, 5, "nonce", None, "a", True), (1, 0, 1, 0, 3, "nonce", None, "b", True), (1, 0, 1, 0, 7, "nonce", None, "b", True), (1, 0, 1, 0, 8, "nonce", None, "b", True), (1, 0, 1, 0, 9, "nonce", None, "a", True),
            (1, 0, 1, 0, 4, "code", None, "b", True), (1, 0, 1, 0, 6, "code", None, "b", True), (1, 0, 1, 0, 1, "balance", "GAS_BUY", "a", True), (1, 0, 2, 1, 2, "nonce", None, "a", True), (1, 1, 1, 0, 1, "nonce", None, None, False)]
    tx = spark.createDataFrame([(1, 0, False), (1, 1, True)], "block_num long, tx_index int, transaction_success boolean")
    auth = spark.createDataFrame([(1, 0, "b", False), (1, 0, "a", True)], "block_num long, tx_index int, authority string, discarded boolean")
    out = outcome.persistent_changes(spark.createDataFrame(rows, names), tx, auth)
    # the sender's is b's at 3; one more nonce and one code of b were authorized, a's authorization was discarded
    assert {(r["tx_index"], r["kind"], r["ordinal"]) for r in out.where("persisted").collect()} == {(0, "nonce", 3), (0, "nonce", 7), (0, "code", 4), (0, "balance", 1), (1, "nonce", 1)}
    none = tx.select("block_num", "tx_index", F.lit("a").alias("authority"), F.lit(False).alias("discarded")).limit(0)
    many = spark.range(100).selectExpr("id AS block_num", "CAST(id % 2 AS INT) AS tx_index", "id % 3 <> 0 AS transaction_success")
    changes = spark.createDataFrame(rows, names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = nodes(outcome.persistent_changes(changes, many, none))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 2  # one each of changes and transactions


def test_change_within_keeps_no_key_in_one_window(spark):
    rows = spark.sql("SELECT id % 2 AS k, id AS n, 1000 + id * 7 + CASE WHEN id % 13 > 6 THEN 40 ELSE 0 END + 300 * floor(id / 13) AS s, id * id % 101 AS v FROM range(400)")
    rows = rows.unionByName(spark.sql("SELECT 2L AS k, id AS n, id - 5 AS s, id % 3 AS v FROM range(10)"))
    for gap, width in ((60, 100), (60, 61), (200, 50), (0, 10)):
        plain, ranged = (aggregates.change_within(rows, ["k"], "n", "s", "v", gap, "c", width=w) for w in (None, width))
        assert ranged.columns == plain.columns and ranged.exceptAll(plain).count() == plain.exceptAll(ranged).count() == 0
        assert "_range" in nodes(ranged).split("Window [")[1].split("Exchange")[1]


def test_funding_rates_are_dealt_by_block_alone(spark):
    deltas = spark.sql("SELECT CAST(b AS BIGINT) AS block_num, CAST(e AS BIGINT) AS event_index, c AS coin, CAST(s AS DECIMAL(38,10)) AS szi, CAST(s AS DECIMAL(38,10)) AS funding_amount, CAST(1 AS DECIMAL(38,10)) AS funding_rate "
                       "FROM VALUES (1, 2, 'A', 1), (1, 2, 'A', -3), (1, 7, 'A', 2), (1, 7, 'B', 2), (2, 5, 'A', 1), (3, 1, 'A', 1) t(b, e, c, s)")
    headers = spark.sql("SELECT CAST(b AS BIGINT) AS block_num, CAST(e AS BIGINT) AS event_index FROM VALUES (1, 7), (1, 2), (1, 4), (2, 5), (4, 1) t(b, e)")
    rates = market.funding_rates(deltas, headers)
    assert {(r["block_num"], r["event_index"], r["coin"], r["dex_index"], int(r["open_interest"])) for r in rates.collect()} == {(1, 2, "A", 0, 4), (1, 7, "A", 2, 2), (1, 7, "B", 2, 2), (2, 5, "A", 0, 1)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = nodes(market.funding_rates(deltas, headers))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
