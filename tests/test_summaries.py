"""Run summaries: parts checked by themselves and where they meet find what a scan of all blocks finds."""

import random

import pytest
from pyspark.sql import functions as F

from blockwright.operators import quality as Q

SHAPE = "block_num long, block_id string, parent_id string, ts long, part long"


def chain(seed, n=300):
    r = random.Random(seed)
    rows, last = [], "g"
    for k in range(n):
        if r.random() < 0.05:
            continue
        own = f"b{k}"
        rows.append((k, own, last if r.random() > 0.05 else "x", None if r.random() < 0.3 else 1000 + k * 10 - (500 if r.random() < 0.05 else 0)))
        if r.random() < 0.05:
            rows.append((k, own + "c", last, 1000 + k * 10))
        last = own
    return rows


def cut(rows, seed, parts):
    r = random.Random(seed)
    rows = sorted(rows)
    cuts = sorted(r.sample(range(1, len(rows)), parts - 1))
    return [(*row, sum(i >= c for c in cuts) * 7 % 5 * 100 + sum(i >= c for c in cuts)) for i, row in enumerate(rows)]


def found(df):
    return sorted((r["kind"], r["block_num"], r["previous"], r["severity"]) for r in df.collect())


@pytest.mark.parametrize(("seed", "parts"), [(1, 2), (2, 9), (3, 60), (4, 250)])
def test_equal_to_the_whole_scan(spark, seed, parts):
    rows = cut(chain(seed), seed, parts)
    df = spark.createDataFrame(rows, SHAPE)
    whole = found(Q.validate_blocks(df, width=40))
    assert {k for k, *_ in whole} >= {"gap", "broken_parent", "time_reversal"}
    summaries = Q.part_summaries(df, "part", width=40)
    assert found(Q.part_problems(df, "part", width=40).unionByName(Q.joined_problems(summaries, "part"))) == whole
    assert found(Q.part_problems(df, "part", True).unionByName(Q.joined_problems(summaries, "part", True))) == found(Q.validate_blocks(df, True))
    assert summaries.agg(F.sum("blocks")).first()[0] == len(rows)


def test_merging_in_any_grouping_gives_the_same_summary(spark):
    rows = cut(chain(5, 120), 5, 12)
    df = spark.createDataFrame(rows, SHAPE)
    parts = Q.part_summaries(df, "part")
    want = tuple(Q.part_summaries(df.withColumn("part", F.lit(0)), "part").select(*Q.SUMMARY).first())
    assert tuple(Q.merged_summary(parts).select(*Q.SUMMARY).first()) == want
    middle = sorted(r["first_num"] for r in parts.collect())[5]
    two = Q.merged_summary(parts.where(F.col("first_num") < middle)).unionByName(Q.merged_summary(parts.where(F.col("first_num") >= middle)))
    assert tuple(Q.merged_summary(two).select(*Q.SUMMARY).first()) == want


def test_a_new_day_needs_no_old_block(spark):
    rows = [(k, f"b{k}", f"b{k - 1}", k, k // 10) for k in range(30)]
    old = Q.part_summaries(spark.createDataFrame(rows[:20], SHAPE), "part")
    day = spark.createDataFrame([(k, i, "other" if k == 20 else p, t, d) for k, i, p, t, d in rows[20:]], SHAPE)
    both = old.unionByName(Q.part_summaries(day, "part"))
    assert found(Q.joined_problems(both, "part")) == [("broken_parent", 20, 19, "error")]
    assert [tuple(r) for r in Q.sealed_by_summaries(both, Q.joined_problems(both, "part"), 0, 31).collect()] == [("broken_parent", 20), ("missing_end", 30)]


def test_parts_that_interlock_are_named(spark):
    rows = [(k, f"b{k}", f"b{k - 1}", k, k % 2) for k in range(10)]
    s = Q.part_summaries(spark.createDataFrame(rows, SHAPE), "part")
    assert [(r["part"], r["kind"], r["block_num"], r["previous"]) for r in Q.joined_problems(s, "part").collect()] == [(1, "overlap", 1, 8)]
