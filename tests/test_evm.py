"""Changes that last, block-level changes, and order keys of the EVM tables."""

import random

import pytest
from pyspark.sql import functions as F

from blockwright.operators import layout
from blockwright.plans.specs import flatten_family
from blockwright.sources import tables as ST

CHANGE = "array<struct<ordinal: long, address: string>>"
SHAPE = f"""block_num long, timestamp timestamp, transactions array<struct<hash: string, status: string, set_code_authorizations: array<struct<authority: string, discarded: boolean>>,
  access_list: array<struct<address: string>>, receipt: struct<logs: array<struct<block_index: long, address: string>>>,
  calls: array<struct<index: long, state_reverted: boolean, balance_changes: array<struct<ordinal: long, address: string, reason: string>>, nonce_changes: {CHANGE}, code_changes: {CHANGE}, storage_changes: {CHANGE}, gas_changes: array<struct<ordinal: long>>, account_creations: {CHANGE}>>>>,
  withdrawals array<struct<index: long>>, balance_changes {CHANGE}, code_changes {CHANGE},
  system_calls array<struct<index: long, begin_ordinal: long, balance_changes: {CHANGE}, storage_changes: {CHANGE}, nonce_changes: {CHANGE}, code_changes: {CHANGE}, gas_changes: {CHANGE}, account_creations: {CHANGE}>>"""


def kept(changes, authorities, sender):
    """The rule as a loop over authorizations."""
    order = sorted(range(len(changes)), key=lambda i: (changes[i][0], i))
    out = order[:1] if sender else []
    for a in authorities:
        out += next(([i] for i in order if changes[i][1] == a and i not in out), [])
    return [changes[i] for i in sorted(out)]


def transaction(r, n):
    changes = lambda k: [(r.randrange(4), r.choice("abc")) for _ in range(r.randrange(k))]
    call = lambda i: (i + 1, r.random() < 0.4, [(r.randrange(9), "a", r.choice(["GAS_BUY", "TRANSFER", "INCREASE_MINT"])) for _ in range(r.randrange(4))], changes(8), changes(6), changes(3), [(r.randrange(9),)], changes(2))
    return (f"t{n}", r.choice(["SUCCEEDED", "FAILED", "REVERTED", None]), r.choice([None, [(r.choice(["a", "b", "c", "", None]), r.random() < 0.3) for _ in range(r.randrange(6))]]), [("x",), ("y",)], ([(n, "l")],), [call(i) for i in range(r.randrange(4))])


def blocks(seed=3, n=40):
    import datetime as dt

    r = random.Random(seed)
    system = lambda: [(9 + k, k, [(1, "s")], [(2, "s")], [(3, "s")], [(4, "s")], [(5, "s")], [(6, "s")]) for k in range(2)]
    return [(b, dt.datetime(2026, 1, 1 + b % 2), [transaction(r, 10 * b + k) for k in range(r.randrange(5))], [(b,)], r.choice([None, [(7, "r")]]), [], system()) for b in range(n)]


@pytest.mark.parametrize("seed", [3, 4])
def test_changes_that_last(spark, seed):
    data = blocks(seed)
    out = flatten_family(spark.createDataFrame(data, SHAPE), "evm")
    want = {t: [] for t in ("balance_changes", "nonce_changes", "code_changes", "storage_changes", "gas_changes", "account_creations")}
    for b, _, txs, *_ in data:
        for k, (_, status, auths, _, _, calls) in enumerate(txs):
            failed = status in ("FAILED", "REVERTED")
            named = [a for a, gone in auths or [] if not gone and a]
            for i, (index, reverted, bal, non, cod, sto, gas, acc) in enumerate(calls):
                root = failed and i == 0
                lists = {"balance_changes": [x[:2] for x in bal if not failed or (root and x[2] != "TRANSFER")], "nonce_changes": non if not failed else kept(non, named, True) if root else [], "code_changes": cod if not failed else kept(cod, named, False) if root else [],
                         "storage_changes": [] if failed else sto, "gas_changes": [(g[0], None) for g in gas], "account_creations": [] if failed else acc}
                for t, rows in lists.items():
                    want[t] += [(b, k, index, o, a, reverted, failed or not reverted) for o, a in rows]
    for t, rows in want.items():
        df = out[t] if "address" in out[t].columns else out[t].withColumn("address", F.lit(None).cast("string"))
        got = [tuple(r) for r in df.select("block_num", "tx_index", "call_index", "ordinal", "address", "state_reverted", "persisted").collect()]
        assert sorted(map(str, got)) == sorted(map(str, rows)), t


def test_block_level_changes_have_no_call(spark):
    out = flatten_family(spark.createDataFrame(blocks(n=6), SHAPE), "evm")
    got = {(r["block_num"], r["call_index"], r["address"], r["ordinal"]) for r in out["system_balance_changes"].collect()}
    want = {(b[0], i, "s", 1) for b in blocks(n=6) for i in (9, 10)} | {(b[0], None, "r", 7) for b in blocks(n=6) if b[4]}
    assert got == want
    assert out["system_storage_changes"].where("call_index IS NULL").count() == 0 and out["system_storage_changes"].count() == 12


def test_every_table_is_compacted_by_its_order_key(spark, tmp_path):
    out = flatten_family(spark.createDataFrame(blocks(n=6), SHAPE), "evm")
    assert {"access_index"} <= set(out["access_lists"].columns) and {"call_index"} <= set(out["calls"].columns) and "persisted" not in out["calls"].columns
    known = {t: df for t, df in out.items() if t in layout.ROW_ORDER}
    assert set(known) == set(out) and len(known) >= 17
    for t, df in known.items():
        assert df.select(*layout.row_order_key(t)).columns  # the key resolves against the table's own columns
    few = {t: known[t] for t in ("calls", "access_lists", "system_code_changes", "blocks")}
    ST.write_tables(few, str(tmp_path))
    days = spark.read.parquet(f"{tmp_path}/blocks").select("date").distinct()
    for t, df in few.items():
        done = layout.compact_closed_dates(spark, str(tmp_path), t, f"{tmp_path}/c", days)
        assert done.agg(F.sum("rows")).first()[0] == df.count()


def test_only_the_lists_of_asked_tables_are_marked(spark):
    from blockwright.plans import specs

    call = "struct<index:bigint,balance_changes:array<struct<ordinal:bigint>>,nonce_changes:array<struct<ordinal:bigint,address:string>>,code_changes:array<struct<ordinal:bigint,address:string>>>"
    blocks = spark.createDataFrame([], f"block_num long, transactions array<struct<status:string,calls:array<{call}>>>")
    kept = specs.needed_changes(blocks, [specs.FAMILIES["evm"]["nonce_changes"]]).schema["transactions"].dataType.elementType["calls"].dataType.elementType
    assert kept.fieldNames() == ["index", "nonce_changes"]
    assert "nonce_changes" in specs.flatten_family(blocks, "evm", only={"nonce_changes"}) and "persisted" in specs.flatten_family(blocks, "evm", only={"nonce_changes"})["nonce_changes"].columns


@pytest.mark.parametrize("seed", [5, 6])
def test_changes_of_several_kinds_from_one_pass(spark, seed):
    from blockwright.plans.specs import evm_changes

    df, kinds, columns = spark.createDataFrame(blocks(seed), SHAPE), ["balance", "nonce", "code", "storage"], ["block_num", "tx_index", "call_index", "change_position", "ordinal", "address", "state_reverted", "persisted"]
    out = flatten_family(df, "evm")
    want = [(k, *r) for k in kinds for r in out[f"{k}_changes"].select(*columns).collect()]
    assert sorted(map(str, (tuple(r) for r in evm_changes(df, kinds).select("kind", *columns).collect()))) == sorted(map(str, want))


def test_what_stays_is_computed_once_a_list(spark):
    from blockwright.operators.outcome import kept_in_order

    shown = str(kept_in_order(F.col("changes"), F.filter("named", lambda x: F.length(x) > 0), sender=True))
    assert shown.count("array_sort") == 1 and shown.count("length") == 1
