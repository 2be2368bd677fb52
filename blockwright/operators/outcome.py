"""Outcome of transactions, their failed children, and the changes a failed transaction keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What says that a transaction failed, by family, over the family's own columns.
FAILED = {
    "evm": "status IN ('FAILED', 'REVERTED')",
    "solana": "err IS NOT NULL",
    "tron": "NOT coalesce(result, false) OR coalesce(receipt_result, '') NOT IN ('', 'DEFAULT', 'SUCCESS')",
    "antelope": "exception IS NOT NULL OR lower(status) NOT IN ('executed', 'unknown')",
    "near": "status = 'Failure'",
    "cosmos": "coalesce(code, 0) <> 0",
}
#: whether failed transactions stay unless told otherwise
KEEPS_FAILED = {"evm": True, "solana": True, "tron": True, "antelope": True, "near": True, "cosmos": True}


def transaction_success(family: str) -> Column:
    """The family's rule; an unknown outcome counts as kept."""
    return ~F.coalesce(F.expr(FAILED[family]), F.lit(False))


def filter_failed(transactions: DataFrame, children: dict[str, DataFrame], keys: list[str], success: str = "transaction_success") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Without failed transactions and all their child rows; children of no transaction stay."""
    failed = transactions.where(~F.col(success)).select(*keys).distinct()
    return transactions.where(F.col(success)), {n: c.join(failed, keys, "left_anti") for n, c in children.items()}


def propagate_outcome(child: DataFrame, parent: DataFrame, keys: list[str], outcome: str = "transaction_success") -> DataFrame:
    return child.join(parent.select(*keys, outcome), keys, "left")


def split_votes(transactions: DataFrame, instructions: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(other, vote) transactions. A vote has one instruction of the vote program, of a vote kind, one or two signatures and no lookups;
    anything uncertain stays with the others."""
    # counts alone, as a largest text would have every task sort its instructions
    voting = (F.col("program") == "vote") & F.col("instruction_kind").isin("vote", "vote_switch", "update_vote_state", "compact_update_vote_state", "tower_sync")
    one = instructions.groupBy(*keys).agg(F.count("*").alias("_n"), F.count_if(voting).alias("_voting"))
    marked = transactions.join(one, keys, "left")
    vote = F.coalesce((F.col("_n") == 1) & (F.col("_voting") == 1) & F.col("num_signatures").between(1, 2) & (F.col("num_lookups") == 0), F.lit(False))
    drop = ["_n", "_voting", "_vote"]
    marked = marked.withColumn("_vote", vote)
    return marked.where(~F.col("_vote")).drop(*drop), marked.where("_vote").drop(*drop)


def persistent_changes(changes: DataFrame, transactions: DataFrame, authorizations: DataFrame) -> DataFrame:
    """``changes`` (block_num, tx_index, call_index, parent_index, ordinal, kind, reason, address, state_reverted) with ``persisted``.

    A transaction that succeeded keeps what no reverted call made. A failed one keeps gas, fee and mint balance changes of its root
    call, its first nonce change there, and one nonce and one code change for each accepted authorization of the address.
    Changes and authorizations of one address are matched in order, so each is used once.
    """
    tx = ["block_num", "tx_index"]
    root = F.col("parent_index") == 0
    paid = (F.col("kind") == "balance") & F.col("reason").isin("GAS_BUY", "GAS_REFUND", "REWARD_TRANSACTION_FEE", "INCREASE_MINT")
    # dealt by transaction and sorted once: an address's changes are numbered, the earliest of all addresses is found on the same order, and so is the transaction
    own, place = Window.partitionBy(*tx, "kind", "_root", "address").orderBy("ordinal"), F.struct("ordinal", "address")
    ranked = changes.repartition(*tx).withColumn("_root", root).withColumn("_k", F.row_number().over(own))
    ranked = ranked.withColumn("_earliest", F.min(F.when(F.col("_k") == 1, place)).over(Window.partitionBy(*tx, "kind", "_root")))
    ranked = ranked.join(transactions.select(*tx, "transaction_success"), tx)
    nonce = F.col("kind") == "nonce"
    sender_nonce = nonce & root & (F.col("_k") == 1) & place.eqNullSafe(F.col("_earliest"))
    other = F.col("kind").isin("nonce", "code") & root & ~sender_nonce
    after_sender = F.when(nonce & F.col("address").eqNullSafe(F.col("_earliest.address")), 1).otherwise(0)
    accepted = authorizations.where(~F.col("discarded")).groupBy(*tx, "authority").agg(F.count("*").alias("_accepted"))
    matched = ranked.join(accepted.withColumnRenamed("authority", "address"), [*tx, "address"], "left")
    kept = (root & paid) | sender_nonce | (other & (F.col("_k") - after_sender <= F.coalesce("_accepted", F.lit(0))))
    persisted = F.when(F.col("transaction_success"), ~F.col("state_reverted")).otherwise(F.coalesce(kept, F.lit(False)))
    return matched.withColumn("persisted", persisted).select(*changes.columns, "persisted")


# Balance changes that a failed transaction keeps.
KEPT_REASONS = ["GAS_BUY", "GAS_REFUND", "REWARD_TRANSACTION_FEE", "INCREASE_MINT"]


def once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` looks at it: inside a list's function Spark computes an expression anew at each place and for each element."""
    return F.get(F.transform(F.array(value), then), 0)


def kept_in_order(changes: Column, authorities: Column, sender: bool) -> Column:
    """Changes of a failed transaction's root call that stay: with ``sender`` the earliest of all, then for each address as many of the earliest
    others as accepted authorizations name it. Earliest by ordinal, then by place; what stays keeps its place."""
    order = F.array_sort(F.transform(changes, lambda c, i: F.struct(c["ordinal"].alias("o"), i.alias("i"), c["address"].alias("a"))))

    def places(x: Column) -> Column:
        rest = F.slice(x["order"], F.lit(2), F.greatest(F.size(x["order"]) - 1, F.lit(0))) if sender else x["order"]

        def of(a: Column) -> Column:
            own = F.transform(F.filter(rest, lambda y: y["a"] == a), lambda y: y["i"])
            return F.slice(own, F.lit(1), F.size(F.filter(x["named"], lambda t: t == a)))

        more = F.flatten(F.transform(F.array_distinct(x["named"]), of))
        return F.concat(F.transform(F.slice(x["order"], 1, 1), lambda y: y["i"]), more) if sender else more

    held = F.struct(order.alias("order"), authorities.alias("named"))
    return once(held, lambda x: once(places(x), lambda kept: F.filter(changes, lambda c, i: F.array_contains(kept, i))))


def with_persisted_changes(transaction: Column, kind: T.StructType) -> Column:
    """A nested transaction whose calls say ``persisted`` and whose changes are what the tables hold: all of one that succeeded, and of one that
    failed what the chain keeps, which is marked persisted. Works inside the transaction's own lists, so nothing is joined or shuffled."""
    have = set(kind.fieldNames())
    call = kind["calls"].dataType.elementType
    lists = {f.name for f in call.fields if isinstance(f.dataType, T.ArrayType)}
    failed = F.coalesce(transaction["status"].isin("FAILED", "REVERTED", "UNKNOWN"), F.lit(False)) if "status" in have else F.lit(False)
    accepted = F.array().cast("array<string>")
    if "set_code_authorizations" in have:
        authority = kind["set_code_authorizations"].dataType.elementType["authority"].dataType
        named = F.filter(transaction["set_code_authorizations"], lambda a: ~F.coalesce(a["discarded"], F.lit(False)) & (F.length(a["authority"]) > 0))
        accepted = F.coalesce(F.transform(named, lambda a: a["authority"]), F.array().cast(T.ArrayType(authority)))

    def one(c: Column, i: Column) -> Column:
        reverted = F.coalesce(c["state_reverted"], F.lit(False)) if "state_reverted" in call.fieldNames() else F.lit(False)
        out = c.withField("persisted", failed | ~reverted)
        root = i == 0
        for name in ("balance_changes", "code_changes", "storage_changes", "nonce_changes", "account_creations"):
            if name not in lists:
                continue
            changes, fields = c[name], set(call[name].dataType.elementType.fieldNames())
            kept = F.slice(changes, 1, 0)
            if name == "balance_changes" and "reason" in fields:
                kept = F.when(root, F.filter(changes, lambda b: b["reason"].isin(KEPT_REASONS))).otherwise(kept)
            elif name in ("nonce_changes", "code_changes") and {"ordinal", "address"} <= fields:
                kept = F.when(root, kept_in_order(changes, accepted, sender=name == "nonce_changes")).otherwise(kept)
            out = out.withField(name, F.when(failed, kept).otherwise(changes))
        return out

    return transaction.withField("calls", F.transform(transaction["calls"], one))


def rpc_log_export(logs: DataFrame) -> DataFrame:
    """Log rows under the names and numbering of node interfaces: the index in the block, not in the transaction."""
    return logs.select("block_num", F.col("tx_index").alias("transactionIndex"), F.col("block_index").alias("logIndex"), F.col("log_index").alias("transactionLogIndex"), "address", "data")
