"""Table specs of the chain families, as paths into the nested block.

A table is written ``list@position list@position | carried columns``: one explode a list (``list?@position`` keeps a parent whose list is empty),
positions count source items, ``>message`` takes an optional message of the element above as the row, and the carried SQL copies what children need from the elements above (``e0``, ``e1``, ...; ``block``).
Every other column follows one rule (``own_columns``): the deepest element's fields, structs flattened with their names joined by ``_``,
lists of messages left out, as those have tables of their own.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.functions.labels import BODY_TABLES, DIRECTIONS, LEDGER_TABLES, LEVERAGE_TYPES, SIDES, event_table
from blockwright.functions.schema import AMOUNT, IDENTITY
from blockwright.operators.flatten import FlattenSpec, Level, TableSpec, cases, flatten, flatten_table, routed, union_by_name
from blockwright.operators.outcome import with_persisted_changes
from blockwright.operators.validate import Checks, with_errors
from blockwright.plans.market import funding_rates, liquidations, outcome_fills, with_counterparty, with_market
from blockwright.plans.sec import BODIES, parse_issues, sec_tables, typed_filings

_TX = "e0.hash AS tx_hash"
_SOLANA = "e0.transaction_success AS transaction_success, e0.is_vote AS is_vote"
_FILING = "e0.accession_number AS accession_number, e0.form_type AS form_type, e0.filing_date AS filing_date, e0.acceptance_datetime AS acceptance_datetime"
_CALL = "e0.hash AS tx_hash, e1.index AS call_index"

# Table names and the lists of the nested blocks they come from.
FAMILIES: dict[str, dict[str, str]] = {
    "evm": {
        "blocks": "", "transactions": "transactions@index", "logs": f"transactions@tx_index receipt.logs@log_index | {_TX}, get(e1.topics, 0) AS topic0, get(e1.topics, 1) AS topic1, get(e1.topics, 2) AS topic2, get(e1.topics, 3) AS topic3",
        "withdrawals": "withdrawals@position", "access_lists": f"transactions@tx_index access_list@access_index | {_TX}", "set_code_authorizations": f"transactions@tx_index set_code_authorizations@authorization_index | {_TX}",
        "calls": f"transactions@tx_index calls@call_position | {_CALL}",
        **{t: f"transactions@tx_index calls@call_position {t}@change_position | {_CALL}, e1.state_reverted AS state_reverted, e1.persisted AS persisted" for t in ("balance_changes", "code_changes", "storage_changes", "nonce_changes", "gas_changes", "account_creations")},
        "system_calls": "system_calls@position",
        **{f"system_{t}": f"system_{t}@change_position" for t in ("balance_changes", "code_changes", "storage_changes", "nonce_changes", "gas_changes", "account_creations")},
    },
    "bitcoin": {"blocks": "", "transactions": "tx@tx_index", "inputs": "tx@tx_index vin@input_index | e0.txid AS tx_hash", "outputs": "tx@tx_index vout@output_index | e0.txid AS tx_hash"},
    "solana": {
        "blocks": "",
        "transactions": f"transactions@transaction_index | {_SOLANA}",
        "vote_transactions": f"transactions@transaction_index | {_SOLANA}",
        "messages": f"transactions@transaction_index messages@message_index | {_SOLANA}",
        "token_balances": f"transactions@transaction_index token_balances@balance_index | {_SOLANA}",
        "account_lookups": f"transactions@transaction_index address_table_lookups@lookup_index | {_SOLANA}",
        "instructions": f"transactions@transaction_index instructions@instruction_index | {_SOLANA}",
        "rewards": "rewards@reward_index",
    },
    "near": {
        "blocks": "", "chunks": "chunks@chunk_index", "transactions": "transactions@transaction_index", "receipts": "receipts@receipt_index", "receipt_actions": "receipts@receipt_index actions@action_index | e0.receipt_id AS receipt_id",
        "execution_logs": "receipts@receipt_index logs@log_index | e0.receipt_id AS receipt_id, e1 AS log", "state_changes": "state_changes@change_index",
    },
    "antelope": {"blocks": "", "transactions": "transaction_traces@index", "actions": "transaction_traces@tx_index action_traces@action_index | e0.id AS tx_hash", "db_ops": "transaction_traces@tx_index db_ops@db_op_index | e0.id AS tx_hash"},
    "cosmos": {"blocks": "", "transactions": "txs@index", "events": "events@event_index attributes?@attribute_index | e0.type AS type", "messages": "txs@tx_index messages@message_index",
               "tx_events": "txs@tx_index events@event_index attributes?@attribute_index | e0.hash AS tx_hash, e1.type AS type"},
    "tron": {
        "blocks": "", "transactions": "transactions@transaction_index", "logs": "transactions@transaction_index log@log_index | e0.txid AS tx_hash", "internal_transactions": "transactions@transaction_index internal_transactions@internal_index | e0.txid AS tx_hash",
        "contracts": "transactions@transaction_index contracts@contract_index | e0.txid AS tx_hash", "internal_call_values": "transactions@transaction_index internal_transactions@internal_index call_value_info@value_index | e0.txid AS tx_hash",
    },
    "beacon": {"blocks": "", **{t: f"body.{t}@{i}" for t, i in (("attestations", "attestation_index"), ("deposits", "deposit_index"), ("proposer_slashings", "slashing_index"), ("attester_slashings", "slashing_index"), ("voluntary_exits", "exit_index"), ("blob_sidecars", "sidecar_index"), ("withdrawals", "withdrawal_index"),
                                                                ("bls_to_execution_changes", "change_index"), ("deposit_requests", "request_index"), ("withdrawal_requests", "request_index"), ("consolidation_requests", "request_index"))}},
    "hypercore": {"blocks": "", "fills": "fills@fill_index", "events": "events@event_index", "funding_deltas": "events@event_index funding.deltas@delta_index", "validator_rewards": "events@event_index validator_rewards.rewards@reward_index"},
    "sec": {
        "blocks": "",
        "filings": "filings@filing_index",
        "filing_parties": f"filings@filing_index parties@party_index | {_FILING}",
        "filing_documents": f"filings@filing_index documents@document_index | {_FILING}",
        "filing_series": f"filings@filing_index series@series_index | {_FILING}",
        "filing_series_classes": f"filings@filing_index series@series_index classes@class_index | {_FILING}, e1.series_id AS series_id",
        "filing_signatures": f"filings@filing_index signatures@signature_index | {_FILING}",
        "ownership_documents": f"filings@filing_index >ownership | {_FILING}",
        "ownership_reporting_owners": f"filings@filing_index ownership.reporting_owners@owner_index | {_FILING}",
        "ownership_transactions": f"filings@filing_index ownership.transactions@transaction_index | {_FILING}",
        "ownership_holdings": f"filings@filing_index ownership.holdings@holding_index | {_FILING}",
        "ownership_footnotes": f"filings@filing_index ownership.footnotes@footnote_index | {_FILING}",
        "form13f_reports": f"filings@filing_index >form13f | {_FILING}",
        "form13f_other_managers": f"filings@filing_index form13f.other_managers@other_manager_index | {_FILING}",
        "form13f_holdings": f"filings@filing_index form13f.holdings@holding_index | {_FILING}",
        "beneficial_reports": f"filings@filing_index >beneficial | {_FILING}",
        "beneficial_reporting_persons": f"filings@filing_index beneficial.reporting_persons@person_index | {_FILING}",
        "form144_notices": f"filings@filing_index >form144 | {_FILING}",
        "form144_securities_information": f"filings@filing_index form144.securities_information_entries@entry_index | {_FILING}",
        "form144_securities_to_be_sold": f"filings@filing_index form144.securities_to_be_sold@lot_index | {_FILING}",
        "form144_sales_past_3_months": f"filings@filing_index form144.securities_sold_past_3_months@sale_index | {_FILING}",
        "nport_reports": f"filings@filing_index >nport | {_FILING}",
        "nport_monthly_returns": f"filings@filing_index nport.fund_info.monthly_total_returns@return_index | {_FILING}",
        "nport_monthly_activity": f"filings@filing_index nport.fund_info.monthly_activity@activity_index | {_FILING}",
        "nport_holdings": f"filings@filing_index nport.holdings@holding_index | {_FILING}",
        "nport_debt_reference_instruments": f"filings@filing_index nport.holdings@holding_index debt_security.reference_instruments@reference_index | {_FILING}",
        "nport_debt_conversion_currencies": f"filings@filing_index nport.holdings@holding_index debt_security.conversion_currencies@conversion_index | {_FILING}",
        "nport_derivatives": f"filings@filing_index nport.holdings@holding_index derivatives@nesting_level | {_FILING}",
        "nport_derivative_swap_legs": f"filings@filing_index nport.holdings@holding_index derivatives@nesting_level legs@leg_index | {_FILING}",
        "nport_derivative_index_components": f"filings@filing_index nport.holdings@holding_index derivatives@nesting_level ref_index_components@component_index | {_FILING}",
        "form_d_notices": f"filings@filing_index >form_d | {_FILING}",
        "form_d_co_issuers": f"filings@filing_index form_d.issuers@co_issuer_index | {_FILING}",
        "form_d_related_persons": f"filings@filing_index form_d.related_persons@person_index | {_FILING}",
        "form_d_sales_recipients": f"filings@filing_index form_d.sales_compensation_recipients@recipient_index | {_FILING}",
        "npx_reports": f"filings@filing_index >npx | {_FILING}",
        "npx_votes": f"filings@filing_index npx.votes@vote_index | {_FILING}",
        "npx_vote_records": f"filings@filing_index npx.votes@vote_index records@record_index | {_FILING}, e1.cusip_norm AS cusip_norm",
        "npx_other_managers": f"filings@filing_index npx.other_managers@other_manager_index | {_FILING}",
        "ncen_reports": f"filings@filing_index >ncen | {_FILING}",
        "form_c_notices": f"filings@filing_index >form_c | {_FILING}",
        "form_c_co_issuers": f"filings@filing_index form_c.co_issuers@co_issuer_index | {_FILING}",
    },
}


def _type_at(kind: T.DataType, path: str) -> T.DataType | None:
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return None
        kind = kind[name].dataType
    return kind


def own_columns(kind: T.DataType, at: str, prefix: str = "") -> dict[str, str]:
    """Output column -> SQL for each field of a message that is no list of messages; messages with issues of their own are rows of another table."""
    out: dict[str, str] = {}
    for f in kind.fields if isinstance(kind, T.StructType) else []:
        if isinstance(f.dataType, T.StructType):
            if prefix + f.name != "header" and "_issues" in f.dataType.fieldNames():
                continue
            out |= own_columns(f.dataType, f"{at}.{f.name}", f"{prefix}{f.name}_")
        elif not (isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)):
            out[prefix + f.name] = f"{at}.{f.name}"
    return out


def _split(sql: str) -> list[str]:
    """A list of select items, cut at commas outside parentheses."""
    out, depth, item = [], 0, ""
    for c in sql:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(item)
            item = ""
        else:
            item += c
    return [x.strip() for x in [*out, item] if x.strip()]


def table_spec(name: str, text: str, schema: T.StructType) -> TableSpec | None:
    """The spec of one table for blocks of this schema; None where the schema lacks one of its lists."""
    paths, _, carried = text.partition("|")
    kind: T.DataType | None = schema
    levels: list[Level] = []
    message, kinds = "", {"block": schema}
    for part in paths.split():
        if part.startswith(">"):
            message, kind = part[1:], _type_at(kind, part[1:])
            if kind is None:
                return None
            levels[-1] = replace(levels[-1], where=f"e{len(levels) - 1}.{message} IS NOT NULL")
            continue
        path, position = part.split("@")
        found = _type_at(kind, path.removesuffix("?")) if kind is not None else None
        if not isinstance(found, T.ArrayType):
            return None
        kind = found.elementType
        kinds[f"e{len(levels)}"] = kind
        levels.append(Level(path.removesuffix("?"), position, outer=path.endswith("?")))
    at = (f"e{len(levels) - 1}" if levels else "block") + (f".{message}" if message else "")
    taken = {*IDENTITY, *(x.position for x in levels)}
    columns = {c: sql for c, sql in own_columns(kind, at).items() if c not in taken}
    for item in _split(carried):
        sql, _, alias = item.rpartition(" AS ")
        if any(_type_at(kinds.get(above), field) is None for above, field in re.findall(r"\b(e\d+|block)\.(\w+(?:\.\w+)*)", sql)):
            continue  # blocks of this schema lack a field of it
        columns[alias] = sql
    if _type_at(kind, "_issues") is not None:
        columns["has_parse_issues"] = f"size({at}._issues) > 0"
    return TableSpec(name, tuple(levels), columns)


def family_spec(family: str, schema: T.StructType, errors: str | None = None, only: set[str] | None = None) -> FlattenSpec:
    """All tables of a family that blocks of this schema can fill; ``only`` picks some (reduced detail)."""
    found = [table_spec(n, t, schema) for n, t in FAMILIES[family].items() if only is None or n in only]
    return FlattenSpec(family, tuple(x for x in found if x is not None), errors)


# What a field of an order-book block must hold.
CHECKS = {
    "hypercore": Checks({
        "block_header": "present", "block_header.block_number": "same:block_num", "block_header.block_time": "nanoseconds and same:timestamp",
        "user": "bytes", "destination": "bytes", "vault": "bytes", "validator": "bytes", "sub_account": "bytes", "hash": "bytes", "users[]": "bytes",
        "coin": "text", "token": "text", "dex": "text", "operation": "text", "ip": "text", "method": "text", "fills[].fee_token": "text",
        "price": "decimal", "size": "decimal", "start_position": "decimal", "closed_pnl": "decimal", "fee": "decimal", "mark_px": "decimal", "amount": "decimal", "usdc": "decimal", "usdc_value": "decimal",
        "native_token_fee": "decimal", "requested_usd": "decimal", "commission": "decimal", "closing_cost": "decimal", "basis": "decimal", "net_withdrawn_usd": "decimal", "interest_amount": "decimal",
        "liquidated_ntl_pos": "decimal", "account_value": "decimal", "szi": "decimal", "funding_amount": "decimal", "funding_rate": "decimal", "reward": "decimal",
        "deployer_fee": "decimal or empty", "builder_fee": "decimal or empty", "priority_gas": "decimal or empty", "end_gas": "decimal or null",
        "order_id": "long", "transaction_id": "long", "twap_id": "long", "nonce": "long", "slot_id": "long",
        "side": "enum:side", "direction": "enum:direction", "leverage_type": "enum:leverage type",
        "fills[].time": "milliseconds", "events[].time": "nanoseconds", "events[].events": "one", "events[].events[]": "case", "events[].events[].ledger_update.delta": "case",
    }, {"side": SIDES, "direction": DIRECTIONS, "leverage type": LEVERAGE_TYPES}),
}


def evm_blocks(blocks: DataFrame) -> DataFrame:
    """Transactions with the changes that last, and a list ``system_X`` a block of each kind of change outside transactions: the block's own, whose
    call_index is null, then those of its system calls."""
    kind = _type_at(blocks.schema, "transactions")
    if isinstance(kind, T.ArrayType) and _type_at(kind.elementType, "calls") is not None:
        blocks = blocks.withColumn("transactions", F.transform("transactions", lambda t: with_persisted_changes(t, kind.elementType)))
    calls = _type_at(blocks.schema, "system_calls")
    for name in ("balance_changes", "code_changes", "storage_changes", "nonce_changes", "gas_changes", "account_creations"):
        own = _type_at(blocks.schema, name)
        inner = _type_at(calls.elementType, name) if isinstance(calls, T.ArrayType) else None
        found = next((k for k in (own, inner) if isinstance(k, T.ArrayType)), None)
        if found is None:
            continue
        fields = found.elementType.fieldNames()

        def change(index: Column):
            return lambda c: F.struct(index.cast("long").alias("call_index"), *[c[f].alias(f) for f in fields])  # noqa: B023

        parts = [F.coalesce(F.transform(name, change(F.lit(None))), F.array())] if own is not None else []
        if inner is not None:
            parts.append(F.coalesce(F.flatten(F.transform("system_calls", lambda s: F.coalesce(F.transform(s[name], change(s["index"])), F.array()))), F.array()))  # noqa: B023
        blocks = blocks.withColumn(f"system_{name}", F.concat(*parts) if len(parts) > 1 else parts[0])
    return blocks


def _evm(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Calls under their own index alone; what marks their changes stands in the tables of changes."""
    drop = {"calls": ["index", "call_position", "persisted"], "system_calls": ["position"]}
    return {name: df.drop(*drop.get(name, [])) for name, df in tables.items()}


# Calls of the vote program that are votes.
VOTES = ["Vote", "VoteSwitch", "UpdateVoteState", "UpdateVoteStateSwitch", "CompactUpdateVoteState", "CompactUpdateVoteStateSwitch", "TowerSync", "TowerSyncSwitch"]


def solana_blocks(blocks: DataFrame) -> DataFrame:
    """Transactions that say ``transaction_success`` and ``is_vote``, their instructions in one numbering (all of the top level, then the inner sets in
    order), and the rewards of transactions and block in one list.

    A top-level instruction has no parent; an inner one has its set's index as parent_instruction_index and inner_index, and its place in the set. A vote is a
    transaction without lookups, with one or two signatures and one instruction, a vote of the vote program; where the schema can't tell, none is one.
    """
    kind = _type_at(blocks.schema, "transactions")
    if not isinstance(kind, T.ArrayType):
        return blocks
    tx = kind.elementType
    top, inner = _type_at(tx, "instructions"), _type_at(tx, "inner_instructions")
    fields = top.elementType.fieldNames() if isinstance(top, T.ArrayType) else []
    have = set(tx.fieldNames())

    def placed(x: Column, parent: Column, place: Column) -> Column:
        where = {"is_inner": parent.isNotNull(), "inner_index": parent.cast("long"), "parent_instruction_index": parent.cast("long"), "inner_instruction_index": place.cast("long")}
        return F.struct(*[x[f].alias(f) for f in fields if f not in where], *[c.alias(n) for n, c in where.items()])

    def more(t: Column) -> Column:
        success = F.coalesce(F.length(t["err"]) == 0, F.lit(True)) if "err" in have else F.lit(True)
        vote = F.lit(False)
        if {"program", "instruction_kind"} <= set(fields) and "num_signatures" in have:
            one = F.get(t["instructions"], 0)
            plain = (F.coalesce(F.size(t["address_table_lookups"]), F.lit(0)) == 0) if "address_table_lookups" in have else F.lit(True)
            legacy = ~F.coalesce(t["versioned"], F.lit(False)) if "versioned" in have else F.lit(True)
            vote = F.coalesce((F.size(t["instructions"]) == 1) & (one["program"] == "vote") & one["instruction_kind"].isin(VOTES) & t["num_signatures"].between(1, 2) & plain & legacy, F.lit(False))
        t2 = t.withField("transaction_success", success).withField("is_vote", vote)
        if not fields:
            return t2
        none = F.lit(None).cast("long")
        listed = F.coalesce(F.transform(t["instructions"], lambda x: placed(x, none, none)), F.array())
        if inner is not None:
            sets = F.transform(t["inner_instructions"], lambda s: F.coalesce(F.transform(s["instructions"], lambda x, i: placed(x, s["index"], i)), F.array()))
            listed = F.concat(listed, F.coalesce(F.flatten(sets), F.array()))
            t2 = t2.dropFields("inner_instructions")
        return t2.withField("instructions", listed)

    out = blocks.withColumn("transactions", F.transform("transactions", more))
    own, block = _type_at(tx, "rewards"), _type_at(blocks.schema, "rewards")
    found = next((k for k in (own, block) if isinstance(k, T.ArrayType)), None)
    if found is None:
        return out
    names = found.elementType.fieldNames()

    def reward(source: str, index: Column, success: Column):
        return lambda r: F.struct(F.lit(source).alias("source"), index.cast("long").alias("transaction_index"), success.alias("transaction_success"), *[r[n].alias(n) for n in names])

    parts = []
    if own is not None:
        of = lambda t, i: F.when(t["is_vote"], F.array()).otherwise(F.coalesce(F.transform(t["rewards"], reward("transaction", i, t["transaction_success"])), F.array()))
        parts.append(F.coalesce(F.flatten(F.transform("transactions", of)), F.array()))
    if block is not None:
        parts.append(F.coalesce(F.transform("rewards", reward("block", F.lit(None), F.lit(None).cast("boolean"))), F.array()))
    return out.withColumn("rewards", F.concat(*parts) if len(parts) > 1 else parts[0])


def _solana(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A vote's only row is the one in ``vote_transactions``."""
    out = {}
    for name, df in tables.items():
        if "is_vote" in df.columns and name != "quarantine":
            df = df.where("is_vote" if name == "vote_transactions" else "NOT is_vote").drop("is_vote")
        out[name] = df
    return out


def hypercore_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks whose events hold one body each in the flat form of the specs: event_type, ledger_type and the body's fields beside time and hash.

    Enum numbers become labels. Blocks already flat stay as they are; check the errors before, as a body list of another length than one loses rows here.
    """
    kind = _type_at(blocks.schema, "events")
    body = _type_at(kind.elementType, "events") if isinstance(kind, T.ArrayType) else None
    if isinstance(body, T.ArrayType):
        def flat(event: Column) -> Column:
            one = F.get(event["events"], 0)
            label, fields = cases(one, body.elementType)
            ledger = fields.pop("delta", None)
            extra: dict[str, Column] = {}
            if ledger is not None:
                names, extra = cases(ledger, _type_at(body.elementType, "ledger_update.delta"))
                extra = {"ledger_type": names, **extra}
            rewards = {"validator_rewards": F.when(one["validator_rewards"].isNotNull(), F.struct(one["validator_rewards"]["validator_to_reward"].alias("rewards")))} if "validator_rewards" in body.elementType.fieldNames() else {}
            funding = {"funding": one["funding"]} if "funding" in body.elementType.fieldNames() else {}
            skip = {"deltas", "validator_to_reward"}
            renamed = {"name": "sub_account_name", "previous_winner": "previous_winner"}
            for name, value in fields.items():
                if name not in skip:
                    extra[renamed.get(name, name)] = F.coalesce(extra[name], value) if name in extra else value
            keep = {f.name: event[f.name] for f in kind.elementType.fields if f.name != "events"}
            return F.struct(*[v.alias(k) for k, v in {**keep, "event_type": label, **extra, **funding, **rewards}.items()])

        blocks = blocks.withColumn("events", F.transform("events", flat))
    fills = _type_at(blocks.schema, "fills")
    if isinstance(fills, T.ArrayType):
        numbers = {"side": SIDES, "direction": DIRECTIONS}
        again = [f.name for f in fills.elementType.fields if f.name in numbers and isinstance(f.dataType, (T.IntegerType, T.LongType))]
        if again:
            label = lambda c, x: F.get(F.array(*map(F.lit, numbers[c])), x[c].cast("int") - 1)
            blocks = blocks.withColumn("fills", F.transform("fills", lambda x: x.withField(again[0], label(again[0], x)) if len(again) == 1 else x.withField(again[0], label(again[0], x)).withField(again[1], label(again[1], x))))
    return blocks


def amounts(df: DataFrame, checks: Checks) -> DataFrame:
    """Text columns of a decimal kind as exact decimals; empty text is null."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")).cast(AMOUNT) for c in df.columns if c in text and (checks.kind(c) or "").startswith("decimal")})


def _hypercore(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Events go to the one table of their kind (unknown labels to ``other_events``); fills get their market and counterparty, two tables derive from them and funding_rates from the deltas."""
    tables = {name: df if name == "quarantine" else amounts(df, CHECKS["hypercore"]) for name, df in tables.items()}
    events, fills, deltas = tables.get("events"), tables.get("fills"), tables.get("funding_deltas")
    if events is not None and deltas is not None and {"coin", "szi", "funding_amount", "funding_rate"} <= set(deltas.columns):
        tables["funding_rates"] = funding_rates(deltas, events.where("event_type = 'funding'"))
    if events is not None and {"event_type", "ledger_type"} <= set(events.columns):
        names = [*LEDGER_TABLES, *[t for t in BODY_TABLES if t not in LEDGER_TABLES]]
        tables = {k: v for k, v in tables.items() if k != "events"} | routed(events, event_table(F.col("event_type"), F.col("ledger_type")), [*dict.fromkeys([*names, "other_events"])], other="other_events")
    if fills is not None and {"coin", "transaction_id", "side", "user", "direction"} <= set(fills.columns):
        paired = with_counterparty(with_market(fills))
        tables |= {"fills": paired.drop("counterparty_direction", "counterparty_fill_index"), "outcome_fills": outcome_fills(paired)}
        if {"liquidation_method", "liquidated_user"} <= set(fills.columns):
            tables["liquidations"] = liquidations(paired)
    return tables


def _cosmos(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Events of the block and of its transactions in one table, told apart by ``source``."""
    parts = {"block": tables.pop("events", None), "transaction": tables.pop("tx_events", None)}
    found = [df.withColumn("source", F.lit(source)) for source, df in parts.items() if df is not None]
    if found:
        order = dict.fromkeys(c for df in found for c in df.columns)
        tables["events"] = union_by_name(found, [*order])
    return tables


#: What a family's blocks need before they are flattened.
PREPARED = {"evm": evm_blocks, "solana": solana_blocks, "hypercore": hypercore_blocks, "sec": typed_filings}
#: What a family's tables need beyond one explode a list.
DERIVED = {"evm": _evm, "solana": _solana, "hypercore": _hypercore, "cosmos": _cosmos, "sec": sec_tables}
#: Tables a family makes of its prepared blocks themselves.
OF_BLOCKS = {"sec": lambda blocks: {"parse_issues": parse_issues(blocks, FAMILIES["sec"])}}


def needed_bodies(blocks: DataFrame, tables: list[str]) -> DataFrame:
    """Filings without the forms' bodies that no list of these tables lies in, so that only what the tables hold is typed; all bodies where a table is made of
    more than one body's lists."""
    kind = _type_at(blocks.schema, "filings")
    places = [text.partition("|")[0].split() for text in tables]
    bodies = {p[1].lstrip(">").partition("@")[0].partition(".")[0] for p in places if len(p) > 1 and p[0].startswith("filings@")}
    if not isinstance(kind, T.ArrayType) or len([p for p in places if len(p) > 1]) < len(places) or not bodies <= set(BODIES):
        return blocks
    spare = [b for b in BODIES if b in kind.elementType.fieldNames() and b not in bodies]
    return blocks.withColumn("filings", F.transform("filings", lambda x: x.dropFields(*spare))) if spare else blocks


def needed_changes(blocks: DataFrame, tables: list[str]) -> DataFrame:
    """Transactions without the lists of changes in their calls that no path of these tables goes through, so that only what the tables hold is marked."""
    transactions = _type_at(blocks.schema, "transactions")
    calls = _type_at(transactions.elementType, "calls") if isinstance(transactions, T.ArrayType) else None
    if not isinstance(calls, T.ArrayType):
        return blocks
    used = {part.partition("@")[0].removesuffix("?") for text in tables for part in text.partition("|")[0].split()}
    spare = [f.name for f in calls.elementType.fields if isinstance(f.dataType, T.ArrayType) and f.name.endswith("_changes") and f.name not in used]
    if not spare or len(spare) == len(calls.elementType.fields):
        return blocks
    return blocks.withColumn("transactions", F.transform("transactions", lambda t: t.withField("calls", F.transform(t["calls"], lambda c: c.dropFields(*spare)))))


def evm_changes(blocks: DataFrame, kinds: list[str]) -> DataFrame:
    """Rows (tx_index, kind, call_index, change_position, ordinal, address, state_reverted, persisted, and the block's identity) of the tables ``X_changes`` of several kinds X, from one pass over the blocks."""
    names = [f"{kind}_changes" for kind in kinds]
    blocks = evm_blocks(needed_changes(blocks, [FAMILIES["evm"][name] for name in names]))
    calls = TableSpec("changes", (Level("transactions", "tx_index"), Level("calls", "call_position")), {"call_index": "e1.index", "state_reverted": "e1.state_reverted", "persisted": "e1.persisted", **{name: f"e1.{name}" for name in names}})
    rows = flatten_table(blocks, calls)

    def tagged(kind: str) -> Column:
        one = lambda c, i: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("change_position"), c["ordinal"].alias("ordinal"), c["address"].alias("address"))
        return F.coalesce(F.transform(f"{kind}_changes", one), F.array())

    own = [c for c in rows.columns if c not in (*names, "call_position")]
    return rows.select(*own, F.explode(F.concat(*map(tagged, kinds))).alias("x")).select(*own, "x.*")


def flatten_family(blocks: DataFrame, family: str, errors: str | None = None, only: set[str] | None = None) -> dict[str, DataFrame]:
    """All tables that blocks of this schema can fill, derived ones included; a family's own checks hold unless ``errors`` names others."""
    if errors is None and family in CHECKS and "_errors" not in blocks.columns:
        blocks = with_errors(blocks, CHECKS[family])
    if family == "sec" and only is not None:
        blocks = needed_bodies(blocks, [FAMILIES[family].get(name, "") for name in only])
    if family == "evm" and only is not None and only <= set(FAMILIES[family]):
        blocks = needed_changes(blocks, [FAMILIES[family][name] for name in only])
    blocks = PREPARED[family](blocks) if family in PREPARED else blocks
    out = flatten(blocks, family_spec(family, T.StructType([f for f in blocks.schema if f.name != "_errors"]), errors, only))
    out = DERIVED[family](out) if family in DERIVED else out
    more = OF_BLOCKS[family](blocks) if family in OF_BLOCKS else {}
    return out | {name: df for name, df in more.items() if only is None or name in only}
