"""Reference tables: JSON documents to snapshot rows, and current and history views of their change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwright.functions.parse import exact_decimal, kv_map
from blockwright.operators.changelog import current_filled, history, newest
from blockwright.operators.joins import asof_join

# Entity keys of the reference tables and the column that orders their rows.
KEYS = {
    "hl_spot_meta": ["request"], "hl_spot_tokens": ["token_index"], "hl_spot_token_details": ["token_index"], "hl_spot_pairs": ["pair_index"], "hl_perp_dexs": ["dex_index"],
    "hl_perp_assets": ["dex_index", "asset_index"], "hl_outcome_meta": ["request"], "hl_outcomes": ["outcome_id"], "hl_questions": ["question_id"], "hl_funding_history": ["coin"],
}
NO_HISTORY = {"hl_spot_token_details", "hl_funding_history"}
FILLED = {"hl_questions": ["fallback_outcome_id", "named_outcome_ids", "settled_outcome_ids"]}

# Shapes of the documents.
SPOT_META = "struct<universe: array<struct<tokens: array<bigint>, name: string, index: bigint, isCanonical: boolean>>, tokens: array<struct<name: string, szDecimals: int, weiDecimals: int, index: bigint, tokenId: string, isCanonical: boolean, fullName: string, deployerTradingFeeShare: string>>>"
PERP_DEXS = "array<struct<name: string, fullName: string, deployer: string, oracleUpdater: string, feeRecipient: string>>"
PERP_METAS = "array<struct<universe: array<struct<szDecimals: int, name: string, maxLeverage: int, marginTableId: int, isDelisted: boolean>>, collateralToken: bigint>>"
OUTCOME_META = "struct<outcomes: array<struct<outcome: bigint, name: string, description: string, sideSpecs: array<struct<name: string>>, quoteToken: string, venue: string, deployerFeeScale: string>>, questions: array<struct<question: bigint, name: string, description: string, fallbackOutcome: bigint, namedOutcomes: array<bigint>, settledNamedOutcomes: array<bigint>>>>"
TOKEN_DETAILS = "struct<name: string, maxSupply: string, deployer: string, deployGas: string, deployTime: string>"
FUNDING_HISTORY = "array<struct<coin: string, fundingRate: string, premium: string, time: bigint>>"


def _parsed(documents: DataFrame, shape: str) -> DataFrame:
    """documents: observed_at, body (JSON text), and any key columns of the request."""
    return documents.withColumn("_d", F.from_json("body", shape)).drop("body")


def spot_meta(documents: DataFrame) -> dict[str, DataFrame]:
    d = _parsed(documents, SPOT_META)
    tokens = d.select("observed_at", F.inline("_d.tokens")).withColumnRenamed("index", "token_index")
    names = tokens.select("observed_at", "token_index", F.col("name").alias("symbol"))
    pairs = d.select("observed_at", F.inline("_d.universe"))
    pairs = pairs.select("observed_at", F.col("index").alias("pair_index"), F.when(F.col("name").contains("/"), F.col("name")).otherwise(F.concat(F.lit("@"), F.col("index").cast("string"))).alias("coin"), F.get("tokens", F.lit(0)).alias("base_index"), F.get("tokens", F.lit(1)).alias("quote_index"), "isCanonical")
    for side in ("base", "quote"):
        pairs = pairs.join(names.select("observed_at", F.col("token_index").alias(f"{side}_index"), F.col("symbol").alias(f"{side}_symbol")), ["observed_at", f"{side}_index"], "left")
    return {"hl_spot_tokens": tokens, "hl_spot_pairs": pairs}


def token_details(documents: DataFrame) -> DataFrame:
    return _parsed(documents, TOKEN_DETAILS).select("token_index", "observed_at", "_d.*")


def perp_dexs(documents: DataFrame) -> DataFrame:
    """The first entry is null: the first exchange, index 0, without a name."""
    rows = _parsed(documents, PERP_DEXS).select("observed_at", F.posexplode("_d").alias("dex_index", "x"))
    return rows.select("observed_at", F.col("dex_index").cast("long").alias("dex_index"), F.coalesce("x.name", F.lit("")).alias("name"), F.col("x.fullName").alias("full_name"), "x.deployer")


def perp_assets(documents: DataFrame, dexs: DataFrame) -> DataFrame:
    rows = _parsed(documents, PERP_METAS).select("observed_at", F.posexplode("_d").alias("dex_index", "m"))
    rows = rows.select("observed_at", F.col("dex_index").cast("long").alias("dex_index"), F.posexplode("m.universe").alias("asset_index", "a"))
    rows = rows.select("observed_at", "dex_index", F.col("asset_index").cast("long").alias("asset_index"), F.col("a.name").alias("coin"), F.col("a.maxLeverage").alias("max_leverage"), F.coalesce("a.isDelisted", F.lit(False)).alias("is_delisted"))
    return rows.join(newest(dexs, ["dex_index"]).select("dex_index", F.col("name").alias("dex")), "dex_index", "left")


def outcome_meta(documents: DataFrame) -> dict[str, DataFrame]:
    d = _parsed(documents, OUTCOME_META)
    questions = d.select("observed_at", F.inline("_d.questions")).select("observed_at", F.col("question").alias("question_id"), "name", "description", F.col("fallbackOutcome").alias("fallback_outcome_id"), F.col("namedOutcomes").alias("named_outcome_ids"), F.col("settledNamedOutcomes").alias("settled_outcome_ids"))
    rows = d.select("observed_at", F.inline("_d.outcomes"))
    side = F.sequence(F.lit(0), F.size("sideSpecs") - 1)
    coins = F.when(F.size("sideSpecs") > 0, F.transform(side, lambda i: F.concat(F.lit("#"), (F.col("outcome") * 10 + i).cast("string"))))
    outcomes = rows.select("observed_at", F.col("outcome").alias("outcome_id"), "name", "description", kv_map(F.col("description")).alias("description_kv"), F.transform("sideSpecs", lambda s: s["name"]).alias("side_names"), coins.alias("side_coins"), F.col("quoteToken").alias("quote_token"), "venue")
    return {"hl_outcomes": outcomes, "hl_questions": questions}


def funding_history(documents: DataFrame) -> DataFrame:
    rows = _parsed(documents, FUNDING_HISTORY).select("observed_at", F.inline("_d"))
    return rows.select("coin", F.timestamp_millis("time").alias("funding_time"), exact_decimal(F.col("fundingRate"), 18).alias("funding_rate"), exact_decimal(F.col("premium"), 18).alias("premium"), "observed_at")


def current(name: str, log: DataFrame) -> DataFrame:
    """The newest row of each entity; a question's lists are filled from the last row that had them."""
    time = "funding_time" if name == "hl_funding_history" else "observed_at"
    return current_filled(log, KEYS[name], FILLED[name], time) if name in FILLED else newest(log, KEYS[name], time)


def history_view(name: str, log: DataFrame) -> DataFrame:
    if name in NO_HISTORY:
        raise ValueError(f"{name} is a history already")
    return history(log, KEYS[name])


def tokens_current(tokens: DataFrame, details: DataFrame) -> DataFrame:
    return current("hl_spot_tokens", tokens).join(current("hl_spot_token_details", details).select("token_index", "deployer", "deployTime", "deployGas"), "token_index", "left")


def outcomes_current(outcomes: DataFrame, questions: DataFrame) -> DataFrame:
    """Newest outcomes; a missing question_id comes from the questions' own lists, the newest that names the outcome."""
    listed = questions.select("question_id", "observed_at", F.explode(F.array_append(F.coalesce("named_outcome_ids", F.array().cast("array<bigint>")), F.col("fallback_outcome_id"))).alias("outcome_id")).where("outcome_id is not null")
    member = newest(listed, ["outcome_id"]).select("outcome_id", F.col("question_id").alias("_q"))
    now = current("hl_outcomes", outcomes)
    have = F.col("question_id") if "question_id" in now.columns else F.lit(None).cast("long")
    return now.join(member, "outcome_id", "left").withColumn("question_id", F.coalesce(have, F.col("_q"))).drop("_q")


def outcome_sides(outcomes_now: DataFrame, questions_now: DataFrame) -> DataFrame:
    """One row for each side of an outcome, keyed by its coin."""
    sides = outcomes_now.select("outcome_id", "name", "question_id", "side_names", F.posexplode("side_coins").alias("side_index", "coin"))
    q = questions_now.select("question_id", F.col("name").alias("question_name"))
    return sides.join(q, "question_id", "left").select("coin", "outcome_id", F.col("side_index").cast("long").alias("side_index"), F.get("side_names", F.col("side_index")).alias("side_name"), F.col("name").alias("outcome_name"), "question_id", "question_name")


def leverage_at(fills: DataFrame, assets: DataFrame, time: str) -> DataFrame:
    """Fills with the leverage valid at their time."""
    return asof_join(fills, history_view("hl_perp_assets", assets), ["coin"], time, "valid_from", ["max_leverage", "is_delisted"])
