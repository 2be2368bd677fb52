"""Five stages over ``documents``: language ID, near duplicates, benchmark passages, secrets, BPE.

Each stage takes (spark, docs, sf_dir) and gives all rows its decisions leave; ``check`` tools and ``run`` write each
stage's rows and read them again before the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockwright.llm.bpe import bpe_round_trip
from blockwright.llm.decontam import contaminated
from blockwright.llm.jaccard import jaccard_components
from blockwright.llm.langid import fit, predict_languages
from blockwright.llm.queries import tokenizer_path
from blockwright.llm.secrets import redacted
from blockwright.llm.shared import forget, ship, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is ``und`` go, texts in no language of the table and letter junk among them; the others keep their row, with ``lang`` filled in where it was null."""
    key = docs.select(*COLUMNS)
    found = predict_languages(key, fit(key), keep=COLUMNS, open_set=True)
    return found.where("lang_pred <> 'und'").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest doc_id, null last (five words a shingle, similarity 0.8).

    Groups are found by a 64-bit hash of the text, not by doc_id: rows with a null doc_id take part like all others, and rows that share
    a doc_id stay if their texts aren't linked. Texts without a word are in no group, and all their rows stay.
    """
    rows = docs.select(*COLUMNS).withColumns({"_text": F.xxhash64("text"), "_row": F.xxhash64(*[x for c in COLUMNS if c != "text" for x in (F.col(c), F.col(c).isNull())])})
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    found = jaccard_components(rows.where(worded).select(F.col("_text").alias("doc_id"), "text"), words=5, num=80, den=100)
    group = found.groupBy(F.col("doc_id").alias("_text")).agg(F.min("component_id").alias("_group"))
    # one row a text before the join, so that a text with many copies is no hot key
    best = rows.where(worded).groupBy("_text").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "_row")).alias("_best"))
    stay = written(best.join(group, "_text").groupBy("_group").agg(F.min("_best").alias("_best")).select("_best._text", "_best._row"), "stay")
    kept = rows.where(worded).join(stay, ["_text", "_row"], "left_semi").dropDuplicates(["_text", "_row"])
    return kept.select(*COLUMNS).unionByName(rows.where(~worded).select(*COLUMNS))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go; all rows of such a text, and no others.

    Texts are known by a 64-bit hash, not by doc_id: a row with a null doc_id is searched like all others, and a clean text
    stays though it shares its doc_id with one that goes. A null text holds nothing.
    """
    rows = docs.select(*COLUMNS).withColumn("_text", F.xxhash64("text"))
    pairs = contaminated(rows.select(F.col("_text").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    return rows.join(written(pairs.select(F.col("doc_id").alias("_text")).distinct(), "leaks"), "_text", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes ``[kind]``; n_chars follows."""
    return redacted(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text."""
    return bpe_round_trip(docs, tokenizer_path())


def _stage(function):
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, docs, sf_dir)

    return run


STAGES = [
    ("language_id", _stage(identify_language)),
    ("jaccard_join", _stage(drop_near_duplicates)),
    ("decontamination", _stage(drop_benchmark_passages)),
    ("secrets", _stage(redact_secrets)),
    ("bpe", _stage(encode)),
]

#: SQL can't express the classifier, the aligner and the encoder: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            forget(last)
        last = docs
    return docs
