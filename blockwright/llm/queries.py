"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockwright.llm.shared import forget, ship

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies: in the folder BLOCKWRIGHT_TOKENIZERS, else in the installed package."""
    if folder := os.environ.get("BLOCKWRIGHT_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", *columns)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back; null texts and roles are empty, repeated turns follow each other by role and text."""
    from blockwright.llm.chat import conversation_digest, conversation_messages, format_conversations

    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversation_digest(format_conversations(conversation_messages(talk.unionByName(extra))))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; null texts and texts without a letter are ``und``. Repeated rows and ids give a row each."""
    from blockwright.llm.langid import fit, is_training, predict_languages

    docs = _docs(spark, sf_dir, "lang")
    found = predict_languages(docs, fit(docs))
    return found.select("doc_id", (~is_training(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document; texts without a word are linked with nothing. A doc_id with several texts gives a row each."""
    from blockwright.llm.jaccard import jaccard_components

    return jaccard_components(_docs(spark, sf_dir), words=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them; null counts as empty, each row is encoded by itself."""
    from blockwright.llm.bpe import bpe_round_trip

    return bpe_round_trip(_docs(spark, sf_dir), tokenizer_path())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every whole text, empty ones included; labels train the model only where crc32(doc_id) mod 3 isn't 1."""
    from blockwright.llm.toxicity import fit, is_held_out, score_toxicity

    docs = _docs(spark, sf_dir, "lang")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score_toxicity(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to the token store in ascending doc_id order and read back; null texts hold the end id alone."""
    from blockwright.llm.tokenstore import read_token_blocks, write_token_blocks

    return read_token_blocks(write_token_blocks(_docs(spark, sf_dir), tokenizer_path(), end_id=2))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, the end replaced by the start of the next document in descending doc_id order."""
    from blockwright.llm.fingerprint import fingerprint_neighbours

    return fingerprint_neighbours(_docs(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every text under counts of the training documents; null counts as empty."""
    from blockwright.llm.lm import is_training, learn, score

    docs = _docs(spark, sf_dir)
    found = score(docs, *learn(docs.where(is_training(F.col("doc_id")))))
    return found.select("doc_id", (~is_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds a passage; clean documents give none."""
    from blockwright.llm.decontam import contaminated

    return contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text, base rules and more; null counts as empty."""
    from blockwright.llm.secrets import BASE, find_secrets

    found = find_secrets(_docs(spark, sf_dir))
    base = [r.kind for r in BASE]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter("secret_spans", lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *map(count, base), F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document by its repetition coverage."""
    from blockwright.llm.quality import repetition

    return repetition(_docs(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every vector whose id is divisible by 50, against all vectors; every seventh label is moved on by one first."""
    from blockwright.llm.negatives import hard_negatives

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt with the first crc32(conv_id) mod 9 turns of the one at the last multiple of five."""
    from blockwright.llm.trie import numbered_turns, prefix_trie, sequences, with_lent_heads

    turns = numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    conv = F.col("conv_id")
    talks = sequences(with_lent_heads(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9))
    found = prefix_trie(talks)
    forget(turns, talks)  # the trie's own tables are written
    return found


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_language_id": op2_language_id,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_token_store": op6_token_store,
    "op7_fingerprints": op7_fingerprints,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_decontamination": op9_decontamination,
    "op10_secrets": op10_secrets,
    "op11_quality_rules": op11_quality_rules,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}

QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (SELECT *, length(role) + length(text) + 16
  + (length(text) - length(replace(text, '\', '')))
  + len(regexp_extract_all(text, '<\|turn:|<\|end\||<\|im_|<\|endoftext|</?s>|\[/?INST\]')) AS chars FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id""",
    "op11_quality_rules": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
word AS (SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM words),
counts AS (SELECT r, count(*) AS n_words, sum(length(x))::BIGINT AS word_chars FROM word GROUP BY r),
ahead AS (SELECT r, i, x, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2, lead(x, 3) OVER w AS x3, lead(x, 4) OVER w AS x4, lead(x, 5) OVER w AS x5, lead(x, 6) OVER w AS x6, lead(x, 7) OVER w AS x7, lead(x, 8) OVER w AS x8, lead(x, 9) OVER w AS x9
  FROM word WINDOW w AS (PARTITION BY r ORDER BY i)),
hashed AS (SELECT r, 5 AS n, i, concat_ws(' ', x, x1, x2, x3, x4) AS g FROM ahead WHERE x4 IS NOT NULL
  UNION ALL SELECT r, 6 AS n, i, concat_ws(' ', x, x1, x2, x3, x4, x5) AS g FROM ahead WHERE x5 IS NOT NULL
  UNION ALL SELECT r, 7 AS n, i, concat_ws(' ', x, x1, x2, x3, x4, x5, x6) AS g FROM ahead WHERE x6 IS NOT NULL
  UNION ALL SELECT r, 8 AS n, i, concat_ws(' ', x, x1, x2, x3, x4, x5, x6, x7) AS g FROM ahead WHERE x7 IS NOT NULL
  UNION ALL SELECT r, 9 AS n, i, concat_ws(' ', x, x1, x2, x3, x4, x5, x6, x7, x8) AS g FROM ahead WHERE x8 IS NOT NULL
  UNION ALL SELECT r, 10 AS n, i, concat_ws(' ', x, x1, x2, x3, x4, x5, x6, x7, x8, x9) AS g FROM ahead WHERE x9 IS NOT NULL),
ranked AS (SELECT r, n, i, count(*) OVER (PARTITION BY r, n, g) AS copies, row_number() OVER (PARTITION BY r, n, g ORDER BY i) AS copy FROM hashed),
inside AS (SELECT DISTINCT r, n, copy > 1 AS later, unnest(range(i, i + n)) AS i FROM ranked WHERE copies > 1),
dup AS (SELECT r, count(DISTINCT i) FILTER (WHERE n = 5) AS n_repeat_words,
  coalesce(sum(length(x)) FILTER (WHERE later AND n = 5), 0)::BIGINT AS dup5_chars, coalesce(sum(length(x)) FILTER (WHERE later AND n = 6), 0)::BIGINT AS dup6_chars,
  coalesce(sum(length(x)) FILTER (WHERE later AND n = 7), 0)::BIGINT AS dup7_chars, coalesce(sum(length(x)) FILTER (WHERE later AND n = 8), 0)::BIGINT AS dup8_chars,
  coalesce(sum(length(x)) FILTER (WHERE later AND n = 9), 0)::BIGINT AS dup9_chars, coalesce(sum(length(x)) FILTER (WHERE later AND n = 10), 0)::BIGINT AS dup10_chars
  FROM inside JOIN word USING (r, i) GROUP BY r),
line AS (SELECT r, generate_subscripts(l, 1) AS k, unnest(l) AS x FROM (SELECT r, str_split(text, chr(10)) AS l FROM docs)),
lines AS (SELECT r, x, row_number() OVER (PARTITION BY r, x ORDER BY k) AS copy FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
by_line AS (SELECT r, count(*) FILTER (WHERE copy > 1) AS n_dup_lines, sum(length(x))::BIGINT AS line_chars, coalesce(sum(length(x)) FILTER (WHERE copy > 1), 0)::BIGINT AS dup_line_chars FROM lines GROUP BY r),
found AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_chars, 0) AS line_chars, coalesce(dup_line_chars, 0) AS dup_line_chars,
  coalesce(dup5_chars, 0) AS dup5_chars, coalesce(dup6_chars, 0) AS dup6_chars, coalesce(dup7_chars, 0) AS dup7_chars,
  coalesce(dup8_chars, 0) AS dup8_chars, coalesce(dup9_chars, 0) AS dup9_chars, coalesce(dup10_chars, 0) AS dup10_chars
  FROM docs LEFT JOIN counts USING (r) LEFT JOIN dup USING (r) LEFT JOIN by_line USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM found)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 20 * line_chars AND 100 * dup5_chars <= 15 * word_chars AND 100 * dup6_chars <= 14 * word_chars
  AND 100 * dup7_chars <= 13 * word_chars AND 100 * dup8_chars <= 12 * word_chars AND 100 * dup9_chars <= 11 * word_chars AND 100 * dup10_chars <= 10 * word_chars AS kept FROM judged""",
    "op12_hard_negatives": """
WITH sound AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op13_prefix_trie": """
WITH said AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
talks AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS lender,
  xor(list_reduce(list_prepend(4294967295, list_transform(str_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS heads FROM said),
rebuilt AS (SELECT t.conv_id, 0 AS own, pos, role, text FROM talks t JOIN said s ON s.conv_id = t.lender AND pos <= heads
  UNION ALL SELECT t.conv_id, 1, pos, role, text FROM talks t JOIN said s ON s.conv_id = t.conv_id AND pos > heads),
placed AS (SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS bytes,
  string_agg(md5(strlen(role) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS prefix FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
members AS (SELECT conv_id, depth, bytes, prefix FROM placed UNION ALL SELECT conv_id, 0, 0, '' FROM talks),
last AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
ends AS (SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM members JOIN last USING (conv_id, depth) GROUP BY prefix),
node AS (SELECT prefix, depth, CASE WHEN depth > 0 THEN substr(prefix, 1, 32 * (depth - 1)) END AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM members GROUP BY prefix, depth),
kids AS (SELECT parent AS prefix, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
own AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (prefix)),
upward AS (SELECT n_children, n_convs, bytes, substr(prefix, 1, 32 * unnest(range(0, depth + 1))) AS prefix FROM own),
sums AS (SELECT prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens FROM upward GROUP BY prefix)
SELECT o.conv_id, o.depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN sums USING (prefix) LEFT JOIN ends USING (prefix) LEFT JOIN own up ON up.prefix = o.parent""",
}
