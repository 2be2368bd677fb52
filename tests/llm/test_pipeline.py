"""The pipeline's stages on awkward rows, and the rows they leave against plain versions on the small table."""

import hashlib
import re
from collections import Counter

import pytest

SMALL = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, _text long, _row string, item_id long, kept boolean"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "en", "web", len(t or ""), 1, "x", 2, True) for i, t in texts], SHAPE)


def left(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def items(spark):
    return [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").collect()]


def test_benchmark_passages_go_by_text_not_by_id(spark):
    import corpus_pipeline

    item = items(spark)[0]
    clean = "a clean text about nothing in particular, long enough to be searched for passages of any kind of benchmark"
    data = [(None, f"before {item} after"), (None, clean), (5, f"x {item}"), (5, clean + " too"), (6, item), (6, item), (7, None), (8, ""), (None, None), (9, clean), (9, clean)]
    got = left(corpus_pipeline.drop_benchmark_passages(spark, rows(spark, data), SMALL))
    assert got == Counter([(None, clean), (5, clean + " too"), (7, None), (8, ""), (None, None), (9, clean), (9, clean)])


def test_benchmark_stage_on_the_small_table(spark):
    """Whole items always go; a text that shares no 40 characters with any item always stays."""
    import corpus_pipeline

    def plain(t):
        return " ".join(re.sub(r"\W+", " ", (t or "").lower()).split())

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    wanted = [plain(t) for t in items(spark)]
    pieces = {t[k : k + 40] for t in wanted for k in range(max(1, len(t) - 39))}
    stay = left(corpus_pipeline.drop_benchmark_passages(spark, docs, SMALL))
    gone = 0
    for (i, t), n in left(docs).items():
        p = plain(t)
        if any(x in p for x in wanted if len(x) >= 20):
            assert (i, t) not in stay
            gone += n
        elif not any(p[k : k + 40] in pieces for k in range(len(p) - 39)):
            assert stay[i, t] == n
    assert gone


def test_secrets_stage_leaves_no_secret_and_all_rows(spark):
    import corpus_pipeline

    key = "AKIA" + "A1B2C3D4E5F6G7H8"
    data = [(1, f"key {key} end"), (1, "other"), (None, 'password = "hunter2222"'), (2, None), (3, ""), (4, "deadbeef" * 5), (4, "deadbeef" * 5), (5, "é" * 3 + " token:abcdef123456")]
    got = corpus_pipeline.redact_secrets(spark, rows(spark, data), SMALL).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in data)
    assert all((r["n_chars"] or 0) == len(r["text"] or "") for r in got)
    joined = "\n".join(r["text"] or "" for r in got)
    assert not re.search(r"AKIA[A-Z0-9]{16}|hunter2222|[0-9a-f]{24}|abcdef123456", joined) and "other" in joined
    assert [tuple(r) for r in got if r["doc_id"] == 1 and r["text"] == "other"] == [(1, "other", "en", "web", 5)]


def test_bpe_stage_equals_the_library(spark):
    import corpus_pipeline
    from blockwright.llm.queries import tokenizer_path
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    data = [(1, "Hello  world"), (1, "other"), (None, "no id"), (2, None), (3, ""), (4, "é日本 \x00 ü</s>"), (5, "word " * 3000)]
    got = {(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.encode(spark, rows(spark, data), SMALL).collect()}
    want = set()
    for i, t in data:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want


@pytest.mark.parametrize("name", ["language_id", "jaccard_join", "decontamination", "secrets", "bpe"])
def test_stages_on_an_empty_table(spark, name):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, rows(spark, []), SMALL)
    assert out.count() == 0 and (name == "bpe" or out.columns == corpus_pipeline.COLUMNS)


def test_language_stage_keeps_rows_without_and_with_repeated_ids(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    text = max((r["text"] for r in docs.where("lang = 'en'").collect()), key=lambda t: len(t or ""))[:400]
    odd = spark.createDataFrame([(None, text, None, "web", 1), (-7, text, None, "web", 1), (-7, text + " again", None, "web", 1), (-8, None, "en", "web", 1), (-9, "123 !!", "en", "web", 1)], docs.schema)
    got = left(corpus_pipeline.identify_language(spark, docs.unionByName(odd), SMALL))
    assert got[None, text] == 1 and got[-7, text] == 1 and got[-7, text + " again"] == 1
    assert not got[-8, None] and not got[-9, "123 !!"]
