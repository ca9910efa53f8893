"""Every operator on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import (
    chat, decontaminate, licenses, mixture, quality, secretscan, simhash, tokencount, toxicity, warc,
)
from tests.llm import rows

BENCHMARK = [(1, rows.TEXT), (2, None), (3, ""), (4, "too short"), (1, rows.TEXT), (None, "no id here but some words all the same")]
LABELS = [(1, 1, 0), (2, 1, 0), (9, 0, 1), (7, 0, 0), (None, 1, 1), (3, None, None), (99, 1, 0)]
JSON = "byte_bpe_50k.json"


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path(JSON)


def operators(spark):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    return {
        "licenses": lambda d: licenses.scan(d),
        "secrets": lambda d: secretscan.scan(d),
        "redact": lambda d: secretscan.redact(d).select("doc_id", "text", "n_chars"),
        "warc": lambda d: warc.round_trip(d.select(F.col("doc_id").alias("page_id"), F.lit("http://x/").alias("url"), F.col("text").alias("html"), "lang")),
        "decontaminate": lambda d: decontaminate.leaks(d, benchmark),
        "without_leaks": lambda d: decontaminate.without_leaks(d, benchmark).select("doc_id", "text"),
        "simhash": lambda d: simhash.near_duplicates(d),
        "without_copies": lambda d: simhash.without_copies(d).select("doc_id", "text"),
        "quality": lambda d: quality.assess(d, labels),
        "kept_documents": lambda d: quality.kept_documents(d, labels).select("doc_id", "text"),
        "toxicity": lambda d: toxicity.scores(d, labels),
        "tokens": lambda d: tokencount.token_counts(d, tokenizer_path()),
        "chat": lambda d: chat.formatted(chat.canonical(d.select("doc_id", F.col("text").alias("prompt"), F.col("lang").alias("completion")))).select("doc_id", "formatted"),
        "records": lambda d: chat.records(d.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text")),
        "mixture": lambda d: mixture.mix(d),
    }


ROW_FOR_ROW = {"secrets", "redact", "warc", "simhash", "quality", "toxicity", "tokens", "mixture", "chat"}
NAMES = ("licenses secrets redact warc decontaminate without_leaks simhash without_copies quality kept_documents toxicity "
         "tokens chat records mixture").split()


@pytest.mark.parametrize("name", NAMES)
def test_edge_rows(spark, name):
    docs = rows.documents(spark)
    operator = operators(spark)[name]
    plain = [tuple(r) for r in operator(docs).collect()]
    if name in ROW_FOR_ROW:
        assert len(plain) == len(rows.DOCUMENTS)
    assert rows.same(plain, [tuple(r) for r in operator(rows.clashing(docs)).collect()])
    assert operator(rows.documents(spark, [])).collect() == []


def test_leaks_and_copies(spark):
    found = {(r["doc_id"], r["item_id"]) for r in operators(spark)["decontaminate"](rows.documents(spark)).collect()}
    assert found == {(1, 1), (2, 1), (None, None)}
    kept = [r["doc_id"] for r in operators(spark)["without_leaks"](rows.documents(spark)).collect()]
    assert sorted(map(str, kept)) == sorted(["3", "4", "5", "6", "7", "8", "9"])
    left = [r["doc_id"] for r in simhash.without_copies(rows.documents(spark)).collect()]
    assert sorted(map(str, left)) == sorted(["1", "3", "6", "7", "8", "9", "None", "None"])
