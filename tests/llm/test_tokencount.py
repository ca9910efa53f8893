"""Token counts equal the library's on whole texts, whatever the tiers hold."""

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import tokencount

DIR = "/root/testdata/sf0.001"


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path())


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in tokencount.token_counts(docs, path()).collect()}
    for r in docs.collect():
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert got[r["doc_id"]] == (len(text.encode()), n, n > 512)


PIECES = st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "᠎",
                          "​", "'s", "'S", "don't", "12", "½", "é", "é", "𝒳", "🙂", "的", "͸", "a" * 60, "...", "_", "\0"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES | st.text(max_size=8), max_size=14))
def test_any_text(pieces):
    text = "".join(pieces)
    lengths = test_any_text.__dict__.setdefault("lengths", tokencount.Lengths(path(), {}))
    assert lengths.count(text) == len(lengths.tokenizer.encode(text, add_special_tokens=False).ids)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE", 50)
    lengths = tokencount.Lengths(path(), {" the": 1})
    whole = " ".join(f"word{i} the" for i in range(400))
    parts = whole.split(" the")
    assert sum(lengths.count(p) for p in parts) == sum(lengths.encoded(parts))
    assert len(lengths.known) < 60 and lengths.known[" the"] == 1


def test_summaries_merge(spark):
    texts = spark.createDataFrame([("common rare%d" % i,) for i in range(500)], "t string").repartition(70)
    assert tokencount.frequent_pre_tokens(texts, 3)[:2] == [" rare", "common"]


@pytest.mark.parametrize("table", [[], [" the", "x", "\n"]])
def test_table_changes_no_count(spark, monkeypatch, table):
    """The sample only chooses which lengths are known beforehand; whatever it gives, the counts are the same."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    whole = sorted(tokencount.token_counts(docs, path()).collect())
    monkeypatch.setattr(tokencount, "frequent_pre_tokens", lambda texts: table)
    assert sorted(tokencount.token_counts(docs, path()).collect()) == whole


def test_table_comes_from_all_texts(spark, monkeypatch):
    """No row is left out of the counts that choose the frequent pre-tokens."""
    read = []
    monkeypatch.setattr(tokencount, "frequent_pre_tokens", lambda texts: read.append(texts.distinct().count()) or [])
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('text ', id) as text")
    tokencount.token_counts(docs, path())
    assert read == [30_000]


def test_frequent_last(spark):
    """A pre-token that only the texts of the last of many parts hold is found; ASCII or not."""
    texts = spark.createDataFrame([("a%d" % i if i < 900 else "été late",) for i in range(1000)], "t string").repartitionByRange(20, "t")
    assert {"été", " late", "a"} <= set(tokencount.frequent_pre_tokens(texts))
