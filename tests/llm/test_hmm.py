"""The hidden Markov scorer against sums over all state paths, brute-force counts and held-out rows."""

import itertools
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hmm
from tests.llm import rows as fixtures


def model(states=3, size=5, seed=1):
    rng = np.random.default_rng(seed)
    first, step, emit = rng.random(states), rng.random((states, states)), rng.random((size, states))
    return hmm.Model(first / first.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(m, codes):
    """(chance, path) of every path of states."""
    for path in itertools.product(range(len(m.first)), repeat=len(codes)):
        p = m.first[path[0]] * m.emit[codes[0], path[0]]
        for a, b, c in zip(path, path[1:], codes[1:]):
            p *= m.step[a, b] * m.emit[c, b]
        yield p, path


SEQUENCES = [np.array(s) for s in ([0], [1, 2, 3, 4, 0], [4, 4], [2], [3, 1, 3], [0, 0, 0, 1])]


def test_likelihood_is_the_sum_over_paths():
    m = model()
    want = [math.log10(sum(p for p, _ in paths(m, s))) for s in SEQUENCES]
    assert hmm.log10_chances(m, SEQUENCES) == pytest.approx(want, abs=1e-12)


def test_expected_counts_are_sums_over_paths():
    m = model()
    found = hmm.Expected(m)
    found.add(SEQUENCES)
    first, step, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in SEQUENCES:
        all_paths = list(paths(m, s))
        total = sum(p for p, _ in all_paths)
        for p, path in all_paths:
            first[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                step[a, b] += p / total
            for k, c in zip(path, s):
                emit[c, k] += p / total
    assert np.allclose(found.first, first) and np.allclose(found.step, step) and np.allclose(found.emit, emit)


@pytest.mark.parametrize("run", [lambda m, rows: hmm.Expected(m).add(rows), hmm.log10_chances])
def test_recursions_hold_two_tables_of_states(run):
    """However many sequences a task has, only the chances and emissions of those side by side are held."""
    rng, m = np.random.default_rng(4), model(hmm.STATES, 50)
    rows = [rng.integers(0, 50, 2000).astype(np.uint16) for _ in range(300)]
    tracemalloc.start()
    try:
        run(m, rows)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 48e6


def test_rounds_never_lose_likelihood(spark, monkeypatch):
    monkeypatch.setattr(hmm, "PRIOR", 0.0)
    rng = np.random.default_rng(2)
    texts = [np.concatenate([rng.integers(0, 3, 4) if k % 2 else rng.integers(3, 6, 4) for k in range(rng.integers(1, 9))]) for _ in range(120)]
    df = spark.createDataFrame([(bytearray(t.astype(np.uint16).tobytes()),) for t in texts], "classes binary").repartition(3)
    share = np.full(6, 1 / 6)
    m, before = hmm.first_model(share, 2), -np.inf
    for _ in range(6):
        found = hmm.expected(df, m)
        alone = hmm.Expected(m)
        alone.add(texts)
        assert np.allclose(found.emit, alone.emit) and np.allclose(found.step, alone.step)  # the same however it is spread
        assert found.log10 > before - 0.5  # the prior of one count a step may cost a little
        before, m = found.log10, hmm.improved(found, share)


def brute_base(rows):
    words = [((r["text"] or "").encode().lower().split() + [b""]) for r in rows]
    out = [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1 if r["doc_id"] is not None else False for r in rows]
    counts = Counter(w for ws, o in zip(words, out) if not o for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return sorted(repr((r["doc_id"], o, len(ws), sum(w in counts for w in ws), total,
                        round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), 7)))
                  for r, ws, o in zip(rows, words, out))


def base(df):
    return sorted(repr((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 7))) for r in df.collect())


@pytest.mark.parametrize("table, own", [(hmm.TABLE, hmm.OWN), (40, 10), (0, 0)])
def test_base_against_brute_force(spark, table, own):
    """Whatever is in the table of frequent words, and in the join of the rare ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = hmm.scores(docs, states=2, table=table, own=own)
    assert base(got) == brute_base(docs.collect())


def test_words_have_one_unit_of_chance(spark):
    """All known words and one unknown of each bucket share the chance of their class."""
    docs = spark.createDataFrame([(b"a b a c",), (b"d a e f g",)], "text binary")
    known = hmm.classes(hmm.word_counts(docs), own=3)
    assert known.own == 3 and known.total == 11 and known.distinct == 8
    inside = Counter()
    for c, n in known.table.values():
        if c >= known.own:
            inside[c - known.own] += (n + 0.5) / known.bucket_mass[c - known.own]
    assert all(inside[b] + 0.5 / known.bucket_mass[b] == pytest.approx(1.0) for b in range(hmm.BUCKETS))


def test_score_is_class_chain_times_word_shares(spark):
    docs = fixtures.documents(spark)
    a = {repr((r["doc_id"], r["n_tokens"])): r["score"] for r in hmm.scores(docs, 1, table=0, own=0).collect()}
    b = {repr((r["doc_id"], r["n_tokens"])): r["score"] for r in hmm.scores(docs, 1, table=100, own=0).collect()}
    assert a == pytest.approx(b, abs=1e-6)  # a word's way to its count changes nothing


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    rows = hmm.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    out = [r for r in rows if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in out)
    assert sum(r["score"] - r["base_score"] for r in out) / tokens > 0.3
    assert sum(r["score"] > r["base_score"] for r in out) / len(out) > 0.9


def test_odd_rows(spark):
    docs = fixtures.documents(spark)
    got = hmm.scores(docs)
    assert base(got) == brute_base(docs.collect())
    again = hmm.scores(fixtures.clashing(docs).select("*", *[F.lit("x").alias(c) for c in ("row", "classes", "rare", "base", "inside")]))
    assert base(again) == base(got)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.collect())
    assert hmm.scores(fixtures.documents(spark, [])).collect() == []
    held = hmm.scores(docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")).collect()
    assert held and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in held)


@pytest.mark.parametrize("rows, shares", [(40, 4), (25, 2), (7, 1)])
def test_start_reads_all_rows(spark, monkeypatch, rows, shares):
    """The rounds of the start take turns on shares that hold every row once, copies among them."""
    texts = spark.createDataFrame([(i // 2, bytearray(np.array([i % 3, i % 5], dtype=np.uint16).tobytes())) for i in range(rows)], "doc_id long, classes binary")
    seen, plain = [], hmm.expected
    monkeypatch.setattr(hmm, "expected", lambda t, m: (seen.append(sorted((r["doc_id"], bytes(r["classes"])) for r in t.collect())), plain(t, m))[1])
    hmm.trained(texts, np.full(6, 1 / 6), 2, start_rows=10, start_rounds=4, rounds=1)
    whole = sorted((r["doc_id"], bytes(r["classes"])) for r in texts.collect())
    assert sorted(x for part in seen[:shares] for x in part) == whole == seen[4]
    assert len(seen) == 5 and all(seen[i] == seen[i % shares] for i in range(4))
