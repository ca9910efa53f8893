import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import rates
from tallyloom.operators import linkage as lk
from tallyloom.operators import pairblocks as pb


# Threshold to (bands, rows) for signatures of length 512.
BANDS = {0: (512, 1), 0.002: (256, 2), 0.07: (128, 4), 0.3: (64, 8), 0.6: (32, 16), 0.81: (16, 32), 0.92: (8, 64),
         0.97: (4, 128), 0.99: (2, 256), 0.998: (1, 512)}


@pytest.mark.parametrize("target", BANDS)
def test_band_choice(target):
    assert lk.choose_bands(512, target)[:2] == BANDS[target]


def table(spark, n=300, hot=120, seed=0):
    """Rows with three band hashes; ``hot`` rows share the hash of band 0."""
    rng = np.random.default_rng(seed)
    hashes = rng.integers(0, 60, (n, 3))
    hashes[:hot, 0] = 999
    pdf = pd.DataFrame({
        "id": np.arange(n), "model": rng.integers(0, 25, n), "brand": rng.choice(["x", "y"], n),
        "shop": rng.choice(["s1", "s2", "s3"], n), "hashes": list(hashes)})
    return spark.createDataFrame(pdf, "id long, model int, brand string, shop string, hashes array<long>"), pdf


def brute(pdf, blocked):
    rows = pdf.to_dict("records")
    out = set()
    for a, b in combinations(rows, 2):
        if any(p == q for p, q in zip(a["hashes"], b["hashes"])):
            if not blocked or (a["brand"] == b["brand"] and a["shop"] != b["shop"]):
                out.add((a["id"], b["id"]))
    return out


@pytest.mark.parametrize("blocked", [False, True])
def test_pair_counts_equal_brute_force(spark, blocked):
    df, pdf = table(spark)
    pairs = brute(pdf, blocked)
    model = pdf["model"].to_numpy()
    args = (["brand"], "shop") if blocked else (None, None)
    row = lk.pair_totals(df, 3, "model", *args).first()
    assert row["candidates"] == len(pairs)
    assert row["found"] == sum(model[a] == model[b] for a, b in pairs)
    assert row["duplicates"] == sum(c * (c - 1) // 2 for c in pdf.groupby("model").size())


def expanded(pdf, out, alike):
    """All record pairs that the class pairs stand for."""
    members = {}
    for r in pdf.to_dict("records"):
        members.setdefault((tuple(r["hashes"]), *[r[c] for c in alike]), []).append(r["id"])
    of = {min(m): m for m in members.values()}
    pairs = []
    for r in out:
        a, b = of[r["id_a"]], of[r["id_b"]]
        own = list(combinations(sorted(a), 2)) if r["id_a"] == r["id_b"] else [tuple(sorted((x, y))) for x in a for y in b]
        assert r["pairs"] == len(own)
        pairs += own
    return pairs


@pytest.mark.parametrize("tile", [1000, 7])
@pytest.mark.parametrize("blocked", [False, True])
def test_all_pairs_come_out_once(spark, blocked, tile):
    """A hot bucket, copies and tiles: the class pairs stand for every candidate pair, each once."""
    df, pdf = table(spark)
    copies = pdf.iloc[:60].assign(id=lambda x: x["id"] + 1000)
    pdf = pd.concat([pdf, copies, copies.assign(id=copies["id"] + 1000)], ignore_index=True)
    df = spark.createDataFrame(pdf, df.schema)
    kwargs = {"same": ["brand"], "different": "shop"} if blocked else {"alike": ["model"]}
    out = lk.candidate_pairs(df, tile=tile, **kwargs).collect()
    pairs = expanded(pdf, out, ["brand", "shop"] if blocked else ["model"])
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(pdf, blocked)


def test_members_rebuild_every_pair(spark):
    """Class pairs and membership give back all record pairs; a null is a value of its own."""
    df, pdf = table(spark)
    copies = pdf.iloc[:60].assign(id=lambda x: x["id"] + 1000)
    pdf = pd.concat([pdf, copies], ignore_index=True)
    df = spark.createDataFrame(pdf, df.schema)
    members = {}
    for r in lk.class_members(df, alike=["model"]).collect():
        members.setdefault(r["representative"], []).append(r["id"])
        assert r["copies"] == (2 if r["id"] % 1000 < 60 else 1)
    assert sorted(i for m in members.values() for i in m) == sorted(pdf["id"]) and len(members) == 300
    pairs = set()
    for r in lk.candidate_pairs(df, alike=["model"]).collect():
        a, b = members[r["id_a"]], members[r["id_b"]]
        pairs |= {tuple(sorted((x, y))) for x in a for y in b if x != y}
    assert pairs == brute(pdf, False)
    gone = spark.createDataFrame([(1, None, [5]), (2, None, [5]), (3, "x", [5])], "id long, shop string, hashes array<long>")
    assert sorted(tuple(r) for r in lk.class_members(gone, alike=["shop"]).collect()) == [(1, 1, 2), (2, 1, 2), (3, 3, 1)]


def test_bucket_of_thousands(spark):
    n = 1500
    df = spark.range(n).select("id", F.array(F.lit(1), F.col("id")).alias("hashes"))
    assert lk.candidate_pairs(df, tile=200).agg(F.sum("pairs"), F.count("*")).first()[:] == (n * (n - 1) // 2,) * 2
    alike = spark.range(n).select("id", F.array(F.lit(1), F.lit(2)).alias("hashes"))
    assert [tuple(r) for r in lk.candidate_pairs(alike).collect()] == [(0, 0, n * (n - 1) // 2)]


def test_truth_groups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, None), (6, None)], "id long, model string")
    assert sorted(tuple(r) for r in lk.truth_groups(df, "model").collect()) == [("a", i, 3, 3) for i in (1, 2, 3)]


def test_equal_and_zero_vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=16)
    rows = [(0, v.tolist()), (1, v.tolist()), (2, [0.0] * 16), (3, (-v).tolist())]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    signed = lk.signatures(df, "vector", 4, 16, 4)
    hashes = {r["id"]: r["hashes"] for r in signed.collect()}
    assert hashes[0] == hashes[1] and hashes[2] == [2 ** lk.plane_count(4) - 1] * 4
    assert [tuple(r) for r in lk.candidate_pairs(signed).collect()] == [(0, 0, 1)]  # two copies, one pair


def test_labels_balance_and_measures(spark):
    pairs = spark.createDataFrame([(i, i + 10, int(i < 3)) for i in range(10)], "id_a long, id_b long, label int")
    out = lk.balance(pairs, F.xxhash64("id_a", "id_b").cast("double"), ["id_a", "id_b"])
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 7, 1: 7}
    per = [r["count"] for r in out.filter("label = 1").groupBy("id_a").count().collect()]
    assert sorted(per) == [2, 2, 3]
    only = lk.balance(pairs.filter("label = 0"), F.lit(1.0), ["id_a"])
    assert only.count() == 7
    nothing = spark.createDataFrame([(0, 0.1)], "y int, p double")
    row = rates.pair_measures(nothing, "y", "p", F.lit(0)).first()
    assert row["precision"] == row["recall"] == row["f1_hat"] == 0.0


def test_pairs_weigh_as_many_as_they_stand_for(spark):
    pairs = spark.createDataFrame([(1, 2, 1000, 1), (3, 4, 1, 0), (5, 6, 3, 0)], "id_a long, id_b long, pairs long, label int")
    weight = {r["id_a"]: r["weight"] for r in lk.balance_weights(pairs).collect()}
    assert weight == {1: 1000.0, 3: 250.0, 5: 750.0}
    assert {r["weight"] for r in lk.balance_weights(pairs.filter("label = 0")).collect()} == {1.0, 3.0}

    rng = np.random.default_rng(2)
    rows = [(float(x), float(rng.random()), float(rng.random() < 0.5), float(rng.random()), int(rng.random() < x),
             int(rng.integers(1, 30))) for x in rng.random(200)]
    folded = spark.createDataFrame(rows, "cosine double, overlap double, same_model double, length_gap double, label int, pairs long")
    whole = folded.withColumn("pairs", F.explode(F.array_repeat(F.lit(1), F.col("pairs").cast("int"))))
    a, b = (lk.fit_pair_classifier(df).stages[-1] for df in (folded, whole))
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-3, atol=1e-3)
    assert abs(a.intercept - b.intercept) < 1e-2


def test_bootstrap_covers_every_row(spark):
    df = spark.range(500)
    draw = F.pmod(F.xxhash64(F.lit(3), F.col("k")), F.col("n"))
    out = {r["split"]: r["count"] for r in lk.bootstrap_split(df, "id", draw).groupBy("split").count().collect()}
    assert sum(out.values()) == 500 and 0.55 < out["train"] / 500 < 0.72


def test_distinct_bucket_contents(spark):
    rows = [(1, 0, 5), (2, 0, 5), (1, 1, 8), (2, 1, 8), (3, 1, 9), (1, 2, 4), (3, 2, 4)]
    df = spark.createDataFrame(rows, "id long, band int, hash long")
    out = lk.distinct_bucket_contents(df).select("size", "first_id").collect()
    assert sorted(tuple(r) for r in out) == [(2, 1), (2, 1)]  # {1,2} once and {1,3}


def test_no_records(spark):
    df = spark.createDataFrame([], "id long, model int, hashes array<long>")
    assert lk.candidate_pairs(df).count() == 0
    assert tuple(lk.pair_totals(df, 2, "model").first()) == (0, 0, 0)


def test_measures_are_not_empty(spark):
    """At the registered threshold every one of the four counts is above zero."""
    from tallyloom.plans import load_all

    row = load_all()["pair_measures_by_cosine"].build(spark, "/root/testdata/sf0.01").first()
    assert all(row[c] > 0 for c in ("tp", "tn", "fp", "fn"))


def test_text_vectors_as_by_hand(spark):
    """Whole texts, empty and null ones, repeated rows and ids, one word thousands of times."""
    from collections import Counter

    texts = ["b a a", "A\tb\n c", "", None, "b a a", "z " * 5000 + "y", "  ", "d" * 3000]
    df = spark.createDataFrame([(7, t) for t in texts], "id int, text string")

    def first_letter(word, size):
        return F.ascii(word) % size

    got = lk.text_vectors(df, "text", 256, first_letter).collect()
    assert got[0].asDict().keys() == {"id", "text", "vector"} and len(got) == len(texts)
    counts = [Counter(ord(w[0]) for w in (t or "").lower().split()) for t in texts]
    rows = sum(1 for _ in texts)
    seen = Counter(t for c in counts for t in c)
    want = {t: {k: n * math.log((rows + 1) / (seen[k] + 1)) for k, n in c.items()} for t, c in zip(texts, counts)}
    for row in got:
        terms = [v["term"] for v in row["vector"]]
        assert terms == sorted(want[row["text"]])
        assert {v["term"]: v["weight"] for v in row["vector"]} == pytest.approx(want[row["text"]])
    assert lk.text_vectors(df.limit(0), "text").count() == 0


def sides(spark, n):
    """Records with repeated ids and missing values, as the features of a pair take them."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4)], None if i % 11 == 0 else [f"w{k}" for k in set(rng.integers(0, 9, 5))],
             None if i % 7 == 0 else f"m{i % 3}", i % 13, i % 25) for i in [*range(n), 3, 3, 40]]
    return spark.createDataFrame(rows, "id long, vector array<double>, tokens array<string>, model_id string, length int, model int")


@pytest.mark.parametrize("args", [{}, {"same": ["brand"], "different": "shop"}])
@pytest.mark.parametrize("tile", [lk.TILE, 16])
def test_carried_columns_are_those_of_a_join(spark, args, tile):
    """Whatever goes with the classes to their buckets; copies of a class pair with themselves."""
    df, pdf = table(spark)
    df = df.unionByName(df.filter("id < 60").withColumn("id", F.col("id") + 500))  # copies
    records = sides(spark, 600)
    pairs = lk.candidate_pairs(df, **args, tile=tile)
    joined = lk.label_pairs(lk.pair_features(pairs, records.drop("model")), df.select("id", "model").distinct(), "model")
    carried = lk.candidate_pairs(df, **args, tile=tile, carried=records.drop("model").join(df.select("id", "model").distinct(), "id"))
    features = lk.pair_features(lk.label_pairs(carried, None, "model"))
    rows = lambda x: sorted(repr(tuple(r)) for r in x.select(*joined.columns).collect())
    assert rows(features) == rows(joined) and joined.count() > 1000


def test_no_shuffle_of_pairs(spark):
    """Texts and vectors move with the classes: no pair is dealt out by its ids."""
    df, _ = table(spark)
    found = lk.pair_features(lk.candidate_pairs(df, same=["brand"], different="shop", carried=sides(spark, 300).drop("model")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and "hashpartitioning(id_" not in plan


@pytest.mark.parametrize("args", [{}, {"same": ["brand"], "different": "shop"}])
@pytest.mark.parametrize("tile", [lk.TILE, 16])
def test_features_of_blocks_are_those_of_pairs(spark, monkeypatch, args, tile):
    """Compared where the classes meet, a few rows and pairs at a time: copies, repeated ids and missing values as in the expressions."""
    monkeypatch.setattr(pb, "ROWS", 50)
    monkeypatch.setattr(pb, "STEP", 300)
    df, _ = table(spark)
    df = df.unionByName(df.filter("id < 60").withColumn("id", F.col("id") + 500))
    odd = "case when id % 17 = 0 then array(1.0, null, 0.0, 2.0) when id % 19 = 0 then array(0.0, 0.0, 0.0, 0.0) when id % 23 = 0 then array(1.0) when id % 29 = 0 then null else vector end"
    records = sides(spark, 600).withColumn("vector", F.expr(odd).cast("array<double>"))
    whole = lk.pair_features(lk.candidate_pairs(df, **args, tile=tile, carried=records))
    blocks = lk.pair_features(lk.candidate_pairs(df, **args, tile=tile, carried=records, features=True)).select(*whole.columns)
    rows = lambda x: sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in x.collect())
    assert rows(blocks) == rows(whole) and len(rows(whole)) > 1000
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.count("array_intersect") == (0 if args else 2)  # only for pairs of a class with itself


def test_common_words_by_hand(monkeypatch):
    """Any number of words in a group, more than are held at a time too."""
    monkeypatch.setattr(pb, "WORDS", 4)
    rng = np.random.default_rng(3)
    words = [None if i == 5 else [None if w == 7 else f"w{w}" for w in rng.integers(0, most, size)]
             for i, (most, size) in enumerate([(30, 20)] * 40 + [(2000, 900)] * 30 + [(3, 0)] * 3)]
    group = np.repeat([0, 1, 2], [40, 30, 3])
    t = pb.Tokens(pa.array(words, pa.list_(pa.string())), group)
    a, b = np.array([(i, j) for i in range(73) for j in range(i + 1, 73) if group[i] == group[j]]).T
    want = [len(set(words[i] or []) & set(words[j] or [])) for i, j in zip(a, b)]
    assert t.common(a, b).tolist() == want and t.wide.max() > 4
    share = [0.0 if not words[i] or not words[j] else n / (len(words[i]) + len(words[j]) - n) for i, j, n in zip(a, b, want)]
    assert t.jaccard(a, b) == pytest.approx(share)


def test_classifier_is_that_of_mllib(spark):
    """The same optimum without a copy of the pairs in memory, one label and a constant feature included."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(8)
    rows = [(float(x), float(rng.random() * 1e-3), 1.0, float(rng.normal()), int(rng.random() < 0.1 + 0.7 * x), int(rng.integers(1, 30)))
            for x in rng.random(400)]
    df = spark.createDataFrame(rows, "cosine double, overlap double, same_model double, length_gap double, label int, pairs long")
    p = df.agg((F.sum(F.col("label") * F.col("pairs")) / F.sum("pairs")).alias("p")).first()["p"]
    weighted = df.withColumn("weight", F.col("pairs") * F.when(F.col("label") == 1, 0.5 / p).otherwise(0.5 / (1 - p)))
    want = Pipeline(stages=[
        VectorAssembler(inputCols=lk.PAIR_FEATURES, outputCol="features"),
        LogisticRegression(labelCol="label", weightCol="weight", maxIter=500, tol=1e-13, regParam=1e-4)]).fit(weighted)
    model = lk.fit_pair_classifier(df)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(want.stages[-1].coefficients.toArray(), rel=1e-4, abs=1e-6)
    assert model.stages[-1].intercept == pytest.approx(want.stages[-1].intercept, rel=1e-4)
    by_mllib = [r["probability"][1] for r in model.transform(df).collect()]
    assert [r["p"] for r in lk.duplicate_probability(model, df).collect()] == pytest.approx(by_mllib)
    for label in (0, 1):
        only = df.filter(F.col("label") == label)
        assert {r["p"] for r in lk.duplicate_probability(lk.fit_pair_classifier(only), only).collect()} == {float(label)}


def test_term_frequencies_without_comparing_expressions(spark):
    """Rows with a term, whatever its counts; terms are sorted by value, not by an expression for every two."""
    rows = [(1, "b a a"), (2, "a  c"), (3, None), (4, ""), (4, "A")]
    df = spark.createDataFrame(rows, "id int, text string")

    def letter(word, size):
        return F.ascii(word) - 97

    held = df.select(F.array_distinct(lk._terms("text", 4, letter)).alias("terms"))
    assert lk.inverse_frequencies(held, 4) == pytest.approx([math.log(6 / 4), math.log(3), math.log(3), math.log(6)])
    plan = lk.term_counts(df, "text", 4, letter)._jdf.queryExecution().executedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan
