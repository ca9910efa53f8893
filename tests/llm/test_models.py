"""Quality trees, toxicity machine and secret field: brute force, exactness, held-out accuracy."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import quality, secretscan, toxicity
from tallyloom.llm.queries import QUERIES

DIR = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)]


def test_quality_base(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, DIR).collect():
        base = plain_statistics(texts[r["doc_id"]])
        assert [r[c] for c in quality.BASE] == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_quality_verdicts(spark):
    """Nearly all good documents that pass the base rules stay; most bad ones go."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_quality_rules"](spark, BIG).collect() if r["doc_id"] in labels]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_trees_are_monotonic_and_flat():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] - np.sin(3 * x[:, 1]) + rng.normal(size=3000) > 0).astype(float)
    trees = quality.grow(x, y, [1, 0, -1])

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        return trees.value[node]

    plain = [1 / (1 + np.exp(-(trees.bias + sum(walk(r, row) for r in trees.roots)))) for row in x[:50]]
    assert np.allclose(plain, trees.score(x[:50]))
    assert np.mean((trees.score(x) > 0.5) == y) > 0.75
    grid = np.linspace(-4, 4, 200)
    for row in x[:40]:
        up, down = np.tile(row, (200, 1)), np.tile(row, (200, 1))
        up[:, 0], down[:, 2] = grid, grid
        assert (np.diff(trees.score(up)) >= -1e-12).all() and (np.diff(trees.score(down)) <= 1e-12).all()


def test_one_label_only_leaves_the_base_rules():
    trees = quality.grow(np.ones((5, 3)), np.ones(5), [0, 0, 0])
    assert (trees.score(np.ones((2, 3))) > 0.5).all()
    assert (quality.grow(np.zeros((0, 3)), np.zeros(0), [0, 0, 0]).score(np.ones((2, 3))) == 0.5).all()


def test_machine_learns_pairs():
    """Label 1 only where both of two terms meet: no sum of weights, the machine does."""
    rng = np.random.default_rng(1)
    lists, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        lists.append([50, *([1] if a else [2]), *([3] if b else [4]), *rng.integers(10, 40, 3)])
        labels.append(float(a == b))
    index = np.concatenate(lists)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]])
    machine = toxicity.train(index, starts, np.array(labels), epochs=40, size=51, ridge=1e-4)
    guess = machine.score(index, starts) > 0.5
    assert np.mean(guess == np.array(labels)) > 0.95
    machine.vector[:] = 0
    assert np.mean((machine.score(index, starts) > 0.5) == np.array(labels)) < 0.65


def test_score_is_the_sum_over_pairs():
    """Weights, then the products of all pairs of vectors by their number of terms, one by one; terms out of use are none."""
    rng = np.random.default_rng(8)
    used = rng.random(31) < 0.7
    used[30] = True
    machine = toxicity.Machine(rng.normal(size=31), rng.normal(size=(31, toxicity.FACTORS)), used)
    texts = [[30, *rng.choice(30, n, replace=False)] for n in (0, 1, 2, 7, 25)]

    def plain(terms):
        terms = [t for t in terms if used[t]]
        pairs = sum(float(machine.vector[a] @ machine.vector[b]) for i, a in enumerate(terms) for b in terms[:i])
        return 1 / (1 + np.exp(-(sum(machine.weight[t] for t in terms) + pairs / len(terms))))

    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    assert np.allclose(machine.score(np.concatenate(texts), starts), [plain(t) for t in texts])


def test_terms_of_a_text(spark):
    """A word, its stems if it is as long, and the stems that different words share, each once."""
    texts = ["", "ab", "abcde", "abcde abcdef", "ABCDE, abcdef! abcde", "abcde xyzuv"]
    rows = spark.createDataFrame(list(enumerate(texts)), "at int, text string").select("at", toxicity.terms(F.col("text")).alias("t"))
    got = {r["at"]: r["t"] for r in rows.collect()}
    assert [len(got[i]) for i in range(len(texts))] == [1, 2, 4, 8, 8, 7]
    assert all(t[0] == toxicity.TERMS and len(set(t)) == len(t) for t in got.values())
    assert set(got[2]) < set(got[3]) == set(got[4])


def test_fit_learns_pairs(spark):
    """The pair case through fit() as it runs: no term of a pair goes with the label by itself."""
    r = random.Random(5)
    fillers, docs, labels = [f"{c}{d}filler" for c in "abcdefgh" for d in "klmnop"], [], []
    for i in range(4000):
        a, b = r.random() < 0.5, r.random() < 0.5
        docs.append((i, " ".join(r.sample(fillers, 20) + ["insult" if a else "praise", "group" if b else "person"])))
        labels.append((i, int(a == b)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.scores(docs, labels).collect() if r["held_out"]]
    assert len(rows) > 1000 and np.mean([(r["score"] > 0.5) == truth[r["doc_id"]] for r in rows]) > 0.95


def test_joint_terms():
    """Pairs are found whatever task has them; terms that add up, and copies of a term, are none."""
    rng = np.random.default_rng(6)
    lists, labels = [], []
    for _ in range(4000):
        a, b, c, d = rng.random(4) < 0.3
        lists.append([*np.flatnonzero([a, b, c, d, c]), *(5 + np.flatnonzero(rng.random(40) < 0.2))])
        labels.append(float(rng.random() < 0.1 + 0.7 * (a and b) + 0.15 * c))
    index, lengths = np.concatenate(lists).astype(np.int32), np.array([len(x) for x in lists])
    whole = toxicity.joint(index, lengths, np.array(labels))
    split = [toxicity.joint(index, lengths, np.array(labels), k, 3) for k in range(3)]
    assert whole.tolist() == [0, 1] and np.unique(np.concatenate(split)).tolist() == [0, 1]


def test_pairs_by_any_number_of_tasks(spark):
    """Pairs found by Spark are those found at once, in one task or in many; an empty sample has none."""
    rng = np.random.default_rng(9)
    lists = [np.flatnonzero(rng.random(30) < 0.3).tolist() for _ in range(3000)]
    labels = [float(rng.random() < 0.05 + 0.8 * (3 in t and 7 in t)) for t in lists]
    whole = toxicity.joint(np.concatenate(lists).astype(np.int32), np.array([len(t) for t in lists]), np.array(labels))
    rows = spark.createDataFrame([(float(y), t) for y, t in zip(labels, lists)], "_label double, terms array<int>").repartition(5)
    for most in (10**9, 40_000, 10):
        got = toxicity.paired(rows, most)
        assert sorted({r["term"] for r in got.collect()}) == whole.tolist() == [3, 7]
    assert toxicity.paired(rows.limit(0)).collect() == []


def test_toxicity_held_out(spark):
    rows = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [r["predicted"] for r in test if labels[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in test if labels[r["doc_id"]] == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.01


def plain_base(text):
    """Base spans straight from the definition."""
    patterns = {
        "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""",
                   lambda m: len(m[2]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)}
    out = []
    for kind, (pattern, good) in patterns.items():
        out += [(m.start(), list(patterns).index(kind), kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def test_secret_base(spark):
    r = random.Random(4)
    hostile = ["pasſword = abcdef123", "API_KEY:'abc' toKen=\"abcdefg.=\"", "secret=ab secret = secret=abcdef", "a" * 24 + "é" + "0" * 23,
               "AKIA" + "Z" * 16 + "AKIA" + "1" * 15, "tokenapikey : x.y.z.", None, "", "token=" + "f" * 40 + " é🙂 passwd='AKIA" + "B" * 20]
    hostile += ["".join(r.choice(["token", "=", " ", "'", "abc", "AKIA", "0f" * 13, "é", "\n", "secret", ":"]) for _ in range(30)) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(hostile)], "doc_id long, text string")
    docs = docs.unionAll(spark.read.parquet(f"{DIR}/documents.parquet").selectExpr("doc_id + 10000", "text"))
    docs = docs.toDF("doc_id", "text")
    texts = {x["doc_id"]: x["text"] or "" for x in docs.collect()}
    for row in secretscan.scan(docs).collect():
        base = [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["spans"] if s["kind"] != "crf"]
        assert base == plain_base(texts[row["doc_id"]])
    got = QUERIES["op2_secret_scan"](spark, DIR).collect()
    for row in got:
        base = plain_base(texts[row["doc_id"] + 10000])
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row["spans"].split(",")) or not base


def trained(spark):
    return secretscan.fit(spark.read.parquet(f"{BIG}/documents.parquet"))


def test_runs_give_the_best_path(spark):
    """Cutting a text at tokens that are outside for sure leaves the Viterbi path of the whole text as it is."""
    field = trained(spark)
    rng = np.random.default_rng(8)
    for n in (1, 2, 5, 200):
        e = rng.normal(0, 6, (n, 3)) + np.array([3, 0, 0])
        assert field.tag(e).tolist() == field.viterbi(e, True, True)
    best = max(([a, b, c] for a in range(3) for b in range(3) for c in range(3)),
               key=lambda p: sum(e[i, t] for i, t in enumerate(p)) + field.transitions[p[0], p[1]] + field.transitions[p[1], p[2]])
    assert field.viterbi(e[:3], True, True) == best


def test_secrets_without_key_words(spark):
    """The field finds made-up secrets that no base pattern has, and leaves plain texts alone."""
    field = trained(spark)
    docs = [r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    r, found, wrong = random.Random(99), 0, 0
    planted = 0
    for text in docs:
        clean = secretscan.all_spans(text, field)
        wrong += sum(k == "crf" for _, _, k in clean)
        words = text.split(" ")
        key = secretscan.made_up(r)
        words.insert(len(words) // 2, key)
        new = " ".join(words)
        if not [s for s in secretscan.base_spans(new) if key in new[s[0]:s[1]]]:
            planted += 1
            at = new.index(key)
            found += any(s < at + len(key) and at < e for s, e, _ in secretscan.all_spans(new, field))
    assert planted > 50 and found / planted > 0.9 and wrong <= len(docs) // 50


def test_redaction(spark):
    docs = spark.createDataFrame([(1, 'x token = "abcdef123456" y', 27), (2, "plain words", 11), (3, None, None)], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secretscan.redact(docs, trained(spark)).collect()}
    assert got == {1: ('x [SECRET]" y', 13), 2: ("plain words", 11), 3: (None, None)}
