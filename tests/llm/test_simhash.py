"""Fingerprints, bit-sliced distances and components against brute force."""

import re

import numpy as np
import xxhash

from tallyloom.llm import simhash

DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints, radius=2):
    """Smallest id reachable, for (id, print) rows."""
    distinct = sorted({p for _, p in prints})
    part = {p: p for p in distinct}

    def root(p):
        while part[p] != p:
            p = part[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                part[root(b)] = root(a)
    least = {}
    for d, p in prints:
        least[root(p)] = min(least.get(root(p), d), d)
    return {d: least[root(p)] for d, p in prints}


def test_fingerprints_and_components(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    prints = [(d, plain_fingerprint(t)) for d, t in texts]
    parts = plain_components(prints)
    assert got == {d: (f"{p:016x}", parts[d]) for d, p in prints}
    assert len(set(parts.values())) < len(texts)


def test_long_text_by_parts():
    text = " ".join(f"Word{i % 977}x{i}" for i in range(70_000))
    assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def test_distances():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [base ^ np.uint64(1 << a) ^ np.uint64(1 << b) for a, b in ((0, 63), (5, 5), (17, 40))]
    prints = np.unique(np.concatenate([base, *near, rng.integers(0, 2**63, 200, dtype=np.uint64)]))
    true = np.array([[bin(int(a) ^ int(b)).count("1") for b in prints] for a in prints])
    for radius in (0, 1, 2, 3, 6):
        rows, words = simhash.within(prints, simhash.bit_planes(prints), radius)
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, :len(prints)].astype(bool)
        full = np.zeros(true.shape, dtype=bool)
        full[rows] = bits
        assert (full == (true <= radius)).all()


def test_hot_block_in_tiles(spark):
    """A long chain and a dense cloud that share a block come out whole from small tiles, with few links."""
    rng = np.random.default_rng(5)
    chain, at = [0], 0
    for k in range(1500):
        at ^= 1 << (22 + int(rng.integers(0, 42)))
        chain.append(at)
    cloud = [(7 << 40) ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a + 1, 64)]
    prints = sorted({p for p in chain + cloud})
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "print long")
    edges = simhash.links(df, 2, tile=128)
    assert edges.count() < 40 * len(prints)
    hung = {r["u"]: r["v"] for r in simhash.components(edges).collect()}
    expected = plain_components([(i, p) for i, p in enumerate(prints)])
    groups = {}
    for i, (p,) in enumerate(signed):
        groups.setdefault(hung.get(p, p), set()).add(expected[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values()))


def test_components_of_a_path(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u long, v long")
    got = {r["u"]: r["v"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 1001: 1000}
