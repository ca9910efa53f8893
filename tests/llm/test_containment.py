"""MinHash containment search against brute force."""

import re

import pytest

from tallyloom.llm import containment, decontaminate
from tests.llm import rows

DIR = "/root/testdata/sf0.001"


def brute(docs, items):
    def grams(t):
        w = [x for x in re.split(r"[^\w]|_", (t or "").lower()) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    out = set()
    for i, t in items:
        own = grams(t)
        out |= {(d, i, len(own & grams(x)), len(own)) for d, x in docs if own and len(own & grams(x)) >= 0.8 * len(own)}
    return out


def test_every_item_keeps_a_run():
    """The worst spread of the q // 5 shingles that may miss leaves a run as long as the class asks for."""
    for q in range(1, 3000):
        c = next(c for c in containment.CLASSES if c.least <= q <= (c.most or q))
        missing = q // 5
        assert -(-(q - missing) // (missing + 1)) >= min(c.run, q), q
        assert c.collision >= 0.9997


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_search_equals_brute_force(spark, broadcast_rows):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    items = spark.read.parquet(f"{DIR}/benchmark.parquet")
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    whole = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    # Items with words changed at either end and inside, at each size class, in a long document.
    words = " ".join(t for _, t in whole[:3]).split()
    more = [(1000 + n, " ".join(words[40:40 + n])) for n in (5, 6, 9, 10, 14, 19, 20, 40, 90)]
    more += [(2000 + n, " ".join(["changed", *words[41:40 + n]])) for n in (14, 24, 60)]
    more += [(3000 + n, " ".join([*words[40:40 + n // 2], "changed", *words[41 + n // 2:40 + n]])) for n in (34, 60, 90)]
    long = [(10_000, " ".join(words * 3)), (10_001, "x " * 20_000 + " ".join(words[38:160]))]
    items = spark.createDataFrame(texts + more, "item_id long, text string")
    docs = spark.createDataFrame(whole + long, "doc_id long, text string")
    found = containment.search(docs, "doc_id", "text", items, "item_id", "text", broadcast_rows=broadcast_rows).collect()
    got = {(r["doc_id"], r["item_id"], r["matched"], r["n_shingles"]) for r in found}
    assert got == brute(whole + long, texts + more) and len(got) == len(found) > 15


def test_long_items_are_not_broadcast(spark, monkeypatch):
    """Few rows of long items reach the bound in bytes; the result is the same by either join."""
    words = [f"w{i}" for i in range(400)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a b c d e f g"), (3, None)], "item_id int, text string")
    docs = spark.createDataFrame([(1, "x y z " * 50 + " ".join(words)), (2, "o a b c d e f g"), (None, None)], "doc_id int, text string")
    sent = []
    hint = containment.F.broadcast
    monkeypatch.setattr(containment.F, "broadcast", lambda df: sent.append(df) or hint(df))
    found = []
    # item 1 has 393 runs of ten values, each row with its 396 shingles: about 13 MB in 3,930 rows
    for most, broadcasts in ((containment.BROADCAST_BYTES, True), (1_000_000, False)):
        sent.clear()
        out = containment.search(docs, "doc_id", "text", items, "item_id", "text", broadcast_bytes=most)
        found.append({(r["doc_id"], r["item_id"], r["matched"]) for r in out.collect()})
        assert bool(sent) == broadcasts
    assert found[0] == found[1] == {(1, 1, 396), (2, 2, 3)}


def test_no_python_and_no_cross_join(spark):
    docs, items = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_common_item(spark):
    """A passage in all documents is found in each."""
    docs = spark.createDataFrame([(i, f"start{i} {rows.TEXT} end{i}") for i in range(3000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, rows.TEXT)], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == 3000
