"""Benchmark decontamination: test items inside documents, by size-partitioned MinHash containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import containment


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, n_shingles, containment): one row per document and benchmark item in it.

    An item leaks when at least 0.8 of its five-word shingles stand in the document. Nulls, short
    texts, repeated rows and empty tables: as ``containment.search`` says.
    """
    return containment.search(docs, "doc_id", "text", benchmark, "item_id", "text")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document holds no benchmark item; null keys are keys.

    The list of leaking documents grows with the input, so it is never broadcast: both sides meet
    by a merge join, at every size alike.
    """
    hit = leaks(docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(hit.hint("merge"), docs["doc_id"].eqNullSafe(hit["_leaked"]), "left_anti")


LEAKS_SQL = containment.SEARCH_SQL.format(docs="documents", items="benchmark")
