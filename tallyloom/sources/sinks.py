"""File sinks. Rows are spread by Spark; nothing is gathered to write it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_run(df: DataFrame, folder: str, stamp: str, format: str = "parquet", **options) -> str:
    """Write a table under a run-stamped name."""
    path = f"{folder}/run={stamp}"
    df.write.format(format).options(**options).mode("error").save(path)
    return path


def append_results(df: DataFrame, folder: str) -> None:
    """Add the lines of a run to the results so far."""
    df.write.mode("append").parquet(folder)


def write_by(df: DataFrame, folder: str, columns: list[str], format: str = "parquet", **options) -> None:
    """One folder per value of ``columns``.

    The rebalance hint gathers each value's rows into few files and splits a value that
    holds very many rows over several tasks.
    """
    df.hint("rebalance", *[F.col(c) for c in columns]).write.partitionBy(*columns).format(format).options(
        **options).mode("error").save(folder)


def write_kinds(tables: dict[str, DataFrame], folder: str) -> None:
    """Inputs, labels, predictions and samples side by side, told apart by ``kind``."""
    every = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [t.withColumn("kind", F.lit(kind)) for kind, t in tables.items()])
    every.write.partitionBy("kind").mode("error").parquet(folder)
