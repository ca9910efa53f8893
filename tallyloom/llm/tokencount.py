"""Token counts by a map-side lookup in two tiers; pre-tokens are never shuffled.

Bounded per-task summaries of all texts, merged in bounded groups, give the
frequent pre-tokens. They are encoded once and sent to all tasks as one compact table. Pre-tokens
outside the table are encoded by the library, many in one call, and kept in a bounded cache that
lives as long as the Python worker. The result does not depend on either tier.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import kept_by_worker, text_or_empty

LIMIT = 512
#: The published pre-token pattern of byte-level BPE and its special string.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same on ASCII texts, where the standard library is faster.
ASCII_PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Characters on whose class regex libraries differ; a text with one goes to the tokenizer whole.
DISPUTED = regex.compile(r"[\x1c-\x1f\x85᠎​]|[^\p{Assigned}]")
ASCII_DISPUTED = re.compile(r"[\x1c-\x1f]")
#: Entries of the table sent to all tasks and of a task's summary. Each entry is a pre-token of at
#: most LONGEST characters, which bounds the table at about 6 MB.
FREQUENT, SUMMARY, LONGEST = 32_768, 8_192, 40
#: Entries of a worker's cache, each of at most LONGEST characters: about 150 MB.
CACHE = 1_000_000
#: Characters counted together, so that their unknown pre-tokens are encoded in one call.
TOGETHER = 1_000_000
#: Summaries merged in one task.
FAN_IN = 64


class Lengths:
    """Pre-token to number of tokens: the shared table and, above it, what this worker has encoded."""

    def __init__(self, tokenizer_path: str, table: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.table, self.known = table, dict(table)
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.at_special = regex.compile("|".join(regex.escape(s) for s in self.specials)) if self.specials else None

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text without disputed characters, and how many special strings lie between them."""
        split = ASCII_PRE_TOKEN.findall if text.isascii() else PRE_TOKEN.findall
        if not any(s in text for s in self.specials):
            return split(text), 0
        segments = self.at_special.split(text)
        return [t for s in segments for t in split(s)], len(segments) - 1

    def learn(self, new: list[str]) -> dict[str, int]:
        """Lengths of pre-tokens outside the cache; the short ones are kept, in place of all others when it is full."""
        fresh = dict(zip(new, self.encoded(new)))
        short = {t: n for t, n in fresh.items() if len(t) <= LONGEST}
        if len(self.known) - len(self.table) + len(short) > CACHE:
            self.known = dict(self.table)
        if len(short) <= CACHE:
            self.known.update(short)
        return fresh

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        out, waiting, whole, missing = [0] * len(texts), [], [], set()
        get = self.known.get
        for i, text in enumerate(texts):
            if (ASCII_DISPUTED if text.isascii() else DISPUTED).search(text):
                whole.append(i)
                continue
            found, out[i] = self.pre_tokens(text)
            lengths = list(map(get, found))
            if None in lengths:
                unknown = [t for t, n in zip(found, lengths) if n is None]
                out[i] += sum(n for n in lengths if n is not None)
                missing.update(unknown)
                waiting.append((i, unknown))
            else:
                out[i] += sum(lengths)
        if missing:
            fresh = self.learn(list(missing))
            for i, unknown in waiting:
                out[i] += sum(map(fresh.__getitem__, unknown))
        for i, n in zip(whole, self.encoded([texts[i] for i in whole])):
            out[i] = n
        return out

    def count(self, text: str) -> int:
        return self.count_all([text])[0]


def together(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``TOGETHER`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _top(counts: Counter, size: int) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]


def frequent_pre_tokens(texts: DataFrame, size: int = FREQUENT) -> list[str]:
    """At most ``size`` pre-tokens that are frequent over all texts (one string column)."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update((ASCII_PRE_TOKEN if text.isascii() else PRE_TOKEN).findall(text))
                if len(counts) > 16 * SUMMARY:
                    counts = Counter(dict(_top(counts, 4 * SUMMARY)))
        yield packed(Counter({t: n for t, n in counts.items() if len(t) <= LONGEST and n > 1}), SUMMARY)

    def packed(counts: Counter, most: int) -> pa.RecordBatch:
        best = _top(counts, most)
        return pa.RecordBatch.from_arrays(
            [pa.array([[t for t, _ in best]], pa.list_(pa.string())), pa.array([[n for _, n in best]], pa.list_(pa.int64()))],
            names=["token", "n"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for tokens, numbers in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts.update(dict(zip(tokens, numbers)))
            if len(counts) > 4 * size:
                counts = Counter(dict(_top(counts, 2 * size)))
        yield packed(counts, size)

    kind = "token array<string>, n array<bigint>"
    out = texts.mapInArrow(summed, kind)
    parts = texts.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // FAN_IN)
        out = out.repartition(parts).mapInArrow(merged, kind)
    counts: Counter = Counter()
    for row in out.collect():  # one row
        counts.update(dict(zip(row["token"], row["n"])))
    return [t for t, _ in _top(counts, size)]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, as the tokenizers library counts whole texts.

    Null text: empty, without tokens. Special strings inside a text count as one token each, the
    library's default. Texts of any length are encoded whole. Repeated rows stay; other columns
    are not read. ``tokenizer_path`` must be readable on every executor.
    """
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    common = frequent_pre_tokens(texts.select("text"))
    known = Lengths(tokenizer_path, {})
    # One string and one byte string travel, not a table of objects; no pre-token holds a NUL with other text.
    sizes = known.encoded(common) if common else []
    fits = [(t, n) for t, n in zip(common, sizes) if n < 256 and "\0" not in t]
    packed = "\0".join(t for t, _ in fits), bytes(n for _, n in fits)
    key = f"{tokenizer_path} {hashlib.sha256(packed[0].encode() + packed[1]).hexdigest()}"
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> Lengths:
            tokens, numbers = shared.value
            return Lengths(tokenizer_path, dict(zip(tokens.split("\0"), numbers)) if numbers else {})

        lengths = kept_by_worker("token lengths", key, fresh)
        for b in batches:
            counted = pa.array([n for part in together(b.column(1).to_pylist()) for n in lengths.count_all(part)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), counted], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = texts.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
