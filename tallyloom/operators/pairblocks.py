"""Pairs of rows that lie together in a group, compared in blocks of numpy, and logistic fits on what comes out.

Nothing here is kept beyond the rows of a few groups and ``STEP`` pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of whole groups worked on together (one group may have more), and pairs made of them at a time.
ROWS, BYTES, STEP = 4_096, 1 << 26, 65_536
#: 64-bit words of a row's word set held at a time, and of all pairs compared in one operation.
WORDS, AT_ONCE = 256, 1 << 20


def _changes(t: pa.Table, columns: list[str]) -> np.ndarray:
    """Positions, from 1 on, at which a row differs from the one before in any of the columns."""
    new = np.zeros(max(len(t) - 1, 0), dtype=bool)
    for c in columns:
        column = _whole(t, c)
        new |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(new) + 1


def _whole(t: pa.Table, column: str) -> pa.Array:
    found = t.column(column).combine_chunks()
    return found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)


def whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables of whole groups, of about ``ROWS`` rows or ``BYTES``. Groups agree in ``columns``, none of them null."""
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        starts, done, most = _changes(t, columns), 0, min(ROWS, BYTES * len(t) // max(t.nbytes, 1))
        for start in starts:
            if start - done >= most or start == starts[-1]:
                yield t.slice(done, start - done).combine_chunks()
                done = start
        held = t.slice(done)
    if held is not None and len(held):
        yield held.combine_chunks()


def _codes(column: pa.Array) -> np.ndarray:
    """A number for each value, the same for equal ones, -1 for null."""
    return column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _in_order(column: pa.Array) -> np.ndarray:
    """Numbers in the order of the values."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    values = column.to_pylist()
    rank = {v: i for i, v in enumerate(sorted(set(values)))}
    return np.array([rank[v] for v in values], dtype=np.int64)


def _lengths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length of each list, 0 for null, and whether it is there."""
    return pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_valid().to_numpy(zero_copy_only=False)


def _padded(column: pa.Array, kind: pa.DataType, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists as rows of a matrix filled up with zeros, their lengths, and whether a list is there and has no nulls."""
    lengths, there = _lengths(column)
    flat = column.flatten().cast(kind, safe=False)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), max(lengths, default=0)), dtype=dtype)
    there = there.copy()
    if flat.null_count:
        there[rows[flat.is_null().to_numpy(zero_copy_only=False)]] = False
        flat = pc.fill_null(flat, 0)
    out[rows, at] = flat.to_numpy(zero_copy_only=False)
    return out, lengths, there


class Vectors:
    """Vectors of rows; one that is null or has a null is alike to nothing, nor are two of different length."""

    def __init__(self, column: pa.Array):
        self.values, self.lengths, self.there = _padded(column, pa.float64(), float)
        self.plain = bool(self.there.all()) and len(set(self.lengths.tolist())) <= 1
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.values, self.values))

    def cosine(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a))
        for k in range(0, len(a), 8_192):
            x, y = a[k : k + 8_192], b[k : k + 8_192]
            below = self.norms[x] * self.norms[y]
            with np.errstate(all="ignore"):
                out[k : k + 8_192] = np.where(below == 0, 0.0, np.einsum("ij,ij->i", self.values[x], self.values[y]) / below)
        if not self.plain:
            out[~(self.there[a] & self.there[b] & (self.lengths[a] == self.lengths[b]))] = 0.0
        return out


class Tokens:
    """Sets of words of rows. A word that two rows of a group have is a bit; the groups are numbered on their own."""

    def __init__(self, column: pa.Array, group: np.ndarray):
        self.lengths, self.there = _lengths(column)
        n = max(len(self.lengths), 1)
        found = column.flatten().dictionary_encode(null_encoding="encode")
        size = max(len(found.dictionary), 1)
        rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
        # (group, word) and row in one number; a word that a row has twice is there once
        held = np.sort((group[rows] * size + found.indices.to_numpy(zero_copy_only=False)) * n + rows)
        held = held[np.diff(held, prepend=-1) != 0]
        word, rows = np.divmod(held, n)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        times = np.diff(starts, append=len(word))
        shared = np.repeat(times > 1, times)
        of = word[starts[times > 1]] // size
        bit = np.arange(len(of)) - np.searchsorted(of, of)
        self.rows, self.bits = rows[shared], np.repeat(bit, times[times > 1])
        order = np.argsort(self.rows, kind="stable")
        self.rows, self.bits = self.rows[order], self.bits[order]
        bits = np.bincount(of, minlength=int(group[-1]) + 1 if len(group) else 0)
        words = -(-bits // 64)
        # groups of as many words, rounded up to a power of two, are compared together
        self.wide = np.where(words > 0, 1 << np.ceil(np.log2(np.maximum(words, 1))).astype(np.int64), 0)[group]
        self.sets = {int(w): self._sets(int(w)) for w in np.unique(self.wide) if 0 < w <= WORDS}

    def _sets(self, wide: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Place of a row, and the bits of the rows of this width from word ``first`` on."""
        chosen = self.wide == wide
        place = np.cumsum(chosen) - 1
        own = chosen[self.rows] & (self.bits >= 64 * first) & (self.bits < 64 * (first + WORDS))
        out = np.zeros((int(chosen.sum()), min(wide, WORDS)), dtype=np.uint64)
        bit = self.bits[own] - 64 * first
        np.bitwise_or.at(out, (place[self.rows[own]], bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
        return place, out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words of both rows."""
        out = np.zeros(len(a), dtype=np.int64)
        wide = self.wide[a]
        for w in np.unique(wide):
            chosen = np.flatnonzero(wide == w)
            for first in range(0, int(w), WORDS):
                place, sets = self.sets[int(w)] if w <= WORDS else self._sets(int(w), first)
                step = max(AT_ONCE // sets.shape[1], 1)
                for k in range(0, len(chosen), step):
                    at = chosen[k : k + step]
                    both = np.bitwise_count(sets[place[a[at]]] & sets[place[b[at]]])
                    out[at] += both.sum(axis=1, dtype=np.int64)
        return out

    def jaccard(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = self.common(a, b)
        every = self.lengths[a] + self.lengths[b] - common
        good = (every != 0) & self.there[a] & self.there[b]
        return np.where(good, common / np.where(good, every, 1), 0.0)


class Rows:
    """Rows of whole groups, sorted by id in each: who pairs with whom, and how alike two are."""

    def __init__(self, t: pa.Table, group: list[str], different: str | None):
        starts = np.concatenate([[0], _changes(t, group)]).astype(np.int64)
        self.group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(t)))
        self.ends = np.append(starts, len(t))[1:][self.group]
        self.ids, self.copies = _in_order(_whole(t, "id")), _whole(t, "copies").to_numpy(zero_copy_only=False)
        self.band, self.own = (_whole(t, c).to_numpy(zero_copy_only=False) for c in ("band", "_own"))
        self.alone = pc.equal(_whole(t, "_low"), _whole(t, "_high")).to_numpy(zero_copy_only=False)
        hashes, lengths, _ = _padded(_whole(t, "hashes"), pa.int64(), np.int64)
        self.hashes, self.bands = np.ascontiguousarray(hashes.T), lengths
        self.different = None if different is None else _codes(_whole(t, different))
        self.vectors, self.tokens = Vectors(_whole(t, "vector")), Tokens(_whole(t, "tokens"), self.group)
        self.models, self.long = _codes(_whole(t, "model_id")), _whole(t, "length").cast(pa.float64()).to_numpy(zero_copy_only=False)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of the rows of all pairs, at most about ``STEP`` at a time; the smaller id first, in their first common band."""
        later = self.ends - np.arange(len(self.ends)) - 1
        until, row = np.cumsum(later), 0
        while row < len(later):
            end = max(int(np.searchsorted(until, (until[row - 1] if row else 0) + STEP, "right")), row + 1)
            many = later[row:end]
            a = np.repeat(np.arange(row, end), many)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
            row = end
            keep = (self.ids[a] < self.ids[b]) & (self.alone[a] | (self.own[a] != self.own[b]))
            if self.different is not None:
                x, y = self.different[a], self.different[b]
                keep &= (x != y) & (x >= 0) & (y >= 0)
            a, b = a[keep], b[keep]
            for j in range(len(self.hashes) - 1):  # those that agree in a band before have met there
                met = (self.hashes[j][a] == self.hashes[j][b]) & (j < self.band[a]) & (j < self.bands[a]) & (j < self.bands[b])
                a, b = a[~met], b[~met]
            if len(a):
                yield a, b

    def same_model(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((self.models[a] == self.models[b]) & (self.models[a] >= 0)).astype(float)

    def length_gap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.long[a], self.long[b]
        most = np.maximum(x, y)
        good = ~np.isnan(most) & (most != 0)
        return np.where(good, np.abs(x - y) / np.where(good, most, 1.0), 0.0)


def newton(
    rows: DataFrame, columns: list[str], factor: dict[float, float], weight: float, mean: np.ndarray, spread: np.ndarray,
    penalty: float, iterations: int, settled: float,
) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) of the least mean loss plus half the penalty on the squared scaled coefficients.

    ``rows`` has label, pairs and the columns; a row weighs ``pairs`` times the factor of its label, all of them
    ``weight``. Columns are centred by ``mean`` and divided by ``spread``; one without spread has the coefficient 0.
    A step is one aggregate; its parameters travel as an array literal.
    """
    used = np.flatnonzero(spread > 0)
    width = len(used) + 1
    upper = [(i, j) for i in range(width) for j in range(i, width)]
    scaled = rows.select(
        (F.col("label") > 0).alias("hit"), F.when(F.col("label") > 0, F.lit(factor[1.0])).otherwise(F.lit(factor[0.0])).alias("f"), "pairs",
        F.lit(1.0).alias("x0"), *[((F.col(columns[i]) - float(mean[i])) / float(spread[i])).alias(f"x{k + 1}") for k, i in enumerate(used)])
    x = [F.col(f"x{i}") for i in range(width)]
    ridge = penalty * np.append(0.0, np.ones(width - 1))

    def sums_at(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        given = F.lit(at.tolist())
        margin = reduce(lambda a, b: a + b, [F.get(given, F.lit(i)) * x[i] for i in range(width)])
        met = scaled.select("hit", (F.col("f") * F.col("pairs")).alias("w"), (1 / (1 + F.exp(-margin))).alias("p"), *x)
        p, w, hit = (F.col(c) for c in ("p", "w", "hit"))
        met = met.select(
            (-w * F.log(F.greatest(F.when(hit, p).otherwise(1 - p), F.lit(1e-300)))).alias("loss"),
            (w * (p - F.when(hit, 1.0).otherwise(0.0))).alias("g"), (w * p * (1 - p)).alias("h"), *x)
        found = met.agg(
            F.sum("loss"), *[F.sum(F.col("g") * c) for c in x], *[F.sum(F.col("h") * x[i] * x[j]) for i, j in upper]).first()
        found = np.array(found, dtype=float) / weight
        bend = np.zeros((width, width))
        for (i, j), v in zip(upper, found[1 + width :]):
            bend[i, j] = bend[j, i] = v
        return found[0] + 0.5 * np.sum(ridge * at * at), found[1 : 1 + width] + ridge * at, bend + np.diag(ridge)

    at = np.zeros(width)
    loss, slope, bend = sums_at(at)
    for _ in range(iterations):
        step = np.linalg.lstsq(bend, slope, rcond=None)[0]
        if np.max(np.abs(step)) < settled:  # what is left after a last step is of the order of its square
            at = at - step
            break
        new = sums_at(at - step)
        while not new[0] <= loss + 1e-12 and np.max(np.abs(step)) >= settled:
            step = step / 2
            new = sums_at(at - step)
        at, (loss, slope, bend) = at - step, new
    coefficients = np.zeros(len(columns))
    coefficients[used] = at[1:] / spread[used]
    return coefficients, float(at[0] - coefficients @ mean)
