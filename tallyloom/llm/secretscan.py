"""Secret scan: three base patterns, and a linear-chain conditional random field for the rest.

The field tags tokens as begin, inside or outside of a secret from their shape, the neighbouring
words and features of the whole file, and Viterbi finds the best tags. It is trained on windows
of a bounded sample of documents: what the base patterns find there is the label, and made-up
secrets are planted into copies of plain windows, with and without a key word before them.

A token whose outside score beats the others by more than two transitions can gain or lose is
outside on the best path whatever its neighbours are. Such tokens cut a text into short runs, and
only these go through Viterbi, with the same result as for the whole text.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import sample_ids

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ of at least 24 characters, without the short ones
KINDS = ("assign", "access", "hex", "crf")

#: Documents of the training sample, windows of one document, tokens of a window.
SAMPLE_ROWS, WINDOWS, WIDTH = 1_000, 4, 24
MASK = "[SECRET]"
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

_TOKEN = re.compile(r"([\w+/.=\-]+)")
_RUNS = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^\W\d_a-zA-Z]+|.")
_KEYWORD = re.compile(r"passw|secret|token|api_?key|credential|bearer|auth|private|access", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand in the base spans, without key words."""
    return sorted([m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
                  + [(s, e) for s, e, k in base_spans(text) if k != "assign"])


_PLAIN = {kind: [f"plain={kind},{n}" for n in range(11)] for kind in ("a", "Aa", "A")}


def plain_word(token: str) -> str | None:
    """The kind of a word of letters, by case, with or without a full stop behind; null for any other token."""
    word = token.rstrip(".")
    if not word.isalpha():
        return None
    return "a" if word.islower() else "Aa" if word[1:].islower() else "A" if word.isupper() else None


def own_features(token: str) -> list[str]:
    """Features of a token by itself; a plain word has only its kind and length."""
    kind = plain_word(token)
    if kind and not _KEYWORD.search(token):
        return [_PLAIN[kind][min(len(token) // 4, 10)]]
    runs = _RUNS.findall(token)
    classes = ["a" if r[0].islower() else "A" if r[0].isupper() else "0" if r[0].isdigit() else r[0] for r in runs]
    digits = sum(map(str.isdigit, token)) / len(token)
    length = min(len(token) // 4, 10)
    changes = min(len(runs), 12)
    mixed = ("0" in classes) + ("a" in classes) + ("A" in classes)
    plain_hex = mixed == 2 and not set(token) - set("0123456789abcdef")
    out = [f"shape={''.join(classes)[:6]}", f"len={length}", f"runs={changes},{length}", f"mixed={mixed},{length}",
           f"digits={int(4 * digits)},{mixed}", f"ascii={token.isascii()},{mixed}"]
    if plain_hex:
        out.append(f"hex={length}")
    if token.startswith("AKIA"):
        out.append("akia")
    if _KEYWORD.search(token):
        out.append(f"keyword,{mixed}")
    return out


def context_class(token: str) -> str:
    """What a token is to its neighbours."""
    if _KEYWORD.search(token):
        return "keyword"
    if plain_word(token):
        return "word"
    if set(token) <= set("=:/.-+"):
        return "sign"
    return "number" if token.isdigit() else "mixed" if re.search(r"\d", token) else "word"


def gap_class(gap: str) -> str:
    """What stands between two tokens."""
    return "colon" if ":" in gap else "quote" if '"' in gap or "'" in gap else "line" if "\n" in gap else \
        "space" if gap.strip() == "" else "other"


def file_features(text: str, tokens: int) -> list[str]:
    """Features of the whole file."""
    equals, symbols = text.count("="), sum(map(text.count, "#$%&{}<>"))
    return [f"equals={min(4, 200 * equals // max(tokens, 1))}", f"symbols={min(4, 10 * symbols // max(tokens, 1))}"]


CONTEXTS, GAPS = ("word", "keyword", "sign", "number", "mixed"), ("space", "colon", "quote", "line", "other")


def cut(text: str) -> tuple[list[str], list[str]]:
    """(gaps, tokens): one gap before each token and one behind the last."""
    parts = _TOKEN.split(text)
    return parts[0::2], parts[1::2]


def _described(token: str) -> tuple[tuple[str, ...], str]:
    """Features and context class of a token."""
    kind = plain_word(token)
    if kind and not _KEYWORD.search(token):
        return (_PLAIN[kind][min(len(token) // 4, 10)],), "word"
    return tuple(own_features(token)), context_class(token)


class _Rows(dict):
    """Key to the number of its row in ``matrix``; a miss is worked out. Begins anew above ``limit`` keys."""

    def __init__(self, work, width: int, limit: int):
        super().__init__()
        self.work, self.limit = work, limit
        self.matrix = np.zeros((1024, width))

    def __missing__(self, key):
        n = len(self)
        if n == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[n] = self.work(key)
        self[key] = n
        return n

    def rows(self, keys: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        numbers = np.fromiter(map(self.__getitem__, keys), dtype=np.int64, count=len(keys))
        return self.matrix[numbers]


@dataclass
class Field:
    """Weights by feature: a row of three tags each; transitions from tag to tag."""

    weights: dict[str, np.ndarray]
    transitions: np.ndarray

    def __post_init__(self):
        nothing = np.zeros(3)
        of = lambda name: self.weights.get(name, nothing)
        self.margin = 2 * (self.transitions.max() - self.transitions.min()) + 1e-9
        self.contexts = {side: np.array([of(f"{side}={c}") for c in CONTEXTS] + [nothing]) for side in ("before", "before2", "after")}
        self.gaps = {side: np.array([of(f"{side}={g}") for g in GAPS]) for side in ("gap", "behind")}
        # many tokens, few kinds of them
        row = cache(lambda names, context: (*sum((of(f) for f in names), nothing), CONTEXTS.index(context)))
        self.own = _Rows(lambda t: row(*_described(t)), 4, 200_000)
        self.gap = _Rows(lambda g: GAPS.index(gap_class(g)), 1, 20_000)
        self.of = of

    def emissions(self, gaps: list[str], tokens: list[str], file: list[str]) -> np.ndarray:
        rows = self.own.rows(tokens)
        context = rows[:, 3].astype(np.int64)
        none = len(CONTEXTS)
        padded = np.concatenate([[none, none], context, [none]])
        between = self.gap.rows(gaps)[:, 0].astype(np.int64)
        return (rows[:, :3] + self.contexts["before"][padded[1:-2]] + self.contexts["before2"][padded[:-3]]
                + self.contexts["after"][padded[3:]] + self.gaps["gap"][between[:-1]] + self.gaps["behind"][between[1:]]
                + sum((self.of(f) for f in file), np.zeros(3)))

    def viterbi(self, emissions: np.ndarray, first: bool, last: bool) -> list[int]:
        """Best tags; unless ``first`` (``last``) the token before (behind) is outside."""
        best = emissions[0] + (0 if first else self.transitions[OUTSIDE])
        back = []
        for row in emissions[1:]:
            paths = best[:, None] + self.transitions
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        if not last:
            best = best + self.transitions[:, OUTSIDE]
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def tag(self, emissions: np.ndarray) -> np.ndarray:
        """Best tags of a whole text, by runs between tokens that are outside for sure."""
        tags = np.zeros(len(emissions), dtype=np.int64)
        open_at = np.flatnonzero(emissions[:, OUTSIDE] - emissions[:, 1:].max(axis=1) <= self.margin)
        if len(open_at):
            for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1):
                s, e = run[0], run[-1] + 1
                tags[s:e] = self.viterbi(emissions[s:e], s == 0, e == len(tags))
        return tags

    def spans(self, text: str) -> list[tuple[int, int]]:
        gaps, tokens = cut(text)
        if not tokens:
            return []
        tags = self.tag(self.emissions(gaps, tokens, file_features(text, len(tokens))))
        hit = np.flatnonzero(tags)
        if not len(hit):
            return []
        ends = np.cumsum(np.fromiter((len(g) + len(t) for g, t in zip(gaps, tokens)), dtype=np.int64, count=len(tokens)))
        out: list[tuple[int, int]] = []
        for i in hit:
            start, end = int(ends[i]) - len(tokens[i]), int(ends[i]) - (len(tokens[i]) - len(tokens[i].rstrip(".")))
            if tags[i] == INSIDE and out and i and tags[i - 1]:
                out[-1] = (out[-1][0], end)
            elif end > start:
                out.append((start, end))
        return out


def window_features(gaps: list[str], tokens: list[str], file: list[str]) -> list[list[str]]:
    """All features of each token of a window, by name."""
    contexts = [context_class(t) for t in tokens]
    out = []
    for i, t in enumerate(tokens):
        names = own_features(t) + file + [f"gap={gap_class(gaps[i])}", f"behind={gap_class(gaps[i + 1])}"]
        names += [f"before={contexts[i - 1]}"] if i else []
        names += [f"before2={contexts[i - 2]}"] if i > 1 else []
        names += [f"after={contexts[i + 1]}"] if i + 1 < len(tokens) else []
        out.append(names)
    return out


def windows(text: str) -> list[tuple[list[str], list[str], list[int], list[str]]]:
    """At most WINDOWS (gaps, tokens, tags, file features) of a text: around base secrets first, then evenly spread."""
    gaps, tokens = cut(text)
    if not tokens:
        return []
    parts, tags, at, k = secret_parts(text), [], 0, 0
    for gap, token in zip(gaps, tokens):
        start = at + len(gap)
        at = start + len(token)
        while k < len(parts) and parts[k][1] <= start:
            k += 1
        inside = k < len(parts) and parts[k][0] < at
        tags.append(OUTSIDE if not inside else BEGIN if start <= parts[k][0] or not tags or not tags[-1] else INSIDE)
    begins = [max(0, i - WIDTH // 2) for i, t in enumerate(tags) if t == BEGIN][:WINDOWS // 2]
    spread = max(1, (len(tokens) - WIDTH) // (WINDOWS - len(begins)) + 1)
    begins += list(range(0, max(1, len(tokens) - WIDTH + 1), spread))[:WINDOWS - len(begins)]
    file = file_features(text, len(tokens))
    return [(gaps[b:b + WIDTH + 1], tokens[b:b + WIDTH], tags[b:b + WIDTH], file) for b in sorted(set(begins))]


def made_up(r: random.Random) -> str:
    """A secret of one of several usual forms."""
    letters, form = string.ascii_letters + string.digits, r.randrange(6)
    draw = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    if form == 0:
        return draw("0123456789abcdef", r.choice([32, 40, 64]))
    if form == 1:
        return "AKIA" + draw(string.ascii_uppercase + string.digits, 16)
    if form == 2:
        return r.choice(["ghp_", "sk-", "xoxb-", "glpat-"]) + draw(letters, r.randint(24, 40))
    if form == 3:
        return ".".join(["eyJ" + draw(letters, r.randint(16, 30)), draw(letters, r.randint(24, 60)), draw(letters + "_-", 43)])
    return draw(letters + "+/", r.randint(20, 44)) + r.choice(["", "=", "=="])


def planted(window: tuple, r: random.Random) -> tuple:
    """A copy of a plain window with a made-up secret in it, and often a word that announces it."""
    gaps, tokens, tags, file = (list(x) for x in window)
    at = r.randrange(len(tokens))
    before = r.choice([[], [], ["token", "="], ["secret", "="], ["Bearer"], ["password"], ["credential"], ["private_key", "="]])
    quote = r.choice(["", "", '"'])
    tokens[at:at] = [*before, made_up(r)]
    tags[at:at] = [OUTSIDE] * len(before) + [BEGIN]
    gaps[at + 1:at + 1] = [" "] * len(before) + [f"{quote} " if quote else " "]
    if quote:
        gaps[at + len(before)] += quote
    return gaps[:WIDTH + 1], tokens[:WIDTH], tags[:WIDTH], file


def train(found: list[tuple], steps: int = 80, rate: float = 0.3, ridge: float = 1e-3, seed: int = 11) -> Field:
    """Adagrad on the conditional likelihood of whole windows, by forward and backward sums."""
    r = random.Random(seed)
    plain = [w for w in found if w[1] and not any(w[2])] or [([" "] * 5, ["the", "and", "of", "to"], [0] * 4, file_features("", 4))]
    everything = found + [planted(plain[i % len(plain)], r) for i in range(max(600, len(plain) // 2))]
    everything = [w for w in everything if w[1]]
    named = [window_features(*w[:2], w[3]) for w in everything]
    index = {f: i + 1 for i, f in enumerate(sorted({f for w in named for t in w for f in t}))}
    most = max(len(t) for w in named for t in w)
    n = len(named)
    ids, gold, real = np.zeros((n, WIDTH, most), dtype=np.int64), np.zeros((n, WIDTH), dtype=np.int64), np.zeros((n, WIDTH), dtype=bool)
    for a, w in enumerate(named):
        gold[a, :len(w)], real[a, :len(w)] = everything[a][2], True
        for b, t in enumerate(w):
            ids[a, b, :len(t)] = [index[f] for f in t]
    weights, moves = np.zeros((len(index) + 1, 3)), np.zeros((3, 3))
    both = real[:, 1:] & real[:, :-1]
    truth = np.eye(3)[gold] * real[:, :, None]
    seen = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
    squares_w, squares_m = np.full_like(weights, 1e-3), np.full_like(moves, 1e-3)
    for _ in range(steps):
        e = weights[ids].sum(axis=2)
        alpha, beta = np.zeros((n, WIDTH, 3)), np.zeros((n, WIDTH, 3))
        alpha[:, 0] = e[:, 0]
        for t in range(1, WIDTH):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            alpha[:, t] = np.where(real[:, t, None], step, alpha[:, t - 1])
        for t in range(WIDTH - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], step, 0.0)
        norm = np.logaddexp.reduce(alpha[:, -1], axis=1)
        chance = np.exp(alpha + beta - norm[:, None, None]) * real[:, :, None]
        pairs = np.exp(alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - norm[:, None, None, None]) * both[:, :, None, None]
        gap = (chance - truth).reshape(-1, 3)
        flat = ids.reshape(-1, most)
        grad = np.stack([np.bincount(flat.ravel(), np.repeat(gap[:, k], most), len(weights)) for k in range(3)], axis=1) / n
        grad[0] = 0
        grad += ridge * weights
        grad_m = (pairs.sum(axis=(0, 1)) - seen) / n + ridge * moves
        squares_w += grad**2
        squares_m += grad_m**2
        weights -= rate * grad / np.sqrt(squares_w)
        moves -= rate * grad_m / np.sqrt(squares_m)
    return Field({f: weights[i] for f, i in index.items()}, moves)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Trained on windows of at most ``rows`` documents (least hashes of doc_id) and planted copies of them."""
    ids = sample_ids(docs, "doc_id", rows).withColumnRenamed("doc_id", "_id")
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = windows(text or "")
                if got:
                    columns = [[doc] * len(got), *map(list, zip(*got))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    texts = pa.list_(pa.string())
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(docs.schema["doc_id"].dataType), texts, texts, pa.list_(pa.int64()), texts]
    names = ["doc_id", "gaps", "tokens", "tags", "file"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(run, f"doc_id {kind}, gaps array<string>, tokens array<string>, tags array<bigint>, file array<string>")
    # A repeated id adds its windows once or more; the limit holds the bound on the sample all the same.
    got = found.distinct().orderBy("doc_id", "tokens", "gaps", "tags").limit(rows * WINDOWS).collect()
    return train([(r["gaps"], r["tokens"], r["tags"], r["file"]) for r in got])


def all_spans(text: str | None, model: Field) -> list[tuple[int, int, str]]:
    """Base spans, and the field's spans that overlap none of them, by start and kind."""
    text = text or ""
    base = base_spans(text)
    taken = sorted((s, e) for s, e, _ in base)
    more = [(s, e, "crf") for s, e in model.spans(text) if not any(a < e and s < b for a, b in taken)]
    return sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


SPANS = "array<struct<start:bigint,end:bigint,kind:string>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """(doc_id, spans) of every row: where secrets stand in the whole text, in code points, end exclusive.

    ``kind`` is assign, access or hex for the base patterns and crf for what the field adds. Null
    and empty texts have no spans; repeated rows stay; a null doc_id is kept. Other columns are
    not read. The field is fitted on ``docs`` unless one is given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_plain(model or fit(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for b in batches:
            found = [[dict(zip(("start", "end", "kind"), s)) for s in all_spans(t, field)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _ARROW_SPANS)], names=["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


def _plain(model: Field) -> tuple[dict, np.ndarray]:
    return model.weights, model.transitions


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of overlapping spans replaced by MASK."""
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """All rows and columns of documents, secrets in ``text`` masked and ``n_chars``, if there, counted anew where they were.

    Nothing is shuffled. Nulls stay null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_plain(model or fit(docs)))
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for b in batches:
            texts = b.column(at).to_pylist()
            found = [all_spans(t, field) for t in texts]
            new = [masked(t, s) if s else t for t, s in zip(texts, found)]
            columns = list(b.columns)
            columns[at] = pa.array(new, b.schema.field(at).type)
            if chars is not None:
                counts = [len(n) if s else c for n, s, c in zip(new, found, b.column(chars).to_pylist())]
                columns[chars] = pa.array(counts, b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
