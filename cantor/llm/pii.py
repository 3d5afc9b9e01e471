"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns find e-mail and IP addresses, card and phone numbers in the whole text; these base spans always stand. The field
then labels the tokens that patterns can't settle. Its nodes are tokens with a digit or '@' (any other token is
outside for certain, so the chain falls apart there). Neighbouring nodes share learnt transitions; distant nodes that
repeat the same digits or address, or end in the same long number, share a skip potential that favours one
kind. Each node has a skip link to the one before and to the first of its like, so links grow with the text, not with its square.
Loopy sum-product messages, damped, carry the evidence; nodes under base spans are held to their label.
Nodes whose marginal for a kind reaches SURE are added as spans, where they touch no base span.

Learning is piecewise: feature weights by regularised logistic regression, transitions by the mutual information of
neighbours, the skip weight by the smoothed log odds that like tokens agree where one has a kind; on at most SAMPLE texts of up to SAMPLE_CHARS characters with a digit or
'@', the ones with the smallest hash of their id, labelled by the patterns. The model is a few hundred numbers and is broadcast.

Defined results: null and empty texts have no span. Repeated rows get equal results. Offsets are code points, end
exclusive. An empty table gives an empty result, and an untrained field adds nothing. Columns of the input are
kept only where named in keep.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import short_batches, smallest

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "email", "ip", "B-card", "I-card", "B-phone", "I-phone")
#: Of each label: its kind, as a number from 0, or -1.
KIND_OF = np.array([-1, 0, 1, 2, 2, 3, 3])
SAMPLE, SAMPLE_CHARS = 3000, 20_000
EPOCHS, STEP, WEIGHT_DECAY = 600, 1.0, 1e-3
MOST_CHAIN, MOST_SKIP = 3.0, 8.0
#: Like tokens that are imagined to agree, beside one that doesn't, before any is seen.
AGREE = 3000.0
#: Tokens of each shape that are imagined to be outside of every span.
DOUBT = 1
SURE = 0.9
ROUNDS, DAMPING = 12, 0.5
HELD = 25.0
#: A token longer than this is cut at characters that no kind has; what is longer still is no node, as nothing that patterns miss is.
LONGEST = 100
#: Tokens that end in so many equal digits are alike.
TAIL = 8

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_EMAIL_LIKE = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_AREA = re.compile(r"\([0-9]{2,4}\)")
_LOCAL_NUMBER = re.compile(r"[0-9]{3}-[0-9]{4}")
_FULL_NUMBER = re.compile(r"[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}")
_EDGE = " \t\n\r\x0b\x0c"
_PART = re.compile(r"[A-Za-z0-9@._%+()-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if len(m[0]) <= 37 and 13 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def nodes(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or '@', without punctuation at their edges (a '+' or '(' in front stays)."""
    out, end = [], 0
    for m in _MARK.finditer(text):
        if m.start() < end:
            continue
        low = max(end, m.start() - LONGEST - 1)
        start = m.start()
        while start > low and text[start - 1] not in _EDGE:
            start -= 1
        end = m.end()
        high = min(len(text), start + LONGEST + 2)
        while end < high and text[end] not in _EDGE:
            end += 1
        if end - start > LONGEST:
            # From the end of the node before; a long token's parts are short, so their sum is the text.
            first = start
            while first > (out[-1][1] if out else 0) and text[first - 1] not in _EDGE:
                first -= 1
            while end < len(text) and text[end] not in _EDGE:
                end += 1
            parts = [(first + p.start(), first + p.end()) for p in _PART.finditer(text[first:end]) if len(p[0]) <= LONGEST and _MARK.search(p[0])]
        else:
            parts = [(start, end)]
        for a, b in parts:
            while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
                b -= 1
            while a < b and not (text[a].isalnum() or text[a] in "+("):
                a += 1
            if a < b:
                out.append((a, b))
    return out


def _features(token: str) -> list[int]:
    """Active features; see N_FEATURES."""
    digits = _NOT_DIGIT.sub("", token)
    n = len(digits)
    size = n if n <= 4 else 5 if n <= 8 else 6 if n <= 12 else 7 if n <= 15 else 8 if n == 16 else 9 if n <= 19 else 10
    parts = token.split(".")
    dotted = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    tests = (
        "@" in token,
        _EMAIL_LIKE.search(token) is not None,
        dotted and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        dotted,
        token[0] == "+",
        _AREA.fullmatch(token) is not None,
        _LOCAL_NUMBER.fullmatch(token) is not None,
        _FULL_NUMBER.fullmatch(token) is not None,
        13 <= n <= 19 and luhn(digits),
        n == len(token),
        any(c.isalpha() for c in token),
        "." in token,
        "-" in token,
        13 <= n <= 19 and n == len(token) and luhn(digits),
    )
    return [size, *(11 + i for i, x in enumerate(tests) if x), 25]


N_FEATURES = 26


def _like(token: str) -> str:
    """Tokens of an equal key are alike."""
    if m := _EMAIL_LIKE.search(token):
        return m[0].lower()
    digits = _NOT_DIGIT.sub("", token)
    return digits[-TAIL:] if len(digits) >= TAIL else token.lower()


def _held(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """The label that base spans give each node, or -1 where none covers it."""
    out, by = [-1] * len(spans), sorted((a, b, k) for k, a, b in base)
    i = 0
    for k, (a, b) in enumerate(spans):
        while i < len(by) and by[i][1] <= a:
            i += 1
        if i < len(by) and by[i][0] < b:
            start, _, kind = by[i]
            first = k == 0 or spans[k - 1][1] <= start
            out[k] = (1, 2, 3 if first else 4, 5 if first else 6)[kind]
    return out


def _maximum_entropy(rows: list[list[int]], gold: np.ndarray) -> np.ndarray:
    """Weights of features and labels by regularised logistic regression: gradient steps over equal rows taken together."""
    kinds, which = np.unique([tuple(int(f in r) for f in range(N_FEATURES)) for r in map(set, rows)], axis=0, return_inverse=True)
    counts = np.zeros((len(kinds), len(LABELS)))
    np.add.at(counts, (which.ravel(), gold), 1.0)
    total, w = counts.sum(axis=1, keepdims=True), np.zeros((N_FEATURES, len(LABELS)))
    for _ in range(EPOCHS):
        z = kinds @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        w += STEP * (kinds.T @ (counts - total * p) / len(gold) - w * WEIGHT_DECAY)
    return w


class Field:
    """The weights, and inference over the nodes of one text."""

    def __init__(self):
        self.unary = np.zeros((N_FEATURES, len(LABELS)))
        self.chain = np.zeros((len(LABELS), len(LABELS)))
        self.skip = 0.0
        self.trained = False

    def scores(self, tokens: list[str]) -> np.ndarray:
        return np.array([self.unary[_features(t)].sum(axis=0) for t in tokens])

    def fit(self, texts: list[str]) -> Field:
        """Piecewise: each kind of potential is fitted by itself, on nodes whose label the patterns settle.

        A node outside every base span is taken as outside, unless it is like one inside of a base span of its text: such a node
        is what the field is for, so it teaches nothing.
        """
        rows, gold, pairs, agree, met = [], [], np.zeros((len(LABELS), len(LABELS))), AGREE, AGREE + 1.0
        for text in texts:
            spans = nodes(text)
            tokens, held = [text[a:b] for a, b in spans], _held(spans, base_spans(text))
            keys = [_like(t) for t in tokens]
            found = {k for k, y in zip(keys, held, strict=True) if y > 0}
            told = [y if y > 0 else -1 if k in found else 0 for k, y in zip(keys, held, strict=True)]
            last: dict[str, int] = {}
            for t, k, y in zip(tokens, keys, told, strict=True):
                if y < 0:
                    continue
                rows.append(_features(t))
                gold.append(y)
                if k in last and (y or last[k]):
                    met += 1
                    agree += KIND_OF[last[k]] == KIND_OF[y]
                last[k] = y
            for a, b in _runs(text, spans):
                for y, z in zip(told[a:b], told[a + 1 : b], strict=False):
                    if y >= 0 and z >= 0:
                        pairs[y, z] += 1
        if not rows:
            return self
        # Shapes that were never seen outside of a span aren't for that reason inside of one.
        for f in range(N_FEATURES - 1):
            rows += [[f, N_FEATURES - 1]] * DOUBT
            gold += [0] * DOUBT
        self.unary = _maximum_entropy(rows, np.array(gold))
        self.skip = min(MOST_SKIP, max(0.5, math.log(agree / max(1.0, met - agree))))
        # Pointwise mutual information of neighbours.
        even = pairs.sum(axis=1, keepdims=True) * pairs.sum(axis=0, keepdims=True) / max(1.0, pairs.sum())
        self.chain = np.clip(np.log((pairs + 0.5) / (even + 0.5)), -MOST_CHAIN, MOST_CHAIN)
        self.trained = True
        return self

    def marginals(self, unary: np.ndarray, edges: np.ndarray, skips: np.ndarray) -> np.ndarray:
        """Loopy sum-product in the log domain, all messages at once."""
        same = self.skip * (KIND_OF[:, None] == KIND_OF[None, :])
        pairs = np.concatenate([edges, edges[:, ::-1], skips, skips[:, ::-1]]).astype(int)
        k, e = len(LABELS), len(edges)
        back = np.concatenate([np.arange(e, 2 * e), np.arange(e), np.arange(2 * e + len(skips), len(pairs)), np.arange(2 * e, 2 * e + len(skips))])
        kind = np.repeat([0, 1, 2], [e, e, 2 * len(skips)])
        psi = np.stack([self.chain, self.chain.T, same])
        messages = np.zeros((len(pairs), k))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, pairs[:, 1], messages)
            new = np.empty_like(messages)
            for low in range(0, len(pairs), 20_000):
                part = slice(low, low + 20_000)
                x = (belief[pairs[part, 0]] - messages[back[part]])[:, :, None] + psi[kind[part]]
                top = x.max(axis=1)
                new[part] = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - messages).max() if len(new) else 0
            messages = DAMPING * messages + (1 - DAMPING) * new
            if moved < 1e-3:
                break
        belief = unary.copy()
        np.add.at(belief, pairs[:, 1], messages)
        belief -= belief.max(axis=1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans beyond the base ones."""
        if not self.trained:
            return []
        spans = nodes(text)
        held = _held(spans, base)
        if -1 not in held:
            return []
        tokens = [text[a:b] for a, b in spans]
        unary = self.scores(tokens)
        for i, y in enumerate(held):
            if y >= 0:
                unary[i, y] += HELD
        runs = _runs(text, spans)
        edges = np.array([(i, i + 1) for a, b in runs for i in range(a, b - 1)], int).reshape(-1, 2)
        first: dict[str, int] = {}
        last: dict[str, int] = {}
        skips = set()
        for i, t in enumerate(tokens):
            key = _like(t)
            for seen in (first, last):
                if key in seen and i - seen[key] >= 1:
                    skips.add((seen[key], i))
            first.setdefault(key, i)
            last[key] = i
        p = self.marginals(unary, edges, np.array(sorted(skips), int).reshape(-1, 2))
        by_kind = np.stack([p[:, KIND_OF == k].sum(axis=1) for k in range(len(KINDS))], 1)
        taken = _ends_by_start(base)
        out: list[tuple[int, int, int]] = []
        for a, b in runs:
            for i in range(a, b):
                kind = int(by_kind[i].argmax())
                if held[i] >= 0 or by_kind[i, kind] < SURE:
                    continue
                start, end = spans[i]
                # An inner token carries the span before it on.
                if out and i > a and kind >= 2 and p[i, 2 * kind] >= p[i, 2 * kind - 1] and out[-1][0] == kind and out[-1][2] == spans[i - 1][1]:
                    out[-1] = (kind, out[-1][1], end)
                else:
                    out.append((kind, start, end))
        return [s for s in out if not _touches(*taken, s[1], s[2])]


def _ends_by_start(base: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts in order, and the furthest end of the spans up to each."""
    ordered = sorted((a, b) for _, a, b in base)
    return [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))


def _touches(starts: list[int], ends: list[int], a: int, b: int) -> bool:
    """Whether some span overlaps [a, b)."""
    i = bisect_left(starts, b)
    return i > 0 and ends[i - 1] > a


def _runs(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches of nodes with nothing but white space and punctuation between them."""
    out, start = [], 0
    for i in range(1, len(spans)):
        gap = text[spans[i - 1][1] : spans[i][0]]
        if len(gap) > 8 or any(c.isalnum() for c in gap):
            out.append((start, i))
            start = i
    if spans:
        out.append((start, len(spans)))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    usable = docs.where(F.col(text).rlike("[0-9@]") & (F.length(text) <= SAMPLE_CHARS)).select(F.col(text).alias("t"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"))
    return Field().fit(smallest(usable, usable.count(), sample, "h", "t").column("t").to_pylist())


def find(docs: DataFrame, model: Field, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), redact: bool = False) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans, n_added and the kept columns; with redact, also redacted_text."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            counts, digests, lists, more, texts = [[], [], [], []], [], [], [], []
            for x in b.column(0):
                body = x.as_py()
                base = base_spans(body) if body else []
                extra = model.added(body, base) if body else []
                for k, c in enumerate(counts):
                    c.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans = sorted(base + extra)
                lists.append(joined(spans))
                more.append(len(extra))
                if redact:
                    texts.append(redacted(body, spans) if spans else body)
            columns = [*b.columns[1:], *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(lists, pa.string()), pa.array(more, pa.int64())]
            names = [*b.schema.names[1:], *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * redact, names=names + ["redacted_text"] * redact)

    rows = docs.select(F.col(text).alias("_text"), F.col(key).alias("doc_id"), *[c for c in keep if c != "doc_id"])
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[1:])
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"{kinds}, {counted}, base_sha256 string, spans string, n_added long" + ", redacted_text string" * redact)
