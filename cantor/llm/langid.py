"""Language of whole texts by word-first backoff.

A word seen in training is scored by its smoothed log frequency per language. A word that wasn't is scored by its
character n-grams: the longest grams first, falling back to shorter ones wherever a longer one is unknown; a gram
of one character unknown to all languages says nothing. A text's score is the sum over its words; the result is
the best language and its probability under equal priors, tempered by the number of words.

The model is fitted on a bounded sample: the SAMPLE labelled rows of up to SAMPLE_CHARS characters with the smallest hash
of their id, of which the WORDS most frequent words and GRAMS most frequent grams per language are kept, those seen once
in a language left out (parameters; so is which rows may be learnt from). The model, of that bounded size, is broadcast. Prediction reads every whole text in one pass without a shuffle.

Defined results: null texts and texts without a letter are 'und' with score 0. Ties go to the first language by name.
Repeated rows get equal results. Rows with a null label are predicted but not learnt from. With no labelled row at
all every text is 'und'. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import short_batches, smallest

UNKNOWN = "und"
SAMPLE, SAMPLE_CHARS, WORDS, GRAMS = 4000, 20_000, 20_000, 30_000
LONGEST = 4
SMOOTH = 0.5
CACHE = 300_000
#: Words of a text that are scored at a time; their number is under CACHE.
CHUNK = 100_000
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """n-grams of a word between its edges; single characters without them."""
    if n == 1:
        return list(word)
    edged = f"<{word}>"
    return [edged[i : i + n] for i in range(len(edged) - n + 1)]


class Model:
    """Log probabilities by word, and by gram where no word is known."""

    def __init__(self, rows, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST):
        """rows: (text, label)."""
        by_word: dict[str, Counter] = defaultdict(Counter)
        by_gram: dict[str, list[Counter]] = defaultdict(lambda: [Counter() for _ in range(longest + 1)])
        for text, label in rows:
            by_word[label].update(words_of(text))
        for label, counted in by_word.items():
            for word, k in counted.items():
                for n in range(1, longest + 1):
                    for gram in grams_of(word, n):
                        by_gram[label][n][gram] += k
        self.labels, self.longest = sorted(by_word), longest
        # Row 0 of the vectors is for words of which nothing is known.
        self.vectors = [np.zeros(len(self.labels))]
        self.words = self._numbered([by_word[x] for x in self.labels], words)
        self.grams = {}
        for n in range(1, longest + 1):
            self.grams |= self._numbered([by_gram[x][n] for x in self.labels], grams)
        self.vectors = np.array(self.vectors)
        self._forget()

    def _forget(self) -> None:
        """Empties the cache: row of the store by word."""
        self.cache: dict[str, int] = {}
        self.store = np.empty((0, len(self.labels)))

    def _numbered(self, counts: list[Counter], most: int) -> dict[str, int]:
        """Rows of the vectors (log probabilities less their mean over the languages) by word or gram."""
        table = self._table(counts, most)
        first = len(self.vectors)
        self.vectors += [v - v.mean() for v in table.values()]
        return {x: first + i for i, x in enumerate(table)}

    @staticmethod
    def _table(counts: list[Counter], most: int) -> dict[str, np.ndarray]:
        kept = sorted({x for c in counts for x, k in sorted(c.items(), key=lambda p: (-p[1], p[0]))[:most] if k > 1})
        totals = [sum(c.values()) + SMOOTH * max(1, len(kept)) for c in counts]
        return {x: np.log([(c[x] + SMOOTH) / t for c, t in zip(counts, totals, strict=True)]) for x in kept}

    def _backed_off(self, word: str) -> list[int]:
        """At each position the longest known gram."""
        found, get, edged = [], self.grams.get, f"<{word}>"
        for i in range(len(edged)):
            for end in range(min(i + self.longest, len(edged)), i, -1):
                row = get(edged[i:end])
                if row is not None:
                    found.append(row)
                    break
        return found or [0]

    def _cached(self, words: list[str]) -> None:
        """Scores the words that aren't in the cache, all at once: a word's grams are summed over the root of their number."""
        new = [w for w in set(words) if w not in self.cache]
        if not new:
            return
        if len(self.cache) + len(new) > CACHE:
            self._forget()
            new = list(set(words))
        parts = [[row] if (row := self.words.get(w)) is not None else self._backed_off(w) for w in new]
        sizes = np.array([len(p) for p in parts])
        flat = np.fromiter((row for p in parts for row in p), np.int64, int(sizes.sum()))
        sums = np.add.reduceat(self.vectors[flat], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]
        first = len(self.cache)
        if first + len(new) > len(self.store):
            grown = np.empty((max(first + len(new), 2 * len(self.store)), len(self.labels)))
            grown[:first] = self.store[:first]
            self.store = grown
        self.store[first : first + len(new)] = sums
        self.cache.update(zip(new, range(first, first + len(new))))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text and self.labels else []
        if not words:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.labels))
        for i in range(0, len(words), CHUNK):
            part = words[i : i + CHUNK]
            self._cached(part)
            total += self.store[np.fromiter(map(self.cache.__getitem__, part), np.int64, len(part))].sum(axis=0)
        total /= math.sqrt(len(words))
        best = int(total.argmax())
        p = np.exp(total - total[best])
        return self.labels[best], float(p[best] / p.sum())

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "store": self.store[:0]}


def fit(docs: DataFrame, learnt: Column, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE, **sizes) -> Model:
    """The model of at most `sample` rows: of those where `learnt` holds, the ones with the smallest hash of the id."""
    usable = docs.where(learnt & F.col(text).isNotNull() & F.col(label).isNotNull() & (F.length(text) <= SAMPLE_CHARS))
    ranked = usable.select(F.col(text).alias("t"), F.col(label).alias("l"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"))
    rows = smallest(ranked, usable.select(F.count("*")).first()[0], sample, "h", "l", "t")
    return Model(zip(rows.column("t").to_pylist(), rows.column("l").to_pylist(), strict=True), **sizes)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, lang_pred, score, and the columns named in keep, of which the text itself may be one: it is sent once."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    first = 0 if text in keep else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[first:], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*names, "lang_pred", "score"])

    rows = docs.select(F.col(text).alias("_text"), F.col(key).alias("doc_id"), *[c for c in keep if c not in ("doc_id", text)])
    names = [text, *rows.columns[1:]][first:]
    kinds = ", ".join(f"`{n}` {t}" for n, (_, t) in zip(names, rows.dtypes[first:], strict=True))
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")
