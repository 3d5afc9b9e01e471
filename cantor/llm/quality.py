"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Native: only DataFrame functions. Features are array expressions inside one row, so no word or line is ever
shuffled. The label model sees a table of vote patterns, at most 3 ** len(RULES) rows whatever the input.

Defined results: a null or empty text has no words, fails the base rules and isn't kept. Rows are independent,
so repeated rows get repeated results and ties don't arise. An empty table gives an empty result. Columns of
the input other than the two named are never read, so clashing names can't matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialize

#: White space, as the contract's words see it.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Short function words of the four languages, for the function-word rule.
FUNCTION_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "de", "la", "le", "les", "et", "un", "une", "en", "el", "los", "y", "que", "der", "die", "das", "und", "ist", "ein", "eine", "zu")
#: Each rule: name, condition of a vote against, condition of a vote for; it abstains where neither holds.
RULES = (
    ("length", "n_words < 40", "n_words >= 80"),
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("word_size", "word_chars < 3 * n_words or word_chars > 12 * n_words", "word_chars >= 4 * n_words and word_chars <= 9 * n_words"),
    ("dup_lines", "4 * n_dup_lines > n_lines", "n_lines > 1 and n_dup_lines = 0"),
    ("repeats", "10 * n_repeat_words > n_words", "n_repeat_words = 0 and n_words >= 40"),
    ("function_words", "n_function = 0 and n_words >= 40", "25 * n_function >= n_words"),
    ("capitals", "4 * n_upper > word_chars", "10 * n_upper <= word_chars"),
    ("endings", "5 * n_ended < n_lines", "2 * n_ended >= n_lines"),
)
ITERATIONS = 15
PRIOR = 0.7
ACCURACY = 0.8
#: A rule's accuracy is smoothed by so many imagined votes and kept within these limits.
SMOOTHING = 20.0
LEAST, MOST = 0.55, 0.98
BASE = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the counts the rules vote on."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACE))
    blank = F.lit(SPACE)
    narrow = docs.select(F.col(key).alias("doc_id"), body.alias("_t"), trimmed.alias("_w")).select(
        "doc_id",
        "_t",
        F.when(F.col("_w") == "", F.array().cast("array<string>")).otherwise(F.split("_w", "[\\x20\\x09-\\x0D]+")).alias("_words"),
        F.filter(F.split("_t", "\n"), lambda line: F.btrim(line, blank) != "").alias("_lines"),
    )
    kept_out = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    n = F.size("_words")
    hashed = narrow.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE, "")).cast("long").alias("word_chars"),
        kept_out(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.isin(*FUNCTION_WORDS))).cast("long").alias("n_function"),
        kept_out("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        F.size(F.filter("_lines", lambda line: F.substring(line, -1, 1).isin(".", "!", "?", '"'))).cast("long").alias("n_ended"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    # Only texts with an equal pair of windows pay for the sort.
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = hashed.withColumn("_s", F.when(repeated, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none)).drop("_h")
    twin = lambda x, i, at: F.coalesce(F.get(F.col("_s"), at)["h"] == x["h"], F.lit(False))
    places = F.array_sort(F.transform(F.filter("_s", lambda x, i: twin(x, i, i - 1) | twin(x, i, i + 1)), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"))
    return ordered.withColumn("n_repeat_words", F.aggregate(places, start, step, lambda a: a["n"])).drop("_s")


def votes(table: DataFrame) -> DataFrame:
    """Adds v_<rule>: 1 for, -1 against, 0 abstains; and base_failed."""
    cases = {f"v_{name}": F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for name, bad, good in RULES}
    return table.withColumns(cases | {"base_failed": F.expr(BASE)})


def _log_odds(prior: float, accuracy: list[float]) -> Column:
    total = F.lit(math.log(prior / (1 - prior)))
    for (name, _, _), a in zip(RULES, accuracy, strict=True):
        total = total + F.col(f"v_{name}") * F.lit(math.log(a / (1 - a)))
    return total


def fit(voted: DataFrame, iterations: int = ITERATIONS) -> tuple[float, list[float]]:
    """Prior and rule accuracies by expectation-maximisation over the table of vote patterns of all rows.

    Every iteration is one aggregation of at most 3 ** len(RULES) rows; only its sums come to the driver.
    """
    names = [f"v_{name}" for name, _, _ in RULES]
    patterns = materialize(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    prior, accuracy = PRIOR, [ACCURACY] * len(RULES)
    for _ in range(iterations):
        q = 1 / (1 + F.exp(-_log_odds(prior, accuracy)))
        sums = [F.sum(F.col("n") * F.col("q")), F.sum("n")]
        for v in names:
            sums += [F.sum(F.col("n") * F.when(F.col(v) == 1, F.col("q")).when(F.col(v) == -1, 1 - F.col("q")).otherwise(0.0)), F.sum(F.col("n") * F.abs(v))]
        row = patterns.withColumn("q", q).agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        if not row[1]:
            break
        prior = min(MOST, max(1 - MOST, (row[0] + SMOOTHING * PRIOR) / (row[1] + SMOOTHING)))
        accuracy = [min(MOST, max(LEAST, (row[2 + 2 * j] + SMOOTHING * ACCURACY) / (row[3 + 2 * j] + SMOOTHING))) for j in range(len(RULES))]
    return prior, accuracy


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Counts, votes, posterior and verdict of every document.

    The features are written once, narrow, to the shared folder: the fit and the verdict both read them.
    """
    voted = materialize(votes(features(docs, key, text)), "quality")
    prior, accuracy = fit(voted)
    posterior = 1 / (1 + F.exp(-_log_odds(prior, accuracy)))
    return voted.withColumn("posterior", posterior).withColumn("kept", ~F.col("base_failed") & (_log_odds(prior, accuracy) >= math.log(threshold / (1 - threshold))))
