"""Tokens, phrases and normalised words of fragments, as array expressions within a row: nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ABBREVIATIONS, SPACES, _c, fold_tokens, normalize

LEAST_PHRASE = 4


def tokens(text: Column | str) -> Column:
    return F.filter(F.split(_c(text), SPACES), lambda t: t != "")


def breaks(toks: Column, folded: Column, language: Column) -> Column:
    """Per token: whether a phrase may end after it (the last token is left to the caller)."""

    def after(t: Column, f: Column) -> Column:
        core = F.regexp_replace(F.lower(f), "[^a-z]", "")
        known = F.when(language == "fr", core.isin(*ABBREVIATIONS["fr"])).otherwise(core.isin(*ABBREVIATIONS["en"]))
        last = F.substring(t, -1, 1)
        return F.when(last.isin(",", ":", "—"), True).when(last.isin(".", "?", "!", ";"), ~(known | (F.length(core) <= 1))).otherwise(False)

    return F.zip_with(toks, folded, after)


def with_phrases(fragments: DataFrame, language: Column | str = "language", text: str = "text") -> DataFrame:
    """Adds tokens, folded, and starts: the token index at which each phrase begins.

    Fragments between breaks of fewer than LEAST_PHRASE tokens join the phrase before; a short first phrase joins the second.
    """
    n = F.size("tokens")
    cut = fragments.withColumn("tokens", tokens(text)).withColumn("folded", fold_tokens(F.col("tokens"), language))
    cut = cut.withColumn("_b", breaks(F.col("tokens"), F.col("folded"), _c(language)))
    ends = F.filter(F.transform("_b", lambda b, i: F.when(b | (i == n - 1), i)), lambda i: i.isNotNull())
    cut = cut.withColumn("_e", ends)
    begin = F.transform("_e", lambda e, j: F.struct(F.when(j == 0, 0).otherwise(F.get(F.col("_e"), j - 1) + 1).alias("at"), e.alias("end")))
    own = F.transform(F.filter(begin, lambda f: (f["at"] == 0) | (f["end"] - f["at"] + 1 >= LEAST_PHRASE)), lambda f: f["at"])
    cut = cut.withColumn("_s", own)
    short = (F.size("_s") > 1) & (F.get(F.col("_s"), F.lit(1)) < LEAST_PHRASE)
    starts = F.when(short, F.concat(F.array(F.lit(0)), F.slice("_s", F.lit(3), F.greatest(F.size("_s") - 2, F.lit(0))))).otherwise(F.col("_s"))
    return cut.withColumn("starts", starts).drop("_b", "_e", "_s")


def phrases(fragments: DataFrame, language: Column | str = "language") -> DataFrame:
    """book_id, ord, phrase, n_tokens, phrase_text: a row per phrase; an empty text has one empty phrase."""
    rows = with_phrases(fragments, language)
    ends = lambda i: F.coalesce(F.get(F.col("starts"), i + 1), F.size("tokens"))
    all_ = F.transform("starts", lambda s, i: F.struct((ends(i) - s).alias("n_tokens"), F.array_join(F.slice("tokens", s + 1, ends(i) - s), " ").alias("phrase_text")))
    none = F.array(F.struct(F.lit(0).alias("n_tokens"), F.col("text").alias("phrase_text")))
    return rows.select("book_id", "ord", F.posexplode_outer(F.when(F.size("tokens") == 0, none).otherwise(all_)).alias("phrase", "_x")).select("book_id", "ord", "phrase", "_x.n_tokens", "_x.phrase_text")


def fragment_words(fragments: DataFrame, language: Column | str = "language") -> DataFrame:
    """Adds words: array<struct<phrase, norm>> of the words that survive normalisation, in order."""
    rows = with_phrases(fragments, language)
    ends = lambda i: F.coalesce(F.get(F.col("starts"), i + 1), F.size("tokens"))
    phrase = F.flatten(F.transform("starts", lambda s, i: F.array_repeat(i, ends(i) - s)))
    every = F.zip_with("folded", phrase, lambda f, p: F.struct(p.alias("phrase"), normalize(f).alias("norm")))
    return rows.withColumn("words", F.filter(every, lambda w: w["norm"] != "")).drop("tokens", "folded", "starts")


def words(fragments: DataFrame, language: Column | str = "language", keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """book_id, g, ord, phrase, norm: all words of a book, numbered from 0 in document order, and the columns named in keep.

    The numbering adds up the counts of earlier paragraphs, so words are only exploded afterwards. Its window needs a book's
    paragraphs in one partition: fragments of books that were dealt by book_id before they were cut need no shuffle here.
    outer: a paragraph without words has one row, with null g, phrase and norm.
    """
    counted = fragment_words(fragments, language).select("book_id", "ord", "words", *keep)
    before = Window.partitionBy("book_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    based = counted.withColumn("_g", F.coalesce(F.sum(F.size("words")).over(before), F.lit(0)).cast("long"))
    # Outer, as the filter on size that a plain explode implies would be pushed down through every step above.
    rows = based.select("book_id", "ord", *keep, "_g", F.posexplode_outer("words").alias("_k", "_w"))
    rows = rows if outer else rows.where("_w is not null")
    return rows.select("book_id", (F.col("_g") + F.col("_k")).alias("g"), "ord", F.col("_w")["phrase"].alias("phrase"), F.col("_w")["norm"].alias("norm"), *keep)
