"""Aligned words to phrase rows and word archives, and back from the document's maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded_all


def named_words(aligned: DataFrame, words: DataFrame, fragments: DataFrame) -> DataFrame:
    """Aligned words with their word, phrase and anchor: joins on (book, word number) and (book, paragraph)."""
    return aligned.join(words, ["book_id", "g"]).join(fragments.select("book_id", "ord", "anchor_id"), ["book_id", "ord"])


def phrase_rows(named: DataFrame, score: str = "score", keep: tuple[str, ...] = ()) -> DataFrame:
    """book_id, ord, anchor_id, phrase_index, bf, ef, conf, n_words, and the columns named in keep, which a paragraph's rows share.

    Begin is the first word's in word order, not the smallest. A paragraph whose rows have a null bf keeps one row without a phrase.
    """
    phrase = F.when(F.col("bf").isNotNull(), F.col("phrase")).alias("phrase_index")
    return named.groupBy("book_id", "ord", "anchor_id", *keep, phrase).agg(F.min_by("bf", "g").alias("bf"), F.max("ef").alias("ef"), F.avg(score).alias("conf"), F.count("g").alias("n_words"))


def word_archive(named: DataFrame) -> DataFrame:
    """book_id, anchor_id, words: all aligned words of an anchor in order."""
    ordered = F.array_sort(F.collect_list(F.struct("g", "bf", "norm", "score")))
    return named.groupBy("book_id", "anchor_id").agg(ordered.alias("words"))


def in_seconds(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """Phrase rows with begin_secs (two places) and confidence (three), rounded as the document promises."""
    timed = rows.join(ratios, "book_id")
    numbers = rounded_all(begin=(F.col("bf") * F.col("ratio"), 2), conf=(F.col("conf"), 3))
    return timed.withColumn("_n", numbers).withColumns({"begin_secs": F.col("_n.begin"), "confidence": F.col("_n.conf"), "end_secs": F.col("ef") * F.col("ratio")}).drop("_n")


def word_map(timed: DataFrame) -> DataFrame:
    """book_id, words: map of anchor to its words in order. timed: anchor_id, g, norm, bf, score, ratio."""
    numbers = rounded_all(begin=(F.col("bf") * F.col("ratio"), 2), conf=(F.col("score"), 3))
    rows = timed.withColumn("_n", numbers)
    ordered = F.array_sort(F.collect_list(F.struct("g", F.col("_n.begin").alias("begin_secs"), F.col("norm").alias("word"), F.col("_n.conf").alias("confidence"))))
    per = rows.groupBy("book_id", "anchor_id").agg(ordered.alias("list"))
    return per.groupBy("book_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("anchor_id", "list")))).alias("words"))


def phrase_map(rows: DataFrame) -> DataFrame:
    """book_id, phrases: map of anchor to its rows. Rows of a repeated anchor are gathered under one key."""
    per = rows.groupBy("book_id", "anchor_id").agg(F.array_sort(F.collect_list(F.struct("phrase_index", "begin_secs", "confidence", "section"))).alias("list"))
    return per.groupBy("book_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("anchor_id", "list")))).alias("phrases"))


def rows(maps: DataFrame, column: str = "phrases") -> DataFrame:
    """anchor_id, phrase_index, begin_secs, confidence, section: a map of arrays as flat rows. Empty maps give none."""
    per = maps.select(*[c for c in maps.columns if c != column], F.explode(column).alias("anchor_id", "_list"))
    kept = [c for c in per.columns if c != "_list"]
    item = per.select(*kept, F.explode("_list").alias("_x"))
    if dict(item.dtypes)["_x"].startswith("array"):
        part = lambda i, kind: F.get("_x", F.lit(i)).cast(kind)
        return item.select(*kept, part(0, "int").alias("phrase_index"), part(1, "double").alias("begin_secs"), part(2, "double").alias("confidence"), part(3, "int").alias("section"))
    return item.select(*kept, "_x.*")
