"""A row of measures per book, from its fragments and the phrases and words placed.

Everything is grouped or windowed by book, so that rows of books that were dealt by book_id once are never shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import plausibility, rounded_all, upper_median
from ..functions.text import _c

MAX_DISCOUNT = 300.0
INVERSION = 1.0
# Ids of the parts a narrator may leave unread.
APPARATUS = (
    "endnote", "endnotes", "footnote", "footnotes", "appendix", "appendices", "glossary", "notes", "note", "translator-note", "translators-note", "translators-preface",
    "translator-preface", "prefatory-note", "editors-note", "editor-note", "preface", "introduction", "foreword", "afterword", "dedication", "epigraph", "dramatis-personae",
    "bibliography", "index", "advertisement", "colophon", "loi", "halftitle", "halftitlepage", "titlepage", "imprint", "copyright",
)
APPARATUS_ID = f"^({'|'.join(APPARATUS)})(-|$)"


def is_real(text: Column | str) -> Column:
    """Whether a paragraph counts: two words or more."""
    return F.size(F.filter(F.split(_c(text), "\\s+"), lambda t: t != "")) >= 2


def paragraphs(phrases: DataFrame, keep: tuple[str, ...] = ("real",)) -> DataFrame:
    """book_id, ord, anchor_id, placed, begin_secs, end_secs, section, confs, turned, n_words, and the columns named in keep.

    phrases: book_id, ord, anchor_id, real, phrase_index, begin_secs, end_secs, section, confidence, n_words; a paragraph without a phrase
    has one row with nulls. The section is that of the paragraph's earliest phrase. turned: phrases that begin more than INVERSION before
    the phrase before them in document order.
    """
    before = Window.partitionBy("book_id").orderBy("ord", "phrase_index").rowsBetween(Window.unboundedPreceding, -1)
    late = F.col("begin_secs") < F.last("begin_secs", ignorenulls=True).over(before) - INVERSION
    return phrases.withColumn("_late", late).groupBy("book_id", "ord", "anchor_id", *keep).agg(
        (F.count("begin_secs") > 0).alias("placed"),
        F.min("begin_secs").alias("begin_secs"),
        F.max("end_secs").alias("end_secs"),
        F.min_by("section", F.when(F.col("begin_secs").isNotNull(), F.struct("begin_secs", "phrase_index"))).alias("section"),
        F.collect_list("confidence").alias("confs"),
        F.count_if("_late").alias("turned"),
        F.sum("n_words").alias("n_words"),
    )


def marked(paras: DataFrame) -> DataFrame:
    """Real paragraphs with idx (from 0), body, and body_idx where they are body.

    Body is what isn't apparatus by its id. Where that is less than half of a book's paragraphs, all of them are body.
    """
    book, order = Window.partitionBy("book_id"), Window.partitionBy("book_id").orderBy("ord")
    rows = paras.where("real").withColumn("_a", F.col("anchor_id").rlike(APPARATUS_ID)).withColumn("idx", F.row_number().over(order) - 1)
    rows = rows.withColumn("body", ~F.col("_a") | (F.sum(F.when(~F.col("_a"), 1).otherwise(0)).over(book) * 2 < F.count("*").over(book)))
    return rows.withColumn("body_idx", F.when(F.col("body"), F.sum(F.col("body").cast("int")).over(order) - 1)).drop("_a")


def _covered() -> list[Column]:
    at = lambda f, c, when: f(F.when(when, F.col(c)))
    both = F.col("placed") & F.col("body")
    return [
        F.count("*").alias("paras"),
        F.count_if("placed").alias("placed"),
        at(F.min, "idx", F.col("placed")).alias("first_idx"),
        at(F.max, "idx", F.col("placed")).alias("last_idx"),
        F.count_if("body").alias("body_paras"),
        at(F.min, "body_idx", both).alias("first_body"),
        at(F.max, "body_idx", both).alias("last_body"),
    ]


def coverage(rows: DataFrame) -> DataFrame:
    """book_id, paras, placed, first_idx, last_idx, body_paras, first_body, last_body of marked paragraphs."""
    return rows.groupBy("book_id").agg(*_covered())


def inversions(rows: DataFrame, begin: str = "begin_secs", least: float = INVERSION) -> DataFrame:
    """book_id, inversions: neighbouring phrases in document order that begin more than `least` earlier than the one before."""
    order = Window.partitionBy("book_id").orderBy("ord", "phrase_index")
    return rows.withColumn("_before", F.lag(begin).over(order)).groupBy("book_id").agg(F.count_if(F.col(begin) < F.col("_before") - least).alias("inversions"))


def confidence(rows: DataFrame, value: str = "confidence") -> DataFrame:
    """book_id, phrases, median_conf: the upper median over phrases. A book's phrases are thousands at most."""
    return rows.groupBy("book_id").agg(F.count("*").alias("phrases"), upper_median(F.collect_list(value)).alias("median_conf"))


def _ends() -> list[Column]:
    first = F.min_by(F.struct("begin_secs", "section"), F.when(F.col("placed"), F.col("ord")))
    last = F.max_by("end_secs", F.when(F.col("placed"), F.col("ord")))
    return [first.alias("_first"), last.alias("_last")]


def _told(joined: DataFrame) -> DataFrame:
    """Adds lead_s and tail_s to books with _first, _last, audio_s and starts, an array of (section, start)."""
    start = F.coalesce(F.get(F.filter("starts", lambda s: s["section"] == F.col("_first.section")), F.lit(0))["start"], F.lit(0.0))
    skipped = F.when(start > MAX_DISCOUNT, 0.0).otherwise(start)
    lead = F.when(F.col("_first.begin_secs").isNull(), F.col("audio_s")).otherwise(F.greatest(F.lit(0.0), F.col("_first.begin_secs") - skipped))
    tail = F.when(F.col("_last").isNull(), F.col("audio_s")).otherwise(F.greatest(F.lit(0.0), F.col("audio_s") - F.col("_last")))
    return joined.withColumns({"lead_s": lead, "tail_s": tail}).drop("_first", "_last", "starts")


def _recorded(starts: DataFrame | None) -> list[Column]:
    return [] if starts is not None else [F.first("audio_s").alias("audio_s"), F.first("starts").alias("starts")]


def ends(paras: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """book_id, lead_s, tail_s, audio_s, from all paragraphs.

    starts: a row per book with audio_s and starts, an array of (section, start); None where the paragraphs bear these columns.

    The lead is measured from the start of the section of the first placed paragraph's earliest phrase, unless what
    lies before it is longer than MAX_DISCOUNT; the tail from the last word's end of the last placed paragraph.
    """
    grouped = paras.groupBy("book_id").agg(*_ends(), *_recorded(starts))
    return _told(grouped if starts is None else starts.join(grouped, "book_id", "left")).select("book_id", "lead_s", "tail_s", "audio_s")


def measures(rows: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """The metrics row a verdict reads, rounded as promised, from marked paragraphs in one grouping by book. starts: as for ends().

    Books without a placed paragraph get null gaps, a lead and a tail as long as the recording, and no confidence.
    """
    confs = F.flatten(F.collect_list("confs"))
    grouped = rows.groupBy("book_id").agg(*_covered(), *_ends(), F.size(confs).alias("phrases"), upper_median(confs).alias("median_conf"), F.sum("turned").alias("inversions"), *_recorded(starts))
    joined = _told(grouped if starts is None else grouped.join(starts, "book_id"))
    span = F.coalesce(F.try_divide(F.col("placed").cast("double"), F.col("last_idx") - F.col("first_idx") + 1), F.lit(0.0))
    start = F.try_divide(F.col("first_body").cast("double"), F.col("body_paras"))
    end = F.try_divide((F.col("body_paras") - 1 - F.col("last_body")).cast("double"), F.col("body_paras"))
    numbers = rounded_all(start=(start, 3), end=(end, 3), span=(span, 3), lead=(F.col("lead_s"), 1), tail=(F.col("tail_s"), 1), audio=(F.col("audio_s"), 0))
    return joined.withColumn("_n", numbers).select(
        "book_id",
        F.col("paras").cast("int").alias("paras"),
        F.col("placed").cast("int").alias("placed"),
        F.col("_n.start").alias("start_gap"),
        F.col("_n.end").alias("end_gap"),
        F.lit(True).alias("has_ends"),
        F.col("_n.span").alias("span_coverage"),
        F.coalesce("_n.lead", F.lit(0.0)).alias("lead_s"),
        F.coalesce("_n.tail", F.lit(0.0)).alias("tail_s"),
        F.col("phrases").cast("int").alias("phrases"),
        F.coalesce("median_conf", F.lit(0.0)).alias("median_conf"),
        F.col("inversions").cast("int").alias("inversions"),
        F.col("_n.audio").cast("int").alias("audio_s"),
    )


def lock_score(pairs: DataFrame, key: list[str], score: str = "score", begin: str = "begin_secs", order: str = "g", per: int = 1) -> DataFrame:
    """Mean word score times how speech-like the upper-median gap between begins is; 0.3 s where there is one word.

    Scores and begins may be whole numbers of 1 / per: they add up exactly then, in whatever order rows arrive.
    """
    gap = (F.lead(begin).over(Window.partitionBy(*key).orderBy(order)) - F.col(begin)) / per
    rows = pairs.withColumn("_gap", gap).groupBy(*key).agg((F.avg(score) / per).alias("_mean"), F.array_compact(F.collect_list("_gap")).alias("_gaps"))
    median = F.when(F.size("_gaps") == 0, 0.3).otherwise(upper_median(F.col("_gaps")))
    return rows.select(*key, (F.col("_mean") * plausibility(median)).alias("lock_score"))
