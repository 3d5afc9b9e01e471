"""The query catalogue over the driver's tables.

The tables hold no sound, so times come from integer formulas that every engine computes alike: a document is a
book whose lines are its paragraphs; word g begins at 30 g + (7 g mod 13) centiseconds and lasts 20; a paragraph is
placed unless (7 doc_id + 13 ord) mod 10 is 0; a conversation is a recording, its turns are files of 10 centiseconds a
character, read by their role, and belongs to the document of the same number.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import numbers as N
from ..functions import text as X
from ..operators import align, anchoring, document, gate, metrics, overlay, reshape, timeline, words

LINE = "\\n"
BEGIN = "g * 30 + pmod(g * 7, 13)"
PLACED = "pmod(book_id * 7 + ord * 13, 10) > 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents, dealt by id: the only shuffle of texts. What is cut from them and grouped by book stays where it is."""
    return table(spark, d, "documents").repartition("doc_id")


def _books(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select(F.col("doc_id").alias("book_id"), "text", X.language_of("lang").alias("language"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = _books(spark, d).select("book_id", "language", F.posexplode(anchoring.blocks("text", LINE)).alias("_p", "text"))
    return rows.select("book_id", (F.col("_p") + 1).alias("ord"), F.concat(F.lit("text-p"), F.col("_p") + 1).alias("anchor_id"), "text", "language")


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).where(F.size(F.split("text", " ")) >= 2)


def _spoken(fragments: DataFrame) -> DataFrame:
    """book_id, g, ord, phrase, norm, anchor_id, real, bf, ef (centiseconds), score (hundredths); a row without times for paragraphs not placed."""
    rows = words.words(fragments.withColumn("real", metrics.is_real("text")), keep=("anchor_id", "real"), outer=True)
    when = lambda x: F.when(F.expr(f"g is not null and {PLACED}"), F.expr(x))
    return rows.withColumns({"bf": when(BEGIN), "ef": when(f"{BEGIN} + 20"), "score": when("pmod(book_id * 31 + g * 17, 100)")})


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    return _spoken(_fragments(spark, d)).where("bf is not null")


def _phrases(spoken: DataFrame) -> DataFrame:
    """Phrase rows in centiseconds, with confidence in hundredths rounded down, and paragraphs without one."""
    return reshape.phrase_rows(spoken, keep=("real",)).withColumn("conf", F.floor("conf")).withColumnsRenamed({"bf": "begin_cs", "ef": "end_cs"})


def _phrase_rows(spark: SparkSession, d: str) -> DataFrame:
    return _phrases(_aligned(spark, d)).select("book_id", "ord", "anchor_id", "phrase_index", "begin_cs", "conf")


def _paragraphs(fragments: DataFrame) -> DataFrame:
    """All paragraphs of books with words, with what is placed of them, in seconds.

    Recordings are as long as their document's words, in files of 1000 s.
    """
    timed = _phrases(_spoken(fragments)).withColumns({"begin_secs": F.col("begin_cs") / 100, "end_secs": F.col("end_cs") / 100, "section": (F.floor(F.col("begin_cs") / 100_000) + 1).cast("int"), "confidence": (F.col("conf") + 40) / 100})
    paras = metrics.paragraphs(timed).withColumn("_n", F.sum("n_words").over(Window.partitionBy("book_id"))).where("_n > 0")
    files = F.sequence(F.lit(0), F.floor(F.col("audio_s") / 1000).cast("int"))
    long = paras.withColumn("audio_s", (F.col("_n") - 1) * 30 / 100 + 60)
    return long.withColumn("starts", F.transform(files, lambda k: F.struct((k + 1).alias("section"), (k * 1000).cast("double").alias("start")))).drop("_n")


def _sections(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations")
    return turns.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("section_number"), F.col("turn").alias("feed_pos"), F.col("role").alias("reader"), (F.length("text").cast("long") * 10).alias("secs_cs"))


def _timeline(spark: SparkSession, d: str) -> DataFrame:
    return timeline.section_starts(timeline.renumber(_sections(spark, d)), "secs_cs")


def paragraphs_txt(spark, d):
    return _fragments(spark, d).select("book_id", "ord", "anchor_id", X.escape_text("text").alias("html"))


def anchored_fragments(spark, d):
    """Texts as anchored sections, read back as fragments."""
    bodies = _books(spark, d).select("book_id", anchoring.anchored_txt("text", LINE).alias("html"))
    return anchoring.fragments_html(bodies)


def paragraphs_html(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", F.posexplode(H.paragraph_texts("html")).alias("pos", "text"))


def anchored_html(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("book_id"), H.anchored_udf("html").alias("html"))
    return anchoring.fragments_html(pages)


def html_blocks(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("book_id"), F.posexplode(H.blocks_udf("html")).alias("block", "_b"))
    return anchoring.keep_blocks(pages.select("book_id", "block", "_b.html", "_b.text"))


def named_entities(spark, d):
    found = F.regexp_extract_all("html", F.lit("<p[^>]*>([^<]*)</p>"), 1)
    return table(spark, d, "pages").select("page_id", F.posexplode(found).alias("pos", "raw")).select("page_id", "pos", X.clean_paragraph("raw").alias("text"))


def headings(spark, d):
    block = F.regexp_extract("html", "(?i)(<h1[^>]*>[\\s\\S]*?</h1>)", 1)
    return table(spark, d, "pages").select("page_id", X.heading_text(block).alias("heading"), X.slugify(X.heading_text(block)).alias("slug"))


def slugs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.slugify(F.substring_index("text", "\n", 1)).alias("slug"))


def hrefs_same_page(spark, d):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return table(spark, d, "pages").select("page_id", F.posexplode(links).alias("pos", "href")).select("page_id", "pos", X.same_page_href("href").alias("href"))


def listen_urls(spark, d):
    return table(spark, d, "pages").select("page_id", X.normalize_listen_url("url").alias("url"))


def languages(spark, d):
    return table(spark, d, "documents").select("doc_id", X.language_of(F.concat(F.upper("lang"), F.lit("-XX"))).alias("language"), X.language_of(F.lit("")).alias("default_language"))


def folded(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fold_whole("text").alias("text"))


def words_normalized(spark, d):
    return words.words(_fragments(spark, d))


def phrase_cut(spark, d):
    return words.phrases(_fragments(spark, d))


def phrase_counts(spark, d):
    """Phrases per document: the flagship."""
    return phrase_cut(spark, d).groupBy("book_id").agg(F.count("*").alias("phrases"), F.sum("n_tokens").alias("tokens"))


def phrase_rows(spark, d):
    return _phrase_rows(spark, d)


def flat_rows(spark, d):
    """Phrase rows to the document's map and back."""
    listed = _phrase_rows(spark, d).select("book_id", "anchor_id", "phrase_index", (F.col("begin_cs") / 100).alias("begin_secs"), (F.col("conf") / 100).alias("confidence"), F.lit(1).alias("section"))
    return reshape.rows(reshape.phrase_map(listed))


def word_archive(spark, d):
    archive = reshape.word_archive(_aligned(spark, d))
    return archive.select("book_id", "anchor_id", F.size("words").alias("n_words"), F.array_join(F.transform("words", lambda w: F.concat_ws(":", w["bf"], w["norm"], w["score"])), " ").alias("words"))


def upper_median(spark, d):
    events = table(spark, d, "events")
    return N.upper_medians(events, "user_id", "value")


def _marked(spark, d):
    return metrics.marked(_paragraphs(_fragments(spark, d)))


def span_coverage(spark, d):
    return metrics.coverage(_marked(spark, d))


def apparatus(spark, d):
    """Ends measured without apparatus: every fifth paragraph of every third book counts as notes, and all but each sixth of every seventh."""
    notes = F.expr("(book_id % 3 = 0 and ord % 5 = 0) or (book_id % 7 = 0 and ord % 6 > 0)")
    frags = _fragments(spark, d).withColumn("anchor_id", F.when(notes, F.concat(F.lit("endnotes-p"), "ord")).otherwise(F.col("anchor_id")))
    return metrics.coverage(metrics.marked(_paragraphs(frags)))


def inversions(spark, d):
    events = table(spark, d, "events").select(F.col("user_id").alias("book_id"), F.col("event_id").alias("ord"), F.lit(0).alias("phrase_index"), F.col("value").alias("begin_secs"))
    return metrics.inversions(events)


def confidence(spark, d):
    return metrics.confidence(_phrase_rows(spark, d), "conf")


def lead_tail(spark, d):
    return metrics.ends(_paragraphs(_fragments(spark, d)))


def _measures(spark, d):
    return metrics.measures(_marked(spark, d))


def measures(spark, d):
    return _measures(spark, d)


def verdict(spark, d):
    return gate.verdicts(_measures(spark, d)).select("book_id", "pass", "doc_coverage")


def refusal(spark, d):
    return gate.verdicts(_measures(spark, d)).select("book_id", "refusal")


def section_timeline(spark, d):
    return _timeline(spark, d).select("book_id", "position", "reader", "secs_cs", "start")


def _begins(spark, d):
    return overlay.begins(_phrase_rows(spark, d), "begin_cs")


def asof_section(spark, d):
    return timeline.section_at(_begins(spark, d), _timeline(spark, d), "whole_begin").select("book_id", "anchor_id", "whole_begin", "section", "section_start")


def asof_events(spark, d):
    """The large-side form: every event of a user with the value of the user's last earlier one; days are buckets."""
    events = table(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "value")
    left, right = events.select("event_id", "user_id", "at", (F.col("at") - 1).alias("upto")), events.select("user_id", F.col("at").alias("seen_at"), F.col("value").alias("seen"))
    return timeline.as_of(left, right, "user_id", "upto", "seen_at", "seen", bucket=86_400_000_000).drop("upto")


def frame_section_range(spark, d):
    started = _timeline(spark, d)
    bounds = started.select("book_id", "position", F.col("start").alias("lo"), (F.col("start") + F.col("secs_cs")).alias("hi"))
    return timeline.frame_section(_begins(spark, d), bounds, "whole_begin").select("book_id", "anchor_id", "whole_begin", "section")


def _pars(spark, d):
    present = _fragments(spark, d).where("pmod(book_id + ord, 11) > 0").select("book_id", "anchor_id").distinct()
    return overlay.pars(_phrase_rows(spark, d), _timeline(spark, d), present, "begin_cs")


def overlay_pars(spark, d):
    return _pars(spark, d)


def overlay_summary(spark, d):
    rows = _phrase_rows(spark, d).join(_sections(spark, d).select("book_id").distinct(), "book_id", "left_semi")
    named = _timeline(spark, d).select("book_id", "position", "reader", "secs_cs")
    return overlay.summary(rows, _pars(spark, d), named, "secs_cs").withColumn("readers", F.array_join("readers", ","))


def overlay_smil(spark, d):
    return overlay.smil(_pars(spark, d).withColumns({"begin": F.col("begin") / 100, "clip_end": F.col("clip_end") / 100}))


def overlay_package(spark, d):
    """The four texts of a package per document that has a recording, at a fixed time."""
    lines = _books(spark, d).select("book_id", "language", anchoring.anchored_txt("text", LINE).alias("body"), F.substring_index("text", "\n", 1).alias("title"))
    used = overlay.used_sections(_timeline(spark, d).select("book_id", "position", "reader", (F.col("secs_cs") / 100).alias("secs")), _pars(spark, d))
    named = lines.join(overlay.readers(used), "book_id").select("*", F.lit(None).cast("string").alias("author"), F.lit("documents").alias("kind"), F.col("book_id").cast("string").alias("id"), F.lit("https://example.org/?a&b").alias("url"), F.lit("").alias("audio_url"))
    packed = overlay.opf(named, used, "2024-01-01T00:00:00Z")
    return packed.join(named, "book_id").select("book_id", "opf", overlay.xhtml("body", "title", "language").alias("xhtml"), overlay.nav("body", "title", "language").alias("nav"))


def clock_text(spark, d):
    return _begins(spark, d).select("book_id", "anchor_id", N.clock(F.col("whole_begin") / 100).alias("clock"), N.hours_minutes(F.floor(F.col("whole_begin") / 10)).alias("length"))


def text_fingerprint(spark, d):
    return table(spark, d, "documents").select("doc_id", X.sha256("text").alias("sha256"), X.fingerprint("1.0", "text").alias("fingerprint"))


def minted_ids(spark, d):
    """All lines of a document as section titles, ids told apart."""
    lines = _books(spark, d).select("book_id", F.transform(anchoring.blocks("text", LINE), lambda b, i: anchoring.base_slug(b, i + 1)).alias("_b"))
    return lines.select("book_id", F.posexplode(anchoring.mint_ids("_b")).alias("pos", "id"))


def sectioning(spark, d):
    """Lines of three words or fewer are headings."""
    rows = _books(spark, d).select("book_id", F.posexplode(anchoring.blocks("text", LINE)).alias("block", "html"))
    short = F.size(F.split("html", " ")) <= 3
    return anchoring.sections(rows, short, F.col("html")).groupBy("book_id", "section", "section_title").agg(F.count("*").alias("blocks"), F.min("block").alias("first_block"))


def section_anchors(spark, d):
    """Section and paragraph ids of the same cut."""
    rows = _books(spark, d).select("book_id", F.posexplode(anchoring.blocks("text", LINE)).alias("block", "html"))
    cut = anchoring.sections(rows, F.size(F.split("html", " ")) <= 3, F.col("html"))
    paragraphs = cut.where(F.size(F.split("html", " ")) > 3).withColumn("id", F.lit(None).cast("string"))
    return anchoring.paragraph_ids(paragraphs, anchoring.section_ids(cut)).select("book_id", "section", "block", "anchor_id")


def lock_scores(spark, d):
    """Chunks of 45 words as locks."""
    rows = _aligned(spark, d).select("book_id", F.floor(F.col("g") / 45).alias("chunk"), "g", F.col("bf").alias("begin_secs"), "score")
    return metrics.lock_score(rows, ["book_id", "chunk"], per=100).select("book_id", "chunk", F.floor(F.col("lock_score") * 1e6 + 0.5).cast("long").alias("lock_micro"))


def chunk_sizes(spark, d):
    return words.words(_fragments(spark, d)).groupBy("book_id").agg(F.count("*").alias("n_words")).withColumn("chunk", N.chunk_words("n_words"))


def semi_anti_anchors(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id")
    semi, anti = docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti")
    return semi.withColumn("side", F.lit("labelled")).union(anti.withColumn("side", F.lit("bare")))


def _roundtrip(spark, d):
    docs = _parsed(spark, d)
    return document.parsed(docs.select("doc_id", document.serialized(docs).alias("value")))


def doc_roundtrip(spark, d):
    """Whole texts as titles to JSON and back; the first 40 characters of what comes back are shown."""
    return _roundtrip(spark, d).select("doc_id", "format", "generator", F.substring("book.title", 1, 40).alias("title"), "book.author", "book.language", F.col("alignment").isNull().alias("unaligned"))


def _parsed(spark, d):
    docs = table(spark, d, "documents")
    title = F.regexp_extract(F.to_json(F.array("text")), "^\\[([\\s\\S]*)\\]$", 1)
    raw = F.concat(F.lit(f'{{"format":"{document.FORMAT}","book":{{"title":'), title, F.lit(',"author":null,"language":"'), "lang", F.lit('"}}'))
    return document.parsed(docs.select("doc_id", raw.alias("value")))


EMISSION_BLOCK = 500
#: Planted sound: a frame of each letter and a blank after it, SPACED blanks after a word, QUIET at both ends, RATIO seconds a frame.
#: Phrases of more than MOST_SAID words are aligned in parts, as the steps of a window take frames times letters.
SPACED, QUIET, RATIO = 2, 200, 0.03
MOST_SAID = 45
MARK = f"{QUIET} + 2 * _letters + {SPACED} * g"


def _said(words_of):
    """Planted sound of some words: no noise, and a little less sure from frame to frame, so that of equal places the first is best."""
    return align.synthetic_emission(words_of, align.backend("letters"), frames_per_letter=2, gap=SPACED, noise=0, lead=QUIET, trail=QUIET, peaks=(10, 8))


def _talks(spark, d):
    """Conversations as books, turns as paragraphs: their words, with the first and end frame of each as planted."""
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("ord"), F.coalesce("text", F.lit("")).alias("text"), F.lit("en").alias("language"))
    rows = words.words(turns)
    before = Window.partitionBy("book_id").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    letters = F.coalesce(F.sum(F.length("norm")).over(before), F.lit(0))
    return rows.withColumn("_letters", letters).select("book_id", "g", "ord", "norm", F.expr(MARK).alias("bf"), F.expr(f"{MARK} + 2 * length(norm) - 1").alias("ef"))


def _recorded(spark, d):
    """Whole conversations with planted emissions, a section for each turn: (words, emission, books)."""
    every = _talks(spark, d)

    def planted(key, pdf):
        logits, _ = _said(list(pdf.sort_values("g")["norm"]))
        return pd.DataFrame(list(align.emission_blocks(key[0], logits, EMISSION_BLOCK)), columns=["book_id", "block", "logits"])

    emission = every.select("book_id", "g", "norm").groupBy("book_id").applyInPandas(planted, "book_id long, block long, logits binary")
    turns = every.groupBy("book_id", "ord").agg(F.min("bf").alias("bf"), F.max("ef").alias("ef"))
    books = turns.groupBy("book_id").agg(F.array_sort(F.collect_list("bf")).alias("_b"), (F.max("ef") + 1 + SPACED + QUIET).alias("_n"))
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.slice("_b", F.lit(2), F.size("_b")), F.array("_n"))
    return every, emission, books.select("book_id", F.lit(RATIO).alias("ratio"), bounds.alias("bounds"))


def ctc_align(spark, d):
    """Each paragraph of all documents aligned, by phrases and parts of long ones, with planted sound of its own: (first word, end) frames of its words."""
    rows = words.fragment_words(_fragments(spark, d)).select("book_id", "ord", F.transform("words", lambda w: w["norm"]).alias("said"), F.transform("words", lambda w: w["phrase"]).alias("phrase"))

    def cut(pdf):
        for book, ord_, said, phrase in zip(pdf["book_id"], pdf["ord"], pdf["said"], pdf["phrase"], strict=True):
            if len(said):
                logits, marks = _said(list(said))
                cuts = [k for k in range(len(said)) if not k or phrase[k] != phrase[k - 1]]
                cuts = [k for low, high in zip(cuts, [*cuts[1:], len(said)], strict=True) for k in range(low, high, MOST_SAID)] + [len(said)]
                windows = [(marks[low][0], min(len(logits), marks[high - 1][1] + QUIET // 4), list(said[low:high])) for low, high in zip(cuts, cuts[1:], strict=False)]
                yield (book, ord_, cuts, windows), logits, windows

    def run(frames):
        model = align.backend("letters")
        for pdf in frames:
            out = []
            for (book, ord_, cuts, windows), found in align.align_recordings(cut(pdf), model):
                for low, (start, _, _), placed in zip(cuts, windows, found, strict=False):
                    out += [(book, ord_, p.g, p.begin, p.end) for p in align.shifted(placed, start, low)]
            yield pd.DataFrame(out, columns=["book_id", "ord", "k", "bf", "ef"])

    # Dealt by a number of its own: Spark joins partitions by their bytes, and a few MB of words are minutes of work.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(parts, "book_id", "ord").mapInPandas(run, "book_id long, ord int, k long, bf long, ef long")


def chain_align(spark, d):
    """Anchors of whole conversations."""
    every, emission, books = _recorded(spark, d)
    return align.anchors(every, emission, books)


def bracket_align(spark, d):
    """All words of whole conversations, aligned between anchors that are planted at each chunk's first word and at the last word."""
    every, emission, books = _recorded(spark, d)
    about = align.sized(every, books)
    marks = every.join(about.hint("merge"), "book_id").where("g % chunk = 0 or g = n_words - 1").select("book_id", "g", "bf")
    seq = (F.row_number().over(Window.partitionBy("book_id").orderBy("g")) - 1).alias("seq")
    found = marks.select("book_id", seq, F.col("g").alias("w0"), F.col("bf").alias("f0"))
    return align.fine_align(align.brackets(found, about), every, emission, EMISSION_BLOCK).select("book_id", "g", "bf", "ef")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        paragraphs_txt, anchored_fragments, paragraphs_html, anchored_html, html_blocks, named_entities, headings, slugs, hrefs_same_page, listen_urls, languages, folded,
        words_normalized, phrase_cut, phrase_counts, phrase_rows, flat_rows, word_archive, upper_median, span_coverage, apparatus, inversions, confidence, lead_tail, measures,
        verdict, refusal, section_timeline, asof_section, asof_events, frame_section_range, overlay_pars, overlay_summary, overlay_smil, overlay_package, clock_text, text_fingerprint, minted_ids,
        sectioning, section_anchors, lock_scores, chunk_sizes, semi_anti_anchors, doc_roundtrip, ctc_align, chain_align, bracket_align,
    )
}
