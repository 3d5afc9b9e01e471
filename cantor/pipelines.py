"""Whole stages over many books: texts to anchored bodies, emissions to judged alignments, documents to packages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import html as H
from .functions import text as X
from .operators import align, anchoring, document, gate, metrics, overlay, reshape, timeline, words
from .schema import ALIGNMENT, AUDIO, BOOK, META, TEXT, VERDICT
from .sources import emission, epub, recording

BLOCK_FRAMES = 2000


def anchored_source(spark: SparkSession, path: str) -> DataFrame:
    """book_id (the path), title, author, language, body: zipped books (*.epub) or whole text files, by the path's ending.

    A plain file says nothing of itself, so its title, author and language are null.
    """
    if path.lower().endswith(".epub"):
        files = epub.scan(spark, path)
        return epub.identities(files).withColumnRenamed("path", "book_id").join(epub.anchored(files), "book_id")
    rows = recording.text_sources(spark, path)
    body = F.when(F.col("kind") == "txt", anchoring.anchored_txt("text")).otherwise(H.anchored_udf("text"))
    none = F.lit(None).cast("string")
    return rows.select(F.col("path").alias("book_id"), none.alias("title"), none.alias("author"), none.alias("language"), body.alias("body"))


def prepared(sources: DataFrame, audio: DataFrame, title: str | None = None, author: str | None = None, language: str | None = None) -> DataFrame:
    """Documents with book, text and audio of local sources. audio: book_id, origin, sections. A source without a paragraph is an error.

    What the caller names wins over what a book says of itself; a file that says nothing is called by its name.
    """
    counted = anchoring.fragments_html(sources.select("book_id", F.col("body").alias("html"))).groupBy("book_id").agg(F.count("*").alias("_n"))
    # Paths of a scan are URIs.
    file = F.url_decode(F.replace(F.element_at(F.split("book_id", "/"), -1), F.lit("+"), F.lit("%2B")))
    told = lambda given, column: F.lit(given) if given else F.col(column)
    named = F.coalesce(told(title, "title"), F.regexp_replace(file, "(?i)\\.[a-z]+$", ""))
    book = F.struct(named.alias("title"), told(author, "author").alias("author"), F.coalesce(told(language, "language"), F.lit("en")).alias("language"), F.struct(F.lit("local").alias("kind"), file.alias("id"), F.lit("").alias("url")).alias("source"))
    none = F.raise_error(F.concat("book_id", F.lit(": no paragraphs found to anchor"))).cast("int")
    text = F.struct(F.lit("book.html").alias("file"), X.sha256("body").alias("sha256"), F.coalesce(F.col("_n").cast("int"), none).alias("paragraphs"))
    sound = F.struct(F.struct(F.lit("local").alias("kind"), F.col("origin").alias("id"), F.lit("").alias("url")).alias("source"), F.col("sections").alias("sections"))
    rows = sources.join(counted, "book_id", "left").join(audio, "book_id")
    return rows.select("book_id", "body", F.lit(document.FORMAT).alias("format"), book.cast(BOOK).alias("book"), text.cast(TEXT).alias("text"), sound.cast(AUDIO).alias("audio"), F.lit(None).cast(ALIGNMENT).alias("alignment"))


def with_anchored_text(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents whose text is sure: those without one get it from their source (anchored_source), and its identity where they have none."""
    counted = anchoring.fragments_html(sources.select("book_id", F.col("body").alias("html"))).groupBy("book_id").agg(F.count("*").alias("_n"))
    told = sources.join(counted, "book_id", "left").select("book_id", F.col("title").alias("_t"), F.col("author").alias("_a"), F.col("language").alias("_l"), "body", F.coalesce("_n", F.lit(0)).cast("int").alias("_n"))
    text = F.struct(F.lit("book.html").alias("file"), X.sha256("body").alias("sha256"), F.col("_n").alias("paragraphs")).cast(TEXT)
    own = F.struct(F.col("_t").alias("title"), F.col("_a").alias("author"), F.coalesce("_l", F.lit("en")).alias("language"), F.struct(F.lit("local").alias("kind"), F.lit("book.epub").alias("id"), F.lit("").alias("url")).alias("source")).cast(BOOK)
    missing = F.raise_error(F.concat("book_id", F.lit(": no text — run `fetch-text` or `prepare` first"))).cast(TEXT)
    rows = docs.join(told, "book_id", "left")
    return rows.withColumns({"text": F.when(F.col("text").isNotNull(), F.col("text")).when(F.col("body").isNull(), missing).otherwise(text), "book": F.coalesce("book", own)}).drop("_t", "_a", "_l", "_n")


def placed_words(bodies: DataFrame, chunks: DataFrame, model: str = "letters", block_frames: int = BLOCK_FRAMES) -> DataFrame:
    """All words of all paragraphs with bf, ef (frames) and score where they were found. bodies: book_id, language, body; chunks: emission rows."""
    frags = anchoring.fragments_html(bodies.select("book_id", F.col("body").alias("html"))).join(bodies.select("book_id", X.language_of("language").alias("language")), "book_id")
    every = words.words(frags.withColumn("real", metrics.is_real("text")), keep=("anchor_id", "real"), outer=True)
    spoken, width = every.where("g is not null"), len(align.backend(model).alphabet)
    found = align.locate(spoken, emission.blocks(chunks, block_frames, width), emission.books(chunks), block_frames, model)
    return every.join(found, ["book_id", "g"], "left")


def phrase_table(placed: DataFrame, books: DataFrame) -> DataFrame:
    """Phrase rows in seconds with their section; paragraphs without a phrase have one row with nulls. books: as emission.books() gives them."""
    position = lambda x, i: F.struct((i + 1).alias("position"), F.get("bounds", i).alias("lo"), F.get("bounds", i + 1).alias("hi"))
    bounds = books.select("book_id", F.inline(F.transform(F.slice("bounds", F.lit(1), F.size("bounds") - 1), position)))
    rows = timeline.frame_section(reshape.phrase_rows(placed, keep=("real",)), bounds, "bf")
    return reshape.in_seconds(rows, books.select("book_id", "ratio"))


def alignments(bodies: DataFrame, chunks: DataFrame, model: str = "letters", block_frames: int = BLOCK_FRAMES, at: Column | None = None) -> DataFrame:
    """book_id, alignment: times and verdict of each book, as the document holds them.

    bodies: book_id, language (as given), body. A book in which nothing was found is judged, and refused, like any other.
    """
    placed, books = placed_words(bodies, chunks, model, block_frames), emission.books(chunks)
    phrases = phrase_table(placed, books)
    start = lambda x, i: F.struct((i + 1).alias("section"), (x * F.col("ratio")).alias("start"))
    starts = books.select("book_id", (F.element_at("bounds", -1) * F.col("ratio")).alias("audio_s"), F.transform(F.slice("bounds", F.lit(1), F.size("bounds") - 1), start).alias("starts"))
    judged = gate.verdicts(metrics.measures(metrics.marked(metrics.paragraphs(phrases)), starts))
    language = X.language_of("language")
    meta = F.struct(*[F.col(c) for c in "paras placed start_gap end_gap span_coverage lead_s tail_s phrases median_conf inversions audio_s".split()], F.size("starts").alias("sections"), F.lit("cpu").alias("device"), F.lit(model).alias("model"), language.alias("language")).cast(META)
    verdict = F.struct("pass", F.col("doc_coverage").alias("docCoverage"), "refusal", "gates").cast(VERDICT)
    hits = reshape.phrase_map(phrases.where("phrase_index is not null").select("book_id", "anchor_id", "phrase_index", "begin_secs", "confidence", "section"))
    timed = placed.where("bf is not null").join(books.select("book_id", "ratio"), "book_id")
    spoken = reshape.word_map(timed)
    tuples = lambda c, item: F.transform_values(c, lambda k, rows: F.transform(rows, item))
    phrase_rows = tuples("phrases", lambda p: F.array(p["phrase_index"].cast("double"), p["begin_secs"], p["confidence"], p["section"].cast("double")))
    word_rows = tuples("words", lambda w: F.array(w["begin_secs"].cast("string"), w["word"], w["confidence"].cast("string")))
    empty = lambda kind: F.create_map().cast(f"map<string,array<array<{kind}>>>")
    when = at if at is not None else X.now_iso()
    joined = bodies.select("book_id", "language", "body").join(judged, "book_id").join(starts.select("book_id", "starts"), "book_id")
    joined = joined.join(hits.select("book_id", phrase_rows.alias("phrases_map")), "book_id", "left").join(spoken.select("book_id", word_rows.alias("words_map")), "book_id", "left")
    whole = F.struct(F.lit(model).alias("model"), F.col("language").alias("language"), when.alias("alignedAt"), X.sha256("body").alias("textSha256"), F.coalesce("phrases_map", empty("double")).alias("phrases"), F.coalesce("words_map", empty("string")).alias("words"), meta.alias("meta"), verdict.alias("verdict"))
    return joined.select("book_id", whole.alias("alignment"))


def exported(docs: DataFrame, force: bool = False, modified: Column | None = None) -> DataFrame:
    """book_id, opf, xhtml, nav, smil, used (files of sound), synced, skipped, of documents with their body. What can't be exported is an error.

    A document of which nothing is spoken has no smil. Joins keep every document: an inner join with an empty side would end before the error is raised.
    """
    problem = document.export_problem(F.col("body"), force)
    sure = docs.withColumn("body", F.when(problem.isNotNull(), F.raise_error(problem).cast("string")).otherwise(F.col("body")))
    base = sure.select("book_id", "body", F.col("book.title").alias("title"), F.col("book.author").alias("author"), F.col("book.language").alias("language"), F.col("book.source.kind").alias("kind"), F.col("book.source.id").alias("id"), F.col("book.source.url").alias("url"), F.col("audio.source.url").alias("audio_url"))
    sections = docs.select("book_id", F.inline("audio.sections"))
    rows = reshape.rows(docs.select("book_id", F.col("alignment.phrases").alias("phrases")))
    started = timeline.section_starts(sections.select("book_id", "position", "secs"))
    present = overlay.present_ids(base.select("book_id", X.xhtml_repair("body").alias("body")))
    pars = overlay.pars(rows, started, present)
    used = overlay.used_sections(sections, pars)
    told = overlay.summary(rows, pars, sections)
    files = used.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("position", "file"))).alias("used"))
    named = base.join(overlay.readers(used), "book_id", "left")
    texts = base.select("book_id", overlay.xhtml("body", "title", "language").alias("xhtml"), overlay.nav("body", "title", "language").alias("nav"))
    package = overlay.opf(named, used, modified if modified is not None else X.now_iso(seconds=True))
    for more in (texts, overlay.smil(pars), files, told.select("book_id", "synced", "skipped")):
        package = package.join(more, "book_id", "left")
    return package


def write_packages(packages: DataFrame, folder: str, sound: str) -> DataFrame:
    """book_id, file: a package per book under a shared folder; files of sound are read from another. A book is written by the task that has it; one without smil isn't written."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for row in f[f["smil"].notna()].itertuples(index=False):
                texts = {"content.opf": row.opf, overlay.BOOK: row.xhtml, overlay.CONTENTS: row.nav, overlay.OVERLAY: row.smil}
                audio = {f"sound/{u['position']:04d}.mp3": epub.load(f"{sound}/{u['file']}") for u in row.used}
                name = f"{folder}/{str(row.book_id).rstrip('/').rpartition('/')[2]}.epub"
                epub.write(name, texts, audio)
                out.append((row.book_id, name))
            yield pd.DataFrame(out, columns=["book_id", "file"])

    kind = dict(packages.dtypes)["book_id"]
    return packages.select("book_id", "opf", "xhtml", "nav", "smil", "used").mapInPandas(run, f"book_id {kind}, file string")
