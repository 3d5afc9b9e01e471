"""Texts and HTML to anchored fragments: stable paragraph ids, sections cut at headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _c, clean_paragraph, escape_text, heading_text, slugify, trim_all

BLANK_LINE = "\\r?\\n\\s*\\r?\\n"
# What is never book text.
SKIP_IDREF = "(?i)^(cover|coverpage|toc|nav)"
BOILERPLATE = "(?i)project gutenberg|start of (the|this) project|end of (the|this) project"
SKIP_TITLE = "(?i)^(contents|table of contents|transcriber|illustrations)"


def blocks(text: Column | str, separator: str = BLANK_LINE) -> Column:
    """Trimmed non-empty blocks of a plain text."""
    return F.filter(F.transform(F.split(_c(text), separator), trim_all), lambda b: b != "")


def fragments_txt(books: DataFrame, separator: str = BLANK_LINE, key: str = "book_id", text: str = "text", least: int = 2) -> DataFrame:
    """book_id, ord, anchor_id, text: numbered paragraphs with `least` words or more. A narrow transformation."""
    rows = books.select(F.col(key).alias("book_id"), F.posexplode(blocks(text, separator)).alias("_p", "_b"))
    flat = rows.select("book_id", (F.col("_p") + 1).alias("ord"), F.concat(F.lit("text-p"), F.col("_p") + 1).alias("anchor_id"), F.regexp_replace("_b", "\\s+", " ").alias("text"))
    return flat.where(F.size(F.split("text", " ")) >= least)


def anchored_txt(text: Column | str, separator: str = BLANK_LINE) -> Column:
    """A plain text as one section of numbered paragraphs."""
    p = F.transform(blocks(text, separator), lambda b, i: F.concat(F.lit('<p id="text-p'), i + 1, F.lit('">'), F.regexp_replace(escape_text(b), "\\r?\\n", " "), F.lit("</p>")))
    return F.concat(F.lit('<section id="text">\n'), F.array_join(p, "\n"), F.lit("\n</section>"))


def fragments_html(bodies: DataFrame, key: str = "book_id", html: str = "html", least: int = 2) -> DataFrame:
    """book_id, ord, anchor_id, text of every paragraph whose first attribute is an id."""
    pattern = '<p id="([^"]+)"(?:\\s[^>]*)?>([\\s\\S]*?)</p>'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), 1).alias("a"), F.regexp_extract_all(html, F.lit(pattern), 2).alias("t"))
    rows = bodies.select(F.col(key).alias("book_id"), F.posexplode(pairs).alias("_p", "_x"))
    flat = rows.select("book_id", (F.col("_p") + 1).alias("ord"), F.col("_x")["a"].alias("anchor_id"), clean_paragraph(F.col("_x")["t"]).alias("text"))
    return flat.where(F.size(F.split("text", " ")) >= least)


def spine_blocks(spine: DataFrame, manifest: DataFrame) -> DataFrame:
    """Spine entries that are text, with the file the manifest names: book_id, pos, idref, href.

    The last manifest entry of an id wins. Entries without a file are dropped.
    """
    last = manifest.where("item_id is not null and href is not null").groupBy("book_id", "item_id").agg(F.max_by("href", "pos").alias("href"))
    return spine.where(~F.col("idref").rlike(SKIP_IDREF)).join(last, (spine["book_id"] == last["book_id"]) & (spine["idref"] == last["item_id"])).select(spine["book_id"], spine["pos"], "idref", "href")


def keep_blocks(rows: DataFrame, text: str = "text") -> DataFrame:
    """Drops blocks that are the distributor's plumbing."""
    return rows.where(~F.col(text).rlike(BOILERPLATE))


def sections(rows: DataFrame, is_heading: Column | None = None, title: Column | None = None) -> DataFrame:
    """Adds section (from 1) and section_title to (book_id, block, html): a new section at each heading.

    Blocks before the first heading are a section of their own. Front matter sections are dropped afterwards, and
    the rest are renumbered, so numbers have no holes.
    """
    title = heading_text("html") if title is None else title
    is_heading = title.isNotNull() if is_heading is None else is_heading
    book = Window.partitionBy("book_id").orderBy("block")
    cut = rows.withColumn("_h", is_heading).withColumn("_t", F.when(F.col("_h"), title))
    first = F.first("_h").over(book.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cut = cut.withColumn("_s", F.sum(F.col("_h").cast("int")).over(book) + F.when(first, 0).otherwise(1))
    named = cut.withColumn("section_title", F.max("_t").over(Window.partitionBy("book_id", "_s")))
    kept = named.where(F.col("section_title").isNull() | ~F.col("section_title").rlike(SKIP_TITLE))
    return kept.withColumn("section", F.dense_rank().over(Window.partitionBy("book_id").orderBy("_s"))).drop("_h", "_t", "_s")


def base_slug(title: Column | str, section: Column | str) -> Column:
    """A section's id before repeats are told apart."""
    slug = F.nullif(slugify(title), F.lit(""))
    return F.coalesce(slug, F.when(_c(section) == 1, F.lit("beginning")).otherwise(F.concat(F.lit("section-"), _c(section))))


def mint_ids(bases: Column | str) -> Column:
    """Ids for an array of bases: the base, or the first of base-2, base-3, ... that isn't taken by an earlier id.

    A fold over a book's sections (tens to hundreds). Only a base that is taken looks for a number, from the count of
    ids that begin like it on: fewer can't all be taken.
    """

    def named(ids: Column, base: Column) -> Column:
        like = F.size(F.filter(ids, lambda i: F.startswith(i, F.concat(base, F.lit("-")))))
        numbered = F.transform(F.sequence(F.lit(2), like + 2), lambda n: F.concat(base, F.lit("-"), n))
        return F.when(F.array_contains(ids, base), F.get(F.array_except(numbered, ids), F.lit(0))).otherwise(base)

    return F.aggregate(_c(bases), F.array().cast("array<string>"), lambda ids, base: F.concat(ids, F.array(named(ids, base))))


def section_ids(sectioned: DataFrame) -> DataFrame:
    """book_id, section, section_title, section_id: one row per section; ids are minted in order within the book."""
    heads = sectioned.groupBy("book_id", "section").agg(F.max("section_title").alias("section_title"))
    heads = heads.withColumn("base", base_slug("section_title", "section"))
    folded = heads.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("section", "section_title", "base"))).alias("_s"))
    minted = folded.withColumn("_i", mint_ids(F.transform("_s", lambda s: s["base"])))
    return minted.select("book_id", F.inline(F.arrays_zip("_s", "_i"))).select("book_id", "_s.section", "_s.section_title", F.col("_i").alias("section_id"))


def paragraph_ids(paragraphs: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds anchor_id to (book_id, section, block, id): the n-th paragraph of its section; ids that exist stay."""
    place = F.row_number().over(Window.partitionBy("book_id", "section").orderBy("block"))
    return paragraphs.join(ids.select("book_id", "section", "section_id"), ["book_id", "section"]).withColumn("anchor_id", F.coalesce("id", F.concat("section_id", F.lit("-p"), place)))
