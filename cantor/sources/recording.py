"""Recordings: the feed of a catalogue, files at hand, and the edge that fetches and measures them."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, normalize_listen_url, zero_padded
from ..operators import timeline
from ..schema import FEED

AGENT = "cantor/0.1"


def feed(spark: SparkSession, path: str) -> DataFrame:
    """book_id (the file), title, url and sections of the first book of each feed file. A feed without a book is an error."""
    raw = spark.read.schema(FEED).option("multiLine", "true").json(path).select(F.col("_metadata.file_path").alias("book_id"), "books")
    return from_feed(raw)


def from_feed(raw: DataFrame) -> DataFrame:
    book = F.coalesce(F.get("books", F.lit(0)), F.raise_error(F.concat(F.lit("no recording found for "), F.col("book_id").cast("string"))).cast(dict(raw.dtypes)["books"][len("array<") : -1]))
    return raw.select("book_id", book.alias("b")).select("book_id", F.coalesce("b.title", F.lit("")).alias("title"), F.col("b.url").alias("url"), F.col("b.sections").alias("sections"))


def sections(books: DataFrame) -> DataFrame:
    """book_id, position, title, reader, listen_url: numbered by the feed's own numbers, blanks as null."""
    rows = books.select("book_id", F.posexplode("sections").alias("feed_pos", "s")).select("book_id", "feed_pos", "s.*")
    reader = blank_to_null(F.get("readers", F.lit(0))["display_name"])
    return timeline.renumber(rows).select("book_id", "position", blank_to_null("title").alias("title"), reader.alias("reader"), normalize_listen_url(F.coalesce("listen_url", F.lit(""))).alias("listen_url"))


def local_audio(spark: SparkSession, path: str) -> DataFrame:
    """position, path, length, file: sound files of a folder in playing order, which is that of their names."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.[mM][pP]3").load(path).select("path", "length")
    named = names.withColumn("name", F.element_at(F.split("path", "/"), -1))
    # Numbered within the folder, as playing order is.
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return named.withColumn("position", F.row_number().over(Window.partitionBy(folder).orderBy("name"))).withColumn("file", F.concat(zero_padded("position"), F.lit(".mp3")))


def to_fetch(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Sections whose file isn't there, or is empty. present: book_id, file, length."""
    named = wanted.withColumn("file", F.concat(zero_padded("position"), F.lit(".mp3")))
    return named.join(present.where("length > 0"), ["book_id", "file"], "left_anti")


def text_sources(spark: SparkSession, path: str) -> DataFrame:
    """path, kind (txt or html by extension), text: whole text files."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.withColumn("kind", F.when(F.lower("path").endswith(".txt"), "txt").otherwise("html"))


def download(url: str, file: str, label: str, agent: str = AGENT, get: Callable | None = None, timeout: int = 120) -> None:
    """Fetches a file to its place; any answer but a good one is an error."""
    request = urllib.request.Request(url, headers={"user-agent": agent})
    with (get or urllib.request.urlopen)(request, timeout=timeout) as answer:
        if not 200 <= answer.status < 300:
            raise OSError(f"audio HTTP {answer.status} for {label}")
        data = answer.read()
    with open(f"{file}.part", "wb") as f:
        f.write(data)
    os.replace(f"{file}.part", file)


def first_ok(urls: list[str], get: Callable) -> bytes:
    """The first candidate that answers well."""
    for url in urls:
        answer = get(url)
        if answer is not None:
            return answer
    raise OSError(f"none of {', '.join(urls)} could be fetched")


# Where a book's file may lie, the richer one first.
EPUB_URLS = ("https://www.gutenberg.org/cache/epub/{id}/pg{id}-images.epub", "https://www.gutenberg.org/cache/epub/{id}/pg{id}.epub")


def answered(url: str, agent: str = AGENT, timeout: int = 120) -> bytes | None:
    """What a URL answers, or None where it has nothing."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"user-agent": agent}), timeout=timeout) as answer:
            return answer.read()
    except urllib.error.HTTPError:
        return None


def fetch_epub(number: str, get: Callable = answered) -> bytes:
    """A book's file by its number at its source."""
    return first_ok([u.format(id=number) for u in EPUB_URLS], get)


def copy_audio(files: list[str], folder: str, probe: Callable | None = None, reader: str | None = None) -> Iterator[dict]:
    """Copies files in their order under numbers of their own, and measures each copy. For the driver's edge."""
    for k, file in enumerate(files, 1):
        name = f"{k:04d}.mp3"
        shutil.copyfile(file, os.path.join(folder, name))
        yield {"position": k, "file": f"audio/{name}", "secs": (probe or probe_secs)(os.path.join(folder, name)), "title": None, "reader": reader}


def download_sections(rows: list[dict], folder: str, fetch: Callable = download, probe: Callable | None = None, pace: float = 0.5) -> Iterator[dict]:
    """In order, one at a time: fetches what isn't there (one retry), measures every file. For the driver's edge."""
    for row in rows:
        name = f"{row['position']:04d}.mp3"
        file = os.path.join(folder, name)
        if not (os.path.exists(file) and os.path.getsize(file)):
            for last in (False, True):
                try:
                    fetch(row["listen_url"], file, f"section {row['position']}")
                    break
                except OSError:
                    if last:
                        raise
                    time.sleep(pace)
            time.sleep(pace)
        yield {**row, "file": name, "secs": (probe or probe_secs)(file)}


def probe_secs(file: str, run: Callable = subprocess.run) -> float:
    """Seconds that a sound file lasts, by the media tool at hand; anything but a finite number is an error."""
    out = run(["ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "json", file], capture_output=True, text=True, check=True).stdout
    secs = float(json.loads(out)["format"]["duration"])
    if secs != secs or secs in (float("inf"), float("-inf")):
        raise ValueError(f"{file}: no duration")
    return secs
