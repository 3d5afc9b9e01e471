"""Zipped books: identity, manifest, spine and anchored body. Files come from binaryFile scans; zip work is Arrow-batched."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import urlparse
from xml.etree import ElementTree

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..operators import anchoring, overlay

SKIPPED = re.compile(anchoring.SKIP_IDREF)
ENTRIES = "path string, title string, author string, language string, manifest array<struct<pos:int,item_id:string,href:string>>, spine array<struct<pos:int,idref:string>>, opf_dir string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(root, name: str) -> str:
    """Text of the first Dublin Core element of a name within the metadata."""
    for el in root.iter():
        if _local(el.tag) == "metadata":
            for child in el.iter():
                if _local(child.tag) == name:
                    return "".join(child.itertext()).strip()
    return ""


def _flipped(name: str) -> str:
    parts = name.split(",")
    return f"{parts[1].strip()} {parts[0].strip()}" if len(parts) == 2 else name


def entry(z: zipfile.ZipFile, name: str) -> bytes:
    try:
        return z.read(name)
    except KeyError:
        raise ValueError(f"epub: missing {name}") from None


def package(data: bytes) -> dict:
    """What a book's package file says."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        container = ElementTree.fromstring(entry(z, "META-INF/container.xml"))
        path = next((el.get("full-path") for el in container.iter() if _local(el.tag) == "rootfile"), None)
        if not path:
            raise ValueError("epub: missing rootfile")
        opf = ElementTree.fromstring(entry(z, path))
    title = _text(opf, "title")
    if not title:
        raise ValueError("epub: missing dc:title")
    items = [el for part in opf.iter() if _local(part.tag) == "manifest" for el in part if _local(el.tag) == "item"]
    refs = [el for part in opf.iter() if _local(part.tag) == "spine" for el in part if _local(el.tag) == "itemref"]
    return {
        "title": title,
        "author": _flipped(_text(opf, "creator")) or None,
        "language": _text(opf, "language") or "en",
        "manifest": [{"pos": i, "item_id": el.get("id"), "href": el.get("href")} for i, el in enumerate(items) if el.get("id") and el.get("href")],
        "spine": [{"pos": i, "idref": el.get("idref") or ""} for i, el in enumerate(refs)],
        "opf_dir": path.rpartition("/")[0],
    }


def scan(spark: SparkSession, path: str) -> DataFrame:
    """path, content of every zipped book under a path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(path).select("path", "content")


def packages(files: DataFrame) -> DataFrame:
    """A row per book: identity, manifest and spine."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([{"path": p, **package(bytes(c))} for p, c in zip(f["path"], f["content"], strict=True)], columns=[x.split(" ")[0] for x in re.split(r", (?=\w+ )", ENTRIES)])

    return files.select("path", "content").mapInPandas(run, ENTRIES)


def identities(files: DataFrame) -> DataFrame:
    """path, title, author, language."""
    return packages(files).select("path", "title", "author", "language")


def _body(data: bytes) -> list[tuple[str, str]]:
    """(html, text) of all body blocks of a book's text files, in spine order."""
    told = package(data)
    # The last entry of an id wins; front matter and entries without a file are passed over.
    files = {item["item_id"]: item["href"] for item in told["manifest"]}
    wanted = [files[ref["idref"]] for ref in told["spine"] if ref["idref"] in files and not SKIPPED.match(ref["idref"])]
    folder = told["opf_dir"]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [block for href in wanted for block in H.html_blocks(entry(z, f"{folder}/{href}" if folder else href).decode("utf-8", "replace"))]


def file_blocks(files: DataFrame) -> DataFrame:
    """book_id, block, html, text: tidied body blocks of all text files of a book, in spine order, plumbing dropped.

    A book's archive is opened where it was read; its blocks leave in batches.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                found = _body(bytes(content))
                for k in range(0, len(found), 1000):
                    yield pd.DataFrame([(path, k + i, html, text) for i, (html, text) in enumerate(found[k : k + 1000])], columns=["book_id", "block", "html", "text"])

    return anchoring.keep_blocks(files.select("path", "content").mapInPandas(run, "book_id string, block int, html string, text string"))


def anchored(files: DataFrame) -> DataFrame:
    """book_id, body: the anchored text of each book. A book without readable text is an error."""
    cut = anchoring.sections(file_blocks(files))
    ids = anchoring.section_ids(cut)
    parts = cut.groupBy("book_id", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "html"))), lambda b: b["html"]), "\n").alias("inner"))
    rows = parts.join(ids, ["book_id", "section"])
    # Paragraphs are split at their opening tags; the n-th one without an id gets the section's n-th.
    pieces = F.split("inner", "(?=<p[\\s>])")
    first = F.when(F.get(pieces, F.lit(0)).rlike("^<p[\\s>]"), F.lit(1)).otherwise(F.lit(0))
    numbered = F.transform(pieces, lambda s, i: F.when(s.rlike("^<p[\\s>]") & ~s.rlike('^<p\\s[^>]*id="'), F.concat(F.lit('<p id="'), F.col("section_id"), F.lit("-p"), i + first, F.lit('"'), F.substring(s, F.lit(3), F.length(s)))).otherwise(s))
    whole = F.concat(F.lit('<section id="'), "section_id", F.lit('">'), F.array_join(numbered, ""), F.lit("</section>"))
    joined = rows.withColumn("_h", whole).groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "_h"))), lambda x: x["_h"]), "\n").alias("body"))
    named = files.select(F.col("path").alias("book_id")).join(joined, "book_id", "left")
    return named.select("book_id", F.coalesce("body", F.raise_error(F.concat("book_id", F.lit(": no readable body after conversion"))).cast("string")).alias("body"))


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    parts = urlparse(uri)
    return (pafs.LocalFileSystem(), parts.path) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(uri)


def load(uri: str) -> bytes:
    fs, path = _store(uri)
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def write(out: str, texts: dict[str, str], audio: dict[str, bytes], folder: str = "book") -> None:
    """A package: the media type first and stored, the rest deflated. For the edge, a book at a time.

    texts: the package file as content.opf, and what its manifest names; audio: bytes by name in the manifest.
    """
    root = ElementTree.Element("container", {"version": "1.0", "xmlns": "urn:oasis:names:tc:opendocument:xmlns:container"})
    ElementTree.SubElement(ElementTree.SubElement(root, "rootfiles"), "rootfile", {"full-path": f"{folder}/content.opf", "media-type": "application/oebps-package+xml"})
    files = {"META-INF/container.xml": ElementTree.tostring(root, encoding="utf-8", xml_declaration=True)}
    files |= {f"{folder}/{name}": data for name, data in {overlay.STYLE: overlay.STYLE_TEXT, **texts, **audio}.items()}
    fs, path = _store(out)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip", zipfile.ZIP_STORED)
        for name, data in files.items():
            z.writestr(name, data)
