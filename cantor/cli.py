"""Commands over a work directory: a book's document (work.json), its text, sound and emission.

    fetch-text --id N [--dir D]     fetch-audio --feed FILE --dir D     prepare --text F | --epub F --audio-dir A --dir D
    align --dir D [--dry]           export --dir D --out FOLDER [--force]
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config, pipelines
from .functions.text import slugify
from .operators import document
from .schema import AUDIO, BOOK, SECTION
from .sources import emission, epub, recording

DOC = "work.json"


def session() -> SparkSession:
    return SparkSession.builder.appName("cantor").getOrCreate()


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The document of a directory as a row (book_id is the directory); a fresh one where there is none."""
    file = Path(folder, DOC)
    rows = spark.createDataFrame([(folder, file.read_text("utf-8") if file.exists() else None)], "book_id string, value string")
    return document.parsed(rows)


def save(docs: DataFrame, folder: str) -> None:
    """One row, one file: the edge of a directory that holds one book."""
    os.makedirs(folder, exist_ok=True)
    Path(folder, DOC).write_text(docs.select(document.serialized(docs)).first()[0] + "\n", "utf-8")


def _body(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    file = Path(folder, "book.html")
    return docs.withColumn("body", F.lit(file.read_text("utf-8") if file.exists() else None).cast("string"))


def _sections(rows: list[dict]):
    names = [x.split(":")[0] for x in SECTION[len("struct<") : -1].split(",")]
    return F.from_json(F.lit(json.dumps([{n: r.get(n) for n in names} for r in rows])), f"array<{SECTION}>")


def fetch_text(args, get=recording.answered) -> str:
    spark, data = session(), recording.fetch_epub(args.id, get)
    told = epub.package(data)
    folder = args.dir or f"work/{spark.range(1).select(slugify(F.lit(told['title']))).first()[0]}"
    os.makedirs(folder, exist_ok=True)
    docs = load(spark, folder)
    Path(folder, "book.epub").write_bytes(data)
    source = F.struct(F.lit("gutenberg").alias("kind"), F.lit(args.id).alias("id"), F.lit(f"https://www.gutenberg.org/ebooks/{args.id}").alias("url"))
    book = F.struct(*[F.lit(told[k]).alias(k) for k in ("title", "author", "language")], source.alias("source")).cast(BOOK)
    save(document.with_text(docs, book), folder)
    return f"{told['title']} -> {folder}"


def fetch_audio(args, fetch=recording.download, probe=recording.probe_secs) -> str:
    spark = session()
    found = recording.feed(spark, args.feed)
    book = found.select("title", "url").first()
    wanted = [r.asDict() for r in recording.sections(found).orderBy("position").collect()]
    os.makedirs(f"{args.dir}/audio", exist_ok=True)
    rows = [r | {"file": f"audio/{r['file']}"} for r in recording.download_sections(wanted, f"{args.dir}/audio", fetch, probe)]
    source = F.struct(F.lit("librivox").alias("kind"), F.lit(args.id or "").alias("id"), F.lit(book["url"]).alias("url"))
    save(document.with_audio(load(spark, args.dir), F.struct(source.alias("source"), _sections(rows).alias("sections")).cast(AUDIO)), args.dir)
    return f"{book['title']}: {len(rows)} sections"


def prepare(args, probe=recording.probe_secs) -> str:
    spark = session()
    if not (args.text or args.epub):
        raise ValueError("prepare needs --text <file.html|.txt> or --epub <file.epub>")
    files = sorted(f for f in os.listdir(args.audio_dir) if f.lower().endswith(".mp3"))
    if not files:
        raise ValueError(f"{args.audio_dir}: no .mp3 files (playing order = filename sort)")
    os.makedirs(f"{args.dir}/audio", exist_ok=True)
    sources = pipelines.anchored_source(spark, os.path.abspath(args.epub or args.text))
    rows = list(recording.copy_audio([f"{args.audio_dir}/{f}" for f in files], f"{args.dir}/audio", probe, args.reader))
    audio = sources.select("book_id", F.lit(os.path.basename(os.path.abspath(args.audio_dir))).alias("origin"), _sections(rows).alias("sections"))
    docs = pipelines.prepared(sources, audio, args.title, args.author, args.language)
    Path(args.dir, "book.html").write_text(docs.select("body").first()[0], "utf-8")
    save(docs, args.dir)
    return f"{len(rows)} audio files -> {args.dir}"


def align(args, settings: config.Config | None = None) -> str:
    """Reads the emission that a model has left in the directory's folder `emission`."""
    spark, model = session(), (settings or config.load()).model
    docs = load(spark, args.dir)
    if Path(args.dir, "book.epub").exists() and not Path(args.dir, "book.html").exists():
        found = pipelines.anchored_source(spark, os.path.abspath(f"{args.dir}/book.epub")).withColumn("book_id", F.lit(args.dir))
        docs = pipelines.with_anchored_text(docs, found)
        Path(args.dir, "book.html").write_text(docs.select("body").first()[0], "utf-8")
    docs = _body(spark, docs, args.dir)
    width = len(pipelines.align.backend(model).alphabet)
    chunks = emission.landed(spark, f"{args.dir}/emission", width)
    number = F.lit(1).cast("long")
    found = pipelines.alignments(docs.select(number.alias("book_id"), "book.language", "body"), chunks.withColumn("book_id", number), model)
    done = docs.drop("alignment").crossJoin(found.select("alignment"))
    verdict = done.select("alignment.verdict").first()
    if verdict is None:
        raise ValueError(f"{args.dir}: no emission to align with")
    if not args.dry:
        save(done, args.dir)
    return "passed" if verdict[0]["pass"] else f"refused: {verdict[0]['refusal']}"


def export(args) -> str:
    spark = session()
    docs = _body(spark, load(spark, args.dir), args.dir)
    packages = pipelines.exported(docs, args.force)
    [row] = pipelines.write_packages(packages, os.path.abspath(args.out), os.path.abspath(args.dir)).collect()
    return row["file"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cantor", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)
    options = {"fetch-text": ("--id*", "--dir"), "fetch-audio": ("--feed*", "--id", "--dir*"), "prepare": ("--text", "--epub", "--audio-dir*", "--dir*", "--title", "--author", "--language", "--reader"), "align": ("--dir*", "--dry!"), "export": ("--dir*", "--out*", "--force!")}
    for name, flags in options.items():
        command = commands.add_parser(name)
        for f in flags:
            command.add_argument(f.rstrip("*!"), **({"action": "store_true"} if f.endswith("!") else {"required": f.endswith("*")}))
    return top


def main(argv: list[str] | None = None) -> int:
    """0 where the command did its work, 1 with a message where it couldn't, 2 for arguments that don't fit."""
    args = parser().parse_args(argv)
    run = {"fetch-text": fetch_text, "fetch-audio": fetch_audio, "prepare": prepare, "align": align, "export": export}[args.command]
    try:
        print(run(args))
    except Exception as e:  # noqa: BLE001
        print(f"cantor: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
