"""The interchange document: read, checked, updated section by section, written compactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import __version__
from ..schema import DOCUMENT

FORMAT = "read-along/1"
GENERATOR = f"cantor/{__version__}"
SECTIONS = ("book", "text", "audio", "alignment")


def parsed(texts: DataFrame, column: str = "value", format: str = FORMAT) -> DataFrame:
    """Documents from JSON text. Broken JSON and any other format tag are errors; a null text is a fresh document."""
    doc = F.from_json(column, DOCUMENT, {"mode": "PERMISSIVE"})
    kept = [c for c in texts.columns if c != column]
    rows = texts.select(*kept, F.col(column).alias("_raw"), doc.alias("_d"))
    broken = F.col("_raw").isNotNull() & F.col("_d.format").isNull()
    other = F.col("_raw").isNotNull() & (F.col("_d.format") != format)
    fail = lambda *m: F.raise_error(F.concat(*m)).cast("string")
    tag = (
        F.when(broken, fail(F.lit("no valid document")))
        .when(other, fail(F.lit('unknown format "'), F.col("_d.format"), F.lit(f'" (expected {format})')))
        .otherwise(F.coalesce("_d.format", F.lit(format)))
    )
    return rows.select(*kept, tag.alias("format"), F.coalesce("_d.generator", F.lit(GENERATOR)).alias("generator"), *[F.col(f"_d.{s}").alias(s) for s in SECTIONS])


def load(spark: SparkSession, path: str, format: str = FORMAT) -> DataFrame:
    """Documents of a folder, a file each, with their path."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parsed(texts, format=format)


def serialized(docs: DataFrame) -> Column:
    """A document as one line of JSON: stages not run are left out, nulls inside a stage stay; the generator is stamped over."""
    empty = {"ignoreNullFields": "false"}
    name = lambda k, v: F.concat(F.lit(f'"{k}":'), v)
    text = lambda c: F.to_json(F.struct(F.col(c).alias("x")), empty)
    parts = [name("format", F.regexp_extract(text("format"), '^\\{"x":([\\s\\S]*)\\}$', 1)), F.lit(f'"generator":"{GENERATOR}"')]
    parts += [F.when(F.col(s).isNotNull(), name(s, F.to_json(s, empty))) for s in SECTIONS if s in docs.columns]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def save(docs: DataFrame, path: str) -> None:
    docs.select(serialized(docs).alias("value")).write.mode("overwrite").text(path)


def with_text(docs: DataFrame, book: Column, text: Column | None = None) -> DataFrame:
    """New text orphans what was derived from the old."""
    kinds = dict(docs.dtypes)
    return docs.withColumns({"book": book.cast(kinds["book"]), "text": (F.lit(None) if text is None else text).cast(kinds["text"]), "alignment": F.lit(None).cast(kinds["alignment"])})


def with_audio(docs: DataFrame, audio: Column) -> DataFrame:
    """New audio makes the times stale."""
    kinds = dict(docs.dtypes)
    return docs.withColumns({"audio": audio.cast(kinds["audio"]), "alignment": F.lit(None).cast(kinds["alignment"])})


def stale(docs: DataFrame, body: Column) -> Column:
    """Whether the text at hand isn't the one that was aligned."""
    return F.sha2(body, 256) != F.col("alignment.textSha256")


def export_problem(body: Column, force: Column | bool = False) -> Column:
    """Why a document can't be exported, or null; the first reason counts."""
    force = F.lit(force) if isinstance(force, bool) else force
    return (
        F.when(F.col("book").isNull(), "no book — run `import` first")
        .when(F.col("text").isNull(), "no text — run `import` first")
        .when(F.col("audio").isNull(), "no audio — run `fetch-audio` first")
        .when(F.col("alignment").isNull(), "no alignment — run `align` first")
        .when(~F.col("alignment.verdict.pass") & ~force, F.concat(F.lit("alignment was refused: "), F.coalesce("alignment.verdict.refusal", F.lit("null")), F.lit(" (pass { force: true } to export anyway)")))
        .when(F.sha2(body, 256) != F.col("alignment.textSha256"), "text changed since alignment; re-run align")
        .when(F.size("audio.sections") == 0, "no audio sections — run `fetch-audio` first")
    )


def empty(spark: SparkSession) -> DataFrame:
    """No document, with all columns."""
    return spark.createDataFrame([], T._parse_datatype_string(DOCUMENT))
