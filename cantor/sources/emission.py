"""Emissions: sound files through a pluggable model to blocks of frames that the alignment reads.

The model is handed in as two functions, one that decodes a file to samples and one that scores a chunk of samples. Files are
dealt to tasks, a file's chunks are scored one after another and leave as they come, so a task never holds a whole emission.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.timeline import frame_bounds, seconds_per_frame

# Samples a second, seconds of a chunk, samples of the shortest remainder that is scored.
RATE, CHUNK_SECS, LEAST_SAMPLES = 16_000, 40, 640
CHUNKS = "book_id long, section int, chunk int, frames long, samples long, logits binary"


def cuts(samples: int, rate: int = RATE) -> list[tuple[int, int]]:
    """(start, end) of the chunks of a file; a remainder that is too short is left out."""
    size = CHUNK_SECS * rate
    return [(a, min(samples, a + size)) for a in range(0, samples, size) if samples - a >= LEAST_SAMPLES]


def scored(files: DataFrame, decode: Callable[[bytes], np.ndarray], forward: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """A row per chunk of each file (book_id, section, content): its frames as float32 rows. Files without a usable chunk give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                samples = decode(b.column(2)[i].as_py())
                for k, (low, high) in enumerate(cuts(len(samples))):
                    logits = np.ascontiguousarray(forward(samples[low:high]), "<f4")
                    values = ([k], [len(logits)], [high - low], [logits.tobytes()])
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), *map(pa.array, values, kinds)], names=["book_id", "section", "chunk", "frames", "samples", "logits"])

    return files.select(F.col("book_id").cast("long"), F.col("section").cast("int"), "content").mapInArrow(run, CHUNKS)


def landed(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Chunk rows of matrices that a model has left as files: book_id=<n>/section=<n>/<chunk>-<samples>.f32, rows of `width` scores."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.f32").option("recursiveFileLookup", "true").load(path).select("path", "content")
    part = lambda pattern, kind: F.regexp_extract("path", pattern, 1).cast(kind)
    return files.select(
        part("book_id=(\\d+)/", "long").alias("book_id"),
        part("section=(\\d+)/", "int").alias("section"),
        part("/(\\d+)-\\d+\\.f32$", "int").alias("chunk"),
        F.floor(F.octet_length("content") / (4 * width)).alias("frames"),
        part("-(\\d+)\\.f32$", "long").alias("samples"),
        F.col("content").alias("logits"),
    )


def books(chunks: DataFrame) -> DataFrame:
    """book_id, ratio (seconds a frame), bounds (first frame of each section, and the end)."""
    per = chunks.groupBy("book_id", "section").agg(F.sum("frames").alias("_f"))
    upto = Window.partitionBy("book_id").orderBy("section")
    ends = per.withColumn("_end", F.sum("_f").over(upto)).groupBy("book_id").agg(F.array_sort(F.collect_list("_end")).alias("_ends"))
    bounds = F.concat(F.array(F.lit(0).cast("long")), "_ends").alias("bounds")
    return seconds_per_frame(chunks, RATE).join(ends, "book_id").select("book_id", "ratio", bounds)


def blocks(chunks: DataFrame, block_frames: int, width: int) -> DataFrame:
    """book_id, block, logits: the chunks of a book end to end, cut anew into blocks of block_frames.

    A chunk goes to the blocks it covers; a block's pieces meet by (book_id, block), so a group is one block.
    """
    placed = frame_bounds(chunks.select("book_id", "section", "chunk", "frames")).select("book_id", "section", "chunk", "offset")
    rows = chunks.join(placed, ["book_id", "section", "chunk"]).where("frames > 0")
    covered = F.sequence(F.floor(F.col("offset") / block_frames), F.floor((F.col("offset") + F.col("frames") - 1) / block_frames))
    each = rows.withColumn("block", F.explode(covered))
    low = F.greatest(F.col("offset"), F.col("block") * block_frames)
    high = F.least(F.col("offset") + F.col("frames"), (F.col("block") + 1) * block_frames)
    piece = F.substring("logits", ((low - F.col("offset")) * 4 * width + 1).cast("int"), ((high - low) * 4 * width).cast("int"))
    pieces = each.select("book_id", "block", low.alias("_low"), piece.alias("_bytes"))
    ordered = F.array_sort(F.collect_list(F.struct("_low", "_bytes")))
    whole = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda got, p: F.concat(got, p["_bytes"]))
    return pieces.groupBy("book_id", "block").agg(whole.alias("logits"))
