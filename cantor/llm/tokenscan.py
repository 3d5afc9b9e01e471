"""Token counts by a separator scan of flat token files.

Files: little-endian 16-bit ids, document after document, each followed by the end-of-document id, no index. A file
is cut into blocks of BLOCK bytes. Each block is searched for the separator by one array comparison and gives its
separators' places. A prefix scan over the blocks of a file (two running maxima and sums, on a row per block)
gives each block the number of separators before it and the place of the last one, which stitches documents that
span blocks: however many blocks a document covers, its start is the separator before plus one.

write() makes such files from documents and tells which document is the how-many-th of which file.

Defined results: a null or empty text is a document of 0 tokens. Repeated rows are documents of their own. Ids that
follow the last separator of a file are reported as a document that isn't terminated. An empty table gives no
file and no row. Only key and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize, scratch, short_batches, store
from .tokens import END, encoder, vocabulary

BLOCK = 4 * 1024 * 1024
ROLL = 128 * 1024 * 1024
WIDTH = 2


def _written(root: str, path: str, separator: int):
    end = separator.to_bytes(WIDTH, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, attempt = encoder(path, "H"), TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, base = store(root)
        out, name, size, number, files = None, "", 0, 0, 0
        for b in batches:
            names, places = [], []
            for text in b.column(1):
                if out is None or size >= ROLL:
                    if out is not None:
                        out.close()
                    fs.create_dir(base, recursive=True)
                    name, size, number, files = f"{root}/tokens-{task:05d}-{files:03d}-{attempt}.bin", 0, 0, files + 1
                    out = fs.open_output_stream(f"{base}/{name.rpartition('/')[2]}", compression=None, buffer_size=1 << 20)
                size += out.write(encode(text.as_py()) + end)
                names.append(name)
                places.append(number)
                number += 1
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(places, pa.int64()), b.column(0)], names=["file", "number", "doc_id"])
        if out is not None:
            out.close()

    return run


def write(docs: DataFrame, root: str | None = None, key: str = "doc_id", text: str = "text", path: str | None = None, separator: int = END) -> DataFrame:
    """Writes flat token files under root. Result: file, number (from 0), doc_id."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return materialize(rows.mapInArrow(_written(root or scratch(spark, "tokens"), path or vocabulary(), separator), "file string, number long, doc_id long"), "order")


def _searched(separator: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, places = [], []
            for name, number in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, path = store(name)
                with fs.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(block, number * block), "<u2")
                sizes.append(len(ids))
                places.append((np.flatnonzero(ids == separator) + number * (block // WIDTH)).astype(np.int64))
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32), np.concatenate([np.zeros(0, np.int64), *places]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), lists], names=["file", "block", "tokens", "ends"])

    return run


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = []
        for name in b.column(0).to_pylist():
            fs, path = store(name)
            sizes.append(fs.get_file_info(path).size)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["file", "bytes"])


def scan(files: DataFrame, separator: int = END, block: int = BLOCK) -> DataFrame:
    """file, number, start, n_tokens (without the separator), terminated: a row per document of the files in column file."""
    spark = files.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = files.select("file").distinct().mapInArrow(_sized, "file string, bytes long").where("bytes > 0")
    cut = sized.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / block))).alias("block"))
    # Short batches: a task holds the separators of a few blocks.
    blocks = materialize(cut.repartition(parts, "file", "block").mapInArrow(_searched(separator, block), "file string, block long, tokens long, ends array<long>"), "blocks")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = blocks.select("file", "block", "tokens", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    stitched = narrow.select(
        F.col("file").alias("_f"),
        F.col("block").alias("_b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"),
    )
    joined = blocks.join(stitched, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    start = lambda i: F.when(i == 0, F.col("carry") + 1).otherwise(F.get(F.col("ends"), i - 1) + 1)
    rows = joined.select("file", "base", F.posexplode(F.transform("ends", lambda e, i: F.struct(start(i).alias("start"), (e - start(i)).alias("n")))))
    whole = rows.select("file", (F.col("base") + F.col("pos")).alias("number"), F.col("col.start").alias("start"), F.col("col.n").alias("n_tokens"), F.lit(True).alias("terminated"))
    ended = narrow.groupBy("file").agg(F.sum("tokens").alias("t"), F.sum("n").cast("long").alias("number"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    return whole.union(ended.where("t > start").select("file", "number", "start", (F.col("t") - F.col("start")).alias("n_tokens"), F.lit(False)))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Writes the documents' token files, scans them, and gives doc_id, n_tokens, start (within its file)."""
    order = write(docs, key=key, text=text, path=path)
    found = scan(order).withColumnsRenamed({"file": "_f", "number": "_n"})
    return order.join(found, (F.col("file") == F.col("_f")) & (F.col("number") == F.col("_n"))).select("doc_id", "n_tokens", "start")
