"""What several operators share: the shared scratch folder, written tables, Arrow batches and byte stores."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes per Arrow batch sent to a Python worker. Texts may be long, so batches are short.
ARROW_ROWS, ARROW_BYTES = 1000, 64 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir).

    Where the session names none, a folder of this machine is used if the master is local; else it is an error.
    """
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


def _shared(spark: SparkSession) -> str:
    """What this application writes is in one folder, which clear() removes."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}"
    return f"{root.rstrip('/')}/cantor/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Removes all that this application has written to the shared folder. Results that still read it must be saved before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_shared(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest(rows: DataFrame, total: int, sample: int, *order: str) -> pa.Table:
    """The first `sample` of `total` rows in some order, of which the first column is a hash as hexadecimal digits.

    A bound on the hash keeps rows that can't be chosen out of the sort. Where too few lie under it, as many rows share an id or
    have none, all are sorted.
    """
    if total > 2 * sample:
        few = rows.where(F.col(order[0]) < f"{int(1.5 * sample / total * 2**32):08x}").orderBy(*order).limit(sample).toArrow()
        if few.num_rows == sample:
            return few
    return rows.orderBy(*order).limit(sample).toArrow()


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> None:
    """Bounds the rows and bytes per Arrow batch for this session (never raises a lower bound).

    Plans read these settings when they run, so they can't be set back here.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key, None)
        if now is not None and not 0 < int(re.sub("[^0-9-]", "", now)) <= most:
            spark.conf.set(key, str(most))


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, for flat files that Spark has no writer for."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), parts.path
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def workers_import(spark: SparkSession) -> None:
    """Tells the workers of a session that was started elsewhere where this package is."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
