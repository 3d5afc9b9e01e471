"""Whole-recording time: section starts, which section a time or frame falls in, clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _c


def renumber(sections: DataFrame, number: str = "section_number", place: str = "feed_pos") -> DataFrame:
    """Positions 1..n by the feed's own number, read as a number; rows without one come first, as they came."""
    order = Window.partitionBy("book_id").orderBy(F.expr(f"try_cast({number} as double)").asc_nulls_first(), place)
    return sections.withColumn("position", F.row_number().over(order))


def section_starts(sections: DataFrame, secs: str = "secs") -> DataFrame:
    """Adds start: what earlier sections of the book last together, added up in order of position."""
    before = Window.partitionBy("book_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return sections.withColumn("start", F.coalesce(F.sum(secs).over(before), F.lit(0)))


def section_arrays(started: DataFrame) -> DataFrame:
    """A row per book: its sections as an array ordered by start (tens to hundreds of entries)."""
    return started.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("start", "position"))).alias("_sections"))


def section_at(rows: DataFrame, started: DataFrame, time: Column | str, how: str = "inner") -> DataFrame:
    """Adds section and section_start: the last section that starts at or before the time, else the first.

    One join on the book: the sections come as an array per book, so the as-of match is an expression in the row.
    """
    arrays = section_arrays(started)
    found = rows.join(arrays, "book_id", how)
    # The sections are sorted: those not after the time are a prefix.
    upto = F.filter("_sections", lambda s: s["start"] <= _c(time))
    match = F.coalesce(F.try_element_at(upto, F.lit(-1)), F.get("_sections", F.lit(0)))
    return found.withColumn("_m", match).withColumn("section", F.col("_m")["position"]).withColumn("section_start", F.col("_m")["start"]).drop("_m", "_sections")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, bucket: int) -> DataFrame:
    """Backward as-of match for right sides too large for arrays. Adds value and right_time to the rows of left; null where
    nothing is at or before. Times are whole numbers; ties match; of equal right times the largest value counts.

    Times are cut into buckets of `bucket`. Within a bucket both sides are sorted together and the last right value is carried on; what a
    bucket begins with comes from a row per key and bucket. So a hot key is dealt over its buckets.
    """
    at = lambda t: F.floor(F.col(t) / bucket)
    seen = right.groupBy(F.col(key).alias("_k"), F.col(right_time).alias("_t")).agg(F.max(value).alias("_v")).withColumn("_b", at("_t"))
    row = F.struct(*left.columns).alias("_row")
    rows = left.select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), row).withColumn("_b", at("_t"))
    both = rows.withColumn("_right", F.lit(None).cast("struct<v:double,t:bigint>")).unionByName(seen.select("_k", "_t", "_b", F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.struct(F.col("_v").cast("double").alias("v"), F.col("_t").cast("long").alias("t")).alias("_right")))
    within = Window.partitionBy("_k", "_b").orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_right", ignorenulls=True).over(within)).where("_row is not null")
    every = rows.select("_k", "_b").distinct().withColumn("_end", F.lit(None).cast("struct<v:double,t:bigint>"))
    closing = seen.groupBy("_k", "_b").agg(F.max_by(F.struct(F.col("_v").cast("double").alias("v"), F.col("_t").cast("long").alias("t")), "_t").alias("_end"))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.unionByName(closing).groupBy("_k", "_b").agg(F.first("_end", ignorenulls=True).alias("_end")).select("_k", "_b", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    joined = found.join(carried, ["_k", "_b"]).withColumn("_m", F.coalesce("_last", "_carried"))
    return joined.select("_row.*", F.col("_m.v").alias(value), F.col("_m.t").alias(right_time))


def frame_section(rows: DataFrame, bounds: DataFrame, frame: Column | str) -> DataFrame:
    """Adds section for a frame: the half-open range of (book_id, position, lo, hi) it is in, else the last section."""
    arrays = bounds.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("position", "lo", "hi"))).alias("_bounds"))
    hit = F.filter("_bounds", lambda b: (b["lo"] <= _c(frame)) & (_c(frame) < b["hi"]))
    found = F.coalesce(F.get(hit, F.lit(0)), F.try_element_at(F.col("_bounds"), F.lit(-1)))["position"]
    return rows.join(arrays, "book_id").withColumn("section", found).drop("_bounds")


def frame_bounds(chunks: DataFrame) -> DataFrame:
    """book_id, section, chunk, frames, offset: each chunk's first frame in the book's emission."""
    order = Window.partitionBy("book_id").orderBy("section", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumn("offset", F.coalesce(F.sum("frames").over(order), F.lit(0)).cast("long"))


def seconds_per_frame(chunks: DataFrame, rate: int = 16000) -> DataFrame:
    """book_id, ratio: from all samples and all frames of the book."""
    return chunks.groupBy("book_id").agg((F.sum("samples") / F.sum("frames") / rate).alias("ratio"))


def clips(pars: DataFrame, begin: str = "begin", order: str = "ord") -> DataFrame:
    """Adds par (1..n by begin over the book) and clip_end: the next paragraph's begin in the same file, or null."""
    book = Window.partitionBy("book_id").orderBy("whole_begin", order)
    file = Window.partitionBy("book_id", "section").orderBy("whole_begin", order)
    return pars.withColumn("par", F.row_number().over(book)).withColumn("clip_end", F.lead(begin).over(file))
