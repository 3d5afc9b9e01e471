"""The gates: whether an alignment may ship, and the first bar it missed in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_up, percent

# The bars. All are inclusive.
MIN_MEDIAN_CONF, MIN_COVERAGE, MIN_DOC_COVERAGE, MAX_LEAD_S, MAX_END_GAP = 0.8, 0.9, 0.5, 125, 0.05
PREDATES = "worker output has no start_gap/end_gap: the aligner predates the ends gate"


def doc_coverage() -> Column:
    """placed / paras, null where there is no paragraph."""
    return F.try_divide(F.col("placed").cast("double"), F.col("paras"))


def gap(name: str) -> Column:
    """A gap at an end: missing is an error, null is the worst case."""
    return F.when(~F.col("has_ends"), F.raise_error(F.lit(PREDATES)).cast("double")).otherwise(F.coalesce(name, F.lit(1.0)))


def passes() -> Column:
    """Every comparison with a null (no paragraphs) is false."""
    bars = (F.col("median_conf") >= MIN_MEDIAN_CONF) & (F.col("span_coverage") >= MIN_COVERAGE) & (doc_coverage() >= MIN_DOC_COVERAGE)
    return F.coalesce(bars & (F.col("lead_s") <= MAX_LEAD_S) & (gap("start_gap") <= MAX_END_GAP) & (gap("end_gap") <= MAX_END_GAP), F.lit(False))


def refusal() -> Column:
    """The first bar missed, as a sentence, asked in the order the verdict asks."""
    bar = lambda x: f"{round(100 * x)}%"
    cover = doc_coverage()
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return (
        F.when(F.col("median_conf") < MIN_MEDIAN_CONF, text("it aligned at median confidence ", F.format_string("%.2f", "median_conf"), f"; the bar is {MIN_MEDIAN_CONF} — the recording and the text may have drifted apart."))
        .when(F.col("span_coverage") < MIN_COVERAGE, text("only ", percent(F.col("span_coverage")), f" of the text between the first and last matched paragraph lined up; the bar is {bar(MIN_COVERAGE)} — somewhere in the middle the reading and the words part ways."))
        .when(cover < MIN_DOC_COVERAGE, text("only ", percent(cover), f" of the tale's paragraphs matched the recording; the bar is {bar(MIN_DOC_COVERAGE)} — it may cover just part of the tale."))
        .when(F.col("lead_s") > MAX_LEAD_S, text("the recording plays for ", F.floor(F.col("lead_s") + 0.5).cast("string"), f" seconds before the first paragraph it matched; the bar is {MAX_LEAD_S} — its opening didn't line up."))
        .when(gap("start_gap") > MAX_END_GAP, text("the narration starts ", percent(gap("start_gap")), f" of the way into the text; the bar is {bar(MAX_END_GAP)} — it may skip the tale's opening."))
        .otherwise(text("the narration stops ", percent(gap("end_gap")), f" short of the text's end; the bar is {bar(MAX_END_GAP)} — it may cover just part of the tale."))
    )


def verdicts(measures: DataFrame) -> DataFrame:
    """Adds pass, doc_coverage (three places), refusal (null where it passes) and the bars in force."""
    gates = F.struct(F.lit(MIN_MEDIAN_CONF).alias("minMedianConf"), F.lit(MIN_COVERAGE).alias("minCoverage"), F.lit(MIN_DOC_COVERAGE).alias("minDocCoverage"), F.lit(float(MAX_LEAD_S)).alias("maxLeadS"), F.lit(MAX_END_GAP).alias("maxEndGap"))
    return measures.withColumns({"pass": passes(), "doc_coverage": half_up(doc_coverage(), 1000), "refusal": F.when(~passes(), refusal()), "gates": gates})
