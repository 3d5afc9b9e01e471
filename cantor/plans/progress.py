"""Progress of stages: counts that a plan reports as a side effect of running, without a pass of their own."""

from __future__ import annotations

import sys
import time
from typing import TextIO

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Progress:
    """Watches DataFrames; lines tell what each stage saw once an action has run."""

    def __init__(self, out: TextIO = sys.stderr):
        self.out, self.seen, self.began = out, {}, time.monotonic()

    def watch(self, df: DataFrame, stage: str, **metrics: Column) -> DataFrame:
        """The same rows; counts them, and what else is asked for, as they pass."""
        self.seen[stage] = Observation(stage)
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()])

    def report(self) -> dict[str, dict]:
        """What the stages saw, written as a line each. Blocks until every watched plan has run."""
        told = {stage: o.get for stage, o in self.seen.items()}
        for stage, values in told.items():
            print(f"  {stage}: " + ", ".join(f"{k} {v}" for k, v in values.items()) + f" ({time.monotonic() - self.began:.0f} s)", file=self.out)
        return told
