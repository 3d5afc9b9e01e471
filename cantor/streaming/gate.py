"""Verdicts over paragraphs as they arrive: the gate's measures per book, kept as state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.numbers import round_binary
from ..operators import gate

PARAGRAPH = "book_id long, paras int, ord int, body boolean, confs array<double>, lead_s double"
STATE = "paras int, lead_s double, ords array<int>, body array<boolean>, confs array<double>, unread int, unread_body int"
RESULT = "book_id long, paras int, placed int, median_conf double, span_coverage double, lead_s double, start_gap double, end_gap double, has_ends boolean"


def measured(book_id: int, paras: int, lead_s: float, ords: list[int], body: list[bool], confs: list[float], unread_body: int) -> dict:
    """The measures of what has arrived: ords and body tell of the placed paragraphs, unread_body of body paragraphs that aren't."""
    ordered = sorted(zip(ords, body, strict=True))
    placed, bodies = len(ordered), sum(b for _, b in ordered) + unread_body
    first, last = next((o for o, b in ordered if b), None), next((o for o, b in reversed(ordered) if b), None)
    gap = lambda n: None if n is None or not bodies else round_binary(n / bodies, 3)
    return {
        "book_id": book_id,
        "paras": paras,
        "placed": placed,
        "median_conf": sorted(confs)[len(confs) // 2] if confs else 0.0,
        "span_coverage": round_binary(placed / (ordered[-1][0] - ordered[0][0] + 1), 3) if placed else 0.0,
        "lead_s": round_binary(lead_s, 1),
        "start_gap": gap(None if first is None else first),
        "end_gap": gap(None if last is None else paras - 1 - last),
        "has_ends": True,
    }


def running(paragraphs: DataFrame) -> DataFrame:
    """A verdict per book and trigger, from all its paragraphs so far.

    paragraphs: PARAGRAPH rows of a stream; paras is the book's number of paragraphs, ord counts them from 0, confs is empty where the
    paragraph isn't placed. A paragraph that comes again replaces nothing: send each once. The state of a book is a few
    numbers per placed paragraph. Where a book's paragraphs are all of the body, ords are body numbers too.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        paras, lead, ords, body, confs, unread, unread_body = state.get if state.exists else (0, 0.0, [], [], [], 0, 0)
        ords, body, confs = list(ords), list(body), list(confs)
        first = min(ords, default=None)
        for f in frames:
            for row in f.itertuples(index=False):
                paras = int(row.paras)
                if len(row.confs):
                    ords.append(int(row.ord))
                    body.append(bool(row.body))
                    confs += [float(c) for c in row.confs]
                    if first is None or row.ord < first:
                        first, lead = int(row.ord), float(row.lead_s)
                else:
                    unread, unread_body = unread + 1, unread_body + bool(row.body)
        state.update((paras, lead, ords, body, confs, unread, unread_body))
        yield pd.DataFrame([measured(int(key[0]), paras, lead, ords, body, confs, unread_body)])

    measures = paragraphs.groupBy("book_id").applyInPandasWithState(step, RESULT, STATE, "update", GroupStateTimeout.NoTimeout)
    return gate.verdicts(measures).select("book_id", "placed", F.col("pass"), "doc_coverage", "refusal")
