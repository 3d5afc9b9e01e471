"""Brackets that are dealt to a task together are aligned as each alone."""

import numpy as np
import pytest

from cantor.operators import align
from cantor.plans import catalogue
from test_catalogue import FOLDER
from test_whole_jobs import RATIO, book, vocabulary


@pytest.mark.parametrize("dealt", [1, 3, 100])
def test_brackets_dealt_together_lie_where_they_were_planted(spark, monkeypatch, dealt):
    monkeypatch.setattr(align, "DEALT", dealt)
    said = vocabulary(150, 21)
    made, marks = book(said, said)
    text = spark.createDataFrame([(1, g, w) for g, w in enumerate(said)], "book_id long, g long, norm string")
    sound = spark.createDataFrame([(1, k, bytearray(x)) for k, x in enumerate(made.sound.blocks)], "book_id long, block long, logits binary")
    found = spark.createDataFrame([(1, k, g, marks[g]) for k, g in enumerate(range(0, 150, 15))], "book_id long, seq int, w0 long, f0 long")
    books = spark.createDataFrame([(1, RATIO, 150, len(made.sound), 25)], "book_id long, ratio double, n_words long, n_frames long, chunk long")
    placed = {r.g: r.bf for r in align.fine_align(align.brackets(found, books), text, sound, 500).collect()}
    assert len(placed) == 150 and np.all([placed[g] == marks[g] for g in range(150)])


@pytest.mark.parametrize("name", ["bracket_align", "chain_align"])
def test_words_and_sound_are_not_sent_through_the_driver(spark, name):
    """Their sizes are underrated, as functions make them: at any size that Spark supposes, no join may broadcast."""
    plan = catalogue.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan
