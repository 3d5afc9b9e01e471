"""Stages of the pipeline against brute force, and the pipeline as a whole."""

import random

import pytest

from cantor.llm import minhash, stages
from test_large_clusters import brute


def texts_at(agreements, seed=3):
    """Pairs of texts of 200 words, of which the second has the first's beginning, to agree in so many hundredths."""
    rng = random.Random(seed)
    rows = []
    for a in agreements:
        # 196 shingles each, k of them in common: k / (392 - k).
        k = round(392 * a / (100 + a))
        one = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        two = one[: k + 4] + [f"w{rng.randrange(10**9)}" for _ in range(196 - k)]
        rows += [" ".join(one), " ".join(two)]
    return list(enumerate(rows))


def test_near_duplicates_stage_links_from_080(spark):
    rows = texts_at([*range(70, 100)] * 4)
    wanted = brute(rows, of=80)
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in stages.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {d for d, c in wanted.items() if c == d}
    assert len(kept) < len({d for d, c in brute(rows).items() if c == d})


def test_thresholds_give_the_forest():
    assert (minhash.least_prefix(85), minhash.least_alike(85)) == (5, 40)
    assert minhash.least_prefix(80) < 5 and minhash.least_alike(80) == 35


@pytest.mark.parametrize("of", [80, 85])
def test_groups_equal_all_pairs(spark, of):
    rows = texts_at([*range(70, 100)] * 2, seed=of)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, threshold=of).collect()} == brute(rows, of=of)
