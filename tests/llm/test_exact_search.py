"""The search returns what brute force does, where codes and probes alone don't tell rows apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cantor.llm import ann


def nearly_equal(rng):
    """Rows about a few directions, nearer together than the codebooks' entries."""
    x = rng.normal(size=(5, 16))[rng.integers(5, size=4000)]
    return x + 1e-3 * rng.normal(size=x.shape)


def of_all_lengths(rng):
    return rng.normal(size=(4000, 16)) * rng.lognormal(0, 2, size=(4000, 1))


def tied(rng):
    """Few whole numbers: most scores are shared by many rows."""
    x = rng.integers(0, 2, size=(4000, 8))
    x[:, 0] = 1
    return x


@pytest.mark.parametrize("made", [nearly_equal, of_all_lengths, tied])
def test_search_finds_what_brute_force_does(spark, made):
    x = made(np.random.default_rng(3)).astype(np.float32).astype(float)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(vectors, F.col("vec_id") % 200 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in range(0, 4000, 200):
        scores = np.cumsum(x * x[q], axis=1)[:, -1]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(4000), -scores))[:20]
        assert got[q] == [(int(i), float(scores[i])) for i in best]
