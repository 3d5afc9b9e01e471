"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns have defined results."""

import pytest
from pyspark.sql import functions as F

from cantor.llm import ann, langid, licenses, minhash, mixing, packing, pii, quality, tokenscan, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, tier string, copies string"
LONG = "word " * 60_000 + "reach me at someone@example.org"
ROWS = [
    (1, None, None, None, None, "x", "y", "z"),
    (2, "", "en", "a", 0, "x", "y", "z"),
    (3, LONG, "en", "a", len(LONG), "x", "y", "z"),
    (4, "the house stands on the hill and the river runs below it", "en", "a", 56, None, None, None),
    (4, "the house stands on the hill and the river runs below it", "en", "a", 56, None, None, None),
    (5, "la maison est sur la colline et le fleuve coule en bas", "fr", "b", 54, None, None, None),
    (None, "the house stands on the hill and the river runs below it", "en", "b", 56, None, None, None),
    (6, " \t\n ", "en", "b", 4, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def seen(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


EVERY = sorted((r[0] is None, r[0] or 0) for r in ROWS)
PER_ROW = {
    "pii": lambda d: pii.find(d, pii.fit(d)),
    "licenses": licenses.scan,
    "tokens": tokenscan.token_counts,
    "langid": lambda d: langid.identify(d, langid.fit(d, F.lit(True))),
    "quality": quality.quality,
    "minhash": minhash.near_duplicates,
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_a_row_per_row(docs, name):
    assert seen(PER_ROW[name](docs)) == EVERY


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_no_row_without_rows(none, name):
    assert PER_ROW[name](none).collect() == []


def test_minhash_groups(docs):
    got = {(r.doc_id, r.n_shingles): r for r in minhash.near_duplicates(docs).collect()}
    assert got[(1, 0)].component_id == 1 and got[(2, 0)].component_id == 2 and got[(6, 0)].component_id == 6
    assert got[(4, 8)].component_id == 4 and got[(4, 8)].kept


def test_packing(docs, none):
    rows = packing.pack(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1
    assert packing.pack(none).collect() == []


def test_mixing(docs, none):
    rows = mixing.replicate(docs, {"a": 1.0, "b": 3.0}, budget=4.0).collect()
    assert all(r.copies >= r.copy >= 1 for r in rows)
    assert {r.doc_id for r in rows} <= {r[0] for r in ROWS}
    assert mixing.replicate(none).collect() == []


def test_mixing_by_hash_join_gives_the_same(docs, monkeypatch):
    def key(rows):
        return sorted(map(str, rows))

    small = key(mixing.replicate(docs, budget=3.0).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST", 0)
    assert key(mixing.replicate(docs, budget=3.0).collect()) == small


def test_archives(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "http://a/", ""), (3, "http://b/", "<p>x</p>"), (4, "http://b/", "<p>x</p>"), (5, "http://c/", "é" * 700_000)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert (got[1].record_type, got[1].refers_to, got[2].record_type) == ("revisit", 2, "response")
    assert (got[3].record_type, got[3].refers_to, got[5].payload_bytes) == ("revisit", 4, 1_400_000)
    assert warc.round_trip(pages.where("page_id < 0")).collect() == []


def test_vectors_that_take_no_part(spark):
    nan, v = float("nan"), [1.0, 0.5]
    rows = [(0, v), (1, v), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [2.0, 0.0]), (20, None)]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(found, key=lambda r: r.rank)] == [(0, 1, 6), (0, 2, 1)]


def test_separators_are_stitched_over_blocks(spark, tmp_path):
    import numpy as np

    ids = np.array([5, 6, 9, 9, 7, 7, 7, 7, 7, 9, 8], "<u2")
    (tmp_path / "t.bin").write_bytes(ids.tobytes())
    files = spark.createDataFrame([(f"file://{tmp_path}/t.bin",)], "file string")
    got = sorted(tuple(r)[1:] for r in tokenscan.scan(files, separator=9, block=4).collect())
    assert got == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 5, True), (3, 10, 1, False)]


def test_samples_are_drawn_where_ids_are_missing_or_repeated(spark):
    import hashlib

    late = next(i for i in range(1000) if hashlib.md5(str(i).encode()).hexdigest()[0] == "f")
    rows = [(None, f"mail {i} to a{i}@example.org again and again", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert pii.fit(docs, sample=2).trained
    model = langid.fit(docs, F.lit(True), sample=2)
    assert model.labels == ["en"] and "again" in model.words
    vectors = spark.createDataFrame([(late, [1.0, float(i)]) for i in range(200)] + [(-1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    [found] = ann.search(vectors, F.col("vec_id") == -1, sample=1, lists=1).collect()
    assert tuple(found) == (-1, 1, late, 200.0)
