"""Operators against plain versions of what they compute: marginals by enumeration, scores word by word, exact neighbours."""

import itertools
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cantor.llm import ann, langid, licenses, mixing, pii, stages
from test_contracts import FOLDER, rows_of

K = len(pii.LABELS)


def enumerated(field, unary, edges, skips):
    """Exact marginals: every labelling."""
    n = len(unary)
    total = np.zeros((n, K))
    for y in itertools.product(range(K), repeat=n):
        score = sum(unary[i, y[i]] for i in range(n)) + sum(field.chain[y[i], y[j]] for i, j in edges)
        score += sum(field.skip for i, j in skips if pii.KIND_OF[y[i]] == pii.KIND_OF[y[j]])
        for i in range(n):
            total[i, y[i]] += math.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def random_field(seed):
    rng = np.random.default_rng(seed)
    field = pii.Field()
    field.chain, field.skip, field.trained = rng.normal(0, 1, (K, K)), 2.0, True
    return field, rng


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("edges, skips", [([(0, 1), (1, 2)], []), ([(0, 1)], [(1, 3), (0, 2)]), ([], [(0, 1), (1, 2), (2, 3)])])
def test_marginals_are_exact_where_there_is_no_loop(seed, edges, skips):
    field, rng = random_field(seed)
    unary = rng.normal(0, 1, (4, K))
    got = field.marginals(unary, np.array(edges, int).reshape(-1, 2), np.array(skips, int).reshape(-1, 2))
    assert np.abs(got - enumerated(field, unary, edges, skips)).max() < 0.01


@pytest.mark.parametrize("seed", range(4))
def test_marginals_are_near_with_a_loop(seed):
    field, rng = random_field(seed)
    field.chain *= 0.5
    unary = rng.normal(0, 1, (4, K))
    edges, skips = [(0, 1), (1, 2), (2, 3)], [(0, 3)]
    got = field.marginals(unary, np.array(edges), np.array(skips))
    assert np.abs(got - enumerated(field, unary, edges, skips)).max() < 0.12


@pytest.fixture(scope="module")
def field():
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    return pii.Field().fit(texts)


REPEATS = (
    ("call +14155550123 tomorrow, or just 4155550123 maybe", "4155550123"),
    ("call +4930123456789 today and if nobody answers try 30123456789 later", "30123456789"),
    ("write to +49 30 12345678 today. Later on the note says 3012345678 again", "3012345678"),
)


@pytest.mark.parametrize("text, token", REPEATS)
def test_repeats_are_found_by_skip_links_and_not_without(field, text, token):
    added = lambda f: [text[a:b] for _, a, b in f.added(text, pii.base_spans(text))]
    assert added(field) == [token]
    alone = pii.Field()
    alone.__dict__.update(field.__dict__)
    alone.skip = 0.0
    assert added(alone) == []


def test_numbers_like_nothing_are_left_alone(field):
    for text in ("in 1984 there were 4155550123 grains, 12 of them red", "page 7, line 12, 1200 copies at 3.50 each", "mail @ noon 2024-01-01"):
        assert field.added(text, pii.base_spans(text)) == []


def test_added_spans_touch_no_base_span(field):
    for t, in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall():
        base = pii.base_spans(t)
        for _, a, b in field.added(t, base):
            assert a < b and not any(x < b and a < y for _, x, y in base)


def test_long_runs_have_nodes():
    text = '{"' + "x" * 200 + '":"4155550123","k":["someone@example.org",17]} and 99'
    assert [text[a:b] for a, b in pii.nodes(text)] == ["4155550123", "someone@example.org", "17", "99"]


def test_a_long_base_span_is_touched_wherever_it_starts():
    base = [(0, 0, 100), *((1, k, k + 1) for k in range(10, 40, 2))]
    assert pii._touches(*pii._ends_by_start(base), 90, 95)
    assert not pii._touches(*pii._ends_by_start(base), 100, 105)


def plain_prediction(model, text):
    """Word by word, gram by gram."""
    words = langid.words_of(text) if text else []
    if not words:
        return langid.UNKNOWN, 0.0
    total = np.zeros(len(model.labels))
    for w in words:
        if w in model.words:
            total += model.vectors[model.words[w]]
            continue
        edged, found = f"<{w}>", []
        for i in range(len(edged)):
            known = [edged[i : i + n] for n in range(model.longest, 0, -1) if i + n <= len(edged) and edged[i : i + n] in model.grams]
            found += [model.vectors[model.grams[known[0]]]] if known else []
        if found:
            total += sum(found) / math.sqrt(len(found))
    total /= math.sqrt(len(words))
    p = np.exp(total - total.max())
    return model.labels[int(total.argmax())], float(p.max() / p.sum())


def test_every_document_is_scored_as_plainly(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit(docs, F.col("doc_id") % 3 > 0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    for d, text, _ in rows_of("documents", "doc_id, text, lang"):
        label, score = plain_prediction(model, text)
        assert got[d][0] == label and abs(got[d][1] - score) < 1e-6


def clustered(n, d, groups, spread, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, d))
    x = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_clustered_vectors_need_few_lists(spark):
    x = clustered(20_000, 32, 400, 0.25)
    lists = round(ann.LISTS * math.sqrt(len(x)))
    model = ann.Quantiser(x[:16_000].astype(np.float32), lists)
    probes = ann.probes_for(x[:16_000].astype(np.float32), model, 20)
    own = ann._nearest(x.astype(np.float32), model.centroids)
    sizes = np.bincount(own, minlength=len(model.centroids))
    q = x[::200].astype(np.float32)
    best = np.argsort(-(q @ model.centroids.T), axis=1)[:, :probes]
    assert sizes[best].sum(axis=1).mean() <= 0.1 * len(x)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = {}
    for r in ann.search(vectors, F.col("vec_id") % 200 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    scores = x[::200] @ x.T
    scores[np.arange(100), np.arange(0, 20_000, 200)] = -9
    exact = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len(found[200 * i] & set(e.tolist())) for i, e in enumerate(exact))
    assert hits >= 0.9 * exact.size


def test_no_query_comes_back_short(spark):
    x = clustered(60, 8, 60, 1.0)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.search(vectors, F.col("vec_id") % 20 == 0, lists=60, probes=1).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in got} == {0: 20, 20: 20, 40: 20}


def test_shorter_vectors_end_in_zeros_and_clashing_columns_are_not_read(spark):
    rows = [(0, [1.0, 0.0, 1.0], "a", 1), (1, [1.0], "b", 2), (2, [0.0, 0.0, 3.0], "c", 3), (2, [0.0, 0.0, 2.0], "c", 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, list string, shard int")
    got = ann.search(vectors, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 3.0), (0, 2, 1, 1.0)]
    assert ann.search(vectors.where("vec_id > 9"), F.lit(True)).collect() == []


def test_large_means_spread_like_poisson(spark):
    docs = spark.createDataFrame([(i, "x" if i < 400 else "x" * 160_000, "small" if i < 400 else "large") for i in range(401)], "doc_id long, text string, source string")
    rows = mixing.replicate(docs, {"small": 0.5, "large": 0.5}, shuffle=False).where("source = 'small'").groupBy("doc_id").agg(F.first("copies").alias("n"), F.first("rate_ppm").alias("r")).collect()
    n, mean = np.array([r.n for r in rows]), rows[0].r / 1e6
    assert mean > 150
    assert abs(n.mean() - mean) < 4 * math.sqrt(mean / len(n)) and 0.8 < n.var() / mean < 1.2


def test_licence_tables_are_parameters(spark):
    docs = spark.createDataFrame([(1, "First line. You may copy this; but never sell it. The end."), (2, "never sell it. you may copy this.")], "doc_id long, text string")
    own = {"copy": "you may copy this", "sell": "but never sell it"}
    got = {r.doc_id: (r.sentence_ids, r.license) for r in licenses.scan(docs, sentences=own, rules=(("Own-1", ("copy", "sell")),), hint=None).collect()}
    assert got == {1: ("copy,sell", "Own-1"), 2: ("copy", None)}


EDGE = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "word " * 60_000 + "reach me at someone@example.org", "en", "a", 300_031),
    (4, "the house stands on the hill and the river runs below it", "en", "a", 56),
    (4, "the house stands on the hill and the river runs below it", "en", "a", 56),
    (4, "another text that has the same number as the one before it, of all things", "en", "b", 56),
    (5, "la maison est sur la colline et le fleuve coule en bas", "fr", "b", 54),
    (None, "the house stands on the hill and the river runs below it", "en", "b", 56),
]


def edge(spark, rows=EDGE):
    """With columns that bear names the operators use inside."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({"_body": F.lit("x"), "kept": F.lit(1), "copy": F.lit(2), "_text": F.lit("y"), "component_id": F.lit("z"), "tier": F.lit("t")})


ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


def test_language_stage_on_edges(spark):
    got = stages.identify_language(spark, edge(spark), "")
    assert got.columns == list(stages.COLUMNS)
    assert {r.doc_id for r in got.collect()} == {3, 4, 5, None}


def test_near_duplicate_stage_on_edges(spark):
    got = stages.drop_near_duplicates(spark, edge(spark), "")
    assert got.columns == list(stages.COLUMNS)
    assert ids(got) == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 4), (False, 5), (True, 0)]


def test_personal_data_stage_on_edges(spark):
    got = stages.redact_personal_data(spark, edge(spark), "").collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[1].n_chars is None and by[2].text == "" and by[2].n_chars == 0
    assert by[3].text.endswith("reach me at [EMAIL]")


def test_mixing_and_packing_stages_on_edges(spark):
    mixed = stages.mix_sources(spark, edge(spark), "")
    assert mixed.columns == list(stages.COLUMNS)
    assert {r.doc_id for r in mixed.collect()} <= {r[0] for r in EDGE}
    packed = stages.pack_sequences(spark, edge(spark), "").collect()
    whole = {}
    for r in packed:
        whole.setdefault((r.doc_id, r.doc_tokens), []).append(r.length)
    assert sum(map(sum, whole.values())) == sum(n * len(EDGE_ROWS) for n, EDGE_ROWS in tokens_of(packed).items())


def tokens_of(rows):
    """Documents by their number of tokens: a document's first piece starts at 0."""
    out = {}
    for r in rows:
        if r.start == 0:
            out.setdefault(r.doc_tokens, []).append(r.doc_id)
    return out


@pytest.mark.parametrize("name, stage", [(s.__name__, s) for s in (stages.identify_language, stages.drop_near_duplicates, stages.redact_personal_data, stages.mix_sources, stages.pack_sequences)])
def test_stages_of_an_empty_table(spark, name, stage):
    assert stage(spark, edge(spark, []), "").collect() == []


def test_pipeline_keeps_what_its_stages_keep(spark):
    """All rows of the last stage come from documents that a plain run of the deciding stages keeps."""
    import corpus_pipeline
    from test_contracts import brute_groups

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    named = stages.identify_language(spark, docs, FOLDER).collect()
    groups = brute_groups([(r.doc_id, r.text, r.lang) for r in named])
    packed = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").distinct().collect()}
    assert packed <= {r.doc_id for r in named}
    # Links at 0.85 are links at 0.80: of each such group one document at most is left.
    left = [c for d, (_, c) in groups.items() if d in packed]
    assert len(left) == len(set(left))
