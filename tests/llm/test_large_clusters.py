"""Clusters that are too large for all block pairs still give every link."""

import random

from cantor.llm import minhash
from cantor.llm.shingles import shingle_set


def template_texts(n, pairs, seed=5):
    """n texts that share a passage (similarity about 0.7); `pairs` of them have a twin at 0.85 or a little more."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**9)}"
    shared = " ".join(word() for _ in range(165))
    texts = []
    for k in range(n):
        own = [word() for _ in range(36)]
        texts.append(f"{shared} {' '.join(own)}")
        if k < pairs:
            texts.append(f"{shared} {' '.join(own[:21] + [word() for _ in range(15)])}")
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute(rows, part=100, of=85):
    """The component of each text by all pairs of sets, distinct texts only."""
    sets = {d: set(shingle_set(t).tolist()) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and part * (n := len(sets[a] & sets[b])) >= of * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def brute_fast(rows):
    """The same by counting common shingles of all pairs."""
    from collections import Counter, defaultdict

    sets, where = {d: shingle_set(t).tolist() for d, t in rows}, defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    everywhere = sum(len(ds) == len(sets) for ds in where.values())
    common = Counter((a, b) for ds in where.values() if len(ds) < len(sets) for i, a in enumerate(ds) for b in ds[i + 1 :])
    for (a, b), n in common.items():
        if 100 * (n + everywhere) >= 85 * (len(sets[a]) + len(sets[b]) - n - everywhere):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def test_pairs_of_a_large_cluster_are_all_found(spark):
    rows = template_texts(700, 60)
    wanted = brute(rows)
    assert sum(c != d for d, c in wanted.items()) == 60
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == wanted


def test_ten_thousand_different_texts_of_one_template(spark):
    rows = template_texts(9000, 1000)
    wanted = brute_fast(rows)
    assert sum(c != d for d, c in wanted.items()) == 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == wanted


def test_pairs_in_a_crowded_prefix_that_isnt_one_cluster():
    """Sketches that agree by half: too little to be alike, enough to share prefixes; pairs among them are joined."""
    import numpy as np

    rng, n, pairs = np.random.default_rng(3), 20_000, 2000
    shared = rng.integers(0, 256, minhash.SKETCH, dtype=np.uint8)
    sketches = np.where(rng.random((n, minhash.SKETCH)) < 0.5, shared, rng.integers(0, 256, (n, minhash.SKETCH), dtype=np.uint8))
    twins = np.where(rng.random((pairs, minhash.SKETCH)) < 0.85, sketches[:pairs], rng.integers(0, 256, (pairs, minhash.SKETCH), dtype=np.uint8))
    every, est = np.concatenate([sketches, twins]).astype(np.uint8), minhash.least_alike(85)
    alike = int(((every[:pairs] == twins).sum(axis=1) >= est).sum())
    found = {tuple(sorted(e)) for seed in range(minhash.TREES) for e in minhash._crowded(every, est, seed)}
    assert sum((k, n + k) in found for k in range(pairs)) >= 0.99 * alike
