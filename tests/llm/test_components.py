"""Connected components against a plain version: every link is joined a few times, however many links a group has."""

import random
from collections import defaultdict

from cantor.llm import components as module


def plain(links):
    near = defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    found = {}
    for start in sorted(near):
        todo = [] if start in found else [start]
        while todo:
            if (x := todo.pop()) not in found:
                found[x] = start
                todo += near[x]
    return found


def test_links_fall_together_as_nodes_do(spark, monkeypatch):
    """Twenty orders of a group of near copies, each with another hub, and links told twice and both ways round."""
    rng = random.Random(1)
    links = [(hub, x) for hub in rng.sample(range(1000), 20) for x in rng.sample(range(1000), 700) if x != hub]
    links = links + links[:5000] + [(b, a) for a, b in links[:5000]]
    written = []
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: written.append((name, got := keep(df, name))) or got)
    found = module.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == plain(links)
    rows = [df.count() for name, df in written if name == "edges"]
    distinct = len({frozenset(x) for x in links})
    assert rows[0] == distinct and sum(rows) < 1.1 * distinct


def test_paths_and_scattered_links(spark):
    rng = random.Random(2)
    ids = rng.sample(range(10**6), 1500)
    links = [(k, k + 1) for k in range(-300, 0)] + list(zip(ids[:400], ids[1:400])) + [tuple(rng.sample(ids[400:], 2)) for _ in range(700)] + [(5 * 10**6, 5 * 10**6)]
    rng.shuffle(links)
    found = module.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r.node for r in found}) and {r.node: r.component for r in found} == plain(links)
    assert module.components(spark.createDataFrame([], "a long, b long")).collect() == []
