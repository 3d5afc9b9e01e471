"""Near-duplicate documents by an LSH forest: several sorted orders of minimum-hash signatures.

1. A pass over the texts gives each document its shingle set's size, digest and signature (not the set).
2. Documents with equal sets fall together by digest; the smallest id stands for them. The rest works on these.
3. Forest: each representative has a row in each of TREES orders, keyed by DEPTH signature bytes. The rows of all
   orders are sorted in one range-partitioned sort, so no prefix, however common, lands in one task. Neighbours with
   a common prefix of at least least_prefix() bytes form a region. A region of up to REGION rows is compared on its sketches of
   SKETCH bytes, row by row; a larger one goes on deeper: its sketches are sorted by ROUNDS orders of their own, and each
   row is compared with the NEAR rows that share the longest prefix with it. Pairs that look alike enough to be links
   (least_alike(), five standard deviations under the threshold) are thinned to a spanning forest of all that the task has seen.
4. The forest's pairs give coarse clusters. They are a net to be searched, not a result. Every pair of a cluster of up
   to BLOCK documents is compared on its full shingle sets, in one task. Of a larger cluster, the forest's own pairs are compared
   first, each hub with its members. What that leaves in several parts is compared by a prefix filter: of two sets that are
   a link, the first common shingle, in one order of all of the cluster's shingles, is among the first few of both, so
   pairs are found by joining on those, dealt by shingle. The order puts common shingles last. No link is left out at any
   size; only pairs of one part, which add nothing, are passed over.
5. Confirmed links give the components; copies get their representative's.

Each text is sent once to the task that compares its cluster (in clusters over BLOCK about twice, and once more for each tile in
which it has a possible partner). Nothing of it is collected to the driver but a few counts.

Defined results: null, empty and blank texts have an empty set, are linked with nothing and are kept. Repeated rows
(equal ids) share sets and get equal results; ties don't matter, as links have no order. A null id is kept as a
component of its own, null. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize, short_batches
from .components import components
from .shingles import mix, shingle_set

#: Links: PART * intersection >= threshold * union, with the threshold in hundredths; OF unless one is given.
PART, OF = 100, 85
TREES, DEPTH, REGION = 20, 12, 256
SKETCH = 64
#: Chance, at most, that a pair at the threshold shares no region in any tree.
MISSED = 1e-5
BLOCK = 256
#: In a crowded region: orders of the sketches, bytes they are sorted by, and how many neighbours a row is compared with.
ROUNDS, SORTED, NEAR = 4, 24, 8
#: A shingle that more than a COMMON-th of a cluster's documents have is put behind the others.
COMMON = 20
#: Rows that a task sorting through the forest holds of one region before it is cut.
HELD = 50_000
#: Documents whose pairs such a task remembers, to leave out pairs that join nothing new.
KNOWN = 200_000
#: Incidence columns per step of the exact comparison.
COLUMNS = 2048

_N = TREES * DEPTH + SKETCH
_A = (mix(np.arange(1, _N + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(_N + 1, 2 * _N + 1, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def least_prefix(of: int) -> int:
    """LEAST: the longest common prefix, in bytes, that pairs at the threshold miss in all trees by MISSED at most."""
    return max(k for k in range(1, DEPTH + 1) if k == 1 or (1 - (of / PART) ** k) ** TREES <= MISSED)


def least_alike(of: int) -> int:
    """EST: sketch bytes that agree, five standard deviations under what is expected of a pair at the threshold."""
    p = of / PART
    return int(SKETCH * p - 5 * (SKETCH * p * (1 - p)) ** 0.5)


def signature(shingles: np.ndarray) -> bytes:
    """A byte per minimum hash: TREES keys of DEPTH bytes, then the sketch."""
    low = np.full(_N, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k in range(0, len(x), 1024):
            np.minimum(low, (x[k : k + 1024, None] * _A + _B).min(axis=0), out=low)
    return (mix(low.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, digests, signs = [], [], []
        for text in b.column(1):
            s = shingle_set(text.as_py())
            sizes.append(len(s))
            with np.errstate(over="ignore"):
                # The hashes are spread evenly, so that sums of two mixes of them tell sets apart.
                digests.append(np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)]).tobytes())
            signs.append(signature(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "digest", "sign"])


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _join(pairs, n: int) -> list[int]:
    """The root of each of n items; the smallest of each group."""
    parent = list(range(n))
    for i, j in pairs:
        a, b = _find(parent, int(i)), _find(parent, int(j))
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [_find(parent, i) for i in range(n)]


def _alike(sketches: np.ndarray, est: int) -> np.ndarray:
    """Pairs of rows whose sketches agree in est bytes or more."""
    n = len(sketches)
    if n == 2:
        return np.array([[0, 1]] if np.count_nonzero(sketches[0] == sketches[1]) >= est else [], np.int64).reshape(-1, 2)
    found = []
    for k in range(0, n, 64):
        same = (sketches[k : k + 64, None, :] == sketches[None, :, :]).sum(axis=2, dtype=np.uint16)
        i, j = np.nonzero(same >= est)
        found.append(np.stack([i + k, j], 1))
    pairs = np.concatenate(found)
    return pairs[pairs[:, 0] < pairs[:, 1]]


class _Joined:
    """Which of n rows are joined, and the pairs that joined them."""

    def __init__(self, n: int):
        self.root, self.edges = np.arange(n), []

    def apart(self, pairs: np.ndarray) -> np.ndarray:
        """Those of the pairs that would join something."""
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return pairs[self.root[pairs[:, 0]] != self.root[pairs[:, 1]]]

    def join(self, pairs: np.ndarray) -> None:
        root = self.root
        for i, j in self.apart(pairs).tolist():
            a, b = _find(root, i), _find(root, j)
            if a != b:
                root[max(a, b)] = min(a, b)
                self.edges.append((i, j))


def _hubs(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs (hub, member) that join what the pairs join: the row with most partners first."""
    joined = _Joined(n)
    while len(pairs):
        hub = int(np.bincount(pairs.ravel(), minlength=n).argmax())
        mine = pairs[(pairs == hub).any(axis=1)].sum(axis=1) - hub
        joined.join(np.stack([np.full(len(mine), hub), mine], 1))
        pairs = joined.apart(pairs)
    return joined.edges


def _crowded(sketches: np.ndarray, est: int, seed: int) -> list[tuple[int, int]]:
    """Pairs that join rows of a large region: the sketches sorted in several orders, each row compared with its neighbours."""
    rng, joined = np.random.default_rng(seed), _Joined(len(sketches))
    for _ in range(ROUNDS):
        keys = np.ascontiguousarray(sketches[:, rng.permutation(SKETCH)[:SORTED]]).view(">u8")
        order = np.lexsort(keys.T[::-1])
        s = sketches[order]
        for step in range(1, NEAR + 1):
            alike = np.flatnonzero((s[:-step] == s[step:]).sum(axis=1, dtype=np.uint8) >= est)
            joined.join(np.stack([order[alike], order[alike + step]], 1))
    return joined.edges


def _pairs_of_region(sketches: np.ndarray, est: int, seed: int) -> list[tuple[int, int]]:
    n = len(sketches)
    return [] if n < 2 else _hubs(_alike(sketches, est), n) if n <= REGION else _crowded(sketches, est, seed)


def _forest(batches: Iterator[pa.RecordBatch], of: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by tree and key: key binary (the tree first), sketch binary, doc_id long.

    Result: pairs that look alike and join something new in this task (alike, as hub and member), and what was joined, as pairs of a
    group's smallest id and the id that stood for a part of it until then (not alike).
    """
    width, least, est = 1 + DEPTH, least_prefix(of), least_alike(of)
    held: list[np.ndarray] = []
    parent: dict[int, int] = {}
    sent: list[tuple[int, int, bool]] = []

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def flush(rows: list[np.ndarray]):
        if sum(map(len, rows)) > 1:
            m = np.concatenate(rows)
            was = set()
            for i, j in _pairs_of_region(m["sketch"], est, int(m["key"][0, 0])):
                x, y = int(m["id"][i]), int(m["id"][j])
                a, b = root(x), root(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    was |= {a, b}
                    sent.append((x, y, True))
            sent.extend((now, old, False) for old in was if (now := root(old)) != old)
            if len(parent) > KNOWN:
                parent.clear()

    def out():
        pairs = np.array(sent, np.int64).reshape(-1, 3)
        sent.clear()
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(pairs[:, 2] > 0)], names=["a", "b", "alike"])

    kind = np.dtype([("id", np.int64), ("key", np.uint8, (width,)), ("sketch", np.uint8, (SKETCH,))])
    last = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        m = np.zeros(n, kind)
        m["id"] = b.column(2).to_numpy(zero_copy_only=False)
        m["key"] = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(n, width)
        m["sketch"] = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(n, SKETCH)
        prefix = np.ascontiguousarray(m["key"][:, : 1 + least])
        new = np.flatnonzero((prefix[1:] != prefix[:-1]).any(axis=1)) + 1
        cuts = [0, *new.tolist(), n]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low or last != prefix[0].tobytes():
                flush(held)
                held = []
            held.append(m[low:high])
            if sum(map(len, held)) > HELD:
                flush(held)
                held = [np.concatenate(held)[-REGION:]]
        last = prefix[-1].tobytes()
        if len(sent) > 50_000:
            yield from out()
    flush(held)
    yield from out()


def exact_pairs(sets: list[np.ndarray], part: int = PART, of: int = OF) -> np.ndarray:
    """Pairs with part * intersection >= of * union, on full sets."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1  # a shingle of one document adds to no intersection
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    top = int(column[-1]) + 1 if len(column) else 0
    for k in range(0, top, COLUMNS):
        low, high = np.searchsorted(column, [k, k + COLUMNS])
        x = np.zeros((n, min(COLUMNS, top - k)), np.float32)
        x[owner[low:high], column[low:high] - k] = 1
        common += x @ x.T
    inter = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    i, j = np.nonzero(part * inter >= of * union)
    return np.stack([i, j], 1)[i < j]


def _confirm(batches: Iterator[pa.RecordBatch], of: int) -> Iterator[pa.RecordBatch]:
    """Batches sorted by group: g, doc_id, text. Result: a star of confirmed links per component of each group.

    A task holds the shingle sets of one group, of BLOCK documents at most (8 bytes a shingle).
    """
    group, ids, sets = None, [], []

    def links():
        a, b = [], []
        if len(ids) > 1:
            for i, r in enumerate(_join(exact_pairs(sets, of=of), len(ids))):
                if i != r:
                    a.append(ids[r])
                    b.append(ids[i])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for g, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if g != group:
                yield links()
                group, ids, sets = g, [], []
            ids.append(doc_id)
            sets.append(shingle_set(text.as_py()))
    yield links()


def _dealt(clusters: DataFrame, alike: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """g, node: the groups whose documents are compared first; and component, node of the clusters over BLOCK.

    Of a large cluster each document goes with the hub, of those it was found alike with, that was found alike most often.
    """
    sizes = materialize(clusters.groupBy("component").agg(F.count("*").alias("n")).where(f"n > {BLOCK}"), "sizes")
    named = clusters.join(sizes, "component", "left")
    small = named.where("n is null").select(F.concat_ws(":", F.lit("c"), "component").alias("g"), "node")
    if not sizes.limit(1).count():
        return small, None
    big = materialize(named.where("n is not null").select("component", "node"), "big")
    seen = materialize(alike.groupBy("a", "b").agg(F.count("*").alias("k")).join(big.select(F.col("node").alias("a")), "a"), "alike")
    degrees = seen.groupBy("a").agg(F.sum("k").alias("_d"))
    best = seen.join(degrees, "a").groupBy("b").agg(F.max_by("a", F.struct("_d", "a")).alias("a"))
    per = best.groupBy("a").agg(F.ceil(F.count("*") / (BLOCK // 2)).cast("int").alias("_k"))
    # A hub with its members, at most about BLOCK at a time.
    stars = materialize(best.join(per, "a").withColumn("g", F.concat_ws(":", F.lit("h"), "a", F.pmod(F.xxhash64("b"), F.col("_k")))).select("g", "a", "b"), "stars")
    return small.union(stars.select("g", F.col("b").alias("node"))).union(stars.select("g", F.col("a").alias("node")).distinct()), big


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches: some columns, the last of them text. Result: the text's shingles instead of it."""
    for b in batches:
        for i in range(b.num_rows):
            s = shingle_set(b.column(b.num_columns - 1)[i].as_py())
            yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in b.columns[:-1]), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], names=[*b.schema.names[:-1], "shingles"])


def _prefixes(batches: Iterator[pa.RecordBatch], of: int) -> Iterator[pa.RecordBatch]:
    """Batches: cluster, part, node, minor, tiles, shingles, common, often. Result: a row per shingle of each set's prefix.

    Shingles are ordered by how many documents of the cluster have them, those of up to a COMMON-th of them first, as one class; then by value.
    """
    for b in batches:
        columns: list[list] = [[], [], [], [], [], [], [], []]
        for i, row in enumerate(zip(*(b.column(k).to_pylist() for k in range(5)), strict=True)):
            s = np.array(b.column(5)[i].values)
            common, often = np.array(b.column(6)[i].values, np.int64), np.array(b.column(7)[i].values, np.int64)
            rank = np.zeros(len(s), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                rank = np.where(common[at] == s, often[at], 0)
            first = len(s) - -(-len(s) * of // PART) + 1
            chosen = s[np.lexsort((s, rank))[:first]]
            for column, value in zip(columns, (*row, len(s)), strict=False):
                column += [value] * len(chosen)
            columns[6] += chosen.tolist()
            columns[7] += range(1, len(chosen) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if k == 3 else pa.int64()) for k, c in enumerate(columns)], names=["cluster", "part", "node", "minor", "tiles", "size", "s", "place"])


def _rest(big: DataFrame, found: DataFrame, texts: DataFrame, threshold: int) -> DataFrame | None:
    """g, node: groups that hold every possible link between different parts of clusters; None if all are in one part.

    big: component, node; found: components of the links so far; texts: node, text.

    Of two sets with PART * intersection >= threshold * union each has threshold / PART of its shingles in common with the other, so
    that the first common one is among the first size - ceil(threshold * size / PART) + 1 of both. A pair has one side at least
    outside its cluster's largest part: that side goes to every block of a shingle's documents, so that no shingle, however
    common, lands in one task. Counts of shingles are added up before they are shuffled; sets themselves never are.
    """
    named = big.select(F.col("component").alias("cluster"), "node").join(found.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    sizes = named.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    split = sizes.groupBy("cluster").agg(F.max_by("part", F.struct("n", "part")).alias("major"), F.count("*").alias("parts"), F.sum("n").alias("_all")).where("parts > 1")
    split = materialize(split, "split")
    if not split.limit(1).count():
        return None
    tiles = F.ceil(F.col("_all") / (BLOCK // 2))
    # Written, so that the join with the texts knows how few they are.
    rows = materialize(named.join(split, "cluster").select("cluster", "part", "node", (F.col("part") != F.col("major")).alias("minor"), tiles.alias("tiles")), "rows_of_rest")
    head = "cluster long, part long, node long, minor boolean, tiles long"
    # A repeated id may have several texts: each is a row.
    sets = materialize(rows.join(texts, "node").select("cluster", "part", "node", "minor", "tiles", "text").mapInArrow(_shingles, f"{head}, shingles array<long>"), "sets_of_rest")
    often = sets.select("cluster", F.explode("shingles").alias("s")).groupBy("cluster", "s").agg(F.count("*").alias("often"))
    common = often.join(split.select("cluster", "_all"), "cluster").where(f"often * {COMMON} > _all").groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("s", "often"))).alias("_c"))
    common = materialize(common.select("cluster", F.transform("_c", lambda x: x["s"]).alias("common"), F.transform("_c", lambda x: x["often"]).alias("often")), "common")
    none = F.array().cast("array<bigint>")
    ranked = sets.join(common, "cluster", "left").select("cluster", "part", "node", "minor", "tiles", "shingles", F.coalesce("common", none).alias("common"), F.coalesce("often", none).alias("often"))
    first = materialize(ranked.mapInArrow(partial(_prefixes, of=threshold), f"{head}, size long, s long, place long"), "prefixes")
    # Shingles that lie in one part only join nothing new.
    useful = first.groupBy("cluster", "s").agg(F.min("part").alias("_low"), F.max("part").alias("_high"), F.count("*").alias("n")).where("_low < _high")
    dealt = materialize(first.join(useful.select("cluster", "s", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), ["cluster", "s"]), "dealt")
    one = dealt.select(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("_b"), "cluster", "s", "part", "node", "size", "place", "tiles")
    other = dealt.where("minor").select(F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_b"), "cluster", "s", *(F.col(c).alias(f"{c}2") for c in ("part", "node", "size", "place")))
    # Common shingles are at most this one, those before it in both and those after it in both.
    most = F.least("place", "place2") + F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
    possible = (F.lit(PART) * most >= F.lit(threshold) * (F.col("size") + F.col("size2") - most)) & (F.lit(PART) * F.least("size", "size2") >= F.lit(threshold) * F.greatest("size", "size2"))
    pairs = one.hint("merge").join(other, ["cluster", "s", "_b"]).where((F.col("part") != F.col("part2")) & possible)
    # Pairs are compared in tiles: one block of the cluster with another.
    tile, tile2 = F.pmod(F.xxhash64("node"), F.col("tiles")), F.pmod(F.xxhash64("node2"), F.col("tiles"))
    g = F.concat_ws(":", F.lit("r"), "cluster", F.least(tile, tile2), F.greatest(tile, tile2))
    return pairs.select(g.alias("g"), F.explode(F.array("node", "node2")).alias("node")).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = OF) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of the input. threshold: in hundredths."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signs = materialize(texts.mapInArrow(_sign, "doc_id long, n_shingles long, digest binary, sign binary"), "signs")
    usable = signs.where("n_shingles > 0 and doc_id is not null")
    # Equal sets: the smallest id stands for all.
    same = usable.groupBy("digest", "n_shingles", "sign").agg(F.min("doc_id").alias("rep"))
    same = materialize(same, "same")
    rows = same.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))).select(
        F.concat(F.unhex(F.lpad(F.hex("_t"), 2, "0")), F.substring("sign", F.col("_t") * DEPTH + 1, F.lit(DEPTH))).alias("key"),
        F.substring("sign", F.lit(TREES * DEPTH + 1), F.lit(SKETCH)).alias("sketch"),
        F.col("rep").alias("doc_id"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = rows.repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id")
    coarse = materialize(order.mapInArrow(partial(_forest, of=threshold), "a long, b long, alike boolean"), "coarse")
    clusters = components(coarse.where("not alike").select("a", "b"))
    # Exact links within the clusters.
    groups, big = _dealt(clusters, coarse.where("alike").select("a", "b"))
    # A repeated id stands once; its rows may differ, and each goes with its own set's representative.
    named = texts.withColumnRenamed("doc_id", "node")

    def confirmed(groups: DataFrame) -> DataFrame:
        sent = materialize(groups, "groups").join(named, "node").select("g", "node", "text")
        return materialize(sent.repartition(parts, "g").sortWithinPartitions("g").mapInArrow(partial(_confirm, of=threshold), "a long, b long").distinct(), "links")

    links = confirmed(groups)
    found = components(links)
    if big is not None and (rest := _rest(big, found, named, threshold)) is not None:
        found = components(links.union(confirmed(rest)))
    lasting = same.select("digest", "n_shingles", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.col("n_shingles").alias("_n"), F.least("rep", F.coalesce("component", "rep")).alias("_c"))
    # Only sets that aren't alone are looked up; the rest are their own component.
    lasting = materialize(lasting, "sets")
    joined = signs.drop("sign").join(lasting, (signs["digest"] == lasting["digest"]) & (signs["n_shingles"] == lasting["_n"]), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
