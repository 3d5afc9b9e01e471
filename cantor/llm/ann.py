"""Approximate nearest neighbours: an inverted file with product-quantised residuals and exact reranking.

Fit: coarse centroids (about LISTS * sqrt(n) of them) and, for the residuals, PARTS codebooks of 256 entries, by k-means on
the rows with the smallest hash of their id: PER_LIST of them for each centroid, SAMPLE at least and MOST at most, so that there are at
most MOST / PER_LIST centroids (documented bounds; every row is indexed). Index: each row's list
and code, written. Lists are put into shards of at most SHARD rows; a list that is larger is dealt over several by
the id's hash, so a very common vector doesn't land in one task. Search: a query goes to the shards of its best lists (as
many as reach TARGET recall on the sample: few for clustered vectors, most for evenly spread ones; and as many as hold
twice the rows asked for, so that no query comes back short), in blocks of QUERIES; a shard adds up distance tables (asymmetric: the query isn't quantised) and
returns its NEAR best, ties to smaller ids. The RERANK best of a query are scored on the original vectors in
double precision.

Check: codes can't tell rows apart that lie closer together than the codebooks' entries, and the probes are a guess from the sample. So the k-th best score
found bounds what is missing: a list whose rows lie within a radius of its centroid holds nothing better for a query if
query . centroid + |query| * radius is below that score. A query goes to the shards of all other lists, and what reaches its
bound there is scored in the same way and joins what was found; so the result is that of brute force. Clustered vectors
leave out most lists; with evenly spread ones every query meets most rows.

Defined results: vectors that are null, zero, or hold a null or non-finite component take no part; shorter vectors are as
if they ended in zeros. Rows with a null id take no part either. Repeated ids are candidates once each: of the rows of one id the
nearest counts, and as a query each of them asks. Ties go to the smaller id. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize, smallest

SAMPLE, MOST, PER_LIST = 20_000, 200_000, 40
LISTS, PARTS, CODES = 2.0, 16, 256
SHARD, QUERIES, NEAR, RERANK = 2048, 1024, 50, 200
#: Lists are probed until so many of the true neighbours of TRIED sample rows, within the sample, lie in them.
TARGET, TRIED = 0.97, 256
ROUNDS = 10
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, v: the rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    rows = rows.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.withColumn("v", F.when(F.size("v") < longest, F.concat("v", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v")))).otherwise(F.col("v")))


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm; an empty cluster restarts at a random row."""
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[rng.integers(len(x), size=int((n == 0).sum()))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    own = np.empty(len(x), np.int64)
    half = (c * c).sum(1) / 2
    for k in range(0, len(x), 4096):
        own[k : k + 4096] = (x[k : k + 4096] @ c.T - half).argmax(1)
    return own


class Quantiser:
    """Coarse centroids and codebooks of the residuals."""

    def __init__(self, x: np.ndarray, lists: int, parts: int = PARTS, seed: int = 1):
        rng = np.random.default_rng(seed)
        x = np.unique(x.astype(np.float32), axis=0)
        self.centroids = _means(x, min(lists, len(x)), ROUNDS, rng)
        d = x.shape[1]
        self.cuts = np.linspace(0, d, min(parts, d) + 1).astype(int)
        rest = x - self.centroids[_nearest(x, self.centroids)]
        self.books = [_means(np.ascontiguousarray(rest[:, a:b]), min(CODES, len(x)), ROUNDS, rng) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = _nearest(x, self.centroids)
        rest = x - self.centroids[own]
        codes = np.stack([_nearest(np.ascontiguousarray(rest[:, a:b]), book) for a, b, book in zip(self.cuts, self.cuts[1:], self.books, strict=False)], 1)
        return own, codes.astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of a query's parts with every entry of the codebooks."""
        out = np.zeros((len(self.books), CODES), np.float32)
        for j, (a, b, book) in enumerate(zip(self.cuts, self.cuts[1:], self.books, strict=False)):
            out[j, : len(book)] = book @ q[a:b]
        return out


def probes_for(x: np.ndarray, model: Quantiser, k: int, target: float = TARGET) -> int:
    """How many lists to probe, measured on the sample."""
    x = np.unique(x, axis=0)
    q = x[np.random.default_rng(2).permutation(len(x))[:TRIED]]
    own = _nearest(x, model.centroids)
    place = np.argsort(np.argsort(-(q @ model.centroids.T), axis=1, kind="stable"), axis=1)
    near = q @ x.T
    near[(q[:, None, :1] == x[None, :, :1])[:, :, 0] & (near >= (q * q).sum(1)[:, None] * (1 - 1e-6))] = -np.inf  # the row itself
    top = np.argsort(-near, axis=1)[:, :k]
    needed = np.sort(np.take_along_axis(place, own[top], axis=1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(target * len(needed)))]) + 1 if len(needed) else 1


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float32)


def _exact(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _reach(q: np.ndarray, centroids: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """What no inner product of a query with a row within the radius of a centroid exceeds, rounding included."""
    long = np.linalg.norm(q, axis=1)[:, None]
    return q @ centroids.T + long * radius + 1e-9 * long * (np.linalg.norm(centroids, axis=1) + radius)


def _distinct(x: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Of equal rows, those with the `most` smallest ids, once each."""
    _, same = np.unique(x, axis=0, return_inverse=True)
    same = same.ravel()
    order = np.lexsort((ids, same))
    order = order[np.concatenate([[True], (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0)])]
    new = np.concatenate([[True], np.diff(same[order]) != 0])
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[place < most]


def _scores(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of q with rows j of x, added up from the first component to the last, so that equal rows score alike."""
    step = max(1, 4_000_000 // x.shape[1])
    return np.concatenate([np.cumsum(q[i[k : k + step]] * x[j[k : k + step]], axis=1)[:, -1] for k in range(0, len(i), step)] or [np.zeros(0)])


def reaching(asked: np.ndarray, q: np.ndarray, floor: np.ndarray, lists: np.ndarray, ids: np.ndarray, x: np.ndarray, centroids: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, vec_id, score: of the rows of some lists, those that reach a query's floor, its k best at most."""
    some = _distinct(x, ids, k + 1)
    some = some[np.argsort(lists[some], kind="stable")]
    lists, ids, x = lists[some], ids[some], x[some]
    room = (k + 1) * int(np.unique(ids, return_counts=True)[1].max())
    slack = 1e-9 * np.linalg.norm(q, axis=1)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(lists) != 0, [True]]))
    for a, b in zip(cuts, cuts[1:], strict=False):
        centre = centroids[lists[a]][None]
        away = np.linalg.norm(x[a:b] - centre, axis=1).max()
        open_ = np.flatnonzero(~(_reach(q, centre, away)[:, 0] < floor))
        if not len(open_):
            continue
        near = q[open_] @ x[a:b].T
        low, loose = floor[open_], slack[open_] * np.linalg.norm(x[a:b], axis=1).max()
        if b - a > room and (~(near < low[:, None])).sum() > room * len(open_):  # only the best of the list can be among the k
            low = np.maximum(low, np.partition(near, b - a - room, axis=1)[:, b - a - room])
        i, j = np.nonzero(~(near < (low - loose)[:, None]))
        left.append(open_[i])
        right.append(a + j)
    i, j = np.concatenate(left), np.concatenate(right)
    other = asked[i] != ids[j]
    i, j = i[other], j[other]
    found = pd.DataFrame({"query_id": asked[i], "vec_id": ids[j], "score": _scores(q, x, i, j)})
    return found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, probes: int | None = None, lists: int | None = None) -> DataFrame:
    """The k nearest by inner product found for each row where is_query (a condition on vec_id) holds.

    lists, probes: how many lists there are and how many a query searches, where they aren't to be found from the data.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    total = rows.count()
    if not total:
        return spark.range(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    lists = lists or max(1, min(round(LISTS * math.sqrt(total)), MOST // PER_LIST))
    sample = max(sample, min(MOST, PER_LIST * lists))
    hashed = rows.withColumn("h", F.md5(F.col("vec_id").cast("string")))
    learnt = smallest(hashed, total, sample, "h", "v").column("v").combine_chunks()
    model = Quantiser(_matrix(learnt), lists)
    probes = probes or probes_for(_matrix(learnt), model, k)
    shared = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, codes = shared.value.encode(_matrix(b.column(1)))
                away = np.linalg.norm(_exact(b.column(1)) - shared.value.centroids[own], axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(away), b.column(1)], names=["vec_id", "list", "code", "away", "v"])

    index = materialize(rows.select("vec_id", "v").mapInArrow(encode, "vec_id long, list int, code binary, away double, v array<double>"), "index")
    # Shards: similar lists side by side, whole where they fit.
    held = index.groupBy("list").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect()
    sizes, radii = {r["list"]: r["n"] for r in held}, {r["list"]: r["away"] for r in held}
    direction = model.centroids @ model.centroids[0]
    first, width, shard, room = {}, {}, 0, SHARD
    for own in sorted(sizes, key=lambda x: (float(direction[x]), x)):
        n = math.ceil(sizes[own] / SHARD)
        if n > 1 or sizes[own] > room:
            shard, room = shard + 1, SHARD
        first[own], width[own] = shard, n
        if n > 1:
            shard, room = shard + n, SHARD
        else:
            room -= sizes[own]
    plan = spark.sparkContext.broadcast((first, width, sizes, probes))
    # Per shard and in all, so many candidates go on; a query looks into lists with so many rows at least.
    near_most, rerank, least = max(NEAR, 2 * k), max(RERANK, 4 * k), 2 * (k + 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per query and shard: the query with the lists it wants there."""
        first, width, sizes, probes = plan.value
        centroids = shared.value.centroids
        held = np.array([x in first for x in range(len(centroids))])
        rows_of = np.array([sizes.get(x, 0) for x in range(len(centroids))])
        for b in batches:
            if not b.num_rows:
                continue
            q = _matrix(b.column(1))
            near = q @ centroids.T
            near[:, ~held] = -np.inf
            best = np.argsort(-near, axis=1, kind="stable")[:, : int(held.sum())]
            enough = np.maximum(probes, 1 + (np.cumsum(rows_of[best], axis=1) < least).sum(axis=1))
            out = ([], [], [], [])
            for i, query in enumerate(b.column(0).to_pylist()):
                wanted: dict[int, list[int]] = {}
                for own in best[i, : enough[i]].tolist():
                    for s in range(first[own], first[own] + width[own]):
                        wanted.setdefault(s, []).append(own)
                raw = q[i].tobytes()
                for s, lists in wanted.items():
                    for column, x in zip(out, (s, query, raw, lists), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.list_(pa.int32()))], names=["shard", "query_id", "q", "lists"])

    routed = materialize(rows.where(is_query).select("vec_id", "v").mapInArrow(route, "shard int, query_id long, q binary, lists array<int>"), "routed")
    places = spark.createDataFrame([(x, first[x], width[x]) for x in first], "list int, _first int, _width int")
    placed = index.select("vec_id", "list", "code").join(F.broadcast(places), "list").withColumn("shard", (F.col("_first") + F.pmod(F.xxhash64("vec_id"), F.col("_width"))).cast("int")).drop("_first", "_width")
    # Blocks of queries per shard: the shard's rows go to each of its blocks.
    blocks = materialize(routed.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("_blocks")), "blocks")
    asked = routed.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("_blocks")).cast("int")).drop("_blocks")
    kept = placed.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")

    def near(asked: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        model: Quantiser = shared.value
        kept = kept.sort_values(["list", "vec_id"], kind="stable").drop_duplicates(["list", "vec_id", "code"])
        lists, ids = kept["list"].to_numpy(), kept["vec_id"].to_numpy()
        codes = np.frombuffer(b"".join(kept["code"]), np.uint8).reshape(len(kept), -1).astype(np.int64) + np.arange(len(model.books)) * CODES
        queries, found, scores = [], [], []
        for query, raw, wanted in zip(asked["query_id"], asked["q"], asked["lists"], strict=True):
            q = np.frombuffer(raw, np.float32)
            spans = [(x, *np.searchsorted(lists, [x, x + 1])) for x in wanted]
            at = np.concatenate([np.arange(a, b) for _, a, b in spans]) if spans else np.zeros(0, int)
            at = at[ids[at] != query]
            if not len(at):
                continue
            score = model.tables(q).ravel()[codes[at]].sum(1) + (model.centroids @ q)[lists[at]]
            if len(at) > 4 * near_most:  # all that may be among the best, ties included
                some = np.flatnonzero(score >= np.partition(score, len(score) - near_most)[len(score) - near_most])
                at, score = at[some], score[some]
            best = np.lexsort((ids[at], -score))[:near_most]
            queries += [query] * len(best)
            found.append(ids[at][best])
            scores.append(score[best])
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "near": []}).astype({"query_id": "int64", "vec_id": "int64", "near": "float32"})
        return pd.DataFrame({"query_id": queries, "vec_id": np.concatenate(found), "near": np.concatenate(scores)})

    met = asked.groupBy("shard", "block").cogroup(kept.groupBy("shard", "block")).applyInPandas(near, "query_id long, vec_id long, near float")
    order = Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    # Written, so that the joins below deal plain rows: an id wanted by many queries can be split.
    chosen = materialize(met.withColumn("_r", F.row_number().over(order)).where(f"_r <= {rerank}").select("query_id", "vec_id").distinct(), "candidates")
    pairs = chosen.join(rows, "vec_id").select("query_id", "vec_id", "v").join(rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    exact = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = materialize(pairs.groupBy("query_id", "vec_id").agg(F.max(dot).alias("score")).withColumn("rank", F.row_number().over(exact)).where(F.col("rank") <= k).select("query_id", "vec_id", "score"), "found")
    reach = spark.sparkContext.broadcast((first, width, radii))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per query and shard with a list that may hold what the query is missing."""
        first, width, radii = reach.value
        lists = np.array(sorted(radii))
        centroids, radius = shared.value.centroids[lists].astype(np.float64), np.array([radii[x] for x in lists.tolist()])
        of_shard: dict[int, list[int]] = {}
        for at, own in enumerate(lists.tolist()):
            for s in range(first[own], first[own] + width[own]):
                of_shard.setdefault(s, []).append(at)
        for whole in batches:
            for b in (whole.slice(at, QUERIES) for at in range(0, whole.num_rows, QUERIES)):
                q, floor = _exact(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
                wanted = ~(_reach(q, centroids, radius) < floor[:, None])
                raw = pa.array([x.tobytes() for x in q], pa.binary())
                for s, own in of_shard.items():
                    some = pa.array(np.flatnonzero(wanted[:, own].any(axis=1)))
                    yield pa.RecordBatch.from_arrays([pa.array([s] * len(some), pa.int32()), b.column(0).take(some), raw.take(some), b.column(2).take(some)], names=["shard", "query_id", "q", "floor"])

    enough = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    floors = rows.where(is_query).withColumnRenamed("vec_id", "query_id").join(enough, "query_id", "left").select("query_id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    again = materialize(floors.mapInArrow(missing, "shard int, query_id long, q binary, floor double"), "missing")
    blocks = materialize(again.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("_blocks")), "blocks")
    asked = again.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("_blocks")).cast("int")).drop("_blocks")
    kept = index.select("vec_id", "list", "v").join(F.broadcast(places), "list").withColumn("shard", (F.col("_first") + F.pmod(F.xxhash64("vec_id"), F.col("_width"))).cast("int")).drop("_first", "_width")
    kept = kept.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")

    def checked(asked: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(kept):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q = np.stack([np.frombuffer(x, np.float64) for x in asked["q"]])
        return reaching(asked["query_id"].to_numpy(), q, asked["floor"].to_numpy(), kept["list"].to_numpy(), kept["vec_id"].to_numpy(), np.stack(kept["v"]), shared.value.centroids.astype(np.float64), k)

    more = asked.groupBy("shard", "block").cogroup(kept.groupBy("shard", "block")).applyInPandas(checked, "query_id long, vec_id long, score double")
    return found.union(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(exact)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
