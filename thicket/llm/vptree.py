"""Nearest neighbours by vantage-point trees, one a shard, with relaxed triangle-inequality pruning.

Vectors are compared on the unit sphere, where the distance sqrt(2 - 2 cos) is a metric and grows as the cosine
falls. A vantage-point tree over a bounded sample cuts the sphere into regions, and every row has its region; a region of
many rows is several shards. A query goes to its own region first. What it has found there bounds how far its
neighbours can be, and it goes on to those regions alone that the triangle inequality does not exclude: each region
knows how near and how far its rows are to the vantage points above it. A shard's tree is built once in the task that
reads the shard, and the queries stream past it in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

SLACK = 1e-7  # rounding of distances near zero; never prunes on less


def row_sums(a: np.ndarray) -> np.ndarray:
    """Sums over the last axis, strictly left to right, so that a score depends on its two vectors only."""
    out = np.zeros(a.shape[0])
    for k in range(a.shape[1]):
        out += a[:, k]
    return out


class VPTree:
    """Unit vectors in a binary tree; each node splits its points at the median distance from one of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 256, seed: int = 7):
        self.ids, self.raw = ids, vectors
        self.norms = np.sqrt(row_sums(vectors * vectors))
        self.unit = vectors / self.norms[:, None]
        self.order = np.arange(len(ids))
        self.leaf, self.rng = leaf, np.random.default_rng(seed)
        self.root = self._build(0, len(ids))

    def _build(self, lo: int, hi: int):
        if hi - lo <= self.leaf:
            return (lo, hi)
        part = self.order[lo:hi]
        point = self.unit[part[self.rng.integers(len(part))]]
        far = distance(self.unit[part] @ point)
        mid = len(part) // 2
        at = np.argpartition(far, mid)
        self.order[lo:hi] = part[at]
        inner, outer = far[at[:mid]].max(), far[at[mid:]].min()
        return (point, inner, outer, self._build(lo, lo + mid), self._build(lo + mid, hi))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float, floor: np.ndarray | None = None) -> Found:
        found = Found(query_ids, queries, k, floor)
        self._visit(self.root, np.arange(len(query_ids)), found, factor)
        return found

    def _visit(self, node, at: np.ndarray, found: Found, factor: float) -> None:
        if not len(at):
            return
        if len(node) == 2:
            found.offer(at, self, self.order[node[0] : node[1]])
            return
        point, inner, outer, left, right = node
        far = distance(found.unit[at] @ point)
        near = far <= (inner + outer) / 2
        self._visit(left, at[near], found, factor)
        self._visit(right, at[~near], found, factor)
        self._visit(right, at[near][factor * (outer - far[near]) <= found.reach(at[near]) + SLACK], found, factor)
        self._visit(left, at[~near][factor * (far[~near] - inner) <= found.reach(at[~near]) + SLACK], found, factor)


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class Found:
    """The k best of each query so far, by score, then smaller id. ``floor``: scores that k others are known to reach.
    ``compared`` counts pairs of a query and a vector."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.query_ids, self.raw, self.k, self.compared = ids, queries, k, 0
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor
        self.norms = np.sqrt(row_sums(queries * queries))
        self.unit = queries / self.norms[:, None]
        self.score = np.full((len(ids), k), -np.inf)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max)

    def reach(self, at: np.ndarray) -> np.ndarray:
        worst = np.maximum(self.score[at, -1], self.floor[at])
        return np.where(np.isfinite(worst), distance(worst), np.inf)

    def offer(self, at: np.ndarray, tree: VPTree, points: np.ndarray) -> None:
        """Screens all pairs by a matrix product and scores those that may enter a list exactly."""
        self.compared += len(at) * len(points)
        for lo in range(0, len(at), 512):
            some = at[lo : lo + 512]
            rough = self.unit[some] @ tree.unit[points].T
            rough[self.query_ids[some][:, None] == tree.ids[points][None, :]] = -np.inf
            bar = np.maximum(self.score[some, -1], self.floor[some])
            if len(points) > self.k:
                bar = np.maximum(bar, np.partition(rough, len(points) - self.k, axis=1)[:, len(points) - self.k])
            q, p = np.nonzero((rough >= bar[:, None] - 1e-9) & np.isfinite(rough))
            if len(q):
                self._merge(some, q, points[p], tree)

    def _merge(self, some: np.ndarray, q: np.ndarray, p: np.ndarray, tree: VPTree) -> None:
        scores = np.empty(len(q))
        for lo in range(0, len(q), 65536):
            s = slice(lo, lo + 65536)
            a, b = some[q[s]], p[s]
            scores[s] = row_sums(self.raw[a] * tree.raw[b]) / (self.norms[a] * tree.norms[b])
        who = np.concatenate([np.repeat(np.arange(len(some)), self.k), q])
        score = np.concatenate([self.score[some].ravel(), scores])
        ids = np.concatenate([self.id[some].ravel(), tree.ids[p]])
        order = np.lexsort((ids, -score, who))
        who, score, ids = who[order], score[order], ids[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        keep = rank < self.k
        self.score[some[who[keep]], rank[keep]] = score[keep]
        self.id[some[who[keep]], rank[keep]] = ids[keep]


class Regions:
    """Leaves of a vantage-point tree over a sample of unit vectors, halved ``depth`` times; where all are alike, less."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 7):
        self.points: list[np.ndarray] = []
        self.paths: list[list[int]] = []  # the vantage points above each region
        self.rng = np.random.default_rng(seed)
        self.root = self._build(sample, depth, [])

    def _build(self, some: np.ndarray, depth: int, path: list[int]):
        if depth and len(some) > 1:
            point = some[self.rng.integers(len(some))]
            far = distance(some @ point)
            radius = np.median(far)
            inner = far <= radius
            if 0 < inner.sum() < len(some):
                self.points.append(point)
                path = [*path, len(self.points) - 1]
                return (path[-1], radius, self._build(some[inner], depth - 1, path), self._build(some[~inner], depth - 1, path))
        self.paths.append(path)
        return len(self.paths) - 1

    def distances(self, unit: np.ndarray) -> np.ndarray:
        return distance(unit @ np.array(self.points).T) if self.points else np.zeros((len(unit), 0))

    def assign(self, far: np.ndarray) -> np.ndarray:
        """The region of each vector, from its ``distances``."""
        out = np.zeros(len(far), dtype=np.int32)

        def walk(node, at: np.ndarray) -> None:
            if isinstance(node, int):
                out[at] = node
            elif len(at):
                inner = far[at, node[0]] <= node[1]
                walk(node[2], at[inner])
                walk(node[3], at[~inner])

        walk(self.root, np.arange(len(far)))
        return out

    def least(self, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How near any row of each region can be to each vector: ``low`` and ``high`` bound the distances of a region's rows
        to each vantage point (region by point; minus and plus infinity where it knows none)."""
        out = np.zeros((len(far), len(low)))
        for p in range(far.shape[1]):
            np.maximum(out, np.maximum(low[None, :, p] - far[:, p, None], far[:, p, None] - high[None, :, p]), out=out)
        return out


def _units(vectors: list) -> np.ndarray:
    v = np.array(vectors, dtype=np.float64)
    return v / np.sqrt(row_sums(v * v))[:, None]


def _by_dim(batch: pd.DataFrame, regions: dict[int, Regions]) -> Iterator[tuple[pd.DataFrame, Regions, np.ndarray]]:
    for dim, part in batch.groupby("dim"):
        own = regions.get(int(dim)) or Regions(np.zeros((0, 0)), 0)
        yield part, own, own.distances(_units(part["vector"].tolist()))


PLACED = "id long, vector array<double>, dim int, region int, far array<double>"


def _place(regions: dict[int, Regions]):
    """For mapInPandas: each vector's region, and its distances to the vantage points above that region."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, own, far in _by_dim(batch, regions):
                at = own.assign(far)
                yield part.assign(region=at, far=[far[k, own.paths[r]] for k, r in enumerate(at)])

    return run


def _route(regions: dict[int, Regions], edges: dict[int, tuple[np.ndarray, np.ndarray]], factor: float):
    """For mapInPandas: the other regions that each query has to be sent to, beyond its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, own, far in _by_dim(batch, regions):
                least = own.least(far, *edges[int(part["dim"].iloc[0])])
                floor = part["floor"].to_numpy()
                reach = np.where(np.isfinite(floor), distance(np.where(np.isfinite(floor), floor, 0.0)), np.inf)
                go = factor * least <= reach[:, None] + SLACK
                go[np.arange(len(part)), part["region"].to_numpy()] = False
                q, r = np.nonzero(go)
                out = part.iloc[q]
                yield out.assign(region=r.astype(np.int32))[["id", "vector", "dim", "region", "floor"]]

    return run


def _search(k: int, factor: float, leaf: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, tree, ids, vectors = None, None, [], []
        for batch in batches:
            keys = list(zip(batch["dim"], batch["region"], batch["shard"], batch["is_query"], strict=True))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                now, is_query = keys[lo][:3], keys[lo][3]
                if now != shard:
                    shard, tree, ids, vectors = now, None, [], []
                some_ids = batch["id"].to_numpy()[lo:hi]
                some = np.array(batch["vector"].iloc[lo:hi].tolist(), dtype=np.float64)
                if not is_query:
                    ids.append(some_ids)
                    vectors.append(some)
                    continue
                if tree is None and ids:
                    tree = VPTree(np.concatenate(ids), np.concatenate(vectors), leaf)
                    ids, vectors = [], []
                if tree is not None:
                    found = tree.search(some_ids, some, k, factor, batch["floor"].to_numpy()[lo:hi])
                    real = np.isfinite(found.score)
                    yield pd.DataFrame({"query_id": np.repeat(some_ids, real.sum(axis=1)), "vec_id": found.id[real], "score": found.score[real]})

    return run


def nearest(df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, factor: float = 1.0, shard_rows: int = 8192, leaf: int = 256, sample: int = 4096, region_rows: int = 1024) -> DataFrame:
    """The ``k`` rows of ``df`` with the largest cosine to each row of ``queries``: ``query_id, rank, vec_id, score``.

    ``factor`` stretches the lower bounds that prune regions and subtrees: 1 gives exact results, more prunes more. Scores
    are exact in double precision, summed left to right; ties go to the smaller id. A query is not its own
    neighbour (rows with its id are left out). Rows without an id take no part, nor do vectors that are null,
    empty, zero, or hold null or non-finite components; vectors of different lengths never meet. Repeated ids
    are candidates of their own; of query rows that repeat an id the least vector counts. Empty tables give no rows.

    ``sample`` rows, and for each region the bounds of its distances, come to the driver. There are about a region for
    each ``region_rows`` rows, ``sample`` / 32 at most; a region of more than ``shard_rows`` rows is several shards,
    dealt by hash, so that a task holds one shard of about that size, whatever the input and however many vectors are
    alike.
    """
    def sound(table: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
        return table.where(F.col(key).isNotNull() & v.isNotNull() & F.coalesce(good, F.lit(False))).select(F.col(key).cast("long").alias("id"), v.alias("vector"), F.size(v).alias("dim"))

    rows, asked = sound(df), sound(queries).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    found = rows.groupBy("dim").count().collect()
    depth = {r["dim"]: max(0, int(np.log2(max(1, min(r["count"] // region_rows, sample // 32))))) for r in found}
    seen: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("dim", "vector").collect():
        seen.setdefault(r["dim"], []).append(r["vector"])
    regions = {d: Regions(_units(seen[d]) if d in seen else np.zeros((0, d)), depth[d]) for d in depth}
    placed = rows.mapInPandas(_place(regions), PLACED).withColumn("row", F.monotonically_increasing_id())
    placed = materialize(placed, "nearest-rows")
    edges = {d: (np.full((len(x.paths), len(x.points)), -np.inf), np.full((len(x.paths), len(x.points)), np.inf)) for d, x in regions.items()}
    for r in placed.select("dim", "region", F.posexplode("far").alias("at", "far")).groupBy("dim", "region", "at").agg(F.min("far").alias("low"), F.max("far").alias("high")).collect():
        point = regions[r["dim"]].paths[r["region"]][r["at"]]
        edges[r["dim"]][0][r["region"], point], edges[r["dim"]][1][r["region"], point] = r["low"], r["high"]
    sizes = placed.groupBy("dim", "region").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    sizes = materialize(sizes, "nearest-regions")  # small, and known to be
    dealt = placed.join(sizes, ["dim", "region"]).select("id", "vector", "dim", "region", F.pmod(F.xxhash64("id", "row"), "shards").cast("int").alias("shard"), F.lit(False).alias("is_query"), F.lit(float("-inf")).alias("floor"))

    def search(sent: DataFrame) -> DataFrame:
        there = dealt.join(sent.select("dim", "region").distinct(), ["dim", "region"], "left_semi")
        each = sent.join(sizes, ["dim", "region"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        met = there.unionByName(each.select("id", "vector", "dim", "region", "shard", F.lit(True).alias("is_query"), "floor"))
        met = met.repartition("dim", "region", "shard").sortWithinPartitions("dim", "region", "shard", "is_query", "id")
        return met.mapInPandas(_search(k, factor, leaf), "query_id long, vec_id long, score double")

    def best(some: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    asked = asked.where(F.col("dim").isin(*regions)) if regions else asked.where("false")
    home = materialize(asked.mapInPandas(_place(regions), PLACED).drop("far"), "nearest-queries")
    first = materialize(best(search(home.withColumn("floor", F.lit(float("-inf"))))), "nearest-first")
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    known = home.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    sent = materialize(known.mapInPandas(_route(regions, edges, factor), "id long, vector array<double>, dim int, region int, floor double"), "nearest-sent")
    return best(first.drop("rank").unionByName(search(sent)))


def op7(spark, sf_dir: str) -> DataFrame:
    """Of ``embeddings``, the 5 nearest to each row whose id is divisible by 50, exact."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS norm FROM v),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda a, b: a + b) / (q.norm * c.norm) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
