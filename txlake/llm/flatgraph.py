"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Equal vectors enter once, with a weight. Every vector goes to the clusters of its
nearest centroids; a cluster is cut into shards of bounded size, and each shard
builds a graph whose edges are pruned robustly (a neighbour is dropped when a kept
one is closer to it than the vector itself, by a factor). The adjacency lists of a
vector from all its shards are united. A query starts at a shard's medoid, follows
edges greedily with a beam, and goes on from every vector in range until none is
left unexpanded. What is found is verified in double precision. Recall is audited
against brute force on a fixed number of queries; below the aim the search is
repeated wider.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import slices
from txlake.llm.graph import components
from txlake.sources.shared import stage


@dataclass(frozen=True)
class Graph:
    """Rows the centroids are fitted on, cluster and shard sizes, clusters a vector is in and asks, edges, beam, audit."""

    sample: int = 16384
    most_clusters: int = 4096
    cluster_rows: int = 256
    shard_rows: int = 512
    overlap: int = 3
    asked: int = 2
    degree: int = 24
    pool: int = 48
    slack: float = 1.2
    beam: int = 64
    audited: int = 256
    aim: float = 0.98
    attempts: int = 3


def usable(vector: str) -> Column:
    """Not null, not empty, not zero, without null or non-finite components."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def unit(rows: list | pd.Series, width: int) -> np.ndarray:
    """Vectors of length one in double precision; shorter ones are padded with zeros."""
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
    x /= np.abs(x).max(axis=1, keepdims=True, initial=1e-300)  # huge components don't overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means of a sample, started at its first rows, which are in hash order."""
    c = x[:k].copy()
    for _ in range(6):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def robust_prune(x: np.ndarray, nodes: np.ndarray, pool: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Neighbours of each of ``nodes`` among its row of ``pool`` (-1: none), nearest first, padded with -1.

    A candidate goes when one that was kept is nearer to it, by the factor ``slack``, than the node is.
    """
    there = pool >= 0
    away = np.where(there, np.maximum(1 - np.einsum("npd,nd->np", x[pool], x[nodes]), 0), np.inf)
    order = np.argsort(away, axis=1, kind="stable")
    pool, away = np.take_along_axis(pool, order, 1), np.take_along_axis(away, order, 1)
    points = x[pool]
    between = np.maximum(1 - points @ points.transpose(0, 2, 1), 0) * np.float32(slack * slack)  # 1 - cos goes with the squared distance
    alive = pool >= 0
    for i in range(pool.shape[1]):
        keep = alive[:, i] & (alive[:, :i].sum(axis=1) < degree)
        alive[:, i] = keep
        alive[:, i + 1 :] &= ~keep[:, None] | (between[:, i, i + 1 :] > away[:, i + 1 :])
    alive = np.where(alive, np.arange(pool.shape[1]), pool.shape[1])
    kept = np.sort(alive, axis=1)[:, :degree]
    return np.where(kept < pool.shape[1], np.take_along_axis(pool, np.minimum(kept, pool.shape[1] - 1), 1), -1)


def build(x: np.ndarray, g: Graph) -> list[np.ndarray]:
    """The adjacency lists of one shard, with edges both ways, pruned to twice the degree."""
    n, x = len(x), x.astype(np.float32)
    near = min(n - 1, g.pool)
    if near < 1:
        return [np.zeros(0, np.int64)] * n
    drawn = np.random.default_rng(n)
    out: list[np.ndarray] = []
    for begin in range(0, n, 256):
        nodes = np.arange(begin, min(n, begin + 256))
        close = x[nodes] @ x.T
        close[np.arange(len(nodes)), nodes] = -np.inf
        pool = np.argpartition(-close, near - 1, axis=1)[:, :near]
        far = drawn.integers(0, n, (len(nodes), g.pool // 4))  # a few long edges
        far[(far == nodes[:, None]) | (far[:, :, None] == pool[:, None, :]).any(axis=2)] = -1
        out += list(robust_prune(x, nodes, np.concatenate([pool, far], axis=1), g.degree, g.slack))
    pairs = np.array([(i, j) for i, e in enumerate(out) for j in e if j >= 0], np.int64).reshape(-1, 2)
    pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    lists = np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, n)))
    first = np.array([e[0] for e in out])
    for i, e in enumerate(lists):
        if len(e) > 2 * g.degree:
            kept = robust_prune(x, np.array([i]), e[None, :], 2 * g.degree, 1.0)[0]
            # those whose nearest neighbour this is stay, so that an edge leads to every node
            lists[i] = np.union1d(kept[kept >= 0], np.flatnonzero(first == i))
    return lists


def search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, cosine: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row of x) pairs within range, block by block; ``edges`` is padded with -1."""
    n = len(x)
    medoid = int((x @ x.sum(axis=0)).argmax())
    width, rest = min(16, n), max(0, n - beam)
    rough, floor = x.astype(np.float32), np.float32(cosine - 1e-4)
    for begin in range(0, len(queries), 256):
        q = queries[begin : begin + 256].astype(np.float32)
        near = np.full((len(q), n), -np.inf, np.float32)
        near[:, medoid] = q @ rough[medoid]
        fresh = near.copy()  # what was seen and not expanded
        going = np.arange(len(q))
        while len(going):
            left = fresh[going]
            best = np.argpartition(-left, width - 1, axis=1)[:, :width]
            value = np.take_along_axis(left, best, axis=1)
            last = np.partition(near[going], rest, axis=1)[:, rest]
            row, col = np.nonzero((value > -np.inf) & (value >= np.minimum(last, floor)[:, None]))
            asking, at = going[row], best[row, col]
            fresh[asking, at] = -np.inf
            going = np.unique(asking)
            to = edges[at]
            a, b = np.repeat(asking, to.shape[1]), to.ravel()
            unseen = (b >= 0) & (near[a, b] == -np.inf)
            seen = np.zeros((len(q), n), bool)
            seen[a[unseen], b[unseen]] = True
            a, b = np.nonzero(seen)
            found = np.einsum("ij,ij->i", q[a], rough[b])
            near[a, b] = found
            fresh[a, b] = found
        a, b = np.nonzero(near >= floor)
        sure = np.einsum("ij,ij->i", queries[a + begin], x[b]) >= cosine  # in double precision
        yield a[sure] + begin, b[sure]


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray) -> np.ndarray:
    """The smallest id that each of n rows reaches by the pairs."""
    low = ids.copy()
    while True:
        before = low.copy()
        for a, b in pairs:
            least = np.minimum(low[a], low[b])
            np.minimum.at(low, a, least)
            np.minimum.at(low, b, least)
        if np.array_equal(before, low):
            return low


def _search_shards(classes: DataFrame, width: int, cosine: float, g: Graph) -> DataFrame:
    """``node, links, root`` from every shard: weights of the found, and the smallest node reached there."""
    n = classes.count()
    k = int(min(g.most_clusters, max(1, -(-n // g.cluster_rows))))
    first = classes.orderBy(F.xxhash64("node"), "node").limit(g.sample).select("vec").toPandas()["vec"]  # bounded by g.sample
    centre = centroids(unit(list(first), width), min(k, len(first)))
    overlap = min(g.overlap, len(centre))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            near = np.argsort(-(unit(batch.column("vec").to_pylist(), width) @ centre.T), axis=1, kind="stable")[:, :overlap]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.tolist(), pa.list_(pa.int32()))], names=[*batch.schema.names, "clusters"])

    placed = classes.select("node", "weight", "vec").mapInArrow(assign, "node long, weight long, vec array<float>, clusters array<int>")
    placed = stage(placed, "clusters")
    members = placed.select("node", "weight", "vec", "clusters", F.posexplode("clusters").alias("rank", "cluster"))
    # a row for each of at most g.most_clusters clusters
    sizes = stage(members.groupBy("cluster").agg(
        F.ceil(F.count("*") / g.shard_rows).cast("int").alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.sum((F.col("rank") < g.asked).cast("int")) / g.shard_rows)).cast("int").alias("blocks"),
    ), "sizes")
    members = members.join(F.broadcast(sizes), "cluster").withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))

    def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        ids = pdf["node"].to_numpy()
        return pd.DataFrame({"node": ids, "near": [ids[e] for e in build(unit(list(pdf["vec"]), width), g)]})

    lists = members.groupBy("cluster", "shard").applyInPandas(build_shard, "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    united = stage(united, "adjacency")
    at = members.join(united, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = members.where(F.col("rank") < g.asked).withColumn("block", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int")).drop("shard")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    columns = ["cluster", "shard", "block", "node", "weight", "vec", "clusters"]
    asked = asked.withColumn("clusters", F.slice("clusters", 1, F.col("rank")))  # asked before, so counted there
    asked = asked.select(*[F.col(c).alias(c) for c in columns])  # apart from the members it is grouped with

    def search_shard(held: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if held.empty or query.empty:
            return pd.DataFrame({"node": [], "links": [], "root": []})
        held = held.sort_values("node", ignore_index=True)
        x, q = unit(list(held["vec"]), width), unit(list(query["vec"]), width)
        ids, asked_ids, weight = held["node"].to_numpy(), query["node"].to_numpy(), held["weight"].to_numpy()
        lists = []
        for near in held["near"]:
            near = np.asarray(near, np.int64)
            at = np.minimum(np.searchsorted(ids, near), len(ids) - 1)
            lists.append(at[ids[at] == near])  # edges to other shards end outside
        edges = np.full((len(ids), max(1, *map(len, lists))) if lists else (0, 1), -1, np.int64)
        for i, e in enumerate(lists):
            edges[i, : len(e)] = e
        links = np.zeros(len(q), np.int64)
        inside = np.array(held["clusters"].tolist(), np.int64).reshape(len(ids), -1)
        before = np.full((len(q), max(1, g.asked - 1)), -1, np.int64)
        for i, c in enumerate(query["clusters"]):
            before[i, : len(c)] = c
        pairs = []
        for a, b in search(x, edges, q, cosine, g.beam):
            other = asked_ids[a] != ids[b]
            a, b = a[other], b[other]
            new = ~(inside[b][:, :, None] == before[a][:, None, :]).any(axis=(1, 2))
            links += np.bincount(a[new], weight[b[new]], len(q)).astype(np.int64)
            pairs.append((a, b + len(q)))
        root = _roots(len(q) + len(ids), pairs, np.concatenate([asked_ids, ids]))
        nodes = np.concatenate([asked_ids, ids])
        counted = np.concatenate([links, np.zeros(len(ids), np.int64)])
        told = (counted > 0) | (root < nodes)
        return pd.DataFrame({"node": nodes[told], "links": counted[told], "root": root[told]})

    keys = ["cluster", "shard", "block"]
    held = at.select(*columns, "near").groupBy(*keys)
    return held.cogroup(asked.groupBy(*keys)).applyInPandas(search_shard, "node long, links long, root long")


def audit(classes: DataFrame, counted: DataFrame, width: int, cosine: float, g: Graph) -> float:
    """Links found over links there are, for a fixed number of vectors against all, by brute force."""
    asked = classes.join(counted, "node", "left").select("node", "vec", F.coalesce("links", F.lit(0)).alias("links"))
    asked = asked.orderBy(F.xxhash64(F.lit(2), "node"), "node").limit(g.audited).toPandas()
    if asked.empty:
        return 1.0
    q, ids = unit(list(asked["vec"]), width), asked["node"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            near = unit(batch.column("vec").to_pylist(), width) @ q.T >= cosine
            near &= batch.column("node").to_numpy()[:, None] != ids
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("weight").to_numpy() @ near)], names=["links"])

    there = classes.select("node", "weight", "vec").mapInArrow(run, "links long").agg(F.sum("links")).collect()[0][0] or 0
    return float(asked["links"].sum() / there) if there else 1.0


def near_duplicates(rows: DataFrame, cosine: float = 0.9, g: Graph = Graph()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``.

    ``n_links`` counts the other rows with a cosine of ``cosine`` or more. Vectors that are
    null, empty or zero, or hold null or non-finite components, link with nothing,
    nor do rows with a null ``vec_id``; shorter vectors count as padded with zeros;
    equal vectors always link; other columns are ignored; an empty table gives no
    rows. The index leaves out no row; see ``audit`` for what the search may miss.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(usable("vec") & F.col("vec_id").isNotNull(), F.lit(False)))
    valid = rows.where("ok")
    classes = stage(valid.groupBy("vec").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), "vectors")
    width = classes.agg(F.max(F.size("vec"))).collect()[0][0] or 0
    found = classes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))
    counted = found.select("node", "links")
    for _ in range(g.attempts if width else 0):  # without a usable vector there is nothing to search
        found = stage(_search_shards(classes, width, cosine, g), "found")
        counted = stage(found.groupBy("node").agg(F.sum("links").alias("links")), "counted")
        if audit(classes, counted, width, cosine, g) >= g.aim:
            break
        g = replace(g, overlap=2 * g.overlap, beam=2 * g.beam, degree=2 * g.degree, pool=2 * g.pool)
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = classes.join(counted, "node", "left").join(joined.withColumnRenamed("id", "node"), "node", "left")
    per_class = per_class.select(
        "vec",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    linked = valid.join(stage(per_class, "classes"), "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
