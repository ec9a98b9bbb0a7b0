"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first search.

The tree is fitted on a bounded sample (``SAMPLE`` vectors, the first by a hash of their ids); every
vector is indexed: it descends to the nearest child until it reaches a leaf. A leaf's vectors are
dealt into packs of about ``PACK``, so that a leaf of any size (many copies of one vector) is many
packs. A query visits leaves in the order in which a priority queue of branches, keyed by the distance
to their centres, hands them out. How many it visits is calibrated: for ``CALIBRATION`` queries the true
neighbours are found by scanning all packs, and visits widen until ``RECALL`` of them are covered.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardtally.sources.workspace import stored

SAMPLE = 50_000
BRANCHES = 16
LEAF = 250
PACK = 2048
QUERIES = 512
CALIBRATION = 200
RECALL = 0.98
ROUNDS = 8
#: Vectors whose squared distance overflows are divided by this.
HUGE = 2.0**600


@dataclass
class Tree:
    """Nodes in one list: their centres, their children, and for leaves their number."""

    centre: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    def order(self, query: np.ndarray, most: int | None = None, held: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """Leaves in best-bin-first order, the first ``most``, and on until they hold ``least`` vectors (``held`` by leaf)."""
        branches, visited, seen = [(0.0, 0)], [], 0
        while branches and (most is None or len(visited) < most or seen < least):
            _, node = heapq.heappop(branches)
            kids = self.children[node]
            if not kids:
                visited.append(self.leaf[node])
                seen += held.get(self.leaf[node], 0) if held else 0
                continue
            for far, kid in zip(((self.centre[kids] - query) ** 2).sum(axis=1).tolist(), kids):
                heapq.heappush(branches, (far, kid))
        return visited

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector."""
        leaves = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                leaves[rows] = self.leaf[node]
                continue
            nearest = _nearest(vectors[rows], self.centre[kids])
            todo += [(kid, rows[nearest == i]) for i, kid in enumerate(kids) if (nearest == i).any()]
        return leaves


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def fit(sample: np.ndarray, leaves: int, branches: int = BRANCHES) -> Tree:
    """Splits the largest node by k-means until there are ``leaves`` leaves or nothing can be split."""
    rng = np.random.default_rng(7)
    centres, children = [sample.mean(axis=0)], [[]]
    heap, count = [(-len(sample), 0, np.arange(len(sample)))], 1
    while heap and count < leaves:
        _, node, rows = heapq.heappop(heap)
        points = np.unique(sample[rows], axis=0)
        if len(points) < 2:
            continue
        k = min(branches, len(points), leaves - count + 1)
        own = points[rng.choice(len(points), k, replace=False)]
        for _ in range(ROUNDS):
            nearest = _nearest(sample[rows], own)
            own = np.stack([sample[rows[nearest == i]].mean(axis=0) if (nearest == i).any() else own[i] for i in range(k)])
        nearest = _nearest(sample[rows], own)
        used = np.unique(nearest)
        if len(used) < 2:
            continue
        for i in used.tolist():
            children[node].append(len(centres))
            heapq.heappush(heap, (-int((nearest == i).sum()), len(centres), rows[nearest == i]))
            centres.append(own[i])
            children.append([])
        count += len(used) - 1
    numbers = iter(range(len(centres)))
    return Tree(np.stack(centres), children, [next(numbers) if not kids else -1 for kids in children])


def _leaves(tree: Tree):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.assign(np.stack(batch["v"].to_numpy()).astype(np.float64)))

    return rows


def _visits(tree: Tree, most: int, held: dict[int, int], least: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(leaf=[tree.order(np.asarray(v, np.float64), most, held, least) for v in batch["v"]])

    return rows


def _packed(group: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(group["v"].to_numpy()).astype(np.float64)
    return pd.DataFrame({"leaf": [group["leaf"].iloc[0]], "ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()]})


def _distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Squared distances, components added from the first to the last."""
    total = np.zeros((len(queries), len(vectors)))
    for i in range(queries.shape[1]):
        total += (queries[:, i][:, None] - vectors[:, i][None, :]) ** 2
    return total


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest of a pack, ties to the smaller id, without itself."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    frames = []
    for lo in range(0, len(query_ids), 128):
        own = query_ids[lo : lo + 128]
        with np.errstate(over="ignore"):
            far = np.sqrt(_distances(queries[lo : lo + 128], vectors))
            if np.isinf(far).any():  # squares overflow
                far = np.where(np.isinf(far), np.sqrt(_distances(queries[lo : lo + 128] / HUGE, vectors / HUGE)) * HUGE, far)
        far[own[:, None] == ids[None, :]] = np.nan
        kept = np.argsort(far, axis=1, kind="stable")[:, :k]
        number = np.repeat(np.arange(len(own)), kept.shape[1])
        score = far[number, kept.ravel()]
        real = ~np.isnan(score)
        frames.append(pd.DataFrame({"query_id": own[number][real], "vec_id": ids[kept.ravel()][real], "score": score[real]}))
    return pd.concat(frames, ignore_index=True)


def _unpacked(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, np.float64).reshape(len(ids), -1)


def _scan(query_ids: np.ndarray, queries: np.ndarray, k: int):
    """All packs against a small set of queries."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _best(query_ids, queries, *_unpacked(row.ids, row.vectors), k).assign(leaf=row.leaf)

    return rows


def _search(k: int):
    """Packs that were joined with the queries that visit them."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _best(*_unpacked(row.query_ids, row.queries), *_unpacked(row.ids, row.vectors), k)

    return rows


def _dealt(rows: DataFrame, id_column: str, size: int) -> DataFrame:
    """``rows`` with a number ``part`` that splits each leaf into parts of about ``size``."""
    parts = rows.groupBy("leaf").agg(F.ceil(F.count("*") / size).alias("_parts"))
    return rows.join(parts, "leaf").withColumn("part", F.pmod(F.xxhash64(id_column), "_parts")).drop("_parts")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of rows with an id and a finite vector that is not zero."""
    vector = F.col("embedding")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: nearest other rows, by Euclidean distance, of rows whose id is divisible by ``every``.

    ``vectors`` needs ``vec_id`` and ``embedding``. Rows with a null id, a null, empty or zero vector, or null
    or non-finite components take no part; rows only meet rows of their own length; repeated rows (of
    one id and vector) count once. Ties go to the smaller vec_id; with at most ``k`` candidates all are
    returned. Other columns are not looked at; an empty table gives an empty result.
    """
    rows = usable(vectors).dropDuplicates()
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    sizes = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}
    found = [_one_length(rows.where(F.col("dim") == dim).drop("dim"), n, every, k, recall) for dim, n in sorted(sizes.items())]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result.select("query_id", "rank", "vec_id", "score")


def _one_length(rows: DataFrame, n: int, every: int, k: int, recall: float) -> DataFrame:
    by_hash = rows.orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = np.array([r.v for r in by_hash.limit(SAMPLE).select("v").toLocalIterator()], np.float64)
    tree = fit(sample, max(1, min(n // LEAF, len(sample) // 8)))
    vector = "array<double>"
    indexed = rows.mapInPandas(_leaves(tree), f"vec_id long, v {vector}, leaf long")
    indexed = stored(indexed, "indexed")
    held = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    packs = _dealt(indexed, "vec_id", PACK).groupBy("leaf", "part").applyInPandas(_packed, "leaf long, ids binary, vectors binary")
    packs = stored(packs, "packs")
    queries = rows.where(F.col("vec_id") % every == 0)
    visits = calibrated(packs, queries, tree, k, recall)
    own = queries.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 0  # a query's own rows are no candidates

    routed = queries.mapInPandas(_visits(tree, visits, held, k + own), f"vec_id long, v {vector}, leaf array<long>")
    routed = stored(routed.select("vec_id", "v", F.explode("leaf").alias("leaf")), "routed")
    blocks = _dealt(routed, "vec_id", QUERIES).groupBy("leaf", "part").applyInPandas(_packed, "leaf long, ids binary, vectors binary")
    blocks = blocks.select("leaf", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))
    near = packs.join(blocks, "leaf").mapInPandas(_search(k), "query_id long, vec_id long, score double")
    return _ranked(near, k)


def calibrated(packs: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """Fewest leaf visits that cover ``recall`` of the true neighbours of some queries (scanned for in all packs)."""
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATION).collect()
    if not some:
        return 1
    ids, vectors = np.array([r.vec_id for r in some], np.int64), np.array([r.v for r in some], np.float64)
    scanned = packs.mapInPandas(_scan(ids, vectors, k), "query_id long, vec_id long, score double, leaf long")
    true = _ranked(scanned, k).select("query_id", "leaf").toPandas()
    place = {i: {leaf: at for at, leaf in enumerate(tree.order(v))} for i, v in zip(ids.tolist(), vectors)}
    needed = np.sort([place[q][leaf] + 1 for q, leaf in zip(true["query_id"], true["leaf"])])
    return int(needed[int(np.ceil(recall * len(needed))) - 1]) if len(needed) else 1
