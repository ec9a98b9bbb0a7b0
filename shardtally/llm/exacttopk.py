"""Exact top-k inner products by distributed histogram selection.

Vectors become integers, so scores are integers and every comparison is exact. Candidates lie in
packs of up to ``PACK`` vectors, ``GROUP`` packs or so to a group; queries lie in blocks of up to ``BLOCK``, and
every block visits every group of its dimension. A group's packs come first in its sorted rows,
then the blocks one by one, so a task holds a group and a block, however many there are of either. How
far each query's search has come is a row of a table. Each pass is one job for all queries:

1. A pass counts scores per query in equal bins of the range that can still hold the k-th score. A
   group passes on only the bins from the top down to its own k-th score: the global k-th cannot lie
   lower. The summed histogram gives the bin of the global k-th score; the next pass looks into that
   bin, until a bin is one score.
2. Candidates that tie at the k-th score are selected the same way by their ids, smallest first.
3. A last pass keeps what lies above the k-th score, and of its ties those up to the last id: k rows
   a query, which are then ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardtally.sources.workspace import stored

SCALE = 1024
BLOCK = 512
BINS = 4096
PACK = 2048
GROUP = 32
PACKED = "dim long, n long, top long, lo long, hi long, ids binary, vectors binary"
STATE = ["lo", "hi", "need", "id_lo", "id_hi"]


def _integers(vector: Column) -> Column:
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & fine, whole)


def _packs(size: int):
    """Vectors of one length behind one another, in rows of ``PACKED``, each in the smallest integers that hold it."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["v"].map(len)
            for dim, same in batch.groupby(lengths):
                for at in range(0, len(same), size):
                    part = same.iloc[at : at + size]
                    vectors = np.stack(part["v"].to_numpy()).astype(np.int64)
                    ids = part["vec_id"].to_numpy(np.int64)
                    top = max(int(vectors.max()), -int(vectors.min()))
                    vectors = vectors.astype(next(t for t in (np.int16, np.int32, np.int64) if top <= np.iinfo(t).max))
                    yield pd.DataFrame({"dim": [dim], "n": [len(ids)], "top": [top], "lo": [ids.min()], "hi": [ids.max()], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()]})

    return rows


class _Block:
    """A block of queries, and where each one's search stands: its k-th score is in [lo, hi], the last tie's id in [id_lo, id_hi]."""

    def __init__(self, row):
        self.ids, self.vectors = _matrix(row)
        self.lo, self.hi, self.need, self.id_lo, self.id_hi = (np.array([s[c] for s in row.state], np.int64) for c in STATE)
        self.exact_in_double = row.reach < 2**53

    def scores(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Scores with a row per query; a query's own row scores below all."""
        if self.exact_in_double:
            scores = (self.vectors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
        else:
            scores = self.vectors.astype(np.int64) @ vectors.T.astype(np.int64)
        scores[self.ids[:, None] == ids[None, :]] = np.iinfo(np.int64).min
        return scores


def _matrix(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    size = len(row.vectors) // (len(ids) * int(row.dim))
    return ids, np.frombuffer(row.vectors, f"<i{size}").reshape(len(ids), -1)


def _spread(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """hi - lo where hi >= lo; ids may be further apart than a long reaches."""
    return hi.astype(np.uint64) - lo.astype(np.uint64)


def _tail(counts: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Bins (best first) up to the one in which the wanted number is reached."""
    before = np.cumsum(counts, axis=1) - counts
    return (counts > 0) & (before < need[:, None])


def _meeting(visit, empty: pd.DataFrame):
    """Rows sorted by group, packs before blocks: ``visit(block row, packs)`` for every block of a group."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, packs = None, []
        yield empty
        for batch in batches:
            for row in batch.itertuples(index=False):
                if group != (row.dim, row.group):
                    group, packs = (row.dim, row.group), []
                if row.block < 0:
                    packs.append(_matrix(row))
                elif packs:
                    yield visit(row, packs)

    return rows


def _histogram(by_id: bool):
    """A pass: rows (block, query number, bin, count), bins numbered from the best."""

    def visit(row, packs: list) -> pd.DataFrame:
        block = _Block(row)
        q = len(block.ids)
        lo, hi = (block.id_lo, block.id_hi) if by_id else (block.lo, block.hi)
        width, number = _spread(hi, lo)[:, None] // np.uint64(BINS) + np.uint64(1), np.arange(q)[:, None]
        total = np.zeros(q * BINS, np.int64)
        for ids, vectors in packs:
            scores = block.scores(ids, vectors)
            for a in range(0, len(ids), 256):
                part = scores[:, a : a + 256]
                own = np.broadcast_to(ids[a : a + 256], part.shape) if by_id else part
                inside = (own >= lo[:, None]) & (own <= hi[:, None])
                far = _spread(own, lo[:, None]) if by_id else _spread(hi[:, None], own)
                if by_id:
                    inside &= part == block.lo[:, None]
                np.add.at(total, (number * BINS + (far // width).astype(np.int64))[inside], 1)
        total = total.reshape(q, BINS)
        number, place = np.nonzero(_tail(total, block.need))
        return pd.DataFrame({"block": np.full(len(number), row.block, np.int64), "number": number, "bin": place, "n": total[number, place]})

    return _meeting(visit, pd.DataFrame({c: np.zeros(0, np.int64) for c in ("block", "number", "bin", "n")}))


def _keep(row, packs: list) -> pd.DataFrame:
    block, out = _Block(row), []
    for ids, vectors in packs:
        scores = block.scores(ids, vectors)
        keep = (scores > block.lo[:, None]) | ((scores == block.lo[:, None]) & (ids[None, :] <= block.id_lo[:, None]))
        query, at = np.nonzero(keep & (scores != np.iinfo(np.int64).min))
        out.append(pd.DataFrame({"query_id": block.ids[query], "vec_id": ids[at], "score": scores[query, at]}))
    return pd.concat(out)


def _pass(packs: DataFrame, blocks: DataFrame, states: DataFrame, function, schema: str) -> DataFrame:
    """Every block of queries, with its states, at every group of packs of its dimension: one shuffle."""
    held = states.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("number", *STATE))).alias("state"))
    columns = ["dim", "group", "block", "ids", "vectors", "reach", "state"]
    visits = blocks.join(held, "block").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).select(columns)
    state = visits.schema["state"].dataType
    own = packs.select("dim", "group", F.lit(-1).cast("long").alias("block"), "ids", "vectors", F.lit(0.0).alias("reach"), F.lit(None).cast(state).alias("state"))
    dealt = own.union(visits).repartition("dim", "group").sortWithinPartitions("dim", "group", "block")
    return dealt.mapInPandas(function, schema)


def _whole(column: str | Column) -> Column:
    """As a decimal, in which no product or difference of longs overflows."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def _narrowed(packs: DataFrame, blocks: DataFrame, states: DataFrame, by_id: bool) -> DataFrame:
    """The states after a pass: the range of the bin in which the wanted number is reached."""
    counts = _pass(packs, blocks, states, _histogram(by_id), "block long, number long, bin long, n long")
    counts = counts.groupBy("block", "number", "bin").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("block", "number").orderBy("bin")))
    reached = counts.join(states.select("block", "number", "need"), ["block", "number"]).where("upto >= need")
    reached = reached.groupBy("block", "number").agg(F.min_by(F.struct("bin", "n", "upto"), "bin").alias("r")).select("block", "number", "r.*")
    rows = states.join(reached, ["block", "number"], "left")
    lo, hi = ("id_lo", "id_hi") if by_id else ("lo", "hi")
    width = F.floor((_whole(hi) - _whole(lo)) / BINS).cast("decimal(20,0)") + 1
    near = F.col("bin").cast("decimal(20,0)") * width
    if by_id:
        new_lo = _whole(lo) + near
        new = {lo: new_lo, hi: F.least(_whole(hi), new_lo + width - 1)}
    else:
        new_hi = _whole(hi) - near
        new = {lo: F.greatest(_whole(lo), new_hi - width + 1), hi: new_hi}
    known = F.col("bin").isNotNull()
    values = {c: F.when(known, v.cast("long")).otherwise(F.col(c)).alias(c) for c, v in (new | {"need": F.col("need") - F.col("upto") + F.col("n")}).items()}
    if not by_id:  # a query that is not reached has fewer than k candidates, and keeps all of them
        values["hi"] = F.when(known, new["hi"].cast("long")).otherwise(F.col("lo")).alias("hi")
        values["id_hi"] = F.when(known, F.col("id_hi")).otherwise(F.col("id_lo")).alias("id_hi")
    return stored(rows.select("block", "number", *[values.get(c, F.col(c)) for c in STATE]), "states")


def _widest(states: DataFrame, lo: str, hi: str) -> int:
    return int(states.agg(F.max(_whole(hi) - _whole(lo))).first()[0] or 0)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block_size: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of every query with all other rows.

    ``vectors`` needs ``vec_id`` and ``embedding``; rows with a null id, a null or empty vector, or null
    or non-finite components take no part. Ties go to the smaller vec_id. A query's own row is any row
    of its id; queries only meet vectors of their own length. Repeated rows (of one id and vector) are
    one row. Where the largest components could make a product that does not fit a long, it is an error.
    Other columns are not looked at; an empty table gives an empty result.
    """
    rows = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), _integers(F.col("embedding")).alias("v"), is_query.alias("q"))
    rows = stored(rows.where("v is not null").dropDuplicates(["vec_id", "v"]), "vectors")
    packs = stored(rows.select("vec_id", "v").mapInPandas(_packs(PACK), PACKED), "packs")
    dims = packs.groupBy("dim").agg(F.max("top").alias("most"), F.ceil(F.count("*") / group).alias("groups"), F.min("lo").alias("least"), F.max("hi").alias("last"))
    packs = packs.join(dims.select("dim", "groups"), "dim").select("dim", F.pmod(F.xxhash64("ids", "vectors"), "groups").alias("group"), "ids", "vectors")

    blocks = rows.where("q").select("vec_id", "v").mapInPandas(_packs(block_size), PACKED).withColumn("block", F.monotonically_increasing_id())
    reach = F.col("dim") * F.col("top").cast("double") * F.col("most").cast("double") + 1
    fits = F.when(reach < 2.0**62, reach).otherwise(F.raise_error(F.lit("inner products of these vectors may not fit a long")).cast("double"))
    blocks = stored(blocks.join(dims, "dim").select("block", "dim", "groups", "n", "least", "last", fits.alias("reach"), "ids", "vectors"), "blocks")
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("number")
    bound = F.ceil("reach").cast("long") + 1
    states = blocks.select("block", number, (-bound).alias("lo"), bound.alias("hi"), F.lit(k).cast("long").alias("need"), F.col("least").alias("id_lo"), F.col("last").alias("id_hi"))
    states = stored(states, "states")
    while _widest(states, "lo", "hi") > 0:
        states = _narrowed(packs, blocks, states, by_id=False)
    while _widest(states, "id_lo", "id_hi") > 0:
        states = _narrowed(packs, blocks, states, by_id=True)
    found = _pass(packs, blocks, states, _meeting(_keep, pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
