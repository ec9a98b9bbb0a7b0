"""Nearest neighbours: recall and exact scores against brute force."""

import math
import random

import numpy as np

from shardtally.llm import anntree
from shardtally.llm.common import ship


def brute(ids, vectors, every, k=10):
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far.round(9))) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(far[i])) for i in order]
    return out


def recall_of(rows, want, k=10):
    got, hits = {}, 0
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == {q for q, x in want.items() if x}
    for q, true in want.items():
        assert len(got.get(q, [])) == len(true)
        hits += len({i for i, _ in got.get(q, [])} & {i for i, _ in true})
        assert [s for _, s in got.get(q, [])] == sorted(s for _, s in got.get(q, []))
    return hits / sum(len(x) for x in want.values())


def test_whole_table(spark):
    from shardtally.llm.queries import op6_nearest_neighbours

    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"].to_numpy()).astype(float)
    out = op6_nearest_neighbours(spark, "/root/testdata/sf0.1")
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    rows = out.collect()
    assert recall_of(rows, brute(ids, vectors, 100)) >= 0.95
    at = {i: n for n, i in enumerate(ids)}
    assert all(math.isclose(r.score, math.dist(vectors[at[r.query_id]], vectors[at[r.vec_id]]), abs_tol=1e-12) for r in rows)


def test_many_copies_ties_and_odd_rows(spark):
    ship(spark)
    rng = random.Random(1)
    good = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(900)] + [(2000 + i, [1.0] * 5) for i in range(450)]
    odd = [(100000, None), (100100, []), (100200, [0.0] * 5), (100300, [None] * 5), (100400, [float("nan")] * 5), (None, [1.0] * 5), good[7]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + odd], "vec_id long, embedding array<double>, leaf int, score string").repartition(4)
    rows = anntree.nearest(df, every=50).collect()
    ids, vectors = np.array([i for i, _ in good]), np.array([v for _, v in good])
    want = brute(ids, vectors, 50)
    assert recall_of(rows, want) >= 0.95
    assert [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == 2050] == list(range(2000, 2010))
    assert anntree.nearest(df.limit(0)).count() == 0
    few = anntree.nearest(df.where("vec_id in (0, 1, 2)"), every=50).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_small_leaves_and_huge_distances_give_k_rows(spark, monkeypatch):
    monkeypatch.setattr(anntree, "calibrated", lambda *args: 1)
    monkeypatch.setattr(anntree, "LEAF", 100)
    rng = np.random.default_rng(3)
    crowd = rng.normal(0, 0.01, (900, 3)) + rng.choice([1.0, 9.0], (900, 1))
    alone = np.array([[500.0, 0, 0], [501, 0, 0], [502, 0, 0]])
    rows = [(i + 1, v.tolist()) for i, v in enumerate(crowd)] + [(1000 * (i + 2), v.tolist()) for i, v in enumerate(alone)]
    got = anntree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=1000).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, n) for q in (2000, 3000, 4000) for n in range(1, 11)]

    huge = [(100, [1e200, 0.0]), (101, [3e200, 0.0]), (102, [-2e200, 0.0]), (103, [1e200, 1.0])]
    got = anntree.nearest(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [103, 101, 102] and abs(got[1].score / 2e200 - 1) < 1e-9
