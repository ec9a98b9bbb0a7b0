"""Exact top-k against scoring everything."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shardtally.llm import exacttopk
from shardtally.llm.common import ship


def brute(rows, is_query, k):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole[(i, tuple(math.floor(x * 1024) for x in v))] = None
    out = []
    for i, a in whole:
        if is_query(i):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in whole if j != i and len(a) == len(b))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_like_brute_force(spark):
    ship(spark)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)] + [(2000 + i, [0.0] * 6) for i in range(9)]
    rows += [(400, None), (500, []), (600, [None] * 6), (700, [float("nan")] * 6), (800, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (7, rows[7][1])]
    rows += [(900, [1.0, 2.0]), (901, [2.0, 2.0]), (2**40, [30.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    rows = [tuple(r) for r in df.collect()]
    for block, group in ((1024, 32), (3, 1)):
        got = exacttopk.top_k(df, F.col("vec_id") % 50 == 0, k=10, block_size=block, group=group).collect()
        assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 50 == 0, 10)
    assert exacttopk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_ids_over_the_whole_range_and_ties(spark, monkeypatch):
    ship(spark)
    rng = random.Random(2)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(120)] + [-(2**63), 2**63 - 1, 2**60 + 1, 2**60 + 2, 0]
    rows = [(i, [1.0, float(n % 2)]) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    wanted = set(ids[::17]) | {0, 2**63 - 1}
    got = exacttopk.top_k(df, F.col("vec_id").isin(*wanted), k=7).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i in wanted, 7)


def test_wide_scores(spark):
    ship(spark)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-6e5, 6e5) for _ in range(5)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exacttopk.top_k(df, F.col("vec_id") % 50 == 0, k=3).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 50 == 0, 3)


def test_products_beyond_a_long_are_an_error(spark):
    ship(spark)
    df = spark.createDataFrame([(0, [3e6] * 3), (1, [3e6] * 3)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit a long"):
        exacttopk.top_k(df, F.col("vec_id") == 0).collect()


def test_jobs_do_not_grow_with_queries(spark):
    ship(spark)
    rng = random.Random(4)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1)] * 4) for i in range(400)], "vec_id long, embedding array<double>")
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for name, step in (("few queries", 100), ("many queries", 2)):
        spark.sparkContext.setJobGroup(name, name)
        exacttopk.top_k(df, F.col("vec_id") % step == 0, block_size=16).collect()
        jobs.append(len(tracker.getJobIdsForGroup(name)))
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] <= jobs[0] + 10


def test_whole_table(spark):
    from shardtally.llm.queries import op3_exact_topk

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op3_exact_topk(spark, "/root/testdata/sf0.01")
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, 10)
