"""Mixing: targets against a loop, words taken against walking through the schedule."""

import random

import pytest
from pyspark.sql import functions as F

from shardtally.llm import mixing


def looped_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        rest = total - sum(fixed.values())
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 3 * sizes[n]]
        if not over:
            return fixed | share
        fixed |= {n: 3 * sizes[n] for n in over}


def rows():
    rng = random.Random(4)
    out = []
    for i in range(700):
        source = rng.choice(["a", "a", "a", "b", "c", "é", "Z", None, "tiny"])
        n = rng.randrange(0, 2) if source == "tiny" else rng.choice([0, 1, 5, 40, 300, 2000])
        out.append((i, source, "w " * n))
    return out + [(700, "a", None), (701, "empty", " \n"), (None, "b", "x y z"), (None, "b", "x y z"), out[0], (702, "c", "long " * 40000)]


@pytest.mark.parametrize("block", [256, 7])
def test_targets_and_takes(spark, block):
    data = rows()
    docs = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, source string, text string, target int").repartition(5)
    got = mixing.mix(docs, block=block).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(data)
    sizes = {}
    for _, source, text in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want = looped_targets(sizes)
    source_of = {i: s for i, s, _ in data}
    totals = dict.fromkeys(sizes, 0)
    for r in got:
        source = "b" if r.doc_id is None else source_of[r.doc_id]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 * max(1, want[source])
        assert 0 <= r.taken <= 3 * r.size
        totals[source] += r.taken
    assert all(abs(totals[s] - want[s]) <= 1 for s in sizes)
    again = sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs.repartition(3), block=block).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in got)


def test_schedule_keeps_to_the_shares(spark):
    sources = spark.createDataFrame([("a", 6000, 1, 6000.0), ("b", 4000, 2, 3000.0), ("c", 900, 3, 1000.0)], "source string, source_size long, sid long, target double")
    plan = mixing.plans(sources, 10)
    slots = sorted(map(tuple, mixing.schedule(plan).collect()))
    need = {r.sid: r.slots for r in plan.collect()}
    for sid, n in need.items():
        assert sorted(j for _, s, j in slots if s == sid) == list(range(n))
        for upto in (100, 400, 800):
            assert abs(sum(s == sid for _, s, _ in slots[:upto]) - upto * n / sum(need.values())) <= 4


def test_no_python_in_the_plan_and_empty_tables(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, source string, text string")
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.where("doc_id = 701")).collect()[0].taken == 0


def test_whole_documents(spark):
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b", f"t{i} " * (50 + i)) for i in range(400)], "doc_id long, source string, text string")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("n")).collect()}
    assert abs(words["a"] / words["b"] - 2.5) < 0.6


def test_whole_documents_reach_every_target(spark):
    rng = random.Random(8)
    data = [(i, f"s{i % 6}", f"t{i} " * rng.choice([1, 30, 400, 3000, 6000])) for i in range(900)]
    data += [(900 + i, None, "n " * 2000) for i in range(60)] + [(5000, "s0", "twice " * 500)] * 4 + [(5000, "s3", "twice " * 500)] * 3
    docs = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(4)
    out = mixing.mixed_documents(docs).withColumn("n", mixing.word_count("text"))
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    sizes, largest = {}, {}
    for _, source, text in data:
        sizes[source] = sizes.get(source, 0) + len(text.split())
        largest[source] = max(largest.get(source, 0), len(text.split()))
    for source, target in looped_targets(sizes).items():
        assert abs(words[source] - target) <= largest[source] / 2 + 1, source
    rows = {(r.doc_id, r.source): r["count"] for r in out.groupBy("doc_id", "source").count().collect()}
    assert all(n <= 3 for (i, _), n in rows.items() if i != 5000) and 0 < rows[5000, "s0"] <= 12 and 0 < rows[5000, "s3"] <= 9
    long_ones = [i for i, s, t in data if s == "s2" and len(t.split()) >= 3000]
    assert sum((i, "s2") in rows for i in long_ones) > len(long_ones) / 6


def test_repeated_rows_share_the_copies_of_their_document(spark):
    shares = [(1, 9, 9, 10, 25), (1, 9, 9, 10, 0), (1, 2, 2, 10, 30), (2, 3, 3, 10, 5), (2, 4, 4, 10, 4), (2, 5, 5, 10, 1)]
    taken = spark.createDataFrame(shares, "sid long, _k1 long, _k2 long, size long, taken long")
    got = {(r.sid, r._k1): (r._rows, r._copies) for r in mixing.whole_copies(taken).collect()}
    assert got[1, 2] == (1, 3) and got[1, 9][0] == 2 and got[1, 9][1] in (2, 3)
    assert sum(n for (s, _), (_, n) in got.items() if s == 2) == 1


def test_whole_table(spark):
    from shardtally.llm.queries import op5_mixing

    out = op5_mixing(spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert out.count() == 1000
    sums = out.groupBy("target", "source_size").agg(F.sum("taken").alias("n")).collect()
    assert sum(r.n > 0 for r in sums) == len(sums) and all(abs(r.n - r.target) <= 1 for r in sums if r.target != 3 * r.source_size)


@pytest.mark.parametrize("block", [256, 7])
def test_takes_equal_a_walk_through_the_schedule(spark, block):
    """Every document's words, slot by slot and word by word along its source's line."""
    docs = spark.createDataFrame(rows(), "doc_id long, source string, text string").repartition(3)
    order = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.lit(11))).otherwise(F.xxhash64("text", F.lit(11)))
    lines = {}
    for r in docs.select("doc_id", "source", "text", order.alias("h"), *mixing.row_key()).collect():
        size = len((r.text or "").encode().split())
        lines.setdefault(r.source, []).append((r.h, r.doc_id is not None, r.doc_id or 0, size, r._k2, r.doc_id))
    sizes = docs.groupBy("source").agg(F.sum(mixing.word_count("text")).alias("source_size"))
    sources = mixing.targets(sizes)
    names = {r.sid: (r.source, r.target) for r in sources.collect()}
    want = []
    plans = {r.sid: r for r in mixing.plans(sources, block).collect()}
    for sid, (source, target) in names.items():
        line = sorted(lines[source])
        words = [at for at, doc in enumerate(line) for _ in range(doc[3])]
        taken = [0] * len(line)
        if (plan := plans.get(sid)) is not None:
            block_at = {(plan.factor * b + plan.shift) % plan.blocks: b for b in range(plan.blocks)}
            assert len(block_at) == plan.blocks
            for j in range(plan.slots):
                start = block_at[j % plan.blocks] * block
                own = words[start : start + block]
                for at in own if j < plan.slots - 1 else own[: plan.last_words]:
                    taken[at] += 1
            assert sum(taken) == round(target)
        want += [(str(doc[5]), doc[3], n) for doc, n in zip(line, taken)]
    got = [(str(r.doc_id), r.size, r.taken) for r in mixing.mix(docs, block=block).collect()]
    assert sorted(got) == sorted(want)
