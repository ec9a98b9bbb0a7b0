"""Near copies against comparing everybody with everybody."""

import random

import numpy as np

from shardtally.llm import nearcopies
from shardtally.llm.common import ship
from shardtally.llm.components import components


def brute(rows, size, percent=80):
    sets = [nearcopies.shingles(t or "", size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = {}
    for i, s in enumerate(sets):
        if s:
            root[i] = distinct.setdefault(s, i)
    kinds = sorted(distinct.items(), key=lambda x: len(x[0]))
    for i, (a, x) in enumerate(kinds):
        for b, y in kinds[i + 1 :]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(x)] = find(y)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(out, key=str)


def test_like_brute_force(spark):
    ship(spark)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(260):  # variants of one text, some too far from all others
        words = list(base)
        for _ in range(rng.randrange(0, 12)):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rng.choices(base, k=rng.randrange(1, 40)))) for i in range(200)]
    rows += [(2000 + i, rows[3][1].upper() + "\n") for i in range(40)]
    rows += [(3000, None), (3001, ""), (3002, " \t"), (3003, "w1"), (3004, "W1"), (3005, "w2 w3"), (None, "w1"), (None, "only null"), (None, "only null")]
    rows += [rows[0], rows[0], (3006, "É é " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size in (2, 5):
        got = nearcopies.near_copies(docs, size=size).collect()
        assert sorted([tuple(r) for r in got], key=str) == brute(rows, size)


def test_large_ids_beside_null_ones(spark):
    ship(spark)
    big = 2**60
    rows = [(big + 1, "a b c d"), (big + 2, "a b c d"), (None, "a b c d"), (big + 3, "own words here"), (None, "only null"), (-(2**63), "least of all"), (2**63 - 1, "least of all"), (big + 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted([tuple(r) for r in nearcopies.near_copies(docs, size=2).collect()], key=str) == brute(rows, 2)


def test_whole_table(spark):
    from shardtally.llm.queries import op9_minhash_near_dedup

    out = op9_minhash_near_dedup(spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute([tuple(r) for r in rows], 2)


def test_empty_and_clashing_names(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id long, text string, node string, bands int")
    assert nearcopies.near_copies(empty).count() == 0


def templated(n):
    """Texts that share a template and many buckets, and are no copies."""
    template = " ".join(f"t{i}" for i in range(60))
    return [(i, template + " " + " ".join(f"own{i}x{j}" for j in range(11))) for i in range(n)]


def test_templated_texts_are_not_dealt_to_one_another(spark):
    ship(spark)
    for n in (1000, 2000):
        rows = spark.createDataFrame([(i, i, t) for i, t in templated(n)], "node long, root long, text string")
        held = spark.sparkContext.broadcast(nearcopies._counted(rows, 2))
        assert nearcopies._candidates(rows, held, 2, 80).count() <= n // 10
    close = [(i, i, " ".join(f"t{k}" for k in range(60)) + f" own{i}") for i in range(40)]
    rows = spark.createDataFrame(close, "node long, root long, text string")
    held = spark.sparkContext.broadcast(nearcopies._counted(rows, 2))
    assert nearcopies._candidates(rows, held, 2, 80).count() == 40


def test_templated_bucket(spark):
    ship(spark)
    rows = templated(1500)
    rows += [(5000 + i, t + f" more{i}") for i, t in rows[:20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs, size=2).collect()}
    assert got == {i: i if i < 5000 else i - 5000 for i, _ in rows}


def test_signature_follows_similarity():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (400, 50, 50))
    elements = np.concatenate([common, a, common, b])
    doc = np.repeat([0, 1], 450)
    one, two = nearcopies.superminhash(elements, doc, 2)
    assert abs((one == two).mean() - 0.8) < 0.12
    small = nearcopies.superminhash(elements[:3], np.array([0, 0, 1]), 2)
    assert np.isfinite(small).all() and sorted(np.floor(small[1])) == list(range(nearcopies.SLOTS))


def test_components_of_a_chain_and_a_hub(spark):
    ship(spark)
    edges = [(i, i + 1) for i in range(100, 400)] + [(5, 1000 + i) for i in range(500)] + [(7, 7), (400, 100)]
    roots = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect())
    assert roots[400] == 100 and roots[1499] == 5 and 7 not in roots and len(roots) == 301 + 501
