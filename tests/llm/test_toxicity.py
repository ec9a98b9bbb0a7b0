"""The shared-backoff models against plain dictionaries, joins against sent tables, held-out results, odd rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardtally.llm import toxicity
from shardtally.llm.common import ship, table


def brute_ratios(words, order):
    """{gram or head: log ratio} by dictionaries."""
    grams = [Counter(), Counter()]
    for word, *counts in words:
        padded = "^" * (order - 1) + word + "$"
        for i in range(len(word) + 1):
            for c in (0, 1):
                if counts[c]:
                    grams[c][padded[i : i + order]] += counts[c]
    pooled = grams[0] + grams[1]

    def discount(values):
        once, twice = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return once / (once + 2 * twice) if once else 0.5

    levels, above = [], pooled
    for _ in range(order - 1):
        level = Counter()
        for gram, n in above.items():
            level[gram[1:]] += n if gram[1:].startswith("^") else 1
        levels.append(level)
        above = level
    below = {"": 1 / (len(levels[-1]) + 1)}
    for level in reversed(levels):
        d, total, kinds = discount(level.values()), Counter(), Counter()
        for gram, n in level.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        below = {g: (max(n - d, 0) + d * kinds[g[:-1]] * below[g[1:]]) / total[g[:-1]] for g, n in level.items()}
    total, kinds = [Counter(), Counter()], [Counter(), Counter()]
    for c in (0, 1):
        for gram, n in grams[c].items():
            total[c][gram[:-1]] += n
            kinds[c][gram[:-1]] += 1
    d = [discount(g.values()) for g in grams]
    rest = [{h: d[c] * kinds[c][h] / total[c][h] if total[c][h] else 1.0 for h in {g[:-1] for g in pooled}} for c in (0, 1)]
    out = {h: math.log(rest[0][h] / rest[1][h]) for h in rest[0]}
    for gram in pooled:
        h = gram[:-1]
        p = [(max(grams[c][gram] - d[c], 0) / total[c][h] if total[c][h] else 0) + rest[c][h] * below[gram[1:]] for c in (0, 1)]
        out[gram] = math.log(p[0] / p[1])
    return out


WORDS = [("idiot", 9, 0), ("idle", 1, 30), ("the", 40, 400), ("then", 4, 45), ("éthos", 0, 2), ("x", 1, 1), ("idiotic", 2, 0), ("theory", 0, 7)]


@pytest.mark.parametrize("order", [2, 3, 6])
def test_table_equals_dictionaries(spark, order):
    words = spark.createDataFrame(WORDS, "word string, toxic long, other long")
    want = brute_ratios(WORDS, order)
    got = {r.gram: r.ratio for r in toxicity.log_ratios(words, order).collect()}
    assert got.keys() == want.keys()
    assert all(got[g] == pytest.approx(want[g], abs=1e-5) for g in want)


def test_words_in_a_task_equal_dictionaries():
    want = brute_ratios(WORDS, 6)
    grams = list(want)
    keys = toxicity.whole_hashes(grams)
    assert all(int(k) == int(toxicity.hashes_of(toxicity._codes([g]), len(g))[1][0]) for g, k in zip(grams, keys))
    order = np.argsort(keys)
    table = toxicity.Ratios(keys[order], np.array([want[g] for g in grams], np.float64)[order], 6)
    words = ["idiot", "x", "éthosé", "unknown", "the", "idiotheory"]

    def looked_up(word):
        padded = "^" * 5 + word + "$"
        return sum(want.get(padded[i : i + 6], want.get(padded[i : i + 5], 0.0)) for i in range(len(word) + 1))

    assert table.words(words) == pytest.approx([looked_up(w) for w in words])
    assert len(table.words([])) == 0 and toxicity.Ratios(keys[:0], keys[:0], 6).words(["a"]).tolist() == [0.0]


def test_probabilities_add_up(spark):
    """With shared backoff P_toxic sums to at most 1 after a head that both classes know."""
    words = spark.createDataFrame(WORDS, "word string, toxic long, other long")
    grams = words.select(F.explode(toxicity.grams_of(F.col("word"), 3)).alias("gram"), (F.col("toxic") + F.col("other")).alias("n")).groupBy("gram").agg(F.sum("n").alias("n"))
    shared = toxicity.shared_backoff(grams, 3).groupBy(F.substring("suffix", 1, 1)).agg(F.sum("shared").alias("all")).collect()
    assert shared and all(0 < r["all"] <= 1 + 1e-9 for r in shared)


def data(n=400):
    rng = np.random.default_rng(5)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    out = []
    for i in range(n):
        words = list(rng.choice(plain, size=rng.integers(3, 200)))
        if i % 4 == 0:
            words[rng.integers(len(words))] = rng.choice(["Zounder!", "zounders", "bezounded"])
        out.append((i, " ".join(words), int(i % 4 == 0)))
    return out


def frames(spark):
    rows = data()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, _mean string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_joins_equal_the_sent_table(spark):
    ship(spark)
    docs, labels = frames(spark)
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(None, None, "x"), (None, "Ünknown zounder, 12", "x"), (7, "", "x")], docs.schema))
    one, two = (toxicity.scored(docs, labels, sent=n) for n in (10**6, 0))
    one, two = (sorted((str(r._row.doc_id), r._row.text or "", r._score) for r in x.collect()) for x in (one, two))
    assert len(one) == len(two) == 406
    assert all(a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9) for a, b in zip(one, two))


def test_held_out_words_are_told_apart(spark):
    ship(spark)
    docs, labels = frames(spark)
    rows = {r._row.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert all((rows[i]._score >= 0.5) == bool(y) and rows[i]._row._mean == "x" for i, _, y in data())


def test_labels_of_the_held_out_fold_change_nothing(spark):
    ship(spark)
    docs, labels = frames(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - labels.toxic).otherwise(labels.toxic))
    one, two = ({r._row.doc_id: r._score for r in toxicity.scored(docs, x).collect()} for x in (labels, turned))
    assert one == pytest.approx(two)


def test_odd_tables(spark):
    ship(spark)
    docs, labels = frames(spark)
    more = spark.createDataFrame([(None, None, "x"), (900, "", "x"), (901, "12 34 !?", "x"), (2**60 + 1, "alpha " * 200_000 + "zounder", "x"), (2**60 + 2, "z" * 500_000, "x")], docs.schema)
    odd = spark.createDataFrame([(None, 1), (1, None), (0, 1), (0, 1), (12345, 1)], "doc_id long, toxic int")
    rows = {(r._row.doc_id, r._row.text): r._score for r in toxicity.scored(docs.union(more), labels.union(odd)).collect()}
    assert len(rows) == 405 and all(0 <= s <= 1 for s in rows.values())
    assert rows[(None, None)] == rows[(900, "")] == rows[(901, "12 34 !?")] < 0.5
    assert rows[(2**60 + 1, "alpha " * 200_000 + "zounder")] > 0.5
    assert [r._score for r in toxicity.scored(docs, labels.where("toxic = 0")).limit(1).collect()] == [0.0]
    assert toxicity.scored(docs.limit(0), labels).count() == 0 and toxicity.scored(docs, labels.limit(0)).count() == 400


def test_held_out_accuracy(spark):
    from shardtally.llm.queries import op11_toxicity

    folder = "/root/testdata/sf0.1"
    out = op11_toxicity(spark, folder)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(table(spark, folder, "labels"), "doc_id").toPandas()
    assert out.count() == 10_000 and rows["score"].between(0, 1).all()
    held = rows[rows["held_out"]]
    bad, good = held[held["toxic"] == 1], held[held["toxic"] == 0]
    print("caught", bad["predicted"].mean(), "flagged", good["predicted"].mean())
    assert bad["predicted"].mean() > 0.8 and good["predicted"].mean() < 0.01
