"""The factorisation machine: the identity, held-out accuracy, odd inputs."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shardtally.llm import quality
from shardtally.llm.common import Hashes, ship


def machine():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "E!"], size=n)) for n in rng.integers(1, 40, 60)]
    places, weights, sizes, stats = quality.features(texts, [None] * 60, Hashes())
    cuts = np.cumsum(sizes)[:-1]
    return texts, quality.fit(np.split(places, cuts), np.split(weights, cuts), stats, rng.integers(0, 2, 60).astype(float), epochs=2)


def test_sum_of_squares_equals_all_pairs():
    texts, own = machine()
    at, value, first = own.rows(*quality.features(texts[:5], [None] * 5, Hashes()))
    margins, _ = own.margins(at, value, first)
    for i, (lo, hi) in enumerate(zip(first, [*first[1:], len(at)])):
        pairs = sum(own.factor[at[a]] @ own.factor[at[b]] * value[a] * value[b] for a in range(lo, hi) for b in range(a + 1, hi))
        assert np.isclose(margins[i], own.bias + own.weight[at[lo:hi]] @ value[lo:hi] + pairs)


def test_query_equals_all_pairs_of_the_stored_weights(spark):
    """Every score of the query from the machine's weights, feature by feature and pair by pair."""
    from shardtally.llm.queries import op2_quality_classifier

    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    own = quality.train(docs, labels)
    got = {r.doc_id: r for r in op2_quality_classifier(spark, folder).collect()}
    assert len(got) == docs.count()
    for row in docs.collect():
        raw = (row.text or "").encode()
        counts = Counter(w.lower() for w in raw.split())
        length = math.sqrt(sum(counts.values()))
        features = [(xxhash.xxh3_64_intdigest(w) % quality.WORDS, math.sqrt(n) / max(length, 1e-9)) for w, n in counts.items()]
        stats = quality.statistics_of(raw, raw.split(), Counter(raw.split()), row.n_chars)
        share = 1 / math.sqrt(quality.STATISTICS)
        for i, x in enumerate(stats):
            features.append((quality.WORDS + i, min(max((x - own.mean[i]) / own.scale[i], -3), 3) * share / 3))
            features.append((quality.WORDS + quality.STATISTICS + i * quality.BINS + sum(x > edge for edge in own.edges[i]), share))
        at, value = np.array([f for f, _ in features]), np.array([v for _, v in features])
        scaled = own.factor[at] * value[:, None]
        pairs = np.triu(scaled @ scaled.T, 1).sum()
        margin = own.bias + own.weight[at] @ value + pairs
        assert got[row.doc_id].score == pytest.approx(1 / (1 + math.exp(-min(max(margin, -30), 30))), abs=1e-6)
        assert got[row.doc_id].predicted == int(got[row.doc_id].score >= 0.3)
        assert got[row.doc_id].held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(spark):
    from shardtally.llm.queries import op2_quality_classifier

    folder = "/root/testdata/sf0.1"
    out = op2_quality_classifier(spark, folder)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert out.count() == 10_000 and rows["score"].between(0, 1).all()
    held = rows[rows["held_out"]]
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    auc = (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()
    accuracy = (held["predicted"] == held["quality"]).mean()
    print("AUC", auc, "accuracy", accuracy, "kept good", (good >= 0.3).mean(), "kept bad", (bad >= 0.3).mean())
    assert auc > 0.99 and accuracy > 0.97 and (good >= 0.3).mean() > 0.99


def test_odd_tables(spark):
    ship(spark)
    data = [(i, "good prose here, of words" if i % 3 else "JUNK!! JUNK!! " * 9, "x") for i in range(90)]
    docs = spark.createDataFrame(data + [(100, None, "x"), (101, "", "x"), (None, "a", "x"), (102, "z " * 90000, "x"), data[0]], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(1, 1), (None, 1), (5, None)], "doc_id long, quality int")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == 95 and all(0 <= r._score <= 1 and r._row.score == "x" for r in rows)
    by_id = {r._row.doc_id: r._score for r in rows}
    assert by_id[1] > 0.7 > 0.3 > by_id[3]
    assert [r._score for r in quality.scored(docs, labels.where("quality = 1")).limit(1).collect()] == [0.5]
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, f"w{i % 7} " * (i % 5 + 1)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - labels.quality).otherwise(labels.quality))
    one, two = ({r._row.doc_id: r._score for r in quality.scored(docs, x).collect()} for x in (labels, turned))
    assert one == pytest.approx(two)
