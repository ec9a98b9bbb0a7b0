"""Substring removal against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from shardtally.llm import substrings
from shardtally.llm.common import ship


def brute(rows, width):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append((doc_id, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=str)


def fixture(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=20))
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 90))
        if i % 3 == 0:
            words.insert(rng.randrange(len(words) + 1), passage)
        rows.append((i, "\n ".join(words)))
    copy = rows[5][1]
    rows += [(200 + i, copy) for i in range(30)]
    rows += [(None, None), (None, rows[6][1]), (None, rows[6][1]), (7, rows[7][1]), (300, ""), (301, " \t\n"), (302, "a " * 400)]
    rows += [(303, "nb sp x " + copy)]
    return rows


@pytest.mark.parametrize("hot, bits", [(1000, 2**20), (3, 2**20), (3, 64), (0, 2**20)])
def test_like_brute_force(spark, hot, bits):
    ship(spark)
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(docs, width=12, hot=hot, bits=bits).select("_row.doc_id", "_cut.*").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, 12)


def test_small_inputs_and_clashing_names(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id long, text string, _k1 int, n_words string")
    assert substrings.remove_repeats(empty).count() == 0
    one = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, _k1 int, n_words string")
    row = substrings.remove_repeats(one).first()
    odd = spark.createDataFrame([(1, None, 2, 3), (2, "", 4, 5), (3, "c  d", 6, 7)], "doc_id long, text string, _others int, _packed int")
    assert sorted(tuple(r._row) for r in substrings.remove_repeats(odd).collect()) == [(1, None, 2, 3), (2, "", 4, 5), (3, "c  d", 6, 7)]
    assert (row._row._k1, row._row.n_words, row._cut.n_words, row._cut.kept) == (5, "x", 2, "a b")


def test_equal_fingerprints_are_told_apart():
    data = np.frombuffer(b"a b c a b d e e ", np.uint8)
    begin = np.arange(0, 14, 2)
    none = np.zeros(len(begin), np.uint64)
    assert substrings.repeated(data, begin, begin + 4, none).tolist() == [True, False, False, True, False, False, False]
    assert substrings.repeated(data, begin, begin + 4, substrings.prints_of(data, begin, begin + 4)).tolist() == [True, False, False, True, False, False, False]


def test_slices_change_no_fingerprint(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    begin = np.sort(rng.integers(0, 4800, 300))
    end = np.maximum.accumulate(begin + rng.integers(0, 200, 300))
    whole = substrings.prints_of(data, begin, end)
    monkeypatch.setattr(substrings, "SLICE_BYTES", 37)
    assert (substrings.prints_of(data, begin, end) == whole).all()


def test_words_are_those_of_the_contract():
    texts = ["\u00a0a\x0b\x0cb\x85c \r\n d", "", "  ", "x", " y\t\tz "]
    chunk = substrings.Chunk([(i, i) for i in range(5)], [t.encode() for t in texts], 2)
    assert chunk.text.tobytes() == b"".join(w + b" " for t in texts for w in t.encode().split())
    assert chunk.first.tolist() == [0, 3, 3, 3, 4] and chunk.words == 6 and chunk.doc.tolist() == [0, 0, 4]


def test_packets_do_not_grow_with_the_buckets():
    rng = random.Random(3)
    text = " ".join(rng.choices([f"w{i}" for i in range(900)], k=20_000)).encode()
    batch = substrings.pa.RecordBatch.from_pydict({"_k1": [1], "_k2": [2], "_text": [text]})
    sizes = [sum(b.nbytes for b in substrings._deal(35, buckets, None)(iter([batch]))) for buckets in (10, 1_000_000)]
    assert sizes[0] == sizes[1]


def test_query_columns(spark):
    from shardtally.llm.queries import op7_substring_dedup

    out = op7_substring_dedup(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in brute(docs, 35)]
    assert sorted([tuple(r) for r in out.collect()], key=str) == sorted(want, key=str)
