"""Each stage of the pipeline against brute force on what the stage before it kept."""

from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from test_nearcopies import brute as near_brute
from test_substrings import brute as cut_brute
from test_tokens import TIKTOKEN

import corpus_pipeline
from shardtally.llm import quality
from shardtally.llm.common import table
from shardtally.sources.workspace import stored

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_one_by_one(spark):
    docs = table(spark, FOLDER, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "substring_dedup", "mix", "tokenise"]

    first = stored(stages["quality"](spark, docs, FOLDER), "t")
    assert first.schema == docs.schema
    scores = {r._row.doc_id: r._score for r in quality.scored(docs, table(spark, FOLDER, "labels")).collect()}
    assert rows_of(first).keys() == {i for i, s in scores.items() if s >= quality.KEEP_AT}

    second = stored(stages["near_dedup"](spark, first, FOLDER), "t")
    before = [(r.doc_id, r.text) for r in first.collect()]
    assert second.schema == docs.schema
    assert sorted(rows_of(second)) == sorted(i for i, _, _, kept in near_brute(before, 5) if kept)

    third = stored(stages["substring_dedup"](spark, second, FOLDER), "t")
    before = [(r.doc_id, r.text) for r in second.collect()]
    texts = dict(before)
    want = {i: kept if gone else texts[i] for i, n, gone, kept in cut_brute(before, 35) if not gone or gone < n}
    assert third.schema == docs.schema and {i: r.text for i, r in rows_of(third).items()} == want

    fourth = stored(stages["mix"](spark, third, FOLDER), "t")
    assert fourth.schema == docs.schema
    times, given = Counter(r.doc_id for r in fourth.collect()), rows_of(third)
    assert max(times.values()) <= 3 and times.keys() <= given.keys()
    assert all(r == given[r.doc_id] for r in fourth.collect())
    words = sum(len((r.text or "").encode().split()) for r in given.values())
    assert abs(sum(len(given[i].text.encode().split()) * n for i, n in times.items()) / words - 1) < 0.25

    last = stages["tokenise"](spark, fourth, FOLDER).collect()
    assert Counter(r.doc_id for r in last) == times
    assert all(r.ids == " ".join(map(str, TIKTOKEN.encode_ordinary(given[r.doc_id].text))) for r in last)
    assert public_tokenizers.PATTERN

    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, last), key=str)


def test_odd_rows(spark):
    docs = table(spark, FOLDER, "documents")
    more = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).union(docs.limit(2)).union(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    out = docs.limit(40).union(more).withColumns({"_k1": F.lit("x"), "kept": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, out, FOLDER), name)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"] and out.count() > 0
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = stored(stage(spark, none, FOLDER), name)
    assert none.count() == 0


def test_one_row_stays_of_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(200)]
    copy = lambda n: " ".join([*base[:-1], f"end{n}"])
    other = lambda n: " ".join([f"v{i}" for i in range(150)] + [f"end{n}"])
    third = lambda n: " ".join([f"u{i}" for i in range(150)] + [f"end{n}"])
    rows = [(None, copy(i)) for i in range(4)] + [(7, other(1)), (7, other(2)), (9, other(3)), (7, "alone and not like the others at all")]
    rows += [(None, third(1)), (3, third(2)), (None, ""), (8, None), (None, copy(0))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, FOLDER).collect()]
    assert [sum(g in chosen for g in got) for chosen in ([(None, copy(i)) for i in range(4)], [(7, other(1)), (7, other(2))])] == [1, 1]
    assert {(7, "alone and not like the others at all"), (3, third(2)), (None, ""), (8, None)} <= set(got) and len(got) == 6


def test_texts_are_cut_once(spark):
    """The filter on the words that stay is no second cut below the first one, in further Python workers."""
    cut = dict(corpus_pipeline.STAGES)["substring_dedup"](spark, table(spark, FOLDER, "documents"), FOLDER)
    assert cut._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 2  # packed, then cut and unpacked
