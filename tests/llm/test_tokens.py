"""Merge replay against tiktoken, and the length histogram against counting."""

import hashlib
import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from shardtally.llm import mergereplay, tokencounts
from shardtally.llm.common import ship

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
REPLAY = mergereplay.MergeReplay(PATH)
TIKTOKEN = tokencounts._encoder(PATH, PATTERN)
TEXTS = [None, "", " ", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30, "The the THE", "   é日本語 \U0001f600\U0001f600", "<|endoftext|>", "x" * 100_000, "word " * 20_000, "\r\n\t  \n", "1234567890" * 9]


def pieces_of(texts):
    return list(dict.fromkeys(p for t in texts for p in mergereplay.regex.findall(PATTERN, t)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_replay_on_any_text(texts):
    pieces = [p.encode() for p in pieces_of(texts)]
    assert REPLAY.encode(pieces) == [TIKTOKEN._core_bpe.encode_single_piece(p) for p in pieces]


def test_replay_on_repetitive_words():
    rng = random.Random(2)
    pieces = list({bytes(rng.choices(b"aabcehnrst", k=rng.randrange(1, 25))) for _ in range(5000)})
    assert REPLAY.encode(pieces) == [TIKTOKEN._core_bpe.encode_single_piece(p) for p in pieces]


def test_pieces_forgotten_between_chunks(monkeypatch):
    monkeypatch.setattr(mergereplay, "KEPT", 50)
    monkeypatch.setattr(mergereplay, "CHUNK_CHARS", 300)
    monkeypatch.setattr(mergereplay, "REPLAY_BYTES", 100)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcehnrst", k=rng.randrange(1, 9))) for _ in range(40)) for _ in range(60)] + ["q" * 900, "", None]
    frames = mergereplay._encoded(PATH, PATTERN)(iter([mergereplay.pd.Series(texts[:50]), mergereplay.pd.Series(texts[50:])]))
    got = [ids for frame in frames for ids in frame["ids"]]
    assert got == [" ".join(map(str, TIKTOKEN.encode_ordinary(t or ""))) for t in texts]


def digests(text):
    ids = TIKTOKEN.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_digests_and_round_trip(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r._row.doc_id: tuple(r._code) for r in mergereplay.encode_digests(docs, PATH, PATTERN).collect()}
    assert got == {i: digests(t) for i, t in enumerate(TEXTS)}
    whole = mergereplay.encode_texts(docs, PATH, PATTERN).collect()
    assert all(bytes(r._code.decoded).decode() == (r._row.text or "") and r._row.ids == "x" for r in whole)
    assert mergereplay.encode_texts(docs.limit(0), PATH, PATTERN).count() == 0


def test_whole_table(spark):
    from shardtally.llm.queries import op10_byte_level_bpe

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in op10_byte_level_bpe(spark, "/root/testdata/sf0.01").collect()}
    assert got == {i: digests(t) for i, t in docs}


def test_every_limit(spark):
    from shardtally.llm.queries import op8_token_counts

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    lengths = [len(TIKTOKEN.encode_ordinary(t or "")) for (t,) in docs]
    want = []
    for limit in sorted(set(lengths)):
        longer = [x for x in lengths if x > limit]
        cut = sum(min(x, limit) for x in lengths)
        want.append((limit, lengths.count(limit), len(longer), sum(longer), cut, sum(lengths) - cut, len(lengths) - len(longer)))
    assert sorted(tuple(r) for r in op8_token_counts(spark, "/root/testdata/sf0.001").collect()) == want


def test_counts_of_odd_tables(spark):
    ship(spark)
    docs = spark.createDataFrame([(None, 1), ("", 2), (" ", 3)], "text string, length int")
    assert sorted(tuple(r)[:3] for r in tokencounts.totals(docs, PATH, PATTERN).collect()) == [(0, 2, 1), (1, 1, 0)]
    assert tokencounts.totals(docs.limit(0), PATH, PATTERN).count() == 0
