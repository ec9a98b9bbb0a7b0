"""Piece tables: cuts, arrangements and inverses, streamed digests, odd rows, brute force on a whole table."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardtally.llm import piecetable
from shardtally.llm.common import ship, table
from shardtally.llm.piecetable import ORDERS, PieceTable, arrange, restore

LARGE = 2**60


def brute(doc_id, text):
    """The contract on plain strings."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n\r é<PSM>\U0001f600", max_size=40), st.integers(-(2**63), 2**63 - 1))
def test_transform_and_restore(text, doc_id):
    done = arrange(doc_id, text)
    n, form, prefix, middle, output = brute(doc_id, text)
    assert (done.n, done.form, *done.chars(), done.table.content().decode()) == (n, form, prefix, middle, output)
    assert done.table.sha256() == sha(output)
    assert restore(output, form).content().decode() == text


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.data())
def test_cuts_split_descriptors_anywhere(raw, data):
    cuts = sorted(data.draw(st.lists(st.integers(0, len(raw)), min_size=1, max_size=4)))
    whole = PieceTable.of(raw)
    parts = [b"".join(raw[s:e] for _, s, e in p) for p in whole.parts(cuts)]
    bounds = [0, *cuts, len(raw)]
    assert parts == [raw[a:b] for a, b in zip(bounds, bounds[1:])]


def test_cuts_of_a_table_with_many_descriptors():
    whole = PieceTable((b"abcdefgh", b"<P><M><S>"), ((0, 4, 8), (1, 0, 3), (0, 0, 4)))
    content = whole.content()
    assert content == b"efgh<P>abcd"
    for a in range(len(content) + 1):
        for b in range(a, len(content) + 1):
            done = whole.arranged([a, b], ORDERS["spm"])
            assert done.content() == b"<S>" + content[b:] + b"<P>" + content[:a] + b"<M>" + content[a:b]
            assert done.buffers is whole.buffers  # nothing was copied
    assert whole.find(b"h<P>a") == 3  # across three descriptors


def test_odd_rows(spark):
    ship(spark)
    long = "x" * 3_000_000 + "\n" + "y z\n" * 100_000
    data = [(1, "a\nb\nc", "k"), (2, None, "k"), (3, "", "k"), (None, "p\nq\n", "k"), (LARGE + 1, "u\n\nv", "k"), (LARGE + 2, "<M>", "k"), (5, long, "k"), (1, "a\nb\nc", "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, n string")
    rows = piecetable.transform(docs).collect()
    assert sorted((r._row.doc_id or -1, r._row.text or "", *map(str, r._fim)) for r in rows) == sorted((i or -1, t or "", *map(str, brute(i, t))) for i, t, _ in data)
    back = piecetable.restored_texts(piecetable.transform(docs)).collect()
    assert all(r._restored == (r._row.text or "") and r._row.n == "k" for r in back)
    digests = piecetable.transform_digests(docs).collect()
    assert sorted((r._row.doc_id or -1, r._fim.output_sha256, r._fim.restored_sha256) for r in digests) == sorted((i or -1, sha(brute(i, t)[4]), sha(t or "")) for i, t, _ in data)
    assert piecetable.transform_digests(docs.limit(0)).count() == 0


def test_whole_table(spark):
    from shardtally.llm.queries import op12_fill_in_middle

    folder = "/root/testdata/sf0.01"
    want = {}
    for r in table(spark, folder, "documents").collect():
        n, form, prefix, middle, output = brute(r.doc_id, r.text)
        want[r.doc_id] = (r.doc_id, n, form, prefix, middle, sha(output), sha(r.text or ""))
    rows = op12_fill_in_middle(spark, folder)
    assert rows.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert {r.doc_id: tuple(r) for r in rows.collect()} == want
    assert {w[2] for w in want.values()} >= {"psm", "spm"}


def test_ambiguous_output_is_an_error():
    with pytest.raises(ValueError, match="<M> stands at 2 places"):
        restore("<P>a<S>b<M>c<M>d", "psm")
