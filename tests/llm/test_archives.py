"""ARC to WARC: round trips, broken files, and the revisit rule against brute force."""

import base64
import hashlib

import pytest

from shardtally.llm import archives
from shardtally.llm.common import ship


def brute(rows, least=0):
    out = []
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    for i, p in payloads:
        ids = [j for j, q in payloads if q == p and j is not None]
        revisit = len(p) >= least and bool(ids) and i != max(ids)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=str)


def test_like_brute_force(spark):
    ship(spark)
    rows = [(i, f"http://a b/{i}", f"<p>é {i % 7}\n\r\n\r\n</p>") for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", None), (None, "u", "alone"), (None, "u", rows[0][2]), rows[59], (103, "u", "x" * 3_000_000), (104, "u", "\x00\n1 2 3\n")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    for least in (0, 5):
        assert sorted(map(tuple, archives.through_warc(pages, least).collect()), key=str) == brute(rows, least)
    assert archives.through_warc(pages.limit(0)).count() == 0


def test_large_ids_beside_null_ones_and_broken_records(spark):
    ship(spark)
    big = 2**60
    rows = [(big + 1, "u", "same"), (big + 2, "u", "same"), (big + 3, "u", "own"), (None, "u", "same"), (None, "u", "null only"), (-(2**63), "u", "least"), (2**63 - 1, "u", "least")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert sorted(map(tuple, archives.through_warc(pages).collect()), key=str) == brute(rows)
    files = archives.write_arc(pages).collect()
    cut = [(bytes(f.content) + b"broken line\n",) for f in files] + [(None,), (b"",)]
    broken = spark.createDataFrame(cut, "content binary").coalesce(1)
    assert sorted((r.page_id for r in archives.read_arc(broken).where("error is null").collect()), key=str) == sorted((i for i, _, _ in rows), key=str)
    assert archives.read_arc(broken).where("error is not null").count() == len(files)
    out = archives.read_warc(archives.convert(broken)).collect()
    assert sorted(map(tuple, out), key=str) == brute(rows)


def test_members_longer_and_shorter_than_a_slice():
    bodies = [b"", b"x", bytes(range(256)) * 400, b"y" * 5_000_000, b"z"]
    members = [archives._gzip(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n" % len(b) + b + b"\r\n\r\n") for b in bodies]
    assert [block for _, block in archives.warc_records(b"".join(members))] == bodies
    with pytest.raises(ValueError, match="ends within"):
        list(archives.warc_records(b"".join(members)[:-3]))


def test_whole_table(spark):
    from shardtally.llm.queries import op4_arc_to_warc

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    out = op4_arc_to_warc(spark, "/root/testdata/sf0.01")
    assert out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)


def test_versions_and_broken_files():
    one = archives.arc_head(1, "a.arc", "20240101000000") + archives.arc_record(1, "http://x/", "2024", b"plain", "a.arc", 0)
    two = archives.arc_head(2, "b.arc", "20240101000000") + archives.arc_record(2, None, "20240203040506", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody", "b.arc", 9)
    (a,), (b,) = list(archives.arc_records(one)), list(archives.arc_records(two))
    assert (a["url"], a["payload"], archives.warc_date(a["archived"])) == ("http://x/", b"plain", "2024-01-01T00:00:00Z")
    assert (b["url"], b["payload"], archives.warc_date(b["archived"])) == ("-", b"body", "2024-02-03T04:05:06Z")
    assert "declared" in list(archives.arc_records(one[:-4]))[-1]["error"]
    assert "no header" in list(archives.arc_records(b"x y z\n"))[0]["error"]
    wrong = archives.arc_head(2, "c.arc", "2024") + archives.arc_record(1, "u", "2024", b"plain", "c.arc", 0)
    assert "fields" in list(archives.arc_records(wrong))[0]["error"]
    assert list(archives.arc_records(b"")) == []


def test_names_and_offsets_of_written_archives(spark):
    ship(spark)
    pages = spark.createDataFrame([(i, "filedesc://x" if i == 5 else "u", "é" * i) for i in range(20)], "page_id long, url string, html string")
    files = archives.write_arc(pages.repartition(2)).collect()
    assert len({f.archive for f in files}) == len(files) > 2
    found = 0
    for file in files:
        for line in [x for x in file.content.split(b"\n") if len(x.split(b" ")) == 10 and not x.startswith(b"URL")]:
            fields = line.decode().split(" ")
            assert file.content[int(fields[7]) :].startswith(line) and fields[8] == file.archive
            found += 1
    assert found == 10
    assert sorted(r["page_id"] for f in files for r in archives.arc_records(bytes(f.content))) == list(range(20))
