"""The tree that op1_licence_scan makes of documents has real cases of inheritance."""

from collections import Counter

from shardtally.llm.common import table
from shardtally.llm.queries import licence_files, op1_licence_scan

FOLDER = "/root/testdata/sf0.01"


def test_rows_inherit_from_their_own_a_parent_and_a_farther_folder(spark):
    files = licence_files(table(spark, FOLDER, "documents")).select("path").collect()
    folders = Counter(r.path.rpartition("/")[0] for r in files)
    assert len(files) == 1000 and folders["shared/all"] == 334
    assert {f.count("/") for f in folders if f != "shared/all"} == {0, 1, 2} and sum(n > 10 for n in folders.values()) > len(folders) / 2
    rows = [r for r in op1_licence_scan(spark, FOLDER).collect() if r.how == "inherited"]
    up = Counter(r.path.rpartition("/")[0].removeprefix(r.licensed_by).count("/") for r in rows)
    assert min(up[0], up[1], up[2]) > 0, up
