"""Licence scans: cosines by hand, inheritance against walking up the tree."""

import math
from collections import Counter

from shardtally.llm import licences
from shardtally.llm.common import ship


def cosine(line, template, frequency, n):
    def vector(text):
        counts = Counter(licences.words_of(text))
        return {w: (1 + math.log(c)) * (math.log((1 + n) / (1 + frequency.get(w, 0))) + 1) for w, c in counts.items()}

    a, b = vector(line), vector(template)
    return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


def brute(rows, least=licences.LEAST):
    words = set(licences.vocabulary(licences.TEMPLATES))
    frequency = Counter(w for _, _, t in rows for w in words & set(licences.words_of(t or "")))
    scans, dirs = [], {}
    for file_id, path, text in rows:
        best, inside, total = (0, None, None), 0, 0
        for number, line in enumerate((text or "").split("\n")):
            n = len(licences.words_of(line))
            total += n
            scored = [(round(cosine(line, t, frequency, len(rows)), 9), name) for name, ts in licences.TEMPLATES.items() for t in ts] if n else [(0, None)]
            score = max(s for s, _ in scored)
            if score >= least:
                inside += n
                if score > best[0]:
                    best = (score, number, min(x for s, x in scored if s == score))
        folder = None if path is None else path.rpartition("/")[0]
        is_file = best[2] is not None and inside / total >= 0.5
        if is_file and folder is not None:
            dirs.setdefault(folder, []).append((-best[0], best[2]))
        scans.append((file_id, path, folder, best, is_file))
    out = []
    for file_id, path, folder, best, is_file in scans:
        licence, by, how = best[2], None, "own"
        if licence is None:
            how = "none"
            up = folder
            while up is not None:
                if up in dirs:
                    licence, by, how = min(dirs[up])[1], up, "inherited"
                    break
                up = None if up == "" else up.rpartition("/")[0]
        out.append((file_id, best[2], is_file, licence, by, how))
    return sorted(out, key=str)


ROWS = [
    (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0.\n"),
    (2, "a/b/c/x.txt", "words of prose\nmore"),
    (3, "a/b/y.txt", "Released under the MIT license\n" + "prose and prose " * 50),
    (4, "a/b/c/d/z.txt", ""),
    (5, "top.txt", None),
    (6, None, "no path"),
    (7, "q/r", "we mention a license here and the public too"),
    (8, "a/b/c/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (8, "a/b/c/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (9, "a/b/c/d/e/f/g", "x " * 100_000),
    (10, "a/second", "Licensed under CC BY-NC 4.0."),
    (None, "a/b/n", "prose"),
]


def test_like_walking_up(spark):
    ship(spark)
    files = spark.createDataFrame([(*r, "x") for r in ROWS], "file_id long, path string, text string, licence string").repartition(3)
    got = licences.scan(files).select("file_id", "own_licence", "is_licence_file", "licence", "licensed_by", "how").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    assert {r.file_id: r.licensed_by for r in got}[9] == "a/b/c/d"
    assert licences.scan(files.limit(0)).count() == 0


def test_root_directory_and_line_numbers(spark):
    ship(spark)
    files = spark.createDataFrame([(1, "LICENSE", "Released under the MIT License."), (2, "x/y", "a\n" * 30 + "Licensed under CC BY 4.0."), (3, "x/z", "p")], "file_id long, path string, text string")
    rows = {r.file_id: r for r in licences.scan(files).collect()}
    assert (rows[2].line, rows[2].is_header, rows[3].licence, rows[3].licensed_by) == (30, False, "MIT", "")


GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_wrapped_embedded_and_full_texts(spark):
    ship(spark)
    prose = "some words of prose that say nothing at all about terms " * 20
    full = {n: t for n, [t] in licences.full_texts().items()}
    header = "/* This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/. */"
    cases = {
        "GPL-3.0": [GPL + "\n" + prose, prose + "\n" + GPL],
        "LGPL-3.0": [GPL.replace("GNU General", "GNU Lesser General") + "\n" + prose],
        "AGPL-3.0": [GPL.replace("GNU General", "GNU Affero General") + "\n" + prose],
        "GPL-2.0": [GPL.replace("version 3", "version 2") + "\n" + prose],
        "MPL-2.0": [header + "\n" + prose],
        "Apache-2.0": [f"{prose} Copyright 2020 Someone. Licensed under the Apache License, Version 2.0. See the LICENSE file for details. {prose}", "// SPDX-License-Identifier: Apache-2.0\n" + prose],
        "MIT": ["# SPDX-License-Identifier: MIT\n" + prose, prose + " ".join(full["MIT"].split()) + prose],
        "MIT OR Apache-2.0": ["// SPDX-License-Identifier: MIT OR Apache-2.0\n" + prose],
        "ISC": ["Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n" + prose],
        None: ["Copyright (c) 2020 Someone. All rights reserved.\n" + prose],
    }
    cases = [(name, text, False) for name, texts in cases.items() for text in texts] + [(name, text, True) for name, text in full.items()]
    cases += [(None, "the license under which the public may read this is a free one\n" + prose, False)]
    rows = [(i, f"d{i}/f", text) for i, (_, text, _) in enumerate(cases)] + [(1000 + i, f"p{i}/f", prose + f"n{i}") for i in range(300)]
    found = licences.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()
    got = {r.file_id: (r.own_licence, r.is_licence_file) for r in found}
    assert all(r.rights_reserved == ("all rights reserved" in " ".join(dict(enumerate(t for _, t, _ in cases)).get(r.file_id, "").lower().split())) for r in found)
    assert [got[i] for i in range(len(cases))] == [(name, whole) for name, _, whole in cases]
    assert all(got[1000 + i] == (None, False) for i in range(300))


def test_whole_table(spark):
    from shardtally.llm.queries import licence_files, op1_licence_scan

    rows = [tuple(r) for r in licence_files(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select("file_id", "path", "text").collect()]
    got = op1_licence_scan(spark, "/root/testdata/sf0.001").select("file_id", "own_licence", "is_licence_file", "licence", "licensed_by", "how").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_crowded_directories_and_the_root_inherit_alike(spark, monkeypatch):
    ship(spark)
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software\n"
    files = [(1, "LICENSE", "SPDX-License-Identifier: MIT"), (2, "a/LICENSE", "SPDX-License-Identifier: Apache-2.0"), (3, "a/b/x", "none"), (4, "c/x", None), (5, None, "x")]
    files += [(100 + i, f"a/many/f{i}", "text") for i in range(60)] + [(200 + i, f"top{i}", "text") for i in range(40)] + [(300, "c/d/e/f", notice)]
    df = spark.createDataFrame(files, "file_id long, path string, text string")
    results = []
    for share in (0.01, 1.0):
        monkeypatch.setattr(licences, "CROWDED", share)
        results.append(sorted(map(str, licences.scan(df).collect())))
    assert results[0] == results[1]
    by_id = {r.file_id: r for r in licences.scan(df).collect()}
    assert by_id[4].how == "inherited" and by_id[4].licensed_by == "" and by_id[4].licence == by_id[1].licence
    assert by_id[130].licensed_by == "a" and by_id[3].licensed_by == "a" and by_id[210].licensed_by == "" and by_id[5].how == "none"
    assert all(r.how != "inherited" for r in licences.scan(df.where("file_id >= 3")).collect())


def test_windows_need_no_word_in_particular():
    """A full text whose telling words are gone is found as long as its cosine allows."""
    texts = licences.full_texts()
    windows = licences.Windows(licences.united(licences.TEMPLATES, licences.NOTICES, texts), {}, 1)
    words = [w for w in licences.words_of(texts["MIT"][0]) if not w.startswith(("licen", "permission", "copyright", "redistribut"))]
    assert any(name == "MIT" for _, _, _, name, _ in windows.text(["prose"] * 50 + words))
    assert windows.text([]) == [] and windows.text(["prose"] * 50) == []
