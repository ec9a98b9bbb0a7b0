"""Licence scans: TF-IDF cosine of lines, windows and whole texts to licence templates, then inheritance by directory.

A text is cut into lines, and each line is compared with the short notices (``TEMPLATES``) as a sparse
TF-IDF vector. Windows of the text's words, lines joined and comment marks gone, are compared with the
notices, with further ones (``NOTICES``) and with the licences' full texts (``licence_texts``), each in
windows of its own length; the whole text is compared with the full texts as well. An SPDX tag names its
licence. Windows of short notices start at every word, others at every eighth part of their length; a
template is left out where the words that a text shares with it cannot reach the least cosine anywhere.

The document frequencies of the templates' words are counted over all texts; a word outside the
templates weighs as one that no text has, so that a line that merely mentions a licence stays far
from its template. A file whose matching lines and windows hold at least half of its words, or whose name says
so, is a licence file, and licenses its directory. Files without a match of their own take the licence of
the nearest ancestor directory that has one; directories are resolved first, so the joins by path see
each directory once, however many files it holds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally.sources.workspace import stored

LEAST = 0.6
#: A directory with more than this share of all files is crowded.
CROWDED = 0.01
HEADER_LINES = 20
NAMES = r"(?i)^(licen[cs]e|copying|copyright|notice)([.-].*)?$"
#: Notices by which these licences are named.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International License"],
}
#: No licence, but a note that there is none: in a column of its own.
RESERVED = "all-rights-reserved"
#: Notices that are looked for in windows only.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": ["Licensed under the MIT License", "Distributed under the MIT license", "This code is free under the MIT license"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License",
    ],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License"],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Licensed under CC0 1.0",
        "CC0 1.0 Universal Public Domain Dedication",
    ],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    RESERVED: ["All rights reserved."],
}
#: Words a template has at least to be a full text, and a window's least cosine by its words: a short notice has to be there almost word for word.
FULL, SHORT = 100, 12
WINDOW_LEAST, SHORT_LEAST = 0.8, 0.9
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+()-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+()-]+)*)")
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def vocabulary(templates: dict[str, list[str]]) -> list[str]:
    return sorted({w for texts in templates.values() for t in texts for w in words_of(t)})


def full_texts() -> dict[str, list[str]]:
    """The licences' whole texts. BSD-2-Clause is BSD-3-Clause without its third clause; AGPL-3.0 is GPL-3.0 under its other name."""
    texts = {p.stem: p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    texts["BSD-2-Clause"] = re.sub(r"(?s)3\. Neither.*?(?=\n\nTHIS SOFTWARE)", "", texts["BSD-3-Clause"])
    texts["AGPL-3.0"] = re.sub("(?i)(gnu) (general public)", r"\1 Affero \2", texts["GPL-3.0"])
    texts["ISC"] = NOTICES["ISC"][0] + (
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
        " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
        " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    )
    return {name: [text] for name, text in texts.items()}


def united(*tables: dict[str, list[str]]) -> dict[str, list[str]]:
    return {name: [t for table in tables for t in table.get(name, [])] for name in sorted({n for table in tables for n in table})}


class Windows:
    """All templates against windows of a text's words, and the full ones against the whole text."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[str, int], n: int):
        weight = {w: math.log((1 + n) / (1 + frequency.get(w, 0))) + 1 for w in vocabulary(templates)}
        self.weight, self.unknown = weight, math.log(1 + n) + 1
        self.templates = []
        for name in sorted(templates):
            for words in map(words_of, templates[name]):
                vector = {w: (1 + math.log(c)) * weight[w] for w, c in Counter(words).items()}
                norm = math.sqrt(sum(x * x for x in vector.values()))
                least = SHORT_LEAST if len(words) < SHORT else WINDOW_LEAST
                self.templates.append((name, len(words), {w: x / norm for w, x in vector.items()}, least))
        self.words = frozenset(weight)
        self.squares: dict[str, list[tuple[int, float]]] = {}
        for at, (_, _, template, _) in enumerate(self.templates):
            for w, x in template.items():
                self.squares.setdefault(w, []).append((at, x * x))

    def cosine(self, words: list[str], template: dict[str, float]) -> float:
        dot = norm = 0.0
        for word, n in Counter(words).items():
            x = (1 + math.log(n)) * self.weight.get(word, self.unknown)
            norm += x * x
            dot += x * template.get(word, 0.0)
        return round(dot / math.sqrt(norm), 9) if norm else 0.0

    def text(self, words: list[str]) -> list[tuple[float, int, int, str, int]]:
        """(cosine, first word, end, name, template's words) of every window of a text's ``words`` that matches.

        No window has a larger cosine to a template than the template's part in the words that the text holds at all.
        """
        reach = [0.0] * len(self.templates)
        for w in self.words.intersection(words):
            for at, square in self.squares[w]:
                reach[at] += square
        found = []
        for (name, size, template, least), most in zip(self.templates, reach):
            if most < least * least - 1e-9:
                continue
            last = max(0, len(words) - size)
            step = 1 if size <= 2 * SHORT else size // 8
            # A template's rare words: a window without any of them cannot reach the least cosine.
            rare, rest = set(), 1.0
            for w in sorted(template, key=lambda w: (-template[w], w)):
                if rest < least * least:
                    break
                rare.add(w)
                rest -= template[w] ** 2
            near = [0]
            for w in words:
                near.append(near[-1] + (w in rare))
            for at in sorted({*range(0, last, step), last}):
                if near[min(len(words), at + size)] > near[at]:
                    score = self.cosine(words[at : at + size], template)
                    if score >= least:
                        found.append((score, at, min(len(words), at + size), name, size))
            if size >= FULL and (score := self.cosine(words, template)) >= least:
                found.append((score, 0, len(words), name, size))
        return found


class Matcher:
    """The templates' vectors for given document frequencies."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[str, int], n: int, windows: Windows | None = None):
        self.windows = windows
        self.weight = {w: math.log((1 + n) / (1 + frequency.get(w, 0))) + 1 for w in vocabulary(templates)}
        self.unknown = math.log(1 + n) + 1
        self.index: dict[str, list[tuple[int, float]]] = {}
        self.names, norms = [], []
        for name in sorted(templates):
            for text in templates[name]:
                vector = self.vector(Counter(words_of(text)))
                for word, x in vector.items():
                    self.index.setdefault(word, []).append((len(self.names), x))
                self.names.append(name)
                norms.append(math.sqrt(sum(x * x for x in vector.values())))
        self.norms = norms

    def vector(self, counts: Counter) -> dict[str, float]:
        return {w: (1 + math.log(n)) * self.weight.get(w, self.unknown) for w, n in counts.items()}

    def line(self, words: list[str]) -> tuple[float, str | None, int]:
        """(cosine, name, words) of the template most like a line's ``words``; ties go to the smaller name."""
        vector = self.vector(Counter(words))
        dots: dict[int, float] = {}
        for word, x in vector.items():
            for at, y in self.index.get(word, ()):
                dots[at] = dots.get(at, 0.0) + x * y
        if not dots:
            return 0.0, None, len(words)
        norm = math.sqrt(sum(x * x for x in vector.values()))
        score, at = max((d / (norm * self.norms[at]), -at) for at, d in dots.items())
        return round(score, 9), self.names[-at], len(words)

    def text(self, text: str | None, least: float) -> tuple[str | None, float, int | None, float, bool]:
        """(licence, cosine, number of its first line, share of the text's words in matching lines and windows, all rights reserved).

        A full text counts before an SPDX tag, a tag before notices, and those by cosine, then by the longer template:
        a short notice may be a part of another licence.
        """
        best, inside, total, starts, reserved, every = ((), 0.0, None, None), [], 0, [], False, []
        for number, line in enumerate((text or "").split("\n")):
            words = words_of(line)
            every += words
            score, name, n = self.line(words)
            starts.append(total)
            if score >= least:
                inside.append((total, total + n))
                best = max(best, ((1, score, 0, -number), score, number, name), key=lambda b: b[0])
            total += n
        for score, at, end, name, size in self.windows.text(every) if self.windows else ():
            if name == RESERVED:
                reserved = True
                continue
            number = bisect_right(starts, at) - 1
            kind = 3 if size >= FULL else 1
            inside.append((at, end))
            best = max(best, ((kind, score, size, -number), score, number, name), key=lambda b: b[0])
        for tag in SPDX.finditer(text or "") if self.windows else ():
            number = text.count("\n", 0, tag.start())
            n = len(words_of(tag.group()))
            at = starts[number] + len(words_of(text[text.rfind("\n", 0, tag.start()) + 1 : tag.start()]))
            inside.append((at, at + n))
            best = max(best, ((2, 1.0, n, -number), 1.0, number, tag.group(1)), key=lambda b: b[0])
        held, upto = 0, 0
        for at, end in sorted(inside):
            held += max(0, end - max(at, upto))
            upto = max(upto, end)
        return best[3], best[1], best[2], held / total if total else 0.0, reserved


def _frequencies(words: list[str]):
    known = frozenset(words)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch["text"]:
                counts.update(known.intersection(words_of(text or "")))
            yield pd.DataFrame({"word": [*counts, None], "n": [*counts.values(), len(batch)]})

    return rows


def frequencies(docs: DataFrame, templates: dict[str, list[str]]) -> tuple[dict[str, int], int]:
    """(texts that hold each template word, texts), over all of ``docs``."""
    rows = docs.select("text").mapInPandas(_frequencies(vocabulary(templates)), "word string, n long")
    found = {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = found.pop(None, 0)
    return found, total


def _scans(matcher: Matcher, least: float):
    def scans(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([matcher.text(t, least) for t in texts], columns=["licence", "cosine", "line", "share", "reserved"]).astype({"line": "Int64", "cosine": float, "share": float})

    return F.pandas_udf(scans, "licence string, cosine double, line long, share double, reserved boolean")


def ancestors(path: str | Column) -> Column:
    """A directory and all above it, down from the root (the empty path)."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def _inherited(rows: DataFrame, nearest: DataFrame) -> DataFrame:
    """``rows`` with the ``nearest`` licence of their directory.

    Directories with more than ``CROWDED`` of all rows, 1 / ``CROWDED`` of them at most, are few enough to be sent to the rows.
    """
    counts = rows.where("directory is not null").groupBy("directory").agg(F.count("*").alias("n"))
    least = CROWDED * (counts.agg(F.sum("n")).first()[0] or 0)
    crowded = F.coalesce(F.col("directory").isin([r.directory for r in counts.where(F.col("n") > least).collect()]), F.lit(False))
    quiet = rows.where(~crowded).join(nearest, "directory", "left")
    return quiet.union(rows.where(crowded).join(F.broadcast(nearest.where(crowded)), "directory", "left").select(quiet.columns))


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """One row per row of ``files`` (file_id, path, text): file_id, path, own_licence, cosine, line,
    is_header (within the first ``HEADER_LINES`` lines), rights_reserved (it says so), is_licence_file, licence, licensed_by and how.

    ``licence`` is the file's own (``how`` = own), else that of the nearest ancestor directory with a
    licence file (inherited; ``licensed_by`` is that directory), else null (none). Of several licence files
    in a directory the highest cosine counts, then the smaller licence name. Null and empty texts match
    nothing; a null path lies in no directory and inherits nothing; repeated rows get equal results. Other columns are
    not looked at; an empty table gives an empty result.
    """
    wide = united(TEMPLATES, NOTICES, full_texts()) if templates is None else templates
    templates = TEMPLATES if templates is None else templates
    own = files.select("file_id", "path", "text")
    counts = frequencies(own, united(templates, wide))
    matcher = Matcher(templates, *counts, Windows(wide, *counts))
    rows = own.select("file_id", "path", _scans(matcher, least)("text").alias("s"))
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    named = F.coalesce(F.regexp_extract("path", "[^/]*$", 0).rlike(NAMES), F.lit(False))
    rows = rows.select(
        "file_id",
        "path",
        directory.alias("directory"),
        F.col("s.licence").alias("own_licence"),
        F.col("s.cosine").alias("cosine"),
        F.col("s.line").alias("line"),
        F.coalesce(F.col("s.line") < HEADER_LINES, F.lit(False)).alias("is_header"),
        F.col("s.reserved").alias("rights_reserved"),
        (F.col("s.licence").isNotNull() & ((F.col("s.share") >= 0.5) | named)).alias("is_licence_file"),
    )
    rows = stored(rows, "scans")
    licensing = rows.where(F.col("is_licence_file") & F.col("directory").isNotNull()).groupBy(F.col("directory").alias("above"))
    best = licensing.agg(F.min(F.struct((-F.col("cosine")).alias("far"), "own_licence")).alias("m")).select("above", F.col("m.own_licence").alias("licence"))
    nested = rows.where("own_licence is null and directory is not null").select("directory").distinct()
    # the root is above every directory: its licence is one value, and no key of a join
    root = best.where("above = ''").first()
    above_all = F.struct(F.lit("").alias("above"), F.lit(root and root.licence).alias("licence"))
    above = nested.select("directory", F.explode(ancestors("directory")).alias("above")).where("above <> ''")
    nearest = above.join(best, "above").groupBy("directory").agg(F.max_by(F.struct("above", "licence"), F.length("above")).alias("_from"))
    result = _inherited(rows, nearest).withColumn("_from", F.coalesce("_from", F.when(F.col("directory").isNotNull() & F.lit(root is not None), above_all)))
    has_own = F.col("own_licence").isNotNull()
    return result.select(
        "file_id",
        "path",
        "own_licence",
        "cosine",
        "line",
        "is_header",
        "rights_reserved",
        "is_licence_file",
        F.when(has_own, F.col("own_licence")).otherwise(F.col("_from.licence")).alias("licence"),
        F.when(~has_own, F.col("_from.above")).alias("licensed_by"),
        F.when(has_own, "own").when(F.col("_from").isNotNull(), "inherited").otherwise("none").alias("how"),
    )
