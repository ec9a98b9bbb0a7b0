"""Fill-in-the-middle transformation on piece tables.

A piece table describes a text without copying it: a list of descriptors (buffer, start, end) over
buffers that never change, here the document itself and one buffer with the sentinels. A cut splits
the descriptors at an offset, an arrangement permutes the groups between the cuts and puts sentinel
descriptors before them, and the inverse permutation brings the text back. Only where a text is
asked for, or hashed, are the described bytes visited, descriptor by descriptor.

    psm:  <P> prefix <S> suffix <M> middle
    spm:  <S> suffix <P> prefix <M> middle
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: the sentinels, units, seed, and the forms as orders of (prefix, middle, suffix).
SENTINELS = ("<P>", "<M>", "<S>")
UNIT = re.compile(rb"[^\n]*\n|[^\n]+")
SEED = 7
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
FIM_PERCENT, SPM_PERCENT = 100, 50

TEXT, MARKS = 0, 1
_MARKS = b"".join(s.encode() for s in SENTINELS)
_MARK_AT = [0, *accumulate(len(s.encode()) for s in SENTINELS)]

Piece = tuple[int, int, int]


@dataclass(frozen=True)
class PieceTable:
    """Immutable buffers and the descriptors (buffer, start, end) that make up the text."""

    buffers: tuple[bytes, bytes]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls((text, _MARKS), ((TEXT, 0, len(text)),) if text else ())

    def parts(self, cuts: list[int]) -> list[list[Piece]]:
        """The descriptors between ascending offsets ``cuts``, those that a cut meets split in two."""
        out: list[list[Piece]] = [[]]
        at, left = 0, list(cuts)
        for buffer, start, end in self.pieces:
            while left and left[0] < at + end - start:
                middle = start + left.pop(0) - at
                if middle > start:
                    out[-1].append((buffer, start, middle))
                    at += middle - start
                out.append([])
                start = middle
            if end > start:
                out[-1].append((buffer, start, end))
            at += end - start
        return out + [[] for _ in left]

    def arranged(self, cuts: list[int], order: tuple[int, ...]) -> PieceTable:
        """The parts between the cuts in ``order``, the sentinel of each part before it."""
        parts = self.parts(cuts)
        marked = ([(MARKS, _MARK_AT[i], _MARK_AT[i + 1]), *parts[i]] for i in order)
        return PieceTable(self.buffers, tuple(chain.from_iterable(marked)))

    def restored(self, order: tuple[int, ...]) -> PieceTable:
        """The inverse of ``arranged`` for a table of the output's text: its sentinels are found, cut out, and its parts put back."""
        marks = [SENTINELS[i].encode() for i in order]
        begins = [self.find(mark) for mark in marks]
        ends = [begin + len(mark) for begin, mark in zip(begins, marks)]
        parts = self.parts(list(chain.from_iterable(zip(begins, ends))))[2::2]
        inverse = sorted(range(len(order)), key=order.__getitem__)
        return PieceTable(self.buffers, tuple(chain.from_iterable(parts[i] for i in inverse)))

    def find(self, mark: bytes) -> int:
        """Offset of the only place where ``mark`` stands; it may lie across descriptors."""
        at, tail, found = 0, b"", []
        for chunk in self.chunks():
            view = tail + bytes(chunk)
            base = at - len(tail)
            hit = view.find(mark)
            while hit >= 0:
                found.append(base + hit)
                hit = view.find(mark, hit + 1)
            at += len(chunk)
            tail = view[len(view) - min(len(view), len(mark) - 1) :]
        if len(found) != 1:
            raise ValueError(f"{mark.decode()} stands at {len(found)} places")
        return found[0]

    def chunks(self) -> Iterator[memoryview]:
        views = tuple(map(memoryview, self.buffers))
        return (views[buffer][start:end] for buffer, start, end in self.pieces)

    def content(self) -> bytes:
        return b"".join(self.chunks())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks():
            digest.update(chunk)
        return digest.hexdigest()


def dice(doc_id: int | None) -> list[int]:
    """h1 to h4 of a document; a null id is written ``null``."""
    digest = hashlib.sha256(f"{SEED}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


@dataclass(frozen=True)
class Arrangement:
    """What the transformation makes of one document."""

    n: int
    form: str
    cuts: tuple[int, int] | None
    table: PieceTable

    def chars(self) -> tuple[int, int] | tuple[None, None]:
        """Code points of prefix and middle."""
        if self.cuts is None:
            return None, None
        text, (a, b) = self.table.buffers[TEXT], self.cuts
        return code_points(text[:a]), code_points(text[a:b])


def code_points(raw: bytes) -> int:
    return len(raw.decode())


def arrange(doc_id: int | None, text: str | None) -> Arrangement:
    """The piece table of the transformed document."""
    raw = (text or "").encode()
    ends = [m.end() for m in UNIT.finditer(raw)]  # of whole UTF-8 sequences: a unit ends at a line feed or the end
    n, source = len(ends), PieceTable.of(raw)
    h1, h2, h3, h4 = dice(doc_id)
    if not raw or any(s.encode() in raw for s in SENTINELS) or h3 % 100 >= FIM_PERCENT:
        return Arrangement(n, "plain", None, source)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    bounds = [0, *ends]
    cuts = (bounds[a], bounds[b])
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    return Arrangement(n, form, cuts, source.arranged(list(cuts), ORDERS[form]))


def restore(output: str | bytes, form: str) -> PieceTable:
    """A piece table of the document's text over the buffer of its ``output``."""
    raw = output.encode() if isinstance(output, str) else output
    source = PieceTable.of(raw)
    return source if form == "plain" else source.restored(ORDERS[form])


#: Ids reach Python as decimal text, since a nullable long would become a double on the way.
_ID = "cast({} as string)"


def _ids(ids: pd.Series) -> Iterator[int | None]:
    return (None if i is None else int(i) for i in ids)


def _transformed(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
    out = []
    for doc_id, text in zip(_ids(ids), texts):
        done = arrange(doc_id, text)
        out.append((done.n, done.form, *map(_shown, done.chars()), done.table.content().decode()))
    return pd.DataFrame(out, columns=["n", "form", "prefix_chars", "middle_chars", "output"]).astype({"prefix_chars": "Int64", "middle_chars": "Int64"})


def _shown(value: int | None):
    return pd.NA if value is None else value


def _digests(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
    out = []
    for doc_id, text in zip(_ids(ids), texts):
        done = arrange(doc_id, text)
        # the output alone, read anew, has to give the text back
        back = restore(done.table.content(), done.form)
        out.append((done.n, done.form, *map(_shown, done.chars()), done.table.sha256(), back.sha256()))
    columns = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return pd.DataFrame(out, columns=columns).astype({"prefix_chars": "Int64", "middle_chars": "Int64"})


def _restored(outputs: pd.Series, forms: pd.Series) -> pd.Series:
    return pd.Series([restore(o, f).content().decode() for o, f in zip(outputs, forms)], dtype=object)


def transform(docs: DataFrame) -> DataFrame:
    """``docs`` as ``_row`` with ``_fim``: n, form, prefix_chars, middle_chars and output.

    Units are lines; the cuts and the form follow from the document's id. A text that is null, empty or
    holds a sentinel stays plain (null counts as empty), and its lengths are null. A null id takes part
    with the seed ``null``; repeated rows get equal results; texts of any length are taken whole; other
    columns, of any name, pass unchanged; an empty table gives an empty result.
    """
    return _with(docs, _transformed, "n long, form string, prefix_chars long, middle_chars long, output string")


def transform_digests(docs: DataFrame) -> DataFrame:
    """Like ``transform``, with SHA-256 digests of the output and of the text rebuilt from it."""
    return _with(docs, _digests, "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def _with(docs: DataFrame, function, schema: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.select("_row", F.pandas_udf(function, schema)(F.expr(_ID.format("_row.doc_id")), F.col("_row.text")).alias("_fim"))


def restored_texts(rows: DataFrame, output: str = "_fim.output", form: str = "_fim.form") -> DataFrame:
    """``rows`` with ``_restored``, the text rebuilt from output and form alone."""
    return rows.withColumn("_restored", F.pandas_udf(_restored, "string")(F.col(output), F.col(form)))
