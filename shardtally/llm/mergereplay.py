"""Byte-level BPE by replaying the merges over all words at once, and decoding.

Each task takes its share of the corpus, cuts the texts into pieces with the tokenizer's pattern,
and gathers the distinct pieces that it has not met before. All of them lie behind one another in
one array of token numbers, with links to the neighbours. An inverted index leads from the rank of
a pair to the places where it stands; merges are applied in rank order, each to all its places at
once, and only the neighbours of a place that was merged are looked up again. The pieces' token ids
are then put in the places of the pieces. A task keeps the ids of up to ``KEPT`` pieces from one chunk of
texts to the next, the first that it met, so common pieces are replayed once a task. The result
does not depend on how the corpus was shared out, so nothing is shuffled, and a task that is lost
is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import lean

CHUNK_CHARS = 4_000_000
REPLAY_BYTES = 2_000_000
KEPT, LONGEST = 200_000, 64


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def _pairs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that merge, as sorted codes, and their ranks."""
    ranks, found = _ranks(path), {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[(left << 32) | right] = rank
    codes = np.array(sorted(found), np.int64)
    return codes, np.array([found[c] for c in codes.tolist()], np.int64)


class MergeReplay:
    """Encodes sets of distinct pieces by the ranks in ``path``."""

    def __init__(self, path: str):
        self.rank = _ranks(path)
        self.bytes = {i: token for token, i in self.rank.items()}
        self.single = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        self.codes, self.code_ranks = _pairs(path)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where there is none."""
        if not len(self.codes):
            return np.full(len(left), -1)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.code_ranks[at], -1)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece; about ``REPLAY_BYTES`` are replayed together."""
        out, lo, size = [], 0, 0
        for hi, piece in enumerate(pieces, 1):
            size += len(piece)
            if size >= REPLAY_BYTES or hi == len(pieces):
                out += self._replay(pieces[lo:hi])
                lo, size = hi, 0
        return out

    def _replay(self, pieces: list[bytes]) -> list[list[int]]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        size = int(lengths.sum())
        if not size:
            return [[] for _ in pieces]
        token = np.append(self.single[np.frombuffer(b"".join(pieces), np.uint8)], -1)
        piece = np.append(np.repeat(np.arange(len(pieces)), lengths), -1)
        after = np.arange(1, size + 2)  # places to the right and to the left that still hold a token
        before = np.arange(-1, size)
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enter(places: np.ndarray) -> None:
            """Puts the pairs that begin at ``places`` into the index."""
            right = after[places]
            inside = piece[places] == piece[np.minimum(right, size)]
            places, right = places[inside], right[inside]
            ranks = self._look_up(token[places], token[right])
            order = np.argsort(ranks, kind="stable")
            order = order[ranks[order] >= 0]
            ranks, places = ranks[order], places[order]
            edges = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1)).tolist() if len(ranks) else []
            for a, b in zip(edges, edges[1:]):
                rank = int(ranks[a])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(queue, rank)
                index[rank].append(places[a:b])

        enter(np.arange(size))
        while queue:
            rank = heapq.heappop(queue)
            at = np.sort(np.concatenate(index.pop(rank)))
            at = at[(token[at] >= 0) & (piece[at] == piece[np.minimum(after[at], size)]) & np.append(True, at[1:] != at[:-1])]
            at = at[self._look_up(token[at], token[after[at]]) == rank]  # others have changed meanwhile
            if not len(at):
                continue
            touching = after[at[:-1]] == at[1:]
            if touching.any():  # of overlapping places every second one, from the left
                number = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(np.append(True, ~touching), number, 0))
                at = at[(number - begin) % 2 == 0]
            gone = after[at]
            token[at], token[gone] = rank, -1
            after[at] = after[gone]
            before[np.minimum(after[at], size)] = at
            left = before[at]
            enter(np.concatenate([at, np.setdiff1d(left[left >= 0], at, assume_unique=True)]))
        kept = token[:size] >= 0
        ends = np.cumsum(np.bincount(piece[:size][kept], minlength=len(pieces))).tolist()
        ids = token[:size][kept].tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class _Codes(dict):
    """Numbers of pieces, and what each becomes: how many ids, the ids as text, the bytes they decode to."""

    def __init__(self, replay: MergeReplay):
        super().__init__()
        self.replay, self.new = replay, []
        self.sizes, self.shown, self.plain = [], [], []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def encode_new(self) -> None:
        replay = self.replay
        pieces = [w.encode() for w in self.new]
        whole = [replay.rank.get(w) for w in pieces]  # a piece that is a token is that token
        rest = iter(replay.encode([w for w, one in zip(pieces, whole) if one is None]))
        for one in whole:
            ids = [one] if one is not None else next(rest)
            self.sizes.append(len(ids))
            self.shown.append(" ".join(map(str, ids)))
            self.plain.append(b"".join([replay.bytes[i] for i in ids]))
        self.new = []

    def forget(self) -> None:
        """Keeps the first ``KEPT`` pieces but very long ones."""
        if len(self) <= KEPT:
            return
        kept = [(w, i) for w, i in self.items() if len(w) <= LONGEST][:KEPT]
        for values in (self.sizes, self.shown, self.plain):
            values[:] = [values[i] for _, i in kept]
        self.clear()
        self.update((w, n) for n, (w, _) in enumerate(kept))


def _encoded(path: str, pattern: str):
    cut = regex.compile(pattern)

    def chunk(codes: _Codes, texts: list[str]) -> pd.DataFrame:
        lines = [[*map(codes.__getitem__, cut.findall(text))] for text in texts]
        codes.encode_new()
        sizes, shown, plain = codes.sizes.__getitem__, codes.shown.__getitem__, codes.plain.__getitem__
        frame = pd.DataFrame(
            {
                "n_tokens": [sum(map(sizes, line)) for line in lines],
                "ids": [" ".join(map(shown, line)) for line in lines],
                "decoded": [b"".join(map(plain, line)) for line in lines],
            }
        )
        codes.forget()
        return frame

    @lean
    def batches(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes = _Codes(MergeReplay(path))
        for texts in columns:
            out, held, size = [], [], 0
            for text in texts:
                held.append(text or "")
                size += len(held[-1])
                if size > CHUNK_CHARS:
                    out.append(chunk(codes, held))
                    held, size = [], 0
            if held or not out:
                out.append(chunk(codes, held))
            yield pd.concat(out, ignore_index=True) if len(out) > 1 else out[0]

    return batches


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` as ``_row`` with ``_code``: n_tokens, ids (decimal, one blank between) and decoded (the bytes of the ids).

    ``path`` names a tiktoken rank file that every executor can open, ``pattern`` its pattern. Pieces
    are encoded separately and without special tokens. Null and empty texts have no ids; texts of any
    length are taken whole; repeated rows and other columns, of any name, pass unchanged.
    """
    code = F.pandas_udf(_typed(_encoded(path, pattern)), "n_tokens long, ids string, decoded binary")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.select("_row", code("_row.text").alias("_code"))


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Like ``encode_texts``, with SHA-256 digests in place of ids and decoded bytes."""
    encoded = _encoded(path, pattern)

    def digests(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for frame in encoded(columns):
            yield pd.DataFrame(
                {
                    "n_tokens": frame["n_tokens"],
                    "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in frame["ids"]],
                    "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in frame["decoded"]],
                }
            )

    code = F.pandas_udf(_typed(digests), "n_tokens long, ids_sha256 string, decoded_sha256 string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.select("_row", code("_row.text").alias("_code"))


def _typed(function):
    """Says to Spark that ``function`` maps an iterator of text columns to an iterator of frames."""
    function.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return function
