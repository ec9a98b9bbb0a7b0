"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``width`` consecutive words. Its minimiser is the smallest hash among its ``MER``-word
pieces. Consecutive windows with one minimiser form a super-k-mer, which travels as one packed
string to the bucket of that minimiser; equal windows have equal minimisers, so each bucket can
sort and count its windows without asking any other.

1. ``minimiser_counts``: super-k-mers per minimiser. Those with more than ``HOT`` are entered in a
   Bloom filter of ``FILTER_BITS`` bits, which every task holds. One that is entered by mistake is
   merely dealt like a hot one.
2. ``_deal``: a row for each super-k-mer, with its words as one string, compressed with a dictionary that
   all tasks share; Spark's shuffle takes the rows to their buckets, so there is no more to a row
   however many buckets there are. Windows of hot
   minimisers go by their own 128-bit digest instead, and a task sends each such window once
   however often it has it, so that no bucket receives more than one entry per task and window.
3. ``_count``: a bucket fingerprints and sorts its windows, compares neighbours with equal
   fingerprints byte by byte, and reports where repeated ones start.
4. The starts are joined back to the texts.

Texts are handled as arrays of bytes: blanks, word hashes and fingerprints come from numpy, without an
object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import lean, parallel, release, row_key
from shardtally.sources.workspace import stored

WIDTH = 35
MER = 4
HOT = 1000
FILTER_BITS = 2**26
CHUNK_BYTES = 1_500_000
BUCKET_WORDS = 300_000
SLICE_BYTES = 1_000_000
SENT = 200_000
#: The dictionary of the compression, and the texts (their first bytes) that it is trained on. It changes sizes only.
DICTIONARY_BYTES, TRAINING_TEXTS, TRAINING_BYTES = 100_000, 2000, 2000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xBF58476D1CE4E5B9)
_ODD = 0x9E3779B97F4A7C15
#: Fixed by the contract: the six bytes between words.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
DEALT = pa.schema([("bucket", pa.int64()), ("kind", pa.int8()), ("_k1", pa.int64()), ("_k2", pa.int64()), ("start", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
RANGES = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
MERS, WINDOWS, KNOWN = 0, 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    return x ^ (x >> np.uint64(29))


_BYTE = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * _MIX))


_held = [np.ones(1, np.uint64)] * 2


def _powers(size: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64; the longest made so far are kept."""
    if len(_held[0]) < size:
        for i, x in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            _held[i] = np.cumprod(np.append(np.uint64(1), np.full(2 * size, x, np.uint64)))
    return _held


def prints_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the stretches [begin, end) of ``data``, both ascending: equal for equal bytes.

    Taken from prefix sums over about ``SLICE_BYTES`` at a time.
    """
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        j = max(int(np.searchsorted(begin, begin[i] + SLICE_BYTES)), i + 1)
        part = data[begin[i] : end[j - 1]]
        powers, inverse = _powers(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * powers[: len(part)], out=sums[1:])
        lo, hi = begin[i:j] - begin[i], end[i:j] - begin[i]
        out[i:j] = (sums[hi] - sums[lo]) * inverse[lo]
        i = j
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


class Chunk:
    """Some whole documents: their words with one blank after each, windows, minimisers and super-k-mers."""

    def __init__(self, keys: list[tuple], texts: list[bytes], width: int):
        self.width = width
        self.k1 = np.array([k[0] for k in keys], np.int64)
        self.k2 = np.array([k[1] for k in keys], np.int64)
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        blank = _BLANK[raw]
        ends = blank.copy()
        ends[0] = False
        ends[1:] &= ~blank[:-1]
        last = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)  # end of each document
        owner = np.searchsorted(last, np.flatnonzero(ends), side="right")
        self.text = np.where(blank, np.uint8(32), raw)[~blank | ends]
        self.end = np.flatnonzero(self.text == 32)  # the blank after each word
        self.begin = np.append(0, self.end + 1)[:-1]
        lengths = np.bincount(owner, minlength=len(texts))
        self.words = len(self.end)
        self.first = np.cumsum(lengths) - lengths
        mer = min(MER, width)
        windows = np.maximum(lengths - width + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), windows)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        self.at = self.first[self.doc] + inside  # first word of each window
        if not len(self.at):
            self.run = self.minimiser = np.zeros(0, np.int64)
            return
        hashes = _mixed(prints_of(self.text, self.begin, self.end))
        pieces = hashes[: len(hashes) - mer + 1].copy()
        for i in range(1, mer):
            pieces = pieces * _MIX + hashes[i : len(hashes) - mer + 1 + i]
        smallest = _sliding_min(_mixed(pieces), width - mer + 1)[self.at]
        new = np.ones(len(self.at), bool)
        new[1:] = (smallest[1:] != smallest[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.run = np.flatnonzero(new)  # index of each super-k-mer's first window
        self.minimiser = smallest[self.run].view(np.int64)

    def span(self, windows: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
        """Bytes from the first word of some windows to the blank after ``last`` ones."""
        return self.begin[self.at[windows]].tolist(), (self.end[self.at[last] + self.width - 1] + 1).tolist()


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Chunk]:
    keys, texts, size = [], [], 0
    for batch in batches:
        for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("_k1", "_k2", "_text"))):
            raw = text or b""
            keys.append((k1, k2))
            texts.append(raw)
            size += len(raw)
            if size > CHUNK_BYTES:
                yield Chunk(keys, texts, width)
                keys, texts, size = [], [], 0
    if keys:
        yield Chunk(keys, texts, width)


def _minimisers(width: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, width):
            values, counts = np.unique(chunk.minimiser, return_counts=True)
            values = pa.array(np.append(values, 0), mask=np.arange(len(values) + 1) == len(values))
            yield pa.RecordBatch.from_arrays([values, pa.array(np.append(counts, chunk.words).astype(np.int64))], ["minimiser", "n"])

    return rows


def minimiser_counts(keyed: DataFrame, width: int = WIDTH) -> DataFrame:
    """Super-k-mers per minimiser; the row without a minimiser counts the words."""
    rows = keyed.mapInArrow(_minimisers(width), "minimiser long, n long")
    return rows.groupBy("minimiser").agg(F.sum("n").alias("n"))


def _places(minimisers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each minimiser in a filter of so many bits."""
    own = minimisers.view(np.uint64)
    return tuple((_mixed(own ^ salt) % np.uint64(bits)).astype(np.int64) for salt in (_MIX, _MUL))


class Filter:
    """A Bloom filter of minimisers as words of 64 bits."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, minimisers: np.ndarray) -> np.ndarray:
        found = np.ones(len(minimisers), bool)
        for at in _places(minimisers, 64 * len(self.words)):
            found &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
        return found


def _filter_places(bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.ascontiguousarray(batch.column("minimiser").to_numpy(zero_copy_only=False), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(own, bits)))], ["at"])

    return rows


def hot_filter(hot: DataFrame, bits: int = FILTER_BITS) -> Filter | None:
    """The filter of the ``hot`` minimisers; at most bits / 64 rows reach the driver, however many there are."""
    at = hot.select("minimiser").mapInArrow(_filter_places(bits), "at long")
    words = at.groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits"))
    out, some = np.zeros(bits // 64, np.int64), False
    for row in words.toLocalIterator():
        out[row["word"]], some = row["bits"], True
    return Filter(out.view(np.uint64)) if some else None


def dictionary_of(keyed: DataFrame) -> bytes:
    """A dictionary for short strings of these texts; empty if there is too little text to train one."""
    some = keyed.select(F.substring("_text", 1, TRAINING_BYTES).alias("t")).where("length(t) > 0").limit(TRAINING_TEXTS).collect()
    parts = [bytes(r.t)[i : i + 300] for r in some for i in range(0, len(r.t), 300)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b""


class _Strings:
    """Short strings compressed one by one, with what they share in a dictionary."""

    def __init__(self, dictionary: bytes):
        held = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self._pack = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=False, write_dict_id=False, **held)
        self._unpack = zstandard.ZstdDecompressor(**held)

    def packed(self, strings: list[bytes]) -> list[bytes]:
        if not strings:
            return []
        if b"" in strings:  # which the function below does not take
            return [self._pack.compress(s) for s in strings]
        out = self._pack.multi_compress_to_buffer(strings)
        return [out[i].tobytes() for i in range(len(out))]

    def one(self, string: bytes) -> bytes:
        return self._unpack.decompress(string)

    def joined(self, strings: list[bytes]) -> bytes:
        """All strings behind one another."""
        if not strings:
            return b""
        out = self._unpack.multi_decompress_to_buffer(strings)
        return b"".join([out[i].tobytes() for i in range(len(out))])


class _Sent:
    """Hot windows that a task has sent: their first place until it is known to repeat, then None."""

    def __init__(self):
        self.places: dict[bytes, tuple | None] = {}

    def sort(self, digests: list[bytes], places: list[tuple]) -> tuple[list[int], list[tuple]]:
        """(windows to send, places now known to repeat)."""
        if len(self.places) > SENT:
            self.places.clear()
        fresh, known = [], []
        for i, (digest, place) in enumerate(zip(digests, places)):
            if digest not in self.places:
                self.places[digest] = place
                fresh.append(i)
                continue
            known.append(place)
            if (first := self.places[digest]) is not None:
                known.append(first)
                self.places[digest] = None
        return fresh, known


def _dealt(bucket, kind: int, k1, k2, start, n, data: list[bytes]) -> pa.RecordBatch:
    columns = [np.asarray(bucket, np.int64), np.full(len(data), kind, np.int8), np.asarray(k1, np.int64), np.asarray(k2, np.int64), np.asarray(start, np.int32), np.asarray(n, np.int64)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(data, pa.binary())], schema=DEALT)


def _deal(width: int, buckets: int, hot, dictionary: bytes = b""):
    """Map side: rows of ``DEALT``. ``data`` is the packed words of a super-k-mer of ``n`` windows, or the digest of one
    hot window; a row without data is a range of ``n`` windows that are known to repeat."""

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, filled, strings = _Sent(), hot.value if hot is not None else None, _Strings(dictionary)
        for chunk in _chunks(batches, width):
            if not len(chunk.run):
                continue
            text = chunk.text.tobytes()
            last = np.append(chunk.run[1:], len(chunk.at)) - 1
            is_hot = filled.has(chunk.minimiser) if filled is not None else np.zeros(len(chunk.run), bool)
            own = np.flatnonzero(~is_hot)
            doc = chunk.doc[chunk.run[own]]
            lo, hi = chunk.span(chunk.run[own], last[own])
            bucket = (_mixed(chunk.minimiser[own].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
            start = chunk.at[chunk.run[own]] - chunk.first[doc]
            yield _dealt(bucket, MERS, chunk.k1[doc], chunk.k2[doc], start, last[own] - chunk.run[own] + 1, strings.packed([text[a:b] for a, b in zip(lo, hi)]))
            if is_hot.any():
                windows = np.flatnonzero(np.repeat(is_hot, last - chunk.run + 1))
                digests = [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(*chunk.span(windows, windows))]
                doc = chunk.doc[windows]
                start = chunk.at[windows] - chunk.first[doc]
                fresh, known = sent.sort(digests, list(zip(chunk.k1[doc].tolist(), chunk.k2[doc].tolist(), start.tolist())))
                data = [digests[i] for i in fresh]
                bucket = np.frombuffer(b"".join(data), "<u8")[::2] % np.uint64(buckets)
                yield _dealt(bucket.astype(np.int64), WINDOWS, chunk.k1[doc[fresh]], chunk.k2[doc[fresh]], start[fresh], np.ones(len(fresh)), data)
                if known:
                    k1, k2, lo, hi = _runs(*(np.array(x, np.int64) for x in zip(*known)), width)
                    yield _dealt(_mixed(k2.view(np.uint64)) % np.uint64(buckets), KNOWN, k1, k2, lo, hi - lo - width + 1, [b""] * len(lo))

    return rows


def _bytes_of(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all values behind one another."""
    parts = [np.zeros(0, np.uint8)]
    for values in column.chunks:
        _, offsets, data = values.buffers()
        if len(values) and data is not None:
            size = np.int64 if pa.types.is_large_binary(values.type) else np.int32
            edges = np.frombuffer(offsets, size)[[values.offset, values.offset + len(values)]]
            parts.append(np.frombuffer(data, np.uint8)[edges[0] : edges[1]])
    return np.concatenate(parts)


def repeated(data: np.ndarray, begin: np.ndarray, end: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Which of the stretches [begin, end) of ``data`` occur more than once, exactly."""
    order = np.argsort(prints, kind="stable")
    same = np.flatnonzero(prints[order][1:] == prints[order][:-1])
    left, right = order[same], order[same + 1]
    text = data.tobytes()
    spans = (x.tolist() for x in (begin[left], end[left], begin[right], end[right]))
    equal = np.fromiter((text[a:b] == text[c:d] for a, b, c, d in zip(*spans)), bool, len(same))
    found = np.zeros(len(begin), bool)
    found[left[equal]] = found[right[equal]] = True
    if not equal.all():  # unequal windows with one fingerprint: these by their bytes
        counts: dict[bytes, list[int]] = {}
        for i in np.flatnonzero(np.isin(prints, prints[left[~equal]])).tolist():
            counts.setdefault(text[begin[i] : end[i]], []).append(i)
        for places in counts.values():
            found[places] = len(places) > 1
    return found


def _runs(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Repeated windows as covered word ranges (k1, k2, lo, hi), neighbouring windows merged."""
    order = np.lexsort((start, k2, k1))
    k1, k2, start = k1[order], k2[order], start[order].astype(np.int64)
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] > start[:-1] + 1)
    begins = np.flatnonzero(new)
    ends = np.append(begins, len(k1))[1:] - 1
    return k1[begins], k2[begins], start[begins], start[ends] + width


def _count(width: int, dictionary: bytes = b""):
    """Reduce side: one bucket's rows to the ranges of its repeated windows."""

    def of_kind(table: pa.Table, kind: int) -> tuple[pa.Table, list[np.ndarray]]:
        part = table.filter(pc.equal(table["kind"], kind))
        return part, [part[c].to_numpy().astype(np.int64) for c in ("_k1", "_k2", "start", "n")]

    def bucket(table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        part, (k1, k2, start, n) = of_kind(table, MERS)
        if len(k1):
            data = np.frombuffer(_Strings(dictionary).joined(part["data"].to_pylist()), np.uint8)
            word_end = np.flatnonzero(data == 32)
            word_begin = np.append(0, word_end + 1)[:-1]
            lengths = n + width - 1
            owner = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(lengths) - lengths)[owner] + inside
            begin, end = word_begin[at], word_end[at + width - 1] + 1
            again = np.flatnonzero(repeated(data, begin, end, prints_of(data, begin, end)))
            found.append((k1[owner[again]], k2[owner[again]], start[owner[again]] + inside[again]))
        part, (k1, k2, start, n) = of_kind(table, WINDOWS)
        if len(k1):
            digests = _bytes_of(part["data"]).view([("a", "<u8"), ("b", "<u8")])
            order = np.lexsort((digests["b"], digests["a"]))
            new = np.append(True, digests[order][1:] != digests[order][:-1])
            group = np.cumsum(new) - 1
            again = order[np.bincount(group, n[order])[group] > 1]
            found.append((k1[again], k2[again], start[again]))
        ranges = [_runs(*(np.concatenate(x) for x in zip(*found)), width)] if found else []
        _, (k1, k2, start, n) = of_kind(table, KNOWN)
        ranges.append((k1, k2, start, start + n - 1 + width))
        release()
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*ranges)], schema=RANGES)

    return bucket


def _kept(los, his, text: bytes):
    """(words, words removed, kept text)."""
    words = text.split()
    if los is None or not len(los):
        return len(words), 0, b" ".join(words).decode()
    mark = np.zeros(len(words) + 1, np.int32)
    np.add.at(mark, np.asarray(los, np.int64), 1)
    np.add.at(mark, np.asarray(his, np.int64), -1)
    keep = np.cumsum(mark[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode()


def _cut(dictionary: bytes):
    """Called non-deterministic, so that a filter on its results is not moved below it: each task would then
    cut its texts twice, in two Python workers at once."""

    def rows(packed: pd.Series, los: pd.Series, his: pd.Series) -> pd.DataFrame:
        release()  # what the batch before took
        one = _Strings(dictionary).one
        return pd.DataFrame([_kept(lo, hi, one(p)) for p, lo, hi in zip(packed, los, his)], columns=["n_words", "n_removed", "kept"])

    return F.pandas_udf(rows, "n_words long, n_removed long, kept string").asNondeterministic()


def _pack(dictionary: bytes):
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series(_Strings(dictionary).packed([(t or "").encode() for t in texts]), dtype=object)

    return F.pandas_udf(rows, "binary")


def _unpack(dictionary: bytes):
    def rows(packed: pd.Series) -> pd.Series:
        one = _Strings(dictionary).one
        return pd.Series([one(p).decode() for p in packed], dtype=object)

    return F.pandas_udf(rows, "string")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*row_key(), F.encode("text", "utf-8").alias("_text"))


def repeated_ranges(docs: DataFrame, dictionary: bytes, width: int = WIDTH, hot: int = HOT, bits: int = FILTER_BITS) -> DataFrame:
    """``_k1, _k2, lo, hi``: word ranges of each row's text that repeated windows cover."""
    keyed = _keyed(docs)
    counts = stored(minimiser_counts(keyed, width).where(F.col("minimiser").isNull() | (F.col("n") > hot)), "minimisers")
    words = counts.where("minimiser is null").agg(F.sum("n")).first()[0] or 0
    often = hot_filter(counts.where("minimiser is not null"), bits)
    held = docs.sparkSession.sparkContext.broadcast(often) if often is not None else None
    buckets = max(4 * parallel(docs), words // BUCKET_WORDS)
    dealt = keyed.mapInArrow(_deal(width, buckets, held, dictionary), "bucket long, kind byte, _k1 long, _k2 long, start int, n long, data binary")
    ranges = dealt.groupBy("bucket").applyInArrow(_count(width, dictionary), "_k1 long, _k2 long, lo long, hi long")
    return stored(ranges, "repeats")


def remove_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT, bits: int = FILTER_BITS) -> DataFrame:
    """Removes every word covered by a window of ``width`` words that also starts anywhere else.

    ``docs`` needs ``doc_id`` and ``text``; the result has its columns in ``_row`` (a struct) and
    ``_cut`` (a struct of n_words, n_removed and kept, the words that stay joined by one blank).
    Windows are judged on the input. Null, empty and short texts keep all their words; repeated
    rows (null ids too) count as different places, so their windows repeat; other columns, of any
    name, pass unchanged; an empty table gives an empty result.
    """
    dictionary = dictionary_of(_keyed(docs))
    ranges = repeated_ranges(docs, dictionary, width, hot, bits)
    per_text = ranges.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("lo", "hi")).alias("_ranges"))
    # texts meet their ranges compressed, and become texts again only where they are asked for
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("_others"), F.col("text").isNull().alias("_no_text"), *row_key(), _pack(dictionary)("text").alias("_packed"))
    joined = rows.join(per_text, ["_k1", "_k2"], "left")
    text = F.when(~F.col("_no_text"), _unpack(dictionary)("_packed")).alias("text")
    fields = [text if c == "text" else F.col("_others")[c].alias(c) for c in docs.columns]
    return joined.select(F.struct(*fields).alias("_row"), _cut(dictionary)("_packed", "_ranges.lo", "_ranges.hi").alias("_cut"))
