"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

SuperMinHash (Ertl, 2017): every set element permutes the signature's slots; its value in the slot
that comes j-th is j plus a random fraction, and a slot keeps the smallest value. Elements work
through their permutations step by step, and stop once no slot of their document can improve:
larger sets need one to three steps. A slot of two sets is equal with their Jaccard probability.

``BANDS`` x ``ROWS`` slots: two sets with similarity 0.8 share no band with probability
(1 - 0.8**4)**32 = 5e-8.

Documents with equal sets are one class (a 64-bit number of the set) from the start. Within a band
bucket nobody is compared with everybody: first all with the bucket's smallest member. Buckets that
still hold several components then go through a prefix filter: of two similar sets ordered alike,
the rarest shingles first, the foremost ones have one in common. Texts that share no such shingle
with another component are done with; of the others, those outside a bucket's largest component
meet the members of other components. So every similar pair that shares a bucket is compared on its
full sets or already connected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import MASK, Hashes, lean, row_key
from shardtally.llm.components import components
from shardtally.sources.workspace import stored

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
SHINGLE = 2
PERCENT = 80
CHUNK_BYTES = 2_000_000
ELEMENTS = 100_000
OUTSIDERS, MEMBERS = 128, 256
#: Places of the table by whose counts shingles are ordered, which every task holds (4 MB).
SLOTS_OF_COUNTS = 2**20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _times(i: int) -> np.uint64:
    return np.uint64(int(_GOLD) * i & MASK)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def superminhash(elements: np.ndarray, doc: np.ndarray, docs: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (docs x slots) of sets given as distinct 64-bit ``elements`` with their ``doc`` numbers."""
    signature = np.full(docs * slots, np.inf)
    order = None  # each element's permutation so far, made when the second step begins
    for step in range(slots):
        if not len(elements):
            break
        dice = mixed(elements + _times(step + 1))
        slot = (step + (dice & np.uint64(0xFFFFFFFF)) % np.uint64(slots - step)).astype(np.int64)
        if step == 0:
            first, taken = slot, slot
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                rows = np.arange(len(elements))
                order[rows, first], order[:, 0] = 0, first
            rows = np.arange(len(elements))
            taken = order[rows, slot].astype(np.int64)
            order[rows, slot] = order[:, step]
        np.minimum.at(signature, doc * slots + taken, step + (dice >> np.uint64(32)) / 2.0**32)
        open_docs = signature.reshape(docs, slots).max(axis=1) > step + 1
        on = open_docs[doc]
        if not on.all():
            elements, doc, first = elements[on], doc[on], first[on]
            order = order[on] if order is not None else None
    return signature.reshape(docs, slots)


def _sets(texts: list[bytes], memo: Hashes, size: int):
    """Distinct ``size``-word shingles of each text: (hashes, document numbers), exact within a chunk."""
    words, lengths = [], []
    for text in texts:
        own = text.lower().split()
        lengths.append(len(own))
        words += own
    lengths = np.array(lengths, np.int64)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    hashes = np.fromiter(map(memo.__getitem__, numbers), np.uint64, len(numbers))
    windows = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    doc = np.repeat(np.arange(len(texts)), windows)
    at = (np.cumsum(lengths) - lengths)[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    span = np.minimum(lengths, size)[doc]
    padded = np.concatenate([ids, np.full(size, -1, np.int64)])
    code, value = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.uint64)
    for i in range(size):  # numbers the shingles of i + 1 words exactly, without gaps
        word = np.where(i < span, padded[at + i], -1)
        value = mixed(value + _times(i + 1)) + np.where(word >= 0, hashes[np.maximum(word, 0)] if len(hashes) else np.uint64(0), np.uint64(7))
        code = code * (len(numbers) + 1) + word + 1
        if i < size - 1:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
    code = np.unique(code, return_inverse=True)[1]
    _, first = np.unique(doc * (code.max(initial=0) + 1) + code, return_index=True)
    return mixed(value[first]), doc[first]


def _sketches(size: int):
    def chunk(keys: list, texts: list[bytes], memo: Hashes) -> pd.DataFrame:
        elements, doc = _sets(texts, memo, size)
        n = np.bincount(doc, minlength=len(texts))
        begin = np.concatenate([[0], np.cumsum(n)])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(elements ^ _GOLD))])
        node = mixed(sums[begin[1:]] - sums[begin[:-1]] + _GOLD * n.astype(np.uint64)).view(np.int64)
        bands = []
        for lo, hi in _parts(begin):
            a, b = begin[lo], begin[hi]
            signature = superminhash(elements[a:b], doc[a:b] - lo, hi - lo).view(np.uint64).reshape(hi - lo, BANDS, ROWS)
            band = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (hi - lo, 1))
            for i in range(ROWS):
                band = mixed(band * _GOLD + signature[:, :, i])
            bands += list(band.view(np.int64))
        return pd.DataFrame(
            {
                "_no_id": [k[0] for k in keys],
                "_k1": [k[1] for k in keys],
                "_k2": [k[2] for k in keys],
                "n": n,
                "node": node,
                "bands": [x if y else [] for x, y in zip(bands, n)],
            }
        )

    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Hashes()
        keys, texts, held = [], [], 0
        for batch in batches:
            for no_id, k1, k2, text in zip(batch["_no_id"], batch["_k1"], batch["_k2"], batch["_text"]):
                raw = (text or "").encode()
                keys.append((no_id, k1, k2))
                texts.append(raw)
                held += len(raw)
                if held > CHUNK_BYTES:
                    yield chunk(keys, texts, memo)
                    keys, texts, held = [], [], 0
        if keys:
            yield chunk(keys, texts, memo)

    return rows


def _parts(begin: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole documents with about ``ELEMENTS`` elements, one document at least."""
    lo, last = 0, len(begin) - 1
    while lo < last:
        hi = int(np.searchsorted(begin, begin[lo] + ELEMENTS, side="right")) - 1
        hi = min(max(hi, lo + 1), last)
        yield lo, hi
        lo = hi


def shingles(text: str, size: int) -> frozenset:
    words = text.encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(size)))) if len(words) >= size else frozenset([tuple(words)])


def _linked(size: int, percent: int):
    @lean
    def pairs(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in columns:
            known = lru_cache(maxsize=64)(lambda text: shingles(text, size))
            out = []
            for a, b in zip(left, right):
                a, b = known(a), known(b)
                both = len(a & b)
                out.append(100 * both >= percent * (len(a) + len(b) - both) > 0)
            yield pd.Series(out, dtype=bool)

    pairs.__annotations__ = {"columns": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(pairs, "boolean")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("_right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_linked(size, percent)("_left", "_right")).select("a", "b")


def _against_outsiders(size: int, percent: int):
    """Links between the outsiders of a block and its members; rows come sorted, outsiders first.

    Of all links found, only those that join components not yet joined within the group are passed on.
    """

    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, outsiders, index, joined = None, [], {}, {}

        def top(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                x = up
            return x

        for batch in batches:
            left, right = [], []
            columns = (batch[c].tolist() for c in ("key", "block", "chunk", "is_member", "node", "root", "text"))
            for key, block, chunk, is_member, node, root, text in zip(*columns):
                if group != (key, block, chunk):
                    group, outsiders, index, joined = (key, block, chunk), [], {}, {}
                own = shingles(text, size)
                if not is_member:
                    for shingle in own:
                        index.setdefault(shingle, []).append(len(outsiders))
                    outsiders.append((node, root, len(own)))
                    continue
                hits = Counter(chain.from_iterable(index[x] for x in own if x in index))
                for at, both in hits.items():
                    other, other_root, n = outsiders[at]
                    if other_root != root and 100 * both >= percent * (len(own) + n - both) and (a := top(root)) != (b := top(other_root)):
                        joined[max(a, b)] = min(a, b)
                        left.append(node)
                        right.append(other)
            yield pd.DataFrame({"a": left, "b": right}, dtype="int64")

    return rows


def _first_pairs(members: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's smallest."""
    pivot = members.groupBy("key").agg(F.min("node").alias("b"))
    return members.join(pivot, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()


def _text_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in frames of about ``CHUNK_BYTES`` of text."""
    for batch in batches:
        cuts = np.flatnonzero(np.diff(batch["text"].str.len().cumsum().to_numpy() // CHUNK_BYTES, prepend=0))
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if hi > lo:
                yield batch.iloc[lo:hi]


def _shingle_counts(size: int):
    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, total = Hashes(), np.zeros(SLOTS_OF_COUNTS, np.int64)
        for chunk in _text_chunks(batches):
            elements, _ = _sets([t.encode() for t in chunk["text"]], memo, size)
            total += np.bincount((elements % np.uint64(SLOTS_OF_COUNTS)).astype(np.int64), minlength=SLOTS_OF_COUNTS)
        slot = np.flatnonzero(total)
        yield pd.DataFrame({"slot": slot, "n": total[slot]})

    return rows


def _counted(texts: DataFrame, size: int) -> np.ndarray:
    """How often the shingles of each slot occur; a fixed number of rows reaches the driver."""
    counts = texts.select("text").mapInPandas(_shingle_counts(size), "slot long, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit(2**31 - 1)).alias("n"))
    packed = counts.select((F.col("slot") * 2**31 + F.col("n")).alias("code")).groupBy((F.col("code") % 1024).alias("part")).agg(F.collect_list("code").alias("codes"))
    out = np.zeros(SLOTS_OF_COUNTS, np.int32)
    for row in packed.toLocalIterator():
        codes = np.array(row["codes"], np.int64)
        out[codes >> 31] = codes & (2**31 - 1)
    return out


def _prefixes(held, size: int, percent: int):
    """The foremost shingles of each text, ordered by their slots' counts.

    Of two similar sets, the not larger one's foremost shingles as far as its ``index`` reaches and the
    other's have one in common: they share 2t/(1+t) of the former and t of the latter at least.
    """

    @lean
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, counts = Hashes(), held.value
        for chunk in _text_chunks(batches):
            elements, doc = _sets([t.encode() for t in chunk["text"]], memo, size)
            order = np.lexsort((elements, counts[(elements % np.uint64(SLOTS_OF_COUNTS)).astype(np.int64)], doc))
            n = np.bincount(doc, minlength=len(chunk))
            length = n - -(-percent * n // 100) + 1
            index = n - -(-2 * percent * n // (100 + percent)) + 1
            place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
            own = place < np.repeat(length, n)
            foremost, index = order[own], (place < np.repeat(index, n))[own]
            nodes, roots = chunk["node"].to_numpy(np.int64), chunk["root"].to_numpy(np.int64)
            yield pd.DataFrame({"shingle": elements[foremost].view(np.int64), "node": nodes[doc[foremost]], "root": roots[doc[foremost]], "index": index})

    return rows


def _candidates(texts: DataFrame, held, size: int, percent: int) -> DataFrame:
    """``node`` of the ``texts`` (node, root, text) that share a foremost shingle with another component's: only these can be similar."""
    schema = "shingle long, node long, root long, index boolean"
    rows = stored(texts.select("node", "root", "text").mapInPandas(_prefixes(held, size, percent), schema), "prefixes")
    keys = rows.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("index").alias("index")).where("index and lo < hi")
    return rows.join(keys.select("shingle"), "shingle", "left_semi").select("node").distinct()


def _meetings(labelled: DataFrame, texts: DataFrame) -> DataFrame:
    """Which members of a bucket are to meet: rows (key, block, chunk, is_member, node, root, text).

    A bucket's largest component needs no comparing within; each member outside it (an outsider)
    meets all members of other components. Outsiders are dealt into blocks and members into chunks,
    so a bucket of any size is many small groups.
    """
    parts = labelled.groupBy("key", "root").agg(F.count("*").alias("n"))
    keys = parts.groupBy("key").agg(F.max_by("root", "n").alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    blocks, chunks = F.ceil((F.col("all") - F.col("most")) / OUTSIDERS), F.ceil(F.col("all") / MEMBERS)
    keys = keys.where("all > most").select("key", "main", blocks.alias("blocks"), chunks.alias("chunks"))
    rows = stored(labelled.join(keys, "key"), "meetings").join(texts, "node")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    block = F.pmod(F.xxhash64("node"), "blocks")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), "chunks")
    columns = ["key", "block", "chunk", "is_member", "node", "root", "text"]
    outsiders = rows.where("root <> main").withColumns({"block": block, "chunk": every("chunks"), "is_member": F.lit(False)})
    everyone = rows.withColumns({"chunk": chunk, "block": every("blocks"), "is_member": F.lit(True)})
    return outsiders.select(columns).union(everyone.select(columns))


def _second_links(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that comparing with one pivot a bucket has missed."""
    labelled = members.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # buckets of two are done with: their members have been compared
    several = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2")
    mixed_rows = stored(labelled.join(several.select("key"), "key", "left_semi").select("key", "node", "root"), "mixed")
    held = texts.sparkSession.sparkContext.broadcast(_counted(texts, size))
    candidates = stored(_candidates(texts.join(mixed_rows.select("node", "root").distinct(), "node"), held, size, percent), "candidates")
    dealt = _meetings(mixed_rows.join(candidates, "node", "left_semi"), texts).repartition("key", "block", "chunk")
    dealt = dealt.sortWithinPartitions("key", "block", "chunk", "is_member")
    return dealt.mapInPandas(_against_outsiders(size, percent), "a long, b long").distinct()


def near_copies(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Two documents are linked when 100 * intersection >= ``percent`` * union of their shingle sets of
    ``size`` words (A-Z lower-cased); component_id is the smallest doc_id reachable. Null, empty and
    blank texts are linked with nothing; a text shorter than a shingle counts as one shingle. Null ids
    are never the smallest: a group of null ids alone has a null component and keeps its rows.
    Repeated rows get equal results. Other columns are not looked at; an empty table gives an empty result.
    """
    return grouped(docs, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """``near_copies`` with the row keys ``_k1, _k2`` (see ``row_key``) and ``_group``, a number of each group (null for texts linked with nothing)."""
    # a nullable long would become a double in pandas: a row's id is its _k1, where it has one
    keyed = docs.select(F.col("doc_id").cast("long").isNull().alias("_no_id"), *row_key(), F.col("text").alias("_text"))
    sketch = keyed.mapInPandas(_sketches(size), "_no_id boolean, _k1 long, _k2 long, n long, node long, bands array<long>")
    sketch = stored(sketch.select(F.when(~F.col("_no_id"), F.col("_k1")).alias("doc_id"), "_k1", "_k2", "n", "node", "bands"), "sketch")
    full = sketch.where("n > 0")
    classes = full.groupBy("node").agg(
        F.min("doc_id").alias("smallest"), F.min("_k1").alias("_k1"), F.min_by("_k2", "_k1").alias("_k2"), F.first("bands").alias("bands")
    )
    classes = stored(classes, "classes")
    rows = classes.select(F.explode("bands").alias("key"), "node")
    shared = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = stored(rows.join(shared.select("key"), "key", "left_semi"), "members")
    wanted = classes.select("node", "_k1", "_k2").join(members.select("node").distinct(), "node", "left_semi")
    texts = keyed.select("_k1", "_k2", F.col("_text").alias("text")).join(wanted, ["_k1", "_k2"]).select("node", "text").dropDuplicates(["node"])
    texts = stored(texts, "texts")

    links = stored(_verified(_first_pairs(members), texts, size, percent), "links")
    labels = components(links)
    more = stored(_second_links(members, labels, texts, size, percent), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    in_groups = classes.select("node", "smallest").join(labels, "node")
    least = in_groups.groupBy("root").agg(F.min("smallest").alias("component_id"))
    groups = in_groups.join(least, "root").select("node", "component_id", "root")
    per_class = classes.select("node", "smallest").join(groups, "node", "left")
    per_class = per_class.select("node", F.coalesce("component_id", "smallest").alias("component_id"), F.coalesce("root", "node").alias("_group"))
    columns = ["doc_id", "_k1", "_k2", F.col("n").alias("n_shingles")]
    result = full.join(per_class, "node", "left").select(*columns, "component_id", "_group")
    result = result.union(sketch.where("n = 0").select(*columns, "doc_id", F.lit(None).cast("long")))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
