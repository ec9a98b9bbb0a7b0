"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The second sum is over all pairs of features, in time linear in their number. A text's features are
its words (lower-cased, hashed to ``WORDS`` places, weight sqrt(count), length 1) and a set of
statistics: shares of kinds of bytes, repetition of words and word pairs, lengths, lines. Each
statistic enters as a number and as the one of ``BINS`` quantile bins in which it lies, so that pairs of
bins (a repetition rate that is normal at one length and junk at another) get weights of their own.

Weights are learned from at most ``SAMPLE`` labelled rows (the first by a hash of their ids); all rows
are scored in parallel with the 1 MB of weights that every task holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import Hashes, lean

WORDS = 2**14
RANK = 8
BINS = 8
SAMPLE = 12_000
EPOCHS = 8
BATCH = 128
KEEP_AT = 0.3
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".,;:", b"!?", b"|\t", b"#$%&*+=<>@^_`~\\/{}[]()", b"'\"-"]
_TABLE = np.zeros((256, len(_KINDS) + 1))
for _i, _kind in enumerate(_KINDS):
    _TABLE[list(_kind), _i] = 1
_TABLE[128:, -1] = 1
STATISTICS = len(_KINDS) + 1 + 9
FEATURES = WORDS + STATISTICS * (BINS + 1)


def statistics_of(raw: bytes, words: list[bytes], counts: Counter, n_chars: float | None) -> np.ndarray:
    """Structure and metadata of one text; all zero but for the lengths if it is empty."""
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE / max(len(raw), 1)
    n = max(len(words), 1)
    pairs = set(zip(words, words[1:]))
    lines = raw.split(b"\n")
    length = float(n_chars) if n_chars is not None and np.isfinite(n_chars) and n_chars >= 0 else float(len(raw))
    return np.append(
        kinds,
        [
            np.log1p(len(words)),
            np.log1p(length),
            len(counts) / n,
            len(pairs) / max(len(words) - 1, 1),
            max(counts.values(), default=0) / n,
            sum(map(eq, words, words[1:])) / n,
            sum(map(len, words)) / n,
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
        ],
    )


def features(texts: list[str | None], n_chars: list, memo: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashed word places, weights, words per text, statistics) of some texts."""
    places, weights, sizes, stats = [], [], [], []
    for text, chars in zip(texts, n_chars):
        raw = (text or "").encode()
        words = raw.split()
        counts = Counter(words)
        lower = Counter()
        for word, n in counts.items():
            lower[word.lower()] += n
        stats.append(statistics_of(raw, words, counts, chars))
        own = np.sqrt(np.fromiter(lower.values(), np.float64, len(lower)))
        weights.append(own / max(np.sqrt((own**2).sum()), 1e-9))
        places.append(np.fromiter(map(memo.__getitem__, lower), np.uint64, len(lower)) % np.uint64(WORDS))
        sizes.append(len(lower))
    return np.concatenate(places).astype(np.int64), np.concatenate(weights), np.array(sizes), np.stack(stats)


@dataclass
class Machine:
    """A fitted machine: weights, factors, and how statistics become features."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    edges: np.ndarray

    def rows(self, places, weights, sizes, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features of some texts in one list: (places, values, first place of each text)."""
        n = len(sizes)
        share = 1 / np.sqrt(STATISTICS)
        plain = np.clip((stats - self.mean) / self.scale, -3, 3) * share / 3
        bins = (stats[:, :, None] > self.edges[None]).sum(axis=2)
        numbers = np.arange(STATISTICS)
        extra = np.concatenate([WORDS + np.tile(numbers, (n, 1)), WORDS + STATISTICS + numbers * BINS + bins], axis=1)
        values = np.concatenate([plain, np.full(plain.shape, share)], axis=1)
        width = extra.shape[1]
        first = np.cumsum(sizes + width) - (sizes + width)
        at, value = np.empty(len(places) + extra.size, np.int64), np.empty(len(places) + extra.size)
        own = (first[:, None] + np.arange(width)).ravel()
        at[own], value[own] = extra.ravel(), values.ravel()
        rest = np.ones(len(at), bool)
        rest[own] = False
        at[rest], value[rest] = places, weights
        return at, value, first

    def margins(self, at, value, first) -> tuple[np.ndarray, np.ndarray]:
        """(scores before the sigmoid, sums of v x per text and factor)."""
        scaled = self.factor[at] * value[:, None]
        sums = np.add.reduceat(scaled, first, axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), first)
        linear = np.add.reduceat(self.weight[at] * value, first)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def score(self, texts: list, n_chars: list, memo: Hashes) -> np.ndarray:
        margin, _ = self.margins(*self.rows(*features(texts, n_chars, memo)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(places: list[np.ndarray], weights: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """Logistic loss in which both classes weigh the same, AdaGrad, small batches in a fixed random order."""
    rng = np.random.default_rng(3)
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    machine = Machine(0.0, np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK)), stats.mean(axis=0), stats.std(axis=0) + 1e-9, edges)
    share = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-2), np.full((FEATURES, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            batch = order[lo : lo + BATCH]
            sizes = np.array([len(places[i]) for i in batch])
            at, value, first = machine.rows(np.concatenate([places[i] for i in batch]), np.concatenate([weights[i] for i in batch]), sizes, stats[batch])
            margin, sums = machine.margins(at, value, first)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]) * share[batch] / len(batch)
            text = np.repeat(np.arange(len(batch)), np.diff(np.append(first, len(at))))
            pull = (slope[text] * value)[:, None]
            by_factor = pull * (sums[text] - machine.factor[at] * value[:, None])
            used, inverse = np.unique(at, return_inverse=True)
            sort = np.argsort(inverse, kind="stable")
            edges_at = np.flatnonzero(np.diff(inverse[sort], prepend=-1))
            step_w = np.add.reduceat(pull[sort, 0], edges_at) + 1e-6 * machine.weight[used]
            step_v = np.add.reduceat(by_factor[sort], edges_at, axis=0) + 1e-6 * machine.factor[used]
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            seen_b += slope.sum() ** 2
            machine.weight[used] -= 0.2 * step_w / np.sqrt(seen_w[used])
            machine.factor[used] -= 0.05 * step_v / np.sqrt(seen_v[used])
            machine.bias -= 0.2 * slope.sum() / np.sqrt(seen_b)
    return machine


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Fixed by the contract: the fold that is never learned from. A null id is not in it."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


@lean
def _rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = Hashes()
    for batch in batches:
        if not len(batch):
            continue
        places, weights, sizes, stats = features(batch["text"].tolist(), batch["n_chars"].tolist(), memo)
        cuts = np.cumsum(sizes)[:-1]
        yield pd.DataFrame({"places": np.split(places, cuts), "weights": np.split(weights, cuts), "stats": list(stats), "label": batch["label"]})


def _own(docs: DataFrame) -> DataFrame:
    chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """A machine from labelled rows outside the held-out fold; None if one of the classes is missing there.

    ``labels`` has ``doc_id`` and ``quality``; of repeated labels the mean decides; null ones are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` rows of two numbers, so the texts need not be shuffled to meet them
    rows = _own(docs).join(F.broadcast(known) if sample <= 100_000 else known, "doc_id").mapInPandas(_rows_of, "places array<long>, weights array<double>, stats array<double>, label double")
    places, weights, stats, label = [], [], [], []
    for row in rows.toLocalIterator(prefetchPartitions=True):
        places.append(np.array(row.places, np.int32))
        weights.append(np.array(row.weights, np.float32))
        stats.append(row.stats)
        label.append(row.label)
    label = np.array(label)
    if not len(label) or label.min() == label.max():
        return None
    order = np.lexsort((label, [float(s[len(_KINDS) + 2]) for s in stats], [len(p) for p in places]))  # whatever order the rows came in
    return fit([places[i] for i in order], [weights[i] for i in order], np.array(stats)[order], label[order])


def _scores(machine: Machine):
    @lean
    def rows(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        memo = Hashes()
        for texts, n_chars in columns:
            texts, n_chars = texts.tolist(), n_chars.tolist()
            parts = [machine.score(texts[i : i + 1000], n_chars[i : i + 1000], memo) for i in range(0, len(texts), 1000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    rows.__annotations__ = {"columns": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(rows, "double")


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` as ``_row`` with its ``_score`` (0 to 1, higher: quality 1 likelier).

    Only ``text`` and, if there, ``n_chars`` enter a score (null: the text's bytes are counted); null and
    empty texts are scored as texts without words. Without labels of both classes every score is 0.5.
    Repeated rows and other columns, of any name, pass unchanged; an empty table gives an empty result.
    """
    machine = train(docs, labels, sample)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    chars = F.col("_row.n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    score = F.lit(0.5) if machine is None else _scores(machine)(F.col("_row.text"), chars)
    return rows.select("_row", score.alias("_score"))
