"""Toxicity by class-conditional Kneser-Ney models with shared backoff.

Two language models of the characters of words, one learned from toxic texts and one from the others:

    P_c(x | h) = max(count_c(h x) - D_c, 0) / count_c(h) + D_c * kinds_c(h) / count_c(h) * P(x | h')

h is the ``ORDER`` - 1 characters before x in the word (padded at its start), h' the same without its
first one, and P the interpolated Kneser-Ney estimate from the continuation counts of both classes
together. Since the backoff is shared, it cancels where neither class has seen ``h x``; a rare word
is judged by the parts that it shares with others, and one that says nothing has a ratio near 1.

The models are kept as one table: log P_toxic - log P_other of every gram ``h x`` seen, and of every h
seen for the x not seen after it. A text is described by its log ratio per character (the
length-normalised likelihoods compared), the largest ratio of a single word, how far its words go beyond
``STRONG`` together, and its length; a logistic regression on these, fitted on labelled rows that the models have not seen, gives the score.

Counts come from all labelled rows and grow with them. The table is sent to the tasks if it has at
most ``SENT_GRAMS`` rows; a larger one meets the words of the texts in joins, with the same results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardtally.llm.common import lean, row_key
from shardtally.llm.quality import held_out
from shardtally.sources.workspace import stored

ORDER = 8
STRONG = 4.0
SENT_GRAMS = 4_000_000
CALIBRATION = 20_000
TOXIC_AT = 0.5
CHUNK_CHARS = 2_000_000
MEMO = 150_000
PAD, END = "^", "$"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NOT_LETTERS = r"[^\p{L}]+"
FEATURES = ["_mean", "_best", "_strong", "_length"]


def words_of(text: Column) -> Column:
    """Runs of letters, lower-cased."""
    return F.filter(F.split(F.lower(text), _NOT_LETTERS), lambda w: w != "")


def grams_of(word: Column, order: int) -> Column:
    """Every character of ``word`` and its end, each behind the ``order`` - 1 characters before it."""
    padded = F.concat(F.lit(PAD * (order - 1)), word, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(order)))


def _head(gram: str, order: int) -> Column:
    return F.substring(F.col(gram), 1, order - 1)


def _discount(counts: DataFrame, n: str) -> float:
    """Kneser and Ney's estimate from how many things were seen once and twice."""
    once, twice = counts.agg(F.count(F.when(F.col(n) == 1, 1)), F.count(F.when(F.col(n) == 2, 1))).first()
    return once / (once + 2 * twice) if once else 0.5


def shared_backoff(grams: DataFrame, order: int) -> DataFrame:
    """``suffix, shared``: the pooled probability of each suffix of ``order`` - 1 characters of ``grams`` (gram, n).

    A gram's count is the number of characters found before it; before the start of a word there is
    only padding, so grams that begin there keep their plain counts.
    """
    levels, above = [], grams
    for _ in range(order - 1):
        rest = above.select(F.expr("substring(gram, 2)").alias("gram"), "n")
        above = stored(rest.groupBy("gram").agg(F.when(F.col("gram").startswith(PAD), F.sum("n")).otherwise(F.count("*")).alias("n")), "level")
        levels.append(above)
    known = None
    for size, level in enumerate(reversed(levels), 1):
        discount = _discount(level, "n")
        heads = level.groupBy(_head("gram", size).alias("head")).agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        joined = level.join(heads, _head("gram", size) == F.col("head"))
        if known is None:
            below = 1 / (F.col("kinds") + 1)
        else:
            joined = joined.join(known, F.expr("substring(gram, 2)") == F.col("suffix"))
            below = F.col("shared")
        estimate = (F.greatest(F.col("n") - discount, F.lit(0.0)) + discount * F.col("kinds") * below) / F.col("all")
        known = joined.select(F.col("gram").alias("suffix"), estimate.alias("shared"))
    return known


def log_ratios(words: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio`` of every gram, and of every head (a character shorter), from ``words`` (word, toxic, other: counts)."""
    grams = words.select(F.explode(grams_of(F.col("word"), order)).alias("gram"), "toxic", "other")
    grams = stored(grams.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "grams")
    shared = shared_backoff(grams.select("gram", (F.col("toxic") + F.col("other")).alias("n")), order)
    sums = [F.sum(c).alias(f"{c}_all") for c in ("toxic", "other")] + [F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in ("toxic", "other")]
    heads = grams.groupBy(_head("gram", order).alias("head")).agg(*sums)
    rest, whole = {}, {}
    for c in ("toxic", "other"):
        discount = _discount(grams, c)
        rest[c] = F.when(F.col(f"{c}_all") > 0, discount * F.col(f"{c}_kinds") / F.col(f"{c}_all")).otherwise(1.0)
        own = F.when(F.col(f"{c}_all") > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"{c}_all")).otherwise(0.0)
        whole[c] = own + rest[c] * F.col("shared")
    seen = grams.join(heads, _head("gram", order) == F.col("head")).join(shared, F.expr("substring(gram, 2)") == F.col("suffix"))
    seen = seen.select("gram", (F.log(whole["toxic"]) - F.log(whole["other"])).alias("ratio"))
    rows = seen.union(heads.select(F.col("head").alias("gram"), (F.log(rest["toxic"]) - F.log(rest["other"])).alias("ratio")))
    return rows.select("gram", F.col("ratio").cast("float").alias("ratio"))


def _codes(texts: list[str]) -> np.ndarray:
    """The characters of all texts behind one another."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes_of(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit numbers of the ``size`` - 1 and of the ``size`` characters from each place on."""
    places = max(len(codes) - size + 1, 0)
    shorter = whole = np.zeros(places, np.uint64)
    for i in range(size):
        shorter, whole = whole, whole * _ODD + (codes[i : i + places].astype(np.uint64) + np.uint64(1))
    return _spread(shorter), _spread(whole)


def whole_hashes(texts: list[str]) -> np.ndarray:
    """Each text's number, as ``hashes_of`` gives it for a stretch of that length."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros(len(texts), np.uint64)
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        codes = _codes([texts[i] for i in rows.tolist()]).reshape(len(rows), size).astype(np.uint64)
        for i in range(size):
            out[rows] = out[rows] * _ODD + (codes[:, i] + np.uint64(1))
    return _spread(out)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Ratios:
    """The table in a task: sorted keys (``hashes_of`` grams and heads) and ratios."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray, order: int):
        self.keys, self.ratios, self.order = keys, ratios, order

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ratios, which of them are known); looked up in ascending order, so that the table is walked through once."""
        if not len(self.keys):
            return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
        order = np.argsort(wanted)
        at = np.empty(len(wanted), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, wanted[order]), len(self.keys) - 1)
        known = self.keys[at] == wanted
        return np.where(known, self.ratios[at].astype(np.float64), 0.0), known

    def words(self, words: list[str]) -> np.ndarray:
        """Log ratio of each word."""
        if not words:
            return np.zeros(0)
        pad = PAD * (self.order - 1)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1  # grams of each word
        heads, grams = hashes_of(_codes([pad + word + END for word in words]), self.order)
        spans = lengths + self.order - 1
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(np.cumsum(spans) - spans, lengths) + inside
        ratio, known = self.find(grams[at])
        missed = np.flatnonzero(~known)
        ratio[missed] = self.find(heads[at[missed]])[0]
        return np.bincount(np.repeat(np.arange(len(words)), lengths), ratio, len(words))


class _Tokens(dict):
    """Numbers of the blank-separated tokens seen, and of each: its words' ratio, characters, best word, excess over ``STRONG``."""

    letters = regex.compile(r"\p{L}+")

    def __init__(self, ratios: Ratios):
        super().__init__()
        self.ratios, self.new, self.table = ratios, [], np.zeros((0, 4))

    def __missing__(self, token: str) -> int:
        number = self[token] = len(self)
        self.new.append(token)
        return number

    def score_new(self) -> None:
        runs = [[t] if t.isascii() and t.isalpha() else self.letters.findall(t) for t in self.new]
        sizes = np.array([len(r) for r in runs], np.int64)
        flat = [w for r in runs for w in r]
        ratio = self.ratios.words(flat)
        owner = np.repeat(np.arange(len(runs)), sizes)
        rows = np.zeros((len(runs), 4))
        rows[:, 0] = np.bincount(owner, ratio, len(runs))
        rows[:, 1] = np.bincount(owner, [len(w) + 1 for w in flat], len(runs))
        np.maximum.at(rows[:, 2], owner, ratio)
        rows[:, 3] = np.bincount(owner, np.maximum(ratio - STRONG, 0), len(runs))
        self.table, self.new = np.concatenate([self.table, rows]), []


    def forget(self) -> None:
        """Keeps the first ``MEMO`` tokens."""
        if len(self) > MEMO:
            kept = list(self)[:MEMO]
            self.clear()
            self.update(zip(kept, range(MEMO)))
            self.table = self.table[:MEMO].copy()


def _described(texts: list[str], tokens: _Tokens) -> np.ndarray:
    """Features of some texts; a text without letters has zeros."""
    numbers, sizes = [], []
    for text in texts:
        own = text.split()
        sizes.append(len(own))
        numbers.append(np.fromiter(map(tokens.__getitem__, own), np.int64, len(own)))
    tokens.score_new()
    out = np.zeros((len(texts), len(FEATURES)))
    for i, own in enumerate(numbers):
        if len(own):
            rows = tokens.table[own]
            chars = rows[:, 1].sum()
            out[i] = rows[:, 0].sum() / max(chars, 1), rows[:, 2].max(), np.log1p(rows[:, 3].sum()), np.log1p(chars)
    tokens.forget()
    return out


def _describe(held):
    """Texts (lower-cased) to their features; ``held`` is a broadcast of keys, ratios and order."""

    @lean
    def rows(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokens = _Tokens(Ratios(*held.value))
        for texts in columns:
            out, chunk, size = [np.zeros((0, len(FEATURES)))], [], 0
            for text in texts:
                chunk.append(text or "")
                size += len(chunk[-1])
                if size > CHUNK_CHARS:
                    out.append(_described(chunk, tokens))
                    chunk, size = [], 0
            out.append(_described(chunk, tokens))
            yield pd.DataFrame(np.concatenate(out), columns=FEATURES)

    rows.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(rows, ", ".join(f"{c} double" for c in FEATURES))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = whole_hashes(batch.column("gram").to_pylist())
        ratios = np.ascontiguousarray(batch.column("ratio").to_numpy(zero_copy_only=False), np.float32)
        blobs = [[keys.tobytes()], [ratios.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(b, pa.binary()) for b in blobs], ["keys", "ratios"])


def _gathered(table: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted table on the driver, 12 bytes a row: rows travel as packed arrays."""
    keys, ratios, at = np.zeros(rows, np.uint64), np.zeros(rows, np.float32), 0
    for row in table.select("gram", "ratio").mapInArrow(_packed, "keys binary, ratios binary").toLocalIterator():
        own = np.frombuffer(row["keys"], np.uint64)
        keys[at : at + len(own)], ratios[at : at + len(own)] = own, np.frombuffer(row["ratios"], np.float32)
        at += len(own)
    order = np.argsort(keys)
    return keys[order], ratios[order]


@dataclass
class Models:
    """The stored table of ratios and, if it is small enough to be sent to the tasks, its broadcast."""

    table: DataFrame
    order: int
    held: Broadcast | None

    @classmethod
    def of(cls, table: DataFrame, order: int, sent: int) -> Models:
        rows = table.count()
        held = table.sparkSession.sparkContext.broadcast((*_gathered(table, rows), order)) if rows <= sent else None
        return cls(table, order, held)


def described(docs: DataFrame, models: Models) -> DataFrame:
    """``docs`` as ``_row`` with the features of its text in ``_text``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_t"))
    if models.held is not None:
        return rows.select("_row", _describe(models.held)(F.lower("_t")).alias("_text"))
    table, order = models.table, models.order
    keyed = docs.select(*row_key(), "text").dropDuplicates(["_k1", "_k2"])
    words = keyed.select("_k1", "_k2", F.explode(words_of(F.col("text"))).alias("word")).groupBy("_k1", "_k2", "word").agg(F.count("*").alias("n"))
    words = stored(words, "words")
    places = words.select("word").distinct().select("word", F.explode(grams_of(F.col("word"), order)).alias("gram"))
    places = places.select("word", F.col("gram").alias("_gram"), _head("gram", order).alias("_head"))
    whole = table.select(F.col("gram").alias("_gram"), F.col("ratio").alias("_whole"))
    heads = table.select(F.col("gram").alias("_head"), F.col("ratio").alias("_rest"))
    ratios = places.join(whole, "_gram", "left").join(heads, "_head", "left")
    ratios = ratios.groupBy("word").agg(F.sum(F.coalesce("_whole", "_rest", F.lit(0.0)).cast("double")).alias("ratio"))
    chars = F.sum(F.col("n") * (F.length("word") + 1))
    excess = F.log1p(F.sum(F.col("n") * F.greatest(F.col("ratio") - STRONG, F.lit(0.0))))
    features = [F.sum(F.col("n") * F.col("ratio")) / chars, F.greatest(F.max("ratio"), F.lit(0.0)), excess, F.log1p(chars)]
    texts = words.join(ratios, "word").groupBy("_k1", "_k2").agg(*[x.alias(c) for x, c in zip(features, FEATURES)])
    rows = rows.select("_row", *row_key("_row.doc_id", "_row.text")).join(texts, ["_k1", "_k2"], "left")
    return rows.select("_row", F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES]).alias("_text"))


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, _toxic, _fold`` of the labels that may be learned from; of repeated ones the mean decides, null ones are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("_toxic"))
    return known.withColumn("_fold", F.crc32(F.col("doc_id").cast("string")) % 5)


def word_counts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``word, toxic, other``: how often each class of the ``known`` texts has each word."""
    texts = docs.select("doc_id", "text").join(known, "doc_id")
    words = texts.select("_toxic", F.explode(words_of(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.sum("_toxic").cast("long").alias("toxic"), F.sum(1 - F.col("_toxic")).cast("long").alias("other"))


def fit(features: np.ndarray, labels: np.ndarray) -> list[float]:
    """Logistic regression by Newton's steps with a small penalty: bias and weights for plain features."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    rows = np.column_stack([(features - mean) / scale, np.ones(len(features))])
    weights = np.zeros(rows.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - labels) + 0.1 * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(len(weights))
        weights -= np.linalg.solve(curve, slope)
    plain = weights[:-1] / scale
    return [float(weights[-1] - plain @ mean), *map(float, plain)]


def scored(docs: DataFrame, labels: DataFrame, order: int = ORDER, sent: int = SENT_GRAMS, sample: int = CALIBRATION) -> DataFrame:
    """``docs`` as ``_row`` with its ``_score`` (0 to 1, higher: toxic likelier).

    The models count all labelled rows of the folds 1 to 3; the regression is fitted on at most ``sample``
    rows of fold 4 (the first by a hash of their ids), and fold 0 is never learned from. Only ``text`` enters a
    score. Null, empty and letterless texts get the score of a text without words; long texts are taken
    whole. Without labels of both classes in both parts every score is 0. Repeated rows and other columns, of
    any name, pass unchanged; an empty table gives an empty result.
    """
    known = known_labels(labels)
    nothing = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.lit(0.0).alias("_score"))
    words = stored(word_counts(docs, known.where("_fold < 4")), "words")
    seen = words.agg(F.max("toxic"), F.max("other")).first()
    if not seen[0] or not seen[1]:
        return nothing
    models = Models.of(stored(log_ratios(words, order), "ratios"), order, sent)
    few = known.where("_fold = 4").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` rows of three numbers, so the texts need not be shuffled to meet them
    few = docs.select("doc_id", "text").join(F.broadcast(few) if sample <= 100_000 else few, "doc_id")
    rows = described(few, models).select("_text.*", F.col("_row._toxic").alias("_toxic")).toPandas()
    rows = rows.sort_values([*FEATURES, "_toxic"])  # whatever order they came in
    if rows["_toxic"].nunique() < 2:
        return nothing
    bias, *weights = fit(rows[FEATURES].to_numpy(), rows["_toxic"].to_numpy(float))
    margin = sum((w * F.col(f"_text.{c}") for w, c in zip(weights, FEATURES)), F.lit(bias))
    return described(docs, models).select("_row", (1 / (1 + F.exp(-margin))).alias("_score"))
