"""Token totals for every context limit from one exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardtally.llm.mergereplay import _ranks
from shardtally.sources.workspace import stored

STEP = 1024


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


def encoded_length(path: str, pattern: str):
    """A column function: tokens of a text by tiktoken, 0 for null."""

    def lengths(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(path, pattern)
        for texts in columns:
            yield pd.Series([len(encoder.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    lengths.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(lengths, "long")


def histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """``length, n_docs`` of a table of document lengths (nulls are left out)."""
    return lengths.where(F.col(length).isNotNull()).groupBy(F.col(length).alias("length")).agg(F.count("*").alias("n_docs"))


def by_limit(counts: DataFrame) -> DataFrame:
    """For every length that occurs, taken as the context limit L (between two of them all figures are linear in L):

    n_docs (of exactly L tokens), docs_longer, tokens_longer (of documents over L), truncated_tokens
    (sum of min(length, L)), lost_tokens, and rank_from (documents of at most L tokens: L is the
    p-quantile for every p up to rank_from / all documents). Suffix sums run within steps of
    ``STEP`` lengths and over the steps' totals, so no task holds more than one step or all steps.
    Nothing is approximate. An empty table gives an empty result.
    """
    counts = counts.withColumn("_step", F.floor(F.col("length") / STEP)).withColumn("_tokens", F.col("length") * F.col("n_docs"))
    later = Window.orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1)
    steps = counts.groupBy("_step").agg(F.sum("n_docs").alias("_n"), F.sum("_tokens").alias("_t"))
    everything = Window.partitionBy(F.lit(1))
    steps = steps.select(
        "_step",
        F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_later_n"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_later_t"),
        F.sum("_n").over(everything).alias("_all_n"),
        F.sum("_t").over(everything).alias("_all_t"),
    )
    inside = Window.partitionBy("_step").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("_n", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
    rows = rows.withColumn("_t", F.coalesce(F.sum("_tokens").over(inside), F.lit(0))).join(steps, "_step")
    longer, tokens = F.col("_n") + F.col("_later_n"), F.col("_t") + F.col("_later_t")
    return rows.select(
        "length",
        "n_docs",
        longer.alias("docs_longer"),
        tokens.alias("tokens_longer"),
        (F.col("_all_t") - tokens + F.col("length") * longer).alias("truncated_tokens"),
        (tokens - F.col("length") * longer).alias("lost_tokens"),
        (F.col("_all_n") - longer).alias("rank_from"),
    )


def totals(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``by_limit`` of the whole texts of ``docs`` (null and empty texts have length 0; other columns are not looked at)."""
    lengths = docs.select(encoded_length(path, pattern)("text").alias("length"))
    return by_limit(stored(histogram(lengths), "lengths"))  # read twice, made once
