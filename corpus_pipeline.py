"""The corpus pipeline: documents to a tokenised mixture, stage by stage.

Every stage works on all rows that the one before kept, and all but the last return the columns of
documents. ``run`` writes each stage to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardtally.llm import mergereplay, mixing, nearcopies, quality, substrings
from shardtally.llm.common import row_key, table
from shardtally.llm.queries import RANKS
from shardtally.sources.workspace import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the given documents' labels, does not reject.

    Null and empty texts are scored as texts without words. Repeated rows get equal scores; null ids are never
    learned from. Without labels of both classes nothing is rejected; an empty table stays empty. Columns
    beyond those of documents pass unchanged.
    """
    rows = quality.scored(docs, table(spark, sf_dir, "labels"))
    return rows.where(F.col("_score") >= quality.KEEP_AT).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest doc_id.

    Null ids come last; of one id, or of null ids alone, the text with the smallest hash stays. Repeated rows are one row.
    """
    groups = nearcopies.grouped(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "_k1", "_k2")).alias("_first")
    kept = groups.where("_group is not null").groupBy("_group").agg(first).select("_first._k1", "_first._k2")
    kept = kept.union(groups.where("_group is null").select("_k1", "_k2")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *row_key())
    return rows.join(kept, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]).select("_row.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 35 words that repeat; untouched texts stay as they are, emptied ones go.

    Null, empty and short texts hold no window and stay. Repeated rows are different places, so
    their windows repeat; other columns pass unchanged; an empty table stays empty.
    """
    rows = substrings.remove_repeats(docs)
    text = F.when(F.col("_cut.n_removed") > 0, F.col("_cut.kept")).otherwise(F.col("_row.text"))
    rows = rows.where("_cut.n_removed = 0 or _cut.n_removed < _cut.n_words").withColumn("_text", text)
    row = F.col("_row").withField("text", F.col("_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("_cut.n_removed") > 0, F.length("_text").cast("long")).otherwise(F.col("_row.n_chars")))
    return rows.select(row.alias("_row")).select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it.

    A null source is a source of its own, the last. Null and empty texts have no words, so the mixture
    takes none of them. Repeated rows and null ids are taken like any others; an empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids: the mixture as token ids, which decode to the very text.

    Null and empty texts have no ids; texts of any length are encoded whole; repeated rows each give a
    row, null ids and sources stay null; an empty table gives an empty result.
    """
    rows = mergereplay.encode_texts(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    same = F.col("_code.decoded") == F.encode(F.coalesce("_row.text", F.lit("")), "utf-8")
    ids = F.when(same, F.col("_code.ids")).otherwise(F.raise_error(F.lit("the ids do not decode to the text")).cast("string"))
    return rows.select("_row.doc_id", "_row.source", "_code.n_tokens", ids.alias("ids"))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mix", mix_sources),
    ("tokenise", tokenise),
]

#: The classifier and the tokeniser cannot be written in SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
