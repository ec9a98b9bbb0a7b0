"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardtally.llm import anntree, archives, exacttopk, filteraudit, licences, mergereplay, mixing, nearcopies, piecetable, quality, substrings, tokencounts, toxicity
from shardtally.llm import oracle
from shardtally.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = oracle.SQL


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("_row.doc_id", "_cut.n_words", "_cut.n_removed", F.sha2(F.col("_cut.kept"), 256).alias("kept_sha256"))


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, sf_dir, "documents"), size=2)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.totals(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = mergereplay.encode_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("_row.doc_id", "_code.*")


@query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exacttopk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.through_warc(table(spark, sf_dir, "pages"))


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anntree.nearest(table(spark, sf_dir, "embeddings"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    rows = quality.scored(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("_score") >= quality.KEEP_AT).cast("int").alias("predicted")
    return rows.select("_row.doc_id", quality.held_out("_row.doc_id").alias("held_out"), F.col("_score").alias("score"), predicted)


def licence_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: a third in one folder, the others by number in folders of three depths, on each of them.

    A folder ``a<n>`` has the documents of 2,000 numbers, the folders ``b<n>`` in it those of 200 each, and the folders
    ``c<n>`` in these of 50. Of ten numbers one lies in the uppermost folder itself and two in the next. A quarter of
    the files is named LICENSE.<number>, by a hash of the number; whether they hold a licence is for the text to say.
    """
    a, b, c = (F.concat(F.lit(x), F.expr(f"doc_id div {n}").cast("string")) for x, n in (("a", 2000), ("b", 200), ("c", 50)))
    digit = F.pmod(F.expr("doc_id div 3"), F.lit(10))
    folder = F.when(F.col("doc_id") % 3 == 0, F.lit("shared/all")).when(digit == 0, a).when(digit <= 2, F.concat_ws("/", a, b))
    name = F.concat(F.when(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, "LICENSE.").otherwise(""), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", folder.otherwise(F.concat_ws("/", a, b, c)), name)
    return docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


@query
def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(licence_files(table(spark, sf_dir, "documents")))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("_score") >= toxicity.TOXIC_AT).cast("int").alias("predicted")
    return rows.select("_row.doc_id", toxicity.held_out("_row.doc_id").alias("held_out"), F.col("_score").alias("score"), predicted)


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piecetable.transform_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("_row.doc_id", "_fim.*")


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
