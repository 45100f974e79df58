"""The registered queries of this subpackage and their SQL.

Each applies its operator, with production parameters, to the whole table and returns the whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import ann, chat, langid, linededup, neardup, packing, pieces, quality, repeats, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines, and the SHA-256 of the remaining text."""
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), edits=linededup.CORPUS_EDITS)
    return out.select("doc_id", "_lines.n_lines", "_lines.n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces, and a sum of hashes of (place, ids) over its units."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.xxhash64("text").alias("mark"))
    mark = F.pmod(F.xxhash64("pos", "ids"), F.lit(1 << 31))
    copies = F.count_if(F.col("pos") == 0)  # rows that repeat a doc_id and its text come back as often
    found = pieces.encode_rows(_table(spark, sf_dir, "documents")).groupBy("doc_id", "mark")
    found = found.agg(F.expr("sum(size(ids)) div count_if(pos = 0)").alias("n_pieces"), F.sum(mark).alias("all"), copies.alias("copies"))
    out = docs.join(found, ["doc_id", "mark"], "left")
    return out.select("doc_id", F.coalesce("n_pieces", F.lit(0)).alias("n_pieces"), F.coalesce(F.expr("`all` div copies"), F.lit(0)).alias("ids_mark"))


def op3_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_filter(_table(spark, sf_dir, "pages"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(_table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_sentencepiece, op3_repeat_removal, op4_packing, op5_language_id, op6_url_filter, op7_nearest_neighbours, op8_chat_format, op9_quality_rules, op10_near_duplicates)}

ORACLES: dict[str, str] = {
    "op1_line_dedup": linededup.ORACLE,
    "op6_url_filter": urlfilter.oracle_sql(),
    "op8_chat_format": chat.ORACLE,
    "op9_quality_rules": quality.oracle_sql(),
    "op10_near_duplicates": neardup.ORACLE,
}
