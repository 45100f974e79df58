"""Corpus pipeline: filter by language, deduplicate at three levels, pack.

Every stage reads all that its predecessor kept. All but the last return the
columns of ``documents``; a text that changes gets its n_chars anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.langid import identify, learn, remainder
from tickloom.llm.linededup import CORPUS_EDITS, dedup_lines
from tickloom.llm.neardup import near_duplicates
from tickloom.llm.packing import pack
from tickloom.llm.repeats import strip_repeats
from tickloom.llm.scratch import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose best language has a posterior below this are rejected.
MIN_SCORE = 0.5


def _changed(docs: DataFrame) -> DataFrame:
    """Documents that still hold a word, with their new length."""
    kept = docs.filter(F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a recognisable language; the others carry the predicted one."""
    model = learn(docs.filter(remainder("doc_id") != 2).select("doc_id", "text", "lang"))
    told = identify(docs, model, "text", carry=COLUMNS)
    kept = told.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out later copies of lines; documents that lose every word go."""
    return _changed(dedup_lines(docs, edits=CORPUS_EDITS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates; rows that repeat a doc_id are told apart by their texts."""
    gone = near_duplicates(docs, mark=True).filter("NOT kept").select(F.col("doc_id").alias("_id"), "_mark").distinct()
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_mark"))
    return docs.join(gone, same, "left_anti").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out byte strings that stand earlier; characters cut at an edge go too, and documents that lose every word."""
    return _changed(strip_repeats(docs, carry=("lang", "source", "n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences with their token ids."""
    return pack(docs)


STAGES = [("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near), ("suffix-array dedup", repeats), ("packing", packing)]

#: Learned language scores and token ids have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"stage{k}")
    return docs
