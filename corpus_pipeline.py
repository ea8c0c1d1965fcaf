"""A corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents, whatever others docs has besides. What each stage decides: texts without any letter go; later copies of repeated
line runs go, and with them documents of which nothing is left; of each component of near duplicates the document of the
least id stays; contaminated documents go; the rest is encoded, whole. Each docstring defines nulls, repeats and ties.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.llm.common import shared_dir, table
from lodestream.llm.decontaminate import decontaminate
from lodestream.llm.jaccard_join import link
from lodestream.llm.langid import fit, predict
from lodestream.llm.line_dedup import dedup_lines
from lodestream.llm.sentencepieces import encode, load


def _key():
    """Of rows with equal id and text; null ids come last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("h"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter. Null and empty texts go. The model is learned from docs; a table without languages rejects every row. Rows are judged by their text alone, so repeated rows and null or repeated ids change nothing."""
    return predict(docs, fit(docs)).where("lang_pred != 'und'").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more, in the order of doc_id and line; n_chars follows the text. What loses all of its text goes; null and empty texts stay as they are. Rows of equal id and text are one document and stay or go together; null ids come first."""
    out = dedup_lines(docs).where("n_deleted = 0 or text != ''")
    return out.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.char_length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts: that of the least doc_id, null ids last, then of the least hash of the text, then any of rows that repeat both. Rows count by id and text, so a different text under the same id is judged on its own. Texts without words are linked with nothing and stay, repeated ones too."""
    linked = link(docs.select(_key().alias("doc_id"), "text"))
    marks = linked.groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("component_id")).alias("gone"), ((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("again")).where("gone or again")
    marks = marks.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_h"), "gone", "again")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    marked = rows.join(marks.withColumnsRenamed({"_id": "_i", "_h": "_g"}), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left").where("gone is null or not gone")
    first = F.row_number().over(Window.partitionBy("_id", "_h").orderBy("_id"))
    return marked.withColumn("_n", first).where("_n = 1 or again is null or not again").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window of ten words with a benchmark item. Rows count by id and text: another text under the id of a contaminated one stays. Null texts have no words and stay."""
    found = decontaminate(docs.select(_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).where("contaminated")
    found = found.select(F.col("doc_id.doc_id").alias("_i"), F.col("doc_id.h").alias("_g")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left_anti").select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every row; both null for a null text, none for an empty one. Repeated rows give repeated results."""
    return encode(docs.select("doc_id", "lang", "source", "text"), load(spark)).withColumn("n_tokens", F.size("ids"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]

#: Language ID and the unigram search have no SQL form; tests/llm hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written as Parquet into the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
