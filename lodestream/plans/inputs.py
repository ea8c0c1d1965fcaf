"""Operator inputs made from the test tables, written alike in Spark and in SQL (see oracles.py)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.functions import urls


TEXTS = ("documents", "pages", "part", "conversations")  # tables whose rows are much work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def spread(df: DataFrame) -> DataFrame:
    """Over all cores where the scan has fewer tasks than there are cores, as for a file of one row group. A table that Spark reads in enough tasks is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if os.environ.get("BENCH_SPREAD") != "0" and df.rdd.getNumPartitions() < cores else df


def page_items(spark, sf_dir) -> DataFrame:
    """Pages as pool rows; entity: the domain."""
    return table(spark, sf_dir, "pages").select("page_id", F.col("page_id").alias("pool_pos"), "url", urls.domain(F.col("url")).alias("entity_name"), "html")


def url_variants(spark, sf_dir) -> DataFrame:
    """Each page's URL, and once more in another spelling."""
    p = page_items(spark, sf_dir)
    again = p.select((F.col("pool_pos") + 1_000_000_000).alias("pool_pos"), F.concat(F.upper(F.regexp_replace("url", "[?#].*$", "")), F.lit("/#x")).alias("url"), "entity_name")
    return p.select("pool_pos", "url", "entity_name").union(again)


def documents(spark, sf_dir) -> DataFrame:
    """Documents as scraped pages of their source; every 50th failed."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("doc_id").alias("pool_pos"), F.col("source").alias("entity_name"), F.col("text").alias("text_content"), F.when(F.col("doc_id") % 50 == 0, "error").otherwise("success").alias("status"), F.concat(F.lit("https://x.org/"), "source", F.when(F.col("doc_id") % 7 == 0, "/tag/").otherwise("/p/"), F.col("doc_id").cast("string")).alias("url"), F.when(F.col("doc_id") % 11 == 0, "Cookie notice").otherwise("Page").alias("title"))


def articles(spark, sf_dir) -> DataFrame:
    """An article for each part, with claims, citations and three sources."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    ks = k.cast("string")
    md = F.concat(F.lit("## [Category: "), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")), F.lit("]\n\nThe company was founded in 19"), F.lpad((k % 90 + 10).cast("string"), 2, "0"), F.lit(" in a **small** town. It employs over "), ks, F.lit(" people now [#"), (k % 5 + 1).cast("string"), F.lit("]. Growth is steady and calm here. A share of "), (k % 100).cast("string"), F.lit("% was sold [#1].\n\n- first point\n- second point\n\n## Meta\n\nTitle: x"))
    cites = F.array(*(F.struct(F.lit(i).alias("index"), F.concat(F.lit(f"https://s{i}.org/"), ks).alias("url"), F.lit(f"Source {i}").alias("title")) for i in (1, 2, 3)))
    return p.select(F.concat("p_name", F.lit(" "), ks).alias("entity_name"), md.alias("markdown"), F.concat(F.lit("About "), "p_name").alias("title"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("sources"), cites.alias("citations"), k.alias("k"), "p_brand", "p_type", "p_name")
