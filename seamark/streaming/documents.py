"""Stages up to the entities are stateless for each document, so they run on streams as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.text import spans


def document_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def sentence_stream(docs: DataFrame) -> DataFrame:
    """Sentences of a stream of ``doc_id, text``."""
    cut = docs.where("text IS NOT NULL").select("doc_id", "text", F.posexplode(spans(F.col("text"))).alias("ord", "s"))
    return cut.select("doc_id", "ord", F.substring("text", F.col("s.a") + 1, F.col("s.b") - F.col("s.a")).alias("sentence"))


def arrivals(docs: DataFrame, late: str = "30 days", width: str = "1 day") -> DataFrame:
    """Documents a day and source on their time of publication, with a watermark for late rows."""
    return docs.withWatermark("published_at", late).groupBy(F.window("published_at", width).alias("w"), "source").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "source", "n")
