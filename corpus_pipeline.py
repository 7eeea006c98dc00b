"""From raw documents to packed training sequences, in stages whose results are written and read again.

Every stage takes and returns the columns of documents, the last one adds its own.  Null or empty texts, repeated
rows, ties and empty tables are what the stage's operator says; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventloom.llm import lines, near, packing, quality, recompress
from eventloom.llm.tables import Scratch, read
from eventloom.scratch import release

Stage = Callable[..., DataFrame]


def _scratch(spark: SparkSession, scratch: Scratch | None) -> Scratch:
    """The caller's, who deletes its tables when the stage's rows are written; else one of the stage's own, whose tables
    (what the lazy result still reads) stay until the driver ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)  # texts are long, and stages are lazy: it stays set
    return scratch or Scratch(spark)


def _n_chars(docs: DataFrame) -> Column:
    """The length again, where a stage took something away."""
    return F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that either scorer calls bad go; null and empty texts are judged by the votes on them."""
    _scratch(spark, scratch)
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    release(spark)
    return quality.classify(docs, model).where("kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Boilerplate lines go, but for their first document; a document that has no word left without them goes."""
    out = lines.spread_lines(docs, scratch=_scratch(spark, scratch)).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", _n_chars(docs)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Of each component of linked documents the one of smallest doc_id stays (all rows that have it); rows of null doc_id stay."""
    found = near.jaccard_components(docs, near.Jaccard(words=5, percent=80), scratch=_scratch(spark, scratch))
    return docs.join(found.where("component_id < doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Passages of 50 words or more stay in one document; a document with nothing else goes."""
    out = recompress.drop_repeats(docs, window=50, scratch=_scratch(spark, scratch)).where("n_removed = 0 or n_removed < n_words")
    return out.withColumn("n_chars", _n_chars(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Each document's ids and an end id, in pieces of 2048 ids at most, in sequences: one row a piece.  Null and
    empty texts have the end id alone."""
    scratch = _scratch(spark, scratch)
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1, capacity=2048)
    pieces = scratch.written(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
    return packing.pack(pieces, capacity=2048, scratch=scratch)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: Components, trained scorers and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with Scratch(spark) as own:
            last, docs = docs, results.written(stage(spark, docs, sf_dir, own))
        results.drop(last)
        release(spark)
    return docs
