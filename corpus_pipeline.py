"""The corpus pipeline: five stages over `documents`, each one of the operators
of `morrowcart.llm`, each written as Parquet and read again before the next."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morrowcart.llm import decontam, jaccard_join, language_id, line_chunks, mixing
from morrowcart.llm.common import bounded_batches, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the text shows; `und` and undecided ones go."""
    return language_id.keep_known(docs, language_id.fit(docs.select("lang", "text")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the line chunks that stand elsewhere; documents that held nothing else go."""
    out = line_chunks.dedup_lines(docs)
    out = out.where((F.col("removed_chunks") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.when(F.col("removed_chunks") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


#: The stage's own measure; op5's query keeps the defaults of `jaccard_join`, which its SQL states.
SHINGLE, NEAR = 5, 80


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (of the smallest id) of each group of near-duplicates. Rows are
    known by id and text, so rows of one id and different texts are judged apart;
    rows without an id stay."""
    row, mark = F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.col("text").isNull()), "row_id"
    while mark in docs.columns:
        mark += "_"
    rows = docs.where("doc_id IS NOT NULL").select(row.alias("row_id"), "doc_id", "text")
    classes = stored(jaccard_join.jaccard_classes(rows, "row_id", words=SHINGLE, percent=NEAR).select("row_id", "component_id").distinct(), "classes")
    first = F.min(F.struct("doc_id", "row_id")).alias("first")
    kept = stored(rows.select("row_id", "doc_id").join(classes, "row_id").groupBy("component_id").agg(first).select("first.row_id").distinct(), "kept-rows")
    return (docs.withColumn(mark, row).join(kept.withColumnRenamed("row_id", mark), mark, "left_semi").dropDuplicates([mark, "doc_id", "text"]).drop(mark)
            .unionByName(docs.where("doc_id IS NULL")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with the words taken of each (repeats counted)."""
    return mixing.mix(docs, labels=table(spark, sf_dir, "labels")).where("taken > 0")


def _in_small_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


STAGES = [(name, _in_small_batches(stage)) for name, stage in (
    ("language ID", identify_language), ("line dedup", dedup_lines), ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate), ("mixing", mix_sources))]

#: Code lengths, rolling hashes and the latent space are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
