"""Corpus pipeline: five stages of tidemark.llm over ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes a
stage's result as Parquet in the shared scratch folder and reads it again as
the next one's ``docs``. All but the last return the columns of documents;
``n_chars`` is brought up to date where a stage changes the text. What a stage
wrote on its way, and its input, are deleted once its result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard_join, line_dedup, mixing, toxicity
from tidemark.llm.queries import vocabulary
from tidemark.session import remove_scratch, scratch_path, scratch_scope
from tidemark.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of
    rows outside the held-out fold, as in op4."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.filter("predicted = 0").select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-repeated lines go, short ones if they are equal; every document stays, if need be without text."""
    return _documents(line_dedup.line_dedup(docs, exact_words=1))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity the smallest id stays. The
    ids that go are the only ones joined; NULL ids stay."""
    groups = jaccard_join.jaccard_components(docs)
    gone = groups.filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: one row per document and epoch with the words
    that the mix takes of it in that epoch."""
    return _documents(mixing.mixed_documents(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, the digest of the ids, and the digest of the text that the
    ids decode to."""
    return bpe.encode_decode_documents(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("jaccard_join", one_per_group),
          ("mixing", mix), ("bpe", encode)]

# A trained classifier, SimHash groups and seeded draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before is not None:
            remove_scratch(spark, before)
        before = path
    return docs
