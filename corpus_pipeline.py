"""Corpus pipeline: five stages over ``documents``, each written and read again.

quality classifier -> n-gram Jaccard join -> PII -> mixing -> best-fit packing.
Every stage works on all rows its predecessor kept. All but the last return the
columns of ``documents``; the last returns the packed pieces.

Nulls and empty texts: a null or empty text is scored like any other by the classifier,
is its own Jaccard class, has no personal data, adds no words to the mix and is a
piece of one closing id. Rows with a null id are kept by the first stages. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm.common import cut, keep_text_batches, small, table
from plaudit.llm.jaccard import jaccard_classes
from plaudit.llm.mixing import mix, word_count
from plaudit.llm.packing import pack_documents
from plaudit.llm.pii import sanitise
from plaudit.llm.quality import fit_quality, quality_score
from plaudit.operators.rank import ordinal_rank
from plaudit.session import ensure_checkpoint_dir, scratch_path

QUALITY_THRESHOLD = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores at least ``QUALITY_THRESHOLD``."""
    keep_text_batches(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(model, F.col("text")) >= QUALITY_THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each Jaccard class: the one with the smallest id.

    Classes are of rows. Where ids are null or occur twice, rows are numbered in the order of their
    ids, so that unlike texts under one id are judged each on its own; rows that repeat
    an id and a text without words (which link with nothing) stay once.
    """
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1 or doc_id is null")
    if again.isEmpty():
        return _one_of_each_class(docs)
    # Identical rows may swap their numbers: either of them stays.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc_nulls_first()]
    numbered = ordinal_rank(docs, order, name="__number")
    kept = _one_of_each_class(numbered, "__number")
    wordless = F.coalesce(word_count(F.col("text")) == 0, F.lit(True))
    once = kept.where(wordless).dropDuplicates(["doc_id", "text"])
    return kept.where(~wordless).unionByName(once).drop("__number")


def _one_of_each_class(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    classes = cut(jaccard_classes(docs, key))
    id_column = classes.columns[0]
    gone = cut(classes.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("__gone")).distinct())
    return docs.join(small(gone, gone.count()), F.col(key) == F.col("__gone"), "left_anti")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms masked; ``n_chars`` of the new text."""
    masked = sanitise(docs)
    length = F.when(F.col("text").isNotNull(), F.length("text").cast("long"))
    return masked.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    sized = docs.withColumn("__words", word_count(F.col("text")))
    mixed = mix(sized, "__words")
    times = mixed.where(F.col("taken_copies") > 0)
    return times.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("taken_copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    keep_text_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
# The classifier is fitted and the tokens come from a vocabulary file: SQL cannot
# express them. tests/llm/test_pipeline.py holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
