"""The corpus pipeline: named stages, each the next one's input, over ``documents``.

Every stage but the last returns the columns of ``documents``; ``run`` writes
each stage's rows to the shared folder and reads them again, so a lost executor
repeats one stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyze.llm import mixing, neardup, packing, pii, toxicity
from panelyze.llm.common import free_names, save, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not call toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    names = free_names(docs, "score", "predicted")
    return toxicity.score(docs, model, tuple(names)).where(F.col(names[1]) == 0).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates; rows that repeat it go too."""
    kept_id, digest, nth = free_names(docs, "kept_id", "digest", "nth")
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(kept_id)).distinct()
    # Null ids belong to no group and stay.
    marked = docs.join(kept, F.col("doc_id") == F.col(kept_id), "left")
    marked = marked.where(F.col(kept_id).isNotNull() | F.col("doc_id").isNull())
    # Rows of one id and text: the join has dealt the rows by id, so this needs no further shuffle.
    same = Window.partitionBy("doc_id", digest).orderBy(digest)
    marked = marked.withColumn(digest, F.xxhash64("text")).withColumn(nth, F.row_number().over(same))
    return marked.where((F.col(nth) == 1) | F.col("doc_id").isNull()).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind."""
    masked = pii.redact(docs, pii.fit(docs))
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned models and a tokenizer: SQL cannot express run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
