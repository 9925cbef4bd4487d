"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. language: rows that the classifier rejects go (no letter, or a best probability below
   the calibrated threshold).
2. near_duplicates: one document of each group of near copies stays (five-word
   shingles, similarity 0.8), the one with the smallest doc_id (a null one last), as one row.
3. decontamination: documents that hold a passage of a benchmark item go.
4. pii: personal data becomes ``[kind]``; n_chars follows the text.
5. mix: how many words the mix takes of each remaining document.

Null or empty texts are rejected by the first stage; extra columns pass through; an
empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.llm import decontaminate, language, mix, ngram_join, pii
from tonality.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))))
    named = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    guessed = language.predict(named, model, reject=True)
    return guessed.filter(F.col("lang_pred") != language.UND).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Whether a passage is held depends on the text alone, so rows without doc_id are told apart by it.
    digest = F.sha2(F.col("text").cast("binary"), 256)
    found = decontaminate.contaminated(docs.select(digest.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = written(found.select(F.col("doc_id").alias("_digest")).distinct(), "contaminated")
    return docs.join(bad, digest == F.col("_digest"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(clean.schema["n_chars"].dataType))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mix(docs)


STAGES = [("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("pii", pii_stage), ("mix", mix_stage)]

# Trained models, alignment and string search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
