"""From documents to packed training sequences, in five stages.

Every stage maps a relation with the columns of ``documents`` to the rows it keeps; its
result is stored as Parquet in the shared folder and read again by the next stage. The last
stage returns the place of every piece in a sequence. NULL, empty and repeated rows are
treated as the operators define; extra columns pass through all stages but the last. Each
stage begins by letting go of what jobs before it left: shuffle files and native buffers that
wait for a collection the driver's half-empty heap would not ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import decontam, langid, neardup, packing, pii
from forumlens.llm.common import fresh, release, stored

#: Below this score no language is recognised; texts in a learned language score far above it.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; learned from the labelled rows among them."""
    release(spark)
    lang, score = fresh(docs, "_lang", "_score")
    found = langid.classified(docs, langid.train(docs), lang_as=lang, score_as=score)
    return found.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    release(spark)
    return neardup.deduplicated(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    release(spark)
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced; ``n_chars`` follows the text."""
    release(spark)
    out = pii.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_plan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document, measured in bytes."""
    release(spark)
    return packing.packed(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_leaks", benchmark_leaks),
          ("personal_data", personal_data), ("packing", packing_plan)]

#: Fitted models and signatures are not SQL: the stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
