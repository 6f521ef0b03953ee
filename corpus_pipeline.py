"""From raw documents to token ids: language, near-duplicates, benchmark passages, personal data, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns a DataFrame that is written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, langid, neardup, pieces, pii
from lakeloom.llm.common import discard, held_out_bucket, materialize, read_table
from lakeloom.llm.queries import piece_model_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that cross-parsing recognises, with ``lang`` set to it; texts without a letter go."""
    model = langid.fit(spark, docs, held_out_bucket(F.col("doc_id"), 5) != 0)
    return langid.keep_known(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return neardup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced by tags."""
    return pii.redact(docs, pii.fit(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return pieces.encode(docs, piece_model_path())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: SQL cannot express the learned stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir))
        discard(docs)
        docs = done
    return docs
