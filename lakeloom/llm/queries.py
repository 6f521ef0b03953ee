"""The queries of this subpackage, their production parameters, and SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import chat, decontaminate, langid, multiindex, neardup, pages, pieces, pii, quality, toxicity
from lakeloom.llm.common import held_out_bucket, read_table


def piece_model_path() -> str:
    """The vocabulary file; LAKELOOM_PIECE_MODEL names another one."""
    if path := os.environ.get("LAKELOOM_PIECE_MODEL"):
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(read_table(spark, sf_dir, "documents"), quality.fit(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(held_out_bucket(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.predict(read_table(spark, sf_dir, "documents"), langid.fit_on(spark, sf_dir))
    return found.select("doc_id", F.coalesce(held_out_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_windows(rows), in_order=True)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read_table(spark, sf_dir, "documents"), piece_model_path(), with_ids=False)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.report(docs, pii.fit(docs))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.link_summary(read_table(spark, sf_dir, "embeddings"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(read_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(read_table(spark, sf_dir, "documents"), toxicity.fit(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(held_out_bucket(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "offending",
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids", "spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_language": op2_language,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_chat": op4_chat,
        "op5_pieces": op5_pieces,
        "op6_pii": op6_pii,
        "op7_embeddings": op7_embeddings,
        "op8_main_text": op8_main_text,
        "op9_toxicity": op9_toxicity,
        "op10_decontamination": op10_decontamination,
    }


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Links of similarity 0.8 from shared shingles, and what each document reaches by them.
_NEAR_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM r GROUP BY a
"""

_EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept FROM r LEFT JOIN n USING (a) GROUP BY r.a
"""

_LEAK_SQL = f"""
WITH i AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
q AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p))),
h AS (SELECT doc_id, item_id, n, i FROM q JOIN p USING (n, k)),
x AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
y AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are tested against brute-force versions and held-out accuracy."""
    return {"op3_near_duplicates": _NEAR_SQL, "op7_embeddings": _EMBEDDING_SQL, "op10_decontamination": _LEAK_SQL}
