"""Manifest, taxonomy and compiled-index sources."""

from __future__ import annotations

import json

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import strings

REFS = "model_key string, name string, pos int, ref string"


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file through Spark's file systems; None if it is missing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def parse_manifest(text: str) -> tuple[dict, list[tuple[str, str | None, int, str]]]:
    """Settings (prefix, suffix, size limits) and references of a YAML manifest."""
    doc = yaml.safe_load(text) or {}
    meta = doc.get("_registry_metadata") or {}
    limits = meta.get("global_constraints") or {}
    settings = {"name_prefix": meta.get("name_prefix"), "name_suffix": meta.get("name_suffix"), "min_size_gb": limits.get("min_size_gb"), "max_size_gb": limits.get("max_size_gb")}
    rows = []
    for key, d in (doc.get("datasets") or {}).items():
        for pos, entry in enumerate((d or {}).get("refs") or []):
            rows.append((key, (d or {}).get("name"), pos, entry["ref"] if isinstance(entry, dict) else str(entry)))
    return {k: v for k, v in settings.items() if v is not None}, rows


def read_manifest(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    settings, rows = parse_manifest(read_text(spark, path) or "")
    return settings, spark.createDataFrame(rows, REFS)


def datasets(refs: DataFrame, prefix: str = "", suffix: str = "Large") -> DataFrame:
    """One row per dataset: its task and output name."""
    d = refs.groupBy("model_key").agg(F.first("name", ignorenulls=True).alias("name"), F.count("*").alias("n_refs"))
    return d.withColumn("task", strings.detect_task(F.col("model_key"))).withColumn(
        "dataset", strings.dataset_name(F.lit(prefix), F.col("model_key"), F.col("name"), F.lit(suffix))
    )


def select_models(refs: DataFrame, model: str | None) -> DataFrame:
    return refs.where(F.lit(model).isNull() | (F.col("model_key") == F.lit(model)))


def model_needs(refs: DataFrame) -> DataFrame:
    """Which datasets need captions and style tags before they are compiled (those of the diffusion task)."""
    task = strings.detect_task(F.col("model_key"))
    return refs.select("model_key").distinct().select("model_key", (task == "diffusion").alias("needs_captions"), (task == "diffusion").alias("needs_styles"))


def read_taxonomy(spark: SparkSession, path: str) -> dict[str, int]:
    """Class name to id; empty if the file is missing."""
    text = read_text(spark, path)
    return {k: int(v) for k, v in json.loads(text).items()} if text else {}


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)
