"""Index, description files and the report of a compiled dataset; all are small aggregates."""

from __future__ import annotations

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import reports
from lakeloom.sinks import shards


def write_index(registry: DataFrame, path: str) -> None:
    """The index as JSON lines, in source, cluster and id order across files."""
    reports.index_of(registry).orderBy("source", "cluster_id", "id").write.mode("overwrite").json(path)


def description_files(index: DataFrame, name: str, version: str = "1") -> dict[str, str]:
    """Texts of dataset_info.yaml, category.txt and classes.txt; none for an empty index."""
    s = reports.summary(index).first()
    if not s["n"]:
        return {}
    info = {"name": name, "version": version, "task": s["task"], "total": s["n"], "train": s["n_train"], "val": s["n_val"], "sources": s["sources"]}
    category = "Image Quality Assessment" if s["task"] == "quality" else "Object Detection"
    return {"dataset_info.yaml": yaml.safe_dump(info, sort_keys=False), "category.txt": category, "classes.txt": s["task"] or ""}


def report(index: DataFrame, name: str) -> str:
    """A short Markdown report: counts, category, metrics, and samples by source."""
    s = reports.summary(index).first()
    category, metrics = reports.TASK_CATEGORIES.get(s["task"], reports.TASK_CATEGORIES["detection"])
    rows = reports.by_source(index).orderBy(F.desc("n"), "display_source").toLocalIterator()
    lines = [f"# {name}", "", f"{category}. {s['n']:,} samples ({s['n_train']:,} train, {s['n_val']:,} val). Usual metrics: {metrics}.", "", "| Source | Samples |", "|-|-|"]
    return "\n".join([*lines, *(f"| {r['display_source']} | {r['n']:,} |" for r in rows)]) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def export(registry: DataFrame, dataset: str, path: str) -> None:
    """Shards, label files, index, description files and report of one dataset of a registry, below ``path``."""
    rows, spark = registry.where(F.col("dataset") == dataset), registry.sparkSession
    shards.write_shards(rows, f"{path}/shards", dataset)
    shards.write_labels(rows, f"{path}/labels")
    write_index(rows, f"{path}/index")
    index = reports.index_of(rows)
    for name, text in description_files(index, dataset).items():
        write_text(spark, f"{path}/{name}", text)
    write_text(spark, f"{path}/report.md", report(index, dataset))


def quarantine(rows: DataFrame, problem: str = "problem") -> tuple[DataFrame, DataFrame]:
    """Good rows, and failed rows with the time they were found."""
    return rows.where(F.col(problem).isNull()).drop(problem), rows.where(F.col(problem).isNotNull()).withColumn("at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
