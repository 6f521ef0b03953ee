"""Exports: TAR shards and label files, written by executors to a folder that all of them share.

``df.write.format("loom_tar").option("path", ...)`` takes ``shard, key, jpg, txt, json`` and writes each shard's rows in the
order they come; use :func:`ordered_shards` before it. ``max_bytes`` starts a further file of a shard once it is reached.
"""

from __future__ import annotations

import io
import os
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from lakeloom.functions import arrays, strings


def ordered_shards(registry: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    """Rows with bytes as ``shard, key, jpg, txt, json``; a shard is one source in cluster and id order.

    Rows are range-partitioned, so a large source spans several tasks; each task writes its own file of the shard, and
    the files' numbers keep the order.
    """
    parts = int(registry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = registry.where(F.col("img_bytes").isNotNull())
    rows = rows.repartitionByRange(parts, "source", "cluster_id", "id").sortWithinPartitions("source", "cluster_id", "id")
    return rows.select(
        strings.shard_name(F.lit(prefix), F.col("source"), F.lit(suffix)).alias("shard"),
        F.col("name").alias("key"),
        F.col("img_bytes").alias("jpg"),
        F.coalesce("caption", F.lit("")).alias("txt"),
        arrays.shard_json(F.col("style_tag"), F.col("cluster_id"), F.col("source")).alias("json"),
    )


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _TarWriter(DataSourceWriter):
    def __init__(self, path: str, max_bytes: int):
        self.path, self.max_bytes = path, max_bytes

    def write(self, rows: Iterator) -> _Written:
        from pyspark import TaskContext

        part, files, tar, shard, size, n = TaskContext.get().partitionId(), [], None, None, 0, 0
        os.makedirs(self.path, exist_ok=True)
        for r in rows:
            if tar is None or r["shard"] != shard or size >= self.max_bytes:
                if tar is not None:
                    tar.close()
                shard, size, n = r["shard"], 0, n + 1
                base = shard.removesuffix(".tar")
                final = os.path.join(self.path, f"{base}-{part:05d}-{n:05d}.tar")
                temporary = f"{final}.{uuid.uuid4().hex}"
                files.append((temporary, final))
                tar = tarfile.open(temporary, "w")
            for ext in ("jpg", "txt", "json"):
                raw = r[ext] if isinstance(r[ext], (bytes, bytearray)) else (r[ext] or "").encode()
                info = tarfile.TarInfo(f"{r['key']}.{ext}")
                info.size = len(raw)
                tar.addfile(info, io.BytesIO(bytes(raw)))
                size += len(raw)
        if tar is not None:
            tar.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        for m in messages:
            for temporary, final in m.files if m else []:
                os.replace(temporary, final)

    def abort(self, messages: list) -> None:
        for m in messages:
            for temporary, _ in m.files if m else []:
                if os.path.exists(temporary):
                    os.remove(temporary)


class TarSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "loom_tar"

    def schema(self) -> str:
        return "shard string, key string, jpg binary, txt string, json string"

    def writer(self, schema, overwrite: bool) -> _TarWriter:
        return _TarWriter(self.options["path"].removeprefix("file://"), int(self.options.get("max_bytes", str(1 << 30))))


class _LabelWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> _Written:
        for r in rows:
            folder = os.path.join(self.path, r["split"])
            os.makedirs(folder, exist_ok=True)
            temporary = os.path.join(folder, f".{uuid.uuid4().hex}")
            with open(temporary, "w", encoding="utf-8") as f:
                f.write("".join(f"{line}\n" for line in r["label_lines"] or []))
            os.replace(temporary, os.path.join(folder, f"{r['name']}.txt"))
        return _Written([])


class LabelSource(DataSource):
    """One text file per sample; an empty one without annotations."""

    @classmethod
    def name(cls) -> str:
        return "loom_labels"

    def schema(self) -> str:
        return "name string, split string, label_lines array<string>"

    def writer(self, schema, overwrite: bool) -> _LabelWriter:
        return _LabelWriter(self.options["path"].removeprefix("file://"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TarSource)
    spark.dataSource.register(LabelSource)


def write_shards(registry: DataFrame, path: str, prefix: str = "", suffix: str = "", max_bytes: int = 1 << 30) -> None:
    register(registry.sparkSession)
    ordered_shards(registry, prefix, suffix).write.format("loom_tar").mode("append").option("path", path).option("max_bytes", max_bytes).save()


def write_labels(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.select("name", "split", "label_lines").write.format("loom_labels").mode("append").option("path", path).save()


def copy_plan(samples: DataFrame, files: DataFrame) -> DataFrame:
    """Image, label and target paths of each sample (by stem). ``files``: kind (images, labels, targets), path."""
    by = files.select("kind", "path", strings.stem(F.col("path")).alias("name")).groupBy("name").pivot("kind", ["images", "labels", "targets"]).agg(F.min("path"))
    return samples.join(by, "name", "left")
