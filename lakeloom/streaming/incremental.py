"""Incremental compiling as a file stream: resume, dedup and micro-batch commits come from the checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from lakeloom.session import scratch_dir


def new_rows(spark: SparkSession, path: str, digest: str, *columns: Column | str, max_files: int = 100) -> DataFrame:
    """A stream of the Parquet files under ``path``, ``columns`` only, each digest once over all batches and restarts.

    ``max_files`` bounds a micro-batch. Without an event time the set of digests is the stream's state; it grows with
    distinct digests and is partitioned like any shuffle.
    """
    schema = spark.read.parquet(path).schema
    # A stream lists a folder; a single file is read through its folder with a name filter.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.getFileStatus(fs_path).isFile():
        stream = reader.option("pathGlobFilter", fs_path.getName()).parquet(fs_path.getParent().toString())
    else:
        stream = reader.parquet(path)
    return stream.select(*columns).dropDuplicates([digest])


def write_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Processes what is there and stops; a later call goes on from the checkpoint and adds only new digests."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def stream_registry(spark: SparkSession, path: str, digest: str, *columns: Column | str) -> DataFrame:
    """One run of the stream into a fresh folder, read back."""
    base = scratch_dir(spark)
    write_available(new_rows(spark, path, digest, *columns), f"{base}/registry", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/registry")
