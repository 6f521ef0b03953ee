"""Counts and summaries of an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.strings import display_source, name_source

#: Category, metric names and what they measure, by task; an unknown task reads as detection.
TASK_CATEGORIES = {
    "quality": ("Image quality assessment", "PLCC, SRCC"),
    "restoration": ("Image restoration", "PSNR, SSIM, LPIPS, FID"),
    "super-resolution": ("Super-resolution", "PSNR, SSIM"),
    "diffusion": ("Image generation", "FID, CLIP score"),
    "detection": ("Object detection", "mAP@50, mAP@50-95"),
    "segmentation": ("Segmentation", "mIoU"),
    "pose": ("Pose estimation", "mAP"),
}


def by_task(index: DataFrame) -> DataFrame:
    return index.groupBy("task").agg(F.count("*").alias("n"))


def by_source(index: DataFrame) -> DataFrame:
    """Count by displayed source: the middle parts of the sample's name, else its source column."""
    shown = display_source(name_source(F.col("name"), F.col("source")))
    return index.groupBy(shown.alias("display_source")).agg(F.count("*").alias("n"))


def summary(index: DataFrame) -> DataFrame:
    """One row: samples by split, sorted sources, and the task of the first row in index order."""
    return index.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "val").alias("n_val"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.min_by("task", F.struct("source", "cluster_id", "id")).alias("task"),
    )


def index_of(registry: DataFrame) -> DataFrame:
    """The registry without its blobs; a reader prunes those columns."""
    return registry.drop("clip_latent", "img_bytes")


def folder_sizes(listing: DataFrame, folder: str = "folder", length: str = "length") -> DataFrame:
    return listing.groupBy(folder).agg(F.sum(length).alias("bytes"), (F.sum(length) / 1024.0**3).alias("gib"))
