"""Image listings, decoded pixels, companions and archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from lakeloom.functions import strings

#: Listing order of extensions; the match is exact, or in any case for a reduce.
EXTENSIONS = (".jpg", ".png", ".bmp", ".jpeg", ".webp")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")


def list_images(spark: SparkSession, path: str, any_case: bool = False) -> DataFrame:
    """``path, length, ext_rank`` of the images; samples are numbered by ext_rank and path."""
    ext = strings.extension(F.col("path"))
    ext = F.lower(ext) if any_case else ext
    rank = F.array_position(F.array(*map(F.lit, EXTENSIONS)), ext) - 1
    return list_files(spark, path).withColumn("ext_rank", rank.cast("int")).where("ext_rank >= 0")


def latest_folder(listing: DataFrame, folder: str = "folder") -> DataFrame:
    """The folder that was modified last."""
    return listing.agg(F.max_by(folder, F.struct("modificationTime", folder)).alias(folder))


def with_sidecars(images: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds ``caption``, the trimmed text of the file with the same folder and stem. ``texts``: path, value."""
    key = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    t = texts.select(key(F.col("path")).alias("_key"), F.regexp_replace("value", r"^\s+|\s+$", "").alias("caption")).dropDuplicates(["_key"])
    return images.withColumn("_key", key(F.col("path"))).join(t, "_key", "left").drop("_key")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    return raw.select("path", F.decode("content", "UTF-8").alias("value"))


def companions(weights: DataFrame, images: DataFrame) -> DataFrame:
    """Adds ``image_path``: the image beside a weights file with its stem, jpg before png before webp, else null."""
    key = lambda c: F.regexp_replace(c, r"\.[^./]*$", "")
    order = F.array_position(F.array(*map(F.lit, (".jpg", ".png", ".webp"))), F.lower(strings.extension(F.col("path"))))
    i = images.select(key(F.col("path")).alias("_key"), "path", order.alias("_order")).where("_order > 0")
    best = i.groupBy("_key").agg(F.min_by("path", F.struct("_order", "path")).alias("image_path"))
    return weights.withColumn("_key", key(F.col("path"))).join(best, "_key", "left").drop("_key")


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (``path, width, height, n_channels, data``) by Spark's image source; undecodable ones are left
    out."""
    raw = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    return raw.select(
        F.regexp_replace("image.origin", "^file:/+", "file:/").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data")
    )


def to_bgr(data: bytes, channels: int) -> np.ndarray:
    x = np.frombuffer(data, np.uint8).reshape(-1, channels)
    return np.repeat(x, 3, axis=1) if channels == 1 else x[:, :3]


@pandas_udf(T.DoubleType())
def dark_share(data: pd.Series, channels: pd.Series) -> pd.Series:
    """Share of pixels whose luma (ITU-R 601) is under 10."""
    weights = np.array([0.114, 0.587, 0.299])
    return pd.Series([float((np.floor(to_bgr(d, int(c)) @ weights + 0.5) < 10).mean()) if d else 1.0 for d, c in zip(data, channels)])


def pixel_features(pixels: DataFrame) -> DataFrame:
    """``path, width, height, hash, dark``: small images are gone before the pixel function runs."""
    digest = F.md5(F.concat(F.concat_ws("x", "width", "height", "n_channels").cast("binary"), "data"))
    return pixels.select("path", "width", "height", digest.alias("hash"), dark_share("data", "n_channels").alias("dark"))


def placeholder(width: int = 512, height: int = 512, grey: int = 128) -> bytes:
    """Pixels that stand for a missing image."""
    return bytes([grey]) * (width * height * 3)


@pandas_udf(T.StringType())
def zip_problem(content: pd.Series) -> pd.Series:
    """Null for a sound archive, else the first bad member or the error."""
    out = []
    for raw in content:
        try:
            out.append(zipfile.ZipFile(io.BytesIO(raw)).testzip())
        except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError) as e:
            out.append(f"{type(e).__name__}: {e}")
    return pd.Series(out, dtype=object)


def check_archives(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path)
    return raw.select("path", zip_problem("content").alias("problem"))


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """``archive, member, size`` of the files in the zip archives below a folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for where, raw in zip(f["path"], f["content"]):
                try:
                    rows += [(where, i.filename, i.file_size) for i in zipfile.ZipFile(io.BytesIO(raw)).infolist() if not i.is_dir()]
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["archive", "member", "size"])

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return raw.mapInPandas(run, "archive string, member string, size long")


def extraction_plan(members: DataFrame, existing: DataFrame) -> DataFrame:
    """Members that still have to be unpacked: those without a non-empty file of the same relative path."""
    return members.join(existing.where("length > 0").select(F.col("relative").alias("member")).distinct(), "member", "left_anti")


def download_targets(listing: DataFrame) -> DataFrame:
    """What to fetch of each repository: the named file, else well-known archives, else any archive or Parquet file,
    else everything. ``listing``: repo, target (or null), file."""
    low = F.lower("file")
    # Archives that are fetched by themselves.
    known = low.isin("spaq.tgz", "live.tgz", "csiq.tgz", "tid2013.tgz")
    archive = F.lit(False)
    for end in (".tgz", ".tar.gz", ".zip", ".parquet"):
        archive = archive | F.endswith("file", F.lit(end))
    rank = F.when(F.col("target").isNotNull(), F.when(F.col("file") == F.col("target"), 0)).when(known, 1).when(archive, 2).otherwise(3)
    ranked = listing.withColumn("rank", rank).where("rank is not null")
    best = ranked.groupBy("repo").agg(F.min("rank").alias("rank"))
    return ranked.join(best, ["repo", "rank"]).select("repo", "file", F.when(F.col("rank") == 3, "snapshot").otherwise("file").alias("mode"))
