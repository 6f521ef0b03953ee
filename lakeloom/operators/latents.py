"""Latent vectors: style clusters and zero-shot tags."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.maths import dot, norm


def style_clusters(df: DataFrame, latent: str, k: int = 16, seed: int = 42, name: str = "cluster_id") -> DataFrame:
    """Adds the k-means cluster of each latent, -1 where there is none; k is at most the number of latents."""
    has = df.where(F.col(latent).isNotNull() & (F.size(latent) > 0))
    n = has.limit(k).count()
    if n < 2:
        return df.withColumn(name, F.when(F.coalesce(F.size(latent), F.lit(0)) > 0, F.lit(0 if n else -1)).otherwise(F.lit(-1)))
    vectors = has.withColumn("_vector", array_to_vector(F.col(latent).cast("array<double>")))
    model = KMeans(k=min(k, n), seed=seed, featuresCol="_vector", predictionCol=name, initMode="k-means||").fit(vectors.select("_vector"))
    out = model.transform(vectors).drop("_vector")
    rest = df.where(F.col(latent).isNull() | (F.size(latent) <= 0)).withColumn(name, F.lit(-1))
    return out.unionByName(rest)


#: Most prototypes or centroids; they travel with every task as one array.
MAX_PROTOTYPES = 10_000


def _best(df: DataFrame, latent: str, table: DataFrame, key: str, value: str, measure, largest: bool, name: str) -> DataFrame:
    """The table's key with the best measure; the table (a fixed set of prototypes) is one scalar subquery."""
    if table.limit(MAX_PROTOTYPES + 1).count() > MAX_PROTOTYPES:
        raise ValueError(f"more than {MAX_PROTOTYPES} prototypes; cluster them first")
    rows = table.agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).cast("array<double>").alias("v")))).alias("_table"))
    ranked = F.transform("_table", lambda p: F.struct((measure(F.col(latent), p["v"]) * (-1.0 if largest else 1.0)).alias("m"), p["k"].alias("k")))
    return df.withColumn("_table", rows.scalar()).withColumn(name, F.array_min(F.filter(ranked, lambda r: r["m"].isNotNull()))["k"]).drop("_table")


def zero_shot(df: DataFrame, latent: str, prototypes: DataFrame, key: str = "tag", value: str = "prototype", name: str = "style_tag") -> DataFrame:
    """Adds the prototype with the largest cosine, ties to the smallest key. Prototypes are a small fixed table."""
    return _best(df, latent, prototypes, key, value, lambda a, b: F.try_divide(dot(a, b), norm(a) * norm(b)), True, name)


def nearest_centroid(df: DataFrame, latent: str, centroids: DataFrame, key: str = "cluster", value: str = "centroid", name: str = "cluster_id") -> DataFrame:
    """Adds the centroid with the least squared distance, ties to the smallest key."""
    far = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y, 2)), F.lit(0.0), lambda s, x: s + x)
    return _best(df, latent, centroids, key, value, far, False, name)
