"""Reduce: a source-balanced sample of a compiled dataset under a byte budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.config import Config
from lakeloom.functions import strings
from lakeloom.operators.sampling import reduce_sample


def reduce_dataset(index: DataFrame, max_gb: float, suffix: str, config: Config = Config()) -> DataFrame:
    """Rows of the sample with their new ``dataset`` name; task and source stay."""
    prefix = config.name_prefix or "loom"
    slug = F.coalesce(F.nullif(strings.slug_of_name(F.col("name"), prefix), F.lit("")), F.col("source"))
    drawn = reduce_sample(index.withColumn("_slug", slug), "_slug", "name", "size", max_gb, config.train_split)
    return drawn.withColumn("dataset", strings.strip_suffix(F.col("dataset"), F.lit(config.name_suffix), F.lit(suffix))).drop("_slug", "turn")
