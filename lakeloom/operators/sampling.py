"""Names, splits, dedup, budgets, interleaving and resume filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.maths import GIB
from lakeloom.operators.ordering import rank_in_group, running_total


def hash_bucket(key: Column, buckets: int = 10_000) -> Column:
    """Bucket of a string's hash, the same on every run and engine."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % buckets


def split_of(key: Column, train: float = 0.8) -> Column:
    return F.when(hash_bucket(key) < int(round(train * 10_000)), F.lit("train")).otherwise(F.lit("val"))


def keep_first(df: DataFrame, digest: str, order: list[str], group: list[str] | None = None) -> DataFrame:
    """The first row in ``order`` of each digest; rows without a digest all stay.

    Partitions keep their own first rows before anything is shuffled, so a digest with many rows is no hot key.
    """
    first = Window.partitionBy(*(group or []), digest).orderBy(*order)
    kept = df.where(F.col(digest).isNotNull()).withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")
    return kept.unionByName(df.where(F.col(digest).isNull()))


def new_digests(df: DataFrame, registry: DataFrame, digest: str = "hash") -> DataFrame:
    """Rows whose digest the registry lacks; rows without a digest stay."""
    known = registry.where(F.col(digest).isNotNull()).select(digest).distinct()
    return df.join(known, digest, "left_anti").select(df.columns)


def byte_budget(df: DataFrame, size: str, order: list[str], cap: Column | float, group: list[str] | None = None, used: int = 0) -> DataFrame:
    """Rows in ``order`` as long as the total before a row is under the cap: the row that crosses it is the last one."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    return running_total(df, size, order, group, "_total").where(F.col("_total") - F.coalesce(F.col(size), F.lit(0)) + used < cap).drop("_total")


def round_robin(df: DataFrame, source: str, key: str, group: list[str] | None = None, name: str = "turn") -> DataFrame:
    """Adds the round in which a row is drawn when each round takes one row of every source that has any left.

    Within a source rows are drawn by their key's hash. Order by group, this column and source to read the sequence.
    """
    shuffled = df.withColumn("_hash", F.md5(F.col(key).cast("string")))
    return rank_in_group(shuffled, [*(group or []), source], ["_hash", key], name).drop("_hash")


def reduce_sample(df: DataFrame, source: str, key: str, size: str, max_gb: float, train: float = 0.8, split: str = "split") -> DataFrame:
    """A source-balanced sample under a byte budget: round-robin within each split, each split with its share."""
    drawn = round_robin(df, source, key, [split])
    cap = F.when(F.col(split) == "train", F.lit(max_gb * GIB * train)).otherwise(F.lit(max_gb * GIB * (1 - train)))
    return byte_budget(drawn, size, ["turn", source, key], cap, [split])


def unregistered(df: DataFrame, registry: DataFrame, names: tuple[str, ...] = ("name",)) -> DataFrame:
    """Rows none of whose names (the current one, a legacy one) is registered yet; a null name never is."""
    known = registry.select(F.col("name").alias("_known")).where("_known is not null").distinct()
    for c in names:
        df = df.join(known, df[c] == known["_known"], "left_anti")
    return df


def with_index(df: DataFrame, group: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """Adds a running number from 0 in ``order`` within ``group``."""
    return rank_in_group(df, group, order, name).withColumn(name, F.col(name) - 1)


def checked_size(df: DataFrame, size: str, min_gb: float) -> DataFrame:
    """Total GiB and whether it reaches the minimum."""
    gib = F.coalesce(F.sum(size), F.lit(0)) / GIB
    return df.agg(gib.alias("total_gb"), (gib >= min_gb).alias("reaches_minimum"))
