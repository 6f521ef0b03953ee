"""Running totals and ranks without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import materialize


def running_total(df: DataFrame, value: str | None, order: list[str], group: list[str] | None = None, name: str = "running") -> DataFrame:
    """Adds the sum of ``value`` (a count where it is None) up to and with each row, in ``order`` within ``group``.

    Rows are range-partitioned once by group and order and written out, so that partition numbers are stable; each
    partition sums its own rows, the partitions' sums give offsets, and a window within partitions does the rest. A
    group of any size is spread over partitions. ``order`` must be unique within a group for a defined result.
    """
    group = group or []
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    amount = F.lit(1).cast("long") if value is None else F.coalesce(F.col(value), F.lit(0))
    ranged = df.withColumn("_amount", amount).repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged)
    sums = ranged.groupBy(*group, "_part").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) if group else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("_part").alias("_of__part"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    same = F.lit(True)
    for c in [*group, "_part"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = ranged.join(offsets, same).select(*ranged.columns, "_offset")
    within = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(name, F.sum("_amount").over(within) + F.col("_offset")).drop("_amount", "_part", "_offset")


def rank_in_group(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Adds each row's number (from 1) in ``order`` within ``group``."""
    return running_total(df, None, order, group, name)
