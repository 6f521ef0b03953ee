"""Which raw sources are still needed, and which references are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.strings import alternate_slug, ref_file, ref_slug, without_archive_suffix


def consumers(sources: DataFrame, refs: DataFrame) -> DataFrame:
    """``slug, model_key`` once for each model with a reference that contains the slug (or whose own alternate name
    is the slug), case-sensitively.

    Both sides are a manifest and a folder listing, so the contains-join is small by nature; equal references are
    joined once.
    """
    distinct = refs.select("ref", "model_key").distinct()
    met = sources.select("slug").distinct().join(distinct, F.contains(F.col("ref"), F.col("slug")) | (alternate_slug(ref_slug(F.col("ref"))) == F.col("slug")))
    return met.select("slug", "model_key").distinct()


def purge_plan(sources: DataFrame, refs: DataFrame, compiled: DataFrame) -> DataFrame:
    """``slug, decision, reason`` of every source: orphaned, compiled for all its consumers, or needed by some.

    ``compiled``: model_key, index_count; a consumer is satisfied if it has a non-empty index. Nothing is deleted.
    """
    done = compiled.groupBy("model_key").agg(F.max(F.coalesce("index_count", F.lit(0))).alias("n"))
    used = consumers(sources, refs).join(done, "model_key", "left").withColumn("ok", F.coalesce(F.col("n") > 0, F.lit(False)))
    per = used.groupBy("slug").agg(
        F.bool_and("ok").alias("all_ok"),
        F.array_join(F.array_sort(F.collect_list("model_key")), ", ").alias("users"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("model_key")))), ", ").alias("waiting"),
    )
    out = sources.select("slug").where("slug is not null").distinct().join(per, "slug", "left")
    return out.select(
        "slug",
        F.when(F.coalesce("all_ok", F.lit(True)), "purge").otherwise("keep").alias("decision"),
        F.when(F.col("all_ok").isNull(), "Orphaned (Not in manifest)")
        .when(F.col("all_ok"), F.concat(F.lit("Compiled for: "), "users"))
        .otherwise(F.concat(F.lit("Needed by: "), "waiting"))
        .alias("reason"),
    )


def source_status(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """Adds ``folder`` and ``status`` (Extracted, ZipOnly, Missing). ``listing``: slug, file_count, has_zip."""
    ref = F.col("ref")
    named = F.coalesce(without_archive_suffix(F.split(ref_file(ref), ":")[0]), F.element_at(F.split(F.replace(ref, F.lit("hf://"), F.lit("")), "/"), -1))
    files = listing.select(F.col("slug").alias("folder"), "file_count", "has_zip")
    joined = refs.withColumn("folder", named).join(files, "folder", "left")
    has_files, zipped = F.coalesce(F.col("file_count") > 0, F.lit(False)), F.coalesce(F.col("has_zip"), F.lit(False))
    status = (
        F.when(F.contains(ref, F.lit("hf://")), F.when(has_files, "Extracted").otherwise("Missing"))
        .when(zipped, "ZipOnly")
        .when(has_files, "Extracted")
        .otherwise("Missing")
    )
    return joined.withColumn("status", status).drop("file_count", "has_zip")


def missing_refs(status: DataFrame, order: str = "pos") -> DataFrame:
    """Each reference that is not extracted, once, with its first position."""
    return status.where(F.col("status").rlike("Missing|ZipOnly|HF_Partial")).groupBy("ref").agg(F.min(order).alias("first_pos"))
