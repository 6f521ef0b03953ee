"""Cleanup and acquisition: plans only; nothing is deleted or downloaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import strings
from lakeloom.operators.purge import missing_refs, purge_plan, source_status


def cleanup_plan(raw: DataFrame, refs: DataFrame, compiled: DataFrame) -> DataFrame:
    """``slug, decision, reason`` of every raw folder (``raw``: slug)."""
    return purge_plan(raw, refs, compiled)


def render(plan: DataFrame) -> list[str]:
    """Lines of a plan, purgeable first; the plan has one row per raw folder."""
    line = F.concat(F.lit("  - "), strings.pad_right(F.col("slug"), 40), F.lit(" | "), F.col("reason"))
    return [r["line"] for r in plan.orderBy(F.desc("decision"), "slug").select(line.alias("line")).collect()]


def acquisition_plan(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """Each missing reference once: what to fetch, from which repository, which file, in order of first mention."""
    missing = missing_refs(source_status(refs, listing))
    return missing.select("ref", "first_pos", strings.ref_repo(F.col("ref")).alias("repo"), strings.ref_file(F.col("ref")).alias("file"), strings.ref_slug(F.col("ref")).alias("folder"))
