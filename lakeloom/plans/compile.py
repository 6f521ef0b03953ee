"""Compile: raw samples to a registry, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom import plugins
from lakeloom.config import Config
from lakeloom.functions import strings
from lakeloom.operators import labels, latents, sampling


def compile_samples(samples: DataFrame, truth: DataFrame, on: str, order: list[str], cap_bytes: float, config: Config = Config(), registry: DataFrame | None = None) -> DataFrame:
    """Label join, quality gate, dedup of what passes it, and byte budget over named samples (``hash``, ``size``, ``source``).

    With a registry, its names are skipped and its hashes and bytes count first, so a rerun adds nothing new.
    """
    used = 0
    if registry is not None:
        samples = sampling.unregistered(samples, registry)
        samples = sampling.new_digests(samples, registry)
        used = registry.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    scored = samples.join(truth, on, "left" if config.vetting == "pass_through" else "inner")
    kept = labels.gate(scored, "source", config.quality_threshold, config.strict_ground_truth, config.vetting)
    if config.enable_dedup:
        kept = sampling.keep_first(kept, "hash", [on])
    return sampling.byte_budget(kept, "size", order, cap_bytes, used=used)


def compile_dataset(
    images: DataFrame,
    refs: DataFrame,
    model_key: str,
    dataset: str,
    config: Config = Config(),
    registry: DataFrame | None = None,
    models: dict[str, str] | None = None,
    content: str = "content",
    **ground_truth: DataFrame,
) -> DataFrame:
    """Registry rows of one dataset from an image listing.

    ``images``: slug, path, ext_rank, size, hash, width, height, dark (and annotations, latents and so on, which pass
    through). ``ground_truth``: votes, aadb, technical as :func:`lakeloom.operators.labels.attach_scores` takes them.
    ``models`` names registered plug-ins by kind (scorer, labeler, captioner, coder), which see the column ``content``.

    Numbers run over the whole listing, so that no threshold changes a name; then come what is registered already (by its
    name or its legacy name), the filters, the gate, dedup of what passed it, and the budget. Only rows without ground
    truth reach the scorer, and only rows that stay reach the labeler, the captioner and the coder.
    """
    wanted = refs.where(F.col("model_key") == model_key).select(strings.ref_slug(F.col("ref")).alias("slug")).distinct()
    rows = images.join(labels.lookup(wanted), "slug", "left_semi").withColumn("source", strings.clean_slug(F.col("slug")))
    # Cleaned slugs may collide: numbers run over all references of a source.
    rows = sampling.with_index(rows, ["source"], ["ext_rank", "slug", "path"])
    prefix = config.name_prefix or "loom"
    rows = (
        rows.withColumn("name", strings.sample_name(F.lit(prefix), F.col("source"), F.col("idx")))
        .withColumn("split", sampling.split_of(F.col("name"), config.train_split))
        .withColumn("dataset", F.lit(dataset))
        .withColumn("task", F.lit(None).cast("string"))
        .withColumn("task", strings.detect_task(F.lit(model_key)))
    )
    used = 0
    if registry is not None:
        rows = rows.withColumn("_legacy", strings.legacy_name(F.lit(prefix), F.col("idx")))
        rows = sampling.unregistered(rows, registry, ("name", "_legacy")).drop("_legacy")
        rows = sampling.new_digests(rows, registry)
        used = registry.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows = rows.where(labels.pixel_filters(F.col("width"), F.col("height"), F.col("dark"), config.black_threshold, config.min_dimension))
    scored = labels.attach_scores(
        rows.withColumn("file", strings.file_name(F.col("path"))).withColumn("stem", strings.stem(F.col("path"))), "source", "file", "stem", normalize=config.normalize_votes, **ground_truth
    )
    models = models or {}
    if "scorer" in models:
        scored = plugins.score_missing(scored, models["scorer"], content)
    kept = labels.gate(scored, "source", config.quality_threshold, config.strict_ground_truth, config.vetting)
    if config.enable_dedup:
        kept = sampling.keep_first(kept, "hash", ["source", "idx"])
    kept = sampling.byte_budget(kept, "size", ["source", "idx"], config.max_size_gb * 1024.0**3, used=used)
    if "labeler" in models and "annotations" in kept.columns:
        kept = plugins.label_missing(kept, models["labeler"], content)
    if "captioner" in models and "caption" in kept.columns:
        kept = plugins.caption(kept, models["captioner"], content)
    if "coder" in models and content in kept.columns:
        kept = plugins.recode(kept, models["coder"], content)
    if "clip_latent" in kept.columns:
        kept = latents.style_clusters(kept, "clip_latent", config.n_style_clusters, config.seed)
    else:
        kept = kept.withColumn("cluster_id", F.lit(-1))
    return kept.withColumn("score", F.round("score", 3))
