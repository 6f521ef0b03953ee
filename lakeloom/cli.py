"""Command line: ``python -m lakeloom.cli compile|reduce|cleanup|status|acquire``."""

from __future__ import annotations

import sys

from pyspark.sql import functions as F

from lakeloom.config import Config, parse_args
from lakeloom.operators.purge import source_status
from lakeloom.plans import cleanup, reduce
from lakeloom.session import build_session
from lakeloom.sinks import reports
from lakeloom.sinks.registry import Registry
from lakeloom.sources import ground_truth, images, manifest


def _listing(spark, raw: str):
    files = images.list_files(spark, raw).withColumn("_rest", F.regexp_replace("path", f"^.*?{raw.rstrip('/').rsplit('/', 1)[-1]}/", ""))
    named = files.withColumn("slug", F.regexp_replace(F.split("_rest", "/")[0], r"\.zip$", "")).withColumn("zip", F.endswith("_rest", F.lit(".zip")) & ~F.contains("_rest", F.lit("/")))
    return named.groupBy("slug").agg(F.count_if(~F.col("zip")).alias("file_count"), F.bool_or("zip").alias("has_zip"))


def main(argv: list[str]) -> int:
    args = parse_args(argv)
    spark = build_session()
    settings, refs = manifest.read_manifest(spark, args["manifest"])
    config = Config.load(args["config"], settings | {k: v for k, v in args.items() if v is not None})
    refs = manifest.select_models(refs, config.model)
    if args["command"] in ("status", "acquire"):
        listing = _listing(spark, args["raw"])
        out = source_status(refs, listing) if args["command"] == "status" else cleanup.acquisition_plan(refs, listing)
        out.show(10_000, False)
    elif args["command"] == "cleanup":
        index = Registry(spark, args["out"]).read()
        named = manifest.datasets(refs, config.name_prefix, config.name_suffix)
        compiled = named.join(index.groupBy("dataset").agg(F.count("*").alias("index_count")), "dataset")
        print("\n".join(cleanup.render(cleanup.cleanup_plan(_listing(spark, args["raw"]), refs, compiled))))
    elif args["command"] == "reduce":
        registry = Registry(spark, args["out"])
        registry.append(reduce.reduce_dataset(registry.read(), config.max_size_gb, "Small", config))
    else:
        from lakeloom.plans.compile import compile_dataset

        registry = Registry(spark, args["out"])
        for row in manifest.datasets(refs, config.name_prefix, config.name_suffix).orderBy("model_key").collect():
            listing = images.list_images(spark, args["raw"])
            pixels = images.pixel_features(images.read_pixels(spark, args["raw"]))
            base = listing.withColumn("slug", F.element_at(F.split("path", "/"), -2)).withColumnRenamed("length", "size").join(pixels, "path", "left")
            done = registry.read().where(F.col("dataset") == row["dataset"])
            truth = ground_truth.read_all(spark, config.ground_truth)
            registry.append(compile_dataset(base, refs, row["model_key"], row["dataset"], config, done, config.models, **truth))
            if args["export"]:
                reports.export(registry.read(), row["dataset"], f"{args['export'].rstrip('/')}/{row['dataset']}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
