"""Annotations, tags and label lines over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.maths import box_to_yolo, normalize_points, round6

ANNOTATION = "struct<type:string,cls:int,data:array<double>>"


def first_ring(segmentation_json: Column) -> Column:
    """First polygon of a JSON list of polygons; null for run-length objects and empty lists."""
    return F.get(F.from_json(segmentation_json, "array<array<double>>", {"mode": "PERMISSIVE"}), F.lit(0))


def annotation(kind: str, cls: Column, data: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), cls.cast("int").alias("cls"), data.cast("array<double>").alias("data"))


def coco_annotation(cls: Column, bbox: Column, segmentation_json: Column, keypoints: Column, width: Column, height: Column) -> Column:
    """Keypoints before segmentation before box; null where the chosen kind holds nothing usable."""
    ring = first_ring(segmentation_json)
    has_points = F.coalesce(F.size(keypoints) > 0, F.lit(False))
    has_ring = segmentation_json.isNotNull() & ~F.trim(segmentation_json).isin("", "[]", "{}", "null")
    return (
        F.when(has_points, annotation("pose", cls, F.concat(bbox.cast("array<double>"), normalize_points(keypoints, width, height, 3))))
        .when(has_ring, F.when(F.size(ring) > 0, annotation("segmentation", cls, normalize_points(ring, width, height))))
        .when(bbox.isNotNull(), annotation("bbox", cls, bbox))
    )


def table_annotation(cls: Column, bbox: Column, polygon: Column | None, keypoints: Column | None, width: Column, height: Column) -> Column:
    """Annotation of a table's row: polygon, then keypoints (with an empty box), then box."""
    out = F.when(bbox.isNotNull(), annotation("bbox", cls, bbox))
    if keypoints is not None:
        zero = F.array(*[F.lit(0.0)] * 4)
        out = F.when(F.coalesce(F.size(keypoints) > 0, F.lit(False)), annotation("pose", cls, F.concat(zero, normalize_points(keypoints, width, height, 3)))).otherwise(out)
    if polygon is not None:
        out = F.when(F.coalesce(F.size(polygon) > 0, F.lit(False)), annotation("segmentation", cls, normalize_points(polygon, width, height))).otherwise(out)
    return out


def has_kind(annotations: Column, kind: str) -> Column:
    return F.coalesce(F.exists(annotations, lambda a: a["type"] == kind), F.lit(False))


def tags(tag_frequency_json: Column, datasets_json: Column, most: int = 20) -> Column:
    """Distinct tags of all buckets, else those of the data sets' lists; sorted, at most ``most``. Bad JSON has none."""
    buckets = F.from_json(tag_frequency_json, "map<string,map<string,long>>")
    first = F.flatten(F.transform(F.map_values(buckets), lambda m: F.map_keys(m)))
    sets = F.from_json(datasets_json, "array<struct<tag_frequency:map<string,long>>>")
    second = F.flatten(F.transform(F.filter(sets, lambda d: d["tag_frequency"].isNotNull()), lambda d: F.map_keys(d["tag_frequency"])))
    chosen = F.when(F.coalesce(F.size(first), F.lit(0)) > 0, first).otherwise(second)
    return F.slice(F.array_sort(F.array_distinct(F.coalesce(chosen, F.array().cast("array<string>")))), 1, most)


def whole_image_boxes(classes: Column) -> Column:
    return F.transform(classes, lambda c: annotation("bbox", c, F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))))


def numbers(a: Column, digits: int = 6) -> Column:
    return F.array_join(F.transform(a, lambda x: F.format_string(f"%.{digits}f", round6(x))), " ")


def quality_line(probs: Column) -> Column:
    return numbers(probs)


def label_line(a: Column, width: Column, height: Column) -> Column:
    """One line of a label file: class, then numbers by the annotation's type."""
    cls = a["cls"].cast("string")
    box = numbers(box_to_yolo(F.slice(a["data"], 1, 4), width, height))
    return (
        F.when(a["type"] == "bbox", F.concat_ws(" ", cls, box))
        .when(a["type"] == "segmentation", F.concat_ws(" ", cls, numbers(a["data"])))
        .when(a["type"] == "pose", F.concat_ws(" ", cls, box, numbers(F.slice(a["data"], 5, 1 << 30))))
    )


def shard_json(style: Column, cluster: Column, source: Column) -> Column:
    return F.to_json(F.struct(style.alias("style"), cluster.alias("cluster"), source.alias("source")))


def class_id(name: Column, taxonomy: dict[str, int]) -> Column:
    """Id of a class name (trimmed, lower-cased); an integer passes through, an unknown name is 0."""
    if not taxonomy:
        return F.coalesce(F.expr("try_cast(null as int)"), F.lit(0))
    table = F.create_map(*[F.lit(x) for kv in taxonomy.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(name.cast("string")))), F.lit(0))
