"""Annotation sources: format discovery, COCO JSON, tables with guessed columns, MATLAB, safetensors headers."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from lakeloom.functions.arrays import coco_annotation, table_annotation
from lakeloom.functions.strings import file_name


def discover_format(listing: DataFrame, folder: str = "folder", path: str = "path") -> DataFrame:
    """``folder, format, path`` of the annotation file that counts: COCO JSON (its name says so) before Parquet before
    MATLAB before safetensors, then the smallest path. Folders without any give no row."""
    name = file_name(F.col(path))
    fmt = (
        F.when(F.endswith(name, F.lit(".json")), F.when(F.contains(name, F.lit("coco")) | F.contains(name, F.lit("instances")), "coco"))
        .when(F.endswith(name, F.lit(".parquet")), "parquet")
        .when(F.endswith(name, F.lit(".mat")), "matlab")
        .when(F.endswith(name, F.lit(".safetensors")), "safetensors")
    )
    rank = F.when(fmt == "coco", 0).when(fmt == "parquet", 1).when(fmt == "matlab", 2).otherwise(3)
    found = listing.select(F.col(folder).alias("folder"), F.struct(rank.alias("rank"), F.col(path).alias("path"), fmt.alias("format")).alias("f")).where("f.format is not null")
    return found.groupBy("folder").agg(F.min("f").alias("f")).select("folder", F.col("f.format").alias("format"), F.col("f.path").alias("path"))


_COCO = (
    "images array<struct<id:long,file_name:string,width:double,height:double>>, "
    "annotations array<struct<image_id:long,category_id:int,bbox:array<double>,segmentation:string,keypoints:array<double>>>"
)


def read_coco(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """Images (the last of an id wins) and annotations of COCO files; segmentation stays JSON (list or object)."""
    doc = spark.read.schema(_COCO).json(list(paths), multiLine=True)
    images = doc.select(F.posexplode("images").alias("pos", "i")).select("pos", "i.*")
    images = images.groupBy("id").agg(F.max_by(F.struct("file_name", "width", "height"), "pos").alias("i")).select("id", "i.*")
    return images, doc.select(F.explode("annotations").alias("a")).select("a.*")


def coco_by_file(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """``file_name`` with its annotations; files without any have an empty list."""
    joined = annotations.join(images, annotations["image_id"] == images["id"])
    a = coco_annotation(F.col("category_id"), F.col("bbox"), F.col("segmentation"), F.col("keypoints"), F.col("width"), F.col("height"))
    grouped = joined.groupBy("file_name").agg(F.collect_list(a).alias("annotations"))
    empty = F.array().cast("array<struct<type:string,cls:int,data:array<double>>>")
    return images.select("file_name").distinct().join(grouped, "file_name", "left").withColumn("annotations", F.coalesce("annotations", empty))


def guess_columns(columns: list[str]) -> dict[str, str]:
    """Roles of a table's columns: exact names first, then the last column whose lower-cased name holds a mark."""
    out = {}
    if "image" in columns:
        out["file_name"] = "image"
    if "label" in columns:
        out["class"] = "label"
    for role, exact, marks in (
        ("xmin", ("xmin", "x1"), ("xmin", "x1")),
        ("ymin", ("ymin", "y1"), ("ymin", "y1")),
        ("width", ("width", "w"), ("width", "w")),
        ("height", ("height", "h"), ("height", "h")),
        ("segmentation", ("segmentation",), ()),
        ("keypoints", ("keypoints",), ()),
    ):
        same = [c for c in columns if c.lower() in exact]
        like = [c for c in columns if any(m in c.lower() for m in marks) and c not in out.values()]
        if same or like:
            out[role] = (same or like)[-1]
    return out


def read_tables(spark: SparkSession, *paths: str) -> DataFrame:
    """All shards under the paths; unreadable ones are skipped."""
    return spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(*paths)


def table_by_file(table: DataFrame, width: str = "image_width", height: str = "image_height", class_column: Callable | None = None) -> DataFrame:
    """``file_name`` with the annotations of its rows; a row without the columns of a box has none."""
    roles = guess_columns(table.columns)
    if "file_name" not in roles:
        raise ValueError("the table has no column that names a file")
    col = lambda r: F.col(roles[r]) if r in roles else None
    box = [col(r) for r in ("xmin", "ymin", "width", "height")]
    bbox = F.array(*[b.cast("double") for b in box]) if all(b is not None for b in box) else F.lit(None).cast("array<double>")
    cls = (class_column or (lambda c: F.coalesce(F.expr(f"try_cast(`{roles['class']}` as int)"), F.lit(0))))(col("class")) if "class" in roles else F.lit(0)
    w = F.col(width) if width in table.columns else F.lit(None).cast("double")
    h = F.col(height) if height in table.columns else F.lit(None).cast("double")
    a = table_annotation(cls, bbox, col("segmentation"), col("keypoints"), w, h)
    return table.groupBy(col("file_name").alias("file_name")).agg(F.collect_list(a).alias("annotations"))


def embedded_images(table: DataFrame, order: list[str]) -> DataFrame:
    """Rows of a table that holds images (bytes, or a struct of bytes) as samples: ``content`` and the row's number.

    A row without an image uses no number.
    """
    from lakeloom.operators.sampling import with_index

    content = F.col("image.bytes") if "struct" in dict(table.dtypes)["image"] else F.col("image")
    rows = table.where(F.col("image").isNotNull()).withColumn("content", content).where("content is not null")
    return with_index(rows, [], order)


@pandas_udf(T.MapType(T.StringType(), T.StringType()))
def safetensors_metadata(head: pd.Series) -> pd.Series:
    """``__metadata__`` of a safetensors file from its first bytes; empty where they are no such header."""
    out = []
    for raw in head:
        try:
            (n,) = struct.unpack("<Q", raw[:8])
            meta = json.loads(raw[8 : 8 + n]).get("__metadata__", {})
            out.append({str(k): v if isinstance(v, str) else json.dumps(v) for k, v in meta.items()})
        except (struct.error, ValueError, TypeError, AttributeError):
            out.append({})
    return pd.Series(out)


def read_safetensors(spark: SparkSession, path: str) -> DataFrame:
    """``path, metadata`` of the safetensors files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.safetensors").load(path)
    return files.select("path", safetensors_metadata("content").alias("metadata"))


def read_matlab(spark: SparkSession, path: str, load: Callable[[bytes], list[dict]] | None = None) -> DataFrame:
    """``path, file_name, class, bbox`` of MATLAB annotation files.

    ``load`` turns a file's bytes into entries (``image_name`` or ``name``, ``class``, ``bbox``); without it SciPy's
    reader is used where it is installed. An entry that can't be read is left out.
    """

    def run(frames: Iterator) -> Iterator:
        reader = load or _scipy_entries
        for frame in frames:
            rows = []
            for where, raw in zip(frame["path"], frame["content"]):
                for e in reader(raw):
                    try:
                        rows.append((where, str(e.get("image_name") or e["name"]), str(e["class"]), [float(x) for x in e["bbox"]]))
                    except (KeyError, TypeError, ValueError):
                        continue
            yield pd.DataFrame(rows, columns=["path", "file_name", "class", "bbox"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.mat").load(path).select("path", "content")
    return files.mapInPandas(run, "path string, file_name string, class string, bbox array<double>")


def _scipy_entries(raw: bytes) -> list[dict]:
    import io

    from scipy.io import loadmat

    data = loadmat(io.BytesIO(raw), simplify_cells=True)
    value = next((v for k, v in data.items() if not k.startswith("__")), [])
    return [x for x in (value if isinstance(value, (list, tuple)) or hasattr(value, "tolist") else [value]) if isinstance(x, dict)]
