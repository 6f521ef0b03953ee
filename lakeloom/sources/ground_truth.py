"""Score tables of seven formats, each as ``file, score, row_no`` (votes as ``image_num, votes``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import maths
from lakeloom.operators.labels import last_wins


def first_existing(spark: SparkSession, base: str, folder: str, relative: str, root: str) -> str | None:
    """The first path that exists of base/root/folder/rel, base/folder/rel and base/folder/folder/rel."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in (f"{base}/{root}/{folder}/{relative}", f"{base}/{folder}/{relative}", f"{base}/{folder}/{folder}/{relative}"):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return path
    return None


#: Place of a line: file, split, and position in it. Lines of one split keep their order in a partition, while the
#: partitions' own order follows how splits are packed.
_PLACE = ("_metadata.file_path", "_metadata.file_block_start")


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("row_no", F.struct(F.col(_PLACE[0]).alias("path"), F.col(_PLACE[1]).alias("split"), F.monotonically_increasing_id().alias("line")))


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns by name; rows numbered by path and place in their file."""
    df = _numbered(spark.read.option("header", True).option("enforceSchema", False).csv(path))
    wanted = [x.rsplit(" ", 1) for x in schema.split(", ")]
    return df.select(*[F.expr(f"try_cast(`{n.strip('`')}` as {t})").alias(n.strip("`")) for n, t in wanted], "row_no")


def _scores(df: DataFrame, file: Column, score: Column) -> DataFrame:
    return df.select(file.alias("file"), score.alias("score"), "row_no").where("file is not null and score is not null")


def read_votes(spark: SparkSession, path: str) -> DataFrame:
    df = _csv(spark, path, "image_num bigint, " + ", ".join(f"vote_{i} double" for i in range(1, 11)))
    return df.groupBy("image_num").agg(F.max_by(F.array(*[f"vote_{i}" for i in range(1, 11)]), "row_no").alias("votes")).where("image_num is not null")


def read_aadb(spark: SparkSession, path: str) -> DataFrame:
    """The last of repeated file names wins; names stay as written."""
    df = _scores(_csv(spark, path, "ImageFile string, score double"), F.col("ImageFile"), F.col("score"))
    return df.groupBy("file").agg(F.max_by("score", "row_no").alias("score"))


def read_koniq(spark: SparkSession, path: str) -> DataFrame:
    return _scores(_csv(spark, path, "image_name string, MOS double"), F.lower("image_name"), maths.from_five(F.col("MOS")))


def read_spaq(spark: SparkSession, path: str) -> DataFrame:
    return _scores(_csv(spark, path, "`Image name` string, MOS double"), F.lower(F.col("Image name")), maths.from_hundred(F.col("MOS")))


def read_tid(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a score and a file name; shorter lines are skipped."""
    t = _numbered(spark.read.text(path)).select(F.split(F.trim("value"), r"\s+").alias("t"), "row_no").where("size(t) >= 2")
    return _scores(t, F.lower(F.col("t")[1]), maths.from_nine(F.expr("try_cast(t[0] as double)")))


def read_live(spark: SparkSession, path: str) -> DataFrame:
    return _scores(_csv(spark, path, "image_name string, dmos double"), F.lower("image_name"), maths.from_impairment(F.col("dmos")))


def read_csiq(spark: SparkSession, path: str) -> DataFrame:
    return _scores(_csv(spark, path, "image_name string, dmos double"), F.lower("image_name"), maths.from_unit_impairment(F.col("dmos")))


TECHNICAL = {"koniq": read_koniq, "spaq": read_spaq, "tid": read_tid, "live": read_live, "csiq": read_csiq}


def read_technical(spark: SparkSession, paths: dict[str, str]) -> DataFrame | None:
    """The given technical tables merged in the order of ``TECHNICAL``, later ones winning; None without any."""
    found = [read(spark, paths[k]) for k, read in TECHNICAL.items() if paths.get(k)]
    return last_wins(found) if found else None


def read_all(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The tables that paths name by format, as :func:`lakeloom.operators.labels.attach_scores` takes them."""
    found = {"votes": read_votes(spark, paths["ava"]) if paths.get("ava") else None, "aadb": read_aadb(spark, paths["aadb"]) if paths.get("aadb") else None}
    found["technical"] = read_technical(spark, paths)
    return {k: v for k, v in found.items() if v is not None}
