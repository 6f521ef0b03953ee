"""Session settings and shared-folder intermediates."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lakeloom", **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ``conf`` entries (dots as in Spark) go on top."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


#: Intermediates that are still there; they are removed at the end of the process.
_LEFT: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which all nodes share; a local one only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|\Z)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/lakeloom-checkpoints"
    path = f"{base.rstrip('/')}/lakeloom-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Writes the frame once to the shared folder and reads it back, so that a recomputation can't change it."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_left() -> None:
    for path, spark in _LEFT.items():
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        except Exception:  # The JVM may be gone already; then the folder's owner cleans it.
            return
