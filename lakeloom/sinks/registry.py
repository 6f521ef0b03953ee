"""Registry: a versioned Parquet table, partitioned by dataset and source.

Plain Parquet has no update, so a change writes a new version folder and then moves the pointer file; readers of an older
version are not disturbed, and a lost job leaves the pointer where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "id long, name string, dataset string, source string, task string, split string, hash string, score double, caption string, style_tag string, "
    "clip_latent array<float>, img_bytes binary, cluster_id int, size long, probs array<double>, label_lines array<string>, "
    "has_segmentation boolean, has_pose boolean, is_autolabeled boolean"
)


class Registry:
    """``path`` holds ``v=<n>`` folders and the file ``CURRENT`` with the number in force."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def version(self) -> int:
        """Number in force, 0 before the first write."""
        fs, p = self._fs(f"{self.path}/CURRENT")
        return int(self.spark.read.text(f"{self.path}/CURRENT").first()["value"]) if fs.exists(p) else 0

    def create(self) -> None:
        """Makes an empty first version if there is none."""
        if not self.version():
            self._write(self.spark.createDataFrame([], SCHEMA), 1)

    def read(self) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/v={v}") if v else self.spark.createDataFrame([], SCHEMA)

    def view(self, name: str = "registry") -> None:
        """The version in force as a temporary view, for SQL."""
        self.read().createOrReplaceTempView(name)

    def append(self, rows: DataFrame) -> int:
        """Adds rows (missing columns become null) to the version in force; one job commit. Returns the version."""
        self.create()
        self._balanced(self._fit(rows)).write.mode("append").partitionBy("dataset", "source").parquet(f"{self.path}/v={self.version()}")
        return self.version()

    def replace(self, rows: DataFrame) -> int:
        """Writes a new version and moves the pointer to it."""
        v = self.version() + 1
        self._write(self._fit(rows), v)
        return v

    def set_clusters(self, clusters: DataFrame) -> int:
        """New version with ``cluster_id`` by ``id``; rows without an entry keep theirs."""
        new = clusters.select("id", F.col("cluster_id").cast("int").alias("_new"))
        return self.replace(self.read().join(new, "id", "left").withColumn("cluster_id", F.coalesce("_new", "cluster_id")).drop("_new"))

    @staticmethod
    def _balanced(rows: DataFrame) -> DataFrame:
        """Rows of a partition together, so that it gets few files; a large source is split over several tasks."""
        return rows.hint("rebalance", "dataset", "source")

    def _fit(self, rows: DataFrame) -> DataFrame:
        fields = self.spark.createDataFrame([], SCHEMA).schema.fields
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(-1 if f.name == "cluster_id" else None)).cast(f.dataType).alias(f.name) for f in fields])

    def _write(self, rows: DataFrame, v: int) -> None:
        self._balanced(rows).write.mode("overwrite").partitionBy("dataset", "source").parquet(f"{self.path}/v={v}")
        if not rows.take(1):
            fs, p = self._fs(f"{self.path}/v={v}")
            fs.mkdirs(p)
        fs, p = self._fs(f"{self.path}/CURRENT")
        out = fs.create(p, True)
        try:
            out.write(bytearray(str(v).encode()))
        finally:
            out.close()
