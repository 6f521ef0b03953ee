from datetime import datetime

from pyspark.sql import functions as F

from lakeloom.functions import arrays, maths, strings
from lakeloom.operators import reports
from lakeloom.sinks import shards
from lakeloom.sources import images, manifest


def test_small_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first()["x"]
    assert get(strings.thousands(F.lit(1234567))) == "1,234,567" and get(strings.kebab(F.lit("A b_C"))) == "a-b-c"
    assert get(strings.shard_name(F.lit("P"), F.lit("s"), F.lit("X"))) == "PsX.tar" and get(strings.taxonomy_key(F.lit(" Cat "))) == "cat"
    assert get(strings.dataset_name(F.lit("P"), F.lit("a_b"), F.lit(None).cast("string"), F.lit("S"))) == "PabS"
    assert get(strings.extension(F.lit("/a/b.JPG"))) == ".JPG" and get(strings.alternate_slug(F.lit("x-ava-aesthetic"))) == "ava"
    assert get(maths.xyxy_to_xywh(*map(F.lit, (1.0, 2.0, 4.0, 8.0)))) == [1.0, 2.0, 3.0, 6.0] and get(maths.to_gib(maths.from_gib(F.lit(2.0)))) == 2.0
    assert get(arrays.quality_line(maths.gaussian_bins(F.lit(5.0)))).count(" ") == 9
    boxes = get(arrays.whole_image_boxes(F.array(F.lit(3), F.lit(4))))
    assert [(b["cls"], b["data"]) for b in boxes] == [(3, [0, 0, 1, 1]), (4, [0, 0, 1, 1])]
    ring = arrays.annotation("segmentation", F.lit(1), F.array(F.lit(0.5)))
    assert get(arrays.has_kind(F.array(ring), "segmentation")) is True and get(arrays.has_kind(F.array(ring), "pose")) is False
    a = arrays.table_annotation(F.lit(2), F.array(*map(F.lit, (1.0, 1.0, 2.0, 2.0))), F.array(F.lit(1.0), F.lit(2.0)), None, F.lit(10), F.lit(10))
    assert get(a)["type"] == "segmentation"


def test_companions_and_copies(spark):
    w = spark.createDataFrame([("/a/m.safetensors",), ("/a/n.safetensors",)], "path string")
    i = spark.createDataFrame([("/a/m.webp",), ("/a/m.png",), ("/b/n.jpg",)], "path string")
    assert {r["path"]: r["image_path"] for r in images.companions(w, i).collect()} == {"/a/m.safetensors": "/a/m.png", "/a/n.safetensors": None}
    assert len(images.placeholder(4, 4)) == 48
    files = spark.createDataFrame([("images", "/i/x.jpg"), ("labels", "/l/x.txt"), ("images", "/i/y.jpg")], "kind string, path string")
    got = {r["name"]: (r["images"], r["labels"], r["targets"]) for r in shards.copy_plan(spark.createDataFrame([("x",), ("z",)], "name string"), files).collect()}
    assert got == {"x": ("/i/x.jpg", "/l/x.txt", None), "z": (None, None, None)}
    t = spark.createDataFrame([("old", datetime(2024, 1, 1)), ("new", datetime(2024, 5, 1))], "folder string, modificationTime timestamp")
    assert images.latest_folder(t).first()["folder"] == "new"


def test_needs_and_index(spark, tmp_path):
    refs = spark.createDataFrame([("diffusion_x", "o/a"), ("yolo", "o/b")], "model_key string, ref string")
    assert {r["model_key"]: r["needs_captions"] for r in manifest.model_needs(refs).collect()} == {"diffusion_x": True, "yolo": False}
    (tmp_path / "index.json").write_text('[{"name": "a", "split": "train"}, {"name": "b", "split": "val"}]')
    assert manifest.read_index(spark, str(tmp_path / "index.json")).count() == 2
    wide = spark.createDataFrame([(1, [0.1], b"x")], "id int, clip_latent array<double>, img_bytes binary")
    assert reports.index_of(wide).columns == ["id"]
