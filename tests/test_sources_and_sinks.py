import json
import struct
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeloom import plugins, session
from lakeloom.config import GIB, Config, parse_args
from lakeloom.plans import cleanup, reduce
from lakeloom.plans.compile import compile_dataset, compile_samples
from lakeloom.sinks import reports, shards
from lakeloom.sinks.registry import Registry
from lakeloom.sources import annotations, ground_truth, images, manifest
from lakeloom.streaming.incremental import new_rows, write_available


def bmp(path, w, h, pixel):
    row = b"".join(bytes(pixel(x)) for x in range(w))
    row += b"\0" * (-len(row) % 4)
    data = row * h
    path.write_bytes(b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 0, 0, 0, 0) + data)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw") / "koniq"
    d.mkdir()
    bmp(d / "good.bmp", 130, 129, lambda x: (200, x % 256, 90))
    bmp(d / "twin.bmp", 130, 129, lambda x: (200, x % 256, 90))
    bmp(d / "small.bmp", 64, 64, lambda x: (200, 200, 200))
    bmp(d / "black.bmp", 200, 200, lambda x: (0, 0, 0))
    bmp(d / "edge.bmp", 200, 200, lambda x: (0, 0, 0) if x < 180 else (255, 255, 255))
    (d / "bad.jpg").write_bytes(b"no image")
    (d / "good.txt").write_text("  a caption \n")
    return d


def test_config(tmp_path):
    f = tmp_path / "c.json"
    f.write_text(json.dumps({"train_split": 0.5, "other": 1, "name_suffix": "S"}))
    c = Config.load(str(f), {"name_suffix": "T", "seed": None})
    assert (c.train_split, c.name_suffix, c.seed) == (0.5, "T", 42) and Config.load(str(tmp_path / "none")) == Config()
    assert parse_args(["reduce", "--max-gb", "2", "--unknown", "x"])["max_size_gb"] == 2.0


def test_manifest(spark, tmp_path):
    f = tmp_path / "m.yaml"
    f.write_text("_registry_metadata: {name_prefix: P, name_suffix: Big, global_constraints: {max_size_gb: 3}}\ndatasets:\n  nima_x: {name: Nima, refs: [{ref: o/a}, {ref: 'hf://o/d:f.tgz'}]}\n  yolo_y: {refs: [{ref: o/a}]}\n  none: {refs: []}\n")
    settings, refs = manifest.read_manifest(spark, str(f))
    assert settings == {"name_prefix": "P", "name_suffix": "Big", "max_size_gb": 3}
    got = {r["model_key"]: (r["task"], r["dataset"], r["n_refs"]) for r in manifest.datasets(refs, "P", "Big").collect()}
    assert got == {"nima_x": ("quality", "PNimaBig", 2), "yolo_y": ("detection", "PyoloyBig", 1)}
    assert manifest.select_models(refs, "yolo_y").count() == 1 and manifest.read_taxonomy(spark, str(tmp_path / "none.json")) == {}


def test_ground_truth(spark, tmp_path):
    (tmp_path / "k.csv").write_text("image_name,MOS\nA.jpg,3\nB.jpg,bad\n")
    (tmp_path / "t.txt").write_text("9.0 I01.bmp\nshort\n0 i02.BMP extra\n")
    (tmp_path / "live.csv").write_text("image_name,dmos\na.jpg,130\n")
    (tmp_path / "ava.csv").write_text("image_num," + ",".join(f"vote_{i}" for i in range(1, 11)) + "\n5," + ",".join("1" * 10) + "\n")
    (tmp_path / "aadb.csv").write_text("ImageFile,score\nX.jpg,0.1\nX.jpg,0.5\n")
    merged = ground_truth.read_technical(spark, {"koniq": str(tmp_path / "k.csv"), "tid": str(tmp_path / "t.txt"), "live": str(tmp_path / "live.csv")})
    assert {r["file"]: r["score"] for r in merged.collect()} == {"a.jpg": 1.0, "i01.bmp": 10.0, "i02.bmp": 1.0}
    assert ground_truth.read_votes(spark, str(tmp_path / "ava.csv")).first()["votes"] == [1.0] * 10
    assert ground_truth.read_aadb(spark, str(tmp_path / "aadb.csv")).first()["score"] == 0.5
    (tmp_path / "base" / "f").mkdir(parents=True)
    (tmp_path / "base" / "f" / "x.csv").write_text("")
    assert ground_truth.first_existing(spark, str(tmp_path / "base"), "f", "x.csv", "root").endswith("base/f/x.csv")
    assert ground_truth.first_existing(spark, str(tmp_path), "f", "none", "root") is None


def test_annotation_sources(spark, tmp_path):
    (tmp_path / "instances_a.json").write_text(
        json.dumps(
            {
                "images": [{"id": 1, "file_name": "old.jpg", "width": 10, "height": 10}, {"id": 1, "file_name": "a.jpg", "width": 10, "height": 10}, {"id": 2, "file_name": "b.jpg", "width": 10, "height": 10}],
                "annotations": [{"image_id": 1, "category_id": 3, "bbox": [1, 1, 2, 2], "segmentation": {"counts": [1]}}, {"image_id": 1, "category_id": 4, "bbox": [0, 0, 5, 5], "segmentation": []}],
            }
        )
    )
    by = {r["file_name"]: r["annotations"] for r in annotations.coco_by_file(*annotations.read_coco(spark, str(tmp_path / "instances_a.json"))).collect()}
    assert [(a["type"], a["cls"]) for a in by["a.jpg"]] == [("bbox", 4)] and by["b.jpg"] == [] and "old.jpg" not in by
    assert annotations.guess_columns(["image", "label", "xmin", "ymin", "width", "height"]) == {"file_name": "image", "class": "label", "xmin": "xmin", "ymin": "ymin", "width": "width", "height": "height"}
    t = spark.createDataFrame([("a.jpg", "5", 1.0, 2.0, 3.0, 4.0), ("a.jpg", "x", 1.0, 2.0, 3.0, 4.0)], "image string, label string, xmin double, ymin double, width double, height double")
    assert sorted(a["cls"] for a in annotations.table_by_file(t).first()["annotations"]) == [0, 5]
    e = spark.createDataFrame([(0, None), (1, (b"x", "p")), (2, (b"y", "q"))], "k int, image struct<bytes:binary,path:string>")
    assert [(r["k"], r["idx"]) for r in annotations.embedded_images(e, ["k"]).orderBy("k").collect()] == [(1, 0), (2, 1)]
    head = json.dumps({"__metadata__": {"a": "1"}}).encode()
    (tmp_path / "m.safetensors").write_bytes(struct.pack("<Q", len(head)) + head)
    (tmp_path / "n.safetensors").write_bytes(b"junk")
    assert sorted(map(str, (r["metadata"] for r in annotations.read_safetensors(spark, str(tmp_path)).collect()))) == ["{'a': '1'}", "{}"]
    (tmp_path / "e.mat").write_bytes(b"m")
    load = lambda raw: [{"name": "z.jpg", "class": "c", "bbox": [1, 2, 3, 4]}, {"name": "broken"}]
    assert annotations.read_matlab(spark, str(tmp_path), load).first()["file_name"] == "z.jpg"


def test_images(spark, raw):
    files = images.list_images(spark, str(raw))
    assert [r["ext_rank"] for r in files.orderBy("path").select("ext_rank").collect()].count(2) == 5
    f = {r["path"].rsplit("/", 1)[1]: r for r in images.pixel_features(images.read_pixels(spark, str(raw))).collect()}
    assert set(f) == {"good.bmp", "twin.bmp", "small.bmp", "black.bmp", "edge.bmp"}
    assert f["good.bmp"]["hash"] == f["twin.bmp"]["hash"] != f["small.bmp"]["hash"] and f["black.bmp"]["dark"] == 1.0 and f["edge.bmp"]["dark"] == pytest.approx(0.9)
    captions = images.with_sidecars(files, images.read_texts(spark, str(raw)))
    assert {r["path"].rsplit("/", 1)[1]: r["caption"] for r in captions.collect()}["good.bmp"] == "a caption"
    refs = spark.createDataFrame([("nima_x", "o/koniq", 0)], "model_key string, ref string, pos int")
    pixels = images.pixel_features(images.read_pixels(spark, str(raw)))
    base = files.withColumn("slug", F.lit("koniq")).withColumnRenamed("length", "size").join(pixels, "path")
    tech = spark.createDataFrame([("good.bmp", 8.0), ("twin.bmp", 8.0), ("edge.bmp", 3.0)], "file string, score double")
    out = compile_dataset(base, refs, "nima_x", "D", technical=tech).collect()
    # The twin is a duplicate, edge has a low score, small and black are filtered by size and darkness.
    assert [(r["source"], r["score"], r["task"], r["path"].rsplit("/", 1)[1]) for r in out] == [("koniq", 8.0, "quality", "good.bmp")]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/1.txt", "hello" * 100)
        z.writestr("x/2.txt", "b")
    raw = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "b.zip").write_bytes(raw[:40] + b"\xff\xff" + raw[42:])
    (tmp_path / "c.zip").write_bytes(b"none")
    got = {r["path"][-5:]: r["problem"] for r in images.check_archives(spark, str(tmp_path)).collect()}
    assert got["a.zip"] is None and got["b.zip"] and got["c.zip"]
    members = images.archive_members(spark, str(tmp_path)).where(F.endswith("archive", F.lit("a.zip")))
    there = spark.createDataFrame([("x/1.txt", 5), ("x/2.txt", 0)], "relative string, length long")
    assert [r["member"] for r in images.extraction_plan(members, there).collect()] == ["x/2.txt"]
    listing = spark.createDataFrame([("r1", None, "SPAQ.tgz"), ("r1", None, "z.zip"), ("r2", "q.bin", "q.bin"), ("r2", "q.bin", "z.zip"), ("r3", None, "a.md"), ("r4", None, "t.parquet")], "repo string, target string, file string")
    assert sorted((r["repo"], r["file"], r["mode"]) for r in images.download_targets(listing).collect()) == [("r1", "SPAQ.tgz", "file"), ("r2", "q.bin", "file"), ("r3", "a.md", "snapshot"), ("r4", "t.parquet", "file")]


def test_registry_shards_and_reports(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "reg"))
    reg.create()
    assert reg.read().count() == 0
    rows = spark.createDataFrame(
        [(1, "p_s1_000000000", "D", "s1", "quality", "train", b"AA", "cap", 10), (2, "p_s1_000000001", "D", "s1", "quality", "val", b"BB", None, 20), (3, "p_s2_000000000", "D", "s2", "quality", "train", None, None, 30)],
        "id long, name string, dataset string, source string, task string, split string, img_bytes binary, caption string, size long",
    )
    reg.append(rows)
    reg.set_clusters(spark.createDataFrame([(1, 5), (2, 3)], "id long, cluster_id int"))
    got = reg.read()
    assert {r["id"]: r["cluster_id"] for r in got.collect()} == {1: 5, 2: 3, 3: -1} and reg.version() == 2
    reg.view("registry")
    assert [r["name"] for r in spark.sql("SELECT name FROM registry WHERE source = 's1' ORDER BY cluster_id, id").collect()] == ["p_s1_000000001", "p_s1_000000000"]
    assert spark.sql("SELECT DISTINCT source FROM registry").count() == 2
    assert spark.sql("SELECT id, clip_latent FROM registry WHERE clip_latent IS NOT NULL").count() == 0
    plan = spark.sql("SELECT id FROM registry WHERE source = 's1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    shards.write_shards(got, str(tmp_path / "out"), "P", "X")
    tars = sorted((tmp_path / "out").iterdir())
    assert all(t.name.startswith("Ps1X-") and t.suffix == ".tar" for t in tars)
    assert [m.name for t in tars for m in tarfile.open(t)][::3] == ["p_s1_000000001.jpg", "p_s1_000000000.jpg"]
    shards.write_labels(rows.select("name", "split", F.array(F.lit("1 2")).alias("label_lines")), str(tmp_path / "labels"))
    assert (tmp_path / "labels" / "train" / "p_s1_000000000.txt").read_text() == "1 2\n"
    texts = reports.description_files(got, "D")
    assert texts["category.txt"] == "Image Quality Assessment" and "total: 3" in texts["dataset_info.yaml"] and reports.description_files(got.where("false"), "D") == {}
    assert "| S1 | 2 |" in reports.report(got, "D")
    small = reduce.reduce_dataset(got, 100 / GIB, "Small", Config(name_suffix="D", train_split=0.5))
    assert {r["dataset"] for r in small.collect()} == {"Small"}
    good, bad = reports.quarantine(spark.createDataFrame([(1, None), (2, "x")], "id int, problem string"))
    assert good.count() == 1 and bad.first()["problem"] == "x"


def test_compile_is_idempotent(spark):
    s = spark.createDataFrame([(i, f"n{i}", "s", 10, f"h{i % 4}") for i in range(6)], "k long, name string, source string, size long, hash string")
    truth = spark.createDataFrame([(i, 5.0) for i in range(6)], "k long, score double")
    first = compile_samples(s, truth, "k", ["source", "k"], 1000)
    assert sorted(r["k"] for r in first.collect()) == [0, 1, 2, 3]
    assert compile_samples(s, truth, "k", ["source", "k"], 1000, registry=first).count() == 0


def test_gate_comes_before_dedup(spark):
    # The first copy has no score; the second one passes and stays.
    s = spark.createDataFrame([(0, "s", "h", 10), (1, "s", "h", 10), (2, "s", "h", 10)], "k long, source string, hash string, size long")
    truth = spark.createDataFrame([(1, 8.0), (2, 9.0)], "k long, score double")
    assert [r["k"] for r in compile_samples(s, truth, "k", ["source", "k"], 1000).collect()] == [1]
    bare = spark.createDataFrame([(0, 1.0), (1, 8.0)], "k long, score double")
    assert [r["k"] for r in compile_samples(s, bare, "k", ["source", "k"], 1000, Config(vetting="pass_through")).collect()] == [1]


def test_numbers_run_over_the_listing_and_legacy_names_count(spark):
    rows = [("koniq", f"/raw/koniq/{i}.jpg", 0, 10, f"h{i}", 200, 200, 0.95 if i == 0 else 0.0) for i in range(4)] + [("koniq", "/raw/koniq/9.jpg", 0, 10, "h9", None, None, None)]
    images_ = spark.createDataFrame(rows, "slug string, path string, ext_rank int, size long, hash string, width int, height int, dark double")
    refs = spark.createDataFrame([("nima_x", "o/koniq", 0)], "model_key string, ref string, pos int")
    tech = spark.createDataFrame([(f"{i}.jpg", 8.0) for i in range(10)], "file string, score double")
    names = lambda config, registry=None: sorted(r["name"] for r in compile_dataset(images_, refs, "nima_x", "D", config, registry, technical=tech).collect())
    assert names(Config()) == [f"loom_koniq_{i:09d}" for i in (1, 2, 3)]
    # A threshold changes which samples stay, never their names.
    assert names(Config(black_threshold=0.0)) == [f"loom_koniq_{i:09d}" for i in (0, 1, 2, 3)]
    done = spark.createDataFrame([("loom_000000002", "x", 5), ("loom_koniq_000000001", "y", 5)], "name string, hash string, size long")
    assert names(Config(), done) == ["loom_koniq_000000003"]


def test_compile_scores_what_lacks_ground_truth(spark):
    plugins.register("coder", "twice", lambda: lambda xs: [x + x for x in xs])
    plugins.register("scorer", "nine", lambda: lambda xs: [(9.0, [1.0]) for _ in xs])
    rows = [("koniq", f"/raw/koniq/{i}.jpg", 0, 10, f"h{i}", 200, 200, 0.0, b"x") for i in range(3)]
    images_ = spark.createDataFrame(rows, "slug string, path string, ext_rank int, size long, hash string, width int, height int, dark double, content binary")
    refs = spark.createDataFrame([("nima_x", "o/koniq", 0)], "model_key string, ref string, pos int")
    tech = spark.createDataFrame([("0.jpg", 8.0), ("1.jpg", 2.0)], "file string, score double")
    got = compile_dataset(images_, refs, "nima_x", "D", Config(), models={"scorer": "nine", "coder": "twice"}, technical=tech).collect()
    assert sorted((r["file"], r["score"], bytes(r["content"])) for r in got) == [("0.jpg", 8.0, b"xx"), ("2.jpg", 9.0, b"xx")]


def test_command_line_compiles_and_exports(spark, raw, tmp_path):
    from lakeloom import cli

    (tmp_path / "m.yaml").write_text("_registry_metadata: {name_prefix: P}\ndatasets:\n  nima_x: {name: Set, refs: [{ref: o/koniq}]}\n")
    (tmp_path / "koniq.csv").write_text("image_name,MOS\ngood.bmp,5\nedge.bmp,1\n")
    (tmp_path / "c.json").write_text(json.dumps({"ground_truth": {"koniq": str(tmp_path / "koniq.csv")}, "black_threshold": 0.0}))
    args = ["--manifest", str(tmp_path / "m.yaml"), "--config", str(tmp_path / "c.json"), "--raw", str(raw), "--out", str(tmp_path / "reg")]
    assert cli.main(["compile", *args, "--export", str(tmp_path / "export")]) == 0
    rows = Registry(spark, str(tmp_path / "reg")).read().collect()
    assert [(r["source"], r["score"]) for r in rows] == [("koniq", 10.0)]
    (out,) = (tmp_path / "export").iterdir()
    assert (out / "report.md").read_text().startswith(f"# {out.name}") and (out / "labels").is_dir() and (out / "index").is_dir()


def test_intermediates_need_a_shared_folder(spark):
    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Cluster.conf)})

    with pytest.raises(ValueError):
        session.scratch_dir(Cluster)
    Cluster.sparkContext.master = "local[2]"
    assert "lakeloom" in session.scratch_dir(Cluster)
    session._LEFT.popitem()


def test_acquisition_plan_and_render(spark):
    refs = spark.createDataFrame([("m", "hf://o/d:f.tgz", 0), ("m", "o/a", 1), ("n", "o/a", 2)], "model_key string, ref string, pos int")
    listing = spark.createDataFrame([("zz", 1, False)], "slug string, file_count long, has_zip boolean")
    got = sorted((r["ref"], r["repo"], r["file"], r["folder"]) for r in cleanup.acquisition_plan(refs, listing).collect())
    assert got == [("hf://o/d:f.tgz", "o/d", "f.tgz", "f"), ("o/a", "o/a", None, "a")]
    plan = cleanup.cleanup_plan(spark.createDataFrame([("zz",)], "slug string"), refs, spark.createDataFrame([], "model_key string, index_count long"))
    assert cleanup.render(plan) == ["  - zz" + " " * 38 + " | Orphaned (Not in manifest)"]


def test_plugins(spark):
    plugins.register("scorer", "len", lambda: lambda xs: [(float(len(x)), [1.0]) for x in xs])
    plugins.register("captioner", "up", lambda: lambda xs: [x.upper() for x in xs])
    df = spark.createDataFrame([("abc", None, None), ("z", 9.0, [0.5])], "x string, score double, probs array<double>")
    with pytest.raises(ValueError):
        plugins.register("other", "x", lambda: None)
    assert plugins.caption(spark.createDataFrame([("q", "has"), ("w", None)], "x string, caption string"), None, "x").orderBy("x").collect()[1]["caption"] == "an image"
    plan = plugins.score_missing(df, "len", "x")
    assert plan.columns == ["x", "score", "probs"]


def test_stream_resumes(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    spark.createDataFrame([("a",), ("a",), ("b",)], "h string").coalesce(1).write.parquet(src)
    write_available(new_rows(spark, src, "h", "h"), out, ckpt)
    assert sorted(r["h"] for r in spark.read.parquet(out).collect()) == ["a", "b"]
    spark.createDataFrame([("b",), ("c",)], "h string").coalesce(1).write.mode("append").parquet(src)
    write_available(new_rows(spark, src, "h", "h"), out, ckpt)
    assert sorted(r["h"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
