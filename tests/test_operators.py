import random

from pyspark.sql import functions as F

from lakeloom.operators import labels, latents, ordering, purge, sampling


def test_running_total_matches_one_pass(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, rng.randint(0, 9)) for i in range(500)] + [(None, 900, 5), (None, 901, None)]
    got = ordering.running_total(spark.createDataFrame(rows, "g string, k long, v long"), "v", ["k"], ["g"]).collect()
    sums, want = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + (v or 0)
        want[k] = sums[g]
    assert {r["k"]: r["running"] for r in got} == want


def test_budget_is_smallest_prefix_that_reaches_the_cap(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([5, 0, 7, 3, 9])], "k long, s long")
    kept = lambda cap, used=0: sorted(r["k"] for r in sampling.byte_budget(df, "s", ["k"], cap, used=used).collect())
    assert kept(0) == [] and kept(5) == [0] and kept(6) == [0, 1, 2] and kept(12) == [0, 1, 2] and kept(100) == [0, 1, 2, 3, 4] and kept(12, used=7) == [0]


def test_budget_plan_has_no_single_partition_window(spark):
    plan = sampling.byte_budget(spark.range(10).withColumn("s", F.lit(1)), "s", ["id"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan


def test_round_robin_takes_turns(spark):
    rows = [("a", i) for i in range(9)] + [("b", 100 + i) for i in range(3)] + [("c", 200)]
    got = sampling.round_robin(spark.createDataFrame(rows, "s string, k long"), "s", "k").collect()
    for s, n in (("a", 9), ("b", 3), ("c", 1)):
        assert sorted(r["turn"] for r in got if r["s"] == s) == list(range(1, n + 1))


def test_keep_first(spark):
    df = spark.createDataFrame([(1, "x"), (0, "x"), (2, None), (3, None), (4, "y")], "k long, h string")
    assert sorted(r["k"] for r in sampling.keep_first(df, "h", ["k"]).collect()) == [0, 2, 3, 4]
    known = spark.createDataFrame([("y",)], "hash string")
    assert sorted(r["k"] for r in sampling.new_digests(df.withColumnRenamed("h", "hash"), known).collect()) == [0, 1, 2, 3]


def test_resume(spark):
    df = spark.createDataFrame([("a", "old_a"), ("b", "old_b"), (None, "old_c")], "name string, legacy string")
    reg = spark.createDataFrame([("a",), ("old_b",)], "name string")
    assert [r["legacy"] for r in sampling.unregistered(df, reg, ("name", "legacy")).collect()] == ["old_c"]


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(4000).select(sampling.split_of(F.col("id").cast("string")).alias("s"))
    n = df.where("s = 'train'").count()
    assert n == df.where("s = 'train'").count() and 3100 < n < 3300


def test_last_wins(spark):
    a = spark.createDataFrame([("F.jpg", 1.0, 0), ("F.jpg", 2.0, 1), ("g", 5.0, 2)], "file string, score double, row_no long")
    b = spark.createDataFrame([("f.JPG", 9.0, 0)], "file string, score double, row_no long")
    assert {r["file"]: r["score"] for r in labels.last_wins([a, b]).collect()} == {"f.jpg": 9.0, "g": 5.0}


def test_precedence_goes_by_slug(spark):
    s = spark.createDataFrame(
        [("ava-x", "7.jpg", "7"), ("ava-x", "bad.jpg", "bad"), ("aadb", "A.jpg", "A"), ("laion", "l.jpg", "l"), ("koniq", "Bad.jpg", "Bad")], "slug string, file string, stem string"
    )
    votes = spark.createDataFrame([(7, [0.0] * 9 + [2.0])], "image_num long, votes array<double>")
    aadb = spark.createDataFrame([("A.jpg", 0.5), ("a.jpg", 0.0)], "file string, score double")
    tech = spark.createDataFrame([("bad.jpg", 8.0)], "file string, score double")
    got = [(r["slug"], r["score"], r["gt_found"]) for r in labels.attach_scores(s, "slug", "file", "stem", votes, aadb, tech).orderBy("slug", "file").collect()]
    # An ava sample without votes does not fall through to the technical table.
    assert got == [("aadb", 5.5, True), ("ava-x", 10.0, True), ("ava-x", None, False), ("koniq", 8.0, True), ("laion", 6.5, True)]


def test_gate(spark):
    df = spark.createDataFrame([("a", 4.0), ("b", 3.99), ("c", None), ("laion-x", None)], "slug string, score double")
    names = lambda **k: [r["slug"] for r in labels.gate(df, "slug", **k).orderBy("slug").collect()]
    assert names() == ["a"] and names(vetting="pass_through") == ["a", "c", "laion-x"] and names(strict=True, vetting="pass_through") == ["a", "laion-x"]


def test_pixel_filters(spark):
    df = spark.createDataFrame([(128, 128, 0.9), (127, 500, 0.0), (200, 200, 0.9001)], "w int, h int, d double")
    assert df.where(labels.pixel_filters(F.col("w"), F.col("h"), F.col("d"))).count() == 1


def test_purge_truth_table(spark):
    raw = spark.createDataFrame([("set1",), ("set10",), ("orphan",), ("koniq10k",), (None,)], "slug string")
    refs = spark.createDataFrame([("m1", "o/set10"), ("m2", "o/set1-x"), ("m3", "o/koniq-10k-dataset")], "model_key string, ref string")
    done = spark.createDataFrame([("m1", 5), ("m2", 0), ("m3", 1)], "model_key string, index_count long")
    got = {r["slug"]: (r["decision"], r["reason"]) for r in purge.purge_plan(raw, refs, done).collect()}
    assert got == {
        "set10": ("purge", "Compiled for: m1"),
        "set1": ("keep", "Needed by: m2"),
        "orphan": ("purge", "Orphaned (Not in manifest)"),
        "koniq10k": ("purge", "Compiled for: m3"),
    }


def test_status(spark):
    refs = spark.createDataFrame([("o/a", 0), ("o/b", 1), ("hf://o/c", 2), ("o/d:f.tgz", 3), ("o/gone", 4)], "ref string, pos int")
    listing = spark.createDataFrame([("a", 3, False), ("b", 3, True), ("c", 1, True), ("f", 0, False)], "slug string, file_count long, has_zip boolean")
    st = purge.source_status(refs, listing)
    assert {r["ref"]: r["status"] for r in st.collect()} == {"o/a": "Extracted", "o/b": "ZipOnly", "hf://o/c": "Extracted", "o/d:f.tgz": "Missing", "o/gone": "Missing"}
    assert sorted(r["ref"] for r in purge.missing_refs(st).collect()) == ["o/b", "o/d:f.tgz", "o/gone"]


def test_clusters(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [])], "id long, v array<double>")
    got = {r["id"]: r["cluster_id"] for r in latents.style_clusters(df, "v", 16).collect()}
    assert got[2] == got[3] == -1 and sorted((got[0], got[1])) == [0, 1]
    proto = spark.createDataFrame([("b", [1.0, 0.1]), ("a", [0.0, 2.0]), ("c", [0.0, 0.0])], "tag string, prototype array<double>")
    assert [r["style_tag"] for r in latents.zero_shot(df.where("id < 3"), "v", proto).orderBy("id").collect()] == ["b", "a", None]
