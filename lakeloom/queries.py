"""Queries over the driver's tables, one or more for each operator, and the SQL that must agree with them.

Tables stand in for the engine's own inputs: ``documents`` are samples (``n_chars`` their size, ``md5(text)`` their
content hash), ``labels`` ground truth, ``embeddings`` latents, ``pages.url`` references, ``events.props`` JSON
metadata, ``lineitem`` box coordinates, ``conversations`` annotations of an image, ``part`` class names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import arrays, maths, strings
from lakeloom.operators import labels, latents, purge, reports, sampling
from lakeloom.streaming.incremental import stream_registry

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def floats(column: str, n: int) -> Column:
    return F.transform(F.slice(column, 1, n), lambda x: x.cast("double"))


_NAME = "printf('loom_%s_%09d', source, doc_id)"
_HASH = "('0x' || substr(md5({k}), 1, 8))::BIGINT % 10000"
_SPLIT = f"CASE WHEN {_HASH.format(k='{k}')} < 8000 THEN 'train' ELSE 'val' END"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as samples: key, name, split, size and content hash. The hash is the only use of the text."""
    d = table(spark, sf_dir, "documents")
    key = F.concat_ws("_", "source", "doc_id")
    return d.select(
        "doc_id",
        "source",
        F.col("n_chars").alias("size"),
        key.alias("key"),
        strings.sample_name(F.lit("loom"), F.col("source"), F.col("doc_id")).alias("name"),
        sampling.split_of(key).alias("split"),
        F.md5("text").alias("hash"),
    )


_SAMPLES = f"SELECT doc_id, source, n_chars AS size, concat_ws('_', source, doc_id) AS key, {_NAME} AS name, {_SPLIT.format(k=chr(99) + 'oncat_ws(' + repr('_') + ', source, doc_id)')} AS split, md5(text) AS hash FROM documents"


@query(f"SELECT doc_id, {_NAME} AS name, source AS middle, source AS second FROM documents")
def sample_names(spark, sf_dir):
    s = samples(spark, sf_dir)
    return s.select("doc_id", "name", strings.name_source(F.col("name"), F.lit("none")).alias("middle"), strings.name_second_part(F.col("name")).alias("second"))


@query(f"SELECT doc_id, split FROM ({_SAMPLES})")
def hash_split(spark, sf_dir):
    return samples(spark, sf_dir).select("doc_id", "split")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS hash FROM documents GROUP BY md5(text)")
def dedup_keep_first(spark, sf_dir):
    return sampling.keep_first(samples(spark, sf_dir).select("doc_id", "hash"), "hash", ["doc_id"])


@query(
    f"SELECT split, source, doc_id, size, turn FROM (SELECT *, sum(size) OVER (PARTITION BY split ORDER BY turn, source, doc_id ROWS UNBOUNDED PRECEDING) - size AS before FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY split, source ORDER BY md5(doc_id::VARCHAR), doc_id) AS turn FROM ({_SAMPLES}))) "
    "WHERE before < CASE WHEN split = 'train' THEN 0.0005 * 1073741824 * 0.8 ELSE 0.0005 * 1073741824 * 0.2 END"
)
def round_robin_budget(spark, sf_dir):
    s = samples(spark, sf_dir).select("split", "source", "doc_id", "size")
    drawn = sampling.round_robin(s, "source", "doc_id", ["split"])
    cap = F.when(F.col("split") == "train", F.lit(0.0005 * maths.GIB * 0.8)).otherwise(F.lit(0.0005 * maths.GIB * 0.2))
    return sampling.byte_budget(drawn, "size", ["turn", "source", "doc_id"], cap, ["split"])


@query(
    "SELECT doc_id, size FROM (SELECT doc_id, n_chars AS size, sum(n_chars) OVER (ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING) - n_chars AS before FROM documents) WHERE before < 1000000"
)
def byte_budget(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("n_chars").alias("size"))
    return sampling.byte_budget(d, "size", ["source", "doc_id"], 1_000_000).select("doc_id", "size")


@query(
    "SELECT sum(n_chars)::BIGINT AS bytes, floor(sum(n_chars) / 1073741824.0 * 1e6 + 0.5) / 1e6 AS gib, sum(n_chars) / 1073741824.0 >= 0.001 AS reaches_minimum FROM documents"
)
def compiled_size(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    checked = sampling.checked_size(d, "n_chars", 0.001)
    return checked.select(F.round(F.col("total_gb") * maths.GIB).cast("long").alias("bytes"), maths.round6(F.col("total_gb")).alias("gib"), "reaches_minimum")


@query(
    "SELECT d.doc_id, floor((1 + (5 * coalesce(l.quality, 0)) * 0.9 + d.n_chars % 9 * 0.5) * 1e6 + 0.5) / 1e6 AS score FROM documents d JOIN labels l USING (doc_id) "
    "WHERE 1 + (5 * coalesce(l.quality, 0)) * 0.9 + d.n_chars % 9 * 0.5 >= 4.0"
)
def quality_gate(spark, sf_dir):
    d, truth = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = d.join(truth, "doc_id").withColumn("score", 1 + 5 * F.coalesce("quality", F.lit(0)) * 0.9 + F.col("n_chars") % 9 * 0.5)
    return labels.gate(scored, "source").select("doc_id", maths.round6(F.col("score")).alias("score"))


_TECH = "SELECT printf('img_%d.jpg', doc_id) AS file, {v} AS score, {t} AS t, doc_id AS r FROM labels WHERE doc_id % {m} = 0"


@query(
    "WITH tech AS (SELECT file, arg_max(score, r * 10 + t * 1000000000) AS score FROM ("
    + " UNION ALL ".join(
        [_TECH.format(v="1 + (1 + quality * 4.0 - 1) * 2.25", t=0, m=2), _TECH.format(v="1 + toxic * 50 * 0.09", t=1, m=3), _TECH.format(v="1 + (1 - quality * 0.5) * 9", t=2, m=5)]
    )
    + ") GROUP BY file), s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ava-x' WHEN 1 THEN 'aadb' WHEN 2 THEN 'laion-5b' ELSE 'koniq' END AS slug, n_chars FROM documents), "
    "a AS (SELECT doc_id, quality * 0.5 + 0.25 AS score FROM labels WHERE doc_id % 3 > 0), "
    "v AS (SELECT doc_id, (1 * (1 + quality) + 5 * 2 + 10 * 3 * toxic) / (1 + quality + 2 + 3 * toxic)::DOUBLE AS score FROM labels), "
    "j AS (SELECT s.doc_id, CASE WHEN slug LIKE '%ava%' THEN v.score WHEN slug = 'aadb' THEN a.score * 9 + 1 WHEN slug LIKE 'laion%' THEN coalesce(CASE WHEN n_chars % 2 = 0 THEN n_chars % 10 END, 6.5) ELSE tech.score END AS score "
    "FROM s LEFT JOIN v USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN tech ON tech.file = printf('img_%d.jpg', s.doc_id)) "
    "SELECT doc_id, score IS NOT NULL AS gt_found, floor(score * 1e6 + 0.5) / 1e6 AS score FROM j"
)
def label_precedence(spark, sf_dir):
    d, truth = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    slug = F.element_at(F.array(*map(F.lit, ("ava-x", "aadb", "laion-5b", "koniq"))), (F.col("doc_id") % 4 + 1).cast("int"))
    s = d.select("doc_id", slug.alias("slug"), F.format_string("img_%d.jpg", "doc_id").alias("file"), F.col("doc_id").cast("string").alias("stem"), "n_chars")
    f, r = F.format_string("IMG_%d.jpg", "doc_id").alias("file"), F.col("doc_id").alias("row_no")
    tech = labels.last_wins(
        [
            truth.where("doc_id % 2 = 0").select(f, r, maths.from_five(1 + F.col("quality") * 4.0).alias("score")),
            truth.where("doc_id % 3 = 0").select(f, r, maths.from_hundred(F.col("toxic") * 50.0).alias("score")),
            truth.where("doc_id % 5 = 0").select(f, r, maths.from_unit_impairment(F.col("quality") * 0.5).alias("score")),
        ]
    )
    zero = [F.lit(0.0)] * 10
    votes = truth.select(
        F.col("doc_id").alias("image_num"), F.array(F.col("quality") + 1.0, *zero[:3], F.lit(2.0), *zero[:4], F.col("toxic") * 3.0).alias("votes")
    )
    aadb = truth.where("doc_id % 3 > 0").select(F.format_string("img_%d.jpg", "doc_id").alias("file"), (F.col("quality") * 0.5 + 0.25).alias("score"))
    own = F.when(F.col("n_chars") % 2 == 0, (F.col("n_chars") % 10).cast("double"))
    out = labels.attach_scores(s, "slug", "file", "stem", votes, aadb, tech, own)
    return out.select("doc_id", "gt_found", maths.round6(F.col("score")).alias("score"))


@query(
    "WITH b AS (SELECT doc_id, 1 + quality * 4.5 + toxic * 2 AS m, unnest(range(1, 11)) AS bin FROM labels), w AS (SELECT *, exp(-0.5 * (bin - m) ** 2) AS e FROM b) "
    "SELECT doc_id, bin::INT AS bin, floor(e / sum(e) OVER (PARTITION BY doc_id) * 1e6 + 0.5) / 1e6 AS p FROM w"
)
def gaussian_bins(spark, sf_dir):
    t = table(spark, sf_dir, "labels").select("doc_id", maths.gaussian_bins(1 + F.col("quality") * 4.5 + F.col("toxic") * 2).alias("p"))
    return t.select("doc_id", F.posexplode("p").alias("bin", "p")).select("doc_id", (F.col("bin") + 1).alias("bin"), maths.round6(F.col("p")).alias("p"))


@query(
    "SELECT event_id, "
    + ", ".join(
        f"floor(({e}) * 1e6 + 0.5) / 1e6 AS {n}"
        for n, e in (
            ("five", "1 + (value - 1) * 2.25"),
            ("hundred", "1 + value * 0.09"),
            ("nine", "value + 1"),
            ("impairment", "1 + (1 - least(100.0, value) / 100) * 9"),
            ("unit_impairment", "1 + (1 - value) * 9"),
            ("unit", "value * 9 + 1"),
        )
    )
    + " FROM events"
)
def score_rescale(spark, sf_dir):
    v = F.col("value")
    scales = {
        "five": maths.from_five,
        "hundred": maths.from_hundred,
        "nine": maths.from_nine,
        "impairment": maths.from_impairment,
        "unit_impairment": maths.from_unit_impairment,
        "unit": maths.from_unit,
    }
    return table(spark, sf_dir, "events").select("event_id", *(maths.round6(f(v)).alias(n) for n, f in scales.items()))


@query(
    "SELECT file, arg_max(score, {'t': t, 'r': r}) AS score FROM (SELECT lower(event_type) AS file, floor(value * 100) AS score, 0 AS t, event_id AS r FROM events WHERE event_id % 2 = 0 "
    "UNION ALL SELECT printf('user_%d', user_id), floor(value * 10), 1, event_id FROM events UNION ALL SELECT lower(event_type), floor(value), 2, event_id FROM events WHERE user_id % 5 = 0) GROUP BY file"
)
def gt_last_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("row_no", F.col("event_id"))
    kind, user = F.upper("event_type").alias("file"), F.format_string("user_%d", "user_id").alias("file")
    return labels.last_wins(
        [
            e.where("event_id % 2 = 0").select(kind, "row_no", F.floor(F.col("value") * 100).alias("score")),
            e.select(user, "row_no", F.floor(F.col("value") * 10).alias("score")),
            e.where("user_id % 5 = 0").select(kind, "row_no", F.floor("value").alias("score")),
        ]
    )


@query(
    "SELECT user_id, floor(sum((event_id % 10 + 1) * floor(abs(value) + 1)) / sum(floor(abs(value) + 1)) * 1e6 + 0.5) / 1e6 AS score, "
    "sum((event_id % 10 + 1) * floor(abs(value) + 1)) AS literal_score FROM events GROUP BY user_id"
)
def weighted_mean_votes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    bins = [F.sum(F.when(F.col("event_id") % 10 == i, F.floor(F.abs("value") + 1).cast("double")).otherwise(0.0)).alias(f"v{i}") for i in range(10)]
    votes = e.groupBy("user_id").agg(*bins).select("user_id", F.array(*[f"v{i}" for i in range(10)]).alias("v"))
    return votes.select("user_id", maths.round6(maths.vote_score(F.col("v"))).alias("score"), maths.vote_score(F.col("v"), False).alias("literal_score"))


_TEN = "SELECT vec_id, unnest(embedding[1:10])::DOUBLE AS x, unnest(range(1, 11)) AS i FROM embeddings"


@query(f"SELECT vec_id, floor(sum(i * exp(x)) / sum(exp(x)) * 1e6 + 0.5) / 1e6 AS mean FROM ({_TEN}) GROUP BY vec_id")
def softmax_mean(spark, sf_dir):
    p = table(spark, sf_dir, "embeddings").select("vec_id", maths.softmax(floats("embedding", 10)).alias("p"))
    return p.select("vec_id", maths.round6(maths.weighted_bins(F.col("p"))).alias("mean"))


@query(
    "SELECT vec_id, i::INT AS i, floor(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) * 1e6 + 0.5) / 1e6 AS x FROM "
    "(SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"
)
def l2_normalize(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", maths.l2_normalize(F.transform("embedding", lambda x: x.cast("double"))).alias("v"))
    return v.select("vec_id", F.posexplode("v").alias("i", "x")).select("vec_id", (F.col("i") + 1).alias("i"), maths.round6(F.col("x")).alias("x"))


_PROTO = "SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY label, i) GROUP BY label"


def label_means(e: DataFrame) -> DataFrame:
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))


@query(
    f"WITH p AS ({_PROTO}) SELECT vec_id, arg_max(label, c) AS style_tag FROM (SELECT vec_id, p.label, list_cosine_similarity(embedding::DOUBLE[], p.v) AS c FROM embeddings, p) GROUP BY vec_id"
)
def zero_shot_tag(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return latents.zero_shot(e.select("vec_id", "embedding"), "embedding", label_means(e), "label", "v").select("vec_id", "style_tag")


@query(f"WITH p AS ({_PROTO}) SELECT vec_id, arg_min(label, c) AS cluster_id FROM (SELECT vec_id, p.label, list_distance(embedding::DOUBLE[], p.v) AS c FROM embeddings, p) GROUP BY vec_id")
def nearest_centroid(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return latents.nearest_centroid(e.select("vec_id", "embedding"), "embedding", label_means(e), "label", "v").select("vec_id", "cluster_id")


@query()
def kmeans_clusters(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return latents.style_clusters(e, "embedding").select("vec_id", "cluster_id")


@query("SELECT vec_id, floor(len(list_filter(embedding, lambda x: x < 0)) / len(embedding) * 1e6 + 0.5) / 1e6 AS dark FROM embeddings WHERE len(list_filter(embedding, lambda x: x < 0)) / len(embedding) <= 0.5")
def dark_ratio(spark, sf_dir):
    dark = F.size(F.filter("embedding", lambda x: x < 0)) / F.size("embedding")
    e = table(spark, sf_dir, "embeddings").select("vec_id", dark.alias("dark"))
    keep = labels.pixel_filters(F.lit(200), F.lit(200), F.col("dark"), black_threshold=0.5)
    return e.where(keep).select("vec_id", maths.round6(F.col("dark")).alias("dark"))


_LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_BOX = {"cx": "(l_quantity + l_tax / 2) / 640.0", "cy": "(l_discount + l_quantity / 2) / 480.0", "w": "l_tax / 640.0", "h": "l_quantity / 480.0"}


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*_LINES.split(", "), F.array("l_quantity", "l_discount", "l_tax", "l_quantity").alias("box"))


@query(f"SELECT {_LINES}, " + ", ".join(f"floor(({e}) * 1e6 + 0.5) / 1e6 AS {n}" for n, e in _BOX.items()) + " FROM lineitem")
def bbox_to_yolo(spark, sf_dir):
    y = _boxes(spark, sf_dir).withColumn("y", maths.box_to_yolo(F.col("box"), F.lit(640), F.lit(480)))
    return y.select(*_LINES.split(", "), *(F.col("y")[i].alias(n) for i, n in enumerate(_BOX)))


@query(
    f"SELECT {_LINES}, CASE WHEN l_linenumber % 2 = 0 THEN concat_ws(' ', l_linenumber::VARCHAR, "
    + ", ".join(f"printf('%.6f', floor(({e}) * 1e6 + 0.5) / 1e6)" for e in _BOX.values())
    + ") ELSE concat_ws(' ', l_linenumber::VARCHAR, printf('%.6f', floor(l_discount * 1e6 + 0.5) / 1e6), printf('%.6f', floor(l_tax * 1e6 + 0.5) / 1e6)) END AS line FROM lineitem"
)
def label_lines(spark, sf_dir):
    li = _boxes(spark, sf_dir)
    seg = arrays.annotation("segmentation", F.col("l_linenumber"), F.slice("box", 2, 2))
    a = F.when(F.col("l_linenumber") % 2 == 0, arrays.annotation("bbox", F.col("l_linenumber"), F.col("box"))).otherwise(seg)
    return li.select(*_LINES.split(", "), arrays.label_line(a, F.lit(640), F.lit(480)).alias("line"))


@query(
    f"SELECT vec_id, i::INT AS i, floor(CASE WHEN i % 3 = 1 THEN x / 640.0 WHEN i % 3 = 2 THEN x / 480.0 ELSE x END * 1e6 + 0.5) / 1e6 AS x FROM ({_TEN}) WHERE i <= 9"
)
def normalize_points(spark, sf_dir):
    p = maths.normalize_points(F.transform(floats("embedding", 10), lambda x: x * 1.0), F.lit(640), F.lit(480), 3)
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(p).alias("i", "x"))
    return v.select("vec_id", (F.col("i") + 1).alias("i"), maths.round6(F.col("x")).alias("x"))


@query("SELECT p_partkey, CASE lower(trim(p_brand)) WHEN 'brand#11' THEN 3 WHEN 'brand#23' THEN 7 WHEN 'brand#35' THEN 12 ELSE 0 END AS cls FROM part")
def category_lookup(spark, sf_dir):
    names = {"brand#11": 3, "brand#23": 7, "brand#35": 12}
    return table(spark, sf_dir, "part").select("p_partkey", arrays.class_id(F.concat(F.lit(" "), F.upper("p_brand"), F.lit(" ")), names).alias("cls"))


@query("SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS tags, len(json_keys(props))::INT AS n FROM events")
def tag_extract(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("j", F.concat(F.lit('{"bucket": '), "props", F.lit("}")))
    t = arrays.tags(F.col("j"), F.lit(None).cast("string"))
    return e.select("event_id", F.array_join(t, ",").alias("tags"), F.size(t).alias("n"))


@query("SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn, role) AS roles, bool_or(role = 'system') AS has_system FROM conversations GROUP BY conv_id")
def annotations_nested(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    nested = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("a"))
    return nested.select("conv_id", F.size("a").cast("long").alias("n"), F.array_join(F.transform("a", lambda x: x["role"]), ",").alias("roles"), F.exists("a", lambda x: x["role"] == "system").alias("has_system"))


@query(
    "SELECT page_id, CASE WHEN contains(last, ':') THEN replace(replace(replace(string_split(last, ':')[-1], '.tgz', ''), '.tar.gz', ''), '.zip', '') ELSE last END AS slug, repo FROM "
    "(SELECT page_id, string_split(ref, '/')[-1] AS last, string_split(ref, ':')[1] AS repo FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'owner/set-' || page_id || ':file_' || page_id || '.tar.gz' ELSE 'owner/set_' || page_id END AS ref FROM pages))"
)
def slug_of_ref(spark, sf_dir):
    i = F.col("page_id").cast("string")
    ref = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, F.concat(F.lit("hf://owner/set-"), i, F.lit(":file_"), i, F.lit(".tar.gz"))).otherwise(F.concat(F.lit("owner/set_"), i))
    p = table(spark, sf_dir, "pages").select("page_id", ref.alias("ref"))
    return p.select("page_id", strings.ref_slug(F.col("ref")).alias("slug"), strings.ref_repo(F.col("ref")).alias("repo"))


_CLEAN = " ".join(f"WHEN contains(lower(s), '{k}') THEN '{k}'" for k in strings.SLUG_KEYS)


@query(f"SELECT page_id, CASE {_CLEAN} ELSE string_split(s, '-')[1] END AS slug FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'My-LAION-5B' WHEN 1 THEN 'x-Aadb-' || page_id WHEN 2 THEN 'Big' || page_id || '-set-x' ELSE string_split(url, '/')[3] END AS s FROM pages)")
def clean_slug(spark, sf_dir):
    i, k = F.col("page_id").cast("string"), F.col("page_id") % 5
    s = F.when(k == 0, "My-LAION-5B").when(k == 1, F.concat(F.lit("x-Aadb-"), i)).when(k == 2, F.concat(F.lit("Big"), i, F.lit("-set-x"))).otherwise(F.split("url", "/")[2])
    return table(spark, sf_dir, "pages").select("page_id", strings.clean_slug(s).alias("slug"))


_TASK = " ".join("WHEN " + " OR ".join(f"contains(k, '{w}')" for w in words) + f" THEN '{t}'" for t, words in strings.TASKS)


@query(f"SELECT p_partkey, CASE WHEN k = '' THEN 'quality' {_TASK} ELSE 'detection' END AS task FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE lower(p_name || ' ' || p_type) END AS k FROM part)")
def detect_task(spark, sf_dir):
    k = F.when(F.col("p_partkey") % 11 == 0, F.lit("")).otherwise(F.concat_ws(" ", "p_name", "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", strings.detect_task(k).alias("task"))


_SHOWN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in strings.DISPLAY.items())


@query(
    f"SELECT shown AS display_source, count(*) AS n FROM (SELECT CASE lower(s) {_SHOWN} ELSE array_to_string(list_transform(string_split_regex(regexp_replace(s, '([^A-Za-z])', '\\1\x01', 'g'), '\x01'), lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '') END AS shown FROM "
    "(SELECT CASE doc_id % 4 WHEN 0 THEN 'ava' WHEN 1 THEN 'LAION-5b' WHEN 2 THEN 'rain100l_x' ELSE source END AS s FROM documents)) GROUP BY shown"
)
def display_source(spark, sf_dir):
    s = F.when(F.col("doc_id") % 4 == 0, "ava").when(F.col("doc_id") % 4 == 1, "LAION-5b").when(F.col("doc_id") % 4 == 2, "rain100l_x").otherwise(F.col("source"))
    d = table(spark, sf_dir, "documents").select(strings.sample_name(F.lit("loom"), s, F.col("doc_id")).alias("name"), F.lit("none").alias("source"))
    return reports.by_source(d)


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("name"))
    done = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("name"))
    return sampling.unregistered(d, done).select("doc_id", "source")


@query("WITH s AS (SELECT DISTINCT source FROM documents) SELECT a.source AS slug, 'model_' || b.source AS model_key FROM s a JOIN s b ON contains('owner/' || b.source || '-v1', a.source)")
def consumers_contains(spark, sf_dir):
    s = table(spark, sf_dir, "documents").select("source").distinct()
    refs = s.select(F.concat(F.lit("owner/"), "source", F.lit("-v1")).alias("ref"), F.concat(F.lit("model_"), "source").alias("model_key"))
    return purge.consumers(s.select(F.col("source").alias("slug")), refs)


@query(
    "WITH s AS (SELECT DISTINCT source AS slug FROM documents), r AS (SELECT slug AS ref, 'm_' || slug AS mk FROM s WHERE slug NOT LIKE '%3'), "
    "c AS (SELECT 'm_' || source AS mk, count(*) FILTER (quality = 0) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING source <> 'src5'), "
    "u AS (SELECT s.slug, r.mk, coalesce(c.n > 0, false) AS ok FROM s LEFT JOIN r ON contains(r.ref, s.slug) LEFT JOIN c USING (mk)), "
    "g AS (SELECT slug, count(mk) AS k, bool_and(ok) AS ok, string_agg(mk, ', ' ORDER BY mk) AS users, string_agg(CASE WHEN NOT ok THEN mk END, ', ' ORDER BY mk) AS waiting FROM u GROUP BY slug) "
    "SELECT slug, CASE WHEN k = 0 OR ok THEN 'purge' ELSE 'keep' END AS decision, CASE WHEN k = 0 THEN 'Orphaned (Not in manifest)' WHEN ok THEN 'Compiled for: ' || users ELSE 'Needed by: ' || waiting END AS reason FROM g"
)
def purge_plan(spark, sf_dir):
    d, truth = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    s = d.select(F.col("source").alias("slug")).distinct()
    refs = s.where("slug not like '%3'").select(F.col("slug").alias("ref"), F.concat(F.lit("m_"), "slug").alias("model_key"))
    joined = d.select("doc_id", "source").join(truth, "doc_id").where("source <> 'src5'")
    compiled = joined.groupBy(F.concat(F.lit("m_"), "source").alias("model_key")).agg(F.count_if(F.col("quality") == 0).alias("index_count"))
    return purge.purge_plan(s, refs, compiled)


_INDEX = f"SELECT doc_id AS id, source, split, CASE WHEN doc_id % 2 = 0 THEN 'quality' ELSE 'detection' END AS task, doc_id % 16 - 1 AS cluster_id, name FROM ({_SAMPLES})"


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = samples(spark, sf_dir)
    return s.select(
        F.col("doc_id").alias("id"), "source", "split", F.when(F.col("doc_id") % 2 == 0, "quality").otherwise("detection").alias("task"), (F.col("doc_id") % 16 - 1).alias("cluster_id"), "name"
    )


@query(
    f"SELECT count(*) AS n, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, "
    f"arg_min(task, {{'a': source, 'b': cluster_id, 'c': id}}) AS task FROM ({_INDEX})"
)
def source_report(spark, sf_dir):
    return reports.summary(_index(spark, sf_dir)).withColumn("sources", F.array_join("sources", ","))


@query(f"SELECT task, count(*) AS n FROM ({_INDEX}) GROUP BY task")
def task_report(spark, sf_dir):
    return reports.by_task(_index(spark, sf_dir))


@query(f"SELECT source, id, cluster_id, row_number() OVER (PARTITION BY source ORDER BY cluster_id, id) AS position FROM ({_INDEX})")
def shard_order(spark, sf_dir):
    return sampling.rank_in_group(_index(spark, sf_dir).select("source", "id", "cluster_id"), ["source"], ["cluster_id", "id"], "position")


@query(
    f"SELECT id, name, '{{\"style\":\"standard\",\"cluster\":' || cluster_id || ',\"source\":\"' || source || '\"}}' AS meta FROM ({_INDEX}) WHERE source = 'src3'"
)
def index_projection(spark, sf_dir):
    r = _index(spark, sf_dir).withColumn("clip_latent", F.array(F.lit(0.0))).withColumn("img_bytes", F.lit(b"x"))
    i = reports.index_of(r).where("source = 'src3'")
    return i.select("id", "name", arrays.shard_json(F.lit("standard"), F.col("cluster_id"), F.col("source")).alias("meta"))


_FORMATS = "CASE WHEN page_id % 7 = 0 THEN 'instances_' || page_id || '.json' WHEN page_id % 5 = 0 THEN 'part-' || page_id || '.parquet' WHEN page_id % 3 = 0 THEN 'note_' || page_id || '.json' WHEN page_id % 2 = 0 THEN page_id || '.mat' ELSE page_id || '.safetensors' END"


@query(
    f"SELECT folder, arg_min(fmt, {{'a': rank, 'b': path}}) AS format, arg_min(path, {{'a': rank, 'b': path}}) AS path FROM (SELECT folder, path, CASE WHEN path LIKE '%.json' THEN CASE WHEN path LIKE '%coco%' OR path LIKE '%instances%' THEN 'coco' END WHEN path LIKE '%.parquet' THEN 'parquet' WHEN path LIKE '%.mat' THEN 'matlab' WHEN path LIKE '%.safetensors' THEN 'safetensors' END AS fmt, "
    f"CASE WHEN path LIKE '%.json' THEN 0 WHEN path LIKE '%.parquet' THEN 1 WHEN path LIKE '%.mat' THEN 2 ELSE 3 END AS rank FROM (SELECT string_split(url, '/')[3] AS folder, {_FORMATS} AS path FROM pages)) WHERE fmt IS NOT NULL GROUP BY folder"
)
def format_priority(spark, sf_dir):
    from lakeloom.sources.annotations import discover_format

    listing = table(spark, sf_dir, "pages").select(F.split("url", "/")[2].alias("folder"), F.expr(_FORMATS).alias("path"))
    return discover_format(listing)


_REFS = "SELECT page_id AS pos, CASE WHEN page_id % 2 = 0 THEN 'hf://owner/' ELSE 'owner/' END || 'set' || page_id % 40 AS ref FROM pages"
_LISTING = "SELECT 'set' || i AS slug, i % 3 AS file_count, i % 4 = 1 AS has_zip FROM (SELECT unnest(range(0, 30)) AS i)"
_STATUS = f"SELECT pos, r.ref, replace(split_part(r.ref, 'owner/', 2), 'x', '') AS folder, CASE WHEN r.ref LIKE 'hf://%' THEN CASE WHEN file_count > 0 THEN 'Extracted' ELSE 'Missing' END WHEN has_zip THEN 'ZipOnly' WHEN file_count > 0 THEN 'Extracted' ELSE 'Missing' END AS status FROM ({_REFS}) r LEFT JOIN ({_LISTING}) l ON l.slug = split_part(r.ref, 'owner/', 2)"


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    refs = table(spark, sf_dir, "pages").select(i.alias("pos"), F.concat(F.when(i % 2 == 0, "hf://owner/").otherwise("owner/"), F.lit("set"), (i % 40).cast("string")).alias("ref"))
    listing = spark.range(30).select(F.concat(F.lit("set"), F.col("id").cast("string")).alias("slug"), (F.col("id") % 3).alias("file_count"), (F.col("id") % 4 == 1).alias("has_zip"))
    return purge.source_status(refs, listing)


@query(f"SELECT pos, ref, folder, status FROM ({_STATUS})")
def source_status(spark, sf_dir):
    return _status(spark, sf_dir).select("pos", "ref", "folder", "status")


@query(f"SELECT ref, min(pos) AS first_pos FROM ({_STATUS}) WHERE status IN ('Missing', 'ZipOnly') GROUP BY ref")
def missing_refs(spark, sf_dir):
    return purge.missing_refs(_status(spark, sf_dir))


@query("SELECT source AS folder, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY source")
def dir_size(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), F.col("n_chars").alias("length"))
    return reports.folder_sizes(d).select("folder", "bytes")


@query(f"SELECT name, dataset FROM (SELECT {_NAME} AS name, CASE WHEN source LIKE '%Large' THEN left(source, length(source) - 5) ELSE source END || 'Small' AS dataset FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || 'Large' ELSE source END AS source FROM documents))")
def reduced_names(spark, sf_dir):
    source = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit("Large"))).otherwise(F.col("source"))
    d = table(spark, sf_dir, "documents").select(source.alias("source"), "doc_id")
    name = strings.sample_name(F.lit("loom"), F.col("source"), F.col("doc_id"))
    return d.select(name.alias("name"), strings.strip_suffix(strings.slug_of_name(name, "loom"), F.lit("Large"), F.lit("Small")).alias("dataset"))


@query("SELECT DISTINCT md5(text) AS hash FROM documents")
def streaming_resume(spark, sf_dir):
    """The documents as a file stream, compiled in available-now batches with stateful dedup of the content hash."""
    return stream_registry(spark, f"{sf_dir}/documents.parquet", "hash", F.md5("text").alias("hash"))


@query(
    f"WITH s AS ({_SAMPLES}), g AS (SELECT s.*, 1 + quality * 9.0 AS score FROM s JOIN labels USING (doc_id) WHERE 1 + quality * 9.0 >= 4.0), "
    "u AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY hash ORDER BY doc_id) = 1), "
    "k AS (SELECT *, sum(size) OVER (ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING) - size AS before FROM u) "
    "SELECT source, split, count(*) AS n, sum(size)::BIGINT AS bytes FROM k WHERE before < 1500000 GROUP BY source, split"
)
def compile_counts(spark, sf_dir):
    """The flagship: name, split, label join and gate, dedup, byte budget, counts by source and split."""
    from lakeloom.plans.compile import compile_samples

    s = samples(spark, sf_dir)
    truth = table(spark, sf_dir, "labels").select("doc_id", (1 + F.col("quality") * 9.0).alias("score"))
    kept = compile_samples(s, truth, "doc_id", ["source", "doc_id"], 1_500_000)
    return kept.groupBy("source", "split").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
