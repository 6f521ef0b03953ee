import math

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import arrays, maths, strings


def values(spark, f, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(f(*[F.col(c.split()[0]) for c in schema.split(", ")])).collect()]


def test_ref_slug(spark):
    refs = [("owner/a-b",), ("hf://owner/c",), ("hf://owner/d:file.tgz",), ("o/x:y:z.tar.gz",), ("plain",), ("a/b/",), (None,)]
    assert values(spark, strings.ref_slug, refs) == ["a-b", "c", "file", "z", "plain", "", None]
    assert values(spark, strings.ref_repo, [("hf://o/d:f.tgz",), ("competition:abc",), ("o/a",)]) == ["o/d", "abc", "o/a"]
    assert values(spark, strings.ref_file, [("hf://o/d:f.tgz",), ("o/a",)]) == ["f.tgz", None]


def test_clean_slug(spark):
    cases = {"My-LAION-5B": "laion-5b", "laion-x": "laion", "LLaVA-150K": "ava", "Big-set": "Big", "-x": "", "": "", "noDash": "noDash", "flickr30k": "flickr"}
    assert values(spark, strings.clean_slug, [(k,) for k in cases]) == list(cases.values())


def test_detect_task(spark):
    cases = {None: "quality", "": "quality", "diffusion_face": "diffusion", "parsenet": "segmentation", "retinaface": "pose", "NIMA_x": "quality", "ultrazoom": "super-resolution", "ffanet_in": "restoration", "yolov8n": "detection"}
    assert values(spark, strings.detect_task, [(k,) for k in cases]) == list(cases.values())


def test_names(spark):
    assert values(spark, lambda s, i: strings.sample_name(F.lit("p"), s, i), [("a_b", 7), ("c", 10**9)], "s string, i long") == ["p_a_b_000000007", "p_c_1000000000"]
    assert values(spark, lambda n: strings.name_source(n, F.lit("z")), [("p_a_b_000000007",), ("p_x",)]) == ["a_b", "z"]
    assert values(spark, strings.name_second_part, [("p_a_b_1",), ("p",)]) == ["a", "unknown"]
    assert values(spark, lambda n: strings.slug_of_name(n, "p"), [("p_a_b_000000007",)]) == ["a_b"]
    assert values(spark, lambda n: strings.strip_suffix(n, F.lit("Large"), F.lit("S")), [("XLarge",), ("X",)]) == ["XS", "XS"]
    assert values(spark, lambda n: strings.pad_right(n, 4), [("ab",), ("abcdef",)]) == ["ab  ", "abcdef"]
    assert values(spark, strings.stem, [("/a/b.c/x.tar.gz",), ("/a/.hidden",), ("x",)]) == ["x.tar", ".hidden", "x"]


@pytest.mark.parametrize("s", ["rain100l", "abc def", "a-b_c", "ALREADY", "x1y2", "", "o'neil"])
def test_title_case(spark, s):
    assert values(spark, strings.title_case, [(s,)]) == [s.title()]


def test_display_source(spark):
    assert values(spark, strings.display_source, [("AVA",), ("laion-5b",), ("KonIQ10k",), ("rain100l",)]) == ["AVA", "LAION-5B", "KonIQ-10k", "Rain100L"]


@pytest.mark.parametrize("mean", [1.0, 10.0, 5.5, 0.0, 12.0])
def test_gaussian(spark, mean):
    (got,) = values(spark, maths.gaussian_bins, [(mean,)], "x double")
    want = [math.exp(-0.5 * (b - mean) ** 2) for b in range(1, 11)]
    assert got == pytest.approx([w / sum(want) for w in want]) and sum(got) == pytest.approx(1)


def test_rescales(spark):
    for f, pairs in {
        maths.from_five: [(1, 1), (3, 5.5), (5, 10)],
        maths.from_hundred: [(0, 1), (50, 5.5), (100, 10)],
        maths.from_nine: [(0, 1), (9, 10)],
        maths.from_impairment: [(0, 10), (50, 5.5), (100, 1), (130, 1)],
        maths.from_unit_impairment: [(0, 10), (1, 1)],
        maths.from_unit: [(0, 1), (0.5, 5.5), (1, 10)],
    }.items():
        assert values(spark, f, [(float(a),) for a, _ in pairs], "x double") == pytest.approx([b for _, b in pairs])


def test_geometry(spark):
    box = lambda b, w, h: maths.box_to_yolo(b, w, h)
    assert values(spark, box, [([10.0, 20.0, 30.0, 40.0], 100, 200)], "b array<double>, w int, h int") == [[0.25, 0.2, 0.3, 0.2]]
    assert values(spark, box, [([10.0, 20.0, 30.0, 40.0], 0, 200)], "b array<double>, w int, h int") == [[None, 0.2, None, 0.2]]
    p = lambda stride: lambda x: maths.normalize_points(x, F.lit(10), F.lit(20), stride)
    assert values(spark, p(2), [([1.0, 2.0, 3.0],), ([],)], "x array<double>") == [[0.1, 0.1], []]
    assert values(spark, p(3), [([1.0, 2.0, 2.0, 5.0, 5.0, 1.0],)], "x array<double>") == [[0.1, 0.1, 2.0, 0.5, 0.25, 1.0]]


def test_votes(spark):
    v = [[0.0] * 9 + [4.0], [0.0] * 10]
    assert values(spark, maths.vote_score, [(x,) for x in v], "x array<double>") == [10.0, None]
    assert values(spark, lambda x: maths.vote_score(x, False), [(v[0],)], "x array<double>") == [40.0]


def test_annotations(spark):
    rows = [
        ([1.0, 1.0, 2.0, 2.0], '[[1, 2, 3, 4]]', None),
        ([1.0, 1.0, 2.0, 2.0], '{"counts": [1], "size": [2, 2]}', None),
        ([1.0, 1.0, 2.0, 2.0], "[]", None),
        ([1.0, 1.0, 2.0, 2.0], '[[1, 2]]', [1.0, 2.0, 2.0]),
        (None, None, None),
    ]
    f = lambda b, s, k: arrays.coco_annotation(F.lit(3), b, s, k, F.lit(10), F.lit(10))
    got = values(spark, f, rows, "b array<double>, s string, k array<double>")
    assert [g and (g["type"], g["data"]) for g in got] == [("segmentation", [0.1, 0.2, 0.3, 0.4]), None, ("bbox", [1, 1, 2, 2]), ("pose", [1, 1, 2, 2, 0.1, 0.2, 2]), None]
    lines = values(spark, lambda b, s, k: arrays.label_line(f(b, s, k), F.lit(10), F.lit(10)), rows, "b array<double>, s string, k array<double>")
    assert lines[0] == "3 0.100000 0.200000 0.300000 0.400000" and lines[2] == "3 0.200000 0.200000 0.200000 0.200000" and lines[4] is None


def test_tags(spark):
    many = "{" + ", ".join(f'"t{i:02d}": 1' for i in range(30)) + "}"
    rows = [('{"b1": {"x": 1, "y": 2}, "b2": {"x": 3}}', None), ("not json", '[{"tag_frequency": {"z": 1}}, {}]'), (None, None), (f'{{"b": {many}}}', None)]
    got = values(spark, lambda a, b: arrays.tags(a, b), rows, "a string, b string")
    assert got[:3] == [["x", "y"], ["z"], []] and len(got[3]) == 20


def test_class_id(spark):
    assert values(spark, lambda n: arrays.class_id(n, {"cat": 4}), [(" CAT ",), ("dog",), (None,)]) == [4, 0, 0]
