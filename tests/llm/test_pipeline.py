import re

from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import pieces, pii
from lakeloom.llm.common import materialize, read_table
from tests.conftest import SF
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_neardup import brute as near


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF, "documents").where("doc_id < 260")
    docs = docs.unionByName(docs.where("doc_id < 3").withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 90_000))
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, SF))
        after = {r["doc_id"]: r for r in docs.collect()}
        kept[name] = (before, after)
        assert name == "tokens" or docs.columns == columns
    before, after = kept["language"]
    assert set(before) - set(after) == {d for d, r in before.items() if not r["text"] or not any(c.isalpha() for c in r["text"])}
    before, after = kept["near_duplicates"]
    label = near([(d, r["text"]) for d, r in before.items()])
    assert set(after) == {d for d in before if label[d] == d}
    before, after = kept["benchmark"]
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    assert set(after) == {d for d, v in contaminated([(d, r["text"]) for d, r in before.items()], items).items() if not v[4]}
    before, after = kept["personal_data"]
    assert set(after) == set(before)
    for d, r in after.items():
        assert r["n_chars"] == len(r["text"]) and not re.search(r"[A-Za-z0-9]@[A-Za-z0-9]+\.", r["text"])
        assert r["text"] == before[d]["text"] or any(tag in r["text"] for tag in pii.TAGS.values())
    before, after = kept["tokens"]
    model = pieces.model_at(corpus_pipeline.piece_model_path())
    assert set(after) == set(before)
    for d, r in after.items():
        assert r["ids"] == model.lib.encode(before[d]["text"], add_bos=True, add_eos=True)


def test_stages_take_empty_tables_and_clashing_columns(spark):
    docs = read_table(spark, SF, "documents").where("doc_id < 12")
    for name in ("node", "label", "t", "key", "shingles", "spans", "ids", "score", "held_out"):
        docs = docs.withColumn(name, F.lit(name))
    for rows, least in ((docs, 1), (docs.where("false"), 0)):
        for name, stage in corpus_pipeline.STAGES:
            done = materialize(stage(spark, rows, SF))
            assert done.count() >= least and (least or not done.count())
            if name != "tokens":
                assert done.columns == docs.columns and all(r["node"] == "node" for r in done.collect())
                rows = done


def test_registered(spark):
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")].__len__() == 10
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "personal_data", "tokens"]
