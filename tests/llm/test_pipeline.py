import os
import shutil

import pytest
from samples import prose

import corpus_pipeline
from corpus_pipeline import STAGES


@pytest.fixture(scope="module")
def folder(spark, frame, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    item = prose(900, 30)
    near = prose(10, 100)
    rows = [(i, prose(i, 80), "xx") for i in range(10)]
    rows += [(20, near, "xx"), (21, near + " end", "xx"), (22, near + " other end", "xx")]
    rows += [(30, prose(3, 80), "xx"), (31, prose(3, 80), "xx"), (32, None, "xx"), (33, "", "xx"), (34, "123 !!", "xx")]
    rows += [(40, prose(41, 20) + " " + item + " " + prose(42, 20), "xx"), (None, prose(50, 50), None)]
    frame(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def stages_of(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.mode("overwrite").parquet(f"{folder}/stage{i}")
        docs = out[name] = spark.read.parquet(f"{folder}/stage{i}")
    return out


def keys(docs):
    return sorted(str(r["doc_id"]) for r in docs.select("doc_id").collect())


def test_every_stage_takes_effect(spark, folder):
    out = stages_of(spark, folder)
    base = [str(i) for i in range(10)]
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    assert all(out[name].columns == columns for name, _ in STAGES[:-1])
    assert keys(out["language"]) == sorted([*base, "20", "21", "22", "30", "31", "40", "None"])
    without = [x for x in base if x != "3"]
    assert keys(out["exact_dedup"]) == sorted([*without, "20", "21", "22", "31", "40", "None"])
    assert keys(out["near_dedup"]) == sorted([*without, "20", "31", "40", "None"])
    assert keys(out["decontamination"]) == sorted([*without, "20", "31", "None"])
    assert set(keys(out["packing"])) == {*without, "20", "31", "None"}
    assert sorted(keys(corpus_pipeline.run(spark, folder))) == keys(out["packing"])


def test_near_copies_with_shared_and_null_keys(spark, frame, folder):
    """Rows are decided by their texts: a dropped one does not stay because a kept one has its key."""
    near, other = prose(60, 100), prose(61, 100)
    rows = [(1, near), (2, near + " end"), (2, other), (None, near + " last"), (None, other + " last"), (None, prose(62, 100)), (5, None), (5, "")]
    kept = dict(STAGES)["near_dedup"](spark, frame(rows), folder)
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"]) == sorted([("1", near), ("2", other), ("None", prose(62, 100))])
    assert kept.filter("doc_id = 5").count() == 2


def test_empty_documents(spark, folder, tmp_path):
    empty = str(tmp_path)
    shutil.copytree(f"{folder}/benchmark.parquet", f"{empty}/benchmark.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(os.path.join(empty, "documents.parquet"))
    assert corpus_pipeline.run(spark, empty).count() == 0
