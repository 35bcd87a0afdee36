"""Stages of the pipeline on clashing ids, clashing column names, maps, nulls and no rows."""

import numpy as np
import pytest

import corpus_pipeline

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, _key string,"
    " _at string, _mix string, row string, `a.b` string, m map<string,int>"
)
TAIL = ("mine", "own", "k", "at", "mix", "r", "dot", {"x": 1})


def prose(seed, n=120):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 3000, n))


@pytest.fixture(scope="module")
def docs(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(0, a), (1, a), (1, b), (2, c), (2, c), (None, prose(4)), (None, prose(5)), (None, b + " more"), (3, None), (4, "")]
    return spark.createDataFrame([(i, t, "en", "s", 1, *TAIL) for i, t in rows], SCHEMA), (a, b, c)


def test_near_copies_share_no_fate_with_rows_of_their_id(spark, sf, docs):
    frame, (a, b, c) = docs
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, frame, sf).collect()]
    texts = [t for _, t in kept]
    assert texts.count(a) == 1 and texts.count(c) == 1
    assert sum(t in (b, b + " more") for t in texts) == 1
    assert prose(4) in texts and prose(5) in texts
    assert (3, None) in kept and (4, "") in kept
    assert len(kept) == 7


def test_documents_are_not_shuffled_for_few_copies(spark, sf, docs):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus_pipeline.drop_near_copies(spark, docs[0], sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_leaks_share_no_fate_with_rows_of_their_id(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 60").first().text
    rows = [(1, prose(1) + " " + item), (1, prose(2)), (None, prose(3) + " " + item), (None, prose(4))]
    frame = spark.createDataFrame([(i, t, "en", "s", 1, *TAIL) for i, t in rows], SCHEMA)
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_leaks(spark, frame, sf).collect()}
    assert kept == {(1, prose(2)), (None, prose(4))}


def test_own_columns_pass_all_stages(spark, sf, docs):
    frame, _ = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, sf)
        added = ["size", "shard", "slot"] if name == "sharding" else []
        assert out.columns == [*frame.columns, *added]
        rows = out.collect()
        assert rows, name
        assert all(tuple(r)[5 : len(frame.columns)] == TAIL for r in rows), name
        assert stage(spark, frame.limit(0), sf).collect() == []


def test_sharding_replaces_only_its_own_columns(spark, sf):
    frame = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, size string, other string")
    (row,) = corpus_pipeline.shard(spark, frame, sf).collect()
    assert row.asDict() == {"doc_id": 1, "text": "a b", "other": "y", "size": 11, "shard": row.shard, "slot": 0}
