"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import corpus_pipeline as P
from conftest import SF001
from eventspark.llm.minmax_dedup import deduplicated
from eventspark.llm.personal_data import masked
from eventspark.llm.quality_knn import train
from test_minmax_dedup import brute


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0)], docs.schema)
    docs = docs.union(odd)
    seen = {}
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, SF001).write.parquet(out := str(tmp_path / name))
        docs = spark.read.parquet(out)
        seen[name] = (before, docs)
        if name != "packing":
            assert tuple(docs.columns) == P.COLUMNS
    before, after = seen["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    known = [(r["doc_id"] in kept) == bool(labels[r["doc_id"]]) for r in before.collect() if r["doc_id"] in labels]
    assert sum(known) >= 0.95 * len(known)
    before, after = seen["near_dedup"]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == [d for d, _, _, keep in brute(rows, 80) if keep]
    before, after = seen["personal_data"]
    want = {r["doc_id"]: masked(r["text"]) for r in before.collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    before, after = seen["mixing"]
    assert after.exceptAll(before).count() == 0 and 0 < after.count() <= before.count()
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.count()
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "personal_data", "mixing", "packing"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0


def test_near_dedup_of_repeated_and_missing_ids(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(60)) for x in "abc")
    near, d = a + "end", "".join(f"d{i} " for i in range(60))
    rows = [(3, a), (7, near), (7, b), (9, b + "end"), (None, c), (None, c), (5, d), (5, d), (None, a), (11, ""), (11, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in P.near_dedup(spark, docs, SF001).collect()]
    assert sorted(got, key=str) == sorted([(3, a), (7, b), (None, c), (5, d), (11, ""), (11, "")], key=str)


def test_near_dedup_keeps_all_columns(spark):
    a, b = ("".join(f"{x}{i} " for i in range(60)) for x in "ab")
    rows = [(1, a, "r2", {"m": 2}), (1, a, "r1", {"m": 1}), (2, a + "end", "r3", None), (3, b, None, {"m": 3}), (4, None, "r4", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_ string, doc map<string,int>")
    got = sorted(map(tuple, deduplicated(docs, percent=80, bands=38).collect()), key=str)
    assert got == [(1, a, "r1", {"m": 1}), (3, b, None, {"m": 3}), (4, None, "r4", None)]


def test_training_text_of_a_repeated_id(spark):
    words = [f"w{i} " * 9 for i in range(40)]
    rows = [(i, words[i] + x) for i in range(40) for x in ("one", "two", "three")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    models = [train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels)
              for r, n in ((rows, 1), (rows[::-1], 3))]
    assert (models[0].vectors == models[1].vectors).all() and len(models[0].labels)


def test_quality_without_labels(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    spark.read.parquet(f"{SF001}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.quality(spark, docs, str(tmp_path)).count() == docs.count() > 0
