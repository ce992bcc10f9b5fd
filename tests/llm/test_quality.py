import numpy as np
import zlib

from coffer.llm import quality, queries


def test_held_out_documents_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op9_quality"](spark, sf_dir).join(queries.table(spark, sf_dir, "labels"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    unseen = [r for r in rows if r["held_out"]]
    assert len(unseen) > 60
    assert np.mean([r["predicted"] == r["quality"] for r in unseen]) > 0.95
    good, bad = ([r["score"] for r in unseen if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "", 9.0), (2, None, 9.0), (None, "word " * 30000, 9.0), (1, "", 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    weights = quality.train(docs, labels)
    assert not weights.any()
    rows = quality.scored(docs, weights).collect()
    assert [r["score"] for r in rows] == [0.5] * 4
    assert quality.scored(docs.limit(0), weights).collect() == []


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    labels = spark.createDataFrame([(i % 3000, i % 2) for i in range(6000)], "doc_id long, quality int")
    ids = [r["doc_id"] for r in quality.training_labels(labels, 500).collect()]
    assert 350 < len(ids) < 650 and len(set(ids)) == len(ids)
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
