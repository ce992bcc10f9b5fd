import numpy as np
import public_tokenizers

import corpus_pipeline
from coffer.llm import bpe, queries, shared
from test_decontaminate import brute as leaks
from test_jaccard import brute as groups
from test_suffixes import brute as repeats

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_on_what_the_last_one_left(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = queries.table(spark, SF_DIR, "documents")
    columns = docs.columns

    def stage(name, docs):
        out = str(tmp_path / name)
        stages[name](spark, docs, SF_DIR).write.parquet(out)
        return spark.read.parquet(out)

    good = stage("quality", docs)
    kept = {r["doc_id"] for r in queries.QUERIES["op9_quality"](spark, SF_DIR).where("predicted = 1").collect()}
    assert good.columns == columns and set(rows(good)) == kept and len(kept) > 100

    single = stage("near_copies", good)
    expected = {d for d, (_, first) in groups(list(rows(good).items())).items() if d == first}
    assert single.columns == columns and set(rows(single)) == expected

    cut = stage("repeated_passages", single)
    texts = {d: kept.decode(errors="ignore") for d, (kept, _) in repeats(list(rows(single).items())).items()}
    assert cut.columns == columns and rows(cut) == texts
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    clean = stage("leaks", cut)
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    assert clean.columns == columns and set(rows(clean)) == {d for d, (_, hit, _) in leaks(list(texts.items()), items).items() if not hit}

    ids = stage("tokens", clean).collect()
    codec = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in ids} == {d: codec.encode_ordinary(t) for d, t in rows(clean).items()}


def test_anti_join_by_filter(spark):
    docs = spark.createDataFrame([(i % 50, str(i)) for i in range(100)] + [(None, "n")], "doc_id long, word string")
    gone = spark.createDataFrame([(i,) for i in range(0, 50, 3)] + [(None,)], "doc_id long")
    left = shared.without(docs, gone, "doc_id").collect()
    assert sorted(r["word"] for r in left) == sorted([str(i) for i in range(100) if i % 50 % 3] + ["n"])
    assert shared.without(docs, gone.limit(0), "doc_id").count() == 101


def odd(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, long, 0.5), (1, long, 0.5), (1, long + " x", 0.5), (1, "something else altogether that stands alone", 0.5), (None, long, 0.5),
        (None, "no name and no copy of it anywhere", 0.5), (None, "no name and no copy of it anywhere", 0.5), (5, None, 0.5), (6, "", 0.5),
    ]
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), q) for d, t, q in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")


def plain(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_near_copies_of_odd_rows(spark):
    docs = odd(spark)
    got = corpus_pipeline.one_of_near_copies(spark, docs, SF_DIR)
    rows = plain(got)
    assert got.columns == docs.columns
    kept = [t for _, t in rows if t and t.startswith("one two")]
    assert len(kept) == 1 and (1, kept[0]) in rows
    assert len(rows) == 5 and (5, None) in rows and (6, "") in rows
    assert (1, "something else altogether that stands alone") in rows and (None, "no name and no copy of it anywhere") in rows
    assert corpus_pipeline.one_of_near_copies(spark, docs.limit(0), SF_DIR).collect() == []


def test_leaks_and_quality_of_odd_rows(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("length(text) > 200").first()["text"]
    docs = odd(spark)
    more = [(None, f"Before {item}", "en", "s", 1, 0.5), (1, f"{item} after", "en", "s", 1, 0.5)]
    whole = docs.union(spark.createDataFrame(more, docs.schema))
    clean = corpus_pipeline.without_leaks(spark, whole, SF_DIR)
    assert plain(clean) == plain(docs) and clean.columns == docs.columns
    good = corpus_pipeline.good_quality(spark, docs, SF_DIR)
    assert good.columns == docs.columns and all(r["score"] == 0.5 for r in good.collect())
    cut = corpus_pipeline.without_repeated_passages(spark, docs, SF_DIR)
    assert cut.count() == docs.count() and cut.columns == docs.columns
    assert corpus_pipeline.tokens(spark, docs, SF_DIR).count() == docs.count()
