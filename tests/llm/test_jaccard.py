import random

import numpy as np
from contract import compare, connect

from coffer.llm import jaccard, queries


def brute(docs):
    sets = {}
    for doc, text in docs:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def corpus(seed):
    """Copies, near copies, chains of edits, shared passages, short and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: rng.choices(vocabulary, k=n)
    passage, docs = text(25), []
    for _ in range(6):
        base = text(rng.randrange(30, 120))
        for _ in range(8):
            docs.append(list(base))
            base[rng.randrange(len(base))] = "edit"
    docs += [text(20) + passage + text(rng.randrange(5, 40)) for _ in range(20)]
    docs += [passage + text(rng.randrange(1, 6)) for _ in range(15)]
    docs += [["a", "b"], ["A", "b"], ["b", "a"], ["a"] * 50, ["a"] * 5, [], text(9000)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)] + [(900, None), (901, "\t\n")]


def test_against_brute_force(spark):
    docs = corpus(3)
    df = spark.createDataFrame([(d, t, -1) for d, t in docs], "doc_id long, text string, n_shingles int").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
    assert got == brute(docs)


def test_repeated_nameless_and_no_rows(spark):
    text = "one two three four five six"
    df = spark.createDataFrame([(4, text), (4, text), (2, text), (None, text), (9, "x")], "doc_id long, text string")
    got = sorted(jaccard.near_duplicates(df).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    assert [tuple(r) for r in got] == [(None, 2, None), (2, 2, 2), (4, 2, 2), (4, 2, 2), (9, 1, 9)]
    assert jaccard.near_duplicates(df.limit(0)).collect() == []


def test_sketches_never_rule_out_what_is_shared():
    rng = np.random.default_rng(2)
    for n, m, k in ((5, 5, 5), (300, 400, 250), (1000, 90, 80), (64, 4000, 0)):
        pool = rng.integers(0, 1 << 63, n + m - k, dtype=np.uint64)
        x, y = pool[:n], pool[n - k :]
        assert jaccard._at_most(jaccard.sketch(x), n, jaccard.sketch(y), m) >= k


def test_query_matches_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op7_jaccard_join"
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == ""
