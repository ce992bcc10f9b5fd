import math
import random
import re

from contract import compare, connect

from coffer.llm import lexical, queries
from coffer.llm.rolling import SLICE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """item: [(score, doc)], best first."""
    held = [(doc, terms(text)) for doc, text in docs]
    held = [(doc, t, {x: t.count(x) for x in set(t)}) for doc, t in held if t]
    total = sum(len(t) for _, t, _ in held)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    weight = {}
    for term in set().union(*wanted.values()):
        df = sum(term in c for *_, c in held)
        weight[term] = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df + 1)))
    out = {}
    for item, asked in wanted.items():
        scores = []
        for doc, t, c in held:
            m = 100 - 90 + (90 * len(t) * len(held)) // total
            s = sum(weight[x] * ((10**9 * c[x]) // (1000 * c[x] + 8 * m)) for x in asked if x in c)
            if s > 0:
                scores.append((-s, doc is None, doc if doc is not None else 0, doc))
        out[item] = [(-s, doc) for s, *_, doc in sorted(scores)[:k]]
    return {item: best for item, best in out.items() if best}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["score"], r["doc_id"]))
    assert all([rank for rank, *_ in best] == list(range(1, len(best) + 1)) for best in out.values())
    return {item: [(s, d) for _, s, d in best] for item, best in out.items()}


def corpus():
    rng = random.Random(13)
    words = [f"{c}{i}" for i in range(60) for c in "aé"] + ["The", "OF", "x", "7"]
    common = ["the", "of", "The"] * 30
    docs = [(i, rng.choice([" ", ", ", "_"]).join(rng.choices(words + common, k=rng.randrange(80)))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, "...!"), (303, "a1 " * 400), (304, docs[5][1]), docs[5], (None, docs[5][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(30)]
    items += [(40, docs[5][1]), (41, "unheard words"), (42, ""), (43, None), (None, "a1 é2"), (1, "a3, A4"), (44, "the of")]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus()
    left = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], "doc_id long, text string, item_id string, key int, n int")
    right = spark.createDataFrame([(i, t, 0, "y") for i, t in items], "item_id long, text string, doc_id int, term string")
    expected = brute(docs, items)
    assert answers(lexical.search(left.repartition(3), right)) == expected
    assert len(expected[None]) == 10 and 41 not in expected
    # Several blocks, and sketches in which nearly everything collides.
    monkeypatch.setattr(lexical, "TERMS", 40)
    monkeypatch.setattr(lexical, "LOAD", 1)
    assert answers(lexical.search(left.repartition(2), right, k=3)) == brute(docs, items, 3)


def test_sketch_bounds_every_score():
    docs, items = corpus()
    rows = [{"q": q, "term": t, "w": 7} for q, (_, text) in enumerate(items[:30]) for t in sorted(set(terms(text)))]
    block = lexical._Block(rows, 200, 9000)
    import numpy as np
    import pyarrow as pa

    texts = [t for _, t in docs if terms(t)] + ["a1 " * 1000 + "a2"]
    found = [lexical.counted(t) for t in texts]
    arrays = [np.array([lexical.crc32(x) for x in c], np.uint32) for c in found]
    sketches = [lexical.sketch(h, np.array(list(c.values()))).tobytes() for h, c in zip(arrays, found)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts))), pa.array([c.total() for c in found]), pa.array(sketches, pa.binary())], ["key", "n", "sketch"]
    )
    seen = 0
    for some, bounds in block.bounds(batch):
        for row, bound in zip(some.tolist(), bounds.tolist()):
            seen += 1
            exact = dict(block.scores(texts[row], list(range(30))))
            assert all(exact[q] <= bound[q] for q in range(30))
    assert seen == len(texts)


def test_long_text_is_read_whole():
    text = "Ab, é " * (SLICE // 4) + "last"
    assert lexical.counted(text) == {b"ab": SLICE // 4, "é".encode(): SLICE // 4, b"last": 1}
    assert lexical.counted("x" * (SLICE + 9) + " y") == {b"x" * (SLICE + 9): 1, b"y": 1}


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "Two one"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "one")], "item_id string, text string")
    assert [d for _, d in answers(lexical.search(docs, items))["q"]] == ["a", "b"]
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []


def test_query_matches_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op13_lexical_search"
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == ""
