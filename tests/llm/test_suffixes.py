import random

import numpy as np

from coffer.llm import rolling, suffixes

N = suffixes.LENGTH


def brute(docs):
    """doc: (bytes kept, maximal removed runs)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        data = (text or "").encode()
        marks, own = np.zeros(len(data) + 1, bool), [data[i : i + N] for i in range(len(data) - N + 1)]
        for i, s in enumerate(own):
            if s in seen:
                marks[i : i + N] = True
        seen.update(own)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], marks]).astype(int)))
        kept = bytes(b for b, m in zip(data, marks) if not m)
        out[doc] = kept, list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    return out


def corpus():
    rng = random.Random(8)
    text = lambda n, letters="abcdefghij é": "".join(rng.choices(letters, k=n))
    shared = [text(n) for n in (49, 50, 51, 60, 83, 120, 400)]
    docs = [text(rng.randrange(300)) + rng.choice(shared) + text(rng.randrange(60)) + rng.choice(shared) for _ in range(60)]
    docs += ["a" * 49, "a" * 50, "a" * 200, "ab" * 90, "ab" * 20, "Restin. " * 60, "Restin. " * 40 + shared[3], "", docs[0], docs[0] + "!"]
    near = list(text(900))
    for _ in range(6):
        docs.append("".join(near))
        near[rng.randrange(900)] = "#"
    rng.shuffle(docs)
    return [(i, d) for i, d in enumerate(docs)] + [(500, None)]


def test_against_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, kept string").repartition(3)
    got = {r["doc_id"]: (bytes(r["kept"]), list(zip(r["starts"], r["ends"]))) for r in suffixes.without_repeats(df).collect()}
    assert got == brute(docs)


def test_text_longer_than_a_stretch(spark):
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefgh ", k=rolling.SLICE + 5000))
    piece = long[rolling.SLICE - 70 : rolling.SLICE + 70]
    docs = [(1, "x" + piece), (2, long), (3, long[100:160] + "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (bytes(r["kept"]), list(zip(r["starts"], r["ends"]))) for r in suffixes.without_repeats(df).collect()}
    assert got == brute(docs)


def test_nameless_repeated_and_carried(spark):
    text = "é" + "".join(random.Random(1).choices("abcdefgh", k=80))
    df = spark.createDataFrame([(None, text, 1), (7, text, 2), (7, text, 3), (9, "É" + text[1:], 4)], "doc_id long, text string, doc int")
    rows = sorted(suffixes.without_repeats(df, ("doc",), as_text=True).collect(), key=lambda r: r["doc"])
    assert [(r["doc_id"], r["doc"], r["kept"]) for r in rows] == [(None, 1, text), (7, 2, text), (7, 3, text), (9, 4, "É")]
    assert suffixes.without_repeats(df.limit(0)).collect() == []
