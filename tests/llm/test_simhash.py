import random

import numpy as np
import xxhash

from coffer.llm import queries, simhash
from coffer.llm.rolling import SLICE

SCHEMA = "doc_id long, text string, point long, cell string, component int"


def fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Smallest doc_id reachable, by comparing everything with everything."""
    label = list(range(len(prints)))
    bits = [p for _, p in prints]
    changed = True
    while changed:
        changed = False
        for i in range(len(bits)):
            for j in range(len(bits)):
                if (bits[i] ^ bits[j]).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    groups = {}
    for (doc, _), x in zip(prints, label):
        groups.setdefault(x, []).append(doc)
    least = {x: min((d for d in docs if d is not None), default=None) for x, docs in groups.items()}
    return [least[x] for x in label]


def corpus():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdeÉé", k=rng.randrange(1, 5)))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(80)]
    base = [word() for _ in range(300)]
    for _ in range(60):
        near = list(base)
        for _ in range(rng.randrange(4)):
            near[rng.randrange(300)] = word()
        texts.append(" ".join(near))
    return texts + [texts[0].upper().replace("É", "É"), texts[0].replace(" ", "\t\n "), "", " \v\f ", "a", "A b", "x\x1cy z"]


def test_against_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(corpus())] + [(500, None), (None, corpus()[3]), (None, "only here without a name"), (7, "a")]
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs], SCHEMA).repartition(3)
    prints = [(d, fingerprint(t)) for d, t in docs]
    expected = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute(prints))), key=repr)
    for block in (simhash.BLOCK, 3):
        found = simhash.near_duplicates(df, block=block).withColumn("fingerprint", simhash.as_hex("fingerprint"))
        assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert len({c for *_, c in expected}) < len({p for _, p, _ in expected})


def test_grid_finds_every_link(spark):
    rng = random.Random(5)
    points = {rng.getrandbits(64) for _ in range(60)}
    for p in list(points):
        for _ in range(6):
            points.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    signed = np.array(sorted(points), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "point long")
    found = {frozenset(r) for r in simhash.links(df).collect()}
    label = {p: p for p in signed}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in found:
        label[root(a)] = root(b)
    near = [(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert all(root(a) == root(b) for a, b in near)
    assert len(found) < len(near)


def test_crowded_cell_gives_a_tree(spark):
    points = np.array([1 << 40 | 1 << b for b in range(40)], np.uint64)
    a, b = simhash._joined(points, points, 3)
    assert len(a) < 2 * len(points)
    assert set(b.tolist()) == {int(points[0])}


def test_long_text_is_read_whole():
    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(SLICE // 5))
    assert len(text) > SLICE + 1000
    words = text.split()
    whole = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    assert np.concatenate(list(simhash.shingle_hashes(text.encode(), 3))).tolist() == whole
    assert np.concatenate(list(simhash.shingle_hashes(b"x" * (2 * SLICE) + b" y", 3))).tolist() == [
        xxhash.xxh64_intdigest(b"x" * (2 * SLICE) + b" y", 42)
    ]


def test_text_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b", "one two three four"), ("a", "one two  three four"), ("c", "")], "doc_id string, text string")
    rows = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert rows == {"a": "a", "b": "a", "c": "c"}
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_query_gives_every_document(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    prints = [(d, fingerprint(t)) for d, t in docs]
    got = queries.QUERIES["op11_simhash"](spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(tuple(r) for r in got) == sorted((d, f"{p:016x}", c) for (d, p), c in zip(prints, brute(prints)))
