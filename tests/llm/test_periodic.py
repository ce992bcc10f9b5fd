import random
import time

import numpy as np
from contract import compare, connect

from coffer.llm import periodic, queries


def brute(words):
    """(start, length, period) of all runs, from every period's agreement with itself."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            if y - x + q >= max(6, 4 * q):
                found.setdefault((x, y - x + q), q)
            x = y
    return sorted((s, length, q) for (s, length), q in found.items())


def sorted_runs(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(12)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 400, list("ab") * 4, list("ab") * 3 + ["a"], list("abc") * 30 + list("ab")]
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    out += [list(fib[-1]), list("ab" * 5 + "a") * 5, (["x"] * 7 + ["y"]) * 6, list("abab" * 3 + "c") * 4]
    for _ in range(120):
        letters = "abcdefgh"[: rng.randrange(1, 9)]
        w = rng.choices(letters, k=rng.randrange(60))
        for _ in range(rng.randrange(4)):
            piece = rng.choices(letters, k=rng.randrange(1, 12))
            at = rng.randrange(len(w) + 1)
            w[at:at] = piece * rng.randrange(3, 9) + piece[: rng.randrange(len(piece))]
        out.append(w)
    return out + out[5:20]


def test_runs_against_brute_force():
    rows = sequences()
    names = {w: i for i, w in enumerate(sorted({w for r in rows for w in r}))}
    words = np.array([names[w] for r in rows for w in r], np.int32)
    offsets = np.cumsum([0] + [len(r) for r in rows])
    got = [[] for _ in rows]
    for row, *run in zip(*(x.tolist() for x in periodic.find_runs(words, offsets))):
        got[row].append(tuple(run))
    assert got == [sorted_runs(brute(r)) for r in rows]
    assert sum(map(len, got)) > 100


def test_common_extension_both_ways():
    rng = random.Random(1)
    piece = rng.choices(range(4), k=90)
    text = np.array([9, *piece, 7, *piece, *piece, *([1] * 60), *piece, 8])
    levels = periodic.grammar(text)
    back, n = periodic.mirror(levels), len(text)
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(1, n - 1) for j in range(1, n - 1, 7) if i != j]))
    ahead = periodic.common_extension(levels, a, b)
    behind = periodic.common_extension(back, n - 1 - a, n - 1 - b)
    text = text.tolist()
    for i, j, f, r in zip(a.tolist(), b.tolist(), ahead.tolist(), behind.tolist()):
        k = 0
        while i + k < n and j + k < n and text[i + k] == text[j + k]:
            k += 1
        m = 0
        while m <= i and m <= j and text[i - m] == text[j - m]:
            m += 1
        assert (f, r) == (k, m)


def test_table_of_odd_rows(spark):
    spaces = [" ", "\n", "\t ", "\v", "\f\r"]
    rng = random.Random(4)
    rows = sequences()
    docs = [(i, "".join(w + rng.choice(spaces) for w in r), "x", 1) for i, r in enumerate(rows)]
    docs += [(900, None, "x", 1), (901, "  \n", "x", 1), (902, "é\x1c é\x1c é\x1c é\x1c é\x1c é\x1c e", "x", 1), (None, "b b b b b b b", "x", 1), docs[9], docs[9]]
    df = spark.createDataFrame(docs, "doc_id int, text string, runs string, start int").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.collapsed(df).collect()), key=repr)
    expected = []
    for doc, text, *_ in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = sorted_runs(brute(words))
        expected.append((doc, len(words), runs, collapse(words, runs)))
    assert got == sorted(expected, key=repr)
    assert periodic.collapsed(df.limit(0)).collect() == []


def test_long_and_hostile_texts():
    rng = random.Random(9)
    block = rng.choices(range(50_000), k=30_000)
    started = time.time()
    rows = [np.zeros(200_000, int), np.array(block * 5), np.tile([0, 1], 100_000), np.array(rng.choices(range(2), k=150_000))]
    row, start, length, q = periodic.find_runs(np.concatenate(rows), np.cumsum([0] + [len(r) for r in rows]))
    first = [tuple(x) for x in zip(start[row < 3].tolist(), length[row < 3].tolist(), q[row < 3].tolist())]
    assert first == [(0, 200_000, 1), (0, 150_000, 30_000), (0, 200_000, 2)]
    assert time.time() - started < 60


def test_query_matches_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op12_periodic_runs"
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == ""
