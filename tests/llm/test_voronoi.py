import random

from contract import compare, connect
from pyspark.sql import functions as F

from coffer.llm import queries, voronoi


def brute(rows, queries_, k):
    out = set()
    for q, v in rows:
        if queries_(q):
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best[:k])}
    return out


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-3, 4) for _ in range(4)]) for i in range(300)]
    rows += [(i, [2, 2, 2, 2]) for i in range(300, 420)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, v array<long>, score string").repartition(3)
    for pivots in (1, 16):
        got = voronoi.top_k(df, F.col("vec_id") % 20 == 0, 5, pivots)
        assert {tuple(r) for r in got.collect()} == brute(rows, lambda q: q % 20 == 0, 5)


def test_fewer_rows_than_k_long_numbers_and_short_vectors(spark):
    rows = [(0, [2**40, 1]), (1, [2**20, -1]), (2, [5])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    full = [(i, (v + [0])[:2]) for i, v in rows]
    assert {tuple(r) for r in voronoi.top_k(df, F.lit(True), 5).collect()} == brute(full, lambda q: True, 5)
    assert voronoi.top_k(df.limit(0), F.lit(True), 5).collect() == []


def test_what_takes_part(spark):
    rows = [(0, [0.5, -0.001]), (1, None), (2, [1.0, None]), (3, [float("nan"), 0.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]), (5, [0.999, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, v int")
    assert sorted(tuple(r) for r in voronoi.integer_vectors(df).collect()) == [(0, [128, -1]), (5, [255, 0])]


def test_query_matches_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op5_voronoi_knn"
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == ""


def test_repeated_rows_are_one_row(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(-9, 10) for _ in range(3)]) for i in range(80)]
    twice = rows + rows[:30] + [(4, [-100, -100, -100]), (20, rows[20][1])]
    df = spark.createDataFrame(twice, "vec_id long, v array<long>").repartition(3)
    got = [tuple(r) for r in voronoi.top_k(df, F.col("vec_id") % 20 == 0, 5, 8).collect()]
    assert sorted(got) == sorted(brute(rows, lambda q: q % 20 == 0, 5))


def test_cells_dealt_out_over_parts(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "TOGETHER", 1)
    monkeypatch.setattr(voronoi, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-3, 4) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(2)
    got = voronoi.top_k(df, F.col("vec_id") % 20 == 0, 5, 2)
    assert {tuple(r) for r in got.collect()} == brute(rows, lambda q: q % 20 == 0, 5)
