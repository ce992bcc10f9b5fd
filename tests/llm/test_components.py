from coffer.llm.components import connected_components
from coffer.llm.shared import Scratch


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r["node"]: r["component"] for r in connected_components(df, Scratch(spark, "test")).collect()}


def test_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(8, 30)]
    ring = [(50, 51), (51, 52), (52, 50)]
    got = found(spark, chain + star + ring + [(3, 3), (None, 4), (51, 50)])
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 30)}, 50: 50, 51: 50, 52: 50}


def test_no_edges(spark):
    assert found(spark, []) == {}
