"""Exact top-k inner products by a Voronoi join: pivots group queries and data, bounds choose the groups that meet."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.llm.shared import Scratch, perhaps_in, ship

#: Rows sampled as pivots; a bound on what the driver and every executor hold.
PIVOTS = 64
#: Vectors of a packed block at most.
BLOCK = 1024
#: Blocks of a cell that stay together when it is dealt out over tasks.
TOGETHER = 16
#: Queries whose best candidates a task holds before it hands them on.
HELD = 100_000
BLOCKS = "cell int, block string, n int, radius double, worst double, dim int, ids binary, matrix binary"


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long.

    Rows without vec_id, without a vector, or with NULL or non-finite components are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite).select("vec_id", whole.alias("v"))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of dim columns; shorter vectors are filled with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: in doubles where no sum can pass 2**53, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _blocks(dim: int, pivots: np.ndarray, pivot_ids: np.ndarray, k: int, queries: bool):
    """A task's vectors by nearest pivot, packed into blocks with their radius; queries also with their worst k-th score
    among the pivots, a lower bound of their k-th score, since pivots are candidates."""
    square = (pivots.astype(np.float64) ** 2).sum(axis=1)

    def run(batches):
        waiting: dict[int, list] = {}

        def packed(cell):
            ids, rows, far, worst = (np.concatenate(x) for x in zip(*waiting.pop(cell), strict=True))
            for at in range(0, len(ids), BLOCK):
                s = slice(at, at + BLOCK)
                yield {
                    "cell": cell,
                    "block": f"{cell}-{ids[s][0]}-{ids[s][-1]}-{len(ids[s])}",
                    "n": len(ids[s]),
                    "radius": float(far[s].max()),
                    "worst": float(worst[s].min()),
                    "dim": dim,
                    "ids": ids[s].tobytes(),
                    "matrix": rows[s].tobytes(),
                }

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                ids = some.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
                rows = _matrix(some.column(1), dim)
                real = rows.astype(np.float64)
                apart = square - 2 * (real @ pivots.T.astype(np.float64)) + (real**2).sum(axis=1, keepdims=True)
                cells = apart.argmin(axis=1)
                # Rounding of the distance must never make a radius too small.
                far = np.sqrt(np.maximum(apart[np.arange(len(ids)), cells], 0)) * (1 + 1e-9) + 1e-3
                worst = np.full(len(ids), -np.inf)
                if queries and len(pivots) > k:
                    met = scores(rows, pivots).astype(np.float64)
                    met[ids[:, None] == pivot_ids[None, :]] = -np.inf
                    worst = np.partition(met, len(pivots) - k, axis=1)[:, len(pivots) - k]
                for cell in np.unique(cells).tolist():
                    mine = cells == cell
                    waiting.setdefault(cell, []).append((ids[mine], rows[mine], far[mine], worst[mine]))
                    if sum(len(x[0]) for x in waiting[cell]) >= BLOCK:
                        yield pa.RecordBatch.from_pylist(list(packed(cell)), schema=ARROW)
        for cell in list(waiting):
            yield pa.RecordBatch.from_pylist(list(packed(cell)), schema=ARROW)

    return run


ARROW = pa.schema(
    [
        ("cell", pa.int32()),
        ("block", pa.string()),
        ("n", pa.int32()),
        ("radius", pa.float64()),
        ("worst", pa.float64()),
        ("dim", pa.int32()),
        ("ids", pa.binary()),
        ("matrix", pa.binary()),
    ]
)


def _meetings(groups: list, cells: list, pivots: np.ndarray, k: int) -> list[tuple]:
    """(query cell, data cell, reach, slope, needed): a data block of radius r meets the group if
    reach + slope * r >= needed.

    For q within g of pivot p and x within r of pivot s: |q.x - p.s| <= g|s| + r|p| + g r. A group needs what may reach
    the k-th score it is sure of: that among the pivots, or by the lower bounds of cells that hold over k vectors.
    """
    real = pivots.astype(np.float64)
    norm, inner = np.sqrt((real**2).sum(axis=1)), real @ real.T
    out = []
    for g in groups:
        p, wide = g["cell"], g["radius"]
        sure, seen = g["worst"], 0
        low = sorted(((inner[p, c["cell"]] - wide * norm[c["cell"]] - c["radius"] * (norm[p] + wide), c["n"]) for c in cells), reverse=True)
        for bound, n in low:
            seen += n
            if seen > k:  # one of them may be the query itself
                sure = max(sure, bound)
                break
        margin = 1e-6 * (1 + abs(sure)) if np.isfinite(sure) else 0.0
        for c in cells:
            s = c["cell"]
            reach, slope = inner[p, s] + wide * norm[s], norm[p] + wide
            if reach + slope * c["radius"] >= sure - margin:
                out.append((p, s, float(reach), float(slope), float(sure - margin)))
    return out


def _best(k: int):
    """Runs over met blocks and keeps the k best of each query; ties go to the smaller vec_id."""
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        best: dict[int, tuple] = {}

        def hand_on():
            if best:
                ids = np.repeat(np.array(list(best), np.int64), [len(b[0]) for b in best.values()])
                found = [np.concatenate(x) for x in zip(*best.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found[0]), pa.array(found[1])], schema=out)
                best.clear()

        for batch in batches:
            for at in range(batch.num_rows):
                q_ids, q, d_ids, d = (np.frombuffer(batch.column(c)[at].as_py(), np.int64) for c in range(4))
                dim = len(q) // max(len(q_ids), 1)
                met = scores(q.reshape(-1, dim), d.reshape(-1, dim))
                for i, query in enumerate(q_ids.tolist()):
                    old_ids, old = best.get(query, (d_ids[:0], met[:0, 0]))
                    row = met[i]
                    if len(row) > k:
                        least = np.partition(row, len(row) - k - 1)[len(row) - k - 1]  # one more: the query itself
                        if len(old) == k:
                            least = max(least, old[-1])
                        mine = row >= least
                    else:
                        mine = np.ones(len(row), bool)
                    mine &= d_ids != query
                    ids, found = np.concatenate([old_ids, d_ids[mine]]), np.concatenate([old, row[mine]])
                    order = np.lexsort((ids, -found))[:k]
                    best[query] = ids[order], found[order]
                if len(best) > HELD:
                    yield from hand_on()
        yield from hand_on()

    return run


def one_of_each(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows (vec_id, v) with one row for each vec_id, that of the largest vector as arrays compare.

    Only ids move to find what is repeated, and only rows that may be repeated move to be told apart.
    """
    repeated = scratch.table(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "repeated")
    if repeated.isEmpty():
        return rows
    marked = perhaps_in(rows, repeated, "vec_id", "_perhaps")
    single = marked.where("_perhaps").groupBy("vec_id").agg(F.max("v").alias("v"))
    return scratch.table(marked.where("not _perhaps").select("vec_id", "v").union(single), "single")


def top_k(vectors: DataFrame, is_query: Column, k: int, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query with every other row.

    vectors has vec_id and v (array of long), see integer_vectors(); is_query marks the queries by these columns. Ties go to the smaller
    vec_id; a query with fewer than k other rows gets all of them. Rows that share a vec_id are one row (see
    one_of_each), so no neighbour stands twice. Shorter vectors count as filled with zeros; an empty table gives an
    empty result.

    Blocks of one cell are packed where they are read, so a cell that holds a third of all vectors is many blocks. Only
    blocks whose bound reaches a query group's sure k-th score are sent to it. Pivots and the cells' summaries have
    PIVOTS rows at most and are all that the driver sees.
    """
    ship(vectors.sparkSession)
    scratch = Scratch(vectors.sparkSession, "voronoi")
    vectors = vectors.withColumn("vec_id", F.col("vec_id").cast("long"))
    rows = one_of_each(vectors.select("vec_id", "v"), scratch)
    chosen = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).collect()
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    seen = {tuple(r["v"]): r["vec_id"] for r in chosen} or {(0,): 0}
    centres = _matrix(pa.array([list(v) for v in seen], pa.list_(pa.int64())), dim)
    centre_ids = np.array(list(seen.values()), np.int64)

    data = scratch.table(rows.mapInArrow(_blocks(dim, centres, centre_ids, k, False), BLOCKS), "data")
    asked = scratch.table(rows.where(is_query).mapInArrow(_blocks(dim, centres, centre_ids, k, True), BLOCKS), "queries")
    cells = data.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()
    groups = asked.groupBy("cell").agg(F.max("radius").alias("radius"), F.min("worst").alias("worst")).collect()
    meetings = vectors.sparkSession.createDataFrame(
        _meetings(groups, cells, centres, k), "q_cell int, d_cell int, reach double, slope double, needed double"
    )
    # Blocks of a cell are dealt out over parts, as many as the largest cell needs; queries go to each of them.
    parts = -(-max((c["n"] for c in cells), default=1) // (BLOCK * TOGETHER))
    q = asked.select(F.col("cell").alias("q_cell"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q"))
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part")
    d = data.select(F.col("cell").alias("d_cell"), part, "radius", F.col("ids").alias("d_ids"), F.col("matrix").alias("d"))
    sent = q.join(F.broadcast(meetings), "q_cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = sent.join(d, ["d_cell", "part"]).where("reach + slope * radius >= needed")
    found = met.select("q_ids", "q", "d_ids", "d").mapInArrow(_best(k), "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
