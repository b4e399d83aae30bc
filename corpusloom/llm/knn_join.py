"""Exact top-k search by inner product: a Voronoi kNN join."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import cut

#: Pivots: about the root of the number of vectors, at most so many, and at most so many bytes of them. Their vectors, summaries of their cells and the plan (a row for a pair of cells, 30 MB at most) are what the driver holds and broadcasts.
PIVOTS, PIVOT_BYTES = 1024, 32 << 20
#: Bytes, as doubles, of the queries of a block, and of the data rows that one local search holds.
QUERY_BYTES, DATA_BYTES = 4 << 20, 16 << 20
#: Slack of the bounds, as a share of the largest norm, for rounding.
_EPS = 1e-6
_LONG = 2**63 - 1
SCHEMA = "query_id long, rank int, vec_id long, score long"


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(float) if rows else np.zeros((0, 0))


def kind_of(most: float) -> str:
    """The narrowest number that holds all components."""
    return "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, q): components floor(scale * x), whole numbers as doubles. Rows with a null id, a null or empty vector, or
    a component that is null or not finite (itself or scaled) take no part."""
    grown = lambda x: x.cast("double") * F.lit(float(scale))
    # floor gives a long; doubles from 2^52 on are whole already
    q = F.transform(F.col(vec_col), lambda x: F.when(F.abs(grown(x)) < F.lit(2.0**52), F.floor(grown(x)).cast("double")).otherwise(grown(x)))
    whole = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), q.alias("q"))
    return rows.where((F.size("q") > 0) & whole)


def _packed(kinds: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.asarray(x.values, float) for x in batch.column("q")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x) for x in rows], pa.int32()), pa.array([x.astype(kinds[len(x)]).tobytes() for x in rows], pa.binary())], names=["id", "width", "vec"])

    return run


def exact_products(query: np.ndarray, x: np.ndarray) -> list[int]:
    """Inner products of whole numbers of any size."""
    q = [int(v) for v in query]
    return [sum(a * int(b) for a, b in zip(q, row, strict=True)) for row in x]


def in_long(score: int) -> int:
    return max(-_LONG, min(_LONG, score))


def sortable(score: int) -> bytes:
    """Bytes in the order of the scores; products of doubles stay far below 2^2100."""
    return (score + (1 << 2100)).to_bytes(264, "big")


def best_of(query_id: int, query: np.ndarray, ids: np.ndarray, x: np.ndarray, about: np.ndarray, slack: np.ndarray | None, k: int) -> list[tuple[int, int]]:
    """(vec_id, score) of the `k` highest scores, ties to smaller ids. `about` are the scores: exact without `slack`,
    else to within it, and then those that may be among the best are computed anew in whole numbers."""
    own = ids == query_id
    low = np.where(own, -np.inf, about if slack is None else about - slack)
    top = np.partition(low, -k)[-k] if len(low) > k else -np.inf
    few = np.flatnonzero(((about if slack is None else about + slack) >= top) & ~own)
    score = [int(v) for v in about[few]] if slack is None else exact_products(query, x[few])
    return [(int(ids[few[i]]), s) for _, _, i, s in sorted((-s, ids[few[i]], i, s) for i, s in enumerate(score))[:k]]


def top_products(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` highest integer inner products of each query (ids divisible by
    `every`) over all other rows, ties to the smaller vec_id.

    A further coordinate sqrt(M^2 - |x|^2), M the largest norm, turns inner products into distances, and the join
    is a Voronoi kNN join: rows fall to their nearest pivot; each cell's summary has its count, its radii and its
    k + 1 smallest distances to the pivot, of different ids. From the summaries alone comes, for each cell of queries,
    an upper bound on the k-th distance, and by the triangle inequality which data can be nearer; only those are
    sent, to groups of query cells that make a block, in slices, each searched locally; slices' winners are merged.

    Vectors of different length cannot be compared, so those of each length are searched apart; null and empty
    vectors, and those with null or non-finite components, take no part. Components may be of any size: scores are
    exact; one beyond a long ranks by its value and is given as the nearest long. Fewer than k other rows give fewer results.
    Repeated ids: each row is a candidate, rows with the query's id are its own and no candidates, and the query is
    answered for the row with the smallest bytes. An empty table gives an empty result. Other columns are ignored.
    """
    rows = quantised(vectors, id_col, vec_col, scale)
    sizes = rows.select(F.size("q").alias("width"), F.array_max(F.transform("q", F.abs)).alias("most")).groupBy("width").agg(F.count("*").alias("n"), F.max("most").alias("most")).collect()
    kinds = {r["width"]: kind_of(r["most"]) for r in sizes}
    data = cut(rows.mapInArrow(_packed(kinds), "id long, width int, vec binary"))
    found = [_search(data.where(F.col("width") == r["width"]), r["width"], r["n"], r["most"], kinds[r["width"]], k, every, pivots) for r in sorted(sizes)]
    found = [x for x in found if x is not None]
    return reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], SCHEMA)


def _search(data: DataFrame, width: int, n: int, most: float, kind: str, k: int, every: int, pivots: int) -> DataFrame | None:
    """The search among vectors of one length."""
    spark = data.sparkSession
    m = max(1, min(pivots, PIVOT_BYTES // (8 * width), math.isqrt(n)))
    unit = 2.0 ** max(0, math.frexp(most)[1] - 400)  # keeps squares finite; a power of two, so without rounding
    chosen = [r["vec"] for r in data.orderBy(F.xxhash64("id", "vec"), "id", "vec").limit(m).collect()]
    p = np.frombuffer(b"".join(chosen), kind).reshape(len(chosen), -1).astype(float) / unit

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), kind) / unit
            yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(1).max())] if len(x) else [], pa.float64())], names=["n"])

    top = float(data.select("vec").mapInArrow(norms, "n double").agg(F.max("n")).first()[0])
    exact = unit == 1.0 and top < 2.0**53
    px = np.concatenate([p, np.sqrt(np.maximum(top - (p * p).sum(1), 0))[:, None]], 1)
    p2 = (px * px).sum(1)

    def to_pivots(x: np.ndarray, last: np.ndarray) -> np.ndarray:
        y = np.concatenate([x, last[:, None]], 1)
        return np.sqrt(np.maximum((y * y).sum(1)[:, None] + p2[None, :] - 2 * y @ px.T, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                x = matrix(batch.column("vec"), kind) / unit
                dist = to_pivots(x, np.sqrt(np.maximum(top - (x * x).sum(1), 0)))
                cell = dist.argmin(1)
                qdist = to_pivots(x, np.zeros(len(x)))
                near = qdist.argmin(1)
                row = np.arange(len(x))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(cell.astype(np.int32)), pa.array(dist[row, cell]), pa.array(near.astype(np.int32)), pa.array(qdist[row, near])], names=["id", "vec", "cell", "dist", "qcell", "qdist"])

    cells = cut(data.select("id", "vec").mapInArrow(assign, "id long, vec binary, cell int, dist double, qcell int, qdist double"))

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pd.DataFrame({"cell": np.zeros(0, np.int32), "id": np.zeros(0, np.int64), "dist": np.zeros(0)})
        for batch in batches:
            rows = pd.concat([best, pd.DataFrame({c: batch.column(c).to_numpy() for c in best.columns})])
            best = rows.sort_values(["cell", "dist", "id"]).drop_duplicates(["cell", "id"]).groupby("cell").head(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(best["cell"], pa.int32()), pa.array(best["id"], pa.int64()), pa.array(best["dist"], pa.float64())], names=["cell", "id", "dist"])

    # a row of each id: of k + 1 ids, one at most is the query's own
    near = cells.select("cell", "id", "dist").mapInArrow(smallest, "cell int, id long, dist double").groupBy("cell", "id").agg(F.min("dist").alias("dist"))
    near = near.withColumn("r", F.row_number().over(W.partitionBy("cell").orderBy("dist", "id"))).where(F.col("r") <= k + 1).drop("r").toPandas()
    summary = cells.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")).toPandas().sort_values("cell")
    queries = cells.where(F.col("id") % every == 0)
    queries = queries.groupBy("id").agg(F.min(F.struct("vec", "qcell", "qdist")).alias("q")).select("id", "q.*")
    asks = queries.groupBy("qcell").agg(F.count("*").alias("n"), F.max("qdist").alias("hi")).toPandas().sort_values("qcell")
    if not len(asks):
        return None
    between = np.sqrt(np.maximum(p2[:, None] + p2[None, :] - 2 * px @ px.T, 0))
    block, piece = max(1, QUERY_BYTES // (8 * width)), max(1, DATA_BYTES // (8 * width))
    # small query cells near to one another make a group of about a block of queries; large ones are cut into blocks
    start = int(asks["qcell"].iloc[0])
    order = np.lexsort((asks["qcell"], between[start, asks["qcell"]]))
    group, have, group_of = 0, 0, np.zeros(len(asks), np.int64)
    for c in order:
        if have and have + asks["n"].iloc[c] > block:
            group, have = group + 1, 0
        group_of[c], have = group, have + int(asks["n"].iloc[c])
    slack = _EPS * (top**0.5 + 1.0)
    s, lo, hi = (summary[c].to_numpy() for c in ("cell", "lo", "hi"))
    # for each query group and data cell: least and most distance to the data pivot
    low, high = np.full((group + 1, len(s)), np.inf), np.full((group + 1, len(s)), -np.inf)
    near_cell, near_id, near_dist = (near[c].to_numpy() for c in ("cell", "id", "dist"))
    for c, reach, g in zip(asks["qcell"], asks["hi"], group_of, strict=True):
        bound = between[c, near_cell] + near_dist + reach
        _, first = np.unique(near_id[(by := np.argsort(bound, kind="stable"))], return_index=True)
        first = np.sort(first)
        theta = float(bound[by[first[k]]]) if len(first) > k else math.inf
        least, farthest = between[c, s] - reach - theta - slack, between[c, s] + reach + theta + slack
        meets = (hi >= least) & (lo <= farthest)
        low[g, meets] = np.minimum(low[g, meets], least[meets])
        high[g, meets] = np.maximum(high[g, meets], farthest[meets])
    sends = low <= high
    asked = np.bincount(group_of, asks["n"].to_numpy(), group + 1)
    blocks = np.maximum(1, np.ceil(asked / block)).astype(int)
    slices = np.maximum(1, np.ceil((sends * summary["n"].to_numpy()).sum(1) / piece)).astype(int)
    g, at = np.nonzero(sends)
    rows = pd.DataFrame({"g": g.astype(np.int32), "cell": s[at].astype(np.int32), "low": low[g, at], "high": high[g, at], "blocks": blocks[g].astype(np.int32), "slices": slices[g].astype(np.int32)})
    plan = F.broadcast(spark.createDataFrame(rows, "g int, cell int, low double, high double, blocks int, slices int"))
    groups = pd.DataFrame({"qcell": asks["qcell"].astype(np.int32), "g": group_of.astype(np.int32), "blocks": blocks[group_of].astype(np.int32), "slices": slices[group_of].astype(np.int32)})
    groups = F.broadcast(spark.createDataFrame(groups, "qcell int, g int, blocks int, slices int"))
    # rows are dealt to slices one by one, so that those of one id spread too
    sent = cells.select("id", "vec", "cell", "dist", F.xxhash64(F.monotonically_increasing_id()).alias("deal")).join(plan, "cell").where("dist between low and high")
    sent = sent.select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod("deal", "slices").cast("int").alias("slice"), "id", "vec", F.lit(False).alias("asks"))
    asking = queries.join(groups, "qcell").select("g", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "id", "vec", F.lit(True).alias("asks"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        q, d = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        out = []
        if len(q) and len(d):
            x, ids = matrix(pa.array(d["vec"]), kind), d["id"].to_numpy()
            y = x / unit
            size = np.sqrt((y * y).sum(1))
            for at in range(0, len(q), 64):
                part = q.iloc[at : at + 64]
                ask = matrix(pa.array(part["vec"]), kind)
                score = (ask / unit) @ y.T
                for i, query in enumerate(part["id"].to_numpy()):
                    slack = None if exact else (size * np.sqrt(((ask[i] / unit) ** 2).sum())) * width * 2.0**-50 + 1e-290
                    out += [(query, j, in_long(v), None if exact else sortable(v)) for j, v in best_of(query, ask[i], ids, x, score[i], slack, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "wide"]).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})

    found = sent.unionByName(asking).groupBy("g", "block", "slice").applyInPandas(search, "query_id long, vec_id long, score long, wide binary")
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
