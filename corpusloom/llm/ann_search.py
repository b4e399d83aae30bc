"""Approximate nearest neighbours by cosine: cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ._common import cut
from ._vectors import components, profile, usable

#: Tables; signed axes that make a code, at most; and probes of a table, at most (but for one axis, where all may be).
TABLES, DIGITS, PROBES = 4, 3, 512
#: The index is fitted on the true neighbours of so many queries and on the codes of so many rows, chosen by hash.
FIT_QUERIES, FIT_ROWS = 128, 2000
#: Share of those neighbours that the fitted probes must find.
RECALL = 0.96
#: A probe costs as much as scoring so many rows.
PROBE_COST = 50
#: Bytes, as doubles, of the rows that one local search holds, and queries of a block.
PART_BYTES, BLOCK = 4 << 20, 1024
SCHEMA = "query_id long, rank int, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the rows, whose length is a power of two, kept at their norm."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


class Index(NamedTuple):
    """What tasks need to hash: the signs of each table's and digit's three flips, the digits of a code, the probes of a
    table, and the parts that buckets are dealt to."""

    width: int
    signs: np.ndarray
    digits: int = 1
    probes: int = 1
    parts: int = 1

    @staticmethod
    def make(width: int, tables: int = TABLES, seed: int = 7) -> Index:
        size = 1 << max(0, (width - 1).bit_length())
        return Index(width, np.random.default_rng(seed).choice([-1.0, 1.0], (tables, DIGITS, 3, size)))

    def rotated(self, u: np.ndarray, table: int, digit: int) -> np.ndarray:
        y = np.pad(u, ((0, 0), (0, self.signs.shape[3] - u.shape[1])))
        for flips in self.signs[table, digit]:
            y = hadamard(y * flips)
        return y

    def codes(self, u: np.ndarray, table: int) -> np.ndarray:
        """Each unit vector's nearest signed axes after the rotations, as one number."""
        out = np.zeros(len(u), np.int64)
        for digit in range(self.digits):
            y = self.rotated(u, table, digit)
            axis = np.abs(y).argmax(1)
            out = out * (2 * y.shape[1]) + 2 * axis + (y[np.arange(len(y)), axis] < 0)
        return out

    def probe_codes(self, u: np.ndarray, table: int) -> np.ndarray:
        """The codes to probe, the likeliest first: the squared lead of the nearest axis over the one probed, summed
        over the digits, is least. The t likeliest combine digits' ranks (from 1) whose product is at most t."""
        base, probes = 2 * self.signs.shape[3], min(self.probes, (2 * self.signs.shape[3]) ** self.digits)
        ranks = np.zeros((1, 0), np.int64)
        room = np.full(1, probes)
        for _ in range(self.digits):
            upto = np.minimum(room, base)
            ranks = np.concatenate([np.repeat(ranks, upto, 0), np.concatenate([np.arange(n) for n in upto])[:, None]], 1)
            room = np.repeat(room, upto) // (ranks[:, -1] + 1)
        cost, code = np.zeros((len(u), len(ranks))), np.zeros((len(u), len(ranks)), np.int64)
        for digit in range(self.digits):
            y = self.rotated(u, table, digit)
            lead = np.empty((len(u), base))
            lead[:, 0::2], lead[:, 1::2] = y, -y
            lead = (lead.max(1)[:, None] - lead) ** 2
            order = np.argsort(lead, 1, kind="stable")[:, : min(probes, base)]
            cost += np.take_along_axis(lead, order, 1)[:, ranks[:, digit]]
            code = code * base + order[:, ranks[:, digit]]
        best = np.argsort(cost, 1, kind="stable")[:, :probes]
        return np.take_along_axis(code, best, 1)

    def part(self, codes: np.ndarray, table: int) -> np.ndarray:
        """The part that a bucket of a table is dealt to."""
        x = codes.astype(np.uint64) * np.uint64(len(self.signs)) + np.uint64(table)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(self.parts)).astype(np.int32)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; that changes no cosine."""
    _, e = np.frexp(np.abs(x).max(1, initial=0.0))
    return np.ldexp(x, -e[:, None])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, in double precision on the original numbers; a pair's result does not depend on its neighbours."""
    q, x = scaled(q), scaled(x)
    return (q * x).sum(1) / (np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1)))


def matrix(rows: list[bytes], width: int) -> np.ndarray:
    """Packed vectors, of floats or doubles, as doubles."""
    kind = "<f4" if rows and len(rows[0]) == 4 * width else "<f8"
    return np.frombuffer(b"".join(rows), kind).astype(float).reshape(-1, width)


def _packed(width: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.tobytes() for r in (components(batch.column("v"), width) + 0.0).astype(kind)]  # -0.0 becomes 0.0
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary())], names=["id", "vec"])

    return run


def _nearest_of_few(width: int, few: np.ndarray, k: int):
    """The k nearest of a task's rows to each of a few unit vectors."""
    schema = pa.schema([("q", pa.int32()), ("score", pa.float64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, bytes]]] = [[] for _ in few]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                vecs = batch.column("vec").slice(at, 4096)
                score = few @ units(matrix(vecs.to_pylist(), width)).T
                top = np.argpartition(-score, k - 1, 1)[:, :k] if score.shape[1] > k else np.tile(np.arange(score.shape[1]), (len(few), 1))
                for i, row in enumerate(top):
                    best[i] = sorted(best[i] + [(float(score[i, j]), vecs[j].as_py()) for j in row.tolist()], reverse=True)[:k]
        out = [(i, s, v) for i, rows in enumerate(best) for s, v in rows]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def fit(distinct: DataFrame, index: Index, n: int, every: int, k: int, recall: float) -> Index:
    """`index` with the digits and probes that find, at the least work, `recall` of the true neighbours of a bounded
    sample of queries, found by scoring all rows against them. All buckets of one digit find everything, so there is
    always such a choice."""
    width = index.width
    asks = distinct.where(F.exists("ids", lambda i: i % every == 0)).orderBy(F.xxhash64("vec"), "rep").limit(FIT_QUERIES).select("vec").collect()
    if not asks:
        return index
    few = units(matrix([bytes(r["vec"]) for r in asks], width))
    by = W.partitionBy("q").orderBy(F.desc("score"), "vec")
    near = distinct.select("vec").mapInArrow(_nearest_of_few(width, few, k + 1), "q int, score double, vec binary")
    near = near.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1).where("r > 1 or score < 0.999999999999").collect()
    rows = distinct.orderBy(F.xxhash64("vec", F.lit(1)), "rep").limit(FIT_ROWS).select("vec").collect()
    sample = units(matrix([bytes(r["vec"]) for r in rows], width))
    if not near:
        return index
    asked = np.array([r["q"] for r in near])
    found = units(matrix([bytes(r["vec"]) for r in near], width))
    best: tuple[float, Index] | None = None
    for digits in range(1, DIGITS + 1):
        most = 2 * index.signs.shape[3] if digits == 1 else PROBES
        trial = index._replace(digits=digits, probes=most)
        rank, scanned = np.full(len(found), most), np.zeros(most)
        for table in range(len(index.signs)):
            probes = trial.probe_codes(few, table)
            theirs, all_codes = trial.codes(found, table), trial.codes(sample, table)
            for i, row in enumerate(probes):
                place = pd.Index(row)
                mine = asked == i
                hit = place.get_indexer(theirs[mine])
                rank[mine] = np.minimum(rank[mine], np.where(hit < 0, most, hit))
                hit = place.get_indexer(all_codes)
                scanned[: len(row)] += np.bincount(hit[hit >= 0], minlength=len(row))
        share = np.array([(rank <= t).mean() for t in range(most)])  # found by t + 1 probes
        work = scanned.cumsum() / (len(few) * len(sample)) * n + PROBE_COST * len(index.signs) * np.arange(1, most + 1)
        enough = np.flatnonzero(share >= recall)
        if len(enough) and (best is None or work[enough[0]] < best[0]):
            best = float(work[enough[0]]), trial._replace(probes=int(enough[0]) + 1)
    return best[1] if best else index._replace(digits=1, probes=2 * index.signs.shape[3])


def _parts(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                u = units(matrix(batch.column("vec").slice(at, 4096).to_pylist(), index.width))
                for table in range(len(index.signs)):
                    yield pa.RecordBatch.from_arrays([pa.array(index.part(index.codes(u, table), table))], names=["part"])

    return run


def _indexed(index: Index):
    schema = pa.schema([("part", pa.int32()), ("tab", pa.int32()), ("code", pa.int64()), ("rep", pa.binary()), ("ids", pa.list_(pa.int64())), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                u = units(matrix(batch.column("vec").to_pylist(), index.width))
                for table in range(len(index.signs)):
                    code = index.codes(u, table)
                    yield pa.RecordBatch.from_arrays([pa.array(index.part(code, table)), pa.array(np.full(len(u), table, np.int32)), pa.array(code), batch.column("rep"), batch.column("ids").cast(schema[4].type), batch.column("vec")], schema=schema)

    return run


def _probing(index: Index):
    """A row for each query and part that it probes, with the table and code of each probe there."""
    schema = pa.schema([("part", pa.int32()), ("rep", pa.binary()), ("tabs", pa.list_(pa.int32())), ("codes", pa.list_(pa.int64())), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, out = whole.slice(at, 256), []
                u = units(matrix(batch.column("vec").to_pylist(), index.width))
                codes = np.concatenate([index.probe_codes(u, t) for t in range(len(index.signs))], 1)
                tabs = np.repeat(np.arange(len(index.signs)), codes.shape[1] // len(index.signs))
                parts = np.stack([index.part(codes[:, i], int(t)) for i, t in enumerate(tabs)], 1)
                for rep, vec, code, part in zip(batch.column("rep").to_pylist(), batch.column("vec").to_pylist(), codes, parts, strict=True):
                    by = np.argsort(part, kind="stable")
                    edges = np.flatnonzero(np.diff(part[by], prepend=-1)).tolist() + [len(by)]
                    out += [(int(part[by[lo]]), rep, tabs[by[lo:hi]].tolist(), code[by[lo:hi]].tolist(), vec) for lo, hi in zip(edges, edges[1:])]  # noqa: B905
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _search(width: int, k: int):
    """Within a part: each query's k + 1 nearest ids in the buckets that it probes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asks, data = pdf[pdf["asks"]], pdf[~pdf["asks"]].sort_values(["tab", "code"])
        found = []
        if len(asks) and len(data):
            q, x = matrix(asks["vec"].tolist(), width), matrix(data["vec"].tolist(), width)
            uq, ux = units(q), units(x)
            bucket = pd.MultiIndex.from_arrays([data["tab"], data["code"]])
            edges = np.flatnonzero(~bucket.duplicated()).tolist() + [len(data)]
            starts = {bucket[lo]: (lo, hi) for lo, hi in zip(edges, edges[1:])}  # noqa: B905
            probed: dict[tuple[int, int], list[int]] = {}
            for i, (tabs, codes) in enumerate(zip(asks["tabs"], asks["codes"], strict=True)):
                for key in zip(tabs.tolist(), codes.tolist(), strict=True):
                    if key in starts:
                        probed.setdefault(key, []).append(i)
            for key, who in probed.items():
                lo, hi = starts[key]
                for some in np.array_split(np.array(who), -(-len(who) // 256)):
                    about = uq[some] @ ux[lo:hi].T
                    least = np.partition(about, -k - 1, 1)[:, -k - 1][:, None] - 1e-12 if hi - lo > k + 1 else -np.inf
                    i, j = np.nonzero(about >= least)
                    found.append(np.stack([some[i], j + lo], 1))
        if not found:
            return pd.DataFrame({"rep": np.zeros(0, object), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        pairs = np.unique(np.concatenate(found), axis=0)
        score = np.concatenate([cosines(q[p[:, 0]], x[p[:, 1]]) for p in np.array_split(pairs, -(-len(pairs) // 8192))])
        ids = data["ids"].to_numpy()[pairs[:, 1]]
        times = np.array([len(i) for i in ids])
        out = pd.DataFrame({"rep": np.repeat(asks["rep"].to_numpy()[pairs[:, 0]], times), "vec_id": np.concatenate(ids), "score": np.repeat(score, times)})
        out = out.sort_values(["rep", "score", "vec_id"], ascending=[True, False, True]).drop_duplicates(["rep", "vec_id"])
        return out.groupby("rep").head(k + 1)

    return run


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL, tables: int = TABLES) -> DataFrame:
    """query_id, rank, vec_id, score: of each query (ids divisible by `every`) the `k` rows of largest cosine that the
    index finds, ties to the smaller vec_id; scores are exact.

    A unit vector's code is its nearest signed axis after a pseudo-rotation by three sign flips and fast Hadamard
    transforms, or two or three such axes. Each table has its own rotations. A query looks into the buckets of its code
    and of the next likeliest ones. How many axes and probes, is fitted: the true neighbours of at most 128 queries,
    chosen by hash, are found by scoring all rows, and the least work that finds `recall` of them is taken. Every row is
    indexed. Buckets are dealt to parts of a bounded number of rows; a part with more, such as one hot bucket, is cut
    into slices, all of which each of its queries meets. So no bucket is capped.

    Equal vectors are one entry with their k + 1 smallest ids: of rows equally near, no others can be among the nearest.

    Vectors that are null, empty or zero, or have null or non-finite components, take no part, nor do rows without an id
    or of another length than the most frequent one (of equally frequent ones, the longest). A repeated id counts once,
    with its nearest vector; its queries are answered for the vector with the smallest bytes; rows with the query's id are its own. With fewer than k other
    ids found, fewer rows come. An empty table gives an empty result. Other columns are ignored."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_col, F.col(id_col).cast("long").alias("id")).where(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0))
    shape = profile(rows)
    if shape is None:
        return spark.createDataFrame([], SCHEMA)
    width = shape.width
    kind = "<f4" if isinstance(vectors.schema[vec_col].dataType.elementType, FloatType) else "<f8"
    rows = rows.where(F.size("v") == width).mapInArrow(_packed(width, kind), "id long, vec binary")
    same = W.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1)
    distinct = cut(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.unhex(F.md5("vec")).alias("rep"), "ids", "vec"))
    n = distinct.count()
    piece = max(1, PART_BYTES // (8 * width))
    index = fit(distinct, Index.make(width, tables), n, every, k, recall)
    index = index._replace(parts=max(1, -(-n * tables // piece)))
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"))
    queries = cut(queries.select(F.col("id").alias("query_id"), F.unhex(F.md5("vec")).alias("rep"), "vec"))
    asks = queries.groupBy("rep").agg(F.min("vec").alias("vec"))
    probing = asks.mapInArrow(_probing(index), "part int, rep binary, tabs array<int>, codes array<long>, vec binary")
    # parts that have more rows, or are asked more queries, than one search holds
    held = distinct.select("vec").mapInArrow(_parts(index), "part int").groupBy("part").agg(F.ceil(F.count("*") / F.lit(2 * piece)).cast("int").alias("slices")).where("slices > 1")
    asked = probing.groupBy("part").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks")).where("blocks > 1")
    plan = cut(held.join(asked, "part", "full").select("part", F.coalesce("slices", F.lit(1)).alias("slices"), F.coalesce("blocks", F.lit(1)).alias("blocks")))
    slices, blocks = F.coalesce("slices", F.lit(1)), F.coalesce("blocks", F.lit(1))
    every_of = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    none = lambda kind: F.lit(None).cast(kind)
    data = distinct.mapInArrow(_indexed(index), "part int, tab int, code long, rep binary, ids array<long>, vec binary").join(plan, "part", "left")
    data = data.select("part", F.pmod(F.xxhash64("rep"), slices).cast("int").alias("slice"), every_of(blocks).alias("block"), "rep", "tab", "code", "ids", none("array<int>").alias("tabs"), none("array<long>").alias("codes"), "vec", F.lit(False).alias("asks"))
    sent = probing.join(plan, "part", "left")
    sent = sent.select("part", every_of(slices).alias("slice"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"), "rep", none("int").alias("tab"), none("long").alias("code"), none("array<long>").alias("ids"), "tabs", "codes", "vec", F.lit(True).alias("asks"))
    found = data.unionByName(sent).groupBy("part", "slice", "block").applyInPandas(_search(width, k), "rep binary, vec_id long, score double")
    best = found.groupBy("rep", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    lists = best.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("all"))
    own = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = queries.select("query_id", "rep").join(lists, "rep").select("query_id", F.posexplode(own).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
