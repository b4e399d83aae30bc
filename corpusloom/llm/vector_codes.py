"""Vector code compression: product codebooks by Lloyd rounds, assignment by Exponion search in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, discard
from ._vectors import components, profile, usable, whole

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Scaled components are held within this.
LIMIT = 1 << 53
#: Rows of a part that are searched together, those with one previous entry and like radii.
BLOCK = 256
_LONG = 2**63 - 1


def part_bounds(width: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Equal consecutive parts; where the length leaves a rest, the first parts are longer by one."""
    size, rest = divmod(width, parts)
    stops = [size * (i + 1) + min(i + 1, rest) for i in range(parts)]
    return list(zip([0, *stops[:-1]], stops, strict=True))


def number_kind(most: int, width: int) -> type:
    """Doubles where all squared distances, four times each, are whole doubles; else whole numbers of any size."""
    return float if 4 * width * (2 * most + 1) ** 2 < 2**53 else object


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y, exactly."""
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)


class Neighbours:
    """A part's codebook, with the entries of each entry's neighbourhood sorted by their distance to it."""

    def __init__(self, entries: np.ndarray, kind: type):
        self.entries = entries.astype(kind)
        gaps = squared(self.entries, self.entries)
        self.order = np.argsort(gaps, 1, kind="stable")
        self.near = np.take_along_axis(gaps, self.order, 1)

    def assign(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry, ties to the lower index; `start` is its previous entry.

        Exponion search: an entry farther from the previous one than twice the row's distance to that cannot be
        nearer, nor as near, by the triangle inequality. So only the sorted neighbours within this radius are
        scanned; squares are compared, so the bound is exact. Rows with one previous entry share its list, in blocks of
        like radii."""
        x = x.astype(self.entries.dtype)
        gap = x - self.entries[start]
        reach = 4 * (gap * gap).sum(1)
        index, least = np.zeros(len(x), np.int64), np.zeros(len(x), self.entries.dtype)
        by = np.lexsort((reach, start)) if reach.dtype != object else np.array(sorted(range(len(x)), key=lambda i: (start[i], reach[i])), np.int64)
        edges = np.flatnonzero(np.diff(start[by], prepend=-1)).tolist() + [len(by)]
        for lo, hi in zip(edges, edges[1:]):  # noqa: B905
            entry = start[by[lo]] if hi > lo else 0
            for at in range(lo, hi, BLOCK):
                rows = by[at : min(at + BLOCK, hi)]
                # in rising index, so that the first of equal distances has the lower one
                scan = np.sort(self.order[entry, : np.searchsorted(self.near[entry], reach[rows[-1]], "right")])
                dist = squared(x[rows], self.entries[scan])
                first = dist.argmin(1)
                index[rows], least[rows] = scan[first], dist[np.arange(len(rows)), first]
        return index, least


def _packed(width: int, scale: int):
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("x", pa.binary()), ("code", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(components(batch.column("v"), width), scale, LIMIT)
            code = bytes(PARTS)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([code] * len(x), pa.binary())], schema=schema)

    return run


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _assigned(width: int, books: list[np.ndarray], kind: type, final: bool):
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("x", pa.binary()), ("code", pa.binary()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [Neighbours(b, kind) for b in books]
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 4096):
                batch = whole_batch.slice(at, 4096)
                x, before = _matrix(batch.column("x"), "<i8", width), _matrix(batch.column("code"), "u1", PARTS)
                found = [n.assign(x[:, lo:hi], before[:, p].astype(np.int64)) for p, (n, (lo, hi)) in enumerate(zip(near, part_bounds(width), strict=True))]
                code = np.stack([i for i, _ in found], 1).astype(np.uint8)
                error = [min(int(e), _LONG) for e in reduce(np.add, [d for _, d in found])]
                kept = pa.nulls(batch.num_rows, pa.binary()) if final else batch.column("x")
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), kept, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error, pa.int64())], schema=schema)

    return run


def _sums(width: int):
    """Of each part, entry and position of a task's rows: how many rows, and their sum."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("position", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = part_bounds(width)
        count = np.zeros((PARTS, ENTRIES), np.int64)
        total = [np.zeros((ENTRIES, hi - lo), object) for lo, hi in bounds]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):  # so many longs within LIMIT add up to a long
                part = batch.slice(at, 512)
                x, code = _matrix(part.column("x"), "<i8", width), _matrix(part.column("code"), "u1", PARTS)
                for p, (lo, hi) in enumerate(bounds):
                    by = np.argsort(code[:, p], kind="stable")
                    entry, first, n = np.unique(code[by, p], return_index=True, return_counts=True)
                    count[p, entry] += n
                    if hi > lo:
                        total[p][entry] += np.add.reduceat(x[by, lo:hi], first, 0).astype(object)
        for p, (lo, hi) in enumerate(bounds):
            entry, position = (a.ravel() for a in np.meshgrid(np.flatnonzero(count[p]), np.arange(hi - lo), indexing="ij"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(entry), p, np.int32)), pa.array(entry.astype(np.int32)), pa.array(position.astype(np.int32)), pa.array(count[p][entry]), pa.array([Decimal(int(t)) for t in total[p][entry, position]], schema[4].type)], schema=schema)

    return run


def updated(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Each entry becomes floor(sum / count) of its rows' components; entries without rows stay."""
    sums = rows.select("x", "code").mapInArrow(_sums(width), "part int, entry int, position int, n long, s decimal(38,0)").groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    books = [b.copy() for b in books]
    for r in sums.collect():  # at most ENTRIES entries of the vectors' length
        books[r["part"]][r["entry"], r["position"]] = int(r["s"]) // r["n"]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def learn_and_encode(vectors: DataFrame, scale: int = 1024, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): id, label, code (a byte a part), error of each row that takes part, and each part's final
    codebook. See `compress` for the rules."""
    label = F.col(label_col).cast("string") if label_col in vectors.columns else F.lit(None).cast("string")
    rows = usable(vectors, vec_col, F.col(id_col).cast("long").alias("id"), label.alias("label"))
    shape = profile(rows)
    if shape is None:
        return vectors.sparkSession.createDataFrame([], "id long, label string, code binary, error long"), []
    width = shape.width
    state = cut(rows.where(F.size("v") == width).mapInArrow(_packed(width, scale), "id long, label string, x binary, code binary"))
    first = state.where("id is not null").orderBy("id", "x").select("x").limit(ENTRIES).collect()
    if not first:  # no row has an id: the smallest vectors begin
        first = state.orderBy("x").select("x").limit(ENTRIES).collect()
    start = np.frombuffer(b"".join(r["x"] for r in first), "<i8").reshape(-1, width)
    books = [start[:, lo:hi].copy() for lo, hi in part_bounds(width)]
    kind = number_kind(int(min(shape.most * scale + 1, LIMIT)), width)
    out = "id long, label string, x binary, code binary, error long"
    for _ in range(rounds):
        last, state = state, cut(state.select("id", "label", "x", "code").mapInArrow(_assigned(width, books, kind, False), out))
        discard(last)
        books = updated(state, books, width)
    done = cut(state.select("id", "label", "x", "code").mapInArrow(_assigned(width, books, kind, True), out).drop("x"))
    discard(state)
    return done, books


def compress(vectors: DataFrame, scale: int = 1024, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: vectors, as whole numbers floor(scale * x), in four parts, each
    replaced by the index of the nearest of the part's 256 entries.

    Codebooks begin as the parts of the 256 smallest ids' vectors and are bettered in `rounds` rounds: every part goes
    to its nearest entry (ties to the lower index), every entry becomes its parts' floored mean. The assignments are
    kept from round to round, so each row's search starts at its previous entry; before the first round that is entry 0.

    Rows whose vector is null or empty, or has null or non-finite components, take no part; nor do those of another
    length than the most frequent one (of equally frequent ones, the longest). A length that four does not divide gives
    the first parts one component more. Fewer than 256 rows make smaller codebooks. Rows with a null id are coded but
    begin no codebook, unless no row has an id; of equal ids the smaller vector's bytes come first. Scaled components
    beyond 2^53 count as 2^53, sums of errors beyond a long as the largest long. Null labels are one label, so is a
    missing column. An empty table gives an empty result. Other columns are ignored."""
    rows, books = learn_and_encode(vectors, scale, rounds, id_col, vec_col, label_col)
    most = F.lit(_LONG).cast("decimal(38,0)")
    of_label = rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most).cast("long").alias("label_error"))
    joined = rows.alias("r").join(of_label.alias("l"), F.col("r.label").eqNullSafe(F.col("l.label")))
    return joined.select(F.col("r.id").alias("vec_id"), F.lower(F.hex("r.code")).alias("code"), F.col("r.error").alias("error"), "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
