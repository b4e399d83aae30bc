"""Exact deduplication by a distributed content sort."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType, VariantType

from ._common import BLANKS, claim, clean_text, cut, give_back

#: Code points of the normalised text that lead the sort key; with the digest behind them a sampled splitter stays under 250 bytes.
HEAD = 32
_GONE = {ord(c): None for c in BLANKS}
FIRST, LAST = 1, 2


def normalised(text: Column) -> Column:
    """The text without any character of `[\\x20\\x09-\\x0D]`; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _sorted(rows: DataFrame, *ties: Column) -> DataFrame:
    """Range-partitioned by sampled splitters and sorted: by the normalised text, told by its first code points and the
    digest of all of it, then the longest original and the smallest id. Splitters look at all of that, so a group of
    any size spreads over many partitions."""
    keys = [F.col("head"), F.col("sha"), F.col("n").desc(), F.col("doc_id").asc_nulls_last(), *ties]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


class Runs:
    """Full comparison of each text with the one before it in the partition, of which only the place is held: where the
    digests differ, so do the texts. Different texts under one digest would lie mixed, so they stop the job."""

    def __init__(self) -> None:
        self.pid, self.seq, self.run = TaskContext.get().partitionId(), 0, 0
        self.sha: str | None = None
        self.column: pa.Array | None = None
        self.at, self.known = 0, None

    @property
    def text(self) -> str:
        """The normalised text of the last row."""
        return self.column[self.at].as_py().translate(_GONE)

    def starts(self, sha: str, column: pa.Array, at: int) -> bool:
        """Whether a run of equal texts starts with the row; `pos` and `run` are the numbers of the row and its run."""
        same = sha == self.sha
        before = (self.known or self.text) if same else None
        self.sha, self.column, self.at, self.known = sha, column, at, None
        if same:
            self.known = self.text
            if before != self.known:
                raise ValueError("two different texts share one SHA-256 digest")
        self.pos = (self.pid << 40) + self.seq
        self.seq += 1
        if not same:
            self.run = self.pos
        return not same


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs. The first and the last row of the partition carry their text, for the comparison across
    partitions."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("n_codepoints", pa.int32()), ("pos", pa.int64()), ("run", pa.int64()), ("pid", pa.int32()), ("place", pa.int32()), ("edge", pa.string())])
    claim("exact_dedup")
    runs, held = Runs(), []

    def send(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        out = held
        for at, (doc_id, sha, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "sha", "n")), strict=True)):
            first = runs.seq == 0
            runs.starts(sha, batch.column("norm"), at)
            out.append([doc_id, sha, n, runs.pos, runs.run, runs.pid, FIRST if first else 0, runs.text if first else None])
        held = out[-1:]
        if len(out) > 1:
            yield send(out[:-1])
    if held:
        held[0][6:] = held[0][6] | LAST, runs.text
        yield send(held)


def _going_on(edges: DataFrame) -> tuple[list[int], set[int]]:
    """The partitions that hold rows, and those of them whose first text is, compared in full, the last one of the
    partition before. `edges` has pid, place and edge of first and last rows: two for each partition at most."""
    pids = sorted(r[0] for r in edges.where(F.col("place").bitwiseAND(FIRST) > 0).select("pid").collect())
    before = F.broadcast(edges.sparkSession.createDataFrame(list(zip(pids[1:], pids, strict=False)), "pid int, was int"))
    first = edges.where(F.col("place").bitwiseAND(FIRST) > 0).select("pid", F.col("edge").alias("x")).join(before, "pid")
    last = edges.where(F.col("place").bitwiseAND(LAST) > 0).select(F.col("pid").alias("was"), F.col("edge").alias("y"))
    return pids, {r[0] for r in first.join(last, "was").where("x = y").select("pid").collect()}


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256, n_codepoints.

    Sampled splitters range-partition the rows by their normalised text, each partition is sorted externally, and
    neighbours are compared in full: a run of equal texts is a group, whose first row (the longest original text,
    then the smallest doc_id) stays. Runs that go on over partition borders are joined by comparing the border rows
    in full; what the driver holds of that are numbers, a few for each partition.

    Null text equals empty text. A null doc_id sorts last. Rows repeated with the same id and text form one
    group of which exactly one row is kept. Texts of any length are sorted by a bounded key. Invalid bytes of a text
    are read as U+FFFD. An empty table gives an empty result. Other columns are ignored.
    """
    text = clean_text(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text).alias("norm"), F.coalesce(F.length(text), F.lit(0)).alias("n"))
    rows = rows.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("sha", F.sha2("norm", 256))
    schema = "doc_id long, text_sha256 string, n_codepoints int, pos long, run long, pid int, place int, edge string"
    seen = cut(_sorted(rows).mapInArrow(_neighbours, schema))
    every = W.partitionBy("run")
    out = seen.select("doc_id", "text_sha256", "n_codepoints", "pos", "run").withColumn("group_size", F.count("*").over(every)).withColumn("keep_id", F.min_by("doc_id", "pos").over(every))
    kept = F.col("pos") == F.col("run")
    mended = _over_borders(seen)
    if mended:
        fix = seen.sparkSession.createDataFrame(mended, "run long, keep long, size long, goes_on boolean")
        out = out.join(F.broadcast(fix), "run", "left")
        there = F.col("size").isNotNull()
        out = out.withColumn("keep_id", F.when(there, F.col("keep")).otherwise(F.col("keep_id"))).withColumn("group_size", F.coalesce("size", "group_size"))
        kept = kept & ~F.coalesce("goes_on", F.lit(False))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "n_codepoints")


def _over_borders(seen: DataFrame) -> list[tuple]:
    """(run, keep_id, group_size, goes_on) of the runs of groups that span partitions: two for each partition at most."""
    edges = seen.where("place > 0").select("pid", "place", "run", "edge")
    pids, on = _going_on(edges)
    if not on:
        return []
    ends = {(r["pid"], bit): r["run"] for r in edges.select("pid", "place", "run").collect() for bit in (FIRST, LAST) if r["place"] & bit}
    root: dict[int, int] = {}
    for was, pid in zip(pids, pids[1:], strict=False):
        if pid in on:
            last = ends[was, LAST]
            root[ends[pid, FIRST]] = root.setdefault(last, last)
    few = F.broadcast(seen.sparkSession.createDataFrame([(r,) for r in root], "run long"))
    per = {r["run"]: r for r in seen.join(few, "run").groupBy("run").agg(F.count("*").alias("n"), F.min_by("doc_id", "pos").alias("id")).collect()}
    size: dict[int, int] = {}
    for run, top in root.items():
        size[top] = size.get(top, 0) + per[run]["n"]
    return [(run, per[top]["id"], size[top], run != top) for run, top in root.items()]


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run, whole; then a row that tells what text the partition ends with."""
    claim("exact_dedup")
    runs, kind = Runs(), None

    def send(rows: pa.Array, place: list[int], edge: list[str | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([rows, pa.array([runs.pid] * len(place), pa.int32()), pa.array(place, pa.int32()), pa.array(edge, pa.string())], names=["row", "pid", "place", "edge"])

    for batch in batches:
        kind, at_start = batch.column("row").type, runs.seq == 0
        mask = [runs.starts(sha, batch.column("body"), at) for at, sha in enumerate(batch.column("sha").to_pylist())]
        rows = batch.column("row").filter(pa.array(mask, pa.bool_()))
        place, edge = [0] * len(rows), [None] * len(rows)
        if at_start and len(rows):
            place[0], edge[0] = FIRST, (batch.column("body")[0].as_py()).translate(_GONE)
        yield send(rows, place, edge)
    if runs.column is not None:
        yield send(pa.nulls(1, kind), [LAST], [runs.text])
    del runs
    give_back()


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts (see `content_sort`), all its columns unchanged. The rows
    travel through the sort once, whole. Rows equal in id and text are told apart by a hash of their plain columns."""
    text = clean_text(text_col)
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, ArrayType | MapType | StructType | VariantType)]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("body"), F.coalesce(F.length(text), F.lit(0)).alias("n"), F.xxhash64(*plain).alias("tie"))
    rows = rows.withColumn("head", F.substring(normalised(F.col("body")), 1, HEAD)).withColumn("sha", F.sha2(normalised(F.col("body")), 256))
    schema = StructType([StructField("row", docs.schema), StructField("pid", IntegerType()), StructField("place", IntegerType()), StructField("edge", StringType())])
    ordered = _sorted(rows, F.col("tie")).select("row", "sha", F.col(f"row.`{text_col}`").alias("raw"))
    ordered = ordered.select("row", "sha", F.coalesce(clean_text("raw"), F.lit("")).alias("body"))
    firsts = cut(ordered.mapInArrow(_first_rows, schema))
    _, on = _going_on(firsts.where("place > 0").select("pid", "place", "edge"))
    gone = docs.sparkSession.createDataFrame([(p, FIRST) for p in on], "pid int, place int")
    return firsts.where("row is not null").join(F.broadcast(gone), ["pid", "place"], "left_anti").select("row.*")
