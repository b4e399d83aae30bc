"""Byte-balanced sharding of indivisible groups by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import bucket_of, cut

#: Groups that one differencing task holds, and partial partitions that the driver combines at the end.
CHUNK = 20_000
#: Rows that one numbering task sorts.
SLOT_ROWS = 100_000


def difference(partials: Sequence[Sequence[int]], shards: int) -> tuple[list[list[int]], list[int]]:
    """Karmarkar-Karp: combine the two partial partitions with the largest spread, the one's largest part with
    the other's smallest, until one is left. Returns for each partial the final part of each of its parts, and
    the final sums."""
    sums: list[list[int]] = []
    origin: list[tuple] = []
    heap: list[tuple[int, int]] = []

    def add(parts: list[tuple[int, int]], *made: object) -> None:
        """parts: (sum, part of what it is made from); kept with the largest sum first."""
        parts.sort(key=lambda x: -x[0])
        sums.append([x[0] for x in parts])
        origin.append((*made, [x[1] for x in parts]))
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], len(sums) - 1))

    for one in partials:
        add([(x, i) for i, x in enumerate(one)])
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        add([(x + y, i) for i, (x, y) in enumerate(zip(sums[a], reversed(sums[b]), strict=True))], a, b)
    final: list[list[int] | None] = [None] * len(sums)
    if sums:
        final[-1] = list(range(shards))
    for node in range(len(sums) - 1, -1, -1):
        *made, order = origin[node]
        where = [0] * shards  # of the part before sorting
        for place, i in enumerate(order):
            where[i] = final[node][place]
        if made:
            a, b = made
            final[a], final[b] = where, where[::-1]
        else:
            final[node] = where
    return [x for x in final[: len(partials)]], sums[-1] if sums else [0] * shards


def _deal(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True])
        empty = [0] * (shards - 1)
        parts, _ = difference([[int(x), *empty] for x in pdf["bytes"]], shards)
        return pdf.assign(part=[x[0] for x in parts])[["key", "chunk", "part", "bytes"]]

    return run


def _combine(shards: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        parts, total = difference(pdf["sums"].map(list).tolist(), shards)
        up = int(pdf["up"].iloc[0])
        return pd.DataFrame({"chunk": pdf["chunk"], "up": up, "moved": parts, "total": [total] * len(pdf)})

    return run


def spread_groups(groups: DataFrame, shards: int, chunk_rows: int = CHUNK) -> DataFrame:
    """(key, shard) of `groups` (key string, bytes long): random chunks are differenced where they are, then
    their partial partitions are combined, many at a time, until the driver holds at most `chunk_rows`."""
    count = groups.count()
    chunks = max(1, -(-count // chunk_rows))
    dealt = groups.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("long"))
    parts = cut(dealt.groupBy("chunk").applyInPandas(_deal(shards), "key string, chunk long, part int, bytes long"))
    level = parts.groupBy("chunk").agg(*(F.sum(F.when(F.col("part") == i, F.col("bytes")).otherwise(0)).alias(f"s{i}") for i in range(shards)))
    level = level.select("chunk", F.array(*(f"s{i}" for i in range(shards))).alias("sums"))
    steps = []
    while chunks > 1:
        fewer = -(-chunks // chunk_rows) if chunks > chunk_rows else 1
        up = cut(level.withColumn("up", F.pmod("chunk", F.lit(fewer))).groupBy("up").applyInPandas(_combine(shards), "chunk long, up long, moved array<int>, total array<long>"))
        steps.append(up.select("chunk", "up", "moved"))
        level = up.groupBy(F.col("up").alias("chunk")).agg(F.first("total").alias("sums"))
        chunks = fewer
    placed = parts.select("key", "chunk", "part")
    for step in steps:
        placed = placed.join(step, "chunk").select("key", F.col("up").alias("chunk"), F.element_at("moved", F.col("part") + 1).alias("part"))
    return placed.select("key", F.col("part").alias("shard"))


def number_within(rows: DataFrame, group: str, key: str, ties: Sequence[str], name: str, total: int, per_task: int = SLOT_ROWS) -> DataFrame:
    """`rows` with a gapless number from 0 within each `group`, in the order of the 64-bit hash `key`: hash
    ranges are counted first, so a group's rows are numbered by many tasks."""
    buckets = max(1, -(-total // per_task))
    rows = rows.withColumn("_b", bucket_of(F.col(key), buckets))
    before = W.partitionBy(group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy(group, "_b").agg(F.count("*").alias("_n")).select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy(group, "_b").orderBy(key, *ties))
    return rows.withColumn("_r", within).join(starts, [group, "_b"]).withColumn(name, F.col("_start") + F.col("_r") - 1).drop("_b", "_r", "_start")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", chunk_rows: int = CHUNK) -> DataFrame:
    """Rows of `docs` in shards 0..shards-1 with near equal bytes; rows of equal texts share a shard.

    Columns: doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 (null: that of no bytes, 0), law
    ('bytes'), shard, slot (gapless from 0), grown_shard (null). Null texts form one group, apart from the empty
    text. One group may outweigh a shard's share; it still stays whole. An empty table gives an empty result.
    Repeated rows get slots of their own. Other columns are ignored.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("key"),
    )
    rows = cut(rows)
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    put = spread_groups(groups, shards, chunk_rows)
    placed = rows.join(put, "key").withColumn("_h", F.xxhash64("doc_id", "key"))
    placed = number_within(placed, "shard", "_h", ["doc_id"], "slot", rows.count())
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
