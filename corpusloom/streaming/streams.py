"""Structured Streaming variants: first-seen dedup, top-k, windowed scores, resume."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import random_key, text_hash
from ..operators.ordering import in_ranges


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """An unbounded file source."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_seen(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """Stateful dedup: one row of each normalised text; the state is a digest each."""
    return stream.withColumn("text_key", text_hash(text_col, 64)).dropDuplicates(["text_key"])


def first_seen_within(stream: DataFrame, ts: str, key: str, delay: str) -> DataFrame:
    """Dedup whose state ends with the watermark."""
    return stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay).dropDuplicatesWithinWatermark([key]).drop("_ts")


def score_windows(stream: DataFrame, ts: str, value: str, by: str, size: str = "1 hour", delay: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Counts and scores of tumbling or sliding windows, late rows up to the watermark."""
    t = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    w = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    return t.groupBy(w.alias("w"), by).agg(F.count("*").alias("rows"), F.avg(value).alias("mean"), F.max(value).alias("max")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "rows", "mean", "max")


def sessions(stream: DataFrame, ts: str, user: str, gap: str = "30 minutes", delay: str = "2 hours") -> DataFrame:
    t = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return t.groupBy(F.session_window("_ts", gap).alias("s"), user).agg(F.count("*").alias("rows")).select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "rows")


def running_top_k(stream: DataFrame, target: str, checkpoint: str, k: int, key: str, score: str | None = None, seed: int = 42) -> StreamingQuery:
    """T1, Q2 over a stream: the k highest scores so far (or a seeded uniform sample). Each batch merges its own
    best with the k kept before; a batch that runs again gives the same files."""
    from ..sources.readers import exists

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{target}/batch={number - 1}"
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(before)) if exists(spark, before) else batch
        order = [F.desc(score), F.col(key)] if score else [random_key(seed, key), F.col(key)]
        rows.dropDuplicates([key]).orderBy(*order).limit(k).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_order(df: DataFrame, path: str, rows: int, *order: str) -> None:
    """`df` as a folder that a file stream reads in the order given, one file a batch: ranges of the order of about `rows`
    rows, each one file, written one after another, as a stream takes files by their time. Rows equal in the order share
    a file."""
    t = in_ranges(df, *order)
    blocks: list[list[int]] = []
    for b, n in sorted((r["_b"], r["count"]) for r in t.groupBy("_b").count().collect()):
        if blocks and blocks[-1][2] + n <= rows:
            blocks[-1][1:] = [b, blocks[-1][2] + n]
        else:
            blocks.append([b, b, n])
    for first, last, _ in blocks or [[0, 0, 0]]:
        t.where(F.col("_b").between(first, last)).drop("_b").coalesce(1).write.mode("append").parquet(path)


def append_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """K10 over a stream: what is there is processed, and a later run goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def polite(stream: DataFrame, domain: str, url: str, arrived: str, delay: float) -> DataFrame:
    """(domain, url, arrived, fetch_at) of a frontier stream, times in seconds: when each address may be asked for, so
    that requests to one domain are `delay` apart: in order of arrival within a batch, then batch after batch. A domain's
    state is one number, when it is free again; its rows of one batch are sorted in one task, so batches should be bounded
    (see `in_order`)."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def schedule(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        free, times = state.get[0] if state.exists else -float("inf"), []
        rows = pd.concat([part[["url", "at"]] for part in parts]).sort_values(["at", "url"])  # parts come in no order
        for at in rows["at"]:
            times.append(max(at, free))
            free = times[-1] + delay
        yield pd.DataFrame({"domain": key[0], "url": rows["url"], "arrived": rows["at"], "fetch_at": times})
        state.update((free,))

    rows = stream.select(F.col(domain).alias("domain"), F.col(url).alias("url"), F.col(arrived).cast("double").alias("at"))
    out = "domain string, url string, arrived double, fetch_at double"
    return rows.groupBy("domain").applyInPandasWithState(schedule, out, "free double", "append", GroupStateTimeout.NoTimeout)
