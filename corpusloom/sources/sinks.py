"""Sinks (K1-K12)."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K1: JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.mode(mode).json(path)


def write_report(spark: SparkSession, path: str, payload: Mapping[str, Any]) -> None:
    """K2: a small report as pretty JSON with sorted keys."""
    write_text(spark, path, json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")


def report_of(sections: Mapping[str, DataFrame], most: int = 10_000) -> dict[str, list[dict[str, Any]]]:
    """Sections of aggregates for K2 and K4. A section of more than `most` rows is no report but a table to be written,
    so it fails."""
    out = {}
    for name, df in sections.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"section {name} has more than {most} rows: write it as a table")
        out[name] = [r.asDict(recursive=True) for r in rows]
    return out


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """K3: one file, for small tables."""
    df.select(*(columns or df.columns)).coalesce(1).write.mode(mode).option("header", True).csv(path)


def markdown(title: str, sections: Mapping[str, Sequence[Mapping[str, Any]]]) -> str:
    """K4."""
    out = [f"# {title}", ""]
    for name, rows in sections.items():
        out += [f"## {name}", ""]
        if rows:
            cols = list(rows[0])
            out += ["| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
            out += ["| " + " | ".join(str(r.get(c, "")).replace("|", "\\|").replace("\n", " ") for c in cols) + " |" for r in rows]
        out.append("")
    return "\n".join(out)


def fingerprint(df: DataFrame) -> str:
    """K5: of the rows, whatever their order: sums of row hashes, which combine before any shuffle."""
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    parts = [F.sum(F.conv(F.substring(h, i, 12), 16, 10).cast("decimal(38,0)")).alias(f"h{i}") for i in (1, 13, 25, 37)]
    import hashlib

    return hashlib.sha256("|".join(map(str, df.agg(F.count("*").alias("n"), *parts).first())).encode()).hexdigest()


def write_dataset(df: DataFrame, path: str, info: Mapping[str, Any] | None = None, mode: str = "errorifexists") -> dict[str, Any]:
    """K5, K6: Parquet by `split`, with its fingerprint and counts beside it."""
    df.write.mode(mode).partitionBy("split").parquet(path)
    back = df.sparkSession.read.parquet(path)
    state = {"fingerprint": fingerprint(back), "rows": {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}, **(info or {})}
    write_report(df.sparkSession, f"{path}/_state.json", state)
    return state


def samples(df: DataFrame, by: str, order: str, most: int = 20) -> DataFrame:
    """K7, K8: the first rows of each component or reject reason."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy(order))).where(F.col("_r") <= most).drop("_r")


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Only rows whose id is not written yet, one of each."""
    from .readers import exists

    new = df.dropDuplicates([key])
    if exists(df.sparkSession, path):
        new = new.join(df.sparkSession.read.schema(df.schema).parquet(path).select(key), key, "left_anti")
    new.write.mode("append").parquet(path)


def compact(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The last value of each id, with the place of its first."""
    w = W.partitionBy(key)
    t = df.withColumn("first_seq", F.min(seq).over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.desc(seq))))
    return t.where("_r = 1").drop("_r")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256, bytes)."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return raw.select(F.substring_index("path", f"/{base}/", -1).alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def verify_manifest(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(file, status) of what is missing, extra or changed."""
    j = expected.select("file", F.col("sha256").alias("want")).join(manifest(spark, path).select("file", "sha256"), "file", "full")
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("want") != F.col("sha256"), "changed")
    return j.select("file", status.alias("status")).where("status is not null")


def write_pages(df: DataFrame, base: str, order: str, rows: int) -> None:
    """A folder of pages `page-<range>-<number>.jsonl.zst`, of so many rows each in the order (a range's last page may have
    fewer), as a paged source (S8, S12) reads them. One shuffle; pages are written as their rows come."""
    import pyarrow as pa
    from pyspark import TaskContext

    from .files import file_system

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        system, folder = file_system(base)
        part, page, number = TaskContext.get().partitionId(), [], 0

        def flush() -> None:
            nonlocal page, number
            with system.open_output_stream(f"{folder}/page-{part:06d}-{number:08d}.jsonl.zst", compression=None) as f:
                f.write(zstandard.ZstdCompressor().compress("".join(f"{line}\n" for line in page).encode()))
            page, number = [], number + 1

        for batch in batches:
            for line in batch.column(0).to_pylist():
                page.append(line)
                if len(page) == rows:
                    flush()
        if page:
            flush()
        yield pa.RecordBatch.from_pydict({"pages": pa.array([number], pa.int32())})

    system, folder = file_system(base)
    system.create_dir(folder)
    lines = df.select(order, F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("line"))
    lines.repartitionByRange(order).sortWithinPartitions(order).select("line").mapInArrow(write, "pages int").agg(F.sum("pages")).collect()
