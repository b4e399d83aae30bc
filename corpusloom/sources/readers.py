"""Sources and scans."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, optional: bool = False) -> DataFrame:
    """Strict JSON lines; a bad line fails. A missing optional file is an empty table."""
    paths = [path] if isinstance(path, str) else list(path)
    if optional:
        paths = [p for p in paths if exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def jsonl_errors(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of lines that are no JSON object. A line's number is its place in its piece of the file and
    the lines of the pieces before, so that only numbers are shuffled and a file of any size is read in pieces."""
    read = spark.read.option("lineSep", "\n").text(path)
    lines = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).withColumn("id", F.monotonically_increasing_id())
    pieces = lines.groupBy("file", "at").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bad = lines.where((F.trim("value") != "") & (F.try_parse_json("value").isNull() | ~F.trim("value").startswith("{")))
    return bad.join(pieces.select("file", "at", "first", before.alias("before")), ["file", "at"]).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).cast("int").alias("line"), F.col("value").alias("text"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """S3."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (r.schema(schema) if schema else r).csv(path)


def read_files(spark: SparkSession, paths: Sequence[str], schema: StructType | str, pattern: str | None = None) -> DataFrame:
    """Several paths, folders or globs, with the file each row is from."""
    r = spark.read.schema(schema).option("recursiveFileLookup", True)
    return (r.option("pathGlobFilter", pattern) if pattern else r).json(list(paths)).withColumn("_input_file", F.input_file_name())


def read_text_files(spark: SparkSession, path: str, suffixes: Sequence[str] = (".txt", ".md")) -> DataFrame:
    """One document a file, decoded with fallbacks."""
    from ..functions.text import decode_bytes

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ok = F.lit(False)
    for s in suffixes:
        ok = ok | F.lower("path").endswith(s)
    return raw.where(ok).select(F.regexp_extract("path", "([^/]+)$", 1).alias("document_id"), decode_bytes("content").alias("text"), "path")


def read_arrow(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Arrow IPC files, stream format first, then file format; files are opened by executors."""
    import pyarrow as pa

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.arrow").load(path).select("content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_buffer()
                try:
                    yield from pa.ipc.open_stream(data)
                except pa.ArrowInvalid:
                    reader = pa.ipc.open_file(data)
                    yield from (reader.get_batch(i) for i in range(reader.num_record_batches))

    return raw.mapInArrow(rows, schema)


def read_dataset(spark: SparkSession, path: str, required: Sequence[str] = ("text", "label")) -> DataFrame:
    """A saved dataset with `split` folders; columns it must have are checked."""
    df = spark.read.parquet(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return df.withColumn("label", F.col("label").cast("int")) if "label" in required else df


def read_zstd_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Zstd-compressed JSON lines; each file by one task. See `zstd_lines` for files of many frames."""
    import pyarrow as pa

    raw = spark.read.format("binaryFile").load(path).select("content")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import zstandard

        for batch in batches:
            for content in batch.column("content"):
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content.as_py())), encoding="utf-8")
                part: list[str] = []
                for line in stream:
                    part.append(line)
                    if len(part) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(part)], names=["value"])
                        part = []
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["value"])

    parsed = raw.mapInArrow(lines, "value string").where(F.trim("value") != "")
    return parsed.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


class _Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


def _called(path: str) -> Callable:
    import importlib

    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


class PagedSource(DataSource):
    """A paged source as a Spark data source, in batch or as a stream. Options: `fetch`, the import path of a
    function (page number, and `base` where that is given -> list of tuples, empty at the end); `pages`, how many pages
    to ask for; as a stream also `head`, the import path of a function (`base` -> how many pages there are now), and
    `scan`, how many rows to read at most, with `page_rows`, the rows of a full page."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options.get("schema", "document_id string, text string")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _PagedStream(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_Page(i) for i in range(int(self.options.get("pages", 1)))]

    def read(self, partition: _Page) -> Iterator[tuple]:
        base = self.options.get("base")
        rows = _called(self.options["fetch"])(*((partition.number,) if base is None else (partition.number, base)))
        most = int(self.options.get("scan", 0))
        yield from rows[: max(0, most - partition.number * int(self.options["page_rows"]))] if most else rows


class _PagedStream(DataSourceStreamReader):
    """The offset is the number of pages read. Which rows a page has under the scan cap follows from its number, so a batch
    that runs again reads the same rows."""

    def __init__(self, options: Mapping[str, str]):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        there = int(_called(self.options["head"])(self.options.get("base")))
        if most := int(self.options.get("scan", 0)):
            there = min(there, -(-most // int(self.options["page_rows"])))
        return {"page": min(there, int(self.options.get("pages", there)))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Page(i) for i in range(start["page"], end["page"])]

    def read(self, partition: _Page) -> Iterator[tuple]:
        return _PagedReader(self.options).read(partition)

    def commit(self, end: dict) -> None:
        pass  # pages stay where they are


def _paged(reader, options: Mapping[str, object], schema: str):
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.format("paged").option("schema", schema).load()


def read_paged(spark: SparkSession, fetch: str, pages: int, schema: str, **options: object) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return _paged(spark.read, {"fetch": fetch, "pages": pages, **options}, schema)


def stream_paged(spark: SparkSession, fetch: str, head: str, schema: str, **options: object) -> DataFrame:
    """An unbounded paged source; see `PagedSource`. A query goes on from its checkpoint at the page after the last."""
    spark.dataSource.register(PagedSource)
    return _paged(spark.readStream, {"fetch": fetch, "head": head, **options}, schema)


def page_files(base: str | None) -> int:
    """How many pages a folder of pages has: files `page-*.jsonl` or `page-*.jsonl.zst`, numbered from 0 by name."""
    return len(_pages(base or ""))


def _pages(base: str) -> list[str]:
    from .files import files_under

    return [p for p in files_under(base) if p.endswith((".jsonl", ".jsonl.zst"))]


def page_file(number: int, base: str) -> list[tuple]:
    """The rows of a page of such a folder, values in the order of the keys."""
    import json

    import zstandard

    from .files import file_system

    path = _pages(base)[number]
    system, name = file_system(path)
    with system.open_input_stream(name, compression=None) as f:
        data = f.read()
    text = zstandard.ZstdDecompressor().decompressobj().decompress(data) if path.endswith(".zst") else data
    return [tuple(v for _, v in sorted(json.loads(line).items())) for line in text.split(b"\n") if line.strip()]


def crawl(pages: DataFrame, seeds: Sequence[str], depth: int, allowed: Callable, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages reached from the seeds over links within `depth`, breadth first: (url, depth). `pages` is what was
    fetched; the frontier is an anti-join with what is known."""
    from ..functions.text import canonical_url, html_links
    from ..operators.identity import save_point

    spark = pages.sparkSession
    known = spark.createDataFrame([(s, 0) for s in seeds], "url string, depth int").select(canonical_url("url").alias("url"), "depth").where("url <> ''").distinct()
    fetched = pages.select(canonical_url(url_col).alias("url"), html_col).where("url <> ''")
    frontier = known
    for level in range(1, depth + 1):
        links = fetched.join(frontier.select("url"), "url").select(F.explode(html_links("url", html_col)).alias("l"))
        frontier = save_point(links.select(canonical_url("l").alias("url")).where("url <> ''").where(allowed(F.col("url"))).distinct().join(known, "url", "left_anti").withColumn("depth", F.lit(level)))
        known = known.unionByName(frontier)
    return known


@dataclass(frozen=True)
class SourceSpec:
    """How to make documents of one source."""

    name: str
    path: str
    schema: str
    text: Sequence[str] = ("text",)
    label: str | None = None
    keep_labels: Sequence[str] = ()
    as_label: int = 0
    limit: int | None = None
    bucket: str = "document"
    extra: Mapping[str, Any] = field(default_factory=dict)


def load_source(spark: SparkSession, spec: SourceSpec, seed: int = 42) -> DataFrame:
    """Text, label, source_name and bucket of one source."""
    from ..functions.text import extract_text, text_hash
    from ..operators.sampling import seeded_sample

    df = read_jsonl(spark, spec.path, spec.schema)
    if spec.label and spec.keep_labels:
        df = df.where(F.lower(F.col(spec.label).cast("string")).isin(*spec.keep_labels))
    out = df.select(extract_text(*spec.text).alias("text"), F.lit(spec.as_label).alias("label"), F.lit(spec.name).alias("source_name"), F.lit(spec.bucket).alias("bucket")).where(F.trim("text") != "")
    return seeded_sample(out.withColumn("_k", text_hash("text", 64)), "_k", seed, most=spec.limit).drop("_k") if spec.limit else out


def load_sources(spark: SparkSession, specs: Sequence[SourceSpec], errors: dict[str, str] | None = None) -> DataFrame | None:
    """All sources in one plan; a source that cannot be read is recorded and left out."""
    from ..operators.splits import concatenate

    parts = []
    for s in specs:
        try:
            df = load_source(spark, s)
            df.limit(1).count()
            parts.append(df)
        except Exception as e:
            if errors is None:
                raise
            errors[s.name] = str(e).split("\n")[0]
    return concatenate(parts)


def guard_paths(paths: Sequence[str], forbidden: Sequence[str]) -> None:
    """Refuses inputs whose path names what must not be used."""
    for p in paths:
        for f in forbidden:
            if re.search(f, p, re.IGNORECASE):
                raise ValueError(f"input {p} matches {f}")


def cached_stage(spark: SparkSession, root: str, name: str, config: Mapping[str, Any], build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's result by the hash of its configuration; built once, then read. A write that did not
    end has no success mark and is made anew."""
    from ..operators.policy import config_hash

    path = f"{root}/{name}-{config_hash(config)}"
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
