"""Datasets of Arrow shards with their state beside them: a Spark data source to write and read."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from .files import file_system, files_under

#: Fixed names of a saved dataset's parts.
STATE, INFO, SPLITS = "state.json", "dataset_info.json", "dataset_dict.json"


@dataclass
class Shard(WriterCommitMessage):
    """What a task has written: its file, rows, and a digest of its rows, whatever their order."""

    path: str
    rows: int
    digest: int


@dataclass
class File(InputPartition):
    path: str


class ArrowDataset(DataSource):
    """Options: path. Written shards become visible all at once, when the job commits: tasks write below `_writing-*`,
    the commit moves the shards and then writes the state; an aborted job removes what its tasks wrote."""

    @classmethod
    def name(cls) -> str:
        return "arrow_dataset"

    def schema(self) -> StructType:
        names = state_of(self.options["path"])["_data_files"]
        if not names:
            raise ValueError(f"{self.options['path']} has no shards to tell a schema")
        system, base = file_system(self.options["path"])
        with system.open_input_stream(f"{base}/{names[0]['filename']}") as f:
            return from_arrow_schema(pa.ipc.open_stream(f).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), overwrite)


def state_of(path: str) -> dict:
    system, base = file_system(path)
    with system.open_input_stream(f"{base}/{STATE}") as f:
        return json.loads(f.read())


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [File(f"{self.path}/{f['filename']}") for f in state_of(self.path)["_data_files"]]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        system, name = file_system(partition.path)
        with system.open_input_stream(name) as f:
            yield from pa.ipc.open_stream(f)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str], overwrite: bool):
        self.path, self.overwrite, self.split = options["path"], overwrite, options.get("split")
        self.job = f"_writing-{uuid.uuid4().hex}"
        system, base = file_system(self.path)
        if not overwrite and files_under(f"{self.path}/{STATE}"):
            raise ValueError(f"{self.path} is a dataset already")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shard:
        system, base = file_system(self.path)
        system.create_dir(f"{base}/{self.job}")
        name, rows, digest, writer = f"{base}/{self.job}/{uuid.uuid4().hex}.arrow", 0, 0, None
        with system.open_output_stream(name) as f:
            for batch in iterator:
                writer = writer or pa.ipc.new_stream(f, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
                for row in batch.to_pylist():
                    text = json.dumps(row, sort_keys=True, ensure_ascii=False, default=str)
                    digest = (digest + int.from_bytes(hashlib.sha256(text.encode()).digest(), "big")) % (1 << 256)
            if writer:
                writer.close()
        return Shard(name, rows, digest)

    def commit(self, messages: list[Shard | None]) -> None:
        system, base = file_system(self.path)
        shards = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.path)
        if self.overwrite:
            for old in files_under(self.path):
                if "/_writing-" not in old:
                    system.delete_file(file_system(old)[1])
        names = [f"data-{i:05d}-of-{len(shards):05d}.arrow" for i in range(len(shards))]
        for shard, name in zip(shards, names, strict=True):
            system.move(shard.path, f"{base}/{name}")
        system.delete_dir(f"{base}/{self.job}")
        rows = sum(s.rows for s in shards)
        fingerprint = hashlib.sha256(f"{rows}|{sum(s.digest for s in shards) % (1 << 256)}".encode()).hexdigest()[:16]
        for name, payload in ((INFO, {"splits": {self.split or "train": {"num_examples": rows}}}), (STATE, {"_data_files": [{"filename": n} for n in names], "_fingerprint": fingerprint, "_split": self.split, "num_rows": rows})):
            with system.open_output_stream(f"{base}/{name}") as f:
                f.write(json.dumps(payload, indent=2, sort_keys=True).encode())

    def abort(self, messages: list[Shard | None]) -> None:
        system, base = file_system(self.path)
        system.create_dir(f"{base}/{self.job}")
        system.delete_dir(f"{base}/{self.job}")


def write_arrow_dataset(df: DataFrame, path: str, split: str | None = None, overwrite: bool = False) -> None:
    """K5: `df` as Arrow shards, one a task with rows, with fingerprint and state. The state comes last: what has none is
    no dataset. An existing dataset is kept unless `overwrite`."""
    df.sparkSession.dataSource.register(ArrowDataset)
    w = df.write.format("arrow_dataset").mode("overwrite" if overwrite else "append").option("path", path)
    (w.option("split", split) if split else w).save()


def write_arrow_splits(df: DataFrame, path: str, splits: tuple[str, ...] = ("train", "validation"), overwrite: bool = False) -> None:
    """K6: a dataset for each split, and the list of splits."""
    for s in splits:
        write_arrow_dataset(df.where(F.col("split") == s).drop("split"), f"{path}/{s}", s, overwrite)
    system, base = file_system(path)
    with system.open_output_stream(f"{base}/{SPLITS}") as f:
        f.write(json.dumps({"splits": list(splits)}).encode())


def read_arrow_dataset(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A saved dataset; its committed shards, a task each."""
    spark.dataSource.register(ArrowDataset)
    r = spark.read.format("arrow_dataset").option("path", path)
    return (r.schema(schema) if schema else r).load()


def read_arrow_splits(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """All splits of a saved dataset, with their names as `split`."""
    system, base = file_system(path)
    with system.open_input_stream(f"{base}/{SPLITS}") as f:
        names = json.loads(f.read())["splits"]
    parts = [read_arrow_dataset(spark, f"{path}/{s}", schema).withColumn("split", F.lit(s)) for s in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
