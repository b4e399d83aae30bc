"""Lines of zstd files, read frame by frame in many tasks."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .files import file_system, files_under

#: Fixed values of the format: magic numbers of frames and (first of sixteen) of skippable frames; bytes of the content
#: size by its flag, and of the dictionary's id by its flag.
FRAME, SKIPPABLE = 0xFD2FB528, 0x184D2A50
SIZE_BYTES, DICTIONARY_BYTES = (0, 2, 4, 8), (0, 1, 2, 4)
#: Compressed bytes of a task, about: whole frames.
TASK_BYTES = 32 << 20


def frames(file: BinaryIO) -> Iterator[tuple[int, int]]:
    """(start, end) of the data frames, from headers alone: each block tells its length, so nothing is decompressed."""
    file.seek(0, 2)
    size_of_file, at = file.tell(), 0
    file.seek(0)
    while len(head := file.read(4)) == 4:
        magic, start = struct.unpack("<I", head)[0], at
        if SKIPPABLE <= magic < SKIPPABLE + 16:
            at = start + 8 + struct.unpack("<I", file.read(4))[0]
            file.seek(at)
            continue
        if magic != FRAME:
            raise ValueError(f"no zstd frame at byte {start}")
        flags = file.read(1)[0]
        single = flags >> 5 & 1
        at = start + 5 + (1 - single) + DICTIONARY_BYTES[flags & 3] + (SIZE_BYTES[flags >> 6] or single)
        last = 0
        while not last:
            file.seek(at)
            block = file.read(3)
            if len(block) < 3:
                raise ValueError(f"the frame at byte {start} is cut off")
            number = int.from_bytes(block, "little")
            last, kind, size = number & 1, number >> 1 & 3, number >> 3
            at += 3 + (1 if kind == 1 else size)
        at += 4 * (flags >> 2 & 1)
        if at > size_of_file:
            raise ValueError(f"the frame at byte {start} is cut off")
        file.seek(at)
        yield start, at


class Piece(InputPartition):
    """Frames [start, end) of a file."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _lines(file: BinaryIO, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin after the first line end at or after `start` (or at the file's start), up to and with the one
    that begins at or before `end`: so each line comes from one piece, wherever frames cut it."""
    import zstandard

    file.seek(start)
    inside = [end - start]

    class Bounded:
        def read(self, n: int = -1) -> bytes:
            data = file.read(min(n if n > 0 else 1 << 20, inside[0]))
            inside[0] -= len(data)
            return data

    def chunks(source: object) -> Iterator[bytes]:
        reader = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
        while data := reader.read(1 << 20):
            yield data

    rest, begun = b"", start == 0
    for data in chunks(Bounded()):
        lines = (rest + data).split(b"\n")
        rest = lines.pop()
        if not begun and lines:
            lines, begun = lines[1:], True
        if begun:
            yield from lines
    if not begun:
        return  # the piece lies within one line, which belongs to an earlier piece
    file.seek(end)
    for data in chunks(file):
        head, found, _ = data.partition(b"\n")
        rest += head
        if found:
            break
    if rest:
        yield rest


class ZstdLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return "value string, file string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.bytes = options["path"], int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in files_under(self.path, ".zst"):
            system, name = file_system(path)
            with system.open_input_file(name) as file:
                first = None
                for start, end in frames(file):
                    first = start if first is None else first
                    if end - first >= self.bytes:
                        out.append(Piece(path, first, end))
                        first = None
                if first is not None:
                    out.append(Piece(path, first, end))
        return out

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, name = file_system(partition.path)
        with system.open_input_file(name) as file:
            part: list[str] = []
            for line in _lines(file, partition.start, partition.end):
                part.append(line.decode())
                if len(part) == 5000:
                    yield pa.RecordBatch.from_pydict({"value": part, "file": [partition.path] * len(part)})
                    part = []
            if part:
                yield pa.RecordBatch.from_pydict({"value": part, "file": [partition.path] * len(part)})


def read_zstd_frames(spark: SparkSession, path: str, schema: StructType | str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """JSON lines of a zstd file, or of a folder's `.zst` files, in tasks of whole frames; lines may go over frames.
    Bad JSON fails. A file of one frame is one task, as nothing can enter a frame midway. Paths must be of a file system
    that pyarrow opens; for others there is `read_zstd_jsonl`, which reads each file in one task."""
    spark.dataSource.register(ZstdLines)
    lines = spark.read.format("zstd_lines").option("task_bytes", str(task_bytes)).load(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_zstd_frames(df: DataFrame, path: str, rows: int = 1000) -> None:
    """JSON lines with sorted keys as zstd files, a file a task and a frame for so many rows."""
    import uuid

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        system, base = file_system(path)
        system.create_dir(base)
        name, n = f"{base}/{uuid.uuid4().hex}", 0
        with system.open_output_stream(f"{name}.part") as out:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    text = "".join(f"{line}\n" for line in batch.column(0).slice(at, rows).to_pylist())
                    out.write(zstandard.ZstdCompressor(write_checksum=True).compress(text.encode()))
                    n += 1
        if n:
            system.move(f"{name}.part", f"{name}.jsonl.zst")
        else:
            system.delete_file(f"{name}.part")
        yield pa.RecordBatch.from_pydict({"frames": pa.array([n], pa.int32())})

    df.select(F.to_json(F.struct(*sorted(df.columns))).alias("line")).mapInArrow(run, "frames int").agg(F.sum("frames")).collect()
