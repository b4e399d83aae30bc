"""Packing token sequences: first-fit decreasing with a tournament tree."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import claim, clean_text, cut, remembers

#: Rows of pieces that one packing task holds; groups are random by document.
GROUP_ROWS = 50_000
#: Chunks whose ids a Python worker remembers.
REMEMBERED = 200_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_tokenizers: dict[str, Tokens] = {}
remembers("packing", _tokenizers.clear)


class Tokens:
    """Ids of a byte-level BPE vocabulary file, as little-endian unsigned 32-bit bytes.

    In this vocabulary's splitting pattern a space before a non-space always starts a new piece, so a text can
    be cut there and the ids of each chunk looked up. A chunk not seen before goes through a fast encoder over
    the same vocabulary and pattern. Texts in which Python's white space differs from the pattern's, or that
    hold a special token's string, go whole through the tokenizers library itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # the printable stand-ins that byte-level vocabularies use for bytes
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        stand = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(stand[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
        self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.odd = re.compile("|".join(["[\x1c-\x1f\x85\u180e]", *map(re.escape, special)]))
        self.cut = re.compile(" (?=\\S)")
        self.known: dict[str, bytes] = {}

    def encode_fast(self, text: str) -> bytes:
        return pack(self.fast.encode_ordinary(text))

    def chunk(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = pack(self.fast.encode_ordinary(" " + piece))
            if len(self.known) < REMEMBERED and len(piece) < 60:
                self.known[piece] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if self.odd.search(text):
            return pack(self.whole.encode(text, add_special_tokens=False).ids)
        first, *rest = self.cut.split(text)
        return self.encode_fast(first) + b"".join(map(self.chunk, rest))


#: Fixed value: the splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pack(ids: list[int]) -> bytes:
    import array

    return array.array("I", ids).tobytes()


def tokens(path: str) -> Tokens:
    if path not in _tokenizers:
        _tokenizers[path] = Tokens(path)
    return _tokenizers[path]


def cut_pieces(path: str, size: int, end_id: int):
    """Tokenise whole texts and cut each document into pieces of `size` ids and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        encode, end = tokens(path), end_id.to_bytes(4, "little")
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = memoryview(encode(text.as_py() or "") + end)
                n = len(ids) // 4
                for start in range(0, n, size):
                    part = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def first_fit_decreasing(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length. A tournament tree over the bins' free space finds the first bin that fits."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    width = 1
    while width < max(1, len(lengths)):
        width *= 2
    free = [size] * (2 * width)
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in order:
        n, at = lengths[i], 1
        while at < width:
            at *= 2
            if free[at] < n:
                at += 1
        placed[i] = (at - width, size - free[at])
        free[at] -= n
        while at > 1:
            at //= 2
            best = max(free[2 * at], free[2 * at + 1])
            if free[at] == best:
                break
            free[at] = best
    return placed


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 1024, end_id: int = 0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces of all documents in sequences of at most `size` tokens: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    Documents are tokenised where they are read and cut into full pieces and a rest; only the pieces' numbers
    are shuffled. Pieces fall at random into groups of about `group_rows`, each packed by first-fit decreasing; the
    pieces of one document may fall apart, so that a document of any length spreads over the groups.
    A null text counts as empty (one id, the end id). Rows with a null or repeated doc_id are packed as any
    other, and pieces of equal rows are dealt apart too. Invalid bytes of a text are read as U+FFFD. An empty table
    gives an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    pieces = cut(rows.mapInArrow(cut_pieces(tokenizer_path, size, end_id), _PIECES))
    groups = max(1, round(pieces.count() / group_rows))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        claim("packing, placed")  # the tokenizer is not needed any more
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        put = first_fit_decreasing(pdf["length"].tolist(), size)
        base = int(pdf["bucket"].iloc[0]) << 32
        return pdf.drop(columns="bucket").assign(sequence_id=[base + b for b, _ in put], offset=[o for _, o in put])

    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("bucket").applyInPandas(place, f"{_PIECES}, sequence_id long, offset long")
