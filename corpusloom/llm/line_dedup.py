"""Line deduplication: documents that overlap are aligned in pairs, aligned blocks leave the later one."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import clean_text, cut

#: Words of an aligned block that is deleted, at least.
MIN_WORDS = 10
#: A line that at most so many segments hold is rare: all pairs of its documents are aligned.
RARE = 4
#: Lines with words of a segment; longer documents are aligned segment by segment.
SEGMENT = 256
_KEY = 28


def split_lines(text: str) -> list[str]:
    return text.split("\n")


def runs_of(places: list[int], counts: list[int], min_words: int) -> set[tuple[int, int]]:
    """(first, last) of the shortest runs of lines with `min_words` words that start or end at each line, and of those
    that lead over blank lines after a line that has them alone.

    Each line of a block of equal lines with so many words, and each blank line in it, lies in such a run inside the
    block: one that starts at the line (or at the last line with words before it), or, where the rest of the block
    has too few words, the one that ends with the block.
    """
    n, runs = len(places), set()
    i = j = have = 0
    while i < n:  # forward: from line i to the first j that completes it
        while j < n and have < min_words:
            have += counts[j]
            j += 1
        if have < min_words:
            break
        runs.add((i, j - 1))
        if j == i + 1 and j < n and places[j] > places[i] + 1:
            runs.add((i, j))
        have -= counts[i]
        i += 1
    i = have = 0
    for j in range(n):  # backward: from the last i that completes it to line j
        have += counts[j]
        while i < j and have - counts[i] >= min_words:
            have -= counts[i]
            i += 1
        if have >= min_words:
            runs.add((i, j))
    return runs


def _records(places: list[int], digests: list[bytes]) -> list[bytes]:
    """Each line's digest behind its distance to the line before, so that blank lines count."""
    return [(p - q).to_bytes(4, "little") + d for p, q, d in zip(places, [0, *places], digests)]  # noqa: B905


def run_keys(places: list[int], counts: list[int], digests: list[bytes], min_words: int) -> dict[tuple[int, int], bytes]:
    """The shortest runs with what tells them apart; the distance to the line before counts, but for the first line."""
    whole = memoryview(b"".join(_records(places, digests)))
    return {(i, j): bytes(whole[20 * i + 4 : 20 * (j + 1)]) for i, j in runs_of(places, counts, min_words)}


def segments(doc: bytes, text: str, min_words: int, size: int = SEGMENT) -> Iterator[tuple]:
    """(key, places, counts, digests, hashes of lines) of each segment. Segments overlap by what a shortest run can need,
    so that each run lies whole in the segment where it starts."""
    places, counts, digests = [], [], []
    for place, line in enumerate(split_lines(text)):
        words = line.split()
        if words:
            places.append(place)
            counts.append(len(words))
            digests.append(xxhash.xxh3_128_digest(" ".join(words)))
    for number, at in enumerate(range(0, len(places), size)):
        part = slice(at, at + size + min_words + 1)
        p, c, d = places[part], counts[part], digests[part]
        if sum(c) >= min_words:
            yield doc + number.to_bytes(4, "big"), np.array(p, "<i4").tobytes(), np.array(c, "<i4").tobytes(), b"".join(d), sorted(map(line_hash, set(d)))


def line_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _segmented(min_words: int, size: int):
    schema = pa.schema([("key", pa.binary()), ("places", pa.binary()), ("counts", pa.binary()), ("digests", pa.binary()), ("lines", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch, out = whole.slice(at, 200), []
                for doc_id, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text")), strict=True):
                    out += segments((doc_id + 2**63).to_bytes(8, "big") + th, text, min_words, size)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def unpacked(places: bytes, counts: bytes, digests: bytes) -> tuple:
    return np.frombuffer(places, "<i4").tolist(), np.frombuffer(counts, "<i4").tolist(), [digests[i : i + 16] for i in range(0, len(digests), 16)]


def frequent_runs(places: list[int], counts: list[int], digests: list[bytes], often: set[int], min_words: int, size: int) -> set[bytes]:
    """Digests of the shortest runs that start among the first `size` lines and have frequent lines only."""
    rare = np.cumsum([0, *(line_hash(d) not in often for d in digests)])
    return {xxhash.xxh3_128_digest(key) for (i, j), key in run_keys(places, counts, digests, min_words).items() if i < size and rare[i] == rare[j + 1]}


def _frequent(min_words: int, size: int):
    schema = pa.schema([("h", pa.binary()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch, out = whole.slice(at, 500), []
                for key, often, *side in zip(*(batch.column(c).to_pylist() for c in ("key", "often", "places", "counts", "digests")), strict=True):
                    out += [(h, key) for h in frequent_runs(*unpacked(*side), set(often), min_words, size)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, key) come sorted. Each segment is paired with the nearest earlier document's segment that holds the
    same run. Where that may lie in the partition before, `b` is null; the last row tells what the partition ends with."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("h", pa.binary()), ("pid", pa.int32())])
    pid, now, doc, entry, before, first = TaskContext.get().partitionId(), None, None, None, None, True
    for batch in batches:
        out = []
        for h, key in zip(batch.column("h").to_pylist(), batch.column("key").to_pylist(), strict=True):
            if h != now:
                first = now is None
                now, doc, entry, before = h, key[:-4], key, None
            elif key[:-4] != doc:
                doc, entry, before = key[:-4], key, entry
            if before:
                out.append((key, before, None, None))
            elif first:
                out.append((key, None, h, pid))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((None, entry, now, pid), schema, strict=True)], schema=schema)


def patience(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (place, other place), both rising; of equal ones that which patience sorting finds."""
    pairs = sorted(pairs)
    tops: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        back.append(last[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [y]
        last[pile : pile + 1] = [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _anchors(a: list[bytes], b: list[bytes], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """(place in a, place in b) of the lines that stand once in a[a0:a1] and once in b[b0:b1]."""
    once_a: dict[bytes, int] = {}
    once_b: dict[bytes, int] = {}
    for once, side, lo, hi in ((once_a, a, a0, a1), (once_b, b, b0, b1)):
        for i in range(lo, hi):
            once[side[i]] = -1 if side[i] in once else i
    return [(i, once_b[x]) for x, i in once_a.items() if i >= 0 and once_b.get(x, -1) >= 0]


def patience_diff(a: list[bytes], b: list[bytes], far_a: list[int], far_b: list[int]) -> list[tuple[int, int, int]]:
    """Blocks (place in a, place in b, lines) that alignments of a and b find.

    Lines that stand once on either side are the anchors; the longest chain of them that rises on both sides is
    aligned. A block is what grows from an anchor up and down over equal lines at equal distances. Between blocks of
    the chain lines that stand once there are anchors in turn. Anchors off the chain, of blocks in another order, are
    aligned by themselves afterwards, until none is left."""
    out: list[tuple[int, int, int]] = []
    done: dict[int, list[tuple[int, int]]] = {}  # by diagonal: the blocks on it, as spans of a

    def grown(i: int, j: int) -> tuple[int, int, int]:
        up, down = 0, 1
        while i - up > 0 and j - up > 0 and a[i - up - 1] == b[j - up - 1] and far_a[i - up] == far_b[j - up]:
            up += 1
        while i + down < len(a) and j + down < len(b) and a[i + down] == b[j + down] and far_a[i + down] == far_b[j + down]:
            down += 1
        return i - up, j - up, up + down

    def covered(i: int, j: int) -> bool:
        return any(lo <= i < hi for lo, hi in done.get(i - j, ()))

    def aligned(anchors: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        blocks = []
        for i, j in patience(anchors):
            if not covered(i, j):
                blocks.append(block := grown(i, j))
                done.setdefault(i - j, []).append((block[0], block[0] + block[2]))
        return blocks

    left = _anchors(a, b, 0, len(a), 0, len(b))
    work = [(0, len(a), 0, len(b), left)]
    while work:
        a0, a1, b0, b1, anchors = work.pop()
        blocks = aligned(anchors)
        out += blocks
        for i, j, n in [*blocks, (a1, b1, 0)] if blocks else ():
            if a0 < i and b0 < j:
                work.append((a0, i, b0, j, _anchors(a, b, a0, i, b0, j)))
            a0, b0 = max(a0, i + n), max(b0, j + n)
    while left := [x for x in left if not covered(*x)]:
        out += aligned(left)
    return out


def common_spans(a: tuple, b: tuple, min_words: int) -> list[tuple[int, int]]:
    """Spans [start, stop) of lines of the later document a, (places, counts, digests), in blocks of `min_words` words
    that b has too: those that alignments find, and, as no anchor leads to them, the shortest runs of lines of which each
    stands more than once in a or in b."""
    places, counts, digests = a
    far = lambda p: [x - y for x, y in zip(p, [0, *p])]  # noqa: B905, E731
    spans, words = [], np.cumsum([0, *counts])
    for i, _, n in patience_diff(digests, b[2], far(places), far(b[0])):
        if words[i + n] - words[i] >= min_words:
            spans.append((places[i], places[i + n - 1] + 1))
    anchor = np.zeros(len(places) + 1, int)
    anchor[[i + 1 for i, _ in _anchors(digests, b[2], 0, len(digests), 0, len(b[2]))]] = 1
    anchor = np.cumsum(anchor)
    rest = {(i, j): key for (i, j), key in run_keys(places, counts, digests, min_words).items() if anchor[i] == anchor[j + 1]}
    if rest:
        there = set(run_keys(*b, min_words).values())
        spans += [(places[i], places[j] + 1) for (i, j), key in rest.items() if key in there]
    return spans


def _aligned(min_words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch, out = whole.slice(at, 500), []
                for key, *x in zip(*(batch.column(c).to_pylist() for c in ("a", "places", "counts", "digests", "places2", "counts2", "digests2")), strict=True):
                    doc_id, th = int.from_bytes(key[:8], "big") - 2**63, key[8:-4]
                    out += [(doc_id, th, *span) for span in common_spans(unpacked(*x[:3]), unpacked(*x[3:]), min_words)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by document and start; a document's rows may go on in the next batch."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])
    now: tuple | None = None
    for batch in batches:
        out = []
        for doc_id, th, start, stop in zip(*(batch.column(c).to_pylist() for c in schema.names), strict=True):
            if now and now[:2] == (doc_id, th) and start <= now[3]:
                now = (*now[:3], max(now[3], stop))
            else:
                out += [now] if now else []
                now = (doc_id, th, start, stop)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(schema)], schema=schema)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(now, schema, strict=True)], schema=schema)


def overlapping(parts: DataFrame, min_words: int = MIN_WORDS, rare: int = RARE, segment: int = SEGMENT) -> DataFrame:
    """(a, b): pairs of segments, a of a later document than b, that are to be aligned.

    A rare line pairs all segments that hold it, so every run with a rare line has its pairs. A run of frequent lines
    only pairs each segment with the one before it, in the order of documents, that holds the run: whatever any
    earlier document shares with it, its partners of its runs share too. So a run of any frequency costs its
    occurrences, and no segment is the partner of many."""
    held = parts.select(F.explode("lines").alias("h"), "key")
    first = F.row_number().over(W.partitionBy("h").orderBy("key"))
    few = held.withColumn("r", first).where(F.col("r") <= rare + 1).groupBy("h").agg(F.sort_array(F.collect_list("key")).alias("keys")).where(F.size("keys").between(2, rare))
    few = few.select("keys", F.posexplode("keys").alias("i", "b")).select("b", F.explode(F.slice("keys", F.col("i") + 2, F.size("keys"))).alias("a"))
    few = few.where(F.substring("a", 1, _KEY - 4) != F.substring("b", 1, _KEY - 4)).select("a", "b")
    frequent = held.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > rare).select("h")
    often = held.join(frequent, "h", "left_semi").groupBy("key").agg(F.collect_list("h").alias("often"))
    runs = parts.drop("lines").join(often, "key").mapInArrow(_frequent(min_words, segment), "h binary, key binary")
    ordered = cut(runs).repartitionByRange("h", F.substring("key", 1, _KEY - 4)).sortWithinPartitions("h", "key")
    chain = cut(ordered.mapInArrow(_chained, "a binary, b binary, h binary, pid int"))
    # runs that began in an earlier partition: the last holder there
    back = W.partitionBy("h").orderBy("pid", F.col("a").isNull()).rowsBetween(W.unboundedPreceding, 0)
    edge = chain.where("h is not null").withColumn("b", F.last("b", ignorenulls=True).over(back)).where("a is not null and b is not null")
    return few.union(chain.where("a is not null and b is not null").select("a", "b")).union(edge.select("a", "b")).distinct()


def aligned_blocks(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, segment: int = SEGMENT) -> DataFrame:
    """doc_id, th (digest of the text), start, stop: the lines [start, stop) of a document that lie in blocks which stand,
    line by line and of `min_words` words or more, in an earlier document too; blocks that meet are one. Documents
    come in the order of doc_id, then of the text's digest; rows equal in both are one document."""
    text = clean_text(text_col)
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("th", F.unhex(F.md5("text")))
    parts = rows.mapInArrow(_segmented(min_words, segment), "key binary, places binary, counts binary, digests binary, lines array<long>")
    parts = cut(parts.dropDuplicates(["key"]))
    pairs = overlapping(parts, min_words, rare, segment)
    sides = pairs.join(parts.select(F.col("key").alias("a"), "places", "counts", "digests"), "a")
    sides = sides.join(parts.select(F.col("key").alias("b"), *(F.col(c).alias(f"{c}2") for c in ("places", "counts", "digests"))), "b").drop("b")
    found = sides.mapInArrow(_aligned(min_words), "doc_id long, th binary, start int, stop int")
    return found.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "start").mapInArrow(_merged, "doc_id long, th binary, start int, stop int")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE, segment: int = SEGMENT) -> DataFrame:
    """doc_id, text, n_lines, removed_lines, spans for each row of `docs`: the text without the lines that stand,
    aligned in blocks of at least `min_words` words, in an earlier document.

    The earliest document with a block keeps it, so nothing is lost altogether. A null text stays null, with no
    lines; a text whose lines all go becomes empty. Rows without a doc_id stay as they are. Rows with one doc_id but
    different texts are different documents; rows equal in both are one, and none of them deletes from another.
    A very long text is aligned in segments, with the same result. Invalid bytes of a text are read as U+FFFD.
    An empty table gives an empty result. Other columns are ignored.
    """
    blocks = aligned_blocks(docs, min_words, id_col, text_col, rare, segment)
    spans = blocks.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")).withColumn("th", F.unhex(F.md5("text")))
    out = rows.alias("d").join(spans.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans"), (F.col("d.doc_id") == F.col("_id")) & (F.col("d.th") == F.col("_th")), "left")
    lines = F.split(F.col("text"), "\n")
    # lines before, between and behind the spans, which are sorted and apart
    there = F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>"))
    starts, stops = F.concat(F.transform(there, lambda x: x["start"]), F.array(F.size(lines))), F.concat(F.array(F.lit(0)), F.transform(there, lambda x: x["stop"]))
    gaps = F.zip_with(stops, starts, lambda lo, hi: F.slice(lines, lo + 1, hi - lo))
    out = out.withColumn("_left", F.flatten(gaps))  # apart from the new `text`, which the functions inside could take for theirs
    left = F.col("_left")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.coalesce(F.size(lines), F.lit(0)))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    removed = F.when(F.col("spans").isNull() | F.col("text").isNull(), 0).otherwise(F.size(lines) - F.size(left))
    return out.select("doc_id", text.alias("text"), n.alias("n_lines"), removed.alias("removed_lines"), there.alias("spans"))
