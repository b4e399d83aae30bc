"""Near-deduplication: MinHash bands, signature check, exact confirmation, star-contraction components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import claim, clean_text, cut, discard, remembers

#: Universal hash functions, and how many of their minima make a band. A pair of similarity 0.8 shares none of the 32 bands with probability (1 - 0.8^5)^32 = 3e-6.
HASHES, ROWS = 160, 5
BANDS = HASHES // ROWS
#: The signature is a byte of each minimum, eight to a long. Of a pair of similarity 0.8 fewer than this share of the minima agree with probability 2e-6.
AGREE = 0.65
SIGNS = tuple(f"s{i}" for i in range(HASHES // 8))
#: Members of an open bucket that stand on either side of a block.
BLOCK = 512
_WORDS = 150_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words as bytes; the first words seen are remembered."""

    def __missing__(self, word: bytes) -> bytes:
        h = xxhash.xxh3_64_digest(word)
        if len(self) < _WORDS and len(word) < 60:
            self[word] = h
        return h


_hashes = WordHashes()
remembers("near_dedup", _hashes.clear)


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct `k`-word shingles of the lower-cased whole text."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(_hashes.__getitem__, words)), ">u8").astype(np.uint64)
    span = min(k, len(words))
    acc = h[: len(h) - span + 1].copy()
    for j in range(1, span):
        acc = mixed(acc + np.uint64(j)) * _FOLD + h[j : len(h) - span + 1 + j]
    return np.unique(mixed(acc + np.uint64(span)))


def minima(sets: list[np.ndarray], at_once: int = 1 << 14) -> np.ndarray:
    """(sets, HASHES) minima of the universal hashes a x + b; every set has a member."""
    out = np.empty((len(sets), HASHES), np.uint64)
    i = 0
    while i < len(sets):
        j, n = i, 0
        while j < len(sets) and (j == i or n + len(sets[j]) <= at_once):
            n += len(sets[j])
            j += 1
        x = np.concatenate(sets[i:j])
        starts = np.cumsum([0, *(len(s) for s in sets[i : j - 1])])
        v = np.empty_like(x)
        for k in range(HASHES):
            np.multiply(x, _A[k], out=v)
            np.add(v, _B[k], out=v)
            out[i:j, k] = np.minimum.reduceat(v, starts)
        i = j
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Fixed-width rows of bytes as an Arrow binary column."""
    return pa.array([bytes(r) for r in np.ascontiguousarray(rows)], pa.binary())


def _signatures(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), *((c, pa.int64()) for c in SIGNS), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup")
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets = [shingles(t.as_py() or "", k) for t in batch.column("text")]
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                m = minima([sets[i] for i in full]) if len(full) else np.empty((0, HASHES), np.uint64)
                key = np.zeros((len(sets), 2), np.uint64)
                for i in full:
                    key[i] = sets[i].sum(), mixed(sets[i] + _FOLD).sum()
                signs = np.zeros((len(sets), HASHES), np.uint8)
                signs[full] = (mixed(m) & np.uint64(255)).astype(np.uint8)
                signs = signs.view(np.int64)
                bands = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(full), 0)
                for r in range(ROWS):
                    bands = mixed(bands * _FOLD + m[:, r::ROWS])
                flat = bands.astype(np.int64).ravel()
                counts = np.where(n > 0, BANDS, 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), _binary(key.view(np.uint8).reshape(len(sets), 16)), *(pa.array(signs[:, c].copy()) for c in range(len(SIGNS))), lists], schema=schema)

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([shingles(t.as_py() or "", k).tobytes() for t in batch.column("text")], pa.binary())], names=["id", "members"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of `edges` (a, b): alternating large-star and small-star until the edges
    stay as they are, which leaves each node tied to the smallest one that it reaches."""
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = mark(edges)
    while now[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        old, edges = edges, cut(small.distinct())
        was, now = now, mark(edges)
        discard(old)
        if was == now:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def alike(left: str, right: str, percent: int) -> Column:
    """Sizes and signatures of two sides allow the similarity. Bytes that differ leave their lowest bit set."""
    one = F.lit(0x0101010101010101)

    def differing(c: str) -> Column:
        v = F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))
        for shift in (4, 2, 1):
            v = v.bitwiseOR(F.shiftrightunsigned(v, shift))
        return F.bit_count(v.bitwiseAND(one))

    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    sizes = (100 * a >= percent * b) & (100 * b >= percent * a)
    return sizes & (sum((differing(c) for c in SIGNS), F.lit(0)) <= int((1 - AGREE) * HASHES))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of `docs`.

    Documents whose sets of `k`-word shingles (of the lower-cased whole text) have `percent` % of their union in
    common are linked; component_id is the smallest doc_id reachable over links. Documents with equal sets are
    one class from the start. A class meets others in the buckets of its bands. First each class is confirmed
    against the bucket leader that it shares most bands with; then, in buckets whose classes are still in
    different components, every pair across components that sizes and signatures do not rule out is confirmed
    too, in blocks, so nothing within a bucket is skipped. Confirmation compares full sets. Only links leave a bucket.

    Texts of any length are read whole; invalid bytes are read as U+FFFD. A null or blank text has no shingles, is its own component and is kept. Rows without a doc_id are returned
    kept, with a null component. Rows that share a doc_id are one document as to links. An empty table gives an
    empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text"))
    signed = cut(rows.mapInArrow(_signatures(k), f"doc_id long, n long, key binary, {', '.join(f'{c} long' for c in SIGNS)}, bands array<long>"))
    classes = signed.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("id"))
    chosen = signed.join(classes, (signed["key"] == classes["key"]) & (signed["doc_id"] == classes["id"]), "left_semi").dropDuplicates(["key", "doc_id"])
    chosen = cut(chosen.select(F.col("doc_id").alias("id"), "n", *SIGNS, "bands"))
    banded = chosen.select(F.explode("bands").alias("h"), "id")
    leaders = banded.groupBy("h").agg(F.min("id").alias("lead"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = cut(banded.join(cut(leaders), "h", "left").where("lead is not null"))
    signs = chosen.select("id", "n", *SIGNS)

    # the leader that a class shares most bands with
    bands = members.where("id <> lead").groupBy("id", "lead").agg(F.count("*").alias("c"))
    best = bands.groupBy("id").agg(F.max_by("lead", "c").alias("lead")).withColumnRenamed("id", "b")
    best = best.join(signs.alias("x"), F.col("lead") == F.col("x.id")).select("b", *(F.col(f"x.{c}").alias(c) for c in ("id", "n", *SIGNS))).alias("y").join(signs.alias("x"), F.col("y.b") == F.col("x.id"))
    best = cut(best.where(alike("x", "y", percent)).select(F.col("y.id").alias("a"), F.col("y.b").alias("b")))
    links = cut(confirm(best, rows, k, percent))
    labels = components(links)

    placed = members.join(labels, members["id"] == labels["node"], "left").select("h", "id", F.coalesce("component", "id").alias("comp"))
    placed = cut(placed)
    per = placed.groupBy("h", "comp").agg(F.count("*").alias("c"))
    open_ = per.groupBy("h").agg(F.max_by("comp", "c").alias("main"), F.max("c").alias("most"), F.sum("c").alias("all"), F.count("*").alias("comps")).where("comps > 1")
    more = cut(across_components(placed.join(cut(open_), "h"), rows, chosen, k, percent, block))
    if more.count():
        labels = components(links.union(more))

    joined = cut(classes.join(labels, classes["id"] == labels["node"], "left").select("key", F.coalesce("component", "id").alias("component_id")))
    discard(chosen, members, best, links, placed, more)  # what follows reads `signed` and `joined` alone
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), "key").join(joined, "key", "left")
    own_id = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", own_id.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _candidates(rows: list[tuple], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each minor member (not of the bucket's main component) of a block: its number, and those of the other members
    that components, sizes and signatures let it be linked with. A pair is left to the first band that it shares:
    that bucket is open too."""
    most = int((1 - AGREE) * HASHES)
    asks, ids, comps, mains, n = (np.array(x) for x in list(zip(*rows, strict=True))[:5])
    sign, bands, band = np.stack([r[5] for r in rows]), np.stack([r[6] for r in rows]), rows[0][7]
    other = np.flatnonzero(~asks)
    for x in np.flatnonzero(asks) if asks.any() else np.flatnonzero(comps != mains):
        ok = (comps[other] != comps[x]) & ((comps[other] == mains[other]) | (ids[x] < ids[other])) & (100 * n[other] >= percent * n[x]) & (100 * n[x] >= percent * n[other])
        left = other[ok]
        left = left[(sign[left] != sign[x]).sum(1) <= most]
        if len(left):
            same = bands[left] == bands[x]
            left = left[same.argmax(1) == np.flatnonzero(bands[x] == band)[0]]
        if len(left):
            yield x, left


def _blocks(batches: Iterator[pa.RecordBatch], extra: tuple[str, ...] = ()) -> Iterator[list[tuple]]:
    """Rows of one block after another; they come sorted by block, and a block may go on in the next batch."""
    now, held = None, []
    for batch in batches:
        sign = np.stack([batch.column(c).to_numpy() for c in SIGNS], 1).view(np.uint8).reshape(-1, HASHES)
        bands = batch.column("bands").flatten().to_numpy().reshape(-1, BANDS)
        columns = (batch.column(c).to_pylist() for c in ("h", "i", "j", "asks", "id", "comp", "main", "n", *extra))
        for at, (h, i, j, asks, id_, comp, main, n, *more) in enumerate(zip(*columns, strict=True)):
            if (h, i, j) != now:
                if len(held) > 1:
                    yield held
                now, held = (h, i, j), []
            held.append((asks, id_, comp, main, n, sign[at], bands[at], h, i, j, *more))
    if len(held) > 1:
        yield held


def _concerned(percent: int):
    """Members of a block that have a candidate in it, by signatures alone."""
    names = ["h", "i", "j", "asks", "id", "comp", "main"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            found = list(_candidates(rows, percent))
            if found:
                use = np.unique(np.concatenate([np.r_[x, left] for x, left in found]))
                out = [(rows[u][7], rows[u][8], rows[u][9], *rows[u][:4]) for u in use]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)], names=names)

    return run


def _block_links(percent: int):
    """Links of a block, confirmed on full sets."""

    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(r[10], np.uint64) for r in rows]
        for x, left in _candidates(rows, percent):
            for y in left:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    yield min(rows[x][1], rows[y][1]), max(rows[x][1], rows[y][1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ("members",)):
            out = list(links(rows))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return run


def across_components(inside: DataFrame, rows: DataFrame, chosen: DataFrame, k: int, percent: int, block: int = BLOCK) -> DataFrame:
    """All links between different components within open buckets. `inside` has h, id, comp and the bucket's main
    component, its size and that of the bucket. Large buckets are cut into blocks of minor members against blocks of
    all members. A block first gets its members' signatures alone; full sets go only to blocks, and there to members,
    where signatures leave a candidate, each once, and only links leave a block."""
    few = F.ceil((F.col("all") - F.col("most")) / block).cast("int")
    many = F.ceil(F.col("all") / block).cast("int")
    keyed = inside.select("*", few.alias("few"), many.alias("many"), F.pmod(F.xxhash64("id"), few).cast("int").alias("mi"), F.pmod(F.xxhash64("id", "h"), many).cast("int").alias("mj"))
    other = keyed.select("h", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i"), F.col("mj").alias("j"), F.lit(False).alias("asks"), "id", "comp", "main")
    minor = keyed.where("comp <> main and few * many > 1").select("h", F.col("mi").alias("i"), F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("j"), F.lit(True).alias("asks"), "id", "comp", "main")
    signs = chosen.select("id", "n", "bands", *SIGNS)

    def blocked(members: DataFrame) -> DataFrame:
        return members.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")

    named = cut(blocked(minor.unionByName(other).join(signs, "id")).mapInArrow(_concerned(percent), "h long, i int, j int, asks boolean, id long, comp long, main long").distinct())
    texts = rows.join(named.select("id").distinct(), rows["doc_id"] == F.col("id"), "left_semi").select(F.col("doc_id").alias("id"), "text")
    sets = texts.mapInArrow(_sets(k), "id long, members binary").distinct()
    # the size tells apart several texts of one id
    full = cut(sets.withColumn("n", (F.length("members") / 8).cast("long")).join(signs, ["id", "n"]))
    return blocked(named.join(full, "id")).mapInArrow(_block_links(percent), "a long, b long").distinct()


def confirm(pairs: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Sets are made anew from the texts of just the
    documents that the pairs name."""
    named = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = rows.join(named, rows["doc_id"] == named["id"], "left_semi").select(F.col("doc_id").alias("id"), "text")
    sets = cut(texts.mapInArrow(_sets(k), "id long, members binary"))
    left = pairs.join(sets, pairs["b"] == sets["id"]).select("a", "b", F.col("members").alias("sb"))
    full = left.join(sets, left["a"] == sets["id"]).select("a", "b", F.col("members").alias("sa"), "sb")
    return full.mapInArrow(_confirmed(percent), "a long, b long").distinct()


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """`docs` without the documents that are not kept (see `near_duplicates`), all columns unchanged. Rows with a null
    doc_id, and those without words, stay; rows that share a doc_id stay or go together."""
    gone = near_duplicates(docs, k, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
