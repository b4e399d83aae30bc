import random
import zlib
from collections import defaultdict

import pytest
import public_tokenizers
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup, mixing, packing, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "a b\tc", "en", "s", 5), (2, "abc", "en", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "  \n", "de", "t", 3),
    (6, "x " * 50_000, "en", "t", 1), (7, "x " * 50_000, "en", "t", 1), (7, "x " * 50_000, "en", "t", 1), (8, "<|endoftext|> a  b\n\n c d\x1ce", "en", "u", 2), (9, "été — 日本 it's 12", "fr", "u", 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("bucket", F.lit(2))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_content_sort_against_brute_force(odd, none):
    rows = exact_dedup.content_sort(odd).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in ODD:
        groups[plain(text)].append((-len(text or ""), doc_id))
    want = sorted((i, min(g)[1], len(g)) for g in groups.values() for _, i in g)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)
    assert exact_dedup.content_sort(none).count() == 0
    assert exact_dedup.drop_copies(odd).count() == len(groups) and exact_dedup.drop_copies(odd).columns == odd.columns


def test_group_over_many_partitions_is_one_group(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_dedup.content_sort(docs)
        assert got.where("group_size > 1").select("keep_id", "group_size").distinct().collect() == [(1, 1333)]
        assert got.where("kept").count() == 668
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_drop_copies_over_many_partitions(spark):
    """One row of each group stays, the longest original and then the smallest id, also where groups cross borders."""
    rows = [(i, " " * (i % 5) + ("same text" if i % 3 else f"t{i % 90}"), i % 4) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra long").repartition(7)
    want = {}
    for i, text, extra in rows:
        key = plain(text)
        want[key] = min(want.get(key, (0, 0)), (-len(text), i)) if key in want else (-len(text), i)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_dedup.drop_copies(docs).collect()
        seen = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.content_sort(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.doc_id for r in got) == sorted(i for _, i in want.values()) and all(r.extra == r.doc_id % 4 for r in got)
    size = defaultdict(int)
    for _, text, _ in rows:
        size[plain(text)] += 1
    assert seen == {(i, want[plain(t)][1], size[plain(t)], i == want[plain(t)][1]) for i, t, _ in rows}


def test_invalid_bytes_are_read_as_replacement(spark):
    df = spark.sql("select 1L doc_id, cast(unhex('61FF62') as string) text, 'en' lang, 's' source, 1L n_chars union all select 2L, 'x y', 'en', 's', 1L")
    assert exact_dedup.content_sort(df).where("kept").count() == exact_dedup.drop_copies(df).count() == 2
    assert sum(r.length for r in packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json")).collect()) > 5


@pytest.mark.parametrize("chunk", [3, 20_000])
def test_sharding_keeps_groups_and_balances(spark, odd, none, chunk):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('ab', cast(1 + id % 997 as int))").alias("text"))
    rows = sharding.shard_documents(docs, chunk_rows=chunk * 50).collect()
    shards, slots, of = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        shards[r.shard] += r.size
        slots[r.shard].append(r.slot)
        of[r.text_crc32, r.size].add(r.shard)
    assert max(shards.values()) - min(shards.values()) < 0.01 * max(shards.values()) and len(shards) == 16
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and all(len(x) == 1 for x in of.values())
    got = {(r.doc_id, r.size, r.text_crc32) for r in sharding.shard_documents(odd, chunk_rows=chunk).collect()}
    assert got == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ODD}
    assert sharding.shard_documents(none).count() == 0


def test_differencing_example():
    parts, sums = sharding.difference([[8, 0], [7, 0], [6, 0], [5, 0], [4, 0]], 2)
    assert sorted(sums) == [14, 16] and sorted(sum(x for x, p in zip((8, 7, 6, 5, 4), parts) if p[0] == s) for s in (0, 1)) == [14, 16]


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_differencing_against_lists(shards):
    """The same rule on plain lists: the two partial partitions of largest spread, largest part with smallest."""
    rng = random.Random(shards)
    sizes = [rng.randrange(1, 10**9) for _ in range(200)]
    left = [[x, *[0] * (shards - 1)] for x in sizes]
    while len(left) > 1:
        left.sort(key=lambda p: p[-1] - p[0])
        a, b, *left = left
        left.append(sorted((x + y for x, y in zip(a, b[::-1])), reverse=True))
    parts, sums = sharding.difference([[x, *[0] * (shards - 1)] for x in sizes], shards)
    assert sorted(sums, reverse=True) == left[0]
    got = [0] * shards
    for x, part in zip(sizes, parts):
        got[part[0]] += x
    assert got == sums and max(sums) - min(sums) < max(sizes) / 100


def quotas(spark, sizes, block):
    totals = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    return mixing.apportion(mixing.source_targets(totals), block).collect()


@pytest.mark.parametrize("sizes", [[1000, 1000, 1000], [10, 100_000, 5000, 70], [1, 1, 1, 1], [333, 777, 12345, 5, 5, 90]])
def test_apportionment_is_highest_quotients(spark, sizes):
    rows = quotas(spark, sizes, 16)
    seats = round(sum(sizes) / 16 + 1e-9)
    most = {r.source: r.most for r in rows}
    ranked = sorted((-r.target / (2 * s + 1), r.source, s) for r in rows for s in range(most[r.source]))[:seats]
    assert {r.source: r.quota for r in rows} == {r.source: sum(x[1] == r.source for x in ranked) for r in rows}


def test_shards_have_integer_quotas_near_the_weights(spark):
    totals = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate([5000, 700, 12345, 90, 8000])], "source string, source_size long")
    rows = mixing.apportion(mixing.source_targets(totals), 16, shards=7).collect()
    house = round(sum(r.target for r in rows) / 16)
    for r in rows:
        assert len(r.upto) == 7 and r.upto[-1] == r.quota and all(x <= y for x, y in zip(r.upto, r.upto[1:]))
        for s, n in enumerate(r.upto):
            assert abs(n - r.target / 16 * (s + 1) / 7) <= 1.5
    assert [sum(r.upto[s] for r in rows) for s in range(7)] == [house * (s + 1) // 7 for s in range(7)]


def test_mix_deals_documents_to_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixed = mixing.mixed_documents(docs, shard_col="shard").withColumn("n", F.regexp_count("text", F.lit(mixing.WORD)))
    per = {r.shard: r.n for r in mixed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert sorted(per) == list(range(16)) and min(per.values()) > 0
    same = spark.createDataFrame([(1, "a b c", "s")] * 50 + [(None, "d e f g", "s")] * 30 + [(None, "h", "t")], "doc_id long, text string, source string")
    rows = mixing.mix_sources(same).collect()
    assert len(rows) == 81 and abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) <= 32
    words = mixing.mixed_documents(same).select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == sum(r.taken for r in rows)


def test_targets_reshare_what_small_sources_cannot_give(spark):
    totals = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(totals).collect()}
    assert got == {"a": 700.0, "b": 270.0, "c": 30.0, None: 0.0}


def test_mix_of_sources_smaller_than_a_block(spark):
    """Each source comes within a word of its target: a table of three words is taken whole, seven words thrice."""
    for sizes in ({"a": [3]}, {"a": [7], "b": [400, 90]}, {"a": [1], "b": [2], "c": [5, 4], "d": [60]}):
        docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for s, all_ in sizes.items() for i, n in enumerate(all_, ord(s) * 10)], "doc_id long, text string, source string")
        rows = mixing.mix_sources(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
        for s in sizes:
            assert abs(sum(r.taken for r in rows if r.source == s) - next(r.target for r in rows if r.source == s)) <= 0.5
        assert all(r.taken <= 3 * r.size and r.first_shard in (None, *range(16)) for r in rows)


def test_mix_takes_near_targets(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.mix_sources(docs).collect()
    taken, target = defaultdict(int), {}
    sources = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= mixing.BLOCK for s in target)
    assert sorted(rows) == sorted(mixing.mix_sources(docs.repartition(7)).collect())
    words = mixing.mixed_documents(docs).select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == sum(taken.values())
    assert mixing.mix_sources(odd).count() == len(ODD) and mixing.mix_sources(none).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_packing_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(odd.where("doc_id <> 7").select(F.col("doc_id") + 10**6, "text"))
    whole = {r.doc_id: packing.pack([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in docs.collect()}
    bins, seen = defaultdict(list), defaultdict(list)
    for p in packing.pack_documents(docs, path, group_rows=100).collect():
        assert p.ids_crc32 == zlib.crc32(whole[p.doc_id][4 * p.start : 4 * (p.start + p.length)]) and p.doc_tokens == len(whole[p.doc_id]) // 4
        bins[p.sequence_id].append((p.offset, p.length))
        seen[p.doc_id].append((p.start, p.length))
    for spans in [*bins.values(), *seen.values()]:
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
    assert all(sum(n for _, n in x) <= 1024 for x in bins.values())
    assert all(sum(n for _, n in seen[i]) == len(x) // 4 for i, x in whole.items())
    total = sum(len(x) // 4 for x in whole.values())
    assert total > 0.96 * 1024 * len(bins)
    assert packing.pack_documents(none, path).count() == 0


def test_first_fit_decreasing_is_first_fit():
    lengths = [((i * 7919) % 1000) + 1 for i in range(400)]
    free, want = [], {}
    for i in sorted(range(400), key=lambda i: -lengths[i]):
        b = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(1024)
        want[i] = (b, 1024 - free[b])
        free[b] -= lengths[i]
    assert packing.first_fit_decreasing(lengths, 1024) == [want[i] for i in range(400)]
