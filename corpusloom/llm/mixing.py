"""Mixing sources to target weights by Sainte-Lague apportionment; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import WORD, bucket_of, cut

#: Tokens of a block.
BLOCK = 16
#: A document is taken at most so many times.
REPEATS = 3
#: Shards that the mix is dealt to, each with integer quotas of its own.
SHARDS = 16
#: Rows whose positions one task sums up.
SPAN_ROWS = 500


def cyclic_weight(rank: Column) -> Column:
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("long")


def source_targets(totals: DataFrame, repeats: int = REPEATS, weight=cyclic_weight) -> DataFrame:
    """`totals` (source, source_size) with weight and target: all words shared by weight; targets stop at
    `repeats` times the source's size, the excess reshared by weight until none is above.

    Closed form: with sources by rising cap per weight, the first k are capped, where k is the least number at
    which the level of the rest reaches no cap of theirs."""
    every = W.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("weight", weight(F.row_number().over(every))).withColumn("cap", F.lit(repeats) * F.col("source_size"))
    rising = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = W.partitionBy()
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    t = t.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"), (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"), F.sum("source_size").over(whole).alias("total"))
    t = t.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("capped"), F.col("level")))
    t = t.withColumn("water", F.min(fits).over(whole)["level"])
    share = F.col("water") * F.col("weight")
    return t.select("source", "source_size", "weight", "total", F.least(share, F.col("cap").cast("double")).alias("target"))


def apportion(targets: DataFrame, block: int = BLOCK, repeats: int = REPEATS, shards: int = SHARDS) -> DataFrame:
    """`targets` with `quota`: integer blocks by the highest Sainte-Lague quotients target / (2s + 1), and `upto`: the
    source's blocks in the first 1, 2, ... shards.

    The seats are shared out in the order of the quotients, an equal number of them to each shard in turn; so the
    shards' quotas are integers, each shard's mix is near the target weights, and their sums are the quotas.
    Rounding at a shard's divisor gives each source its seats so far but for a few; those few are the highest (or,
    when too many were given, the lowest) quotients near the divisor, of which each source offers as many as it
    can win."""
    house = F.round(F.col("total") / F.lit(block)).cast("long")
    t = targets.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards)))).withColumn("seats", F.floor(house * F.col("shard") / F.lit(shards)).cast("long"))
    whole = W.partitionBy("shard")
    ideal = F.coalesce(F.try_divide(F.col("target") * F.col("seats"), F.lit(float(block)) * house), F.lit(0.0))
    t = t.withColumn("first", F.floor(ideal + 0.5).cast("long")).withColumn("most", F.ceil(F.lit(repeats) * F.col("source_size") / F.lit(block)).cast("long"))
    t = t.withColumn("miss", F.col("seats") - F.sum("first").over(whole))
    t = t.withColumn("offers", F.ceil(F.abs("miss") * F.col("target") / F.greatest(F.col("total"), F.lit(1))).cast("long") + 2)
    up = F.col("miss") > 0
    offers = F.when(up, F.sequence(F.col("first"), F.col("first") + F.col("offers"))).otherwise(F.sequence(F.greatest(F.col("first") - F.col("offers"), F.lit(0)), F.greatest(F.col("first") - 1, F.lit(0))))
    seats = t.where(F.col("miss") != 0).select("shard", "source", "target", "miss", "first", "most", F.explode(offers).alias("seat")).where((up & (F.col("seat") < F.col("most"))) | (~up & (F.col("seat") < F.col("first"))))
    quotient = F.col("target") / (2 * F.col("seat") + 1)
    won = whole.orderBy(F.when(up, -quotient).otherwise(quotient), F.col("source").asc_nulls_last(), "seat")
    moved = seats.withColumn("place", F.row_number().over(won)).where(F.col("place") <= F.abs("miss")).groupBy("shard", "source").agg(F.sum(F.signum("miss")).cast("long").alias("extra"))
    joined = t.alias("t").join(moved.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source")) & (F.col("t.shard") == F.col("m.shard")), "left")
    quota = F.least(F.col("first") + F.coalesce(F.col("extra"), F.lit(0)), F.col("most"))
    every = joined.select("t.source", "source_size", "target", "most", F.struct(F.col("t.shard").alias("shard"), quota.alias("quota")).alias("q"))
    upto = F.transform(F.sort_array(F.collect_list("q")), lambda x: x["quota"])
    return every.groupBy("source", "source_size", "target", "most").agg(upto.alias("upto")).select("source", "source_size", "target", F.element_at("upto", -1).alias("quota"), "most", "upto")


def seeded(seed: str, sep: str, *parts: Column) -> Column:
    """The first 60 bits of a digest."""
    return F.conv(F.substring(F.sha2(F.concat_ws(sep, F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)), 256), 1, 15), 16, 10).cast("long")


def mix_places(docs: DataFrame, seed: str = "mix", block: int = BLOCK, repeats: int = REPEATS, weight=cyclic_weight, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """For each row: doc_id, size, source, source_size, target, h (the seeded digest of id and text), at (where it lies on
    its source's ring), lo and words (the run of the repeated ring that the mix takes), upto (the blocks of the first
    shards).

    A source's documents lie in seeded order on a ring, which repeated gives equal-token blocks, so that any run of
    blocks is a seeded choice among documents, few of which are cut. The shards take their quotas one after another
    from a seeded start. Positions are prefix sums over ranges of the seeded digest, and rows equal in id, source and
    text count as one with its number, so one source's rows, or one id's, spread over many tasks.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), seeded(seed, ":", F.col(id_col).cast("long"), text).alias("h"))
    rows = cut(rows.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("times")))
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))
    quotas = cut(apportion(source_targets(totals, repeats, weight), block, repeats, shards))
    buckets = max(1, -(-rows.count() // SPAN_ROWS))
    rows = rows.withColumn("b", F.floor(F.col("h") / F.lit(2.0**60) * buckets).cast("int")).withColumn("source", F.struct("source")).withColumn("words", F.col("size") * F.col("times"))
    before = W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("source", "b").agg(F.sum("words").alias("n")).select("source", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = W.partitionBy("source", "b").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(starts, ["source", "b"])
    nth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))
    placed = placed.select("doc_id", "source", "size", "h", nth.alias("nth"), (F.col("start") + F.col("inside")).alias("at")).withColumn("at", F.col("at") + F.col("nth") * F.col("size"))
    ring = F.col("source_size")
    blocks = F.greatest(F.floor(ring / F.lit(block)), F.lit(1)).cast("long")
    lo = F.pmod(seeded(seed, "/", F.col("source")), blocks) * block
    q = quotas.select(F.struct("source").alias("source"), "source_size", "target", "upto", lo.alias("lo"), words_of("quota", "target", "source_size", block, repeats).alias("words"))
    return placed.join(q, "source").select("doc_id", "size", F.col("source.source").alias("source"), "source_size", "target", "h", "at", "lo", "words", "upto")


def parts_taken(repeats: int = REPEATS) -> Column:
    """array<struct<place, a, b>>: for each time that the run meets the document, where on the repeated ring, and the words
    [a, b) of the document that it takes."""
    rounds = F.array(*(F.lit(r) * F.col("source_size") for r in range(repeats + 1)))
    start = lambda r: F.greatest(F.col("lo"), F.col("at") + r)
    stop = lambda r: F.least(F.col("lo") + F.col("words"), F.col("at") + r + F.col("size"))
    met = F.transform(rounds, lambda r: F.struct(start(r).alias("place"), (start(r) - F.col("at") - r).alias("a"), (stop(r) - F.col("at") - r).alias("b")))
    return F.filter(met, lambda x: x["b"] > x["a"])


def words_of(quota: str, target: str, source_size: str, block: int, repeats: int) -> Column:
    """Words of a source's quota: its last block is cut or stretched, by less than a block, to what the target leaves, so
    that a source smaller than a block comes near its target too."""
    q, near = F.col(quota), F.floor(F.col(target) + 0.5).cast("long")
    return F.least(F.greatest(F.least(near, (q + 1) * block - 1), (q - 1) * block + 1, F.lit(0)), F.lit(repeats) * F.col(source_size))


def shard_of(place: Column, block: int) -> Column:
    """The shard, from 0, that takes the word at a place of the repeated ring; the last one has what its last block is
    stretched by."""
    return F.least(F.size(F.filter("upto", lambda blocks: blocks * block <= place - F.col("lo"))), F.size("upto") - 1)


def mix_sources(docs: DataFrame, block: int = BLOCK, repeats: int = REPEATS, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, and first_shard (that of the document's first word that the mix takes;
    null where it takes none) for each row of `docs`.

    A null or empty text has size 0 and takes 0. Null sources are one source, last in order. A repeated row
    stands on the ring as often as it comes; rows of one id but different texts stand each for itself. Texts are
    counted whole. An empty table gives an empty result; where no document has a word, all targets are 0. Other
    columns are ignored.
    """
    places = mix_places(docs, block=block, repeats=repeats, **options).withColumn("parts", parts_taken(repeats))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    shard = F.when(F.size("parts") > 0, shard_of(F.col("parts")[0]["place"], block))
    return places.select("doc_id", "size", "source_size", "target", taken.alias("taken"), shard.cast("int").alias("first_shard"))


def mixed_documents(docs: DataFrame, seed: str = "mix", block: int = BLOCK, repeats: int = REPEATS, shard_col: str | None = None, **options) -> DataFrame:
    """The mix itself, with the columns of `docs`: a document comes as often as it is taken whole, and once more
    with each further run of its words (joined by single spaces where it is not the whole text). With `shard_col`,
    a column of that name tells the shard that the part's first word is dealt to.

    Documents without words are not in the mix. Of rows equal in id, source and text one stands for all, as often as
    they are taken. See `mix_sources` for nulls, repeated rows and empty tables."""
    places = mix_places(docs, seed=seed, block=block, repeats=repeats, **options)
    places = places.select(F.struct("doc_id", "source", "size", "h").alias("_key"), "size", "lo", "upto", F.explode(parts_taken(repeats)).alias("_part"))
    places = places.select("_key", "size", "_part", shard_of(F.col("_part.place"), block).alias("_shard"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), seeded(seed, ":", F.col("doc_id").cast("long"), text).alias("h"))
    rows = docs.select(key.alias("_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")).dropDuplicates(["_key"])
    out = rows.join(places, "_key")
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"({WORD})"))
    a, b = F.col("_part.a"), F.col("_part.b")
    part = F.when((a == 0) & (b == F.col("size")), F.col("_row.text")).otherwise(F.array_join(F.slice(words, a.cast("int") + 1, (b - a).cast("int")), " "))
    return out.select(*((part if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns), *([F.col("_shard").alias(shard_col)] if shard_col else []))
