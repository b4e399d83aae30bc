"""Joins of documents, results and models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions.text import as_column, random_key
from .ordering import numbered
from .sampling import ranked
from .storage import save_point


def last_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row of each key that comes last; a lookup in which later rows overwrite earlier ones."""
    order = W.partitionBy(*keys).orderBy(F.col(seq).desc())
    return df.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def first_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row of each key that comes first."""
    order = W.partitionBy(*keys).orderBy(seq)
    return df.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def lookup(left: DataFrame, right: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """Inner join to the last right row of each key."""
    return left.join(last_per_key(right, [key], seq).drop(seq) if seq else right, key)


def lookup_with_rejects(left: DataFrame, right: DataFrame, key: str, reason: str = "source_missing") -> DataFrame:
    """Left join; `reason` says why a row has no partner."""
    marked = right.withColumn("_hit", F.lit(True))
    return left.join(marked, key, "left").withColumn("reason", F.when(F.col("_hit").isNull(), reason)).drop("_hit")


def align(models: dict[str, DataFrame], key: str, score: str) -> DataFrame:
    """Inner join of models' results by key; a column of scores each."""
    out = None
    for name, df in models.items():
        part = df.select(key, F.col(score).alias(f"{name}_{score}"))
        out = part if out is None else out.join(part, key)
    return out


def mismatches(models: dict[str, DataFrame], key: str) -> DataFrame:
    """For each pair of models, how many keys of the one the other lacks."""
    tagged = None
    for name, df in models.items():
        part = df.select(F.col(key).cast("string").alias("k"), F.lit(name).alias("m")).distinct()
        tagged = part if tagged is None else tagged.union(part)
    sets = tagged.groupBy("k").agg(F.collect_set("m").alias("have"))
    pairs = F.array(*(F.struct(F.lit(a).alias("model"), F.lit(b).alias("other")) for a in models for b in models if a != b))
    lacks = sets.select("have", F.explode(pairs).alias("p")).where(F.array_contains("have", F.col("p.model")) & ~F.array_contains("have", F.col("p.other")))
    return lacks.groupBy(F.col("p.model").alias("model"), F.col("p.other").alias("other")).count()


def regressions(candidate: DataFrame, baseline: DataFrame, threshold: float, fields: Sequence[str] = ("language", "category"), seq: str | None = None) -> DataFrame:
    """Attacks that the candidate misses, joined to the baseline's row of the same corpus and composite key
    (document id, else payload hash, else window hash): scores, their difference, bands, and the candidate's `fields`.
    Rows: corpus, document_id, attack_text_hash, best_window_text_hash, label, score. Of repeated keys the last row by
    `seq` counts. Misses without a baseline row have a null baseline_score."""
    from ..functions.features import score_band
    from ..functions.text import row_key

    key = row_key(F.col("document_id"), F.col("attack_text_hash"), F.col("best_window_text_hash"))
    keyed = lambda d: last_per_key(d.withColumn("_k", F.coalesce(key["kind"], F.lit("window_text_hash"))).withColumn("_v", F.coalesce(key["value"], F.lit(""))), ["corpus", "_k", "_v"], seq) if seq else d.withColumn("_k", F.coalesce(key["kind"], F.lit("window_text_hash"))).withColumn("_v", F.coalesce(key["value"], F.lit("")))
    missed = keyed(candidate).where((F.col("label") == 1) & (F.col("score") < threshold))
    before = keyed(baseline).select("corpus", "_k", "_v", F.col("score").alias("baseline_score"))
    j = missed.join(before, ["corpus", "_k", "_v"], "left")
    named = [F.coalesce(F.nullif(F.col(f).cast("string"), F.lit("")), F.lit("unknown")).alias(f) for f in fields]
    return j.select("corpus", "document_id", F.col("score").alias("candidate_score"), "baseline_score", (F.col("score") - F.col("baseline_score")).alias("score_delta"), score_band("score", "regression").alias("candidate_score_band"), score_band("baseline_score", "regression").alias("baseline_score_band"), *named)


def with_windows(docs: DataFrame, windows: DataFrame, key: str, order: str, fields: Sequence[str]) -> DataFrame:
    """Documents with the ordered array of their windows."""
    lists = windows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *fields))).alias("windows"))
    return docs.join(lists, key, "left")


def long_keys(df: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """(id, kind, value) of all identity keys that are there."""
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys))
    return df.select(F.col(id_col), F.explode(pairs).alias("p")).select(id_col, "p.kind", "p.value").where("value is not null and value <> ''")


def any_key_match(left: DataFrame, right: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """Left ids with the kinds of key in which they meet the right side; kinds and values in one equi-join."""
    theirs = long_keys(right, id_col, keys).select("kind", "value").distinct()
    return long_keys(left, id_col, keys).join(theirs, ["kind", "value"], "left_semi").groupBy(id_col).agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def reconcile(a: DataFrame, b: DataFrame, key: str, value: str, tolerance: float = 1e-8) -> DataFrame:
    """One row of counts: missing, extra, mismatching, matching."""
    j = a.select(key, F.col(value).alias("x"), F.lit(1).alias("ina")).join(b.select(key, F.col(value).alias("y"), F.lit(1).alias("inb")), key, "full")
    both = F.col("ina").isNotNull() & F.col("inb").isNotNull()
    off = F.coalesce(F.abs(F.col("x") - F.col("y")) > tolerance, F.col("x").isNull() != F.col("y").isNull())
    return j.agg(F.count_if(F.col("inb").isNull()).alias("missing"), F.count_if(F.col("ina").isNull()).alias("extra"), F.count_if(both & off).alias("mismatching"), F.count_if(both & ~off).alias("matching"))


#: Bytes of a gram; bits of the filter that the texts' grams pass, at most (a megabyte is 23).
GRAM, MOST_BITS = 8, 26
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(data: bytes | None, n: int) -> np.ndarray:
    """The grams of n bytes of a text, as numbers."""
    b = np.frombuffer(data or b"", np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(b) - n + 1), np.uint64)
    for k in range(n if len(out) else 0):
        out = (out << np.uint64(8)) | b[k : len(b) - n + 1 + k]
    return out


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((grams * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


@F.pandas_udf(ArrayType(LongType()))
def _phrase_grams(phrases: pd.Series) -> pd.Series:
    return phrases.map(lambda p: np.unique(_grams(p, min(len(p), GRAM))).view(np.int64))


def _slots(bits: int):
    @F.pandas_udf(LongType())
    def slot(grams: pd.Series) -> pd.Series:
        return pd.Series(_slot(grams.to_numpy(np.int64).view(np.uint64), bits))

    return slot


def _passing(sent: Broadcast, bits: int, lengths: Sequence[int]):
    """The distinct grams of a text, of each length, that the filter lets pass."""

    @F.pandas_udf(ArrayType(LongType()))
    def passing(texts: pd.Series) -> pd.Series:
        words = sent.value

        def of(data: bytes | None) -> np.ndarray:
            found = [np.zeros(0, np.uint64)]
            for n in lengths:
                grams = _grams(data, n)
                slot = _slot(grams, bits)
                found.append(grams[(words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1])
            return np.unique(np.concatenate(found)).view(np.int64)

        return texts.map(of)

    return passing


def containing(texts: DataFrame, phrases: DataFrame, text_col: str, phrase_col: str, most_bits: int = MOST_BITS) -> DataFrame:
    """(text row, phrase row) of phrases that stand in a text, each pair of rows once. Phrases that are null or empty
    stand in no text.

    An inverted index by the rarest gram: of a phrase's grams of eight bytes (or itself, if shorter) the one that fewest
    phrases of the bank have is its key. Texts are scanned once; their grams pass a filter of the keys, of fixed
    greatest size, and meet the phrases in an equi-join on the gram, which is then checked by the whole phrase. Spark
    sends the phrases to the texts where they are small, and else both by gram; no bank is collected."""
    spark = texts.sparkSession
    bank = phrases.where(F.length(phrase_col) > 0)
    different = bank.select(F.col(phrase_col).cast("string").alias("_p")).distinct()
    grams = save_point(different.select("_p", F.explode(_phrase_grams(F.col("_p").cast("binary"))).alias("_gram")))
    shared = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
    keys = save_point(grams.join(shared, "_gram").groupBy("_p").agg(F.min(F.struct("_n", "_gram")).alias("_k")).select("_p", F.col("_k._gram").alias("_gram")))
    size = keys.agg(F.count_distinct("_gram").alias("n"), F.collect_set(F.least(F.octet_length("_p"), F.lit(GRAM))).alias("lengths")).first()
    bits = min(most_bits, max(12, (32 * size["n"]).bit_length()))
    words = keys.select(_slots(bits)("_gram").alias("s")).select(F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).collect()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[[r["w"] for r in words]] = np.array([r["bits"] for r in words], np.int64).view(np.uint64)
    keyed = _passing(spark.sparkContext.broadcast(table), bits, sorted(size["lengths"]))
    found = texts.withColumn("_gram", F.explode(keyed(F.col(text_col).cast("binary"))))
    met = found.join(keys, "_gram").where(F.contains(F.col(text_col), F.col("_p"))).drop("_gram")
    return met.join(bank.withColumn("_p", F.col(phrase_col).cast("string")), "_p").drop("_p")


def _placed(right: DataFrame, seed: int, right_id: str) -> DataFrame:
    """`right` with `_n`, its number in seeded order from 0."""
    return numbered(right, "_n", random_key(seed, right_id), F.col(right_id)).withColumn("_n", F.col("_n") - 1)


def deal(left: DataFrame, right: DataFrame, seed: int, left_id: str, right_id: str) -> DataFrame:
    """Each left row with one right row, in cycles over both seeded orders: an equi-join on the left row's number modulo
    the right rows, so that two right rows differ by one use at most. Left rows of one id follow one another by their other
    columns. Left rows are numbered in ranges of their hash, in one shuffle."""
    many = right.count()
    if not many:
        return left.join(right.limit(0), F.lit(False), "inner")
    key = random_key(seed, left_id)
    others = [F.col(c) for c in left.columns if c != left_id]
    turns = ranked(left, "_n", F.conv(F.substring(key, 1, 3), 16, 10).cast("int"), [key, F.col(left_id), *others])
    return turns.withColumn("_n", (F.col("_n") - 1) % many).join(_placed(right, seed, right_id), "_n").drop("_n")


def deal_at_random(left: DataFrame, right: DataFrame, seed: int, left_id: str, right_id: str) -> DataFrame:
    """J11 by chance: each left row with the right row that its hash names; uses differ as chance has it, and nothing is
    ordered but the right rows."""
    many = right.count()
    if not many:
        return left.join(right.limit(0), F.lit(False), "inner")
    named = F.pmod(F.conv(F.substring(random_key(seed, left_id), 1, 15), 16, 10).cast("long"), F.lit(many)).cast("int")
    return left.withColumn("_n", named).join(_placed(right, seed, right_id), "_n").drop("_n")


def semi(left: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key is chosen; a narrow key table lets the wide rows be read late."""
    return left.join(keys, on, "left_semi")


def anti(left: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """J7."""
    return left.join(keys, on, "left_anti")


def zip_rows(a: DataFrame, b: DataFrame, order_a: Column | str, order_b: Column | str) -> DataFrame:
    """Rows of two lists side by side, by their numbers in their orders."""
    return numbered(a, "_n", as_column(order_a)).join(numbered(b, "_n", as_column(order_b)), "_n").drop("_n")
