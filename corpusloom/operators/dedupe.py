"""Deduplication policies and repeat reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import as_column, hash_form, mask_template, once, text_hash
from .storage import save_point


def dedupe(df: DataFrame, key: Column | str, *order: Column | str) -> DataFrame:
    """The first row of each key in the order given (input order, or priority then input order). A frequent key
    is cut down to one row where rows are read, before any shuffle."""
    w = W.partitionBy("_k").orderBy(*order)
    return df.withColumn("_k", as_column(key)).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 1).drop("_k", "_r")


def dedupe_conflicts(df: DataFrame, key: Column | str, label: str, *order: Column | str, policy: str = "drop") -> DataFrame:
    """As `dedupe`, but keys with several labels go ('drop'), keep their first row ('first'), or keep one row
    of each label ('ignore')."""
    k = df.withColumn("_k", as_column(key))
    if policy == "ignore":
        return dedupe(k, F.struct("_k", label), *order).drop("_k")
    # the first row of a key, and its labels' range, are both cut down where rows are read
    out = k.withColumn("_r", F.row_number().over(W.partitionBy("_k").orderBy(*order))).where("_r = 1").drop("_r")
    if policy == "drop":
        labels = k.groupBy("_k").agg(F.min(label).alias("_a"), F.max(label).alias("_z")).where(F.col("_a").eqNullSafe(F.col("_z")))
        out = out.join(labels.select(F.col("_k").alias("_same")), F.col("_k").eqNullSafe(F.col("_same")), "left_semi")
    return out.drop("_k")


def cap(df: DataFrame, keys: Sequence[str], most: int | Column, *order: Column | str) -> DataFrame:
    """At most so many rows of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


#: A repeated value is met in so many places, so that a frequent one does not gather in one task.
PLACES = 16


def repeat_counts(df: DataFrame, text_col: str = "text", prefix: int = 80, suffix: int = 100, id_col: str = "doc_id") -> DataFrame:
    """On each row, how many rows have its text, normalised text, prefix and suffix. Ids and hashes alone are
    shuffled: each kind's values are summed where they are read, met again by hash, and joined to the rows by id."""
    kinds, text = ("exact_count", "normalized_count", "prefix_count", "suffix_count"), F.coalesce(F.col(text_col), F.lit(""))
    digests = once(lambda t, n: F.array(*(F.sha2(c, 256) for c in (t, n, F.left(n, F.lit(prefix)), F.right(n, F.lit(suffix))))), t=text, n=hash_form(text_col))
    hashed = df.withColumn("_key", F.struct(F.col(id_col).alias("id"), F.sha2(text, 256).alias("h")))
    # each kind's digest is a column of a written table, so that texts are normalised once and not for each kind
    digested = save_point(hashed.select("_key", digests.alias("d")))
    pairs = F.posexplode("d").alias("kind", "h")
    long = digested.select("_key", pairs).select("_key", "kind", "h", F.pmod(F.xxhash64("_key"), F.lit(PLACES)).cast("int").alias("place"))
    counts = long.groupBy("kind", "h").agg(F.count("*").alias("n")).where("n > 1").withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))))
    met = long.join(counts, ["kind", "h", "place"], "left")
    wide = met.groupBy("_key").agg(*(F.coalesce(F.max(F.when(F.col("kind") == i, F.col("n"))), F.lit(1)).alias(k) for i, k in enumerate(kinds)))
    return hashed.join(wide, "_key").select(*df.columns, *kinds)


def duplicate_report(df: DataFrame, label: str, text_col: str = "text") -> DataFrame:
    """One row: texts that repeat, rows they take, texts with conflicting labels."""
    per = df.groupBy(text_hash(text_col, 64).alias("h")).agg(F.count("*").alias("n"), F.min(label).alias("a"), F.max(label).alias("b"))
    return per.agg(F.count_if(F.col("n") > 1).alias("duplicate_texts"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"), F.count_if((F.col("n") > 1) & (F.col("a") != F.col("b"))).alias("conflicting_texts"))


def template_clusters(df: DataFrame, text_col: str = "text", least: int = 2, sets: Sequence[str] = ()) -> DataFrame:
    """Groups of texts with one masked form: hash, rows, distinct texts, and sorted sets of columns."""
    t = df.select(F.substring(F.sha2(mask_template(text_col), 256), 1, 16).alias("template_hash"), F.sha2(text_col, 256).alias("_t"), *sets)
    joined = [F.array_join(F.sort_array(F.collect_set(F.col(c).cast("string"))), ";").alias(f"{c}_set") for c in sets]
    return t.groupBy("template_hash").agg(F.count("*").alias("rows"), F.count_distinct("_t").alias("texts"), *joined).where(F.col("rows") >= least)
