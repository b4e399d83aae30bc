"""Identity keys: exclusion, leakage, overlap, connected groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import long_signature, text_hash
from .joins import long_keys
from .storage import save_point, shared_dir  # noqa: F401


def exclusion_index(parts: Mapping[str, DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(kind, value, origins) of the locked sets: full text digest, signature of the ends, and id."""
    out = None
    for name, df in parts.items():
        kinds = F.array(F.struct(F.lit("text_hash").alias("kind"), text_hash(text_col, 64).alias("value")), F.struct(F.lit("long_signature").alias("kind"), long_signature(text_col).alias("value")), F.struct(F.lit("document_id").alias("kind"), F.col(id_col).cast("string").alias("value")))
        part = df.select(F.explode(kinds).alias("k")).select("k.kind", "k.value", F.lit(name).alias("origin"))
        out = part if out is None else out.unionByName(part)
    return out.where("value is not null").groupBy("kind", "value").agg(F.sort_array(F.collect_set("origin")).alias("origins"))


def extend_index(index: DataFrame, more: DataFrame) -> DataFrame:
    """The union of two indexes, origins merged."""
    origins = F.array_sort(F.array_distinct(F.flatten(F.collect_list("origins"))))
    return index.unionByName(more).groupBy("kind", "value").agg(origins.alias("origins"))


def exclusion_reasons(df: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text", priority: Sequence[str] = ("text_hash", "document_id", "long_signature")) -> DataFrame:
    """`df` with `reason`: the first kind, in order of priority, by which the index has the row; else null."""
    keys = df.select(F.col(id_col), text_hash(text_col, 64).alias("text_hash"), long_signature(text_col).alias("long_signature"), F.col(id_col).cast("string").alias("document_id"))
    met = long_keys(keys, id_col, priority).join(index.select("kind", "value"), ["kind", "value"], "left_semi")
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("kind"))
    least = met.groupBy(id_col).agg(F.min(rank).cast("int").alias("_p"))
    return df.join(least, id_col, "left").withColumn("reason", F.when(F.col("_p").isNotNull(), F.element_at(F.array(*map(F.lit, priority)), F.col("_p")))).drop("_p")


def leakage(train: DataFrame, locked: DataFrame, train_id: str, locked_id: str, text_col: str = "text") -> DataFrame:
    """(kind, severity, rows, values): exact text and id are hard errors, the signature of the ends a warning."""
    def keys(df: DataFrame, i: str) -> DataFrame:
        named = df.select(F.col(i).cast("string").alias("document_id"), text_hash(text_col, 64).alias("text_hash"), long_signature(text_col).alias("long_signature"))
        return long_keys(named.withColumn("_i", F.col("document_id")), "_i", ["document_id", "text_hash", "long_signature"])

    met = keys(train, train_id).join(keys(locked, locked_id).select("kind", "value").distinct(), ["kind", "value"], "left_semi")
    severity = F.when(F.col("kind") == "long_signature", "warning").otherwise("error")
    return met.groupBy("kind").agg(F.count_distinct("_i").alias("rows"), F.count_distinct("value").alias("values")).withColumn("severity", severity)


def overlap_report(df: DataFrame, split: str, keys: Sequence[str], hard: Sequence[str] = (), samples: int = 20) -> DataFrame:
    """For each key, how many values stand in several splits, some of them, and whether that is an
    error; all keys in one pass."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys))
    long = df.select(F.col(split).alias("s"), F.explode(kinds).alias("k")).select("s", "k.kind", "k.value").where("value is not null and value <> ''")
    shared = long.groupBy("kind", "value").agg(F.min("s").alias("a"), F.max("s").alias("b")).where("a <> b")
    from pyspark.sql import Window as W

    few = shared.withColumn("r", F.row_number().over(W.partitionBy("kind").orderBy("value")))
    counted = few.groupBy("kind").agg(F.count("*").alias("shared"), F.sort_array(F.collect_list(F.when(F.col("r") <= samples, F.col("value")))).alias("samples"))
    all_kinds = df.sparkSession.createDataFrame([(k, k in hard) for k in keys], "kind string, hard boolean")
    return all_kinds.join(counted, "kind", "left").select("kind", "hard", F.coalesce("shared", F.lit(0)).alias("shared"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def connected_groups(df: DataFrame, id_col: str, keys: Sequence[str]) -> DataFrame:
    """(id, group): rows that share any value of any key, directly or through others; the group is its
    smallest id.

    Rows tie to the smallest row of each value (a star, never all pairs). Then every row takes the smallest label
    around it, and the label of its label, until nothing changes: rounds grow with the logarithm of a chain."""
    long = save_point(long_keys(df, id_col, keys).withColumnRenamed(id_col, "id").distinct())
    hubs = long.groupBy("kind", "value").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = save_point(long.join(hubs, ["kind", "value"]).where("id <> hub").select("id", "hub").distinct())
    both = edges.select(F.col("id").alias("a"), F.col("hub").alias("b")).union(edges.select(F.col("hub").alias("a"), F.col("id").alias("b")))
    both = save_point(both)
    label = save_point(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")))
    while True:
        near = both.join(label.select(F.col("a").alias("b"), F.col("l").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        least = label.join(near, "a", "left").select("a", "l", F.least("l", F.coalesce("m", "l")).alias("n"))
        jump = least.join(label.select(F.col("a").alias("n"), F.col("l").alias("p")), "n", "left")
        step = save_point(jump.select("a", "l", F.least("n", F.coalesce("p", "n")).alias("n")))
        changed = step.where("l <> n").limit(1).count()
        label = step.select("a", F.col("n").alias("l"))
        if not changed:
            break
    return df.select(id_col).distinct().join(label.withColumnRenamed("a", id_col), id_col, "left").select(id_col, F.coalesce("l", F.col(id_col)).alias("group"))
