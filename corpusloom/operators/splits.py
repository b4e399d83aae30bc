"""Train, validation and test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import random_key
from .identity import connected_groups
from .ordering import cut_value, in_ranges, numbered, running, walked
from .sampling import RANGES, ranked, seeded_rank
from .storage import save_point


def hash_share(seed: int, key: str) -> Column:
    """A row's place in [0, 1) of the seeded order."""
    return F.conv(F.substring(random_key(seed, key), 1, 13), 16, 10).cast("double") / F.lit(16.0**13)


def random_split(df: DataFrame, key: str, validation: float | int, seed: int = 42) -> DataFrame:
    """A count takes the first rows of the seeded order; a share takes the hash's range, without any order."""
    if isinstance(validation, float):
        return df.withColumn("split", F.when(hash_share(seed, key) < validation, "validation").otherwise("train"))
    cut = cut_value(df.select(random_key(seed, key).alias("_k")), validation) if validation > 0 else ("", 0, 0)
    last = F.lit(True) if cut is None else random_key(seed, key) <= cut[0]  # rows of one key stay together
    return df.withColumn("split", F.when(last, "validation").otherwise("train"))


def stratified_split(df: DataFrame, key: str, strata: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """round(n x share) rows of each stratum; where a stratum has under two rows, the last key is given up
    for all."""
    strata = list(strata)
    while len(strata) > 1 and df.groupBy(*strata).count().where("count < 2").limit(1).count():
        strata.pop()
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_n")).select(*(F.struct(F.col(c)).alias(f"_s{i}") for i, c in enumerate(strata)), "_n")
    same = F.lit(True)
    for i, c in enumerate(strata):
        same = same & (F.struct(F.col(c)) == F.col(f"_s{i}"))
    t = seeded_rank(df, "_r", key, strata, seed).join(sizes, same)
    return t.select(*df.columns, F.when(F.col("_r") <= F.bround(F.col("_n") * F.lit(share)), "validation").otherwise("train").alias("split"))


def hinted_split(df: DataFrame, key: str, hint: str, strata: Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Fixed rows stay where they must; an unknown hint fails."""
    bad = F.col(hint).isNotNull() & ~F.col(hint).isin("train", "validation", "")
    checked = df.withColumn(hint, F.when(bad, F.raise_error(F.concat(F.lit("unknown split hint: "), F.col(hint))).cast("string")).otherwise(F.col(hint)))
    fixed = F.col(hint).isin("train", "validation")
    free = stratified_split(checked.where(~F.coalesce(fixed, F.lit(False))), key, strata, share, seed)
    return checked.where(fixed).withColumn("split", F.col(hint)).unionByName(free)


def exact_split(df: DataFrame, key: str, label: str, counts: Mapping[str, Mapping[int, int]], seed: int = 42) -> DataFrame:
    """So many rows of each label in each split; rows beyond are left out."""
    out, when = seeded_rank(df, "_r", key, [label], seed), None
    for lab in sorted({x for c in counts.values() for x in c}):
        upto = 0
        for split, per in counts.items():
            upto += per.get(lab, 0)
            hit = (F.col(label) == lab) & (F.col("_r") <= upto)
            when = F.when(hit, split) if when is None else when.when(hit, split)
    return out.withColumn("split", when).where("split is not null").drop("_r")


def strata_totals(df: DataFrame, key: str, strata: Sequence[str], totals: Mapping[str, int], seed: int = 42) -> DataFrame:
    """Three-way split with exact totals, strata by share: rows stand in one order in which each stratum is
    spread evenly, and the totals cut that order."""
    sizes = df.groupBy(*strata).agg(F.count("*").alias("_n")).select(*(F.struct(F.col(c)).alias(f"_s{i}") for i, c in enumerate(strata)), "_n")
    same = F.lit(True)
    for i, c in enumerate(strata):
        same = same & (F.struct(F.col(c)) == F.col(f"_s{i}"))
    even = seeded_rank(df.select(key, *strata), "_r", key, strata, seed).join(sizes, same).select(key, ((F.col("_r") - 0.5) / F.col("_n")).alias("_even"))
    narrow, upto, when = ranked(even, "_p", F.floor(F.col("_even") * RANGES).cast("int"), ["_even", random_key(seed, key)]), 0, None
    for split, n in totals.items():
        upto += n
        when = F.when(F.col("_p") <= upto, split) if when is None else when.when(F.col("_p") <= upto, split)
    return df.join(narrow.select(key, when.alias("split")).where("split is not null"), key)


def group_majority(df: DataFrame, group: str, fields: Sequence[str]) -> DataFrame:
    """The most frequent value of each field in each group, ties to the smaller value, and the group's rows."""
    df = save_point(df.select(group, *fields))
    out = df.groupBy(group).agg(F.count("*").alias("rows"))
    for f in fields:
        c = df.groupBy(group, f).agg(F.count("*").alias("n"))
        best = c.withColumn("_r", F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), f))).where("_r = 1")
        out = out.join(best.select(group, f), group, "left")
    return out


def atomic_split(df: DataFrame, group: str, strata: Sequence[str], shares: Mapping[str, float], seed: int = 42, protected: Mapping[str, str] | None = None, protected_field: str | None = None) -> DataFrame:
    """Whole groups to pools by stratum of their majority attributes; a group goes to the pool in whose share
    the middle of its rows falls, in seeded order; protected values go to their pool."""
    g = save_point(group_majority(df, group, strata))  # read twice to be put in ranges
    g = save_point(running(g, "_p", F.col("rows"), *strata, random_key(seed, group), F.col(group)))  # over all strata, one after another
    whole = g.groupBy(*(F.col(s).alias(f"_g{i}") for i, s in enumerate(strata))).agg(F.min("_p").alias("_first"), F.sum("rows").alias("_all"))
    same = F.lit(True)
    for i, s in enumerate(strata):
        same = same & F.col(s).eqNullSafe(F.col(f"_g{i}"))
    g = g.join(whole, same)
    middle = (F.col("_p") - F.col("_first") + F.col("rows") - F.col("rows") / 2) / F.col("_all")
    upto, when = 0.0, None
    names = list(shares)
    for name in names[:-1]:
        upto += shares[name]
        when = F.when(middle <= upto, name) if when is None else when.when(middle <= upto, name)
    pool = F.lit(names[-1]) if when is None else when.otherwise(names[-1])
    g = g.withColumn("pool", pool)
    if protected and protected_field:
        fixed = F.coalesce(*(F.when(F.col(protected_field) == v, p) for v, p in protected.items()), F.col("pool"))
        g = g.withColumn("pool", fixed)
    return df.join(g.select(group, "pool"), group)


def _first_fit(sizes: DataFrame, group: str, order: Sequence[Column], target: int, slack: float) -> DataFrame:
    """First fit: a group goes to validation while that stays within `slack` times the target. Sums of ranges of the
    order decide whole ranges: one that fits below the target goes in whole, one whose smallest group is too large
    stays out whole. Only those in between are walked, group by group."""
    limit, have, whole = slack * target, 0, []
    t = in_ranges(sizes.select(group, "rows"), *order)
    kind = sizes.schema[group].dataType.simpleString()
    taken = t.select(group).where(F.lit(False))

    def step(have: int, rows: pd.DataFrame) -> tuple[int, pd.DataFrame]:
        keep = []
        for n in rows["rows"]:
            fits = have < target and have + n <= limit
            have += int(n) if fits else 0
            keep.append(fits)
        return have, rows.loc[keep, [group]]

    for r in t.groupBy("_b").agg(F.sum("rows").alias("n"), F.min("rows").alias("least")).orderBy("_b").collect():
        if have >= target:
            break
        if have + r["n"] < target:
            whole.append(r["_b"])
            have += r["n"]
        elif have + r["least"] <= limit:
            part, have = walked(t, order, step, have, f"{group} {kind}", blocks=[r["_b"]])
            taken = taken.unionByName(part)
    taken = taken.unionByName(t.where(F.col("_b").isin(whole)).select(group)).withColumn("_v", F.lit(True))
    return sizes.join(taken, group, "left").select(group, F.when(F.col("_v"), "validation").otherwise("train").alias("split"))


def grouped_split(df: DataFrame, id_col: str, keys: Sequence[str], validation: int, seed: int = 42, slack: float = 1.1) -> DataFrame:
    """Connected groups of rows never straddle; seeded first fit up to 110 % of the target."""
    g = df.join(connected_groups(df, id_col, keys), id_col)
    sizes = g.groupBy("group").agg(F.count("*").alias("rows"))
    return g.join(_first_fit(sizes, "group", [random_key(seed, "group"), F.col("group")], validation, slack), "group")


def cover_split(df: DataFrame, group: str, component: str, validation: int, seed: int = 42) -> DataFrame:
    """First, for each component, the smallest group that has it goes to validation; then the smallest groups
    until the target is reached."""
    sizes = df.groupBy(group).agg(F.count("*").alias("rows"))
    per = df.select(group, component).distinct().join(sizes, group)
    cover = per.withColumn("_r", F.row_number().over(W.partitionBy(component).orderBy("rows", random_key(seed, group)))).where("_r = 1").select(group).distinct().withColumn("_c", F.lit(0))
    ordered = sizes.join(cover, group, "left").withColumn("_c", F.coalesce("_c", F.lit(1)))
    ordered = running(ordered, "_before", F.col("rows"), "_c", "rows", random_key(seed, group), F.col(group))
    plan = ordered.select(group, F.when((F.col("_c") == 0) | (F.col("_before") < validation), "validation").otherwise("train").alias("split"))
    return df.join(plan, group)


def ordered_cut(df: DataFrame, key: str, share: float = 0.75, seed: int | None = None) -> DataFrame:
    """The first share of the list (by key, or by seeded hash) to train, the rest to validation; a list of under four
    is shared by both."""
    n = df.count()
    if n < 4:
        return df.withColumn("split", F.lit("both"))
    t = seeded_rank(df, "_r", key, (), seed) if seed is not None else numbered(df, "_r", key)
    return t.select(*df.columns, F.when(F.col("_r") <= round(n * share), "train").otherwise("validation").alias("split"))


def concatenate(parts: Sequence[DataFrame | None]) -> DataFrame | None:
    """All parts by column name, missing columns null."""
    there = [p for p in parts if p is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), there) if there else None


def remaining(df: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """X15."""
    return df.join(taken.select(key), key, "left_anti")
