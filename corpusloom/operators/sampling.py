"""Seeded sampling, quotas and capped selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import random_key
from .ordering import SMALL, Pass, first_rows, greedy, in_ranges, running, walked


def seeded_sample(df: DataFrame, key: str, seed: int = 42, fraction: float | None = None, most: int | None = None) -> DataFrame:
    """A share of the rows by the range of their seeded hash, or the first `most` in its order; either is a filter."""
    k = random_key(seed, key)
    if fraction is not None:
        df = df.where(F.conv(F.substring(k, 1, 13), 16, 10).cast("double") < F.lit(fraction * 16.0**13))
    return first_rows(df, k, most) if most is not None else df


#: Ranges that an order is cut into, so that many tasks number the rows of one group.
RANGES = 4096


def ranked(df: DataFrame, name: str, bucket: Column, order: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    """`df` with `name`, the number of a row from 1 within its group in the given order. `bucket` is a whole number that
    never falls in that order: rows are numbered in their range, and ranges start where those before end."""
    t = df.withColumn("_b", bucket)
    starts = t.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select(*(F.struct(F.col(c)).alias(f"_g{i}") for i, c in enumerate(by)), F.col("_b").alias("_sb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    t = t.withColumn("_i", F.row_number().over(W.partitionBy(*by, "_b").orderBy(*order)))
    same = F.col("_b") == F.col("_sb")
    for i, c in enumerate(by):
        same = same & (F.struct(F.col(c)) == F.col(f"_g{i}"))
    return t.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_i")).alias(name))


def seeded_rank(df: DataFrame, name: str, key: str, by: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """`ranked` by seeded hash, whose first digits are the range."""
    k = random_key(seed, key)
    return ranked(df, name, F.conv(F.substring(k, 1, 3), 16, 10).cast("int"), [k], by)


def sample_per_group(df: DataFrame, group: Sequence[str], key: str, most: int | Column, seed: int = 42) -> DataFrame:
    """A uniform choice of each group: its first rows by seeded hash. Spark cuts groups down to
    `most` rows before the shuffle where `most` is a constant."""
    order = W.partitionBy(*group).orderBy(random_key(seed, key))
    return df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")


def largest_remainder(counts: DataFrame, total: int, key: str, weight: str = "rows") -> DataFrame:
    """Q3: counts with `quota`: floors of the exact shares, then one more for the largest fractions, ties by key."""
    exact = F.col(weight) * F.lit(total) / F.sum(weight).over(W.partitionBy())
    t = counts.withColumn("_e", exact).withColumn("_f", F.floor("_e").cast("long"))
    t = t.withColumn("_rest", F.lit(total) - F.sum("_f").over(W.partitionBy()))
    rank = F.row_number().over(W.orderBy(F.desc(F.col("_e") - F.col("_f")), key))
    return t.withColumn("quota", F.col("_f") + (rank <= F.col("_rest")).cast("long")).drop("_e", "_f", "_rest")


def drift_quota(weights: Mapping[str, float], total: int, absorber: str) -> dict[str, int]:
    """Q4: rounded shares (half to even); one named key takes up what is left over or short."""
    whole = sum(weights.values())
    out = {k: round(w * total / whole) for k, w in weights.items()}
    out[absorber] += total - sum(out.values())
    return out


def cyclic_quota(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Q5: rounded shares, corrected one by one in cycles by falling weight."""
    whole = sum(weights.values())
    out = {k: round(w * total / whole) for k, w in weights.items()}
    keys, i = sorted(weights, key=lambda k: (-weights[k], k)), 0
    while (gap := total - sum(out.values())) and keys:
        k = keys[i % len(keys)]
        if gap > 0 or out[k] > 0:
            out[k] += 1 if gap > 0 else -1
        i += 1
    return out


def leading_quota(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Q6: floors, the remainder to the first keys."""
    whole = sum(weights.values())
    out = {k: math.floor(w * total / whole) for k, w in weights.items()}
    for k in list(out)[: total - sum(out.values())]:
        out[k] += 1
    return out


def water_fill(total: int, availability: Mapping[str, int], weights: Mapping[str, float] | None = None) -> dict[str, int]:
    """Q7: shares by weight, never above what there is; what a full key cannot take goes to the rest."""
    weights = dict(weights or dict.fromkeys(availability, 1.0))
    out, left = dict.fromkeys(availability, 0), min(total, sum(availability.values()))
    while left:
        open_ = [k for k in availability if out[k] < availability[k]]
        share = leading_quota({k: weights[k] for k in open_}, left)
        before = left
        for k in open_:
            add = min(share[k], availability[k] - out[k])
            out[k], left = out[k] + add, left - add
        if left == before:
            break
    return out


def nested_quota(outer: Mapping[str, int], inner: Mapping[str, float]) -> dict[tuple[str, str], int]:
    """Q8."""
    return {(o, i): n for o, total in outer.items() for i, n in leading_quota(inner, total).items()}


def take_quota(df: DataFrame, quotas: DataFrame, keys: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """The first rows by seeded hash of each group, as many as `quotas` (keys, quota) says. Groups are numbered in ranges of
    the hash, so a huge one is many tasks'."""
    q = seeded_rank(df, "_r", key, keys, seed).join(quotas.select(*keys, "quota"), list(keys))
    return q.where(F.col("_r") <= F.col("quota")).drop("_r", "quota")


def quota_with_refill(df: DataFrame, quotas: DataFrame, keys: Sequence[str], key: str, total: int, seed: int = 42) -> DataFrame:
    """Q9, Q10, Q18: quotas first; what some groups lack is filled from the rest, rows in seeded order. `phase` is
    1 or 2."""
    q = seeded_rank(df, "_r", key, keys, seed).join(quotas.select(*keys, "quota"), list(keys), "left").withColumn("_k", random_key(seed, key))
    q = q.withColumn("phase", F.when(F.col("_r") <= F.coalesce("quota", F.lit(0)), 1).otherwise(2)).drop("_r")
    first = q.where("phase = 1")
    rest = first_rows(q.where("phase = 2"), F.col("_k"), total - first.count())
    return first.unionByName(rest).drop("quota", "_k")


def capped(df: DataFrame, caps: Mapping[str, int], key: str, seed: int = 42) -> DataFrame:
    """Q12, Q13 at scale: a row stays if its rank by seeded hash is within the cap of every key. Stricter than the
    sequential fold: a row over one cap does not free its place under another."""
    out = df
    for i, column in enumerate(caps):
        out = seeded_rank(out, f"_r{i}", key, [column], seed)
    ok = F.lit(True)
    for i, most in enumerate(caps.values()):
        ok = ok & (F.col(f"_r{i}") <= most)
    return out.where(ok).drop(*(f"_r{i}" for i in range(len(caps))))


def cap_fold(df: DataFrame, caps: Mapping[str, int | Mapping[object, int]], total: int | None, key: str, seed: int = 42, priority: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """Q11, Q12, exact: rows in order of priority, then seeded hash; each is taken if no cap of its keys is reached, and
    `total` in all. `key` must be unique."""
    chosen = greedy(df, key, [Pass(caps, total)], [*map(F.col, priority), random_key(seed, key)], small=small)
    return df.join(chosen, key, "left_semi")


def targeted_sample(df: DataFrame, group: str, targets: Mapping[object, int], source: str, source_cap: int, total: int, key: str, seed: int = 42, small: int = SMALL) -> DataFrame:
    """Q11 whole: first by the groups' targets under the cap of a source; then, while rows are lacking, by the source's
    cap alone. `pass` is 1 or 2."""
    passes = [Pass({group: targets, source: source_cap}, total), Pass({source: source_cap}, total)]
    return df.join(greedy(df, key, passes, [random_key(seed, key)], small=small), key)


def capped_build(df: DataFrame, component: str, targets: Mapping[str, int], caps: Mapping[str, int | Mapping[object, int]], total: int, key: str, language: str | None = None, least: Mapping[object, int] | None = None, exempt: Sequence[str] = (), seed: int = 42, small: int = SMALL) -> DataFrame:
    """Q12 whole: components in the order of `targets`, each up to its target (others last and whole), under all `caps`; then what is left, in a
    new seeded order, first of languages below their `least` rows, then of any, up to `total`. Rows with a null or
    empty value of an `exempt` key are not capped by it. `pass` is 1 to 3."""
    place = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in zip(targets, range(len(targets)), strict=True) for x in pair)), F.col(component)), F.lit(len(targets)))
    df = df.withColumn("_component", F.when(F.col(component).isin(list(targets)), F.col(component)))
    first = Pass({"_component": targets, **caps}, None, [place, random_key(seed, key)])
    again = [random_key(seed + 1, key)]
    low = []
    if language and least:
        most = caps.get(language)
        room = {k: n if most is None else min(n, most if isinstance(most, int) else most.get(k, 0)) for k, n in least.items()}
        low = [Pass({**caps, language: room}, total, again)]
    passes = [first, *low, Pass(caps, total, again)]
    return df.join(greedy(df, key, passes, again, [*exempt, "_component"], small), key).drop("_component")


def band_mix(df: DataFrame, band: str, shares: Mapping[str, float], total: int, caps: Mapping[str, int], key: str, seed: int = 42) -> DataFrame:
    """Q13: band targets under caps, then what is left of other bands."""
    quotas = df.sparkSession.createDataFrame([(b, n) for b, n in leading_quota(shares, total).items()], f"{band} string, quota long")
    return quota_with_refill(capped(df, caps, key, seed), quotas, [band], key, total, seed)


def bundle_counts(a: int, b: int, got_a: int, got_b: int, want_a: int, want_b: int, least_benign: int = 2) -> tuple[int, int]:
    """The counts (attack, benign) of at most (a, b) and of what the targets still lack that bring the ratio nearest to
    the targets', the most rows of equal ones. For each attack count the error falls, then rises with the benign count, so
    that only the counts beside the exact one, and the ends of the range and of its penalty, can be best."""
    most_a, most_b, least = max(min(a, want_a - got_a), 0), max(min(b, want_b - got_b), 0), min(least_benign, b)
    best = (math.inf, 0, 0)
    for x in range(most_a + 1):
        level = (got_a + x) * want_b
        exact = level // want_a - got_b if want_a else most_b
        for y in {min(max(y, 0), most_b) for y in (exact, exact + 1, least - 1, least, 0, 1, most_b)}:
            if x + y:
                error = abs(level - (got_b + y) * want_a) + (want_a + want_b) * (y < least) - 1e-6 * (x + y)
                best = min(best, (error, x, y))
    return best[1], best[2]


def carrier_bundles(df: DataFrame, carrier: str, label: str, targets: tuple[int, int], key: str, seed: int = 42, least_benign: int = 2) -> DataFrame:
    """Q14: whole bundles of a carrier, in seeded order, each cut to the counts (attack, benign) that bring the
    running ratio nearest to the targets' ratio, with at least two benign rows where it has them. Carriers are walked
    block by block, until both targets are reached."""
    sizes = df.groupBy(carrier).agg(F.count_if(F.col(label) == 1).alias("a"), F.count_if(F.col(label) == 0).alias("b"))
    want_a, want_b = targets

    def step(got: tuple[int, int], rows: pd.DataFrame) -> tuple[tuple[int, int], pd.DataFrame]:
        out = []
        for c, a, b in rows[[carrier, "a", "b"]].itertuples(index=False, name=None):
            best = bundle_counts(a, b, *got, want_a, want_b, least_benign)
            got = got[0] + best[0], got[1] + best[1]
            out.append((c, *best))
        return got, pd.DataFrame(out, columns=[carrier, "take_a", "take_b"])

    order = [random_key(seed, carrier), F.col(carrier)]
    kind = df.schema[carrier].dataType.simpleString()
    plan, _ = walked(in_ranges(sizes, *order), order, step, (0, 0), f"{carrier} {kind}, take_a long, take_b long", over=lambda got: got == (want_a, want_b))
    t = df.join(plan, carrier).withColumn("_r", F.row_number().over(W.partitionBy(carrier, label).orderBy(random_key(seed, key))))
    return t.where(F.col("_r") <= F.when(F.col(label) == 1, F.col("take_a")).otherwise(F.col("take_b"))).drop("_r", "take_a", "take_b")


def rebalance(df: DataFrame, label: str, ratio: float, key: str, seed: int = 42, bin_col: str | None = None) -> DataFrame:
    """Q15: all positives and `ratio` negatives for each; with a bin, negatives by the positives' histogram."""
    pos, neg = df.where(F.col(label) == 1), df.where(F.col(label) == 0)
    total = round(pos.count() * ratio)
    if bin_col is None:
        return pos.unionByName(seeded_sample(neg, key, seed, most=total))
    quotas = largest_remainder(pos.groupBy(bin_col).agg(F.count("*").alias("rows")), total, bin_col)
    return pos.unionByName(quota_with_refill(neg, quotas, [bin_col], key, total, seed).drop("phase"))


def half_and_half(df: DataFrame, label: str, total: int, key: str, seed: int = 42) -> DataFrame:
    """Q16: half of each label, then the other label's rest."""
    quotas = df.sparkSession.createDataFrame([(0, total // 2), (1, total // 2)], f"{label} int, quota long")
    return quota_with_refill(df.withColumn(label, F.col(label).cast("int")), quotas, [label], key, total, seed).drop("phase")


def take_until(df: DataFrame, units: str, target: int, by: Sequence[str], *order: Column | str) -> DataFrame:
    """Rows until their units reach the target; the row that passes it is still taken."""
    if not by:
        return running(df, "_u", F.col(units), *order).where(F.col("_u") < target).drop("_u")
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("_u", F.coalesce(F.sum(units).over(w), F.lit(0))).where(F.col("_u") < target).drop("_u")


def hard_examples(windows: DataFrame, target: int, per_document: int = 2, per_source: int | None = None, unsafe: str | None = None, unsafe_cap: int = 0, gap: int = 128, id_col: str = "doc_id", source: str = "source_name", seed: int = 42) -> DataFrame:
    """T5, exact: windows (id, window_index, token_start, score, source), documents in seeded order, each one's by
    falling score: one is taken if its document, its source and, where the column `unsafe` is true, all unsafe
    sources have room, and if it starts `gap` tokens or more from those taken of the document; `target` at most. The
    walk goes block by block and ends at the target; its state is a count for each source."""
    most = target if per_source is None else per_source

    def step(state: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
        sources, doc, starts, n, n_unsafe = state
        keep = []
        for d, s, start, risky in rows[[id_col, source, "token_start", "_risky"]].itertuples(index=False, name=None):
            if d != doc:
                doc, starts = d, []
            ok = n < target and len(starts) < per_document and sources.get(s, 0) < most and not (risky and n_unsafe >= unsafe_cap) and all(abs(start - x) >= gap for x in starts)
            if ok:
                starts = [*starts, start]
                sources[s], n, n_unsafe = sources.get(s, 0) + 1, n + 1, n_unsafe + bool(risky)
            keep.append(ok)
        return (sources, doc, starts, n, n_unsafe), rows.loc[keep, ["_id"]]

    risky = F.coalesce(F.col(unsafe).cast("boolean"), F.lit(False)) if unsafe else F.lit(False)
    t = windows.withColumn("_risky", risky).withColumn("_id", F.concat_ws(":", F.col(id_col).cast("string"), F.col("window_index").cast("string")))
    order = [random_key(seed, id_col), F.col(id_col), F.desc("score"), F.col("window_index")]
    narrow = in_ranges(t.select(id_col, source, "token_start", "_risky", "_id", "score", "window_index"), *order)
    chosen, _ = walked(narrow, order, step, ({}, None, [], 0, 0), "_id string", over=lambda state: state[3] >= target)
    return t.join(chosen, "_id", "left_semi").drop("_id", "_risky")


def scan_until(df: DataFrame, accept: Column, most: int, scan: int, *order: Column | str, distinct: str | None = None) -> DataFrame:
    """The first `most` accepted rows among the first `scan` rows in order, each value of `distinct` once; what
    follows is not looked at."""
    t = df.orderBy(*order).limit(scan).where(accept)
    if distinct:
        t = t.withColumn("_r", F.row_number().over(W.partitionBy(distinct).orderBy(*order))).where("_r = 1").drop("_r")
    return t.orderBy(*order).limit(most)


def unique_rendered(spark, most: int, template: str, seed: int = 42, tries: int = 4, **options: Sequence[str]) -> DataFrame:
    """Q20: up to `most` different texts from a template, in seeded order."""
    from ..functions.text import render

    made = spark.range(most * tries).select("id", render(template, F.concat_ws(":", F.lit(seed), F.col("id").cast("string")), **options).alias("text"))
    first = made.groupBy("text").agg(F.min("id").alias("id"))
    return first.orderBy("id").limit(most)
