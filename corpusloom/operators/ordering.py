"""Orders over all rows in which no task holds them all: numbers, running sums, the first rows, greedy choice under caps,
and walks from block to block.

A total order is cut into ranges, as many as shuffles have partitions. Within a range Spark sorts and counts; what the
driver gets of a range is a number or two.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import save_point

#: Ranges of an order, at most; bounds what the driver gets.
MOST_RANGES = 4096
#: Keys of a histogram's last cell that the driver sorts.
FEW_KEYS = 4096
#: A greedy choice among at most so many rows is made in one task.
SMALL = 20_000
#: Values of a key that can have limits of their own.
MOST_LIMITS = 5000


def in_ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """`df`, written, with `_b`: rows of a smaller range come first in the order. Rows equal in it share a range, so an
    order should end in a unique column."""
    n = max(1, min(MOST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return save_point(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()))


def _starts(t: DataFrame, amount: Column) -> DataFrame:
    """(_b, _s): the sum of `amount` over the ranges before."""
    rows, at = [], 0
    for r in sorted(t.groupBy("_b").agg(F.sum(amount).cast("long").alias("s")).collect()):
        rows.append((r["_b"], at))
        at += r["s"] or 0
    return t.sparkSession.createDataFrame(rows, "_b int, _s long")


def running(df: DataFrame, name: str, amount: Column, *order: Column | str) -> DataFrame:
    """`df` with `name`: the sum of a whole `amount` over all rows before this one in the order."""
    t = in_ranges(df, *order)
    before = W.partitionBy("_b").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("_in", F.coalesce(F.sum(amount).over(before).cast("long"), F.lit(0)))
    return t.join(F.broadcast(_starts(t, amount)), "_b").select(*df.columns, (F.col("_in") + F.col("_s")).alias(name))


def numbered(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """`df` with `name`: a row's number in the order, from 1."""
    return running(df, "_n", F.lit(1), *order).select(*df.columns, (F.col("_n") + 1).alias(name))


def cut_value(keys: DataFrame, n: int) -> tuple[str, int, int] | None:
    """Of a table of one column of hexadecimal texts of one length: the n-th smallest text, how many rows with that text
    are among the first n, and how many there are. None where there are at most n rows.

    The histogram of the first three digits finds the cell of the n-th row, that of the next three refines it, until a
    cell holds one text or few enough rows to be sorted. No rows are ordered, whatever n is."""
    key, prefix, left = keys.columns[0], "", n
    while True:
        here = keys.where(F.col(key).startswith(prefix)) if prefix else keys
        cells = here.groupBy(F.substring(key, 1, len(prefix) + 3).alias("p")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        if not prefix and sum(c["n"] for c in cells) <= n:
            return None
        for cell in sorted(cells, key=lambda c: c["p"]):
            if left <= cell["n"]:
                break
            left -= cell["n"]
        if cell["lo"] == cell["hi"]:
            return cell["lo"], left, cell["n"]
        prefix = cell["p"]
        if cell["n"] <= FEW_KEYS:
            some = sorted(r[0] for r in keys.where(F.col(key).startswith(prefix)).collect())
            value = some[left - 1]
            return value, left - some.index(value), some.count(value)


def first_rows(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The `n` rows with the smallest `key`, hexadecimal digits of one length, as a filter. Of rows with the last key,
    which are interchangeable, as many as fit."""
    if n <= 0:
        return df.where(F.lit(False))
    cut = cut_value(df.select(key.alias("_k")), n)
    if cut is None:
        return df
    value, take, there = cut
    if take == there:
        return df.where(key <= value)
    return df.where(key < value).unionByName(df.where(key == value).limit(take))


class Pass(NamedTuple):
    """One pass of a greedy choice: for each key column the rows that a value of it may have (one limit, or a limit for
    each value and none for others), the rows chosen by the end of the pass, and its own order (else the choice's)."""

    caps: Mapping[str, int | Mapping[object, int]]
    total: int | None = None
    order: Sequence[Column] | None = None


def _limit(column: Column, cap: int | Mapping[object, int]) -> Column:
    if isinstance(cap, int):
        return F.lit(cap)
    if len(cap) > MOST_LIMITS:
        raise ValueError(f"more than {MOST_LIMITS} limits for one key")
    table = F.create_map(*(F.lit(x) for pair in cap.items() for x in pair)) if cap else None
    return F.lit(0) if table is None else F.coalesce(F.element_at(table, column), F.lit(0))


def _earlier(live: DataFrame, column: str, i: int) -> DataFrame:
    """`live` with _n{i} and _a{i}: how many rows, and how many chosen rows, of the row's value come before it. A hot value
    is counted range by range."""
    counts = live.groupBy(column, "_r").agg(F.count("*").alias("n"), F.count_if("_ok").alias("a"))
    w = W.partitionBy(column).orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col(column).alias("_v"), F.col("_r").alias("_q"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_sn"), F.coalesce(F.sum("a").over(w), F.lit(0)).alias("_sa"))
    inside = W.partitionBy(column, "_r").orderBy("_o").rowsBetween(W.unboundedPreceding, -1)
    t = live.withColumn("_in", F.count(F.lit(1)).over(inside)).withColumn("_ia", F.count_if("_ok").over(inside))
    t = t.join(starts, F.col(column).eqNullSafe(F.col("_v")) & (F.col("_r") == F.col("_q")))
    return t.select(*live.columns, (F.col("_in") + F.col("_sn")).alias(f"_n{i}"), (F.col("_ia") + F.col("_sa")).alias(f"_a{i}"))


def _fold(columns: Sequence[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Rows of one table in order; `_l{i}` are their limits, negative where there is none."""
        pdf = pdf.sort_values("_o")
        seen: list[dict] = [{} for _ in columns]
        keys = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in columns]
        limits = [pdf[f"_l{i}"].tolist() for i in range(len(columns))]
        out = []
        for row, ok in enumerate(pdf["_ok"].tolist()):
            if not ok:
                ok = all(lim[row] < 0 or s.get(k[row], 0) < lim[row] for s, k, lim in zip(seen, keys, limits, strict=True))
            if ok:
                for s, k in zip(seen, keys, strict=True):
                    s[k[row]] = s.get(k[row], 0) + 1
            out.append(ok)
        return pdf.assign(_ok=out)[pdf.columns.tolist()]

    return run


def _settled(live: DataFrame, columns: Sequence[str], small: int) -> DataFrame:
    """`live` (columns, _id, _o, _ok, _l{i}) with all its rows decided: `_ok`, or gone."""
    n = live.count()
    if n <= small:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in live.schema)
        return live.groupBy(F.lit(0).alias("_g")).applyInPandas(_fold(columns), schema).where("_ok")
    live = save_point(live.withColumn("_r", F.floor(F.col("_o") / max(1, n // MOST_RANGES + 1))))
    while live.where("not _ok").limit(1).count():
        t = live
        for i, c in enumerate(columns):
            t = _earlier(t, c, i)
        safe, full = F.lit(True), F.lit(False)
        for i in range(len(columns)):
            free = F.col(f"_l{i}") < 0
            safe, full = safe & (free | (F.col(f"_n{i}") < F.col(f"_l{i}"))), full | (~free & (F.col(f"_a{i}") >= F.col(f"_l{i}")))
        live = save_point(t.where(F.col("_ok") | ~full).withColumn("_ok", F.col("_ok") | safe).select(*live.columns))
    return live


def greedy(df: DataFrame, id_col: str, passes: Sequence[Pass], order: Sequence[Column], exempt: Sequence[str] = (), small: int = SMALL) -> DataFrame:
    """(id, pass): the rows that a walk through all rows in the order would choose, taking each whose keys all have room,
    pass after pass, counts going on; what a pass leaves is offered to the next.

    In rounds: a row is chosen as soon as even all undecided rows before it leave room under each of its keys, and
    rejected as soon as chosen rows before it fill one of them; the first undecided row can always be decided. In a
    seeded order the chains of rows that wait for one another are short, so rounds grow with the logarithm of the
    rows. Tables of at most `small` rows are walked in one task, with the same result.

    Ids must be unique. Null is a value as any other, but under keys in `exempt` rows with a null or empty value have
    no limit. An order should end in a unique column; the id is added."""
    kind = df.schema[id_col].dataType
    columns = list(dict.fromkeys(c for p in passes for c in p.caps))
    orders = [[*(p.order or order), F.col(id_col)] for p in passes]
    # keys and orders are made once, however many passes read them
    flat = save_point(df.select(F.col(id_col).alias("_id"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)), *(c.alias(f"_s{n}_{i}") for n, by in enumerate(orders) for i, c in enumerate(by))))
    narrow = flat.select("_id", *(f"_c{i}" for i in range(len(columns))))
    chosen: DataFrame | None = None
    have = 0
    for number, p in enumerate(passes, 1):
        by = [f"_s{number - 1}_{i}" for i in range(len(orders[number - 1]))]
        rows = numbered(flat.select(*narrow.columns, *by), "_o", *by).select(*narrow.columns, "_o", F.lit(False).alias("_ok"))
        if chosen is not None:
            before = narrow.join(chosen.select("_id"), "_id").withColumn("_o", F.lit(-1).cast("long")).withColumn("_ok", F.lit(True))
            rows = rows.join(chosen.select("_id"), "_id", "left_anti").unionByName(before)
        used = [f"_c{columns.index(c)}" for c in p.caps]
        for i, (c, cap) in enumerate(p.caps.items()):
            column = F.col(used[i])
            free = (column.isNull() | (column.cast("string") == "")) if c in exempt else F.lit(False)
            rows = rows.withColumn(f"_l{i}", F.when(free, -1).otherwise(_limit(column, cap)).cast("long"))
        live = rows.select("_id", "_o", "_ok", *used, *(f"_l{i}" for i in range(len(used))))
        new = save_point(_settled(live, used, small).where("_o >= 0").select("_id", "_o"))
        if p.total is not None:
            new = first_rows(new, F.lpad(F.hex("_o"), 16, "0"), p.total - have)
        part = save_point(new.select("_id", F.lit(number).alias("pass")))
        have += part.count()
        chosen = part if chosen is None else chosen.unionByName(part)
    return chosen.select(F.col("_id").cast(kind).alias(id_col), "pass")


def walked(t: DataFrame, order: Sequence[Column | str], step: Callable[[object, pd.DataFrame], tuple[object, pd.DataFrame]], state: object, schema: str, over: Callable[[object], bool] = lambda _: False, blocks: Sequence[int] | None = None) -> tuple[DataFrame, object]:
    """A walk through `t` (from `in_ranges`) that depends on all before: block after block, each in one task that gets the
    state so far, until `over(state)`. `step(state, rows)` gives the new state and the block's result rows of `schema`.
    The driver holds the state only, and no task more than one block."""
    parts, names = [], [f.split()[0].strip("`") for f in schema.split(",")]

    def from_state(now: object) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            after, out = step(now, pdf.sort_values("_place").drop(columns=["_b", "_place"]).reset_index(drop=True))
            last = pd.DataFrame({**{n: [None] for n in names}, "_state": [pickle.dumps(after)]}, dtype=object)
            return pd.concat([out[names].astype(object).assign(_state=None), last])

        return run

    if blocks is None:
        blocks = sorted(r["_b"] for r in t.select("_b").distinct().collect())
    for b in blocks:
        if over(state):
            break
        block = t.where(F.col("_b") == b).withColumn("_place", F.row_number().over(W.partitionBy("_b").orderBy(*order)))
        done = save_point(block.groupBy("_b").applyInPandas(from_state(state), f"{schema}, _state binary"))
        state = pickle.loads(done.where("_state is not null").first()["_state"])
        parts.append(done.where("_state is null").drop("_state"))
    out = t.sparkSession.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out, state
