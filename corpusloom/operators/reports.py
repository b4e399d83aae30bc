"""Reports over labelled corpora."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.features import hits, length_bin
from ..functions.text import WORD_CHARS, as_column, once, safe_div, text_or_empty
from .ordering import running
from .storage import save_point


def counts(df: DataFrame, *keys: str, order: bool = False) -> DataFrame:
    """A1, A2: group counts; in falling order, ties by key."""
    out = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return out.orderBy(F.desc("rows"), *keys) if order else out


def summarise(df: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
    """(field, value, rows, positives) of many keys in one pass."""
    t = df.select(F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.col(k).cast("string").alias("value")) for k in keys))).alias("k"), *([label] if label else []))
    extra = [F.sum(F.coalesce(F.col(label).cast("long"), F.lit(0))).alias("positives")] if label else []
    return t.groupBy("k.field", "k.value").agg(F.count("*").alias("rows"), *extra)


def rank_percentile(df: DataFrame, value: str, shares: Sequence[float], rule: str = "round", by: Sequence[str] = ()) -> DataFrame:
    """A3: (share, value) by index into the sorted values: 'round' of (n-1)p (half to even), 'ceil' np - 1, or
    'floor' of (n-1)p. Values are counted before they are ordered, and ordered in ranges, so that no task orders all of them."""
    per = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    per = save_point(running(per, "_p", F.col("c"), *by, "v"))  # over all groups, one after another
    whole = per.groupBy(*(F.col(b).alias(f"_g{i}") for i, b in enumerate(by))).agg(F.min("_p").alias("_first"), F.sum("c").alias("n"))
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_g{i}"))
    per = per.join(whole, same).withColumn("upto", F.col("_p") + F.col("c") - F.col("_first")) if by else per.crossJoin(whole).withColumn("upto", F.col("_p") + F.col("c"))
    index = {"round": lambda p: F.rint((F.col("n") - 1) * p), "ceil": lambda p: F.greatest(F.ceil(F.col("n") * p) - 1, F.lit(0)), "floor": lambda p: F.floor((F.col("n") - 1) * p)}[rule]
    cells = [F.min(F.when(F.col("upto") > index(F.lit(float(p))), F.col("v"))).alias(f"p{i}") for i, p in enumerate(shares)]
    g = per.groupBy(*by).agg(*cells)
    return g.select(*by, F.explode(F.array(*(F.struct(F.lit(float(p)).alias("share"), F.col(f"p{i}").alias("value")) for i, p in enumerate(shares)))).alias("s")).select(*by, "s.share", "s.value")


def numeric_summary(df: DataFrame, value: str, by: Sequence[str] = (), rule: str = "round") -> DataFrame:
    """A3: avg (one decimal), p50, p90, p99, min, max."""
    p = rank_percentile(df, value, (0.5, 0.9, 0.99), rule, by).groupBy(*by).agg(*(F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in ((0.5, "p50"), (0.9, "p90"), (0.99, "p99"))))
    m = df.groupBy(*by).agg(F.count(value).alias("rows"), F.round(F.avg(value), 1).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max"))
    return m.join(p, list(by)) if by else m.crossJoin(p)


def length_summary(df: DataFrame, length: str, label: str) -> DataFrame:
    """A4: rows, positives, their share and mean length of each length bin."""
    pos = F.count_if(F.col(label) == 1)
    return df.groupBy(length_bin(length).alias("length_bin")).agg(F.count("*").alias("rows"), pos.alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"), safe_div(pos, F.count("*")).alias("positive_share"), F.round(F.avg(length), 1).alias("avg_length"))


def entropy(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: groups, entropy (nats), effective count, top share."""
    per = summarise(df, keys)
    p = F.col("rows") / F.sum("rows").over(W.partitionBy("field"))
    return per.withColumn("p", p).groupBy("field").agg(F.count("*").alias("groups"), (-F.sum(F.col("p") * F.ln("p"))).alias("entropy"), F.max("p").alias("top_share")).withColumn("effective_count", F.exp("entropy"))


def divergence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: the Jensen-Shannon divergence (bits) of two distributions of `key`; 0 where one of them is empty."""
    share = lambda d, n: d.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias("c")).select("k", (F.col("c") / F.sum("c").over(W.partitionBy())).alias(n))
    j = share(left, "p").join(share(right, "q"), "k", "full").select(F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    term = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)
    both = (F.max("p") > 0) & (F.max("q") > 0)
    return j.agg(F.when(both, 0.5 * F.sum(term("p")) + 0.5 * F.sum(term("q"))).otherwise(0.0).alias("jsd"))


def document_windows(windows: DataFrame, id_col: str, score: str, threshold: float) -> DataFrame:
    """Windows, positives, scores' least, mean, median and greatest, first and last positive window."""
    hit = F.col(score) >= threshold
    return windows.groupBy(id_col).agg(
        F.count("*").alias("windows"), F.count_if(hit).alias("positive_windows"), F.min(score).alias("min_score"), F.avg(score).alias("mean_score"), F.median(score).alias("median_score"), F.max(score).alias("max_score"),
        F.min(F.when(hit, F.col("window_index"))).alias("first_positive"), F.max(F.when(hit, F.col("window_index"))).alias("last_positive"),
    )


def rate_table(all_rows: DataFrame, some: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `some` per rows of `all_rows` for each key, zero-filled both ways."""
    d, n = all_rows.groupBy(*keys).agg(F.count("*").alias("denominator")), some.groupBy(*keys).agg(F.count("*").alias("numerator"))
    j = d.join(n, list(keys), "full").na.fill(0, ["denominator", "numerator"])
    return j.withColumn("rate", safe_div(F.col("numerator"), F.col("denominator")))


def family_table(df: DataFrame, families: Column, label: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows of each family by label and further conditions."""
    t = df.select(label, F.explode(families).alias("family"), *(c.alias(n) for n, c in conditions.items()))
    pos = F.count_if(F.col(label) == 1)
    return t.groupBy("family").agg(F.count("*").alias("rows"), pos.alias("attack"), F.count_if(F.col(label) == 0).alias("benign"), *(F.count_if(n).alias(n) for n in conditions), safe_div(pos, F.count("*")).alias("attack_share"))


def label_ratios(df: DataFrame, fields: Sequence[str], label: str) -> DataFrame:
    """Share of positives of each value of each field."""
    return summarise(df, fields, label).withColumn("ratio", safe_div(F.col("positives"), F.col("rows")))


def odds_ratio(a: Column, n_a: Column, b: Column, n_b: Column) -> Column:
    """With half a row added to each cell."""
    return ((a + 0.5) / (n_a - a + 0.5)) / ((b + 0.5) / (n_b - b + 0.5))


def marker_odds(df: DataFrame, selected: Column, markers: Sequence[str], text_col: str = "text") -> DataFrame:
    """For each marker: rows that have it among the selected and the others, and the odds ratio. One scan."""
    low = F.lower(text_or_empty(text_col))
    t = df.select(selected.alias("sel"), *(F.contains(low, F.lit(m.lower())).alias(f"m{i}") for i, m in enumerate(markers)))
    g = t.agg(F.count_if("sel").alias("ns"), F.count_if(~F.col("sel")).alias("nb"), *(F.struct(F.lit(m).alias("marker"), F.count_if(F.col("sel") & F.col(f"m{i}")).alias("s"), F.count_if(~F.col("sel") & F.col(f"m{i}")).alias("b")).alias(f"c{i}") for i, m in enumerate(markers)))
    e = g.select("ns", "nb", F.explode(F.array(*(f"c{i}" for i in range(len(markers))))).alias("c"))
    return e.select("c.marker", F.col("c.s").alias("selected"), F.col("c.b").alias("baseline"), odds_ratio(F.col("c.s"), F.col("ns"), F.col("c.b"), F.col("nb")).alias("odds_ratio"))


def ngram_odds(df: DataFrame, selected: Column, lowest: int = 1, highest: int = 3, least: int = 5, text_col: str = "text") -> DataFrame:
    """N-grams of words with at least `least` selected rows: occurrences, rows, rows of the others, odds
    ratio. A row gives each of its n-grams once to count rows, and a selected row all of them to count occurrences; both are
    added up where rows are read, so that a shuffle carries an n-gram once for each task."""
    tokens = F.regexp_extract_all(F.lower(text_or_empty(text_col)), F.lit(f"({WORD_CHARS}+)"))
    t = df.select(selected.alias("sel"), tokens.alias("w"))
    grams = F.flatten(F.transform(F.sequence(F.lit(lowest), F.lit(highest)), lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))).otherwise(F.array().cast("array<string>"))))
    totals = t.agg(F.count_if("sel").alias("ns"), F.count_if(~F.col("sel")).alias("nb"))
    kept = lambda a: F.concat(F.array_distinct(a), F.when(F.col("sel"), a).otherwise(F.array().cast("array<string>")))
    listed = t.select("sel", once(lambda a: F.struct(F.size(F.array_distinct(a)).alias("n"), kept(a).alias("g")), a=grams).alias("l")).select("sel", "l.n", F.posexplode("l.g").alias("i", "ngram"))
    row = F.col("i") < F.col("n")
    sums = listed.groupBy("ngram").agg(F.count_if(~row).alias("occurrences"), F.count_if(row & F.col("sel")).alias("rows"), F.count_if(row & ~F.col("sel")).alias("baseline_rows"))
    return sums.where(F.col("rows") >= least).crossJoin(F.broadcast(totals)).select("ngram", "occurrences", "rows", "baseline_rows", odds_ratio(F.col("rows"), F.col("ns"), F.col("baseline_rows"), F.col("nb")).alias("odds_ratio"))


def group_scores(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    """A27."""
    t = df.groupBy(*keys).agg(F.count("*").alias("rows"), F.avg(score).alias("mean_score"), F.max(score).alias("max_score"))
    return t.withColumn("share", F.col("rows") / F.sum("rows").over(W.partitionBy()))


def density_table(df: DataFrame, density: str, key: str, high: float = 0.05) -> DataFrame:
    """Mean, median, p90 by index, and rows of high density."""
    p = rank_percentile(df, density, (0.9,), "floor", [key]).select(key, F.col("value").alias("p90"))
    m = df.groupBy(key).agg(F.count("*").alias("rows"), F.avg(density).alias("mean"), F.median(density).alias("median"), F.count_if(F.col(density) >= high).alias("high_rows"))
    return m.join(p, key)


def clusters(df: DataFrame, keys: Sequence[str], id_col: str, score: str, samples: int = 3) -> DataFrame:
    """Failure clusters by a composite key: id, rows, mean score, the ids of the highest scores."""
    h = F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)), 256), 1, 12)
    t = df.withColumn("cluster_id", h).withColumn("_r", F.row_number().over(W.partitionBy("cluster_id").orderBy(F.desc(score), id_col)))
    return t.groupBy("cluster_id", *keys).agg(F.count("*").alias("rows"), F.avg(score).alias("mean_score"), F.transform(F.sort_array(F.collect_list(F.when(F.col("_r") <= samples, F.struct("_r", id_col)))), lambda s: s[id_col]).alias("samples"))


def coverage(clusters_: DataFrame, training: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Training rows that match each cluster on each of its keys."""
    out = clusters_
    for k in keys:
        out = out.join(training.groupBy(k).agg(F.count("*").alias(f"train_{k}")), k, "left").na.fill(0, [f"train_{k}"])
    return out


def judge_agreement(df: DataFrame, label: str, judged: str, confidence: str, high: float = 0.8, by: Sequence[str] = ()) -> DataFrame:
    """Rows, agreements, and the same among confident judgments."""
    ok, sure = F.col(label).eqNullSafe(F.col(judged)), F.col(confidence) >= high
    t = df.where(F.col(judged).isNotNull()).groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(ok).alias("agree"), F.count_if(sure).alias("confident"), F.count_if(sure & ok).alias("confident_agree"))
    return t.select("*", safe_div(F.col("agree"), F.col("rows")).alias("agreement"), safe_div(F.col("confident_agree"), F.col("confident")).alias("confident_agreement"))


def regression_summary(df: DataFrame, before: str, after: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows that newly pass or fail the threshold, and mean change."""
    b, a = F.col(before) >= threshold, F.col(after) >= threshold
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(~b & a).alias("new_hits"), F.count_if(b & ~a).alias("lost_hits"), F.count_if(b & a).alias("kept_hits"), F.avg(F.col(after) - F.col(before)).alias("mean_change"))


def review_rollup(df: DataFrame, category: str, windows: str, flagged: Column, label: str) -> DataFrame:
    """Documents, windows, flagged and false positives by category, with a total row."""
    t = df.withColumn("_f", flagged)
    return t.rollup(category).agg(F.grouping(category).cast("int").alias("is_total"), F.count("*").alias("documents"), F.sum(windows).alias("windows"), F.count_if("_f").alias("flagged"), F.count_if(F.col("_f") & (F.col(label) == 0)).alias("false_positives"))


def vote_field(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The candidate column with the most values, the earlier one of equals."""
    there = [c for c in candidates if c in df.columns]
    if not there:
        return None
    row = df.agg(*(F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in there)).first()
    best = max(there, key=lambda c: (row[c], -there.index(c)))
    return best if row[best] else None


def cost_estimate(df: DataFrame, text_col: str = "text", overhead: int = 600, chars_per_token: float = 4.0, price_per_million: float = 1.0) -> DataFrame:
    """A37."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("chars")).withColumn("tokens", F.ceil(F.col("chars") / chars_per_token) + F.col("rows") * overhead).withColumn("cost", F.col("tokens") / 1e6 * price_per_million)


def rejection_report(df: DataFrame, reason: str, id_col: str, samples: int = 3) -> DataFrame:
    """Count and first ids of each reason."""
    r = F.row_number().over(W.partitionBy(reason).orderBy(id_col))
    t = df.where(F.col(reason).isNotNull()).select(reason, id_col, r.alias("_r"))
    return t.groupBy(reason).agg(F.count("*").alias("rows"), F.sort_array(F.collect_list(F.when(F.col("_r") <= samples, F.col(id_col)))).alias("samples"))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """Bounded top-k; a full order makes ties definite."""
    return df.orderBy(*order).limit(k)


def keyword_hits(text: Column | str, phrases: Sequence[str]) -> Column:
    return hits(F.lower(text_or_empty(text)), phrases)


def natural_key(c: Column | str) -> Column:
    """Letters, then the first number as a number."""
    s = as_column(c).cast("string")
    return F.struct(F.regexp_extract(s, "^([^0-9]*)", 1).alias("head"), F.coalesce(F.regexp_extract(s, "([0-9]+)", 1).try_cast("long"), F.lit(-1)).alias("number"), s.alias("all"))


#: Words in the bucket of a benign row, or in the generation of an attack row, by falling priority.
BENIGN_PRIORITY = (("hard", 5), ("near_boundary", 4), ("prod_real", 3), ("neighbor", 2))
ATTACK_PRIORITY = (("embedded", 4), ("wrapper", 3), ("v10", 2))
SCORED_FROM = 4


def priority(name: Column | str, score: Column | None = None, table: Sequence[tuple[str, int]] = BENIGN_PRIORITY) -> Column:
    """struct(rank, score), to order by: the first word of the table that the name has, else 1; the score counts only
    among the ranks from `SCORED_FROM` on, and not for attacks."""
    s, rank = text_or_empty(name), None
    for word, n in table:
        rank = F.when(s.contains(word), n) if rank is None else rank.when(s.contains(word), n)
    rank = rank.otherwise(1)
    return F.struct(rank.alias("rank"), F.when(rank >= SCORED_FROM, F.coalesce(score, F.lit(0.0))).otherwise(0.0).alias("score") if score is not None else F.lit(0.0).alias("score"))
