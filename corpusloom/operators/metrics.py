"""Classification metrics, intervals, thresholds and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import safe_div

#: Fixed value: the normal quantile of a 95 % interval.
Z95 = 1.959963984540054
COUNTS = ("tp", "fp", "tn", "fn")


def confusion(label: Column, predicted: Column) -> list[Column]:
    """Counts over 0/1 labels and boolean predictions; rows with a null label are left out."""
    pos, neg = label == 1, label == 0
    return [F.count_if(pos & predicted).alias("tp"), F.count_if(neg & predicted).alias("fp"), F.count_if(neg & ~predicted).alias("tn"), F.count_if(pos & ~predicted).alias("fn")]


def with_rates(df: DataFrame) -> DataFrame:
    """Precision, recall, F1, false positive rate and accuracy of tp, fp, tn, fn."""
    tp, fp, tn, fn = (F.col(c) for c in COUNTS)
    p, r = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    return df.select("*", (tp + fp + tn + fn).alias("documents"), p.alias("precision"), r.alias("recall"), safe_div(2 * p * r, p + r).alias("f1"), safe_div(fp, fp + tn).alias("fpr"), safe_div(tp + tn, tp + fp + tn + fn).alias("accuracy"))


def threshold_metrics(results: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Metrics at each threshold (score >= threshold is positive), overall or by groups. The thresholds
    are conditional sums over one scan; the short list of them is unpivoted after the aggregation."""
    lab, s = F.col(label), F.col(score)
    cells = [F.struct(F.lit(float(t)).alias("threshold"), *(c for c in confusion(lab, s >= t))).alias(f"t{i}") for i, t in enumerate(thresholds)]
    grouped = results.groupBy(*by).agg(*cells) if by else results.agg(*cells)
    return with_rates(grouped.select(*by, F.explode(F.array(*(f"t{i}" for i in range(len(thresholds))))).alias("m")).select(*by, "m.*"))


def grouping_metrics(results: DataFrame, thresholds: Sequence[float], sets: Sequence[Sequence[str]], label: str = "label", score: str = "score") -> DataFrame:
    """Metrics of several groupings in one plan; a column outside its row's grouping is null, and
    `grouping` names the columns inside."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    lab, s = F.col(label), F.col(score)
    cells = [F.struct(F.lit(float(t)).alias("threshold"), *(c for c in confusion(lab, s >= t))).alias(f"t{i}") for i, t in enumerate(thresholds)]
    name = F.concat_ws(",", *(F.when(F.grouping(c) == 0, c) for c in cols)).alias("grouping")
    grouped = results.groupingSets([[F.col(c) for c in x] for x in sets], *(F.col(c) for c in cols)).agg(name, *cells)
    return with_rates(grouped.select("grouping", *cols, F.explode(F.array(*(f"t{i}" for i in range(len(thresholds))))).alias("m")).select("grouping", *cols, "m.*"))


def wilson(successes: Column, total: Column, z: float = Z95) -> Column:
    """struct(low, high); (0, 0) of nothing."""
    n, p = total.cast("double"), safe_div(successes, total)
    denominator = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / denominator
    margin = z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n) / denominator
    low, high = F.greatest(F.lit(0.0), centre - margin), F.least(F.lit(1.0), centre + margin)
    return F.when(total > 0, F.struct(low.alias("low"), high.alias("high"))).otherwise(F.struct(F.lit(0.0).alias("low"), F.lit(0.0).alias("high")))


#: Normal quantiles by the least confidence level that they serve.
LEVELS = ((0.99, 2.5758293035489004), (0.95, Z95), (0.0, 1.6448536269514722))


def wilson_upper(successes: Column, total: Column, level: float = 0.95) -> Column:
    """The interval's upper end by confidence level; 1 of nothing."""
    z = next(z for least, z in LEVELS if level >= least)
    return F.when(total > 0, wilson(successes, total, z)["high"]).otherwise(1.0)


def _by_score(results: DataFrame, label: str, score: str) -> DataFrame:
    """(score, positives, rows): distinct scores, so that what follows is ordered once, after aggregation."""
    return results.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))


def prefix_sums(df: DataFrame, order: Column, columns: Sequence[str], parts: int = 64) -> DataFrame:
    """Running sums of `columns` in the given order as `cum_*`, without ordering all rows in one task: rows are
    range-partitioned, each range summed, and the sums of the (few) ranges carried over."""
    ranged = df.withColumn("_o", order)
    edges = ranged.approxQuantile("_o", [i / parts for i in range(1, parts)], 0.001) if parts > 1 else []
    edges = sorted(set(edges))
    bucket = sum(((F.col("_o") > e).cast("int") for e in edges), F.lit(0))
    ranged = ranged.withColumn("_b", bucket)
    totals = ranged.groupBy("_b").agg(*(F.sum(c).alias(f"_t_{c}") for c in columns))
    before = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_b", *(F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in columns))
    inside = W.partitionBy("_b").orderBy("_o").rangeBetween(W.unboundedPreceding, 0)
    out = ranged.select("*", *(F.sum(c).over(inside).alias(f"_i_{c}") for c in columns)).join(F.broadcast(starts), "_b")
    return out.select(*df.columns, *((F.col(f"_i_{c}") + F.col(f"_s_{c}")).alias(f"cum_{c}") for c in columns))


def ranking_metrics(results: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: positives, negatives, roc_auc (ties count half), average_precision."""
    t = prefix_sums(_by_score(results, label, score), -F.col("s"), ["pos", "n"])
    neg = F.col("n") - F.col("pos")
    # positives that outrank a negative, ties half
    wins = neg.cast("double") * (F.col("cum_pos") - F.col("pos") / 2.0)
    out = t.agg(F.sum("pos").alias("positives"), F.sum(neg).alias("negatives"), F.sum(wins).alias("w"), F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_n"))).alias("p"))
    return out.select("positives", "negatives", safe_div(F.col("w"), F.col("positives") * F.col("negatives")).alias("roc_auc"), safe_div(F.col("p"), F.col("positives")).alias("average_precision"))


def threshold_for_recall(results: DataFrame, least: float, label: str = "label", score: str = "score") -> DataFrame:
    """The threshold of the highest precision with recall >= `least`, else that of the best F1; of equals
    the lowest."""
    t = prefix_sums(_by_score(results, label, score), -F.col("s"), ["pos", "n"])
    total = results.agg(F.sum(F.col(label).cast("long")).alias("all_pos"))
    m = t.crossJoin(F.broadcast(total)).select(F.col("s").alias("threshold"), (F.col("cum_pos") / F.col("cum_n")).alias("precision"), safe_div(F.col("cum_pos"), F.col("all_pos")).alias("recall"))
    m = m.withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    ok = F.col("recall") >= least
    order = [F.when(ok, 0).otherwise(1), F.when(ok, -F.col("precision")).otherwise(-F.col("f1")), F.col("threshold")]
    return m.orderBy(*order).limit(1).withColumn("reached", ok)


def rank_checkpoints(metrics: DataFrame, model: str = "model", least_recall: float = 0.99) -> DataFrame:
    """Models x thresholds over all corpora: enough recall first, then few false positives, then F1."""
    total = with_rates(metrics.groupBy(model, "threshold").agg(*(F.sum(c).alias(c) for c in COUNTS)))
    order = W.orderBy((F.col("recall") >= least_recall).desc(), "fpr", F.desc("f1"), model, "threshold")
    return total.withColumn("place", F.row_number().over(order))


def flatten_models(summaries: DataFrame, model: str, corpus: str, by_threshold: str) -> DataFrame:
    """Summaries with a map of threshold -> struct of counts as rows of model x corpus x threshold."""
    t = summaries.select(model, corpus, F.explode(by_threshold).alias("threshold", "m"))
    return with_rates(t.select(model, corpus, "threshold", *(F.col(f"m.{c}").alias(c) for c in COUNTS)))


def action_metrics(results: DataFrame, action: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates of actions; null is an action of its own."""
    a, n = F.col(action), F.count("*")
    counts = {"block": F.count_if(a == "BLOCK"), "review": F.count_if(a == "REVIEW"), "allow": F.count_if(a == "ALLOW"), "null": F.count_if(a.isNull())}
    rates = [safe_div(counts[k], n).alias(f"{k}_rate") for k in ("block", "review", "allow")]
    return results.groupBy(*by).agg(n.alias("total"), *(c.alias(f"{k}_count") for k, c in counts.items()), *rates)


def action_confusion(results: DataFrame, action: str, label: str, review_is_block: bool, by: Sequence[str] = ()) -> DataFrame:
    """Binary metrics of actions."""
    hit = F.coalesce(F.col(action).isin("BLOCK", "REVIEW") if review_is_block else F.col(action) == "BLOCK", F.lit(False))
    return with_rates(results.groupBy(*by).agg(*confusion(F.col(label), hit)))


def allow_accounting(results: DataFrame, action: str = "action", label: str = "label", baseline: str = "baseline_score", threshold: float = 0.82, by: Sequence[str] = ()) -> DataFrame:
    """Attacks allowed by the baseline alone, by the policy on top of it, and prevented by the policy."""
    attack, base, allowed = F.col(label) == 1, F.col(baseline) < threshold, F.coalesce(F.col(action) == "ALLOW", F.lit(False))
    cells = {"attacks": attack, "baseline_allowed": attack & base, "policy_allowed": attack & allowed, "added_by_policy": attack & allowed & ~base, "prevented_by_policy": attack & base & ~allowed}
    return results.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in cells.items()))


def detection_pattern(*detected: tuple[str, Column]) -> Column:
    """Which models detect a document, as 'a+b', or 'none'."""
    return F.coalesce(F.nullif(F.concat_ws("+", *(F.when(c, n) for n, c in detected)), F.lit("")), F.lit("none"))

