"""Gates and audits: assertions over aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import normalize, safe_div, text_hash
from .reports import label_ratios

#: Comparisons of gates.
RULES = {"lt": lambda v, t: v < t, "lte": lambda v, t: v <= t, "gt": lambda v, t: v > t, "gte": lambda v, t: v >= t, "eq": lambda v, t: v == t}


def reasons(*checks: tuple[str, Column]) -> Column:
    """The name of the first check that holds, cheap ones first; null if none does."""
    return F.coalesce(*(F.when(c, n) for n, c in checks), F.lit(None).cast("string"))


def split_rejects(df: DataFrame, *checks: tuple[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected with `reason`)."""
    marked = df.withColumn("reason", reasons(*checks))
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def prepared(text: Column, least: int, most: int, corrupted: Column, truncate: bool = False) -> Column:
    """The text to use, or null."""
    cut = F.left(text, F.lit(most)) if truncate else F.when(F.length(text) <= most, text)
    return F.when((F.length(text) >= least) & ~corrupted, cut)


def consistent(label: Column, signal: Column) -> Column:
    """Positives show the signal, negatives do not."""
    return (label == 1).eqNullSafe(signal)


def curate(rows: DataFrame, judgments: DataFrame, key: str, rule_ok: Column, least: float = 0.8) -> DataFrame:
    """P5: a judgment sure enough overrules the rules' evidence; `decision` says which decided."""
    j = judgments.select(key, F.col("label").alias("_l"), F.col("confidence").alias("_c"))
    out = rows.join(j, key, "left")
    sure = F.coalesce(F.col("_c") >= least, F.lit(False))
    keep = F.when(sure, F.col("_l") == "attack").otherwise(rule_ok)
    decision = F.when(sure & keep, "judged_attack").when(sure, "judged_benign").when(keep, "rule_evidence").otherwise("no_evidence")
    return out.withColumn("keep", keep).withColumn("decision", decision).drop("_l", "_c")


def mined(df: DataFrame, label: str, score: str, threshold: float, kind: str) -> DataFrame:
    """Missed positives ('fn') or false alarms ('fp')."""
    return df.where((F.col(label) == 1) & (F.col(score) < threshold)) if kind == "fn" else df.where((F.col(label) == 0) & (F.col(score) >= threshold))


def reviewed_allowed(control: Column, reviewed: Column, context: Column) -> Column:
    """A window with a control pattern needs a review flag and a fitting context."""
    return ~control | (reviewed & context)


def first_of(df: DataFrame, key: Column, eligible: Column, order: Sequence[str]) -> DataFrame:
    """`df` with `_first`: whether an eligible row is the first eligible one of its key. Rows meet the first of their key by
    its place in the order too, so that neither a frequent key nor the rows that are not eligible gather in one task."""
    t = df.withColumn("_e", eligible).withColumn("_k", F.when(F.col("_e"), key))
    least = t.where("_e").groupBy("_k").agg(F.min(F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)))).alias("_o")).select(F.col("_k").alias("_lk"), "_o.*")
    same = F.col("_k") == F.col("_lk")
    for i, c in enumerate(order):
        same = same & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    return t.join(least, same, "left").withColumn("_first", F.col("_lk").isNotNull()).drop("_e", "_k", "_lk", *(f"_o{i}" for i in range(len(order))))


#: Spellings of the classes in mined rows.
BENIGN_LABELS, ATTACK_LABELS = ("0", "benign", "safe", "not_prompt_injection", "non_injection"), ("1", "attack", "malicious", "prompt_injection", "injection")


def mined_benign(df: DataFrame, control: str, context: str, pools: Sequence[str], threshold: float, order: Sequence[str], text: str = "text", canonical: bool = False) -> DataFrame:
    """Mined benign rows (label, score, source_pool, reviewed, text) with `reason`, null for usable ones, and
    `near_boundary`: whether the text has the control pattern. Such rows need a review and a fitting context. Of repeated
    texts the first usable one counts. `canonical` (P7): an empty label will do, texts are told apart before pools are
    looked at, and near-boundary rows stay."""
    label, t = F.lower(F.trim(F.coalesce(F.col("label").cast("string"), F.lit("")))), normalize(text)
    pool = F.coalesce(F.col("source_pool"), F.lit(""))
    bad_label = ~label.isin(*BENIGN_LABELS, *([""] if canonical else []))
    early = [("not_benign_label", bad_label), ("below_score_threshold", F.coalesce(F.col("score"), F.lit(0.0)) < threshold), ("missing_text", t == "")]
    pooled = [("missing_source_pool", pool == ""), ("disallowed_source_pool", ~pool.isin(*pools))] if canonical else [("missing_or_disallowed_source_pool", ~pool.isin(*pools))]
    before = early if canonical else early + pooled
    near = t.rlike("(?iu)" + control)
    late = pooled if canonical else [("near_boundary_without_review", near & ~F.coalesce(F.col("reviewed").cast("boolean"), F.lit(False))), ("near_boundary_without_context", near & ~t.rlike("(?iu)" + context))]
    # what is read from the text is told before rows meet, so that who needs no text moves none
    told = df.withColumn("near_boundary", near).withColumn("_before", reasons(*before)).withColumn("_late", reasons(*late))
    marked = first_of(told, text_hash(text, 64), F.col("_before").isNull(), order)
    return marked.withColumn("reason", F.coalesce("_before", F.when(~F.col("_first"), "duplicate_text_hash"), "_late")).drop("_first", "_before", "_late")


def derived_anchor(text: Column, attack: Column, anchors: Sequence[str], control: str) -> Column:
    """The longest of the anchors that stands in the texts, ties by place in the list; else what the control pattern
    matches; else empty."""
    both = F.concat_ws(" ", text, attack)
    known = [F.when(F.contains(F.lower(both), F.lit(a.lower())), F.lit(a)) for a in sorted(anchors, key=len, reverse=True)]
    found = normalize(F.regexp_extract(both, "(?iu)(" + control + ")", 0))
    return F.coalesce(*known, found)


def visible_misses(df: DataFrame, control: str, filler: str, pools: Sequence[str], order: Sequence[str], text: str = "text", anchors: Sequence[str] | None = None) -> DataFrame:
    """Missed attacks (label, source_pool, anchor, attack_text, visible, text) with `anchor` and `reason`, null for usable ones. With
    `anchors` (P7) a missing anchor is derived, and an empty label will do."""
    label, t = F.lower(F.trim(F.coalesce(F.col("label").cast("string"), F.lit("")))), normalize(text)
    pool, given = F.coalesce(F.col("source_pool"), F.lit("")), normalize("anchor")
    if anchors is not None:
        given = F.when(given != "", given).otherwise(derived_anchor(t, normalize("attack_text"), anchors, control))
    named = df.withColumn("anchor", given)
    a = F.col("anchor")
    signal, seen = ("anchor_without_model_control_signal", ~a.rlike("(?iu)" + control)), ("anchor_not_visible_in_window", ~F.contains(F.lower(t), F.lower(a)))
    there = [("missing_attack_anchor_text", a == ""), ("filler_attack_anchor_text", a.rlike("(?iu)" + filler))]
    if anchors is None:
        checks = [("not_attack_label", ~label.isin(*ATTACK_LABELS)), ("missing_window_text", t == ""), ("missing_or_disallowed_source_pool", ~pool.isin(*pools)), *there, signal, seen]
    else:
        checks = [("not_attack_label", ~label.isin(*ATTACK_LABELS, "")), ("missing_window_text", t == ""), *there, seen, signal, ("missing_source_pool", pool == ""), ("disallowed_source_pool", ~pool.isin(*pools))]
    checks += [("missing_review_or_visible_flag", ~F.coalesce(F.col("visible").cast("boolean"), F.lit(False)))]
    marked = first_of(named.withColumn("_before", reasons(*checks)), text_hash(text, 64), F.col("_before").isNull(), order)
    return marked.withColumn("reason", F.coalesce("_before", F.when(~F.col("_first"), "duplicate_text_hash"))).drop("_first", "_before")


def validation(marked: DataFrame, usable: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """(name, rows, least, passed) of each reason and of each kind of usable rows against its least number."""
    ok = F.col("reason").isNull()
    cells = F.array(*(F.struct(F.lit(n).alias("name"), F.count_if(ok & c).alias("rows"), F.lit(least).cast("long").alias("least")) for n, (c, least) in usable.items()))
    kinds = marked.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")
    rejected = marked.where(~ok).groupBy(F.col("reason").alias("name")).agg(F.count("*").alias("rows")).withColumn("least", F.lit(None).cast("long"))
    return kinds.unionByName(rejected).withColumn("passed", F.when(F.col("least").isNotNull(), F.col("rows") >= F.col("least")))


def good_anchor(text: Column, anchor: Column, control: str, filler: Sequence[str] = ()) -> Column:
    """Stands in the text, is no filler, and shows control."""
    return (anchor != "") & F.contains(F.lower(text), F.lower(anchor)) & ~F.lower(F.trim(anchor)).isin(*filler, "") & F.lower(anchor).rlike(control)


def by_spec(label: Column, spec: Mapping[str, Any]) -> Column:
    """P10: rows that a source's spec counts as its class."""
    return F.lower(label.cast("string")).isin(*map(str, spec["labels"])) if spec.get("labels") else F.lit(True)


def not_identifier(text: Column) -> Column:
    """No bare identifier."""
    return ~F.trim(text).rlike("^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")


def marked_unsafe(markers: Sequence[str], *names: Column) -> Column:
    """P13."""
    blob = F.lower(F.concat_ws(" ", *names))
    hit = F.lit(False)
    for m in markers:
        hit = hit | F.contains(blob, F.lit(m.lower()))
    return hit


def gate(metrics: DataFrame, gates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Metrics (keys, metric, value) against gates (keys, metric, op, target); a metric that is missing
    fails. Adds value and passed."""
    v, t = F.col("value"), F.col("target")
    ok = F.coalesce(*(F.when(F.col("op") == n, r(v, t)) for n, r in RULES.items()), F.lit(False))
    return gates.join(metrics.select(*keys, "metric", "value"), [*keys, "metric"], "left").withColumn("passed", ok)


def verdict(gated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Passed only if every gate passed."""
    return gated.groupBy(*by).agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.count("*").alias("gates"))


def long_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Metric columns as rows."""
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))
    return df.select(*keys, F.explode(cells).alias("m")).select(*keys, "m.*")


def component_gates(rows: DataFrame, targets: DataFrame, component: str, least: float = 0.9, most: float = 1.25) -> DataFrame:
    """Rows of each component against its target."""
    have = rows.groupBy(component).agg(F.count("*").alias("rows"))
    j = targets.join(have, component, "left").na.fill(0, ["rows"]).withColumn("fill", safe_div(F.col("rows"), F.col("target")))
    return j.withColumn("passed", (F.col("target") == 0) | F.col("fill").between(least, most))


def source_dominance(df: DataFrame, source: str, label: str, overall: float = 0.25, per_class: float = 0.35) -> DataFrame:
    """Sources above their share of all rows or of a class."""
    c = df.groupBy(source, label).agg(F.count("*").alias("n"))
    per = c.select(source, label, "n", (F.col("n") / F.sum("n").over(W.partitionBy(label))).alias("share"), F.lit("class").alias("scope"))
    all_ = c.groupBy(source).agg(F.sum("n").alias("n")).select(source, F.lit(None).cast(df.schema[label].dataType).alias(label), "n", (F.col("n") / F.sum("n").over(W.partitionBy())).alias("share"), F.lit("all").alias("scope"))
    return per.unionByName(all_).withColumn("dominant", F.col("share") > F.when(F.col("scope") == "all", overall).otherwise(per_class))


def ratio_audit(df: DataFrame, fields: Sequence[str], label: str, least_rows: int = 100, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Values that nearly give the label away."""
    return label_ratios(df, fields, label).withColumn("leaks_label", (F.col("rows") >= least_rows) & ((F.col("ratio") < low) | (F.col("ratio") > high)))


def pair_coverage(df: DataFrame, carrier: str, label: str, least: float = 0.9) -> DataFrame:
    """Share of carriers that have rows of both labels."""
    c = df.where(F.col(carrier).isNotNull()).groupBy(carrier).agg((F.bool_or(F.col(label) == 1) & F.bool_or(F.col(label) == 0)).alias("both"))
    return c.agg(F.count("*").alias("carriers"), F.count_if("both").alias("paired")).withColumn("coverage", safe_div(F.col("paired"), F.col("carriers"))).withColumn("passed", F.col("coverage") >= least)


def visibility_audit(df: DataFrame, label: str, visible: Column) -> DataFrame:
    """Positives without a visible signal, negatives with one."""
    v = F.coalesce(visible, F.lit(False))
    return df.agg(F.count_if((F.col(label) == 1) & ~v).alias("hidden_positives"), F.count_if((F.col(label) == 0) & v).alias("visible_negatives")).withColumn("passed", (F.col("hidden_positives") == 0) & (F.col("visible_negatives") == 0))


def language_balance(df: DataFrame, language: str, by: Sequence[str], low: float, high: float, exempt: Sequence[str] = ("mixed",)) -> DataFrame:
    """Shares of languages overall and by label, component and so on."""
    sets = [[language], *([b, language] for b in by)]
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], F.col(language), *(F.col(b) for b in by)).agg(F.coalesce(*(F.when(F.grouping(b) == 0, b) for b in by), F.lit("all")).alias("scope"), F.count("*").alias("rows"))
    value = F.coalesce(*(F.col(b).cast("string") for b in by), F.lit("all")) if by else F.lit("all")
    g = g.select(F.col(language), "scope", value.alias("value"), "rows")
    share = F.col("rows") / F.sum("rows").over(W.partitionBy("scope", "value"))
    return g.withColumn("share", share).withColumn("passed", F.col(language).isin(*exempt) | F.col("share").between(low, high))


def bank_audit(bank: DataFrame, text: str, template: str, source: str, external: Column, anchored: Column, scale: int) -> DataFrame:
    """One row on a payload bank with its gates, which grow with the scale."""
    n = F.count("*")
    m = bank.agg(n.alias("rows"), F.count_distinct(text).alias("texts"), F.count_distinct(template).alias("templates"), safe_div(F.count_if(external), n).alias("external_share"), safe_div(F.count_if(anchored), n).alias("anchored_share"), F.count_distinct(source).alias("sources"))
    return m.withColumn("passed", (F.col("texts") >= min(scale, 2000)) & (F.col("templates") >= max(5, scale // 100)) & (F.col("external_share") >= 0.2) & (F.col("anchored_share") >= 0.9))


def capacity(df: DataFrame, key: str, targets: Mapping[str, int], factor: float = 1.2) -> dict[str, dict[str, Any]]:
    """Whether there are candidates enough before a build."""
    have = {r[key]: r["count"] for r in df.where(F.col(key).isin(*targets)).groupBy(key).count().collect()}
    return {k: {"have": have.get(k, 0), "need": -(-int(n * factor * 1000) // 1000), "enough": have.get(k, 0) >= n * factor} for k, n in targets.items()}


def assert_counts(df: DataFrame, label: str, expected: Mapping[int, int]) -> DataFrame:
    """Fails unless the labels have exactly these counts."""
    got = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if got != dict(expected):
        raise ValueError(f"label counts {got}, expected {dict(expected)}")
    return df


def split_issues(df: DataFrame, label: str, source: str, bucket: str, critical: Sequence[str], max_share: float = 0.35, least_rows: int = 200) -> list[str]:
    """What is wrong with a split, as text."""
    g = df.groupBy(source, bucket, label).count().collect()
    n, out = sum(r["count"] for r in g), []
    labels = {r[label] for r in g}
    if labels - {0, 1} or len(labels) < 2:
        out.append(f"labels: {sorted(map(str, labels))}")
    for key, name, bad in ((source, "source share", lambda c: c > max_share * n), (bucket, "critical bucket", lambda c: False)):
        per: dict[Any, int] = {}
        for r in g:
            per[r[key]] = per.get(r[key], 0) + r["count"]
        out += [f"{name}: {k}" for k, c in sorted(per.items(), key=str) if bad(c)]
        if key == bucket:
            out += [f"{name}: {k} has {per.get(k, 0)} rows" for k in critical if per.get(k, 0) < least_rows]
    return out


def package_issues(spark, root: str, required: Sequence[str], datasets: Mapping[str, Sequence[str]]) -> list[str]:
    """Files missing, and datasets without rows or columns they must have."""
    out = []
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_extract("path", "([^/]+)/*$", 1).alias("f"))
    files = {r["f"] for r in names.where(F.col("f").isin(*required)).distinct().collect()}
    out += [f"missing {f}" for f in required if f not in files]
    for name, columns in datasets.items():
        df = spark.read.parquet(f"{root}/{name}")
        out += [f"{name} lacks {c}" for c in columns if c not in df.columns] + ([f"{name} is empty"] if df.limit(1).count() == 0 else [])
    return out


def metadata_auc(df: DataFrame, fields: Sequence[str], label: str, key: str, most: int = 50_000, seed: int = 42) -> float:
    """Area under the curve of a model that sees only nuisance columns; near 0.5 if they do not give the label away.
    It is fitted on a seeded sample of at most `most` of the training rows, and evaluated on all validation rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    from .sampling import seeded_sample
    from .splits import random_split

    t = df.select(key, F.col(label).cast("double").alias("label"), *(F.coalesce(F.col(f).cast("string"), F.lit("none")).alias(f) for f in fields))
    t = random_split(t, key, 0.3, seed)
    taught = seeded_sample(t.where("split = 'train'"), key, seed, most=most)
    stages = [StringIndexer(inputCols=list(fields), outputCols=[f"{f}_i" for f in fields], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{f}_i" for f in fields], outputCols=[f"{f}_v" for f in fields]), VectorAssembler(inputCols=[f"{f}_v" for f in fields], outputCol="features"), LogisticRegression(maxIter=20, regParam=0.01)]
    model = Pipeline(stages=stages).fit(taught)
    return BinaryClassificationEvaluator().evaluate(model.transform(t.where("split = 'validation'")))
