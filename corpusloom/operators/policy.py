"""Cascade, router, certified slices and document policy (U2-U12, U15). Patterns are configuration."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import anchored, any_pattern, folded
from ..functions.text import once, text_or_empty, truthy

ALLOW, REVIEW, BLOCK = "ALLOW", "REVIEW", "BLOCK"
DIAGNOSTIC, SHADOW, ENFORCED = "diagnostic", "shadow", "enforced"
#: Names that results carry.
WRAPPER_CATEGORY, WRAPPER_FAMILY = "security_compliance_redaction_wrappers", "security_compliance_redaction_wrapper"
ANCHOR_CATEGORY, ANCHOR_FAMILY = "direct_protected_attack_anchor", "direct_model_control_or_exfiltration"
ROUTER_KEYS = ("direct_patterns", "meta_patterns", "negation_pattern", "router_version", "security_patterns", "trusted_categories", "wrapper_patterns")


def config_hash(payload: Any) -> str:
    """Digest of the canonical JSON."""
    return hashlib.sha256(json.dumps(payload, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class RouterConfig:
    direct_patterns: Sequence[str]
    meta_patterns: Sequence[str]
    security_patterns: Sequence[str]
    wrapper_patterns: Sequence[str]
    negation_pattern: str
    trusted_categories: Sequence[str] = (WRAPPER_CATEGORY,)
    router_version: str = "router-1"

    @property
    def hash(self) -> str:
        return config_hash({k: list(v) if not isinstance(v, str) else v for k, v in self.__dict__.items()})

    @staticmethod
    def load(payload: Mapping[str, Any]) -> RouterConfig:
        """Exactly the known keys, lists of different non-empty strings."""
        if sorted(payload) != sorted(ROUTER_KEYS):
            raise ValueError(f"router config must have exactly the keys {', '.join(ROUTER_KEYS)}")
        for k, v in payload.items():
            if k in ("negation_pattern", "router_version"):
                if not isinstance(v, str) or not v:
                    raise ValueError(f"{k} must be a non-empty string")
            elif not isinstance(v, list) or not v or not all(isinstance(x, str) and x for x in v) or len(set(v)) < len(v):
                raise ValueError(f"{k} must be a list of different non-empty strings")
        return RouterConfig(**payload)


@dataclass(frozen=True)
class PolicyConfig:
    router: RouterConfig
    protected: Mapping[str, str] = field(default_factory=dict)
    slices: Sequence[Mapping[str, Any]] = ()
    allowlist: Sequence[str] = (WRAPPER_CATEGORY,)
    low: float = 0.82
    protect: float = 0.999
    reviewer_allow: float = 0.10
    reviewer_block: float = 0.30
    mode: str = DIAGNOSTIC
    reviewer_model_id: str = "reviewer"
    reviewer_calibration_id: str | None = None
    engine_version: str = "policy-1"
    current_action: str | None = None

    @property
    def hash(self) -> str:
        return config_hash(dict(self.protected))

    def validate(self) -> PolicyConfig:
        """What the run-time modes require."""
        if set(self.protected.values()) - {BLOCK, REVIEW}:
            raise ValueError("protected families may only be BLOCK or REVIEW")
        validate_slices(self.slices)
        if self.mode != DIAGNOSTIC and self.reviewer_allow >= self.reviewer_block:
            raise ValueError("the reviewer's allow threshold must be below its block threshold")
        if self.mode == ENFORCED:
            if "oracle" in self.reviewer_model_id.lower():
                raise ValueError("a reviewer derived from evaluation labels cannot be enforced")
            if any(authority(s, "auto_allow") for s in self.slices) and not self.reviewer_calibration_id:
                raise ValueError("enforced automatic ALLOW needs a reviewer calibration id")
        return self


def authority(row: Mapping[str, Any], name: str) -> bool:
    return bool((row.get("authority") or {}).get(name))


def validate_slices(slices: Sequence[Mapping[str, Any]]) -> None:
    """Named slices; automatic ALLOW must be bound to rules, versions, hashes, reviewer and calibration."""
    seen = set()
    for s in slices:
        if not s.get("slice") or not s.get("router_version"):
            raise ValueError("a certified slice needs slice and router_version")
        if authority(s, "auto_allow"):
            missing = [k for k in ("language", "router_rule_ids", "router_config_hash", "reviewer_model_id", "reviewer_calibration_id", "policy_engine_version", "policy_config_hash") if not s.get(k)]
            if missing:
                raise ValueError(f"automatic ALLOW without {', '.join(missing)}")
        key = json.dumps(s, sort_keys=True)
        if key in seen:
            raise ValueError("certified slices repeat")
        seen.add(key)


def specificity(row: Mapping[str, Any]) -> int:
    """How many of the optional bindings a slice has."""
    return sum(bool(row.get(k)) for k in ("language", "router_rule_ids", "router_config_hash", "policy_engine_version", "policy_config_hash", "reviewer_model_id", "reviewer_calibration_id"))


def direct_anchor(text: Column | str, config: RouterConfig, low: Column | None = None) -> Column:
    """A direct pattern outside spans that negate it."""
    return anchored(text, config.direct_patterns, config.negation_pattern, low=low)


def route(text: Column | str, category: Column, trusted: Column, language: Column, config: RouterConfig, anchor: Column | None = None, low: Column | None = None) -> Column:
    """U4: struct(category, semantic_family, language, confidence, reason, rule_ids). `anchor` saves the direct patterns
    where they were looked for already, `low` folding the text."""
    t = text_or_empty(text)
    patterns = {"security_signal_v1": config.security_patterns, "wrapper_structure_v1": config.wrapper_patterns, "policy_or_meta_security_mention_v1": config.meta_patterns}
    signals = {n: any_pattern(t, p, low) for n, p in patterns.items()}
    raised = F.array_compact(F.array(*(F.when(c, n) for n, c in signals.items())))
    by_source = truthy(trusted, "policy") & F.coalesce(category.isin(*config.trusted_categories), F.lit(False))
    seen = F.struct((direct_anchor(t, config, low) if anchor is None else anchor).alias("anchor"), raised.alias("raised"))

    def result(cat: str, family: str, confidence: str, reason: str, rules: Column) -> Column:
        return F.struct(F.lit(cat).alias("category"), F.lit(family).alias("semantic_family"), language.alias("language"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"), rules.alias("rule_ids"))

    def decided(s: Column) -> Column:
        return (
            F.when(s["anchor"], result(ANCHOR_CATEGORY, ANCHOR_FAMILY, "high", "direct_attack_anchor_present", F.array(F.lit("direct_attack_anchor_v1"))))
            .when(by_source, result(WRAPPER_CATEGORY, WRAPPER_FAMILY, "high", "trusted_source_metadata_security_wrapper", F.array(F.lit("trusted_security_wrapper_source_tag_v1"))))
            .when(F.size(s["raised"]) == 3, result(WRAPPER_CATEGORY, WRAPPER_FAMILY, "high", "deterministic_security_wrapper_structure", s["raised"]))
            .when(F.size(s["raised"]) > 0, result("unknown", "unknown", "low", "insufficient_non_keyword_structure_for_high_confidence_slice", s["raised"]))
            .otherwise(result("unknown", "unknown", "low", "no_router_match", F.array().cast("array<string>")))
        )

    return once(decided, s=seen)


def match_slice(router: Column, config: PolicyConfig) -> Column:
    """struct(id, auto_allow, ultra_allow) of the most specific slice whose bindings all hold; of equals one
    that denies; two equals of one kind fail. The slices are a short configuration, so this is one expression."""
    fitting = []
    for s in config.slices:
        bound = {"router_version": config.router.router_version, "router_config_hash": config.router.hash, "policy_engine_version": config.engine_version, "policy_config_hash": config.hash, "reviewer_model_id": config.reviewer_model_id, "reviewer_calibration_id": config.reviewer_calibration_id}
        if s.get("router_version") != bound.pop("router_version") or any(s.get(k) and s[k] != v for k, v in bound.items()):
            continue
        ok = router["category"] == s["slice"]
        if s.get("language"):
            ok = ok & (router["language"] == s["language"])
        rules = F.array_sort(F.array(*map(F.lit, sorted(set(s.get("router_rule_ids") or [])))).cast("array<string>"))
        have = F.array_sort(F.array_distinct(router["rule_ids"]))
        if authority(s, "auto_allow"):
            ok = ok & ((F.size(rules) > 0) & (rules == have))
        elif s.get("router_rule_ids"):
            ok = ok & (F.size(F.array_except(rules, have)) == 0)
        name = s.get("certified_slice_id") or config_hash(s)
        fitting.append(F.when(ok, F.struct(F.lit(specificity(s)).alias("specificity"), F.lit(not authority(s, "auto_allow")).alias("denies"), F.lit(name).alias("id"), F.lit(authority(s, "auto_allow")).alias("auto_allow"), F.lit(authority(s, "ultra_allow")).alias("ultra_allow"))))
    empty = F.lit(None).cast("struct<id:string,auto_allow:boolean,ultra_allow:boolean>")
    if not fitting:
        return empty
    found = F.array_compact(F.array(*fitting))
    best = F.array_max(found)
    top = F.filter(found, lambda x: x["specificity"] == best["specificity"])
    mixed_kinds = F.exists(top, lambda x: x["denies"]) & F.exists(top, lambda x: ~x["denies"])
    conflict = (F.size(top) > 1) & ~mixed_kinds
    chosen = F.element_at(F.filter(top, lambda x: (x["denies"] == best["denies"])), 1)
    value = F.struct(chosen["id"].alias("id"), chosen["auto_allow"].alias("auto_allow"), chosen["ultra_allow"].alias("ultra_allow"))
    return F.when(F.size(found) == 0, empty).when(conflict, F.raise_error(F.lit("certified slices of equal specificity conflict")).cast("struct<id:string,auto_allow:boolean,ultra_allow:boolean>")).otherwise(value)


def cascade(stage1: Column, reviewer: Column, anchor: Column, stage1_threshold: float, reviewer_threshold: float, veto: bool = True) -> Column:
    """struct(decision, reason)."""
    out = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    first = F.when(stage1 < stage1_threshold, out(0, "stage1_negative"))
    if veto:
        first = first.when(anchor, out(1, "hard_anchor_veto"))
    return first.when(reviewer.isNull(), out(1, "reviewer_missing")).when(reviewer >= reviewer_threshold, out(1, "reviewer_positive")).otherwise(out(0, "reviewer_negative"))


def eligible(anchor: Column, stage1: Column, router: Column, slice_: Column, config: PolicyConfig) -> Column:
    """U8: struct(eligible, reason): whether a window needs the reviewer's score at all."""
    no = lambda r: F.struct(F.lit(False).alias("eligible"), (F.lit(r) if isinstance(r, str) else r).alias("reason"))
    protected = family_action(router, config)
    return (
        F.when(anchor, no("direct_attack_anchor_block")).when(stage1 < config.low, no("below_safety_reference")).when(router["confidence"] == "low", no("low_confidence_router"))
        .when(protected.isNotNull(), no(F.concat(F.lit("protected_family_"), F.lower(protected)))).when(~router["category"].isin(*config.allowlist), no("slice_not_reviewer_allowlisted"))
        .when((stage1 >= config.protect) & ~F.coalesce(slice_["ultra_allow"], F.lit(False)), no("protect_threshold"))
        .otherwise(F.struct(F.lit(True).alias("eligible"), F.lit("reviewer_allowlisted_slice").alias("reason")))
    )


def family_action(router: Column, config: PolicyConfig) -> Column:
    return F.coalesce(*(F.when(router["semantic_family"] == f, a) for f, a in config.protected.items()), F.lit(None).cast("string"))


def decide_windows(windows: DataFrame, config: PolicyConfig, text: str = "window_text", stage1: str = "stage1_score", reviewer: str = "reviewer_score", category: str = "category", trusted: str = "trusted_source_metadata", language: str = "language") -> DataFrame:
    """Windows with anchor, router, certified_slice_id, proposed_action, effective_action, the decision's
    reason and flags."""
    config.validate()
    s1, rv = F.col(stage1), F.col(reviewer)
    routed = lambda low, a: F.struct(a.alias("anchor"), route(text, F.col(category), F.col(trusted), F.col(language), config.router, a, low).alias("router"))
    looked = once(lambda low: once(lambda a: routed(low, a), a=direct_anchor(text, config.router, low)), low=folded(text))
    w = windows.select("*", F.explode(F.array(looked)).alias("_l")).withColumn("anchor", F.col("_l.anchor")).withColumn("router", F.col("_l.router"))
    w = w.withColumn("_slice", match_slice(F.col("router"), config)).withColumn("_protected", family_action(F.col("router"), config))
    w = w.withColumn("reviewer_eligible", eligible(F.col("anchor"), s1, F.col("router"), F.col("_slice"), config)["eligible"])
    auto = F.coalesce(F.col("_slice.auto_allow"), F.lit(False)) & F.lit(bool(config.reviewer_calibration_id))
    ultra = F.coalesce(F.col("_slice.ultra_allow"), F.lit(False))
    step = lambda a, r, used=False: F.struct((F.lit(a) if isinstance(a, str) else a).alias("action"), F.lit(r).alias("reason"), F.lit(used).alias("used"))
    decision = (
        F.when(F.col("anchor"), step(BLOCK, "direct_attack_anchor_block")).when(s1 < config.low, step(ALLOW, "baseline_negative_allow"))
        .when(F.col("router.confidence") == "low", step(REVIEW, "low_confidence_router_review")).when(F.col("_protected") == BLOCK, step(BLOCK, "protected_family_block"))
        .when(F.col("_protected") == REVIEW, step(REVIEW, "protected_family_review")).when(~F.col("router.category").isin(*config.allowlist), step(REVIEW, "slice_not_reviewer_allowlisted"))
        .when((s1 >= config.protect) & ~ultra, step(REVIEW, "protect_threshold_review")).when(rv.isNull(), step(REVIEW, "reviewer_not_scored_review"))
        .when(rv >= config.reviewer_block, step(BLOCK, "reviewer_attack_block", True)).when(rv > config.reviewer_allow, step(REVIEW, "reviewer_gray_zone_review", True))
        .when(auto, step(ALLOW, "certified_reviewer_auto_allow", True)).otherwise(step(ALLOW, "reviewer_potential_allow_uncertified", True))
    )
    w = w.withColumn("_d", decision)
    reason = F.col("_d.reason")
    baseline, certified = reason == "baseline_negative_allow", reason == "certified_reviewer_auto_allow"
    proposed = F.col("_d.action")
    effective = {DIAGNOSTIC: F.lit(None).cast("string"), SHADOW: F.col(config.current_action).cast("string") if config.current_action else F.lit(None).cast("string")}.get(config.mode)
    if effective is None:
        effective = F.when((proposed == ALLOW) & ~baseline & ~certified, REVIEW).otherwise(proposed)
    return w.select(*windows.columns, "anchor", "router", "reviewer_eligible", F.col("_slice.id").alias("certified_slice_id"), proposed.alias("proposed_action"), effective.alias("effective_action"), reason.alias("final_reason"), F.col("_d.used").alias("reviewer_used"), baseline.alias("baseline_allow"), certified.alias("certified_auto_allow"), reason.isin("certified_reviewer_auto_allow", "reviewer_potential_allow_uncertified").alias("reviewer_potential_allow"))


def decide_documents(windows: DataFrame, config: PolicyConfig, id_col: str = "doc_id") -> DataFrame:
    """The gravest proposed action of a document's windows, the effective action, and its router
    results: sorted distinct categories, families and rules, and the primary ones, of the gravest then the first
    window."""
    severity = F.when(F.col("proposed_action") == BLOCK, 2).when(F.col("proposed_action") == REVIEW, 1).otherwise(0)
    rank = F.when(F.col("proposed_action") == BLOCK, 0).when(F.col("proposed_action") == REVIEW, 1).when(F.col("reviewer_potential_allow"), 2).otherwise(3)
    primary = F.min(F.struct(rank.alias("rank"), F.col("window_index").alias("i"), F.col("router.category").alias("category"), F.col("router.semantic_family").alias("family"), F.col("router.language").alias("language")))
    g = windows.groupBy(id_col).agg(
        F.max(severity).alias("s"), F.bool_and((F.col("proposed_action") != ALLOW) | F.col("baseline_allow") | F.col("certified_auto_allow")).alias("sound"),
        F.sort_array(F.collect_set("router.category")).alias("categories"), F.sort_array(F.collect_set("router.semantic_family")).alias("semantic_families"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("router.rule_ids")))).alias("rule_ids"), F.bool_or("anchor").alias("has_anchor"), primary.alias("p"), F.count("*").alias("windows"),
        *([F.first(F.col(config.current_action).cast("string"), ignorenulls=True).alias("current")] if config.current_action else []),
    )
    proposed = F.element_at(F.array(F.lit(ALLOW), F.lit(REVIEW), F.lit(BLOCK)), F.col("s") + 1)
    if config.mode == DIAGNOSTIC:
        effective = F.lit(None).cast("string")
    elif config.mode == SHADOW:
        effective = F.col("current") if config.current_action else F.lit(None).cast("string")
    else:
        effective = F.when((proposed == ALLOW) & ~F.col("sound"), REVIEW).otherwise(proposed)
    why = F.element_at(F.array(*map(F.lit, ("block_window", "review_window", "reviewer_potential_allow_window", "first_diagnostic_category"))), F.col("p.rank") + 1)
    rules = F.when(F.size("rule_ids") > 0, F.col("rule_ids")).otherwise(F.array(F.lit("unknown")))
    return g.select(id_col, "windows", proposed.alias("document_proposed_action"), effective.alias("document_effective_action"), "categories", "semantic_families", rules.alias("rule_ids"), "has_anchor", F.array_contains("categories", WRAPPER_CATEGORY).alias("has_security_wrapper"), F.col("p.category").alias("primary_category"), F.col("p.family").alias("primary_family"), F.col("p.language").alias("primary_language"), why.alias("primary_reason"))


#: Kinds of identity that a certified slice must not share with the reviewer's training rows, and the columns that tell them.
LEAK_KEYS = {
    "text_hash": ("text_hash",), "normalized_text_hash": ("normalized_text_hash",), "source_document_id": ("source_document_id", "original_document_id", "document_id"),
    "template_family_id": ("template_family_id", "source_pattern_id", "attack_generation_recipe_id", "benign_generation_recipe_id"),
}


def shared_identities(rows: DataFrame, training: DataFrame) -> dict[str, int]:
    """How many values of each kind of identity both sides have."""

    def values(df: DataFrame) -> DataFrame:
        there = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, cs in LEAK_KEYS.items() for c in cs if c in df.columns]
        found = F.explode(F.array(*there)) if there else F.explode(F.array().cast("array<struct<kind:string,value:string>>"))
        return df.select(found.alias("k")).select("k.*").where("value <> ''").distinct()

    counts = {r["kind"]: r["count"] for r in values(rows).join(values(training), ["kind", "value"], "left_semi").groupBy("kind").count().collect()}
    return {k: counts.get(k, 0) for k in LEAK_KEYS}


def certify(results: DataFrame, config: PolicyConfig, slice_: str, hypothesis: str, contrast: DataFrame | None = None, training: DataFrame | None = None, manual: Mapping[str, Any] | None = None, max_added: int = 0, min_contrast: int = 600, min_reviewed: tuple[int, int] = (50, 50), level: float = 0.95, production: bool = False) -> dict[str, Any]:
    """A report on automatic ALLOW for one slice, from evaluated rows (category or certified_slice_id, label,
    stage1_positive, proposed_action, potential_allow, versions, identities), attacks to contrast with, the reviewer's training rows
    and a summary of the manual review (benign and attack samples reviewed; `min_reviewed` of each).

    Counted in one pass: attacks that the policy allows though stage one saw them, those that stage one missed,
    false alarms before and hard blocks after, and rows bound to other versions. The rate of the first has an upper bound
    over the contrasts. Status: 'reject' with more of them than `max_added`; 'production_auto_allow_certified' with
    nothing in the way; 'diagnostic_candidate' where only production is in the way and rows might be allowed;
    'review_only' where the slice has rows; else 'reject'."""
    from .metrics import wilson_upper

    in_slice = [F.coalesce(F.col(c) == slice_, F.lit(False)) for c in ("category", "certified_slice_id") if c in results.columns]
    rows = results.where(sum((c.cast("int") for c in in_slice), F.lit(0)) > 0)
    bound = {"router_version": config.router.router_version, "router_config_hash": config.router.hash, "policy_engine_version": config.engine_version, "policy_config_hash": config.hash, "reviewer_model_id": config.reviewer_model_id}
    if config.reviewer_calibration_id:
        bound["reviewer_calibration_id"] = config.reviewer_calibration_id
    wrong = {k: F.count_if(~F.col(k).eqNullSafe(F.lit(v))) if k in results.columns else F.count("*") for k, v in bound.items()}
    attack, seen, allowed = F.col("label") == 1, F.coalesce(F.col("stage1_positive"), F.lit(False)), F.coalesce(F.col("proposed_action") == ALLOW, F.lit(False))
    might = F.coalesce(F.col("potential_allow"), F.lit(False))
    cells = {
        "rows": F.count("*"), "attack_rows": F.count_if(attack), "attack_allow_policy_added": F.count_if(attack & seen & allowed), "attack_allow_baseline_miss": F.count_if(attack & ~seen & allowed), "potential_allow_rows": F.count_if(might),
        "potential_allow_attacks": F.count_if(might & attack), "false_alarms": F.count_if(~attack & seen), "hard_blocks": F.count_if(~attack & F.coalesce(F.col("proposed_action") == BLOCK, F.lit(False))),
    }
    m = rows.agg(*(c.alias(n) for n, c in cells.items()), *(c.alias(f"wrong_{k}") for k, c in wrong.items())).first().asDict()
    contrasts = contrast.count() if contrast is not None else 0
    contrasts = contrasts or m["attack_rows"]
    of = max(contrasts, m["attack_rows"])
    added = m["attack_allow_policy_added"]
    spark = results.sparkSession
    upper = spark.range(1).select(wilson_upper(F.lit(added), F.lit(of), level)).first()[0]
    mismatches = {k: m.pop(f"wrong_{k}") for k in wrong}
    keys = [c for cs in LEAK_KEYS.values() for c in cs]
    held = rows.select(*(c for c in keys if c in rows.columns))
    if contrast is not None:
        held = held.unionByName(contrast.select(*(c for c in keys if c in contrast.columns)), allowMissingColumns=True)
    leaks = shared_identities(held, training) if training is not None else None
    blockers = ["predeclared_hypothesis_missing"] * (not hypothesis.strip()) + ["certification_input_version_mismatch"] * any(mismatches.values()) + ["slice_local_attack_contrast_underfilled"] * (contrasts < min_contrast)
    blockers += ["attack_allow_policy_added_exceeds_budget"] * (added > max_added) + ["certification_holdout_leakage_check_missing"] * (leaks is None) + ["certification_holdout_leakage_detected"] * any((leaks or {}).values())
    if manual is None:
        blockers.append("manual_review_summary_missing")
    else:
        blockers += [f"manual_{k}_sample_underfilled" for k, least in zip(("benign", "attack"), min_reviewed, strict=True) if int(manual.get(f"{k}_samples_reviewed") or 0) < least]
    stops = blockers + ["oracle_reviewer_is_diagnostic_only"] * ("oracle" in config.reviewer_model_id.lower()) + ["reviewer_calibration_id_missing"] * (not config.reviewer_calibration_id) + ["production_auto_allow_certification_flag_missing"] * (not production)
    if added > max_added:
        status = "reject"
    elif not stops:
        status = "production_auto_allow_certified"
    elif m["potential_allow_rows"] and not blockers:
        status = "diagnostic_candidate"
    elif m["rows"]:
        status = "review_only"
    else:
        status = "reject"
        blockers.append("slice_not_found_in_results")
    reduction = (m["false_alarms"] - m["hard_blocks"]) / m["false_alarms"] if m["false_alarms"] else 0.0
    return {**m, "status": status, "failures": sorted(set(blockers)), "production_blockers": sorted(set(stops)), "contrast_count": of, "attack_allow_upper": upper, "hard_block_fp_reduction": reduction, "version_mismatches": mismatches, "leaks": leaks}


def teacher_mask(teacher: Column, label: Column, confident: float = 0.9, mode: str = "agree") -> Column:
    """Rows that a teacher's probability may teach: confident ones that agree with the label ('agree'), those of them
    that are benign ('benign_only'), or all confident ones ('all_confident')."""
    sure = F.greatest(teacher, 1 - teacher) >= confident
    says = (teacher >= 0.5).cast("int")
    return {"benign_only": sure & (says == 0) & (label == 0), "all_confident": sure}.get(mode, sure & (says == label))


def positive_class(names: Mapping[int, str]) -> int:
    """The id of the positive class by its name."""
    from ..functions.text import ATTACK_SPELLINGS

    found = [i for i, n in names.items() if n.strip().lower() in ATTACK_SPELLINGS]
    if len(found) != 1:
        raise ValueError("the positive class is not clear from the names")
    return found[0]

