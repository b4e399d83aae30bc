"""More named queries over whole tables, by family, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import features as B
from ..functions import text as T
from ..operators import dedupe as N
from ..operators import gates as G
from ..operators import joins as J
from ..operators import metrics as A
from ..operators import policy as U
from ..operators import reports as R
from ..operators import sampling as Q
from ..operators import splits as S
from ..operators import windows as V
from ..operators.identity import save_point, shared_dir
from ..sources import readers, sinks
from .queries import BEST, DOC, MODELS, SP, best_windows, hform, labelled, norm, query, read, rkey, scored, unit, windows_sql

# Neutral phrase tables.
WEIGHTED = {"legal": {"license": 3, "copyright": 2, "version": 1}, "contact": {"@": 2, "phone": 1, "(": 1}, "secret": {"token": 3, "key": 1}}
RULED = {"legal": (["license"], ["copyright", "version"]), "contact": (["@"], ["phone", "call"]), "secret": (["token ="], ["key", "password"])}
FAMILIES = {"override": ["licensed under", "gnu"], "exposure": ["token =", "api_key"], "listing": ["version", "copyright"]}
CONTROL, PROCESS = r"\btoken = ", ["the", "and", "license", "version"]


def contained(c: str, phrases) -> str:
    return "(" + " + ".join(f"contains({c}, '{p}')::INT" for p in phrases) + ")"


def joined(cases: dict[str, str], sep: str = ",") -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in cases.items()) + f"], lambda x: x IS NOT NULL), '{sep}')"


# --- functions
INVISIBLE = r"regexp_replace(text, '[\x{200B}\x{FEFF}\x00]', '', 'g')"


@query(f"SELECT doc_id, {norm(INVISIBLE)} AS visible, {norm()} AS plain FROM documents")
def normalise_visible(spark, d):
    return read(spark, d, "documents").select("doc_id", T.normalize_visible("text").alias("visible"), T.normalize_nbsp("text").alias("plain"))


@query(f"SELECT doc_id, concat_ws(',', sha256({hform()}), substr(sha256({hform()}), 1, 24), substr(sha256({hform()}), 1, 20), substr(sha256({hform()}), 1, 16)) AS variants FROM documents")
def hash_variants(spark, d):
    return read(spark, d, "documents").select("doc_id", F.array_join(T.hash_variants("text"), ",").alias("variants"))


@query(r"""SELECT page_id, left(trim(regexp_replace(lower(url), '[^\p{L}\p{N}]+', '_', 'g'), '_'), 80) AS name, trim(regexp_replace(url, '[^A-Za-z0-9_.-]+', '-', 'g'), '-') AS file, trim(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), '_') AS id FROM pages""")
def slugs(spark, d):
    return read(spark, d, "pages").select("page_id", *(T.slug("url", k).alias(k) for k in T.SLUGS))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'attack' ELSE 'benign' END AS label, toxic AS label_id, toxic AS strict_label, quality = 1 AS truthy, quality <> 0 AS not_false, CAST(quality AS DOUBLE) AS number, coalesce(quality / nullif(toxic, 0), 0.0)::DOUBLE AS ratio FROM labels""")
def coerced_labels(spark, d):
    t = read(spark, d, "labels")
    return t.select("doc_id", T.label_name("toxic").alias("label"), T.label_id("toxic").alias("label_id"), T.label_int_strict("toxic").alias("strict_label"), T.truthy("quality").alias("truthy"), T.not_false("quality").alias("not_false"), T.safe_double("quality").alias("number"), T.safe_div(F.col("quality"), F.col("toxic")).alias("ratio"))


@query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'a' WHEN length(text) > 50 THEN text END AS first_text, concat_ws('#', conv_id, turn) AS row_id, CASE WHEN role = 'user' THEN 'document_id' WHEN text <> '' THEN 'window_text_hash' END AS kind FROM conversations""")
def first_filled_columns(spark, d):
    t = read(spark, d, "conversations").withColumn("a", F.when(F.col("role") == "user", "a").otherwise(" ")).withColumn("b", F.when(F.length("text") > 50, F.col("text")))
    key = T.row_key(F.nullif(F.trim("a"), F.lit("")), F.lit(None).cast("string"), F.col("text"))
    return t.select("conv_id", "turn", F.nullif(T.extract_text("a", "b"), F.lit("")).alias("first_text"), F.concat_ws("#", T.source_row_id("conv_id"), T.source_row_id("turn")).alias("row_id"), key["kind"].alias("kind"))


@query(r"""SELECT doc_id, length(regexp_replace(text, '[^\x{0400}-\x{052F}]', '', 'g')) AS cyrillic, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin, length(regexp_replace(text, '[^\p{L}]|[A-Za-z\x{0400}-\x{052F}]', '', 'g')) AS other_alpha FROM documents""")
def script_counts(spark, d):
    return read(spark, d, "documents").select("doc_id", T.script_counts("text").alias("s")).select("doc_id", "s.*")


@query(r"""WITH p AS (SELECT doc_id, regexp_extract_all(text, '(?s)(.*?[.!?][\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+)') AS p FROM documents)
SELECT doc_id, len(p) AS ends, CAST(coalesce(list_sum(list_transform(p, lambda x: length(x))), 0) AS INT) AS last_end FROM p""")
def sentence_ends(spark, d):
    e = T.sentence_ends("text")
    return read(spark, d, "documents").select("doc_id", F.size(e).alias("ends"), F.coalesce(F.try_element_at(e, F.lit(-1)), F.lit(0)).alias("last_end"))


@query(f"""WITH t AS (SELECT doc_id, {norm()} AS t, length({norm()}) // 2 AS s FROM documents), c AS (SELECT *, length(t) AS n, greatest(0, s - 80) AS a FROM t)
SELECT doc_id, CASE WHEN n <= 180 THEN t ELSE {norm("substr(t, greatest(least(n, a + 180) - 180, 0) + 1, 180)")} END AS crop FROM c""")
def crops_around(spark, d):
    start = F.floor(F.length(T.normalize("text")) / 2).cast("int")
    return read(spark, d, "documents").select("doc_id", T.crop_around("text", start, start + 20, 100).alias("crop"))


@query(f"""WITH t AS (SELECT doc_id, {norm()} AS t FROM documents) SELECT doc_id, trim('payload text ' || t) AS prefix, trim(t || ' payload text') AS suffix, CASE WHEN t = '' THEN 0 ELSE length(t) + 1 END AS suffix_start FROM t""")
def embedded_ends(spark, d):
    """Payloads before and after whole texts; the test of places inside is a fixture's."""
    t = read(spark, d, "documents").withColumn("p", T.embed("text", F.lit("payload  text"), "prefix")).withColumn("s", T.embed("text", F.lit("payload text"), "suffix"))
    return t.select("doc_id", F.trim("p.text").alias("prefix"), F.trim("s.text").alias("suffix"), F.when(F.col("s.start") == 1, 0).otherwise(F.col("s.start")).alias("suffix_start"))


# --- features
@query("WITH t AS (SELECT doc_id, lower(text) AS x FROM documents), s AS (SELECT doc_id, " + ", ".join("(" + " + ".join(f"contains(x, '{p}')::INT * {w}" for p, w in ps.items()) + f") AS {c}" for c, ps in WEIGHTED.items()) + """ FROM t)
SELECT doc_id, CASE WHEN greatest(legal, contact, secret) < 2 THEN NULL WHEN legal = greatest(legal, contact, secret) THEN 'legal' WHEN contact >= secret THEN 'contact' ELSE 'secret' END AS category, greatest(legal, contact, secret) AS score FROM s""")
def weighted_category(spark, d):
    return read(spark, d, "documents").select("doc_id", B.weighted_category("text", WEIGHTED, 2).alias("w")).select("doc_id", "w.*")


@query("WITH t AS (SELECT doc_id, lower(text) AS x FROM documents), s AS (SELECT doc_id, " + ", ".join(f"{contained('x', s)} AS {c}_s, {contained('x', m)} AS {c}_m" for c, (s, m) in RULED.items()) + " FROM t), r AS (SELECT doc_id, " + ", ".join(f"CASE WHEN {c}_s >= 1 OR {c}_m >= 2 THEN 3 * {c}_s + {c}_m ELSE 0 END AS {c}" for c in RULED) + """ FROM s)
SELECT doc_id, CASE WHEN greatest(legal, contact, secret) = 0 THEN NULL WHEN legal = greatest(legal, contact, secret) THEN 'legal' WHEN contact >= secret THEN 'contact' ELSE 'secret' END AS category FROM r""")
def rule_category(spark, d):
    return read(spark, d, "documents").select("doc_id", B.rule_category("text", RULED).alias("category"))


WORDY = {"legal": ["license", "gnu general"], "grammar": ["the", "of the"]}


@query("WITH t AS (SELECT doc_id, lower(text) AS x FROM documents), s AS (SELECT doc_id, " + ", ".join(f"regexp_matches(x, '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}-]){p.replace(' ', '[' + chr(92) + 's]+')}($|[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Pc}}-])')::INT AS {c}{i}" for c, ps in WORDY.items() for i, p in enumerate(ps)) + """ FROM t), n AS (SELECT doc_id, legal0 + legal1 AS a, grammar0 + grammar1 AS b, legal0 * 7 + legal1 * 11 AS x, grammar0 * 3 + grammar1 * 6 AS y FROM s)
SELECT doc_id, CASE WHEN a + b = 0 THEN 'none' WHEN a > b OR (a = b AND x >= y) THEN 'legal' ELSE 'grammar' END AS category FROM n""")
def word_category(spark, d):
    return read(spark, d, "documents").select("doc_id", B.word_category("text", WORDY, "none").alias("category"))


@query(f"""WITH t AS (SELECT doc_id, text, lower(text) AS x, lower({norm()}) AS n, len(string_split({norm()}, ' ')) AS w FROM documents),
k AS (SELECT *, CASE WHEN regexp_matches(x, '{CONTROL}') THEN 'model_control_attack_like' WHEN {contained("x", PROCESS)} >= 4 THEN 'strong_external_process_instruction' WHEN {contained("x", PROCESS)} >= 2 THEN 'medium_external_process_instruction' WHEN {contained("x", PROCESS)} >= 1 THEN 'weak_external_process_instruction' ELSE 'non_instructional' END AS kind FROM t)
SELECT doc_id, kind, CASE WHEN contains(n, 'begin document') THEN 'wrapper_metadata_like' WHEN regexp_matches(text, '(^|\\n)\\s*(\\d+[).]|[-*•])\\s+\\S+') THEN 'list_checklist' WHEN regexp_matches(n, '\\b(if|when)\\b') AND kind <> 'non_instructional' THEN 'conditional_procedural'
WHEN kind IN ('medium_external_process_instruction', 'strong_external_process_instruction') THEN 'instructional_procedural' WHEN regexp_matches(text, '[{{}};=<>]{{8,}}') THEN 'code_config_like' WHEN w <= 28 THEN 'short_command_like' ELSE 'descriptive' END AS form FROM k""")
def instruction_forms(spark, d):
    return read(spark, d, "documents").select("doc_id", B.instructionality("text", CONTROL, PROCESS).alias("kind"), B.text_form("text", CONTROL, PROCESS, ["begin document"]).alias("form"))


ALL_PHRASES = [p for ps in FAMILIES.values() for p in ps]


@query(f"""WITH t AS (SELECT doc_id, toxic, text, trim(regexp_replace(text, '^{SP}|{SP}$', '', 'g')) AS s, {hform()} AS n FROM documents JOIN labels USING (doc_id)),
p AS (SELECT *, list_min(list_filter([{", ".join(f"instr(n, '{p}')" for p in ALL_PHRASES)}], lambda x: x > 0)) AS pos FROM t)
SELECT doc_id, {joined({c: contained("n", ps) + " > 0" for c, ps in FAMILIES.items()})} AS families, CASE WHEN toxic = 0 THEN 'benign_or_quoted' WHEN {contained("n", FAMILIES["override"])} > 0 THEN 'explicit_override' WHEN {contained("n", FAMILIES["exposure"])} > 0 THEN 'bare_or_exfiltration_command' WHEN length(text) >= 1000 THEN 'long_jailbreak_or_document_attack' ELSE 'other_attack' END AS strength,
CASE WHEN contains(s, '<!--') OR contains(s, '-->') OR contains(lower(s), '<html') THEN 'html_or_comment' WHEN contains(s, '```') OR contains(s, '~~~') THEN 'markdown_or_code_block' WHEN regexp_matches(lower(s), '\\b(metadata|instruction|system|assistant|developer)\\s*[:=]') THEN 'metadata_or_structured_field' WHEN s[1] IN ('{{', '[') THEN 'json_like' WHEN contains(s, '|') AND contains(s, chr(10)) THEN 'table_like' WHEN contains(lower(s), 'ocr') THEN 'ocr_like' ELSE 'plain_text' END AS surface,
CASE WHEN pos IS NULL THEN 'no_known_phrase' WHEN (pos - 1) / length(n) < 0.2 THEN 'beginning' WHEN (pos - 1) / length(n) > 0.8 THEN 'end' ELSE 'middle' END AS place FROM p""")
def phrase_taxonomy(spark, d):
    t = labelled(spark, d)
    return t.select("doc_id", F.array_join(B.phrase_families("text", FAMILIES), ",").alias("families"), B.strength("text", F.col("label"), FAMILIES, "override", ["exposure"]).alias("strength"), B.surface("text").alias("surface"), B.phrase_position("text", ALL_PHRASES).alias("place"))


EVIDENCE = {"license": ("licen[sc]e", 2), "secret": ("token =", 2), "meta": (r"\bversion\b", 1)}


@query(f"""WITH t AS (SELECT doc_id, lower({norm()} || ' ' || source) AS t FROM documents), f AS (SELECT doc_id, regexp_matches(t, 'licen[sc]e') AS a, regexp_matches(t, 'token =') AS b, regexp_matches(t, '\\bversion\\b') AS c, regexp_matches(t, 'gnu') AND regexp_matches(t, 'general') AS x FROM t)
SELECT doc_id, 2 * a::INT + 2 * b::INT + c::INT + (a::INT + b::INT + c::INT >= 2)::INT + x::INT AS score, {joined({"license": "a", "secret": "b", "meta": "c", "several": "a::INT + b::INT + c::INT >= 2", "gnu_general": "x"})} AS reasons FROM f""")
def evidence_scores(spark, d):
    e = B.evidence("text", EVIDENCE, [("gnu_general", "gnu", "general")], "source", "several")
    return read(spark, d, "documents").select("doc_id", e.alias("e")).select("doc_id", "e.score", F.array_join("e.reasons", ",").alias("reasons"))


@query(r"""WITH t AS (SELECT doc_id, text, lower(text) AS x FROM documents) SELECT doc_id, regexp_matches(text, '(?is)licen[sc]ed?|copyright') AS hint, regexp_matches(regexp_replace(text, '(?is)apache license', ' ', 'g'), '(?is)\blicense\b') AS anchored, NOT regexp_matches(text, '(?is)apache license') AND regexp_matches(text, '(?is)\blicense\b') AS vetoed,
(regexp_matches(x, 'license') AND (regexp_matches(x, 'under') OR regexp_matches(x, 'version'))) OR (contains(x, 'gnu')::INT + contains(x, 'public')::INT + contains(x, 'general')::INT >= 3 AND contains(x, 'version')) AS target FROM t""")
def detectors(spark, d):
    target = B.target_and_frame("text", "license", "under", "version", ("gnu", "public", "general"), ("version",))
    return read(spark, d, "documents").select("doc_id", B.any_pattern("text", ["licen[sc]ed?", "copyright"]).alias("hint"), B.anchored("text", [r"\blicense\b"], "apache license").alias("anchored"), B.anchored("text", [r"\blicense\b"], "apache license", True).alias("vetoed"), target.alias("target"))


TRIGGERS = {"license": "licen[sc]e", "the": r"\bthe\b"}


@query(f"""WITH t AS (SELECT doc_id, lang, len(regexp_extract_all(text, '(?is)licen[sc]e')) AS a, len(regexp_extract_all(text, '(?is)\\bthe\\b')) AS b, len(list_filter(string_split({norm()}, ' '), lambda x: x <> '')) AS w FROM documents)
SELECT doc_id, a + b AS count, (a + b) / greatest(w, 1) AS density, {joined({"license": "a > 0", "the": "b > 0"})} AS names FROM t""")
def trigger_densities(spark, d):
    t = read(spark, d, "documents").select("doc_id", B.trigger_density("text", TRIGGERS).alias("t"))
    return t.select("doc_id", "t.count", "t.density", F.array_join("t.names", ",").alias("names"))


@query(f"""WITH t AS (SELECT lang, (len(regexp_extract_all(text, '(?is)licen[sc]e')) + len(regexp_extract_all(text, '(?is)\\bthe\\b'))) / greatest(len(list_filter(string_split({norm()}, ' '), lambda x: x <> '')), 1) AS v FROM documents), s AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM t)
SELECT lang, count(*) AS rows, round(avg(v), 10) AS mean, median(v) AS median, count(*) FILTER (v >= 0.05) AS high_rows, max(v) FILTER (i = floor((n - 1) * 0.9)) AS p90 FROM s GROUP BY lang""")
def trigger_density_by_category(spark, d):
    t = read(spark, d, "documents").select("lang", B.trigger_density("text", TRIGGERS)["density"].alias("v"))
    return R.density_table(t, "v", "lang").withColumn("mean", F.round("mean", 10))


ANOMALY = {"triggers": {"l": "licen[sc]e"}, "negations": {"n": "not "}, "scaffolds": {"s": "version"}, "contaminations": {"c": "token ="}}


@query(rf"""WITH t AS (SELECT doc_id, text, lang, {unit("doc_id")} AS s, greatest(length(regexp_replace(text, '[^\p{{L}}]', '', 'g')), 1) AS letters, length(regexp_replace(text, '[^А-Яа-яЁё]', '', 'g')) AS cyr, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS lat, len(regexp_extract_all(text, '[A-Za-zА-Яа-яЁё<>@:/._-]+|[0-9]+')) AS w,
count(*) OVER (PARTITION BY {hform()}) AS nc, count(*) OVER (PARTITION BY left({hform()}, 80)) AS pc, count(*) OVER (PARTITION BY right({hform()}, 100)) AS sc, greatest(length(text), 1) AS n FROM documents),
p AS (SELECT *, (nc > 3)::INT + (pc > 10)::INT + (sc > 10)::INT AS rep, len(regexp_extract_all(text, '(?is)licen[sc]e')) AS trig, regexp_matches(text, '(?is)not ')::INT AS neg, (lat / letters >= 0.1 AND cyr / letters >= 0.1)::INT AS mix, least(3, len(regexp_extract_all(text, '(?is)version'))) AS scaf, regexp_matches(text, '(?is)token =')::INT AS cont,
(len(list_filter([{", ".join(f"CASE WHEN regexp_matches(text, '(?is){x.replace(chr(39), chr(39) * 2)}') THEN 1 END" for x in B.ARTIFACTS.values())}], lambda x: x IS NOT NULL)) > 0 OR length(regexp_replace(text, '[^0-9]', '', 'g')) / n > 0.2 OR length(regexp_replace(text, '[^{{}}\[\]();=<>|`]', '', 'g')) / n > 0.12)::INT AS num FROM t),
q AS (SELECT *, (trig / greatest(w, 1) >= 0.05)::INT AS dens, (w < 20 AND s > 0.95 AND trig = 0)::INT AS short FROM p)
SELECT doc_id, 3 * rep + 2 * (dens + neg + mix + scaf + short + num) + 5 * cont + contains(lower(text), 'gnu')::INT + CASE WHEN regexp_matches(text, 'Ð|Ñ|\x{{FFFD}}|Â|Ã') THEN 3 ELSE 0 END + CASE WHEN lang = 'en' AND cyr / letters > 0.4 THEN 2 ELSE 0 END + (s >= 0.999)::INT AS score,
CASE WHEN cont > 0 THEN 'label_contamination_candidate' WHEN short > 0 THEN 'short_structured_high_score' WHEN num > 0 THEN 'numeric_code_artifact' WHEN rep >= 2 AND neg > 0 THEN 'template_boilerplate_artifact' WHEN neg > 0 THEN 'prompt_security_negation_artifact' WHEN mix > 0 AND dens > 0 THEN 'mixed_language_template' WHEN rep >= 2 THEN 'template_boilerplate_artifact' ELSE 'ordinary_false_positive' END AS bucket FROM q""")
def anomaly_buckets(spark, d):
    t = N.repeat_counts(read(spark, d, "documents").select("doc_id", "text", "lang")).withColumn("s", T.unit("doc_id"))
    parts = B.anomaly_scores("text", "s", {"normalized": F.col("normalized_count"), "prefix": F.col("prefix_count"), "suffix": F.col("suffix_count")}, ANOMALY)
    scored_ = F.transform(F.array(parts), lambda p: B.anomaly(p, "text", "s", "lang", {"gnu": "GNU"}))[0]
    return t.select("doc_id", scored_.alias("a")).select("doc_id", "a.*")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'hf://' || lang || '/' || source ELSE source END AS family, CASE WHEN contains(lower(source || ' ' || lang), 'src1') THEN 'SRC1' WHEN contains(lower(source || ' ' || lang), 'de') THEN 'de' END AS generated, CASE WHEN source = 'src0' THEN 'zero' WHEN toxic = 1 THEN 'direct_attack' ELSE 'benign_document' END AS bucket FROM documents JOIN labels USING (doc_id)""")
def source_tags(spark, d):
    t = labelled(spark, d)
    origin = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("hf://"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("/part"))).otherwise("file")
    return t.select("doc_id", B.source_family("source", origin).alias("family"), B.generated_reason(["SRC1", "de"], "source", "lang").alias("generated"), B.default_bucket(F.col("label"), "source", {"src0": "zero"}).alias("bucket"))


# --- windows
@query(f"WITH t AS (SELECT doc_id, len(list_filter(string_split({norm()}, ' '), lambda x: x <> '')) AS n FROM documents) SELECT doc_id, CASE WHEN n = 0 THEN 1 ELSE 1 + greatest(0, CAST(ceil((n - 190) / 95.0) AS INT)) END AS windows FROM t")
def word_window_estimates(spark, d):
    return read(spark, d, "documents").select("doc_id", V.estimated_windows("text").alias("windows"))


@query(f"""WITH {windows_sql(32, 16)}, n AS (SELECT doc_id, window_count AS n FROM w1 WHERE window_count > 0),
f AS (SELECT doc_id, n, list_distinct(list_concat([0, n - 1, n // 2], CASE WHEN n >= 4 THEN [n // 4, n * 3 // 4] ELSE [] END, CASE WHEN n >= 10 THEN [n // 5, n * 2 // 5, n * 3 // 5, n * 4 // 5] ELSE [] END)) AS f FROM n),
s AS (SELECT doc_id, n, f, list_transform(list_sort(list_transform(list_filter(range(n), lambda i: NOT list_contains(f, i)), lambda i: sha256(concat_ws(':', '42', doc_id, i)) || ':' || i)), lambda x: CAST(split_part(x, ':', 2) AS BIGINT)) AS rest, list_transform(list_sort(list_transform(f, lambda i: sha256(concat_ws(':', '42', doc_id, i)) || ':' || i)), lambda x: CAST(split_part(x, ':', 2) AS BIGINT)) AS few FROM f)
SELECT doc_id, array_to_string(list_sort(CASE WHEN len(f) > 7 THEN few[1:7] ELSE list_concat(f, rest[1 : greatest(least(7, n) - len(f), 0)]) END), ',') AS chosen FROM s""")
def structured_window_choice(spark, d):
    t = read(spark, d, "documents").withColumn("n", V.window_count(F.size(T.words("text")), 32, 16)).where("n > 0")
    return t.select("doc_id", F.array_join(V.structured_indices("n", 7, 42, F.col("doc_id").cast("string")), ",").alias("chosen"))


@query(f"""WITH {windows_sql(64, 32)}, s AS (SELECT doc_id, n // 3 AS a0, least(n // 3 + 40, n) AS a1, tok[n // 3 + 1 : least(n // 3 + 40, n)] AS pw FROM w1 WHERE n > 0),
j AS (SELECT doc_id, window_index, lower(window_text) AS w, list_transform(pw, lambda x: lower(x)) AS pw, greatest(0, least(token_end, a1) - greatest(token_start, a0)) AS shared, a1 - a0 AS total FROM win JOIN s USING (doc_id)),
v AS (SELECT *, contains(w, array_to_string(pw, ' ')) OR len(list_filter(list_transform(range(1, len(pw) + 1), lambda i: array_to_string(pw[i : i + 9], ' ')), lambda x: length(x) >= 24 AND contains(w, CASE WHEN instr(x[25:], ' ') > 0 THEN left(x, 23 + CAST(instr(x[25:], ' ') AS INT)) ELSE x END))) > 0 AS seen FROM j)
SELECT doc_id, window_index, shared / total AS ratio, CASE WHEN shared <= 0 THEN 'none' WHEN shared / total >= 0.85 THEN CASE WHEN seen THEN 'full' ELSE 'partial_ambiguous' END WHEN total > 8 AND shared >= 8 AND seen THEN 'partial_material' ELSE 'partial_ambiguous' END AS visibility FROM v""")
def window_visibility(spark, d):
    """How much of a passage of each document its windows show."""
    docs = read(spark, d, "documents").where("doc_id IS NOT NULL").select("doc_id", T.words("text").alias("tok"))
    n = F.size("tok")
    a0 = F.floor(n / 3).cast("int")
    spans = docs.select("doc_id", "tok", a0.alias("a0"), F.least(a0 + 40, n).alias("a1"), F.array_join(F.slice("tok", a0 + 1, F.lit(40)), " ").alias("p"))
    spans = spans.withColumn("forms", V.payload_forms("p"))  # once a document; its windows take them along
    w = V.explode_windows(spans, length=64, stride=32, tokens=F.col("tok"), keep=["doc_id", "a0", "a1", "p", "forms"])
    w = w.withColumn("shared", V.overlap(F.col("token_start"), F.col("token_end"), F.col("a0"), F.col("a1")))
    of_few = (F.when(F.col("shared") > 0, F.col(c)).alias(c) for c in ("window_text", "forms"))  # other windows are not looked at
    w = w.select("doc_id", "window_index", "shared", "a0", "a1", "p", *of_few)
    v = V.visibility(F.col("shared"), F.col("a1") - F.col("a0"), F.col("window_text"), F.col("p"), forms=F.col("forms"))
    return w.select("doc_id", "window_index", v.alias("v")).select("doc_id", "window_index", "v.ratio", "v.visibility")


@query(f"WITH {windows_sql()}, l AS (SELECT *, contains(lower(window_text), 'license') AS l FROM win) SELECT doc_id, window_index FROM (SELECT *, bool_or(l) OVER (PARTITION BY doc_id) AS has_some FROM l) WHERE l OR NOT has_some")
def likely_windows(spark, d):
    w = V.explode_windows(read(spark, d, "documents"), keep=["doc_id"])
    return V.likely_windows(w, F.contains(F.lower("window_text"), F.lit("license"))).select("doc_id", "window_index")


@query()
def windows_apart(spark, d):
    """Greedy choice: tested on a fixture."""
    return V.apart(scored(spark, d).select("doc_id", "window_index", "token_start", "score"), 256, 3)


# --- predicates
@query(f"""WITH t AS (SELECT *, toxic AS label, {hform()} AS n FROM documents JOIN labels USING (doc_id)) SELECT doc_id, CASE WHEN length(text) < 100 THEN 'too_short' WHEN regexp_matches(trim(text), '^[0-9a-fA-F]{{8}}-([0-9a-fA-F]{{4}}-){{3}}[0-9a-fA-F]{{12}}$') THEN 'identifier' WHEN contains(lower(source || ' ' || lang), 'src1') THEN 'unsafe_source' WHEN (label = 1) <> contains(n, 'license') THEN 'label_without_signal'
WHEN contains(n, 'token =') AND NOT (quality = 1 AND contains(n, 'version')) THEN 'near_boundary' END AS reason, CASE WHEN length(text) >= 100 AND length(text) <= 5000 THEN text END IS NOT NULL AS prepared FROM t""")
def row_predicates(spark, d):
    t = labelled(spark, d)
    n = T.hash_form("text")
    why = G.reasons(
        ("too_short", F.length("text") < 100), ("identifier", ~G.not_identifier(F.col("text"))), ("unsafe_source", G.marked_unsafe(["src1"], F.col("source"), F.col("lang"))), ("label_without_signal", ~G.consistent(F.col("label"), n.contains("license"))),
        ("near_boundary", ~G.reviewed_allowed(n.contains("token ="), F.col("quality") == 1, n.contains("version"))),
    )
    return t.select("doc_id", why.alias("reason"), G.prepared(F.col("text"), 100, 5000, F.lit(False)).isNotNull().alias("prepared"))


MINED_SQL = f"""t AS (SELECT doc_id, toxic, quality, {unit("doc_id")} AS score, source, {norm()} AS t, sha256({hform()}) AS h, regexp_matches({norm()}, '(?i)license') AS near FROM documents JOIN labels USING (doc_id)),
e AS (SELECT *, CASE WHEN toxic <> 0 THEN 'not_benign_label' WHEN score < 0.3 THEN 'below_score_threshold' WHEN t = '' THEN 'missing_text' WHEN source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8') THEN 'missing_or_disallowed_source_pool' END AS early FROM t),
f AS (SELECT *, early IS NULL AND doc_id = min(doc_id) FILTER (early IS NULL) OVER (PARTITION BY h) AS first FROM e),
mined AS (SELECT doc_id, near, coalesce(early, CASE WHEN NOT first THEN 'duplicate_text_hash' WHEN near AND quality <> 1 THEN 'near_boundary_without_review' WHEN near AND NOT regexp_matches(t, '(?i)version') THEN 'near_boundary_without_context' END) AS reason FROM f)"""


def mined_rows(spark, d):
    t = labelled(spark, d).select("doc_id", "label", "score", F.col("source").alias("source_pool"), (F.col("quality") == 1).alias("reviewed"), "text")
    return G.mined_benign(t, "license", "version", [f"src{i}" for i in range(9)], 0.3, ["doc_id"])


@query(f"WITH {MINED_SQL} SELECT doc_id, near AS near_boundary, reason FROM mined")
def mined_benign_reasons(spark, d):
    return mined_rows(spark, d).select("doc_id", "near_boundary", "reason")


@query(f"""WITH {MINED_SQL} SELECT reason AS name, count(*) AS rows, CAST(NULL AS BIGINT) AS least, CAST(NULL AS BOOLEAN) AS passed FROM mined WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'plain', count(*) FILTER (reason IS NULL AND NOT near), 100, count(*) FILTER (reason IS NULL AND NOT near) >= 100 FROM mined
UNION ALL SELECT 'near_boundary', count(*) FILTER (reason IS NULL AND near), 1, count(*) FILTER (reason IS NULL AND near) >= 1 FROM mined""")
def mined_benign_validation(spark, d):
    return G.validation(mined_rows(spark, d), {"plain": (~F.col("near_boundary"), 100), "near_boundary": (F.col("near_boundary"), 1)})


@query(f"""WITH t AS (SELECT doc_id, toxic, quality, source, {norm()} AS t, sha256({hform()}) AS h, CASE WHEN doc_id % 2 = 0 THEN trim(left({norm()}, 12)) ELSE '' END AS given FROM documents JOIN labels USING (doc_id)),
a AS (SELECT *, CASE WHEN given <> '' THEN given WHEN contains(lower(t), 'public license') THEN 'public license' WHEN contains(lower(t), 'license') THEN 'license' ELSE '' END AS anchor FROM t),
e AS (SELECT *, CASE WHEN toxic <> 1 THEN 'not_attack_label' WHEN t = '' THEN 'missing_window_text' WHEN anchor = '' THEN 'missing_attack_anchor_text' WHEN regexp_matches(anchor, '(?i)^the ') THEN 'filler_attack_anchor_text' WHEN NOT contains(lower(t), lower(anchor)) THEN 'anchor_not_visible_in_window' WHEN NOT regexp_matches(anchor, '(?i)license') THEN 'anchor_without_model_control_signal'
WHEN source = 'src9' THEN 'disallowed_source_pool' WHEN quality <> 1 THEN 'missing_review_or_visible_flag' END AS early FROM a), f AS (SELECT *, early IS NULL AND doc_id = min(doc_id) FILTER (early IS NULL) OVER (PARTITION BY h) AS first FROM e)
SELECT doc_id, anchor, coalesce(early, CASE WHEN NOT first THEN 'duplicate_text_hash' END) AS reason FROM f""")
def visible_miss_reasons(spark, d):
    t = labelled(spark, d).select("doc_id", F.col("label"), F.col("source").alias("source_pool"), F.when(F.col("doc_id") % 2 == 0, F.left(T.normalize("text"), F.lit(12))).otherwise("").alias("anchor"), F.lit("").alias("attack_text"), (F.col("quality") == 1).alias("visible"), "text")
    pools = [f"src{i}" for i in range(40) if i != 9]
    return G.visible_misses(t, "license", "^the ", pools, ["doc_id"], anchors=["license", "public license"]).select("doc_id", "anchor", "reason")


# --- joins
@query(f"WITH {BEST} SELECT doc_id, quality, best_score FROM labels JOIN best USING (doc_id)")
def lookup_join(spark, d):
    return J.lookup(read(spark, d, "labels").select("doc_id", "quality"), best_windows(spark, d).select("doc_id", "best_score"), "doc_id")


@query("SELECT doc_id, source, CASE WHEN quality IS NULL THEN 'source_missing' END AS reason FROM documents LEFT JOIN labels USING (doc_id)")
def missing_partners(spark, d):
    return J.lookup_with_rejects(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels").select("doc_id", "quality"), "doc_id").drop("quality")


@query(f"""WITH {DOC}, s AS (SELECT doc_id, lang, source, label, {unit(MODELS['b'])} AS b, score AS a FROM dl)
SELECT lang AS corpus, CAST(doc_id AS VARCHAR) AS document_id, b AS candidate_score, a AS baseline_score, b - a AS score_delta FROM s WHERE label = 1 AND b < 0.6""")
def model_regressions(spark, d):
    t = labelled(spark, d).select(F.col("lang").alias("corpus"), F.col("doc_id").cast("string").alias("document_id"), F.lit(None).cast("string").alias("attack_text_hash"), F.sha2("text", 256).alias("best_window_text_hash"), "label", "score", F.col("lang").alias("language"), F.col("source").alias("category"))
    candidate = t.withColumn("score", T.unit(F.concat_ws(":", F.lit("b"), "document_id")))
    return J.regressions(candidate, t, 0.6).select("corpus", "document_id", "candidate_score", "baseline_score", "score_delta")


@query(f"""WITH {windows_sql()} SELECT doc_id, count(*) AS windows, array_to_string(list(window_index ORDER BY window_index), ',') AS indices FROM win GROUP BY doc_id""")
def documents_with_windows(spark, d):
    docs = read(spark, d, "documents").select("doc_id")
    t = J.with_windows(docs, scored(spark, d).select("doc_id", "window_index", "score"), "doc_id", "window_index", ["score"]).where("windows is not null")
    return t.select("doc_id", F.size("windows").cast("long").alias("windows"), F.array_join(F.transform("windows", lambda w: w["window_index"].cast("string")), ",").alias("indices"))


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def selected_documents(spark, d):
    return J.semi(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels").where("quality = 1").select("doc_id"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def remaining_documents(spark, d):
    return S.remaining(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), "doc_id")


@query("SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r = 1")
def first_turn_of_each(spark, d):
    return J.first_per_key(read(spark, d, "conversations"), ["conv_id"], "turn").select("conv_id", "turn", "text")


# --- reports
@query("SELECT lang, source, count(*) AS rows FROM documents GROUP BY ALL")
def pair_counts(spark, d):
    return R.counts(read(spark, d, "documents"), "lang", "source")


@query(f"WITH {DOC} SELECT 'lang' AS field, lang AS value, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM dl GROUP BY lang UNION ALL SELECT 'source', source, count(*), CAST(sum(label) AS BIGINT) FROM dl GROUP BY source")
def composition(spark, d):
    return R.summarise(labelled(spark, d), ["lang", "source"], "label")


@query(f"""WITH {DOC}, a AS (SELECT lang, label, CASE WHEN score >= 0.8 THEN 'BLOCK' WHEN score >= 0.5 THEN 'REVIEW' ELSE 'ALLOW' END AS x FROM dl) SELECT lang, count(*) FILTER (label = 1 AND x <> 'ALLOW') AS tp, count(*) FILTER (label = 0 AND x <> 'ALLOW') AS fp, count(*) FILTER (label = 0 AND x = 'ALLOW') AS tn, count(*) FILTER (label = 1 AND x = 'ALLOW') AS fn FROM a GROUP BY lang""")
def action_confusion(spark, d):
    t = labelled(spark, d).withColumn("x", F.when(F.col("score") >= 0.8, "BLOCK").when(F.col("score") >= 0.5, "REVIEW").otherwise("ALLOW"))
    return A.action_confusion(t, "x", "label", True, ["lang"]).select("lang", "tp", "fp", "tn", "fn")


@query(f"""WITH {DOC}, f AS (SELECT label, n_chars, unnest(list_filter([{", ".join(f"CASE WHEN {contained(hform(), ps)} > 0 THEN '{c}' END" for c, ps in FAMILIES.items())}], lambda x: x IS NOT NULL)) AS family FROM dl)
SELECT family, count(*) AS rows, count(*) FILTER (label = 1) AS attack, count(*) FILTER (label = 0) AS benign, count(*) FILTER (n_chars > 1000) AS long, count(*) FILTER (label = 1) / count(*) AS attack_share FROM f GROUP BY family""")
def phrase_family_table(spark, d):
    return R.family_table(labelled(spark, d), B.phrase_families("text", FAMILIES), "label", {"long": F.col("n_chars") > 1000})


@query(f"WITH {DOC} SELECT source, count(*) AS rows, round(avg(score), 10) AS mean_score, max(score) AS max_score, count(*) / (SELECT count(*) FROM dl) AS share FROM dl GROUP BY source")
def group_scores(spark, d):
    return R.group_scores(labelled(spark, d), "score", ["source"]).withColumn("mean_score", F.round("mean_score", 10))


@query(f"""WITH {DOC}, c AS (SELECT lang, source, count(*) AS rows FROM dl WHERE label = 0 AND score >= 0.5 GROUP BY ALL), a AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), b AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT lang, source, rows, coalesce(a.n, 0) AS train_lang, coalesce(b.n, 0) AS train_source FROM c LEFT JOIN a USING (lang) LEFT JOIN b USING (source)""")
def cluster_coverage(spark, d):
    c = R.clusters(G.mined(labelled(spark, d), "label", "score", 0.5, "fp"), ["lang", "source"], "doc_id", "score").select("lang", "source", "rows")
    return R.coverage(c, read(spark, d, "documents"), ["lang", "source"])


# --- order and sampling
@query(f"WITH {DOC} SELECT doc_id, score FROM dl ORDER BY score DESC, doc_id LIMIT 50")
def top_scores(spark, d):
    return R.top_k(labelled(spark, d).select("doc_id", "score"), 50, F.desc("score"), "doc_id")


@query(f"WITH {DOC} SELECT doc_id, score FROM dl ORDER BY abs(score - 0.5), doc_id LIMIT 50")
def nearest_to_threshold(spark, d):
    return R.top_k(labelled(spark, d).select("doc_id", "score"), 50, F.abs(F.col("score") - 0.5), "doc_id")


@query(f"""WITH {DOC}, p AS (SELECT doc_id, CASE WHEN contains(source, '1') THEN 5 WHEN contains(source, '2') THEN 4 WHEN contains(source, '3') THEN 3 ELSE 1 END AS rank, score FROM dl) SELECT doc_id, rank, CASE WHEN rank >= 4 THEN score ELSE 0.0 END AS within FROM p""")
def priority_keys(spark, d):
    p = R.priority("source", F.col("score"), (("1", 5), ("2", 4), ("3", 3)))
    return labelled(spark, d).select("doc_id", p["rank"].alias("rank"), p["score"].alias("within"))


@query("SELECT source, regexp_extract(source, '^([^0-9]*)', 1) AS head, CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS number FROM (SELECT DISTINCT source FROM documents)")
def natural_keys(spark, d):
    k = R.natural_key("source")
    return read(spark, d, "documents").select("source").distinct().select("source", k["head"].alias("head"), k["number"].alias("number"))


@query()
def hard_example_choice(spark, d):
    """Greedy under caps: tested on a fixture."""
    w = scored(spark, d).where("score >= 0.5").select("doc_id", "window_index", "token_start", "score", F.col("source").alias("source_name"))
    return Q.hard_examples(w, 200, per_source=20)


@query(f"""WITH r AS (SELECT doc_id, source, text, {rkey("doc_id")} AS k FROM documents ORDER BY k LIMIT 300), a AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS n FROM r WHERE length(text) >= 200) SELECT doc_id, source FROM a WHERE n = 1 ORDER BY k LIMIT 10""")
def scan_until_enough(spark, d):
    t = read(spark, d, "documents").select("doc_id", "source", "text")
    return Q.scan_until(t, F.length("text") >= 200, 10, 300, T.random_key(42, "doc_id"), distinct="source").select("doc_id", "source")


@query(f"""WITH {DOC}, p AS (SELECT count(*) FILTER (label = 1) AS p FROM dl), n AS (SELECT doc_id, row_number() OVER (ORDER BY {rkey("doc_id")}) AS r FROM dl WHERE label = 0) SELECT doc_id FROM dl WHERE label = 1 UNION ALL SELECT doc_id FROM n WHERE r <= (SELECT round_even(p * 1.5, 0) FROM p)""")
def rebalanced_rows(spark, d):
    return Q.rebalance(labelled(spark, d).select("doc_id", "label"), "label", 1.5, "doc_id").select("doc_id")


@query(f"""WITH {DOC}, r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {rkey("doc_id")}) <= 30 AS inq, {rkey("doc_id")} AS k FROM dl), f AS (SELECT *, row_number() OVER (PARTITION BY inq ORDER BY k) AS n FROM r) SELECT doc_id, label FROM f WHERE inq OR n <= greatest(0, 60 - (SELECT count(*) FROM r WHERE inq))""")
def half_of_each(spark, d):
    return Q.half_and_half(labelled(spark, d).select("doc_id", "label"), "label", 60, "doc_id").select("doc_id", "label")


# --- splits
@query(f"""WITH h AS (SELECT doc_id, lang, CASE WHEN source = 'src0' THEN 'validation' WHEN source = 'src1' THEN 'train' END AS hint FROM documents), f AS (SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {rkey("doc_id")}) <= round_even(count(*) OVER (PARTITION BY lang) * 0.2, 0) THEN 'validation' ELSE 'train' END AS split FROM h WHERE hint IS NULL)
SELECT doc_id, hint AS split FROM h WHERE hint IS NOT NULL UNION ALL SELECT doc_id, split FROM f""")
def hinted_split(spark, d):
    t = read(spark, d, "documents").select("doc_id", "lang", F.when(F.col("source") == "src0", "validation").when(F.col("source") == "src1", "train").alias("hint"))
    return S.hinted_split(t, "doc_id", "hint", ["lang"], 0.2).select("doc_id", "split")


@query(f"WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {rkey('doc_id')}) AS r, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN r <= round_even(n * 0.75, 0) THEN 'train' ELSE 'validation' END AS split FROM r")
def seeded_cut(spark, d):
    return S.ordered_cut(read(spark, d, "documents").select("doc_id"), "doc_id", 0.75, 42)


@query("SELECT doc_id, NULL::INT AS quality, source FROM documents UNION ALL SELECT doc_id, quality, NULL FROM labels")
def union_of_parts(spark, d):
    return S.concatenate([read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels").select("doc_id", "quality")]).select("doc_id", F.col("quality").cast("int").alias("quality"), "source")


@query()
def cover_split(spark, d):
    """Greedy set cover: tested on a fixture."""
    t = read(spark, d, "documents").select("doc_id", F.concat_ws("-", "lang", F.col("doc_id") % 50).alias("group"), "source")
    return S.cover_split(t, "group", "source", 100).select("doc_id", "group", "split")


# --- scoring and policy
@query(f"""WITH {DOC}, t AS (SELECT *, {unit(MODELS['b'])} AS rv FROM dl) SELECT doc_id, CASE WHEN score < 0.5 THEN 0 WHEN quality = 0 THEN 1 WHEN rv >= 0.6 THEN 1 ELSE 0 END AS decision, CASE WHEN score < 0.5 THEN 'stage1_negative' WHEN quality = 0 THEN 'hard_anchor_veto' WHEN rv >= 0.6 THEN 'reviewer_positive' ELSE 'reviewer_negative' END AS reason FROM t""")
def cascade_decisions(spark, d):
    t = labelled(spark, d).withColumn("rv", T.unit(F.concat_ws(":", F.lit("b"), "doc_id")))
    return t.select("doc_id", U.cascade(F.col("score"), F.col("rv"), F.col("quality") == 0, 0.5, 0.6).alias("c")).select("doc_id", "c.*")


@query(f"""WITH {DOC} SELECT doc_id, greatest(score, 1 - score) >= 0.8 AND (score >= 0.5)::INT = label AS agree, greatest(score, 1 - score) >= 0.8 AND score < 0.5 AND label = 0 AS benign_only, greatest(score, 1 - score) >= 0.8 AS all_confident FROM dl""")
def teacher_masks(spark, d):
    return labelled(spark, d).select("doc_id", *(U.teacher_mask(F.col("score"), F.col("label"), 0.8, m).alias(m) for m in ("agree", "benign_only", "all_confident")))


@query("""WITH c AS (SELECT source, count(*) FILTER (toxic = 1) AS k, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source), z(level, z) AS (VALUES ('low', 1.6448536269514722::DOUBLE), ('middle', 1.959963984540054), ('high', 2.5758293035489004))
SELECT source, level, round(least(1, ((k / n + z*z/(2*n)) + z * sqrt((k / n * (1 - k / n) + z*z/(4*n)) / n)) / (1 + z*z/n)), 10) AS upper FROM c, z""")
def certification_bounds(spark, d):
    c = labelled(spark, d).groupBy("source").agg(F.count_if(F.col("label") == 1).alias("k"), F.count("*").alias("n"))
    cells = F.array(*(F.struct(F.lit(n).alias("level"), F.round(A.wilson_upper(F.col("k"), F.col("n"), x), 10).alias("upper")) for n, x in (("low", 0.9), ("middle", 0.95), ("high", 0.99))))
    return c.select("source", F.explode(cells).alias("c")).select("source", "c.*")


@query(f"WITH {windows_sql()} SELECT doc_id, window_index, CASE WHEN window_index % 2 = 0 THEN length(window_text) / 10.0 END AS score FROM win")
def scored_by_batches(spark, d):
    """A scorer of batches, for eligible windows alone."""
    w = V.explode_windows(read(spark, d, "documents"), keep=["doc_id"])
    return V.score_windows(w, lambda: lambda texts: texts.str.len() / 10.0, eligible=F.col("window_index") % 2 == 0).select("doc_id", "window_index", "score")


# --- audits
@query(f"WITH {DOC}, c AS (SELECT source, bool_or(label = 1) AND bool_or(label = 0) AS twice FROM dl GROUP BY source) SELECT count(*) AS carriers, count(*) FILTER (twice) AS paired, count(*) FILTER (twice) / count(*) AS coverage, count(*) FILTER (twice) / count(*) >= 0.9 AS passed FROM c")
def carrier_pairs(spark, d):
    return G.pair_coverage(labelled(spark, d), "source", "label")


@query(f"WITH {DOC}, c AS (SELECT count(*) FILTER (label = 1 AND NOT contains({hform()}, 'license')) AS hidden_positives, count(*) FILTER (label = 0 AND contains({hform()}, 'license')) AS visible_negatives FROM dl) SELECT *, hidden_positives = 0 AND visible_negatives = 0 AS passed FROM c")
def visibility_audit(spark, d):
    return G.visibility_audit(labelled(spark, d), "label", T.hash_form("text").contains("license"))


@query(f"""WITH b AS (SELECT text, left({hform()}, 20) AS template, source, lang <> 'en' AS ext, contains(text, 'e') AS anc FROM documents), c AS (SELECT count(*) AS rows, count(DISTINCT text) AS texts, count(DISTINCT template) AS templates, count(*) FILTER (ext) / count(*) AS external_share, count(*) FILTER (anc) / count(*) AS anchored_share, count(DISTINCT source) AS sources FROM b)
SELECT *, texts >= 100 AND templates >= 5 AND external_share >= 0.2 AND anchored_share >= 0.9 AS passed FROM c""")
def payload_bank_audit(spark, d):
    t = read(spark, d, "documents").withColumn("template", F.left(T.hash_form("text"), F.lit(20)))
    return G.bank_audit(t, "text", "template", "source", F.col("lang") != "en", F.col("text").contains("e"), 100)


# --- sources and sinks: what is written is read back
def few(df, column: str, most: int = 1000) -> list:
    """Sorted values of a short list, which becomes configuration; a long one is an error."""
    got = sorted(r[column] for r in df.limit(most + 1).collect())
    if len(got) > most:
        raise ValueError(f"more than {most} values of {column}")
    return got


def folder(spark) -> str:
    """A new name in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_round_trip(spark, d):
    t, path = read(spark, d, "documents").select("doc_id", "text", "lang"), folder(spark)
    sinks.write_jsonl(t, path)
    return readers.read_jsonl(spark, path, t.schema)


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def csv_round_trip(spark, d):
    t, path = read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), folder(spark)
    sinks.write_csv(t, path)
    return readers.read_csv(spark, path, t.schema)


@query("SELECT doc_id, CAST(toxic AS INT) AS label, CASE WHEN quality = 1 THEN 'train' ELSE 'validation' END AS split FROM labels")
def dataset_round_trip(spark, d):
    t, path = read(spark, d, "labels").select("doc_id", F.col("toxic").alias("label"), F.when(F.col("quality") == 1, "train").otherwise("validation").alias("split")), folder(spark)
    sinks.write_dataset(t, path)
    return readers.read_dataset(spark, path, ("doc_id", "label")).select("doc_id", "label", F.col("split").cast("string").alias("split"))


@query("SELECT doc_id, source FROM documents")
def appended_once(spark, d):
    """Two overlapping batches; each id is written once."""
    t, path = read(spark, d, "documents").select("doc_id", "source"), folder(spark)
    sinks.append_new(t.join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"), path, "doc_id")
    sinks.append_new(t, path, "doc_id")
    return spark.read.schema(t.schema).parquet(path)


@query("SELECT 0 AS changed, count(*) > 0 AS written FROM documents")
def manifest_verified(spark, d):
    path = folder(spark)
    read(spark, d, "documents").write.json(path)
    listed = save_point(sinks.manifest(spark, path))
    bad = sinks.verify_manifest(spark, path, listed)
    return bad.agg(F.count("*").cast("int").alias("changed")).crossJoin(listed.agg((F.count("*") > 0).alias("written")))


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 2")
def component_samples(spark, d):
    return sinks.samples(read(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 2)


@query("SELECT lang, count(*) AS rows FROM documents WHERE length(trim(text)) > 0 GROUP BY lang")
def loaded_sources(spark, d):
    """One source a language, loaded by its spec from JSON lines."""
    t, root = read(spark, d, "documents").select("text", "lang"), folder(spark)
    langs = few(t.select("lang").distinct(), "lang")
    t.write.partitionBy("lang").json(root)
    specs = [readers.SourceSpec(x, f"{root}/lang={x}", "text string") for x in langs]
    return readers.load_sources(spark, specs).groupBy(F.col("source_name").alias("lang")).agg(F.count("*").alias("rows"))


@query("""WITH l AS (SELECT DISTINCT regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || x AS url FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']+)["'']', 1)) AS x FROM pages WHERE starts_with(url, 'https://')) WHERE starts_with(x, '/')) SELECT count(*) AS pages FROM l""")
def crawl_links(spark, d):
    """Distinct root-relative targets of secure pages."""
    t = read(spark, d, "pages").where(F.col("url").startswith("https://"))
    links = t.select("url", F.explode(T.html_links("url", "html")).alias("l"), T.url_parts("url")["netloc"].alias("host"))
    own = links.where(F.col("l").startswith("https://") & (T.url_parts("l")["netloc"] == F.col("host")))
    return own.select("l").distinct().agg(F.count("*").alias("pages"))


# --- dataset builds: rows are checked by tests of purity and counts
@query()
def build_flagship(spark, d):
    from . import builders as D

    payloads = read(spark, d, "benchmark").select(F.col("item_id").alias("payload_id"), F.col("text").alias("payload"))
    b = D.clean_windowed(read(spark, d, "documents"), payloads, None, {"doc_id": 6, "source_name": 5000}, 100)
    return b.reports["components"]


@query()
def build_general(spark, d):
    from . import builders as D

    t = labelled(spark, d).select(F.col("doc_id").alias("id"), "text", "label", F.col("source").alias("source_name"), F.col("lang").alias("bucket"))
    return R.counts(D.general_set(t, None, 2.0, max_source_share=1.0).rows, "split", "label")


@query()
def build_corrections(spark, d):
    from . import builders as D

    docs = read(spark, d, "documents")
    return R.counts(D.correction(labelled(spark, d).select("doc_id", "label", "score"), docs, 0.5, ["the", "la", "de"], docs).rows, "split", "label", "band")


@query()
def build_evaluation(spark, d):
    from . import builders as D

    docs = labelled(spark, d).select("doc_id", "text", "label")
    return D.evaluation_suite({"all": docs}, {"a": lambda c: T.unit(c), "b": lambda c: T.unit(F.concat(F.lit("b"), c))}, [0.5, 0.9]).reports["metrics"]

