"""Named queries on sources, sinks, streams, quotas, certification and builds, with their DuckDB SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import features as B
from ..functions import text as T
from ..operators import gates as G
from ..operators import identity as X
from ..operators import joins as J
from ..operators import policy as U
from ..operators import reports as R
from ..operators import sampling as Q
from ..sources import readers, sinks
from ..streaming import streams
from . import builders as D
from .queries import DOC, POLICY, POLICY_SQL, ROUTER, SP, hform, labelled, lsig, norm, policy_windows, query, read, rkey, scored, unit
from .queries_more import ALL_PHRASES, FAMILIES, contained, few, folder, joined


# --- sources and sinks
@query("SELECT doc_id, lang FROM documents")
def optional_file(spark, d):
    """A file that is missing adds nothing."""
    t, path = read(spark, d, "documents").select("doc_id", "lang"), folder(spark)
    sinks.write_jsonl(t, path)
    missing = readers.read_jsonl(spark, f"{path}-missing", t.schema, optional=True)
    return readers.read_jsonl(spark, [path, f"{path}-missing"], t.schema, optional=True).union(missing)


@query("SELECT lang, count(*) AS rows, true AS named FROM documents GROUP BY lang")
def several_folders(spark, d):
    t, path = read(spark, d, "documents").select("doc_id", "lang"), folder(spark)
    t.where("lang = 'en'").write.json(f"{path}/a")
    t.where("lang <> 'en'").write.json(f"{path}/b/c")
    got = readers.read_files(spark, [f"{path}/a", f"{path}/b"], "doc_id long, lang string", "*.json")
    return got.groupBy("lang").agg(F.count("*").alias("rows"), F.bool_and(F.col("_input_file").endswith(".json")).alias("named"))


@query("SELECT item_id, text || chr(10) AS text FROM benchmark")
def folders_of_text_files(spark, d):
    path = folder(spark)
    read(spark, d, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    return readers.read_text_files(spark, path).select(F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("long").alias("item_id"), "text")


@query("SELECT item_id, text FROM benchmark")
def paged_source(spark, d):
    """Asked page by page; those behind the last are missing, so only as many as there are."""
    base = folder(spark)
    sinks.write_pages(read(spark, d, "benchmark").select("item_id", "text"), base, "item_id", 10)
    return readers.read_paged(spark, "corpusloom.sources.readers:page_file", readers.page_files(base), "item_id long, text string", base=base)


@query("SELECT lang, count(*) AS rows FROM documents GROUP BY lang")
def cached_stage(spark, d):
    """Built once; the second call reads what the first wrote."""
    root, calls = folder(spark), []

    def build():
        calls.append(1)
        return R.counts(read(spark, d, "documents"), "lang")

    readers.cached_stage(spark, root, "langs", {"v": 1}, build)
    out = readers.cached_stage(spark, root, "langs", {"v": 1}, build)
    if len(calls) != 1:
        raise ValueError("a cached stage was built again")
    return out


@query("SELECT lang, count(*) AS rows FROM documents GROUP BY lang")
def report_written(spark, d):
    path = f"{folder(spark)}.json"
    sections = sinks.report_of({"langs": R.counts(read(spark, d, "documents"), "lang")})
    sinks.write_report(spark, path, sections)
    back = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return spark.createDataFrame([(r["lang"], r["rows"]) for r in back["langs"]], "lang string, rows long")


@query("SELECT CASE WHEN length(text) < 200 THEN 'short' WHEN lang <> 'en' THEN 'language' ELSE 'kept' END AS reason, count(*) AS rows FROM documents GROUP BY 1")
def rejects_aside(spark, d):
    kept, out = G.split_rejects(read(spark, d, "documents"), ("short", F.length("text") < 200), ("language", F.col("lang") != "en"))
    return R.counts(out, "reason").union(kept.agg(F.lit("kept"), F.count("*")))


@query(r"""WITH l AS (SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || x AS url FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"'']+)["'']', 1)) AS x FROM pages) WHERE starts_with(x, '/')) SELECT count(DISTINCT url) AS pages FROM l WHERE regexp_extract(url, '://([^/?#]*)', 1) IN ('thther.example.org', 'ththed.example.org')""")
def crawled(spark, d):
    """One step from all pages, within two hosts."""
    pages = read(spark, d, "pages")
    links = pages.select(F.explode(T.html_links("url", "html")).alias("u"))
    hosts = ["thther.example.org", "ththed.example.org"]
    return links.where(T.allowed_url("u", hosts) & T.url_host("u").isin(*hosts)).distinct().agg(F.count("*").alias("pages"))


# --- streams
@query(f"SELECT DISTINCT sha256({hform()}) AS text_key FROM documents")
def stream_first_seen(spark, d):
    path = folder(spark)
    read(spark, d, "documents").select("doc_id", "text").write.parquet(f"{path}-in")
    s = streams.first_seen(streams.read_stream(spark, f"{path}-in", "doc_id long, text string")).select("text_key")
    streams.append_once(s, f"{path}-out", f"{path}-checkpoint").awaitTermination()
    return spark.read.schema("text_key string").parquet(f"{path}-out")


@query(f"SELECT doc_id FROM documents ORDER BY {rkey('doc_id')} LIMIT 20")
def stream_sample(spark, d):
    """A uniform sample kept over batches."""
    path = folder(spark)
    read(spark, d, "documents").select("doc_id").repartition(3).write.parquet(f"{path}-in")
    s = streams.read_stream(spark, f"{path}-in", "doc_id long", 1)
    streams.running_top_k(s, f"{path}-out", f"{path}-checkpoint", 20, "doc_id").awaitTermination()
    out = spark.read.parquet(f"{path}-out")
    return out.join(out.agg(F.max("batch").alias("batch")), "batch").select("doc_id")


# --- functions
@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), value) AS score FROM events""")
def nested_fields(spark, d):
    k = T.nested("props", "k")
    return read(spark, d, "events").select("event_id", k.cast("double").alias("k"), T.first_score(T.nested("props", "missing"), k, "value").alias("score"))


@query(r"""WITH t AS (SELECT doc_id, source, length(regexp_replace(text, '[^А-Яа-яЁё]', '', 'g')) AS cyr, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS lat, lang FROM documents), s AS (SELECT *, CASE WHEN greatest(cyr, lat) = 0 THEN 'unknown' WHEN cyr >= greatest(40, lat * 2) THEN 'ru' WHEN lat >= greatest(40, cyr * 2) THEN 'en' WHEN least(cyr, lat) > 0 THEN 'mixed' WHEN cyr > 0 THEN 'ru' ELSE 'en' END AS seen FROM t)
SELECT doc_id, CASE WHEN source = 'src0' THEN 'ru' WHEN lang = 'en' THEN 'en' WHEN source = 'src1' AND seen = 'unknown' THEN 'mixed' ELSE seen END AS language FROM s""")
def canonical_languages(spark, d):
    named = F.when(F.col("source") == "src0", "RU-ru").when(F.col("lang") == "en", " English").when(F.col("source") == "src1", "multi").otherwise("fr")
    return read(spark, d, "documents").select("doc_id", T.canonical_language(named, "text").alias("language"))


@query(r"""WITH t AS (SELECT page_id, html, len(regexp_extract_all(html, 'Ð|Ñ|Â|â')) AS score, len(regexp_extract_all(html, 'â|\x{FFFD}|Ð|Ñ')) AS marks, lower(concat(' ', left(html, 4000))) AS head FROM pages)
SELECT page_id, sha256(html) AS decoded, score, marks >= 4 OR regexp_matches(html, 'â€|â™|â“|â”|â–') AS corrupted, regexp_matches(head, 'are you not a robot|captcha|access denied|доступ ограничен|проверка безопасности|подтвердите, что вы не робот') AS blocked FROM t""")
def decoded_pages(spark, d):
    """Pages are UTF-8 as they say; none of them can be read again as Latin-1."""
    t = read(spark, d, "pages")
    return t.select("page_id", F.sha2(T.decode_bytes(F.encode("html", "UTF-8")), 256).alias("decoded"), T.mojibake_score("html").alias("score"), T.looks_corrupted("html").alias("corrupted"), T.looks_blocked("html", F.lit("")).alias("blocked"))


@query(rf"""WITH t AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){SP}', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s, {norm()} AS n FROM documents),
f AS (SELECT *, list_filter(string_split(regexp_replace(n, '([.!?。]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: contains(lower(x), 'license') OR contains(lower(x), 'copyright')) AS hit, list_min(list_filter([instr(lower(n), 'license'), instr(lower(n), 'copyright')], lambda x: x > 0)) - 1 AS pos FROM t)
SELECT doc_id, len(s) AS sentences, sha256(array_to_string(s, '|')) AS hash, CASE WHEN len(hit) > 0 THEN left(array_to_string(hit[1:3], ' '), 900) WHEN pos >= 0 THEN n[greatest(pos - 220, 0) + 1 : pos + 680] ELSE left(n, 700) END AS fragment FROM f""")
def sentences_and_fragments(spark, d):
    s = T.sentences("text")
    return read(spark, d, "documents").select("doc_id", F.size(s).cast("long").alias("sentences"), F.sha2(F.array_join(s, "|"), 256).alias("hash"), T.fragment("text", ["license", "copyright"]).alias("fragment"))


@query(f"""WITH t AS (SELECT doc_id, {unit("doc_id")} AS u, CAST('0x' || substr(sha256(concat_ws(':', doc_id, 'what')), 1, 8) AS BIGINT) % 3 AS w FROM documents)
SELECT doc_id, CASE WHEN u < 0.65 THEN 'random' WHEN u < 0.72 THEN 'beginning' WHEN u < 0.79 THEN 'early' WHEN u < 0.86 THEN 'middle' WHEN u < 0.93 THEN 'late' ELSE 'end' END AS place, 'a ' || ['red', 'green', 'blue'][w + 1] || ' door' AS text FROM t""")
def rendered_choices(spark, d):
    """Choices by weight, and templates filled by key. No hash lies on an edge."""
    return read(spark, d, "documents").select("doc_id", T.token_position(F.col("doc_id")).alias("place"), T.render("a {what} door", F.col("doc_id"), what=["red", "green", "blue"]).alias("text"))


@query(f"""WITH t AS (SELECT doc_id, text, lang, lower(text) AS x, {hform()} AS n FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(x, 'licen[sc]e') THEN 'licence' WHEN regexp_matches(x, 'token') THEN 'token' ELSE 'other' END AS intent, {joined({"long": "length(text) > 2000", "foreign": "lang <> 'en'", "asks": "contains(text, '?')"})} AS tags, contains(n, 'example') OR regexp_matches(n, '["''«“„`].{{0,2}}({"|".join(ALL_PHRASES)})|({"|".join(ALL_PHRASES)}).{{0,2}}["''»”`]') AS quoted FROM t""")
def intents_and_tags(spark, d):
    tags = B.tags(long=F.length("text") > 2000, foreign=F.col("lang") != "en", asks=F.col("text").contains("?"))
    return read(spark, d, "documents").select("doc_id", B.first_match("text", {"licence": "licen[sc]e", "token": "token"}, "other").alias("intent"), F.array_join(tags, ",").alias("tags"), B.quoted_or_discussed("text", ALL_PHRASES, ["example"]).alias("quoted"))


# --- predicates, joins, quotas
@query(f"""WITH j AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'attack' ELSE 'benign' END AS l, {unit("concat_ws(':', 'j', doc_id)")} AS c FROM labels), t AS (SELECT doc_id, l, coalesce(c >= 0.8, false) AS sure, {contained(hform(), FAMILIES["listing"])} > 0 AS rule FROM documents LEFT JOIN j USING (doc_id))
SELECT doc_id, CASE WHEN sure THEN l = 'attack' ELSE rule END AS keep, CASE WHEN sure AND l = 'attack' THEN 'judged_attack' WHEN sure THEN 'judged_benign' WHEN rule THEN 'rule_evidence' ELSE 'no_evidence' END AS decision FROM t""")
def curated_rows(spark, d):
    j = read(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "attack").otherwise("benign").alias("label"), T.unit(F.concat_ws(":", F.lit("j"), "doc_id")).alias("confidence"))
    t = read(spark, d, "documents").select("doc_id", "text")
    return G.curate(t, j, "doc_id", B.hits(T.hash_form("text"), FAMILIES["listing"]) > 0).select("doc_id", "keep", "decision")


@query("WITH a AS (SELECT lang, row_number() OVER (ORDER BY lang) AS n FROM (SELECT DISTINCT lang FROM documents)), b AS (SELECT source, row_number() OVER (ORDER BY source) AS n FROM (SELECT DISTINCT source FROM documents)) SELECT lang, source FROM a JOIN b USING (n)")
def zipped_lists(spark, d):
    t = read(spark, d, "documents")
    return J.zip_rows(t.select("lang").distinct(), t.select("source").distinct(), "lang", "source")


@query("""WITH c AS (SELECT lang AS key, count(*) AS n FROM documents GROUP BY lang), w AS (SELECT *, sum(n) OVER () AS whole FROM c), r AS (SELECT key, n, CAST(round_even(n * 101.0::DOUBLE / whole, 0) AS BIGINT) AS r, CAST(floor(n * 101 / whole) AS BIGINT) AS f FROM w)
SELECT key, r + CASE WHEN key = 'en' THEN 101 - (SELECT CAST(sum(r) AS BIGINT) FROM r) ELSE 0 END AS drift, f + CASE WHEN row_number() OVER (ORDER BY key) <= 101 - (SELECT sum(f) FROM r) THEN 1 ELSE 0 END AS leading FROM r""")
def rounded_quotas(spark, d):
    counts = R.counts(read(spark, d, "documents"), "lang").select(F.struct("lang", "rows").alias("c"))
    w = {lang: rows for lang, rows in few(counts, "c")}
    drift, leading = Q.drift_quota(w, 101, "en"), Q.leading_quota(w, 101)
    return spark.createDataFrame([(k, drift[k], leading[k]) for k in w], "key string, drift long, leading long")


@query(f"""WITH b AS (SELECT unnest([{{'kind': 'text_hash', 'value': sha256({hform()})}}, {{'kind': 'long_signature', 'value': {lsig()}}}, {{'kind': 'document_id', 'value': CAST(item_id AS VARCHAR)}}], recursive := true), 'benchmark' AS o FROM benchmark),
t AS (SELECT unnest([{{'kind': 'text_hash', 'value': sha256({hform()})}}, {{'kind': 'long_signature', 'value': {lsig()}}}, {{'kind': 'document_id', 'value': CAST(doc_id AS VARCHAR)}}], recursive := true), 'toxic' AS o FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT kind, value, string_agg(DISTINCT o, ',' ORDER BY o) AS origins FROM (SELECT * FROM b UNION ALL SELECT * FROM t) GROUP BY kind, value""")
def extended_index(spark, d):
    toxic = labelled(spark, d).where("label = 1").select("doc_id", "text")
    index = X.extend_index(X.exclusion_index({"benchmark": read(spark, d, "benchmark")}, "item_id"), X.exclusion_index({"toxic": toxic}))
    return index.withColumn("origins", F.array_join("origins", ","))


@query("SELECT doc_id, label FROM (SELECT doc_id, toxic AS label, text FROM documents JOIN labels USING (doc_id)) WHERE (label = 1) = contains(lower(text), 'license')")
def strict_rows(spark, d):
    t = labelled(spark, d).select("doc_id", "label", "text")
    return D.strict_windows(t, F.lower("text").contains("license")).rows.select("doc_id", "label")


@query("SELECT k AS key, CAST(have AS BIGINT) AS have, need, have >= n * 1.2 AS enough FROM (SELECT t.k, t.n, CAST(ceil(t.n * 1.2 - 1e-9) AS BIGINT) AS need, count(d.doc_id) AS have FROM (VALUES ('src0', 10), ('src1', 5000), ('none', 3)) t(k, n) LEFT JOIN documents d ON d.source = t.k GROUP BY t.k, t.n)")
def capacity_preflight(spark, d):
    c = G.capacity(read(spark, d, "documents"), "source", {"src0": 10, "src1": 5000, "none": 3})
    return spark.createDataFrame([(k, v["have"], v["need"], v["enough"]) for k, v in c.items()], "key string, have long, need long, enough boolean")


# --- policy
@query(f"WITH {POLICY_SQL} SELECT doc_id, window_index, NOT anchor AND score >= 0.3 AND sec AND wrap AND meta AND score < 0.95 AS eligible FROM pol")
def reviewer_eligibility(spark, d):
    return policy_windows(spark, d).select("doc_id", "window_index", F.col("reviewer_eligible").alias("eligible"))


@query(f"""WITH {DOC}, t AS (SELECT *, score >= 0.05 AS seen, score < 0.05 OR {unit("concat_ws(':', 'b', doc_id)")} < 0.3 AS allowed FROM dl WHERE lang = 'en'), c AS (SELECT count(*) AS rows, count(*) FILTER (label = 1) AS n, count(*) FILTER (label = 1 AND seen AND allowed) AS k, count(*) FILTER (label = 1 AND NOT seen AND allowed) AS missed, count(*) FILTER (label = 0 AND seen) AS alarms FROM t),
p AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM c), x AS (SELECT count(DISTINCT sha256({hform()})) AS leaks FROM t WHERE sha256({hform()}) IN (SELECT sha256({hform()}) FROM benchmark))
SELECT CASE WHEN k > 0 THEN 'reject' ELSE 'review_only' END AS status, rows, n AS attacks, k AS added, missed, alarms, leaks, round(least(1, (p + z*z/(2*n) + z * sqrt((p*(1-p) + z*z/(4*n)) / n)) / (1 + z*z/n)), 10) AS upper FROM p, x""")
def slice_certification(spark, d):
    bound = {"router_version": ROUTER.router_version, "router_config_hash": ROUTER.hash, "policy_engine_version": POLICY.engine_version, "policy_config_hash": POLICY.hash, "reviewer_model_id": POLICY.reviewer_model_id}
    action = F.when((F.col("score") < 0.05) | (T.unit(F.concat_ws(":", F.lit("b"), "doc_id")) < 0.3), "ALLOW").otherwise("REVIEW")
    t = labelled(spark, d).select(F.when(F.col("lang") == "en", "s1").alias("category"), "label", (F.col("score") >= 0.05).alias("stage1_positive"), action.alias("proposed_action"), (action == "ALLOW").alias("potential_allow"), T.text_hash("text", 64).alias("text_hash"), *(F.lit(v).alias(k) for k, v in bound.items()))
    locked = read(spark, d, "benchmark").select(T.text_hash("text", 64).alias("text_hash"))
    c = U.certify(t, POLICY, "s1", "wrappers are benign", training=locked)
    row = c["status"], c["rows"], c["attack_rows"], c["attack_allow_policy_added"], c["attack_allow_baseline_miss"], c["false_alarms"], c["leaks"]["text_hash"], round(c["attack_allow_upper"], 10)
    return spark.createDataFrame([row], "status string, rows long, attacks long, added long, missed long, alarms long, leaks long, upper double")


# --- builds: rows are checked by tests of purity and counts
def _rows(spark, d):
    return labelled(spark, d).select(F.col("doc_id").alias("id"), "text", "label", F.col("source").alias("source_name"), F.col("lang").alias("bucket"), "score")


@query()
def build_windowed(spark, d):
    docs = D.documents(read(spark, d, "documents"))
    return D.windowed_correction(docs, scored(spark, d).select("doc_id", "window_index", "token_start", "window_text", "score"), 0.8).reports["components"]


@query()
def build_exact_counts(spark, d):
    t = _rows(spark, d)
    return D.exact_build(t, {"src0": 10, "src1": 10, "src2": 10, "src3": 30}, {"train": {0: 20, 1: 2}, "test": {0: 5, 1: 1}}).reports["splits"]


@query()
def build_reviewer_set(spark, d):
    t = _rows(spark, d).withColumn("key", F.left("text", F.lit(40)))
    return D.reviewer_set(t, 0.2, 40, ["key"], 8).reports["labels"]


@query()
def build_restoration(spark, d):
    t = _rows(spark, d)
    return D.restoration(t.where("label = 1 and score < 0.5"), t, ["bucket"], 60, t).reports["components"]
