"""Named queries on resumable sources, whole greedy builds, and operators that had none, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import gates as G
from ..operators import judging as K
from ..operators import metrics as A
from ..operators import ordering as O
from ..operators import reports as R
from ..operators import sampling as Q
from ..operators import splits as S
from ..operators import windows as V
from ..operators.storage import save_point
from ..sources import arrow_dataset, readers, resume, sinks, zstd_lines
from ..streaming import streams
from . import builders as D
from .queries import DOC, ORACLES, SP, SPLIT, hform, labelled, query, read, rkey, scored, sint, windows_sql
from .queries_more import few, folder

PAGE, PAGES = "corpusloom.sources.readers:page_file", "corpusloom.sources.readers:page_files"


# --- sources that stop and go on
@query("SELECT doc_id, text, lang FROM documents")
def zstd_frames(spark, d):
    """Written frame by frame, read back in tasks of few frames."""
    t, path = read(spark, d, "documents").select("doc_id", "text", "lang"), folder(spark)
    zstd_lines.write_zstd_frames(t, path, 50)
    return zstd_lines.read_zstd_frames(spark, path, "doc_id long, text string, lang string", 1 << 20).select("doc_id", "text", "lang")


@query(f"SELECT doc_id, text, {SPLIT} AS split FROM documents")
def arrow_splits(spark, d):
    t, path = S.random_split(read(spark, d, "documents").select("doc_id", "text"), "doc_id", 0.2), folder(spark)
    arrow_dataset.write_arrow_splits(t, path)
    return arrow_dataset.read_arrow_splits(spark, path, "doc_id long, text string").select("doc_id", "text", "split")


@query("SELECT doc_id, text FROM documents")
def hub_stream(spark, d):
    """A paged stream, read in two runs of one checkpoint: the second begins behind the pages of the first."""
    t, base = read(spark, d, "documents").select("doc_id", "text"), folder(spark)
    sinks.write_pages(t, base, "doc_id", 200)
    pages = readers.page_files(base)
    for upto in (pages // 2, pages):
        stream = readers.stream_paged(spark, PAGE, PAGES, "doc_id long, text string", base=base, pages=upto)
        streams.append_once(stream, f"{base}-out", f"{base}-checkpoint").awaitTermination()
    return spark.read.schema("doc_id long, text string").parquet(f"{base}-out")


@query(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256({hform()}) ORDER BY doc_id) AS r FROM documents WHERE length(text) >= 200) WHERE r = 1")
def resumed_collection(spark, d):
    """A collection of four steps that is killed in the third and goes on."""
    t, root = save_point(O.numbered(read(spark, d, "documents").select("doc_id", "text"), "seq", "doc_id")), folder(spark)
    n, calls = t.count(), []

    def build(rows):
        calls.append(1)
        if len(calls) == 4:  # one call asks for the columns
            raise InterruptedError
        return rows.where(F.length("text") >= 200).select("seq", "doc_id", T.text_hash("text", 64).alias("key"))

    arguments = (t, "seq", build, "key", root, "documents", {"least": 200}, n, n, -(-n // 4))
    try:
        resume.collect_source(*arguments)
    except InterruptedError:
        pass
    return resume.collect_source(*arguments).rows.select("doc_id")


@query("""WITH p AS (SELECT regexp_extract(url, '://([^/?#]+)', 1) AS domain, url, page_id::DOUBLE AS arrived, row_number() OVER (PARTITION BY regexp_extract(url, '://([^/?#]+)', 1) ORDER BY page_id, url) - 1 AS i FROM pages WHERE url IS NOT NULL)
SELECT domain, url, arrived, max(arrived - 3.0 * i) OVER (PARTITION BY domain ORDER BY i) + 3.0 * i AS fetch_at FROM p""")
def polite_crawl(spark, d):
    """Pages arrive at second page_id; requests to a host are three seconds apart."""
    path = folder(spark)
    t = read(spark, d, "pages").where("url is not null").select(F.regexp_extract("url", "://([^/?#]+)", 1).alias("domain"), "url", "page_id")
    streams.in_order(t, f"{path}-in", 200_000, "page_id")
    stream = streams.polite(streams.read_stream(spark, f"{path}-in", "domain string, url string, page_id long", 1), "domain", "url", "page_id", 3.0)
    streams.append_once(stream, f"{path}-out", f"{path}-checkpoint").awaitTermination()
    return spark.read.schema("domain string, url string, arrived double, fetch_at double").parquet(f"{path}-out")


@query(rf"SELECT conv_id, turn, CASE WHEN trim(regexp_replace(text, '{SP}', ' ', 'g')) = '' THEN role ELSE role || chr(10) || chr(10) || regexp_replace(regexp_replace(text, '^{SP}', ''), '{SP}$', '') END AS text FROM conversations WHERE text IS NOT NULL")
def nested_strings(spark, d):
    t = read(spark, d, "conversations").where("text is not null")
    return t.select("conv_id", "turn", T.flatten_json(F.to_json(F.struct("role", "turn", F.array(F.struct("text")).alias("parts")))).alias("text"))


@query("SELECT source, count(*) AS rows FROM documents GROUP BY source")
def guarded_paths(spark, d):
    """Inputs whose path names a locked set are refused; these do not."""
    t = read(spark, d, "documents")
    readers.guard_paths([r[0] for r in t.select(F.input_file_name().alias("f")).distinct().limit(1000).collect()], ["locked", "blind_eval"])
    return R.counts(t, "source")


# --- functions and predicates
def _varied(c: str, old: str, new: str, i: int) -> str:
    return f"CASE WHEN {sint(f'concat_ws(chr(58), doc_id % 4, {i})')} % 2 = 0 AND instr({c}, '{old}') > 0 THEN left({c}, CAST(instr({c}, '{old}') AS INT) - 1) || '{new}' || substr({c}, CAST(instr({c}, '{old}') AS INT) + {len(old)}) ELSE {c} END"


@query(f"""WITH a AS (SELECT doc_id, {_varied("coalesce(text, '')", " the ", " a ", 0)} AS t FROM documents), b AS (SELECT doc_id, {_varied("t", " and ", " & ", 1)} AS t FROM a)
SELECT doc_id, CASE WHEN doc_id % 4 > 0 AND doc_id % 4 % 2 = 0 THEN '[' || t || ']' ELSE t END AS text FROM b""")
def varied_texts(spark, d):
    return read(spark, d, "documents").select("doc_id", T.vary("text", [(" the ", " a "), (" and ", " & ")], F.col("doc_id") % 4, [(2, "[", "]")]).alias("text"))


@query(r"SELECT item_id, text <> '' AND contains(lower(text), lower(right(text, 30))) AND lower(trim(right(text, 30))) NOT IN ('', 'thank you') AND regexp_matches(lower(right(text, 30)), 'the|must|license') AS good FROM benchmark")
def good_anchors(spark, d):
    return read(spark, d, "benchmark").select("item_id", G.good_anchor(F.col("text"), F.right("text", F.lit(30)), "the|must|license", ["thank you"]).alias("good"))


@query("SELECT doc_id, lower(CAST(quality AS VARCHAR)) IN ('1', 'good') AS counts FROM labels")
def labels_by_spec(spark, d):
    return read(spark, d, "labels").select("doc_id", F.coalesce(G.by_spec(F.col("quality"), {"labels": [1, "good"]}), F.lit(None).cast("boolean")).alias("counts"))


@query(f"WITH {DOC}, t(threshold) AS (VALUES (0.5::DOUBLE), (0.9::DOUBLE)), c AS (SELECT lang AS corpus, threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp, count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 0 AND score < threshold) AS tn, count(*) FILTER (label = 1 AND score < threshold) AS fn FROM dl, t GROUP BY ALL) SELECT 'm' AS model, *, tp + fp + tn + fn AS documents, coalesce(fp / nullif(fp + tn, 0), 0.0) AS fpr FROM c")
def flattened_models(spark, d):
    """Summaries with a map of thresholds, one row a corpus, made flat."""
    t = A.threshold_metrics(labelled(spark, d), [0.5, 0.9], by=["lang"])
    nested = t.groupBy(F.lit("m").alias("model"), F.col("lang").alias("corpus")).agg(F.map_from_entries(F.collect_list(F.struct("threshold", F.struct(*A.COUNTS)))).alias("by_threshold"))
    return A.flatten_models(nested, "model", "corpus", "by_threshold").select("model", "corpus", "threshold", *A.COUNTS, "documents", "fpr")


@query("WITH c AS (SELECT count(*) FILTER (trim(lang) <> '') AS a, count(*) FILTER (trim(source) <> '') AS b, count(*) FILTER (trim(text) <> '') AS c FROM documents) SELECT CASE WHEN greatest(a, b, c) = 0 THEN NULL WHEN a >= b AND a >= c THEN 'lang' WHEN b >= c THEN 'source' ELSE 'text' END AS field FROM c")
def voted_field(spark, d):
    best = R.vote_field(read(spark, d, "documents"), ["missing", "lang", "source", "text"])
    return spark.createDataFrame([(best,)], "field string")


# --- quotas and selection
@query("""WITH c AS (SELECT source, count(*) AS w FROM documents WHERE source IS NOT NULL GROUP BY source), s AS (SELECT *, CAST(round_even(w * 1000 / (SELECT sum(w) FROM c), 0) AS BIGINT) AS n, row_number() OVER (ORDER BY w DESC, source) AS r FROM c)
SELECT source, CAST(n + CASE WHEN r <= abs(1000 - (SELECT sum(n) FROM s)) THEN sign(1000 - (SELECT sum(n) FROM s)) ELSE 0 END AS BIGINT) AS quota FROM s""")
def cyclic_quotas(spark, d):
    t = read(spark, d, "documents").where("source is not null")
    names = few(t.select("source").distinct(), "source")
    counts = {r["source"]: r["rows"] for r in R.counts(t.where(F.col("source").isin(names)), "source").collect()}
    return spark.createDataFrame(sorted(Q.cyclic_quota(counts, 1000).items()), "source string, quota long")


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang), i(part, w, k) AS (VALUES ('short', 1, 1), ('medium', 2, 2), ('long', 4, 3))
SELECT lang, part, CAST(n * w // 7 + CASE WHEN k <= n - (n * 1 // 7 + n * 2 // 7 + n * 4 // 7) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM c, i""")
def nested_quotas(spark, d):
    t = read(spark, d, "documents").where("lang is not null")
    outer = {r["lang"]: r["rows"] for r in R.counts(t.where(F.col("lang").isin(few(t.select("lang").distinct(), "lang"))), "lang").collect()}
    got = Q.nested_quota(outer, {"short": 1, "medium": 2, "long": 4})
    return spark.createDataFrame([(*k, n) for k, n in got.items()], "lang string, part string, quota long")


@query()
def water_filled(spark, d):
    """Shares that are full give to the rest; tested by itself."""
    t = read(spark, d, "documents").where("source is not null")
    there = {r["source"]: r["rows"] for r in R.counts(t.where(F.col("source").isin(few(t.select("source").distinct(), "source"))), "source").collect()}
    return spark.createDataFrame(sorted(Q.water_fill(sum(there.values()) * 2 // 3, there).items()), "source string, quota long")


@query(f"""WITH k AS (SELECT doc_id, source, lang, CASE WHEN n_chars < 1000 THEN 'low' ELSE 'high' END AS band, {rkey('doc_id')} AS k FROM documents), c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS a, row_number() OVER (PARTITION BY lang ORDER BY k) AS b FROM k) WHERE a <= 30 AND b <= 70),
p AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY band ORDER BY k) <= CASE band WHEN 'low' THEN 40 ELSE 60 END THEN 1 ELSE 2 END AS phase FROM c), f AS (SELECT *, row_number() OVER (PARTITION BY phase ORDER BY k) AS n FROM p)
SELECT doc_id, band, phase FROM f WHERE phase = 1 OR n <= greatest(0, 100 - (SELECT count(*) FROM p WHERE phase = 1))""")
def band_mixture(spark, d):
    t = read(spark, d, "documents").withColumn("band", F.when(F.col("n_chars") < 1000, "low").otherwise("high"))
    return Q.band_mix(t, "band", {"low": 2, "high": 3}, 100, {"source": 30, "lang": 70}, "doc_id").select("doc_id", "band", "phase")


@query(ORACLES["cap_fold"])
def cap_rounds(spark, d):
    """The choice of `cap_fold` in rounds, as on tables that no task holds."""
    return Q.cap_fold(read(spark, d, "documents").select("doc_id", "source", "lang"), {"source": 20, "lang": 60}, 200, "doc_id", small=0)


@query(f"""WITH RECURSIVE o AS (SELECT doc_id, source, lang, dense_rank() OVER (ORDER BY source) AS si, dense_rank() OVER (ORDER BY lang) AS li, row_number() OVER (ORDER BY {rkey("doc_id")}) AS n, count(*) OVER () AS total FROM documents),
f AS (SELECT 0::BIGINT AS n, [x * 0 for x in range((SELECT max(si) FROM o))] AS cs, [x * 0 for x in range((SELECT max(li) FROM o))] AS cl, 0 AS taken, [false for x in range((SELECT max(n) FROM o))] AS had, 0 AS pass UNION ALL
SELECT n, list_transform(cs, lambda x, i: x + (good AND i = si)::INT), list_transform(cl, lambda x, i: x + (good AND i = li)::INT), taken + good::INT, CASE WHEN good AND n <= total THEN list_transform(had, lambda x, i: x OR i = n) ELSE had END, CASE WHEN good THEN CASE WHEN n <= total THEN 1 ELSE 2 END ELSE 0 END
FROM (SELECT f.n + 1 AS n, total, si, li, cs, cl, taken, had, taken < 150 AND cs[si] < 30 AND (f.n + 1 > total OR cl[li] < CASE lang WHEN 'en' THEN 40 WHEN 'de' THEN 20 ELSE 0 END) AND NOT (f.n + 1 > total AND had[o.n]) AS good FROM f JOIN o ON o.n = f.n % o.total + 1 WHERE f.n < 2 * o.total))
SELECT doc_id, lang, source, pass FROM f JOIN o ON o.n = (f.n - 1) % o.total + 1 WHERE pass > 0""")
def targets_then_relaxed(spark, d):
    """Targets of two languages under a cap of each source, then whatever the sources' cap allows."""
    t = read(spark, d, "documents").select("doc_id", "lang", "source")
    return Q.targeted_sample(t, "lang", {"en": 40, "de": 20}, "source", 30, 150, "doc_id").select("doc_id", "lang", "source", "pass")


@query()
def capped_build(spark, d):
    """Components to their targets, then leftovers by language and of any kind; tested against the walk."""
    t = read(spark, d, "documents").select("doc_id", "lang", "source", F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "medium").alias("component"), T.text_hash("text", 64).alias("text_key"))
    return Q.capped_build(t, "component", {"short": 50, "medium": 70}, {"source": 40, "lang": {"en": 120, "de": 60, "fr": 60, "es": 60}, "text_key": 1}, 260, "doc_id", "lang", {"de": 50, "fr": 50}).select("doc_id", "component", "lang", "source", "pass")


@query()
def bundles_of_carriers(spark, d):
    """Windows of documents as carriers, cut to a ratio; tested against the walk."""
    w = scored(spark, d).select("doc_id", "window_index", (F.col("score") >= 0.7).cast("int").alias("label"), F.concat_ws(":", "doc_id", "window_index").alias("id"))
    return Q.carrier_bundles(w, "doc_id", "label", (60, 90), "id").select("doc_id", "window_index", "label")


# --- choices whose SQL is new
ORACLES["windows_apart"] = f"""WITH {windows_sql()}, s AS (SELECT doc_id, window_index, token_start, score FROM win),
a AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, window_index) = 1),
b AS (SELECT s.* FROM s JOIN a ON s.doc_id = a.doc_id AND abs(s.token_start - a.token_start) >= 256 QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY s.score DESC, s.window_index) = 1),
c AS (SELECT s.* FROM s JOIN a ON s.doc_id = a.doc_id AND abs(s.token_start - a.token_start) >= 256 JOIN b ON s.doc_id = b.doc_id AND abs(s.token_start - b.token_start) >= 256 QUALIFY row_number() OVER (PARTITION BY s.doc_id ORDER BY s.score DESC, s.window_index) = 1)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c"""

ORACLES["cover_split"] = f"""WITH t AS (SELECT doc_id, concat_ws('-', lang, doc_id % 50) AS "group", source FROM documents), z AS (SELECT "group", count(*) AS rows, {rkey('"group"')} AS k FROM t GROUP BY "group"),
v AS (SELECT DISTINCT "group" FROM (SELECT p."group", row_number() OVER (PARTITION BY source ORDER BY rows, k) AS r FROM (SELECT DISTINCT "group", source FROM t) p JOIN z USING ("group")) WHERE r = 1),
o AS (SELECT z.*, v."group" IS NULL AS c FROM z LEFT JOIN v USING ("group")), b AS (SELECT *, coalesce(sum(rows) OVER (ORDER BY c, rows, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
SELECT doc_id, "group", CASE WHEN NOT c OR before < 100 THEN 'validation' ELSE 'train' END AS split FROM t JOIN b USING ("group")"""


# --- judgments, checks and builds
def judge_by_length():
    """A service that fails on large batches and leaves rows out at first: long texts are the attacks."""
    asked: set[str] = set()

    def judge(rows):
        if len(rows) > 8:
            raise ValueError("too many")
        new = [r for r in rows if r["candidate_id"] in asked or int(r["candidate_id"]) % 5]
        asked.update(r["candidate_id"] for r in rows)
        return [{"candidate_id": r["candidate_id"], "label": "attack" if r["n_chars"] > 2000 else "benign", "confidence": 0.5, "evidence_span": "", "rationale_short": "length"} for r in new]

    return judge


@query("SELECT CAST(doc_id AS VARCHAR) AS candidate_id, CASE WHEN n_chars > 2000 THEN 'attack' ELSE 'benign' END AS label, 0.5::DOUBLE AS confidence FROM documents")
def judged_rows(spark, d):
    t = read(spark, d, "documents").select(F.col("doc_id").alias("candidate_id"), "n_chars")
    return K.judge_rows(t, judge_by_length, ["n_chars"]).select("candidate_id", "label", "confidence")


@query(f"""WITH {DOC}, n AS (SELECT count(*) AS n FROM dl), s AS (SELECT source, count(*) AS c FROM dl GROUP BY source) SELECT 'source share: ' || source AS issue FROM s, n WHERE c > 0.1 * n
UNION ALL SELECT 'critical bucket: ' || b || ' has ' || count(lang) || ' rows' FROM (VALUES ('en'), ('xx')) v(b) LEFT JOIN dl ON lang = b GROUP BY b HAVING count(lang) < 200""")
def split_issues(spark, d):
    issues = G.split_issues(labelled(spark, d).select("label", "source", "lang"), "label", "source", "lang", ["en", "xx"], 0.1, 200)
    return spark.createDataFrame([(i,) for i in issues], "issue string")


@query(f"WITH {DOC} SELECT doc_id, label FROM dl")
def counts_asserted(spark, d):
    t = labelled(spark, d).select("doc_id", "label")
    return G.assert_counts(t, "label", {r["label"]: r["rows"] for r in R.counts(t, "label").collect()})


@query("SELECT unnest(['missing card.md', 'train lacks label']) AS issue FROM (SELECT count(*) FROM documents)")
def package_issues(spark, d):
    root = folder(spark)
    read(spark, d, "documents").select("doc_id", "text").write.parquet(f"{root}/train")
    sinks.write_text(spark, f"{root}/state.json", "{}")
    return spark.createDataFrame([(i,) for i in G.package_issues(spark, root, ["state.json", "card.md"], {"train": ["text", "label"]})], "issue string")


@query()
def built_pool(spark, d):
    """Rows of a document pool: fit, not of the benchmark, each text once."""
    index = D.X.exclusion_index({"benchmark": read(spark, d, "benchmark")}, "item_id")
    docs = read(spark, d, "documents")
    return D.document_pool(docs, index, {"legal": ["license", "copyright"], "web": ["http", "@"]}, {"legal": 40, "web": 40, "general": 60}).rows.select("doc_id", "category", "language", "length_bucket", "phase")


@query()
def built_augmentation(spark, d):
    """Rows of benchmark passages set into documents and cropped around."""
    phrases = read(spark, d, "benchmark").select(F.col("item_id").alias("phrase_id"), F.col("text").alias("phrase"))
    carriers = read(spark, d, "documents").where("length(text) > 0")
    return D.augmented(carriers, phrases, "deep", 1, "embedded").select("doc_id", "phrase_id", "split_hint", "span_start", "span_stop", "label", F.sha2("text", 256).alias("text_sha256"))


@query()
def built_parent_correction(spark, d):
    """Rows of two component reservoirs, each text once, split by shared text ends and document."""
    t = labelled(spark, d).select(F.col("doc_id").cast("string").alias("id"), "text", F.col("label").cast("int").alias("label"), F.when(F.col("label") == 1, "attack").otherwise("benign").alias("component"), F.left(T.hash_form("text"), F.lit(80)).alias("head"))
    half = F.xxhash64("id") % 2 == 0
    return D.parent_correction(t.where(half), t.where(~half), {"attack": 1, "benign": 3}, 200, ["head"], 40).rows.select("id", "component", "label", "group", "split")


@query()
def built_flagship(spark, d):
    """Rows of the whole flagship build: benchmark passages as payloads, high windows as mined rows, windows on licenses as misses."""
    w = scored(spark, d).where("doc_id is not null").withColumnRenamed("source", "source_pool")
    mined = w.select("doc_id", F.col("window_text").alias("text"), F.lit("benign").alias("label"), "score", "source_pool", (F.col("doc_id") % 2 == 0).alias("reviewed"))
    misses = w.where(F.contains("window_text", F.lit("icense"))).select("doc_id", F.col("window_text").alias("text"), F.lit("attack").alias("label"), "source_pool", F.lit("license").alias("anchor"), F.col("window_text").alias("attack_text"), F.lit(True).alias("visible"))
    payloads = read(spark, d, "benchmark").select(F.col("item_id").alias("payload_id"), F.col("text").alias("payload"))
    pools = few(read(spark, d, "documents").select("source").where("source is not null").distinct(), "source")
    index = D.X.exclusion_index({"benchmark": read(spark, d, "benchmark")}, "item_id")
    targets = {"reviewed_near_boundary": 20, "mined_benign": 60, "missed_attack": 30, "embedded_attack": 90, "standalone_attack": 10, "same_document_contrast": 40, "random_benign": 60, "original_contrast": 90}
    b = D.flagship(read(spark, d, "documents"), payloads, mined, misses, index, targets, 80, {"doc_id": 8, "payload_id": 12, "source_name": 120}, r"\blicense\b", "version|copyright|the", "^thank you$", pools)
    return b.rows.select("id", "component", "label", "doc_id", "payload_id", "split", "pass", F.sha2("text", 256).alias("text_sha256"))
