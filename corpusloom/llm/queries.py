"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann_search, exact_dedup, knn_join, language_id, line_dedup, mixing, near_dedup, packing, sharding, token_counts, url_filter, vector_codes, whitening
from ._common import table


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules that the query fixes.
RULES = [url_filter.Rule("net", "/", "block"), url_filter.Rule("example.net", "/en/", "allow"), url_filter.Rule("example.com", "/de/", "block"), url_filter.Rule("org", "/fr/", "allow")]


#: Words of hosts that count as labelled bad. A host is judged by trees that were fitted on other hosts only.
BAD_HOST_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "viagra")


def op1(spark, d):
    pages = table(spark, d, "pages")
    return url_filter.filter_urls(pages, RULES, url_filter.cross_fit(url_filter.weak_labels(pages, RULES, BAD_HOST_WORDS)))


def op2(spark, d):
    return token_counts.count_tokens(table(spark, d, "documents"), token_counts.read_vocabulary(vocabulary("piece_bpe_32k.model")))


def op3(spark, d):
    return knn_join.top_products(table(spark, d, "embeddings"))


def op4(spark, d):
    """The cleaned texts as digests."""
    out = line_dedup.dedup_lines(table(spark, d, "documents"))
    return out.select("doc_id", "n_lines", "removed_lines", F.to_json("spans").alias("spans"), F.sha2("text", 256).alias("text_sha256"))


def op5(spark, d):
    return sharding.shard_documents(table(spark, d, "documents"))


def op6(spark, d):
    return mixing.mix_sources(table(spark, d, "documents"))


def op7(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"), k=2)


def op8(spark, d):
    return exact_dedup.content_sort(table(spark, d, "documents")).drop("n_codepoints")


def op9(spark, d):
    return language_id.languages(table(spark, d, "documents"))


def op10(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"))


def op11(spark, d):
    return ann_search.nearest(table(spark, d, "embeddings"))


def op12(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"))


def op13(spark, d):
    return vector_codes.compress(table(spark, d, "embeddings"))


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd rounds as a chain of common table expressions: b are codebooks, a assignments, by all distances."""
    sql = [
        """v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "p AS MATERIALIZED (SELECT vec_id, part, list_slice(q, part * len(q) // 4 + 1, (part + 1) * len(q) // 4) AS x FROM v, (SELECT unnest(range(4)) AS part))",
        "b0 AS MATERIALIZED (SELECT part, entry, x FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < 256)",
    ]
    for r in range(rounds + 1):
        sql.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p.part, any_value(p.x) AS x, min({{'d': list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x), 'entry': entry}}) AS m
      FROM p JOIN b{r} b ON p.part = b.part GROUP BY vec_id, p.part)""")
        if r < rounds:
            sql.append(f"u{r} AS (SELECT part, m.entry AS entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{r})")
            sql.append(f"n{r} AS (SELECT part, entry, list(c ORDER BY i) AS x FROM (SELECT part, entry, i, CAST(floor(sum(c)::DOUBLE / count(*)) AS BIGINT) AS c FROM u{r} GROUP BY part, entry, i) GROUP BY part, entry)")
            sql.append(f"b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN n{r} n USING (part, entry))")
    sql.append(f"e AS (SELECT vec_id, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    sql.append("l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM e JOIN v USING (vec_id) GROUP BY label)")
    sql.append(f"h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ",\n".join(sql) + "\nSELECT e.vec_id, code, error, label_error, codebooks_sha256 FROM e JOIN v USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM v.label, h"


QUERIES = {
    "op1_url_filter": op1,
    "op2_token_counts": op2,
    "op3_voronoi_knn": op3,
    "op4_line_dedup": op4,
    "op5_kk_sharding": op5,
    "op6_sainte_lague_mix": op6,
    "op7_minhash": op7,
    "op8_content_sort_dedup": op8,
    "op9_kneser_ney_langid": op9,
    "op10_ffd_packing": op10,
    "op11_cross_polytope_ann": op11,
    "op12_jacobi_whitening": op12,
    "op13_exponion_codes": op13,
}

ORACLES = {
    "op13_exponion_codes": _codes_sql(),
    "op6_sainte_lague_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, CAST('0x' || substr(sha256(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), 'null'), coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM t),
r AS (SELECT *, coalesce(sum(cap) OVER x, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER x, 0) AS open FROM w WINDOW x AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - capped) / open AS level FROM r),
g AS (SELECT source, source_size, total, CAST(round(total / 16) AS BIGINT) AS house, least((SELECT level FROM l WHERE level * weight <= cap ORDER BY capped, level LIMIT 1) * weight, CAST(cap AS DOUBLE)) AS target FROM l),
a0 AS (SELECT *, house * shard // 16 AS seats, CAST(ceil(3 * source_size / 16) AS BIGINT) AS most FROM g, (SELECT unnest(range(1, 17)) AS shard)),
a1 AS (SELECT *, CAST(floor(coalesce(target * seats / nullif(16.0::DOUBLE * house, 0), 0) + 0.5) AS BIGINT) AS first FROM a0),
a2 AS (SELECT *, seats - CAST(sum(first) OVER (PARTITION BY shard) AS BIGINT) AS miss FROM a1),
a3 AS (SELECT *, CAST(ceil(abs(miss) * target / greatest(total, 1)) AS BIGINT) + 2 AS offers FROM a2),
s0 AS (SELECT shard, source, target, miss, first, most, unnest(CASE WHEN miss > 0 THEN range(first, first + offers + 1) ELSE range(greatest(first - offers, 0), greatest(first - 1, 0) + 1) END) AS seat FROM a3 WHERE miss <> 0),
s1 AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY CASE WHEN miss > 0 THEN -(target / (2 * seat + 1)) ELSE target / (2 * seat + 1) END, source NULLS LAST, seat) AS place FROM s0 WHERE (miss > 0 AND seat < most) OR (miss < 0 AND seat < first)),
m AS (SELECT shard, source, CAST(sum(sign(miss)) AS BIGINT) AS extra FROM s1 WHERE place <= abs(miss) GROUP BY shard, source),
q0 AS (SELECT a3.source, source_size, target, greatest(source_size // 16, 1) AS blocks, list(least(first + coalesce(extra, 0), most) ORDER BY a3.shard) AS upto FROM a3 LEFT JOIN m ON a3.source IS NOT DISTINCT FROM m.source AND a3.shard = m.shard GROUP BY ALL),
q AS (SELECT *, least(greatest(least(CAST(floor(target + 0.5) AS BIGINT), (upto[16] + 1) * 16 - 1), (upto[16] - 1) * 16 + 1, 0), 3 * source_size) AS words, CAST('0x' || substr(sha256(concat_ws('/', 'mix', coalesce(source, 'null'))), 1, 15) AS BIGINT) % blocks * 16 AS lo FROM q0),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM d),
j AS (SELECT p.doc_id, p.size, q.source_size, q.target, pos, lo, words, upto, list_sum([greatest(0, least(lo + words, pos + k * source_size + size) - greatest(lo, pos + k * source_size)) for k in range(0, 4)]) AS taken FROM p JOIN q ON p.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken, CASE WHEN taken > 0 THEN CAST(least(len([x for x in upto if x * 16 <= CASE WHEN pos + size > lo THEN greatest(pos, lo) ELSE pos + source_size END - lo]), 15) AS INT) END AS first_shard FROM j""",
    "op7_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT doc_id, n, hash(g) AS g FROM s JOIN n USING (doc_id)),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS i, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.i WHERE r.c < l.b),
c AS (SELECT i, min(c) AS component_id FROM r GROUP BY i)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.i = d.doc_id""",
    "op3_voronoi_knn": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_content_sort_dedup": r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256, length(coalesce(text, '')) AS len FROM documents),
r AS (SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r""",
}
