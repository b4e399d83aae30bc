import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from corpusloom.llm import knn_join, language_id, line_dedup, near_dedup, token_counts, url_filter
from corpusloom.llm.queries import RULES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Word"), (4, "Word"), (5, "word"), (6, "w " * 60_000), (None, "word"), (7, "日本 \x00 x"), (8, "123 456")]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).withColumn("h", F.lit(1)).withColumn("key", F.lit("k")).withColumn("id", F.lit(0))


def word_sets(rows, k):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        out[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    return out


def brute_components(sets, percent=80):
    ids = sorted(i for i in sets if sets[i])
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                u, v = sorted((top(a), top(b)))
                root[v] = u
    return {i: top(i) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_all_pairs(docs, k):
    sets = word_sets([(r.doc_id, r.text) for r in docs.collect()], k)
    want = brute_components(sets)
    got = near_dedup.near_duplicates(docs, k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


@pytest.mark.parametrize("block", [3, near_dedup.BLOCK])
def test_near_duplicates_chains_and_bridges(spark, block):
    """Families of gradual variants: links that only run through members, never through the smallest; buckets in one or
    many blocks."""
    rng, rows = random.Random(3), []
    for family in range(12):
        words = [f"f{family}w{rng.randrange(10**6)}" for _ in range(120)]
        for step in range(8):
            rows.append((len(rows) * 7 % 997, " ".join(words)))
            for _ in range(rng.choice([1, 3, 6])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(word_sets(rows, 2))
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 2, block=block).collect()} == want


def test_near_duplicates_odd_rows(odd, none):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(odd, 2).collect())
    assert got == [(0, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (8, 1, 8, True)]
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.drop_near_copies(odd).columns == odd.columns


def test_star_contraction(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in root.items() if n != c}


def test_language_id_on_held_out_documents(spark, none, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    known = [r for r in rows if r.lang_pred != "und"]
    assert len(rows) > 250 and sum(r.lang == r.lang_pred for r in known) > 0.97 * len(known)
    assert sum(r.rejected for r in known) < 0.02 * len(known) and all(0 <= r.score <= 1 for r in rows)
    assert language_id.languages(none).count() == 0 and {r.lang_pred for r in language_id.languages(odd).collect()} == {"und"}
    assert language_id.keep_identified(docs).columns == docs.columns and language_id.keep_identified(odd).count() == 0


def test_rejection_is_calibrated_on_held_out_documents(spark):
    """Noise is rejected; of clean documents that nothing was learned from, none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models, limits = language_id.learn(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    clean = language_id.identify(docs.where(language_id.held_out()), models, limits).where("lang_pred <> 'und'")
    assert clean.where("rejected").count() <= 0.005 * clean.count()
    rng = random.Random(2)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(60)) for _ in range(20)] + ["これは日本語の文章です", "Это русский текст для проверки"]
    odd = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    assert language_id.identify(odd, models, limits).where("rejected").count() == len(noise)
    others = ["Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti", "Todos os seres humanos nascem livres e iguais em dignidade e em direitos", "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw", "Bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar"]
    shuffled = ["".join(rng.sample(letters, len(letters))) for r in docs.where("length(text) > 200").limit(40).collect() for letters in ["".join(r.text.split()[:40])]]
    planted = spark.createDataFrame(list(enumerate(others + shuffled)), "doc_id long, text string")
    assert language_id.identify(planted, models, limits).where("not rejected").count() <= 1
    import pandas as pd

    seen = pd.DataFrame({"lang": ["a"] * 101 + ["b"], "h": [*np.linspace(1, 2, 101), 4.0]})
    got = language_id.limits_of(seen, ["a", "b", "c"])
    assert got["b"] - got["a"] == 2.5 and got["c"] == got["b"] and language_id.limits_of(seen[:0], ["a"]) == {"a": math.inf}


def test_kneser_ney_sums_to_one():
    words = {"a": {"banana": 3, "bandana": 1, "nab": 2}, "b": {"xyz": 1}}
    models = language_id.Models({k: language_id.Counter(v) for k, v in words.items()}, 3)
    alphabet = sorted(set("".join(w for v in words.values() for w in v)))
    # over the known letters, the closing edge and one unknown letter
    for prefix in ("", "ba", "na", "q"):
        assert math.isclose(sum(prob(models, prefix + c, len(prefix)) for c in [*alphabet, "", "ß"]), 1.0, abs_tol=1e-9)


def plain_kneser_ney(words, order, letters, word):
    """Nats of a word, from dictionaries of strings alone."""
    edge = language_id._EDGE
    padded = {edge * (order - 1) + w + edge: n for w, n in words.items()}
    levels = [None] * order
    levels[-1] = Counter()
    for p, times in padded.items():
        for e in range(order - 1, len(p)):
            levels[-1][p[e - order + 1 : e + 1]] += times
    for n in range(order - 1):  # n-grams of n + 1 characters: by how many characters they are preceded
        levels[n] = Counter(g[1:] for g in {p[e - n - 1 : e + 1] for p in padded for e in range(order - 1, len(p))})
    tested, cost = edge * (order - 1) + word + edge, 0.0
    for e in range(order - 1, len(tested)):
        p = 1.0 / letters
        for n, level in enumerate(levels):
            once, twice = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            gram = tested[e - n : e + 1]
            inside = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
            if inside:
                total = sum(inside.values())
                p = (inside.get(gram, discount) - discount) / total + discount * len(inside) / total * p
        cost -= math.log(p)
    return cost


def test_kneser_ney_against_plain_counts():
    rng = random.Random(4)
    words = {lang: Counter("".join(rng.choice(a) for _ in range(rng.randrange(1, 7))) for _ in range(150)) for lang, a in (("a", "abcde"), ("b", "cdefgé"))}
    models = language_id.Models(words, 3)
    tested = ["abc", "cdé", "zz", "eeeee", *list(words["a"])[:10]]
    cost, n = models.costs(tested)
    for i, w in enumerate(tested):
        assert n[i] == len(w) + 1
        for c, lang in enumerate(models.langs):
            assert math.isclose(cost[i, c], plain_kneser_ney(words[lang], 3, models.letters, w), rel_tol=1e-9)


def prob(models, word, at):
    """P of the character (or closing edge) at place `at` in language a."""
    grams, _ = language_id.gram_hashes([word], models.order)
    contexts = language_id.context_hashes([word], models.order)
    p = 1.0 / models.letters
    for n in range(models.order):
        known, row = models.backoff[n].find(contexts[n][at : at + 1])
        gamma = models.backoff[n].values[row[0], 0] if known[0] else 1.0
        hit, row = models.grams[n].find(grams[n][at : at + 1])
        p = (models.grams[n].values[row[0], 0] if hit[0] else 0.0) + gamma * p
    return p


@pytest.mark.parametrize("fallback", [True, False])
def test_token_counts_against_the_tokenizer(docs, fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    judge = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
    judge.pre_tokenizer = pre_tokenizers.Metaspace()
    judge.encode_special_tokens = True
    counter = token_counts.Counter(vocabulary, fallback)
    texts = [r.text for r in docs.collect()] + ["日本語 テスト 漢", "a  b", "x\x00y", "🙂🙂 z", "aaaaaaa", "\n\nnew"]
    assert [counter.text(t)[0] for t in texts] == [len(judge.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_ties_and_rows(odd, none):
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("ab", -3.0), ("b", -1.0), ("bc", -2.0), ("c", -1.0), ("abc", -4.0)]
    assert token_counts.Counter(vocabulary).best("abc")[1] == -4.0 and token_counts.Counter(vocabulary).best("abc")[0] == 1
    got = {(r.doc_id, r.n_tokens) for r in token_counts.count_tokens(odd, vocabulary).collect()}
    assert (1, None) in got and (2, 0) in got and len(got) == 9
    assert token_counts.count_tokens(none, vocabulary).count() == 0


def test_urls(spark):
    urls = [
        (1, "HTTP://A.Example.NET/en/x?q=1#f"), (2, "https://example.net"), (3, "http://x.net/a"), (4, "http://netx/a"), (5, "ftp://example.com/de/"), (6, "http://e.org/fr/a?b"),
        (7, None), (8, "no scheme"), (9, "a://b://c/d"), (10, "http://x.org?y=/fr/"), (11, ""), (11, ""), (12, "http://a.b.org/fr"), (13, "http://net/"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("rule", F.lit("x"))
    labelled = spark.createDataFrame([(f"http://good{i}.org/a/{i}", 0) for i in range(40)] + [(f"http://x-spam-{i}{i}.biz/?a={i}&b=2", 1) for i in range(40)], "url string, blocked int")
    model = url_filter.fit(labelled)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, RULES, model).collect()}
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2][:3] == ("example.net", "", None)
    assert got[3][2:] == ("net/", "block") and got[4][:3] == ("netx", "/a", None) and got[5][2:] == ("example.com/de/", "block")
    assert got[6] == ("e.org", "/fr/a", "org/fr/", "allow") and got[7][:3] == ("", "", None) and got[8][:3] == ("", "", None)
    assert got[9][:2] == ("b:", "//c/d") and got[10][:3] == ("x.org", "", None) and got[12][2] is None and got[13][2:] == ("net/", "block")
    test = spark.createDataFrame([(1, "http://fine.org/a/7"), (2, "http://y-spam-9.biz/?a=1&b=2")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(test, [], model).orderBy("page_id").collect()] == ["allow", "block"]
    assert url_filter.filter_urls(pages.limit(0), RULES, url_filter.fit(labelled.limit(0))).count() == 0


def test_hosts_are_judged_by_trees_that_did_not_see_them(spark):
    """Held-out ranking of labelled hosts on the pages table, and no host in both a fold and its model's sample."""
    from corpusloom.llm.queries import BAD_HOST_WORDS

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    labelled = url_filter.weak_labels(pages, RULES, BAD_HOST_WORDS)
    judged = url_filter.filter_urls(pages, RULES, url_filter.cross_fit(labelled)).where("rule is null")
    labels = pages.join(labelled.distinct(), "url").select("page_id", F.col("blocked").alias("y"))
    rows = judged.join(labels, "page_id").select("y", "probability", "verdict").toPandas()
    print("held-out AUC", (rows["probability"].rank()[rows["y"] == 1].sum() - (rows["y"] == 1).sum() * ((rows["y"] == 1).sum() + 1) / 2) / ((rows["y"] == 1).sum() * (rows["y"] == 0).sum()))
    auc = rows["probability"].rank()[rows["y"] == 1].sum() - (n := (rows["y"] == 1).sum()) * (n + 1) / 2
    assert n > 50 and auc / (n * (len(rows) - n)) > 0.9
    assert (rows["verdict"] == "allow")[rows["y"] == 0].mean() > 0.97
    url = lambda h: F.lit(f"http://{h}/")
    folds = spark.range(1).select(*(url_filter.fold_of(url_filter.url_parts(url(h))[0]) for h in ("www.somewhere.net", "m.somewhere.net"))).first()
    assert folds[0] == folds[1]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = url_filter.Trees().fit(x[:1500], y[:1500])
    assert ((trees.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 3])).tolist()) for i in range(1500)]
    vectors += [(5000, vectors[0][1]), (5100, vectors[0][1]), (6000, None), (6001, [1.0] * 7 + [None]), (6100, [1.0] * 7 + [float("nan")]), (None, [1.0] * 8), (6200, [1.0] * 3)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("cell", F.lit(2))
    got = sorted(tuple(r) for r in knn_join.top_products(df).collect())
    q = {i: np.floor(1024 * np.array(v, np.float32).astype(float)) for i, v in vectors[:1502]}
    want = []
    for i in q:
        if i % 100 == 0:
            s = sorted((-int(q[i] @ v), j) for j, v in q.items() if j != i)[:10]
            want += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    assert got == sorted(want)
    assert knn_join.top_products(df.limit(0)).count() == 0


def brute_products(vectors, k=10):
    rows = [(i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]) for i, v in vectors]
    out = []
    for i, q in {i: min((np.array(v, "<i4").tobytes(), v) for j, v in rows if j == i)[1] if max(map(abs, dict(rows)[i])) < 2**31 else dict(rows)[i] for i, _ in rows if i % 100 == 0}.items():
        s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, max(1 - 2**63, min(2**63 - 1, -x))) for r, (x, j) in enumerate(s)]
    return sorted(out)


def test_knn_of_mixed_lengths_and_empty_vectors(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.normal(size=3 + i % 3).tolist()) for i in range(700)] + [(10_000 + i, []) for i in range(1500)]
    got = sorted(tuple(r) for r in knn_join.top_products(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect())
    assert got == brute_products([v for v in vectors if v[1]])


@pytest.mark.parametrize("top", [3e6, 1e9, 3e30])
def test_knn_of_large_components(spark, top):
    """Products beyond 2^53 are exact, and beyond a long held at its end."""
    rng = np.random.default_rng(7)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * rng.choice([1, 1, top])]) for i in range(400)]
    vectors += [(2000 + i, v) for i, v in vectors[:30]]
    got = sorted(tuple(r) for r in knn_join.top_products(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect())
    assert got == brute_products(vectors)


def test_knn_against_few_others(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in (0, 1, 2)], "vec_id long, embedding array<float>")
    assert knn_join.top_products(df).count() == 2


def test_knn_bounds_ignore_repeated_rows_of_the_query(spark):
    """Twelve rows with the query's id, all on a pivot, are no neighbours and bound nothing."""
    rng = np.random.default_rng(4)
    units = rng.normal(size=(1001, 8))
    units /= np.linalg.norm(units, axis=1)[:, None]
    own = [float(x) for x in 2 * units[0]]
    ids = spark.createDataFrame([(100 * i, own) for i in range(1, 3000)], "vec_id long, embedding array<float>")
    query = knn_join.quantised(ids, "vec_id", "embedding", 1024).orderBy(F.xxhash64("id", "q")).first()["id"]  # among the pivots
    vectors = [(query, own)] * 12 + [(100 * i + 1, units[i].tolist()) for i in range(1, 1001)]
    got = sorted(tuple(r) for r in knn_join.top_products(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect())
    q = {i: np.floor(1024 * np.array(v, np.float32).astype(float)) for i, v in vectors}
    best = sorted((-int(q[query] @ v), i) for i, v in q.items() if i != query)[:10]
    assert got == [(query, r + 1, i, -x) for r, (x, i) in enumerate(best)]


def test_patience_and_blocks():
    assert line_dedup.patience([(0, 5), (1, 0), (2, 1), (3, 2), (4, 9)]) == [(1, 0), (2, 1), (3, 2), (4, 9)]
    assert line_dedup.patience([]) == []


def lines_of(*names):
    return "\n".join(" ".join(f"{n}{i}" for i in range(6)) for n in names)


def test_line_dedup_deletes_aligned_blocks(spark, odd, none):
    rows = [
        (1, lines_of("a", "b", "c", "d") + "\n\n" + lines_of("d", "e")), (2, lines_of("x", "b", "c", "y")), (3, lines_of("c", "z", "b")), (4, lines_of("a", "b", "c", "d") + "\n\n" + lines_of("d", "e")),
        (5, "short\nline"), (6, "short\nline"), (7, lines_of("x", "y")), (8, None), (9, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(3)).withColumn("place", F.lit(3))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1].removed_lines == 0 and got[2].text == lines_of("x", "y") and got[3].removed_lines == 0  # six words alone are under ten
    assert got[4].removed_lines == 7 and got[4].text == "" and got[5].removed_lines == got[6].removed_lines == 0
    assert got[7].text == lines_of("x", "y") and got[8].text is None and got[9].text == "" and got[9].n_lines == 1
    assert line_dedup.dedup_lines(odd).count() == odd.count() and line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_finds_shared_passages(docs):
    """Whatever it deletes stands in an earlier document."""
    before = {r.doc_id: r.text for r in docs.collect()}
    first = defaultdict(lambda: 10**9)
    for i, t in before.items():
        for line in t.split("\n"):
            key = " ".join(line.split())
            first[key] = min(first[key], i)
    for r in line_dedup.dedup_lines(docs).collect():
        lines = before[r.doc_id].split("\n")
        gone = [lines[i] for s in r.spans for i in range(s.start, s.stop)]
        assert len(gone) == r.removed_lines and all(first[" ".join(x.split())] < r.doc_id or not x.split() for x in gone)


def test_line_dedup_deletes_copies_whose_lines_stand_first_elsewhere(spark):
    """A copy goes whole though each of its lines has its first occurrence in a document of its own."""
    names = [f"n{i}" for i in range(12)]
    rows = [(i, lines_of(n, f"own{i}")) for i, n in enumerate(names)] + [(50, lines_of(*names)), (60, lines_of(*names)), (61, lines_of("p", *names[3:9], "q"))]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].removed_lines == 0 for i in (*range(12), 50))
    assert got[60].text == "" and got[60].removed_lines == 12 and got[61].text == lines_of("p", "q")


def brute_shared_lines(texts, min_words):
    """Per document the places in runs of equal lines, at least `min_words` words, that an earlier document holds too."""
    lines = {i: [" ".join(x.split()) for x in t.split("\n")] for i, t in texts.items()}
    out = {i: set() for i in texts}
    for i, a in lines.items():
        for b in (lines[j] for j in texts if j < i):
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                        n += 1
                        if a[x] and a[x + n - 1] and sum(len(w.split()) for w in a[x : x + n]) >= min_words:
                            out[i] |= set(range(x, x + n))
    return out


@pytest.mark.parametrize("segment", [3, 256])
@pytest.mark.parametrize("rare", [0, 4])
def test_line_dedup_equals_brute_force(spark, segment, rare):
    """Also where documents have several segments, no line counts as rare, and runs go over partition borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    pool = ["", "", "a", "b b", "c c c c", "d " * 9, "e " * 10, "f " * 14]
    texts = {i: "\n".join(rng.choice(pool) for _ in range(rng.randrange(14))) for i in range(60)}
    want = brute_shared_lines(texts, 10)
    got = line_dedup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), segment=segment, rare=rare).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.doc_id: {i for s in r.spans for i in range(s.start, s.stop)} for r in got} == want and sum(map(len, want.values())) > 100


def test_line_dedup_links_repeated_passages(spark):
    """A passage goes from later documents though the first one, or the later one itself, has it twice or each line is repeated."""
    passage = "\n".join(" ".join(f"{n}{i}" for i in range(10)) for n in "abcde")
    hum = "la la la la\n\nla la la la\n\nla la la la"
    rows = [(1, f"{passage}\none\n{passage}"), (2, f"two\n{passage}\nthree"), (3, f"{passage}\nfour\n{passage}"), (4, f"five\n{hum}"), (5, f"{hum}\nsix"), (6, f"{passage}\n\n{passage}")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].removed_lines == got[4].removed_lines == 0
    assert [got[i].text for i in (2, 3, 5, 6)] == ["two\nthree", "four", "six", ""]


def test_line_dedup_equals_brute_force_on_the_table(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: {i for s in r.spans for i in range(s.start, s.stop)} for r in got} == brute_shared_lines(texts, 10)


def test_line_dedup_partners_and_rows_of_one_id(spark):
    """Lines that stand first in two documents, and together in a third; rows with one id are told apart by text."""
    rows = [(1, lines_of("x", "p")), (2, lines_of("q", "y")), (3, lines_of("x", "y")), (4, lines_of("u", "x", "y", "v"))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(rows), 4: lines_of("u", "v")}
    same = [(5, lines_of("a", "b", "c", "d")), (5, lines_of("e", "f", "g", "h")), (5, lines_of("e", "f", "g", "h")), (4, lines_of("a", "b"))]
    got = sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(same, "doc_id long, text string")).collect())
    assert got == sorted([(4, lines_of("a", "b")), (5, lines_of("c", "d")), (5, lines_of("e", "f", "g", "h")), (5, lines_of("e", "f", "g", "h"))])


def test_patience_diff_anchors_grow_and_recur():
    a, b = list("abcxdefy"), list("abczdefw")
    far = [1] * 8
    assert sorted(line_dedup.patience_diff(a, b, far, far)) == [(0, 0, 3), (4, 4, 3)]
    a, b = list("rruss"), list("qruts")  # r stands twice in a: it joins the block of u
    assert sorted(line_dedup.patience_diff(a, b, [1] * 5, [1] * 5)) == [(1, 1, 2)]


def test_line_dedup_reads_invalid_bytes(spark):
    df = spark.sql("select 1L doc_id, cast(unhex('61FF62') as string) text union all select 2L, 'x'")
    assert line_dedup.dedup_lines(df).count() == 2


def side_of(text, min_words=10):
    parts = list(line_dedup.segments(b"", text, min_words, 10**6))
    return line_dedup.unpacked(*parts[0][1:4]) if parts else None


def random_pair(rng):
    """Two texts of blocks that both hold, in any order, of lines that stand once or again and again."""
    pool = ["", "a", "b b", "c " * 5, "d " * 11]
    blocks = [[rng.choice(pool) if rng.random() < 0.4 else f"u{rng.randrange(10**6)} " * rng.randrange(1, 8) for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 6))]
    texts = []
    for _ in range(2):
        some = rng.sample(blocks, rng.randrange(1, len(blocks) + 1)) + [[f"own{rng.randrange(10**6)}"] for _ in range(rng.randrange(4))]
        rng.shuffle(some)
        texts.append("\n".join(x for b in some for x in b))
    return texts


def spans_of(texts):
    a, b = side_of(texts[1]), side_of(texts[0])
    return {i for s in line_dedup.common_spans(a, b, 10) for i in range(*s)} if a and b else set()


def test_alignment_equals_brute_force_and_decides(monkeypatch):
    """Whole pairs against brute force; without the diff most blocks stay."""
    rng = random.Random(12)
    pairs = [random_pair(rng) for _ in range(1500)]
    want = [brute_shared_lines(dict(enumerate(p)), 10)[1] for p in pairs]
    assert [spans_of(p) for p in pairs] == want and sum(map(bool, want)) > 500
    monkeypatch.setattr(line_dedup, "patience_diff", lambda *_: [])
    assert sum(spans_of(p) != w for p, w in zip(pairs, want, strict=True)) > 300


def test_rare_lines_choose_the_partners(spark):
    """A run with a rare line pairs documents by that line only: no run of it is chained."""
    rows = [(1, lines_of("a", "b")), (2, lines_of("c")), (3, lines_of("x", "a", "b", "y"))] + [(10 + i, lines_of("f", "g") + f"\nown{i}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[3] == lines_of("x", "y") and got[10] == rows[3][1] and got[17] == "own7"
    often = {line_dedup.line_hash(d) for d in side_of(lines_of("f", "g"))[2]}
    assert line_dedup.frequent_runs(*side_of(lines_of("f", "g")), often, 10, 256) and not line_dedup.frequent_runs(*side_of(lines_of("a", "b")), often, 10, 256)
