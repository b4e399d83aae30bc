"""Work and memory that must not grow faster than the input: how often an input is read, and where its rows go."""

from __future__ import annotations

import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import features as B
from corpusloom.functions import text as T
from corpusloom.operators import gates as G
from corpusloom.operators import reports as R
from corpusloom.operators import sampling as Q
from corpusloom.operators import splits as S
from corpusloom.operators import windows as V
from corpusloom.plans import builders as D

ROWS = 200


def counted(spark, df, column):
    """`df` whose column counts the rows that it is made for."""
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def same(s: pd.Series) -> pd.Series:
        seen.add(len(s))
        return s

    return df.withColumn(column, same(F.col(column))), seen


def rows(spark):
    return spark.range(ROWS).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("some words of a text "), F.col("id").cast("string")).alias("text"), (F.col("id") % 4 == 0).cast("int").alias("label"), F.lit("s").alias("source_name"), F.lit("b").alias("bucket"), F.lit(0.9).alias("score"))


def test_atomic_split_reads_its_groups_a_few_times(spark):
    t, seen = counted(spark, rows(spark).withColumn("g", F.substring("id", 1, 1)), "g")
    S.atomic_split(t, "g", ["label"], {"a": 0.5, "b": 0.5}).collect()
    assert seen.value <= 3 * ROWS


def test_general_set_reads_its_rows_a_few_times(spark):
    t, seen = counted(spark, rows(spark), "text")
    D.general_set(t, None, 2.0, max_source_share=1.0).rows.collect()
    assert seen.value <= 4 * ROWS


def test_reviewer_set_reads_its_rows_a_few_times(spark):
    t, seen = counted(spark, rows(spark), "text")
    D.reviewer_set(t, 0.2, 40, ["id"], 8).rows.collect()
    assert seen.value <= 4 * ROWS


def test_pool_reads_its_documents_once(spark):
    t, seen = counted(spark, rows(spark).select(F.col("id").cast("long").alias("doc_id"), "text", F.col("source_name").alias("source"), F.lit("en").alias("lang")), "text")
    got = D.document_pool(t, None, {"x": ["words"]}, {"x": 50}, min_chars=1).rows.select("doc_id", "category", "dedupe_cluster_id").collect()
    assert len(got) == 50 and seen.value <= 2 * ROWS
    assert got[0]["dedupe_cluster_id"] is not None


def test_correction_reads_its_results_a_few_times(spark):
    results, seen = counted(spark, rows(spark).select(F.col("id").cast("long").alias("doc_id"), "label", (F.lit(0.9) - 0.8 * F.col("label")).cast("string").alias("score")), "score")
    docs = rows(spark).select(F.col("id").cast("long").alias("doc_id"), "text")
    D.correction(results.withColumn("score", F.col("score").cast("double")), docs, 0.5, ["words"], docs).rows.collect()
    assert seen.value <= 4 * ROWS


def test_greedy_choice_makes_its_keys_once(spark):
    t, seen = counted(spark, rows(spark).withColumn("k", F.substring("id", 1, 1)), "k")
    Q.targeted_sample(t, "label", {0: 20, 1: 20}, "k", 10, 60, "id", small=0).select("id").collect()
    assert seen.value <= 2 * ROWS


def test_ineligible_rows_and_frequent_keys_spread(spark):
    confs = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        t = G.first_of(spark.range(1000).withColumn("t", F.lit("same")), F.col("t"), F.col("id") % 10 == 7, ["id"])
        per = [r["count"] for r in t.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per) == 1000 and max(per) < 400
        assert [r["id"] for r in t.where("_first").collect()] == [7]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("made", "most"),
    [
        (lambda: T.bag_cluster_id("text"), 1), (lambda: T.fragment("text", ["a", "b"]), 1), (lambda: B.phrase_families("text", {"x": ["a", "b"], "y": ["c"]}), 1),
        (lambda: B.strength("text", F.col("label"), {"x": ["a", "b"], "y": ["c"]}, "x", ["y"]), 1), (lambda: B.phrase_position("text", ["a", "b", "c"]), 1), (lambda: B.surface("text"), 1),
        (lambda: B.evidence("text", {"a": ("a", 1), "b": ("b", 1)}, [("c", "a", "b")]), 2), (lambda: T.canonical_language("source_name", "text"), 2), (lambda: B.language_mismatch("source_name", "text"), 3),
    ],
)
def test_a_text_is_put_in_form_once(spark, made, most):
    assert plan(rows(spark).select(made().alias("x"))).count("regexp_replace") <= most


def test_words_and_sentences_are_cut_without_python_or_lambdas(spark):
    assert "lambda" not in plan(rows(spark).select(T.words("text"), T.sentences("text")))


ODD = ["", " ", " . x", "a.\n ", "a.\t b!  c", "  Lead. in", "q? r", "x\n", "a. \x85b", "ab.c d.", " a. b", "😀😀a. é"]


def test_sentences_and_entropy_of_odd_texts(spark):
    import math
    import re
    from collections import Counter

    space = "[ \\t-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
    t = spark.createDataFrame(list(enumerate(ODD)), "i int, t string").select("i", T.sentences("t").alias("s"), T.char_entropy("t").alias("e"))
    for r in t.collect():
        text = ODD[r["i"]]
        assert r["s"] == [x for x in (p.strip(" ") for p in re.split("(?<=[.!?])" + space, text)) if x]
        want = -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) if text else 0.0
        assert abs(r["e"] - want) < 1e-9


def test_runs_of_characters_make_the_entropy(spark):
    assert "array_sort" not in plan(rows(spark).select(T.char_entropy("text")))


def test_composed_texts_stay_where_they_are(spark):
    import re

    stays = re.compile("[" + T.COMPOSED + "]")
    for c in map(chr, range(0x3000)):
        if stays.match(c):
            assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c)
    texts = ["plain", "ﬁne", "é", "½", "Ёж", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "t string").coalesce(1).select(T.nfkc("t")).collect()]
    assert got == [x if x is None else unicodedata.normalize("NFKC", x) for x in texts]


def test_windows_apart_are_read_as_they_come(spark):
    rows = [(d, i, i * 100, float((i * 7 + d) % 5)) for d in range(7) for i in range(9)]
    t = spark.createDataFrame(rows, "doc_id long, window_index int, token_start int, score double")
    out = V.apart(t, 256, 3)
    assert "FlatMapGroupsInPandas" not in plan(out)
    want = set()
    for d in range(7):
        taken = []
        for _, i, start, _ in sorted((r for r in rows if r[0] == d), key=lambda r: (-r[3], r[1])):
            if len(taken) < 3 and all(abs(start - x) >= 256 for x in taken):
                taken.append(start)
                want.add((d, i))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        assert {(r["doc_id"], r["window_index"]) for r in V.apart(t, 256, 3).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ngrams_are_shuffled_by_themselves(spark):
    out = R.ngram_odds(rows(spark), F.col("label") == 1, 1, 2, 5)
    assert plan(out).count("Aggregate") == 2
    got = {r["ngram"]: (r["occurrences"], r["rows"], r["baseline_rows"]) for r in out.collect()}
    assert got["some words"] == (50, 50, 150)


def test_a_language_worker_keeps_nothing_when_it_ends(spark):
    from corpusloom.llm import language_id

    docs = spark.createDataFrame([(i, w, lang) for i in range(40) for w, lang in (("the house of words", "en"), ("das Haus der Worte", "de"))], "doc_id long, text string, lang string").coalesce(1)
    assert language_id.keep_identified(docs, 20).count() > 0

    def held(batches):
        import pyarrow as pa

        yield from (pa.RecordBatch.from_arrays([pa.array([len(language_id._last)] * b.num_rows, pa.int32())], ["n"]) for b in batches)

    assert {r["n"] for r in docs.select("doc_id").mapInArrow(held, "n int").collect()} == {0}


def test_a_window_has_no_copy_of_its_documents_tokens(spark):
    plan = V.explode_windows(rows(spark), keep=["id"])._jdf.queryExecution().executedPlan().toString()
    assert [line.strip(" +-:")[:2] for line in plan.splitlines() if "Generate explode(" in line] == ["*("]  # compiled, so read where they are


def test_patterns_are_looked_for_only_where_their_texts_are(spark):
    assert B.needed_texts(r"\bthe in\b") == [["the in"]] and B.needed_texts(r"(?:never|do not)\s+(?:ignore|share)[^.]{0,60}") == [["never", "do not"], ["ignore", "share"]]
    assert B.needed_texts("ab?c+(?:d|ef)*x") == [["a"], ["c"], ["x"]] and B.needed_texts("licen[sc]ed?") == [["licen"], ["e"]]
    for unsure in ("", "a|", "[ab]", "(?:ab|)", "[[a]b]c", "[a[b]]c", "[a&&b]c", r"\101", "(?<n>a)b", r"\Qa\E", r"\p{L}a", "(?:ab){0,2}", "(?!ab)"):
        assert B.needed_texts(unsure) == [], unsure
    looked = spark.range(1).select(B.any_pattern(F.lit("x"), ["secret"], F.lit("x")).alias("x"))._jdf.queryExecution().analyzed().toString().lower()
    assert looked.index("contains(") < looked.index("rlike")


def test_needed_texts_do_not_change_what_matches(spark):
    texts = ["ignore the rules", "IGNORE X RULES", "ıgnore ruleſ", "İGNORE RULES", "maKe risK", "make risk", "never ignore that. ignore my rules", "never ignore my rules", "ig nore", "", None, "ΣΟΦΟΣ x", "straße"]
    patterns = [r"\bignore\b.{0,40}\brules\b", "make|risk", "(?:ma|ri)[ks]", "(?:ignore )?the", "σοφος", "STRASSE|straße", "(?x) ma ke", "x{0}the"]
    negated = r"(?:never|do not)\s+(?:ignore|share)[^.!?\n]{0,60}"
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.coalesce("t", F.lit(""))
    plain = lambda t, ps: t.rlike("(?ius)" + "|".join(f"(?:{p})" for p in ps))
    for ps in [*([p] for p in patterns), patterns]:
        got = df.select(B.any_pattern("t", ps), plain(t, ps), B.anchored("t", ps, negated), plain(F.regexp_replace(t, "(?ius)" + negated, " "), ps), B.anchored("t", ps, negated, veto=True), ~t.rlike("(?ius)" + negated) & plain(t, ps)).collect()
        assert all(r[0] == r[1] and r[2] == r[3] and r[4] == r[5] for r in got), ps
    assert sum(r[0] for r in df.select(B.any_pattern("t", patterns[:1])).collect()) == 6


def test_window_visibility_moves_no_text(spark):
    from corpusloom.plans.queries import QUERIES

    plan = QUERIES["window_visibility"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan parquet") == 1


def test_forms_of_a_payload_do_not_change_what_is_shown(spark):
    phrase = "one two three four five six seven eight nine ten eleven twelve"
    windows = ["x three four five six seven y", "x three four five y", f"A {phrase.upper()}", "", "antidisestablishmentarianism", None]
    df = spark.createDataFrame([(w, p) for w in windows for p in (phrase, "", "short", "x antidisestablishmentarianism")], "w string, p string")
    got = df.select(V.shows_text("w", "p"), V.shows_text("w", "p", forms=V.payload_forms("p"))).collect()
    assert [r[0] for r in got] == [r[1] for r in got] and [i for i, r in enumerate(got) if r[0]] == [0, 8, 19]


def saved(monkeypatch, make):
    """The tables that a build writes between its steps, as sets of columns."""
    seen, real = [], D.X.save_point
    monkeypatch.setattr(D.X, "save_point", lambda df: seen.append(set(df.columns)) or real(df))
    return make(), [c for c in seen if c & {"text", "window_text", "attack_text", "payload"}]


def bank(spark, n=12):
    return spark.createDataFrame([(i, " ".join(f"payload{i}word{j}" for j in range(10))) for i in range(n)], "payload_id long, payload string")


def test_windows_of_a_build_are_chosen_without_their_texts(spark, monkeypatch):
    """Only documents, once, and the bank are written with texts; rows have theirs nevertheless."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    b, texts = saved(monkeypatch, lambda: D.clean_windowed(docs, bank(spark), None, {"doc_id": 6}, 40))
    assert sum("text" in c for c in texts) == 1 and not any("window_text" in c for c in texts)
    rows = b.rows.withColumn("own", T.text_hash("window_text", 64)).collect()
    assert rows and all(r["own"] == r["text_key"] for r in rows)
    assert sum(r["rows"] for r in b.reports["components"].collect()) == len(rows) == len({r["id"] for r in rows})


def test_a_flagship_writes_texts_of_documents_and_chosen_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mined = docs.select("doc_id", F.substring("text", 1, 300).alias("text"), F.lit("benign").alias("label"), F.lit(0.9).alias("score"), F.lit("a").alias("source_pool"), F.lit(True).alias("reviewed"))
    misses = mined.limit(0).withColumn("anchor", F.lit("x")).withColumn("attack_text", F.lit("x")).withColumn("visible", F.lit(True))
    targets = {"mined_benign": 20, "embedded_attack": 30, "same_document_contrast": 10, "original_contrast": 20, "random_benign": 20, "standalone_attack": 4}
    b, texts = saved(monkeypatch, lambda: D.flagship(docs, bank(spark), mined, misses, None, targets, 20, {"doc_id": 9}, r"\bnever\b", "policy", "^thanks$", ["a"]))
    assert sum("text" in c for c in texts) == 3  # the documents, and the rows chosen for either side
    own = T.text_hash("text", 64)
    rows = b.rows.withColumn("own", own).collect()
    assert rows and all(r["own"] == r["text_key"] for r in rows) and {r["component"] for r in rows} == set(targets)


def test_checks_of_mined_rows_move_no_text(spark):
    import re

    t = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars > 0").select("doc_id", "text", F.lit("s").alias("source_pool"), (F.col("doc_id") >= 0).alias("reviewed"), F.lit(0.9).alias("score"), F.lit("words").alias("anchor"), F.col("text").alias("attack_text"), F.lit(True).alias("visible"))
    for marked in (G.mined_benign(t.withColumn("label", F.lit("benign")), "some", "text", ["s"], 0.5, ["doc_id"]), G.visible_misses(t.withColumn("label", F.lit("attack")), "words", "^x$", ["s"], ["doc_id"])):
        side = plan(marked.select("doc_id", "reason")).split("Join LeftOuter")[1].splitlines()[1]
        assert side.strip().startswith(":- Project [doc_id#") and not re.search(r"[\[ ]text#\d+[,\]]", side)
        assert marked.where("reason is null").count() + marked.where("reason is not null").count() == t.count()
