"""Windows, joins, splits, selection, metrics, gates, sources, sinks and streams."""

import hashlib
import json
import math
import random

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from corpusloom.functions.text import random_key
from corpusloom.operators import dedupe as N
from corpusloom.operators import gates as G
from corpusloom.operators import identity as X
from corpusloom.operators import joins as J
from corpusloom.operators import metrics as A
from corpusloom.operators import ordering as O
from corpusloom.operators import reports as R
from corpusloom.operators import sampling as Q
from corpusloom.operators import splits as S
from corpusloom.operators import windows as V
from corpusloom.sources import readers, sinks
from corpusloom.streaming import streams

SF = "/root/testdata/sf0.001"


def spans(n, length=254, stride=128, clamped=False):
    out, start = [], 0
    while n and start < n:
        at = min(start, max(n - length, 0)) if clamped else start
        out.append((at, min(at + length, n)))
        if start + length >= n:
            break
        start += stride
    return out


@pytest.mark.parametrize("clamped", [False, True])
def test_window_arithmetic(spark, clamped):
    sizes = [0, 1, 253, 254, 255, 382, 383, 510, 511, 1000]
    df = spark.createDataFrame([(n, " ".join(["w"] * n)) for n in sizes], "doc_id long, text string")
    got = {n: [] for n in sizes}
    for r in V.explode_windows(df, tail="clamped" if clamped else "short").orderBy("doc_id", "window_index").collect():
        got[r.doc_id].append((r.token_start, r.token_end))
        assert r.window_count == len(spans(r.doc_id)) and len(r.window_text.split()) == r.token_end - r.token_start
    assert got == {n: spans(n, clamped=clamped) for n in sizes}
    assert [r[0] for r in spark.createDataFrame([(0,), (254,), (255,)], "n int").select(V.window_count("n", empty=1)).collect()] == [1, 1, 2]


def test_best_window_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(1, 0, 0.5), (1, 2, 0.9), (1, 1, 0.9), (2, 0, 0.0)], "doc_id long, window_index int, score double")
    assert sorted((r.doc_id, r.best_window_index, r.best_score, r.window_count) for r in V.best_window(df).collect()) == [(1, 1, 0.9, 3), (2, 0, 0.0, 1)]


def test_structured_indices(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (50,)], "n int").select(V.structured_indices("n", 7)).collect()
    assert rows[0][0] == [] and rows[1][0] == [0] and rows[2][0] == [0, 1, 2] and len(rows[3][0]) == 7 and set(rows[3][0]) <= {0, 49, 25, 12, 37, 10, 20, 30, 40}
    wide = spark.createDataFrame([(5,), (8,), (50,)], "n int").select(V.structured_indices("n", 12), V.structured_indices("n", 2, random_only=True), V.structured_indices("n", 40, thirds=True)).collect()
    assert wide[0][0] == [0, 1, 2, 3, 4] and wide[1][0] == list(range(8)) and {0, 10, 12, 20, 25, 30, 37, 40, 49} <= set(wide[2][0]) and len(wide[2][0]) == 12
    assert len(wide[2][1]) == 2 and {16, 33} <= set(wide[2][2]) and len(wide[2][2]) == 40


def test_visibility(spark):
    """Only what the text shows counts; a short payload must be there whole."""
    phrase = " ".join(f"token{i:02}" for i in range(20))
    rows = [
        (0, 20, phrase, phrase, "none"), (20, 20, f"x {phrase.upper()}  y", phrase, "full"), (17, 20, phrase[24:], phrase, "full"), (17, 20, "hidden", phrase, "partial_ambiguous"), (10, 20, phrase[:80], phrase, "partial_material"),
        (10, 20, "token00 token05 token10", phrase, "partial_ambiguous"), (7, 20, phrase[:56], phrase, "partial_ambiguous"), (4, 6, "a bb ccc dddd", "a bb ccc dddd eeeee ffffff", "partial_ambiguous"), (3, 0, "x", "", "none"),
    ]
    df = spark.createDataFrame(rows, "s int, t int, w string, p string, want string")
    got = df.select(V.visibility(F.col("s"), F.col("t"), F.col("w"), F.col("p")), "want").collect()
    assert [r[0].visibility for r in got] == [r.want for r in got] and got[2][0].ratio == 0.85
    assert df.limit(1).select(V.shows_text(F.lit("the KEY word"), F.lit("any key here"), 24, ["key"])).first()[0]
    df = spark.createDataFrame([("a b c d e f", "x a b c d y"), ("a b c", "a b d"), ("q", ""), ("foo bar baz", "bar baz"), ("say one, two three four", "zzz two three four it one"), ("x " + "ab" * 20, "ab " * 40), ("say two three four five", "zz two three four five yy")], "w string, p string")
    assert [r[0] for r in df.select(V.fragment_visible("w", "p")).collect()] == [False, False, False, True, False, True, True]
    assert [r[0] for r in df.select(V.lexical_overlap("w", "p")).collect()] == [4 / 6, 2 / 3, 0.0, 1.0, 4 / 6, 0.0, 4 / 6]


def test_injection_makes_matched_contrast(spark):
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{j}" for j in range(600))) for i in range(6)], "doc_id long, text string")
    pays = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota"), (2, "one two three four five six seven eight nine")], "payload_id long, payload string")
    rows = V.inject(docs, pays).collect()
    assert {r.component for r in rows} == {"embedded_attack", "same_document_contrast", "original_contrast"}
    assert all((r.label == 1) == (r.component == "embedded_attack") for r in rows) and {r.doc_id for r in rows if r.label} == set(range(6))


def test_apart_and_likely(spark):
    df = spark.createDataFrame([(1, i, i * 50, s) for i, s in enumerate([0.9, 0.8, 0.95, 0.1])], "doc_id long, window_index int, token_start int, score double")
    assert sorted(r.window_index for r in V.apart(df, 100, 2).collect()) == [0, 2]
    assert sorted(r.window_index for r in V.likely_windows(df, F.col("score") > 0.85).collect()) == [0, 2] and V.likely_windows(df, F.col("score") > 2).count() == 4


def test_scorer_sees_only_eligible_windows(spark):
    df = spark.createDataFrame([(1, "aa"), (2, "b"), (3, None)], "id long, window_text string")

    def make():
        return lambda s: [len(x) for x in s]

    got = {r.id: r.score for r in V.score_windows(df, make, eligible=F.length("window_text") > 1).collect()}
    assert got == {1: 2.0, 2: None, 3: None}


def test_conflict_policies(spark):
    df = spark.createDataFrame([(1, "x", 0, 0.1), (2, "X ", 1, 0.9), (3, "y", 1, 0.5), (4, "y", 1, 0.7), (5, "x", 0, 0.2)], "id long, text string, label int, score double")
    ids = lambda p: sorted(r.id for r in N.dedupe_conflicts(df, F.lower(F.trim("text")), "label", F.desc("score"), "id", policy=p).collect())
    assert ids("drop") == [4] and ids("first") == [2, 4] and ids("ignore") == [2, 4, 5]
    assert N.duplicate_report(df, "label").first() == (2, 5, 1)


def test_connected_groups_through_different_keys(spark):
    df = spark.createDataFrame([(1, "s1", "p1"), (2, "s1", "p2"), (3, "s3", "p2"), (4, "s4", "p4"), (5, None, ""), (6, None, "")], "id long, s string, p string")
    assert {r.id: r.group for r in X.connected_groups(df, "id", ["s", "p"]).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    chain = spark.range(60).select("id", F.floor(F.col("id") / 2).cast("string").alias("a"), F.floor((F.col("id") + 1) / 2).cast("string").alias("b"))
    assert {r.group for r in X.connected_groups(chain, "id", ["a", "b"]).collect()} == {0}


def test_exclusion_index_merges_origins(spark):
    a, b = (spark.createDataFrame([(i, t)], "doc_id long, text string") for i, t in ((1, "Same text"), (2, "same  TEXT")))
    index = X.extend_index(X.exclusion_index({"a": a}), X.exclusion_index({"b": b}))
    assert {tuple(r.origins) for r in index.where("kind = 'text_hash'").collect()} == {("a", "b")} and index.count() == 4


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    right = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], "k long, w string, seq int")
    assert sorted(tuple(r) for r in J.lookup(left, right, "k", "seq").collect()) == [(1, "a", "new"), (2, "b", "x")]
    assert {r.k for r in J.lookup_with_rejects(left, right.dropDuplicates(["k"]), "k").where("reason is not null").collect()} == {3}
    assert sorted(tuple(r) for r in J.mismatches({"l": left, "r": right}, "k").collect()) == [("l", "r", 1)]
    texts = spark.createDataFrame([(1, "abc def"), (2, "def"), (3, "")], "id long, t string")
    bank = spark.createDataFrame([("p", "abc"), ("q", "ef"), ("r", "bc d")], "n string, p string")
    want = [(1, "p"), (1, "q"), (1, "r"), (2, "q")]
    assert sorted((r.id, r.n) for r in J.containing(texts, bank, "t", "p").collect()) == want
    twice, odd = texts.union(texts.where("id = 2")), bank.union(bank.where("n = 'q'")).union(spark.createDataFrame([("e", ""), ("z", None)], "n string, p string"))
    want = sorted([(1, "p"), (1, "q"), (1, "q"), (1, "r"), (2, "q"), (2, "q"), (2, "q"), (2, "q")])
    assert sorted((r.id, r.n) for r in J.containing(twice, odd, "t", "p").collect()) == want
    assert J.containing(texts, bank.limit(0), "t", "p").count() == 0
    assert J.deal(texts, bank, 1, "id", "n").count() == 3 and J.deal(texts, bank.limit(0), 1, "id", "n").count() == 0


def test_deal_goes_in_cycles(spark):
    """Against the walk through both seeded orders: every right row before any comes again, rows of one id too."""
    left = [(i // 2 if i < 20 else i, f"t{i}") for i in range(103)]
    place = lambda i: hashlib.sha256(f"7:{i}".encode()).hexdigest()
    for size in (1, 7, 200):
        turns, bank = sorted(left, key=lambda r: (place(r[0]), *r)), sorted(range(size), key=place)
        want = sorted((*r, bank[n % size]) for n, r in enumerate(turns))
        got = J.deal(spark.createDataFrame(left, "id long, t string"), spark.range(size).withColumnRenamed("id", "n"), 7, "id", "n")
        assert sorted((r.id, r.t, r.n) for r in got.collect()) == want


def test_quotas(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, rows long")
    assert {r.k: r.quota for r in Q.largest_remainder(counts, 3, "k").collect()} == {"a": 1, "b": 1, "c": 1}
    assert Q.drift_quota({"a": 1, "b": 1, "c": 2}, 10, "c") == {"a": 2, "b": 2, "c": 6} and Q.cyclic_quota({"a": 1, "b": 1, "c": 1}, 10) == {"a": 4, "b": 3, "c": 3}
    assert Q.leading_quota({"a": 1, "b": 1, "c": 1}, 5) == {"a": 2, "b": 2, "c": 1} and Q.water_fill(100, {"a": 10, "b": 80, "c": 80}) == {"a": 10, "b": 45, "c": 45}
    assert Q.water_fill(500, {"a": 10, "b": 5}) == {"a": 10, "b": 5} and sum(Q.nested_quota({"x": 7, "y": 3}, {"s": 1, "l": 2}).values()) == 10


def test_selection(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}", i % 2) for i in range(90)], "id long, g string, label int")
    for make in (lambda: Q.cap_fold(df, {"g": 10}, 25, "id"), lambda: Q.capped(df, {"g": 10}, "id")):
        rows = make().collect()
        assert max(sum(r.g == g for r in rows) for g in ("g0", "g1", "g2")) <= 10 and sorted(rows) == sorted(make().collect())
    assert Q.cap_fold(df, {"g": 10}, 25, "id").count() == 25
    assert Q.half_and_half(df, "label", 20, "id").groupBy("label").count().collect()[0]["count"] == 10
    assert Q.rebalance(df, "label", 0.5, "id").where("label = 0").count() == 22 and Q.rebalance(df, "label", 0.5, "id", bin_col="g").where("label = 0").count() == 22
    assert abs(Q.seeded_sample(df, "id", fraction=0.5).count() - 45) < 20 and Q.sample_per_group(df, ["g"], "id", 4).count() == 12
    b = Q.carrier_bundles(df.withColumn("c", F.floor(F.col("id") / 6)), "c", "label", (20, 30), "id").groupBy("label").count().collect()
    assert all(r["count"] <= (20 if r.label else 30) for r in b) and sum(r["count"] for r in b) > 40
    assert Q.unique_rendered(spark, 5, "{a} {b}", a=["1", "2", "3"], b=["4", "5"]).count() == 5
    mix = Q.band_mix(df.withColumn("band", F.when(F.col("id") < 30, "low").otherwise("high")), "band", {"low": 1, "high": 1}, 20, {"g": 25}, "id")
    assert mix.count() == 20


def grid_counts(a, b, got_a, got_b, want_a, want_b, least):
    best = (math.inf, 0, 0)
    for x in range(min(a, want_a - got_a) + 1):
        for y in range(min(b, want_b - got_b) + 1):
            if x + y:
                error = abs((got_a + x) * want_b - (got_b + y) * want_a) + (want_a + want_b) * (y < min(least, b)) - 1e-6 * (x + y)
                best = min(best, (error, x, y))
    return best[1:]


def test_carrier_bundles_of_any_size(spark):
    rng = random.Random(3)
    for _ in range(1500):
        want_a, want_b = rng.randrange(40), rng.randrange(40)
        case = (rng.randrange(30), rng.randrange(30), rng.randint(0, want_a), rng.randint(0, want_b), want_a, want_b, rng.randrange(4))
        assert Q.bundle_counts(*case) == grid_counts(*case), case
    df = spark.createDataFrame([(i, i // 100, i % 2) for i in range(200)], "id long, c long, label int")
    got = {r.label: r["count"] for r in Q.carrier_bundles(df, "c", "label", (40, 60), "id").groupBy("label").count().collect()}
    assert got == {0: 60, 1: 40}


def test_hard_examples_and_early_stop(spark):
    rng = random.Random(8)
    rows = [(d, w, w * 64, rng.random(), f"s{d % 3}", d % 3 == 0) for d in range(40) for w in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, window_index int, token_start int, score double, source_name string, risky boolean")
    order = [r.doc_id for r in df.select("doc_id").distinct().orderBy(random_key(42, "doc_id")).collect()]
    for target, per_source, unsafe_cap in ((30, 20, 4), (1000, 1000, 7), (1000, 9, 1000)):
        want, by_source = [], {}
        for d in order:
            kept = []
            for r in sorted((r for r in rows if r[0] == d), key=lambda r: -r[3]):
                full = len(kept) == 2 or by_source.get(r[4], 0) >= per_source or (r[5] and by_source.get("unsafe", 0) >= unsafe_cap)
                if not full and all(abs(r[2] - x[2]) >= 128 for x in kept):
                    kept.append(r)
                    for k in [r[4]] + ["unsafe"] * r[5]:
                        by_source[k] = by_source.get(k, 0) + 1
            want += kept
        got = Q.hard_examples(df, target, 2, per_source, "risky", unsafe_cap).collect()
        assert sorted(map(tuple, got)) == sorted(want[:target]) and len(got) > 15
    scan = lambda *a, **k: [r.id for r in Q.scan_until(spark.range(100).withColumn("h", F.col("id") % 8), F.col("id") % 2 == 0, *a, "id", **k).collect()]
    assert scan(3, 50) == [0, 2, 4] and scan(50, 7) == [0, 2, 4, 6] and scan(9, 50, distinct="h") == [0, 2, 4, 6]


def test_splits(spark):
    df = spark.createDataFrame([(i, f"s{i % 4}", i % 2, f"k{i // 3}", None if i % 5 else "train") for i in range(120)], "id long, s string, label int, k string, hint string")
    assert S.random_split(df, "id", 30).where("split = 'validation'").count() == 30
    h = S.hinted_split(df, "id", "hint", ["s"], 0.25)
    assert h.count() == 120 and h.where("hint = 'train' and split <> 'train'").count() == 0
    with pytest.raises(Exception, match="unknown split hint"):
        S.hinted_split(df.withColumn("hint", F.lit("odd")), "id", "hint", ["s"], 0.2).count()
    g = S.grouped_split(df, "id", ["k"], 30)
    assert g.groupBy("group").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0 and 27 <= g.where("split = 'validation'").count() <= 33
    c = S.cover_split(df, "k", "s", 12)
    assert c.where("split = 'validation'").select("s").distinct().count() == 4 and c.count() == 120
    a = S.atomic_split(df, "k", ["s"], {"train": 0.5, "test": 0.5}, protected={"s1": "test"}, protected_field="s")
    assert a.groupBy("k").agg(F.count_distinct("pool").alias("n")).where("n > 1").count() == 0
    assert S.ordered_cut(df, "id").where("split = 'train'").count() == 90 and {r.split for r in S.ordered_cut(df.limit(3), "id").collect()} == {"both"}
    assert S.concatenate([df.select("id"), None, df.select("s")]).count() == 240 and S.remaining(df, df.where("id < 100"), "id").count() == 20


def test_metrics_against_plain_python(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(2), round(rng.random(), 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    m = A.ranking_metrics(df).first()
    assert math.isclose(m.roc_auc, auc, rel_tol=1e-12) and m.positives == len(pos)
    t = A.threshold_metrics(df, [0.5]).first()
    assert (t.tp, t.fp) == (sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)) and math.isclose(t.precision, t.tp / (t.tp + t.fp))
    assert A.ranking_metrics(df.limit(0)).first().roc_auc == 0.0
    w = spark.createDataFrame([(0, 0), (5, 10), (10, 10)], "k int, n int").select(A.wilson(F.col("k"), F.col("n")), A.wilson_upper(F.col("k"), F.col("n"))).collect()
    assert tuple(w[0][0]) == (0.0, 0.0) and w[0][1] == 1.0 and math.isclose(w[1][0].low, 0.2365930905, abs_tol=1e-8) and math.isclose(w[1][0].high, 0.7634069095, abs_tol=1e-8) and math.isclose(w[2][0].high, 1.0)
    upper = spark.createDataFrame([(2, 300)], "k int, n int").select(*(A.wilson_upper(F.col("k"), F.col("n"), x) for x in (0.95, 0.99, 0.9))).first()
    assert all(math.isclose(a, b, abs_tol=5e-5) for a, b in zip(upper, (0.0240, 0.0334, 0.0199), strict=True))
    b = A.threshold_for_recall(df, 2.0).first()
    assert not b.reached


def test_gates(spark):
    df = spark.createDataFrame([(i, i % 2, "a" if i < 80 else "b") for i in range(100)], "id long, label int, s string")
    assert G.assert_counts(df, "label", {0: 50, 1: 50}) is df
    with pytest.raises(ValueError):
        G.assert_counts(df, "label", {0: 1})
    assert G.split_issues(df, "label", "s", "s", ["c"], 0.35, 10) == ["source share: a", "source share: b", "critical bucket: c has 0 rows"] or "source share: a" in G.split_issues(df, "label", "s", "s", ["c"], 0.35, 10)
    assert G.pair_coverage(df, "s", "label").first().passed and G.capacity(df, "s", {"a": 50, "b": 50})["b"]["enough"] is False
    kept, rejected = G.split_rejects(df, ("small", F.col("id") < 10), ("odd", F.col("label") == 1))
    assert kept.count() == 45 and {r.reason for r in rejected.collect()} == {"small", "odd"}
    assert G.metadata_auc(df.withColumn("leak", F.col("label")), ["leak"], "label", "id") > 0.95
    j = spark.createDataFrame([(1, "attack", 0.9), (2, "benign", 0.9), (3, "attack", 0.1)], "id long, label string, confidence double")
    c = {r.id: (r.keep, r.decision) for r in G.curate(df.select("id").where("id < 5"), j, "id", F.col("id") == 3).collect()}
    assert c == {0: (False, "no_evidence"), 1: (True, "judged_attack"), 2: (False, "judged_benign"), 3: (True, "rule_evidence"), 4: (False, "no_evidence")}


def test_reports(spark):
    df = spark.createDataFrame([(1, "x", None, 5), (2, "x", "t", 7), (3, "y", "t", 9)], "id long, a string, b string, n long")
    assert R.vote_field(df, ["missing", "b", "a"]) == "a" and R.vote_field(df, ["zzz"]) is None
    assert R.divergence(df, df, "a").first().jsd == 0.0 and R.divergence(df.where("a = 'x'"), df.where("a = 'y'"), "a").first().jsd == 1.0
    names = spark.createDataFrame([("checkpoint-10",), ("checkpoint-9",)], "n string")
    assert [r.n for r in names.orderBy(R.natural_key("n")).collect()] == ["checkpoint-9", "checkpoint-10"]


def fetch_page(number):
    return [(f"p{number}-{i}", f"text {number} {i}") for i in range(3)] if number < 2 else []


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "text": "x"}\n\n[1]\nnot json\n')
    (tmp_path / "b.jsonl").write_text('{"id": 1, "text": "x"}\n{"id": 2, "text": ""}\n')
    assert sorted(r.line for r in readers.jsonl_errors(spark, str(tmp_path / "a.jsonl")).collect()) == [3, 4]
    assert readers.read_jsonl(spark, str(tmp_path / "b.jsonl"), "id long, text string").count() == 2
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), "id long, text string").collect()
    assert readers.read_jsonl(spark, str(tmp_path / "none.jsonl"), "id long", optional=True).count() == 0
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "c.jsonl.zst").write_bytes(zstandard.compress(b'{"id": 7}\n{"id": 8}\n'))
    assert sorted(r.id for r in readers.read_zstd_jsonl(spark, str(tmp_path / "z"), "id long").collect()) == [7, 8]
    table = pa.table({"text": ["a", "b"], "label": pa.array([0, 1], pa.int64())})
    (tmp_path / "arrow").mkdir()
    for name, make in (("s.arrow", pa.ipc.new_stream), ("f.arrow", pa.ipc.new_file)):
        with make(str(tmp_path / "arrow" / name), table.schema) as w:
            w.write_table(table)
    assert readers.read_arrow(spark, str(tmp_path / "arrow"), "text string, label long").count() == 4
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "d.txt").write_bytes("ж".encode("cp1251"))
    (tmp_path / "t" / "d.bin").write_bytes(b"x")
    assert [r.text for r in readers.read_text_files(spark, str(tmp_path / "t")).collect()] == ["ж"]
    spec = readers.SourceSpec("b", str(tmp_path / "b.jsonl"), "id long, text string", as_label=1)
    errors = {}
    assert readers.load_sources(spark, [spec, readers.SourceSpec("x", str(tmp_path / "no"), "id long")], errors).count() == 1 and list(errors) == ["x"]
    with pytest.raises(ValueError):
        readers.guard_paths(["/data/locked_eval/x"], ["locked"])
    made = []
    for _ in range(2):
        assert readers.cached_stage(spark, str(tmp_path / "cache"), "s", {"a": 1}, lambda: made.append(1) or spark.range(3)).count() == 3
    assert made == [1]
    assert readers.read_paged(spark, "tests.test_operators:fetch_page", 3, "document_id string, text string").count() == 6


def test_crawl(spark):
    rows = [("http://h.org/a", "<a href='/b'>b</a><a href='http://x.com/'>x</a>"), ("http://h.org/b", "<a href='/c'>c</a><a href='/a'>a</a>"), ("http://h.org/c", "<a href='/d'>d</a>")]
    pages = spark.createDataFrame(rows, "url string, html string")
    from corpusloom.functions.text import allowed_url

    got = {r.url: r.depth for r in readers.crawl(pages, ["http://h.org/a"], 2, lambda u: allowed_url(u, ["h.org"])).collect()}
    assert got == {"http://h.org/a": 0, "http://h.org/b": 1, "http://h.org/c": 2}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "train"), (2, "b", "validation")], "z long, text string, split string")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert "".join(p.read_text() for p in (tmp_path / "j").glob("part-*")).startswith('{"split"')
    state = sinks.write_dataset(df, str(tmp_path / "d"))
    assert state["rows"] == {"train": 1, "validation": 1} and state["fingerprint"] == sinks.fingerprint(df.orderBy(F.desc("z")).select("text", "z", "split"))
    assert json.loads((tmp_path / "d" / "_state.json").read_text())["rows"] == state["rows"]
    sinks.append_new(df, str(tmp_path / "p"), "z")
    sinks.append_new(df.union(spark.createDataFrame([(3, "c", "train")], df.schema)), str(tmp_path / "p"), "z")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    seq = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "id string, seq int, v string")
    assert sorted((r.id, r.v, r.first_seq) for r in sinks.compact(seq, "id", "seq").collect()) == [("a", "z", 1), ("b", "y", 2)]
    root = tmp_path / "m"
    (root / "sub").mkdir(parents=True)
    (root / "one").write_text("1")
    (root / "sub" / "two").write_text("2")
    want = sinks.manifest(spark, str(root))
    want = spark.createDataFrame(want.collect(), want.schema)
    assert sinks.verify_manifest(spark, str(root), want).count() == 0
    (root / "one").write_text("9")
    (root / "three").write_text("3")
    (root / "sub" / "two").unlink()
    assert {(r.file, r.status) for r in sinks.verify_manifest(spark, str(root), want).collect()} == {("one", "changed"), ("three", "extra"), ("sub/two", "missing")}
    assert G.package_issues(spark, str(tmp_path / "d"), ["nothing.json"], {"split=train": ["text", "gone"]}) == ["missing nothing.json", "split=train lacks gone"]
    assert "| a |" in sinks.markdown("T", {"s": [{"a": 1}]})
    sinks.write_csv(df, str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c")).count() == 2


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.where("doc_id < 100").write.parquet(src)
    stream = streams.read_stream(spark, src, docs.schema)
    q = streams.append_once(streams.first_seen(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    docs.where("doc_id >= 50").write.mode("append").parquet(src)
    q = streams.append_once(streams.first_seen(streams.read_stream(spark, src, docs.schema)), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    from corpusloom.functions.text import text_hash

    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.select(text_hash("text", 64)).distinct().count()
    for _ in range(2):
        streams.running_top_k(streams.read_stream(spark, src, docs.schema, 1), str(tmp_path / "top"), str(tmp_path / "ck2"), 5, "doc_id", "n_chars").awaitTermination()
    last = max((tmp_path / "top").glob("batch=*"), key=lambda p: int(p.name[6:]))
    assert sorted(r.doc_id for r in spark.read.parquet(str(last)).collect()) == sorted(r.doc_id for r in docs.orderBy(F.desc("n_chars"), "doc_id").limit(5).collect())
    ev = spark.read.parquet(f"{SF}/events.parquet")
    es = spark.readStream.schema(ev.schema).parquet(f"{SF}/events.parquet*")
    for df, name in ((streams.score_windows(es, "ts", "value", "event_type"), "w"), (streams.sessions(es, "ts", "user_id"), "s"), (streams.first_seen_within(es, "ts", "event_id", "1 hour"), "d")):
        q = df.writeStream.format("memory").queryName(f"m_{name}").outputMode("append").option("checkpointLocation", str(tmp_path / f"ck_{name}")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"m_{name}").count() > 0


def test_regressions(spark):
    cols = "corpus string, document_id string, attack_text_hash string, best_window_text_hash string, label int, score double, language string, category string, seq int"
    new = [("c", "1", None, "w", 1, 0.2, "en", None, 1), ("c", "2", None, "w", 1, 0.9, "en", "x", 1), ("c", "", "h", "w", 1, 0.1, "", "x", 1), ("c", None, None, "w9", 1, 0.3, "ru", "x", 1), ("d", "1", None, "w", 1, 0.2, "en", "x", 1), ("c", "5", None, "w", 0, 0.1, "en", "x", 1)]
    old = [("c", "1", None, "w", 1, 0.5, "en", "x", 1), ("c", "1", None, "w", 1, 0.995, "en", "x", 2), ("c", None, "h", "other", 1, 0.8, "en", "x", 1), ("c", None, "", "w9", 1, 0.4, "en", "x", 1)]
    got = {(r.corpus, r.document_id): (r.baseline_score, r.baseline_score_band, r.language, r.category) for r in J.regressions(spark.createDataFrame(new, cols), spark.createDataFrame(old, cols), 0.5, seq="seq").collect()}
    assert got == {("c", "1"): (0.995, "0.99-0.999", "en", "unknown"), ("c", ""): (0.8, "0.50-0.82", "unknown", "x"), ("c", None): (0.4, "0.10-0.50", "ru", "x"), ("d", "1"): (None, None, "en", "x")}


def test_priorities(spark):
    df = spark.createDataFrame([("prod_fp_hard_benign", 0.5), ("near_boundary", 0.7), ("prod_real", 0.9), ("neighbor", 0.9), (None, 0.9), ("hard", None)], "b string, s double")
    assert [tuple(r[0]) for r in df.select(R.priority("b", F.col("s"))).collect()] == [(5, 0.5), (4, 0.7), (3, 0.0), (2, 0.0), (1, 0.0), (5, 0.0)]
    assert [tuple(r[0]) for r in df.select(R.priority(F.lit("embedded_wrapper"), None, R.ATTACK_PRIORITY)).limit(1).collect()] == [(4, 0.0)]


def test_report_sections_are_whole(spark):
    assert len(sinks.report_of({"a": spark.range(5)}, 5)["a"]) == 5
    with pytest.raises(ValueError):
        sinks.report_of({"a": spark.range(6)}, 5)


def test_repeat_counts_of_rows_with_one_id(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "A"), (3, "a"), (3, "a"), (None, "a"), (4, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "", r.exact_count, r.normalized_count) for r in N.repeat_counts(df).collect())
    assert got == sorted([(1, "a", 4, 5), (1, "b", 1, 1), (2, "A", 1, 5), (3, "a", 4, 5), (3, "a", 4, 5), (0, "a", 4, 5), (4, "", 1, 1)])


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert R.divergence(df, df.limit(0), "k").first().jsd == 0.0 and R.divergence(df.where("k = 'a'"), df.where("k = 'b'"), "k").first().jsd == 1.0


def fold(rows, passes, exempt=()):
    """A walk through (id, keys) for each of the passes (order, caps, total): {id: pass}."""
    chosen, seen = {}, {}
    for number, (order, caps, total) in enumerate(passes, 1):
        for i in order:
            if i in chosen or (total is not None and len(chosen) >= total):
                continue
            keys = [(c, rows[i][c]) for c in rows[i]]
            limit = lambda c, v, caps=caps: caps[c] if isinstance(caps[c], int) else caps[c].get(v, 0)
            if all(c not in caps or (c in exempt and v in (None, "")) or seen.get((c, v), 0) < limit(c, v) for c, v in keys):
                chosen[i] = number
                for k in keys:
                    seen[k] = seen.get(k, 0) + 1
    return chosen


@pytest.mark.parametrize("small", [0, 10**6])
def test_greedy_choice_is_the_walk(spark, small):
    """Passes, limits of single values, exempt and null keys, a hot value; in rounds and in one task."""
    rng = random.Random(4)
    rows = {i: {"a": rng.choice(["hot", "hot", "x", "y", None]), "b": rng.choice(["1", "2", "3", "4", "", None]), "c": f"c{rng.randrange(40)}"} for i in range(400)}
    df = spark.createDataFrame([(i, r["a"], r["b"], r["c"]) for i, r in rows.items()], "id long, a string, b string, c string")
    order = [r.id for r in df.orderBy(random_key(42, "id")).collect()]
    again = [r.id for r in df.orderBy(random_key(43, "id")).collect()]
    passes = [O.Pass({"a": {"hot": 30, "x": 25, None: 7}, "b": 20, "c": 3}), O.Pass({"b": 40, "c": 4}, 130, [random_key(43, "id")])]
    got = {r.id: r["pass"] for r in O.greedy(df, "id", [O.Pass({"a": {"hot": 30, "x": 25}, "b": 20, "c": 3}), passes[1]], [random_key(42, "id")], ["b"], small).collect()}
    assert got == fold(rows, [(order, {"a": {"hot": 30, "x": 25}, "b": 20, "c": 3}, None), (again, {"b": 40, "c": 4}, 130)], ["b"])
    assert {2} < set(got.values()) == {1, 2} and len(got) == 130
    if not small:  # rounds are slow on a small table; the other forms differ in their passes only
        return
    one = {r.id for r in Q.cap_fold(df, {"a": 50, "c": 2}, 60, "id", small=small).collect()}
    assert one == set(fold(rows, [(order, {"a": 50, "c": 2}, 60)]))
    q11 = {r.id: r["pass"] for r in Q.targeted_sample(df, "a", {"hot": 9, "y": 9}, "c", 2, 50, "id", small=small).collect()}
    assert q11 == fold(rows, [(order, {"a": {"hot": 9, "y": 9}, "c": 2}, 50), (order, {"c": 2}, 50)]) and len(q11) == 50
    targets, caps = {"y": 20, "hot": 30}, {"b": {"1": 20, "2": 30, "3": 9, "4": 9}, "c": 4}
    first = sorted(rows, key=lambda i: ({"y": 0, "hot": 1}.get(rows[i]["a"], 2), order.index(i)))
    part = {i: {**r, "a": r["a"] if r["a"] in targets else None} for i, r in rows.items()}
    want = fold(part, [(first, {"a": targets, **caps}, None), (again, {**caps, "b": {"1": 15, "3": 9}}, 120), (again, caps, 120)], ["a"])
    q12 = {r.id: r["pass"] for r in Q.capped_build(df, "a", targets, caps, 120, "id", "b", {"1": 15, "3": 30}, seed=42, small=small).collect()}
    assert q12 == want


def test_first_rows_of_any_order(spark, monkeypatch):
    """Cells refined to the last digit, repeated keys, and no ordered limit in the plan."""
    monkeypatch.setattr(O, "FEW_KEYS", 3)
    df = spark.createDataFrame([(i % 500, i) for i in range(700)], "id long, i long")
    keys = sorted(r.k for r in df.select(random_key(42, "id").alias("k")).collect())
    for n in (0, 1, 7, 350, 699, 700, 900):
        t = O.first_rows(df, random_key(42, "id"), n)
        assert sorted(r.k for r in t.select(random_key(42, "id").alias("k")).collect()) == keys[:n]
    plan = Q.seeded_sample(df.dropDuplicates(["id"]), "id", most=350)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
    assert S.random_split(df, "i", 30).where("split = 'validation'").count() == 30


def test_numbers_and_running_sums_over_ranges(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(9), rng.randrange(100)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, a int, n long")
    by = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r.id: (r.k, r.s) for r in O.running(O.numbered(df, "k", F.desc("a"), "id"), "s", F.col("n"), F.desc("a"), "id").collect()}
    total, want = 0, {}
    for k, (i, _, n) in enumerate(by, 1):
        want[i], total = (k, total), total + n
    assert got == want
    assert sorted(map(tuple, Q.take_until(df, "n", 4000, [], "id").select("id").collect())) == [(i,) for i, _, _ in rows if sum(r[2] for r in rows[:i]) < 4000]


def test_first_fit_in_blocks_is_the_walk(spark):
    rng = random.Random(9)
    for target, sizes in ((100, (1, 30)), (400, (1, 200)), (37, (30, 60)), (5000, (1, 9))):
        rows = {i: rng.randint(*sizes) for i in range(300)}
        df = spark.createDataFrame(list(rows.items()), "g long, rows long")
        have, want = 0, set()
        for r in df.orderBy(random_key(42, "g")).collect():
            if have < target and have + r.rows <= 1.1 * target:
                have, want = have + r.rows, want | {r.g}
        got = {r.g for r in S._first_fit(df, "g", [random_key(42, "g"), F.col("g")], target, 1.1).where("split = 'validation'").collect()}
        assert got == want


def test_bundles_are_the_walk(spark):
    rng = random.Random(10)
    rows = [(i, rng.randrange(25), rng.random() < 0.4) for i in range(300)]
    df = spark.createDataFrame([(i, c, int(y)) for i, c, y in rows], "id long, c long, label int")
    got_a = got_b = 0
    want = {}
    for r in df.select("c").distinct().orderBy(random_key(42, "c")).collect():
        a, b = sum(y for _, c, y in rows if c == r.c), sum(not y for _, c, y in rows if c == r.c)
        x, y = Q.bundle_counts(a, b, got_a, got_b, 60, 80)
        got_a, got_b, want[r.c] = got_a + x, got_b + y, (x, y)
    got = Q.carrier_bundles(df, "c", "label", (60, 80), "id").groupBy("c").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b")).collect()
    assert {r.c: (r.a, r.b) for r in got} == {c: n for c, n in want.items() if n != (0, 0)} and (got_a, got_b) == (60, 80)


def test_percentiles_over_ranges(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(50)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v long")
    for by in ([], ["g"]):
        for rule, at in (("round", lambda n, p: round((n - 1) * p)), ("ceil", lambda n, p: max(math.ceil(n * p) - 1, 0)), ("floor", lambda n, p: math.floor((n - 1) * p))):
            groups = {}
            for g, v in rows:
                if v is not None:
                    groups.setdefault(g if by else 0, []).append(v)
            got = {(r.g if by else 0, r.share): r.value for r in R.rank_percentile(df, "v", (0.5, 0.9), rule, by).collect()}
            assert got == {(g, p): sorted(v)[at(len(v), p)] for g, v in groups.items() for p in (0.5, 0.9)}


@pytest.mark.parametrize("bits", [6, 26])
def test_containment_by_the_rarest_gram_is_brute_force(spark, bits):
    """Phrases of 1 to 30 characters of few letters, some beyond ASCII, in a filter that lets most grams pass and in one that lets few."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("ab é\u4e2d\U0001f600") for _ in range(rng.randrange(n)))
    texts = [(i, word(120) if i % 7 else None) for i in range(120)]
    bank = [(i, word(31) if i % 3 else word(5)) for i in range(60)] + [(99, next(t for _, t in texts if t and len(t) > 60)[10:55])]
    got = J.containing(spark.createDataFrame(texts, "id long, t string"), spark.createDataFrame(bank, "n long, p string"), "t", "p", bits)
    assert sorted((r.id, r.n) for r in got.collect()) == sorted((i, n) for i, t in texts for n, p in bank if t and p and p in t)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [id") == 1 and "Cartesian" not in plan
