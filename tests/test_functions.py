"""Scalar functions on strings that the tables do not have."""

import hashlib
import math
import unicodedata
from collections import Counter

from pyspark.sql import functions as F

from corpusloom.functions import features as B
from corpusloom.functions import text as T


def one(spark, column, **values):
    names = list(values)
    types = {str: "string", int: "long", float: "double", bytes: "binary", list: "array<string>", type(None): "string", bool: "boolean"}
    df = spark.createDataFrame([tuple(values.values())] if values else [(1,)], ", ".join(f"{n} {types[type(v)]}" for n, v in values.items()) if values else "x long")
    return df.select(column).first()[0]


def many(spark, column, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(column).collect()]


def test_normalise(spark):
    assert many(spark, T.normalize("t"), " a   b\t\n c ", None, "") == ["a b c", "", ""]
    assert many(spark, T.normalize_visible("t"), "a​b\x00 ﻿c") == ["ab c"]
    assert many(spark, T.normalize_compatible("t"), "ﬁn  Ａ") == [" ".join(unicodedata.normalize("NFKC", "ﬁn  Ａ").lower().split())]
    assert many(spark, T.mask_template("t"), "See https://x.y/z?1 or a.b@c.de, 42 times") == ["see <url> or <email>, <num> times"]
    assert many(spark, T.slug("t"), " Hello, Мир! ", "--", "été日", "x" * 90) == ["hello_мир", "unknown", "été日", "x" * 80]
    assert many(spark, T.slug("t", "file"), "a/b c.txt", "//") == ["a-b-c.txt", "source"] and many(spark, T.slug("t", "id"), "a/b", "") == ["a_b", "unknown"]
    assert many(spark, T.preview("t", 10), "short", "a much longer text") == ["short", "a much ..."] and many(spark, T.preview("t", 7, "compact"), "a much longer text") == ["a much ..."]
    long = "Ab " * 150
    head = " ".join(long.lower().split())
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert many(spark, T.long_signature("t"), "A  b", long) == [digest("a b"), digest(head[:200] + " ... " + head[-200:])]


def test_labels_and_numbers(spark):
    assert many(spark, T.label_name("t"), "1", "Malicious ", "safe", None, "odd", "TRUE") == ["attack", "attack", "benign", "benign", "odd", "attack"]
    assert many(spark, T.truthy("t"), "Yes", "trusted", "0", None) == [True, False, False, False] and many(spark, T.truthy("t", "policy"), "trusted") == [True]
    assert many(spark, T.not_false("t"), None, "no", "x") == [True, False, True]
    assert many(spark, T.safe_double("t", -1.0), "1.5", "x", None) == [1.5, -1.0, -1.0]
    assert one(spark, T.first_score("a", "b"), a="x", b="0.25") == 0.25 and one(spark, T.safe_div(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert many(spark, T.nested("t", "a.b"), '{"a": {"b": 3}}', "{}") == ["3", None]


def test_languages(spark):
    ru, en = "Привет мир как дела сегодня у всех нас тут хорошо", "Hello world how are you all doing here today friends"
    assert many(spark, T.infer_language("t"), ru, en, ru + en, "12", ru + " ok") == ["ru", "en", "mixed", "unknown", "ru"]
    assert many(spark, T.infer_language("t", "dominant"), ru, en, "да", "yes да", "") == ["ru", "en", "ru", "mixed", "unknown"]
    assert many(spark, T.infer_language("t", "any"), ru + "x", "") == ["mixed", "unknown"] and many(spark, T.infer_language("t", "cyrillic"), "xж", "x") == ["ru", "en"]
    assert one(spark, T.canonical_language("a", "t"), a="en-US", t=ru) == "en" and one(spark, T.canonical_language("a", "t"), a="multi", t=ru) == "ru"
    assert tuple(many(spark, T.script_counts("t"), "Жa é")[0]) == (1, 1, 1)


def test_entropy(spark):
    texts = ["", "aaaa", "abab", "Привет, мир"]
    want = [-sum(c / len(t) * math.log2(c / len(t)) for c in Counter(t).values()) if t else 0.0 for t in texts]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(many(spark, T.char_entropy("t"), *texts), want, strict=True))


def test_pages(spark):
    page = "<html><title> A &amp; B </title><script>x<y</script><p>One<br>two</p><svg><a href='no'></svg><a href='/p?q=1#f'>go</a> <a href=\"mailto:x@y\">m</a></html>"
    assert many(spark, T.html_text("t"), page, "a&lt;b&gt;c<!-- x -->") == ["A & B One two go m", "a c"] and many(spark, T.html_title("t"), page) == ["A & B"]
    df = spark.createDataFrame([("http://h.org/a/b", page + "<link href='x?a&amp;b'><a href='#t'><a href='TEL:1'>")], "u string, t string")
    assert df.select(T.html_links("u", "t")).first()[0] == ["http://h.org/a/no", "http://h.org/p?q=1#f", "http://h.org/a/x?a&b", "TEL:1"]
    urls = ["HTTP://Ex.ORG?utm_source=1&UTM_x=2&b=2#x", "ftp://a/b", "https://a/b?gclid=1", "https://a/b?q=a+b%2Fc&e&gclids=1&s=~*", "", None]
    assert many(spark, T.canonical_url("t"), *urls) == ["http://Ex.ORG?b=2", "", "https://a/b", "https://a/b?q=a+b%2Fc&e=&s=~%2A", "", ""]
    allowed = ["http://w.ex.org/a/1", "http://nex.org/a", "http://ex.org/b", "http://u:p@EX.org:81/a?x", "http://ex.org/ab"]
    assert many(spark, T.allowed_url("t", ["ex.org"], ["/a"]), *allowed) == [True, False, False, True, False] and many(spark, T.allowed_url("t"), "x") == [True]
    assert many(spark, T.skipped_url("t", [".pdf"]), "http://a/b.PDF?x", "mailto:x", "http://a/Login/x", "http://a/b") == [True, True, True, False]
    assert many(spark, T.looks_blocked("t", F.lit("")), "please solve the CAPTCHA", "403 forbidden", "Доступ ограничен") == [True, False, True]


def test_bytes_and_mojibake(spark):
    assert one(spark, T.decode_bytes("a"), a="привет".encode("cp1251")) == "привет" and one(spark, T.decode_bytes("a"), a=b"<meta charset=latin-1>\xe9") == "<meta charset=latin-1>é"
    bad = "привет".encode().decode("latin-1")
    assert many(spark, T.repair_mojibake("t"), bad, "fine ж", "Ð¿Ñ", None) == ["привет", "fine ж", "Ð¿Ñ", None] and many(spark, T.looks_corrupted("t"), bad, "ok", "â€œx", "\ufffd") == [True, False, True, False]
    assert one(spark, T.decode_bytes("a"), a=b"<META CharSet='CP1251'>" + "да".encode("cp1251")) == "<META CharSet='CP1251'>да"
    assert one(spark, T.decode_bytes("a"), a="привет мир".encode().decode("latin-1").encode()) == "привет мир"


def test_sentences_and_insertion(spark):
    t = "One two. Three four! Five six? Seven"
    assert many(spark, T.sentences("t"), t, "") == [["One two.", "Three four!", "Five six?", "Seven"], []]
    assert many(spark, T.sentence_ends("t"), t) == [[9, 21, 31]]
    for position in ("prefix", "suffix", "middle", "deep"):
        r = many(spark, T.embed("t", F.lit("XYZ"), position), t)[0]
        assert r.text[r.start : r.stop] == "XYZ" and r.text.replace("XYZ", "").split() == t.split()
    assert many(spark, T.embed("t", F.lit("X"), "prefix"), t)[0].text == "X " + t and many(spark, T.embed("t", F.lit("X"), "suffix"), t)[0].start == len(t) + 1
    assert many(spark, T.embed("t", F.lit("X"), "middle"), t)[0].start in {len(x) + 1 for x in ("One two.", "One two. Three four!", "One two. Three four! Five six?")}
    long = "".join(f"word{i:03} " for i in range(200)).strip()
    assert many(spark, T.crop_around("t", F.lit(9), F.lit(14), 15), t)[0] == t  # a span keeps 160 characters
    assert many(spark, T.crop_around("t", F.lit(800), F.lit(807), 15), long)[0] == " ".join(long[720:887].split())
    assert many(spark, T.crop_around("t", F.lit(0), F.lit(7), 15), long)[0] == long[:167].strip() and many(spark, T.crop_around("t", F.lit(1590), F.lit(1599), 15), long)[0] == long[-169:].strip()
    r = many(spark, T.crop_with_context("t", F.lit(800), F.lit(807), 300, 40), long)[0]
    assert long[800:807] in r and 295 <= len(r) <= 300 and r.index(long[800:807]) >= 39
    assert len(many(spark, T.crop_random("t", 5), t)[0]) == 5
    assert many(spark, T.fragment("t", ["four", "six"]), t, "none here") == ["Three four! Five six?", "none here"]
    assert many(spark, T.fragment("t", ["zz"]), long + "zz" + long)[0] == (long + "zz" + long)[:900] and len(many(spark, T.fragment("t", ["q"]), long)[0]) == 700


def test_token_insertion_and_templates(spark):
    df = spark.createDataFrame([([str(i) for i in range(10)], ["X", "Y"])], "t array<string>, i array<string>")
    for place, lo, hi in (("beginning", 0, 10), ("early", 0, 3), ("middle", 4, 6), ("late", 6, 10), ("end", 0, 10), ("random", 0, 10)):
        seen = {r[0].start for k in range(40) for r in df.select(T.insert_tokens("t", "i", F.lit(place), F.lit(k))).collect() if r[0].tokens[r[0].start : r[0].stop] == ["X", "Y"] and len(r[0].tokens) == 12} if place == "middle" else {df.select(T.insert_tokens("t", "i", F.lit(place), F.lit(7))).first()[0].start}
        assert min(seen) >= lo and max(seen) <= hi and (place != "middle" or seen == {4, 5, 6})
    assert df.select(T.insert_tokens("t", F.array().cast("array<string>"), F.lit("early"), F.lit(1))).first()[0] is None
    got = {r[0] for r in spark.range(200).select(T.render("a {x} b {y}", F.col("id"), x=["1", "2"], y=["3", "4"])).collect()}
    assert got == {f"a {x} b {y}" for x in "12" for y in "34"}
    shares = Counter(r[0] for r in spark.range(4000).select(T.token_position(F.col("id"))).collect())
    assert abs(shares["random"] / 4000 - 0.65) < 0.04 and len(shares) == 6
    assert many(spark, T.vary("t", [], F.lit(6), [(3, "[", "]"), (4, "<", ">")]), "x") == ["[x]"]


def test_json_and_turns(spark):
    assert many(spark, T.flatten_json("t"), '{"a": [" x ", {"b": "y"}], "c": 1}', "plain", None) == ["x\n\ny", "plain", None]
    df = spark.createDataFrame([([("system", "s"), ("human", " a "), ("assistant", "b"), ("USER", "c")],)], "t array<struct<role:string,content:string>>")
    assert df.select(T.first_turns("t"), T.first_turns("t", 3)).first() == ("a", "a\n\nc")
    df = spark.createDataFrame([(None, " ", "T", "B")], "text string, body string, title string, answer string")
    assert df.select(T.extract_text("text", "body", joined=["title", "answer"])).first()[0] == "T\n\nB"


def test_buckets(spark):
    n = spark.range(0, 120).select("id", B.window_count_bucket("id").alias("b"), B.window_count_bin("id").alias("c"))
    by = {r.id: (r.b, r.c) for r in n.collect()}
    assert by[1] == ("1", "1") and by[2] == ("2-4", "2") and by[5][0] == "5-20" and by[21][0] == "21-50" and by[100][0] == "51-100" and by[101] == ("101+", "4+")
    s = spark.createDataFrame([(x,) for x in (0.0, 0.001, 0.5, 0.82, 0.95, 0.9995, 1.0, None)], "s double")
    assert [r[0] for r in s.select(B.score_band("s")).collect()] == ["<0.001", "0.001-0.01", "0.50-0.82", "0.82-0.90", "0.95-0.99", ">=0.9995", ">=0.9995", None]
    assert [r[0] for r in s.select(B.score_weight("s")).collect()][:5] == [220, 220, 220, 180, 120]
    assert [r[0] for r in s.select(B.boundary_band("s", [0.99, 0.82], True)).collect()][:5] == ["miss_below_0.82"] * 3 + ["miss_below_0.99"] * 2
    assert [r[0] for r in spark.range(1, 60, 12).select(B.stepped("id", B.SMALL_COUNTS)).collect()] == ["1", "11-25", "11-25", "26-50", "26-50"]
    assert [r[0] for r in s.select(B.share_bucket("s")).collect()][:7] == ["<=1%", "<=1%", "25-50%", "50-<100%", "50-<100%", "50-<100%", "100%"]
    assert [r[0] for r in spark.range(5).select(B.position_bucket("id", F.lit(5))).collect()] == ["first", "early", "middle", "late", "last"]


def test_categories(spark):
    table = {"a": ["apple", "pear"], "b": ["bean", "pear"]}
    assert many(spark, B.keyword_category("t", table, "z"), "a pear", "bean and pear", "none") == ["a", "b", "z"]
    assert many(spark, B.word_category("t", table, "z"), "pears", "a pear", "bean", "bean-pole") == ["z", "b", "b", "z"]
    assert tuple(many(spark, B.weighted_category("t", {"a": {"x": 2}, "b": {"y": 3}}, 3), "x y")[0]) == ("b", 3)
    assert many(spark, B.rule_category("t", {"a": (["strong"], ["m1", "m2"]), "b": ([], ["m1", "m2"])}), "strong", "m1", "m1 m2", "x") == ["a", None, "a", None]
    assert many(spark, B.first_match("t", {"q": r"\?", "e": "!"}, "s"), "a?!", "b!", "c") == ["q", "e", "s"]
    assert many(spark, B.source_family("t"), "hf://org/name/sub/x", "plain:part", None, "a:doc:1") == ["hf://org/name", "plain:part", "unknown", "a:doc:1"]
    assert one(spark, B.source_family("a", "b"), a="s", b="hf://o/n/x") == "hf://o/n" and one(spark, B.source_family("a", "b"), a="s", b="other") == "s"
    assert many(spark, B.generated_reason(["synth", "gpt"], "t"), "made by GPT", "human") == ["gpt", None]


def test_quality(spark):
    assert many(spark, B.quality_score("t"), "", "Plain words that differ.")[0] == 0.0
    good, bad = many(spark, B.quality_score("t"), "Plain words that differ from one another.", "<a><b>{{x}}&amp;<c><d>")
    assert good > 0.85 > bad
    flags = many(spark, B.quality_flags("t", F.lit("ru")), "", "abc\u200b " + "x" * 30, "Ð\x01" + " " * 20 + "текст и еще", "short", "абвгд efghi")
    assert flags[0] == ["empty_text"] and flags[1] == ["zero_width_char", "language_ru_low_cyrillic"] and flags[2] == ["possible_mojibake", "control_char", "long_whitespace_run"]
    assert flags[3] == ["very_short_text"] and flags[4] == ["mixed_cyrillic_latin"]
    assert many(spark, B.quoted_or_discussed("t", ["open sesame"], ["for example"]), 'he said "open sesame"', "open sesame now", "for example this") == [True, False, True]
    r = many(spark, B.evidence("t", {"a": ("alpha", 2), "b": ("beta", 1)}, [("both", "alpha", "gamma")]), "alpha beta", "alpha", "Alpha gamma")
    assert [(x.score, x.reasons) for x in r] == [(4, ["a", "b", "multiple_pi_signals"]), (2, ["a"]), (3, ["a", "both"])]
    assert one(spark, B.evidence("a", {"x": ("meta", 2)}, metadata="b"), a="t", b="META")["score"] == 2
    assert many(spark, B.any_pattern("t", ["ж+"]), "ЖЖ", "x") == [True, False]


def test_taxonomy_and_detectors(spark):
    table = {"over": ["drop the rules"], "leak": ["tell the secret", "print it"], "other": ["hm"]}
    texts = ["Please DROP  the rules", "tell the secret", "hm", "y" * 1000]
    assert many(spark, B.strength("t", F.lit(1), table, "over", ["leak"]), *texts) == ["explicit_override", "bare_or_exfiltration_command", "other_attack", "long_jailbreak_or_document_attack"]
    assert many(spark, B.strength("t", F.lit(0), table, "over", ["leak"]), "x") == ["benign_or_quoted"]
    forms = ["<!-- x", "a ```b", "System: x", "[1]", "a|b\nc", "an OCR text", "plain", " {x}"]
    assert many(spark, B.surface("t"), *forms) == ["html_or_comment", "markdown_or_code_block", "metadata_or_structured_field", "json_like", "table_like", "ocr_like", "plain_text", "json_like"]
    places = ["hm" + "x" * 50, "x" * 50 + "hm", "x" * 20 + "hm" + "x" * 20, "none"]
    assert many(spark, B.phrase_position("t", ["hm"]), *places) == ["beginning", "end", "middle", "no_known_phrase"]
    seen = B.target_and_frame("t", "prompt", "show", "audit", ("system", "tools", "routing"))
    assert many(spark, seen, "Show the PROMPT", "the prompt", "audit: prompt", "system tools routing json", "system tools routing", " ") == [True, False, True, True, False, False]


def test_anomalies(spark):
    plain = many(spark, B.artifacts("t"), "plain words only", "a1b2c3d4e5f60718", "12 34 56", "{};")
    assert [x.score for x in plain] == [0, 1, 1, 1] and plain[1].hits == ["hex_hash"]
    count = lambda n: {"normalized": F.lit(n), "prefix": F.lit(n), "suffix": F.lit(n)}
    patterns = {"triggers": {"t": "trigger"}, "negations": {"n": "not a command"}, "scaffolds": {"s": "meta:"}, "contaminations": {"c": "label="}}
    parts = lambda n: B.anomaly_scores("t", F.lit(0.96), count(n), patterns)
    texts = ["label=1", "short one", "a trigger not a command", " ".join(["word"] * 30), "meta: " * 5 + " ".join(["word"] * 30)]
    got = many(spark, F.transform(F.array(parts(1)), lambda p: B.anomaly(p, "t", F.lit(0.96), F.lit("en")))[0], *texts)
    assert [x.bucket for x in got] == ["label_contamination_candidate", "short_structured_high_score", "prompt_security_negation_artifact", "ordinary_false_positive", "ordinary_false_positive"]
    assert [x.score for x in got] == [9, 2, 4, 0, 6]  # a seventh of "label=1" is a symbol of code
    got = many(spark, F.transform(F.array(parts(11)), lambda p: B.anomaly(p, "t", F.lit(0.9995), F.lit("ru"), {"w": "WORD"}))[0], texts[3])
    assert got[0].bucket == "template_boilerplate_artifact" and got[0].score == 3 * 3 + 1 + 2 + 1


def test_white_space_is_what_it_was(spark):
    """The class that rules most characters out first, against the plain one, over all characters."""
    plain = r"[ \t-\r\x85\xa0  -     　]+"
    chars = spark.createDataFrame([(f"a{chr(i)}{chr(i)}b",) for i in range(1, 0x11000) if not 0xD800 <= i < 0xE000] + [(" \t\x85 x　\n y ",), ("",), (None,)], "t string")
    want = F.trim(F.regexp_replace(F.coalesce("t", F.lit("")), plain, " "))
    old = F.trim(F.regexp_replace(F.lower(want), plain, " "))
    assert chars.where((T.normalize("t") != want) | (T.hash_form("t") != old) | (T.has_words("t") != (F.size(T.words("t")) > 0))).count() == 0


def test_words_are_cut_once_where_a_phrase_is_inserted(spark):
    from corpusloom.operators import windows as V

    docs = spark.createDataFrame([(i, f"a{i} b c d") for i in range(9)] + [(9, " \n"), (10, None)], "doc_id long, text string")
    payloads = spark.createDataFrame([(1, "x y"), (2, "z")], "payload_id long, payload string")
    made = V.inject(docs, payloads)
    assert made.groupBy("component").count().collect() and not made.where("doc_id > 8").count()
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 20
