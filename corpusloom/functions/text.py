"""Text, hash, language, URL and HTML functions as Column expressions."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from html.entities import html5
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Spellings that must be recognised as given.
ATTACK_SPELLINGS = ("1", "attack", "malicious", "prompt_injection", "injection")
BENIGN_SPELLINGS = ("0", "benign", "not_prompt_injection", "non_injection", "safe")
TRUTHY = {"strict": ("1", "true", "yes", "y"), "policy": ("1", "true", "yes", "y", "trusted")}
RUSSIAN = ("ru", "rus", "russian", "ru_ru", "rus_cyrl", "russian_cyrillic")
ENGLISH = ("en", "eng", "english", "en_us", "en_gb")
SEVERAL = ("mixed", "multi", "multilingual")
CYRILLIC, LATIN = "[А-Яа-яЁё]", "[A-Za-z]"
MOJIBAKE = ("Ð", "Ñ", "Â", "â€™", "â€œ", "â€", "�")
#: How wrongly decoded pages and texts show.
CRAWL_MOJIBAKE, TEXT_MOJIBAKE, AFTER_A = ("Ð", "Ñ", "Â", "â"), ("â", "\ufffd", "Ð", "Ñ"), ("€", "™", "“", "”", "–")
#: A query parameter that begins so is dropped; paths that a crawl does not follow.
TRACKING = ("utm_", "fbclid", "gclid", "yclid")
SKIPPED_PATHS = ("/login", "/signin", "/auth", "/register", "/cart")
BLOCKED_PAGE = ("are you not a robot", "captcha", "access denied", "доступ ограничен", "проверка безопасности", "подтвердите, что вы не робот")

_SPACE = r" \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of Unicode white space. The class rules out what most characters are first: several times faster.
SPACES = rf"[[\t- \x85-\u3000]&&[{_SPACE}]]+"
#: What `\w` is with (?U), as a class that tries ASCII first: several times faster.
WORD_CHARS = r"[a-zA-Z0-9_\p{IsAlphabetic}\p{M}\p{Nd}\p{Pc}\u200c\u200d]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


def once(use: Callable[..., Column], **values: Column) -> Column:
    """`use(**values)`, with each value computed once, however often it is used and also inside the functions of arrays."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), lambda x: use(**{k: x[k] for k in values}))[0]


def char_count(t: Column, chars: str) -> Column:
    """How many characters of a class a text has, without an array of them."""
    return F.length(t) - F.length(F.regexp_replace(t, f"{chars}+", ""))


def normalize(c: Column | str) -> Column:
    """every run of Unicode white space becomes one space, ends stripped; null becomes empty."""
    return F.trim(F.regexp_replace(text_or_empty(c), SPACES, " "))


def normalize_visible(c: Column | str) -> Column:
    """F1 after zero-width space, byte order mark and NUL are removed."""
    return normalize(F.translate(text_or_empty(c), "​﻿\x00", ""))


@F.pandas_udf(StringType())
def _composed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        for at in range(0, len(s), 500):  # what Python holds at once is a slice's texts
            yield s.iloc[at : at + 500].map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


#: Characters that compatibility composition leaves alone, whatever stands beside them: a text of these is composed.
COMPOSED = r"\x00-\x9f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e\u0400-\u045f\u2012-\u2016\u2018-\u2023"


def nfkc(c: Column | str) -> Column:
    """Unicode compatibility composition, which Spark does not have. Only texts that it may change go to Python."""
    t = as_column(c)
    return F.coalesce(_composed(F.when(t.rlike(f"[^{COMPOSED}]"), t)), t)


def normalize_compatible(c: Column | str) -> Column:
    return normalize(F.lower(nfkc(text_or_empty(c))))


def mask_template(c: Column | str) -> Column:
    """URLs, addresses and numbers become placeholders."""
    t = F.regexp_replace(F.lower(text_or_empty(c)), r"(?U)https?://\S+", "<url>")
    t = F.regexp_replace(t, r"(?U)\b[\w.+-]+@[\w.-]+\.\w+\b", "<email>")
    return normalize(F.regexp_replace(t, r"(?U)\d+", "<num>"))


def normalize_nbsp(c: Column | str) -> Column:
    """F5."""
    return normalize(F.translate(text_or_empty(c), " ", " "))


def hash_form(c: Column | str) -> Column:
    """The form that text keys are hashed in. Lower case makes no white space of anything else."""
    return F.lower(normalize(c))


def stable_hash(c: Column | str, length: int = 16) -> Column:
    """F6."""
    return F.substring(F.sha2(as_column(c), 256), 1, length)


def text_hash(c: Column | str, length: int = 16) -> Column:
    return stable_hash(hash_form(c), length)


def hash_variants(c: Column | str) -> Column:
    """the full digest and its prefixes."""
    h = F.sha2(hash_form(c), 256)
    return F.array(h, *(F.substring(h, 1, n) for n in (24, 20, 16)))


def candidate_id(source: Column | str, text: Column | str) -> Column:
    """F8."""
    return F.sha2(F.concat_ws("\n", text_or_empty(source), F.lower(normalize(text))), 256)


def random_key(seed: int | str, *keys: Column | str) -> Column:
    """the order of every seeded shuffle."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *(as_column(k).cast("string") for k in keys)), 256)


def stable_int(c: Column | str) -> Column:
    """the first 32 bits of the digest."""
    return F.conv(F.substring(F.sha2(as_column(c).cast("string"), 256), 1, 8), 16, 10).cast("long")


def unit(c: Column | str) -> Column:
    """A stable number in [0, 1); stands in for model scores, which nothing here can compute."""
    return stable_int(c) / F.lit(4294967296.0)


def long_signature(c: Column | str, n: int = 200) -> Column:
    """hash of the two ends; of the whole of a text of at most `n` characters."""
    t = hash_form(c)
    return F.sha2(F.when(F.length(t) <= n, t).otherwise(F.concat(F.left(t, F.lit(n)), F.lit(" ... "), F.right(t, F.lit(n)))), 256)


def bag_cluster_id(c: Column | str, words: int = 80) -> Column:
    """hash of the first distinct words of four letters or more, in order."""
    bag = lambda t: F.array_join(F.slice(F.sort_array(F.array_distinct(F.regexp_extract_all(t, F.lit(f"({WORD_CHARS}{{4,}})")))), 1, words), " ")
    either = lambda t: once(lambda t, b: F.when(b != "", b).otherwise(t), t=t, b=bag(t))
    return stable_hash(once(either, t=hash_form(c)))


#: What stays in names of each kind, what replaces the rest, and what an empty name becomes.
SLUGS = {"name": (r"[^\p{L}\p{N}]+", "_", "unknown"), "file": (r"[^A-Za-z0-9_.-]+", "-", "source"), "id": (r"[^A-Za-z0-9_.-]+", "_", "unknown")}


def slug(c: Column | str, kind: str = "name") -> Column:
    """'name' (lower case, letters and digits of any script, 80 characters at most), 'file' or 'id'."""
    drop, mark, empty = SLUGS[kind]
    s = text_or_empty(c)
    s = F.regexp_replace(F.regexp_replace(F.lower(s) if kind == "name" else s, drop, mark), f"^{mark}+|{mark}+$", "")
    return F.coalesce(F.nullif(F.left(s, F.lit(80)) if kind == "name" else s, F.lit("")), F.lit(empty))


def label_name(c: Column | str, attack: str = "attack", benign: str = "benign") -> Column:
    """unknown spellings stay, empty ones are benign."""
    t = F.lower(F.trim(text_or_empty(c)))
    known = F.when(t.isin(*ATTACK_SPELLINGS, "true"), attack).when(t.isin(*BENIGN_SPELLINGS, "false", ""), benign)
    return known.otherwise(t)


def label_id(c: Column | str) -> Column:
    return (label_name(c) == "attack").cast("int")


def label_int_strict(c: Column | str) -> Column:
    """fails on what is neither a known spelling nor a number."""
    t = F.lower(F.trim(text_or_empty(c)))
    n = F.when(t.isin(*ATTACK_SPELLINGS), 1).when(t.isin("benign", "safe", "not_injection", "0"), 0).otherwise(t.try_cast("int"))
    return F.when(n.isNull(), F.raise_error(F.concat(F.lit("not a label: "), t)).cast("int")).otherwise(n)


def truthy(c: Column | str, dialect: str = "strict") -> Column:
    """F16: null is false."""
    return F.lower(F.trim(text_or_empty(c))).isin(*TRUTHY[dialect])


def not_false(c: Column | str) -> Column:
    """F16: the negative test; null is not false."""
    return ~F.coalesce(F.lower(F.trim(as_column(c).cast("string"))).isin("0", "false", "no", "n"), F.lit(False))


def safe_double(c: Column | str, default: float = 0.0) -> Column:
    """F17."""
    return F.coalesce(as_column(c).cast("string").try_cast("double"), F.lit(default))


def safe_div(a: Column, b: Column) -> Column:
    """0 on a zero denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def first_score(*candidates: Column | str) -> Column:
    """the first candidate that parses as a number."""
    return F.coalesce(*(as_column(c).cast("string").try_cast("double") for c in candidates))


def nested(c: Column | str, path: str) -> Column:
    """a path in a JSON string."""
    return F.get_json_object(as_column(c), "$." + path)


def row_key(document_id: Column, attack_hash: Column, window_hash: Column) -> Column:
    """(kind, value) of the first that is there."""
    kinds = (("document_id", document_id), ("attack_text_hash", attack_hash), ("window_text_hash", window_hash))
    return F.coalesce(*(F.when(F.coalesce(c, F.lit("")) != "", F.struct(F.lit(k).alias("kind"), c.alias("value"))) for k, c in kinds))


def preview(c: Column | str, limit: int = 160, form: str = "window") -> Column:
    """'window' is `limit` characters at most, the mark included; 'compact' cuts at `limit` and adds the mark."""
    t = normalize(c)
    cut = F.concat(F.left(t, F.lit(limit - 3)), F.lit("...")) if form == "window" else F.concat(F.rtrim(F.left(t, F.lit(limit))), F.lit(" ..."))
    return F.when(F.length(t) <= limit, t).otherwise(cut)


def infer_language(c: Column | str, dialect: str = "ratio") -> Column:
    """'ratio' (mixed from 12 %), 'dominant' (40 letters and twice as many), 'any', 'head' (2,000
    characters, mixed above 20 %), 'cyrillic'."""
    t = text_or_empty(c)
    if dialect == "head":
        t = F.left(t, F.lit(2000))
    return once(lambda cyr, lat: _script_language(cyr, lat, dialect), cyr=char_count(t, CYRILLIC), lat=char_count(t, LATIN))


def _script_language(cyr: Column, lat: Column, dialect: str) -> Column:
    least, most = F.least(cyr, lat), F.greatest(cyr, lat)
    if dialect == "ratio":
        return F.when((least > 0) & (least / most >= 0.12), "mixed").when(cyr > lat, "ru").when(lat > 0, "en").otherwise("unknown")
    if dialect == "dominant":
        return F.when(most == 0, "unknown").when(cyr >= F.greatest(F.lit(40), lat * 2), "ru").when(lat >= F.greatest(F.lit(40), cyr * 2), "en").when(least > 0, "mixed").when(cyr > 0, "ru").otherwise("en")
    if dialect == "any":
        return F.when(least > 0, "mixed").when(cyr > 0, "ru").when(lat > 0, "en").otherwise("unknown")
    if dialect == "head":
        return F.when((most > 0) & (least / F.greatest(most, F.lit(1)) > 0.20), "mixed").when(cyr > lat, "ru").otherwise("en")
    return F.when(cyr > 0, "ru").otherwise("en")


def canonical_language(value: Column | str, text: Column | str | None, seen: Column | None = None) -> Column:
    """F24. `seen` is the text's dominant language, where it is known already."""
    raw = F.translate(F.lower(F.trim(text_or_empty(value))), "-", "_")
    seen = once(lambda seen: F.when(raw.isin(*SEVERAL) & (seen == "unknown"), "mixed").otherwise(seen), seen=infer_language(text, "dominant") if seen is None else seen)
    return F.when(raw.isin(*RUSSIAN), "ru").when(raw.isin(*ENGLISH), "en").otherwise(seen)


def script_counts(c: Column | str) -> Column:
    """F25."""
    t = text_or_empty(c)
    cyr, lat = char_count(t, "[Ѐ-ԯ]"), char_count(t, LATIN)
    return F.struct(cyr.alias("cyrillic"), lat.alias("latin"), char_count(t, r"[\p{L}&&[^A-Za-zЀ-ԯ]]").alias("other_alpha"))


def char_entropy(c: Column | str) -> Column:
    """bits a character."""
    chars = F.array_remove(F.split(text_or_empty(c), ""), "")
    # runs of the sorted characters, from a text of them; only a run, of which there are few, is looked at by itself
    runs = lambda a: F.transform(F.regexp_extract_all(F.array_join(F.sort_array(a), ""), F.lit(r"(?s)((.)\2*)")), lambda x: F.length(x).cast("double"))
    bits = lambda n, runs: F.when(n == 0, 0.0).otherwise(F.log2(n) - F.aggregate(runs, F.lit(0.0), lambda s, x: s + x * F.log2(x)) / n)
    return once(lambda a: once(bits, n=F.size(a), runs=runs(a)), a=chars)


@F.pandas_udf(StringType())
def unescape(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Character references of HTML; some two thousand names, so not an expression."""
    for s in parts:
        yield s.map(lambda x: None if x is None else html.unescape(x))


_ENDED = re.compile(r"&(?:(#[0-9]+|#[xX][0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*));|&amp")


def _ended(m: re.Match) -> str:
    number, name = m.groups()
    if number or not name:
        return html.unescape(m[0])
    return html5.get(f"{name};", f"&{name.removeprefix('amp')};")


def unescape_ended_text(x: str) -> str:
    """The references of `html.unescape` that end in a semicolon, and the ampersand's without; others, as a cut text
    has at its end, stay."""
    return _ENDED.sub(_ended, x)


@F.pandas_udf(StringType())
def unescape_ended(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: None if x is None else unescape_ended_text(x))


def html_text(c: Column | str, entities: bool = True, ended: bool = False) -> Column:
    """visible text: entities first, so that what they spell is markup too; block tags separate words. With `ended`,
    entities need their semicolon, but for the ampersand's."""
    t = (unescape_ended if ended else unescape)(text_or_empty(c)) if entities else text_or_empty(c)
    for tag in ("script", "style", "noscript", "svg"):
        t = F.regexp_replace(t, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    t = F.regexp_replace(t, r"(?i)<(br|p|li|tr|td|th|h[1-6])\b[^>]*>", " ")
    return normalize(F.regexp_replace(t, "<[^>]+>", " "))


def html_title(c: Column | str, ended: bool = False) -> Column:
    """the first title's visible text."""
    return html_text(F.regexp_extract(text_or_empty(c), "(?is)<title[^>]*>(.*?)</title>", 1), ended=ended)


def _joined(plain: Callable[[str], str]):
    def one(b: str, hrefs: Sequence[str]) -> list[str]:
        out = []
        for h in hrefs:
            h = plain(h.strip())
            if not h or h.startswith(("#", "mailto:", "tel:", "javascript:")):
                continue
            try:
                out.append(urljoin(b or "", h))
            except ValueError:
                continue
        return out

    @F.pandas_udf(ArrayType(StringType()))
    def joined(base: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else one(b, h) for b, h in zip(base, links, strict=True)])

    return joined


def html_links(base: Column | str, c: Column | str, ended: bool = False) -> Column:
    """resolved targets of all hrefs in order, but fragments, mail, phone and script targets. `ended` as in
    `html_text`."""
    found = F.regexp_extract_all(text_or_empty(c), F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"))
    return _joined(unescape_ended_text if ended else html.unescape)(text_or_empty(base), found)


def url_parts(c: Column | str) -> dict[str, Column]:
    """Scheme in lower case, authority, path and query of a URL without its fragment."""
    u = F.regexp_replace(F.ltrim(text_or_empty(c)), "(?s)#.*$", "")
    whole = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?]*))?([^?]*)(?:\?(.*))?$"
    names = ("scheme", "netloc", "path", "query")
    parts = {n: F.regexp_extract(u, whole, i + 1) for i, n in enumerate(names)}
    return {**parts, "scheme": F.lower(parts["scheme"])}


def reencoded(c: Column) -> Column:
    """A query's key or value decoded and encoded again as in forms; broken escapes stay as they are."""
    plain = F.coalesce(F.try_url_decode(c), F.translate(c, "+", " "))
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(c: Column | str, drop: Sequence[str] = TRACKING) -> Column:
    """no fragment, no tracking parameters, the others encoded anew; empty unless http(s)."""
    u = url_parts(c)
    key = lambda p: F.lower(F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)))
    tracked = lambda p: sum((F.startswith(key(p), F.lit(d)).cast("int") for d in drop), F.lit(0)) > 0
    value = lambda p: F.when(F.instr(p, "=") > 0, F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")
    pairs = F.filter(F.split(u["query"], "&"), lambda p: (p != "") & ~tracked(p))
    query = F.array_join(F.transform(pairs, lambda p: F.concat(reencoded(F.substring_index(p, "=", 1)), F.lit("="), reencoded(value(p)))), "&")
    path = F.when((u["netloc"] != "") & (u["path"] != "") & ~u["path"].startswith("/"), F.concat(F.lit("/"), u["path"])).otherwise(u["path"])
    whole = F.concat(u["scheme"], F.lit(":"), F.when((u["netloc"] != "") | path.startswith("//"), F.concat(F.lit("//"), u["netloc"])).otherwise(""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(u["scheme"].isin("http", "https"), whole).otherwise("")


def url_host(c: Column | str) -> Column:
    """The host in lower case, without user and port."""
    return F.substring_index(F.substring_index(F.lower(url_parts(c)["netloc"]), "@", -1), ":", 1)


def allowed_url(c: Column | str, domains: Sequence[str] = (), prefixes: Sequence[str] = ()) -> Column:
    """a domain or its subdomain, and a path that is, or lies under, one of the prefixes if there are any. No
    domains allow all."""
    if not domains:
        return F.lit(True)
    host, path = url_host(c), url_parts(c)["path"]
    ok = sum((((host == d) | host.endswith("." + d)).cast("int") for d in domains), F.lit(0)) > 0
    if prefixes:
        ok = ok & (sum((((path == p) | path.startswith(p.rstrip("/") + "/")).cast("int") for p in prefixes), F.lit(0)) > 0)
    return ok


def skipped_url(c: Column | str, suffixes: Sequence[str] = (), parts: Sequence[str] = SKIPPED_PATHS) -> Column:
    """URLs that a crawl leaves out: not http(s), a path that ends with one of the suffixes or holds one of the parts."""
    u = url_parts(c)
    path = F.lower(u["path"])
    return ~u["scheme"].isin("http", "https") | (sum((path.endswith(x).cast("int") for x in suffixes), F.lit(0)) + sum((path.contains(x).cast("int") for x in parts), F.lit(0)) > 0)


@F.pandas_udf(StringType())
def _decoded(data: pd.Series, named: pd.Series) -> pd.Series:
    import re

    def one(raw: bytes | None, charset: str | None) -> str | None:
        if raw is None:
            return None
        meta = re.search(rb"charset\s*=\s*['\"]?([A-Za-z0-9_.-]+)", bytes(raw[:4096]), re.IGNORECASE)
        for encoding in (meta[1].decode("ascii") if meta else None, "utf-8", charset, "windows-1251", "latin-1"):
            try:
                if encoding:
                    return bytes(raw).decode(encoding)
            except (UnicodeDecodeError, LookupError):
                continue
        return bytes(raw).decode("utf-8", errors="replace")

    return pd.Series([one(d, n) for d, n in zip(data, named, strict=True)], dtype=object)


def decode_bytes(data: Column | str, charset: Column | str | None = None) -> Column:
    """F32: the charset that the page names (in any case), UTF-8, that of the response, Windows-1251, Latin-1; then the
    repair of F33."""
    return repair_mojibake(_decoded(as_column(data), as_column(charset) if charset is not None else F.lit(None).cast("string")))


def mark_count(c: Column | str, marks: Sequence[str]) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit("|".join(marks)))


def mojibake_score(c: Column | str) -> Column:
    """marks of wrongly decoded text."""
    return mark_count(c, CRAWL_MOJIBAKE)


def repair_mojibake(c: Column | str, least: int = 4) -> Column:
    """from `least` marks on, reread as UTF-8 what was read as Latin-1, if that leaves fewer marks, or as many and
    more Cyrillic. Null stays null."""
    t = as_column(c)
    fixed = F.try_validate_utf8(F.encode(F.when(t.rlike("^[\\x00-\\u00ff]*$"), t), "ISO-8859-1").cast("string"))
    rank = lambda x: F.struct(mojibake_score(x), -char_count(x, CYRILLIC))
    return F.when((mojibake_score(t) >= least) & fixed.isNotNull() & (rank(fixed) < rank(t)), fixed).otherwise(t)


def looks_corrupted(c: Column | str, least: int = 4) -> Column:
    """that many marks, or one pair that a misread quotation mark or dash leaves."""
    pairs = "|".join(f"â{x}" for x in AFTER_A)
    return (mark_count(c, TEXT_MOJIBAKE) >= least) | text_or_empty(c).rlike(pairs)


def looks_blocked(body: Column | str, title: Column | str, marks: Sequence[str] = BLOCKED_PAGE) -> Column:
    """F35."""
    head = F.lower(F.concat_ws(" ", text_or_empty(title), F.left(text_or_empty(body), F.lit(4000))))
    return sum((head.contains(m).cast("int") for m in marks), F.lit(0)) > 0


def sentence_gap(end: str) -> str:
    """White space behind an `end`. It begins with the white space, which is rarer than what may be an end's place."""
    one = SPACES.removesuffix("+")
    return f"{one}(?<={end}{one}){one}*"


def sentences(c: Column | str) -> Column:
    """F36."""
    return F.array_remove(F.split(F.trim(text_or_empty(c)), sentence_gap("[.!?]")), "")


def sentence_ends(c: Column | str) -> Column:
    """offset (characters from 0) behind each sentence and the white space that follows it."""
    # each match begins where the last one ended, so that a text without an end is read once
    parts = F.regexp_extract_all(text_or_empty(c), F.lit(r"(?sU)\G(.*?[.!?]\s+)"))
    step = lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + F.length(x)))
    return F.aggregate(parts, F.array().cast("array<int>"), step)


def inserted(carrier: Column, insertion: Column, place: Column) -> Column:
    """struct(text, start, stop): the insertion after `place` characters, between single spaces."""
    before, after = F.trim(F.left(carrier, place)), F.trim(F.substring(carrier, place + 1, F.length(carrier)))
    start = F.when(before == "", 0).otherwise(F.length(before) + 1)
    return F.struct(normalize(F.concat_ws(" ", before, insertion, after)).alias("text"), start.alias("start"), (start + F.length(insertion)).alias("stop"))


def draw(lo: Column, hi: Column, *key: Column | str) -> Column:
    """A seeded whole number from `lo` to `hi`, both included."""
    return (lo + F.pmod(stable_int(F.concat_ws(":", *(as_column(k).cast("string") for k in key))), F.greatest(hi - lo, F.lit(0)) + 1)).cast("int")


def embed(carrier: Column | str, insertion: Column | str, position: str = "middle", seed: int = 42) -> Column:
    """struct(text, start, stop) of normalised texts: at the prefix, the suffix, the sentence end nearest to the
    middle (moved by up to 80 characters, seeded), or deep: a seeded sentence end, or place, in the 35-75 %."""
    if position not in ("prefix", "suffix"):
        inside = lambda c, i: once(lambda c, i, ends: _embed_inside(c, i, ends, position, seed), c=c, i=i, ends=sentence_ends(c))
        return once(inside, c=normalize(carrier), i=normalize(insertion))
    c, i = normalize(carrier), normalize(insertion)
    if position == "prefix":
        return F.struct(F.concat_ws(" ", i, c).alias("text"), F.lit(0).alias("start"), F.length(i).alias("stop"))
    n = F.length(c)
    return F.struct(F.concat_ws(" ", c, i).alias("text"), (n + 1).alias("start"), (n + 1 + F.length(i)).alias("stop"))


def _embed_inside(c: Column, i: Column, ends: Column, position: str, seed: int) -> Column:
    n, key = F.length(c), (F.lit(seed), F.lit(position), c, i)
    half = F.floor(n / 2).cast("int")
    if position == "middle":
        nearest = lambda target, ends: F.array_min(F.transform(ends, lambda e: F.struct(F.abs(e - target).alias("d"), e.alias("e"))))["e"]
        best = once(nearest, target=half - draw(F.lit(-80), F.lit(80), *key), ends=ends)
        return inserted(c, i, F.coalesce(best, half))
    lo, hi = F.floor(n * 0.35).cast("int"), F.floor(n * 0.75).cast("int")
    deep = once(lambda ends, lo, hi: F.filter(ends, lambda e: (e >= lo) & (e <= hi)), ends=ends, lo=lo, hi=hi)
    place = F.when(F.size(deep) > 0, F.try_element_at(deep, draw(F.lit(1), F.size(deep), *key))).otherwise(draw(F.greatest(lo, F.lit(1)), F.greatest(lo + 1, hi), *key))
    return inserted(c, i, place)


#: Fixed value: token positions of an insertion and their weights in per cent.
TOKEN_POSITIONS = (("random", 65), ("beginning", 7), ("early", 7), ("middle", 7), ("late", 7), ("end", 7))


def token_position(key: Column, positions: Sequence[tuple[str, int]] = TOKEN_POSITIONS) -> Column:
    return weighted_choice(key, positions)


def insert_tokens(tokens: Column | str, insertion: Column | str, position: Column, key: Column) -> Column:
    """struct(tokens, start, stop) with the insertion among the tokens at a seeded place of the position's range:
    the first or last 64 tokens, the first or last third, a tenth about the middle, or anywhere. Null where either is
    empty."""

    def put(t: Column, i: Column, n: Column) -> Column:
        third, mid, reach = F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int"), F.greatest(F.floor(n / 10).cast("int"), F.lit(1))
        lo = F.when(position == "late", F.floor(2 * n / 3).cast("int")).when(position == "end", F.greatest(n - 64, F.lit(0))).when(position == "middle", F.greatest(mid - reach, F.lit(0))).otherwise(0)
        hi = F.when(position == "beginning", F.least(F.lit(64), n)).when(position == "early", third).when(position == "middle", F.least(mid + reach, n)).otherwise(n)
        value = once(lambda at: F.struct(F.concat(F.slice(t, F.lit(1), at), i, F.slice(t, at + 1, n)).alias("tokens"), at.alias("start"), (at + F.size(i)).alias("stop")), at=draw(lo, hi, key, position))
        return F.when((n > 0) & (F.size(i) > 0), value)

    return once(lambda t, i: once(lambda n: put(t, i, n), n=F.size(t)), t=as_column(tokens), i=as_column(insertion))


def _crop(t: Column, first: Column, size: Column) -> Column:
    """`size` characters from `first` on, moved left where the text ends before."""
    stop = F.least(F.length(t), first + size)
    return normalize(F.substring(t, F.greatest(stop - size, F.lit(0)) + 1, F.least(size, F.length(t))))


def crop_around(c: Column | str, start: Column, stop: Column, budget: int | Column) -> Column:
    """the normalised text cut to `budget` characters, or the span and 160 if that is more, with the span about in
    the middle; a text that fits stays whole."""
    t, span = normalize(c), F.greatest(stop - start, F.lit(0))
    size = F.greatest(F.lit(budget) if isinstance(budget, int) else budget, span + 160)
    return F.when(F.length(t) <= size, t).otherwise(_crop(t, F.greatest(start - F.floor((size - span) / 2).cast("int"), F.lit(0)), size))


def crop_with_context(c: Column | str, start: Column, stop: Column, budget: int, context: int, seed: int = 42) -> Column:
    """as `crop_around`, but with at least `context` characters before the span, and a seeded share of what is spare."""
    t, span = normalize(c), F.greatest(stop - start, F.lit(0))
    size = F.least(F.greatest(F.lit(budget), span + 2 * context), F.length(t))
    spare = F.greatest(size - span - 2 * context, F.lit(0))
    return F.when(F.length(t) <= size, t).otherwise(_crop(t, F.greatest(start - context - draw(F.lit(0), spare, F.lit(seed), t), F.lit(0)), size))


def crop_random(c: Column | str, budget: int, seed: int = 42) -> Column:
    """F42."""
    t = text_or_empty(c)
    spare = F.greatest(F.length(t) - budget, F.lit(0))
    start = F.pmod(stable_int(F.concat_ws(":", F.lit(seed), t)), spare + 1).cast("int")
    return F.substring(t, start + 1, F.lit(budget))


def fragment(c: Column | str, triggers: Sequence[str], most: int = 3) -> Column:
    """the first sentences with a trigger, 900 characters at most; else what surrounds the first trigger, from 220
    characters before to 680 after its start; else the first 700 characters."""

    def cut(t: Column, low: Column) -> Column:
        has = lambda s: once(lambda x: sum((F.contains(x, F.lit(w)).cast("int") for w in triggers), F.lit(0)) > 0, x=F.lower(s))
        with_trigger = F.array_join(F.slice(F.filter(F.array_remove(F.split(t, sentence_gap("[.!?。]")), ""), has), 1, most), " ")
        places = F.filter(F.array(*(F.instr(low, w) for w in triggers)), lambda p: p > 0)
        around = lambda first: F.substring(t, F.greatest(first - 220, F.lit(0)) + 1, first + 680 - F.greatest(first - 220, F.lit(0)))
        found = lambda first: once(lambda w: F.when(w != "", F.left(w, F.lit(900))).otherwise(around(first)), w=with_trigger)
        # sentences are cut only where a trigger stands
        return once(lambda first: F.when(first.isNull(), F.left(t, F.lit(700))).otherwise(once(found, first=first)), first=F.array_min(places) - 1)

    return once(lambda t: once(cut, t=t, low=F.lower(t)), t=normalize(c))


def vary(c: Column | str, replacements: Sequence[tuple[str, str]], variant: Column, wrappers: Sequence[tuple[int, str, str]] = ()) -> Column:
    """first hits of some replacements, chosen by the variant, and wrappers (every, before, after)."""
    t = text_or_empty(c)
    for i, (old, new) in enumerate(replacements):
        pick = F.pmod(stable_int(F.concat_ws(":", variant.cast("string"), F.lit(i))), F.lit(2)) == 0
        at = F.instr(t, old)
        t = F.when(pick & (at > 0), F.concat(F.left(t, at - 1), F.lit(new), F.substring(t, at + len(old), F.length(t)))).otherwise(t)
    for every, before, after in wrappers:
        t = F.when((variant > 0) & (variant % every == 0), F.concat(F.lit(before), t, F.lit(after))).otherwise(t)
    return t


def render(template: str, key: Column, **options: Sequence[str]) -> Column:
    """slots {name} filled from their lists, by the key."""
    import re

    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        else:
            values = F.array(*map(F.lit, options[piece]))
            parts.append(F.element_at(values, (F.pmod(stable_int(F.concat_ws(":", key.cast("string"), F.lit(piece))), F.size(values)) + 1).cast("int")))
    return F.concat(*parts)


def weighted_choice(key: Column, choices: Sequence[tuple[str, float]]) -> Column:
    """Q19: a choice by cumulative weight."""
    total, at, u = sum(w for _, w in choices), 0.0, unit(key)
    out = None
    for name, weight in choices[:-1]:
        at += weight / total
        out = F.when(u < at, name) if out is None else out.when(u < at, name)
    return F.lit(choices[-1][0]) if out is None else out.otherwise(choices[-1][0])


def first_turns(turns: Column | str, most: int = 1, roles: Sequence[str] = ("user", "human", "prompter")) -> Column:
    """the first user turns of array<struct<role, content>>, joined by blank lines."""
    said = F.filter(as_column(turns), lambda t: F.lower(t["role"]).isin(*roles) & (F.trim(F.coalesce(t["content"], F.lit(""))) != ""))
    return F.array_join(F.transform(F.slice(said, 1, most), lambda t: F.trim(t["content"])), "\n\n")


def has_words(c: Column | str) -> Column:
    """Whether there are tokens, told by the first of them."""
    return text_or_empty(c).rlike(f"[^{_SPACE}]")


def words(c: Column | str) -> Column:
    """White-space tokens; the stand-in for model tokens."""
    return F.array_remove(F.split(normalize(c), " "), "")


def extract_text(*columns: str, joined: Sequence[str] = ()) -> Column:
    """The first candidate column with text, else the joined columns as paragraphs."""
    filled = [F.when(F.trim(text_or_empty(c)) != "", F.col(c)) for c in columns]
    parts = F.concat_ws("\n\n", *(F.nullif(F.trim(text_or_empty(c)), F.lit("")) for c in joined))
    return F.coalesce(*filled, parts)


@F.pandas_udf(StringType())
def flatten_json(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All strings of a nested JSON value, depth first, as paragraphs."""
    import json

    def walk(x: object) -> Iterator[str]:
        if isinstance(x, str):
            if x.strip():
                yield x.strip()
        elif isinstance(x, dict):
            for v in x.values():
                yield from walk(v)
        elif isinstance(x, list):
            for v in x:
                yield from walk(v)

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        try:
            return "\n\n".join(walk(json.loads(s)))
        except ValueError:
            return s.strip()

    for s in parts:
        yield s.map(one)


def source_row_id(*columns: str) -> Column:
    """S18."""
    return F.coalesce(*(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns))
