"""Bucketing, classification and text-quality features (B1-B33). Phrase tables are parameters."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_
from re import _parser as sre
from string import ascii_lowercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CYRILLIC, LATIN, SPACES, WORD_CHARS, as_column, char_count, hash_form, mark_count, normalize, normalize_compatible, once, safe_double, text_or_empty, words

# Edges and names of buckets.
LENGTH_BINS = ((128, "0000-0128"), (256, "0129-0256"), (512, "0257-0512"), (1024, "0513-1024"), (2048, "1025-2048"), (None, "2049+"))
WINDOW_BUCKETS = ((1, "1"), (4, "2-4"), (20, "5-20"), (50, "21-50"), (100, "51-100"), (None, "101+"))
SIZE_BUCKETS = ((1, "short"), (4, "medium"), (20, "long"), (None, "very_long"))
SMALL_COUNTS = ((0, "0"), (1, "1"), (2, "2"), (5, "3-5"), (10, "6-10"), (25, "11-25"), (50, "26-50"), (None, "51+"))
SHARES = ((0.01, "<=1%"), (0.05, "1-5%"), (0.10, "5-10%"), (0.25, "10-25%"), (0.50, "25-50%"))
_EIGHT = (0.01, 0.10, 0.50, 0.82, 0.95, 0.99, 0.999)
_EIGHT_NAMES = ("<0.01", "0.01-0.10", "0.10-0.50", "0.50-0.82", "0.82-0.95", "0.95-0.99", "0.99-0.999", ">=0.999")
SCORE_BANDS: dict[str, tuple[tuple[float, ...], tuple[str, ...]]] = {
    "eleven": ((0.001, 0.01, 0.10, 0.50, 0.82, 0.90, 0.95, 0.99, 0.999, 0.9995), ("<0.001", "0.001-0.01", "0.01-0.10", "0.10-0.50", "0.50-0.82", "0.82-0.90", "0.90-0.95", "0.95-0.99", "0.99-0.999", "0.999-0.9995", ">=0.9995")),
    "mined": ((0.82, 0.95, 0.99), ("below_target", "medium_hard_score_0.82_0.95", "hard_score_0.95_0.99", "very_hard_score_ge_0.99")),
    "critical": ((0.82, 0.95, 0.99, 0.999), ("score_lt_0.82", "score_0.82_0.95", "score_0.95_0.99", "score_0.99_0.999", "score_gte_0.999")),
    "failures": (_EIGHT[:6], (*_EIGHT_NAMES[:6], ">=0.99")),
    "regression": (_EIGHT, _EIGHT_NAMES),
    "strategy": (_EIGHT[:6], ("lt_0_01", "0_01_to_0_10", "0_10_to_0_50", "0_50_to_0_82", "0_82_to_0_95", "0_95_to_0_99", "ge_0_99")),
    "reviewer": (_EIGHT, _EIGHT_NAMES),
    "missed": ((0.95, 0.99, 0.999), ("v15_miss_below_0.95", "v15_miss_below_0.99", "v15_miss_below_0.999", "v15_not_missed")),
}
MOJIBAKE = ("Ð", "Ñ", "Â", "â€™", "â€œ", "â€", "\ufffd")
ZERO_WIDTH = "[​‌‍﻿⁠]"


def stepped(value: Column | str, edges: Sequence[tuple[float | None, str]]) -> Column:
    """The first bucket whose inclusive upper edge is not passed."""
    v, out = as_column(value), None
    for top, name in edges:
        hit = F.lit(True) if top is None else v <= top
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def length_bin(value: Column | str) -> Column:
    return stepped(value, LENGTH_BINS)


def window_count_bucket(value: Column | str) -> Column:
    return stepped(value, WINDOW_BUCKETS)


def window_count_bin(value: Column | str) -> Column:
    return stepped(value, ((1, "1"), (2, "2"), (3, "3"), (None, "4+")))


def size_bucket(value: Column | str) -> Column:
    return stepped(value, SIZE_BUCKETS)


def position_bucket(index: Column | str, count: Column | str, preset: str = "builder") -> Column:
    """B5."""
    i, n = as_column(index), as_column(count)
    ratio = i / F.greatest(n - 1, F.lit(1))
    if preset == "builder":
        return F.when(n <= 1, "single_window").when(i == 0, "first").when(i == n - 1, "last").when(ratio <= 0.33, "early").when(ratio >= 0.67, "late").otherwise("middle")
    return F.when(n <= 1, "only").when(i == 0, "first").when(i == n - 1, "last").when(ratio < 0.25, "early").when(ratio >= 0.75, "late").otherwise("middle")


def score_band(score: Column | str, preset: str = "eleven") -> Column:
    """Half-open bands; null has none."""
    edges, names = SCORE_BANDS[preset]
    s = as_column(score)
    out = F.when(s.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(edges, names, strict=False):
        out = out.when(s < edge, name)
    return out.otherwise(names[-1])


def boundary_band(score: Column | str, thresholds: Sequence[float], missed: bool) -> Column:
    """By a model's own thresholds: the lowest one that an attack misses, or the highest that a benign text reaches."""
    s, rising = as_column(score), sorted(thresholds)
    out = None
    for t in rising if missed else rising[::-1]:
        hit, name = (s < t, f"miss_below_{t:.3g}") if missed else (s >= t, f"fp_at_{t:.3g}")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("not_missed" if missed else "not_fp")


def score_weight(score: Column | str) -> Column:
    """B7."""
    s = as_column(score)
    return F.when(s < 0.82, 220).when(s < 0.95, 180).when(s < 0.99, 120).when(s < 0.999, 70).otherwise(20)


def share_bucket(share: Column | str) -> Column:
    """B8."""
    s = as_column(share)
    out = None
    for top, name in SHARES:
        out = F.when(s <= top, name) if out is None else out.when(s <= top, name)
    return out.when(s < 1, "50-<100%").otherwise("100%")


def hits(text: Column, phrases: Sequence[str]) -> Column:
    """How many phrases the (lower-cased) text contains."""
    if not phrases:
        return F.lit(0)
    return sum((F.contains(text, F.lit(p.lower())).cast("int") for p in phrases), F.lit(0))


def keyword_category(text: Column | str, table: Mapping[str, Sequence[str]], fallback: str) -> Column:
    """Most phrases contained; ties to the earlier category of the table."""
    t = F.lower(text_or_empty(text))
    best = F.greatest(*(F.struct(hits(t, p).alias("n"), F.lit(-i).alias("order"), F.lit(c).alias("c")) for i, (c, p) in enumerate(table.items())), F.struct(F.lit(0).alias("n"), F.lit(1).alias("order"), F.lit(fallback).alias("c")))
    return best["c"]


def word_category(text: Column | str, table: Mapping[str, Sequence[str]], fallback: str | None = None) -> Column:
    """Whole-word hits, then total length of the phrases hit, then category name (descending). A hyphen belongs to
    a word; white space in a phrase matches any."""
    import re

    t = F.lower(text_or_empty(text))

    def score(phrases: Sequence[str]) -> tuple[Column, Column]:
        flat = [" ".join(p.lower().split()) for p in phrases]
        flat = [p for p in flat if p]
        found = [t.rlike(rf"(?U)(^|[^\w-]){r'\s+'.join(map(re.escape, p.split()))}($|[^\w-])").cast("int") for p in flat]
        return sum(found, F.lit(0)), sum((f * len(p) for f, p in zip(found, flat, strict=True)), F.lit(0))

    best = F.greatest(*(F.struct(n.alias("n"), w.alias("w"), F.lit(c).alias("c")) for c, p in table.items() for n, w in [score(p)]), F.struct(F.lit(0).alias("n"), F.lit(0).alias("w"), F.lit("").alias("c")))
    return F.when(best["n"] > 0, best["c"]).otherwise(F.lit(fallback).cast("string"))


def weighted_category(text: Column | str, table: Mapping[str, Mapping[str, int]], least: int, trusted: Column | None = None) -> Column:
    """Sum of the weights of phrases contained; under `least` the trusted default, or null."""
    t = F.lower(text_or_empty(text))
    best = F.greatest(*(F.struct(sum((F.contains(t, F.lit(p.lower())).cast("int") * w for p, w in ps.items()), F.lit(0)).alias("s"), F.lit(-i).alias("order"), F.lit(c).alias("c")) for i, (c, ps) in enumerate(table.items())), F.struct(F.lit(-1).alias("s"), F.lit(0).alias("order"), F.lit("").alias("c")))
    return F.struct(F.when(best["s"] >= least, best["c"]).otherwise(trusted if trusted is not None else F.lit(None).cast("string")).alias("category"), best["s"].alias("score"))


def rule_category(text: Column | str, table: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> Column:
    """(strong, medium) phrases; 3 strong + medium, accepted with one strong or two medium; ties to the
    earlier category."""
    t = F.lower(text_or_empty(text))
    options = []
    for i, (c, (strong, medium)) in enumerate(table.items()):
        s, m = hits(t, strong), hits(t, medium)
        options.append(F.when((s >= 1) | (m >= 2), F.struct((3 * s + m).alias("s"), F.lit(-i).alias("order"), F.lit(c).alias("c"))))
    return F.array_max(F.array_compact(F.array(*options)))["c"]


def instructionality(text: Column | str, control: str, keywords: Sequence[str]) -> Column:
    """B13."""
    t = F.lower(text_or_empty(text))
    n = hits(t, keywords)
    return F.when(t.rlike(control), "model_control_attack_like").when(n >= 4, "strong_external_process_instruction").when(n >= 2, "medium_external_process_instruction").when(n >= 1, "weak_external_process_instruction").otherwise("non_instructional")


def text_form(text: Column | str, control: str, keywords: Sequence[str], wrappers: Sequence[str]) -> Column:
    """B14."""
    t, raw = F.lower(normalize(text)), text_or_empty(text)
    kind = instructionality(text, control, keywords)
    return (
        F.when(hits(t, wrappers) > 0, "wrapper_metadata_like").when(raw.rlike(r"(^|\n)\s*(\d+[).]|[-*•])\s+\S+"), "list_checklist")
        .when(t.rlike(r"(?U)\b(if|when|если|при условии|в случае)\b") & (kind != "non_instructional"), "conditional_procedural")
        .when(kind.isin("medium_external_process_instruction", "strong_external_process_instruction"), "instructional_procedural")
        .when(raw.rlike("[{};=<>]{8,}"), "code_config_like").when(F.size(words(raw)) <= 28, "short_command_like").otherwise("descriptive")
    )


def quality_parts(text: Column | str) -> Column:
    """What B15 counts, each once: struct(n, alpha, odd, tokens, kinds, markup)."""
    t = normalize(text)
    low = F.lower(t)
    tokens = F.regexp_extract_all(low, F.lit(f"({WORD_CHARS}{{2,}})"))
    return F.struct(
        F.length(t).alias("n"), char_count(t, r"\p{L}").alias("alpha"), char_count(t, r"[\p{C}\p{Zl}\p{Zp}[\p{Zs}&&[^ ]]]").alias("odd"),
        F.size(tokens).alias("tokens"), F.size(F.array_distinct(tokens)).alias("kinds"), F.regexp_count(low, F.lit(f"</?{WORD_CHARS}+" + r"|\{{2,}|\}{2,}|&[a-z]+;")).alias("markup"),
    )


def quality_of(parts: Column) -> Column:
    """B15 from `quality_parts`. The weights and limits."""
    n, many = F.greatest(parts["n"], F.lit(1)), F.greatest(parts["tokens"], F.lit(1))
    unique = parts["kinds"] / many
    score = 0.45 * (parts["alpha"] / n) + 0.35 * (1 - parts["odd"] / n) + 0.20 * F.least(F.lit(1.0), unique * 4)
    score = score - F.least(F.lit(0.35), parts["markup"] / many * 3) - 0.25 * ((unique < 0.08) & (parts["tokens"] > 120)).cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)) * (parts["n"] > 0).cast("double")


def quality_score(text: Column | str) -> Column:
    """B15. Nothing in it is conditional, so Spark computes each part once in compiled code."""
    return quality_of(quality_parts(text))


def script_letters(t: Column) -> tuple[Column, Column, Column]:
    """Cyrillic, Latin and other letters."""
    return char_count(t, "[\u0400-\u052f]"), char_count(t, LATIN), char_count(t, r"[\p{L}&&[^A-Za-z\u0400-\u052f]]")


def quality_flags(text: Column | str, language: Column | str, short: int = 8) -> Column:
    """Array of the flags raised."""
    t, lang = text_or_empty(text), F.lower(text_or_empty(language))
    bare = F.regexp_replace(t, r"(?U)^\s+|\s+$", "")
    cyr, lat, other = script_letters(t)
    letters, most = cyr + lat + other, F.greatest(cyr, lat)
    share = lambda x: x / F.greatest(letters, F.lit(1))
    flags = {
        "empty_text": bare == "", "very_short_text": (bare != "") & (F.length(bare) < short), "possible_mojibake": mark_count(t, MOJIBAKE) > 0, "zero_width_char": t.rlike(ZERO_WIDTH),
        "control_char": t.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"), "long_whitespace_run": t.rlike(r"(?U)\s{20,}"), "mixed_cyrillic_latin": (F.least(cyr, lat) > 0) & (F.least(cyr, lat) / F.greatest(most, F.lit(1)) >= 0.20),
        "language_ru_low_cyrillic": (lang == "ru") & (letters >= 20) & (share(cyr) < 0.30), "language_en_low_latin": (lang == "en") & (letters >= 20) & (share(lat) < 0.50),
    }
    return tags(**flags)


def phrase_families(text: Column | str, table: Mapping[str, Sequence[str]]) -> Column:
    """B17."""
    return once(lambda t: F.array_compact(F.array(*(F.when(hits(t, p) > 0, c) for c, p in table.items()))), t=hash_form(text))


#: Fixed values of B18: marks of each surface, in order, and the names of the ends.
STRUCTURED_FIELD = r"\b(metadata|instruction|system|assistant|developer)\s*[:=]"


def strength(text: Column | str, label: Column, table: Mapping[str, Sequence[str]], override: str, exfiltration: Sequence[str]) -> Column:
    """B18: 'benign_or_quoted' by label; else by the families of `table` that occur, `override` first, then any of
    `exfiltration`; else by length. NFKC texts are compared."""

    def named(t: Column) -> Column:
        bare = sum((hits(t, table[f]) for f in exfiltration), F.lit(0)) > 0
        return (
            F.when(hits(t, table[override]) > 0, "explicit_override").when(bare, "bare_or_exfiltration_command")
            .when(F.length(text_or_empty(text)) >= 1000, "long_jailbreak_or_document_attack").otherwise("other_attack")
        )

    return F.when(label == 0, "benign_or_quoted").otherwise(once(named, t=normalize_compatible(text)))


def surface(text: Column | str) -> Column:
    """The form of the text around a phrase."""
    form = lambda t, low: (
        F.when(t.contains("<!--") | t.contains("-->") | low.contains("<html"), "html_or_comment").when(t.contains("```") | t.contains("~~~"), "markdown_or_code_block")
        .when(low.rlike(STRUCTURED_FIELD), "metadata_or_structured_field").when(t.startswith("{") | t.startswith("["), "json_like")
        .when(t.contains("|") & t.contains("\n"), "table_like").when(low.contains("ocr") | low.contains("скан"), "ocr_like").otherwise("plain_text")
    )
    return once(lambda t: once(form, t=t, low=F.lower(t)), t=F.regexp_replace(text_or_empty(text), rf"^{SPACES}|{SPACES}$", ""))


def phrase_position(text: Column | str, phrases: Sequence[str]) -> Column:
    """Where the first phrase stands: in the first or last fifth, or between."""
    first = lambda t: F.array_min(F.filter(F.array(*(F.instr(t, p) for p in phrases)), lambda p: p > 0))
    at = once(lambda t: (first(t) - 1) / F.greatest(F.length(t), F.lit(1)), t=normalize_compatible(text))
    return once(lambda at: F.when(at.isNull(), "no_known_phrase").when(at < 0.20, "beginning").when(at > 0.80, "end").otherwise("middle"), at=at)


def quoted_or_discussed(text: Column | str, phrases: Sequence[str], markers: Sequence[str]) -> Column:
    """A marker, or a quotation mark within two characters of a phrase."""
    import re

    t = hash_form(text)
    body = "|".join(re.escape(p.lower()) for p in phrases) or "(?!)"
    return (hits(t, markers) > 0) | t.rlike(rf"[\"'«“„`].{{0,2}}({body})|({body}).{{0,2}}[\"'»”`]")


def evidence(text: Column | str, groups: Mapping[str, tuple[str, int]], combos: Sequence[tuple[str, str, str]] = (), metadata: Column | str | None = None, several: str = "multiple_pi_signals") -> Column:
    """struct(score, reasons): the weights of the pattern groups found, one more for two groups or more, and one for
    each combination (reason, pattern, pattern) of which both are found. Metadata count as text."""

    def scored(**seen: Column) -> Column:
        found = {name: seen[f"g{i}"] for i, name in enumerate(groups)}
        many = sum((c.cast("int") for c in found.values()), F.lit(0)) >= 2
        both = {name: seen[f"c{i}"] for i, (name, _, _) in enumerate(combos)}
        score = sum((found[n].cast("int") * w for n, (_, w) in groups.items()), F.lit(0)) + many.cast("int") + sum((c.cast("int") for c in both.values()), F.lit(0))
        return F.struct(score.alias("score"), tags(**found, **{several: many}, **both).alias("reasons"))

    # the text is put together once, and looked at once for each pattern
    look = lambda t: once(scored, **{f"g{i}": t.rlike("(?is)" + p) for i, (p, _) in enumerate(groups.values())}, **{f"c{i}": t.rlike(a) & t.rlike(b) for i, (_, a, b) in enumerate(combos)})
    return once(look, t=F.lower(F.concat_ws(" ", normalize(text), normalize(metadata) if metadata is not None else F.lit(""))))


#: Characters of which `folded` makes the same whatever form of them a pattern in any case fits.
PLAIN = frozenset(ascii_lowercase + digits + " ")
#: What Java reads otherwise than Python: back references, brackets in classes, and classes that begin with their end.
READ_OTHERWISE = re.compile(r"\\[0-9]|&&|\[\^?\]|\[[^\]]*\[")


def _needs(tree: Iterable) -> list[list[str]]:
    found, run = [], ""
    for op, arg in [*tree, (sre.AT, None)]:
        if op is sre.LITERAL and chr(arg).lower() in PLAIN:
            run += chr(arg).lower()
            continue
        found, run = found + [[run]] * bool(run), ""
        if op is sre.SUBPATTERN:
            found += _needs(arg[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
            found += _needs(arg[2])
        elif op is sre.BRANCH and all(ways := [_needs(way) for way in arg[1]]):
            found.append([text for way in ways for text in max(way, key=lambda texts: min(map(len, texts)))])
    return found


def needed_texts(pattern: str) -> list[list[str]]:
    """Lists of texts: what matches the pattern in any case has, folded, one of each list. None where that is not sure."""
    if READ_OTHERWISE.search(pattern):
        return []
    try:
        with warnings.catch_warnings(action="error"):
            return _needs(sre.parse(pattern))
    except (re.error, OverflowError, Warning):  # what only Java knows
        return []


def folded(text: Column | str) -> Column:
    """Lower case; the three letters beside the Kelvin sign that are forms of Latin ones in patterns, but not in lower case, become those."""
    t = text_or_empty(text)
    for odd, plain in (("\u017f", "s"), ("\u0131", "i"), ("\u0130", "i")):
        t = F.replace(t, F.lit(odd), F.lit(plain))
    return F.lower(t)


def any_pattern(text: Column | str, patterns: Sequence[str], low: Column | None = None) -> Column:
    """Any of the patterns, whatever the case of any script. A pattern is looked for only where the texts that
    its matches have are found, which is faster. `low` is the folded text, where it is made already."""
    t, needs = text_or_empty(text), {p: needed_texts(p) for p in patterns}
    if low is None and any(needs.values()):
        return once(lambda low: any_pattern(text, patterns, low), low=folded(text))

    def found(p: str) -> Column:
        texts = [reduce(or_, (F.contains(low, F.lit(x)) for x in ways)) for ways in needs[p]]
        return reduce(and_, [*texts, t.rlike(f"(?ius)(?:{p})")])

    return reduce(or_, map(found, patterns)) if patterns else F.lit(False)


def anchored(text: Column | str, positive: Sequence[str], negated: str, veto: bool = False, low: Column | None = None) -> Column:
    """A positive pattern outside negated spans; with `veto` any negated span rules the text out."""
    t, hit, ruled = text_or_empty(text), any_pattern(text, positive, low), any_pattern(text, [negated], low)
    if veto:
        return ~ruled & hit
    # without the spans the text is another, so its texts are looked for anew; most texts have no such span
    return F.when(ruled, any_pattern(F.regexp_replace(t, "(?ius)" + negated, " "), positive)).otherwise(hit)


def target_and_frame(text: Column | str, target: str, verb: str, frame: str, fields: Sequence[str] = (), formats: Sequence[str] = ("json", "yaml", "internal"), least: int = 3) -> Column:
    """A target with a verb or a frame, or some named fields with the name of a format."""
    t = text_or_empty(text)
    low = F.lower(t)
    return (F.trim(t) != "") & ((t.rlike("(?iu)" + target) & (t.rlike("(?iu)" + verb) | t.rlike("(?iu)" + frame))) | ((hits(low, fields) >= least) & (hits(low, formats) > 0)))


def first_match(text: Column | str, table: Mapping[str, str], fallback: str) -> Column:
    """The first pattern that matches names the class."""
    t = F.lower(text_or_empty(text))
    return F.coalesce(*(F.when(t.rlike(p), c) for c, p in table.items()), F.lit(fallback))


def tags(**conditions: Column) -> Column:
    """Names of the conditions that hold."""
    return F.array_compact(F.array(*(F.when(c, n) for n, c in conditions.items())))


def trigger_density(text: Column | str, patterns: Mapping[str, str]) -> Column:
    """struct(count, density, names)."""
    t = text_or_empty(text)
    counts = {n: F.regexp_count(t, F.lit("(?ius)" + p)) for n, p in patterns.items()}
    total = sum(counts.values(), F.lit(0))
    return F.struct(total.alias("count"), (total / F.greatest(F.size(words(t)), F.lit(1))).alias("density"), tags(**{n: c > 0 for n, c in counts.items()}).alias("names"))


#: What shows that a text is data or code rather than prose.
ARTIFACTS = {
    "hex_hash": r"\b[a-fA-F0-9]{16,}\b",
    "float_sequence": r"\b\d+\.\d+(?:\s*,\s*\d+\.\d+){2,}\b",
    "json_like": r"[{}\[\]]\s*['\"]?\w+['\"]?\s*:",
    "route_like": r"\b(?:GET|POST|PUT|PATCH|DELETE)\s+/[A-Za-z0-9_./{}-]+",
    "sql_like": r"\b(?:SELECT|INSERT|UPDATE|DELETE|DROP|UNION)\b.{0,80}\b(?:FROM|WHERE|TABLE|VALUES)\b",
}


def artifacts(text: Column | str, patterns: Mapping[str, str] = ARTIFACTS) -> Column:
    """struct(score, hits, digit_share, symbol_density, urls): 1 for a pattern, over 20 % digits or over 12 % symbols of code."""
    t = text_or_empty(text)
    n = F.greatest(F.length(t), F.lit(1))
    digits, symbols = char_count(t, r"\p{Nd}") / n, char_count(t, r"[{}\[\]();=<>|`]") / n
    found = tags(**{name: t.rlike("(?isU)" + p) for name, p in patterns.items()})
    score = ((F.size(found) > 0) | (digits > 0.20) | (symbols > 0.12)).cast("int")
    return F.struct(score.alias("score"), found.alias("hits"), digits.alias("digit_share"), symbols.alias("symbol_density"), F.regexp_count(t, F.lit(r"(?iU)https?://\S+")).alias("urls"))


def language_mismatch(language: Column | str, text: Column | str) -> Column:
    """B29."""
    t, lang = text_or_empty(text), F.lower(text_or_empty(language))
    belied = lambda n, cyr, lat: _belied(lang, cyr / n, lat / n)
    return lang.isin("ru", "en", "mixed") & once(belied, n=F.greatest(char_count(t, r"\p{L}"), F.lit(1)), cyr=char_count(t, CYRILLIC), lat=char_count(t, LATIN))


def _belied(lang: Column, cyr: Column, lat: Column) -> Column:
    return ((lang == "ru") & (lat > 0.55) & (cyr < 0.30)) | ((lang == "en") & (cyr > 0.40)) | ((lang == "mixed") & ((lat < 0.05) | (cyr < 0.05)))


#: Tokens that anomalies are counted by, marks of misread text, and the weights of the scores.
ANOMALY_TOKEN = r"[A-Za-zА-Яа-яЁё<>@:/._-]+|\d+"
ANOMALY_MOJIBAKE = ("Ð", "Ñ", "\ufffd", "Â", "Ã")
ANOMALY_WEIGHTS = {
    "template_repetition": 3, "trigger_density": 2, "benign_negation": 2, "mixed_language": 2, "metadata_scaffold": 2, "short_high_score": 2, "numeric_code": 2, "label_contamination": 5,
}


def anomaly_scores(text: Column | str, score: Column | str, repeats: Mapping[str, Column], patterns: Mapping[str, Mapping[str, str]]) -> Column:
    """Struct of the component scores. `repeats` has the counts normalized, prefix and suffix of N5; `patterns` the
    named patterns triggers, negations, scaffolds and contaminations."""
    t = text_or_empty(text)
    count = lambda kind: sum((F.regexp_count(t, F.lit("(?is)" + p)) for p in patterns.get(kind, {}).values()), F.lit(0))

    def parts(tokens: Column, letters: Column, triggers: Column) -> Column:
        mixed = (char_count(t, LATIN) / letters >= 0.10) & (char_count(t, CYRILLIC) / letters >= 0.10)
        out = {
            "template_repetition": (repeats["normalized"] > 3).cast("int") + (repeats["prefix"] > 10).cast("int") + (repeats["suffix"] > 10).cast("int"),
            "trigger_density": (triggers / F.greatest(tokens, F.lit(1)) >= 0.05).cast("int"), "benign_negation": (count("negations") > 0).cast("int"), "mixed_language": mixed.cast("int"),
            "metadata_scaffold": F.least(F.lit(3), count("scaffolds")), "short_high_score": ((tokens < 20) & (safe_double(score) > 0.95) & (triggers == 0)).cast("int"),
            "numeric_code": artifacts(t)["score"], "label_contamination": (count("contaminations") > 0).cast("int"),
        }
        return F.struct(*(c.alias(n) for n, c in out.items()))

    return once(parts, tokens=F.regexp_count(t, F.lit(ANOMALY_TOKEN)), letters=F.greatest(char_count(t, r"\p{L}"), F.lit(1)), triggers=count("triggers"))


def anomaly(parts: Column, text: Column | str, score: Column | str, language: Column | str, markers: Mapping[str, str] | None = None) -> Column:
    """struct(score, bucket) from `anomaly_scores`: the weighted scores, the markers (phrases, 4 at most), misread text, a
    language that the script belies, and a very high model score."""
    t = text_or_empty(text)
    marked = sum((F.contains(F.lower(t), F.lit(m.lower())).cast("int") for m in (markers or {}).values()), F.lit(0))
    total = sum((parts[n] * w for n, w in ANOMALY_WEIGHTS.items()), F.lit(0)) + F.least(F.lit(4), marked)
    total = total + F.when(mark_count(t, ANOMALY_MOJIBAKE) > 0, 3).otherwise(0) + F.when(language_mismatch(language, t), 2).otherwise(0) + (safe_double(score) >= 0.999).cast("int")
    bucket = (
        F.when(parts["label_contamination"] > 0, "label_contamination_candidate").when(parts["short_high_score"] > 0, "short_structured_high_score").when(parts["numeric_code"] > 0, "numeric_code_artifact")
        .when((parts["template_repetition"] >= 2) & (parts["benign_negation"] > 0), "template_boilerplate_artifact").when(parts["benign_negation"] > 0, "prompt_security_negation_artifact")
        .when((parts["mixed_language"] > 0) & (parts["trigger_density"] > 0), "mixed_language_template").when(parts["template_repetition"] >= 2, "template_boilerplate_artifact").otherwise("ordinary_false_positive")
    )
    return F.struct(total.alias("score"), bucket.alias("bucket"))


def source_family(source: Column | str, origin: Column | str | None = None) -> Column:
    """A name that names a document stands for itself; an origin on a hub gives its owner and name; else the source."""
    named = F.coalesce(F.nullif(text_or_empty(source), F.lit("")), F.lit("unknown"))
    from_ = F.coalesce(F.nullif(text_or_empty(origin), F.lit("")), named) if origin is not None else named
    return F.when(named.contains(":doc:"), named).when(from_.startswith("hf://"), F.array_join(F.slice(F.split(from_, "/"), 1, 4), "/")).otherwise(named)


def generated_reason(markers: Sequence[str], *metadata: Column | str) -> Column:
    """The first marker in the metadata, else null."""
    blob = F.lower(F.concat_ws(" ", *(as_column(c).cast("string") for c in metadata)))
    return F.coalesce(*(F.when(F.contains(blob, F.lit(m.lower())), m) for m in markers), F.lit(None).cast("string"))


def default_bucket(label: Column, source: Column | str, table: Mapping[str, str]) -> Column:
    """By source where the table names it, else by label."""
    s = text_or_empty(source)
    named = F.coalesce(*(F.when(s == k, v) for k, v in table.items()), F.lit(None).cast("string"))
    return F.coalesce(named, F.when(label == 1, "direct_attack").otherwise("benign_document"))
