"""Token windows, spans and visibility."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import WORD_CHARS, as_column, normalize, once, random_key, words

#: Tokens of a window and between window starts.
LENGTH, STRIDE = 254, 128


def window_count(n: Column | str, length: int = LENGTH, stride: int = STRIDE, empty: int = 0) -> Column:
    """Windows of `n` tokens; `empty` for none."""
    n = as_column(n)
    more = F.ceil((n - length) / stride)
    return F.when(n <= 0, empty).otherwise(1 + F.greatest(more, F.lit(0))).cast("int")


def window_starts(n: Column | str, length: int = LENGTH, stride: int = STRIDE, tail: str = "short") -> Column:
    """Starts of all windows; with a clamped tail the last window is full. No tokens, no windows."""
    n = as_column(n).cast("int")
    count = window_count(n, length, stride)
    start = (lambda i: i * stride) if tail == "short" else (lambda i: F.least(i * stride, F.greatest(n - length, F.lit(0))))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), start)).otherwise(F.array().cast("array<int>"))


def estimated_windows(text: Column | str, length: int = 190, stride: int = 95) -> Column:
    """By words, at least one."""
    return window_count(F.size(words(text)), length, stride, empty=1)


def explode_windows(docs: DataFrame, text_col: str = "text", length: int = LENGTH, stride: int = STRIDE, tail: str = "short", tokens: Column | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` with a row for each window: window_index, window_count, token_start, token_end, window_text.

    `tokens` is an array column; white-space tokens by default."""
    keep = list(keep if keep is not None else [c for c in docs.columns if c != text_col])
    t = docs.select(*keep, (tokens if tokens is not None else words(text_col)).alias("_tokens"))
    n = F.size("_tokens")
    count = window_count(n, length, stride)
    # indices alone, without a function of arrays: what Spark compiles leaves a document's tokens where they are, else each window had a copy of all
    indices = F.when(n > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    t = t.select(*keep, "_tokens", F.explode(indices).alias("window_index"))
    start = F.col("window_index") * stride
    t = t.withColumn("token_start", start if tail == "short" else F.least(start, F.greatest(n - length, F.lit(0))))
    end = F.least(F.col("token_start") + length, n)
    return t.select(*keep, "window_index", count.alias("window_count"), "token_start", end.alias("token_end"), F.array_join(F.slice("_tokens", F.col("token_start") + 1, length), " ").alias("window_text"))


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 512, stride: int = 448, most: int | None = None, min_chars: int = 1) -> DataFrame:
    """Chunks with ids that name their document."""
    t = explode_windows(docs, text_col, length, stride).where(F.length("window_text") >= min_chars)
    if most is not None:
        t = t.where(F.col("window_index") < most)
    chunk = F.concat_ws("#", F.col(id_col).cast("string"), F.col("window_index").cast("string"))
    return t.withColumn("original_document_id", F.col(id_col).cast("string")).withColumn("document_id", chunk).withColumn("text_hash", F.substring(F.sha2("window_text", 256), 1, 16))


def sample_windows(windows: DataFrame, per_document: int, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """A seeded choice of windows of each document."""
    order = W.partitionBy(id_col).orderBy(random_key(seed, id_col, "window_index"))
    return windows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_document).drop("_r")


def structured_indices(count: Column | str, most: int, seed: int = 42, key: Column | None = None, random_only: bool = False, thirds: bool = False) -> Column:
    """First, last and middle window, from 4 on the quartiles, from 10 on the quintiles (and thirds, if asked for), then
    seeded others up to `most`; where there are more than `most`, a seeded choice of them. In order."""
    n = as_column(count).cast("int")
    at = lambda a, b: F.floor(n * a / b).cast("int")
    none = F.array().cast("array<int>")
    fixed = none
    if not random_only:
        fixed = F.array(F.lit(0), n - 1, at(1, 2))
        fixed = F.concat(fixed, F.when(n >= 4, F.array(at(1, 4), at(3, 4))).otherwise(none), F.when(n >= 10, F.array(*(at(i, 5) for i in range(1, 5)))).otherwise(none))
        fixed = F.concat(fixed, F.array(at(1, 3), at(2, 3))) if thirds else fixed
    fixed = F.array_distinct(fixed)
    key = key if key is not None else F.lit("")
    seeded = lambda a: F.transform(F.array_sort(F.transform(a, lambda i: F.struct(random_key(seed, key, i).alias("h"), i.alias("i")))), lambda s: s["i"])
    lacks = F.greatest(F.least(F.lit(most), n) - F.size(fixed), F.lit(0))
    rest = F.when(lacks > 0, F.slice(seeded(F.array_except(F.sequence(F.lit(0), n - 1), fixed)), F.lit(1), lacks)).otherwise(none)
    chosen = F.when(F.size(fixed) > most, F.slice(seeded(fixed), 1, most)).otherwise(F.concat(fixed, rest))
    return F.when(n <= 0, none).otherwise(F.array_sort(chosen))


def best_window(scored: DataFrame, id_col: str = "doc_id", score_col: str = "score", keep: Sequence[str] = ()) -> DataFrame:
    """The highest score of each document; the first window on ties."""
    best = F.max(F.struct(F.col(score_col).alias("s"), (-F.col("window_index")).alias("i"), *keep)).alias("b")
    return scored.groupBy(id_col).agg(best, F.count("*").alias("window_count")).select(id_col, "window_count", F.col("b.s").alias("best_score"), (-F.col("b.i")).alias("best_window_index"), *(F.col(f"b.{c}").alias(c) for c in keep))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Tokens that two spans share."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def payload_forms(payload: Column | str, min_chars: int = 24) -> Column:
    """What `shows_text` looks for: struct(text, runs), the payload's form and, of up to ten of its words in a row with
    `min_chars` characters, the first that reach them: a longer run is there only if these are."""

    def forms(p: Column) -> Column:
        runs = lambda t: F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.array_join(F.slice(t, i, 10), " "))
        cut = lambda end, x: F.when(end > 0, F.substring(x, F.lit(1), end - 1)).otherwise(x)
        long = F.filter(once(runs, t=F.split(p, " ")), lambda x: F.length(x) >= min_chars)
        return F.struct(p.alias("text"), F.array_distinct(F.transform(long, lambda x: cut(F.locate(" ", x, min_chars + 1), x))).alias("runs"))

    return once(forms, p=F.lower(normalize(payload)))


def shows_text(window: Column | str, payload: Column | str, min_chars: int = 24, atoms: Sequence[str] = (), forms: Column | None = None) -> Column:
    """The window has the payload, or up to ten of its words in a row with `min_chars` characters, or an atom that the
    payload has too. Case and white space do not count. `forms` saves making the payload's forms for each window."""

    def seen(w: Column, f: Column) -> Column:
        atom = sum(((F.contains(f["text"], F.lit(a.lower())) & F.contains(w, F.lit(a.lower()))).cast("int") for a in atoms), F.lit(0)) > 0
        return (w != "") & (f["text"] != "") & (F.contains(w, f["text"]) | F.exists(f["runs"], lambda x: F.contains(w, x)) | atom)

    return once(seen, w=F.lower(normalize(window)), f=payload_forms(payload, min_chars) if forms is None else forms)


def visibility(shared: Column, total: Column, window_text: Column, text: Column, min_tokens: int = 8, min_chars: int = 24, atoms: Sequence[str] = (), forms: Column | None = None) -> Column:
    """struct(visibility, ratio) of a payload in a window: 'none' without shared tokens; from 85 % of them on 'full' if
    the text shows it; of a short payload only all of it counts; else 'partial_material' with `min_tokens` and the text.
    What the text does not show is 'partial_ambiguous'. The window's text is not looked at without shared tokens; `forms`
    are `payload_forms`."""
    ratio = F.coalesce(F.try_divide(shared, total), F.lit(0.0))
    seen = shows_text(window_text, text, min_chars, atoms, forms)
    kind = (
        F.when((total <= 0) | (shared <= 0), "none").when((shared >= total) | (ratio >= 0.85), F.when(seen, "full").otherwise("partial_ambiguous"))
        .when((total > min_tokens) & (shared >= min_tokens) & seen, "partial_material").otherwise("partial_ambiguous")
    )
    return F.struct(kind.alias("visibility"), F.when(total > 0, ratio).otherwise(0.0).alias("ratio"))


def fragment_visible(window: Column | str, payload: Column | str, shingle: int = 4, span: int = 24, step: int = 12) -> Column:
    """The window has the payload, or so many of its words of three characters or more in a row, or one of its
    character spans without white space."""

    def seen(w: Column, p: Column, tokens: Column, compact: Column, packed: Column) -> Column:
        shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - shingle + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, shingle), " "))
        spans = F.transform(F.sequence(F.lit(0), F.greatest(F.length(packed) - span, F.lit(0)), F.lit(step)), lambda i: F.substring(packed, i + 1, F.lit(span)))
        hit = F.contains(w, p) | ((F.size(tokens) >= shingle) & F.exists(shingles, lambda s: F.contains(w, s))) | ((F.length(packed) >= span) & F.exists(spans, lambda s: F.contains(compact, s)))
        return (w != "") & (p != "") & hit

    forms = lambda w, p: once(seen, w=w, p=p, tokens=F.regexp_extract_all(p, F.lit(f"({WORD_CHARS}{{3,}})")), compact=F.translate(w, " ", ""), packed=F.translate(p, " ", ""))
    return once(forms, w=F.lower(normalize(window)), p=F.lower(normalize(payload)))


#: Fixed value: the tokens that lexical overlap counts.
OVERLAP_TOKEN = "[A-Za-zА-Яа-яЁё0-9]+"


def lexical_overlap(text: Column | str, reference: Column | str) -> Column:
    """Share of the reference's words, repeated ones each, that the text has."""
    tokens = lambda c: F.regexp_extract_all(F.lower(normalize(c)), F.lit(f"({OVERLAP_TOKEN})"))
    share = lambda t, r: F.when(F.size(r) == 0, 0.0).otherwise(F.size(F.filter(r, lambda x: F.array_contains(t, x))) / F.size(r))
    return once(share, t=F.array_distinct(tokens(text)), r=tokens(reference))


def likely_windows(windows: DataFrame, likely: Column, id_col: str = "doc_id") -> DataFrame:
    """Of a document with several windows, those that are likely; all of them where none is."""
    w = W.partitionBy(id_col)
    some = F.max(likely.cast("int")).over(w)
    return windows.withColumn("_l", likely).withColumn("_s", some).where((F.col("_s") == 0) | F.col("_l")).drop("_l", "_s")


def apart(windows: DataFrame, min_gap: int, most: int, id_col: str = "doc_id", order: str = "score") -> DataFrame:
    """Greedily, by falling score, windows of a document whose starts are `min_gap` tokens apart. Documents are
    sorted, and their windows are read as they come; what is held is the places taken of one document."""
    score = F.col(order).cast("double")
    falling = F.when(~F.isnan(score), score).desc_nulls_last()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, taken = object(), []
        for batch in batches:
            keep = []
            for d, start in zip(batch.column(id_col).to_pylist(), batch.column("token_start").to_pylist(), strict=True):
                if d != doc:
                    doc, taken = d, []
                ok = len(taken) < most and all(abs(start - x) >= min_gap for x in taken)
                if ok:
                    taken.append(start)
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return windows.repartition(id_col).sortWithinPartitions(id_col, falling, "window_index").mapInArrow(pick, windows.schema)


def labelled_windows(docs: DataFrame, id_col: str = "doc_id", length: int = LENGTH, stride: int = STRIDE, keep: Sequence[str] = ()) -> DataFrame:
    """Windows of documents (id, tokens, payload, span_start, span_stop) with the payload's visibility and a
    label; windows in which it cannot be told are left out."""
    forms = docs.withColumn("_forms", payload_forms("payload"))
    w = explode_windows(forms, "text", length, stride, tokens=F.col("tokens"), keep=[id_col, "payload", "span_start", "span_stop", "_forms", *keep])
    shared = overlap(F.col("token_start"), F.col("token_end"), F.col("span_start"), F.col("span_stop"))
    seen = visibility(shared, F.col("span_stop") - F.col("span_start"), F.col("window_text"), F.col("payload"), forms=F.col("_forms"))
    w = w.select("*", F.inline(F.array(seen)).alias("visibility", "overlap_ratio")).drop("_forms")  # made once; the filter below would make it again
    return w.where("visibility <> 'partial_ambiguous'").withColumn("label", F.col("visibility").isin("full", "partial_material").cast("int"))


def inject(carriers: DataFrame, payloads: DataFrame, seed: int = 42, id_col: str = "doc_id", length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """Carriers (id, text) each with one payload (payload_id, payload) among its tokens; the windows of the
    injected document (visible ones positive) and those of the untouched carrier (negative), by shared carrier id.

    Payloads are dealt in cycles over the seeded order of the carriers (J11)."""
    from .joins import deal

    dealt = deal(carriers.select(id_col, "text"), payloads.select("payload_id", "payload"), seed, id_col, "payload_id")
    return inject_dealt(dealt, seed, id_col, length, stride).unionByName(untouched(carriers, id_col, length, stride))


_INJECTED = ("window_index", "token_start", "token_end", "window_text", "label", "visibility")


def inject_dealt(dealt: DataFrame, seed: int = 42, id_col: str = "doc_id", length: int = LENGTH, stride: int = STRIDE, keep: Sequence[str] = ()) -> DataFrame:
    """The windows of injected documents, of carriers that have their payload (id, text, payload_id, payload). Columns
    `keep` go along."""
    from ..functions.text import has_words, insert_tokens, token_position

    dealt = dealt.where(has_words("text") & has_words("payload"))  # a filter on what is made of them would make it twice
    t = dealt.withColumn("place", token_position(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), F.col("payload_id").cast("string"))))
    t = t.withColumn("i", insert_tokens(words("text"), words("payload"), F.col("place"), F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))))
    made = t.select(id_col, "payload_id", "place", "payload", F.col("i.tokens").alias("tokens"), F.col("i.start").alias("span_start"), F.col("i.stop").alias("span_stop"), *keep)
    hit = labelled_windows(made, id_col, length, stride, ["payload_id", "place", *keep])
    return hit.select(id_col, *_INJECTED, "payload_id", "place", F.when(F.col("label") == 1, "embedded_attack").otherwise("same_document_contrast").alias("component"), *keep)


def untouched(carriers: DataFrame, id_col: str = "doc_id", length: int = LENGTH, stride: int = STRIDE, keep: Sequence[str] = ()) -> DataFrame:
    """The windows of carriers as they are, with the columns of `inject_dealt`."""
    plain = explode_windows(carriers.select(id_col, "text", *keep), "text", length, stride).withColumn("label", F.lit(0)).withColumn("visibility", F.lit("none"))
    return plain.select(id_col, *_INJECTED, F.lit(None).cast("long").alias("payload_id"), F.lit(None).cast("string").alias("place"), F.lit("original_contrast").alias("component"), *keep)


def score_windows(windows: DataFrame, score, text_col: str = "window_text", eligible: Column | None = None) -> DataFrame:
    """`score` (texts -> scores, made anew by `score()` in each worker) over batches; only eligible rows
    reach it, the others get null."""

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = score()
        for s in parts:
            yield pd.Series(scorer(s), dtype="float64")

    if eligible is None:
        return windows.withColumn("score", run(F.col(text_col)))
    w = windows.withColumn("_e", eligible)
    return w.where("_e").withColumn("score", run(F.col(text_col))).unionByName(w.where("not coalesce(_e, false)").withColumn("score", F.lit(None).cast("double"))).drop("_e")
