"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import claim, clean_text, give_back, remembers

#: Characters of the longest n-gram; about how many labelled documents of a language are learned from, and how many of its distinct words, the most frequent, at most.
ORDER, TAUGHT, MOST_WORDS = 4, 800, 150_000
#: Bytes of the models' tables, which are broadcast, and languages; more is an error.
MOST_BYTES, MOST_LANGUAGES = 512 << 20, 2_000
#: One in so many of those documents is held out to calibrate rejection: a document is rejected if its best cross-entropy lies so many spreads above the language's median. A spread is the distance from the median that 1 % of the held-out documents, of all languages, exceed.
CALIBRATES, SPREADS, TAIL = 5, 5.0, 0.99
#: Sharpness of the score over cross-entropies in nats a character.
SHARP = 12.0
_WORDS = 100_000
_EDGE = "\x02"
_B = np.uint64(0x9E3779B97F4A7C15)


def letters(word: str) -> str:
    """A word's letters alone, in lower case."""
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()


def gram_hashes(words: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For every letter and closing edge of the words: hashes of the n-gram of each order that ends there (one
    that would begin before the opening edge begins at it), and the word's number."""
    padded = [_EDGE * (order - 1) + w + _EDGE for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(w) for w in padded], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = np.flatnonzero(inside >= order - 1)
    found, acc = [], np.zeros(len(ends), np.uint64)
    for n in range(1, order + 1):
        acc = acc * _B + codes[ends - (n - 1)]  # from the last character back, so that hash n extends hash n-1
        x = acc ^ (acc >> np.uint64(29))
        found.append((x * np.uint64(0xBF58476D1CE4E5B9)) ^ np.uint64(n))
    return found, owner[ends]


def context_hashes(words: list[str], order: int) -> list[np.ndarray]:
    """Hashes of the contexts (the n-gram without its last character) that belong to gram_hashes."""
    padded = [_EDGE * (order - 1) + w + _EDGE for w in words]
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(w) for w in padded], np.int64)
    inside = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ends = np.flatnonzero(inside >= order - 1)
    found, acc = [np.zeros(len(ends), np.uint64)], np.zeros(len(ends), np.uint64)
    for n in range(1, order):
        acc = acc * _B + codes[ends - n]
        x = acc ^ (acc >> np.uint64(29))
        found.append((x * np.uint64(0x94D049BB133111EB)) ^ np.uint64(n))
    return found


class Table:
    """Values by hash: sorted hashes and rows, found by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, row) for each key."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


class Models:
    """Interpolated Kneser-Ney models of all languages over words between edges, in one set of hash tables: a
    row has a column for each language."""

    def __init__(self, words: dict[str, Counter], order: int = ORDER):
        self.langs, self.order = sorted(words), order
        self.grams: list[Table] = []
        self.backoff: list[Table] = []
        self.letters = 1
        per = {lang: self._counts(words[lang]) for lang in self.langs}
        size = len(self.langs)
        every = [np.unique(np.concatenate([per[x][n][0] for x in self.langs])) if size else np.empty(0, np.uint64) for n in range(order)]
        self.letters = max(2, len(every[0]) + 1) if size else 2
        for n in range(order):
            contexts = np.unique(np.concatenate([per[x][n][1] for x in self.langs])) if size else np.empty(0, np.uint64)
            first, gamma = np.zeros((len(every[n]), size)), np.ones((len(contexts), size))
            for c, lang in enumerate(self.langs):
                keys, ctx, count = per[lang][n]
                if not len(keys):
                    continue
                once, twice = (count == 1).sum(), (count == 2).sum()
                discount = once / (once + 2 * twice) if once and twice else 0.5
                which, back = np.unique(ctx, return_inverse=True)
                total, kinds = np.bincount(back, count), np.bincount(back)
                first[np.searchsorted(every[n], keys), c] = (count - discount) / total[back]
                gamma[np.searchsorted(contexts, which), c] = discount * kinds / total
            self.grams.append(Table(every[n], first))
            self.backoff.append(Table(contexts, gamma))

    def _counts(self, words: Counter) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: n-grams, their contexts and counts; below the highest order a count is the number of
        characters seen before the n-gram."""
        listed = sorted(words)
        if not listed:
            return [(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0))] * self.order
        grams, owner = gram_hashes(listed, self.order)
        contexts = context_hashes(listed, self.order)
        times = np.array([words[w] for w in listed], float)[owner]
        out = []
        for n in range(self.order):
            if n == self.order - 1:
                keys, at, back = np.unique(grams[n], return_index=True, return_inverse=True)
                count = np.bincount(back, times)
            else:
                _, longer = np.unique(grams[n + 1], return_index=True)
                keys, at, count = np.unique(grams[n][longer], return_index=True, return_counts=True)
                at, count = longer[at], count.astype(float)
            out.append((keys, contexts[n][at], count))
        return out

    @property
    def bytes(self) -> int:
        return sum(t.keys.nbytes + t.values.nbytes for t in self.grams + self.backoff)

    def costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats of each word (closing edge included) in each language, and its characters."""
        grams, owner = gram_hashes(words, self.order)
        contexts = context_hashes(words, self.order)
        p = np.full((len(owner), len(self.langs)), 1.0 / self.letters)
        for n in range(self.order):
            known, at = self.backoff[n].find(contexts[n])
            gamma = np.where(known[:, None], self.backoff[n].values[at], 1.0) if len(self.backoff[n].keys) else 1.0
            hit, at = self.grams[n].find(grams[n])
            first = np.where(hit[:, None], self.grams[n].values[at], 0.0) if len(self.grams[n].keys) else 0.0
            p = first + gamma * p
        cost = np.zeros((len(words), len(self.langs)))
        for c in range(len(self.langs)):
            cost[:, c] = np.bincount(owner, -np.log(p[:, c]), len(words))
        return cost, np.bincount(owner, minlength=len(words))


class Scorer:
    """Cross-entropies of whole texts; costs of the first words seen are remembered."""

    def __init__(self, models: Models):
        self.models = models
        self.known: dict[str, int] = {}
        self.cost = np.zeros((1024, len(models.langs) + 1))

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Nats a character in each language; nan without letters."""
        width = len(self.models.langs)
        if len(self.known) > _WORDS:
            self.known.clear()
        split = [(t or "").split() for t in texts]
        new = list({w for ws in split for w in ws}.difference(self.known))
        if new:
            base = len(self.known)
            self.known.update(zip(new, range(base, base + len(new)), strict=True))
            while len(self.cost) < base + len(new):
                self.cost = np.concatenate([self.cost, np.zeros_like(self.cost)])
            self.cost[base : base + len(new)] = 0
            bare = [letters(w) for w in new]
            some = [i for i, w in enumerate(bare) if w]
            for at in range(0, len(some), 20_000):
                part = some[at : at + 20_000]
                cost, n = self.models.costs([bare[i] for i in part])
                rows = np.array(part) + base
                self.cost[rows, :width], self.cost[rows, width] = cost, n
        out = np.full((len(texts), width), np.nan)
        for i, ws in enumerate(split):
            if ws:
                total = self.cost[np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))].sum(0)
                if total[width]:
                    out[i] = total[:width] / total[width]
        return out


_last: list[Scorer] = []
remembers("language_id", _last.clear)


def scorer_of(models: Models) -> Scorer:
    """A worker's scorer, kept from task to task while the models are the same."""
    claim("language_id")
    if not _last or _last[0].models is not models:
        _last[:] = [Scorer(models)]
    return _last[0]


def forget() -> None:
    """A worker's scorer goes, and its memory with it."""
    _last.clear()
    give_back()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("language_id")
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found.update((lang, x) for w in text.split() if (x := letters(w)))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])


def labelled_sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About `per_language` documents of each language, by hash of the id; whole texts. Languages are few: a model is
    learned of each, so more than `MOST_LANGUAGES` are an error."""
    counts = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: these are no language labels")
    share = F.broadcast(labelled.sparkSession.createDataFrame([(r["lang"], per_language / r["count"]) for r in counts], "_lang string, _share double"))
    taken = labelled.join(share, F.col("lang") == F.col("_lang"))
    return taken.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("_share") * (1 << 30)).drop("_lang", "_share")


def learn(labelled: DataFrame, order: int = ORDER, per_language: int = TAUGHT, most_words: int = MOST_WORDS) -> tuple[Models, dict[str, float]]:
    """Models of the languages in `labelled` (doc_id, text, lang), and each one's rejection threshold.

    Words are counted by executors; the driver gets the most frequent distinct words of each language's bounded
    sample. Thresholds come from the cross-entropies of sampled documents that no model has seen."""
    sample = labelled_sample(labelled.where("lang is not null and text is not null").withColumn("text", clean_text("text")), per_language)
    unseen = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATES)) == 0
    counted = sample.where(~unseen).select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))
    counted = counted.withColumn("r", place).where(F.col("r") <= most_words).drop("r").toPandas()
    words: dict[str, Counter] = {}
    for lang, part in counted.groupby("lang"):
        words[str(lang)] = Counter(dict(zip(part["word"], part["n"].astype(int), strict=True)))
    models = Models(words, order)
    if models.bytes > MOST_BYTES:
        raise ValueError(f"models of {models.bytes} bytes for {len(words)} languages: lower per_language or most_words")
    if not words:
        return models, {}
    handed = sample.sparkSession.sparkContext.broadcast(models)
    langs = models.langs

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(handed.value)
        for batch in batches:
            h = scorer.texts(batch.column("text").to_pylist())
            h = h[~np.isnan(h[:, 0])]
            yield pa.RecordBatch.from_arrays([pa.array([langs[i] for i in h.argmin(1)], pa.string()), pa.array(h.min(1))], names=["lang", "h"])

    return models, limits_of(sample.where(unseen).select("text").mapInArrow(measure, "lang string, h double").toPandas(), langs)


def limits_of(seen: pd.DataFrame, langs: list[str]) -> dict[str, float]:
    """Rejection limits from the best cross-entropies (lang, h) of held-out documents. A language that none of them
    fell to gets the highest limit of the others; without any, nothing is rejected."""
    if not len(seen):
        return {lang: float("inf") for lang in langs}
    middle = seen.groupby("lang")["h"].median()
    spread = float(np.quantile(seen["h"] - seen["lang"].map(middle), TAIL))
    return {lang: float(middle.get(lang, middle.max())) + SPREADS * spread for lang in langs}


def identify(docs: DataFrame, models: Models, limits: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected, cross_entropy of each row.

    lang_pred is the language of the lowest cross-entropy a character, ties to the first in code-point order;
    'und' if the text is null or has no letter, or nothing was learned (score 0). rejected: 'und', or worse than
    its language's calibrated limit. Whole texts are read, invalid bytes as U+FFFD. Repeated rows are judged each; an
    empty table gives an empty result. Other columns are ignored."""
    langs = models.langs
    limit = np.array([limits.get(x, np.inf) for x in langs])
    handed = docs.sparkSession.sparkContext.broadcast(models)
    schema = "doc_id long, lang_pred string, score double, rejected boolean, cross_entropy double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(handed.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                pred, score, out, best = [], [], [], []
                h = scorer.texts(batch.column("text").to_pylist()) if langs else np.full((batch.num_rows, 1), np.nan)
                for row in h:
                    if np.isnan(row[0]):
                        pred.append("und"), score.append(0.0), out.append(True), best.append(None)
                        continue
                    i = int(row.argmin())
                    pred.append(langs[i]), score.append(float(1 / np.exp(-SHARP * (row - row[i])).sum()))
                    out.append(bool(row[i] > limit[i])), best.append(float(row[i]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_()), pa.array(best, pa.float64())], names=["doc_id", "lang_pred", "score", "rejected", "cross_entropy"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")).mapInArrow(run, schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame, per_language: int = TAUGHT) -> DataFrame:
    """doc_id, held_out, lang_pred, score and more for each row of `docs`, learned from those not held out (rows
    without text or lang teach nothing; a null doc_id is not held out). See `identify` for odd rows."""
    models, limits = learn(docs.where(~held_out()).select("doc_id", "text", "lang"), per_language=per_language)
    return identify(docs, models, limits).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def keep_identified(docs: DataFrame, per_language: int = TAUGHT) -> DataFrame:
    """`docs` without the documents that language identification rejects, all columns unchanged: those without a
    letter (null and empty texts too), and those far from every language learned. Where nothing was learned, as in a
    table without labels, none is kept. Repeated rows are judged each; an empty table gives an empty result."""
    models, limits = learn(docs.select("doc_id", "text", "lang"), per_language=per_language)
    handed = docs.sparkSession.sparkContext.broadcast((models, limits))

    @F.arrow_udf("boolean")
    def good(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, lim = handed.value
        scorer = scorer_of(m)
        top = np.array([lim[x] for x in m.langs])
        for s in parts:
            ok = []
            for at in range(0, len(s), 500):  # texts are Python's a slice at a time
                texts = s.slice(at, 500).to_pylist()
                h = scorer.texts(texts) if m.langs else np.full((len(texts), 1), np.nan)
                ok += [not np.isnan(r[0]) and bool(r.min() <= top[r.argmin()]) for r in h]
            yield pa.array(ok, pa.bool_())
        forget()  # the stages that follow begin in the JVM, beside this worker

    return docs.where(good(clean_text("text")))
