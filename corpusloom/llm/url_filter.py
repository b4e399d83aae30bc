"""URL filtering: rules first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import char_entropy
from ._common import clean_text

#: Labelled URLs that the trees are fitted on, at most about so many; chosen by hash of the URL.
FITTED = 20_000
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "params", "query_length", "is_https", "has_extension", "suffix1", "suffix2", "longest_label", "first_dir", "host_hyphens")


@dataclass(frozen=True)
class Rule:
    """`host` and the start of the path; `verdict` allow or block."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then up to `?`, `#`
    or the end. Null, or no `://`: both empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_column(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. The rules are a short configuration."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def features(url: Column, host: Column, path: Column) -> list[Column]:
    """Lexical features; the suffixes and the first directory are strings, encoded by their labelled rates."""
    url = F.coalesce(url, F.lit(""))
    length = F.length(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return [
        length, F.length(host), F.length(path), F.size(F.filter(F.split(path, "/"), lambda x: x != "")), F.size(labels),
        F.regexp_count(url, F.lit("[0-9]")) / F.greatest(length, F.lit(1)), F.regexp_count(url, F.lit("-")), char_entropy(url),
        F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))), F.length(query), url.startswith("https"), path.rlike(r"\.[A-Za-z0-9]{1,5}$"),
        F.element_at(labels, -1), F.substring_index(host, ".", -2), F.array_max(F.transform(labels, F.length)), F.regexp_extract(path, "^/([^/]*)", 1), F.regexp_count(host, F.lit("-")),
    ]


def weak_labels(urls: DataFrame, rules: Sequence[Rule], words: Sequence[str], url_col: str = "url") -> DataFrame:
    """(url, blocked): a rule's verdict where one fits, else block if a word of the host is on the list of known bad
    host words, else allow: labels where no people labelled. The trees see none of the words, only lexical features."""
    host, path = url_parts(F.col(url_col))
    ruled = rule_column(host, path, rules)["verdict"]
    bad = F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words))) if words else F.lit(False)
    return urls.select(F.col(url_col).alias("url"), F.coalesce((ruled == "block").cast("int"), bad.cast("int")).alias("blocked"))


NAMED = ("suffix1", "suffix2", "first_dir")


@dataclass
class Trees:
    """Gradient-boosted regression trees on the logistic loss, with histogram splits."""

    rounds: int = 40
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    least: int = 5
    prior: float = 0.0
    edges: list = field(default_factory=list)
    trees: list = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1) if len(x) else np.zeros(x.shape, int)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        rate = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
        self.prior = float(np.log(rate / (1 - rate)))
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) if len(x) else np.empty(0) for j in range(x.shape[1])]
        b, margin = self.binned(x), np.full(len(x), self.prior)
        for _ in range(self.rounds if len(set(y.tolist())) > 1 else 0):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(b, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(tree, b)
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple]:
        """Nodes in heap order: (feature, bin) sends bins up to `bin` left; (-1, value) is a leaf."""
        tree: list[tuple] = [(-1, 0.0)] * (2 ** (self.depth + 1))
        work = [(1, np.arange(len(g)))]
        while work:
            at, rows = work.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            tree[at] = (-1, float(-self.rate * gs / (hs + 1.0)))
            if at >= 2**self.depth or len(rows) < 2 * self.least:
                continue
            top = (1e-6, 0, 0)
            for j in range(b.shape[1]):
                size = len(self.edges[j]) + 1
                n = np.bincount(b[rows, j], minlength=size).cumsum()[:-1]
                gl = np.bincount(b[rows, j], g[rows], size).cumsum()[:-1]
                hl = np.bincount(b[rows, j], h[rows], size).cumsum()[:-1]
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(n < self.least) | (len(rows) - n < self.least)] = 0
                if len(gain) and gain.max() > top[0]:
                    top = (gain.max(), j, int(gain.argmax()))
            if top[0] > 1e-6:
                tree[at] = (top[1], top[2])
                left = b[rows, top[1]] <= top[2]
                work += [(2 * at, rows[left]), (2 * at + 1, rows[~left])]
        return tree

    def _leaf(self, tree: list[tuple], b: np.ndarray) -> np.ndarray:
        feature, value = np.array([t[0] for t in tree]), np.array([t[1] for t in tree])
        at = np.ones(len(b), int)
        for _ in range(self.depth):
            f = feature[at]
            go = f >= 0
            right = b[np.arange(len(b)), np.maximum(f, 0)] > value[at]
            at = np.where(go, 2 * at + right, at)
        return value[at]

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        margin = np.full(len(x), self.prior)
        for tree in self.trees:
            margin += self._leaf(tree, b)
        return 1 / (1 + np.exp(-margin))


@dataclass
class UrlModel:
    trees: Trees
    rates: dict[str, dict[str, float]]

    def matrix(self, f: pd.DataFrame) -> np.ndarray:
        cols = [f[c].map(self.rates[c]).fillna(self.rates[c][""]) if c in NAMED else f[c] for c in FEATURES]
        return np.stack([c.astype(float).to_numpy() for c in cols], 1) if len(f) else np.zeros((0, len(FEATURES)))


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", most: int = FITTED) -> UrlModel:
    """Fit on about `most` of the `labelled` URLs (label 1: block), chosen by hash of the URL. Repeated URLs
    count once with each label. No rows: a model that blocks nothing."""
    rows = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(clean_text(url_col).alias("url"), F.col(label_col).cast("int").alias("y"))
    share = min(1.0, most / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    host, path = url_parts(F.col("url"))
    got = rows.select("url", "y", *(c.alias(n) for c, n in zip(features(F.col("url"), host, path), FEATURES, strict=True))).toPandas()
    got = got.sort_values(["url", "y"]).reset_index(drop=True)
    y = got["y"].to_numpy(float)
    mean = y.mean() if len(y) else 0.0
    rates = {}
    for c in NAMED:
        per = got.groupby(c)["y"].agg(["sum", "count"])
        rates[c] = {**{str(k): (s + 5 * mean) / (n + 5) for k, s, n in per.itertuples() if n >= 3}, "": mean}
    model = UrlModel(Trees(), rates)
    model.trees.fit(model.matrix(got), y)
    return model


#: Models of a cross-fit; each judges the hosts that it was not fitted on.
FOLDS = 2


def fold_of(host: Column, folds: int = FOLDS) -> Column:
    """The fold of a host by its longest label, so that its subdomains (www, m, ...) share it."""
    longest = F.array_max(F.transform(F.split(host, r"\."), lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    return F.pmod(F.xxhash64(longest), F.lit(folds)).cast("int")


def cross_fit(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", folds: int = FOLDS, most: int = FITTED) -> list[UrlModel]:
    """For each fold the model fitted on the hosts of the others, at most about `most` URLs each."""
    host, _ = url_parts(F.col(url_col))
    return [fit(labelled.where(fold_of(host, folds) != i), url_col, label_col, most) for i in range(folds)]


def filter_urls(pages: DataFrame, rules: Sequence[Rule], models: UrlModel | Sequence[UrlModel], id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, probability of each row of `pages`.

    The longest fitting rule decides; else the trees: block at `threshold` or more. With several `models`, of a
    cross-fit, each URL is judged by the one that did not see its host. A null URL, or one without
    `://`, has empty parts, fits no rule, and is judged by the trees on its (empty) parts. URLs of any length are
    judged whole, invalid bytes as U+FFFD. Repeated rows are judged each; an empty table gives an empty result; other
    columns are ignored."""
    models = [models] if isinstance(models, UrlModel) else list(models)
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), clean_text(url_col).alias("url"))
    host, path = url_parts(F.col("url"))
    base = base.select("page_id", "url", host.alias("host"), path.alias("path"))
    handed = pages.sparkSession.sparkContext.broadcast(models)

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in parts:
            probability = np.zeros(len(f))
            for i, model in enumerate(handed.value):
                mine = (f["fold"] == i).to_numpy()
                probability[mine] = model.trees.probability(model.matrix(f[mine]))
            yield f[["page_id", "host", "path", "rule", "ruled"]].assign(probability=probability)

    cols = [c.alias(n) for c, n in zip(features(F.col("url"), F.col("host"), F.col("path")), FEATURES, strict=True)]
    base = base.withColumn("r", rule_column(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("ruled"), fold_of(F.col("host"), len(models)).alias("fold"), *cols)
    judged = base.mapInPandas(judge, "page_id long, host string, path string, rule string, ruled string, probability double")
    own = F.when(F.col("probability") >= threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "probability")
