"""Toxicity by classifier chains.

Categories are predicted one after another by linear models over word features;
each model also sees the probabilities of the categories before it. While
fitting, those probabilities are out-of-fold: documents are dealt into folds by
id, and the probability given to a later model comes from an earlier model that
did not see the document. The last category, ``toxic``, is the label itself; its
threshold is calibrated on the out-of-fold probabilities.

The label table names one flag only, so the earlier categories are marked among
the toxic documents by small word lists (parameter ``categories``).

Fitting uses a bounded sample of labelled documents (``max_rows``, by id hash),
broadcast as (id, label): its size is fixed by the parameter, and the documents
are not shuffled. Features are words and word beginnings of 4 and 5 letters; every
one that tells the kinds apart is kept (chi-square on document counts, summed in
Spark, with the correction for small counts, ``min_chi`` at least: one in a
thousand by chance), so the sample alone bounds their number. All documents are scored.

Defined results: a null or empty text has no features; without labels of both
kinds every probability is 0 and nothing is toxic; a document labelled more than
once is toxic if any label says so; null labels are ignored; an id with several
texts is fitted on the least of them; repeated rows are scored row by row; extra
columns stay (one named like an output is replaced).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqwise.llm.common import batches_by_bytes, staged, texts_of, with_text, without_text

WORD = re.compile(r"\w+")
# Seed words of the categories before the label.
CATEGORIES = {
    "insult": ("idiot", "moron", "loser", "clown", "scum", "trash"),
    "demeaning": ("stupid", "pathetic", "worthless", "disgusting"),
}
FOLDS = 3


def features_of(word: str) -> tuple[str, ...]:
    """A word's features: itself, and its beginnings of 4 and 5 letters."""
    if len(word) < 4:
        return (word,)
    return (word, word[:4] + "*", word[:5] + "*") if len(word) > 4 else (word, word + "*")


def doc_features(text: str) -> set[str]:
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        out.update(features_of(w))
    return out


@dataclass
class Chain:
    """Feature numbers and, per category, (weights, weights of the earlier
    probabilities, intercept)."""
    vocabulary: dict[str, int] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)
    models: list[tuple[np.ndarray, np.ndarray, float]] = field(default_factory=list)
    threshold: float = 2.0

    def numbers(self, text: str, cache: dict[str, tuple[int, ...]]) -> list[int]:
        found: set[int] = set()
        for w in set(WORD.findall(text.lower())):
            got = cache.get(w)
            if got is None:
                got = tuple(self.vocabulary[f] for f in features_of(w) if f in self.vocabulary)
                if len(cache) >= 200_000:
                    cache.clear()
                cache[w] = got
            found.update(got)
        return sorted(found)

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        """(documents, categories)."""
        out = np.zeros((len(rows), len(self.names)))
        for k, (w, v, b) in enumerate(self.models):
            score = np.array([w[r].sum() if r else 0.0 for r in rows]) + b
            out[:, k] = _sigmoid(score + out[:, :k] @ v)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(rows: list[list[int]], more: np.ndarray, y: np.ndarray, n_features: int, l2: float = 1e-4,
             steps: int = 300) -> tuple[np.ndarray, np.ndarray, float]:
    """L2-penalised logistic model on sparse 0/1 rows and dense ``more``
    columns, by accelerated gradient steps."""
    flat = np.fromiter((f for r in rows for f in r), np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    k, n = more.shape[1], max(len(rows), 1)
    w = np.zeros(n_features + k + 1)
    ahead, rate = w.copy(), 4.0 / (1 + k + (len(flat) / n) / 4)
    for step in range(steps):
        s = np.bincount(doc, ahead[flat], len(rows)) + more @ ahead[n_features:-1] + ahead[-1]
        e = (_sigmoid(s) - y) / n
        g = np.concatenate([np.bincount(flat, e[doc], n_features), e @ more, [e.sum()]])
        g[:-1] += l2 * ahead[:-1]
        new = ahead - rate * g
        ahead, w = new + step / (step + 3) * (new - w), new
    return w[:n_features], w[n_features:-1], float(w[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the widest gap with the fewest errors (the highest if several)."""
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    low, high = np.concatenate([[0.0], p]), np.concatenate([p, [1.0]])
    least = errors[high > low].min()
    gap = np.where(errors == least, high - low, -1.0)
    at = int(np.flatnonzero(gap == gap.max())[-1])
    return float((low[at] + high[at]) / 2)


def fit_rows(rows: list[list[int]], targets: dict[str, np.ndarray], folds: np.ndarray, vocabulary: dict[str, int]) -> Chain:
    """The chain on feature numbers, 0/1 targets and fold numbers."""
    chain = Chain(vocabulary, list(targets))
    before = np.zeros((len(rows), 0))
    n = len(vocabulary)
    for y in targets.values():
        unseen = np.zeros(len(rows))
        for f in range(FOLDS):
            train, test = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
            w, v, b = logistic([rows[i] for i in train], before[train], y[train], n)
            unseen[test] = _sigmoid(np.array([w[rows[i]].sum() if rows[i] else 0.0 for i in test]) + before[test] @ v + b)
        chain.models.append(logistic(rows, before, y, n))
        before = np.column_stack([before, unseen])
    chain.threshold = best_threshold(before[:, -1], y)
    return chain


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        categories: dict[str, tuple[str, ...]] | None = None, max_rows: int = 10_000,
        min_chi: float = 10.83) -> Chain:
    categories = CATEGORIES if categories is None else categories
    marks = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id"))
             .agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("__y")))
    marks = (marks.withColumn("__h", F.xxhash64(F.col("__id"), F.lit("toxicity"))).orderBy("__h", "__id")
             .limit(max_rows))                     # the documented bound of the fitting sample
    sample = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # one text of each id (the least of several): at most max_rows texts, whatever repeats
    sample = staged(sample.join(F.broadcast(marks), "__id").groupBy("__id", "__y").agg(F.min("__text").alias("__text")),
                    "toxicity-sample")
    y = F.col("__y")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        toxic: Counter = Counter()
        for frame in frames:
            for t, mark in zip(frame["__text"], frame["__y"]):
                got = doc_features(t)
                seen.update(got)
                if mark:
                    toxic.update(got)
        if seen:
            yield pd.DataFrame({"f": list(seen), "n": list(seen.values()), "t": [toxic[f] for f in seen]})
    totals = sample.agg(F.count("*").alias("n"), F.sum(y).alias("t")).first()
    if not totals.n or not totals.t or totals.t == totals.n:
        return Chain()
    table = (sample.select("__text", "__y").mapInPandas(count, "f string, n long, t long")
             .groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    n, t = float(totals.n), float(totals.t)
    expected = F.col("n") * t / n
    chi = F.greatest(F.abs(F.col("t") - expected) - 0.5, F.lit(0.0)) ** 2 / (expected * (1 - F.col("n") / (n + 1)) * (1 - t / n))
    chosen = table.select("f", F.round(chi, 6).alias("chi")).filter(F.col("chi") >= min_chi).orderBy(F.desc("chi"), "f").collect()
    vocabulary = {r.f: k for k, r in enumerate(chosen)}
    part = Chain(vocabulary)

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for frame in frames:
            sets = [set(WORD.findall(t.lower())) for t in frame["__text"]]
            yield pd.DataFrame({
                "id": frame["__id"], "y": frame["__y"],
                "numbers": [part.numbers(t, cache) for t in frame["__text"]],
                "marks": [[int(not s.isdisjoint(words)) for words in categories.values()] for s in sets]})
    kind = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("y", T.IntegerType()),
                         T.StructField("numbers", T.ArrayType(T.IntegerType())),
                         T.StructField("marks", T.ArrayType(T.IntegerType()))])
    got = sample.select("__id", "__y", "__text").mapInPandas(encode, kind)
    # at most max_rows ids; the order makes the sums repeatable
    got = got.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int")).orderBy("id", "numbers").collect()
    toxic = np.array([r.y for r in got], float)
    targets = {c: toxic * np.array([r.marks[k] for r in got], float) for k, c in enumerate(categories)}
    folds = np.array([r.fold for r in got])
    return fit_rows([list(r.numbers) for r in got], targets | {"toxic": toxic}, folds, vocabulary)


def score(docs: DataFrame, chain: Chain, text: str = "text", keep: list[str] | None = None,
          categories: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``; all by default) with ``p_<category>`` (double)
    for each category, ``p_toxic`` last, and ``is_toxic``."""
    names = [*(CATEGORIES if categories is None else categories), "toxic"]
    made = [*(f"p_{c}" for c in names), "is_toxic"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.DoubleType()) for c in made[:-1]),
                           T.StructField("is_toxic", T.BooleanType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for frame in frames:
            for part in batches_by_bytes(frame, name):
                p = np.zeros((len(part), len(names)))
                if chain.models:
                    p = chain.probabilities([chain.numbers(t, cache) for t in texts_of(part, name)])
                yield without_text(part, name).assign(**dict(zip(made, p.T)), is_toxic=p[:, -1] > chain.threshold)
    rows, name = with_text(docs, keep, text)
    return rows.mapInPandas(run, schema)
