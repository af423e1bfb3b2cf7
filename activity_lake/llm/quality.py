"""Quality by hierarchical empirical Bayes: a document's own evidence and the record of its host and path.

A logistic classifier on figures of the text gives each document its evidence. The expected numbers of good documents are
summed by host and by path (levels are columns, coarse to fine), and each level's rate is drawn towards the level above it,
the hosts' towards the global rate, as strongly as the level's own spread suggests: a site with few documents keeps nearly
its parent's rate. A document's posterior odds are the odds of its path, without the document itself, times its own
likelihood ratio.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.llm.common import cut, unused

#: The classifier is fitted on at most so many labelled documents, those with the smallest hashes of their ids.
LABELLED_SAMPLE = 20_000
LEVELS = ("source", "lang")
KEEP = 0.5
PORTION = 1 << 20

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
PLAIN = b".,;:'\"()-?"
SYMBOLS = bytes(b for b in range(33, 127) if b not in UPPER + LOWER + DIGITS + PLAIN + b"!")
FIGURES = 12


def figures(text: bytes) -> list[float]:
    """Figures of a whole text; an empty one has none but its length."""
    n = len(text)
    without = lambda kind: n - len(text.translate(None, kind))
    upper, lower, digits, symbols, bangs = map(without, (UPPER, LOWER, DIGITS, SYMBOLS, b"!"))
    beyond = n - len(text.decode("utf-8", "replace")) if not text.isascii() else 0
    letters = upper + lower + beyond + 1
    words, ends, lengths, lines = Counter(), 0, 0, Counter(text.split(b"\n"))
    at = 0
    while at < n:
        end = text.find(b" ", at + PORTION)
        end = n if end < 0 else end
        part = text[at:end].split()
        words.update(part)
        lengths += sum(map(len, part))
        at = end
    total = sum(words.values()) or 1
    top = words.most_common(1)[0][1] if words else 0
    repeated = sum(len(line) * (k - 1) for line, k in lines.items())
    return [
        np.log1p(total), upper / letters, digits / (n + 1), symbols / (n + 1), bangs / total, len(words) / total,
        top / total, min(lengths / total, 40.0), repeated / (n + 1), symbols / total, beyond / letters,
        float(len(words) / total * np.log1p(total)),
    ]


def design(rows: np.ndarray) -> np.ndarray:
    """The figures, their squares and square roots, and a constant."""
    return np.hstack([np.ones((len(rows), 1)), rows, rows ** 2, np.sqrt(np.abs(rows))])


@dataclass
class Classifier:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def logit(self, rows: np.ndarray) -> np.ndarray:
        terms = design(rows)
        terms[:, 1:] = (terms[:, 1:] - self.mean) / self.spread
        return np.clip(terms @ self.weights, -30, 30)


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 40) -> Classifier:
    """Ridge-penalised logistic regression by Newton's method. Without both classes it says nothing (logit 0)."""
    terms = design(rows)
    mean, spread = (terms[:, 1:].mean(axis=0), terms[:, 1:].std(axis=0) + 1e-9) if len(rows) else (np.zeros(3 * FIGURES), np.ones(3 * FIGURES))
    weights = np.zeros(terms.shape[1])
    if len(good) and 0 < good.mean() < 1:
        terms[:, 1:] = (terms[:, 1:] - mean) / spread
        penalty = np.full(len(weights), ridge)
        penalty[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(terms @ weights, -30, 30)))
            gradient = terms.T @ (good - p) - penalty * weights
            change = np.linalg.solve((terms * (p * (1 - p))[:, None]).T @ terms + np.diag(penalty), gradient)
            weights += change
            if np.abs(change).max() < 1e-6:
                break
    return Classifier(mean, spread, weights)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def figures_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: figures(text if text is not None else b""), na_action=None)


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED_SAMPLE) -> Classifier:
    """A classifier from labels (doc_id, quality 0/1); several labels of a document vote, a tie counts as good.

    The chosen ids are bounded by ``most``, so they may be broadcast, and so are the figures that reach the driver.
    """
    votes = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("vote"))
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id")
    # A document that is repeated counts once or more, but the driver still gets no more than ``most`` rows.
    rows = sample.select("doc_id", figures_of("text").alias("f"), (F.col("vote") >= 0.5).alias("good")).limit(most).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    return fit(np.array(rows["f"].tolist(), float).reshape(-1, FIGURES), rows["good"].to_numpy(float))


def evidence(classifier: Classifier):
    """A function of a binary text column to the classifier's logit; a null text counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def logit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = [figures(text if text is not None else b"") for text in texts]
            yield pd.Series(classifier.logit(np.array(rows, float).reshape(-1, FIGURES)), dtype=float)

    return logit


def concentration(rates: DataFrame, mean: Column) -> float:
    """How many documents the parent's rate is worth, by moments: columns good, n and what ``mean`` reads.

    The spread of the groups' rates beyond what ``n`` draws from their parent's rate would show anyway; the less there is,
    the stronger the parent.
    """
    over = F.pow(F.col("good") / F.col("n") - mean, F.lit(2))
    row = rates.agg(F.sum(F.col("n") * over).alias("seen"), F.sum(mean * (1 - mean)).alias("drawn"),
                    F.sum(F.col("n") * mean * (1 - mean)).alias("most"), F.count("*").alias("groups")).first()
    if not row["groups"] or not row["most"]:
        return 1.0
    between = max(row["seen"] - row["drawn"], 0.0) / row["most"]  # as a share of the largest possible
    return float(np.clip(1 / max(between, 1e-6) - 1, 1.0, 1e4))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def assess(docs: DataFrame, classifier: Classifier, out: str = "quality", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """All columns of ``docs`` and the struct ``out``: evidence (logit), site (the path's rate), probability.

    Null hosts and paths are sites of their own; a null text is judged as an empty one. Equal rows get equal values. An
    empty table gives an empty table.
    """
    docs = docs.drop(out)
    e = unused(docs, "evidence_")
    keys = [unused(docs, f"level{i}_") for i in range(len(levels))]
    sites = [F.to_json(F.array(*(F.col(c).cast("string") for c in levels[:i + 1]))) for i in range(len(levels))]
    scored = docs.withColumns({e: evidence(classifier)(F.col("text").cast("binary")), **dict(zip(keys, sites))})
    p = unused(docs, "p_")
    good = 1 / (1 + F.exp(-F.col(e)))
    # One row a path. Written, as it is summed in several ways and the texts should be read for it once.
    finest = cut(scored.groupBy(*keys).agg(F.sum(good).alias("good"), F.count("*").alias("n")), "paths")
    overall = finest.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    total_n, total = overall["n"] or 0, overall["good"] or 0.0
    base = (total + 1) / (total_n + 2)
    table, strengths = finest, []
    shrunk = F.lit(base)  # the rate of the level above, drawn towards its own parents'
    for i, key in enumerate(keys):
        level = finest.groupBy(*keys[:i + 1]).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        for j in range(i):
            level = level.join(finest.groupBy(*keys[:j + 1]).agg(F.sum("good").alias(f"up_good{j}"), F.sum("n").alias(f"up_n{j}")), keys[:j + 1])
        if i:
            shrunk = (F.col(f"up_good{i - 1}") + strengths[i - 1] * shrunk) / (F.col(f"up_n{i - 1}") + strengths[i - 1])
        strengths.append(concentration(level, shrunk))
        table = table if i == len(keys) - 1 else table.join(
            level.select(*keys[:i + 1], F.col("good").alias(f"good{i}"), F.col("n").alias(f"n{i}")), keys[:i + 1])
    last = len(keys) - 1
    table = table.withColumnsRenamed({"good": f"good{last}", "n": f"n{last}"})
    row = unused(docs, "site_")
    packed = table.select(*keys, F.struct(*(c for c in table.columns if c not in keys)).alias(row))
    # Written, so that Spark knows its size: a small table of sites is broadcast, and the texts stay where they are.
    joined = scored.withColumn(p, good).join(cut(packed, "sites"), keys)
    rate = F.lit(base)
    for i in range(len(keys)):  # each level without the document itself, drawn towards the one above
        rate = (F.col(f"{row}.good{i}") - F.col(p) + strengths[i] * rate) / (F.col(f"{row}.n{i}") - 1 + F.lit(strengths[i]))
    own = F.col(e) - F.lit(float(np.log(base / (1 - base))))
    return joined.withColumn(out, F.struct(
        F.col(e).alias("evidence"), rate.alias("site"),
        (1 / (1 + F.exp(-(_logit(rate) + own)))).alias("probability"))).select(*docs.columns, out)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = KEEP) -> DataFrame:
    """The documents whose probability of being good is ``least`` or more; columns as they came."""
    q = unused(docs, "quality_")
    return assess(docs, train(docs, labels), q).filter(F.col(f"{q}.probability") >= least).select(*docs.columns)


def op5_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged = assess(docs.select("doc_id", "source", "lang", "text"), train(docs, labels), "q")
    return judged.select("doc_id", "source", F.col("q.evidence").alias("evidence"), F.col("q.site").alias("site"),
                         F.col("q.probability").alias("probability"), (F.col("q.probability") >= KEEP).alias("keep"))
