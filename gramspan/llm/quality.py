"""Quality classifier from positive and unlabelled documents.

Trusted positives are labelled good documents; the unlabelled side is the
whole corpus, whose share of good documents (the class prior) is estimated
from the labels that may be learnt from. A linear model minimises the
non-negative unbiased risk

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

with the logistic loss l. As l(g) - l(-g) = -g, the risk is convex while its
second part is positive: Newton steps are taken on it, and each step is the
one of several lengths with the least non-negative risk. Every sum is one
distributed aggregate over all documents; only sums over the few features
reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramspan.llm.common import stored, texts
from gramspan.llm.hashing import Block, blocks

# Classes of bytes that are counted.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:?'\"()-", "!", "#$%&*+/<=>@\\^_`{|}~[]", " \t\r\v\f", "\n")
N_FEATURES = 20
_STEPS = (1.0, 0.5, 0.25, 0.1, 0.03)


def _class_tables() -> list[np.ndarray]:
    tables = []
    for chars in _CLASSES:
        t = np.zeros(256, np.int64)
        t[np.frombuffer(chars.encode(), np.uint8)] = 1
        tables.append(t)
    high = np.zeros(256, np.int64)
    high[128:192] = 1  # continuation bytes: one or more per non-ASCII character
    return [*tables, high]


_TABLES = _class_tables()


def features(batch_texts: list[bytes]) -> np.ndarray:
    """``(n, N_FEATURES)``: shares, rates and logarithms that describe form, not topic."""
    block = Block(batch_texts)
    block.words()
    n, size = len(batch_texts), np.maximum(block.lengths, 1).astype(float)
    # The separator after each text belongs to it in these sums; it counts as a line break.
    counts = [np.add.reduceat(t[block.bytes], block.first).astype(float) for t in _TABLES]
    upper, digit, point, bang, symbol, space, lines, high = counts
    words = np.maximum(block.n_words, 1).astype(float)
    hashes, long = block.word_hashes(), block.end - block.start

    def per_text(values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1)
        np.cumsum(values, out=total[1:])
        return total[block.word0 + block.n_words] - total[block.word0]

    order = np.lexsort((hashes, block.owner))
    new = np.ones(len(hashes), bool)
    if len(hashes):
        o, h = block.owner[order], hashes[order]
        new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    distinct = per_text(new)
    # The most frequent word of each text.
    runs = np.flatnonzero(new)
    sizes = np.diff(np.append(runs, len(hashes)))
    most = np.zeros(n)
    if len(runs):
        np.maximum.at(most, block.owner[order][runs], sizes)
    same = np.zeros(len(hashes), bool)
    if len(hashes):
        same[1:] = (hashes[1:] == hashes[:-1]) & (block.owner[1:] == block.owner[:-1])
    last = block.bytes[np.maximum(block.end - 1, 0)]
    strange = (_TABLES[4] + _TABLES[3])[last] > 0
    capital = (_TABLES[0][block.bytes[block.start]] > 0) if len(long) else np.zeros(0)
    # Zeta-like growth of vocabulary: distinct words against the root of all words.
    columns = [
        upper / size, digit / size, point / size, bang / size, symbol / size, space / size, high / size,
        np.sqrt(symbol / size), np.sqrt(bang / size), np.sqrt(upper / size),
        np.log1p(block.lengths), np.log1p(words), np.log1p(lines), np.log1p(words / np.maximum(lines, 1)),
        distinct / words, most / words, per_text(same) / words, per_text(strange) / words,
        per_text(capital) / words, per_text(long) / words / 10,
    ]
    return np.column_stack(columns)


def feature_table(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for each row; the texts go no further."""

    def compute(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body in blocks(batch):
                x = pa.FixedSizeListArray.from_arrays(pa.array(features(body).ravel()), N_FEATURES)
                yield pa.RecordBatch.from_arrays([part.column(0), x.cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    return texts(docs).mapInArrow(compute, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learnt from; a null id is in no fold."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(fold == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, positive`` of the rows that may be learnt from; the better of repeated labels holds."""
    usable = labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg((F.max("quality") == 1).alias("positive"))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    risk: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.standard(x) @ self.weights + self.bias, -40, 40)))

    def score_features(self, table: DataFrame) -> DataFrame:
        """Add ``score`` to a feature table."""
        model = self

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(model.scores(np.array(x.tolist()).reshape(-1, N_FEATURES)))

        return table.withColumn("score", score("x"))

    def score_text(self, text: Column) -> Column:
        """The score of a text column, in one pass without a shuffle."""
        model = self

        @F.pandas_udf("double")
        def score(text: pd.Series) -> pd.Series:
            batch = pa.record_batch([pa.array(text, pa.binary())], ["text"])
            parts = [model.scores(features(body)) for _, body in blocks(batch)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        return score(F.coalesce(text, F.lit("")).cast("binary"))


def _sums(rows: DataFrame, measure) -> np.ndarray:
    """Sum ``measure(x, positive)``, a fixed-length vector, over all rows."""

    def part(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy().reshape(-1, N_FEATURES)
            got = measure(x, batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    summed = rows.select("x", "positive").mapInArrow(part, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    got = sorted((r["i"], r["v"]) for r in summed.collect())
    return np.array([v for _, v in got])


def fit(
    table: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    ridge: float = 1e-4,
    max_iter: int = 20,
    tolerance: float = 1e-5,
) -> QualityModel:
    """Fit on a feature table and labels (``doc_id, quality``).

    The prior, unless given, is the share of good documents among the labels
    that may be learnt from, smoothed by one good and one bad. Without trusted
    positives or documents the model scores everything with the prior.
    """
    known = training_labels(labels)
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("p")).head()
    if prior is None:
        prior = (seen["p"] + 1) / (seen["n"] + 2)
    trusted = known.filter("positive").select("doc_id", F.lit(True).alias("positive"))
    rows = stored(
        table.join(trusted, "doc_id", "left").select("x", F.coalesce("positive", F.lit(False)).alias("positive")),
        "quality-rows",
    )
    d = N_FEATURES
    s = _sums(
        rows,
        lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]),
    )
    model = QualityModel(np.zeros(d), np.ones(d), np.zeros(d), float(np.log(prior / (1 - prior))), prior, float("nan"))
    if not len(s) or not s[1]:
        return model
    n, n_pos = s[:2]
    model.mean = s[2 : 2 + d] / n
    spread = np.sqrt(np.maximum(s[2 + d :] / n - model.mean**2, 0))
    model.scale = np.where(spread > 1e-9, spread, 1.0)
    pos = _sums(rows, lambda x, p: np.append(model.standard(x)[p].sum(0), 0.0))[:d] / n_pos
    pos = np.append(pos, 1.0)
    theta = np.append(np.zeros(d), model.bias)
    decay = np.append(np.full(d, ridge), 0.0)

    def slope(x, p):
        z = np.column_stack([model.standard(x), np.ones(len(x))])
        q = 1 / (1 + np.exp(-np.clip(z @ theta, -40, 40)))
        return np.concatenate([q @ z, ((z * (q * (1 - q))[:, None]).T @ z).ravel()])

    def risks(tries):
        def measure(x, p):
            g = np.column_stack([model.standard(x), np.ones(len(x))]) @ np.array(tries).T
            bad, good = np.logaddexp(0, g), np.logaddexp(0, -g)
            return np.concatenate([bad.sum(0), bad[p].sum(0), good[p].sum(0)])

        unl, pos_bad, pos_good = _sums(rows, measure).reshape(3, len(tries))
        return prior * pos_good / n_pos + np.maximum(0, unl / n - prior * pos_bad / n_pos)

    best = risks([theta])[0]
    for _ in range(max_iter):
        g = _sums(rows, slope)
        gradient = g[: d + 1] / n - prior * pos + decay * theta
        hessian = g[d + 1 :].reshape(d + 1, d + 1) / n + np.diag(decay + 1e-9)
        step = -np.linalg.solve(hessian, gradient)
        tries = [theta + s * step for s in _STEPS]
        found = risks(tries)
        k = int(np.argmin(found))
        if found[k] >= best - tolerance * abs(best):
            break
        theta, best = tries[k], found[k]
    model.weights, model.bias, model.risk = theta[:d], float(theta[d]), float(best)
    return model


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    A null text is empty, an empty text is scored like any other. Repeated rows
    are scored alike and each returned. Labels of unknown documents, with a null
    quality or of the held-out fold teach nothing. Extra columns are ignored.
    """
    table = stored(feature_table(docs), "quality-features")
    model = fit(table, labels, **options)
    return model.score_features(table).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
