"""Toxicity by a classifier chain.

The categories are learned in order with logistic regression over hashed words;
each later model also takes the probabilities of the earlier categories. For
training these are out-of-fold: predicted by models that have not seen the row.

Training takes a bounded sample of the labelled documents, about ``max_rows``
by hash of doc_id; of a category its model and those of the folds are fitted side
by side, a task each. A document that holds more labels rows than one counts
once, with the largest label, and one that stands in several rows with its least text. Null and empty texts have no words and get the base
rate; without labelled rows all probabilities are 0 and nothing is flagged; an
empty table gives no rows; repeated rows are scored each; very long texts have
more features; ties play no part; documents' other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lean, settled, slices
from .words import hashes, sorted_set, words

BITS = 18
FOLDS = 4


#: Letters of ASCII and bytes of other characters make words; all else parts them.
_LETTER = np.array([32 if b < 128 and not chr(b).isalpha() else b for b in range(256)], np.uint8)


def features(texts: list[str | None]) -> list[np.ndarray]:
    """Distinct hashed features of each text, A-Z lowered: runs of letters, their first four and five bytes, and what stands between white space as it is."""
    found = []
    for kind, (replaced, most) in enumerate(((_LETTER, None), (_LETTER, 4), (_LETTER, 5), (None, None))):
        data, starts, ends, first = words(texts, replaced)
        numbers = (hashes(data, starts, ends if most is None else np.minimum(ends, starts + most), 10 * (kind + 1)) >> np.uint64(64 - BITS)).astype(np.int32)
        found.append([numbers[a:b] for a, b in zip(first, first[1:])])
    return [sorted_set(np.concatenate(all_)) for all_ in zip(*found)]


class Rows:
    """Rows of feature numbers, flat."""

    def __init__(self, rows: list[np.ndarray]):
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.of = np.repeat(np.arange(len(rows)), self.sizes)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights[self.flat], len(self.sizes))

    def take(self, keep: np.ndarray) -> Rows:
        ends = np.cumsum(self.sizes)
        return Rows([self.flat[e - n : e] for e, n in zip(ends[keep], self.sizes[keep])])


def fit(rows: Rows, extra: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.5) -> np.ndarray:
    """Weights of words, then of ``extra`` columns, then the bias: adaptive gradient steps from smoothed log-odds of the words."""
    size, n = 1 << BITS, len(y)
    if n == 0 or y.min() == y.max():
        return np.concatenate((np.zeros(size + extra.shape[1]), [np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))]))
    # A word's scale is its smoothed log-odds: words as frequent in either class start and stay near none.
    on = np.bincount(rows.flat, y[rows.of], size)
    off = np.bincount(rows.flat, 1 - y[rows.of], size)
    scale = np.log((on + 1) / (y.sum() + 2)) - np.log((off + 1) / (n - y.sum() + 2))
    scale[on + off < 3] = 0
    scale = np.sign(scale) * np.maximum(0, np.abs(scale) - 1.96 * np.sqrt(1 / (on + 1) + 1 / (off + 1)))  # only what sampling doesn't explain
    w, e, b = np.zeros(size), np.zeros(extra.shape[1]), np.log(y.mean() / (1 - y.mean()))
    gw, ge, gb = np.full(size, 1e-6), np.full(extra.shape[1], 1e-6), 1e-6
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(rows.dot(w * scale) + extra @ e + b, -30, 30))) - y
        dw = (np.bincount(rows.flat, error[rows.of], size) * scale + ridge * w) / n
        de, db = (extra.T @ error + ridge * e) / n, error.mean()
        gw += dw**2
        ge += de**2
        gb += db**2
        w -= 0.5 * dw / np.sqrt(gw)
        e -= 0.5 * de / np.sqrt(ge)
        b -= 0.5 * db / np.sqrt(gb)
    return np.concatenate((w * scale, e, [b]))


def predict(rows: Rows, extra: np.ndarray, model: np.ndarray) -> np.ndarray:
    size = 1 << BITS
    return 1 / (1 + np.exp(-np.clip(rows.dot(model[:size]) + extra @ model[size:-1] + model[-1], -30, 30)))


def fit_fold(rows: Rows, extra: np.ndarray, y: np.ndarray, fold: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The model of the rows outside fold ``k`` (of all rows if k < 0), and its predictions for that fold."""
    out = fold == k
    model = fit(rows.take(~out), extra[~out], y[~out])
    return model, predict(rows.take(out), extra[out], model)


def _trainer(c: int, earlier: list[dict[int, float]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Fits category ``c`` on the rows outside the group's fold (on all for k = -1) and predicts that fold."""
    earlier = list(earlier)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["k"].iloc[0])
        pdf = pdf.sort_values("doc_id").drop_duplicates("doc_id")
        ids = pdf["doc_id"].to_numpy()
        extra = np.array([[p[i] for p in earlier] for i in ids.tolist()], np.float64).reshape(len(ids), len(earlier))
        fold = (ids * 2654435761 >> 8) % FOLDS
        model, found = fit_fold(Rows([np.asarray(f, np.int64) for f in pdf["features"]]), extra, pdf[f"y{c}"].to_numpy(np.float64), fold, k)
        return pd.DataFrame({"k": [k], "model": [model.tobytes() if k < 0 else None], "ids": [ids[fold == k].tolist()], "p": [found.tolist()]})

    return train


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, str], max_rows: int = 8000) -> list[bytes]:
    """``categories``: name -> SQL condition over ``labels``, in the chain's order. Weights, 2 MB a category."""
    conditions = [F.expr(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]
    known = labels.select("doc_id", *conditions).groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))]).na.drop()
    n = known.count()
    share = min(1.0, max_rows / max(1, n))
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most about max_rows rows of a few numbers
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [f for (texts,) in slices([batch], ["text"]) for f in features(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32())), *[batch.column(f"y{i}") for i in range(len(categories))]], ["doc_id", "features", *[f"y{i}" for i in range(len(categories))]])

    ys = ", ".join(f"y{i} int" for i in range(len(categories)))
    data = settled(chosen.mapInArrow(lean(read), f"doc_id long, features array<int>, {ys}"))
    models: list[bytes] = []
    unseen: list[dict[int, float]] = []  # of earlier categories, by document: at most about max_rows numbers each
    for c in range(len(categories)):
        folds = range(-1, FOLDS if c + 1 < len(categories) else 0)
        dealt = data.select("*", F.explode(F.array(*map(F.lit, folds))).alias("k"))
        fitted = dealt.groupBy("k").applyInPandas(_trainer(c, unseen), "k int, model binary, ids array<long>, p array<double>").collect()
        if not fitted:
            return []
        models += [bytes(r["model"]) for r in fitted if r["k"] < 0]
        unseen.append({i: p for r in fitted for i, p in zip(r["ids"], r["p"])})
    return models


def score(docs: DataFrame, models: list[bytes], categories: dict[str, str]) -> DataFrame:
    """doc_id and p_<category> for each category."""
    names = list(categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [np.frombuffer(m) for m in models]
        for ids, texts in slices(batches, ["doc_id", "text"]):
            rows = Rows([f.astype(np.int64) for f in features(texts)])
            extra = np.zeros((len(texts), 0))
            for model in chain:
                extra = np.column_stack((extra, predict(rows, extra, model)))
            if not chain:
                extra = np.zeros((len(texts), len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(extra[:, k]) for k in range(len(names))]], ["doc_id", *[f"p_{n}" for n in names]])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, " + ", ".join(f"p_{n} double" for n in names))
