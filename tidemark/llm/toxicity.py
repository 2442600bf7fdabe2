"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other.  Each has a logistic model over the
tokens present in the text (words and runs of signs, lower-cased; those in at least
LEAST_DOCS documents of the sample, and LEAST_Z standard deviations more or less often in the
category than by chance) and over the log-odds that the earlier models of the chain give.  In training those come out of fold: FOLDS folds by the hash of the text, so
that equal texts share a fold, and every document's earlier probabilities come from models
that haven't seen it.  In prediction they come from the models fitted on the whole sample.

The labels say of a document whether it is of low quality and whether it is toxic; the
chain is (low_quality, toxic) by default.  The sample is bounded: about SAMPLE_ROWS
distinct labelled documents, drawn by hash from all of them.

Edge cases: texts that are null or have no tokens get the probabilities of an empty text
and are never flagged; labels that are null or lack a document train nothing; without any
labels all probabilities are 0; repeated rows are judged each; a document whose rows
tie or differ in their labels is of low quality, or toxic, if one of them says so; very long texts are judged by
all their tokens; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, sliced

SAMPLE_ROWS, LEAST_DOCS, FOLDS = 8_000, 8, 3
#: Standard deviations by which a token's count in a category must miss what chance would give.
LEAST_Z = 4.0
PASSES, RATE, DECAY = 80, 0.5, 2e-5
THRESHOLD = 0.5
CHAIN = ("low_quality", "toxic")
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+")


def tokens_of(text: str | None) -> set[str]:
    return set(TOKEN.findall((text or "").lower()))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse rows of features that are there or not."""

    def __init__(self, rows: list[list[int]], width: int) -> None:
        self.size = np.array([len(r) for r in rows])
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.index = np.fromiter((i for r in rows for i in r), np.int64, int(self.size.sum()))
        self.row, self.width = np.repeat(np.arange(len(rows)), self.size), width

    def part(self, keep: np.ndarray) -> Rows:
        own = object.__new__(Rows)
        inside = keep[self.row]
        own.size, own.width = self.size[keep], self.width
        own.index, own.row = self.index[inside], np.repeat(np.arange(int(keep.sum())), own.size)
        return own

    def only(self, features: np.ndarray) -> Rows:
        own = object.__new__(Rows)
        inside = features[self.index]
        own.size, own.width, own.index, own.row = self.size, self.width, self.index[inside], self.row[inside]
        return own

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], len(self.size))


def logistic(x: Rows, extra: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the tokens, and of the earlier log-odds with the constant last."""
    extra = np.column_stack([extra, np.ones(len(y))])
    share, often = y.mean() if len(y) else 0.0, np.bincount(x.index, minlength=x.width)
    deviation = np.bincount(x.index, y[x.row] - share, x.width) / np.sqrt(np.maximum(often * share * (1 - share), 1e-9))
    telling = (np.abs(deviation) >= LEAST_Z) & (often >= LEAST_DOCS)
    x = x.only(telling)
    w, v = np.zeros(x.width), np.zeros(extra.shape[1])
    sw, sv = np.full_like(w, 1e-4), np.full_like(v, 1e-4)
    base = np.clip(share, 1e-3, 1 - 1e-3)
    v[-1] = np.log(base / (1 - base))
    for _ in range(PASSES):
        g = (y - sigmoid(x.dot(w) + extra @ v)) / max(1, len(y))
        gw, gv = np.bincount(x.index, g[x.row], x.width) - DECAY * w, extra.T @ g
        sw += gw * gw
        sv += gv * gv
        w += RATE * gw / np.sqrt(sw)
        v += 0.2 * RATE * gv / np.sqrt(sv)
    return w, v


def train(texts: list[str], labels: np.ndarray, chain: Sequence[str] = CHAIN) -> dict | None:
    """labels: one row a text, one column a category, 0 or 1."""
    if not texts:
        return None
    bags = [tokens_of(t) for t in texts]
    often = sorted(t for t, n in Counter(t for b in bags for t in b).items() if n >= LEAST_DOCS)
    place = {t: i for i, t in enumerate(often)}
    x = Rows([sorted(place[t] for t in b if t in place) for b in bags], len(place))
    fold = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) % FOLDS for t in texts])
    odds, models = np.zeros((len(texts), 0)), []
    for c in range(len(chain)):
        models.append(logistic(x, odds, labels[:, c]))
        fresh = np.zeros(len(texts))
        for k in range(FOLDS):
            seen = fold != k
            w, v = logistic(x.part(seen), odds[seen], labels[seen, c])
            fresh[~seen] = x.part(~seen).dot(w) + np.column_stack([odds[~seen], np.ones(int((~seen).sum()))]) @ v
        odds = np.column_stack([odds, np.clip(fresh, -30, 30)])
    weights = np.column_stack([w for w, _ in models])
    return {"place": place, "weights": weights, "extra": [v for _, v in models]}


def predict(model: dict | None, texts: list[str | None], n: int = len(CHAIN)) -> np.ndarray:
    """Probabilities, one row a text, one column a category."""
    out = np.zeros((len(texts), n))
    if model is None:
        return out
    place, weights = model["place"], model["weights"]
    for i, text in enumerate(texts):
        at = [place[t] for t in tokens_of(text) if t in place]
        base = weights[at].sum(axis=0)
        odds: list[float] = []
        for c, v in enumerate(model["extra"]):
            odds.append(float(np.clip(base[c] + np.dot(v[:-1], odds) + v[-1], -30, 30)))
        out[i] = sigmoid(np.array(odds))
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict | None:
    """Train on a bounded sample.  labels: doc_id, quality, toxic."""
    marks = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 0).cast("int")).alias("low"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n = marks.count()
    if n == 0:
        return None
    drawn = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) / 1_000_000_007.0 < min(1.0, rows / n))
    if rows <= BROADCAST_ROWS:  # about so many were drawn
        drawn = F.broadcast(drawn)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    held = sorted(tuple(r) for r in texts.join(drawn, "doc_id").dropDuplicates(["doc_id", "text"]).select("text", "low", "toxic").collect())
    return train([r[0] for r in held], np.array([r[1:] for r in held], dtype=float).reshape(-1, 2))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, probability of each category, and whether it reaches the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            p = predict(model.value, texts)
            said = np.array([bool(t and TOKEN.search(t)) for t in texts], dtype=bool)
            out = {"doc_id": batch.column(0)}
            for c, name in enumerate(CHAIN):
                out |= {f"p_{name}": pa.array(p[:, c]), name: pa.array((p[:, c] >= threshold) & said)}
            yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, " + ", ".join(f"p_{c} double, {c} boolean" for c in CHAIN))
