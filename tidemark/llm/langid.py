"""Language identification: a linear-chain conditional random field over the words of a text.

A word is a run of ASCII letters and non-ASCII bytes, A-Z lower-cased.  Its emission scores
add up learned weights of hashed features: prefixes and suffixes of two to four bytes, the
mean over its byte trigrams with the word's ends, and the word itself (a lexicon entry).
Transitions between the labels of neighbouring words are learned with them, by the
gradient of the conditional likelihood (AdaGrad, a fixed number of full passes).

Labels come per document; code-switched training sequences are spliced from stretches of
labelled documents of all languages, so that the chain sees changes of language where
their places are known.  Prediction runs forward-backward over every whole text; a
document's language has the largest share of its posterior mass, words weighted by length.

The training sample is bounded: about PER_LANGUAGE distinct documents of each of the LANGUAGES most
frequent values of lang, drawn by hash from all labelled documents; of each, STRETCHES stretches at most, drawn
from all over its text.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is every
text if there are no labelled documents; rows with a null lang or doc_id train nothing;
repeated rows are judged each; equal shares go to the first language in order of name;
very long texts are scored by pieces and chained by segments,
which changes no posterior; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import sliced

PER_LANGUAGE, LANGUAGES, STRETCHES = 120, 256, 64
BITS, PASSES, RATE, DECAY = 16, 25, 0.5, 1e-6
STRETCH, SEQUENCE = (4, 60), 80
UNDECIDED = "und"
#: Bytes of text whose features are computed at once; words of a segment of a chain.
PIECE, SEGMENT = 1 << 20, 2_048

FOLD = np.zeros(256, dtype=np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_FIN = np.uint64(0xBF58476D1CE4E5B9)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + np.uint64(kind * 0xD6E8FEB86659FD93 & 2**64 - 1)) * _FIN
    h = (h ^ (h >> np.uint64(32))) * _BASE
    return (h >> np.uint64(64 - BITS)).astype(np.int32)


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and starts and ends of the words."""
    data = FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], data != 0, [0]]).astype(np.int8)))
    return data, edge[::2], edge[1::2]


class Features:
    """Hashed features of words: ``single`` (n, 7) buckets, one per kind, -1 where the word is too short;
    ``grams`` and the place of each word's first one."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        x = np.concatenate([[0], data, [0]]).astype(np.uint64)  # the ends of words are zeros
        size = end - start
        power = np.cumprod(np.full(len(data) + 1, _BASE, dtype=np.uint64))
        back = np.cumprod(np.full(len(data) + 1, _INVERSE, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * power[:-1], dtype=np.uint64)])
        cut = lambda a, b: (sums[b] - sums[a]) * back[a]
        columns = [_bucket(cut(start, end), 1)]
        for k in (2, 3, 4):
            ok = size >= k
            columns.append(np.where(ok, _bucket(cut(start, np.where(ok, start + k, end)), 10 + k), -1))
            columns.append(np.where(ok, _bucket(cut(np.where(ok, end - k, start), end), 20 + k), -1))
        self.single = np.stack(columns, axis=1)
        gram = x[:-2] << np.uint64(16) | x[1:-1] << np.uint64(8) | x[2:]
        self.grams = _bucket(gram[data != 0], 2)  # one for each byte of a word
        self.first = np.concatenate([[0], np.cumsum(size)])[:-1]
        self.size = size


def emissions(f: Features, weights: np.ndarray) -> np.ndarray:
    if not len(f.size):
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.add.reduceat(weights[f.grams], f.first, axis=0) / f.size[:, None].astype(np.float32)
    for k in range(f.single.shape[1]):
        out += weights[f.single[:, k]]  # -1 is the last row, which stays zero
    return out


def posteriors(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once: word posteriors, expected transitions, and
    posteriors of the first words.  scores: words of all sequences one after the other."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    at = (np.concatenate([[0], np.cumsum(lengths[np.argsort(order, kind="stable")])])[:-1])[order]
    longest = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    a_move, forward = np.exp(move).astype(np.float32), np.empty_like(e)
    a = np.exp(start).astype(np.float32)[None, :] * e[at[:live[0]]] if longest else None
    for t in range(longest):
        n = live[t]
        if t:
            a = (a[:n] @ a_move) * e[at[:n] + t]
        a /= a.sum(axis=1, keepdims=True)
        forward[at[:n] + t] = a
    out, moves = np.empty_like(e), np.zeros(move.shape)
    b = np.ones((len(lengths), e.shape[1]), dtype=np.float32)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        here = at[:n] + t
        if t + 1 < longest:
            m = live[t + 1]
            ahead = e[at[:m] + t + 1] * b[:m]
            f = forward[at[:m] + t]
            joint = f[:, :, None] * a_move[None] * ahead[:, None, :]
            moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b[:m] = ahead @ a_move.T
            b[:m] /= b[:m].sum(axis=1, keepdims=True)
        p = forward[here] * b[:n]
        out[here] = p / p.sum(axis=1, keepdims=True)
    return out, moves, out[at[lengths > 0]].sum(axis=0) if longest else np.zeros(e.shape[1])


def _segments(e: np.ndarray, lengths: np.ndarray, prior: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sequences cut into segments of at most SEGMENT words, so that a long one is many short ones: first
    words, lengths, what comes from before a segment (a share for each label of its first word), and what
    comes from behind it (a factor for each label of its last word).  Exact: each segment's transfer
    matrix is the product of its steps, all segments side by side, and those are chained."""
    count = -(-lengths // SEGMENT)
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    of = np.repeat(np.arange(len(lengths)), count)
    k = np.arange(len(of)) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
    at, size = begin[of] + k * SEGMENT, np.minimum(lengths[of] - k * SEGMENT, SEGMENT)
    ahead, behind = np.tile(prior, (len(of), 1)), np.ones((len(of), e.shape[1]), np.float32)
    many = np.flatnonzero(count[of] > 1)
    if not len(many):
        return at, size, ahead, behind
    order = many[np.argsort(-size[many], kind="stable")]
    live = np.searchsorted(-size[order], -np.arange(SEGMENT), side="left")
    step = np.eye(e.shape[1], dtype=np.float32)[None] * e[at[order], None, :]
    for t in range(1, int(size[order[0]])):
        x = (step[:live[t]] @ m) * e[at[order[:live[t]]] + t, None, :]
        step[:live[t]] = x / x.sum(axis=(1, 2), keepdims=True)
    place = dict(zip(order.tolist(), range(len(order)), strict=True))
    for s in many.tolist():  # in order of the text
        if k[s]:
            x = ahead[s - 1] @ step[place[s - 1]] @ m
            ahead[s] = x / x.sum()
    for s in many[::-1].tolist():
        if k[s] + 1 < count[of[s]]:
            x = m @ (step[place[s + 1]] @ behind[s + 1])
            behind[s] = x / x.sum()
    return at, size, ahead, behind


def label_posteriors(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Word posteriors only; the loop over places does as little as it can."""
    if not len(scores):
        return scores
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    m, forward = np.exp(move).astype(np.float32), np.empty_like(e)
    at, lengths, ahead, behind = _segments(e, lengths[lengths > 0], np.exp(start).astype(np.float32), m)
    order = np.argsort(-lengths, kind="stable")
    at, behind, longest = at[order], behind[order], int(lengths[order[0]])
    live = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    mt, ones = np.ascontiguousarray(m.T), np.ones(e.shape[1], np.float32)
    a = ahead[order] * e[at]
    for t in range(longest):
        here = at[:live[t]] + t
        if t:
            a = (a[:live[t]] @ m) * e[here]
        a /= (a @ ones)[:, None]
        forward[here] = a
    b = behind
    forward[at + lengths[order] - 1] *= behind
    for t in range(longest - 2, -1, -1):
        n = live[t + 1]
        here = at[:n] + t
        x = (e[here + 1] * b[:n]) @ mt
        x /= (x @ ones)[:, None]
        b[:n] = x
        forward[here] *= x
    return forward / (forward @ ones)[:, None]


def train(sample: list[tuple[str, str]], seed: int = 20_260_810) -> dict | None:
    """Weights, start and transition scores from (text, lang) pairs."""
    langs = sorted({lang for _, lang in sample})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    stretches = []
    for text, lang in sorted(sample):
        data, start, end = words_of(text)
        at, own = 0, []
        while at < len(start):
            n = int(rng.integers(*STRETCH))
            a, b = start[at], end[min(at + n, len(start)) - 1]
            own.append((data[a:b], langs.index(lang), min(n, len(start) - at)))
            at += n
        if len(own) > STRETCHES:
            own = [own[i] for i in rng.choice(len(own), STRETCHES, replace=False)]
        stretches += own
    stretches = [stretches[i] for i in rng.permutation(len(stretches))]
    if not stretches:
        return None
    pieces, labels, lengths = [], [], [0]
    for data, label, n in stretches:
        if lengths[-1] >= SEQUENCE:
            lengths.append(0)
        lengths[-1] += n
        pieces += [data, np.zeros(1, np.uint8)]
        labels += [label] * n
    data = np.concatenate(pieces)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], data != 0, [0]]).astype(np.int8)))
    f, y, lengths = Features(data, edge[::2], edge[1::2]), np.asarray(labels), np.asarray(lengths)
    k, rows = len(langs), (1 << BITS) + 1
    w, start, move = np.zeros((rows, k), np.float32), np.zeros(k), np.zeros((k, k))
    sums = [np.full(x.shape, 1e-2, x.dtype) for x in (w, start, move)]
    truth = np.eye(k, dtype=np.float32)[y]
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    follows = np.ones(len(y), bool)
    follows[begin] = False
    later = np.flatnonzero(follows)
    seen = np.zeros((k, k))
    np.add.at(seen, (y[later - 1], y[later]), 1)
    word_of = np.repeat(np.arange(len(f.size)), f.size)
    for _ in range(PASSES):
        p, moves, first = posteriors(emissions(f, w), lengths, start, move)
        g = truth - p
        share = g / f.size[:, None]
        grad = np.zeros_like(w)
        for c in range(k):
            grad[:, c] = np.bincount(f.grams, share[word_of, c], rows)
            for j in range(f.single.shape[1]):
                grad[:, c] += np.bincount(np.where(f.single[:, j] < 0, rows - 1, f.single[:, j]), g[:, c], rows)
        grad[-1] = 0
        for x, s, d in zip((w, start, move), sums, (grad - DECAY * len(y) * w, truth[begin].sum(axis=0) - first, seen - moves), strict=True):
            s += d * d
            x += (RATE * d / np.sqrt(s)).astype(x.dtype)
    return {"langs": langs, "weights": w, "start": start, "move": move}


def predict(model: dict | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    n = len(texts)
    named, sure = [UNDECIDED] * n, [0.0] * n
    if model is None:
        return named, sure
    scores, lengths, weight, docs = [], np.zeros(n, np.int64), [], []
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    total = 0

    def flush() -> None:
        nonlocal held, total
        if held:
            at = np.cumsum([0, *[len(d) + 1 for d, _, _ in held]])
            data = np.concatenate([np.concatenate([d, [np.uint8(0)]]) for d, _, _ in held])
            f = Features(data, np.concatenate([s + a for (_, s, _), a in zip(held, at, strict=False)]), np.concatenate([e + a for (_, _, e), a in zip(held, at, strict=False)]))
            scores.append(emissions(f, model["weights"]))
            weight.append(f.size)
        held, total = [], 0

    for i, text in enumerate(texts):
        if text and (any(map(str.isalpha, text)) if not text.isascii() else True):
            data, start, end = words_of(text)
            lengths[i] = len(start)
            if len(start):
                docs.append(i)
                for a in range(0, len(start), PIECE // 4):  # a very long text goes by pieces
                    s, e = start[a:a + PIECE // 4], end[a:a + PIECE // 4]
                    held.append((data[s[0]:e[-1]], s - s[0], e - s[0]))
                    total += e[-1] - s[0]
                    if total >= PIECE:
                        flush()
    flush()
    if docs:
        p = label_posteriors(np.concatenate(scores), lengths[docs], model["start"], model["move"])
        size = np.concatenate(weight).astype(np.float64)
        at = np.concatenate([[0], np.cumsum(lengths[docs])])[:-1]
        share = np.add.reduceat(p * size[:, None], at, axis=0) / np.add.reduceat(size, at)[:, None]
        for i, row in zip(docs, share, strict=True):
            named[i], sure[i] = model["langs"][int(row.argmax())], float(min(1.0, row.max()))
    return named, sure


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict | None:
    """Train on a bounded sample of the documents that aren't held out."""
    from itertools import chain

    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("doc_id is not null and lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return None
    share = F.create_map(*chain.from_iterable((F.lit(k), F.lit(min(1.0, per_language / n))) for k, n in counts.items()))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_007)) / 1_000_000_007.0
    return train([(r["text"], r["lang"]) for r in usable.where(draw < share[F.col("lang")]).dropDuplicates(["doc_id", "text", "lang"]).select("text", "lang").collect()])


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents with lang_pred and score added (columns of these names are replaced)."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, per_language))
    plain = docs.drop("lang_pred", "score")
    at = plain.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            named, sure = predict(model.value, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(named, pa.string()), pa.array(sure, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType
    return plain.mapInArrow(run, StructType(list(plain.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType()))
