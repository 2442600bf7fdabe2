"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components become integers floor(scale * x).  A block of vectors is indexed as posting
segments: for each dimension, the rows whose component lies in one step of STEP values.
For a query, the segments of all dimensions are processed by descending quantised impact
(query component times the segment's step, above the least impact of that dimension).
What is left to come in each dimension bounds every row's score from above, and what has
come bounds it from below; processing stops only once at most KEEP rows can still be
among the best k of the block, or all segments are done.  Those rows are rescored exactly.
The best k of the blocks then meet in a window that keeps k rows a query before its shuffle.

A stated query set goes against all rows in blocks: each task holds one index block of at
most BLOCK_ROWS vectors and streams the query blocks (QUERY_ROWS vectors each) from the
shared folder, so that neither a join nor a broadcast of the queries is needed.

Integers are exact at any size.  Vectors whose inner products with others like them stay within 62 bits fill blocks of their own,
which are compared in 64 bits; the others come in small blocks of their own, and only comparisons with these
(or with such queries) use integers of any size.  A score beyond 64 bits is returned as the nearest one that
fits, but ranks by its true value.

Edge cases: vectors that are null or hold a null, NaN or infinity take no part, every finite one does; shorter
vectors count as padded with zeros; rows with the query's own vec_id aren't candidates;
repeated query rows of the same integers are one query; equal scores go to the smaller vec_id; rows
without vec_id take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh_path, written

BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
#: Vectors of a block of such whose products may leave 62 bits.
LARGE_ROWS = 256
STEP = 16
#: Segments between two looks at the bounds, as shares of all segments.
LOOKS = (0.35, 0.5, 0.65, 0.8, 0.9)
KEEP = 1_024


class Index:
    """Posting segments of one block; x: rows of integers, of any size if the type is object."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        level = self.x // STEP
        self.dim, self.level, self.rows = [], [], []
        for d in range(x.shape[1]):
            order = np.argsort(level[:, d], kind="stable")
            steps, starts = np.unique(level[order, d], return_index=True)
            self.dim += [d] * len(steps)
            self.level += list(steps)
            self.rows += np.split(order.astype(np.intp), starts[1:])
        self.dim, self.level = np.asarray(self.dim), np.asarray(self.level, dtype=x.dtype)
        self.first = np.searchsorted(self.dim, np.arange(x.shape[1]))

    def best(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best rows of the block, best first."""
        qs = q[self.dim]
        # a row of a segment adds between low and high, whatever the row's exact component
        a, b = qs * self.level * STEP, qs * (self.level * STEP + STEP - 1)
        low, high = np.minimum(a, b), np.maximum(a, b)
        least = np.minimum.reduceat(low, self.first)
        gain = low - least[self.dim]
        order = np.argsort(-gain, kind="stable")
        slack = int((np.abs(q) * (STEP - 1)).sum())
        score = np.zeros(len(self.ids), dtype=np.int32 if gain.sum() < 2**31 else self.x.dtype)
        alive = np.flatnonzero(self.ids != own)
        done, keep = 0, max(KEEP, 4 * k)
        for look in LOOKS:
            upto = int(look * len(order))
            for s in order[done:upto]:
                g = gain[s]
                if g:
                    score[self.rows[s]] += g
            done = upto
            if len(alive) > k:
                # the most that a dimension's unprocessed segments can still add
                rest = np.zeros(len(least), dtype=self.x.dtype)
                np.maximum.at(rest, self.dim[order[done:]], gain[order[done:]])
                got = score[alive]
                bar = np.partition(got, len(got) - k)[len(got) - k]
                alive = alive[got + int(rest.sum()) + slack >= bar]
            if len(alive) <= keep:
                break
        exact = self.x[alive] @ q
        top = sorted(range(len(alive)), key=lambda i: (-exact[i], self.ids[alive[i]]))[:k] if exact.dtype == object else np.lexsort((self.ids[alive], -exact))[:k]
        return self.ids[alive][top], exact[top]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v: finite vectors as arrays of doubles."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))


def integers(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x), in 64 bits if all are below ``limit``, else of any size."""
    if np.abs(x).max(initial=0) * scale < limit:
        return np.floor(x * scale).astype(np.int64)
    whole = lambda c: math.floor(c * scale) if math.isfinite(c * scale) else int(c) * scale
    return np.array([[whole(c) for c in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def _packed(df: DataFrame, rows: int, dims: int, least_large: float) -> DataFrame:
    """Blocks of a partition's vectors: n, ids, vecs (bytes).  Those with a component of at least ``least_large`` lie in
    blocks of LARGE_ROWS, the others in blocks of ``rows``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {False: [], True: []}
        for batch in batches:
            ids, x = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8"), np.zeros((batch.num_rows, dims), dtype="<f8")
            inside = np.arange(dims)[None, :] < np.diff(batch.column(1).offsets.to_numpy())[:, None]
            x[inside] = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            is_large = np.abs(x).max(axis=1, initial=0) >= least_large
            for large, most in ((False, rows), (True, LARGE_ROWS)):
                own = np.flatnonzero(is_large == large)
                while len(own):
                    some, own = own[:most - sum(len(i) for i, _ in held[large])], own[most - sum(len(i) for i, _ in held[large]):]
                    held[large].append((ids[some], x[some]))
                    if sum(len(i) for i, _ in held[large]) == most:
                        yield block(held[large])
                        held[large] = []
        for left in held.values():
            if left:
                yield block(left)

    def block(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, x = (np.concatenate(c) for c in zip(*held, strict=True))
        return pa.RecordBatch.from_pydict({"n": [len(ids)], "ids": [ids.tobytes()], "vecs": [x.tobytes()]}, schema=pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("vecs", pa.binary())]))

    return df.mapInArrow(pack, "n long, ids binary, vecs binary")


def _beyond(score: int) -> str | None:
    """A text that orders scores which count as the same 64-bit one; null for a score that fits (see ``NEAR``)."""
    if -2**63 <= score < 2**63:
        return None
    digits = f"{len(str(abs(score))):05d}{abs(score)}"
    return f"6{digits}" if score > 0 else "4" + digits.translate(str.maketrans("0123456789", "9876543210"))


#: The order of scores that fit among those that count as the same.
NEAR = "5"


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query row."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    spark = vectors.sparkSession
    finite = usable(vectors, id_col, vec_col)
    dims = finite.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    if dims == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    limit = math.isqrt(2**62 // dims) - STEP
    blocks = written(_packed(finite, BLOCK_ROWS, dims, limit / scale), "vector_blocks")
    # queries are the same if their integers are
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(F.when(F.abs(x * scale) < 2.0**53, x * scale)).cast("double")).otherwise(x))
    asked = written(finite.where(is_query(F.col("vec_id"))).withColumn("whole", whole).dropDuplicates(["vec_id", "whole"]).drop("whole"), "queries")
    asked_at = fresh_path(spark, "query_blocks")
    _packed(asked.repartition(1 + asked.count() // QUERY_ROWS), QUERY_ROWS, dims, limit / scale).write.parquet(asked_at)

    def integers_of(packed: bytes) -> np.ndarray:
        return integers(np.frombuffer(packed, "<f8").reshape(-1, dims), scale, limit)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(asked_at)
        asked = ds.dataset(base, filesystem=store, format="parquet")
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids, x, made = np.frombuffer(row["ids"], "<i8"), integers_of(row["vecs"]), {}
                for part in asked.to_batches(batch_size=1):  # one block of queries in memory at a time
                    for held in part.to_pylist():
                        q = integers_of(held["vecs"])
                        kind = np.result_type(x, q)
                        if kind not in made:
                            made[kind] = Index(ids, x.astype(kind))
                        yield answer(made[kind], np.frombuffer(held["ids"], "<i8"), q.astype(kind))

    def answer(index: Index, q_ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": [], "beyond": []}
        for i, own in enumerate(q_ids):
            ids, scores = index.best(q[i], own, k)
            out["query_id"] += [own] * len(ids)
            out["vec_id"] += ids.tolist()
            out["score"] += [max(-2**63, min(2**63 - 1, int(x))) for x in scores]
            out["beyond"] += [_beyond(int(x)) for x in scores]
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")] + [("beyond", pa.string())]))

    found = blocks.select("ids", "vecs").repartition(max(1, min(20_000, blocks.count()))).mapInArrow(search, "query_id long, vec_id long, score long, beyond string")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc(F.coalesce("beyond", F.lit(NEAR))), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
