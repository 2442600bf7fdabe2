"""Product codes of vectors: integer codebooks, nearest entries by partial distances.

Components become integers floor(scale * x); a vector is cut into PARTS equal consecutive parts, each with a
codebook of ENTRIES entries that starts as the parts of the vectors of the smallest ids.  A round assigns every
part to its nearest entry (squared Euclidean distance, ties to the lower index) and moves each entry to
the componentwise floor of its parts' mean; unused entries stay.

Search goes by partial distances: a part's dimensions are taken in descending variance of the codebook,
for many vectors at once.  The entry nearest in the first dimension gives a first complete distance; then the entries
come in waves, and a mask drops an entry for a vector once its distance so far strictly exceeds the
vector's best complete one, so that only what is left meets the next dimension.

A round is one pass over the rows: a task adds up its own parts by entry, and the sums of all tasks, at most
ENTRIES times the vector's length, make the next codebooks on the driver; they travel with the next pass.
Sums are exact at any size: each is cut into limbs of 32 bits, which Spark adds up apart.

Edge cases: vectors that are null or hold a null, NaN or infinity are dropped; shorter vectors count as padded
with zeros, and lengths that PARTS doesn't divide up to the next multiple; every finite vector takes part: where distances
could leave 62 bits, those rows of a batch (or a part whose codebook is so large) use integers of any size, and an
error beyond 64 bits counts as the largest that fits; rows without id come last among the ids, rows of one id are
ordered by their vectors; with fewer rows than ENTRIES the codebooks have that many entries; an
empty table gives empty codebooks and no rows; further columns don't matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .shared import join_on_hot_key, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries that are compared before the best distances are looked at again.
WAVE = 16
#: Vectors that are compared at once.
ROWS = 2_048
MOST = 2**63 - 1

Book = np.ndarray
"""A part's entries, a row each: 64-bit integers, or objects where one is too large for squares in 64 bits."""


def usable(vectors: DataFrame, *carried: str, vec_col: str = "embedding") -> DataFrame:
    """The ``carried`` columns and v: the finite vectors."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(*carried, v.cast("array<double>").alias("v"))


def _small(width: int) -> int:
    """Integers up to this have distances over ``width`` components and all parts within 62 bits."""
    return math.isqrt(2**60 // max(1, width * PARTS))


def _whole(x: float, scale: int) -> int:
    return math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale


def integers(column: pa.Array, dims: int, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their integers (rows x dims): of the rows that 64 bits suffice for, then of the others."""
    lengths = np.diff(column.offsets.to_numpy())
    x = np.zeros((len(column), dims))
    x[np.arange(dims)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    small = np.abs(x).max(axis=1, initial=0) < _small(dims // PARTS) / scale
    low, high = np.flatnonzero(small), np.flatnonzero(~small)
    large = np.array([[_whole(c, scale) for c in row] for row in x[high].tolist()], dtype=object).reshape(len(high), dims)
    return [(low, np.floor(x[low] * scale).astype(np.int64)), (high, large)]


def book_of(entries: list[list[int]]) -> Book:
    fits = all(abs(c) < _small(len(e)) for e in entries for c in e)
    return np.array(entries, dtype=np.int64 if fits else object).reshape(len(entries), -1)


def nearest(x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry for each row of x; ties to the lower index."""
    n, width = x.shape
    if not width:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    if book.dtype != x.dtype:
        x, book = x.astype(object), book.astype(object)
    exact = book.astype(object)
    spread = len(book) * (exact * exact).sum(axis=0) - exact.sum(axis=0) ** 2
    first, *rest = sorted(range(width), key=lambda d: -spread[d])

    # a complete distance to begin with: the entry just below the vector in the first dimension
    ascending = np.argsort(book[:, first], kind="stable")
    index = ascending[np.clip(np.searchsorted(book[ascending, first], x[:, first], side="right") - 1, 0, None)]
    best = ((x - book[index]) ** 2).sum(axis=1)
    for start in range(0, len(book), WAVE):
        wave = book[start:start + WAVE]
        so_far = (x[:, first, None] - wave[None, :, first]) ** 2
        rows, entries = np.nonzero(so_far <= best[:, None])
        got = so_far[rows, entries]
        for d in rest:
            got = got + (x[rows, d] - wave[entries, d]) ** 2
            kept = np.flatnonzero(got <= best[rows])
            rows, entries, got = rows[kept], entries[kept], got[kept]
        complete = np.full(so_far.shape, best.max(initial=0) + 1, dtype=best.dtype)
        complete[rows, entries] = got
        at = complete.argmin(axis=1)
        least, at = complete[np.arange(n), at], at + start
        better = (least < best) | (least == best) & (at < index)
        best, index = np.where(better, least, best), np.where(better, at, index)
    return index, best


def _assigned(column: pa.Array, books: list[Book], dims: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, integers by part, entries by part and errors, for some rows at a time."""
    width = dims // PARTS
    for numbers, x in integers(column, dims, scale):
        for start in range(0, len(numbers), ROWS):
            some = x[start:start + ROWS]
            some = some.reshape(len(some), PARTS, width)
            found = [nearest(some[:, p], book) for p, book in enumerate(books)]
            error = sum((e.astype(object) if e.dtype == object else e for _, e in found), np.zeros(len(some), np.int64))
            yield numbers[start:start + ROWS], some, np.stack([i for i, _ in found], axis=1), error


def _sums(rows: DataFrame, books: list[Book], dims: int, scale: int, limbs: int) -> dict[tuple[int, int, int], tuple[int, int]]:
    """(part, entry, position) -> number of assigned parts and their components' sum."""
    width = dims // PARTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((PARTS, ENTRIES, width), dtype=object), np.zeros((PARTS, ENTRIES), dtype=np.int64)
        for batch in batches:
            for _, x, index, _ in _assigned(batch.column(0), books, dims, scale):
                for p in range(PARTS):
                    order = np.argsort(index[:, p], kind="stable")
                    used, starts = np.unique(index[order, p], return_index=True)
                    sums[p, used] += np.add.reduceat(x[order, p], starts, axis=0)
                    counts[p] += np.bincount(index[:, p].astype(np.int64), minlength=ENTRIES)
        out = [(p, e, d, int(counts[p, e]), *_limbs(int(sums[p, e, d]), limbs)) for p, e in np.argwhere(counts).tolist() for d in range(width)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    names = ["part", "entry", "position", "count", *[f"limb{i}" for i in range(limbs)]]
    each = rows.select("v").mapInArrow(add, ", ".join(f"{c} long" for c in names))
    totals = each.groupBy(*names[:3]).agg(*[F.sum(c).alias(c) for c in names[3:]])
    return {(r[0], r[1], r[2]): (r[3], sum(limb << 32 * i for i, limb in enumerate(r[4:]))) for r in totals.collect()}


def _limbs(value: int, limbs: int) -> list[int]:
    return [value >> 32 * i & 0xFFFFFFFF for i in range(limbs - 1)] + [value >> 32 * (limbs - 1)]


def codebooks(rows: DataFrame, id_col: str = "vec_id", rounds: int = ROUNDS, scale: int = SCALE) -> tuple[list[Book], int]:
    """The trained codebooks by part, and the padded length; rows: id, v (see ``usable``)."""
    longest, largest = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    dims = -(-longest // PARTS) * PARTS
    seeds = [[_whole(c, scale) for c in r["v"]] + [0] * (dims - len(r["v"])) for r in rows.orderBy(F.asc_nulls_last(id_col), "v").limit(ENTRIES).collect()]
    if not seeds:
        return [], dims
    width, limbs = dims // PARTS, (_whole(largest or 0.0, scale) + 1).bit_length() // 32 + 3
    books = [book_of([s[p * width:(p + 1) * width] for s in seeds]) for p in range(PARTS)]
    for _ in range(rounds):
        sums = _sums(rows, books, dims, scale, limbs)
        moved = [[[sums[p, e, d][1] // sums[p, e, d][0] if (p, e, d) in sums else int(c) for d, c in enumerate(entry)] for e, entry in enumerate(book.tolist())] for p, book in enumerate(books)]
        books = [book_of(entries) for entries in moved]
    return books, dims


def books_digest(books: list[Book]) -> str:
    """SHA-256 of all components by part, entry and position, as decimals with commas."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book.tolist() for c in entry).encode()).hexdigest()


def encode(rows: DataFrame, books: list[Book], dims: int, scale: int = SCALE) -> DataFrame:
    """``rows`` with code (an index a part, two hex digits each) and error instead of v."""
    kept = [f for f in rows.schema.fields if f.name != "v"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("v")
            others = [c for i, c in enumerate(batch.columns) if i != at]
            for numbers, _, index, error in _assigned(batch.column(at), books, dims, scale):
                digits = index.astype(np.uint8).tobytes().hex()
                codes = [digits[i:i + 2 * PARTS] for i in range(0, len(digits), 2 * PARTS)]
                own = [c.take(pa.array(numbers)) for c in others]
                yield pa.RecordBatch.from_arrays([*own, pa.array(codes, pa.string()), pa.array([min(int(e), MOST) for e in error], pa.int64())], [f.name for f in schema.fields])

    schema = StructType([*kept, StructField("code", StringType()), StructField("error", LongType())])
    return rows.mapInArrow(code, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """id, code, error, label_error (errors of equal labels, nulls together) and the codebooks' digest."""
    books, dims = codebooks(usable(vectors, id_col, vec_col=vec_col), id_col)
    label = F.coalesce(F.concat(F.lit("v"), F.col(label_col).cast("string")), F.lit("n"))
    rows = usable(vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vec_col).alias("vec")), "id", "label", vec_col="vec")
    coded = written(encode(rows, books, dims), "codes")
    most = F.lit(MOST).cast("decimal(38,0)")
    totals = written(coded.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"), F.least(F.sum(F.col("error").cast("decimal(20,0)")), most).cast("long").alias("label_error")), "label_errors")
    out = join_on_hot_key(coded, totals, "label", "_rows", F.col("id"))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
