"""As-of join: each row gets the last row of the other table at or before its instant, key by key.

Both sides become one table that is shuffled once, by key and time slice, and sorted by time; within a slice the last right row is
carried forward.  The slices' own last right rows, a row each, are carried from slice to slice and joined back on
(key, slice), by which the large side is already placed.  So there is no range join, and a hot key is cut by time: the slices' length is
planned from the counts of both tables, so that the fullest key has about ``rows`` rows a slice.

Of right rows with equal key and instant the one with the largest ``tie`` counts (then any of equal ones: give a tie
that tells them apart).  Left rows without key or instant, or before the first right row, have nulls; right
rows without key or instant take no part.  Every left row comes out once, repeated ones too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the fullest key in a slice, about.
ROWS = 1_000_000


def slice_micros(left: DataFrame, right: DataFrame, key: str, ts: str, rows: int = ROWS) -> int:
    """Microseconds of a slice: the span over the number of slices that the fullest key needs."""
    instants = left.select(key, F.col(ts).cast("timestamp").alias("t")).unionByName(right.select(key, F.col(ts).cast("timestamp").alias("t"))).where(F.col(key).isNotNull() & F.col("t").isNotNull())
    each = instants.groupBy(key).agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    # a key that is full for a short time only needs short slices: the shortest of all keys holds
    needed = (F.unix_micros("high") - F.unix_micros("low") + 1) / F.ceil(F.col("n") / rows)
    found = each.agg(F.min(F.when(F.col("n") > rows, needed)), F.min(F.unix_micros("low")), F.max(F.unix_micros("high"))).first()
    return max(1, int(found[0])) if found[0] else max(1, (found[2] or 0) - (found[1] or 0) + 1)


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, values: Sequence[str], tie: str, rows: int = ROWS) -> DataFrame:
    """The left columns, and ``values`` of the right row; key and ts have these names on both sides."""
    width = slice_micros(left, right, key, ts, rows)
    place = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(width)).cast("long")
    found = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    kind = right.select(found.alias("s")).schema["s"].dataType
    own = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(left.columns)])
    own_kind = left.select(own.alias("s")).schema["s"].dataType
    keyed = right.where(F.col(key).isNotNull() & F.col(ts).isNotNull())

    instant: Column = F.col(ts).cast("timestamp")
    unmatched = F.col(key).isNull() | F.col(ts).isNull()  # any number of these, so they are dealt out
    lefts = left.select(F.col(key).alias("_key"), instant.alias("_ts"), F.when(unmatched, F.pmod(F.monotonically_increasing_id(), F.lit(4_096))).otherwise(place(F.col(ts))).alias("_slice"), F.lit(1).alias("_side"), F.lit(None).cast(keyed.schema[tie].dataType).alias("_tie"), own.alias("_own"), F.lit(None).cast(kind).alias("_found"))
    rights = keyed.select(F.col(key).alias("_key"), instant.alias("_ts"), place(F.col(ts)).alias("_slice"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.lit(None).cast(own_kind).alias("_own"), found.alias("_found"))

    # right rows come before left rows of the same instant
    so_far = Window.partitionBy("_key", "_slice").orderBy("_ts", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    within = lefts.unionByName(rights).withColumn("_last", F.last("_found", ignorenulls=True).over(so_far)).where("_side = 1")

    lasts = rights.groupBy("_key", "_slice").agg(F.max_by("_found", F.struct("_ts", "_tie")).alias("_end"))
    # a slice's mark comes before its own end, so what precedes the mark is the last row of the slices before
    slices = lefts.where("_key is not null and _ts is not null").select("_key", "_slice").distinct()
    marks = slices.select("_key", "_slice", F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_end")).unionByName(lasts.select("_key", "_slice", F.lit(2).alias("_kind"), "_end"))
    before = F.last("_end", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_slice", "_kind").rowsBetween(Window.unboundedPreceding, -1))
    carried = marks.withColumn("_before", before).where("_kind = 1").select("_key", "_slice", "_before")

    joined = within.join(carried, ["_key", "_slice"], "left")
    out = F.when(F.col("_ts").isNotNull(), F.coalesce("_last", "_before"))
    return joined.select(*[F.col("_own")[f"c{i}"].alias(c) for i, c in enumerate(left.columns)], *[out[f"v{i}"].alias(c) for i, c in enumerate(values)])
