"""Set-wise writes: what a merge, a delete or a change feed results in, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """A batch that would match one row more than once."""


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; the order should leave no ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Of the rows of a key, the one that came last."""
    return latest_per_key(df, keys, [F.desc(seq)])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source replace rows of equal key and are added otherwise."""
    return target.join(source, list(keys), "left_anti").unionByName(source.select(target.columns))


def with_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the source whose key isn't there yet are added."""
    return target.unionByName(source.join(target, list(keys), "left_anti").select(target.columns))


def without_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(gone, list(keys), "left_anti")


def retained(target: DataFrame, column: str, floor: Column) -> DataFrame:
    """Rows before the floor go; nulls stay, as in SQL's DELETE."""
    return target.where((F.col(column) >= floor) | F.col(column).isNull() | floor.isNull())


def changed(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the source that differ from the target in any of the columns (nulls equal nulls)."""
    t = target.select([F.col(c).alias(f"_{c}") for c in columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return source.join(t, same, "left_anti")


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """insert, delete, update_pre and update_post rows between two snapshots, compared in ``parts`` tasks (the session's number, if None)."""
    rest = [c for c in before.columns if c not in keys]
    dealt = lambda df: df if parts is None else df.repartition(parts, *keys)
    side = lambda df, s: dealt(df).select(*keys, F.struct(*rest, F.lit(True).alias("_here")).alias(s))
    both = side(before, "a").join(side(after, "b"), list(keys), "full_outer")
    old, new = F.col("a._here").isNotNull(), F.col("b._here").isNotNull()
    differ = ~reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in rest], F.lit(True))
    row = lambda kind, s: F.struct(F.lit(kind).alias("change_type"), *[F.col(f"{s}.{c}").alias(c) for c in rest])
    changes = F.when(old & ~new, F.array(row("delete", "a"))).when(new & ~old, F.array(row("insert", "b"))).when(differ, F.array(row("update_pre", "a"), row("update_post", "b")))
    return both.select(*keys, F.explode(changes).alias("c")).select(*keys, "c.*")


def applied(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table brought up to date by a change feed."""
    touched = changes.select(*keys).distinct()
    fresh = changes.where(F.col("change_type").isin("insert", "update_post")).select(target.columns)
    return target.join(touched, list(keys), "left_anti").unionByName(fresh)


def since(source: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows at or after the high-water mark: the boundary is read again and the upsert makes that harmless."""
    return source if mark is None else source.where(F.col(column) >= mark)
