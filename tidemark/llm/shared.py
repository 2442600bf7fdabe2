"""What the corpus operators share: the shared folder, written tables, bounded broadcasts, salted joins.

Recovery: intermediate results are written as Parquet to the folder that the
cluster names in ``spark.checkpoint.dir``, so a lost executor costs its running
tasks only.  No block of any operator lives on one executor alone.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

#: Rows and bytes that a Python worker works on at once (or one row).
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: A side of a join is broadcast only when it has been measured and has at most so many rows and bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
#: Keys of a join that hold more than 1 / HOT_KEYS of all rows are split.
HOT_KEYS = 10_000

_scopes: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where that is unset, a temporary one, but only for a
    local master: executors of a cluster don't share the driver's disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", uuid.uuid4().hex)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, below the innermost scope or else the application's own folder."""
    base = _scopes[-1] if _scopes else f"{shared_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    return f"{base}/{uuid.uuid4().hex}/{name}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is written inside goes at the end; results must have been written elsewhere or collected by then."""
    folder = fresh_path(spark, "scope")
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    return write_to(df, fresh_path(df.sparkSession, name))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows and BATCH_BYTES bytes (or one row), without copying."""
    for batch in batches:
        left = [batch]
        while left:
            part = left.pop()
            if part.num_rows > rows or part.num_rows > 1 and part.nbytes > BATCH_BYTES:
                half = part.num_rows // 2
                left += [part.slice(half), part.slice(0, half)]
            elif part.num_rows:
                yield part


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside; the session's own setting comes back after it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bytes(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType | BinaryType):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    if isinstance(kind, StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16).cast("long"))
    if isinstance(kind, ArrayType):
        return F.aggregate(F.coalesce(value, F.array().cast(kind)), F.lit(16).cast("long"), lambda n, x: n + _bytes(x, kind.elementType))
    return F.lit(8).cast("long")


def fits(df: DataFrame) -> bool:
    """Whether a (written) frame is small enough, in rows and in bytes, to be broadcast."""
    of = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes(of, df.schema)), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def join_on_hot_key(big: DataFrame, small: DataFrame, key: str, weight: str, salt_by: Column, how: str = "left") -> DataFrame:
    """Join of ``big`` to ``small`` (unique by ``key``) where one key may hold a third of ``big``.

    ``weight`` is a column of ``small``: how many rows of ``big`` have the key; it isn't returned.
    A small side that fits is broadcast.  Beyond that, a key with more than 1 / HOT_KEYS of the
    total weight is split into parts of about that size: its row in ``small`` comes once for each,
    its rows in ``big`` are dealt by ``salt_by``.  Only the hot keys' hashes and numbers of parts
    are broadcast, at most HOT_KEYS of 16 bytes.
    """
    if fits(small):
        return big.join(F.broadcast(small.drop(weight)), key, how)
    total = small.agg(F.sum(weight)).first()[0] or 0
    part = max(1, total // HOT_KEYS)
    hot = small.where(F.col(weight) > part).groupBy(F.xxhash64(key).alias("_hash")).agg(F.max(F.ceil(F.col(weight) / part)).cast("long").alias("_parts"))
    hot = F.broadcast(hot)
    dealt = big.withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left").withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.coalesce("_parts", F.lit(1).cast("long"))))
    repeated = small.drop(weight).withColumn("_hash", F.xxhash64(key)).join(hot, "_hash", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1).cast("long")) - 1)))
    joined = dealt.drop("_hash", "_parts").join(repeated.drop("_hash", "_parts"), [key, "_salt"], how)
    return joined.drop("_salt").select(*big.columns, *[c for c in small.columns if c not in (key, weight)])



def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with pos, a row's place from 0 in its group by the ``order`` columns (nulls first), and n, the group's rows.

    One range sort on (group, order), written with running numbers; the groups' counts in its partitions
    give the rest, so a group may have any size.  Equal rows have no order among themselves, and are dealt
    over partitions too.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the upper bits of the number are the partition's, the lower 33 bits count its rows
    numbered = written(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33).alias("_part")
    parts = numbered.groupBy(part, group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    of = Window.partitionBy(group)
    before = F.coalesce(F.sum("_count").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(parts.select("_part", group, (before - F.col("_first")).alias("_start"), F.sum("_count").over(of).alias("n")), "starts")
    starts = F.broadcast(starts) if fits(starts) else starts
    starts = starts.withColumnRenamed(group, "_of")
    out = numbered.join(starts, (F.shiftright("_at", 33) == F.col("_part")) & F.col(group).eqNullSafe(F.col("_of")))
    return out.select(*rows.columns, (F.col("_start") + F.col("_at")).alias("pos"), "n")
