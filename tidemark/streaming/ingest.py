"""Streams into stores: replays and late rows change nothing, since every batch is an upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import last_wins
from tidemark.operators.store import Store
from tidemark.schema import Table


def landed(spark: SparkSession, path: str, schema, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def upsert_stream(stream: DataFrame, store: Store, table: Table, seq: str, checkpoint: str, shape=None) -> StreamingQuery:
    """Run what has arrived through the store: last row of a key wins, exactly once by its key."""
    def write(batch: DataFrame, _: int) -> None:
        rows = last_wins(batch, table.keys, seq)
        store.upsert(table, rows.select(table.schema.fieldNames()))

    source = stream if shape is None else shape(stream)
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], ts: str, late: str = "1 day") -> DataFrame:
    """First row of a key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(events: DataFrame, ts: str, key: str, value: str, size: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums by event time; works on a stream and on a table."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    return marked.groupBy(F.window(ts, size).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")


def last_result(grouped: DataFrame, path: str) -> DataFrame:
    """Run a grouped stream on what has arrived; the whole result after its last batch.  A batch that runs again replaces its own."""
    spark, done = grouped.sparkSession, []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/result/{number}")
        done.append(number)

    query = grouped.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/result/{done[-1]}") if done else spark.createDataFrame([], grouped.schema)
