"""Event-time sessions of a stream: state for open ones, a sink for closed ones.

Rows of a key belong to one session while each comes less than ``gap`` after one before it, in whatever order and in whatever
micro-batch they arrive: a late row extends its session, or joins two.  A session is closed once the
watermark, the newest event time less ``late``, has reached its end (last row plus gap); only then is it written, once,
and its state goes, so state holds no more than the sessions of the last ``late`` + ``gap``.  A row that is older than the
watermark and would touch closed time is dropped and counted.  Each micro-batch shuffles its own
rows by key, after partial merging; a restart goes on from the checkpoint.

Rows without event time take no part; a null key is a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Sessions:
    """Where a run's closed sessions and its state lie, and what a session is."""

    path: str
    keys: tuple[str, ...]
    ts: str
    value: str
    gap: str = "30 minutes"
    late: str = "1 day"

    def start(self, stream: DataFrame) -> StreamingQuery:
        """Take in what has arrived, then stop."""
        marked = stream.withWatermark(self.ts, self.late).groupBy(F.session_window(self.ts, self.gap).alias("w"), *self.keys)
        grouped = marked.agg(F.count(F.lit(1)).alias("n"), F.sum(self.value).alias("total"), F.max(self.value).alias("largest"))
        rows = grouped.select(*self.keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total", "largest")
        sink = rows.writeStream.format("parquet").outputMode("append").option("path", f"{self.path}/closed").option("checkpointLocation", f"{self.path}/state")
        return sink.trigger(availableNow=True).start()

    def run(self, stream: DataFrame) -> dict[str, int]:
        """``start`` to its end; rows taken in, and rows dropped because they came after the watermark."""
        query = self.start(stream)
        query.awaitTermination()
        told = query.recentProgress
        return {"rows": sum(p["numInputRows"] for p in told), "dropped": sum(s["numRowsDroppedByWatermark"] for p in told for s in p["stateOperators"])}

    def closed(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.open(spark).schema).parquet(f"{self.path}/closed")

    def open(self, spark: SparkSession) -> DataFrame:
        """Sessions that may still grow, from the state of the last finished batch."""
        state = spark.read.format("statestore").load(f"{self.path}/state")
        # the value holds the window, the keys, and the aggregates' buffers in their order
        names = state.schema["value"].dataType.fieldNames()[1 + len(self.keys):]
        return state.select(*[F.col(f"value.`{k}`").alias(k) for k in self.keys], F.col("value.session_window.start").alias("session_start"), F.col("value.session_window.end").alias("session_end"),
                            *[F.col(f"value.`{n}`").alias(c) for n, c in zip(names, ("n", "total", "largest"), strict=True)])

    def all(self, spark: SparkSession) -> DataFrame:
        return self.closed(spark).withColumn("closed", F.lit(True)).unionByName(self.open(spark).withColumn("closed", F.lit(False)))


def sessions_of(table: DataFrame, keys: Sequence[str], ts: str, value: str, gap: str) -> DataFrame:
    """The same sessions of a table."""
    grouped = table.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("largest"))
    return grouped.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total", "largest")
