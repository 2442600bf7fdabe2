"""Scans of tables, files and operational sources; configuration."""

from __future__ import annotations

import copy
import re
import tempfile
import threading
import time
import uuid
from collections.abc import Callable, Hashable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table of a folder; named columns are all that is read."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(columns) if columns else df


def working_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share; a temporary one only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name} doesn't exist; run the set-up task first")


def operational(spark: SparkSession, url: str, table: str, column: str, mark=None, **options: str) -> DataFrame:
    """Rows at or after the high-water mark of a JDBC table; the predicate is pushed to the source."""
    df = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return df if mark is None else df.where(F.col(column) >= F.lit(mark))


def point_read(spark: SparkSession, sql: str, frames: dict[str, DataFrame] | None = None, **args) -> list[dict]:
    """Rows of a parameterised query (``:name`` markers, ``{name}`` for frames) as dicts."""
    return [r.asDict(recursive=True) for r in spark.sql(sql, args=args, **(frames or {})).collect()]


def staged(spark: SparkSession, rows: list[tuple], schema: str, name: str) -> DataFrame:
    """The driver's few rows as a view of the given name for SQL."""
    df = spark.createDataFrame(rows, schema)
    df.createOrReplaceTempView(name)
    return df


def landed_pages(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """Rows of landed response pages: the envelope's results, with its request id."""
    raw = spark.read.schema(f"request_id string, results array<struct<{_fields(row_schema)}>>").json(path, multiLine=True)
    return raw.select("request_id", F.explode("results").alias("r")).select("r.*", F.col("request_id").alias("_request_id"))


def _fields(ddl: str) -> str:
    return re.sub(r"(\w+)\s+(?=[a-z])", r"\1:", ddl)


@lru_cache
def config(path: str) -> dict:
    """A YAML file, or JSON where no YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        import json
        return json.loads(text)
    return yaml.safe_load(text) or {}


def section(conf: dict, name: str) -> dict:
    """A section, empty if there is none."""
    found = conf.get(name) or {}
    if not isinstance(found, dict):
        raise ValueError(f"section {name} must be a mapping")
    return found


def overridden(conf: dict, name: str, **values) -> dict:
    """A copy of the configuration with values of a section replaced; the one that was read stays as it is."""
    out = copy.deepcopy(conf)
    out[name] = section(out, name) | {k: v for k, v in values.items() if v is not None}
    return out


def pandas_of(df: DataFrame, column: str, value, order: str, most: int = 100_000):
    """The rows of one key in order as pandas: a bounded read (a longer result is an error, not cut).  The
    filter reaches the scan; whatever is to be done for all keys belongs into grouped tasks instead."""
    rows = df.where(F.col(column) == value).orderBy(order).limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"{column} = {value!r} has more than {most} rows")
    return rows


class Cache:
    """Results of bounded reads, each kept for ``seconds`` (10 minutes by default), ``most`` at a time.

    A failed read isn't kept.  Readers of one key at the same time read once."""

    def __init__(self, seconds: float = 600, most: int = 1000, clock: Callable[[], float] = time.monotonic) -> None:
        self.seconds, self.most, self.clock = seconds, most, clock
        self._held: dict[Hashable, tuple[float, object]] = {}
        self._lock = threading.Lock()
        self._busy: dict[Hashable, threading.Lock] = {}

    def get(self, key: Hashable, read: Callable[[], object]):
        with self._lock:
            turn = self._busy.setdefault(key, threading.Lock())
        with turn:
            held = self._held.get(key)
            if held is not None and self.clock() - held[0] < self.seconds:
                return held[1]
            value = read()
            with self._lock:
                self._held.pop(key, None)
                self._held[key] = (self.clock(), value)
                while len(self._held) > self.most:
                    gone = next(iter(self._held))
                    del self._held[gone]
                    self._busy.pop(gone, None)
            return value

    def clear(self) -> None:
        with self._lock:
            self._held.clear()
            self._busy.clear()
