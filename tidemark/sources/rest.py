"""Daily bars and news articles of a paginated service as a Spark data source.

``spark.dataSource.register(PagedSource)``; ``spark.read.format("paged_json")`` with options
``urls`` (a JSON list), ``per_minute``, and ``key_env`` (the environment variable that holds the
key, so that it never stands in a plan).  All urls share one partition unless
``partitions`` says otherwise, because the request budget is global.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.client import Client


def http_get(url: str) -> tuple[int, dict]:
    try:
        with urllib.request.urlopen(url, timeout=30) as r:
            return r.status, json.loads(r.read())
    except urllib.error.HTTPError as e:
        return e.code, {}


def fetched(asked: DataFrame, per_minute: float, key_env: str | None = None) -> DataFrame:
    """ticker, request_id, row (JSON) of all pages of the urls; asked: ticker, url.  A task asks one after the other."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = os.environ.get(key_env, "") if key_env else ""
        client = Client(lambda u: http_get(f"{u}{'&' if '?' in u else '?'}apiKey={key}" if key else u), per_minute)
        for batch in batches:
            for one in batch.to_pylist():
                rows = [(one["ticker"], row.pop("_request_id"), json.dumps(row)) for row in client.pages(one["url"])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["ticker", "request_id", "row"])

    return asked.select("ticker", "url").mapInArrow(fetch, "ticker string, request_id string, row string")


class Share(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.urls = json.loads(options["urls"])
        self.shares = max(1, int(options.get("partitions", 1)))
        self.rate = float(options.get("per_minute", 5)) / self.shares
        self.key_env = options.get("key_env")

    def partitions(self) -> list[Share]:
        return [Share(self.urls[i::self.shares]) for i in range(min(self.shares, max(1, len(self.urls))))]

    def read(self, partition: Share) -> Iterator[tuple]:
        key = os.environ.get(self.key_env, "") if self.key_env else ""
        signed = lambda u: f"{u}{'&' if '?' in u else '?'}apiKey={key}" if key else u
        client = Client(lambda u: http_get(signed(u)), self.rate)
        for url in partition.urls:
            for row in client.pages(url):
                yield url, row.pop("_request_id"), json.dumps(row)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "url string, request_id string, row string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)
