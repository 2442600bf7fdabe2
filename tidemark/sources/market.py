"""The service's bars and articles as a stream: what each ticker has had since the last run.

``spark.dataSource.register(MarketSource)``; ``spark.readStream.format("market")`` with options ``base``, ``kind`` (bars or news),
``tickers`` (a JSON list), ``since`` (a date), and as in ``rest`` ``per_minute``, ``partitions`` and ``key_env``.

An offset is an instant for each ticker.  A micro-batch asks for [start, end) of every ticker, so neighbouring batches neither
overlap nor leave a hole, and a batch that is run again after a failure asks for the same; with a sink that
writes a batch once, nothing is lost or repeated.  With the trigger ``availableNow`` the first run after a failure finishes the
failed batch, the next one goes on.  The end is ``settle`` minutes ago (bars: the start of that day), when what the
service says of the time before no longer changes; ``until`` fixes it instead.  A ticker that joins the list
starts at ``since``; one that leaves keeps its place for when it returns.  The checkpoint keeps the offsets: a commit
has nothing to do.  A batch's requests are dealt over ``partitions`` tasks, which share the budget.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.client import Client
from tidemark.sources.rest import http_get

#: Routes of the service (fixed values: its contract).
BARS = "{base}/v2/aggs/ticker/{ticker}/range/1/day/{start}/{end}?adjusted=true&sort=asc&limit=50000"
NEWS = "{base}/v2/reference/news?ticker={ticker}&published_utc.gte={start}&published_utc.lt={end}&order=asc&sort=published_utc&limit=1000"
STAMP = "%Y-%m-%dT%H:%M:%SZ"


def request_of(kind: str, base: str, ticker: str, start: str, end: str) -> str:
    """The url of what ``ticker`` has in [start, end); bars go by whole days, the last one inclusive."""
    if kind == "news":
        return NEWS.format(base=base, ticker=quote(ticker), start=start, end=end)
    last = datetime.strptime(end, STAMP) - timedelta(days=1)
    return BARS.format(base=base, ticker=quote(ticker), start=start[:10], end=f"{last:%Y-%m-%d}")


class Requests(InputPartition):
    def __init__(self, asked: list[tuple[str, str, str]]) -> None:
        self.asked = asked


class MarketReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.base, self.kind = options["base"], options.get("kind", "bars")
        if self.kind not in ("bars", "news"):
            raise ValueError(f"kind is bars or news, not {self.kind}")
        self.tickers = sorted(set(json.loads(options["tickers"])))
        self.since = f"{options['since'][:10]}T00:00:00Z"
        self.until, self.settle = options.get("until"), float(options.get("settle", 15))
        self.shares = max(1, int(options.get("partitions", 1)))
        self.rate = float(options.get("per_minute", 5)) / self.shares
        self.key_env = options.get("key_env")

    def initialOffset(self) -> dict:
        return {t: self.since for t in self.tickers}

    def latestOffset(self) -> dict:
        end = datetime.strptime(self.until, STAMP) if self.until else datetime.now(UTC) - timedelta(minutes=self.settle)
        if self.kind == "bars":
            end = end.replace(hour=0, minute=0, second=0)
        return {t: max(f"{end:{STAMP}}", self.since) for t in self.tickers}

    def partitions(self, start: dict, end: dict) -> list[Requests]:
        asked = [(t, start.get(t, self.since), to) for t, to in sorted(end.items()) if start.get(t, self.since) < to]
        return [Requests(asked[i::self.shares]) for i in range(min(self.shares, len(asked)))]

    def read(self, partition: Requests) -> Iterator[tuple]:
        key = os.environ.get(self.key_env, "") if self.key_env else ""
        client = Client(lambda u: http_get(f"{u}{'&' if '?' in u else '?'}apiKey={key}" if key else u), self.rate)
        for ticker, start, end in partition.asked:
            for row in client.pages(request_of(self.kind, self.base, ticker, start, end)):
                yield ticker, row.pop("_request_id"), json.dumps(row)

    def commit(self, end: dict) -> None:
        pass


class MarketSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "market"

    def schema(self) -> str:
        return "ticker string, request_id string, row string"

    def streamReader(self, schema) -> MarketReader:
        return MarketReader(self.options)
