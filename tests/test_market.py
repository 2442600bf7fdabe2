"""The service as a stream: restarts and failed batches lose and repeat nothing."""

import json
import re
from collections import Counter
from datetime import datetime, timedelta
from urllib.parse import parse_qs, urlsplit

import pytest

from tidemark.sources import market

T0 = datetime(2026, 8, 1)
SAID = {t: [T0 + timedelta(hours=7 * i + k) for i in range(30)] for k, t in enumerate(["AAA", "B B", "CCC"])}


def news(refused, asked):
    """Articles of a ticker in [gte, lt), three a page; tickers in ``refused`` are refused."""
    def answer(path):
        asked.append(path)
        q = {k: v[0] for k, v in parse_qs(urlsplit(path).query).items()}
        if q["ticker"] in refused:
            return 403, {}
        start, end = (datetime.strptime(q[f"published_utc.{k}"], market.STAMP) for k in ("gte", "lt"))
        at = int(q.get("page", 0))
        found = [{"id": f"{q['ticker']}-{t:%d%H}", "published_utc": t.strftime(market.STAMP)} for t in SAID[q["ticker"]] if start <= t < end]
        body = {"request_id": f"r{len(asked)}", "results": found[3 * at:3 * at + 3]}
        if found[3 * at + 3:]:
            body["next_url"] = f"http://{answer.host}{re.sub(r'&page=.*', '', path)}&page={at + 1}"
        return 200, body

    return answer


def run(spark, base, folder, until, tickers=("AAA", "B B"), **options):
    spark.dataSource.register(market.MarketSource)
    stream = spark.readStream.format("market").options(base=base, kind="news", tickers=json.dumps(tickers), since="2026-08-01", until=f"{until:{market.STAMP}}", per_minute="600000", partitions="2", **options).load()
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()


def ids(spark, folder):
    return Counter(json.loads(r["row"])["id"] for r in spark.read.parquet(f"{folder}/out").collect())


def test_restarts_and_failures_lose_and_repeat_nothing(spark, service, tmp_path):
    refused, asked = set(), []
    answer = news(refused, asked)
    base, folder = service(answer), f"file://{tmp_path}"
    answer.host = base.removeprefix("http://")
    want = lambda until, *tickers: Counter(f"{t}-{x:%d%H}" for t in tickers for x in SAID[t] if x < until)
    one, two, three = T0 + timedelta(days=2), T0 + timedelta(days=4, hours=7), T0 + timedelta(days=20)
    run(spark, base, folder, one)
    assert ids(spark, folder) == want(one, "AAA", "B B")
    before = len(asked)
    run(spark, base, folder, one)
    assert len(asked) == before  # nothing new to ask for
    refused.add("B B")
    with pytest.raises(Exception, match="403"):
        run(spark, base, folder, two)
    refused.clear()
    run(spark, base, folder, three, ("AAA", "B B", "CCC"))  # finishes the failed batch
    assert ids(spark, folder) == want(two, "AAA", "B B")
    run(spark, base, folder, three, ("AAA", "B B", "CCC"))  # the rest, and a new ticker
    assert ids(spark, folder) == want(three, "AAA", "B B", "CCC")
    assert {r["ticker"] for r in spark.read.parquet(f"{folder}/out").select("ticker").distinct().collect()} == {"AAA", "B B", "CCC"}


def test_offsets_and_requests():
    reader = market.MarketReader({"base": "u", "tickers": '["B", "A", "A"]', "since": "2026-08-01", "until": "2026-08-04T10:30:00Z", "partitions": "2"})
    start, end = reader.initialOffset(), reader.latestOffset()
    assert end == {"A": "2026-08-04T00:00:00Z", "B": "2026-08-04T00:00:00Z"}  # bars of whole days
    assert [p.asked for p in reader.partitions(start, end)] == [[("A", "2026-08-01T00:00:00Z", "2026-08-04T00:00:00Z")], [("B", "2026-08-01T00:00:00Z", "2026-08-04T00:00:00Z")]]
    assert reader.partitions(end, end) == [] and [p.asked for p in reader.partitions({"A": end["A"]}, end)] == [[("B", start["B"], end["B"])]]
    assert "/ticker/A%20B/range/1/day/2026-08-01/2026-08-03?" in market.request_of("bars", "u", "A B", start["A"], end["A"])
    late = market.MarketReader({"base": "u", "tickers": '["A"]', "since": "2999-01-01", "kind": "news"})
    assert late.latestOffset() == late.initialOffset() and late.partitions(late.initialOffset(), late.latestOffset()) == []
    with pytest.raises(ValueError, match="bars or news"):
        market.MarketReader({"base": "u", "tickers": "[]", "since": "2026-08-01", "kind": "x"})
