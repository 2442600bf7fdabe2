"""Read models, tools with checked arguments, the index's specification, and the tool loop."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.functions import numeric, text
from tidemark.operators import merge, search
from tidemark.operators.store import Store
from tidemark.schema import TABLES

#: Richer models first (fixed order).
MODEL_ORDER = ("news_markov", "markov", "gbm")
ROUNDS, K = 6, 5


class ToolError(ValueError):
    """What a tool says of a call it can't serve; it is a result, not a failure."""


@dataclass(frozen=True)
class IndexSpec:
    source_table: str = "silver.news_recent"
    primary_key: str = "doc_id"
    embedding_column: str = "embedding_text"
    columns: tuple[str, ...] = ("doc_id", "ticker", "title", "publisher", "published_at", "sentiment_label", "article_url", "embedding_text")
    subtype: str | None = "hybrid"
    sync: str | None = "triggered"

    def drift(self, live: Mapping[str, str | None]) -> list[str]:
        """Where a live index differs: what decides results must be there and equal, the rest only if known."""
        strict = ("source_table", "primary_key", "embedding_column")
        low = lambda v: str(v or "").lower()
        return [f"{k}: index has {live.get(k)!r}, {getattr(self, k)!r} is wanted" for k in (*strict, "subtype", "sync") if low(live.get(k)) != low(getattr(self, k)) and (k in strict or low(live.get(k)))]


def sync_index(store: Store, at: datetime) -> int:
    """Bring the term index up to date with the change feed of its source; documents written anew or gone.

    The first sync, or one whose last version has been vacuumed, builds it from all rows."""
    source, terms, sizes, state = (TABLES[t] for t in ("silver.news_recent", "gold.news_terms", "gold.news_lengths", "gold.index_state"))
    for t in (source, terms, sizes, state):
        store.create(t)
    now, known = store.versions(source.name), store.read(state).where(F.col("source") == source.name).first()
    text = F.col("embedding_text").alias("text")
    if known is None or known["version"] not in now:
        fresh, gone = store.read(source, now[-1]).select("doc_id", "ticker", text).where("doc_id is not null"), None
    else:
        feed = store.changes(source, known["version"], now[-1]).where("doc_id is not null").persist()
        fresh = feed.where(F.col("change_type").isin("insert", "update_post")).select("doc_id", "ticker", text)
        gone = feed.where(F.col("change_type").isin("delete", "update_pre")).select("doc_id", "ticker", text)
    changed = 0
    if gone is not None and not gone.isEmpty():
        store.delete_keys(terms, search.postings(gone).select("term", "doc_id").distinct())
        store.delete_keys(sizes, gone.select("doc_id").distinct())
        changed += gone.count()
    fresh = fresh.dropDuplicates(["doc_id"])
    store.upsert(terms, search.postings(fresh, "ticker"))
    changed += store.upsert(sizes, search.lengths(fresh, "ticker"))
    store.upsert(state, store.spark.createDataFrame([(source.name, now[-1], at)], state.schema))
    return changed


def indexed_scores(store: Store, ticker: str, query: str):
    """doc_id, score of a ticker's documents by the term index: reads the buckets of the asked terms."""
    asked, terms = search.query_terms(query), TABLES["gold.news_terms"]
    keys = store.spark.createDataFrame([(t,) for t in asked], "term string")
    posted = store.read_keys(terms, keys).where(F.col("ticker") == ticker)
    return search.bm25_of(posted, store.read(TABLES["gold.news_lengths"]).where(F.col("ticker") == ticker), asked)


def latest_forecasts(store: Store):
    """One row a ticker: the newest day, its richest model; regime as a struct that may be missing."""
    order = [F.desc("as_of_date"), text.preference_rank(F.col("model_used"), MODEL_ORDER), F.desc("generated_at")]
    f = merge.latest_per_key(store.read(TABLES["gold.forecast_runs"]), ["ticker"], order)
    store.create(TABLES["gold.regime_states"])
    r = store.read(TABLES["gold.regime_states"]).select("ticker", "as_of_date", F.struct("prob_low_vol", "prob_high_vol", "low_vol_sigma", "high_vol_sigma").alias("regime"))
    return f.join(r, ["ticker", "as_of_date"], "left")


def market_page(store: Store):
    """Headline columns of every ticker."""
    high, low = F.col("prob_high_vol"), F.col("prob_low_vol")
    return latest_forecasts(store).select("ticker", "as_of_date", F.when(high.isNotNull(), numeric.regime_badge(low, high)).alias("badge"), numeric.direction(F.col("prob_positive")).alias("direction"), numeric.money(F.col("price_p10")).alias("low"), numeric.money(F.col("price_p50")).alias("middle"), numeric.money(F.col("price_p90")).alias("high"), numeric.band_offset(F.col("current_price"), F.col("price_p10"), F.col("price_p90")).alias("place"))


def _ticker(value: str) -> str:
    t = str(value).strip().upper()
    if not re.fullmatch(text.TICKER, t):
        raise ToolError(f"not a ticker: {value!r}")
    return t


@dataclass
class Tools:
    """Four tools over the tables; user and watchlist come from the caller, never from the model."""

    store: Store
    user_id: str
    watchlist_id: str
    vectors: object = None  # DataFrame doc_id, embedding
    embed: Callable[[str], list[float]] | None = None

    #: name -> (required, optional) arguments
    ARGUMENTS = {"get_market_forecast": (("ticker",), ()), "search_market_news": (("ticker", "query"), ("k",)), "update_watchlist": (("action", "ticker"), ()), "save_research_report": (("ticker", "question", "report_md"), ())}

    def specs(self) -> list[dict]:
        kind = lambda a: {"type": "integer"} if a == "k" else {"type": "string"}
        return [{"type": "function", "function": {"name": n, "description": getattr(self, n).__doc__, "parameters": {"type": "object", "properties": {a: kind(a) for a in (*req, *opt)}, "required": list(req), "additionalProperties": False}}} for n, (req, opt) in self.ARGUMENTS.items()]

    def execute(self, name: str, arguments: Mapping | str | None) -> dict:
        if name not in self.ARGUMENTS:
            raise ToolError(f"no tool {name}")
        given = json.loads(arguments) if isinstance(arguments, str) else dict(arguments or {})
        required, optional = self.ARGUMENTS[name]
        missing, more = [a for a in required if a not in given], sorted(set(given) - set(required) - set(optional))
        if missing or more:
            raise ToolError(f"{name}: missing {missing}, unknown {more}")
        return getattr(self, name)(**given)

    def get_market_forecast(self, ticker: str) -> dict:
        """Latest stored forecast of a ticker with its regime."""
        row = latest_forecasts(self.store).where(F.col("ticker") == _ticker(ticker)).first()
        return {"found": False, "ticker": _ticker(ticker)} if row is None else {"found": True} | row.asDict(recursive=True)

    def search_market_news(self, ticker: str, query: str, k: int = K) -> dict:
        """Articles of a ticker that fit a question best, with snippets."""
        if not str(query or "").strip():
            raise ToolError("the query is empty")
        recent = self.store.read(TABLES["silver.news_recent"])
        docs = recent.where(F.col("ticker") == _ticker(ticker)).withColumn("text", F.col("embedding_text"))
        indexed = self.store.exists("gold.news_terms") and search.query_terms(query)
        scores = indexed_scores(self.store, _ticker(ticker), query) if indexed else search.bm25(docs.select("doc_id", "text"), search.query_terms(query))
        lists = [search.ranked(scores, 50)]
        if self.vectors is not None and self.embed is not None:
            lists.append(search.ranked(search.nearest(self.vectors.join(docs.select("doc_id"), "doc_id", "left_semi"), self.embed(query), 50), 50))
        best = search.fused(lists, search.clamp_k(k))
        found = docs.join(F.broadcast(best), "doc_id").orderBy(F.desc("score"), "doc_id")  # at most 20 rows
        return {"results": [r.asDict() for r in found.select("title", "publisher", "published_at", "sentiment_label", "article_url", text.snippet(F.col("embedding_text"), F.col("title")).alias("snippet")).collect()]}

    def update_watchlist(self, action: str, ticker: str) -> dict:
        """Add or remove a ticker; returns the list as it is now."""
        table, t = TABLES["app.watchlist_tickers"], _ticker(ticker)
        if action not in ("add", "remove"):
            raise ToolError(f"no action {action}")
        self.store.create(table)
        row = self.store.spark.createDataFrame([(self.watchlist_id, t, datetime.now(UTC), self.user_id)], table.schema)
        if action == "add":
            self.store.insert_absent(table, row)
        else:
            self.store.delete_keys(table, row.select(*table.keys))
        held = self.store.read(table).where(F.col("watchlist_id") == self.watchlist_id).select("ticker").orderBy("ticker")
        return {"tickers": [r[0] for r in held.collect()]}

    def save_research_report(self, ticker: str, question: str, report_md: str) -> dict:
        """Save a finished report; an empty one is refused."""
        if not report_md.strip():
            raise ToolError("the report is empty")
        table, report_id = TABLES["app.research_reports"], str(uuid.uuid4())
        known = None
        if self.store.exists("gold.forecast_runs"):
            known = self.get_market_forecast(ticker).get("forecast_id")
        self.store.upsert(table, self.store.spark.createDataFrame([(report_id, self.user_id, _ticker(ticker), question, report_md, known, datetime.now(UTC))], table.schema))
        return {"report_id": report_id}


@dataclass
class Answer:
    content: str
    trail: list[dict] = field(default_factory=list)

    @property
    def forecast_id(self) -> str | None:
        return next((t["result"].get("forecast_id") for t in reversed(self.trail) if t["tool"] == "get_market_forecast" and t["result"].get("found")), None)


def converse(question: str, tools: Tools, model: Callable[[list[dict], list[dict]], dict], rounds: int = ROUNDS) -> Answer:
    """Ask ``model(messages, specs)`` until it calls no tool (at most ``rounds`` times); a tool's error is its result."""
    messages, trail = [{"role": "user", "content": question}], []
    for _ in range(rounds):
        said = model(messages, tools.specs())
        messages.append(said)
        calls = said.get("tool_calls") or []
        if not calls:
            return Answer(said.get("content") or "", trail)
        for call in calls:
            try:
                result = tools.execute(call["name"], call.get("arguments"))
            except (ToolError, ValueError) as e:
                result = {"error": str(e)}
            trail.append({"tool": call["name"], "result": result})
            messages.append({"role": "tool", "name": call["name"], "content": json.dumps(result, default=str)})
    return Answer("No answer within the allowed number of rounds.", trail)
