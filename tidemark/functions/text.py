"""String functions over columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sentiment labels and their scores (fixed values); any other label scores 0.
SENTIMENT = {"positive": 1, "negative": -1, "neutral": 0}
TICKER = r"^[A-Z][A-Z0-9.\-]{0,9}$"


def redacted(c: Column) -> Column:
    """Secrets in query strings are masked."""
    return F.regexp_replace(c, r"(?i)(apikey=)[^&\s\"']+", "$1***REDACTED***")


def normal_label(c: Column) -> Column:
    return F.lower(F.trim(c))


def sentiment_score(c: Column, scores: Mapping[str, int] = SENTIMENT) -> Column:
    """Score of a label; unknown labels and nulls are neutral."""
    out = F.lit(0)
    for name, score in scores.items():
        out = F.when(normal_label(c) == name, F.lit(score)).otherwise(out)
    return out.cast("int")


def preference_rank(c: Column, order: Sequence[str]) -> Column:
    """Place in ``order`` from 0; what isn't in it comes last."""
    out = F.lit(len(order))
    for i, name in enumerate(order):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out.cast("int")


def normal_ticker(c: Column) -> Column:
    """Upper-cased and trimmed; null if it isn't a ticker."""
    t = F.upper(F.trim(c))
    return F.when(t.rlike(TICKER), t)


def embedding_text(title: Column, description: Column) -> Column:
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.nullif(F.concat_ws("\n", blank(title), blank(description)), F.lit(""))


def document_id(article_id: Column, ticker: Column) -> Column:
    """Null if either part is."""
    return F.concat(article_id, F.lit(":"), ticker)


def snippet(text: Column, title: Column, limit: int = 320) -> Column:
    """Text without its leading title, trimmed, cut at ``limit`` with dots."""
    body = F.trim(F.when(text.startswith(title), F.substr(text, F.length(title) + 1)).otherwise(text), F.lit(" \n"))
    return F.when(F.length(body) > limit, F.concat(F.rtrim(F.substr(body, F.lit(1), F.lit(limit))), F.lit("..."))).otherwise(body)


def truncated(c: Column, limit: int = 1000) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substr(c, F.lit(1), F.lit(limit - 3)), F.lit("..."))).otherwise(c)


def scoped_question(ticker: Column, question: Column) -> Column:
    return F.when(ticker.isNull(), question).otherwise(F.concat(F.lit("[Ticker: "), ticker, F.lit("] "), question))


def publisher_name(c: Column) -> Column:
    """Name inside a JSON object, or the plain string itself."""
    return F.coalesce(F.get_json_object(c, "$.name"), c)


def strings(c: Column) -> Column:
    """Array elements as strings; nulls stay."""
    return F.transform(c, lambda x: x.cast("string"))


def surrogate_id(namespace: str, name: Column) -> Column:
    """Name-based UUID of version 5, computed natively."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    part = lambda a, n: F.substr(digest, F.lit(a), F.lit(n))
    variant = F.substr(F.lit("89ab"), F.conv(part(17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))
