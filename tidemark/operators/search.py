"""Hybrid retrieval: BM25 over terms, exact cosine over vectors, fused by reciprocal ranks.

Documents can be searched as they are (one pass that tokenises all of them), or by postings that
were written once: a query then reads the asked terms' postings and the documents' lengths only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Usual constants of BM25 and of reciprocal-rank fusion (fixed values).
K1, B, RRF = 1.2, 0.75, 60
WORDS = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def query_terms(query: str) -> list[str]:
    import re
    return sorted(set(re.findall(r"[^\W_]+", query.lower())))


def filter_of(document: str) -> Column:
    """The condition of a JSON filter document: each column equals its value or is one of a list; no column, no
    condition.  Values are literals, never text of a query."""
    given = json.loads(document or "{}")
    if not isinstance(given, dict):
        raise ValueError("a filter document is an object")
    out = F.lit(True)
    for name, value in given.items():
        out = out & (F.col(name).isin(value) if isinstance(value, list) else F.col(name).eqNullSafe(F.lit(value)))
    return out


def decoded(response: dict) -> list[dict]:
    """Rows of a service's answer by column name: names from its manifest, values in lists.  A row that is
    shorter lacks its last columns; a column nobody expects goes with its own name."""
    names = [c["name"] for c in (response.get("manifest") or {}).get("columns") or []]
    return [dict(zip(names, row, strict=False)) for row in (response.get("result") or {}).get("data_array") or []]


def clamp_k(k: int, most: int = 20) -> int:
    return max(1, min(int(k), most))


def bm25(docs: DataFrame, query: Sequence[str]) -> DataFrame:
    """doc_id, score of the documents that hold a query term.  One pass counts documents, lengths
    and document frequencies; a document's row carries its own term counts, so nothing is exploded."""
    asked = list(query)
    bags = docs.select("doc_id", terms(F.coalesce("text", F.lit(""))).alias("w")).select("doc_id", F.size("w").alias("n"), *[F.size(F.filter("w", _equals(t))).alias(f"tf{i}") for i, t in enumerate(asked)])
    stats = bags.agg(F.count("*").alias("docs"), F.avg("n").alias("mean"), *[F.sum((F.col(f"tf{i}") > 0).cast("long")).alias(f"df{i}") for i in range(len(asked))])
    joined = bags.where(" or ".join(f"tf{i} > 0" for i in range(len(asked))) or "false").crossJoin(F.broadcast(stats))  # one row of statistics
    score = F.lit(0.0)
    for i in range(len(asked)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.ln(1 + (F.col("docs") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("n") / F.col("mean")))
    return joined.select("doc_id", score.alias("score"))


def postings(docs: DataFrame, *own: str) -> DataFrame:
    """term, doc_id, the ``own`` columns, tf, n: how often a document holds a term, and how many terms it has."""
    bags = docs.select("doc_id", *own, terms(F.coalesce("text", F.lit(""))).alias("w")).withColumn("n", F.size("w").cast("long"))
    return bags.select("doc_id", *own, "n", F.explode("w").alias("term")).groupBy("term", "doc_id", *own, "n").agg(F.count("*").alias("tf")).select("term", "doc_id", *own, "tf", "n")


def lengths(docs: DataFrame, *own: str) -> DataFrame:
    """doc_id, the ``own`` columns, n."""
    return docs.select("doc_id", *own, F.size(terms(F.coalesce("text", F.lit("")))).cast("long").alias("n"))


def bm25_of(posted: DataFrame, sizes: DataFrame, query: Sequence[str]) -> DataFrame:
    """The same scores as ``bm25`` from postings and lengths."""
    asked = posted.where(F.col("term").isin(list(query)))
    stats = sizes.agg(F.count("*").alias("docs"), F.avg("n").alias("mean"))
    df = asked.groupBy("term").agg(F.count("*").alias("df"))  # a row for each term of the query
    tf, n = F.col("tf"), F.col("n")
    idf = F.ln(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    each = asked.join(F.broadcast(df), "term").crossJoin(F.broadcast(stats))  # one row of statistics
    return each.groupBy("doc_id").agg(F.sum(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / F.col("mean")))).alias("score"))


def _equals(term: str):
    return lambda x: x == term


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, query: Sequence[float], k: int) -> DataFrame:
    """doc_id, score of the k nearest; a heap of k rows a partition, then of k."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select("doc_id", cosine(F.col("embedding"), q).alias("score")).where("score is not null").orderBy(F.desc("score"), "doc_id").limit(k)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    """doc_id, rank of the best k."""
    top = scores.orderBy(F.desc("score"), "doc_id").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "doc_id")))  # over k rows


def fused(lists: Sequence[DataFrame], k: int) -> DataFrame:
    """doc_id, score: sum of 1 / (RRF + rank) over the lists, best k."""
    out = None
    for one in lists:
        part = one.select("doc_id", (1.0 / (F.lit(RRF) + F.col("rank"))).alias("s"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id").agg(F.sum("s").alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)


def hybrid(docs: DataFrame, vectors: DataFrame, query: str, query_vector: Sequence[float], k: int = 5, depth: int = 50, where: Column | None = None) -> DataFrame:
    """Filter first, then both rankings of ``depth``, fused to k."""
    kept = docs if where is None else docs.where(where)
    own = vectors.join(kept.select("doc_id"), "doc_id", "left_semi") if where is not None else vectors
    return fused([ranked(bm25(kept, query_terms(query)), depth), ranked(nearest(own, query_vector, depth), depth)], clamp_k(k))
