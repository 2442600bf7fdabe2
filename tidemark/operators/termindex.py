"""A term index in blocks with bounds: the best k documents by BM25, reading only blocks that can matter.

A document belongs to a window: documents of about its length (steps of an eighth of a power of two), cut by a hash
of the id into parts of about WINDOW.  A block is what a term has in a window: (doc_id, tf, n) of its
documents, with the largest tf and the smallest n.  BM25 grows with tf and falls with n, so these two bound
every document of the block whatever the collection's size, mean length and document frequencies become.

A search reads the heads of the asked terms' blocks (the entries' column isn't read) and adds up a window's bounds.
The windows of the highest bounds are scored first; their k-th score is a threshold, and a window whose bound lies
below it holds no document of the best k.  Blocks of the other windows are read and scored, so the result is
that of scoring everything.

The index is kept by change feeds: a segment holds the blocks of documents written anew, the ids that are
gone from the segments before, and signed counts (documents of a term, documents, terms) from which the
statistics follow.  A segment counts once its totals, written last, are there; ``compacted`` writes one segment of all.

Blocks lie sorted by (term, window): the filter on terms reaches the scan and skips row groups.  No term or length,
however frequent, makes a task larger than a window.  A load's texts are dealt by id to tasks of about TEXT bytes, which count a
document's terms within its row and write them (``bags``); what reads these takes at most BAGS bytes of files a task, and
a task that makes blocks or adds up counts has about ENTRIES entries at most.  ``change_feed`` compares snapshots in tasks of about TEXT bytes.
So tasks follow the input, whatever the session's number of partitions.  Rows without id take no part; null and empty texts count as
documents of no terms; an id that comes again in one load counts once, by its first text in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.search import K1, B, terms

#: Documents of a window, about; windows that are scored first; windows that a filter names.
WINDOW, FIRST, NAMED = 256, 16, 1_000
#: Sums by another order of additions differ by less.
SLACK = 1e-9
#: Bytes of text, bytes of written bags and entries of blocks that a task has, about.
TEXT, BAGS, ENTRIES = 16 << 20, 8 << 20, 1 << 18


@dataclass(frozen=True)
class Found:
    """doc_id, score of the best documents; how many blocks the asked terms have and how many were read."""

    rows: DataFrame
    blocks: int
    read: int


def _once(value: Column, f) -> Column:
    """f(value) with the value computed once a row."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _counted(words: Column) -> Column:
    """(term, tf) of a document's words, by the runs of the sorted words."""
    def runs(w: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == F.size(w)) | (F.get(w, i) != F.get(w, i - 1)))
        return _once(ends, lambda e: F.transform(e, lambda end, k: F.struct(F.get(w, end - 1).alias("term"), (end - F.coalesce(F.get(e, k - 1), F.lit(0))).cast("long").alias("tf"))))

    return F.when(F.size(words) > 0, _once(F.sort_array(words), runs)).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))


@contextmanager
def _dealt(spark: SparkSession, entries: int) -> Iterator[None]:
    """Scans and joined partitions of at most BAGS bytes a task and shuffles into a partition for ENTRIES of ``entries`` at least, for
    what is run inside; the session's own settings come back after it."""
    size, joined, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = {key: spark.conf.get(key) for key in (size, joined, parts)}
    spark.conf.set(size, str(BAGS))
    spark.conf.set(joined, str(BAGS))
    spark.conf.set(parts, str(max(int(before[parts]), _tasks(entries))))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _tasks(entries: int) -> int:
    return 1 + entries // ENTRIES


def _texts(docs: DataFrame) -> int:
    """Number of tasks for the documents' texts."""
    return 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TEXT


def _bags(docs: DataFrame, at: str) -> DataFrame:
    """doc_id, gone, n, held (term, tf), written; docs: doc_id, text, gone."""
    told = docs.where("doc_id is not null")
    one = told.repartition(_texts(told), "doc_id").groupBy("doc_id", "gone").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    words = one.select("doc_id", "gone", terms(F.col("text")).alias("w"))
    words.select("doc_id", "gone", F.size("w").cast("long").alias("n"), _counted(F.col("w")).alias("held")).write.mode("overwrite").parquet(at)
    return docs.sparkSession.read.parquet(at)


def _bucket(n: Column) -> Column:
    return F.floor(8 * F.log2(n + 1)).cast("int")


def build(docs: DataFrame, path: str) -> None:
    """A new index below ``path``; docs: doc_id, text."""
    spark = docs.sparkSession
    bags = _bags(docs.select("doc_id", "text", F.lit(False).alias("gone")), f"{path}/bags/seg=0")
    sizes = bags.groupBy(_bucket(F.col("n")).alias("bucket")).agg(F.ceil(F.count("*") / WINDOW).cast("int").alias("parts"))
    sizes.coalesce(1).write.parquet(f"{path}/layout")  # a row a bucket, some hundreds
    _segment(spark, path, 0, bags)


def sync(spark: SparkSession, path: str, gone: DataFrame, fresh: DataFrame) -> int:
    """A further segment: documents (doc_id, text) as they were that are gone, and as they are that are new; an update is both."""
    told = lambda docs, left: docs.select("doc_id", "text", F.lit(left).alias("gone"))
    return _synced(spark, path, told(gone, True).unionByName(told(fresh, False)))


def change_feed(before: DataFrame, after: DataFrame) -> DataFrame:
    """``merge.change_feed`` between two snapshots of documents (doc_id, text); its tasks follow the texts of both."""
    was, now = (df.where("doc_id is not null").select("doc_id", "text") for df in (before, after))
    return merge.change_feed(was, now, ["doc_id"], _texts(was.unionByName(now)))


def sync_changes(spark: SparkSession, path: str, feed: DataFrame) -> int:
    """``sync`` by a change feed of documents (``change_feed``)."""
    return _synced(spark, path, feed.select("doc_id", "text", F.col("change_type").isin("delete", "update_pre").alias("gone")))


def _synced(spark: SparkSession, path: str, docs: DataFrame) -> int:
    number = 1 + spark.read.parquet(f"{path}/totals").agg(F.max("seg")).first()[0]
    _segment(spark, path, number, _bags(docs, f"{path}/bags/seg={number}"))
    return number


def _blocks(entries: DataFrame, n: int) -> DataFrame:
    """Sorted blocks of ``n`` entries (term, window, doc_id, tf, n): one range shuffle, so blocks are made where they lie."""
    entry = F.struct("doc_id", F.col("tf").cast("int").alias("tf"), F.col("n").cast("int").alias("n"))
    dealt = entries.repartitionByRange(_tasks(n), "term", "window").groupBy("term", "window")
    return dealt.agg(F.max("tf").cast("long").alias("most_tf"), F.min("n").cast("long").alias("least_n"), F.collect_list(entry).alias("entries")).sortWithinPartitions("term", "window")


def _segment(spark: SparkSession, path: str, number: int, bags: DataFrame) -> None:
    at = lambda part: f"{path}/{part}/seg={number}"
    entries, every = bags.agg(F.sum(F.when(F.col("gone"), 0).otherwise(F.size("held"))), F.sum(F.size("held"))).first()
    with _dealt(spark, every or 0):
        layout = F.broadcast(spark.read.parquet(f"{path}/layout"))
        fresh = bags.where("not gone").withColumn("bucket", _bucket(F.col("n"))).join(layout, "bucket", "left")
        part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)))
        posted = fresh.select("doc_id", "n", (F.col("bucket").cast("long") * (1 << 32) + part).alias("window"), F.inline("held"))
        _blocks(posted, entries or 0).write.mode("overwrite").parquet(at("blocks"))

        sign = F.when(F.col("gone"), -1).otherwise(1).cast("long")
        if number:
            bags.where("gone").select("doc_id").write.mode("overwrite").parquet(at("gone"))
        counts = bags.select(sign.alias("sign"), F.explode("held.term").alias("term")).groupBy("term").agg(F.sum("sign").alias("docs"))
        counts.where("docs <> 0").repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(at("counts"))
        bags.agg(F.coalesce(F.sum(sign), F.lit(0).cast("long")).alias("docs"), F.coalesce(F.sum(sign * F.col("n")), F.lit(0).cast("long")).alias("terms")).write.mode("overwrite").parquet(at("totals"))


def _read(spark: SparkSession, path: str, part: str, segments: Sequence[int]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{part}").parquet(*[f"{path}/{part}/seg={s}" for s in segments])


def search(spark: SparkSession, path: str, query: Sequence[str], k: int = 20) -> Found:
    """The best ``k`` documents for the query's terms; equal scores (to ten digits) go to the smaller id."""
    asked = sorted(set(query))
    totals = spark.read.parquet(f"{path}/totals").groupBy("seg").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).collect()  # a row a segment
    segments, docs, terms = sorted(r["seg"] for r in totals), sum(r["docs"] for r in totals), sum(r["terms"] for r in totals)
    mean = terms / docs if docs and terms else 1.0
    df = {r["term"]: r["df"] for r in _read(spark, path, "counts", segments).where(F.col("term").isin(asked)).groupBy("term").agg(F.sum("docs").alias("df")).collect()}  # a row a term of the query
    posted = _read(spark, path, "blocks", segments).where(F.col("term").isin(asked))
    idf = F.element_at(F.create_map(*[x for t in asked for x in (F.lit(t), F.log(1 + (F.lit(float(docs)) - df.get(t, 0) + 0.5) / (df.get(t, 0) + 0.5)))]), F.col("term")) if asked else F.lit(0.0)

    def bm25(tf: Column, n: Column) -> Column:
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / F.lit(mean)))

    windows = posted.groupBy("window").agg(F.sum(bm25(F.col("most_tf"), F.col("least_n"))).alias("bound"), F.count("*").alias("blocks"))
    first = windows.orderBy(F.desc("bound"), "window").limit(FIRST).collect()
    scores = _scores(spark, path, posted.where(F.col("window").isin([r["window"] for r in first])), segments, bm25)
    best = _best(scores, k).agg(F.count("*"), F.min("score")).first()
    bar = best[1] - SLACK if best[0] == k else float("-inf")
    needed = windows.where(F.col("bound") >= bar)
    n_windows, n_blocks, read = windows.agg(F.count_if(F.col("bound") >= bar), F.sum("blocks"), F.sum(F.when(F.col("bound") >= bar, F.col("blocks")))).first()
    if n_windows <= NAMED:
        kept = posted.where(F.col("window").isin([r["window"] for r in needed.select("window").collect()]))
    else:
        kept = posted.join(needed.select("window"), "window", "left_semi")
    return Found(_best(_scores(spark, path, kept, segments, bm25), k), n_blocks or 0, read or 0)


def _live(spark: SparkSession, path: str, entries: DataFrame, segments: Sequence[int]) -> DataFrame:
    """Entries (with seg, doc_id) that no later segment calls gone."""
    if len(segments) == 1:
        return entries
    gone = _read(spark, path, "gone", [s for s in segments if s > 0]).groupBy("doc_id").agg(F.max("seg").alias("until"))
    return entries.join(gone, "doc_id", "left").where("until is null or seg >= until").drop("until")


def _scores(spark: SparkSession, path: str, posted: DataFrame, segments: Sequence[int], bm25) -> DataFrame:
    entries = posted.select("seg", "term", F.explode("entries").alias("e")).select("seg", "term", "e.*")
    return _live(spark, path, entries, segments).groupBy("doc_id").agg(F.round(F.sum(bm25(F.col("tf"), F.col("n"))), 10).alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), "doc_id").limit(k)


def compacted(spark: SparkSession, path: str, to: str) -> None:
    """The same index as one segment below ``to``, without what is gone."""
    segments = sorted(r["seg"] for r in spark.read.parquet(f"{path}/totals").select("seg").distinct().collect())
    spark.read.parquet(f"{path}/layout").write.parquet(f"{to}/layout")
    blocks = _read(spark, path, "blocks", segments)
    n = blocks.agg(F.sum(F.size("entries"))).first()[0] or 0
    with _dealt(spark, n):
        entries = blocks.select("seg", "term", "window", F.explode("entries").alias("e")).select("seg", "term", "window", "e.*")
        _blocks(_live(spark, path, entries, segments).select("term", "window", "doc_id", "tf", "n"), n).write.parquet(f"{to}/blocks/seg=0")
        _read(spark, path, "counts", segments).groupBy("term").agg(F.sum("docs").alias("docs")).where("docs <> 0").repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{to}/counts/seg=0")
    _read(spark, path, "totals", segments).agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).write.parquet(f"{to}/totals/seg=0")
