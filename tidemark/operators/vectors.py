"""A vector index: a trained coarse quantiser, posting lists in blocks, probed lists or an exact way.

Vectors become unit vectors, so that the nearest by cosine is the nearest by Euclidean distance.  K-means, trained
on a bounded sample, gives the centres; every vector is then posted in the list of its nearest centre.  A list lies
sorted by the distance to its centre and cut into blocks of at most BLOCK vectors, each with the least and largest of these
distances, so a list may hold any share of the vectors and no task more than a block.

A search compares queries with blocks.  ``probed``: the blocks of the ``probes`` lists whose centres are nearest
to the query; how many that takes is measured when the index is built: CALIBRATION vectors are searched exactly, and
the places of their neighbours' lists among the lists by distance tell the recall of every number of probes.  ``exact``: the lists probed first give every query a distance that its k-th neighbour can't exceed;
by the triangle inequality a vector of a block is no nearer to the query than the block's ring around the
centre, so the blocks whose ring lies beyond that distance are skipped and all others are compared.
Centres are few (``lists``, 4,096 at most) and are read by every task; queries meet blocks in groups
of at most BLOCK queries and one block, whatever the sizes of a list and of the query set, and of a pair of
groups only the k best of each query come out.

Vectors that are null, empty or without length, or that hold a null, NaN or infinity, take no part; neither do rows
without id.  Equal scores go to the smaller id.  Repeated ids are rows of their own; a query's own id isn't its neighbour.
A query id with
several vectors asks for the best of them all.  An empty table has an empty index and no answers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Vectors in a block, and queries that meet it at once.
BLOCK = 4_096
#: Most vectors that train the quantiser, most lists, rounds of training, and its seed.
SAMPLE, LISTS, ROUNDS, SEED = 200_000, 4_096, 10, 7
#: Vectors that are searched exactly to choose the probes, neighbours of each, and the recall that they must reach.
CALIBRATION, NEIGHBOURS, RECALL = 256, 5, 0.93
#: Sums of products by another order of additions differ by less; so do distances made of them.
SLACK, FAR = 1e-9, 1e-6


def unit(vector: Column) -> Column:
    """The vector at length 1 in doubles; null where it can't be."""
    v = vector.cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)) & (length > 0) & (length < float("inf"))
    # the length is bound once a row: inside the inner function it would be added up again for each component
    return F.when(usable, F.get(F.transform(F.array(length), lambda one: F.transform(v, lambda x: x / one)), F.lit(0)))


def _units(vectors: DataFrame) -> DataFrame:
    return vectors.where("doc_id is not null").select("doc_id", unit(F.col("embedding")).alias("u")).where("u is not null")


@dataclass(frozen=True)
class VectorIndex:
    """Centres, and two tables: ``posted`` (list, block, doc_id, u, far) and ``blocks`` (list, block, n, least, most)."""

    centres: np.ndarray
    posted: DataFrame
    blocks: DataFrame
    probes: int

    def nearest_lists(self, vector: list[float], probes: int) -> list[int]:
        """For one query: the lists to read; the filter on ``list`` reaches the scan."""
        v = np.asarray(vector, float)
        return np.argsort(((self.centres - v / np.linalg.norm(v)) ** 2).sum(axis=1), kind="stable")[:probes].tolist()


def lists_for(rows: int) -> int:
    """About the root of the rows: lists and centres are then equally much work."""
    return max(1, min(LISTS, round(math.sqrt(rows))))


def build(vectors: DataFrame, path: str, lists: int | None = None, recall_target: float | None = RECALL) -> VectorIndex:
    """Train, post, choose the probes and write below ``path``; vectors: doc_id, embedding.  Without a target nothing
    is calibrated and probes are all lists: for exact searches, whose results don't depend on that number."""
    spark = vectors.sparkSession
    _units(vectors).write.parquet(f"{path}/units")
    units = spark.read.parquet(f"{path}/units")
    rows = units.count()
    if not rows:
        schema = "list int, block long, doc_id {}, u array<double>, far double".format(dict(vectors.dtypes)["doc_id"])
        spark.createDataFrame([], schema).write.parquet(f"{path}/posted")
        spark.createDataFrame([], "list int, centre array<double>").write.parquet(f"{path}/centres")
        spark.createDataFrame([(0,)], "probes int").write.parquet(f"{path}/probes")
        return load(spark, path)
    # by a hash of the id: the same sample whatever the files' order
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, SAMPLE / rows))
    sample = units.where(share).select(array_to_vector("u").alias("features"))
    fitted = KMeans(k=lists or lists_for(rows), maxIter=ROUNDS, seed=SEED, initMode="random").fit(sample)
    centres = np.array(fitted.clusterCenters())
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "list int, centre array<double>").coalesce(1).write.parquet(f"{path}/centres")

    assigned = fitted.transform(units.withColumn("features", array_to_vector("u"))).select(F.col("prediction").alias("list"), "doc_id", "u")
    assigned.write.parquet(f"{path}/assigned")
    held = _with_distance(spark.read.parquet(f"{path}/assigned"), spark.read.parquet(f"{path}/centres"))
    # one range sort by (list, distance); blocks are numbered within their partition, so none crosses a border
    keys = ["list", "far", "doc_id"]
    placed = held.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed.withColumn("block", F.expr(f"at div {BLOCK}")).drop("at").write.parquet(f"{path}/posted")
    if recall_target is None:
        spark.createDataFrame([(len(centres),)], "probes int").coalesce(1).write.parquet(f"{path}/probes")
        return load(spark, path)
    made = _opened(spark, path, 0)
    few = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, CALIBRATION / rows))
    chosen = probes_for(made, vectors.where(few), recall_target)
    spark.createDataFrame([(chosen,)], "probes int").coalesce(1).write.parquet(f"{path}/probes")
    return load(spark, path)


def probes_for(index: VectorIndex, sample: DataFrame, target: float = RECALL, k: int = NEIGHBOURS) -> int:
    """The fewest lists that hold the ``target`` share of the sample's true neighbours (a bounded sample: a row a neighbour
    goes to an aggregate over the lists' places)."""
    truth = exact(index, sample, k, 1).select("query_id", F.col("doc_id"))
    lists = truth.join(index.posted.select("doc_id", "list"), "doc_id").select("query_id", "list")
    order = Window.partitionBy("query_id").orderBy("gap", "list")
    places = _distances(_asked(sample), index.centres, len(index.centres)).select("query_id", "list", F.row_number().over(order).alias("place"))
    needed = lists.join(places, ["query_id", "list"]).groupBy("place").agg(F.count("*").alias("n"))
    held = sorted((r["place"], r["n"]) for r in needed.collect())  # a row a list at most
    total, so_far = sum(n for _, n in held), 0
    for place, n in held:
        so_far += n
        if so_far >= target * total:
            return place
    return 1


def _with_distance(assigned: DataFrame, centres: DataFrame) -> DataFrame:
    joined = assigned.join(F.broadcast(centres), "list")  # LISTS centres at most
    gap = F.zip_with("u", "centre", lambda a, b: (a - b) * (a - b))
    return joined.withColumn("far", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x))).drop("centre")


def load(spark: SparkSession, path: str) -> VectorIndex:
    return _opened(spark, path, spark.read.parquet(f"{path}/probes").first()["probes"])


def _opened(spark: SparkSession, path: str, probes: int) -> VectorIndex:
    posted = spark.read.parquet(f"{path}/posted")
    blocks = posted.groupBy("list", "block").agg(F.count("*").alias("n"), F.min("far").alias("least"), F.max("far").alias("most"))
    centres = [r["centre"] for r in spark.read.parquet(f"{path}/centres").orderBy("list").collect()]
    return VectorIndex(np.array(centres) if centres else np.zeros((0, 0)), posted, blocks, probes)


# -- search -----------------------------------------------------------------------------
def _distances(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """query_id, q, list, gap of each query to its ``probes`` nearest centres."""
    def near(batches):
        for batch in batches:
            ids, q = batch.column(0), _rows(batch.column(1))
            for start in range(0, len(q), BLOCK):
                part = q[start:start + BLOCK]
                gap = np.sqrt(np.maximum(((part**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None] - 2 * part @ centres.T), 0))
                some = np.argsort(gap, axis=1, kind="stable")[:, :probes]
                row = np.repeat(np.arange(start, start + len(part)), some.shape[1])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(some.ravel().astype(np.int32)), pa.array(np.take_along_axis(gap, some, 1).ravel())], ["query_id", "q", "list", "gap"])

    kind = dict(queries.dtypes)["query_id"]
    return queries.select("query_id", "q").mapInArrow(near, f"query_id {kind}, q array<double>, list int, gap double")


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _compared(index: VectorIndex, pairs: DataFrame, k: int) -> DataFrame:
    """query_id, doc_id, score: for each pair (query_id, q, list, block) the k best of the block."""
    kind, doc = dict(pairs.dtypes)["query_id"], dict(index.posted.dtypes)["doc_id"]
    # a list's queries come in parts of about BLOCK, and its blocks go to each part that asks for them
    loads = pairs.groupBy("list").agg(F.ceil(F.approx_count_distinct("query_id") / BLOCK).alias("parts"))  # a row a list
    dealt = pairs.join(F.broadcast(loads), "list").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts"))).drop("parts")
    copies = index.posted.join(dealt.select("list", "block", "part").distinct(), ["list", "block"])

    def best(posted: pa.Table, asked: pa.Table) -> pa.Table:
        x, q = _rows(posted.column("u")), _rows(asked.column("q"))
        ids, q_ids = posted.column("doc_id").combine_chunks(), asked.column("query_id").combine_chunks()
        order = pc.sort_indices(ids).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        code = np.concatenate([c.indices.to_numpy() for c in pa.chunked_array([ids, q_ids.cast(ids.type)]).dictionary_encode().unify_dictionaries().chunks])
        own, asking = code[:len(ids)], code[len(ids):]
        at, of, scores = [], [], [np.zeros(0)]
        for start in range(0, len(q), 256):
            for i, row in enumerate(q[start:start + 256] @ x.T, start):
                row[own == asking[i]] = -np.inf
                bar = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                near = np.flatnonzero((row >= bar - SLACK) & (row > -np.inf))
                # a row's sum of products is the same wherever the row stands, unlike a matrix product's
                exact = (x[near] * q[i]).sum(axis=1)
                first = np.lexsort((rank[near], -exact))[:k]
                at += near[first].tolist()
                of += [i] * len(first)
                scores.append(exact[first])
        return pa.table({"query_id": q_ids.take(pa.array(of, pa.int64())), "doc_id": ids.take(pa.array(at, pa.int64())), "score": np.concatenate(scores)})

    part = ["list", "block", "part"]
    met = dealt.select("query_id", "q", *[F.col(c).alias(f"of_{c}") for c in part])
    return copies.groupBy(*part).cogroup(met.groupBy(*[f"of_{c}" for c in part])).applyInArrow(best, f"query_id {kind}, doc_id {doc}, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asked(queries: DataFrame) -> DataFrame:
    q = queries.where("doc_id is not null").select(F.col("doc_id").alias("query_id"), unit(F.col("embedding")).alias("q")).where("q is not null")
    return q.distinct()


def probed(index: VectorIndex, queries: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
    """query_id, rank, doc_id, score: the k best of the ``probes`` nearest lists (as many as the index has measured);
    queries: doc_id, embedding."""
    if not len(index.centres):
        return _none(queries)
    pairs = _distances(_asked(queries), index.centres, probes or index.probes).join(index.blocks.select("list", "block"), "list").drop("gap")
    return _top(_compared(index, pairs, k), k).select("query_id", "rank", "doc_id", "score")


def blocks_to_compare(index: VectorIndex, queries: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """query_id, q, list, block of the blocks that may hold one of the k nearest; first: ``probed`` of the queries."""
    # cosine c of unit vectors is a distance of sqrt(2 - 2c); fewer than k found prove nothing
    bound = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.sqrt(F.greatest(2 - 2 * F.min("score"), F.lit(0.0)))).alias("bound"))
    asked = _distances(_asked(queries), index.centres, len(index.centres)).join(bound, "query_id", "left")
    ring = F.greatest(F.col("gap") - F.col("most"), F.col("least") - F.col("gap"))
    return asked.join(index.blocks, "list").where(F.col("bound").isNull() | (ring <= F.col("bound") + FAR)).select("query_id", "q", "list", "block")


def exact(index: VectorIndex, queries: DataFrame, k: int = 5, probes: int = 8) -> DataFrame:
    """The k best of all vectors: as ``probed``, and proven."""
    if not len(index.centres):
        return _none(queries)
    pairs = blocks_to_compare(index, queries, probed(index, queries, k, probes), k)
    return _top(_compared(index, pairs, k), k).select("query_id", "rank", "doc_id", "score")


def _none(queries: DataFrame) -> DataFrame:
    return queries.sparkSession.createDataFrame([], "query_id {0}, rank int, doc_id {0}, score double".format(dict(queries.dtypes)["doc_id"]))


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true neighbours that were found."""
    both = truth.join(found.select("query_id", "doc_id", F.lit(True).alias("hit")).distinct(), ["query_id", "doc_id"], "left")
    return both.agg(F.avg(F.coalesce(F.col("hit"), F.lit(False)).cast("double"))).first()[0]
