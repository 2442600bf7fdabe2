"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, stars.

A document's set holds 64-bit hashes of its distinct word shingles.  One permutation of it
gives SLOTS bins by the hashes' top bits, each with its least hash; an empty bin takes the
value of the first filled bin in a fixed random order of its own (optimal densification).
Bands of rows_for(threshold) bins give the buckets: 32 bands of 8 at 0.85, 42 of 6 at 0.8.

1. Documents with equal sets share one representative, the smallest doc_id.
2. Each bucket of two or more representatives is a star around one of them (another one in
   each band), so the number of candidate edges is at most one a band and document.  The edges'
   connected components are the clusters.
3. Each representative is confirmed on full sets against the centre it met most often.
   The links' components settle a cluster of which all members come together: the usual
   case, linear in the cluster.
4. In every other cluster the members outside its largest component are confirmed against all
   centres of their buckets.
5. What still is outside its cluster's largest component is compared on full
   sets with all members, block by block (about BLOCK_ROWS sets a block, several tasks for
   one cluster).  A block pair returns only a spanning forest of the links it found.  So no
   link between two documents of a cluster is lost, nor are pairs ever rows.

A pair at the threshold misses all buckets with a probability below MISS; in a cluster that
stars alone don't settle it is compared even then.

Buckets, centres and clusters may hold any share of the rows: joins on them split hot keys, and a
centre's members are confirmed MEMBERS at a time.

Edge cases: texts that are null, empty or white space have n_shingles 0 and link with
nothing; a text of fewer words than a shingle has one, its whole sequence; repeated rows of
one doc_id have equal sets and get equal results; rows without doc_id stay by themselves
with a null component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import BATCH_ROWS, batches_of, fits, join_on_hot_key, sliced, written

SLOTS, MOST_ROWS, MISS = 256, 8, 1e-4
BLOCK_ROWS, BLOCK_HASHES = 192, 400_000
#: Members of a centre that one task confirms; block pairs, of some MB each, in one Arrow batch.
MEMBERS, BLOCK_PAIRS = 512, 4
#: Bytes of text whose hashes are computed at once.
PIECE = 1 << 20

_rng = np.random.default_rng(20_260_810)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX = _rng.integers(1, 2**63, SLOTS, dtype=np.uint64) | np.uint64(1)
#: For each bin, the order in which it looks for a filled bin.
_ORDER = np.argsort(_rng.random((SLOTS, SLOTS)), axis=1).argsort(axis=1).astype(np.int16)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (splitmix64's finish)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of bytes that are already folded: polynomial prefix sums, one pass."""
    word = ~SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    power = np.cumprod(np.full(len(data) + 1, _BASE, dtype=np.uint64))
    back = np.cumprod(np.full(len(data) + 1, _INVERSE, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[:-1], dtype=np.uint64)])
    return mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash a word, in order.  Long texts go by pieces that end at white space."""
    data = FOLD[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if len(data) <= PIECE:
        return _word_hashes(data)
    at, out = 0, []
    while at < len(data):
        to = min(at + PIECE, len(data))
        while to < len(data):  # on to the next white space
            ahead = np.flatnonzero(SPACE[data[to:to + PIECE]])
            if len(ahead):
                to += int(ahead[0])
                break
            to = min(to + PIECE, len(data))
        out.append(_word_hashes(data[at:to]))
        at = to
    return np.concatenate(out)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(width, len(w))
    h = np.full(len(w) - n + 1, np.uint64(n))
    for k in range(n):
        h = mixed(h * _BASE + w[k:len(w) - n + 1 + k])
    return np.unique(h)


def rows_for(percent: int) -> int:
    """Bins in a band: as many as leave a pair at the threshold a chance below MISS of meeting nowhere."""
    return next((r for r in range(MOST_ROWS, 0, -1) if (1 - (percent / 100) ** r) ** (SLOTS // r) < MISS), 1)


def bands_of(hashes: np.ndarray, rows: int) -> np.ndarray:
    """Bucket numbers, one a band, of a sorted set that isn't empty."""
    bins = (hashes >> np.uint64(56)).astype(np.intp)
    filled, first = np.unique(bins, return_index=True)
    slots = np.empty(SLOTS, dtype=np.uint64)
    slots[filled] = hashes[first]
    if len(filled) < SLOTS:
        empty = np.setdiff1d(np.arange(SLOTS), filled, assume_unique=True)
        slots[empty] = slots[filled[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]]
    used = SLOTS // rows * rows
    return mixed((mixed(slots) * _MIX)[:used].reshape(-1, rows).sum(axis=1, dtype=np.uint64)).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sketches(docs: DataFrame, width: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint of the set (null if empty), bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n, prints, bands = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                n.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(bands_of(s, rows) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "print", "bands"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, print binary, bands array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """doc_id, hashes (bytes) of the documents named in ``ids`` (doc_id, one row each)."""
    if fits(ids):
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "hashes": pa.array([shingle_set(t.as_py(), width).tobytes() for t in batch.column(1)], pa.binary())})

    return _texts(docs).join(ids, "doc_id", "left_semi").mapInArrow(run, "doc_id long, hashes binary")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges (a: centre, b: member) that hold on full sets.  A centre's set comes once for each
    salt, about MEMBERS of its members follow; a task has one centre's set in memory at a time."""
    sizes = written(edges.groupBy("a").agg(F.count("*").alias("rows"), F.ceil(F.count("*") / MEMBERS).alias("salts")), "centres")
    members = join_on_hot_key(edges.select("a", "b"), sizes, "a", "rows", F.col("b")).select("a", "b", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"))
    centres = members.select("a", "salt").distinct()
    rows = centres.join(sets.withColumnRenamed("doc_id", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "hashes").unionByName(members.join(sets.withColumnRenamed("doc_id", "b"), "b").select("a", "salt", "b", "hashes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, centre = None, None
        for batch in sliced(batches):
            out: dict[str, list] = {"a": [], "b": []}
            for a, b, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s = np.frombuffer(h, np.uint64)
                if b is None:
                    own, centre = a, s
                elif own == a and linked(centre, s, percent):
                    out["a"].append(a)
                    out["b"].append(b)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b")).mapInArrow(run, "a long, b long")


def forest(left: list[np.ndarray], right: list[np.ndarray], same: bool, groups: tuple[list, list], percent: int) -> list[tuple[int, int]]:
    """Positions (i, j) of links between sets of two blocks that join what isn't joined yet."""
    nl, nr = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    words = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    for at in range(0, len(words), 16_384):
        part = words[at:at + 16_384]
        rows = [np.zeros((len(x), len(part)), dtype=np.float32) for x in (left, right)]
        for m, block in zip(rows, (left, right), strict=True):
            for i, s in enumerate(block):
                s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], "right")]
                p = np.searchsorted(part, s)
                m[i, p[part[np.minimum(p, len(part) - 1)] == s]] = 1
        common += rows[0] @ rows[1].T
    holds = 100 * common.astype(np.int64) >= percent * (nl[:, None] + nr[None, :] - common.astype(np.int64))
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(holds), strict=True):
        if same and i >= j:
            continue
        a, b = root(groups[0][i]), root(groups[1][j])
        if a != b:
            parent[a] = b
            out.append((int(i), int(j)))
    return out


def _parts(clusters: DataFrame, links: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, cluster, part, n_shingles) of the nodes, and for each cluster of several parts its largest one
    (main) and the numbers of blocks of the two sides.

    clusters: node, cluster.  links: node, label (components of confirmed links)."""
    grouped = written(clusters.join(links, "node", "left").select("node", "cluster", F.coalesce("label", "node").alias("part")).join(sizes, "node"), "parts")
    counted = grouped.groupBy("cluster", "part").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("hashes"))
    blocks = lambda rows, hashes: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(hashes / BLOCK_HASHES))
    whole = counted.groupBy("cluster").agg(F.count("*").alias("parts"), F.max(F.struct("rows", "hashes", "part")).alias("m"), F.sum("rows").alias("all_rows"), F.sum("hashes").alias("all_hashes")).where("parts > 1")
    open_ = written(whole.select("cluster", F.col("m.part").alias("main"), blocks(F.col("m.rows"), F.col("m.hashes")).alias("main_blocks"), blocks(F.col("all_rows") - F.col("m.rows"), F.col("all_hashes") - F.col("m.hashes")).alias("more_blocks"), F.col("all_rows").alias("rows")), "open_clusters")
    return grouped, open_


def _rest(grouped: DataFrame, open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside clusters that the stars didn't bring together."""
    placed = join_on_hot_key(grouped, open_, "cluster", "rows", F.col("node"), "inner").withColumn("block", F.when(F.col("part") == F.col("main"), F.pmod(F.xxhash64("node"), "main_blocks")).otherwise(F.col("main_blocks") + F.pmod(F.xxhash64("node"), "more_blocks")))
    held = written(placed.join(sets.withColumnRenamed("doc_id", "node"), "node").groupBy("cluster", "block").agg(F.collect_list(F.struct("node", "part", "hashes")).alias("x")), "set_blocks")
    pairs = open_.select("cluster", F.expr("explode(sequence(main_blocks, main_blocks + more_blocks - 1))").alias("j")).select("cluster", "j", F.expr("explode(sequence(0L, j))").alias("i"))
    pairs = pairs.join(held.select("cluster", F.col("block").alias("i"), F.col("x").alias("xi")), ["cluster", "i"]).join(held.select("cluster", F.col("block").alias("j"), F.col("x").alias("xj")), ["cluster", "j"]).select("i", "j", "xi", "xj")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                xi, xj = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                sets_of = [[np.frombuffer(r["hashes"], np.uint64) for r in x] for x in (xi, xj)]
                found = forest(*sets_of, batch.column(0)[k].as_py() == batch.column(1)[k].as_py(), ([r["part"] for r in xi], [r["part"] for r in xj]), percent)
                yield pa.RecordBatch.from_pydict({"a": [xi[i]["node"] for i, _ in found], "b": [xj[j]["node"] for _, j in found]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    with batches_of(grouped.sparkSession, BLOCK_PAIRS):
        return written(pairs.mapInArrow(run, "a long, b long"), "rest_links")


def kept_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that repeat another of their group.  Only the ids that go are joined."""
    gone = written(near_duplicates(docs, width, percent).where(~F.col("kept")).select(F.col("doc_id").alias("_repeated_id")).distinct(), "repeated_documents")
    if fits(gone):
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_repeated_id"], "left_anti")


def _components_of_sets(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, print, bands of all rows; print, component, copies of the sets that have company)."""
    drawn = written(sketches(docs, width, rows_for(percent)), "sketches")
    by_set = written(drawn.where("print is not null and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "sets")
    reps = drawn.where("print is not null").join(by_set.select("print", F.col("rep").alias("doc_id")), ["print", "doc_id"], "left_semi").dropDuplicates(["doc_id"])
    entries = reps.select(F.col("doc_id").alias("rep"), F.posexplode("bands").alias("band", "bucket"))
    entries = entries.select("rep", F.xxhash64("band", "bucket").alias("bucket"), "band")
    by_bucket = written(entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep", "band")).alias("centre")).where("n > 1"), "buckets")
    met = written(join_on_hot_key(entries.select("rep", "bucket"), by_bucket, "bucket", "n", F.col("rep"), "inner").where("rep <> centre").groupBy(F.col("centre").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("votes")), "stars")
    clusters = components(met).withColumnRenamed("label", "cluster")
    sets = written(full_sets(docs, clusters.select(F.col("node").alias("doc_id")), width), "full_sets")
    best = met.groupBy("b").agg(F.max(F.struct("votes", "a")).getField("a").alias("a"))
    confirmed = written(_confirmed(best, sets, percent), "star_links")
    sizes = reps.select(F.col("doc_id").alias("node"), "n_shingles")
    first = components(confirmed)
    grouped, open_ = _parts(clusters, first, sizes)
    if not open_.isEmpty():  # members outside of the main part try every centre they met
        outside = join_on_hot_key(grouped, open_.select("cluster", "main", "rows"), "cluster", "rows", F.col("node"), "inner").where("part <> main").select(F.col("node").alias("b"))
        again = met.select("a", "b").join(outside, "b").select("a", "b").join(best.select("b", "a"), ["a", "b"], "left_anti")
        confirmed = confirmed.unionByName(written(_confirmed(written(again, "further_stars"), sets, percent), "further_links"))
        first = components(confirmed)
        grouped, open_ = _parts(clusters, first, sizes)
    more = _rest(grouped, open_, sets, percent)
    # what is joined already is one node, so that the second pass is over few edges
    names = first.select(F.col("node"), F.col("label"))
    joined = more
    for end in ("a", "b"):
        joined = joined.join(names.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    second = components(joined)
    final = clusters.select("node").join(names, "node", "left").select("node", F.coalesce("label", "node").alias("half")).join(second.select(F.col("node").alias("half"), F.col("label").alias("top")), "half", "left").select(F.col("node").alias("rep"), F.coalesce("top", "half").alias("label")).where("rep <> label")
    return drawn, written(by_set.join(final, "rep", "left").where("copies > 1 or label is not null").select("print", F.coalesce("label", "rep").alias("component"), "copies"), "component_of_set")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept.  Links: 100 * intersection >= percent * union."""
    with batches_of(docs.sparkSession, BATCH_ROWS):  # all that runs Python is written in here
        drawn, to = _components_of_sets(docs, width, percent)
    out = join_on_hot_key(drawn.select("doc_id", "n_shingles", "print"), to, "print", "copies", F.col("doc_id"))
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
