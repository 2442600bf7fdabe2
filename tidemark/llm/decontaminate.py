"""Benchmark decontamination: one Aho-Corasick automaton over the normalised item windows.

Words are runs of ASCII letters, ASCII digits and non-ASCII characters, A-Z lower-cased.
A window is ``width`` consecutive words of an item; an item of fewer words, but not none,
is one window.  A document is normalised to its words with one blank between them and
scanned once; the matches' offsets are mapped back to word numbers, and those to the
code points of the original text.

Items are cut into chunks of CHUNK words that overlap by a window, and chunks are dealt to blocks of
about BLOCK_BYTES bytes, whose automaton takes some 260 MB in a worker (measured: 264 MB for 100,000 words of 5 letters
and a blank, 135 MB for half of them).  A usual benchmark is one block and thus one automaton.  The blocks of a
larger one are collected, broadcast and scanned for one after the other: each scan writes the hits of
distinct texts and drops its broadcast, so that driver and workers hold one block at a time whatever
the size of the benchmark.

Edge cases: a null text has no words (n_words 0, nothing hit); a benchmark row with a null
id or without words adds no window; repeated items and repeated windows count once for
each distinct id; repeated documents are judged each by itself; other columns are left
alone; very long texts are one pass each, with offsets by bisection; empty tables give an empty result or no hits.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import join_on_hot_key, sliced, written

#: A word in a text whose A-Z are still capitals.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of items in one automaton; words of an item in one chunk.
BLOCK_BYTES, CHUNK = 600_000, 10_000
#: Bytes that aren't part of a word become blanks, A-Z become a-z, all others stay.
FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

SCHEMA = ("doc_id long, n_words long, n_hit long, item_ids array<long>, "
          "spans array<struct<start:int,end:int>>")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows_of(words: list[bytes], width: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]


def automaton(items: list[tuple[int, str]], width: int):
    """None if there is no window."""
    import ahocorasick

    owners: dict[bytes, set[int]] = {}
    for item_id, text in items:
        for w in windows_of(words_of(text), width):
            owners.setdefault(w, set()).add(item_id)
    built = ahocorasick.Automaton()
    for w, ids in owners.items():
        built.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(ids)))
    if owners:
        built.make_automaton()
    return built if owners else None


def merged(found) -> list[tuple[int, int]]:
    """Intervals [from, to) that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan(text: str | None, built) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, merged hit intervals of word numbers [from, to), ids of the items found."""
    words = words_of(text)
    if not words or built is None:
        return len(words), [], set()
    flat = f" {b' '.join(words).decode('latin-1')} "
    found: set[tuple[int, int]] = set()
    ids: set[int] = set()
    blanks = None
    for end, (n, owners) in built.iter(flat):
        if blanks is None:
            blanks = [m.start() for m in re.finditer(" ", flat)]
        last = bisect_right(blanks, end) - 1  # the word before this blank has number last - 1
        found.add((last - n, last))
        ids.update(owners)
    return len(words), merged(found), ids


def original_spans(text: str, hits: list[tuple[int, int]]) -> list[dict]:
    """Code points [start, end) in the text as it was, for intervals of word numbers."""
    at = [m.span() for m in re.finditer(WORD, text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in hits]


def chunks(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, text: at most CHUNK + width - 1 words each; every window of an item lies in one of its chunks."""
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(WORD), F.lit(0))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)), F.lit(CHUNK))
    return items.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.array_join(F.slice("w", F.col("at") + 1, F.lit(CHUNK + width - 1)), " ").alias("text"))


def _blocks(benchmark: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The chunks, each with the number of its block, and how many blocks there are."""
    parts = written(chunks(benchmark, width), "benchmark_chunks")
    n = 1 + parts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // BLOCK_BYTES
    return parts.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))), n


def _of_block(parts: DataFrame, k: int) -> list[tuple[int, str]]:
    return [tuple(r) for r in parts.where(F.col("block") == k).select("item_id", "text").collect()]


def _hits(docs: DataFrame, parts: DataFrame, n: int, width: int) -> DataFrame:
    """print, found, item_ids of the distinct texts with hits, and how many rows hold them; one block after the other."""
    spark, every = docs.sparkSession, None
    for k in range(n):
        shared = spark.sparkContext.broadcast(_of_block(parts, k))
        made: list = []

        def find(batches: Iterator[pa.RecordBatch], shared=shared, made=made) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(automaton(shared.value, width))
            for batch in sliced(batches):
                rows = {"print": [], "found": [], "item_ids": []}
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    _, hits, ids = scan(text.as_py(), made[0])
                    if hits:
                        rows["print"].append(key)
                        rows["found"].append([{"start": a, "end": b} for a, b in hits])
                        rows["item_ids"].append(sorted(ids))
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("print", pa.binary()), ("found", INTERVALS), ("item_ids", pa.list_(pa.int64()))]))

        found = docs.select(F.unhex(F.sha2("text", 256)).alias("print"), "text").where("text is not null").mapInArrow(find, "print binary, found array<struct<start:int,end:int>>, item_ids array<long>")
        part = written(found.groupBy("print").agg(F.first("found").alias("found"), F.first("item_ids").alias("item_ids"), F.count("*").alias("rows")), "block_hits")
        shared.destroy()
        every = part if every is None else every.unionByName(part)
    return written(every.groupBy("print").agg(F.flatten(F.collect_list("found")).alias("found"), F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"), F.max("rows").alias("rows")), "hits")


def _row(text: str | None, n: int, hits: list[tuple[int, int]], ids) -> tuple:
    return n, sum(b - a for a, b in hits), sorted(ids), original_spans(text, hits) if hits else []


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Per document: words, hit words, ids of the items met, and the hit spans of the original text."""
    parts, n = _blocks(benchmark, width)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if n == 1:
        shared = docs.sparkSession.sparkContext.broadcast(_of_block(parts, 0))
        made: list = []

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(automaton(shared.value, width))
            for batch in sliced(batches):
                texts = batch.column(1).to_pylist()
                yield _batch(batch.column(0), [_row(t, *scan(t, made[0])) for t in texts])

        return plain.mapInArrow(judge, SCHEMA)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, found, ids = (batch.column(k).to_pylist() for k in (1, 2, 3))
            yield _batch(batch.column(0), [_row(t, len(words_of(t)), merged((x["start"], x["end"]) for x in f or ()), i or ()) for t, f, i in zip(texts, found, ids, strict=True)])

    keyed = plain.withColumn("print", F.unhex(F.sha2("text", 256)))
    return join_on_hot_key(keyed, _hits(plain, parts, n, width), "print", "rows", F.col("doc_id")).select("doc_id", "text", "found", "item_ids").mapInArrow(join, SCHEMA)


def _batch(doc_ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    names = ("n_words", "n_hit", "item_ids", "spans")
    return pa.RecordBatch.from_pydict({"doc_id": doc_ids.to_pylist()} | {c: [r[k] for r in rows] for k, c in enumerate(names)}, schema=ARROW)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents of which no word is hit, in one pass for each block."""
    parts, n = _blocks(benchmark, width)
    if n > 1:
        hits = _hits(docs.select(F.col("text").cast("string").alias("text")), parts, n, width)
        held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), F.coalesce(F.unhex(F.sha2(docs["text"].cast("string"), 256)), F.lit(b"")).alias("print"))
        marked = join_on_hot_key(held, hits.select("print", "rows", F.lit(True).alias("hit")), "print", "rows", F.monotonically_increasing_id())
        return marked.where("hit is null").select("own.*")
    shared = docs.sparkSession.sparkContext.broadcast(_of_block(parts, 0))
    made: list = []
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(automaton(shared.value, width))
        for batch in sliced(batches):
            yield batch.filter(pa.array([not scan(t.as_py(), made[0])[1] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


INTERVALS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.int64())),
    ("spans", INTERVALS),
])


def digest(judged: DataFrame) -> DataFrame:
    """The columns of the query: counts, and the ids hashed as sorted strings."""
    ids = F.concat_ws(",", F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))))
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def ids_digest(ids: set[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
