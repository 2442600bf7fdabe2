"""Near-duplicate lines: a segment-partition edit join over all distinct lines.

Equal lines are one distinct line, whose first place is the smallest (doc_id, line number).
Two distinct lines are linked if their edit distance (code points) is at most what the shorter
one allows: one edit for every PER characters, at most ``edits``.  So every line takes part; one
of fewer than PER characters allows none, that is, only equal lines repeat it.

A distinct line is cut into as many segments of even length as it allows edits, plus one, entered
in an index by (length, segment, hash of the segment).  By the pigeonhole principle, a line within
the threshold holds one of the segments unchanged, at a place that the two lengths narrow
down: a line probes, for its own length and each shorter one within reach, only the
substrings around each segment's place (multi-match-aware bounds).  Before any text is
read, a pair must agree in a 63-bit parity vector of the lines' character pairs: an edit
flips at most four of the bits.  What is left is verified by a banded bit-parallel
edit distance after common ends are cut off.

Segments and probes meet in one shuffle by slot.  A slot of more than HOT entries is only noted there;
its entries are dealt to blocks of about BLOCK, and pairs of blocks are compared by many tasks, so
no pair is lost or left to one task.

Of two linked lines the one with the later first place repeats the other.  A document
keeps an occurrence of a line only if it is the line's first place and the line repeats no
earlier one.  Blank lines are kept where they are and count as no line.  Lines that links join are
a class, named by its smallest first place.

Edge cases: a null text has no lines and stays null; very long lines and texts go by pieces; of
lines that tie in nothing but their place the smaller place comes first; repeated rows of one doc_id
hold the lines at the same places, so each row keeps what it is first to have (rows of one doc_id with
other texts are compared like any, and lines at equal places of theirs stay or go together); rows without
doc_id are neither changed nor compared; other columns pass through; empty tables give empty results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import BATCH_ROWS, batches_of, fits, join_on_hot_key, sliced, written

#: Edits at most, and characters of a line for each of them.
EDITS, PER = 2, 12
#: Entries of a slot that one task compares at once; entries of a block of a larger slot.
HOT, BLOCK = 1_024, 16_384
#: Entries of a slot up to which slots are compared side by side, by the distance of their entries.
FEW = 16
#: Characters whose features are computed at once (or one line).
PIECE = 1 << 19
#: Hash of a line: 128 bits as two longs.
KEY = ["k1", "k2"]


def line_key(line: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return _signed(h >> 64), _signed(h & (2**64 - 1))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


_rng = np.random.default_rng(20_260_811)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Characters are spread over 64 bits before they enter the polynomial.
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


def allowed(n, edits: int = EDITS):
    """Edits that a line of n characters allows."""
    return np.minimum(edits, np.asarray(n) // PER)


def features(lines: list[str], edits: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """For each line, a 63-bit vector of the parities of its character pairs, shifted left by one;
    and its slots, hashes of (length, segment, characters): those of its own segments, and the probes
    at other places or for shorter lines.  (A probe of the own length at a segment's own place
    would repeat that segment's slot.)  Vectorised over all lines; short ones, which allow different numbers of
    edits, by themselves."""
    n = np.array([len(x) for x in lines], dtype=np.int64)
    short = n < (PER + 1) * edits
    if short.any() and not short.all():
        parities, out = np.empty(len(n), np.int64), ([None] * len(n), [None] * len(n))
        for at in (np.flatnonzero(short), np.flatnonzero(~short)):
            p, *found = features([lines[i] for i in at], edits)
            parities[at] = p
            for to, have in zip(out, found, strict=True):
                for i, x in zip(at, have, strict=True):
                    to[i] = x
        return parities, *out
    c = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    power = np.cumprod(np.full(len(c) + 1, _BASE, dtype=np.uint64))
    back = np.cumprod(np.full(len(c) + 1, _INVERSE, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c + np.uint64(1)) * _SPREAD * power[:-1], dtype=np.uint64)])

    def slot(length: np.ndarray, segment: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = first + start
        h = (sums[at + size] - sums[at]) * back[at] + length.astype(np.uint64) * np.uint64(16) + np.uint64(segment)
        h = (h ^ (h >> np.uint64(31))) * _SPREAD
        return (h ^ (h >> np.uint64(29))).view(np.int64)

    line_of = np.repeat(np.arange(len(lines)), n)
    pair = ((c[:-1] * _SPREAD + c[1:]) * _BASE >> np.uint64(40)) % np.uint64(63)
    inside = line_of[:-1] == line_of[1:] if len(c) else np.zeros(0, bool)
    odd = np.bincount((line_of[:-1] * 64 + pair.astype(np.int64))[inside] + 1, minlength=64 * len(lines))[:64 * len(lines)] & 1
    parities = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    own, probes = [], []
    for delta in range(edits + 1):
        other = n - delta
        may = allowed(np.maximum(other, 0), edits)
        for most in range(max(delta, 1), edits + 1):  # lines of length ``other`` that allow so many edits
            mine, parts = may == most, most + 1
            if not mine.any():
                continue
            short, longer, at = other // parts, other % parts, np.zeros_like(n)
            for i in range(1, parts + 1):
                size = short + (i > parts - longer)
                if delta == 0:
                    own.append((slot(n, i, at, np.where(mine, size, 0)), mine))
                for move in range(-most, most + 1):
                    fits_in = -(i - 1) <= move <= i - 1 and delta - (parts - i) <= move <= delta + parts - i
                    if fits_in and (delta or move):
                        start = at + move
                        ok = mine & (start >= 0) & (start + size <= n)
                        probes.append((slot(other, i, np.where(ok, start, 0), np.where(ok, size, 0)), ok))
                at = np.where(mine, at + size, 0)

    def by_line(columns: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        if not columns:
            return [np.empty(0, np.int64)] * len(lines)
        values, valid = np.stack([x for x, _ in columns], axis=1), np.stack([x for _, x in columns], axis=1)
        return np.split(values[valid], np.cumsum(valid.sum(axis=1))[:-1])

    return parities, by_line(own), by_line(probes)


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: common ends are cut off, then a band of
    2 * edits + 1 diagonals is kept as bit vectors of the cells with at most e edits."""
    if abs(len(a) - len(b)) > edits:
        return False
    n = len(os.path.commonprefix((a, b)))
    a, b = a[n:], b[n:]
    n = len(os.path.commonprefix((a[::-1], b[::-1])))
    a, b = a[:len(a) - n], b[:len(b) - n]
    if not a or not b:
        return max(len(a), len(b)) <= edits
    # bit d of level[e] at row i: cell (i, i + d - edits) is reached with at most e edits
    width = 2 * edits + 1
    full = (1 << width) - 1
    level = [((1 << (e + 1)) - 1) << edits & full for e in range(edits + 1)]
    for i, ch in enumerate(a):
        equal = 0
        for d in range(width):
            j = i + d - edits
            if 0 <= j < len(b) and b[j] == ch:
                equal |= 1 << d
        fresh = []
        for e in range(edits + 1):
            v = level[e] & equal
            if e:
                v |= level[e - 1] | level[e - 1] >> 1  # substitution, deletion
                v |= fresh[e - 1] << 1  # insertion
            fresh.append(v & full)
        level = fresh
        if not level[-1]:
            return False
    d = len(b) - len(a) + edits
    return bool(level[edits] >> d & 1)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def occurrences(docs: DataFrame, edits: int) -> DataFrame:
    """k1, k2, doc_id, line_no, parity, segments, probes of every line that isn't blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            held, chars = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for k, line in enumerate(text.as_py().split("\n")):
                    if line.strip():
                        held.append((doc_id, k, line))
                        chars += len(line)
                        if chars >= PIECE:
                            yield rows(held)
                            held, chars = [], 0
            if held:
                yield rows(held)

    def rows(held: list[tuple[int, int, str]]) -> pa.RecordBatch:
        keys = np.array([line_key(x) for _, _, x in held], dtype=np.int64)
        parity, segments, probes = features([x for _, _, x in held], edits)
        lists = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), pa.array(parity), pa.array(segments, lists), pa.array(probes, lists)], names=["k1", "k2", "doc_id", "line_no", "parity", "segments", "probes"])

    return _documents(docs).where("doc_id is not null and text is not null").mapInArrow(run, "k1 long, k2 long, doc_id long, line_no long, parity long, segments array<long>, probes array<long>")


def places_of(docs: DataFrame) -> DataFrame:
    """k1, k2, doc_id, line_no of every line that isn't blank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, numbers, keys = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for k, line in enumerate(text.as_py().split("\n")):
                    if line.strip():
                        ids.append(doc_id)
                        numbers.append(k)
                        keys.append(line_key(line))
            keys = np.array(keys, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ids, pa.int64()), pa.array(numbers, pa.int64())], names=["k1", "k2", "doc_id", "line_no"])

    return _documents(docs).where("doc_id is not null and text is not null").mapInArrow(run, "k1 long, k2 long, doc_id long, line_no long")


def _texts_of(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """id, line of the lines (doc_id, line_no, k1, k2, id), read from the documents."""
    wanted = written(lines.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "id", *KEY)).alias("lines")), "wanted_lines")
    if fits(wanted):
        wanted = F.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, out = [], []
            for text, asked in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                have = text.as_py().split("\n")
                for x in asked:  # another row of the doc_id may have another text
                    if x["line_no"] < len(have) and line_key(have[x["line_no"]]) == (x["k1"], x["k2"]):
                        ids.append(x["id"])
                        out.append(have[x["line_no"]])
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "line": pa.array(out, pa.string())})

    return _documents(docs).where("text is not null").join(wanted, "doc_id").select("text", "lines").mapInArrow(run, "id long, line string").dropDuplicates(["id"])


def _agreeing(ids: tuple[np.ndarray, np.ndarray], marks: tuple[np.ndarray, np.ndarray], edits: int) -> np.ndarray:
    """Which pairs are of two lines, not of two probes, and near in their parities."""
    near = np.bitwise_count((marks[0] ^ marks[1]).view(np.uint64) >> np.uint64(1)) <= 4 * edits
    return near & (ids[0] != ids[1]) & ((marks[0] & marks[1] & 1) == 0)


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x, y = (np.concatenate([np.empty(0, np.int64), *v]) for v in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def meetings(batches: Iterator[pa.RecordBatch], edits: int, hot: int) -> Iterator[pa.RecordBatch]:
    """(a, b) ids that meet in a slot; (slot, null) for each slot of more than ``hot`` entries.  Rows (slot,
    id, mark) come sorted by slot; the unfinished slot at a batch's end is held, up to ``hot`` entries of it."""
    passing, slot, ids, marks = None, *(np.empty(0, np.int64) for _ in range(3))

    def judged(slot: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, start, size = np.unique(slot, return_index=True, return_counts=True)
        if (size > hot).any():
            yield pa.RecordBatch.from_arrays([pa.array(slot[start[size > hot]]), pa.nulls(int((size > hot).sum()), pa.int64())], names=["a", "b"])
        a, b = [], []
        for k, n in zip(start[(size > FEW) & (size <= hot)], size[(size > FEW) & (size <= hot)], strict=True):
            own, theirs = ids[k:k + n], marks[k:k + n]
            i, j = np.nonzero(np.triu(_agreeing((own[:, None], own[None, :]), (theirs[:, None], theirs[None, :]), edits), 1))
            a.append(own[i])
            b.append(own[j])
        left = np.where(size > FEW, 0, size)
        left = np.repeat(left, size) - (np.arange(len(slot)) - np.repeat(start, size))  # entries from here to the slot's end
        at = np.flatnonzero(left > 1)
        for d in range(1, FEW):
            at = at[left[at] > d]
            if not len(at):
                break
            good = at[_agreeing((ids[at], ids[at + d]), (marks[at], marks[at + d]), edits)]
            a.append(ids[good])
            b.append(ids[good + d])
        if sum(map(len, a)):
            yield _pairs(a, b)

    for batch in batches:
        new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if passing is not None:
            new = [v[np.searchsorted(new[0], passing, "right"):] for v in new]
        if not len(new[0]):
            continue
        passing = None
        slot, ids, marks = (np.concatenate(v) for v in zip((slot, ids, marks), new, strict=True))
        cut = np.searchsorted(slot, slot[-1])
        yield from judged(slot[:cut], ids[:cut], marks[:cut])
        slot, ids, marks = slot[cut:], ids[cut:], marks[cut:]
        if len(slot) > hot:
            yield from judged(slot, ids, marks)
            passing, slot, ids, marks = slot[0], slot[:0], ids[:0], marks[:0]
    yield from judged(slot, ids, marks)


def _hot_pairs(entries: DataFrame, hot: DataFrame, edits: int, block: int) -> DataFrame:
    """(a, b) of the slots in ``hot``: every block of a slot's entries against itself and each later one."""
    held = written(entries.join(F.broadcast(hot) if fits(hot) else hot, "slot", "left_semi"), "hot_entries")
    sizes = written(held.groupBy("slot").agg(F.ceil(F.count("*") / block).alias("blocks"), F.count("*").alias("rows")), "hot_slots")
    placed = join_on_hot_key(held, sizes, "slot", "rows", F.col("id"), "inner").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    x = F.collect_list(F.struct("id", "mark"))
    packed = written(placed.groupBy("slot", "block").agg(x.alias("x")).select("slot", "block", F.transform("x", lambda r: r["id"]).alias("ids"), F.transform("x", lambda r: r["mark"]).alias("marks")), "hot_blocks")
    pairs = sizes.select("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("j")).select("slot", "j", F.explode(F.sequence(F.lit(0).cast("long"), "j")).alias("i"))
    side = lambda k: packed.select("slot", F.col("block").alias(k), F.col("ids").alias(f"ids_{k}"), F.col("marks").alias(f"marks_{k}"))
    both = pairs.join(side("i"), ["slot", "i"]).join(side("j"), ["slot", "j"]).select("ids_i", "marks_i", "ids_j", "marks_j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            ids, marks, other, theirs = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
            at = range(0, len(ids), max(1, (1 << 22) // max(1, len(other))))
            for k in at:  # about four million pairs at once
                part = slice(k, k + at.step)
                i, j = np.nonzero(_agreeing((ids[part, None], other[None, :]), (marks[part, None], theirs[None, :]), edits))
                if len(i):
                    yield _pairs([ids[part][i]], [other[j]])

    return both.mapInArrow(run, "a long, b long")


def links(docs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """(a, b) ids of linked distinct lines, a < b.  lines: id, k1, k2, doc_id, line_no, parity, segments, probes."""
    kinds = F.concat(F.transform("segments", lambda s: F.struct(s.alias("slot"), F.lit(0).cast("long").alias("probe"))), F.transform("probes", lambda s: F.struct(s.alias("slot"), F.lit(1).cast("long").alias("probe"))))
    entries = lines.select("id", "parity", F.inline(kinds)).select("slot", "id", F.col("parity").bitwiseOR(F.col("probe")).alias("mark"))
    hot_size, block = HOT, BLOCK
    met = written(entries.repartition("slot").sortWithinPartitions("slot").mapInArrow(lambda batches: meetings(batches, edits, hot_size), "a long, b long"), "line_meetings")
    pairs = met.where("b is not null")
    hot = met.where("b is null").select(F.col("a").alias("slot"))
    if not hot.isEmpty():
        pairs = pairs.unionByName(_hot_pairs(entries, hot, edits, block))
    with batches_of(docs.sparkSession, 8):  # of blocks, of half a MB each
        pairs = written(pairs.distinct(), "line_pairs")
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    with batches_of(docs.sparkSession, BATCH_ROWS):
        texts = written(_texts_of(docs, lines.select("id", "doc_id", "line_no", *KEY).join(needed, "id", "left_semi")), "line_texts")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [within(x, y, int(allowed(min(len(x), len(y)), edits))) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with batches_of(docs.sparkSession, BATCH_ROWS):
        return written(both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), "line_links")


def judged_lines(docs: DataFrame, edits: int = EDITS, classes: bool = True) -> DataFrame:
    """Every place (doc_id, line_no) of a line with: first (the line's first place is here), repeats (the
    line is linked to an earlier one), n_links of its line, class (the smallest place of the lines
    that links join with it; null if ``classes`` aren't asked for)."""
    found = occurrences(docs, edits)
    lines = found.groupBy(*KEY).agg(F.min(F.struct("doc_id", "line_no")).alias("at"), *[F.first(c).alias(c) for c in ("parity", "segments", "probes")], F.count("*").alias("places"))
    # the id of a distinct line is its number in the written table; its place orders it
    with batches_of(docs.sparkSession, BATCH_ROWS):
        lines = written(lines.select(F.monotonically_increasing_id().alias("id"), *KEY, F.col("at.doc_id").alias("doc_id"), F.col("at.line_no").alias("line_no"), "parity", "segments", "probes", "places"), "distinct_lines")
    linked = links(docs, lines, edits)
    at = lines.select("id", F.struct("doc_id", "line_no").alias("at"))
    sides = linked.join(at.select(F.col("id").alias("a"), F.col("at").alias("at_a")), "a").join(at.select(F.col("id").alias("b"), F.col("at").alias("at_b")), "b")
    each = sides.select(F.col("a").alias("id"), F.col("at_a").alias("own"), (F.col("at_b") < F.col("at_a")).alias("repeats")).unionByName(sides.select(F.col("b").alias("id"), F.col("at_b").alias("own"), (F.col("at_a") < F.col("at_b")).alias("repeats")))
    per_line = each.groupBy("id").agg(F.max("repeats").alias("repeats"), F.count("*").alias("n_links"), F.first("own").alias("own"))
    none = F.lit(None).cast("struct<doc_id:bigint,line_no:bigint>")
    if classes:
        members = written(per_line.join(components(linked).withColumnRenamed("node", "id"), "id"), "linked_lines")
        names = members.groupBy("label").agg(F.min("own").alias("class"), F.count("*").alias("rows"))
        per_line = join_on_hot_key(members, written(names, "line_classes"), "label", "rows", F.col("id"))
    else:
        per_line = per_line.withColumn("class", none)
    # lines met once that link to nothing need no join: they are what they are
    mine = F.struct("doc_id", "line_no")
    special = lines.select("id", *KEY, "doc_id", "line_no", "places").join(per_line.select("id", "repeats", "n_links", "class"), "id", "left").where("places > 1 or n_links is not null")
    special = special.select(F.struct(*KEY).alias("key"), mine.alias("at"), F.coalesce("repeats", F.lit(False)).alias("repeats"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class", mine if classes else none).alias("class"), "places")
    marked = join_on_hot_key(places_of(docs).select(F.struct(*KEY).alias("key"), "doc_id", "line_no"), written(special, "special_lines"), "key", "places", mine)
    return marked.select("doc_id", "line_no", (F.col("at").isNull() | (mine == F.col("at"))).alias("first"), F.coalesce("repeats", F.lit(False)).alias("repeats"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "class")


def summary(docs: DataFrame, edits: int = EDITS, classes: bool = True) -> DataFrame:
    """Per document: lines, repeats of equal lines, lines that repeat a linked earlier one, links of
    its lines (counted at each of their places), numbers of the lines that go; the classes of its lines that
    repeat or are linked (line number, first place of the class, links), and the documents of those first places."""
    places = judged_lines(docs, edits, classes)
    goes = ~F.col("first") | F.col("repeats")
    member = F.struct("line_no", F.col("class.doc_id").alias("class_doc_id"), F.col("class.line_no").alias("class_line_no"), "n_links")
    lists = [F.collect_set(F.when(F.col("class").isNotNull(), member)).alias("classes")] if classes else []
    per_doc = places.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sum((~F.col("first")).cast("long")).alias("n_equal"), F.sum((F.col("first") & F.col("repeats")).cast("long")).alias("n_near"),
        F.sum("n_links").alias("n_links"), F.min(goes).alias("all_go"), F.collect_set(F.when(goes, F.col("line_no"))).alias("dropped"), *lists)
    none = F.lit(0).cast("long")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(per_doc, "doc_id", "left")
    more = []
    if classes:
        held = F.coalesce("classes", F.array().cast("array<struct<line_no:bigint,class_doc_id:bigint,class_line_no:bigint,n_links:bigint>>"))
        more = [F.array_sort(held).alias("classes"), F.array_sort(F.array_distinct(F.transform(held, lambda x: x["class_doc_id"]))).alias("class_docs")]
    return every.select("doc_id", *[F.coalesce(c, none).alias(c) for c in ("n_lines", "n_equal", "n_near", "n_links")], F.array_sort(F.coalesce("dropped", F.array().cast("array<bigint>"))).alias("dropped"), F.coalesce("all_go", F.lit(False)).alias("all_go"), *more)


def without_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents with repeated lines taken out of their texts; a document of which no line is left goes."""
    gone = summary(docs, edits, False).where(F.size("dropped") > 0).dropDuplicates(["doc_id"]).select("doc_id", F.col("dropped").alias("gone"), F.col("all_go"))
    # own columns of the documents may have any name, so they travel as one
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), F.col("doc_id").cast("long").alias("doc_id"))
    joined = held.join(gone, "doc_id", "left").where(~F.coalesce("all_go", F.lit(False)))
    left = lambda lines: F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col("gone"))
    cut = lambda lines: F.concat_ws("\n", F.transform(left(lines), lambda i: F.get(lines, i.cast("int"))))
    text = F.when(F.col("gone").isNull(), F.col("own.text")).otherwise(F.get(F.transform(F.array(F.split(F.col("own.text").cast("string"), "\n")), cut), F.lit(0)))
    return joined.select(*[text.alias(c) if c == "text" else F.col("own")[c].alias(c) for c in docs.columns])
