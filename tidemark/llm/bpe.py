"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut at safe boundaries before they reach the library: a place where
white space follows a character that is none always starts a new match of the splitting
pattern, whatever stands before it, and no earlier match looks ahead past it.  A run of
white space of LONG_RUN or more is taken out by itself, since the library's regex engine
recurses on it: all but its last character (all of it at the end of a text) is one match,
and the last one begins the rest.

Edge cases: a null text is encoded as the empty text (no ids; the hashes of no bytes);
very long texts go part by part; repeated rows are encoded each, ties have no meaning here; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced

#: White space as the library's regex engine has it (Unicode White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
LONG_RUN = 256
#: Characters after which a text is cut at the next safe boundary.
PART_CHARS = 200_000
LONG = re.compile(f"(?<![{SPACE}])[{SPACE}]{{{LONG_RUN},}}")
SAFE = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load(ranks_path: str, pattern: str):
    """An encoder without special tokens; the rank file is read where it lies and never copied.  Its ``whole``
    is one that splits nothing, for what is one match already."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc, enc_whole = (tiktoken.Encoding("local", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (pattern, r"(?s:.+)"))
    enc.whole = enc_whole
    return enc


def parts(text: str) -> Iterator[tuple[bool, str]]:
    """(whether it is one match, text) in order; the texts join to the whole."""
    at = 0
    for m in LONG.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        yield from ((False, x) for x in _cut(text, at, m.start()))
        yield True, text[m.start():end]
        at = end
    yield from ((False, x) for x in _cut(text, at, len(text)))


def _cut(text: str, at: int, end: int) -> Iterator[str]:
    while at < end:
        m = SAFE.search(text, at + PART_CHARS, end) if end - at > PART_CHARS else None
        to = m.start() if m else end
        yield text[at:to]
        at = to


def encode(enc, text: str | None) -> Iterator[np.ndarray]:
    """The ids of a text, part by part."""
    for single, part in parts(text or ""):
        yield (enc.whole if single else enc).encode_to_numpy(part, disallowed_special=()).astype("<u4", copy=False)


def decode(enc, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def _each(docs: DataFrame, ranks_path: str, pattern: str, build, schema: str) -> DataFrame:
    loaded: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:
            loaded.append(load(ranks_path, pattern))
        for batch in sliced(batches):
            yield build(loaded[0], batch)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def tokenized(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of the whole text."""
    def build(enc, batch):
        ids = [np.concatenate([np.empty(0, "<u4"), *encode(enc, t.as_py())]).astype(np.int64) for t in batch.column(1)]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int64()))})

    return _each(docs, ranks_path, pattern, build, "doc_id long, ids array<long>")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, number of ids, and hashes of the ids and of what they decode to; streams each text by parts."""
    def build(enc, batch):
        out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in batch.column(1):
            n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
            for ids in encode(enc, text.as_py()):
                n += len(ids)
                of_ids.update(ids.tobytes())
                of_bytes.update(decode(enc, ids))
            out["n_tokens"].append(n)
            out["ids_sha256"].append(of_ids.hexdigest())
            out["decoded_sha256"].append(of_bytes.hexdigest())
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **out})

    return _each(docs, ranks_path, pattern, build, SCHEMA)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Documents with their text encoded and decoded again; a text that doesn't come back is an error."""
    loaded: list = []
    at = docs.columns.index("text")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not loaded:
            loaded.append(load(ranks_path, pattern))
        for batch in sliced(batches):
            texts = []
            for t in batch.column(at):
                t = t.as_py()
                back = t if t is None else b"".join(decode(loaded[0], ids) for ids in encode(loaded[0], t)).decode("utf-8")
                if back != t:
                    raise ValueError("a text didn't come back from its ids")
                texts.append(back)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)
