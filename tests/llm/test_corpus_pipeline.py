"""The pipeline against brute force, and the queries that have SQL against it."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_set_operators import brute_components, brute_lines
from test_text_operators import brute_hits

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import bpe, langid, registry

SF = "/root/testdata/sf0.001"


def some_documents():
    rows = duckdb.sql(f"select doc_id, text, lang, source, n_chars from '{SF}/documents.parquet' where length(text) < 1500 order by doc_id limit 70").fetchall()
    rng = random.Random(12)
    nxt = 1000
    for r in list(rows[:20]):
        words = r[1].split(" ")
        if len(words) > 40:
            words[rng.randrange(len(words))] = f"changed{nxt}"
            rows.append((nxt, "\n".join(" ".join(words).split("\n")[::-1]), r[2], "src0", len(r[1])))
            nxt += 1
    item = duckdb.sql(f"select text from '{SF}/benchmark.parquet' order by item_id limit 1").fetchall()[0][0]
    return [*rows, (2000, "12 !!", "en", "src1", 5), (2001, None, "en", "src1", None), (2002, f"A start of its own. {item} And an end.", "en", "src1", 9), (2003, "", None, None, None)]


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = some_documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()

    learned = [(t, lang) for d, t, lang, *_ in rows if lang is not None and t is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    named, sure = langid.predict(langid.train(learned), [r[1] for r in rows])
    left = [(r[0], r[1]) for r, n, s in zip(rows, named, sure, strict=True) if n != "und" and s >= corpus_pipeline.LEAST_SCORE]
    left.sort()
    lines_of = brute_lines([t for _, t in left])
    cut = []
    for k, (d, t) in enumerate(left):
        n, *_, gone = lines_of[k]
        if not n or len(gone) < n:
            cut.append((d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)))
    _, label = brute_components([t for _, t in cut], 5, 80)
    kept = [x for k, x in enumerate(cut) if label[k] == k]
    clean = [(d, t) for d, t in kept if not brute_hits(t, items)[1]]
    assert len(left) < len(rows) and len(kept) < len(cut) <= len(left) and len(clean) < len(kept)

    enc = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = {d: (len(ids := enc.encode_ordinary(t)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t in clean}
    got = {r[0]: tuple(r)[1:] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes


def test_pipeline_edges(spark, tmp_path):
    """Nulls in every column, repeated rows and ids, columns with the stages' own names; empty tables."""
    good = "The first line is of its own kind and of some length.\nAnd here follows another line that nobody has said before."
    rows = [(1, good, "en", 7, "a", "k"), (1, good, "en", 7, "a", "k"), (2, good + "\nA third one ends the text with words of its own.", "en", None, None, None), (None, "A row without number keeps its text, whatever others say.", "en", 1, "b", "k"), (3, None, None, None, None, None), (4, "", "en", 0, "c", "k"), (None, None, None, None, None, None)]
    rows += [(10 + k, f"The words of document {k} are quite its own: w{k}a w{k}b w{k}c and w{k}d are with them.", "en", k, "x", "y") for k in range(40)]
    names = "doc_id long, text string, lang string, score int, own string, print string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, names)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "score", "own", "print"]
    left = {(r["doc_id"], r["score"], r["own"]) for r in docs.collect()}
    assert {(1, 7, "a"), (None, 1, "b"), (10, 0, "x")} <= left and not {3, 4} & {d for d, *_ in left}
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len({d for d, *_ in left})
    spark.createDataFrame([], names).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def plain(v):
    return round(float(v), 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in want.description)
    frame = entry.queries()[name](spark, SF)
    assert sorted(frame.columns) == columns
    order = [d[0] for d in want.description]
    sql = sorted(str([plain(r[order.index(c)]) for c in columns]) for r in want.fetchall())
    assert sorted(str([plain(r[c]) for c in columns]) for r in frame.collect()) == sql


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES}
    assert numbers == set(range(1, 11)) and "pipeline" in entry.queries()


def test_language_stage_keeps_columns_of_its_own_names(spark):
    rows = [(k, f"The words of document {k} are its own and plain.", "en", f"p{k}", 7.5, "x") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, _score string")
    out = corpus_pipeline.language(spark, docs, SF)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == rows
