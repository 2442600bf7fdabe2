"""A corpus from documents: language, repeated lines, near-duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.  SQL can't express the first stage's learned model, so run() is
tested against the operators' brute-force versions.

Each stage's rows are written to the shared folder and reread as the next one's documents; what a stage
writes on its way, and its predecessor's rows, go when its own rows are written.

Edge cases: a null or empty text, or one without a letter, has no language and goes in the first stage; very
long texts pass every stage whole; of tied or repeated lines and documents the smallest (doc_id, line)
and doc_id stay; rows that share a doc_id stay or go together in near-dedup, by each of their texts, and
rows without doc_id are never repeats; further columns of documents, whatever their names, pass through all
stages but the last; empty documents give an empty result, an empty benchmark removes nothing, and documents
without any known language leave none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, langid, lines, minhash
from tidemark.llm.shared import fresh_path, remove, scope, table, write_to

#: Below this share of its words' mass, a document's language isn't settled and the document goes.
LEAST_SCORE = 0.4


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    # the operator's own columns replace those of their names, so these travel under others
    free = "_" * (1 + max(map(len, docs.columns)))
    held = docs.toDF(*[free + c if c in ("lang_pred", "score") else c for c in docs.columns])
    judged = langid.identify(held).where((F.col("lang_pred") != langid.UNDECIDED) & (F.col("score") >= LEAST_SCORE))
    return judged.select(*[F.col(h).alias(c) for h, c in zip(held.columns, docs.columns, strict=True)])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; documents of which a line is left."""
    return _counted(lines.without_repeats(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.kept_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language ID", language), ("line dedup", line_dedup), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("byte-level BPE", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "_"))
        with scope(spark):
            docs = write_to(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        before = path
    return docs
