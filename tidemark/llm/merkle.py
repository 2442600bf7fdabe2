"""Merkle manifest of a dataset: leaf digests, group roots, one root, and a proof for every row.

H is SHA-256 as lower-case hex text.  A leaf is H of the row's columns, each as ``-`` if null, else as its
UTF-8 byte count, ``:`` and its text.  The leaves of a group ascend by the order column; while a group has
several nodes, every FANOUT consecutive ones (the last run may be shorter, even one) become H of their texts.
A group's last node is its subroot, a lone leaf itself; the subroots in order of their groups (null first,
UTF-8 bytewise) make the root in the same way.

Rows get their places by one range sort and sums over its partitions.  Blocks of FANOUT ** LEVELS aligned
nodes are tasks: a block's digests are one numpy matrix of 64-byte rows, reshaped by the fanout and hashed
level by level; its top is a node of the next tier, a 4096th of the one below.  Proofs come down again tier by
tier: index arithmetic gives the siblings of all nodes of a block, and what is above the block is appended.
So no task holds more than a block, however large a group is, and each tier is written to the shared folder.

A proof is an array of (slot, others), lowest level first: the node's place in its run and the run's other
digests from left to right.  ``folded`` recomputes a root from a leaf and its proof by built-in functions; a proof is some KB, so digests of it
are made in the block's task, and proofs themselves leave it only on request.

Edge cases: nulls in any column are part of the leaf (an empty text is ``0:``, unlike null); rows without order
value come first; rows with equal order values follow by leaf, so equal rows may take each other's proof;
texts of any length are hashed whole; a run of one has no siblings and is hashed again, a group of one row
is its own leaf; an empty table has no rows and no root (None); further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .shared import placed, written

FANOUT, LEVELS = 8, 4
#: Characters of a digest.
WIDTH = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = ArrayType(StructType([StructField("slot", IntegerType()), StructField("others", StringType())]))


def leaf_of(*values: Column) -> Column:
    """H of a row's values."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, values)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    def up(digest: Column, step: Column) -> Column:
        before = step["slot"] * WIDTH
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), before), digest, F.substring(step["others"], before + 1, F.length(step["others"]))), 256)

    return F.aggregate(proof, leaf, up)


def _matrix(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(digests.to_pylist()).encode(), np.uint8).reshape(-1, WIDTH)


def levels_of(nodes: np.ndarray, of: int, levels: int = LEVELS) -> list[np.ndarray]:
    """The levels of a block (rows of digests) of a group of ``of`` nodes, lowest first."""
    out = [nodes]
    while len(out) <= levels if of > FANOUT**levels else len(out[-1]) > 1:
        below = out[-1]
        whole = len(below) // FANOUT
        runs = [*below[:whole * FANOUT].reshape(whole, FANOUT * WIDTH)] + ([below[whole * FANOUT:]] if len(below) % FANOUT else [])
        out.append(np.frombuffer("".join(hashlib.sha256(run.tobytes()).hexdigest() for run in runs).encode(), np.uint8).reshape(-1, WIDTH))
    return out


def siblings(nodes: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Of each place in ``own`` in a level: the slot in its run, and the run's other digests."""
    slot = own % FANOUT
    first = own - slot
    step = np.arange(FANOUT - 1)
    others = first[:, None] + step + (step >= slot[:, None])
    count = np.minimum(first + FANOUT, len(nodes)) - first - 1
    text, row = nodes[np.minimum(others, len(nodes) - 1)].tobytes(), (FANOUT - 1) * WIDTH
    return slot, [text[i * row:i * row + n * WIDTH] for i, n in enumerate(count.tolist())]


def _ordered(block: pa.Table) -> pa.Table:
    return block.take(pa.array(np.argsort(block.column("pos").to_numpy(), kind="stable")))


def _climb(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of every group's tree, lowest first, and its root (g, pos 0, n 1, digest)."""
    def top(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        group, of, number = (k.as_py() for k in key)
        digest = levels_of(_matrix(_ordered(block).column("digest")), of, levels)[-1]
        return pa.table({"g": [group], "pos": [number], "n": [-(-of // FANOUT**levels)], "digest": [digest.tobytes().decode()]})

    tiers = [nodes]
    while True:
        tops = tiers[-1].groupBy("g", "n", _block(levels)).applyInArrow(top, "g string, pos long, n long, digest string")
        tops = written(tops, "merkle_tier")
        if not tops.where("n > 1").head(1):
            return tiers, tops
        tiers.append(tops)


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / FANOUT**levels).alias("block")


def _proven(block: pa.Table, above: pa.Table, levels: int) -> tuple[pa.Table, list[list[tuple[int, bytes]]]]:
    """A block's rows with their subroot, and each row's proof; above: the one row of the block's top."""
    block = _ordered(block)
    nodes = levels_of(_matrix(block.column("digest")), block.column("n")[0].as_py(), levels)
    at = np.arange(block.num_rows)
    steps = [siblings(level, at // FANOUT**k) for k, level in enumerate(nodes[:-1])]
    tail = [(u["slot"], u["others"].encode()) for u in above.column("proof").to_pylist()[0]]
    own = zip(*(zip(slot.tolist(), others, strict=True) for slot, others in steps), strict=True) if steps else [()] * len(at)
    root = pa.array([above.column("subroot")[0].as_py()] * len(at), pa.string())
    return block.drop_columns(["block"]).append_column("subroot", root), [[*some, *tail] for some in own]


def _arrow(proofs: list[list[tuple[int, bytes]]]) -> pa.Array:
    flat = [step for proof in proofs for step in proof]
    values = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.int32()), pa.array([o for _, o in flat], pa.string())], ["slot", "others"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, proofs)]), pa.int32()), values)


def _told(leaf: str, proof: list[tuple[int, bytes]]) -> tuple[str, str]:
    """H of a proof's siblings, and the root that a leaf and the proof give."""
    digest, all_others = leaf.encode(), hashlib.sha256()
    for slot, others in proof:
        all_others.update(others)
        digest = hashlib.sha256(others[:slot * WIDTH] + digest + others[slot * WIDTH:]).hexdigest().encode()
    return all_others.hexdigest(), digest.decode()


def _descend(tiers: Sequence[DataFrame], above: DataFrame, levels: int, claimed: str | None = None, proofs: bool = True) -> DataFrame:
    """The lowest tier's rows with subroot and, if asked for, proof; with a ``claimed`` column also proof_sha256 and
    folded_root, which that leaf gives.  above: the roots (g, pos, subroot, proof)."""
    def prove(lowest: bool):
        def run(block: pa.Table, over: pa.Table) -> pa.Table:
            out, found = _proven(block, over, levels)
            if lowest and claimed:
                told = [_told(leaf, proof) for leaf, proof in zip(out.column(claimed).to_pylist(), found, strict=True)]
                out = out.append_column("proof_sha256", pa.array([p for p, _ in told], pa.string())).append_column("folded_root", pa.array([f for _, f in told], pa.string()))
            return out.append_column("proof", _arrow(found)) if proofs or not lowest else out

        return run

    text = lambda *names: [StructField(n, StringType()) for n in names]
    for tier in reversed(tiers):
        lowest = tier is tiers[0]
        fields = [*tier.schema.fields, *text("subroot", *(["proof_sha256", "folded_root"] if lowest and claimed else [])), *([StructField("proof", PROOF)] if proofs or not lowest else [])]
        over = above.select("g", F.col("pos").alias("block"), "subroot", "proof")
        above = tier.withColumn("block", _block(levels)).groupBy("g", "block").cogroup(over.groupBy("g", "block")).applyInArrow(prove(lowest), StructType(fields))
    return above


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id", claimed: Column | None = None, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """The order column, leaf, subroot, root, proof_sha256 (H of the proof's siblings) and folded_root of every row, and with
    ``proofs`` the proof.  folded_root is what the ``claimed`` leaf (null: the row's own) gives with the proof."""
    # keys of groups ascend with null first
    key = F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n"))
    leaf = leaf_of(*map(F.col, columns))
    rows = docs.select(key.alias("g"), F.col(order).alias("_order"), leaf.alias("digest"), (leaf if claimed is None else F.coalesce(claimed, leaf)).alias("claimed"))
    # written first: the range sort looks at its rows twice, texts are read and hashed once
    tiers, subroots = _climb(placed(written(rows, "merkle_leaves"), "g", ["_order", "digest"]), levels)
    over, roots = _climb(placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), "g", ["of"]), levels)
    found = roots.head(1)
    start = roots.select("g", "pos", F.col("digest").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    above = written(_descend(over, start, levels).select(F.col("of").alias("g"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "proof"), "merkle_subroots")
    proven = _descend(tiers, above, levels, "claimed", proofs)
    root = F.lit(found[0]["digest"] if found else None).cast("string").alias("root")
    return proven.select(F.col("_order").alias(order), F.col("digest").alias("leaf"), "subroot", root, "proof_sha256", "folded_root", *(["proof"] if proofs else []))
