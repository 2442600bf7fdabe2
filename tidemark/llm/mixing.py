"""A mixture of sources with target weights: repetition rates, whole copies and one drawn copy.

The words of every source are summed; sources in order of their code points (null last) get the weights by
turns and share SHARE times all words.  No source gets more than MOST times its words; what is above goes to
the others by weight until none is above.  A source's rate is its target over its words; a document is taken
floor(rate) times, and once more if a number from a hash of (seed, doc_id) in [0, 1) lies below the fraction.

A text is read once: sizes are written to the shared folder, summed with map-side combining (a source
may hold any share of the rows), and the sources' targets, a row for each, come back by a measured broadcast
or a join that splits hot sources.  Sharing out is an aggregate over the sources a round; only sums come
to the driver, and integers decide which source is above, so reruns agree.

Edge cases: a null text has no words, nor has an empty one or one of white space; a source without words has
target and rate 0 and none of its documents is taken; null is a source by itself, unlike the empty name; rows with one
doc_id are drawn together, rows without doc_id by their texts (null texts together); texts of any length count whole; an
empty table gives an empty result; further columns pass through ``mixture`` (its own, ``copy``, replaces
one of that name) and don't matter elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import join_on_hot_key, placed, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
SEED = "mixture"
#: Hex digits of a digest that make the drawn number, exact in a double.
DIGITS = 13


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), text), F.lit("none"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), named), 256)
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def _key(source: Column) -> Column:
    """Sources as texts that ascend by code point with null last."""
    return F.coalesce(F.concat(F.lit("v"), source.cast("string")), F.lit("z"))


def _measured(docs: DataFrame, seed: str) -> DataFrame:
    rows = docs.select("doc_id", _key(F.col("source")).alias("_source"), words(F.col("text")).alias("size"), drawn(F.col("doc_id"), F.col("text"), seed).alias("_drawn"))
    return written(rows, "sizes")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """_source, _rows, source_size, weight, target, rate of every source; sizes: _source, size."""
    summed = sizes.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    ranked = placed(summed.withColumn("g", F.lit("")), "g", ["_source"])
    sources = written(ranked.select("_source", "_rows", "source_size", turn.alias("weight"), (F.col("source_size") * most).alias("_cap")), "sources")

    total, free = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    part, held, n_held = Fraction(share), 0, 0
    while True:
        # a source's part of what the held ones leave is above its cap; all in integers
        rest = part.numerator * total - part.denominator * held
        above = F.col("_cap").cast("decimal(38,0)") * F.lit(Decimal(part.denominator * free)) < F.col("weight").cast("decimal(10,0)") * F.lit(Decimal(rest))
        found = sources.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if found[0] == n_held or found[2] == 0:
            break
        n_held, held, free = found
    given = F.lit(rest / part.denominator) * F.col("weight") / F.lit(float(max(free, 1)))
    target = F.when(above, F.col("_cap").cast("double")).otherwise(F.least(given, F.col("_cap").cast("double")))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return sources.withColumn("target", target).withColumn("rate", rate).drop("_cap")


def _copies(rate: Column, number: Column) -> Column:
    return (F.floor(rate) + (number < rate - F.floor(rate)).cast("long")).cast("long")


def taken(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """doc_id, size, source_size, target, rate and copies of every document."""
    sizes = _measured(docs, seed)
    found = written(targets(sizes, **how).drop("weight"), "targets")
    out = join_on_hot_key(sizes, found, "_source", "_rows", F.col("_drawn"))
    return out.select("doc_id", "size", "source_size", "target", "rate", _copies(F.col("rate"), F.col("_drawn")).alias("copies"))


def mixture(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The documents of the mixture, each as often as it is taken; copy: its number from 1."""
    found = written(targets(_measured(docs, seed), **how).select("_source", "_rows", "rate"), "rates")
    free = "_" * (1 + max(map(len, docs.columns)))
    own = docs.drop("copy").columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias(free), _key(F.col("source")).alias("_source"), drawn(F.col("doc_id"), F.col("text"), seed).alias("_drawn"))
    joined = join_on_hot_key(keyed, found, "_source", "_rows", F.col("_drawn"))
    copies = _copies(F.col("rate"), F.col("_drawn"))
    numbers = F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies)).otherwise(F.array().cast("array<bigint>"))).alias("copy")
    return joined.select(free, numbers).select(f"{free}.*", "copy")
