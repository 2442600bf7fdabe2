"""Personal data: base patterns, and terms that reveal protected entities.

Base spans are the leftmost non-overlapping matches of four patterns; matches that fail
their check (address parts, digits, Luhn) are dropped without another try.  Spans come from
DataFrame functions alone: a text split by a pattern and the pattern's matches give all
places as running sums.

Each distinct value found is a protected entity, and so is what it shares with others: an address's
domain, an ip's network (three parts), a card's issuer (six digits), a phone's exchange (all but four
digits).  So entities that one text alone holds are still met in several, as members of their pool.

Co-occurrence is counted in windows: the words outside base spans within CONTEXT characters before or
after a span (a word cut by the edge isn't in).  A term is any run of letters, marks and digits,
lower-cased, short ones and numbers too.  Over N distinct texts, a term t is met in n_t, an entity e in
n_e, and both in one window in n_te; n_e and n_te are the lesser of the distinct texts and the distinct
windows, since neither copies of a text nor copies of a passage say anything new.  The pointwise mutual
information log2(N n / (n_t n_e)) is compared with what the entity itself carries, log2(N / n_e): a term
discloses an entity if it gives at least ``disclosure`` of that.  There n is the lower bound of n_te, the
mean of which so many are met by chance in a share TRUST of all cases, and n_te must be 2 at least: one
meeting is no co-occurrence, however rare the word.

A disclosing term is removed wherever it stands in the texts where it is met beside its entity, if it
gives all (within 1 %, by the counts themselves).  Otherwise it is generalised: a word that stands in
CONTAINS of the distinct windows that hold the term, in twice as many texts at least, is a concept that contains
it.  The term becomes the rarest such word that is too frequent to disclose any entity of the text, however
the two go together; a term without one is removed.

Patterns are written so that the engine neither recurses nor starts inside a run it has
tried (possessive groups; a match starts where the last one ended or off such a run), which
changes no match.

Edge cases: a null text is the empty text; very long texts are handled in time linear in their
length (spans by running sums in two levels, replacements cut from UTF-32 bytes); rows without
doc_id are judged too; repeated rows are judged each; a term with several entities takes the
strictest treatment; equally rare concepts go by their letters; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fits, join_on_hot_key, written

#: Patterns of the base kinds, in the order in which kinds are listed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Share of an entity's information from which a term discloses it; characters of a window on each side.
DISCLOSURE, CONTEXT = 0.6, 200
#: A count stands for the mean of which so many are met in this share of cases; the normal quantile of it.
TRUST, QUANTILE = 0.1, 1.2815515655446004
#: A concept stands in this share of the windows that hold the term it contains.
CONTAINS = 0.8
WORD = r"[\p{L}\p{M}\p{N}]"
#: Elements that one step of a running sum copies.
CHUNK = 256
SPANS = "array<struct<start:bigint,end:bigint,value:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine) -> Column:
    """What ``combine`` (associative, 0 its neutral element) makes of the values before each element,
    in two levels, so that long arrays aren't copied for each element."""
    zero = F.lit(0).cast("long")

    def prefixes(xs: Column) -> Column:
        return F.aggregate(xs, F.array(zero), lambda acc, x: F.array_append(acc, combine(F.element_at(acc, -1), x)))

    def chunked(xs: Column) -> Column:
        steps = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / CHUNK).cast("int"))
        return F.when(F.size(xs) > 0, F.transform(steps, lambda k: F.slice(xs, k * CHUNK + 1, F.lit(CHUNK)))).otherwise(F.array().cast("array<array<bigint>>"))

    def shifted(chunks: Column) -> Column:
        whole = F.transform(chunks, lambda c: F.aggregate(c, zero, combine))
        return let(prefixes(whole), lambda bases: F.flatten(F.transform(chunks, lambda c, k: F.transform(F.slice(prefixes(c), F.lit(1), F.size(c)), lambda x: combine(x, F.get(bases, k))))))

    return let(values, lambda xs: let(chunked(xs), shifted))


def places(text: Column, pattern: Column | str) -> Column:
    """Array of (start, end, value) of all matches, in code points: the text split by the pattern
    gives the gap before each match."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern

    def measured(found: Column) -> Column:
        gaps = F.slice(F.split(text, regex, -1), F.lit(1), F.size(found))
        return F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("value"), F.length(g).cast("long").alias("gap"), (F.length(g) + F.length(m)).cast("long").alias("step")))

    def placed(steps: Column) -> Column:
        before = running(F.transform(steps, lambda x: x["step"]), lambda a, x: a + x)
        return F.zip_with(steps, before, lambda x, b: F.struct((b + x["gap"]).alias("start"), (b + x["step"]).alias("end"), x["value"].alias("value")))

    return let(F.regexp_extract_all(text, regex, F.lit(0)), lambda found: let(measured(found), placed))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Whether the digits of x pass the Luhn check."""
    ds = F.reverse(F.regexp_extract_all(x, F.lit("[0-9]"), F.lit(0)))
    twice = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    values = F.transform(ds, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(twice(c.cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str, x: Column) -> Column:
    if kind == "ip":  # a part of more than three digits after its zeros is over 255
        return F.forall(F.split(x, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        n = F.length(digits(x))
        return F.when((n >= 13) & (n <= 19), luhn(x)).otherwise(F.lit(False))
    if kind == "phone":
        n = F.length(digits(x))
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    """kind -> array of (start, end, value), checked."""
    may = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.rlike(r"\+[0-9]")}
    none = F.array().cast(SPANS)

    def checked(kind: str, pattern: str) -> Column:
        return F.when(may[kind], F.filter(places(text, pattern), lambda m: valid(kind, m["value"]))).otherwise(none)

    return {k: checked(k, p) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)}


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, print (of the text), a column of spans for each kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", "text", text_print(F.col("text")).alias("print"), *[c.alias(k) for k, c in base_spans(F.col("text")).items()])


def held() -> Column:
    """Whether a row of ``spans_of`` holds a base span."""
    return sum((F.size(k) for k in KINDS), F.lit(0)) > 0


def entities_of(kind: str, value: Column) -> Column:
    """The protected entities of a base value: itself (emails lower-cased, numbers by their digits) and its pool."""
    if kind == "email":
        plain = F.translate(value, UPPER, LOWER)
        pool = F.concat(F.lit("@"), F.substring_index(plain, "@", -1))
    elif kind == "ip":
        plain, pool = value, F.concat(F.substring_index(value, ".", 3), F.lit(".*"))
    else:
        plain = digits(value)
        pool = F.concat(F.substr(plain, F.lit(1), F.lit(6) if kind == "card" else F.length(plain) - 4), F.lit("*"))
    return F.transform(F.array(plain, pool), lambda x: F.concat(F.lit(f"{kind}:"), x))


def words_of(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")), "")


def piece(raw: Column, start: Column, size: Column) -> Column:
    """A part of a text in UTF-32 bytes, whose places need no counting."""
    return F.decode(F.substr(raw, (start * 4 + 1).cast("int"), (size * 4).cast("int")), "UTF-32")


def rebuilt(text: Column, cuts: Column, put) -> Column:
    """The text with ``put(cut, covered)`` in place of what each cut (start, end, ...) takes away, where
    ``covered`` is the largest end of the cuts before it."""
    def built(raw: Column, ordered: Column, covered: Column) -> Column:
        parts = F.zip_with(ordered, covered, lambda m, b: F.concat(F.when(m["start"] > b, piece(raw, b, m["start"] - b)).otherwise(F.lit("")), put(m, b)))
        last = F.array_max(F.transform(ordered, lambda m: m["end"]))
        return F.concat(F.array_join(parts, ""), piece(raw, last, F.greatest(F.length(text).cast("long") - last, F.lit(0))))

    def whole(ordered: Column) -> Column:
        covered = running(F.transform(ordered, lambda m: m["end"]), lambda a, x: F.greatest(a, x))
        return F.when(F.size(ordered) > 0, let(F.encode(text, "UTF-32"), lambda raw: let(covered, lambda c: built(raw, ordered, c)))).otherwise(text)

    return let(F.array_sort(cuts), whole)


def outside(text: Column, spans: Column) -> Column:
    """The text with blanks in place of the spans (start, end, value); all other places stay the same."""
    return rebuilt(text, spans, lambda m, b: F.repeat(F.lit(" "), F.greatest(m["end"] - F.greatest(b, m["start"]), F.lit(0)).cast("int")))


def terms_at(text: Column) -> Column:
    """Array of (start, end, value) of a text's terms, as they stand."""
    return places(text, WORD + "+")


def windows_of(blank: Column) -> Column:
    """Array of (entities, near) of every base span, where ``blank`` is the text outside the spans and ``near``
    its part around the span, without words that an edge cuts."""
    n = F.length(blank).cast("long")

    def near(raw: Column, m: Column) -> Column:
        first, last = F.greatest(m["start"] - CONTEXT, F.lit(0)), F.least(m["end"] + CONTEXT, n)
        before, after = piece(raw, first, m["start"] - first), piece(raw, m["end"], last - m["end"])
        before = F.when(first > 0, F.regexp_replace(before, f"\\A{WORD}+", "")).otherwise(before)
        after = F.when(last < n, F.regexp_replace(after, f"(?<!{WORD}){WORD}++\\z", "")).otherwise(after)
        return F.lower(F.concat(before, F.lit(" "), after))

    def of_kind(raw: Column, kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(entities_of(kind, m["value"]).alias("entities"), near(raw, m).alias("near")))

    return let(F.encode(blank, "UTF-32"), lambda raw: F.concat(*[of_kind(raw, k) for k in KINDS]))


def text_print(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def sure(n: Column) -> Column:
    """The mean of which n or more are met by chance in a share TRUST of all cases (Poisson, by the cube-root formula)."""
    return n * F.pow(1 - 1 / (9 * n) - QUANTILE / (3 * F.sqrt(n)), F.lit(3.0))


@dataclass(frozen=True)
class Disclosure:
    """windows: print (64 bits of the text's), seen (a hash of the window), entity, n_e, terms: a row for each
    distinct window and entity that several hold.  entities: entity, n_e.  told: entity, term, n_te, n_e, n_t,
    whole: the pairs that disclose.  counts: term, n_t of terms met twice with an entity.  total: distinct texts."""

    windows: DataFrame
    copies: DataFrame
    entities: DataFrame
    told: DataFrame
    counts: DataFrame
    total: int
    disclosure: float

    def may(self, n_t: Column, n_e: Column) -> Column:
        """No term of more texts can give ``disclosure`` of an entity of n_e texts, since both are together in n_e at most."""
        return n_t <= (float(self.total) ** (1 - self.disclosure)) * F.pow(n_e.cast("double"), F.lit(self.disclosure)) * (1 + 1e-9)


def disclosing(spans: DataFrame, disclosure: float = DISCLOSURE) -> Disclosure:
    """Which terms disclose which entities, of the (written) rows of ``spans_of``.

    Windows are few beside the texts, so pairs are counted in them first; of the texts' words only those that
    are met twice with an entity are then counted.  A row counts 1 / (copies of its text), so that a text
    counts once, however many rows hold it."""
    prints = written(spans.groupBy("print").agg(F.count(F.lit(1)).alias("rows")), "texts")
    total, copies = prints.count(), prints.where("rows > 1")

    met = F.least(F.count_distinct("print"), F.count_distinct("seen"))
    blank = spans.where(held()).select(F.xxhash64("print").alias("print"), *KINDS, F.explode(F.array(outside(F.col("text"), F.concat(*KINDS)))).alias("blank"))
    near = blank.select("print", F.inline(windows_of(F.col("blank")))).distinct()
    around = near.select("print", F.xxhash64("near").alias("seen"), words_of(F.col("near")).alias("terms"), F.explode("entities").alias("entity"))
    around = written(around, "windows")
    entities = written(around.groupBy("entity").agg(met.alias("n_e"), F.count(F.lit(1)).alias("rows")), "entities")
    windows = written(join_on_hot_key(around, entities.where("n_e > 1"), "entity", "rows", F.col("print"), "inner"), "pooled_windows")

    pairs = windows.select("entity", "n_e", "print", "seen", F.explode("terms").alias("term"))
    twice = pairs.groupBy("entity", "n_e", "term").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    twice = written(twice, "pairs")
    asked = written(twice.select("term").distinct(), "asked_terms")
    plain = F.when(held(), outside(F.col("text"), F.concat(*KINDS))).otherwise(F.col("text"))
    bags = join_on_hot_key(spans.select("print", words_of(plain).alias("terms")), copies.withColumn("copies", F.col("rows")), "print", "rows", F.monotonically_increasing_id())
    said = bags.select(F.explode("terms").alias("term"), (1.0 / F.coalesce("copies", F.lit(1))).alias("share"))
    summed = lambda words: words.groupBy("term").agg(F.round(F.sum("share")).cast("long").alias("n_t"))
    counts = summed(said.join(F.broadcast(asked), "term", "left_semi")) if fits(asked) else summed(said).join(asked, "term", "left_semi")
    counts = written(counts, "term_counts")

    n_t, n_e, n_te, whole = F.col("n_t"), F.col("n_e"), F.col("n_te"), float(max(total, 1))
    weights = twice.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    known = join_on_hot_key(twice, counts.join(weights, "term"), "term", "_n", F.col("entity"), "inner")
    out = Disclosure(windows, copies, entities, None, counts, total, disclosure)
    known = written(known.where(out.may(n_t, n_e)).select(F.struct("entity", "term").alias("key"), "n_t", "rows"), "rare_pairs")
    # what each pair is met in, of pairs rare enough to disclose
    met_in = join_on_hot_key(pairs.withColumn("key", F.struct("entity", "term")), known, "key", "rows", F.col("print"), "inner")
    known = met_in.groupBy("entity", "n_e", "term", "n_t").agg(met.alias("n_te"), F.count(F.lit(1)).alias("rows")).where("n_te > 1")
    carried, given = F.log2(whole / n_e), lambda n: F.log2(whole * n / (n_t * n_e))
    told = known.where((carried > 0) & (given(sure(n_te)) >= disclosure * carried)).withColumn("whole", given(n_te) >= 0.99 * carried)
    return replace(out, told=written(told, "told"))


def contained(found: Disclosure, terms: DataFrame) -> DataFrame:
    """term, most, to: the rarest word that contains the term and discloses no entity of ``most`` texts (of those ``terms`` that have one)."""
    seen = found.windows.groupBy("seen").agg(F.first("terms").alias("terms"))
    asked = terms.groupBy("term").agg(F.first("n_t").alias("n_t"))
    held_by = seen.select("terms", F.explode("terms").alias("term"))
    # a told term is in few texts (``may``), its windows are no more than their spans
    near = join_on_hot_key(held_by, asked.withColumn("_n", F.col("n_t")), "term", "_n", F.hash("terms"), "inner")
    both = near.select("term", "n_t", F.explode("terms").alias("to")).groupBy("term", "n_t", "to").agg(F.count(F.lit(1)).alias("n"))
    alone = both.where("term = to").select("term", F.col("n").alias("n_w"))
    wider = both.where("term != to").join(alone, "term").where((F.col("n_w") > 1) & (F.col("n") >= CONTAINS * F.col("n_w")))
    sizes = found.counts.select(F.col("term").alias("to"), F.col("n_t").alias("n_to"), F.col("n_t").alias("_n"))
    wider = join_on_hot_key(wider.select("term", "n_t", "to"), sizes, "to", "_n", F.col("term"), "inner").where("n_to >= 2 * n_t")
    fit = terms.select("term", "most").distinct().join(wider, "term").where(~found.may(F.col("n_to"), F.col("most")))
    return fit.groupBy("term", "most").agg(F.min(F.struct("n_to", "to"))["to"].alias("to"))


def treated(found: Disclosure) -> DataFrame:
    """print, term, to: what becomes of each disclosing term of a text, a wider word or nothing."""
    key = F.struct("entity", "term").alias("key")
    at = found.windows.select("print", "entity", "n_e", F.explode("terms").alias("term")).select("print", "term", key)
    told = found.told.select(key, "n_t", "whole", "rows")
    met = join_on_hot_key(at, told, "key", "rows", F.col("print"), "inner")
    largest = written(found.windows.groupBy("print").agg(F.max("n_e").alias("most")), "largest_entities")
    met = written(met.groupBy("print", "term").agg(F.max("whole").alias("whole"), F.first("n_t").alias("n_t")).join(largest, "print"), "met_terms")
    wider = contained(found, met.where(~F.col("whole")))
    return met.join(wider, ["term", "most"], "left").select("print", "term", F.when(F.col("whole"), "").otherwise(F.coalesce("to", F.lit(""))).alias("to"))


def coverage(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """kind, n_entities, n_with_terms (entities, pools included, that a term discloses)."""
    found = disclosing(written(spans_of(docs), "spans"), disclosure)
    told = found.told.select("entity").distinct().withColumn("told", F.lit(1).cast("long"))
    each = found.entities.join(told, "entity", "left").select(F.substring_index("entity", ":", 1).alias("kind"), F.coalesce("told", F.lit(0).cast("long")).alias("told"))
    return each.groupBy("kind").agg(F.count("*").alias("n_entities"), F.sum("told").alias("n_with_terms"))


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, text, the kinds' spans, and the spans of disclosing terms with what becomes of them (to)."""
    spans = written(spans_of(docs), "spans")
    found = disclosing(spans, disclosure)
    terms = written(treated(found), "treated")
    told = terms.select("print").distinct()
    printed = spans.where(held()).withColumn("full", F.col("print")).withColumn("print", F.xxhash64("full"))
    texts = printed.join(told, "print", "left_semi").dropDuplicates(["full"])
    tokens = texts.select("print", "full", F.explode(F.array(outside(F.col("text"), F.concat(*KINDS)))).alias("blank")).select("print", "full", F.explode(terms_at(F.col("blank"))).alias("m"))
    at = tokens.withColumn("term", F.lower("m.value")).join(terms, ["print", "term"])
    per_text = at.groupBy(F.col("full").alias("print")).agg(F.array_sort(F.collect_list(F.struct("m.start", "m.end", "m.value", "to"))).alias(TERM))
    weighed = written(per_text.join(found.copies, "print", "left").withColumn("rows", F.coalesce("rows", F.lit(1))), "terms_of_texts")
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,to:string>>")
    if fits(weighed):
        every = spans.join(F.broadcast(weighed), "print", "left")
    else:  # texts without entities needn't move
        marked = join_on_hot_key(spans.where(held()), weighed, "print", "rows", F.monotonically_increasing_id())
        every = marked.unionByName(spans.where(~held()).withColumn(TERM, none))
    return every.select("doc_id", "text", *KINDS, F.coalesce(TERM, none).alias(TERM))


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind as listed, then start."""
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda m: F.concat(F.lit(f"{kind}:"), m["start"].cast("string"), F.lit(":"), m["end"].cast("string")))

    return F.array_join(F.concat(*[named(k) for k in kinds]), ",")


def cleaned() -> Column:
    """The text with base values replaced by their kind's name, disclosing terms removed or generalised."""
    to = lambda kind: F.transform(kind, lambda m: F.struct(m["start"], m["end"], F.lit(f"[{kind.upper()}]").alias("to")))
    cuts = F.concat(*map(to, KINDS), F.transform(TERM, lambda m: F.struct(m["start"], m["end"], m["to"])))
    return rebuilt(F.col("text"), cuts, lambda m, b: F.when(m["start"] >= b, m["to"]).otherwise(F.lit("")))


def clean_text(judged: DataFrame) -> DataFrame:
    """doc_id, the sanitised text."""
    return judged.select("doc_id", cleaned().alias("text"))


def digest(judged: DataFrame) -> DataFrame:
    """The columns of the query, and the sanitised text."""
    return judged.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined(KINDS), 256).alias("base_sha256"), joined((*KINDS, TERM)).alias("spans"), cleaned().alias("sanitised"))
