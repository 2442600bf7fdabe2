"""URL filters: given rules first, then association rules that FP-growth mines from labelled urls.

A url is a transaction of tokens (host suffix, host parts, path words, file ending, query
names, fragment).  A labelled url counts once, however many rows hold it; it is bad if at least half
of its labelled rows are.  A rule ``tokens -> bad`` holds for a url that has all its tokens; its
support is the number of bad labelled urls it holds for.  Rules are kept if they have a support of
``min_rows`` (an absolute number, so that a pattern isn't lost in a longer table), the confidence
``min_confidence`` and a lift of ``min_lift`` over the base rate, and if no rule of part of their
tokens is as confident.

What bounds the mining:
* Tokens that occur in exactly the same labelled urls are one item, so a url repeated with other
  numbers has one item, not all subsets of its tokens.  A rule asks for all tokens of its items.
* Items that are rules by themselves are found by counting and take no part in combinations, nor
  do items of all urls.
* Spark's FP-growth runs over the bad urls alone, whose frequent itemsets hold every antecedent with
  enough support; a rule's antecedent has up to LONGEST items.  A url enters with its WIDTH items that deviate most from
  the base rate, so that it has at most 2 ** WIDTH itemsets.
* Where a bad url has more items than that, the sets of all items of all urls are counted besides, a length at a time
  (``sets_of_any_width``), so every antecedent of up to LONGEST items is met at any width.  A set goes on
  only if it has enough support, fewer urls than each of its parts and a good url, since no rule that
  grows from another set is kept.
* Support and confidence of FP-growth's antecedents are then counted on whole urls, by the inverted index.

Each kept rule is posted in an inverted index under its rarest token, so that a url meets only rules
that share one token with it; the remaining tokens are compared as sets.  All of it is DataFrame code.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no given
rule, and has no tokens, so its verdict is allow; very long urls take part as above;
labels with nulls don't count as bad or good; empty labels give no mined rule; repeated pages are
judged each; of rules that tie in confidence the one with the larger support decides, then the
last in order of tokens; other columns are ignored; empty pages give an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import join_on_hot_key, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bad urls a rule must hold for.
MIN_ROWS = 20
#: Items of a url in combinations; items of an antecedent.
WIDTH, LONGEST = 12, 4

#: (action, host, path) of the given rules.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, action) of the longest rule that fits; nulls if none does."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, action = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url: parts that can recur; numbers count as one word."""
    host, path, rest = host_of(url), path_of(url), _rest(url)
    parts = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(F.translate(path, UPPER, LOWER), r"[/._-]"), lambda x: x != "")
    query = F.regexp_extract(rest, r"\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]), lambda x: x != "")
    all_of = F.concat(
        F.transform(parts, lambda x: F.concat(F.lit("h:"), x)),
        F.when(F.size(parts) >= 3, F.array(F.concat(F.lit("d:"), F.concat_ws(".", F.slice(parts, -3, 3))))).otherwise(F.array().cast("array<string>")),
        F.transform(words, lambda x: F.concat(F.lit("p:"), F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x))),
        F.transform(names, lambda x: F.concat(F.lit("q:"), x)),
        F.when(F.instr(rest, "#") > 0, F.array(F.lit("f:"))).otherwise(F.array().cast("array<string>")),
    )
    return F.coalesce(F.array_distinct(all_of), F.array().cast("array<string>"))


def fitting(sets: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """(key, rule columns) for each rule of ``index`` (token, freq, tokens, ...) that is a subset of the row's
    ``items``.  ``freq``, about how many rows hold the token, tells which posting lists need splitting."""
    rest = [c for c in index.columns if c not in ("token", "freq")]
    lists = written(index.groupBy("token").agg(F.max("freq").alias("freq"), F.collect_list(F.struct(*rest)).alias("rules")), "posting_lists")
    posted = sets.select(key, "items", F.explode("items").alias("token"))
    met = join_on_hot_key(posted, lists, "token", "freq", F.col(key), "inner").select(key, "items", F.inline("rules"))
    return met.where(F.size(F.array_except("tokens", "items")) == 0).drop("items")


def subsets(items: Column) -> Column:
    """All proper non-empty subsets of a short sorted array, each sorted."""
    all_of = F.aggregate(items, F.array(F.array().cast("array<bigint>")), lambda acc, x: F.concat(acc, F.transform(acc, lambda s: F.array_append(s, x))))
    return F.filter(all_of, lambda s: (F.size(s) > 0) & (F.size(s) < F.size(items)))


def sets_of_any_width(urls: DataFrame, single: DataFrame, min_rows: int) -> DataFrame:
    """of, n, n_bad: how many urls hold each set of 2 to LONGEST items, for all sets that may be kept as rules.
    ``urls``: u, bad, item; ``single``: item, n of the items."""
    held, sets, found = urls.select("u", "bad", F.array("item").alias("of")), single.select(F.array("item").alias("of"), "n"), None
    for size in range(2, LONGEST + 1):
        # two sets of a url that differ in their last items
        one = held.select("u", "bad", "of", F.slice("of", 1, size - 2).alias("start"))
        other = held.select("u", F.slice("of", 1, size - 2).alias("start"), F.element_at("of", -1).alias("further"))
        grown = one.join(other, ["u", "start"]).where(F.element_at("of", -1) < F.col("further")).select("u", "bad", F.array_append("of", F.col("further")).alias("of"))
        grown = written(grown, "url_sets")
        counted = grown.groupBy("of").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad")).where(F.col("n_bad") >= min_rows)
        parts = counted.select("of", "n", "n_bad", F.explode(F.transform("of", lambda x: F.array_remove("of", x))).alias("part"))
        least = parts.join(sets.select(F.col("of").alias("part"), F.col("n").alias("theirs")), "part").groupBy("of", "n", "n_bad").agg(F.count("*").alias("parts"), F.min("theirs").alias("least"))
        counted = written(least.where((F.col("parts") == size) & (F.col("least") > F.col("n"))).select("of", "n", "n_bad"), "url_set_counts")
        found = counted if found is None else found.unionByName(counted)
        sets = counted.where("n > n_bad").select("of", "n")
        if size < LONGEST:
            held = written(join_on_hot_key(grown, sets.withColumn("weight", F.col("n")).drop("n"), "of", "weight", F.col("u"), "inner"), "url_held_sets")
    return found


def mine(labelled: DataFrame, min_rows: int, min_confidence: float, min_lift: float) -> DataFrame:
    """Index (token, freq, tokens, confidence, support) of the pruned rules.  ``labelled``: url, bad (boolean)."""
    from pyspark.ml.fpm import FPGrowth

    urls = labelled.where("url is not null and bad is not null").groupBy("url").agg((2 * F.sum(F.col("bad").cast("long")) >= F.count("*")).alias("bad"))
    bags = written(urls.select(F.xxhash64("url").alias("u"), tokens_of(F.col("url")).alias("items"), "bad").where(F.size("items") > 0), "url_bags")
    n, n_bad = bags.agg(F.count("*"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))).first()
    if n_bad < min_rows:
        return bags.sparkSession.createDataFrame([], "token string, freq long, tokens array<string>, confidence double, support long")
    base = n_bad / n
    good_enough = (F.col("n_bad") >= min_rows) & (F.col("n_bad") / F.col("n") >= min_confidence) & (F.col("n_bad") / F.col("n") >= min_lift * base)
    same = [F.bit_xor(F.xxhash64("u", F.lit(k))).alias(f"urls{k}") for k in (1, 2)]
    tokens = bags.select("u", "bad", F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad"), *same).where(F.col("n_bad") >= min_rows)
    classes = tokens.groupBy("n", "n_bad", "urls1", "urls2").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    away = F.abs(F.col("n_bad") - F.col("n") * base) / F.sqrt(F.col("n") * F.lit(max(base * (1 - base), 1e-12)))
    classes = written(classes.select(F.xxhash64("n", "urls1", "urls2").alias("item"), "tokens", "n", "n_bad", good_enough.alias("alone"), away.alias("away")), "url_items")
    open_ = classes.where(~F.col("alone") & (F.col("n") < n)).select(F.explode("tokens").alias("token"), "item", "away", F.col("n_bad").alias("rows"))

    held = join_on_hot_key(bags.where("bad").select("u", F.explode("items").alias("token")), open_, "token", "rows", F.col("u"), "inner")
    every = held.groupBy("u").agg(F.sort_array(F.collect_set(F.struct("away", "item")), False).alias("x")).select(F.transform("x", lambda x: x["item"]).alias("all"))
    every = written(every.where(F.size("all") >= 2), "bad_url_items")
    bad_bags = every.select(F.slice("all", 1, WIDTH).alias("items"))
    m, widest = every.agg(F.count("*"), F.coalesce(F.max(F.size("all")), F.lit(0))).first()
    rules = classes.where("alone").select(F.array("item").alias("of"), "tokens", "n", "n_bad")
    if m >= min_rows:
        sets = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / m).fit(bad_bags).freqItemsets.where((F.size("items") >= 2) & (F.size("items") <= LONGEST)).select(F.array_sort("items").alias("of"))
        parts = sets.select("of", F.explode("of").alias("item")).join(classes.select("item", "tokens", "n"), "item")
        asked = parts.groupBy("of").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"), F.min_by(F.col("tokens")[0], "n").alias("token"), F.min("n").alias("freq"))
        counted = fitting(bags.select(F.struct("u", "bad").alias("own"), "items"), "own", written(asked, "url_antecedents"))
        rules = rules.unionByName(counted.groupBy("of", "tokens").agg(F.count("*").alias("n"), F.sum(F.col("own.bad").cast("long")).alias("n_bad")).where(good_enough))
    if widest > WIDTH:
        whole = join_on_hot_key(bags.select("u", "bad", F.explode("items").alias("token")), open_, "token", "rows", F.col("u"), "inner")
        single = open_.select("item").distinct().join(classes.select("item", "n"), "item")
        wide = written(sets_of_any_width(written(whole.select("u", "bad", "item").distinct(), "url_open_items"), single, min_rows).where(good_enough), "url_wide_rules")
        parts = wide.select("of", F.explode("of").alias("item")).join(classes.select("item", "tokens"), "item")
        tokens = parts.groupBy("of").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))
        rules = rules.unionByName(wide.join(tokens, "of").select("of", "tokens", "n", "n_bad")).dropDuplicates(["of"])
    rules = written(rules.select("of", "tokens", (F.col("n_bad") / F.col("n")).alias("confidence"), F.col("n_bad").alias("support"), "n"), "url_rules")
    part = rules.select(F.col("of").alias("part"), F.col("confidence").alias("theirs"))
    covered = rules.select("of", "confidence", F.explode(subsets(F.col("of"))).alias("part")).join(part, "part").where("theirs >= confidence").select("of").distinct()
    kept = rules.join(covered, "of", "left_anti")
    rarest = kept.select("of", F.explode("of").alias("item")).join(classes.select("item", F.col("tokens")[0].alias("token"), F.col("n").alias("freq")), "item").groupBy("of").agg(F.min_by("token", "freq").alias("token"), F.min("freq").alias("freq"))
    return written(kept.join(rarest, "of").select("token", "freq", "tokens", "confidence", "support"), "url_index")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, min_rows: int = MIN_ROWS, min_confidence: float = 0.6, min_lift: float = 1.5) -> DataFrame:
    """Per page: host, path, the given rule that fits, verdict, and the mined tokens that decided if any did.

    ``labels`` (doc_id, quality, toxic) belong to the page of the same number; bad is quality 0 or toxic 1.
    """
    bad = labels.groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(F.expr("quality = 0 or toxic = 1")).alias("bad"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    index = mine(pages.join(bad, "page_id").select("url", "bad"), min_rows, min_confidence, min_lift)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, action = given_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumns({"rule": name, "given": action})
    if index.isEmpty():
        found = judged.withColumn("mined", F.lit(None).cast("array<string>"))
    else:
        sets = judged.where("given is null and url is not null").groupBy("url").agg(F.count("*").alias("pages")).select(F.struct("url", "pages").alias("own"), tokens_of(F.col("url")).alias("items"))
        best = fitting(sets, "own", index).groupBy("own").agg(F.max(F.struct("confidence", "support", "tokens")).getField("tokens").alias("mined")).select("own.*", "mined")
        found = join_on_hot_key(judged, written(best, "url_matches"), "url", "pages", F.col("page_id"))
    verdict = F.coalesce("given", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "mined")
