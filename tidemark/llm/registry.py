"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, codes, decontaminate, langid, lines, merkle, minhash, mixing, pii, topk, toxicity, url_rules, warc
from .shared import table


def op3_decontaminate(spark, sf_dir):
    return decontaminate.digest(decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))).drop("spans")


def op4_language_id(spark, sf_dir):
    judged = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select(F.col("doc_id").cast("long").alias("doc_id"), langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_url_filters(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_warc(spark, sf_dir):
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


def op6_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_line_dedup(spark, sf_dir):
    return lines.summary(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op10_pii(spark, sf_dir):
    return pii.digest(pii.sanitise(table(spark, sf_dir, "documents")))


def op11_vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # a tampered row: text in lower case where 3 divides the number's checksum
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_of(*map(F.col, merkle.COLUMNS[:-1]), F.translate("text", UPPER, UPPER.lower())))
    out = merkle.manifest(docs, claimed=tampered)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_mixing(spark, sf_dir):
    out = mixing.taken(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
QUERIES = {"op1_url_filters": op1_url_filters, "op2_warc": op2_warc, "op6_minhash": op6_minhash, "op7_line_dedup": op7_line_dedup, "op8_toxicity": op8_toxicity, "op9_top_k": op9_top_k, "op10_pii": op10_pii, "op3_decontaminate": op3_decontaminate, "op4_language_id": op4_language_id, "op5_byte_bpe": op5_byte_bpe, "op11_vector_codes": op11_vector_codes, "op12_merkle_manifest": op12_merkle_manifest, "op13_mixing": op13_mixing}
#: SQL for A-Z lower-cased only.
FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bs AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bs),
ks AS (SELECT DISTINCT k FROM bw),
ds AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
m AS (SELECT ds.doc_id, ds.i, ds.k, bw.item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM ds) ds JOIN bw ON bw.k = ds.k AND bw.g = ds.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS g FROM p),
f AS (SELECT g, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY g)
SELECT page_id, n::BIGINT AS payload_bytes, d.g AS payload_digest,
       CASE WHEN f.first IS NULL OR page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.g = f.g
"""

OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM e),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY 1, 2) x
      JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * x.c >= 85 * (na.n + nb.n - x.c)),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.u AS component_id, d.doc_id = c.u AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT v, min(u) AS u FROM r GROUP BY v) c ON c.v = d.doc_id
"""

OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

#: One round of assignment and one of moved entries, after the codebooks of round {0}.
_ASSIGNED = """
a{0} AS MATERIALIZED (SELECT vec_id, label, part, v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT x.vec_id, x.label, x.part, x.v, b.e, list_sum(list_transform(list_zip(x.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d
  FROM x JOIN b{0} b ON b.part = x.part) GROUP BY vec_id, label, part, v)"""
_MOVED = """
m{0} AS (SELECT part, e, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM (SELECT part, e, v, unnest(range(1, len(v) + 1)) AS i FROM a{0}) GROUP BY part, e, i),
f{0} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM m{0} GROUP BY part, e),
b{1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(f.c, b.c) AS c FROM b{0} b LEFT JOIN f{0} f ON f.part = b.part AND f.e = b.e)"""

OP11_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, part, v[part * w + 1:(part + 1) * w] AS v FROM (SELECT *, len(v) // 16 AS w, unnest(range(16)) AS part FROM k)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < 64),
b0 AS MATERIALIZED (SELECT part, e, v AS c FROM x JOIN s USING (vec_id)),{_ASSIGNED.format(0)},{_MOVED.format(0, 1)},{_ASSIGNED.format(1)},{_MOVED.format(1, 2)},{_ASSIGNED.format(2)},
t AS (SELECT vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id, label),
g AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS h FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM g) AS codebooks_sha256 FROM t
"""

#: Levels of the SQL's trees: enough for 8 ** 8 rows a language and 8 ** 3 languages.
_LEVELS, _TOPS = 8, 3


def _op12_sql() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(unicode(c)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"

    def tree(name: str, levels: int) -> str:
        up = "{n}{j} AS MATERIALIZED (SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h, (any_value(n) + 7) // 8 AS n FROM {n}{i} GROUP BY g, pos // 8)"
        return ", ".join(up.format(n=name, i=i, j=i + 1) for i in range(levels))

    def climb(start: str, name: str, levels: int, out: str) -> str:
        parts, last = [], start
        for i in range(levels):
            parts.append(f"""{out}{i} AS MATERIALIZED (SELECT p.rid, p.g, p.pos // 8 AS pos,
  p.proof || coalesce(string_agg(q.h, '' ORDER BY q.pos) FILTER (q.pos <> p.pos), '') AS proof,
  CASE WHEN any_value(q.n) = 1 THEN p.cur ELSE sha256(string_agg(CASE WHEN q.pos = p.pos THEN p.cur ELSE q.h END, '' ORDER BY q.pos)) END AS cur
  FROM {last} p JOIN {name}{i} q ON q.g = p.g AND q.pos // 8 = p.pos // 8 GROUP BY p.rid, p.g, p.pos, p.proof, p.cur)""")
            last = f"{out}{i}"
        return ", ".join(parts)

    return f"""
WITH d AS (SELECT doc_id, coalesce('v' || lang, 'n') AS g, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(FOLDED)} END AS changed FROM documents),
r AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
l0 AS (SELECT g, pos, leaf AS h, n FROM r), {tree('l', _LEVELS)},
t0 AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS n, g AS lang FROM l{_LEVELS}), {tree('t', _TOPS)},
c AS (SELECT rid, g, pos, '' AS proof, coalesce(changed, leaf) AS cur FROM r), {climb('c', 'l', _LEVELS, 'u')},
e AS (SELECT u.rid, '' AS g, t0.pos, u.proof, u.cur FROM u{_LEVELS - 1} u JOIN t0 ON t0.lang = u.g), {climb('e', 't', _TOPS, 'w')}
SELECT r.doc_id, r.leaf, t0.h AS subroot, z.h AS root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root, w.cur = z.h AS verified
FROM r JOIN w{_TOPS - 1} w USING (rid) JOIN t0 ON t0.lang = r.g JOIN t{_TOPS} z ON true
"""


OP12_SQL = _op12_sql()

# the sources in order of their cap for a weight: those before the first that isn't above its part are held at it
OP13_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             ('0x' || substr(sha256('mixture:' || coalesce(doc_id::VARCHAR, 'text:' || text, 'none')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, coalesce(sum(2 * n) OVER (ORDER BY n::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(w) OVER (ORDER BY n::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(n) OVER () AS total FROM s),
f AS (SELECT held, free, total FROM o WHERE 2 * n * 2 * free >= (3 * total - 2 * held) * w ORDER BY held, free DESC LIMIT 1),
t AS (SELECT s.source, s.n, least(2.0::DOUBLE * s.n, ((3 * f.total - 2 * f.held) / 2.0::DOUBLE) * s.w / f.free::DOUBLE) AS target FROM s LEFT JOIN f ON true),
q AS (SELECT *, CASE WHEN n > 0 THEN least(target / n, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT doc_id, size, n AS source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
"""

ORACLE: dict[str, str] = {"op2_warc": OP2_SQL, "op6_minhash": OP6_SQL, "op9_top_k": OP9_SQL, "op3_decontaminate": OP3_SQL, "op11_vector_codes": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_mixing": OP13_SQL}
