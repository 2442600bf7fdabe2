"""Vector codes, Merkle manifests, mixtures: against plain versions on small tables and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes, merkle, mixing, registry, shared

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=[1_000_000, 2], ids=["broadcast", "by_key"])
def join_way(request, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", request.param)


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_merkle_manifest", "op13_mixing"])
def test_equals_sql(spark, join_way, name):
    got = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(registry.ORACLE[name])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# -- vector codes -----------------------------------------------------------------------
def plain_codes(rows, rounds=2):
    """(id, label, vector) rows to {id: (code, error, label_error)} and the codebooks' text."""
    kept = [(i, lab, [math.floor(Fraction(x) * 256) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = -(-max((len(v) for *_, v in kept), default=0) // 16) * 16
    kept = [(i, lab, v + [0] * (dims - len(v))) for i, lab, v in kept]
    w = dims // 16
    cut = lambda v, p: v[p * w:(p + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:64]
    books = [[cut(v, p) for *_, v in first] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((far(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        of = [defaultdict(list) for _ in books]
        for *_, v in kept:
            for p in range(16):
                of[p][near(v, p)[1]].append(cut(v, p))
        books = [[[sum(x) // len(x) for x in zip(*of[p][e], strict=True)] if of[p][e] else c for e, c in enumerate(book)] for p, book in enumerate(books)]
    found = [(i, lab, [near(v, p) for p in range(16)]) for i, lab, v in kept]
    total = defaultdict(int)
    for _, lab, n in found:
        total[lab] += min(sum(d for d, _ in n), codes.MOST)
    out = [(i, "".join(f"{e:02x}" for _, e in n), min(sum(d for d, _ in n), codes.MOST), min(total[lab], codes.MOST)) for i, lab, n in found]
    return out, ",".join(str(c) for book in books for e in book for c in e)


def check_codes(spark, rows, kind="double"):
    df = spark.createDataFrame([(i, lab, v, "x", b"y") for i, lab, v in rows], f"vec_id long, label int, embedding array<{kind}>, code string, v binary")
    out = codes.compress(df).collect()
    want, text = plain_codes(rows)
    assert sorted((str(tuple(r)[:4]) for r in out)) == sorted(str(r) for r in want)
    assert {r["codebooks_sha256"] for r in out} <= {hashlib.sha256(text.encode()).hexdigest()}
    return out


@pytest.mark.parametrize("dims", [16, 48, 21, 3])
def test_codes_equal_plain(spark, join_way, dims):
    rng = random.Random(dims)
    rows = [(rng.randrange(400), rng.choice([None, 1, 2, 3]), [rng.choice([0.0, 0.25, -0.25, rng.uniform(-2, 2)]) for _ in range(dims)]) for _ in range(300)]
    rows += [rows[0]] * 5 + [(None, 7, [0.5] * dims), (500, None, None), (501, 1, [None] + [0.0] * (dims - 1)), (502, 1, [float("nan")] * dims), (503, 1, [float("inf")] + [1.0] * (dims - 1)), (504, 1, [1.0]), (505, 1, [])]
    assert len(check_codes(spark, rows)) == 308


def test_codes_of_few_equal_and_no_rows(spark):
    check_codes(spark, [(1, None, [-0.001] * 16), (2, None, [0.001] * 16)])
    check_codes(spark, [(i, 1, [1.0] * 16) for i in range(200)])
    check_codes(spark, [(1, 1, []), (2, 1, [])])
    assert check_codes(spark, []) == []


@pytest.mark.parametrize("large", [1e6, 1e9, 1e17, 1e30, 1.7e308])
@pytest.mark.parametrize("first", [True, False])
def test_codes_take_every_finite_vector(spark, large, first):
    rng = random.Random(5)
    rows = [(10 + i, i % 2, [rng.uniform(-1, 1) for _ in range(32)]) for i in range(150)]
    rows.append((1 if first else 900, 0, [large, -large] + [0.5] * 30))
    assert len(check_codes(spark, rows)) == 151


def test_nearest_drops_and_ties():
    rng = np.random.default_rng(3)
    for width in (1, 2, 5):
        x, book = rng.integers(-6, 6, (500, width)), rng.integers(-6, 6, (64, width))
        far = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        for a, b in ((x, book), (x.astype(object), book), (x, book.astype(object))):
            index, best = codes.nearest(a, b)
            assert (index == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


# -- Merkle manifest --------------------------------------------------------------------
H = lambda s: hashlib.sha256(s.encode()).hexdigest()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, pos int, n int, g string, leaf string, tampered string, proof int"


def plain_leaf(*values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """The root, and the siblings of each leaf by level."""
    proofs, place, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, at in enumerate(place):
            run = at // 8 * 8
            proofs[i].append((at - run, "".join(nodes[run:at] + nodes[at + 1:run + 8])))
        nodes, place = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)], [p // 8 for p in place]
    return nodes[0], proofs


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof digest, folded root)."""
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    own = {}
    for lang, some in by.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r[0], r[3], r[2], r[4], r[1])))
        own[lang] = plain_tree([plain_leaf(r[0], r[3], r[2], r[4], r[1]) for r in some])
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    root, over = plain_tree([own[x][0] for x in langs])
    out = []
    for x, upper in zip(langs, over, strict=True):
        for r, proof in zip(by[x], own[x][1], strict=True):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            digest = plain_leaf(r[0], r[3], r[2], r[4], text)
            for slot, others in proof + upper:
                digest = H(others[:64 * slot] + digest + others[64 * slot:])
            out.append((str(r[0]), plain_leaf(r[0], r[3], r[2], r[4], r[1]), own[x][0], root, H("".join(o for _, o in proof + upper)), digest, digest == root))
    return sorted(out)


def query12(spark, rows, monkeypatch):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", "z", "t", 3) for r in rows], DOCS)
    monkeypatch.setattr(registry, "table", lambda *_: df)
    return sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in registry.op12_merkle_manifest(spark, "").collect())


def some_docs(n, langs, seed=1):
    rng = random.Random(seed)
    return [(rng.randrange(3 * n), "".join(rng.choice("AbC é\n:-") for _ in range(rng.randrange(12))), rng.choice(langs), rng.choice(["s", "", None]), rng.randrange(9)) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 73, 700])
def test_manifest_equals_plain(spark, join_way, monkeypatch, n):
    rows = some_docs(n, ["en", "en", "en", None, "", "é", "z"])
    assert query12(spark, rows, monkeypatch) == plain_manifest(rows)


def test_manifest_of_many_groups_and_tiers(spark, monkeypatch):
    # blocks of 64 nodes: the hot group takes three tiers, the groups two
    whole = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda docs, claimed: whole(docs, claimed=claimed, levels=2))
    rows = some_docs(4_200, ["hot"]) + some_docs(130, [f"l{i}" for i in range(90)], 2) + some_docs(65, ["m"], 3)
    assert query12(spark, rows, monkeypatch) == plain_manifest(rows)


def test_manifest_edges(spark, monkeypatch):
    assert query12(spark, [], monkeypatch) == []
    hit = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 3 == 0)
    rows = [(None, None, None, None, None)] * 3 + [(None, "", "", "", 0), (hit, "ABC" * 100_000, "en", "s", 1), (hit, "ABC", "en", "s", 1), (-7, "É", "en", "s", None)] + [(6, "same", "en", "s", 1)] * 20
    got, want = query12(spark, rows, monkeypatch), plain_manifest(rows)
    assert got == want and any(not r[-1] for r in got)


def test_proof_tells_a_changed_leaf(spark):
    rows = some_docs(200, ["en", "fr"])
    out = merkle.manifest(spark.createDataFrame(rows, ", ".join(DOCS.split(", ")[:5])), proofs=True)
    folded = out.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"), (merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).alias("bad"))
    assert [tuple(r) for r in folded.distinct().collect()] == [(True, False)]
    told = out.select((F.sha2(F.concat_ws("", F.col("proof.others")), 256) == F.col("proof_sha256")).alias("p"), (F.col("folded_root") == F.col("root")).alias("f"))
    assert [tuple(r) for r in told.distinct().collect()] == [(True, True)]


# -- mixtures ---------------------------------------------------------------------------
def plain_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {}
    left, free = share * sum(sizes.values()), set(names)
    while free:
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if part[s] > most * sizes[s]]
        if not above:
            return target | part
        for s in above:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
            free.discard(s)
    return target


MIXED = "doc_id long, text string, source string, size int, rate double, copy int, _source string"


@pytest.mark.parametrize("weights,share,most", [((3, 1, 2), 1.5, 2), ((1,), 0.3, 2), ((5, 1), 2.5, 3), ((1, 9), 3.0, 2)])
def test_mixture_equals_plain(spark, join_way, weights, share, most):
    rng = random.Random(len(weights))
    names = [None, "", "a", "B", "é", "z", "𝒳", "ｚ", "empty"]
    rows = [(i, " \t\n\x0b".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(30))) + " ", "a" if i % 3 else rng.choice(names[:-1])) for i in range(900)]
    rows += [(1_000 + i, t, "empty") for i, t in enumerate([None, "", " \r\n\x0c "])] + [(None, "x y", "B"), (None, None, "B"), (7, "x    y", "B"), (7, "again " * 5_000, "B")]
    df = spark.createDataFrame([(*r, 1, 0.5, 2, "x") for r in rows], MIXED)
    how = {"weights": weights, "share": share, "most": most}
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = plain_targets(sizes, weights, Fraction(share), most)

    def number(i, t):
        named = str(i) if i is not None else "text:" + t if t is not None else "none"
        return int(hashlib.sha256(f"mixture:{named}".encode()).hexdigest()[:13], 16) / 16**13

    def copies(i, t, s):
        rate = min(float(want[s]) / sizes[s], most) if sizes[s] else 0
        return math.floor(rate) + (number(i, t) < rate - math.floor(rate))

    out = mixing.taken(df, **how).collect()
    expected = sorted((str(i), size(t), sizes[s], copies(i, t, s)) for i, t, s in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"], r["copies"]) for r in out) == expected
    assert sorted(round(r["target"], 6) for r in out) == sorted(round(float(want[s]), 6) for _, _, s in rows)
    mixed = mixing.mixture(df, **how)
    assert mixed.columns == [c for c in df.columns if c != "copy"] + ["copy"]
    assert sorted((str(r["doc_id"]), str(r["text"]), str(r["source"]), r["size"], r["copy"]) for r in mixed.collect()) == sorted((str(i), str(t), str(s), 1, c + 1) for i, t, s in rows for c in range(copies(i, t, s)))


def test_mixture_comes_near_its_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 17), f"s{i % 5}" if i % 3 else "hot") for i in range(6_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.taken(df).withColumn("source_size", F.col("source_size"))
    sums = out.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("got"), F.max("copies").alias("most")).collect()
    assert all(abs(r["got"] - r["target"]) < 0.06 * r["target"] and r["most"] <= 2 for r in sums)
    again = mixing.taken(df.repartition(7))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_mixture_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken(df).collect() == [] and mixing.mixture(df).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["copies"]) for r in mixing.taken(blank).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_places_of_hot_and_equal_rows(spark, join_way):
    df = spark.createDataFrame([("a", None)] * 3 + [("a", i % 7) for i in range(500)] + [(None, 1), ("b", 2), ("b", 1)], "g string, x int")
    out = shared.placed(df.repartition(5), "g", ["x"]).collect()
    for g, n in (("a", 503), ("b", 2), (None, 1)):
        some = sorted((r for r in out if r["g"] == g), key=lambda r: r["pos"])
        assert [r["pos"] for r in some] == list(range(n)) and {r["n"] for r in some} == {n}
        assert [r["x"] for r in some] == sorted((r["x"] for r in some), key=lambda x: (x is not None, x))
