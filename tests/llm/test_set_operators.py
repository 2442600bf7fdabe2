"""URL rules, WARC, MinHash, lines, top-k, personal data: against brute force."""

import base64
import gzip
import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, lines, minhash, pii, shared, topk, url_rules, warc

DOCS = "doc_id long, text string, digest string, _salt int, rep long, print int"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 7, 3) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(params=[100_000, 2], ids=["broadcast", "by_key"])
def join_way(request, monkeypatch):
    """Both ways of joining to a small side."""
    monkeypatch.setattr(shared, "BROADCAST_ROWS", request.param)
    monkeypatch.setattr(shared, "HOT_KEYS", min(request.param, 10_000))


@pytest.mark.parametrize(("rows", "size", "keys_split"), [(100, 1 << 20, 3), (3, 1 << 20, 3), (100, 50, 100), (0, 0, 1)])
def test_join_on_hot_key(spark, monkeypatch, rows, size, keys_split):
    for name, value in (("BROADCAST_ROWS", rows), ("BROADCAST_BYTES", size), ("HOT_KEYS", keys_split)):
        monkeypatch.setattr(shared, name, value)
    keys = ["hot"] * 500 + ["b"] * 3 + ["c", "absent", None]
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long")
    small = spark.createDataFrame([("hot", 500, 1, None), ("b", 3, 2, "x"), ("c", 1, 3, "y"), ("d", 0, 4, "z"), ("e", 0, 5, "z")], "k string, n long, v int, w string")
    out = shared.join_on_hot_key(big, small, "k", "n", F.col("i"))
    assert out.columns == ["k", "i", "v", "w"]
    want = {"hot": (1, None), "b": (2, "x"), "c": (3, "y")}
    assert sorted(map(str, out.collect())) == sorted(f"Row(k={k!r}, i={i}, v={want.get(k, (None, None))[0]}, w={want.get(k, (None, None))[1]!r})" for i, k in enumerate(keys))


# -- url rules --------------------------------------------------------------------------
def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def test_url_parts_and_given_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "http://a.com", "http://a.com?x=1", "http://a.com/x", "http://example.com/en/1", "http://www.Example.com/en/1", "http://b.www.example.com/en/", "http://xexample.com/en/", "http://a.net/es/", "http://a.net/es", "http://a.net/fr/x#y", "http://net/fr/", "ftp://a.org/fr/://b", "http://a.com/EN/?q#f", "http://É.com/en/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in url_rules.judge(pages, none).collect()}
    assert len(out) == len(urls)
    for i, u in enumerate(urls):
        host, path = brute_parts(u)
        fits = [(len(h + p), h + p, a) for a, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == (host, path, rule, verdict), u


def python_tokens(url):
    """Tokens as the operator's docstring has them."""
    host, path = brute_parts(url)
    rest = url.split("://", 1)[1]
    parts = [p for p in host.split(".") if p]
    query = re.search(r"\?([^#]*)", rest)
    names = [x.split("=")[0] for x in query[1].split("&")] if query else []
    out = [f"h:{p}" for p in parts] + (["d:" + ".".join(parts[-3:])] if len(parts) >= 3 else [])
    out += ["p:" + ("#" if w.isdigit() else w) for w in re.split(r"[/._-]", path.lower()) if w]
    return set(out + [f"q:{n}" for n in names if n] + (["f:"] if "#" in rest else []))


def brute_rules(labelled, min_rows, confidence, lift, longest=4):
    """Token sets of all rules, by enumeration over classes of tokens that occur in the same urls."""
    from itertools import combinations
    count, bad_count = Counter(u for u, _ in labelled), Counter(u for u, bad in labelled if bad)
    urls = {u: 2 * bad_count[u] >= count[u] for u in count}
    bags = {u: python_tokens(u) for u in urls}
    base = sum(urls.values()) / len(urls)
    occurs = {}
    for t in set().union(*bags.values()):
        occurs.setdefault(frozenset(u for u in urls if t in bags[u]), set()).add(t)
    out = {}
    for n in range(1, longest + 1):
        for sets in combinations(occurs, n):
            hold = frozenset.intersection(*sets)
            bad = sum(urls[u] for u in hold)
            if bad >= min_rows and bad / len(hold) >= confidence and bad / len(hold) >= lift * base:
                out[frozenset(sets)] = (frozenset().union(*(occurs[s] for s in sets)), bad / len(hold))
    return [tokens for of, (tokens, c) in out.items() if not any(p < of and out[p][1] >= c for p in out)]


def test_mined_rules_against_brute_force(spark, join_way):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        host = rng.choice(["spam.org", "good.org", "mixed.org", "a.shop.net"])
        section = rng.choice(["win", "news", "win/now"])
        bad = host == "spam.org" and rng.random() < 0.95 or host == "mixed.org" and "win" in section or host == "a.shop.net" and section == "win/now" and rng.random() < 0.8
        rows.append((i, f"http://{host}/{section}/{rng.randint(0, 99)}{rng.choice(['', '?id=1', '#top'])}", bad))
    more = ["http://x.spam.org/else", "http://mixed.org/win/7", "http://mixed.org/news/7", "http://other.org/win/7", "http://b.shop.net/win/now/1"]
    pages = spark.createDataFrame([r[:2] for r in rows] + [(1000 + i, u) for i, u in enumerate(more)], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in url_rules.judge(pages, labels, rules=(), min_rows=10, min_confidence=0.7).collect()}
    rules = brute_rules([(u, bad) for _, u, bad in rows], 10, 0.7, 1.5)
    assert len(rules) >= 3 and any(len(r) > 1 for r in rules)
    for i, url in [r[:2] for r in rows] + [(1000 + i, u) for i, u in enumerate(more)]:
        held = [r for r in rules if r <= python_tokens(url)]
        assert (out[i]["verdict"] == "block") == bool(held), url
        assert out[i]["mined"] is None if not held else set(out[i]["mined"]) in held


@pytest.mark.parametrize("further", [2, 9, 14])
def test_rules_of_two_tokens_survive_any_width(spark, further):
    """Bad if and only if two words agree, beside words that tell nothing."""
    rng, rows = random.Random(3), []
    for i in range(800):
        a = rng.randrange(8)
        b = a if i < 400 else rng.choice([x for x in range(8) if x != a])
        rows.append((i, f"http://site{i}.org/a{a}/b{b}/" + "/".join(f"w{k}x{rng.randrange(2)}" for k in range(further)), i < 400))
    rng.shuffle(rows)
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in url_rules.judge(pages, labels, rules=(), min_rows=20, min_confidence=0.95).collect()}
    assert sum(out[i]["verdict"] == "block" for i in range(400)) == 400
    assert all(out[i]["verdict"] == "allow" for i in range(400, 800))


def test_wide_urls_against_brute_force(spark):
    rng, rows = random.Random(8), []
    for i in range(400):
        words = [f"k{k}v{rng.randrange(2)}" for k in range(11)]
        bad = words[2] == "k2v1" and words[7] == "k7v0" and rng.random() < 0.97 or words[0] == "k0v1" and words[4] == "k4v1" and words[9] == "k9v1"
        rows.append((i, "http://h.org/" + "/".join(words), bad))
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in url_rules.judge(pages, labels, rules=(), min_rows=20, min_confidence=0.9).collect()}
    rules = brute_rules([(u, bad) for _, u, bad in rows], 20, 0.9, 1.5, 3)
    assert any(len(r) == 3 for r in rules)
    for i, url, _ in rows:
        held = [r for r in rules if r <= python_tokens(url)]
        assert not held or out[i]["verdict"] == "block", url


@pytest.mark.parametrize("agree", [3, 4])
def test_rules_of_three_and_four_tokens_survive_any_width(spark, agree):
    """Bad if and only if some words' numbers add up to an even one, beside twelve words that deviate more than these."""
    rng, rows = random.Random(5), []
    for i in range(800):
        bad = i < 400
        telling = [(i >> k) & 1 for k in range(agree - 1)]
        telling.append((sum(telling) + (not bad)) % 2)
        words = [f"t{k}x{v}" for k, v in enumerate(telling)] + [f"w{k}x{int(rng.random() < (0.6 if bad else 0.45))}" for k in range(12)]
        rows.append((i, f"http://site{i}.org/" + "/".join(words), bad))
    rng.shuffle(rows)
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not bad), 0) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r for r in url_rules.judge(pages, labels, rules=(), min_rows=20, min_confidence=0.95).collect()}
    assert sum(out[i]["verdict"] == "block" for i in range(400)) == 400
    assert all(out[i]["verdict"] == "allow" for i in range(400, 800))


def test_long_and_repeated_urls_are_bounded(spark):
    """Copies of a url with forty tokens, and forty urls that each differ in one of them."""
    words = [f"word{k}" for k in range(40)]
    urls = ["http://a.b.org/" + "/".join(words)] * 30 + ["http://a.b.org/" + "/".join([*words[:k], f"other{k}", *words[k + 1:]]) for k in range(40)]
    urls += [f"http://good.org/{k}" for k in range(100)] + [f"http://c.org/{w}/v{k}" for w in words for k in range(40)]
    rows = [(i, u) for i, u in enumerate(urls)]
    labels = spark.createDataFrame([(i, int(i >= 70), 0) for i in range(len(urls))], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"), labels, rules=(), min_rows=10).collect()}
    assert all(out[i] == ("block" if i < 70 else "allow") for i in range(len(urls)))


def test_url_rules_empty_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(none, spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")).count() == 0


# -- warc -------------------------------------------------------------------------------
def test_warc_against_brute_force(spark, join_way):
    big, small = "<p>" + "ä" * 100, "<p>short"
    html = [big, None, small, big, small, "", big + "x", "y" * 99, "y" * 99, "z" * 100, "z" * 100]
    pages = spark.createDataFrame([(10 - i, f"http://a/{i}\n?é", h, "d") for i, h in enumerate(html)] + [(10, "u", big, "d"), (None, None, big, None)], "page_id long, url string, html string, digest string")
    out = sorted(map(tuple, warc.read(warc.write(pages)).collect()), key=str)
    want = []
    payloads = [(10 - i, (h or "").encode()) for i, h in enumerate(html)] + [(10, big.encode()), (None, big.encode())]
    for page, p in payloads:
        same = [q for q, x in payloads if x == p and q is not None]
        first = min(same) if len(p) >= 100 and sum(x == p for _, x in payloads) > 1 else page
        want.append((page, len(p), hashlib.sha256(p).hexdigest(), "response" if first == page else "revisit", None if first == page else first))
    assert out == sorted(want, key=str)


def test_warc_empty(spark):
    assert warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


@pytest.mark.parametrize("records", [0, 1, 70_000])
def test_zip_directory(records):
    """Central directory, with ZIP64 records once there are more members than 16 bits count."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(records):
            z.writestr(f"m{i}", b"")
        z.writestr(warc.INDEX, b"last")
    members = warc.directory(out, len(out.getvalue()))
    assert len(members) == records + 1
    at, n = warc.stored_at(out, members[warc.INDEX])
    assert out.getvalue()[at:at + n] == b"last"


def test_zip64_extra_field_and_compressed_member():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open(warc.ARCHIVE, "w", force_zip64=True) as f:
            f.write(b"x" * 10)
        z.writestr("packed", b"y" * 1000, zipfile.ZIP_DEFLATED)
    members = warc.directory(out, len(out.getvalue()))
    assert warc.stored_at(out, members[warc.ARCHIVE])[1] == 10
    with pytest.raises(ValueError, match="stored"):
        warc.stored_at(out, members["packed"])
    with pytest.raises(ValueError, match="central"):
        warc.directory(io.BytesIO(b"nothing"), 7)


def test_package_range_reads(monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 300)
    out, payloads = io.BytesIO(), [b"a" * n for n in (0, 10, 5000, 3)]
    package = warc.Package(out)
    for i, p in enumerate(payloads):
        package.add(i, "u", p, hashlib.sha256(p).hexdigest(), None)
    package.close()
    assert [warc.parts_of(*x[1:])[1] for x in warc.read_package(out, len(out.getvalue()))] == payloads
    with pytest.raises(ValueError, match="WARC"):
        list(warc.records_of(iter([b"not a record\r\n\r\n"])))


def foreign(kind, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", *[f"{k.replace('_', '-')}: {v}" for k, v in headers.items()], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def foreign_records(payload):
    """A warcinfo record, responses with digests in base 32, by another algorithm and none, a bare revisit."""
    http = "application/http; msgtype=response"
    b32 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return [
        foreign("warcinfo", b"software: x\r\n\r\nmore"), foreign("response", warc.HTTP + payload, Content_Type=http, WARC_Payload_Digest=f"sha1:{b32}"),
        foreign("response", warc.HTTP + payload, Content_Type=http, WARC_Payload_Digest=f"md5:{hashlib.md5(payload).hexdigest()}"), foreign("response", warc.HTTP + payload, Content_Type=http, WARC_Payload_Digest="own:x"),
        foreign("resource", payload), foreign("revisit", warc.HTTP, Content_Type=http, WARC_Payload_Digest=f"sha1:{b32}", WARC_Refers_To="<urn:uuid:1>"), foreign("response", warc.HTTP + payload[:3], Content_Type=http, WARC_Payload_Digest=f"sha1:{b32}", WARC_Truncated="length"),
    ]


def zipped(members, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, raw in members.items():
            z.writestr(name, raw, method if "index" in name else zipfile.ZIP_STORED)
    return out, len(out.getvalue())


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
@pytest.mark.parametrize("packed", ["plain", "a_member_each", "one_member", "two_a_member"])
def test_archives_without_index(monkeypatch, step, packed):
    monkeypatch.setattr(warc, "STEP", step)
    records = foreign_records(b"a\r\n\r\nb" * 30)
    raw = {"plain": b"".join(records), "a_member_each": b"".join(map(gzip.compress, records)), "one_member": gzip.compress(b"".join(records)), "two_a_member": b"".join(gzip.compress(b"".join(records[k:k + 2])) for k in range(0, len(records), 2))}[packed]
    name = "archive/x.warc" + ("" if packed == "plain" else ".gz")
    got = [(h["warc-type"], block) for _, h, block in warc.read_package(*zipped({name: raw, "other.txt": b"x"}))]
    assert got == [(r.split(b"\r\n")[1].split()[1].decode(), r.partition(b"\r\n\r\n")[2][:-4]) for r in records]
    for cut in {len(raw) - 5, len(raw) // 2, len(raw) // 3, 12} - {0}:
        with pytest.raises(ValueError, match="cut off"):
            list(warc.read_package(*zipped({name: raw[:cut]})))
    assert list(warc.read_package(*zipped({name: b""}))) == []


@pytest.mark.parametrize("named", [[], [0], [2, 4], [6], [0, 1, 2, 3, 4, 5, 6], [1, 1, 3]])
@pytest.mark.parametrize("index", ["index.cdxj", "index.cdx.gz", "deflated.index.cdxj"])
def test_what_no_index_names_is_read(named, index):
    records = list(map(gzip.compress, foreign_records(b"abc" * 50)))
    offsets = [sum(map(len, records[:k])) for k in range(len(records))]
    lines = "\n".join(f'- 1 {{"filename": "x.warc.gz", "offset": "{offsets[k]}", "length": "{len(records[k])}"}}' for k in named).encode()
    out, size = zipped({"a/x.warc.gz": b"".join(records), "b/y.warc.gz": records[0], index: gzip.compress(lines) if index.endswith(".gz") else lines}, zipfile.ZIP_DEFLATED if "deflated" in index else zipfile.ZIP_STORED)
    got = list(warc.read_package(out, size))
    assert [h["warc-type"] for _, h, _ in got] == ["warcinfo", "response", "response", "response", "resource", "revisit", "response", "warcinfo"]
    assert [k for k, (e, _, _) in enumerate(got) if e] == sorted(set(named))


@pytest.mark.parametrize("line", ['{"filename": "z.warc.gz", "offset": 0, "length": 5}', '{"filename": "x.warc.gz", "offset": 0, "length": 99999}', '{"filename": "x.warc.gz", "offset": 3, "length": 9}', '{"offset": 0, "length": 5}'])
def test_indexes_that_are_wrong(line):
    raw = b"".join(map(gzip.compress, foreign_records(b"abc")))
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_package(*zipped({"a/x.warc.gz": raw, "b/y.warc.gz": raw, "index.cdxj": b"- 1 " + line.encode()})))


def test_foreign_records_as_rows(spark, tmp_path):
    payload = b"q" * 120
    out, size = zipped({"archive/x.warc.gz": b"".join(map(gzip.compress, foreign_records(payload)))})
    (tmp_path / "x.wacz").write_bytes(out.getvalue())
    manifest = lambda n: spark.createDataFrame([(f"file://{tmp_path}/{n}", size, 7)], "path string, bytes long, records long")
    rows = warc.read(manifest("x.wacz")).collect()
    sha = hashlib.sha256(payload).hexdigest()
    info = b"software: x\r\n\r\nmore"
    assert [(r["record_type"], r["payload_bytes"]) for r in rows] == [("warcinfo", len(info)), ("response", 120), ("response", 120), ("response", 120), ("resource", 120), ("revisit", None), ("response", 3)]
    assert [r["payload_digest"] for r in rows][1:5] == [sha] * 4 and rows[5]["payload_digest"].startswith("sha1:") and not any(r["page_id"] or r["refers_to"] for r in rows)
    wrong = foreign("response", warc.HTTP + b"r" * 120, Content_Type="application/http", WARC_Payload_Digest=f"sha256:{sha}")
    out, size = zipped({"archive/x.warc": wrong})
    (tmp_path / "bad.wacz").write_bytes(out.getvalue())
    with pytest.raises(Exception, match="doesn't fit its digest"):
        warc.read(manifest("bad.wacz")).collect()


# -- near-duplicates --------------------------------------------------------------------
def brute_components(texts, width, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        before = list(label)
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    return [len(s) for s in sets], label


def near_copies(rng, n, edits):
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, width, percent):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 7)  # so that clusters take several blocks
    rng = random.Random(8)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d", "A B C D", *near_copies(rng, 60, 7), *near_copies(rng, 10, 2), *[" ".join(f"u{rng.randint(0, 99)}" for _ in range(30)) for _ in range(30)], "same " * 4000, "same " * 4000]
    sizes, label = brute_components(texts, width, percent)
    out = {r["doc_id"]: r for r in minhash.near_duplicates(docs(spark, texts), width, percent).collect()}
    assert len(out) == len(texts)
    for i in range(len(texts)):
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (sizes[i], label[i], label[i] == i), i


def test_near_duplicates_ways_and_edges(spark, join_way):
    texts = ["a b c d e f"] * 5 + [None, "z"]
    frame = docs(spark, texts).union(docs(spark, texts).limit(1)).union(spark.createDataFrame([(None, "a b c d e f", "x", 1, 7, 3)], DOCS))
    rows = minhash.near_duplicates(frame, 5, 80).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == sorted([("0", "0", True)] * 2 + [(str(i), "0", False) for i in range(1, 5)] + [("5", "5", True), ("6", "6", True), ("None", "None", True)])
    assert {r["doc_id"] for r in minhash.kept_documents(frame).collect()} == {0, 5, 6, None}
    assert minhash.near_duplicates(frame.limit(0)).count() == 0


def test_word_hashes_by_pieces(monkeypatch):
    t = "alpha βeta  gamma\tdelta " * 50 + "q" * 400
    whole = minhash.word_hashes(t)
    monkeypatch.setattr(minhash, "PIECE", 16)
    assert (minhash.word_hashes(t) == whole).all() and len(whole) == len(t.split())


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(500, i) for i in range(1, 60)]
    out = dict(map(tuple, components.components(spark.createDataFrame(chain + star, "a long, b long")).collect()))
    assert {out[i] for i in range(100, 181)} == {100} and {out[i] for i in [500, *range(1, 60)]} == {1}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_with_split_nodes(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(shared, "HOT_KEYS", 2)
    edges = [(500, i) for i in range(1, 30)] + [(501, 502), (502, 503)]
    out = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {out[i] for i in [500, *range(1, 30)]} == {1} and {out[i] for i in (501, 502, 503)} == {501}


# -- lines ------------------------------------------------------------------------------
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, line, most):
    out = list(line)
    for _ in range(rng.randint(0, most)):
        k, kind = rng.randrange(len(out) + 1), rng.randrange(3)
        if kind == 0 and k < len(out):
            out[k] = rng.choice("abxé")
        elif kind == 1:
            out.insert(k, rng.choice("ab z"))
        elif k < len(out):
            del out[k]
    return "".join(out)


def test_edit_check_and_candidates():
    rng = random.Random(1)
    for _ in range(3000):
        a = "".join(rng.choice("abé c") for _ in range(rng.randint(24, 34)))
        b = changed(rng, a, 4)
        d = edit_distance(a, b)
        assert lines.within(a, b, 2) == (d <= 2)
        if d <= 2 and a != b and len(b) >= 24:
            assert found_by_slots(a, b)


def found_by_slots(a, b):
    (pa_, pb_), own, probes = lines.features([a, b], 2)
    (oa, ob), (sa, sb) = map(set, (x.tolist() for x in own)), map(set, (x.tolist() for x in probes))
    return bin((int(pa_) ^ int(pb_)) & (2**64 - 1)).count("1") <= 8 and bool(oa & ob or oa & sb or ob & sa)


def test_short_lines_allow_fewer_edits():
    rng = random.Random(4)
    assert [int(lines.allowed(n)) for n in (0, 11, 12, 23, 24, 999)] == [0, 0, 1, 1, 2, 2]
    for _ in range(2000):
        a = "".join(rng.choice("abé c") for _ in range(rng.randint(10, 26)))
        b = changed(rng, a, 2)
        if a != b and edit_distance(a, b) <= lines.allowed(min(len(a), len(b))):
            assert found_by_slots(a, b), (a, b)


def brute_lines(texts):
    first = {}
    for d, t in enumerate(texts):
        for k, x in enumerate((t or "").split("\n")):
            if x.strip():
                first.setdefault(x, (d, k))
    held = list(first)
    pairs = [(a, b) for i, a in enumerate(held) for b in held[:i] if abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= min(2, min(len(a), len(b)) // 12)]
    degree = Counter(x for p in pairs for x in p)
    repeats = {max(p, key=first.get) for p in pairs}
    out = {}
    for d, t in enumerate(texts):
        n = equal = near = links = 0
        gone = []
        for k, x in enumerate((t or "").split("\n")):
            if x.strip():
                own = first[x] == (d, k)
                n, equal, near, links = n + 1, equal + (not own), near + (own and x in repeats), links + degree[x]
                gone += [k] if not own or x in repeats else []
        out[d] = (n, equal, near, links, gone)
    return out


def brute_classes(texts):
    """(document, line number) -> first place of the line's class, for lines that repeat or are linked."""
    places = {(d, k): x for d, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if x.strip()}
    held = sorted(set(places.values()))
    name = {x: min(p for p, y in places.items() if y == x) for x in held}
    pairs = [(a, b) for i, a in enumerate(held) for b in held[:i] if abs(len(a) - len(b)) <= 2 and edit_distance(a, b) <= min(2, min(len(a), len(b)) // 12)]
    for _ in held:
        for a, b in pairs:
            name[a] = name[b] = min(name[a], name[b])
    linked = {x for p in pairs for x in p}
    often = Counter(places.values())
    return {p: name[x] for p, x in places.items() if often[x] > 1 or x in linked}


@pytest.mark.parametrize(("rows", "hot", "block"), [(100_000, 1024, 16_384), (2, 3, 4)])
def test_lines_against_brute_force(spark, monkeypatch, rows, hot, block):
    for module, name, value in ((shared, "BROADCAST_ROWS", rows), (lines, "HOT", hot), (lines, "BLOCK", block)):
        monkeypatch.setattr(module, name, value)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcd e") for _ in range(rng.randint(8, 60))) for _ in range(14)]
    texts = [None, "", "\n\n", "short\nshort", *["\n".join(changed(rng, rng.choice(base), 3) for _ in range(rng.randint(1, 5))) for _ in range(60)], "\n".join(base), "x" * 200_000 + "\nlast line is of its own kind"]
    want = brute_lines(texts)
    out = {r["doc_id"]: r for r in lines.summary(docs(spark, texts)).collect()}
    assert len(out) == len(texts)
    for i in range(len(texts)):
        assert tuple(out[i])[1:6] == want[i], i
    classes = {(i, c["line_no"]): (c["class_doc_id"], c["class_line_no"]) for i, r in out.items() for c in r["classes"]}
    assert classes == brute_classes(texts)
    assert all(r["class_docs"] == sorted({c["class_doc_id"] for c in r["classes"]}) for r in out.values())
    left = {r["doc_id"]: r["text"] for r in lines.without_repeats(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        n, equal, near, _, gone = want[i]
        if n and len(gone) == n:
            assert i not in left
        else:
            assert left[i] == (t if t is None or not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))


def test_lines_edges(spark):
    frame = docs(spark, ["only line here, the same twice"]).union(docs(spark, ["only line here, the same twice"])).union(spark.createDataFrame([(None, "a\na", "x", 1, 7, 3)], DOCS))
    assert sorted(str(r["doc_id"]) for r in lines.without_repeats(frame).collect()) == ["0", "0", "None"]
    assert lines.without_repeats(frame).columns == frame.columns
    assert lines.summary(frame.limit(0)).count() == 0
    other = docs(spark, ["one line of its own, nearly", "one line of its own, nearly!\nsecond"]).union(docs(spark, ["\n\nanother text of the same number", "x"]))
    assert lines.summary(other).count() == 4


def test_a_hot_template_of_lines(spark):
    """Thousands of lines that share their segments: blocks of one slot, no task with all pairs."""
    texts = ["\n".join(f"Notice number {7919 * (i * 50 + k) % 10**9:09d} of the register, all rights reserved." for k in range(50)) for i in range(80)]
    out = lines.summary(docs(spark, texts))
    everything = [x for t in texts for x in t.split("\n")]
    codes = np.array([[int(c) for c in x[14:23]] for x in everything], dtype=np.int8)
    near = sum(int(((codes[i] != codes).sum(axis=1) <= 2).sum()) - 1 for i in range(len(codes)))
    rows = out.collect()
    assert sum(r["n_lines"] for r in rows) == 4000 and sum(r["n_links"] for r in rows) >= near


# -- top-k ------------------------------------------------------------------------------
def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "KEEP", 8)
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.2, (700, 12)).astype(np.float32)
    vectors[::7] = vectors[0]  # ties
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1, 2), (1001, [0.1, None], 1, 2), (1002, [float("nan")], 1, 2), (1003, [float("inf")], 1, 2), (1050, [0.5, 0.25], 1, 2), (None, [0.5], 1, 2), (1051, [], 1, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, block int")
    out = sorted(map(tuple, topk.top_k(frame, lambda c: c % 50 == 0).collect()))
    x = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v, *_ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    pad = {i: np.pad(v, (0, 12 - len(v))) for i, v in x.items()}
    want = []
    for q in (i for i in pad if i % 50 == 0):
        scores = sorted((-int(pad[q] @ v), i) for i, v in pad.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert out == sorted(want)


@pytest.mark.parametrize("size", [1e7, 3e18])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, size / 4, (40, 3)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(95, [1e17, 3.0, 0.0]), (96, [-1e17, 0.0, 0.0]), (97, [1e30, 0.0, 0.0]), (98, [1e30, 1e30, 0.0]), (99, [-1e30, 0.0, 1.0]), (100, [2e30, 0.0, -1.0]), (101, [1.7e308, 0.0, 0.0]), (102, [float("inf"), 0.0, 0.0])]
    frame = spark.createDataFrame([*rows, rows[0]], "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(frame, lambda c: c % 50 == 0, k=12, scale=2).collect())
    whole = {i: [int(c) * 2 for c in v] for i, v in rows if i != 102}
    fit = lambda s: max(-2**63, min(2**63 - 1, s))
    want = []
    for q in (0, 100):
        copies = 2 if q != 0 else 1  # row 0 stands there twice
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q for _ in range(copies if i == 0 else 1))[:12]
        want += [(q, k, i, fit(-s)) for k, (s, i) in enumerate(scores, 1)]
    assert got == want


def test_scores_beyond_64_bits_keep_their_order():
    scores = [-10**90, -10**40 - 1, -10**40, -2**63 - 1, -2**63, 0, 2**63 - 1, 2**63, 10**40, 10**40 + 1, 10**90]
    fit = lambda s: max(-2**63, min(2**63 - 1, s))
    assert sorted(scores[::-1], key=lambda s: (fit(s), topk._beyond(s) or topk.NEAR)) == scores


def test_top_k_few_and_empty(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<float>")
    assert list(map(tuple, topk.top_k(frame, lambda c: c % 50 == 0).collect())) == [(0, 1, 1, 256 * 128)]
    assert topk.top_k(frame.limit(0), lambda c: c % 50 == 0).count() == 0


# -- personal data ----------------------------------------------------------------------
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(d))) % 10 == 0


def brute_spans(t):
    ok = {"email": lambda x: True, "ip": lambda x: all(int(p) <= 255 for p in x.split(".")), "card": lambda x: 13 <= len(d := re.sub("[^0-9]", "", x)) <= 19 and luhn(d), "phone": lambda x: 9 <= len(re.sub("[^0-9]", "", x)) <= 15}
    return {k: [m.span() for m in re.finditer(p, t) if ok[k](m[0])] for k, p in PATTERNS.items()}


def test_base_spans_against_regexes(spark):
    rng = random.Random(9)
    parts = ["a.b@c.de", "x@y", "@", ".", "..", "-", "+", "%", "é", "😀", " ", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+49", "(", ")", "12", "_", "a@b.c_d@e.f", "7" * 30]
    texts = [None, "", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)], "m@n.op " * 1500, "5" * 30_000, "a" * 60_000 + "@b.cd", "1.2.3." * 4000]
    out = {r["doc_id"]: r for r in pii.digest(pii.sanitise(docs(spark, texts))).collect()}
    for i, t in enumerate(texts):
        b = brute_spans(t or "")
        said = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in b[k])
        assert [out[i][f"n_{k}"] for k in PATTERNS] == [len(b[k]) for k in PATTERNS], (i, (t or "")[:200])
        assert out[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def brute_entities(kind, value):
    if kind == "email":
        plain = re.sub("[A-Z]", lambda m: m[0].lower(), value)
        return [f"email:{plain}", "email:@" + plain.rpartition("@")[2]]
    if kind == "ip":
        return [f"ip:{value}", "ip:" + value.rpartition(".")[0] + ".*"]
    d = re.sub("[^0-9]", "", value)
    return [f"{kind}:{d}", f"{kind}:{d[:6] if kind == 'card' else d[:-4]}*"]


def brute_told(texts):
    """(told pairs -> whole, terms told in each text, texts that hold a term)."""
    texts = {t or "" for t in texts}
    marks, holds = [], Counter()
    for t in texts:
        spans = [(k, s, e) for k, found in brute_spans(t).items() for s, e in found]
        blank = list(t)
        for _, s, e in spans:
            blank[s:e] = " " * (e - s)
        blank = "".join(blank)
        holds.update(set(re.findall(r"[^\W_]+", blank.lower())))
        for k, s, e in spans:
            first, last = max(0, s - pii.CONTEXT), min(len(t), e + pii.CONTEXT)
            before, after = blank[first:s], blank[e:last]
            before = re.sub(r"\A[^\W_]+", "", before) if first else before
            after = re.sub(r"[^\W_]+\Z", "", after) if last < len(t) else after
            near = f"{before} {after}".lower()
            marks += [(entity, t, near) for entity in brute_entities(k, t[s:e])]
    met = lambda rows: min(len({t for _, t, _ in rows}), len({n for _, _, n in rows}))
    told, per_text = {}, {}
    for entity in {m[0] for m in marks}:
        rows = [m for m in marks if m[0] == entity]
        n_e = met(rows)
        for term in {w for m in rows for w in re.findall(r"[^\W_]+", m[2])}:
            n_te = met([m for m in rows if term in re.findall(r"[^\W_]+", m[2])])
            n = n_te * (1 - 1 / (9 * n_te) - pii.QUANTILE / (3 * n_te ** 0.5)) ** 3
            carried, given = np.log2(len(texts) / n_e), lambda n, t=term, e=n_e: np.log2(len(texts) * n / (holds[t] * e))
            if n_te > 1 and carried > 0 and n > 0 and given(n) >= 0.6 * carried:
                told[entity, term] = bool(given(n_te) >= 0.99 * carried)
                for m in rows:
                    if term in re.findall(r"[^\W_]+", m[2]):
                        per_text.setdefault(m[1], set()).add(term)
    return told, per_text, holds


def told_in(texts, out):
    return [[texts[i][int(a):int(e)].lower() for k, a, e in (s.split(":") for s in out[i]["spans"].split(",") if s) if k == "term"] for i in range(len(texts))]


def test_disclosing_terms_against_counts(spark, join_way):
    """Entities of one, two and more texts, short names and numbers, copies of texts and of passages, long texts."""
    rng = random.Random(10)
    noise = lambda n=12: " ".join(f"n{min(rng.randint(0, 60), rng.randint(0, 60))}ord" for _ in range(n))
    texts = [noise() for _ in range(300)]
    texts += [f"{noise()} Zorblatt, write to Ann@x.org {k}" for k in range(4)] + [f"{noise()} zorblatt"] + ["copy bob@y.org quux"] * 9
    texts += [f"{noise()} Al 4711 calls +49 30 1234 555{k} {noise()}" for k in range(3)]  # different phones of one exchange
    texts += [f"{noise(200)} Li eve@two.org {noise(300)} far away {noise(200)} Li" for _ in range(2)] + [f"{noise()} lonely one@alone.org"]
    texts += [f"{noise(90)} {'y' * 250} same passage near dora@z.org and after it {'x' * 250}" for _ in range(5)]
    texts += [f"{noise()} Host 10.2.3.{k} rack{k % 2}" for k in range(6)] + [f"{noise()} paid 4111 1111 1111 1111 by Kim" for _ in range(3)]
    out = {r["doc_id"]: r for r in pii.digest(pii.sanitise(docs(spark, texts))).collect()}
    told, per_text, _ = brute_told(texts)
    got = told_in(texts, out)
    for t, found in zip(texts, got, strict=True):
        blank = t
        for spans in brute_spans(t).values():
            for s, e in spans:
                blank = blank[:s] + " " * (e - s) + blank[e:]
        assert found == [w for w in re.findall(r"[^\W_]+", blank.lower()) if w in per_text.get(t, ())], t
    terms = {e: {t for x, t in told if x == e} for e, _ in told}
    assert "zorblatt" in terms["email:ann@x.org"] and {"al", "4711"} <= terms["phone:49301234*"] and "kim" in terms["card:4111111111111111"] and "host" in terms["ip:10.2.3.*"]
    assert "li" in terms["email:eve@two.org"] and "far" not in terms["email:eve@two.org"]  # near, not in the same text alone
    assert not {"email:bob@y.org", "email:one@alone.org", "email:dora@z.org"} & set(terms)  # one text, one meeting, one passage


def test_planted_names_are_found_and_little_else(spark):
    """Names beside the addresses of a domain, in words of Zipf's frequencies."""
    rng = np.random.default_rng(4)
    noise = lambda n: " ".join(f"w{w}" for w in rng.zipf(1.3, n) if w < 10**9)
    texts = [noise(60) for _ in range(1500)]
    for d in range(40):
        texts += [f"{noise(40)} Name{d} a{k}@firm{d}.org {noise(40)}" for k in range(3)]
    got = told_in(texts, {r["doc_id"]: r for r in pii.digest(pii.sanitise(docs(spark, texts))).collect()})
    found = [(w == f"name{(i - 1500) // 3}") for i, ws in enumerate(got) for w in ws]
    assert sum(found) == 120 and sum(found) >= 0.95 * len(found)


def test_terms_become_the_rarest_word_that_contains_them(spark):
    """A term that doesn't give all becomes a word that stands wherever it stands and discloses nothing, if there is one."""
    texts = [f"medicine n{k % 7}ord n{k % 5}xy filler {k}" for k in range(500)] + [f"neurology medicine n{k}ord quux clinic mail ann@x.org" for k in range(4)]
    judged = pii.sanitise(docs(spark, texts))
    assert {r["value"]: r["to"] for r in judged.where("doc_id = 500").selectExpr("inline(term)").collect()} == {"neurology": "", "quux": "", "clinic": "", "mail": ""}
    assert pii.clean_text(judged).where("doc_id = 500").first()["text"] == " medicine n0ord    [EMAIL]"
    texts[100] += " neurology"  # now it doesn't give all
    judged = pii.sanitise(docs(spark, texts))
    assert {r["value"]: r["to"] for r in judged.where("doc_id = 500").selectExpr("inline(term)").collect()} == {"neurology": "medicine", "quux": "", "clinic": "", "mail": ""}
    assert {r["doc_id"]: r["sanitised"] for r in pii.digest(judged).collect()}[500] == "medicine medicine n0ord    [EMAIL]"


def test_lower_bounds_of_counts(spark):
    """The chance to meet n or more at the bound is TRUST, within the formula's error."""
    for n, row in enumerate(spark.range(1, 60).select(pii.sure(F.col("id")).alias("m")).collect(), 1):
        m = row["m"]
        term, less = np.exp(-m), 0.0
        for k in range(n):
            less, term = less + term, term * m / (k + 1)
        assert abs(1 - less - pii.TRUST) < 0.01, n


def test_many_spans_and_terms_in_one_text(spark):
    long = " ".join(f"u{k}x@y.org Yard" for k in range(3000))
    judged = pii.sanitise(docs(spark, [long, *[f"short v{k}@y.org yard" for k in range(3)], *[f"filler {k} words" for k in range(300)]]))
    row = pii.digest(judged).where("doc_id = 0").first()
    assert row["n_email"] == 3000 and row["spans"].count("term") == 3000 and "@" not in row["sanitised"]


def test_terms_that_are_parts_of_an_entity(spark):
    """A name beside an address that holds it gives the address away; within the address it is no term."""
    texts = [f"n{k % 7}ord n{k % 11}oun filler {k}" for k in range(80)] + [f"Schmidt Ann n{k}ord ann.schmidt@x.org and mail {k}" for k in range(4)]
    judged = pii.sanitise(docs(spark, texts))
    out = {r["doc_id"]: r for r in pii.digest(judged).collect()}
    spans = [s.split(":") for s in out[80]["spans"].split(",") if s.startswith("term")]
    assert [texts[80][int(a):int(e)] for _, a, e in spans] == ["Schmidt", "Ann", "and", "mail"]
    clean = {r["doc_id"]: r["text"] for r in pii.clean_text(judged).collect()}
    assert "chmidt" not in clean[80] and "[EMAIL]" in clean[80]


def test_entities_of_one_text_have_terms_through_their_pool(spark):
    texts = [f"n{k % 7}ord n{k % 11}oun filler {k}" for k in range(600)] + ["n1ord filler zorblatt one@x.org", "n2ord filler zorblatt quuxling two@x.org", "n1ord filler alone three@z.org"]
    frame = docs(spark, texts)
    got = told_in(texts, {r["doc_id"]: r for r in pii.digest(pii.sanitise(frame)).collect()})
    assert got[600:] == [["zorblatt"], ["zorblatt"], []] and not any(got[:600])
    assert [tuple(r) for r in pii.coverage(frame).collect()] == [("email", 5, 1)]


def test_outside_keeps_the_places(spark):
    text = "é a@b.cd +1 555 123 4567 😀 x 4111 1111 1111 1111 tail"
    span = lambda a, e: (a, e, text[a:e])
    frame = spark.createDataFrame([(text, [span(30, 49), span(2, 8), span(4, 8), span(9, 24)])], "text string, s array<struct<start:bigint,end:bigint,value:string>>")
    got = frame.select(pii.outside(F.col("text"), F.col("s"))).first()[0]
    gone = {*range(30, 49), *range(2, 8), *range(9, 24)}
    assert got == "".join(" " if i in gone else c for i, c in enumerate(text))


def test_personal_data_empty(spark):
    assert pii.digest(pii.sanitise(docs(spark, ["a"]).limit(0))).count() == 0
