"""Language ID, BPE, decontamination, toxicity: against brute force, round trips, held-out rows."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import bpe, decontaminate, langid, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, print string, digest int"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCAB = {"en": "the and of that with from this", "fr": "le la des que pour dans être", "de": "der die und das nicht für über"}


def docs(spark, texts, langs=None):
    rows = [(i, t, (langs or [None] * len(texts))[i], "src0", None, "p", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def tricky_texts():
    return [None, "", " ", "a", "Plain words here.", "x " * 400 + "\n" * 700 + "end", " " * 3000, "word" * 3000, "é" * 50 + " 日本語 テスト 🎉", "'s 't 've " * 200, "1234567890" * 300, "tab\t\t\tand\r\nnew\x1cline　wide ", "<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.load(RANKS, public_tokenizers.PATTERN)


def test_bpe_like_the_library_and_back(spark, encoder):
    texts = [*tricky_texts(), "same text", "same text"]
    out = {r["doc_id"]: r for r in bpe.digests(docs(spark, texts), RANKS, public_tokenizers.PATTERN).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        ids = encoder.encode_ordinary(t or "")
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_parts_are_safe(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 7)
    rng = random.Random(3)
    for _ in range(400):
        t = "".join(rng.choice(["a", "B", "é", "1", "'s", "'", "!", " ", "  ", "\n", "\t", " ", "\x1c"]) for _ in range(rng.randint(0, 60)))
        assert [i for part in bpe.encode(encoder, t) for i in part.tolist()] == encoder.encode_ordinary(t), repr(t)


def test_bpe_long_white_space(encoder):
    for tail in ("", "x", "\nx"):
        t = "ab" + " " * 300 + tail
        assert [i for part in bpe.encode(encoder, t) for i in part.tolist()] == encoder.encode_ordinary(t)
    long = "ab" + " " * 1_000_000 + "x"  # the library alone overflows its stack here
    assert b"".join(bpe.decode(encoder, p) for p in bpe.encode(encoder, long)).decode() == long


def test_bpe_round_trip_keeps_rows(spark):
    frame = docs(spark, tricky_texts())
    assert sorted(map(str, bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN).collect())) == sorted(map(str, frame.collect()))


def brute_hits(text, items, width=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, ids = set(), set()
    for item, t in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        for win in ([w[i:i + width] for i in range(max(1, len(w) - width + 1))] if w else []):
            for i in range(len(words) - len(win) + 1):
                if words[i:i + len(win)] == win:
                    hit |= set(range(i, i + len(win)))
                    ids.add(item)
    return len(words), len(hit), ids


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 18])
def test_decontaminate_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "B", "cé", "d9", "E"])
    items = [(k, " ".join(word() for _ in range(n))) for k, n in ((1, 12), (2, 3), (10, 30), (3, 1), (4, 12))] + [(5, None), (6, "..."), (2, "zz ZZ zz"), (7, "Long, unique: opening-words")]
    texts = [None, "", "!!", "LONG  unique\nopening WORDS", *[" ".join(word() for _ in range(rng.randint(1, 80))) for _ in range(60)], items[2][1].upper() + " tail", "x " * 5000 + items[0][1]]
    bench = spark.createDataFrame([(*x, "extra") for x in items], "item_id long, text string, doc_id string")
    out = {r["doc_id"]: r for r in decontaminate.digest(decontaminate.decontaminate(docs(spark, texts), bench)).collect()}
    for i, t in enumerate(texts):
        n, hit, ids = brute_hits(t, items)
        assert (out[i]["n_words"], out[i]["n_hit"], out[i]["n_items"], out[i]["contaminated"]) == (n, hit, len(ids), hit > 0)
        assert out[i]["items_sha256"] == decontaminate.ids_digest(ids)
    spans = out[3]["spans"]
    assert [texts[3][s["start"]:s["end"]] for s in spans] == ["LONG  unique\nopening WORDS"]
    kept = {r["doc_id"] for r in decontaminate.without_contaminated(docs(spark, texts), bench).collect()}
    assert kept == {i for i, t in enumerate(texts) if not brute_hits(t, items)[1]}


def test_chunks_keep_every_window(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 4)
    items = [(1, "a b c d e f g h i j k l m"), (2, "a, b"), (3, "...")]
    rows = decontaminate.chunks(spark.createDataFrame(items, "item_id long, text string"), 3).collect()
    have = {(r["item_id"], w) for r in rows for w in decontaminate.windows_of(decontaminate.words_of(r["text"]), 3)}
    assert have == {(i, w) for i, t in items for w in decontaminate.windows_of(decontaminate.words_of(t), 3)}
    assert max(len(r["text"].split()) for r in rows) <= 6


def test_decontaminate_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark, ["a b"]), none).first()["n_hit"] == 0
    assert decontaminate.decontaminate(docs(spark, ["a"]).limit(0), none).count() == 0


def spoken(rng, lang, n):
    return " ".join(rng.choice(VOCAB[lang].split()) for _ in range(n))


def test_language_of_words_and_switches(spark):
    rng = random.Random(1)
    langs = [rng.choice(list(VOCAB)) for _ in range(400)]
    texts = [spoken(rng, lang, rng.randint(3, 60)) for lang in langs]
    frame = docs(spark, texts, langs)
    judged = {r["doc_id"]: r for r in langid.identify(frame).collect()}
    held = [r["doc_id"] for r in frame.select("doc_id", langid.held_out(frame["doc_id"]).alias("h")).collect() if r["h"]]
    assert 50 < len(held) < 150
    assert np.mean([judged[i]["lang_pred"] == langs[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in judged.values())
    model = langid.train([(t, lang) for t, lang in zip(texts, langs, strict=True)])
    mixed = spoken(rng, "en", 40) + " " + spoken(rng, "fr", 40)
    _, start, end = langid.words_of(mixed)
    f = langid.Features(*langid.words_of(mixed))
    p = langid.label_posteriors(langid.emissions(f, model["weights"]), np.array([80]), model["start"], model["move"])
    said = [model["langs"][i] for i in p.argmax(axis=1)]
    assert said[:35].count("en") > 30 and said[45:].count("fr") > 30


@pytest.mark.parametrize("segment", [2_048, 1, 2, 3])
def test_forward_backward_against_enumeration(monkeypatch, segment):
    monkeypatch.setattr(langid, "SEGMENT", segment)
    from itertools import product
    rng = np.random.default_rng(2)
    scores, start, move = rng.normal(size=(7, 3)).astype(np.float32), rng.normal(size=3), rng.normal(size=(3, 3))
    lengths = np.array([4, 1, 2])
    got, at = langid.label_posteriors(scores, lengths, start, move), 0
    also = langid.posteriors(scores, lengths, start, move)[0]
    for n in lengths:
        want = np.zeros((n, 3))
        for path in product(range(3), repeat=int(n)):
            s = start[path[0]] + sum(scores[at + t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False))
            for t, k in enumerate(path):
                want[t, k] += np.exp(s)
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(got[at:at + n], want, atol=1e-4) and np.allclose(also[at:at + n], want, atol=1e-4)
        at += n


def plain_features(word):
    """Bytes of what a word's features stand for: the word, its prefixes and suffixes, and its trigrams."""
    b = word.lower().encode()
    ends = [b"\0" + b + b"\0"]
    return b, [b[:k] for k in (2, 3, 4) if len(b) >= k], [b[-k:] for k in (2, 3, 4) if len(b) >= k], [e[i:i + 3] for e in ends for i in range(len(b))]


def test_features_stand_for_affixes_grams_and_words():
    words = ["The", "then", "other", "é", "über", "überall", "a", "the"]
    data, start, end = langid.words_of(" ".join(words))
    f = langid.Features(data, start, end)
    bucket, at = {}, 0
    for i, w in enumerate(words):
        whole, pre, suf, grams = plain_features(w)
        told = [("w", whole)] + [x for k in (0, 1, 2) for x in ((("p", pre[k]), ("s", suf[k])) if len(pre) > k else ((None, None), (None, None)))]
        for name, got in zip(told, f.single[i].tolist(), strict=True):
            assert (got == -1) == (name[0] is None)
            if name[0]:
                assert bucket.setdefault(name, got) == got
        for g, got in zip(grams, f.grams[at:at + len(grams)].tolist(), strict=True):
            assert bucket.setdefault(("g", g), got) == got
        at += len(grams)
    assert len(set(bucket.values())) == len(bucket)  # no collisions here


def test_gradient_against_differences():
    """Training climbs the conditional likelihood: posteriors give its gradient in start and transition scores."""
    from itertools import product
    rng = np.random.default_rng(4)
    scores, start, move = rng.normal(size=(5, 2)).astype(np.float32), rng.normal(size=2), rng.normal(size=(2, 2))
    y = [0, 1, 1, 0, 1]

    def loglik(start, move):
        s = lambda path: start[path[0]] + sum(scores[t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False))
        return s(y) - np.log(sum(np.exp(s(p)) for p in product((0, 1), repeat=5)))

    _, moves, first = langid.posteriors(scores, np.array([5]), start, move)
    seen = np.zeros((2, 2))
    for a, b in zip(y, y[1:], strict=False):
        seen[a, b] += 1
    for a, b in product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[a, b] = 1e-4
        assert abs((loglik(start, move + d) - loglik(start, move - d)) / 2e-4 - (seen - moves)[a, b]) < 1e-3
    for k in (0, 1):
        d = np.eye(2)[k] * 1e-4
        assert abs((loglik(start + d, move) - loglik(start - d, move)) / 2e-4 - ((k == y[0]) - first[k])) < 1e-3


def test_language_edge_cases(spark):
    rng = random.Random(4)
    texts = [None, "", "123 !!", "—", *[spoken(rng, "en", 20) for _ in range(20)], spoken(rng, "en", 60_000)]
    out = {r["doc_id"]: r for r in langid.identify(docs(spark, texts, [None] + ["en"] * (len(texts) - 1))).collect()}
    assert [(out[i]["lang_pred"], out[i]["score"]) for i in range(4)] == [("und", 0.0)] * 4
    assert out[len(texts) - 1]["lang_pred"] == "en"
    assert langid.identify(docs(spark, ["the and"])).first()["lang_pred"] == "und"  # nothing to learn from
    assert langid.identify(docs(spark, ["a"]).limit(0)).count() == 0
    clash = docs(spark, ["der die"], ["de"]).selectExpr("*", "'x' as lang_pred", "7 as score")
    assert langid.identify(clash).first()["score"] <= 1


def labelled(rng, n):
    texts, low, toxic = [], [], []
    for _ in range(n):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(20, 80))]
        low.append(int(rng.random() < 0.2))
        toxic.append(int(rng.random() < (0.5 if low[-1] else 0.05)))
        words += ["###"] * 4 * low[-1] + [rng.choice(["idiot", "trash", "scum"]) for _ in range(3 * toxic[-1])]
        rng.shuffle(words)
        texts.append(" ".join(words))
    return texts, low, toxic


def test_toxicity_on_unseen_rows(spark):
    rng = random.Random(6)
    texts, low, toxic = labelled(rng, 1200)
    frame = docs(spark, texts)
    labels = spark.createDataFrame([(i, 1 - low[i], toxic[i], "x") for i in range(600)], "doc_id long, quality int, toxic int, text string")
    out = {r["doc_id"]: r for r in toxicity.judge(frame, labels).collect()}
    for name, truth in (("low_quality", low), ("toxic", toxic)):
        assert np.mean([out[i][name] == bool(truth[i]) for i in range(600, 1200)]) > 0.98


def plain_logistic(x, extra, y):
    """The same model over a dense matrix, row by row."""
    n, extra = len(y), np.column_stack([extra, np.ones(len(y))])
    share = y.mean()
    often = x.sum(axis=0)
    telling = (often >= toxicity.LEAST_DOCS) & (np.abs(x.T @ (y - share)) / np.sqrt(np.maximum(often * share * (1 - share), 1e-9)) >= toxicity.LEAST_Z)
    x = x * telling
    w, v = np.zeros(x.shape[1]), np.zeros(extra.shape[1])
    sw, sv = np.full_like(w, 1e-4), np.full_like(v, 1e-4)
    v[-1] = np.log(share / (1 - share))
    for _ in range(toxicity.PASSES):
        p = np.array([1 / (1 + np.exp(-(x[i] @ w + extra[i] @ v))) for i in range(n)])
        gw = sum((y[i] - p[i]) * x[i] for i in range(n)) / n - toxicity.DECAY * w
        gv = sum((y[i] - p[i]) * extra[i] for i in range(n)) / n
        sw, sv = sw + gw ** 2, sv + gv ** 2
        w, v = w + toxicity.RATE * gw / np.sqrt(sw), v + 0.2 * toxicity.RATE * gv / np.sqrt(sv)
    return w, v


def test_chain_against_a_plain_version(spark):
    """Tokens, folds, out-of-fold log-odds and both models, by dense matrices and loops."""
    import zlib
    rng = random.Random(7)
    texts, low, toxic = labelled(rng, 150)
    vocabulary = sorted({t for x in texts for t in re.findall(r"[^\W_]+|[^\w\s]+", x.lower())})
    bag = lambda t: np.array([float(w in set(re.findall(r"[^\W_]+|[^\w\s]+", t.lower()))) for w in vocabulary])
    x, y = np.array([bag(t) for t in texts]), np.column_stack([low, toxic]).astype(float)
    fold = np.array([zlib.crc32(t.encode()) % toxicity.FOLDS for t in texts])
    first, odds = plain_logistic(x, np.zeros((len(texts), 0)), y[:, 0]), np.zeros(len(texts))
    for k in range(toxicity.FOLDS):
        w, v = plain_logistic(x[fold != k], np.zeros(((fold != k).sum(), 0)), y[fold != k, 0])
        odds[fold == k] = x[fold == k] @ w + v[-1]
    second = plain_logistic(x, odds[:, None], y[:, 1])
    unseen = [*labelled(rng, 20)[0], texts[0], "", "unknown words only"]
    own = np.array([bag(t) for t in unseen]) @ first[0] + first[1][-1]
    also = np.array([bag(t) for t in unseen]) @ second[0] + second[1][0] * own + second[1][-1]
    frame = docs(spark, texts + unseen)
    labels = spark.createDataFrame([(i, 1 - low[i], toxic[i]) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.judge(frame, labels).collect()}
    for i in range(len(unseen)):
        r = out[len(texts) + i]
        assert np.allclose([r["p_low_quality"], r["p_toxic"]], [1 / (1 + np.exp(-own[i])), 1 / (1 + np.exp(-also[i]))], atol=1e-6), i


def test_toxicity_edge_cases(spark):
    frame = docs(spark, [None, "", "hello"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["toxic"] for r in toxicity.judge(frame, none).collect()] == [False] * 3
    nulls = spark.createDataFrame([(0, None, 1), (None, 1, 1), (2, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"]: r["toxic"] for r in toxicity.judge(frame, nulls).collect()}[0] is False
    assert toxicity.judge(frame.limit(0), nulls).count() == 0
