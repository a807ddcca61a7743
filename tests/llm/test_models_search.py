"""Language model, lexical search and phrases: each against a plain version, and on awkward rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from daybook.llm import collocations, lexical, recurrent_lm
from daybook.llm.shingles import Words, blocks

SCHEMA = "doc_id long, text string, lang string, item_id string, word long, rank int, row long, score string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def made(seed, n, words="the of and river stone green letter house été ñandú water x1 seven road".split()):
    draw = random.Random(seed)
    ends = ["", "", "", ",", ".", "\n", " ;", "!\t"]
    return " ".join(draw.choice(words).title() + str(draw.choice(["", "", 1, 22])) + draw.choice(ends) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    texts = [made(i, 30 + i) for i in range(60)]
    texts += [None, "", " \n\t ", "...", "one two", "x " * 30_000, "ß日本 " * 2000 + "a" * 5000, made(3, 33), made(3, 33), texts[5]]
    langs = [None, "en", "de", "", "und"]
    out = [(i, t, langs[i % 5], "i", 1, 2, 3, "s") for i, t in enumerate(texts)]
    return [*out, out[7], (None, made(99, 50), "en", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- Phrases ------------------------------------------------------------------


def plain_phrases(rows, least, top):
    n, f = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    f[lang, tuple(words[at : at + size])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = set()
    for (lang, words), a in candidates.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words) and candidates.get((lang, words[i:j])) == a:
                    inside.add((lang, words[i:j]))
    found = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, all_ in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(all_)[:top], 1)
    )


@pytest.mark.parametrize(("least", "top", "shard", "bucket"), [(3, 40, 500, 50), (10, 2000, 2_000_000, 1_000_000), (2, 5, 100, 1000)])
def test_phrases_by_brute_force(docs, rows, monkeypatch, least, top, shard, bucket):
    monkeypatch.setattr(collocations, "BUCKET_PHRASES", bucket)
    got = collocations.collocations(docs, least, top, shard)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, top)


def test_no_phrases(none, docs):
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(docs, least=10**6).count() == 0


def test_index_counts_what_stands_in_the_text():
    draw = np.random.default_rng(1)
    text = np.r_[0, np.where(draw.random(400) < 0.15, 0, draw.integers(1, 4, 400)), 0]
    index = collocations.Index(collocations.transform(text).astype(np.int32))
    for size in range(2, collocations.DEPTH + 1):
        counts = index.extend()
        want = collections.Counter(
            tuple(text[i : i + size].tolist()) for i in range(len(text) - size + 1) if 0 not in text[i : i + size]
        )
        assert {tuple(w): int(c) for w, c in zip(index.words.tolist(), counts, strict=True)} == want


@pytest.mark.parametrize("words", [1, 3, 100, 2**20, 2**31 - 1, 2**40])
def test_packed_phrases_come_back(words):
    pack = collocations._Pack(words)
    for depth in range(1, 6):
        some = np.random.default_rng(depth).integers(1, words + 1, (20, depth))
        assert (pack.words(pack.packed(some), depth) == some).all()


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**12, 10**14, 10**6, 10**13)], "a long, n long, l long, r long")
    assert row.selectExpr(f"{collocations._SCORE} as score").first()[0] == 1000 * 10**26 // 10**19


# --- Search -------------------------------------------------------------------


def plain_search(rows, items, top):
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
    held = [(i, collections.Counter(t), len(t)) for i, t in ((r[0], terms(r[1])) for r in rows) if t]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = collections.Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        found = []
        for i, tf, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                for t in terms(text)
                if t in tf
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if gone else i, -s) for rank, (s, gone, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(1024, 128, 192), (16, 3, 4), (7, 1, 1)])
def test_search_by_brute_force(spark, docs, rows, monkeypatch, sizes):
    monkeypatch.setattr(lexical.counted, "__defaults__", sizes[:1])
    monkeypatch.setattr(lexical.indexed, "__defaults__", sizes[1:])
    items = [(f"q{i}", made(i, 12)) for i in range(12)] + [("none", None), ("empty", " .. "), ("one", "ONE two"), ("odd", "nowhere"), ("q0", made(0, 12)), (None, "seven")]
    table = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id string, text string, doc_id int")
    got = lexical.ranked(docs, table, top=7, block_items=5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, 7)


def test_nothing_to_search(spark, docs, none):
    items = spark.createDataFrame([("a", "river")], "item_id string, text string")
    assert lexical.ranked(none, items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0


def test_blocks_are_left_out_and_nothing_is_lost():
    """Documents of two kinds; an item of one kind needs no block of the other."""
    draw = np.random.default_rng(2)
    n, terms = 400, 40
    kind = np.arange(n) % 2
    tf = np.where((np.arange(terms)[None, :] // 20 == kind[:, None]) & (draw.random((n, terms)) < 0.6), draw.integers(1, 9, (n, terms)), 0)
    tf[:, 0] = 1  # one term in all of them
    doc, term = np.nonzero(tf)
    import pyarrow as pa

    by = lexical.Weights(n, int(tf.sum()), draw.integers(1, 5000, terms))
    columns = {
        "shard": pa.array([1]),
        "doc_ids": lexical._one(np.arange(n), pa.int64()),
        "n": lexical._one(tf.sum(axis=1), pa.int64()),
        "sizes": lexical._one((tf > 0).sum(axis=1), pa.int32()),
        "terms": lexical._one(term, pa.int32()),
        "tf": lexical._one(tf[doc, term], pa.int32()),
    }
    batch = pa.RecordBatch.from_pydict(columns)
    row = lexical.index_row(batch, 0, by, lexical.directions(terms), 16, 32)
    shard = lexical._Shard(row, 0)
    impacts = np.where(tf > 0, by.impacts(tf.sum(axis=1)[:, None], np.maximum(tf, 1)), 0)
    left_out = 0
    for _ in range(30):
        wanted = np.unique(np.r_[0, draw.integers(20, 40, 4)])
        scores = impacts[:, wanted] @ by.of_term[wanted]
        order = np.lexsort((np.arange(n), -scores))[:10]
        found, without = shard.best(wanted.tolist(), by.of_term[wanted], 10, 1)
        assert found == [(int(x), int(scores[x])) for x in order]
        left_out += without
    assert left_out > 100


# --- Language model -----------------------------------------------------------


@pytest.fixture(scope="module")
def scored(docs):
    return recurrent_lm.scored(docs, rounds=2, share=2, known=8, held=12).collect()


def test_base_scores_by_brute_force(rows, scored):
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + ["\0"]) for i, t, *_ in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = collections.Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(
        ((str(i), held(i), len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for i, t in tokens),
        key=str,
    )
    got = sorted(((str(r["doc_id"]), *r[1:6]) for r in scored), key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in scored)


def test_nothing_to_learn_from(spark, none):
    assert recurrent_lm.scored(none).count() == 0
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    alone = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in recurrent_lm.scored(alone).collect()} == {(3, 0, 0, 0.0)}


@pytest.fixture(scope="module")
def vocab():
    draw = np.random.default_rng(0)
    known = np.sort(draw.integers(1, 100, 70))[::-1].astype(float)
    empty = np.empty(0, np.int64)
    return recurrent_lm.Vocabulary(7, 5000, 200, empty.astype(np.uint64), empty, empty, known, np.array([[3, 5.0], [1, 2], [0, 0], [4, 4]]))


def loss(weights, vocab, texts, grads=None):
    net, total, state = recurrent_lm.Network(weights, len(vocab.known)), 0.0, None
    for read, target, fresh, _ in recurrent_lm.windows(texts, vocab.end, 3, 100):
        state, trace = np.zeros((read.shape[1], recurrent_lm.UNITS)), []
        states = net.forward(net.prepare(), read, fresh, state, trace)
        real, flat = target.ravel() >= 0, states.reshape(-1, recurrent_lm.UNITS)
        found, back = net.log_probability(flat[real], target.ravel()[real], grads)
        total -= found.sum()
        if grads is not None:
            whole = np.zeros_like(flat)
            whole[real] = back
            net.backward(read, fresh, trace, whole.reshape(states.shape), grads)
    return total


def test_gradients_by_differences(vocab):
    draw = np.random.default_rng(1)
    weights = {k: x.astype(float) for k, x in recurrent_lm.initial(vocab).items()}
    weights["kind"] += draw.normal(0, 0.3, weights["kind"].shape)
    weights["word"] += draw.normal(0, 0.3, weights["word"].shape)
    texts = [np.r_[draw.integers(0, vocab.end, n), vocab.end] for n in (5, 9, 3, 12)]
    grads = {k: np.zeros_like(x) for k, x in weights.items()}
    loss(weights, vocab, texts, grads)
    for name, x in weights.items():
        for flat in np.argsort(-np.abs(grads[name]).ravel())[:3]:
            at = np.unravel_index(flat, x.shape)
            middle = x[at]
            x[at] = middle + 0.01
            above = loss(weights, vocab, texts)
            x[at] = middle - 0.01
            below = loss(weights, vocab, texts)
            x[at] = middle
            assert (above - below) / 0.02 == pytest.approx(grads[name][at], rel=0.03, abs=0.01), name


def test_a_text_scores_alike_in_any_company_and_window(vocab, monkeypatch):
    draw = np.random.default_rng(3)
    weights = {k: x + draw.normal(0, 0.2, x.shape).astype(np.float32) for k, x in recurrent_lm.initial(vocab).items()}
    texts = [np.r_[draw.integers(0, vocab.end, n), vocab.end] for n in (1, 700, 50, 3, 0, 90)]
    net = recurrent_lm.Network(weights, len(vocab.known))
    together = recurrent_lm.score(net, net.prepare(), texts, vocab.end)
    monkeypatch.setattr(recurrent_lm, "STEPS", 7)
    monkeypatch.setattr(recurrent_lm, "LANES", 2)
    alone = [recurrent_lm.score(net, net.prepare(), [x], vocab.end)[0] for x in texts]
    assert together == pytest.approx(alone, rel=1e-4)


def test_probabilities_add_up_to_one(vocab):
    draw = np.random.default_rng(4)
    weights = {k: x + draw.normal(0, 0.2, x.shape).astype(np.float32) for k, x in recurrent_lm.initial(vocab).items()}
    net = recurrent_lm.Network(weights, len(vocab.known))
    state = draw.uniform(-1, 1, (1, recurrent_lm.UNITS)).astype(np.float32)
    all_ = np.arange(vocab.end + 1)
    found, _ = net.log_probability(np.repeat(state, len(all_), axis=0), all_)
    assert np.exp(found).sum() == pytest.approx(1, abs=1e-4)


def test_training_learns_an_order(vocab):
    texts = [np.r_[np.tile([3, 5, 9], 40), vocab.end] for _ in range(20)]
    weights = recurrent_lm.initial(vocab)
    squares = {k: np.full_like(x, recurrent_lm.START) for k, x in weights.items()}
    before = loss(weights, vocab, texts)
    for _ in range(8):
        recurrent_lm.train(weights, squares, texts, vocab)
    assert loss(weights, vocab, texts) < 0.3 * before


def test_held_words_stay_within_their_bound(spark):
    counts = spark.createDataFrame([(i, 0, 1 + i % 7) for i in range(500)], "word long, form int, c long")
    vocab = recurrent_lm.vocabulary(counts, 3, known=4, held=100)
    assert 0 < len(vocab.words) <= 100 and vocab.distinct == 501
    assert vocab.rest[0].tolist() == [496, sum(1 + i % 7 for i in range(500)) - vocab.known.sum()]
    part = next(blocks(["plain", "été.", "x.", "ñ"][:1]))
    assert recurrent_lm.forms(Words(part, lower=True)).tolist() == [0]
