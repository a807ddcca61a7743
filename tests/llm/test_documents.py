"""Operators on documents: awkward rows for all of them, then each against a plain version."""

import collections
import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import bpe, langid, line_dedup, minhash, mixing, quality_rules, site_quality
from daybook.llm.queries import QUERIES
from daybook.llm.text_model import sampled

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, rate string, p string"
WORDS = "the of and river stone green letter house under many water bright window paper seven road".split()


def prose(seed, words=80):
    draw = random.Random(seed)
    lines = [" ".join(draw.choice(WORDS) + str(draw.randint(0, 99)) for _ in range(10)) for _ in range(words // 10)]
    return "\n".join(lines)


def awkward_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, clashing extra columns."""
    texts = {
        0: prose(0),
        1: prose(1),
        2: prose(0),  # a copy of 0
        3: prose(0) + " tail",  # a near copy of 0
        4: None,
        5: "",
        6: " \n\t\n ",
        7: "one two",
        8: "x " * 60_000,
        9: "éß日本 " * 3000 + "a" * 5000,
        10: "### 123 !!",
        11: prose(11),
    }
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None, 7, "x", "y") for i, t in texts.items()]
    return [*rows, rows[11], (None, prose(12), None, None, None, None, None, None), (12, "a\nb\nc", "fr", "s", 5, 1, "", "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(0, 1, 0), (1, 1, None), (1, 1, 0), (10, 0, 0), (9, None, 1), (None, 1, 0), (999, 0, 1)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


OPERATORS = {
    "language": lambda d, _: langid.predict_languages(d),
    "bpe": lambda d, _: bpe.digests(d),
    "encoded": lambda d, _: bpe.encoded(d),
    "lines": lambda d, _: line_dedup.deduplicated(d),
    "mixing": lambda d, x: mixing.mixed(d, mixing.domain_labels(x)),
    "site": lambda d, x: site_quality.judged(d, site_quality.good_labels(x), F.col("source"), F.col("lang")),
    "near": lambda d, _: minhash.near_duplicates(d),
    "rules": lambda d, x: quality_rules.judged(d, x),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, docs, labels):
    rows = OPERATORS[name](docs, labels).select("doc_id").collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in rows) == sorted([-1, *range(13), 11])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, none, no_labels):
    assert OPERATORS[name](none, no_labels).collect() == []


@pytest.mark.parametrize("name", ["mixing", "site", "rules"])
def test_without_labels(name, docs, no_labels):
    assert OPERATORS[name](docs, no_labels).count() == 15


def test_language_of_texts_without_letters(docs):
    rows = {r.doc_id: r for r in langid.predict_languages(docs).collect()}
    assert [rows[i].lang_pred for i in (4, 5, 6, 10)] == ["und"] * 4
    assert rows[4].score == 0 and all(0 <= r.score <= 1 for r in rows.values())
    assert not rows[None].held_out


def test_only_letters_of_category_l_count():
    parser = langid.Parser({"de": "der hund und die katze", "en": "the dog and the cat"})
    assert [x[0] for x in parser.predict(["½ ②²", "Ⅷ", "①2³", "ª", "5 ñ", "字"])][:3] == ["und"] * 3
    assert all(x[0] != "und" for x in parser.predict(["ª", "5 ñ", "字"]))


def plain_phrases(text, learned):
    """Longest matches by trying every length."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in learned:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_by_brute_force():
    learned = {"a": prose(3, 200), "b": "zu dem hause und der strasse " * 9}
    parser = langid.Parser(learned)
    texts = [langid.plain(t) for t in (prose(4, 40), "der hund", "zzz", "", "the strasse " * 60)]
    found = parser.phrases(texts)
    for text, row in zip(texts, found, strict=True):
        blocks = [text[i : i + langid.BLOCK] for i in range(0, len(text), langid.BLOCK)]
        for name, value in zip(parser.languages, row, strict=True):
            assert value == sum(plain_phrases(b, langid.plain(learned[name])) for b in blocks), (text, name)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(public_tokenizers.path(bpe.VOCABULARY))


def encoding(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )


def test_a_worker_forgets_pieces_after_a_task(monkeypatch):
    path = public_tokenizers.path(bpe.VOCABULARY)
    texts = [prose(k) for k in range(5)]
    with bpe._codec(path) as codec:
        first = [x for x in codec.described(texts)]
        assert len(codec._known) > 100
    assert codec._known  # few pieces stay
    monkeypatch.setattr(bpe, "KEPT", 100)
    with bpe._codec(path) as again:
        assert again is codec and [x for x in again.described(texts)] == first
    assert not codec._known and not codec.vocabulary.follows and not codec.vocabulary.step
    with bpe._codec(path) as again:
        assert [x for x in again.described(texts)] == first


def test_bpe_equals_the_library(docs, vocabulary):
    known = encoding(vocabulary)
    rows = {r.doc_id: r for r in bpe.digests(docs).collect()}
    for doc_id, text, *_ in awkward_rows():
        ids = known.encode_ordinary(text or "")
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert all(r.exact for r in bpe.encoded(docs).collect())


def test_token_pairs_by_definition(vocabulary):
    draw = random.Random(1)
    for _ in range(3000):
        a, b = draw.randint(0, 6000), draw.randint(0, 6000)
        joined = vocabulary.merged(vocabulary.bytes_of[a] + vocabulary.bytes_of[b])
        assert vocabulary.may_follow(a, b) == (joined == [a, b])


def test_edits_equal_encoding_anew(vocabulary):
    draw = random.Random(2)
    for _ in range(300):
        data = bytes(draw.choice(b"etaoin shrdlu") for _ in range(draw.randint(0, 200)))
        start = draw.randint(0, len(data))
        stop = draw.randint(start, len(data))
        new = bytes(draw.choice(b"etaoin") for _ in range(draw.randint(0, 5)))
        edited = bpe.Prefixes(vocabulary, data)
        edited.replace(start, stop, new)
        anew = bpe.Prefixes(vocabulary, data[:start] + new + data[stop:])
        assert (edited.last, edited.data, edited._states) == (anew.last, anew.data, anew._states)


def test_lines_by_brute_force(spark):
    draw = random.Random(5)
    texts = {i: "\n".join(draw.choice("abc ") for _ in range(draw.randint(0, 9))) for i in range(60)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(frame).collect()}
    seen = set()
    for i, text in texts.items():
        lines = text.split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip()]
        covered = set()
        for three in zip(filled, filled[1:], filled[2:], strict=False):
            window = tuple(lines[k] for k in three)
            covered |= set(three) if window in seen else set()
            seen.add(window)
        assert found[i] == "\n".join(x for k, x in enumerate(lines) if k not in covered)


def shingles(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def components(links, ids):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_names_that_clash_survive(spark):
    names = ["doc_id", "text", "n_chars", "_id", "_key", "_covered", "n_removed", "row", "id", "key", "covered", "a.b"]
    same = "a b\nc d\ne f\ng h"
    rows = [(i, t, 1, *[f"{c}{i}" for c in names[3:]]) for i, t in enumerate([same, same, prose(1), None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, " + ", ".join(f"`{c}` string" for c in names[3:]))
    found = {r["doc_id"]: r for r in line_dedup.deduplicated(docs).collect()}
    assert [found[i]["n_removed"] for i in range(4)] == [0, 4, 0, 0] and found[1]["text"] == ""
    assert all(found[i][c] == f"{c}{i}" for i in range(4) for c in names[3:] if c != "n_removed")
    staged = corpus_pipeline.line_stage(spark, docs, "")
    assert staged.columns == names and {r["doc_id"]: r["n_removed"] for r in staged.collect()} == {0: "n_removed0", 2: "n_removed2", 3: "n_removed3"}
    near = corpus_pipeline.near_stage(spark, docs.unionByName(docs.where("doc_id = 2")), "")
    assert near.columns == names and sorted(r["_id"] for r in near.collect()) == ["_id0", "_id2", "_id3"]


def test_a_later_window_may_overlap_the_first(spark):
    docs = spark.createDataFrame([(1, "a\na\na\na\nb")], "doc_id long, text string")
    assert line_dedup.deduplicated(docs).first()["text"] == "a\nb"


def test_a_text_of_very_many_repeated_lines(spark):
    lines = [f"line {i % 1000}" for i in range(200_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    begin = time.monotonic()
    row = line_dedup.deduplicated(docs).first()
    assert row["text"] == "\n".join(lines[:1000]) and row["n_removed"] == 199_000
    assert time.monotonic() - begin < 30


def test_no_more_rows_to_learn_from_than_the_bound(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i % 80} " * 60) for i in range(4000)], "doc_id long, text string")
    labels = spark.range(60).selectExpr("id as doc_id", "'x' as kind")
    taken = sampled(docs, labels, 30).collect()
    assert len(taken) == len({r["doc_id"] for r in taken}) <= 30
    plan = sampled(docs, labels, 30)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert len(sampled(docs, labels, 100).collect()) == 40


def test_near_duplicates_by_brute_force(spark, monkeypatch):
    draw = random.Random(6)
    bases = [prose(k, 150).split() for k in range(4)]
    texts = {}
    for i in range(160):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 1, 2, 4, 8])):
            words[draw.randrange(len(words))] = "new" + str(draw.randint(0, 9999))
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    links = [
        (a, b)
        for a, b in itertools.combinations(texts, 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    expected = components(links, texts)
    rows = minhash.near_duplicates(frame, width=4).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (expected[r.doc_id] == r.doc_id) for r in rows)
    monkeypatch.setattr(minhash, "LARGE", 2)  # looked up with salt
    again = minhash.near_duplicates(frame, width=4, exact=True).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_a_met_pair_is_judged_by_its_sets_alone(spark):
    shingles = np.arange(10, dtype=np.uint64).tobytes()
    far = [np.full(minhash.VALUES, i, np.uint16).tobytes() for i in range(2)]
    sets = spark.createDataFrame([(i, bytearray(far[i]), bytearray(), bytearray(shingles)) for i in range(2)], minhash._SETS)
    pairs = spark.createDataFrame([(0, 1)], "a long, b long")
    assert [tuple(r) for r in minhash._confirmed(pairs, sets, 80).collect()] == [(0, 1)]


def test_near_duplicates_of_awkward_rows(docs):
    rows = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert [rows[i].component_id for i in (0, 2, 3)] == [0, 0, 0]
    assert all(rows[i].n_shingles == 0 and rows[i].component_id == i for i in (4, 5, 6))
    assert rows[7].n_shingles == 1 and rows[8].n_shingles == 1
    assert rows[None].component_id is None and rows[None].kept


def test_counts_and_rules(docs, labels):
    rows = {r.doc_id: r for r in quality_rules.judged(docs, labels).collect()}
    for doc_id, text, *_ in awkward_rows():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = collections.Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        row = rows[doc_id]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row.n_dup_lines == len(lines) - len(set(lines)) and row.n_repeat_words == len(repeated)
        assert row.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (row.kept and row.base_failed)


def test_a_rule_is_learned(spark):
    def text(i):
        return " ".join(w + ("###" if i % 4 == 0 else "") for w in prose(i, 100).split())

    frame = spark.createDataFrame([(i, text(i)) for i in range(240)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(200)], "doc_id long, quality int")
    rows = quality_rules.judged(frame, marks).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in rows)


def test_rates_meet_the_targets(spark):
    def text(i):
        return prose(i, 100) + (" idiot scum" if i % 3 == 0 else "")

    frame = spark.createDataFrame([(i, text(i)) for i in range(300)], "doc_id long, text string")
    marks = spark.createDataFrame(
        [(i, "toxic" if i % 3 == 0 else "clean") for i in range(200)], "doc_id long, kind string"
    )
    rows = mixing.mixed(frame, marks, {"clean": 0.8, "toxic": 0.2}, ("clean", "toxic")).collect()
    clean, toxic = (sum(r.rate * r.n_words * r[f"p_{d}"] for r in rows) for d in ("clean", "toxic"))
    assert abs(clean / (clean + toxic) - 0.8) < 0.01
    assert all(r.copies >= 1 for r in rows if r.doc_id % 3)
    site = site_quality.judged(
        frame.withColumn("source", F.lit("s")),
        marks.select("doc_id", F.when(F.col("kind") == "clean", "good").otherwise("bad").alias("kind")),
        F.col("source"),
        F.col("source"),
    )
    assert all(r.kept == bool(r.doc_id % 3) for r in site.collect())


def plain_strength(groups, parents):
    """By moments, as a person would with a table of groups (n, good): how far means lie from the parent's beyond chance."""
    some = [(n, good / n, parent) for (n, good), parent in zip(groups, parents, strict=True) if n >= 2]
    total = sum(n for n, *_ in some)
    variance = sum(n * q * (1 - q) for n, _, q in some) / total if some else 0
    if not variance:
        return site_quality.MAX_STRENGTH
    spread = sum(n * (m - q) ** 2 for n, m, q in some)
    between = max((spread - len(some) * variance) / total, variance / site_quality.MAX_STRENGTH)
    return min(max(variance / between - 1, site_quality.MIN_STRENGTH), site_quality.MAX_STRENGTH)


def test_sites_are_shrunk_as_a_plain_version_says(spark):
    draw = random.Random(4)
    rows = []
    for i in range(600):
        host = draw.choice(["a"] * 6 + ["b", "b", "c", None])
        bad = draw.random() < {"a": 0.1, "b": 0.7, "c": 0.4, None: 0.2}[host]
        text = prose(i, 80) + (" click here buy now ###" * 8 if bad else "")
        rows.append((i, text, f"http://www.{host}.org/{draw.choice('xyz')}/{i % 3}/p.html" if host else None, "bad" if bad else "good"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, url string, kind string")
    host, path = site_quality.url_host(F.col("url")), site_quality.url_path(F.col("url"), 2)
    found = {r["doc_id"]: r for r in site_quality.judged(frame, frame.where("doc_id % 3 = 0").select("doc_id", "kind"), host, path).collect()}
    site = {i: (u.split("/")[2][4:], "/" + "/".join(u.split("/")[3:5])) if u else ("", "") for i, _, u, _ in rows}
    hosts, paths = collections.defaultdict(lambda: [0, 0.0]), collections.defaultdict(lambda: [0, 0.0])
    for i, r in found.items():
        for group in (hosts[site[i][0]], paths[site[i]]):
            group[0] += 1
            group[1] += r["p_doc"]
    overall = sum(good for _, good in hosts.values()) / len(found)
    k = plain_strength(list(hosts.values()), [overall] * len(hosts))
    p_host = {name: (good + k * overall) / (n + k) for name, (n, good) in hosts.items()}
    k = plain_strength(list(paths.values()), [p_host[name] for name, _ in paths])
    p_path = {name: (good + k * p_host[name[0]]) / (n + k) for name, (n, good) in paths.items()}
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for i, r in found.items():
        odds = logit(r["p_doc"]) + 0.5 * (logit(p_path[site[i]]) - logit(overall))
        want = (p_host[site[i][0]], p_path[site[i]], 1 / (1 + math.exp(-odds)))
        assert (r["p_host"], r["p_path"], r["score"]) == pytest.approx(want, rel=1e-9)
    assert p_host["a.org"] > p_host["b.org"] and min(n for n, _ in paths.values()) < 10


def test_hosts_and_paths_of_urls(spark):
    urls = ["http://WWW.A.org/x/y/z.html?q=/1", "https://b.org", "https://b.org/", "https://b.org/only", "no url", None, "http://c.de//d///e"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(site_quality.url_host(F.col("u")), site_quality.url_path(F.col("u"), 2)).collect()
    assert [tuple(r) for r in got] == [("a.org", "/x/y"), ("b.org", "/"), ("b.org", "/"), ("b.org", "/"), (None, None), (None, None), ("c.de", "/d")]


def plain_rates(n, p, wanted, rounds=200_000):
    """Nonnegative least squares by plain projected gradient, in the measure of tokens."""
    r = np.ones(len(n))
    speed = 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p).max()
    for _ in range(rounds):
        miss = (r * n) @ p - wanted
        r = np.maximum(r - speed * (p @ miss), 0)
    return r


@pytest.mark.parametrize(("goal", "repeats"), [((0.6, 0.3, 0.1), True), ((0.6, 0.3, 0.1), False), ((0.98, 0.01, 0.01), True), ((0.1, 0.1, 0.8), True)])
def test_rates_against_a_plain_solver(spark, goal, repeats):
    draw = np.random.default_rng(3)
    n = draw.integers(1, 300, 400).astype(float)
    p = draw.dirichlet((0.6, 0.2, 0.1), 400)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n_words long, p array<double>")
    fit = mixing.fit_rates(rows, goal, 0, repeats)
    before = n @ p
    total = before[0] / goal[0]
    wanted = np.array(goal) * total if repeats else np.minimum(np.array(goal) * total, before)
    plain = (plain_rates(n, p, wanted) * n) @ p
    assert fit.wanted == pytest.approx(wanted)
    ours = [r["r"] for r in rows.select(mixing.rate(fit.steps, 3).alias("r")).collect()]
    assert min(ours) >= 0 and (np.array(ours) * n) @ p == pytest.approx(fit.reached, rel=1e-6)
    assert np.linalg.norm(fit.reached - wanted) <= np.linalg.norm(plain - wanted) + 2e-4 * total
    assert fit.met == bool(np.abs(fit.reached - wanted).max() <= mixing.TOLERANCE * total)


def test_targets_out_of_reach_are_reported(spark):
    rows = spark.createDataFrame([(100, [0.5, 0.5])] * 20, "n_words long, p array<double>")
    fit = mixing.fit_rates(rows, (0.9, 0.1), 0, True)
    assert not fit.met and len(fit.steps) < mixing.MAX_PASSES
    table = mixing.reached(
        spark.createDataFrame([(10, 0.9, 0.1, 1.0, 1), (10, 0.1, 0.9, 0.5, 0)], "n_words long, p_clean double, p_toxic double, rate double, copies long"),
        {"clean": 0.8, "toxic": 0.2}, ("clean", "toxic"),
    )
    got = {r["domain"]: (round(r["wanted"], 6), round(r["by_rates"], 6), round(r["by_copies"], 6)) for r in table.collect()}
    assert got == {"clean": (10.0, 9.5, 9.0), "toxic": (2.5, 5.5, 1.0)}


def test_a_scarce_domain_costs_no_clean_text(spark):
    frame = spark.createDataFrame(
        [(i, prose(i, 100) + (" idiot scum" if i < 8 else "")) for i in range(300)], "doc_id long, text string"
    )
    marks = spark.createDataFrame([(i, "toxic" if i < 8 else "clean") for i in range(300)], "doc_id long, kind string")
    rows = mixing.mixed(frame, marks, {"clean": 0.5, "toxic": 0.25, "low": 0.25}).collect()
    assert all(r.copies == 1 for r in rows if r.doc_id >= 8)


def test_the_mixing_query_fills_scarce_domains(spark, tmp_path):
    kinds = {0: ("toxic", " idiot scum"), 1: ("low", " click here buy")}
    texts = [(i, prose(i, 100) + kinds.get(i % 50, ("", ""))[1]) for i in range(500)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i % 50 != 1), int(i % 50 == 0)) for i in range(500)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = QUERIES["op5_mixing"](spark, str(tmp_path)).collect()
    tokens = {d: sum(r.rate * r.n_words * r[f"p_{d}"] for r in rows) for d in mixing.DOMAINS}
    before = sum(r.n_words * r.p_clean for r in rows)
    for name, share in mixing.TARGETS.items():
        assert abs(tokens[name] / (before / mixing.TARGETS["clean"]) - share) < 0.001
    assert all(r.copies > 1 for r in rows if r.doc_id % 50 < 2)
    assert sum(r.copies for r in rows if r.doc_id % 50 > 1) > 0.95 * 480


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, docs, none, tmp_path, name, stage):
    empty = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    out = stage(spark, docs, empty)
    if name != "byte_bpe":
        assert out.columns == docs.columns
    assert out.count() <= docs.count()
    assert stage(spark, none, empty).count() == 0


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    rows = [(2, prose(2)), (5, prose(2)), (5, prose(5)), (6, None), (None, prose(2))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_stage(spark, frame, "").collect()]
    assert sorted(kept, key=str) == sorted([rows[0], *rows[2:]], key=str)
    mixed = mixing.mixed(frame, spark.createDataFrame([], "doc_id long, kind string"), keyed=True)
    left = corpus_pipeline._without(frame, mixed.where("doc_id = 5").limit(1))
    assert left.where("doc_id = 5").count() == 1


def test_pipeline_stages_take_effect(spark, tmp_path):
    sf = str(tmp_path)
    good = [(i, prose(i, 100)) for i in range(20)]
    near = (20, prose(3, 100).replace("\n", " ") + " end")
    rows = [*good, near, (21, "short"), (22, prose(4, 100) + "\n" + prose(30, 60))]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int").write.parquet(
        f"{sf}/labels.parquet"
    )
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(result) == {*range(20), 22}
    known = encoding(bpe.Vocabulary.load(public_tokenizers.path(bpe.VOCABULARY)))
    assert list(result[22].ids) == known.encode_ordinary(prose(30, 60))
    assert all(r.exact and r.n_tokens == len(r.ids) for r in result.values())
