"""Operators on pages and vectors, and what all operators share."""

import base64
import hashlib
import math
import random
import time

import numpy as np
import pytest

from daybook.llm import embedding_dedup, html_text, warc
from daybook.llm.common import Work
from daybook.llm.components import connected

PARAGRAPH = "The river and the house of the old town lie in the green valley under the hill, and it is quiet."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>"<p>no</p>"</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies and it is the law of the land in which you are reading this now.</div>
<main><h1>Old&nbsp;Town</h1><p>{PARAGRAPH}<p>Caf&eacute; &amp; <b>bar</b>.<br>Yes.</p>
<aside>In other news the man and the dog went to the sea for the day and that was it.</aside>
<div class="ad">Buy the best of the shoes and the hats that are in the shop now, it is cheap.</div>
<form>Name of the reader and the town in which they live <input name=x></form></main>
<section id="comments"><p>I think that the author of this is right and the town is the best of all.</p></section>
<footer>&copy; the owners of the page and of all that is in it, and so on for the years.</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == f"Old Town {PARAGRAPH} Café & bar. Yes."


def test_main_text_without_an_article():
    page = f"<body><div><a href=1>One</a> | <a href=2>Two</a></div><h2>Title</h2><div>{PARAGRAPH}</div><div>Short one.</div><div>{PARAGRAPH}</div></body>"
    assert html_text.main_text(page) == f"Title {PARAGRAPH} Short one. {PARAGRAPH}"


COMMENT = "I think that the author of this is right and it is the best of all in the town."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div><p title="5" screen">{PARAGRAPH}</p></div>', PARAGRAPH),
        (f"<div><p><a title=it's href=x>Hi</a> {PARAGRAPH}</p></div>", f"Hi {PARAGRAPH}"),
        (f'<div><p title="abc>{PARAGRAPH}</p></div>', PARAGRAPH),
        (f"<div><p a=1/ b = '>' c>{PARAGRAPH}</p></div>", PARAGRAPH),
        (f"<div><p>1 < 2 <3 & {PARAGRAPH}</p><!-- <p>no", f"1 < 2 <3 & {PARAGRAPH}"),
        ("<div>" + "我们在这个城市里看到了很多新的建筑物。" * 3 + "</div>", "我们在这个城市里看到了很多新的建筑物。" * 3),
        (f"<article><p>{PARAGRAPH}</p><article><p>{COMMENT}</p></article></article>", PARAGRAPH),
        (f"<article><h1>T</h1><article><p>{PARAGRAPH}</p></article></article>", f"T {PARAGRAPH}"),
        (f"<main><article><p>{PARAGRAPH}</p></article></main>", PARAGRAPH),
        (f'<div><p>{PARAGRAPH}</p></div><div class="hinweis"><p>{COMMENT}</p></div>', PARAGRAPH),
        (f'<div><p>{PARAGRAPH}</p></div><section id="kommentare"><p>{COMMENT}</p></section>', PARAGRAPH),
    ],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "part",
    ['<a title="', "<a b='c ", "<div>x y z ", "<div class=ad>some text of it ", "<div class=print><article>text of it</article> ",
     "<b><li>x</li>", "<b></i>", "<svg>", "<!a ", "</a ", "<", "<article>some of the text ", "<ul><li><p>of it", "<select><option>a"],
)
def test_time_in_proportion_to_the_page(part):
    def seconds(n):
        begin = time.process_time()
        html_text.main_text(part * n)
        return time.process_time() - begin

    seconds(1000)
    assert seconds(40_000) < 0.5 + 12 * seconds(10_000)


NAMES = "Anna Bert Carl Dora Emil Frida Gustav Hanna Ida Jakob Karl Lena Max Nora"
LINKS = "<p><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a></p>"


def test_text_beside_and_inside_an_article_is_scored():
    tile = "<article><p>The man of the house and the dog went to the sea for the day, and it was good.</p></article>"
    assert PARAGRAPH in html_text.main_text(f"<body><div><p>{PARAGRAPH}</p></div>{tile}</body>")
    page = f"<article><p>{PARAGRAPH}</p>{LINKS}<p>{NAMES}</p>{LINKS}</article>"
    assert html_text.main_text(page) == PARAGRAPH
    # Beside running text, and where no text has function words, names stay.
    assert html_text.main_text(f"<div><p>{PARAGRAPH}</p><p>{NAMES}</p></div>") == f"{PARAGRAPH} {NAMES}"
    assert html_text.main_text(f"<article>{LINKS}<p>{NAMES}</p></article>") == NAMES


@pytest.mark.parametrize(
    "before",
    [
        "<select><option>Deutsch<option>English</select>",
        "<select><option>Deutsch<optgroup label=x><option>English</select>",
        "<div><select><option>Deutsch<option>English</div>",
        "<form><select><option>Deutsch</option><option>English</select></form>",
        "<embed src=x>",
        "<map name=x>",
        "<object data=x>",
        "<svg><g><svg></svg></g><text>no</text></svg>",
    ],
)
def test_tags_left_open_lose_no_text(before):
    after = "<select><option>One</option></select>"
    page = f"<body>{before}<article><p>{PARAGRAPH}</p>{after}<p>{PARAGRAPH}</p></article></body>"
    assert html_text.main_text(page) == f"{PARAGRAPH} {PARAGRAPH}"


@pytest.mark.parametrize(
    "tag",
    [
        "div class='content has-sidebar'",
        "div class='layout no-sidebar'",
        "div class='page-with-toc'",
        "div class='post tags-news'",
        "div id='print-area'",
        "div class='layout sidebar'",
        "div style='overflow: hidden'",
        "form action=x",
    ],
)
def test_marks_around_the_main_text_do_not_count(tag):
    end = f"</{tag.split()[0]}>"
    side = f"<div class='sidebar'><p>{PARAGRAPH}</p></div><div class='site-footer'><p>{PARAGRAPH}</p></div>"
    comments = f"<div id=comments>{f'<article><p>{PARAGRAPH} No.</p></article>' * 9}</div>"
    text = f"<p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p>"
    wanted = " ".join([PARAGRAPH] * 3)
    for inner in (f"<article>{text}</article>", f"<main>{text}</main>", f"<div>{text}</div>"):
        assert html_text.main_text(f"<body><{tag}>{inner}{end}{side}{comments}</body>") == wanted
        assert html_text.main_text(f"<body><{tag}>{side}{inner}{comments}{end}</body>") == wanted


def test_captions_and_formulas_stay():
    page = f"<article><p>{PARAGRAPH}</p><figure><figcaption>The mill.</figcaption></figure><p>So <math><mi>x</mi></math> is.</p></article>"
    assert html_text.main_text(page) == f"{PARAGRAPH} The mill. So x is."


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- open", "<script>x", "</p></p>", "<a href='>'>", "&#0;&bogus;"])
def test_broken_pages(page):
    assert isinstance(html_text.main_text(page), str)


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>same</p>"
    rows = [(5, "u", same), (3, "http://x/ä b\r\n", same), (9, None, same), (1, "u", None), (2, "u", ""), (7, "u", PAGE)]
    rows += [(None, "u", same), (8, "u", "x" * 300_000), (8, "u", "x" * 300_000), (10, "u", "x" * 300_000)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")


def test_pages_extracted(pages):
    rows = html_text.extracted(pages).collect()
    assert len(rows) == 10
    by = {r.page_id: r for r in rows}
    assert by[1].text == "" and by[1].n_chars == 0 and by[7].n_chars == len(by[7].text)
    assert html_text.extracted(pages.limit(0)).collect() == []


def test_archives(pages):
    rows = warc.archived(pages).collect()
    assert len(rows) == 10
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows)
    assert kinds == [
        (0, "response", None),
        (1, "response", None),
        (2, "revisit", 1),
        (3, "response", None),
        (5, "revisit", 3),
        (7, "response", None),
        (8, "response", None),
        (8, "response", None),
        (9, "revisit", 3),
        (10, "revisit", 8),
    ]
    body = b"<p>same</p>"
    nine = next(r for r in rows if r.page_id == 9)
    assert nine.payload_bytes == len(body)
    assert nine.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
    assert warc.archived(pages.limit(0)).collect() == []


def test_archive_bytes():
    big = b"y" * (1 << 24)
    records = [warc.record(1, "u", b"abc", None), warc.record(2, "u", big, None), warc.record(3, None, b"abc", 1)]
    data = b"".join(warc.member(r) for r in records)
    chunks = [data[i : i + 7] for i in range(0, 3000, 7)] + [data[3003:]]
    found = [x for x in warc.members(chunks) if x]
    assert found == records
    assert [warc.parsed_page(*warc.parse(x))[0] for x in found] == [1, 2, 3]
    with pytest.raises(ValueError):
        list(warc.members([data[:-4]]))
    with pytest.raises(ValueError):
        warc.parse(records[0].replace(b"abc", b"abd"))


def test_archives_made_elsewhere(spark, tmp_path):
    def foreign(kind, block, *extra):
        head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", *extra, f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    made = [
        foreign("warcinfo", b"software: x\r\n"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n"),
        foreign("response", http + b"<p>page", "WARC-Payload-Digest: md5:0"),
        foreign("response", b"DNS answer"),
        foreign("metadata", b""),
        foreign("revisit", http, "WARC-Refers-To: <urn:uuid:0>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(warc.member(x) for x in made))
    rows = [tuple(r) for r in warc.read_archives(spark, str(tmp_path), files="*.warc.gz").collect()]
    assert rows == [(None, 7, warc.digest_text(b"<p>page"), "response", None, bytearray(b"<p>page")), (None, None, None, "revisit", None, None)]
    (tmp_path / "b.warc.gz").write_bytes(warc.member(foreign("response", http + b"x", f"WARC-Payload-Digest: sha1:{warc.digest_text(b'y')}")))
    with pytest.raises(Exception, match="payload's digest"):
        warc.read_archives(spark, str(tmp_path), files="b*").collect()


def test_vectors_by_brute_force(spark):
    draw = random.Random(8)
    rows = []
    for i in range(300):
        if i % 3 and i > 10:
            base = rows[draw.randrange(len(rows))][1]
            rows.append((i, [x + draw.gauss(0, 0.03) * (i % 5 > 0) for x in base], draw.choice([1, 1, 2])))
        else:
            rows.append((i, [draw.gauss(0, 1) for _ in range(24)], draw.choice([1, 2])))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [nan] * 24, [inf] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [(300 + k, v, 1) for k, v in enumerate(odd)]
    rows += [(310, rows[0][1], None), (None, rows[0][1], 1), (311, [0.5, 0.5], 1), (312, [0.5, 0.5], 1), (313, [-0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    def usable(row):
        i, v, label = row
        return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [r for r in rows if usable(r)]
    near = {r[0]: [] for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98:
                near[a[0]].append(b[0])
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    assert len(found) == len(rows)
    truth = sum(map(len, near.values()))
    assert truth > 100
    assert sum(r.n_links for r in found.values()) >= 0.99 * truth
    assert all(r.n_links <= len(near[i]) for i, r in found.items())
    assert all(found[300 + k].n_links == 0 and found[300 + k].kept for k in range(len(odd)))
    assert found[312].component_id == 311 and found[None].component_id is None
    assert embedding_dedup.near_duplicates(frame.limit(0)).collect() == []


def test_an_id_with_several_vectors(spark):
    a, b, c = ([float(k == at) for k in range(8)] for at in range(3))
    rows = [(1, a, 1), (1, b, 1), (2, a, 1), (3, c, 1), (4, b, 2), (5, b, 1), (5, b, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in embedding_dedup.near_duplicates(frame).collect())
    assert found == sorted([(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 2, 1, False), (5, 2, 1, False)])


def test_planted_links_of_many_vectors(spark, monkeypatch):
    """Pairs planted at cosines of 0.98 to 0.99 among 4000 vectors, and a class of a third of the rows."""
    monkeypatch.setattr(embedding_dedup, "LARGE", 100)
    draw = np.random.default_rng(5)
    base = draw.standard_normal((3000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = draw.standard_normal((1000, 32))
    away -= (away * base[:1000]).sum(axis=1, keepdims=True) * base[:1000]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = draw.uniform(0.9801, 0.99, (1000, 1))
    near = cosine * base[:1000] + np.sqrt(1 - cosine**2) * away
    vectors = np.vstack([base, near])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)] + [(10_000 + k, base[2999].tolist(), 1) for k in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(8)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    want = vectors @ vectors.T >= 0.98
    np.fill_diagonal(want, False)
    links = want.sum(axis=1) + np.where(np.arange(4000) == 2999, 2000, 0)
    got = np.array([found[i].n_links for i in range(4000)])
    assert links[:2999].sum() >= 1000 and (got <= links).all()
    assert got[:2999].sum() >= 0.995 * links[:2999].sum()
    assert got[2999] == 2000 and {found[10_000 + k].component_id for k in range(2000)} == {2999}


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + k) for k in range(300)]
    frame = spark.createDataFrame([*chain, *star, (5, 5), (3, 2)], "a long, b long")
    rows = connected(frame, Work(spark, "test"), "x").collect()
    assert all(r.component_id == (0 if r.node < 1000 else 1000) for r in rows)
    assert len(rows) == 201 + 300
    assert connected(frame.limit(0), Work(spark, "test"), "y").collect() == []
