"""Wrappers of hosts: expressions, alignment, and main texts against a plain reader."""

import html
import json
import random
import re

import pytest

from reelgrove.llm import wrappers as w
from reelgrove.llm.queries import QUERIES


def wrapper(*pages):
    out = None
    for p in pages:
        one = w.general(w.parsed(p))
        out = one if out is None else w.merged(out, one)
    return out


def text(page, *others):
    return w.read(w.parsed(page), w.mark(wrapper(*(others or (page,)), page)))


def blocks_of_article(page):
    """The article of the given tables' pages, cut at block tags by patterns alone."""
    found = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page or "", re.S)
    if not found:
        return []
    parts = re.split(r"</?(?:p|h1|br)>", found[1])
    plain = [html.unescape(re.sub(r"</?(?:b|a)(?: [^>]*)?>", "", x)) for x in parts]
    return [" ".join(x.split()) for x in plain if x.split()]


def test_mismatches_become_slots_optional_and_repeated_groups():
    one = "<body><h1>A</h1><ul><li>x</li></ul><p>same</p></body>"
    two = "<body><h1>B</h1><h2>sub</h2><ul><li>x<li>y<li>z</ul><p>same</p></body>"
    expected = "<body> <h1> # </h1> ( <h2> # </h2> )? <ul> ( <li> # </li> )+ </ul> <p> # </p> </body>"
    assert w.expression(wrapper(one, two)) == w.expression(wrapper(two, one)) == expected
    slots = [e for e in w._all(wrapper(one, two)) if e.label == "#"]
    assert [s.held is None for s in slots] == [True, False, True, False]
    assert w.expression(w.unpacked(json.loads(json.dumps(w.packed(wrapper(one, two)))))) == expected


def test_groups_of_several_elements_repeat():
    assert w.expression(wrapper("<dl><dt>a<dd>b<dt>c<dd>d</dl>")) == "<dl> ( <dt> # </dt> <dd> # </dd> )+ </dl>"
    assert w.expression(wrapper("<body>" + "<h2>a</h2><p>b</p><p>c</p>" * 3 + "</body>")) == (
        "<body> ( <h2> # </h2> ( <p> # </p> )+ )+ </body>"
    )


def test_wrappers_stay_small_however_the_pages_are_built():
    rng = random.Random(7)
    flat = ["<body>" + "".join(f"<{t}>x</{t}>" for t in rng.choices(["p", "h2", "ul", "pre", "table", "dl"], k=400)) for _ in range(20)]
    nested = ["<body>" + "".join(f"<{t}>x" for t in rng.choices(["p", "h2", "ul", "pre", "dl"], k=400)) for _ in range(20)]
    assert sum(1 for _ in w._all(wrapper(*flat))) < 60
    assert all(text(p, *flat) == ["x"] * 400 for p in flat)
    assert all(len(text(p, *nested)) == 400 for p in nested)


def test_texts_below_a_trimmed_wrapper_are_read(monkeypatch):
    monkeypatch.setattr(w, "LARGEST", 6)
    pages = [f"<body><article><div><div><h2>a</h2><p>b</p><nav>n</nav><ul><li>{i}</ul></div></div></article></body>" for i in range(3)]
    small = w.trimmed(wrapper(*pages))
    assert sum(1 for _ in w._all(small)) <= 6
    assert w.read(w.parsed(pages[2]), w.mark(small)) == ["a", "b", "2"]


@pytest.mark.parametrize(
    "part",
    [
        "<nav><a>menu</a></nav>", "<header><h2>site</h2></header>", "<footer>foot</footer>", "<aside>side</aside>",
        '<div class="sidebar">side</div>', '<div id="cookie-notice">we use</div>', '<p class="ad">buy</p>',
        "<form><p>your name</p><input value=x></form>", "<script>if (a < b) '</p>'</script>", "<style>p{}</style>",
        '<section class="comments"><p>first!</p></section>', '<article class="comment"><p>me too</p></article>',
        '<ul class="related"><li>more</li></ul>', "<!-- <p>old</p> -->", '<div style="display: none">hidden</div>',
        "<select><option>one<option>two</select>", "<noscript>enable it</noscript>", "<button>go</button>",
        '<div class=adBox><div><p>deep</p></div></div>', '<div role="navigation">x</div>',
    ],
)
@pytest.mark.parametrize("place", ["before", "inside", "after"])
def test_what_is_no_article_stays_out(part, place):
    page = {
        "before": f"<body>{part}<article><h1>T</h1><p>one</p><p>two</p></article></body>",
        "inside": f"<body><article><h1>T</h1><p>one</p>{part}<p>two</p></article></body>",
        "after": f"<body><article><h1>T</h1><p>one</p><p>two</article>{part}</body>",
    }[place]
    if place == "inside" and part.startswith("<header"):
        return  # a heading block of the article itself
    assert text(page) == ["T", "one", "two"]


def test_references_white_space_and_inline_markup():
    page = "<article><p> a&amp;b &lt;i&gt; &eacute;&#233;&#x4e2d;\n\t<b>bo</b>ld&nbsp;x<br>y <i>z<p>&copy 1 < 2 &am</article>"
    assert text(page) == ["a&b <i> éé中 bold x y z", "© 1 < 2 &am"]
    assert text("<article>bare<p>in</p>tail<hr>end") == ["bare", "in", "tail", "end"]


def test_pages_without_an_article():
    pages = [
        f"<body><div><ul><li>home<li>news</ul></div><div><p>text {i} is long enough</p><p>more words {i}</p></div><div>imprint</div></body>"
        for i in range(5)
    ]
    assert text(pages[0], *pages) == ["text 0 is long enough", "more words 0"]
    assert text("just words") == ["just words"] and text("") == []
    assert text("<main><h1>t</h1><nav>n</nav><p>x</main><p>out") == ["t", "x"]
    assert text('<div class="post-content"><p>x</p></div><div>y</div>') == ["x"]


def test_the_template_of_the_host_is_no_main_text():
    pages = [f"<body><div>Welcome to our site, dear reader<p>story number {i} told at length</p></div></body>" for i in range(4)]
    assert text(pages[1], *pages) == ["story number 1 told at length"]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<div>" * 5000 + "<article><p>x" + "</div>" * 5000, ["x"]),
        ("<div>" * 300 + "<nav>menu</nav><p>x", ["x"]),
        ("<p>" * 20_000 + "x", ["x"]),
        ("</div>" * 20_000 + "<article>x", ["x"]),
        ("<tr>" * 20_000 + "x", ["x"]),
        ("<article>" + "word " * 300_000, [" ".join(["word"] * 300_000)]),
        ('<a "' * 5_000 + "<article>x", None),
        ("<article>a\x00b퟿</article>", ["a\x00b퟿"]),
        ("<article><p>x<script>never closed <p>y", ["x"]),
        ("<!-- never closed <article>x", []),
    ],
)
def test_broken_pages(page, expected):
    found = text(page)
    assert expected is None or found == expected


def rows(spark, data):
    return spark.createDataFrame(data, "page_id bigint, url string, html string, main_text string, wrapper string, part int")


def test_odd_rows(spark):
    good = "<body><nav>m</nav><article><p>{}</p></article></body>"
    data = [
        (1, "https://a.example.com/1", good.format("one"), "old", "w", 1),
        (1, "https://a.example.com/1", good.format("one"), "old", "w", 1),
        (2, "HTTP://user@A.example.com:80/2", good.format("two"), None, None, None),
        (3, None, good.format("three"), "old", "w", 1),
        (4, "no url", good.format("four"), "old", "w", 1),
        (5, "https://a.example.com/5", None, "old", "w", 1),
        (6, "https://a.example.com/6", "", "old", "w", 1),
        (7, "https://a.example.com/7", "<p>no article here", "old", "w", 1),
        (8, "https://a.example.com/8", "<nav>m</nav><article></article><p>x", "old", "w", 1),
        (None, None, None, None, None, None),
    ]
    out = w.extract(rows(spark, data))
    assert out.columns == ["page_id", "url", "html", "wrapper", "part", "main_text"]
    found = sorted((r.page_id or 0, r.main_text, r.wrapper) for r in out.collect())
    texts = ["", "one", "one", "two", "three", "four", "", "", "no article here", ""]
    assert [t for _, t, _ in found] == texts
    assert w.extract(rows(spark, [])).count() == 0


def test_many_partial_wrappers_of_one_host(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 3)
    pages = [
        (i, "https://hot.example.com/x", f"<body><article><h1>t{i}</h1>{'<p>a</p>' * (i % 4)}{'<h2>s</h2>' if i % 7 == 0 else ''}</article></body>", None, None, None)
        for i in range(60)
    ]
    found = w.infer(rows(spark, pages).repartition(20)).collect()
    assert len(found) == 1
    built = w.unpacked(json.loads(found[0].wrapper))
    assert w.expression(built).startswith("<body> <article> <h1> # </h1> ( ")
    assert {p.label for p in built.parts[0].parts[0].parts} == {"h1", "h2", "p"}
    assert built.parts[0].parts[0].parts[0].parts[0].chars == sum(len(f"t{i}") for i in range(60))


def test_query_as_plain_patterns(spark, small):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    out = QUERIES["op12_wrappers"](spark, small).collect()
    assert sorted(r.page_id for r in out) == sorted(pages)
    for r in out:
        assert r.text == "\n\n".join(blocks_of_article(pages[r.page_id].html))
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
