"""Main texts of pages against what their templates put in."""

import html
import math
import random
import re
import time

import pytest

from lexweave.llm import html_text


def article(page):
    """The text of the driver's template, by its own tags."""
    inner = re.sub(r"</?b>", "", page[page.index("<article>") + 9 : page.index("</article>")])
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in re.split(r"</?(?:h1|p|br)>", inner)) if x)


def test_driver_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = html_text.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


MENU = '<nav><a href="/">Home</a> <a href="/b">Blog</a></nav>'
BODY = "<h1>A &amp; B</h1><p>The first   paragraph is long enough\nto count as text.</p><p>The second has <a href='x'>a link</a> and <em>stress</em>.</p>"
TEXT = "A & B\nThe first paragraph is long enough to count as text.\nThe second has a link and stress."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body>{MENU}<main>{BODY}</main><footer>&copy; us</footer></body>", TEXT),
        (f'<html><head><title>T</title></head><body><div id="page"><div class="sidebar"><p>Popular stories of the week and more</p></div><div class="post">{BODY}</div></div></body></html>', TEXT),
        (f'<body><header><h1>Site</h1></header><article><header><h1>A &amp; B</h1></header>{BODY[18:]}</article><div id="comments"><p>I agree with all of this very much indeed.</p></div>', TEXT),
        (f'<div class="cookie-notice">We use cookies to serve you better.</div><article>{BODY}</article><form><p>Subscribe to our letter</p><input></form>', TEXT),
        (f"<article>{BODY}<script>var a = '<p>no</p>';</script><style>p{{}}</style></article>", TEXT),
        (f'<article>{BODY}<aside>Aside words</aside><div class="ad">Buy now</div></article>', TEXT),
        ("<p>a<p>b<div><span>c</span> d</div>", "a\nb\nc d"),
        ("plain text &lt;only&gt;", "plain text <only>"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one\ntwo\nx\ny"),
        ("<article><p>3 < 4 and 5 > 2</p></article>", "3 < 4 and 5 > 2"),
        ("<article><p>cut off <a href='x", "cut off"),
        ("<!-- only a comment -->", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    long = "word " * 100_000
    assert html_text.main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_rows(spark):
    rows = [(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, "t")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)], key=str)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_unequal_sections_without_article():
    """Every dense section is text, however small beside the greatest; menus stay out."""
    few = [f"few {i} " + "word " * 199 for i in range(4)]
    many = [f"many {i} " + "word " * 99 for i in range(40)]
    section = lambda texts: "<div>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>"
    links = "<div>" + "".join(f'<a href="/{i}">Another story of the day</a> ' for i in range(9)) + "</div>"
    got = html_text.main_text(f"<body>{links}{section(few)}{section(many)}</body>")
    assert got == "\n".join(t.strip() for t in [*few, *many])


@pytest.mark.parametrize("names", ["post has-sidebar", "hentry comments-open", "no-sidebar", "page-layout with-menu"])
def test_wrappers_that_only_mention_a_sidebar(names):
    assert html_text.main_text(f'<body>{MENU}<div class="{names}">{BODY}</div><div class="site-footer">By us all</div></body>') == TEXT


@pytest.mark.parametrize("wrapper", ['<form id="all">{}</form>', '<div class="sidebar">{}</div>', '<div class="menu"><main>{}</main></div>', "<aside>{}</aside>", '<div role="dialog">{}</div>'])
def test_nothing_empties_a_page(wrapper):
    assert html_text.main_text("<body>" + wrapper.format(BODY) + "</body>") == TEXT


def test_heading_beside_the_text_and_menus_in_it():
    title, text = "<h1>A &amp; B</h1>", BODY[18:]
    assert html_text.main_text(f"<body>{MENU}{title}<div>{text}</div></body>") == TEXT
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Story {i}</a></li>" for i in range(5)) + "</ul>"
    assert html_text.main_text(f"<body>{MENU}<main>{BODY}<h2>You may also like</h2>{links}</main></body>") == TEXT
    assert html_text.main_text(f"<article>{BODY}<ul><li>one <a href='x'>two</a></li><li>three</li></ul></article>") == TEXT + "\none two\nthree"


def stripped(page, tags):
    return re.sub(r' (?:class|id|role)="[^"]*"', "", re.sub(rf"<(/?)(?:{tags})\b", r"<\1div", page))


@pytest.mark.parametrize("tags", ["article|main", "article|main|nav|header|footer|aside|section"])
def test_density_alone_finds_the_article(spark, tags):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    same = [html_text.main_text(stripped(p, tags)) == article(p) for p in pages]
    assert sum(same) >= 0.99 * len(pages)


@pytest.mark.parametrize("piece, end", [("<a ", '">"'), ("<a \"> '", ""), ("<a '>'", ""), ("<b>", "</i>" * 200_000), ("<b><p>", ""), ("<i><div>", "</i>" * 100_000), ('<p class="', ""), ("<!", ""), ("<p", ">x"), ("<h2>x</h2><div>y</div>", "")])
def test_time_grows_with_length(piece, end):
    begun = time.perf_counter()
    html_text.main_text(piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - begun < 20


def brute(page):
    """Greatest sum of child densities by plain recursion: (tag, own text) of the node and the threshold on its path."""
    root = html_text.parse(page)

    def below(node):
        return [x for c in node.nodes() for x in [c, *below(c)]]

    def text(node):
        return "".join(html.unescape(c if isinstance(c, str) else "" if c.skip else text(c)) for c in node.children)

    def size(node):
        return len("".join(text(node).split()))

    def linked(node):
        return size(node) if node.tag == "a" else sum(linked(c) for c in node.nodes())

    share = linked(root) / size(root) if size(root) else 0.0

    def dense(node):
        c, t, lc, lt = size(node), len(below(node)), linked(node), sum(x.tag == "a" for x in below(node))
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / max(t, 1) * math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)) / base

    def total(node):
        return math.fsum(map(dense, node.nodes())) if node.nodes() else dense(node)

    every = [root, *below(root)]
    return every, [dense(n) for n in every], [total(n) for n in every]


def test_densities_by_plain_recursion():
    rng = random.Random(4)
    for _ in range(150):
        page = "".join(rng.choice(["<div>", "</div>", "<p>", "</p>", "<a>", "</a>", "<li>", "word and ", "some longer words here ", "x", "&amp;", "<br>", "<b>", "</b>"]) for _ in range(rng.randrange(60)))
        nodes, densities, sums = brute(page)
        root = html_text.parse(page)
        html_text._measure(root)
        ours = html_text._ordered(root)
        assert [n.tag for n in ours] == [n.tag for n in nodes]
        assert [n.density for n in ours] == pytest.approx(densities) and [n.sum for n in ours] == pytest.approx(sums)
        assert root.best.sum == pytest.approx(max(sums))
