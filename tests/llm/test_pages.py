"""Main text of pages."""

import random
import time
from xml.etree import ElementTree

from pyspark.sql import Row

from txflow.llm.extraction import extract_pages, main_text

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body class="no-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies, really, a lot of them, as everybody else does.</div>
<main><article><h1>Title &amp; more</h1><p>First  paragraph,\n with <b>bold</b>, commas, and&nbsp;<a href=x>one link</a>.<p>Second one<br>goes on
<section><p>Third, in a section.</section><ul><li>item one<li>item two</ul><div class="advert">Buy now, cheap, today.</div>
<form><label>Mail</label><input></form><p>&lt;tag&gt; caf&eacute; &#x2014; end</p></article>
<aside>Aside, with, many, commas, to, win, points, for, nothing, at, all.</aside>
<div id="comments"><p>First comment, which is long, has commas, and says nothing new about it at all.</div></main>
<footer>&copy; us</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title & more",
        "First paragraph, with bold, commas, and one link.",
        "Second one goes on",
        "Third, in a section.",
        "item one",
        "item two",
        "<tag> café — end",
    ]


def test_containers_without_article_are_found_by_score():
    page = (
        '<body><div class="menu"><a>Home</a> <a>Away</a></div><div><p>' + "Long text, with commas, here. " * 9 + "</p><p>"
        + "And more, of it, there. " * 9 + '</p></div><div><a href="1">link one</a> <a href="2">link two</a></div></body>'
    )
    assert main_text(page).count("\n") == 1 and "link one" not in main_text(page) and "Home" not in main_text(page)


def test_broken_and_empty_pages():
    assert [main_text(x) for x in (None, "", "<p>", "<script>only", "<!-- cut", "<nav>menu</nav>")] == [""] * 6
    assert main_text("just text &amp") == "just text &"
    assert main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert len(main_text("<article>" + "<p>some words, here</p>" * 20_000)) == 20_000 * 17 - 1


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t"), (None, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(extract_pages(pages).collect(), key=repr)
    assert len(got) == 4 and sum(r.text != "" for r in got) == 2
    assert Row(page_id=2, url=None, text="") in got
    assert extract_pages(pages.limit(0)).collect() == []


LONG_P = "A paragraph of the article, with commas, and a good deal of words in it, so it counts. " * 2
P = f"<p>{LONG_P}</p>"


def kept(page):
    return [x if x != LONG_P.strip() else "P" for x in main_text(page).split("\n")]


def test_names_do_not_delete_the_article():
    assert kept(f"<div class='content-with-sidebar'><h1>T</h1>{P}{P}</div>") == ["T", "P", "P"]
    assert kept(f"<div class='widget'>{P}{P}</div>") == ["P", "P"]
    assert kept(f"<div id='page-menu'><nav>{P}</nav><article>{P}</article></div>") == ["P"]
    assert kept(f"<article>{P}<div class='legal-text'>{P}</div><section id='discussion'>{P}</section></article>") == ["P"] * 3
    # What the names mean in earnest still goes.
    assert kept(f"<article>{P}<div class='comments'>{P}</div><div class='advert'>{P}</div><div class='legal'>(c) us</div></article>") == ["P"]
    assert kept(f"<body><div class=comments>{P * 5}</div><div>{P}</div></body>") == ["P"]
    assert kept(f"<article>{P}<form class='widget'>{P}</form><div hidden class=widget>{P}</div></article>") == ["P"]


def test_short_blocks_beside_the_best_container_stay():
    assert kept(f"<body><nav>x</nav><h1>Head</h1><p>Short one.</p><div>{P}{P}{P}</div><p>{'a, ' * 40}</p></body>")[:3] == ["Head", "Short one.", "P"]
    between = kept(f"<body><div>{P}{P}</div><h2>Next</h2><p>Short.</p><div>{P}{P}</div></body>")
    assert between == ["P", "P", "Next", "Short.", "P", "P"]


def test_a_list_of_sources_stays_in_an_article():
    links = "<ul><li><a href=a>Source one</a><li><a href=b>Source two</a></ul>"
    assert kept(f"<article>{P}<h2>Sources</h2>{links}</article>") == ["P", "Sources", "Source one", "Source two"]
    assert kept(f"<article>{links}{P}</article>") == ["P"]
    assert kept(f"<body>{links}<div>{P}{P}</div></body>") == ["P", "P"]


def test_unclosed_elements_take_linear_time():
    begun = time.perf_counter()
    for name in ("svg", "noscript", "select", "object"):
        assert main_text(f"<{name}>" * 40_000 + "<p>left</p>") == "left"
    assert time.perf_counter() - begun < 4


def scored_again(page):
    """The points of all containers of well-formed pages, added up from below."""
    points, chars = {}, {}

    def walk(node, path):
        own = node.text or ""
        for child in node:
            own += child.tail or ""
            walk(child, [*path, child])
        text = " ".join(own.split())
        if text and node.tag in ("p", "div", "section"):
            gain = 1 + text.count(",") + min(len(text) / 100, 3.0)
            for level, up in enumerate(reversed(path)):
                chars[up] = chars.get(up, 0) + len(text)
                share = (0 if node.tag == "p" else 1) if level == 0 else 1 / (1 if level == 1 else 2 if level == 2 else 3 * level)
                points[up] = points.get(up, 0) + gain * share

    root = ElementTree.fromstring(page)
    walk(root, [root])
    return max(points, key=points.get)


def test_the_best_container_is_that_of_a_plain_computation():
    rng = random.Random(3)

    def tree(depth):
        if depth == 0 or rng.random() < 0.4:
            return f"<p>{' '.join(rng.choice(['word,', 'word', 'longer']) for _ in range(rng.randint(1, 60)))}</p>"
        return "<div>" + "".join(tree(depth - 1) for _ in range(rng.randint(1, 4))) + "</div>"

    for _ in range(60):
        page = "<body>" + "".join(tree(3) for _ in range(rng.randint(1, 4))) + "</body>"
        best = scored_again(page)
        want = [" ".join(p.text.split()) for p in (best.iter("p") if best.tag != "p" else [best])]
        got = main_text(page).split("\n")
        # The best container is there as a whole, in order; like siblings may stand around it.
        assert any(got[i : i + len(want)] == want for i in range(len(got))), page
