"""Malformed pages, the time a page takes, and the style tree against its formulas."""

import math
import time
from collections import Counter

import pytest

from seriesprep.llm import html_extract


# --------------------------------------------------------------------- malformed pages and the style tree
@pytest.mark.parametrize(
    "source, text",
    [
        ("<p title=it's>Hello it's me</p><p>two</p>", "Hello it's me\ntwo"),
        ("<article><p>a</p><img alt=don't src=x><p>body text isn't lost</p></article>", "a\nbody text isn't lost"),
        ("<script src=/x/>var leaked=1;</script><p>t</p>", "t"),
        ('<div class="main-content post"><p>body</p></div><article class="teaser"><p>small</p></article>', "body\nsmall"),
        ('<p a="x"b=\'y>\'c = "<p>" d=>z</p =q>', "z"),
        ("<p>1 < 2 <3 </> <?php x ?> <!x> y <!-- <p> -> --> z <!--> w", "1 < 2 <3 y z w"),
        ("<p>x<svg/>y</p><svg><path d='x'/><p>out</p>", "x y".replace(" ", "") + "\nout"),
        ("<p>a<object><p>no</object> b<p>c<select><option>n</select>d", "a b\ncd"),
        ("<title>x <b> y</title><p>&am<b>p;</b> &lt;b&gt; &#x41;&copy2", "&amp; <b> A©2"),
        ("<p>one<script>if (a</script/x>b) two</p", "oneb) two</p"),
        ("<p>a <b c=\"d>e <i>f</i>", "a e f"),
    ],
)
def test_marks_as_the_standard_reads_them(source, text):
    assert html_extract.Page(source).text() == text


@pytest.mark.parametrize("part", ["<a '", '<a b="', "<", "<!", "</p", "<div>", "<b>", "<div class='q'><p>x", "<script>", "<svg>", "</b>", "&", "<li><ul>", '<a b=\'"x>', "<!--"])
def test_time_is_linear_in_the_page(part):
    source = "<p>" + part * (1_000_000 // len(part))
    began = time.process_time()
    html_extract.Page(source).text()
    assert time.process_time() - began < 8  # about 1 s; quadratic time would take hours


def test_deep_and_long_marks_keep_their_text():
    deep = "".join(f"<div class='{'n' * 300}{i}'>t{i} " for i in range(2000))
    page = html_extract.Page(deep)
    assert page.text() == "\n".join(f"t{i}" for i in range(2000))
    assert max(len(path) for path, *_ in page.blocks) < 100 * html_extract.TREE_DEPTH


def brute_importance(pages):
    """The formulas of the module's docstring over lists: ``(host, path) -> importance``."""
    sites = {}
    for url, source in {(u, s) for _, u, s in pages}:  # copies count once
        sites.setdefault(url.split("/")[2], []).append(html_extract.Page(source))
    own, sizes = {}, {}
    for site, parsed in sites.items():
        m = sizes[site] = len(parsed)
        blocks, looks = Counter(), Counter()
        for page in parsed:
            blocks.update({(path, text) for path, _, noise, text in page.blocks if not noise})
            looks.update(set(page.children))
        nodes = {path[: i if i >= 0 else None] for path, _ in blocks for i in [j for j, c in enumerate(path) if c == ">" and j] + [-1]} - {""}
        for node in nodes:
            below = [n for (path, _), n in blocks.items() if path == node or path.startswith(node + ">")]
            faces = [n for (path, _), n in looks.items() if path == node]
            shown = sum(faces)
            entropy = -sum(n / shown * math.log(n / shown) for n in faces) / math.log(shown) if shown > 1 else 0.0
            content = 1 - sum(n * math.log(n) for n in below) / sum(below) / math.log(m) if m > 1 else None
            own[site, node] = None if m == 1 else (1 - html_extract.DAMP) * entropy + html_extract.DAMP * content
    result = {}
    for (site, node), value in own.items():
        said = [v for (_, path), v in own.items() if path == node and v is not None]
        named = any(c in node.split(">")[-1] for c in ".#")
        prior = (sum(said) + html_extract.PRIOR_HOSTS) / (len(said) + html_extract.PRIOR_HOSTS) if named else 1.0
        m = 0 if value is None else sizes[site]
        result[site, node] = (m * (value or 0.0) + html_extract.PRIOR_PAGES * prior) / (m + html_extract.PRIOR_PAGES)
    return result


def site_pages():
    """Twelve hosts of one layout whose notice and list differ in content only, one host with one page, and one with another layout."""
    def layout(i, site):
        return (
            f"<html><body><div class='top'><p>Welcome to site {site}</p></div><div id='post-{i}'><h1>Title {i} {site}</h1><p>Story {i} of {site}</p>"
            f"<p>Shared words</p></div><div class='low'><p>{'All rights' if i % 2 else 'Our rights'} of {site}</p></div></body></html>"
        )

    pages = [(100 * site + i, f"http://h{site}.example/{i}", layout(i, site)) for site in range(12) for i in range(20 if site else 40)]
    pages.append((5000, "http://single.example/x", layout(7, 99)))
    pages += [(6000 + i, f"http://other.example/{i}", f"<body><div class='text'><p>Tale {i}</p></div></body>") for i in range(3)]
    return pages + [(7000, *pages[0][1:])]


def test_importance_is_that_of_the_formulas(spark):
    pages = site_pages()
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)
    got = {(r["host"], r["path"]): r["importance"] for r in html_extract.importance(html_extract.style_tree(table)).collect()}
    expected = brute_importance(pages)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in expected)


def test_only_the_style_tree_tells_boilerplate_from_body(spark):
    pages = site_pages()
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(table).collect()}
    for site in range(12):
        for i in range(20):  # numbered ids are one node of the tree; a paragraph that the node repeats stays with it
            assert got[100 * site + i] == f"Title {i} {site}\nStory {i} of {site}\nShared words"
    assert got[5000] == "Title 7 99\nStory 7 of 99\nShared words"  # one page: by what the named branches are on other hosts
    assert [got[6000 + i] for i in range(3)] == ["Tale 0", "Tale 1", "Tale 2"]
    assert got[7000] == got[0]


def test_text_outside_a_main_element_needs_more_importance(spark):
    source = "<body><div class='lead'><p>Lead {0}</p></div><div class='tail'><p>Part {1}</p></div>{2}</body>"
    article = "<article><p>Story {0}</p></article>"
    rows = [(i, f"http://a.example/{i}", source.format(i, i // 6, article.format(i))) for i in range(40)]
    rows += [(100 + i, f"http://b.example/{i}", source.format(i, i // 6, f"<p>Story {i}</p>")) for i in range(40)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(table).collect()}
    assert all(got[i] == f"Lead {i}\nStory {i}" for i in range(40))
    assert all(got[100 + i] == f"Lead {i}\nPart {i // 6}\nStory {i}" for i in range(40))
