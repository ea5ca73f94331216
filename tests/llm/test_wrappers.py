"""Wrappers: alignment, and main text against a plain cut of the test pages."""

from __future__ import annotations

import html
import random
import re

import pytest

from keelson.llm import wrappers
from keelson.llm.wrappers import blocks, common, content_paths, expression, extract, main_text, merge, op6_main_text, packed, page_wrapper, unpacked
from tests.conftest import TESTDATA


def alone(page):
    return main_text(page, None)


def test_repeats_options_and_slots():
    a = page_wrapper("<body><div>top</div><article><h2>a</h2><p>1</p><h2>b</h2><p>2</p></article></body>")
    b = page_wrapper("<body><div>top</div><aside>x</aside><article><h2>c</h2><p>3</p></article></body>")
    assert expression(a) == "<body><div>#</div><article>(<h2>#</h2><p>#</p>)+</article></body>"
    both = expression(merge(a, b))
    assert both.startswith("<body><div>=</div>(<aside!>#</aside>)?<article>") and both.endswith("</article></body>")
    assert content_paths(merge(a, b)) == ["/body/article/h2", "/body/article/p"]
    lists = page_wrapper("<ul><li>a<li>b<li>c</ul>")
    assert expression(lists) == "<ul>(<li>#</li>)+</ul>"


def test_page_without_article_element():
    page = """<html><head><title>T</title></head><body><header><a href=/>Home</a> Site</header><ul class="menu"><li><a>x</a><li><a>y</a></ul>
    <div id=content><h2>Title &amp; more</h2><p>First para with <a href=q>link</a> text.<p>Second&nbsp;para<br>line<div class="share">Share</div>
    <blockquote>Quote <b>x</blockquote><ul><li>one<li>two</ul><div class=comments><p>Nice!</div></div><aside>side</aside>
    <form><input><label>Mail</label></form><!-- c --><script>if(a<b)"</p>"</script><footer>f"""
    assert alone(page) == "Title & more\n\nFirst para with link text.\n\nSecond para line\n\nQuote x\n\none\n\ntwo"


def test_odd_markup():
    assert alone("<article class='post'><header><h1>A</h1></header>1 < 2 &lt; 3 <3 <p>x</p></article><p>out") == "A\n\n1 < 2 < 3 <3\n\nx"
    assert alone("<main><p hidden>h</p><p>a\n b</p><div class='cookie-notice'>c</div><style>p{}</style></main>") == "a b"
    for page in ("", "<", "<p", "</p>", "<!--", "<article>", "<script>", "plain text only", "<p>" * 3000 + "x", "<div>" * 300 + "deep"):
        alone(page)
    assert alone("<article><p>" + "word " * 300_000 + "</p></article>") == ("word " * 300_000).strip()


PAGES = "page_id long, url string, html string, host int, paths string"


def test_awkward_pages(spark):
    rows = [(1, "http://h/a", None), (2, None, "<article><p>x</p></article>"), (3, "http://[", ""), (None, "http://h/b", "<article>é😀 <p>y</article>"), (5, "http://h/c", "<nav>n</nav>")]
    rows += [(6, "http://h/a", "<article>t</article>")] * 2
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], PAGES)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(df).collect()), key=str)
    want = [(1, "http://h/a", "", 0), (2, None, "x", 1), (3, "http://[", "", 0), (None, "http://h/b", "é😀\n\ny", 5), (5, "http://h/c", "", 0)] + [(6, "http://h/a", "t", 1)] * 2
    assert got == sorted(want, key=str)
    assert extract(df.limit(0)).count() == 0


def test_whole_table(spark):
    sf = f"{TESTDATA}/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op6_main_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        cut = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>|<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", cut)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_end_tags_left_out():
    """Elements without text content of their own do not run on to the end of the page."""
    article = "<article><p>one</p><p>two</p></article>"
    for before in (
        "<datalist><option value=a><option value=b></datalist>", "<select><optgroup><option>a<optgroup><option>b</select>", "<form><select><option>a</form>",
        "<div><object data=x></div>", "<div><video src=x>no video</div>", "<div><template><p>t</div>", "<svg><path d='M0 0'/><g><path/></svg>", "<svg><path d='M0 0'>",
        "<header><audio><canvas></header>", "<svg/><math/>",
    ):
        assert alone(f"<body>{before}{article}<p>end</body>") == "one\n\ntwo", before
    assert alone("<article><p>a <svg><title>t</title><text>no</text></svg> b</p><select><option>x</select><p>c</article>") == "a\n\nb\n\nc"


def extracted(spark, pages):
    """Texts of (url, html) by the whole operator, in the given order."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    return [r.text for r in sorted(extract(df).collect(), key=lambda r: r.page_id)]


ARTICLE = "<article><h1>Head</h1><p>one</p><p class='social-policy'>two</p><p class='side-effects alert-level'>three</p></article>"


def test_class_names(spark):
    """Names of states and of layouts do not mark an element, names of parts do."""
    fine = ["page no-sidebar", "layout has-header has-footer", "menu-closed", "is-nav-open", "with-sidebar", "without-comments", "sidebar-hide", "cookies-off", "socialism", "padded", "adventure", "headline", "cookie-recipe", "content-sidebar-wrap"]
    pages = [("http://h/", f"<body class='{c}'><div class='{c}' id='{c}'>{ARTICLE}</div></body>") for c in fine]
    marked = ["sidebar", "site-footer", "comment-list", "cookie-banner", "share-buttons", "related-posts", "main-nav", "ad", "top-ad", "newsletter-box", "breadcrumbs", "widget-area", "no-js social", "cookie-law-info", "gdpr-consent"]
    pages += [(f"http://g{i}/", f"<body><div class='x {c}'><p>beside it</p></div>{ARTICLE}<div id='{c}'>more</div></body>") for i, c in enumerate(marked)]
    assert extracted(spark, pages) == ["Head\n\none\n\ntwo\n\nthree"] * len(pages)


def test_marked_element_that_holds_the_article(spark):
    teaser = "<aside><article><p>teaser</p></article></aside>"
    pages = [
        ("http://a/", "<div class='sidebar'><p>a</p><article><p>the whole long text of the article</p></article></div><p>end</p>"),
        ("http://b/", "<form id='form'><nav>menu</nav><main><p>the whole long text</p></main></form>"),
        ("http://c/", f"<div id=content><p>a long text that is not in any article element at all</p><p>and more of it</p></div>{teaser}"),
        ("http://d/", f"{ARTICLE}{teaser}"),
        ("http://e/", "<div class='menu'><main><p>left open, the text goes on and on"),
    ]
    want = ["the whole long text of the article", "the whole long text", "a long text that is not in any article element at all\n\nand more of it", "Head\n\none\n\ntwo\n\nthree", "left open, the text goes on and on"]
    assert extracted(spark, pages) == want


def test_deep_pages_do_not_fail_a_job(spark):
    deep = [("http://deep/", "<div>" * n + "<p>deep text</p>" + "</div>" * n) for n in (350, 1000, 5000, 100_000)]
    deep += [("http://other/", "<article>" + "<section><p>x</p>" * 3000), ("http://other/", "<article>" + "<section><p>y</p>" * 2000)]
    got = extracted(spark, deep)
    assert got[:4] == ["deep text"] * 4 and got[4] == "\n\n".join("x" * 3000) and got[5] == "\n\n".join("y" * 2000)


def host_page(i, r):
    """A page of a host without article or main, and its text: slots between template paragraphs, an optional one, a repeated one, linked lists."""
    words = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    title, first, date = words(4), words(30), words(2)
    body = [words(25) for _ in range(r.randrange(2, 6))]
    quote = words(12) if i % 3 == 0 else None
    page = f"""<html><body class="no-sidebar"><div class=top><a href=/>Home</a> <a href=/x>Contact</a></div><div class=wrap><div class="text post-{i}">
    <h1>{title}</h1><p>Written by the staff of the Daily Example</p><p>{first}</p><div class=date>{date}</div>
    {f'<blockquote>{quote}</blockquote>' if quote else ''}{''.join(f'<p>{b}' for b in body)}
    <p>Please read our guide before you write to us.</p><ul><li><a href=a>{words(3)}</a><li><a href=b>{words(3)}</a></ul></div>
    <div class=more><a href=1>{words(5)}</a><a href=2>{words(4)}</a></div></div><div class=end>All rights reserved.</div></body></html>"""
    return page, "\n\n".join([title, first, date, *([quote] if quote else []), *body])


def test_host_without_article(spark):
    """20 pages: their slots and nothing of the template."""
    r = random.Random(6)
    pages = [host_page(i, r) for i in range(20)]
    assert extracted(spark, [("http://daily/" + str(i), p) for i, (p, _) in enumerate(pages)]) == [t for _, t in pages]
    # pages that are all alike have no template to tell from text
    alike = "<body><div><p>a text of some length, the same on every page</p><p>and a second part</p></div></body>"
    assert extracted(spark, [("http://alike/", alike)] * 5) == ["a text of some length, the same on every page\n\nand a second part"] * 5


def test_matching_by_position():
    """The same path inside and outside a repeated group: the expression tells them apart."""
    a = page_wrapper("<div><p>t</p><pre>u</pre><h2>a</h2><p>1</p><h2>b</h2><p>2</p></div>")
    b = page_wrapper("<div><p>t</p><pre>v</pre><h2>c</h2><p>3</p><h2>d</h2><p>4</p><h2>e</h2><p>5</p></div>")
    both = merge(a, b)
    assert expression(both) == "<div><p>=</p><pre>#</pre>(<h2>#</h2><p>#</p>)+</div>"
    r = wrappers.Reader(wrappers.reader_text(both))
    assert r.text("<div><p>t</p><pre>w</pre><h2>x</h2><p>t</p></div>") == "w\n\nx\n\nt"  # the template text is left out in its own place only
    assert r.text("<div><p>other</p><pre>w</pre><h2>x</h2><p>6</p><h2>y</h2><p>7</p></div>") == "other\n\nw\n\nx\n\n6\n\ny\n\n7"


def test_long_lists_are_aligned_exactly(monkeypatch):
    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    r = random.Random(1)
    for rows in (1, 4, 256):
        monkeypatch.setattr(wrappers, "ROWS", rows)
        for _ in range(300):
            a, b = ([r.choice("abcd") for _ in range(r.randrange(25))] for _ in range(2))
            got = common(a, b)
            assert len(got) == longest(a, b) and all(a[i] == b[j] for i, j in got)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    a = [f"x{i}" for i in range(5000)]
    assert len(common(a, ["new", *a[:2500], "z", *a[2500:]])) == 5000  # shifted by one


def test_wrappers_round_trip():
    for page in ("", "<p>a<p>b", "<div><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></div>"):
        one = page_wrapper(page)
        assert packed(unpacked(packed(one))) == packed(one) and expression(unpacked(packed(one))) == expression(one)


@pytest.mark.parametrize("page", ["<p><a href=x>link</p><p>plain text</p>", "<div><a>link<a>second</div><p>plain text</p>"])
def test_unclosed_links_end_with_their_block(page):
    assert [(t, n) for label, t, n in blocks(page) if isinstance(t, str)][-1] == ("plain text", 0)
