import html
import re

import duckdb
from llm_data import SF, documents, llm, nothing, odd, odd_rows  # noqa: F401

from tillbook.llm import html_text
from tillbook.llm.html_text import Page


def plain_article(source):
    """Text of a generated page: what stands between the article's tags, cut at its paragraphs."""
    start = source.find("<article>") + 9
    end = source.find("</article>", start)
    body = re.sub(r"<[^>]*$", "", source[start : end if end >= 0 else len(source)])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_pages_equal_plain_reading(llm):
    rows = duckdb.connect().execute(f"select page_id, url, html from read_parquet('{SF}/pages.parquet')").fetchall()
    got = sorted(tuple(r) for r in html_text.extract(llm.read.parquet(f"{SF}/pages.parquet")).collect())
    assert got == sorted((i, u, plain_article(h), len(plain_article(h))) for i, u, h in rows)


def test_structure():
    cases = {
        "<article><h1>T</h1><p>a<p>b<ul><li>one<li>two</ul></article>": "T\n\na\n\nb\n\none\n\ntwo",
        "<body><nav>menu</nav><header>site</header><main><p>x</main><footer>f</footer>": "x",
        "<article><p>x</p><section class='comments'><p>no</p></section><form>f</form><aside>s</aside></article><p>out": "x",
        "<p>a &lt; b&nbsp;&amp; <b>bo</b>ld<br>line\n\t next</p><!-- <p>no</p> --><p>&#x41;&am</p>": "a < b & bold line next\n\nA&am",
        "<script>'<p>'</script><style>p{}</style><noscript><p>n</p></noscript><p>x</p><scr": "x",
        "<div class='with-sidebar'><article><p>x</p></article></div><div class=sidebar>s</div>": "x",
        "<table><tr><td>a<td>b<tr><td>c</table><p title='a>b'>q": "a\n\nb\n\nc\n\nq",
        "<p hidden>h</p><p style='display: none'>h</p><div role=navigation>n</div><div id=cookie-notice>c</div>t": "t",
        "<P>UP</P><DIV CLASS='AD'>x</DIV>": "UP",
        "1 < 2 and 3 > 2 <3": "1 < 2 and 3 > 2 <3",
        "<p></p>  <div> </div>": "",
        "<article><p>first</article><article><p>second</article>": "first\n\nsecond",
    }
    for source, text in cases.items():
        assert Page(source).text() == text, source


def site(i, body):
    return f"<html><body><div class=x><p>Call us today</p><p>We are open</p></div>{body}<div><a href=/>Home</a> <a href=/b>Board</a></div></body></html>"


def test_templates_go_and_quoted_paragraphs_stay(llm):
    rows = [(i, f"http://shop.example/{i}", site(i, f"<p>Page number {i} has its own text</p>")) for i in range(12)]
    rows += [(100 + i, f"https://user@News.example:80/{i}", f"<article><p>Famous words</p><p>Own {i}</p><ul><li><a href=/s>Share it</a></ul></article>") for i in range(9)]
    rows += [(200, "http://other.example/", site(0, "<p>Alone</p>"))]
    got = {r.page_id: r.text for r in html_text.extract(llm.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got[3] == "Page number 3 has its own text"
    assert got[104] == "Famous words\n\nOwn 4"
    assert got[200] == "Call us today\n\nWe are open\n\nAlone\n\nHome Board"


def test_odd_pages(llm):
    schema = "page_id long, url string, html string, host string, digest long, text string"
    rows = [(None, None, None), (1, None, "<p>a"), (1, None, "<p>a"), (2, "", ""), (3, "not a url", "plain"), (4, "http://h", "<p>" + "x " * 50_000), (5, "http://h", "<div>" * 3000 + "deep")]
    pages = llm.createDataFrame([(*r, "h", 1, "t") for r in rows], schema)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(pages).collect()), key=repr)
    texts = ["", "a", "a", "", "plain", ("x " * 50_000).strip(), "deep"]
    assert got == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, texts, strict=True)), key=repr)
    assert html_text.extract(pages.limit(0)).collect() == []


SCHEMA = "page_id long, url string, html string"


def brute_templates(rows, host, least_pages=5, least_share=0.5, prose_pages=20, prose_share=0.8):
    """Template hashes of a host by counting over all its pages."""
    texts, where = set(), {}
    for _, url, source in rows:
        if f"//{host}/" in url:
            page = Page(source)
            texts.add(page.text())
            for _, _, digest, prose in page.subtrees:
                where.setdefault((digest, prose), set()).add(page.text())
    return frozenset(
        d
        for (d, prose), found in where.items()
        if len(found) >= (prose_pages if prose else least_pages) and len(found) >= (prose_share if prose else least_share) * len(texts)
    )


def article(i, inner=""):
    return f"<html><body><nav>menu</nav><article><h1>Title {i}</h1><p>Story number {i} is told here.</p>{inner}<p>It ends {i}.</p></article></body></html>"


BOX = "<div class=card><h3>Join our list</h3><p>Weekly letters, no spam.</p></div>"


def test_boxes_in_articles_go_and_copied_stories_stay(llm):
    rows = [(i, f"http://box.example/{i}", article(i, BOX)) for i in range(20)]
    # a story without an article element that stands on 6 of 50 pages, three times under the same frame
    story = "<div><p>A long story that was copied.</p><p>It has two paragraphs.</p></div>"
    rows += [(100 + i, f"http://news.example/{i}", f"<body>{story}<p>frame {i % 4}</p></body>") for i in range(6)]
    rows += [(200 + i, f"http://news.example/o{i}", f"<body><div><p>Other story {i}.</p></div></body>") for i in range(44)]
    # one page copied many times is one text: nothing of it is a template
    rows += [(300 + i, f"http://copies.example/{i}", f"<body><div><p>Only page.</p>{BOX}</div></body>") for i in range(30)]
    # a quoted box on a third of the articles stays, a sentence at one place of all of many articles goes
    rows += [(400 + i, f"http://quotes.example/{i}", article(i, BOX if i % 3 == 0 else "")) for i in range(30)]
    rows += [(500 + i, f"http://notice.example/{i}", article(i, "<p>Subscribe to read more.</p>")) for i in range(25)]
    got = {r.page_id: r.text for r in html_text.extract(llm.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    for i, url, source in rows:
        host = url.split("/")[2]
        assert got[i] == Page(source).text(brute_templates(rows, host)), url
    plain = lambda i: f"Title {i}\n\nStory number {i} is told here.\n\nIt ends {i}."
    assert got[3] == plain(3)
    assert got[101] == "A long story that was copied.\n\nIt has two paragraphs.\n\nframe 1"
    assert got[300] == "Only page.\n\nJoin our list\n\nWeekly letters, no spam."
    assert "Join our list" in got[403] and got[404] == plain(4)
    assert got[507] == plain(7)
