"""HTML extraction and URL filters."""

import html
import re

from tests.conftest import SF_MID
from tidemark.llm import html_text, url_filter
from tidemark.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href="/">Home of the site</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it better for everyone who reads it.</div>
<div class=ad>Buy now a very good thing that everyone needs and nobody can do without today.</div>
<main><article><header><h1>A &amp; B</h1></header><p>First   para&shy;graph with <b>bold</b> and
 <a href=x>a link</a>.<p>One<br>Two<!-- hidden --></p><form><label>Name</label><button>Send it now</button></form>
<p>caf&eacute; &#8364;5</p></article>
<section id="comments"><p>I think that this is the best article of all that I have read in years.</p></section></main>
<aside>Related things that you may also want to read some day when there is time.</aside>
<footer>&copy; 2020 The Company of All Things, all rights reserved.</footer></body></html>"""


def test_page():
    tree = html_text.train()
    found = html_text.blocks(PAGE)
    x, _ = html_text.features([found])
    kept = [b[0] for b, k in zip(found, tree.predict(x), strict=True) if k]
    assert kept == ["A & B", "First para\xadgraph with bold and a link.", "One Two", "café €5"]


def test_tree_knows_its_table():
    rows = html_text.labelled_table()
    assert (html_text.train().predict(rows[:, :-1]) == rows[:, -1]).mean() > 0.97


def test_page_without_article():
    text = "These are many words that make a long paragraph of plain text without any link in it at all, as it is. " * 2
    page = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><div>{text}</div><div>{text}</div></body>"
    found = html_text.blocks(page)
    x, _ = html_text.features([found])
    assert html_text.train().predict(x).tolist() == [0, 1, 1]


def main_text(page):
    found = html_text.blocks(page)
    x, _ = html_text.features([found])
    return [b[0] for b, k in zip(found, html_text.train().predict(x), strict=True) if k]


def words(start, n=40):
    return " ".join(f"{start}{i}" for i in range(n))


def test_article_below_marks():
    a, b, c, d = (words(x) for x in "abcd")
    nav, foot = "<nav><a href=1>Home page</a></nav>", f"<footer>{words('f', 30)}</footer>"
    body = f"{nav}<article><h1>Title</h1><p>{a}</p><p>Short.</p><p>{b}</p></article>{foot}"
    full = ["Title", a, "Short.", b]
    for page in (f"<body><form id=form1 action=x>{body}</form></body>",
                 f"<head><title>T</title><meta charset=u><body>{body}",
                 f"<html><head><title>T</title>{body}",
                 f"<body><div class='site has-sidebar'>{body}</div>",
                 f"<body><div id=page class='page-header'><form>{body}</form></div>",
                 f"<body><div class=cookies-on-page><div class='ads subscription'>{body}</div></div>",
                 f"<form><article><p>Only a</p><p>short one.</p></article><div class=ad>Buy {words('x', 30)}</div></form>"):
        assert main_text(page) == (["Only a", "short one."] if "Only" in page else full), page
    plain = f"<form>{nav}<div class=content><div>{a}</div><div>{b}</div></div>{foot}<div class=sidebar>{c}</div></form>"
    assert main_text(plain) == [a, b]
    named = (f"<article><h1 class=entry-header>Title</h1><p>{a}</p><h2 id=related-work>Related work</h2><p>{b}</p>"
             f"<section id=search><h2>Search</h2><p>{c}</p><p>So it is.</p></section>"
             f"<div class=section id=legal><h2>Law</h2><p>{d}</p></div><div class=share>Share this</div></article>")
    assert main_text(named) == ["Title", a, "Related work", b, "Search", c, "So it is.", "Law", d]
    assert main_text(f"<article><p>{a}</p><form><p>{b}</p><p>{c}</p></form></article>") == [a, b, c]


def test_furniture_stays():
    a, b, note = words("a", 90), words("b", 90), words("n", 30)
    talk = "<div id=comments>" + "".join(f"<div class=comment><p>{words(f'c{i}x', 60)}</p></div>" for i in range(9)) + "</div>"
    for extra in (talk, f"<div class=cookie-notice>{note}</div>", f"<form><label>Mail</label><p>{note}</p></form>",
                  f"<div class=sidebar><p>{note}</p></div>", f"<section id=related><p>{note}</p></section>",
                  f"<div class=newsletter><p>{note}</p><p>{note}</p></div>", f"<div role=search>{note}</div>"):
        assert main_text(f"<main><article><p>{a}</p><p>{b}</p></article></main>{extra}") == [a, b], extra
        assert main_text(f"<div class=content><p>{a}</p><p>{b}</p></div>{extra}") == [a, b], extra
    assert main_text(f"<article><p>{a}</p><div class=ad>{note}</div><form><p>{note}</p></form><p>{b}</p></article>") == [a, b]


def test_articles_beside_the_main_text():
    a, b, c = (words(x, 90) for x in "abc")
    content = f"<div class=content><div>{a}</div><div>{b}</div></div>"
    teasers = "".join(f"<article><h3><a href=x>One more</a></h3><p>{words(f't{i}x', 20)}</p></article>" for i in range(3))
    talk = "".join(f"<article class='comment-body'><p>{words(f'c{i}x', 60)}</p></article>" for i in range(9))
    for beside in (f"<aside>{teasers}</aside>", f"<div class=related-posts>{teasers}</div>",
                   f"<div id=comments>{talk}</div>", talk, f"<aside>{teasers}</aside><div id=comments>{talk}</div>",
                   "<article id=div-comment-12><p>" + c + "</p></article>"):
        assert main_text(f"<body>{content}{beside}</body>") == [a, b], beside
        marked = f"<article class='post reply-closed'><h1>Title</h1><p>{a}</p><p>{b}</p></article>"
        assert main_text(f"<body>{marked}{beside}</body>") == ["Title", a, b], beside
    # teasers that nothing sets apart: words and links decide
    assert main_text(f"<body>{content}<div class=grid>{teasers}</div></body>")[:2] == [a, b]
    listing = "".join(f"<article><h2>Title</h2><p>{x}</p></article>" for x in (a, b, c)) + f"<div>{words('z', 30)}</div>"
    assert main_text(listing) == ["Title", a, "Title", b, "Title", c]
    assert main_text(f"<article><p>{a}</p></article><div>{b}</div>") == [a]


def test_comments_and_adverts_in_lists():
    a, b, c = (words(x, 90) for x in "abc")
    talk = "".join(f"<li class=comment><p>{words(f'c{i}x', 60)}</p><p>So it is.</p></li>" for i in range(5))
    for page in (f"<article><p>{a}</p><p>{b}</p></article><ol>{talk}</ol>", f"<article><p>{a}</p><p>{b}</p><ol>{talk}</ol></article>",
                 f"<div><p>{a}</p><p>{b}</p></div><ol>{talk}</ol>", f"<div><p>{a}</p><p>{b}</p></div><ol>{talk.replace('</li>', '')}</ol>",
                 f"<article><p>{a}<ul><li class=ad><p>{c}</p></ul><p>{b}</article>"):
        assert main_text(page) == [a, b], page
    # closing tags left out: an element's mark ends with it
    assert main_text(f"<article><ul><li class=ad>{words('n', 20)}<li>{a}</ul><p class=promo>{words('m', 20)}<p>{b}</article>") == [a, b]
    rows = f"<article><p>{a}</p><table><tr><td class=ad>{words('n', 20)}<td>one<tr><td>two</table><p>{b}</p></article>"
    assert main_text(rows) == [a, "one", "two", b]


def test_links_around_blocks():
    a, b = words("a", 90), words("b", 90)
    teaser = f"<a href=x><div>{words('t', 30)}</div><div>{words('u', 30)}</div></a>"
    assert main_text(f"<div><div>{a}</div><div>{b}</div></div>{teaser}") == [a, b]
    assert [x[2] for x in html_text.blocks(f"{teaser}<p>free</p>")] == [30, 30, 0]
    # a link that isn't closed ends with the block that it stands in
    assert [x[1:3] for x in html_text.blocks("<div><a href=x>one two</div><p>three four</p>")] == [(2, 2), (2, 0)]
    assert [x[1:3] for x in html_text.blocks("<ul><li><a href=x>one<li>two</ul>three")] == [(1, 1), (1, 0), (1, 0)]


def test_short_pages():
    assert main_text("<body><h1>Closed today</h1><p>We are not open.</p><p>Come back tomorrow.</p></body>") == [
        "Closed today", "We are not open.", "Come back tomorrow."]
    assert main_text("<p>It works!</p>") == ["It works!"]
    assert main_text("<nav><a href=1>Home</a></nav><p>Nothing here yet, sorry.</p><footer>All rights</footer>") == [
        "Nothing here yet, sorry."]
    assert main_text("<ul><li><a href=1>Home page</a><li><a href=2>News of today</a></ul>") == []


def unmarked(page):
    """The page without any mark: other tags for furniture and article, no attributes but links."""
    body = re.sub(r"(?s)<(script|style|title|head)\b.*?</\1>", "", page)
    body = re.sub(r"<(/?)(?:article|main|nav|header|footer|aside|section|form|button|label)\b[^>]*>", r"<\1div>", body)
    return re.sub(r"<(?!a\b)(\w+)\s[^>]*>", r"<\1>", body)


def test_words_and_links_alone(spark):
    """On the given pages without their marks, the tree still finds most of the article."""
    hit = kept = true = 0
    for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect():
        want = {b[0]: b[1] for b in html_text.blocks(re.search(r"(?s)<article>.*?</article>", r.html)[0])}
        got = main_text(unmarked(r.html))
        true += sum(want.values())
        kept += sum(len(x.split()) for x in got)
        hit += sum(len(x.split()) for x in got if x in want)
    print(f"words found {hit / true:.3f}, of those kept {hit / kept:.3f}")
    assert hit / true > 0.95 and hit / kept > 0.7


def test_deep_marks():
    assert len(html_text.blocks("<div class=nav><form>" * 20000 + "text")) == 1


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text, long enough to be a paragraph of its own " * 5),
            (4, "u", "<article><p>cut off <b>here &am"), (5, "u", "<p " * 1000), (6, "u", "<script>never closed <p>x"),
            (None, "u", "<article>a < b && c > d</article>"), (7, "u", "<article>" + "<p>word " * 20000),
            (7, "u", "<article>" + "<p>word " * 20000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert got[1].text == got[2].text == got[6].text == got[5].text == "" and got[1].n_chars == 0
    assert got[3].text.startswith("plain text") and got[4].text == "cut off here &am"
    assert got[None].text == "a < b && c > d" and got[7].n_blocks == 20000 and got[7].n_chars == 99999
    assert html_text.extract(pages).count() == len(rows)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    for r in QUERIES["op6_html_extraction"](spark, SF_MID).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_urls(spark):
    urls = ["http://a.example.com/fr/1", "https://B.EXAMPLE.org/es/2?x#y", "https://example.org/en/12", "http://org",
            "http://x.org/", "no scheme", None, "", "http://h.net/alias", "http://h.net/other", "http://H.net/alias#top",
            "http://notexample.org/es/", "x://y://z.com/de/", "http://a.com/de/1", "http://h.net/free",
            "http://h.net/alias", "http://q.net?://x.com/de/"]
    pages = spark.createDataFrame([(i, u, "z", "z", "z") for i, u in enumerate(urls)],
                                  "page_id long, url string, node string, host string, component string")
    edges = spark.createDataFrame(
        [("http://h.net/alias", "http://k.net/step"), ("http://k.net/step", "http://a.com/de/1"),
         ("http://h.net/other", "http://a.com/de/1#x"), ("http://h.net/free", "http://a.example.com/fr/1"),
         ("http://h.net/free", "http://b.com/de/7"), (None, "http://h.net/other"), ("http://h.net/other", "bad")],
        "src string, dst string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, edges).collect()}
    assert got == {
        0: ("a.example.com", "/fr/1", "com/fr/", "allow"), 1: ("b.example.org", "/es/2", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"), 3: ("org", "", None, "allow"),
        4: ("x.org", "/", "org/", "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("h.net", "/alias", None, "block"), 9: ("h.net", "/other", None, "block"),
        10: ("h.net", "/alias", None, "block"), 11: ("notexample.org", "/es/", "org/", "allow"),
        12: ("y:", "//z.com/de/", None, "allow"), 13: ("a.com", "/de/1", "com/de/", "block"),
        14: ("h.net", "/free", None, "allow"), 15: ("h.net", "/alias", None, "block"), 16: ("q.net", "", None, "allow")}
    assert url_filter.filter_urls(pages, edges.limit(0)).count() == len(urls)
    assert url_filter.filter_urls(pages.limit(0), edges).count() == 0


def test_page_edges(spark):
    tags = ["<link rel='canonical' href=\"http://b.net/x?a=1&amp;b=2\">", "<LINK HREF=/top REL=canonical>",
            "<link rel=canonical href=//c.net/y>", "<link rel='shortcut canonical' href='page.html'>",
            "<meta http-equiv=refresh content='0; url=http://d.net/'>", "<link rel=stylesheet href=x.css>",
            "<link rel=canonical href='#here'>", "<meta http-equiv='refresh' content='5'>", None]
    pages = spark.createDataFrame([(i, "http://a.net/d/p?q", f"<head>{t}</head>" if t else None)
                                   for i, t in enumerate(tags)], "page_id long, url string, html string")
    assert sorted(r.dst for r in url_filter.page_edges(pages).collect()) == sorted([
        "http://b.net/x?a=1&b=2", "http://a.net/top", "http://c.net/y", "http://a.net/d/page.html", "http://d.net/"])
