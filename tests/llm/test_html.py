from __future__ import annotations

import random
import re
import time
from html import unescape

from convlens.llm import html
from convlens.llm.queries import op7_html_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav><div id="cookie-notice">We use cookies</div>
<main><article><header><h1>Ti&amp;tle</h1></header><p>One <b>bold</b>&nbsp;x<br>two<p>Three &lt;tag&gt; &#233;
<div class="ad">buy</div><aside>rel</aside><ul><li>i1<li>i2</ul><script>if(a<b){"</p>"}</script><form>n<input></form>
<table><tr><td>c1<td>c2</table><!-- <p>no</p> --><p style="display: none">hid</p><span class="share">Share</span>
<section class="comments"><p>hi</p><article class="comment">me</article></section></article></main>
<div class="sidebar"><p>side</p></div><footer>f</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert html.extract(FULL).split("\n\n") == ["Ti&tle", "One bold x two", "Three <tag> é", "i1", "i2", "c1", "c2"]


def test_pages_without_article_or_markup():
    plain = '<body><div id=wrap><div class=menu>m</div><div class="story"><h1>H</h1><p>long one</p></div><div class="comments">c</div></div>'
    assert html.extract(plain) == "H\n\nlong one"
    assert html.extract("a < b &amp; c") == "a < b & c"
    assert html.extract("") == html.extract(None) == html.extract("<script>open to the end") == ""


def test_broken_markup_is_read_as_far_as_it_goes():
    assert html.extract("<article><p><b>one<br><p>two</i></div><p>three") == "one\n\ntwo\n\nthree"
    assert html.extract('<article><p title="a > b">x</p></article') == "x\n\n</article"


def test_names_that_hold_a_mark_and_a_layout_word():
    aside = ["article-comments", "comment-body", "comment-content", "sidebar-content", "ad-content", "cookie-notice-body", "main-nav"]
    aside += ["comment has-reply", "comment-no-avatar", "main-sidebar", "post comment-body"]
    for name in aside:
        assert html.extract(f"<article><p>one</p><div class='{name}'><p>no</p></div><p>two</p></article>") == "one\n\ntwo"
        assert html.extract(f"<body><div class=story><p>one</p></div><div class='{name}'><p>no</p></div></body>") == "one"
    assert html.extract("<article><p>one</p><p class='no-comments'>Comments are closed.</p></article>") == "one"
    for name in ["with-sidebar", "has-sidebar main", "no-sidebar", "content-with-sidebar", "content-sidebar-wrap", "post has-comments", "no-ads"]:
        assert html.extract(f"<body><div class='{name}'><article><p>one</p></article></div></body>") == "one"
        assert html.extract(f"<body class='{name}'><div class='{name}'><p>one</p></div></body>") == "one"
    assert html.extract("<body class='main comments-open'><article class='post comments-closed'><p>one</p></article></body>") == "one"


def test_raw_elements_end_where_they_end():
    parts = ['<svg class="i" title="a > b"/>', "<math/>", "<SVG />", "<svg><path d=''/></svg>", "<svg><svg/><text>t</text></svg>"]
    for part in parts:
        assert html.extract(f"<article><p>one</p>{part}<p>two</p><p>three</p></article>") == "one\n\ntwo\n\nthree"
    for name in ("title-bar", "select-box", "object-x"):
        assert html.extract(f"<article><p>one</p><{name}>in</{name}><p>two</p></article>") == "one\n\nin\n\ntwo"
    assert html.extract("<article><p>one</p><select><option>no</select><title>no</title><p>two</p></article>") == "one\n\ntwo"


def test_siblings_titles_and_words_of_an_article_stay():
    parts = "<main><h1>Title</h1><p>Lead para.</p><article><p>A longer first part.</p></article><article>Part two.</article><nav>n</nav></main>"
    assert html.extract(parts).split("\n\n") == ["Title", "Lead para.", "A longer first part.", "Part two."]
    assert html.extract("<body><div>x</div><article>One.</article><article>Two, longer.</article></body>") == "One.\n\nTwo, longer."
    assert html.extract('<p>We <span class="search-term">searched</span> a lot.</p>') == "We searched a lot."
    assert html.extract('<p>We <span class="share">shared</span> a lot.</p><p><span class="share">Share</span></p>') == "We shared a lot."
    assert html.extract('<article><section class="alert-study"><p>Alerts.</p></section></article>') == "Alerts."
    for name in ("responses", "discussion", "share-buttons", "related-posts", "alert alert-box", "search-box"):
        assert html.extract(f"<article><p>one</p><div class='{name}'><p>no</p></div></article>") == "one"
    assert html.extract("<p>one <i hidden>no <b>no</b></i>two</p>") == "one two"


def test_hostile_pages_take_time_in_proportion():
    size = 300_000
    for part in ("<a ", "<![CDATA[", "<!--", "<", "<a \"", "<a '\"", "<div>", "<div>t", "<p>", "</p>x", "<li>", "<script>", "<tr><ul>", "</div>", "<b class=ad>", "<svg ", "&amp", "<td x='>'"):
        for tail in ("", ">", "</x>"):
            begin = time.process_time()
            html.extract(part * (size // len(part)) + tail)
            assert time.process_time() - begin < 3, part
    deep = "<div>" * 50_000 + "<article><p>in</p></article>" + "</div>" * 50_000 + "<tr>" * 20_000 + "</x>" * 20_000
    begin = time.process_time()
    assert html.extract(deep) == "in"
    assert time.process_time() - begin < 8


def test_any_other_page_keeps_its_text():
    assert html.extract('<article><p>one</p><p title="open>two</p><p>three</p></article>') == "one\n\ntwo\n\nthree"
    assert html.extract("<article>one <![CDATA[ two </article>") == "one"
    assert html.extract("<p>a <!-- no") == "a"


def page(number: int, text: str) -> str:
    return (
        f"<html><body><div class=top><p>Welcome to us</p></div><div class=story><h1>Title {number}</h1>"
        f"<p>{text}</p><p>Read on in our shop</p></div><div class=bottom><p>All about us</p></div></body></html>"
    )


def test_template_of_a_host_is_left_out(spark):
    rows = [(i, f"http://a.example/{i}", page(i, f"story {i} " * (20 + i))) for i in range(12)]
    rows += [(20, "http://single.example/", page(20, "the only page")), (21, None, "<p>no url</p>"), (22, "http://a.example/x", None)]
    rows += [(i, f"http://copies.example/{i}", page(1, "same story " * 9)) for i in range(30, 42)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html.main_text(docs).collect()}
    for i in range(12):
        assert got[i] == f"Title {i}\n\n" + ("story %d " % i * (20 + i)).strip()
    assert "the only page" in got[20]
    assert got[21] == "no url"
    assert got[22] == ""
    assert all("same story" in got[i] for i in range(30, 42))  # copies are not boilerplate
    content = {r.host: r.content for r in html.templates(docs.select(html.host_of(docs.url).alias("host"), docs.page_id.alias("page_key"), "html")).collect()}
    assert content["a.example"] == html.path_id("div.story", html.path_id("body", html.path_id("html")))


def brute_template(pages):
    """The texts of a host that lie within an element of equal occurrence vector, from whole vectors."""
    vectors, around = {}, {}
    for n, p in enumerate(pages):
        blocks, elements = html.parse(p)
        tokens = [("path", e.path) for e in elements] + [("text", html._token(b)) for b in blocks if html._is_slot(b)]
        for t in tokens:
            vectors.setdefault(t, [0] * len(pages))[n] += 1
        for b in blocks:
            e = b.inner
            while e is not None:
                around.setdefault(html._token(b), set()).add(e.path)
                e = e.outer
    held = {k: v for k, v in vectors.items() if sum(x > 0 for x in v) >= html.SUPPORT}
    return {t for (kind, t), v in held.items() if kind == "text" and any(held.get(("path", p)) == v for p in around[t])}


def test_classes_of_small_hosts_against_whole_vectors(spark):
    """Notices on all pages, on some pages, in articles and beside them, twice on a page, and texts that merely repeat."""
    draw = random.Random(8)
    rows, hosts = [], {}
    for host, count in (("seven.example", 7), ("twenty.example", 20), ("two.example", 2), ("mixed.example", 9)):
        for i in range(count):
            story = "".join(f"<p>{' '.join(draw.choices('abcdefghijklm', k=60))} {host} {i} {j}</p>" for j in range(3))
            always = "<div class=x1><p>This text is on every page of the site.</p></div>"
            some = "<div class=x2><b>Members get more.</b><p>Join the club.</p></div>" if i % 2 else ""
            twice = "<p>A refrain.</p>" * (i % 3)
            quote = "<p>A sentence that a few stories have.</p>" if i % 4 == 1 else ""
            page = f"<html><body><div class=top>Site</div><main><h1>Story {i}</h1>{always}{story}{some}{twice}{quote}</main></body></html>"
            hosts.setdefault(host, []).append(page)
            rows.append((len(rows), f"http://{host}/{i}", page))
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    slim = docs.select(html.host_of(docs.url).alias("host"), docs.page_id.alias("page_key"), "html")
    got = {r.host: r for r in html.templates(slim).collect()}
    for host, pages in hosts.items():
        texts, paths = ({} if v is None else dict(zip(v[::2], v[1::2])) for v in (got[host].texts, got[host].paths))
        found = {html._token(b) for p in pages for b in html.parse(p)[0] if html._nested(b, texts, paths)}
        assert found == brute_template(pages)
    texts = {r.page_id: (r.url, r.text) for r in html.main_text(docs).collect()}
    for i, (url, text) in texts.items():
        few = "two.example" in url
        assert ("every page of the site" in text) == few and text.startswith("Story")
        assert "Join the club" not in text or few
        assert "A sentence that" in text or (int(url.rsplit("/", 1)[1]) % 4 != 1)


def test_pages_of_the_table(spark, sf):
    got = {r.page_id: r for r in op7_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.DOTALL)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", article)]
        assert got[p.page_id].text == "\n\n".join(filter(None, blocks))
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


def test_columns_of_any_name(spark):
    names = ["_host", "_content", "_template", "host", "content", "c0", "page_key"]
    docs = spark.createDataFrame([(1, "http://h/", "<p>x</p>" * 200_000, *names)], ["page_id", "url", "html", *names])
    got = html.main_text(docs)
    assert got.columns == ["page_id", "url", *names, "text"]
    (row,) = got.collect()
    assert [row[c] for c in names] == names and len(row.text) == 3 * 200_000 - 2


def test_empty_table_and_kept_columns(spark):
    docs = spark.createDataFrame([(1, "http://h/", "<p>x</p>", "t", 5)], "page_id long, url string, html string, text string, host int")
    (row,) = html.main_text(docs).collect()
    assert (row.page_id, row.url, row.host, row.text) == (1, "http://h/", 5, "x")
    assert html.main_text(docs.where("page_id > 1")).count() == 0
