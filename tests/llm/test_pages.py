"""Main text of pages and records derived from them."""

import hashlib

import pytest
from helpers import CLASHES
from pyspark.sql import functions as F

from llm.html_blocks import best_container, blocks, container_scores, main_container, page_blocks, text_of
from llm.html_text import host_paths, main_text
from llm.queries import queries
from llm.warc import derivatives, read_warc, responses, write_warc

TEMPLATE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; {i}</title><style>p{{x}}</style>
<script>var a = "<p>no</p>";</script></head><body class="has-sidebar"><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><header><h2>Site</h2></header>
<div class="post-{i} content"><h1>Title {i}</h1><p>First &eacute;&#233;&nbsp;para {i}
 with <b>bold</b> and <a href="/x?a=1&amp;b=2">link</a>.<p>Second<br>line{more}<ul><li>One<li>Two</ul>
<aside>See also</aside><form><p>Name <input></p></form><!-- <p>hidden</p> --></div>
<div class="sidebar"><p>Side text that is not part of it</p></div>
<div id="comments"><p>A reader's comment which is very long {long}</p></div>
<footer>&copy; all</footer></body></html>"""
EXPECTED = "Title {i}\n\nFirst éé para {i} with bold and link.\n\nSecond line{more}\n\nOne\n\nTwo"


def page(i, more="", long="x " * 400):
    return TEMPLATE.format(i=i, more=more, long=long)


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *(F.lit(1).alias(n) for n in CLASHES), F.lit(2).alias("path"), F.lit(3).alias("votes"))


def test_pages_of_a_template(spark):
    rows = [(i, f"https://user@WWW.a.org:80/p/{i}?q#f", page(i)) for i in range(20)]
    out = {r.page_id: r for r in main_text(pages(spark, rows)).collect()}
    for i in range(20):
        assert out[i].text == EXPECTED.format(i=i, more="") and out[i].n_chars == len(out[i].text)
    [path] = host_paths(pages(spark, rows)).collect()
    assert (path.host, path.path, path.votes) == ("www.a.org", "/body.has-sidebar/div.content.post-0", 20)


def test_consensus_corrects_a_page_whose_own_best_is_wrong(spark):
    """On one page an unmarked box is longer than the text; the host's other pages tell."""
    odd = page(99, long="").replace('<div class="sidebar">', f"<div class='box'><p>{'Box words. ' * 80}</p></div><div class='sidebar'>")
    rows = [(i, f"http://b.org/{i}", page(i)) for i in range(9)] + [(99, "http://b.org/99", odd)]
    alone = main_text(pages(spark, rows[-1:])).first().text
    assert "Box words" in alone and "Title" not in alone
    together = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert together[99] == EXPECTED.format(i=99, more="")


def test_a_second_template_of_a_host_keeps_its_articles(spark):
    """The winning path has an intro on each page of the other template, and a caption on a page of none."""
    first = "<body><div class=text><p>{}</p></div><div class=foot><p>Foot</p></div></body>"
    second = "<body><div class=text><p>Intro {}.</p></div><div class=story><p>{}</p></div></body>"
    lone = "<body><div class=text><p>Caption.</p></div><div class=lone><p>{}</p></div></body>"
    bodies = [LONG * 2 + f"end {i}" for i in range(10)]
    rows = [(i, f"http://c.org/{i}", first.format(bodies[i])) for i in range(6)]
    rows += [(i, f"http://c.org/{i}", second.format("word " * 20, bodies[i])) for i in range(6, 9)]
    rows += [(9, "http://c.org/9", lone.format(bodies[9]))]
    out = {r.page_id: r.text for r in main_text(pages(spark, rows)).collect()}
    assert [out[i] for i in range(6)] == bodies[:6]
    assert all(bodies[i] in out[i] and "Foot" not in out[i] for i in range(6, 10))
    [won] = host_paths(pages(spark, rows)).collect()
    assert (won.path, won.votes) == ("/body/div.text", 6)


def test_articles_and_their_headings():
    html = "<body><div><p>short</p></div><article class=x7><h1>H</h1><div class=inner><p>" + "long text " * 50 + "</p></div></article></body>"
    assert best_container(container_scores(blocks(html))) == "/body/article.x0"
    wrapper = "<body><div class='with-sidebar'><p>All the text there is.</p></div></body>"
    assert [b[0] for b in page_blocks(wrapper)] == ["All the text there is."]


LONG = "Some words of the article. " * 20


@pytest.mark.parametrize(
    "html,kept,gone",
    [
        ("<div class='page has-sidebar'><p>article</p></div><p>Powered by X</p>", ["article"], []),
        (f"<html class='no-comments'><div class='layout sidebar-right'><p>{LONG}</p><div class=sidebar>Side</div></div>", [LONG], ["Side"]),
        (f"<body><form id=aspnetForm><nav>Menu</nav><div><p>{LONG}</p></div></form><footer>Foot words</footer>", [LONG], ["Menu", "Foot"]),
        (f"<div><div class='article-header'><h1>Title</h1></div><p>{LONG}</p></div>", ["Title", LONG], []),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>", ["Title", LONG], []),
        ("".join(f"<div class='elementor-widget elementor-widget-text'><p>Part {i}.</p></div>" for i in range(9)), ["Part 0", "Part 8"], []),
        (f"<div><p>{LONG}</p><h2 id=discussion>Discussion</h2><section id=related-work><p>Others did.</p></section></div>", ["Discussion", "Others did"], []),
        (f"<div><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><p>{LONG}</p></div>", ["Let x=1 be."], []),
        (f"<div><p>{LONG}</p></div><div class=post-comments>{LONG * 3}comment end</div><form>Name</form>", [LONG], ["comment end", "Name"]),
        (f"<div><p>{LONG}</p></div><div class=related-posts>Next</div><div class=cookie-notice>{LONG * 9}we bake</div>", [LONG], ["Next", "we bake"]),
    ],
)
def test_names_alone_drop_no_article_text(html, kept, gone):
    text = "\n\n".join(b[0] for b in page_blocks(html))
    assert all(k.strip() in text for k in kept) and not any(g in text for g in gone)


@pytest.mark.parametrize(
    "html",
    [
        f"<body><main><h1>Title</h1><p>The lede.</p><div class=body><p>{LONG}</p><p>{LONG}</p></div></main></body>",
        f"<body><h1>Title</h1><p>The lede.</p><div class=body><p>{LONG}</p></div></body>",
        f"<body><div id=w><section class=top><h1>Title</h1><p>The lede.</p></section><section class=b><p>{LONG * 4}</p></section></div></body>",
        f"<body><main><h1>Title</h1><p>The lede.</p><article><p>{LONG}</p></article></main></body>",
    ],
)
def test_title_and_lede_beside_the_longest_container_stay(html):
    links = "<div class=x><p><a href=/>Far away</a> <a href=/>and farther</a></p></div>"
    text = text_of(found := page_blocks(html.replace("</body>", links + "</body>")), main_container(found))
    assert text.startswith("Title\n\nThe lede.\n\nSome words") and "Far away" not in text


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain words only", "plain words only"),
        ("<p>unclosed <b>tags<i> here", "unclosed tags here"),
        ("a < b and <3 <p", "a < b and <3 <p"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>&lt;b&gt; &amp;amp; &#x1F600; &unknown; &#0;</p>", "<b> &amp; 😀 &unknown; �"),
        ("<body><nav><a href=x>only menus</a></nav></body>", ""),
        ("<p title='a>b'>quoted</p><p>" + "w " * 200_000 + "</p>", "quoted\n\n" + "w " * 199_999 + "w"),
        ("<p>kept<!-- open <p>hidden</p> and this", "kept"),
        ("<p class=it's>one</p><p title=\"x>two</p><b>", "one\n\ntwo"),
        ("x" + "<a " * 50_000, "x" + ("<a " * 50_000).rstrip()),
        ("y" + "<a \"" * 50_001 + ">z", "yz"),
        ("<!" * 50_000 + ">w", "w"),
        ("<div>" * 30_000 + "v" + "</div>" * 30_000, "v"),
        ("</div></p><div><div><div><p>deep</div>", "deep"),
    ],
)
def test_broken_pages(spark, html, text):
    rows = [(1, None, html), (1, "no host here", html), (None, "", html)]
    out = main_text(pages(spark, rows)).collect()
    assert [(r.text, r.n_chars) for r in out] == [(text, len(text))] * 3


def test_empty_tables(spark):
    empty = pages(spark, [(1, "u", "h")]).limit(0)
    assert main_text(empty).collect() == [] and derivatives(responses(empty)).collect() == []


def test_every_given_page_gives_its_article(spark, sf_dir):
    """The given pages hold their text in one element; here it is found by plain search."""
    import html as entities
    import re

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = {r.page_id: r.text for r in queries()["op8_html_text"](spark, sf_dir).collect()}
    assert out.keys() == source.keys()
    for number, page_html in source.items():
        article = re.search(r"<article>(.*?)</article>", page_html, re.S)[1]
        parts = [re.sub(r"<[^>]*>", "", x.replace("<br>", " ")) for x in re.split(r"</?(?:p|h1)>", article)]
        parts = [" ".join(entities.unescape(x).split()) for x in parts]
        assert out[number] == "\n\n".join(filter(None, parts))


def records(spark):
    rows = [(i, f"https://a.org/{i}", page(i, more=" 😀 é")) for i in range(6)]
    rows += [(7, None, None), (8, "https://a.org/8", ""), (None, "https://a.org/x", "plain\r\n\r\ntext"), (1, "https://a.org/1", page(1, more=" 😀 é"))]
    return responses(pages(spark, rows))


def test_derived_records_refer_to_their_source(spark):
    sources = {r.headers["WARC-Record-ID"]: r for r in records(spark).collect()}
    derived = derivatives(records(spark)).collect()
    assert len(sources) == 9 and len(derived) == 20
    for r in derived:
        source = sources[r.headers["WARC-Refers-To"]]
        for name in ("WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest"):
            assert r.headers.get(name) == source.headers.get(name)
        data = r.content.encode()
        assert int(r.headers["Content-Length"]) == len(data)
        assert r.headers["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(data).hexdigest()
        body = source.content.partition("\r\n\r\n")[2]
        assert source.headers["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(body.encode()).hexdigest()
    assert len({r.headers["WARC-Record-ID"] for r in derived}) == 18
    both = {r.headers["WARC-Type"]: r.content for r in derived if r.source_id == 3}
    assert "source-http-header: HTTP/1.1 200 OK\r\n" in both["metadata"]
    assert "title: T & 3\r\nlanguage: en\r\noutlink: /a\r\noutlink: /x?a=1&b=2\r\n" in both["metadata"]
    assert "Menu" in both["conversion"] and "Second line 😀 é" in both["conversion"]
    assert "no</p>" not in both["conversion"] and "hidden" not in both["conversion"]
    assert derivatives(derivatives(records(spark))).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_files_round_trip(spark, root, compression):
    whole = records(spark).select("headers", "content").union(derivatives(records(spark)).select("headers", "content"))
    write_warc(whole.repartition(3), f"{root}/{compression}", compression)
    back = read_warc(spark, f"{root}/{compression}")
    key = lambda rows: sorted((sorted(r.headers.items()), r.content) for r in rows)
    assert key(back.collect()) == key(whole.collect())


def test_a_damaged_record_is_refused(spark, root):
    bad = records(spark).limit(1).withColumn("content", F.concat("content", F.lit("!")))
    write_warc(bad, f"{root}/bad")
    with pytest.raises(Exception, match="length"):
        read_warc(spark, f"{root}/bad").collect()


def test_tags_without_an_end_swallow_nothing():
    from llm.html_blocks import visible_text

    page = "<body><p>one two three</p><svg class='i'/><p>four</p><select><option>x<p>five</p><svg><text>no</text></svg><object data=a><p>six</p></body>"
    text = visible_text(page)
    assert all(word in text for word in ("three", "four", "five", "six")) and "no" not in text.split()
    assert "kept" not in visible_text("<p>a</p><script>kept")


def test_a_heading_far_below_its_article_is_kept():
    page = "<article>" + "<div>" * 40 + "<header><h1>Title of it</h1></header><p>" + "word " * 60 + "</p>" + "</div>" * 40 + "</article>"
    assert any(b[0] == "Title of it" for b in page_blocks(page))


@pytest.mark.parametrize("intro", [124, 219, 1500])
def test_a_page_of_its_own_template_keeps_its_story(spark, intro):
    common = "<html><body><div class=intro><p>{}</p></div></body></html>"
    pages = [(i, "https://h.example/%d" % i, common.format("plain words here " * 20)) for i in range(5)]
    words = lambda n, w: (w + " ") * (n // (len(w) + 1))
    odd = f"<html><body><div class=intro><p>{words(intro, 'early')}</p></div><div class=story><p>{words(2000, 'later')}</p></div></body></html>"
    pages.append((9, "https://h.example/9", odd))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    (text,) = [r.text for r in main_text(df).collect() if r.page_id == 9]
    assert text.count("later") == 2000 // 6 and text.count("early") == intro // 6


def test_twenty_templates_on_one_host(spark):
    page = "<html><body><div class=top><p>Intro {0}.</p></div><div class=t{1}><p>{2}</p></div></body></html>"
    # Class names with letters, since digits fold.
    pages = [(i, "https://h.example/x", page.format(i, "abcdefghijklmnopqrst"[i % 20], f"body{i} " * 80)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert all(r.text.count(f"body{r.page_id}") == 80 for r in main_text(df).collect())
