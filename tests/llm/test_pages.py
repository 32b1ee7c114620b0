import random
import string
import time
from html.parser import HTMLParser

import pytest
from coinloom.llm import wrappers
from coinloom.llm.common import table

HEAD = '<!DOCTYPE html><html><head><title>T {0}</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>'
ARTICLE = (
    HEAD + '<header><a href="/">Home</a></header><nav><ul><li>A<li>B</ul></nav><div class="cookie-notice">We use cookies</div>'
    '<main><article class="post-{0}"><h1>Title {0}</h1><p>First &amp; {0}<p>Second\n  <b>bold</b> text<br>on<div class="ad">Buy</div>'
    "<form>name <input></form>{1}</article></main><aside>side</aside>"
    '<section id="comments"><article class="comment">reader says {0}</article></section><footer>&copy; foot</footer></body></html>'
)
PLAIN = HEAD.replace("<body>", '<body class="page with-sidebar has-ads">') + '<header>Site</header><div id="menu">one two</div><div id="content"><p>Body {0} is rather long, much longer than the rest.</p><ul><li>x {0}</li><li>y</li></ul></div><div id="sidebar">links</div></body>'


def pages(spark):
    rows = [(k, f"http://a.example/{k}", ARTICLE.format(k, "<p>more</p>" * (k % 3))) for k in range(6)]
    rows += [(10 + k, f"https://B.example:80/p?{k}", PLAIN.format(k)) for k in range(3)]
    rows += [(20, None, None), (21, "not a url", ""), (22, "http://c.example/", "<p>lonely &eacute; <i>page</i>"), (23, "http://c.example/2", "text only"), (24, "http://c.example/3", "<<<>< p <b")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")


def extracted(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.extract_text(frame).collect()}


def test_main_text(spark):
    got = {r.page_id: r for r in wrappers.extract_text(pages(spark)).collect()}
    assert len(got) == 14 and all(r.n_chars == len(r.text) for r in got.values())
    for k in range(6):
        assert got[k].text == "\n".join([f"Title {k}", f"First & {k}", "Second bold text on", *["more"] * (k % 3)])
    for k in range(3):
        assert got[10 + k].text == f"Body {k} is rather long, much longer than the rest.\nx {k}\ny"
    assert got[20].text == got[21].text == ""
    assert got[22].text == "lonely é page"
    assert got[23].text == "text only"
    assert got[24].text == "<<<>< p"


def test_wrapper_of_a_host(spark):
    got = {r.host: r for r in wrappers.infer_wrappers(pages(spark)).collect()}
    a = got["a.example"]
    assert a.n_pages == 6 and a.region == "/main/article.post-0"
    assert "(p # /p)+" in a.pattern and ")?" in a.pattern and "=" in a.pattern
    assert got["b.example"].region == "/div.content"
    assert wrappers.infer_wrappers(pages(spark).limit(0)).count() == 0


def test_merging_in_any_order_gives_one_region():
    own = [wrappers.Wrapper.of(wrappers.events(ARTICLE.format(k, "<p>m</p>" * (k % 4)))).dump() for k in range(8)]
    one, two = wrappers.Wrapper.load(own[0]), wrappers.Wrapper.load(own[7])
    for k in range(1, 8):
        one.merge(wrappers.Wrapper.load(own[k]))
        two.merge(wrappers.Wrapper.load(own[7 - k]))
    assert one.region() == two.region() == "/main/article.post-0" and one.pages == two.pages == 8
    assert one.template(one.region()) == two.template(two.region())


def test_pages_without_body_and_hosts_with_teaser_cards(spark):
    long = "The body of this page is long, much longer than the cards beside it are, and it goes on for a while."
    cards = '<body><div class="content"><p>{0} {1}</p>{2}</div></body>'
    rows = [
        (1, "http://c.example/", "<p>lonely &eacute; <i>page</i>"),
        (2, "http://c.example/2", "text only"),
        (3, "http://d.example/", "<title>T</title><h1>Head</h1><p>first<p>second<nav>menu</nav>"),
        (4, "http://f.example/", ""),
        (5, "http://g.example/", "<html><p>hello world text</p></html>"),
        (6, "http://h.example/", "<ul><li>x<li>y</ul>"),
        (7, "http://i.example/", "<section><p>in</p></section><p>after</p>"),
    ]
    rows += [(10 + k, f"http://e.example/{k}", cards.format(long, k, '<article class="teaser">card</article>' * (k % 2))) for k in range(4)]
    got = extracted(spark, rows)
    assert [got[k] for k in range(1, 8)] == ["lonely é page", "text only", "Head\nfirst\nsecond", "", "hello world text", "x\ny", "in\nafter"]
    assert all(got[10 + k].startswith(f"{long} {k}") for k in range(4))


def test_markup_and_class_words_inside_an_article(spark):
    inside = '<p title="a>b">hello</p><p class="alert">Important paragraph</p><div class="share-price">Shares fell 4 points</div>'
    rows = [(1, "http://a.example/", f"<article>{inside}<div class='ad-slot'>Buy</div><span class=ad>now</span></article>")]
    rows += [(2, "http://b.example/", '<p>one <a href="x>y>z" title=\'q>\'>two</a> three</p><p a="never closed>four</p>')]
    got = extracted(spark, rows)
    assert got[1] == "hello\nImportant paragraph\nShares fell 4 points"
    assert got[2] == "one two three\nfour"


NOTICE = "This long notice is the same on every page of the host, whatever the page is about, and it fills most of a short page."


def test_alignment_decides_what_a_single_page_cannot_show(spark):
    """Unmarked boxes of fixed text: aligned pages show that they belong to the template, one page alone does not."""
    shape = '<div class="qa">{n}</div><div class="qb"><p>Story {k} tells what happened on day {k}.</p><div class="qc">Join the club</div><p>And {k} more.</p></div>'
    rows = [(k, f"http://many.example/{k}", shape.format(n=NOTICE, k=k)) for k in range(5)]
    rows += [(9, "http://one.example/", shape.format(n=NOTICE, k=9))]
    rows += [(20 + k, f"http://copies.example/{k}", shape.format(n=NOTICE, k=0)) for k in range(4)]
    got = extracted(spark, rows)
    for k in range(5):
        assert got[k] == f"Story {k} tells what happened on day {k}.\nAnd {k} more."
    assert "Join the club" in got[9]
    assert all(got[20 + k] == got[20] and "Story 0" in got[20] for k in range(4))  # copies show nothing


def test_equal_headings_are_no_template(spark):
    shape = "<article><h2>Summary</h2><p>In {0} words.</p><h2>Details</h2><p>Of {0} things.</p></article>"
    got = extracted(spark, [(k, f"http://a.example/{k}", shape.format(k)) for k in range(5)])
    assert all(got[k] == f"Summary\nIn {k} words.\nDetails\nOf {k} things." for k in range(5))


def test_folds_and_common_rows():
    page = "<dl>" + "<dt>a</dt><dd>b</dd>" * 3 + "</dl>" + "<p>x</p>" * 4
    assert wrappers.Wrapper.of(wrappers.events(page)).pattern() == "dl (dt # /dt dd # /dd)+ /dl (p # /p)+"
    import random

    rng = random.Random(1)
    for n in (5, 40, 400):
        for alphabet in (3, 50, 5000):
            a, b = ([str(rng.randrange(alphabet)) for _ in range(n)] for _ in range(2))
            pairs = wrappers._common(a, b)
            assert all(a[i] == b[j] for i, j in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
            if n <= 40:
                assert len(pairs) == len(wrappers._longest(a, b, 0, n, 0, n))


def test_very_long_and_very_deep_pages():
    """A million characters of tags that neither fold nor align, and 50,000 nested blocks."""
    import random

    rng = random.Random(4)
    tags = ["div", "p", "section", "ul", "h2", "pre", "ol", "table"]
    long = ["".join(f"<{t} class=c{chr(97 + rng.randrange(26))}>w {i}</{t}>" for i, t in enumerate(rng.choices(tags, k=30_000))) for _ in range(2)]
    began = time.time()
    one, two = (wrappers.Wrapper.of(wrappers.events(x)) for x in long)
    one.merge(two)
    assert one.pages == 2 and time.time() - began < 60
    text = wrappers.main_text(long[0], one.region())
    assert text.count("\n") == 29_999
    deep = "<div>" * 50_000 + "deep" + "</div>" * 50_000
    w = wrappers.Wrapper.of(wrappers.events(deep))
    w.merge(wrappers.Wrapper.load(w.dump()))
    assert wrappers.main_text(deep, w.region()) == "deep" and time.time() - began < 90
    assert wrappers.main_text("<a" * 300_000, "") == "" and wrappers.main_text('<p x="' * 100_001 + ">z", "") in ("", "z")


class Plain(HTMLParser):
    """The blocks of a page's article, read by the standard parser."""

    SKIPPED = ("script", "style", "nav", "footer", "aside", "form")
    BLOCKS = ("p", "h1", "h2", "h3", "li", "div", "article", "ul")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.article, self.skip, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.article += tag == "article"
        self.skip += tag in self.SKIPPED
        if tag in self.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.article -= tag == "article"
        self.skip -= tag in self.SKIPPED
        if tag in self.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.article and not self.skip:
            self.blocks[-1] += data


def test_whole_table_against_a_plain_parse(spark):
    rows = table(spark, "/root/testdata/sf0.01", "pages").collect()
    got = {r.page_id: r.text for r in wrappers.extract_text(table(spark, "/root/testdata/sf0.01", "pages")).collect()}
    assert len(got) == len(rows) == 250
    for r in rows:
        plain = Plain()
        plain.feed(r.html)
        assert got[r.page_id] == "\n".join(filter(None, (" ".join(b.split()) for b in plain.blocks))), r.page_id


def story(k, article, style):
    """A page and its known text: a heading, a section under a fixed heading whose paragraphs have names of their own, a byline all share."""
    rng = random.Random(f"{k}{style}")
    name = lambda: "".join(rng.choices(string.ascii_lowercase, k=7))
    lines = [f"Line {i} of story {k}: {name()} {name()} {name()} and {name()}." for i in range(20)]
    body = "".join(f'<p class="{name() if style else "x"}">{x}</p>' for x in lines)
    tag = "article" if article else "div"
    page = (
        f'<html><body><nav><a href="/">Home</a> <a href="/x">News</a></nav><{tag} class="text"><h1>Story {k}</h1>'
        + ("<p class='byline'>By Ana Silva for the regional desk</p>" if article else "")
        + f'<section class="story"><h2>The story</h2>{body}</section><p>Closing words of number {k} {name()}.</p></{tag}>'
        f'<footer>All rights reserved</footer></body></html>'
    )
    known = [f"Story {k}", *(["By Ana Silva for the regional desk"] if article else []), "The story", *lines]
    return page, known


@pytest.mark.parametrize("article", [True, False])
def test_hosts_of_any_size_keep_their_text(spark, article):
    rows, want = [], {}
    for host, n in enumerate([3, 4, 20, 120, 200, 500]):
        for k in range(n):
            page, known = story(k, article, style=True)
            ident = host * 1000 + k
            rows.append((ident, f"http://h{host}.example/{k}", page))
            want[ident] = known
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 2, 5):
        got = {r.page_id: r.text.split("\n") for r in wrappers.extract_text(frame.repartition(parts, "page_id")).collect()}
        assert {i for i, known in want.items() if got[i][:-1] != known or not got[i][-1].startswith("Closing words")} == set()


def test_shared_lines_of_an_article_stay_and_shared_links_go(spark):
    def page(k):
        return (
            f"<html><body><article><h1>T{k}</h1><p class='byline'>By Ana Silva for the regional desk</p><table><tr><td>Unit<td>Metre</table>"
            f"<p>Words of page {k} that no other page has, quite a few of them.</p><div class='q'><a href='/b'>Buy the yearly book now</a></div></article></body></html>"
        )

    got = extracted(spark, [(k, f"http://s.example/{k}", page(k)) for k in range(4)])
    for k in range(4):
        assert got[k] == f"T{k}\nBy Ana Silva for the regional desk\nUnit\nMetre\nWords of page {k} that no other page has, quite a few of them."


def test_more_pages_take_nothing_from_others(spark):
    whole = [(k, f"http://g.example/{k}", story(k, True, True)[0]) for k in range(260)]
    few = extracted(spark, whole[:5])
    many = extracted(spark, whole)
    assert all(few[k] == many[k] for k in range(5))
