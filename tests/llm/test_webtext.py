"""Main text of pages: against a parser-based slow version, template counts by hand, hostile markup."""

import html
import re
from collections import defaultdict
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import webtext
from sluice.llm.queries import op11_main_text

PAGES = "page_id long, url string, html string"


class Slow(HTMLParser):
    """Blocks of the article of a page whose elements are all closed but for p and br."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def slow(page: str) -> str:
    parser = Slow()
    parser.feed(page)
    return "\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)


def text_of(page: str) -> str:
    """The text of one page, its own marks alone: the operator's last steps over one row."""
    read = webtext.Page(page)
    mains = [s for s in read.subtrees if s[3] & webtext.MAIN]
    out = [s for s in read.subtrees if s[3] & webtext.LEFT_OUT]
    inside = lambda i, ranges: any(a <= i < b for _, a, b, _ in ranges)
    joined = "".join(p for i, p in enumerate(read.pieces) if (not mains or inside(i, mains)) and not inside(i, out))
    return re.sub(" {2,}", " ", re.sub(" *\n[ \n]*", "\n", joined)).strip(" \n")


def test_op11_equals_the_parser_version_on_all_pages(spark, sf):
    got = op11_main_text(spark, sf).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r.text == slow(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article>a &lt;p&gt; &#233;&nbsp;b\t c</article>", "a <p> é b c"),
        ("<p>one<p>two<ul><li>x<li>y</ul>", "one\ntwo\nx\ny"),
        ("<article><h1>T</h1><p>a<b>b</b>c<br>d</article>", "T\nabc d"),
        ("<header>top</header><main><header><h1>T</h1></header><p>x</p></main><footer>f</footer>", "T\nx"),
        ("<body><nav>n</nav><article>x<aside>s</aside>y<form>q</form></article><div class='site-footer'>f</div></body>", "x\ny"),
        ("<article>x<div class='ad slot'>buy</div><section id=comments><article>no</article></section></article>", "x"),
        ("<article class='comment'>c</article><article class='post with-sidebar'>x</article>", "x"),
        ("<div class='with-sidebar gradient-box'>kept</div><div class=sidebar-left>s</div><p role=search>z</p>", "kept"),
        ("<article>a<script>if (a<b) '</p>'</script>b<style>p{}</style><!-- <p>c</p> -->d<noscript>e</noscript></article>", "abd"),
        ("<article>a < b && c <3 d</article>", "a < b && c <3 d"),
        ("<article>a<script>never closed</article>", "a"),
        ("<article>a<img alt='x>y' src=z>b<p title=\"<b>\">c</article> tail", "ab\nc"),
        ("<article>a<div hidden>b</div><div style='display: none'>c</div><span aria-hidden=true>d</span>e</article>", "a\ne"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<article>a</b></i></div>b</article></article>", "ab"),
        ("<main>only main</main><div>other</div>", "only main"),
        ("<article>x<!-- open", "x"),
        ("<article>x<a href='never", "x"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ],
)
def test_markup(page, want):
    assert text_of(page) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<article>", "</article>", "<div class=ad>", "<div>", "</div>", "<ul><li>", "</ul>", "<", ">", "&", "&amp", "<!--", "-->", "<script>", "</script>", "a b", "é", "\n", "=\"", "'", "<td>", "<option>"])))
def test_any_markup_is_read(parts):
    page = "".join(parts)
    read = webtext.Page(page)
    for _, a, b, _ in read.subtrees:
        assert 0 <= a <= b <= len(read.pieces)
    assert "<article>" not in text_of(page)


def test_time_is_linear_in_hostile_pages():
    import time

    began = time.time()
    for unit in ("<div>", "<p><b>", '<a b="', "<!--", "</p>", "<article>x", "</div ", "&", "<li>"):
        webtext.Page(unit * 40_000)
    assert time.time() - began < 60


def counted(pages, many):
    """Template subtrees by hand: containers on at least `many` different articles of a host."""
    seen, per_page = defaultdict(set), []
    for _, url, page in pages:
        read = webtext.Page(page or "")
        host = re.sub(r"^https?://([^/]*).*", r"\1", url or "")
        found = {h for h, a, b, k in read.subtrees if k & webtext.CANDIDATE and a < b}
        per_page.append((host, [h for h, a, b, k in read.subtrees if k & webtext.CANDIDATE and a < b]))
        for h in found:
            seen[host, h].add(read.article())
    return [sum(len(seen[host, h]) >= many for h in found) for host, found in per_page]


def test_templates_are_counted_per_host(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    rows = [(p + 1000 * k, u.replace(re.sub(r"^https?://([^/]*).*", r"\1", u), f"h{(p + k) % 3}.example"), h.replace("<body>", f"<body><div>Site {p % 7}<ul><li>a</ul></div>")) for k in range(2) for p, u, h in rows]
    for many in (2, webtext.MANY_PAGES):
        got = {r.page_id: r.template_subtrees for r in webtext.extract(spark.createDataFrame(rows, PAGES), many).collect()}
        want = dict(zip([r[0] for r in rows], counted(rows, many)))
        assert got == want and any(want.values())


def test_template_without_any_mark_goes_and_shared_passages_stay(spark):
    box = "<div><p>All our shops are open on Sunday</p><ul><li>North<li>South</ul></div>"
    body = lambda k: f"{box}<div><p>Story {k} of the day</p><p>A line that all share</p></div>"
    page = lambda k: f"<body>{box}<article><p>Text {k}</p><p>A line that all share</p><div><p>Sign the letter</p></div></article></body>"
    rows = [(k, f"http://a.example/{k}", page(k)) for k in range(5)] + [(10, "http://b.example/1", page(10)), (11, "http://B.example:80/2", page(11))]
    rows += [(20 + k, f"http://c.example/{k}", body(k)) for k in range(4)]
    rows += [(30 + k, "http://d.example/", page(99)) for k in range(6)]  # copies of one page are no template
    got = {r.page_id: r.text for r in webtext.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(5):
        assert got[k] == f"Text {k}\nA line that all share"
    assert got[10] == "Text 10\nA line that all share\nSign the letter" and got[11].startswith("Text 11")
    for k in range(4):
        assert "shops" not in got[20 + k] and got[20 + k].startswith(f"Story {k} of the day")
    assert all(got[30 + k] == "Text 99\nA line that all share\nSign the letter" for k in range(6))


def test_edges(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    rows = [(1, None, None), (2, "x", ""), (None, "http://h/", "<p>a</p>"), (None, "http://h/", "<p>a</p>"), (3, "http://h/", long), (4, "not a url", "<br>")]
    df = spark.createDataFrame([r + ("k", 1) for r in rows], PAGES + ", host string, hash long")
    got = webtext.extract(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append(r.text)
    assert by[1] == [""] and by[2] == [""] and by[None] == ["a", "a"] and by[4] == [""]
    assert by[3] == ["\n".join(["word & word"] * 60_000)]
    assert webtext.extract(df.limit(0)).count() == 0
    assert html.unescape("&am") == "&am"  # cut references stay as they are
