"""Main text of web pages by removal of site templates.

Every page is read into a tree, and each container in it (a list, a division, a menu, a footer) is hashed over its tags and text. Spark
counts, for every host, on how many different articles a container recurs; one that recurs on many is part of the
site's template and is deleted from all pages of that host. What no count can show, as on hosts with few pages, is
settled by the page's own marks: text stands in `article` (or `main`) elements, and elements that say what they are
(`nav`, `form`, class "advert", role "search") are left out. Paragraphs of an article are never deleted as a template:
passages that many articles share are text.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import slices, written

#: Different articles of a host that a container has to recur on to be deleted.
MANY_PAGES = 3

# Element names of the HTML standard, by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noscript noembed noframes xmp".split())
CONTAINERS = set("aside dialog details div dl fieldset figure footer form header hgroup menu nav ol search section table ul".split())
TEXT_BLOCKS = set("address blockquote center h1 h2 h3 h4 h5 h6 p pre".split())
PART_BLOCKS = set("caption dd dt figcaption legend li optgroup option summary tbody td tfoot th thead tr".split())
OTHER_BLOCKS = set("article body html main hr head".split())
BLOCKS = CONTAINERS | TEXT_BLOCKS | PART_BLOCKS | OTHER_BLOCKS
CLOSES_P = (CONTAINERS | set("address article blockquote center h1 h2 h3 h4 h5 h6 hr main p pre".split())) - {"table"}
NOT_TEXT = set("aside button datalist dialog footer form head math menu nav object search select svg template".split())
#: An element of the first kind ends when one of the second begins, unless one of the third stands between.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    **{t: ({"dt", "dd"}, {"dl"}) for t in ("dt", "dd")},
    **{t: ({"td", "th"}, {"table", "tr"}) for t in ("td", "th")},
    "tr": ({"tr", "td", "th"}, {"table"}),
    **{t: ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}) for t in ("tbody", "thead", "tfoot")},
    "option": ({"option"}, {"select", "datalist"}),
}

_MARKED_ROLE = re.compile(r"(?:alert|alertdialog|banner|complementary|contentinfo|dialog|form|menu|menubar|navigation|search|toolbar)\Z")
#: Words of class and id by which an element says that it isn't text: whole, or as the first or last part of a name.
_SAYS = r"ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|respond|share|sharing|sidebar|signup|skip-link|social|sponsor\w*|subscribe|toolbar|widget"
_MARKED_NAME = re.compile(rf"(?:(?:{_SAYS})(?:[-_].*)?|(?!(?:has|no|with|without)[-_]).*[-_](?:{_SAYS}))\Z", re.I)
_OF_READERS = re.compile(r"(?:ads?|advert\w*|comments?|promo\w*|related|repl(?:y|ies)|respond|sponsor\w*|teaser)(?:[-_].*)?\Z", re.I)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN_STYLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

CANDIDATE, LEFT_OUT, MAIN, OF_ARTICLE = 1, 2, 4, 8


def digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=8).digest()


def says_not_text(tag: str, attributes: str) -> bool:
    """Whether an element's name or attributes say that it is no part of the main text."""
    if tag in NOT_TEXT:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    found = {m[1].lower(): unescape(next((v for v in m.groups()[1:] if v is not None), "")) for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN_STYLE.search(found.get("style", "")):
        return True
    if _MARKED_ROLE.match(found.get("role", "").strip().lower()):
        return True
    says = _OF_READERS if tag in ("article", "main") else _MARKED_NAME
    return any(says.match(name) for key in ("class", "id") for name in found.get(key, "").split())


class Page:
    """One page, read in one pass: pieces of text and the subtrees, each a range of pieces.

    `pieces` hold decoded text with blanks as single spaces and block bounds as newlines. A piece ends where a container
    begins or ends, so that deleting a subtree means leaving out its pieces.
    """

    def __init__(self, html: str):
        self.pieces: list[str] = []
        self.subtrees: list[tuple[int, int, int, int]] = []  # hash, first piece, end, kind
        self.text: list[str] = []  # of the piece that is open
        self.stack: list[list] = []  # tag, digests of what it holds, first piece or None, kind
        self.open: dict[str, int] = {}
        self.mains = self.left_out = 0
        self.read(html)
        while self.stack:
            self.pop()
        self.cut()
        self.subtrees = self.with_one_region()

    def read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                self.said(html[at:])
                return
            if lt > at:
                self.said(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = size if end < 0 else end + 3
                continue
            follows = html[lt + 1 : lt + 3]
            if follows[:1] in ("!", "?") or (follows[:1] == "/" and len(follows) == 2 and not ("a" <= follows[1].lower() <= "z")):
                end = html.find(">", lt)
                at = size if end < 0 else end + 1
                continue
            tag = _TAG.match(html, lt)
            if tag is None:
                if "a" <= follows.lstrip("/")[:1].lower() <= "z":
                    return  # a tag that never ends
                self.said("<")
                at = lt + 1
                continue
            at = tag.end()
            name = tag[2].lower()
            if tag[1]:
                self.end(name)
            elif name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = close.end() if close else size
            else:
                self.begin(name, tag[3])

    def said(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        words = " ".join(text.split())
        text = f"{' ' * text[0].isspace()}{words}{' ' * text[-1].isspace()}" if words else " "
        self.text.append(text)
        if self.stack and text != " ":
            self.stack[-1][1].append(text.encode("utf-8", "surrogatepass"))

    def cut(self) -> int:
        """End the open piece; the number of pieces so far."""
        if self.text:
            self.pieces.append("".join(self.text))
            self.text = []
        return len(self.pieces)

    def begin(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P and self.open.get("p"):
            self.pop_to({"p"}, {"table", "button", "article", "section", "div"})
        if tag in ENDED_BY:
            self.pop_to(*ENDED_BY[tag])
        if tag in VOID:
            if tag in ("br", "hr"):
                self.text.append("\n" if tag == "hr" else " ")
            return
        kind = LEFT_OUT if says_not_text(tag, attributes) else 0
        if tag in ("article", "main"):
            kind |= 0 if kind or self.left_out else MAIN
            self.mains += 1
        elif tag in CONTAINERS or (tag in TEXT_BLOCKS and not self.mains):
            kind |= CANDIDATE
        if tag in BLOCKS:
            self.text.append("\n")
        self.left_out += bool(kind & LEFT_OUT)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.stack.append([tag, [], self.cut() if kind else None, kind])

    def end(self, tag: str) -> None:
        if self.open.get(tag):
            inline = tag not in BLOCKS
            for entry in reversed(self.stack):
                if entry[0] == tag:
                    break
                if inline and entry[0] in BLOCKS:
                    return  # a phrase cannot end the block around it
            while self.pop() != tag:
                pass

    def pop_to(self, tags: set[str], bounds: set[str]) -> None:
        """Close the outermost open element of `tags` that no element of `bounds` holds back."""
        if not any(self.open.get(t) for t in tags):
            return
        depth = None
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in bounds:
                break
            if self.stack[k][0] in tags:
                depth = k
        if depth is not None:
            while len(self.stack) > depth:
                self.pop()

    def pop(self) -> str:
        tag, held, first, kind = self.stack.pop()
        self.open[tag] -= 1
        self.mains -= tag in ("article", "main")
        self.left_out -= bool(kind & LEFT_OUT)
        if tag in BLOCKS:
            self.text.append("\n")
        if held or kind:
            own = digest(tag.encode("utf-8", "surrogatepass") + b"\0" + b"\0".join(held))
            if self.stack:
                self.stack[-1][1].append(b"\1" + own)
            if kind and (held or kind & MAIN):
                self.subtrees.append((int.from_bytes(own, "big", signed=True), first, self.cut(), kind | (OF_ARTICLE if tag == "article" else 0)))
        return tag

    def with_one_region(self) -> list[tuple[int, int, int, int]]:
        """Subtrees with only those marked MAIN that make the region of the main text: articles, or else main elements."""
        wanted = MAIN | OF_ARTICLE if any(kind & OF_ARTICLE and kind & MAIN for *_, kind in self.subtrees) else MAIN
        return [(h, a, b, kind & (CANDIDATE | LEFT_OUT) | (MAIN if kind & wanted == wanted else 0)) for h, a, b, kind in self.subtrees]

    def article(self) -> bytes:
        """Digest of the text that is left by the page's own marks: pages with the same one are copies of each other."""
        region = [s for s in self.subtrees if s[3] & MAIN] or [(0, 0, len(self.pieces), MAIN)]
        keep = [False] * len(self.pieces)
        for _, a, b, _ in region:
            keep[a:b] = [True] * (b - a)
        for _, a, b, kind in self.subtrees:
            if kind & LEFT_OUT:
                keep[a:b] = [False] * (b - a)
        return digest("".join(p for p, k in zip(self.pieces, keep) if k).encode("utf-8", "surrogatepass"))


def _keyed(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, html, k1, k2) of pages; k1 and k2 are hashes of the whole row, the same after any loss."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    return rows.select("*", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("k1"), F.xxhash64("html", "url", "page_id", F.lit(1)).alias("k2"))


def occurrences(keyed: DataFrame) -> DataFrame:
    """(k1, k2, host, hash, article) for every container of every page, once per page."""
    ship(keyed.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices([batch], "html"):
                rows: list[list] = [[], [], [], [], []]
                for html, *page in zip(*(part.column(c).to_pylist() for c in ("html", "k1", "k2", "host"))):
                    read = Page(html)
                    found = sorted({h for h, a, b, kind in read.subtrees if kind & CANDIDATE and a < b})
                    article = int.from_bytes(read.article(), "big", signed=True)
                    for values, v in zip(rows, (*page, None, article)):
                        values.extend(found if v is None else [v] * len(found))
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types)], ["k1", "k2", "host", "hash", "article"])

    return keyed.select("html", "k1", "k2", "host").mapInArrow(run, "k1 long, k2 long, host string, hash long, article long")


def templates(found: DataFrame, many: int = MANY_PAGES) -> DataFrame:
    """(host, hash, articles) of containers on at least `many` different articles of a host. Occurrences are made distinct
    first, so a host with a third of all pages is spread over all tasks, and then counted by partial sums."""
    distinct = found.select("host", "hash", "article").distinct()
    return distinct.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("articles")).filter(F.col("articles") >= many)


def read_pages(keyed: DataFrame) -> DataFrame:
    """(page_id, url, k1, k2, pieces, hashes, ranges) of every page: its text, and its subtrees as hash and as first piece, end
    and kind, packed into 30, 30 and 4 bits of a number."""
    ship(keyed.sparkSession)
    keys = keyed.select("page_id").schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices([batch], "html"):
                pages = [Page(html) for html in part.column("html").to_pylist()]
                hashes = [[h for h, a, b, _ in p.subtrees if a < b] for p in pages]
                ranges = [[a << 34 | b << 4 | k for _, a, b, k in p.subtrees if a < b] for p in pages]
                pieces = pa.array([[s.encode("utf-8", "replace") for s in p.pieces] for p in pages], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("page_id", "url", "k1", "k2")] + [pieces, *(pa.array(v, pa.list_(pa.int64())) for v in (hashes, ranges))],
                    ["page_id", "url", "k1", "k2", "pieces", "hashes", "ranges"],
                )

    schema = f"page_id {keys}, url string, k1 long, k2 long, pieces array<string>, hashes array<long>, ranges array<long>"
    return keyed.select("page_id", "url", "k1", "k2", "html").mapInArrow(run, schema)


def unpacked(hashes: Column, ranges: Column) -> Column:
    """Packed subtrees as structs (hash, first, end, kind)."""
    bits = lambda v, shift, width: F.shiftrightunsigned(v, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
    return F.zip_with(hashes, ranges, lambda h, r: F.struct(h.alias("hash"), bits(r, 34, 30).alias("first"), bits(r, 4, 30).alias("end"), bits(r, 0, 4).alias("kind")))


def _inside(ranges: Column, i: Column) -> Column:
    return F.exists(ranges, lambda r: (r["first"] <= i) & (i < r["end"]))


def text_of(pieces: Column, dropped: Column, mains: Column) -> Column:
    """The pieces of the main ranges (of the page, where there is none) outside the dropped ones, blanks and bounds merged."""
    left = F.filter(pieces, lambda p, i: ((F.size(mains) == 0) | _inside(mains, i)) & ~_inside(dropped, i))
    joined = F.regexp_replace(F.regexp_replace(F.array_join(left, ""), " *\n[ \n]*", "\n"), " {2,}", " ")
    return F.regexp_replace(joined, "^[ \n]+|[ \n]+$", "")


def extract(pages: DataFrame, many: int = MANY_PAGES) -> DataFrame:
    """page_id, url, text, n_chars, template_subtrees (deleted as parts of the site's template) and marked_subtrees (left
    out by their own marks) of every page.

    Null and empty html, and pages without text, give an empty text. Repeated rows repeat the result; pages without url make up one
    host. Copies of an article count once, so an article that is repeated is no template. Extra columns are ignored.
    Blanks are those of Unicode, no-break spaces included; a line break inside a block is a blank. Containers of an article (lists, tables,
    divisions) that recur on `many` different articles of a host are deleted as well.
    """
    keyed = _keyed(pages)
    found = written(occurrences(keyed), "containers")
    recurring = templates(found, many).select("host", "hash")
    deleted = found.join(recurring, ["host", "hash"]).groupBy("k1", "k2").agg(F.collect_set("hash").alias("deleted"))
    rows = read_pages(keyed).join(deleted, ["k1", "k2"], "left").withColumn("subtrees", unpacked(F.col("hashes"), F.col("ranges")))
    recurs = lambda s: (s["kind"].bitwiseAND(CANDIDATE) != 0) & F.coalesce(F.array_contains("deleted", s["hash"]), F.lit(False))
    marked = lambda s: s["kind"].bitwiseAND(LEFT_OUT) != 0
    rows = rows.withColumn("of_template", F.filter("subtrees", recurs)).withColumn("left_out", F.filter("subtrees", lambda s: marked(s) & ~recurs(s)))
    rows = rows.withColumn("dropped", F.concat("of_template", "left_out"))
    gone = lambda m: F.exists("dropped", lambda d: (d["first"] <= m["first"]) & (m["end"] <= d["end"]))
    rows = rows.withColumn("mains", F.filter("subtrees", lambda s: (s["kind"].bitwiseAND(MAIN) != 0) & ~gone(s)))
    return rows.withColumn("text", text_of(F.col("pieces"), F.col("dropped"), F.col("mains"))).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"),
        F.size("of_template").alias("template_subtrees"), F.size("left_out").alias("marked_subtrees"),
    )
