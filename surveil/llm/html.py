"""HTML main text with site template removal.

A page is read once by a forgiving tokenizer (unclosed and misnested tags, raw text of scripts,
attributes with ``>``). Every element subtree is hashed (tag, class, text, children); Spark counts on how many different pages of a host each hash stands, and subtrees on a
share of them are template and deleted. Inside an article only subtrees of ``CONTAINERS`` can be
template (a share bar, a subscription box), for a paragraph that articles share is content; an
article that would lose all its text keeps it. Template removal alone cannot give right results: menus and adverts
that differ from page to page do not recur, and a paragraph that many articles share does. So
elements that say what they are (``nav``, ``footer``, ``aside``, ``form``, scripts, classes and
ids such as ``ad`` or ``comments``) go at once; where a page has an ``article`` or ``main``, the
text is what is inside; and recurrence decides about everything else, boxes inside included.

Blocks are block-level elements; white space in a block (``<br>`` included) becomes one space,
character references are decoded, and blocks are joined by one line feed in page order.

Defined results: null html has an empty text; a null url is the host ``''``; repeated rows are
pages of their own, but count once for their host; pages may be of any length; an empty table
gives no rows; other columns are ignored.
"""

import hashlib
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.session import stage

MIN_PAGES = 4       # template stands on so many different pages of one host at least,
MIN_PERCENT = 30    # and on so many of a hundred

# Element names by their part in a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu",
    "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
SPACING = {"br", "td", "th", "img", "wbr", "option"}
DROPPED = {
    "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "canvas", "object", "button", "select",
    "textarea", "dialog", "menu", "head", "title", "noembed", "noframes", "xmp", "audio", "video", "map", "math",
}
MAIN = {"article", "main"}
# inside an article, elements that can be template: they group blocks
CONTAINERS = {"center", "details", "dir", "div", "dl", "fieldset", "figure", "header", "hgroup", "ol", "section", "table", "ul"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
LABELS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "banner", "sponsor", "sponsored", "promo",
    "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "header", "masthead", "cookie",
    "cookies", "consent", "gdpr", "notice", "notices", "newsletter", "subscribe", "subscription", "signup", "popup", "modal", "overlay",
    "comment", "comments", "disqus", "respond", "share", "sharing", "social", "related", "widget", "toolbar", "pagination", "pager",
}
# an open element of the first kind ends where one of the second starts
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = {"ul", "ol", "dl", "table", "select", "menu"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|$)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I | re.S)
_LABEL = re.compile(r"[a-z0-9]+")


def _boilerplate(attributes: str) -> tuple[bool, str]:
    """(whether class, id or role name a boilerplate part, the class text)."""
    label, bad = "", False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role":
            bad |= value.strip() in ROLES
            continue
        if name.lower() == "class":
            label = value
        for word in value.split():
            parts = _LABEL.findall(word)
            # "ad", "top-ad", "ad_box"; not "road" or "shadow"
            bad |= bool(parts) and (parts[0] in LABELS or parts[-1] in LABELS)
    return bad, label


class _Open:
    __slots__ = ("tag", "label", "dropped", "inside", "content", "parent", "hash")

    def __init__(self, tag, label, dropped, inside, parent):
        self.tag, self.label, self.dropped, self.inside, self.parent = tag, label, dropped, inside, parent
        self.content, self.hash = [], None


class Page:
    """The blocks of a page and the hashes of its subtrees.

    ``main`` are the blocks inside an article or main element, ``blocks`` those outside, each with
    the subtree it stands in.
    """

    def __init__(self, html: str):
        self.main, self.blocks, self.hashes, self._text, self._has_main = [], [], set(), [], False
        root = _Open("#", "", False, False, None)
        self._stack, self._open_p = [root], 0
        at, end = 0, len(html)
        for match in iter(lambda: _TOKEN.search(html, at), None):
            if match.start() > at:
                self._words(html[at:match.start()])
            at = match.end()
            tag = match[2]
            if tag is None:
                continue
            tag = tag.lower()
            if match[1]:
                self._close(tag)
                continue
            self._start(tag, match[3])
            if tag in RAW:
                stop = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(html, at)
                until = stop.start() if stop else end
                self._words(html[at:until], raw=True)
                at = until
                if not stop:
                    self._close(tag)
        if at < end:
            self._words(html[at:])
        while len(self._stack) > 1:
            self._pop()
        self._flush()

    def _words(self, raw_text: str, raw: bool = False) -> None:
        top = self._stack[-1]
        text = raw_text if raw or "&" not in raw_text else unescape(raw_text)
        if not top.dropped:
            self._text.append(text)
        if text.strip():
            top.content.append(" ".join(text.split()))

    def _flush(self) -> None:
        if self._text:
            block = " ".join("".join(self._text).split())
            self._text = []
            if block:
                top = self._stack[-1]
                (self.main if top.inside else self.blocks).append((block, top))

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            if self._open_p and tag not in ("body", "html"):
                self._close("p")
        elif tag in SPACING and not self._stack[-1].dropped:
            self._text.append(" ")
        if tag in ENDS:
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i].tag in ENDS[tag]:
                    self._close(self._stack[i].tag)
                    break
                if self._stack[i].tag in FENCES:
                    break
        if tag in VOID:
            return
        top = self._stack[-1]
        bad, label = _boilerplate(attributes) if "=" in attributes else (False, "")
        dropped = top.dropped or tag in DROPPED or (bad and tag not in ("html", "body", *MAIN)) or (tag == "header" and not top.inside)
        inside = top.inside or (tag in MAIN and not dropped)
        self._has_main |= inside
        self._stack.append(_Open(tag, label, dropped, inside, top))
        self._open_p += tag == "p"

    def _close(self, tag: str) -> None:
        if tag == "p" and not self._open_p:
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                while len(self._stack) > i:
                    self._pop()
                return

    def _pop(self) -> None:
        gone = self._stack[-1]
        if gone.tag in BLOCKS:
            self._flush()
        self._stack.pop()
        self._open_p -= gone.tag == "p"
        if gone.content and gone.tag not in ("html", "body", "head"):
            text = f"{gone.tag}\0{gone.label}\0" + "\0".join(gone.content)
            own = int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)
            if not gone.inside or gone.tag in CONTAINERS:
                gone.hash = own
                self.hashes.add(own)
            # what is around an article is told by itself
            if not gone.inside or gone.parent.inside:
                gone.parent.content.append(str(own))

    def result(self):
        """(finished text or None, open blocks as (text, hashes of the subtrees around it), all hashes).

        Around a block of an article are the subtrees inside the article.
        """
        found = []
        for text, node in self.main if self._has_main else self.blocks:
            chain = []
            while node is not None and node.inside == self._has_main:
                if node.hash is not None:
                    chain.append(node.hash)
                node = node.parent
            found.append({"text": text, "chain": chain})
        if self._has_main and not any(x["chain"] for x in found):
            return "\n".join(x["text"] for x in found), [], self.hashes
        return (None if found else ""), found, self.hashes

    def has_main(self) -> bool:
        return self._has_main


PARSED = "page_id long, url string, host string, content long, text string, main boolean, blocks array<struct<text:string,chain:array<long>>>, hashes array<long>"
_BLOCK = pa.list_(pa.struct([("text", pa.string()), ("chain", pa.list_(pa.int64()))]))


def parse(pages: DataFrame) -> DataFrame:
    """One row per page, see PARSED: ``text`` is set where nothing is left to decide."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
                        F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))).alias("host"), F.xxhash64(F.col("html").cast("string")).alias("content"))

    def run(batches):
        for batch in batches:
            texts, main, blocks, hashes = [], [], [], []
            for html in batch.column(2).to_pylist():
                page = Page(html or "")
                text, own, all_hashes = page.result()
                texts.append(text)
                main.append(page.has_main())
                blocks.append(own)
                hashes.append(sorted(all_hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(texts, pa.string()), pa.array(main, pa.bool_()), pa.array(blocks, _BLOCK), pa.array(hashes, pa.list_(pa.int64()))],
                names=["page_id", "url", "host", "content", "text", "main", "blocks", "hashes"])

    return rows.mapInArrow(run, PARSED)


def template(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash): subtrees on at least ``min_pages`` and MIN_PERCENT of the different pages of their host."""
    pages = stage(parsed.groupBy("host", "content").agg(F.first("hashes").alias("hashes")), "pages", "zstd")
    each = pages.select("host", F.explode("hashes").alias("hash"))
    often = each.groupBy("host", "hash").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    # staged, so that a host with very many subtrees can be split in the join
    often, hosts = stage(often, "often", "zstd"), stage(pages.groupBy("host").agg(F.count("*").alias("all")), "hosts", "zstd")
    return often.join(hosts, "host").filter(F.col("pages") * 100 >= F.col("all") * MIN_PERCENT).select("host", "hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text) of every row of (page_id, url, html)."""
    parsed = stage(parse(pages).withColumn("row", F.monotonically_increasing_id()), "parsed", "zstd")
    done = parsed.filter("text IS NOT NULL").select("page_id", "url", "text")
    # pages with open blocks ask which of the subtrees around each block are template
    left = parsed.filter("text IS NULL")
    asked = left.select("row", "host", F.posexplode("blocks").alias("block", "b")).select("row", "host", "block", F.explode("b.chain").alias("hash"))
    gone = asked.join(template(parsed, min_pages), ["host", "hash"]).groupBy("row").agg(F.collect_set("block").alias("gone"))
    kept = F.filter("blocks", lambda b, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    # pages that differ only around an article would make all of it template
    kept = F.when(F.col("main") & (F.size(kept) == 0), F.col("blocks")).otherwise(kept)
    rest = left.join(gone, "row", "left").select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))
    return done.unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
