"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element stands at its path (tags with their first class
or id, inline tags left out), and holds the styles its children come in and the texts found in it. Two
entropies, to the base of the number of different pages m that have the element, tell its importance:

- content: a text that stands in one page has entropy 0, one spread evenly over all pages has 1; the
  content importance of an element is 1 less the mean entropy of its texts, by characters;
- presentation: the entropy of the styles of its children. Menus and notices look the same everywhere.

An element's importance is ``GAMMA`` times the content importance of all below it and the rest times the
presentation importance. Branches below ``KEEP`` are taken out of every page of the host, where at least
``PAGES`` different pages have the element. Names that say what a branch is (``NOISE`` tags and words) come
before the statistics: such branches go everywhere, and where a page marks its article, all else goes too.
A word alone doesn't decide: the article itself, and a branch with the page's title (h1), with its article or
with most of its text stay, whatever they are called (``has-sidebar``, ``no-comments``).

Statistics are sums over (host, path, text, page), so a host with a third of all pages is many groups;
pages that share their main text (the marked one, else the texts of the path that holds most) count once, so copies
of one article under other menus don't make it look like a menu. The result for a host is a short list of paths, joined to its pages:
by broadcast while all lists are small (checked), else by a shuffle.

Defined results: null or empty html gives an empty text; a null url or one without host belongs to a host
named by the empty string; unclosed and cut-off markup is read as browsers do; repeated rows give repeated
results.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.llm.common import extended, map_arrow, slices, stored

GAMMA, KEEP, PAGES = 0.9, 0.25, 5
#: Most characters of all hosts' lists that are broadcast.
BROADCAST = 8_000_000

# What HTML elements are.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
#: Open elements that a start tag of the named kind closes, up to the element that bounds the search.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
          "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table")}
#: Tags, and words in class, id or role, of branches that are no part of an article.
NOISE_TAGS = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split())
NOISE_WORDS = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary consent "
                        "contentinfo cookie cookies disclaimer footer masthead menu modal nav navbar navigation newsletter "
                        "notice notices pagination popup promo related search share sharing sidebar social sponsor "
                        "sponsored subscribe toolbar widget".split())
MAIN_TAGS = frozenset(["article", "main"])

TAG = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|[^>]*>|.*\Z)", re.S)
NAME = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)


class Page:
    """The blocks of a page in order: (path, in its article, text); and its elements' styles."""

    def __init__(self, html: str):
        self.blocks: list[tuple[tuple[str, ...], bool, str]] = []
        self.styles: list[tuple[tuple[str, ...], str]] = []
        # open elements: tag, name in paths, noise, in the article, children's names, named branches around
        self.open: list[tuple[str, str, bool, bool, list[str], tuple[int, ...]]] = [("", "", False, False, [], ())]
        # branches with a noise word, by number: characters, has the title, has an article; and those of each block and style
        self.named: list[list[int]] = []
        self.block_in: list[tuple[int, ...]] = []
        self.style_in: list[tuple[int, ...]] = []
        self.article_outside = False
        self.buffer: list[str] = []
        self._read(html)
        while len(self.open) > 1:
            self._close()
        self._flush()
        self._judge()

    def _judge(self) -> None:
        """Branches with a noise word go, but for those that hold the title, the article or most of the text."""
        if not self.named:
            return
        for at, (_, _, text) in zip(self.block_in, self.blocks):
            for i in at:
                self.named[i][0] += len(text)
        total = sum(len(text) for _, _, text in self.blocks)
        clear = sum(len(text) for at, (_, inside, text) in zip(self.block_in, self.blocks) if inside and not at)
        gone = {i for i, (chars, title, article) in enumerate(self.named)
                if not (title or 2 * chars > total or article and (not self.article_outside or chars >= clear))}
        self.blocks = [b for at, b in zip(self.block_in, self.blocks) if gone.isdisjoint(at)]
        self.styles = [b for at, b in zip(self.style_in, self.styles) if gone.isdisjoint(at)]

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join(html_entities.unescape("".join(self.buffer)).split())
            self.buffer.clear()
            if text and not self.open[-1][2]:
                self.blocks.append((tuple(e[1] for e in self.open[1:]), self.open[-1][3], text))
                self.block_in.append(self.open[-1][5])

    def _close(self) -> None:
        self._flush()
        _, _, noise, _, children, around = self.open[-1]
        if not noise:
            self.styles.append((tuple(e[1] for e in self.open[1:]), " ".join(children)))
            self.style_in.append(around)
        self.open.pop()

    def _open(self, tag: str, attributes: str) -> None:
        self._flush()
        if self.open[-1][0] == "p":
            self._close()
        for kind, bound in [CLOSES[tag]] if tag in CLOSES else []:
            ends, stops = kind.split(), bound.split()
            at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] in ends + stops), 0)
            while at and self.open[at][0] in ends:
                while len(self.open) > at:
                    self._close()
                at -= 1
        found = {k.lower(): v.strip("\"'").lower() for k, v in NAME.findall(attributes)} if "=" in attributes else {}
        words = {w for v in found.values() for w in re.split(r"[^a-z0-9]+", v) if w}
        inside, main = self.open[-1][3], tag in MAIN_TAGS or found.get("role") == "main"
        noise = self.open[-1][2] or tag in NOISE_TAGS or (tag == "header" and not inside)
        around = self.open[-1][5]
        if not noise and (tag == "h1" or main):
            for i in around:
                self.named[i][1 if tag == "h1" else 2] = 1
            self.article_outside |= tag == "article" and not around
        if not noise and not main and tag not in ("html", "body") and words & NOISE_WORDS:
            around = (*around, len(self.named))
            self.named.append([0, int(tag == "h1"), 0])
        first = (found.get("class") or found.get("id") or "").split()
        name = f"{tag}.{first[0]}" if first else tag
        if self.open[-1][4][-1:] != [name]:  # runs of equal children are one
            self.open[-1][4].append(name)
        self.open.append((tag, name, noise, (inside or main) and not noise, [], around))

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = TAG.search(html, at)
            if not m:
                self.buffer.append(html[at:])
                return
            self.buffer.append(html[at:m.start()])
            at = m.end()
            if m[2] is None:
                end = "-->" if m[0] == "<!--" else ">"
                to = html.find(end, at - (2 if html.startswith("<!-->", m.start()) else 0))
                at = n if to < 0 else to + len(end)
                continue
            if not m[0].endswith(">"):
                return  # cut off within a tag
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                if not m[3].endswith("/>") or tag not in ("svg", "math"):
                    at = html.find(">", close.start()) + 1 if close and html.find(">", close.start()) >= 0 else n
                if tag not in ("svg", "math"):
                    self._flush()
            elif tag in VOID:
                if tag in ("br", "hr"):
                    self._flush()
            elif tag not in INLINE:
                self._open(tag, m[3])

    def _end(self, tag: str) -> None:
        if tag in INLINE or tag in VOID:
            if tag == "br":
                self._flush()
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._close()
                return
        self._flush()

    def main(self) -> str:
        """The text that tells different pages apart: the marked blocks, else those of the path with most characters."""
        blocks = [b for b in self.blocks if b[1]]
        if not blocks:
            by: dict[tuple[str, ...], int] = {}
            for path, _, text in self.blocks:
                by[path] = by.get(path, 0) + len(text)
            most = max(by, key=lambda path: (by[path], path), default=None)
            blocks = [b for b in self.blocks if b[0] == most]
        return "\n".join(text for _, _, text in blocks)

    def kept(self, low: frozenset[str] = frozenset()) -> list[str]:
        """Texts of the blocks that stay: those of the article, if the page has one with text."""
        blocks = [b for b in self.blocks if b[1]] or self.blocks
        if not low:
            return [t for _, _, t in blocks]
        gone: dict[tuple[str, ...], bool] = {}
        out = []
        for path, _, text in blocks:
            if path not in gone:
                gone[path] = any("/".join(path[:i]) in low for i in range(1, len(path) + 1))
            if not gone[path]:
                out.append(text)
        return out


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def site_nodes(pages: DataFrame) -> DataFrame:
    """Rows of the merged trees: (host, path, kind, what, page, chars).

    kind 0: a text (by hash) in an element, chars its length times its number in the page; kind 1: a style.
    """
    key = lambda s: xxhash.xxh3_64_intdigest(s) - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in slices(batches, "html"):
            out: dict[str, list] = {c: [] for c in ("host", "path", "kind", "what", "page", "chars")}
            for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                if not html:
                    continue
                page = Page(html)
                page_key = key(page.main() or html)
                marked = any(inside for _, inside, _ in page.blocks)
                rows: dict[tuple[str, int, int], int] = {}
                for path, inside, text in page.blocks:
                    if path and (inside or not marked):
                        k = "/".join(path), 0, key(text)
                        rows[k] = rows.get(k, 0) + len(text)
                for path, style in page.styles:
                    rows["/".join(path), 1, key(style)] = 1
                for (path, kind, what), chars in rows.items():
                    for c, v in zip(out, (host, path, kind, what, page_key, chars)):
                        out[c].append(v)
            yield out

    src = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string"))
    return map_arrow(src, run, "host string, path string, kind int, what long, page long, chars long")


def low_branches(nodes: DataFrame) -> DataFrame:
    """(host, low): the paths of each host whose importance is below the bound."""
    nodes = stored(nodes.groupBy("host", "path", "kind", "what", "page").agg(F.max("chars").alias("chars")), "style-tree")
    m = nodes.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count(F.lit(1)).alias("m"))
    # entropy of one text over its pages: log n - sum(c log c) / n, for c characters a page and n in all
    text = (nodes.where("kind = 0").groupBy("host", "path", "what")
            .agg(F.sum("chars").alias("n"), F.sum(F.col("chars") * F.log("chars")).alias("clogc"))
            .select("host", "path", "n", (F.col("n") * F.log("n") - F.col("clogc")).alias("nh")))
    text = text.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("nh").alias("nh")).join(m, ["host", "path"])
    text = text.withColumn("imp", F.when(F.col("m") > 1, F.greatest(F.lit(0.0), 1 - F.col("nh") / F.col("n") / F.log("m"))).otherwise(1.0))
    steps = F.split("path", "/")
    below = (text.select("host", "n", "imp", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)),
                                                                  lambda i: F.array_join(F.slice(steps, 1, i), "/"))).alias("path"))
             .groupBy("host", "path").agg((F.sum(F.col("n") * F.col("imp")) / F.sum("n")).alias("content")))
    style = (nodes.where("kind = 1").groupBy("host", "path", "what").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("host", "path").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
             .select("host", "path", (F.log("n") - F.col("clogc") / F.col("n")).alias("h")))
    both = below.join(style, ["host", "path"], "left").join(m, ["host", "path"]).where(F.col("m") >= PAGES)
    look = F.least(F.lit(1.0), F.coalesce(F.col("h") / F.log("m"), F.lit(0.0)))
    return (both.where(GAMMA * F.col("content") + (1 - GAMMA) * look < KEEP)
            .groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low")))


def main_text(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but html, if None) of every page, with text and n_chars."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in ("html", "text", "n_chars")]
    lists = stored(low_branches(site_nodes(pages)), "low-branches")
    size = lists.agg(F.sum(F.length("host") + F.length(F.array_join("low", " ")))).first()[0] or 0
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col("html").cast("string").alias("__html"), _host(F.col("url")).alias("__host"))
    lists = lists.withColumnRenamed("host", "__host").withColumnRenamed("low", "__low")
    met = src.join(F.broadcast(lists) if size <= BROADCAST else lists, "__host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in slices(batches, "__html"):
            texts = [" ".join(Page(h).kept(frozenset(low or ()))) if h else ""
                     for h, low in zip(b.column("__html").to_pylist(), b.column("__low").to_pylist())]
            yield {c: b.column(c) for c in keep} | {"text": texts, "n_chars": np.array([len(t) for t in texts], np.int64)}

    return map_arrow(met.select(*[F.col(f"`{c}`") for c in keep], "__html", "__low"), run, extended(src, keep, "text string, n_chars long"))
