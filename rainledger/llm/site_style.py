"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of style nodes (paths of block
elements with their classes). A node's importance is the normalised entropy,
over the host's different pages, of what stands below it and of how its
children are laid out: a branch that looks alike on page after page has low
importance and is taken off every page. Names of elements, roles and classes are
a prior for what differs from page to page and yet is no article (comments,
lists of related pages), and for hosts of which there is one page only.

Pages are read by hand in one pass: time is in proportion to a page's length,
whatever its nesting, unclosed tags or cut-off ends.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import Scratch, per_batch

#: Elements that stand inside a line; they neither end a block nor are style nodes.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br del "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mtable mtr mtd mstyle mpadded mphantom merror menclose mmultiscripts semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea title iframe svg object select canvas audio video xmp noframes annotation annotation-xml".split())
#: Elements that the start of a like one ends, up to the container that bounds this.
CLOSES = {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table article section main div body aside nav footer header form blockquote".split())
#: Names of elements, roles and words of classes and ids that mark what isn't the article.
APART = frozenset("nav footer aside form button dialog menu head fieldset".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget "
    "footer cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations "
    "adsbygoogle comment comments commentlist reply replies disqus respond login search form toolbar pager pagination".split()
)
#: Words that may stand beside those in a class without changing what it means; a class with any other word says something else.
BESIDE = frozenset("box bar block list area section container wrapper wrap inner outer main site page top bottom left right posts post articles links link buttons button items item icons icon group row col column content header title text slot unit thread media global primary secondary mobile desktop bg dark light user users reader readers visitor visitors wp l c js law info panel layout region plugin fb facebook view views thread threads".split())
#: Words of those that an article may also be about: inside one, a part named by them alone goes only if it holds links.
LINKED = frozenset("social share sharing related recommended recommendations reply replies promo promotion notice notices search respond".split())
HEADERS = frozenset("header masthead topbar".split())
CONTENT = frozenset("article main".split())
#: Elements of running text: their class never sets them apart.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table figure figcaption dl dt dd td th tr li".split())

_tag_name = re.compile(r"[a-zA-Z][^\s/>]*")
_next = re.compile(r"[>=]")
_space = re.compile(r"\s*")
_bare = re.compile(r"[^\s>]*")
_last_word = re.compile(r"[^\s/\"']*$")
_raw_end = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


def said_apart(value: str, words: frozenset[str]) -> bool:
    """Whether a class or id names a thing of these words: one of its parts by white space has such a word, and else only words that may stand beside it."""
    for token in value.split():
        parts = [p for p in re.split(r"[^a-z]+", token) if p]
        if any(p in words for p in parts) and all(p in words or p in BESIDE for p in parts):
            return True
    return False


class Page:
    """A page's style nodes and blocks of text.

    nodes: parent, name, key (a hash of the path) and whether article or main is
    on it, parents first; node 0 is the page. blocks: node, text, apart (by
    names) in page order. layout: the children of each node.

    A form stands apart, unless the page is in it: an article or main in it
    doesn't, and where there's none outside, neither does a form that holds
    paragraphs and most of the text.
    """

    def __init__(self, page: str):
        self.parent, self.name, self.key, self.content = [-1], [""], [xxhash.xxh3_64_intdigest("")], [False]
        self.blocks: list[tuple[int, str, bool]] = []
        self.layout: dict[int, list[str]] = defaultdict(list)
        self._at: dict[tuple[int, str], int] = {}
        self._stack: list[tuple[str, int, bool, int]] = []  # tag, node, apart for sure, mark
        self._marks: list[list] = []  # what is judged at the end: kind, links, characters, whether it has paragraphs
        self._held: list[tuple[int, str, bool, int]] = []
        self._open: dict[str, list[int]] = defaultdict(list)  # tag -> places in the stack
        self._bounds: list[int] = []
        self._words: list[str] = []
        self._read(page)

    def _top(self) -> tuple[str, int, bool, int]:
        return self._stack[-1] if self._stack else ("", 0, False, -1)

    def _mark(self, kind: str) -> int:
        self._marks.append([kind, 0, 0, False])
        return len(self._marks) - 1

    def _judge(self) -> None:
        """Which of the marked parts stand apart after all."""
        open_ = [(node, text) for node, text, sure, mark in self._held if not sure and mark < 0]
        article, free = any(self.content[node] for node, _ in open_), sum(len(text) for _, text in open_)
        forms = sum(m[2] for m in self._marks if m[0] == "form")
        apart = [links > 0 if kind == "linked" else article or not running or 2 * size <= free + forms for kind, links, size, running in self._marks]
        self.blocks = [(node, text, sure or (mark >= 0 and apart[mark])) for node, text, sure, mark in self._held]

    def _flush(self) -> None:
        if self._words:
            text = " ".join(entities.unescape("".join(self._words)).split())
            self._words.clear()
            if text:
                tag, node, sure, mark = self._top()
                self._held.append((node, text, sure, mark))
                if mark >= 0 and not sure:
                    self._marks[mark][2] += len(text)
                    self._marks[mark][3] |= tag in TEXT

    def _pop(self, n: int) -> None:
        while len(self._stack) > n:
            self._open[self._stack.pop()[0]].pop()
        while self._bounds and self._bounds[-1] >= n:
            self._bounds.pop()

    def _child(self, node: int, name: str, content: bool) -> int:
        if (at := self._at.get((node, name))) is None:
            at = self._at[node, name] = len(self.parent)
            self.parent.append(node)
            self.name.append(name)
            self.key.append(xxhash.xxh3_64_intdigest(self.key[node].to_bytes(8, "little") + name.encode()))
            self.content.append(content)
        return at

    def _starts(self, tag: str, named: dict[str, str]) -> None:
        self._flush()
        if tag in VOID:
            return
        ends = CLOSES.get(tag, ()) if tag in CLOSES else ("p",)
        bound = self._bounds[-1] if self._bounds else -1
        above = [places[k] for t in ends if (places := self._open[t]) and (k := bisect_right(places, bound)) < len(places)]
        if above:
            self._pop(min(above))
        _, node, sure, mark = self._top()
        kind = sorted(re.findall(r"[a-z]+", named.get("class", "")))
        inside, whole = self.content[node], tag in CONTENT
        if whole and mark >= 0 and self._marks[mark][0] == "form":
            mark = -1
        if not sure and tag not in ("body", "html"):
            told = [named.get(a, "") for a in ("class", "id")]
            classed = not whole and tag not in TEXT
            by_class = classed and any(said_apart(x, APART_WORDS) for x in told)
            head = not inside and (tag in HEADERS or (classed and any(said_apart(x, HEADERS) for x in told)))
            if tag == "form" and not inside:
                mark = mark if mark >= 0 else self._mark("form")
            elif tag in APART or named.get("role", "").strip() in APART_ROLES or head:
                sure = True
            elif by_class:
                if inside and not any(said_apart(x, APART_WORDS - LINKED) for x in told):
                    mark = mark if mark >= 0 else self._mark("linked")
                else:
                    sure = True
        name = ".".join([tag, *kind])
        self.layout[node].append(name)
        self._open[tag].append(len(self._stack))
        if tag in BOUNDS:
            self._bounds.append(len(self._stack))
        self._stack.append((tag, self._child(node, name, inside or whole), sure, mark))

    def _ends(self, tag: str) -> None:
        if self._open[tag]:
            self._flush()
            self._pop(self._open[tag][-1])
        else:
            self._flush()

    def _read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                self._words.append(page[at:lt])
            if lt == size:
                break
            following = page[lt + 1 : lt + 2]
            if following in ("!", "?"):
                if page.startswith("<!--", lt):
                    close = min((k for k in (page.find("-->", lt + 2), page.find("--!>", lt + 4)) if k >= 0), default=-1)
                    at = size if close < 0 else page.find(">", close) + 1
                else:
                    close = page.find(">", lt)
                    at = size if close < 0 else close + 1
                continue
            ending = following == "/"
            m = _tag_name.match(page, lt + 1 + ending)
            if not m:
                self._words.append("<")
                at = lt + 1
                continue
            tag, at = m.group().lower(), m.end()
            named: dict[str, str] = {}
            while at < size:  # attributes; a tag that the page's end cuts off is none
                sign = _next.search(page, at)
                if not sign:
                    at, tag = size, ""
                    break
                if sign.group() == ">":
                    at = sign.end()
                    break
                word = _last_word.search(page[max(at, sign.start() - 64) : sign.start()].rstrip()).group().lower()
                at = _space.match(page, sign.end()).end()
                quote = page[at : at + 1]
                if quote in ('"', "'") and quote:
                    close = page.find(quote, at + 1)
                    if close < 0:
                        at, tag = size, ""
                        break
                    value, at = page[at + 1 : close], close + 1
                else:
                    bare = _bare.match(page, at)
                    value, at = bare.group(), bare.end()
                if word in ("class", "id", "role"):
                    named.setdefault(word, value.lower())
            else:
                tag = ""
            if not tag:
                break
            if tag in INLINE:
                if tag == "br":
                    self._words.append(" ")
                elif tag == "a" and not ending and (mark := self._top()[3]) >= 0:
                    self._marks[mark][1] += 1
            elif ending:
                self._ends(tag)
            elif tag in RAW:
                end = _raw_end[tag].search(page, at)
                close = page.find(">", end.end()) if end else -1
                if tag == "xmp":  # is shown as it stands
                    self._flush()
                    self._words.append(page[at : end.start() if end else size].replace("&", "&amp;"))
                    self._flush()
                at = size if close < 0 else close + 1
            else:
                self._starts(tag, named)
        self._flush()
        self._judge()

    def styles(self) -> list[tuple[int, int, int, bool]]:
        """(key, content, layout, within an article) of each node with text below it: hashes of the texts (in any order) and of how its children are laid out (runs of like children count once)."""
        total, many = [0] * len(self.parent), [0] * len(self.parent)
        for node, text, _ in self.blocks:
            total[node] += xxhash.xxh3_64_intdigest(text)
            many[node] += 1
        for node in range(len(self.parent) - 1, 0, -1):
            total[self.parent[node]] += total[node]
            many[self.parent[node]] += many[node]
        out = []
        for node in range(1, len(self.parent)):
            if many[node]:
                row = self.layout.get(node, [])
                runs = "\n".join(x for x, y in zip(row, ["", *row]) if x != y)
                out.append((_signed(self.key[node]), _signed((total[node] + many[node]) & _ALL), _signed(xxhash.xxh3_64_intdigest(runs)), self.content[node]))
        return out

    def kept(self, low: set[int], by_names: bool = True) -> list[str]:
        """Texts of the blocks that are neither apart nor at or below a node whose key is low."""
        gone = [False] * len(self.parent)
        for node in range(1, len(self.parent)):
            gone[node] = gone[self.parent[node]] or (not self.content[node] and _signed(self.key[node]) in low)
        return [text for node, text, apart in self.blocks if not gone[node] and not (apart and by_names)]


_ALL = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Weight of a node's content in its importance, beside its layout; on how many of a host's different pages the same content stands, on average, below a node that isn't important.
CONTENT_WEIGHT, REPEATS = 0.9, 2.0


def importance(pages: DataFrame, content_weight: float = CONTENT_WEIGHT) -> DataFrame:
    """(host, path, m, importance) over pages (host, html): entropies to the base of the number m of different pages that have the node. path is a hash; nodes of one page alone, and those in article or main, are left out."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            copy = xxhash.xxh3_128_digest(page or "")
            rows += [(host, path, copy, content, layout) for path, content, layout, within in Page(page or "").styles() if not within]
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["host", "path", "copy", "content", "layout"])

    nodes = per_batch(pages, spread, "host string, path long, copy binary, content long, layout long").distinct()
    both = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in enumerate(("content", "layout")))))
    seen = nodes.select("host", "path", both.alias("x")).groupBy("host", "path", "x.kind", "x.value").agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    sums = seen.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(n * F.log(n)).alias("s"))
    m = F.col("m").cast("double")
    entropy = (F.log(m) - F.col("s") / m) / F.log(m)
    weight = F.when(F.col("kind") == 0, content_weight).otherwise(1 - content_weight)
    return sums.where("m > 1").groupBy("host", "path").agg(F.max("m").alias("m"), F.sum(weight * entropy).alias("importance"))


def unimportant(nodes: DataFrame, repeats: float = REPEATS, content_weight: float = CONTENT_WEIGHT) -> DataFrame:
    """(host, low): hashes of the paths of each host that aren't important.

    The threshold depends on the number m of pages: it's the importance of a
    node of one layout whose contents stand on `repeats` pages each,
    content_weight * (1 - ln repeats / ln m). What stands on all of them has 0.
    """
    threshold = content_weight * (1 - F.log(F.lit(repeats)) / F.log(F.col("m").cast("double")))
    return nodes.where(F.col("importance") <= threshold + 1e-9).groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("low"))


def _with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))


#: Low paths (8 bytes each) and hosts that are broadcast at most; beyond, the pages are joined by host, and Spark splits large hosts.
BROADCAST_PATHS = 1_000_000


def _low(rows: DataFrame, repeats: float) -> DataFrame:
    low = Scratch(rows.sparkSession).settled(unimportant(importance(rows.select("host", "html")), repeats))
    size = low.agg(F.sum(F.size("low") + 4)).first()[0] or 0
    return F.broadcast(low) if size <= BROADCAST_PATHS else low


def main_text(pages: DataFrame, repeats: float = REPEATS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of pages.

    Blocks are joined by an empty line; white space inside a block is one
    space. A null html or a page without an article gives an empty text; pages
    with a null or odd url share the host ''. Copies of a page count as one page
    of the style tree, which judges a node from two different pages on and takes
    nothing out of article or main. Repeated rows stay, null ids too; other
    columns aren't read; an empty table gives no rows. A tag that the page's end
    cuts off, and what an unclosed quote swallows, is no text.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = _with_host(pages, id_col, url_col, html_col)
    joined = rows.join(_low(rows, repeats), "host", "left").select("id", "url", "html", "low")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n\n".join(Page(page or "").kept(set(gone or ()))) for page, gone in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return per_batch(joined, extract, f"page_id {kind}, url string, text string, n_chars long")


def removals(pages: DataFrame, repeats: float = REPEATS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(by_tree, by_names, by_both, kept): how many blocks of all pages the style tree alone takes out, the names alone, both, and how many stay."""
    rows = _with_host(pages, id_col, url_col, html_col)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for page, gone in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist()):
            x, low = Page(page or ""), set(gone or ())
            tree, names, either = len(x.kept(low, False)), len(x.kept(set())), len(x.kept(low))
            found.append((names - either, tree - either, len(x.blocks) - tree - names + either, either))
        columns = zip(*found) if found else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["by_tree", "by_names", "by_both", "kept"])

    counted = per_batch(rows.join(_low(rows, repeats), "host", "left").select("html", "low"), count, "by_tree long, by_names long, by_both long, kept long")
    return counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted.columns])
