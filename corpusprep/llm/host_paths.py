"""Main text of web pages by consensus of their host.

Every page's containers are scored by the prose they hold, and the page votes for the path of its
best one, the lowest that holds nearly all of it, generalised to tags and classes without digits.
Spark counts the votes per host. Each page is then extracted again with the first winning path of its
host that holds nearly all the prose of its own best container; a page that has none uses that. Menus, headers, footers, sidebars, notices, adverts, forms
and reader comments are left out wherever they stand.
"""

import html
import re
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import functions as F

from corpusprep.llm.common import attach, stored

#: A path is a winner of its host with at least this share of votes; so a host has at most 50.
SHARE = 0.02
#: Part of the prose that counts as nearly all of it.
COVER = 0.9

# The block-level elements of HTML, and those whose content is not prose.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div
dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend
li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr
ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("nav footer aside form button select dialog menu header head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
BOILERPLATE = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side
aside footer header masthead banner topbar toolbar cookie cookies consent gdpr notice notices alert
popup modal overlay newsletter subscribe subscription signup login ad ads adv advert adverts
advertisement advertising sponsor sponsored promo promotion share sharing social comment comments
commentlist discussion disqus reply replies respond related recommended recommendations widget
widgets pagination pager skip search hidden copyright legal""".split())
REMARKS = frozenset("comment comments commentlist discussion disqus reply replies respond".split())
ADVERTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo
promotion""".split())
CONTAINERS = frozenset("body main article section div td blockquote html center".split())

_RAW = "script|style|noscript|template|svg|iframe|object|textarea|title|math|canvas|audio|video"
# Outside quotes a tag ends at the next angle bracket, so each is looked at once however broken.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^<>]*+(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<tag2>[a-z][a-z0-9:-]*+)[^<>]*+>|<[!?/][^>]*+(?:>|\Z)|<[a-z][^<>]*+(?=<|\Z)",
    re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'"
                   r"|([^\s\"'>]+)))?", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: An opening tag closes an open element of these kinds.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_BARRIERS = frozenset("ul ol dl table article section div main body td th blockquote".split())


class Page:
    """Elements of a page with their paths, and its text blocks in page order."""

    def __init__(self, source):
        self.tag, self.path, self.parent, self.out = ["html"], ["html"], [-1], [False]
        # Left out by the words of its class or id alone.
        self.named = [False]
        self.blocks, self._text, self._links = [], [], 0
        # An inline element that is not shown: its tag, how often it is open, and the block's depth.
        muted = None
        stack, at, links = [0], 0, 0
        for m in _TOKEN.finditer(source):
            if m.start() > at and not muted:
                self._add(source[at:m.start()], links)
            at = m.end()
            tag = (m["tag"] or m["tag2"] or "").lower()
            if not tag:
                continue
            if m["end"] or source.startswith("</", m.start()):
                if muted and tag == muted[0]:
                    muted[1] -= 1
                    muted = muted if muted[1] else None
                if tag == "a":
                    links = max(0, links - 1)
                elif tag in BLOCKS or tag in LEFT_OUT:
                    self._end_block(stack[-1])
                    if tag in map(self.tag.__getitem__, stack[1:]):
                        while self.tag[stack.pop()] != tag:
                            pass
                    if muted and len(stack) < muted[2]:
                        muted = None
                continue
            if muted and tag == muted[0]:
                muted[1] += 1
            elif not muted and m["attrs"] and tag not in BLOCKS and tag not in LEFT_OUT and \
                    tag not in VOID and self._unseen(m["attrs"]):
                muted = [tag, 1, len(stack)]
            if tag == "br":
                self._text.append(" ")
            elif tag == "a":
                links = 1
            elif tag == "img" or tag not in BLOCKS and tag not in LEFT_OUT:
                continue
            else:
                self._end_block(stack[-1])
                if tag == "body":
                    del stack[1:]
                closes = _CLOSES.get(tag, ())
                for k in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[k]]
                    if name in closes or name == "p":
                        del stack[k:]
                        break
                    if name in _BARRIERS:
                        break
                links = 0
                if tag not in VOID and tag != "html":
                    stack.append(self._open(tag, m["attrs"] or "", stack[-1]))
        if at < len(source) and not muted:
            self._add(source[at:], links)
        self._end_block(stack[-1])
        self._settle()

    @staticmethod
    def _attributes(attrs):
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}

    @staticmethod
    def _hidden(found):
        return "hidden" in found or found.get("aria-hidden", "").lower() == "true" or \
            "display:none" in found.get("style", "").replace(" ", "").lower()

    def _unseen(self, attrs):
        """Whether an inline element is hidden or an advert."""
        found = self._attributes(attrs)
        names = {p.lower() for p in _PARTS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
        return self._hidden(found) or bool(names & ADVERTS)

    def _settle(self):
        """Decide what the words of a class or id leave out: not an element that holds an article
        or, on a page without one, more than half of its prose, as theme classes of layouts do."""
        held, articles, total = {}, set(), 0.0
        for element, text, links in self.blocks:
            if not self.out[element]:
                worth = self._worth(text, links)
                total += worth
                for k in self._line(element):
                    held[k] = held.get(k, 0.0) + worth
        for k, tag in enumerate(self.tag):
            if tag in ("article", "main") and held.get(k) and not self.named[k]:
                articles.update(self._line(self.parent[k]))
        for k in range(1, len(self.tag)):
            own = self.named[k] and k not in articles and (
                articles or held.get(k, 0.0) <= total / 2)
            self.out[k] = self.out[k] or own or self.out[self.parent[k]]

    def _open(self, tag, attrs, parent):
        found = self._attributes(attrs) if attrs else {}
        classes = re.sub(r"\d+", "", found.get("class", "")).split()
        names = {p.lower() for p in _PARTS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
        within = any(self.tag[k] in ("article", "main") for k in self._line(parent))
        out = named = False
        if tag == "article":
            named = bool(names & REMARKS)
        elif tag == "header":
            # The header of an article holds its headings; they are kept block by block.
            out = not within
        elif tag not in ("body", "main", "html"):
            out = tag in LEFT_OUT
            named = bool(names & BOILERPLATE) and not (within and names & BOILERPLATE == {"header"})
        out = out or found.get("role", "").lower() in ROLES or self._hidden(found)
        own = ".".join([tag, *sorted({c.lower() for c in classes})])
        self.tag.append(tag)
        self.path.append(f"{self.path[parent]}>{own}")
        self.parent.append(parent)
        self.out.append(out or self.out[parent])
        self.named.append(named)
        return len(self.tag) - 1

    def _line(self, k):
        while k >= 0:
            yield k
            k = self.parent[k]

    def _add(self, text, links):
        self._text.append(text)
        if links:
            self._links += len(text)

    def _end_block(self, element):
        if self._text:
            # References are decoded once the block's text is whole.
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((element, text, self._links / max(1, len(text))))
        self._text, self._links = [], 0

    def _kept(self, element):
        if self.out[element]:
            return False
        line = list(self._line(element))
        if self.tag[element] in ("h1", "h2", "h3", "h4", "h5", "h6"):
            return True
        return not any(self.tag[k] == "header" for k in line)

    def scores(self):
        """Prose of each container, with all that stands in it."""
        found = {}
        for element, text, links in self.blocks:
            if self._kept(element):
                for k in self._line(element):
                    if self.tag[k] in CONTAINERS:
                        found[k] = found.get(k, 0.0) + self._worth(text, links)
        return found

    @staticmethod
    def _worth(text, links):
        return len(text) * max(0.0, 1 - links) * (1 + text.count(",") / 20)

    def best(self):
        """The container to vote for: the lowest that holds nearly all prose of the page, or the
        article or main it stands in."""
        found = self.scores()
        if not found:
            return None
        # A page of links alone has no prose; its whole text is taken.
        least = COVER * found[0]
        # Elements are numbered in page order, so the last of a line of descent is its lowest.
        top = max(k for k, worth in found.items() if worth >= least) if least else 0
        outer = [k for k in self._line(top) if self.tag[k] in ("article", "main")]
        return outer[0] if outer else top

    def prose(self, elements):
        """Prose under any of the elements."""
        chosen = set(elements)
        return sum(self._worth(text, links) for element, text, links in self.blocks
                   if self._kept(element) and not chosen.isdisjoint(self._line(element)))

    def text(self, elements):
        """Kept blocks under any of the elements, joined by blank lines."""
        chosen = set(elements)
        return "\n\n".join(text for element, text, _ in self.blocks if self._kept(element)
                           and not chosen.isdisjoint(self._line(element)))

    def extract(self, winners):
        """Main text by the first of the host's `winners` (paths, most votes first) that holds
        nearly all prose of the page's own best container, else by that."""
        where = {}
        for k, path in enumerate(self.path):
            if not self.out[k]:
                where.setdefault(path, []).append(k)
        top = self.best()
        if top is None:
            return ""
        least = COVER * self.prose([top])
        for path in winners:
            if path in where and self.prose(where[path]) >= least:
                found = self.text(where[path])
                if found:
                    return found
        return self.text([top])


def host_of(url):
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


def _votes(batches):
    for batch in batches:
        count = {}
        for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            top = page.best()
            if top is not None:
                key = host_of(url), page.path[top]
                count[key] = count.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in count], pa.string()), pa.array([p for _, p in count],
                                                                     pa.string()),
             pa.array(list(count.values()), pa.int64())], ["host", "path", "votes"])


def winning_paths(pages):
    """`(host, paths)`: per host the paths with at least SHARE of its votes, most votes first."""
    votes = stored(pages.select("url", "html").mapInArrow(
        _votes, "host string, path string, votes long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes")), "page-votes")
    total = votes.groupBy("host").agg((F.sum("votes") * SHARE).alias("least"))
    ranked = votes.join(total, "host").filter("votes >= least").groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("p"))
    return stored(ranked.select("host", F.col("p.path").alias("paths")), "page-winners")


def _hosts(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([host_of(u) for u in batch.column(1).to_pylist()])],
            [*batch.schema.names, "host"])


def _extracted(batches):
    for batch in batches:
        ids, urls, sources, winners = (batch.column(k) for k in range(4))
        found = [Page(s or "").extract(w or []) for s, w in zip(sources.to_pylist(),
                                                               winners.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [ids, urls, pa.array(found, pa.string()),
             pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages):
    """`(page_id, url, text, n_chars)` for every row of `pages(page_id, url, html)`.

    A null or empty page has the empty text; a null or odd url is the host "". Repeated rows are
    extracted each. The text keeps everything in the winning containers but the kinds named above.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    hosted = rows.mapInArrow(_hosts, "page_id long, url string, html string, host string")
    # One row of at most 50 paths per host; broadcast while the hosts are few.
    joined = attach(hosted, winning_paths(rows), "host", "left")
    return joined.select("page_id", "url", "html", "paths").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long")
