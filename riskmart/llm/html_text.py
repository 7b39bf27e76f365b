"""Main text of web pages by composite text density.

A page becomes a tree of its blocks and links (other elements only format text); scripts, styles, controls and hidden parts never count. Elements that by
name, role or class hold menus, page headers and footers, side columns, notices, adverts, forms or reader comments are evidence, not a verdict: such a
part goes only if it holds no article, main part or page title and no more than ``MOST_SHARE`` of the body's text outside links. Each remaining node
gets its composite text density: characters per tag, adjusted by the characters and tags inside links (counts of links that are 0 taken as 1; the logarithm's base is moved by 1, so that a page without links has one). A node's density sum adds the densities of its children, direct text being a child of its own. The
subtree with the greatest sum is content; the lowest density on the path from it up to the body is the threshold, and wherever a node reaches
it, the subtree with the greatest sum below it is content as well.

Text: character references decoded, white space inside a block turned into one space, blocks joined in page order by one space.

Defined cases: null or empty html gives an empty text with 0 characters, and so does a page without text. Broken markup (open elements, stray ends,
a tag cut off by the end) is read as browsers do in the common cases. Nothing is capped: the tree of a page is walked without recursion in time
linear in its length. Repeated rows stay separate rows; an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import batches_of, record

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*+(?:>|$)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$)|<(?P<odd_end>/?)(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|$)",
    re.S,
)
#: One attribute after another, so that neither a value nor the end of another name is taken for one.
_ATTR = re.compile(r"""(?P<name>[^\s"'>/=]+)(?:\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s"'>]+)))?|["'/=]""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption br".split()
)
_CLOSES_P = _BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
#: Nodes of the density tree: blocks and links. Other elements format text within a block and belong to it.
_NODES = _BLOCK - {"br"} | {"a"}
#: An opening tag ends these open elements.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_CUT = frozenset("head button select option datalist script style noscript template textarea title iframe object svg canvas audio video map".split())
_SUSPECT = frozenset("nav header footer aside form dialog menu".split())
#: A suspect part with more of the body's link-free text is the content.
MOST_SHARE = 0.75
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
_CUT_CLASS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion|tions)?|banners?|sidebars?|side|cookies?|consent|gdpr|notices?|notification|alerts?|"
    r"comments?|commentlist|respond|replies|disqus|nav|navbar|navigation|menus?|breadcrumbs?|footer|header|masthead|toolbar|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|subscription|signup|login|search|popup|modal|overlay|skip|pagination|pager|widget)(?:$|[\s_-])",
    re.I,
)
_KEEP = frozenset("html body article main".split())
_TITLES = frozenset("article main h1".split())
CUT, SUSPECT = 2, 1


def _verdict(name: str, attrs: str) -> int:
    """``CUT``: never content; ``SUSPECT``: not, unless it holds the content; 0: nothing against it."""
    if name in _CUT:
        return CUT
    found = SUSPECT if name in _SUSPECT else 0
    if not attrs or name in _KEEP:
        return found
    for m in _ATTR.finditer(attrs):
        kind, value = (m["name"] or "").lower(), m["a"] or m["b"] or m["c"] or ""
        if kind == "hidden" or kind == "aria-hidden" and value.lower() == "true":
            return CUT
        if kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return CUT
        if kind in ("class", "id") and _CUT_CLASS.search(value) or kind == "role" and value.lower() in _CUT_ROLES:
            found = SUSPECT
    return found


class Page:
    """Nodes in page order (a parent comes before its children) and the page's flow of texts and block edges."""

    def __init__(self, html: str):
        self.parent, self.name, self.end = [-1], ["#root"], [0]
        self.flow: list[tuple[int, str | None]] = []  # (node, text), or (node, None) at the edge of a block
        self.regions: list[list] = []  # suspect parts in page order: first and end of the flow, first and end of the nodes, holds a title
        self._parse(html)

    def _parse(self, html: str) -> None:
        stack, names, open_count, cut_at = [0], ["#root"], Counter(), 0  # cut_at: stack depth of the outermost cut element
        suspects: list[tuple[int, list]] = []  # stack depth and region of each open suspect element

        def pop() -> None:
            nonlocal cut_at
            node, name = stack.pop(), names.pop()
            open_count[name] -= 1
            if not cut_at and name in _BLOCK:
                self.flow.append((stack[-1], None))
            if cut_at and len(stack) < cut_at:
                cut_at = 0
            if suspects and len(stack) < suspects[-1][0]:
                suspects.pop()[1][1:4:2] = [len(self.flow), len(self.parent)]
            if stack[-1] != node:
                self.end[node] = len(self.parent)

        def close(name: str) -> None:
            if open_count[name] > 0:
                while names[-1] != name:
                    pop()
                pop()

        def say(text: str) -> None:
            if text and not cut_at:
                self.flow.append((stack[-1], unescape(text)))

        at = 0
        while m := _TAG.search(html, at):
            say(html[at : m.start()])
            at = m.end()
            name = (m["name"] or m["odd"] or "").lower()
            if not name:
                continue
            if m["end"] or m["odd_end"]:
                if name == "br":
                    self.flow.append((stack[-1], None))
                close(name)
                continue
            if name in _CLOSES_P and open_count["p"] > 0:
                close("p")
            for other in _ENDS.get(name, ()):
                if open_count[other] > 0 and names[-1] == other:
                    pop()
            if not cut_at and name in _BLOCK:
                self.flow.append((stack[-1], None))
            if name in _VOID:
                continue
            if name in _RAW:
                over = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?", re.I).search(html, at)
                at = over.end() if over else len(html)
                continue
            verdict = 0 if cut_at else _verdict(name, m["attrs"] or "")
            if verdict == CUT:
                cut_at = len(stack) + 1
            elif verdict == SUSPECT:
                region = [len(self.flow), 0, len(self.parent), 0, False]
                self.regions.append(region)
                suspects.append((len(stack) + 1, region))
            if not cut_at and name in _TITLES:
                for _, region in suspects:
                    region[4] = True
            is_node = not cut_at and name in _NODES
            if is_node:
                self.parent.append(stack[-1])
                self.name.append(name)
                self.end.append(len(self.parent))
            stack.append(len(self.parent) - 1 if is_node else stack[-1])
            names.append(name)
            open_count[name] += 1
        say(html[at:])
        while len(stack) > 1:
            pop()
        self.end[0] = len(self.parent)

    def main_text(self) -> str:
        n = len(self.parent)
        chars, tags, link_chars, link_tags, direct = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.name[i] == "a"
        in_body = [len("".join(text.split())) if text is not None and not in_link[node] else 0 for node, text in self.flow]
        whole, sums = sum(in_body), list(accumulate(in_body, initial=0))
        gone, off, done = [False] * len(self.flow), [False] * n, 0
        for first, end, low, high, titled in self.regions:  # an outer part comes first; what is inside a cut one is cut with it
            if first >= done and not titled and sums[end] - sums[first] <= MOST_SHARE * whole:
                gone[first:end], off[low:high] = [True] * (end - first), [True] * (high - low)
                done = end
        self.flow = [(node, None if gone[k] else text) for k, (node, text) in enumerate(self.flow)]
        for node, text in self.flow:
            if text is not None:
                size = len("".join(text.split()))
                direct[node] += size
                chars[node] += size
                if in_link[node]:
                    link_chars[node] += size
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + (not off[i])
            link_tags[p] += link_tags[i] + (self.name[i] == "a" and not off[i])
        body = next((i for i in range(n) if self.name[i] == "body"), 0)
        share = link_chars[body] / max(chars[body], 1)

        def density(i: int) -> float:
            c, t, lc, lt = chars[i], max(tags[i], 1), link_chars[i], link_tags[i]
            if not c:
                return 0.0
            base = log(c / max(c - lc, 1) * lc + share * c + e)
            return c / t * log(max(c / max(lc, 1) * t / max(lt, 1), 1.0 + 1e-9)) / log(base + 1)

        dense = [density(i) for i in range(n)]
        total = [d * log(d + 1) if not in_link[i] else 0.0 for i, d in enumerate(direct)]
        for i in range(n - 1, 0, -1):
            total[self.parent[i]] += dense[i]
        best = list(range(n))  # node with the greatest sum in each subtree; the outermost of equals
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if total[best[i]] > total[best[p]] or total[best[i]] == total[best[p]] and best[i] < best[p] and best[p] != p:
                best[p] = best[i]
        top = best[body]
        if not chars[top]:
            return ""
        threshold, i = dense[top], top
        while i != body and i > 0:
            i = self.parent[i]
            threshold = min(threshold, dense[i])
        content = [False] * n
        i = body
        while i < self.end[body]:
            if content[self.parent[i]] and i != body:
                content[i] = True
            elif dense[i] >= threshold and chars[i]:
                content[best[i]] = True
            i += 1
        blocks, words = [], []
        for node, text in self.flow:
            if text is None:
                blocks.append("".join(words))
                words = []
            elif content[node]:
                words.append(text)
        blocks.append("".join(words))
        return " ".join(" ".join(b.split()) for b in blocks if b and not b.isspace())


def main_text(html: str | None) -> str:
    return Page(html).main_text() if html else ""


EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield record(EXTRACTED, [batch.column("page_id"), batch.column("url"), texts, [len(t) for t in texts]])


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row."""
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return batches_of(df.sparkSession, rows, extract_batches, "page_id long, url string, text string, n_chars long").withColumnRenamed("page_id", id_col)
