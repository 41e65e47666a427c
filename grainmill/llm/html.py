"""Main text of web pages by tree scoring.

A page is parsed into a tree of elements in one pass (implied end tags of paragraphs and list items,
raw-text elements and unclosed tags are handled). Elements that are never article text are ruled
out by tag, role or class; a class or id counts only against elements whose text looks the part
(short or full of links, see ``ruled_out``), never against most of the page's text. Every block of text then passes points for its length and commas to its
parent, half of them to the grandparent and less further up; a container's points are discounted by
its link density, the best container is kept, or the article around it, with those of its siblings
that score well themselves. Kept blocks are joined in page order; nothing is cut from them.

Defined results: null html counts as empty and gives an empty text; a page of which class names
would leave nothing is taken again without them; repeated rows each get their row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, ship

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_READ = frozenset("class id role aria-hidden hidden style".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
GONE = frozenset("nav footer aside form noscript svg annotation annotation-xml canvas object button select dialog template menu head audio video map".split())
PARAGRAPH = frozenset("p pre td th li blockquote h1 h2 h3 h4 h5 h6 dd dt figcaption".split())
_CLOSES_P = BLOCK - {"br", "option", "body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
_SCOPE = frozenset("article aside body div figure footer form header html main nav section table td th ul ol blockquote".split())

_IMPLIED = {"li": (("li",),), "option": (("option",),), "dd": (("dd", "dt"),), "dt": (("dd", "dt"),), "td": (("td", "th"),), "th": (("td", "th"),), "tr": (("td", "th"), ("tr",))}

COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
NEGATIVE = COMMENTS | frozenset(
    "nav navbar navigation menu menus sidebar aside footer header masthead banner ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended"
    " recommendations breadcrumb breadcrumbs pagination pager toolbar widget widgets skip hidden copyright legal".split()
)
#: words that name parts of articles too
WEAK = frozenset(
    "related search social share sharing legal copyright header notice notices alert notification widget widgets toolbar skip recommended recommendations discussion navigation consent"
    " overlay promotion subscription advertising advertisement sponsor menu footer hidden login signup".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div ul ol dl table aside header footer nav form".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_POSITIVE = frozenset("article content post entry story main body text".split())
_BONUS = {"article": 30.0, "main": 25.0, "section": 3.0, "div": 3.0, "td": 2.0, "blockquote": 2.0}


class _Page:
    """Elements as parallel lists; element 0 is the page itself."""

    def __init__(self, source: str):
        self.tag, self.up, self.by_tag, self.by_name, self.comments, self.bonus = ["#"], [0], [False], [0], [False], [0.0]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or None where a block ends
        self.places: dict[str, list[int]] = {}  # tag to its open elements' places on the stack
        self.scopes, self.talk, self.cleared = [], 0, 0  # places of open containers; open comment sections; places cleared of class words
        stack, at = [0], 0
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self.events.append((stack[-1], source[at : m.start()]))
            at = m.end()
            name = m[2] or m[5]
            if not name:
                if m[0].startswith("<![CDATA["):
                    self.events.append((stack[-1], m[0][9:-3].replace("&", "&amp;")))
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._close(stack, name)
                continue
            attrs = m[3] if m[2] else m[6]
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            if name in _CLOSES_P:
                self._imply(stack, "p")
            for closed in _IMPLIED.get(name, ()):
                self._imply(stack, *closed)
            if name in BLOCK:
                self.events.append((stack[-1], None))
            if name in VOID or attrs.rstrip().endswith("/") and name not in BLOCK:
                continue
            self._open(stack, name, attrs)
        if at < len(source):
            self.events.append((stack[-1], source[at:]))
        self.events.append((0, None))

    def _open(self, stack: list[int], name: str, attrs: str) -> None:
        by_tag, by_name, comments, bonus = name in GONE, 0, False, _BONUS.get(name, 0.0)
        if "=" in attrs or "hidden" in attrs:
            for m in _ATTR.finditer(attrs):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
                if key not in _READ:
                    continue
                if key in ("class", "id"):
                    words = {w.lower() for w in _CAMEL.split(value) if w}
                    if words & NEGATIVE and not (key == "id" and (name in _HEADINGS or name == "p")):  # an anchor's id is made of the heading's words
                        strong = bool(words & NEGATIVE - WEAK) and (key == "class" or name in _BOXES or bool(words & COMMENTS - WEAK))
                        by_name = max(by_name, 1 + strong)
                        comments = comments or bool(words & COMMENTS - WEAK)
                    bonus += 10.0 * bool(words & _POSITIVE)
                elif key == "role":
                    by_tag = by_tag or value.lower() in _ROLES
                elif key == "aria-hidden":
                    by_tag = by_tag or value.lower() == "true"
                elif key == "hidden":
                    by_tag = True
                elif "display:none" in value.replace(" ", "").lower():
                    by_tag = True
        if name == "header" and not (self.places.get("article") or self.places.get("main")):
            by_tag = True
        if name in ("html", "body"):
            by_name, by_tag, comments = 0, False, False
        elif name in ("article", "main"):
            by_name = 2 * comments
            if not by_name and not self.talk:
                for i in stack[self.cleared :]:  # a wrapper of the article is no sidebar, whatever its class says
                    self.by_name[i] = 0
                self.cleared = len(stack)
        self.tag.append(name)
        self.up.append(stack[-1])
        self.by_tag.append(by_tag)
        self.by_name.append(by_name)
        self.comments.append(comments)
        self.bonus.append(bonus)
        self.places.setdefault(name, []).append(len(stack))
        if name in _SCOPE:
            self.scopes.append(len(stack))
        self.talk += comments
        stack.append(len(self.tag) - 1)

    def _cut(self, stack: list[int], k: int) -> None:
        """Close all elements from a place of the stack on."""
        while len(stack) > k:
            i = stack.pop()
            self.places[self.tag[i]].pop()
            self.talk -= self.comments[i]
        while self.scopes and self.scopes[-1] >= k:
            self.scopes.pop()
        self.cleared = min(self.cleared, k)

    def _imply(self, stack: list[int], *names: str) -> None:
        """Close an open element of these names, unless a container stands in between."""
        k = max((self.places[n][-1] for n in names if self.places.get(n)), default=0)
        if k and (not self.scopes or self.scopes[-1] <= k):
            self.events.append((stack[-1], None))
            self._cut(stack, k)

    def _close(self, stack: list[int], name: str) -> None:
        if name in BLOCK:
            self.events.append((stack[-1], None))
        if (open_ := self.places.get(name)) and (name in _SCOPE or not self.scopes or self.scopes[-1] <= open_[-1]):
            self._cut(stack, open_[-1])

    def ruled_out(self) -> list[bool]:
        """Whether an element's class or id rules it out, given the text it holds; spares page-wide forms.

        Strong words (2) rule out all but what holds most of the page's unlinked text, or long prose
        inside the article; weak words (1) only lists of links, and short bits outside the article.
        Comments are spared only around the page's headline, or nearly all of its text.
        """
        n = len(self.tag)
        size, links, link, gone, inside = [0] * n, [0] * n, [False] * n, [False] * n, [False] * n
        holds: list[set[str]] = [set() for _ in range(n)]
        for i in range(1, n):
            up = self.up[i]
            gone[i] = gone[up] or self.by_tag[i] and self.tag[i] != "form"
            link[i] = link[up] or self.tag[i] == "a"
            inside[i] = inside[up] or self.tag[up] in ("article", "main")
        for at, text in self.events:
            if text is not None and not gone[at]:
                k = len(" ".join(text.split()))
                size[at] += k
                links[at] += k * link[at]
        for i in range(n - 1, 0, -1):
            up = self.up[i]
            size[up] += size[i]
            links[up] += links[i]
            if size[i]:
                if self.tag[i] in _HEADINGS or self.tag[i] in ("p", "article", "main"):
                    holds[i].add(self.tag[i])
                holds[up] |= holds[i]
        prose = [k - j for k, j in zip(size, links)]
        for i in range(1, n):  # a word of a sentence, whatever it does when clicked
            if self.tag[i] == "button" and self.tag[self.up[i]] in ("p", "b", "i", "em", "strong", "span") and size[self.up[i]] >= 20:
                self.by_tag[i] = False
        for i in range(1, n):
            if self.tag[i] == "form" and self.by_tag[i] and 2 * prose[i] >= prose[0] and (prose[i] >= 140 or holds[i] & {"p", "h1", "article", "main"}):
                self.by_tag[i] = False
        out = [False] * n
        for i in range(1, n):
            if not self.by_name[i]:
                continue
            dense, most = links[i] > 0.3 * size[i], prose[i] >= 0.6 * prose[0] and bool(prose[i])
            if self.comments[i]:
                out[i] = not (most and ("h1" in holds[i] or prose[i] >= 0.9 * prose[0]))
            elif most:
                out[i] = False
            elif self.by_name[i] == 2:
                out[i] = dense or not inside[i] or prose[i] < 300
            else:
                out[i] = dense or not inside[i] and size[i] < 140 and not holds[i] & _HEADINGS
            if not out[i] and not inside[i] and not most:
                self.bonus[i] -= 25.0
        return out

    def blocks(self, names: list[bool]) -> list[tuple[int, str, int]]:
        """``(element, text, link characters)`` of the blocks that are not ruled out."""
        n = len(self.tag)
        gone, link = [False] * n, [False] * n
        for i in range(1, n):
            up = self.up[i]
            gone[i] = gone[up] or self.by_tag[i] or names[i]
            link[i] = link[up] or self.tag[i] == "a"
        block = list(range(n))
        for i in range(1, n):
            if self.tag[i] not in BLOCK:
                block[i] = block[self.up[i]]
        out, parts, owner, linked = [], [], 0, 0
        for at, text in self.events:
            if text is None:
                if parts:
                    text = " ".join(_html.unescape("".join(parts)).split())
                    if text:
                        out.append((owner, text, linked))
                    parts, linked = [], 0
            elif not gone[at]:
                if not parts:
                    owner = block[at]
                parts.append(text)
                if link[at]:
                    linked += len(text)
        return out


def _best(page: _Page, blocks: list[tuple[int, str, int]]) -> set[int]:
    """The elements whose text is kept."""
    n = len(page.tag)
    score, length, links, own = list(page.bonus), [0] * n, [0] * n, [False] * n
    for owner, text, linked in blocks:
        size = len(text)
        length[owner] += size
        links[owner] += min(linked, size)
        points = (1 + min(size / 100, 10.0) + text.count(",")) * (1 - min(linked / size, 1.0))
        at, share = (page.up[owner] if page.tag[owner] in PARAGRAPH else owner), 1.0
        for level in range(6):
            score[at] += points * share
            own[at] = True
            if not at:
                break
            at, share = page.up[at], 0.5 if level == 0 else 1 / (3 * (level + 1))
    for i in range(n - 1, 0, -1):
        length[page.up[i]] += length[i]
        links[page.up[i]] += links[i]
    final = [s * (1 - min(1.0, k / size)) if size and has else -1.0 for s, k, size, has in zip(score, links, length, own)]
    top = max(range(n), key=lambda i: (final[i], -i))
    at = top
    while at:  # the article around the best container, or else the page's main element
        if page.tag[at] in ("article", "main"):
            top = at
            if page.tag[at] == "article":
                break
        at = page.up[at]
    keep = {top}
    if top:
        best = final[top]
        for i in range(1, n):
            if i != top and page.up[i] == page.up[top] and length[i]:
                density = links[i] / length[i]
                same = page.tag[i] == page.tag[top] or page.tag[top] not in ("article", "main")
                if same and final[i] >= max(5.0, 0.2 * best) and density < 0.3:
                    keep.add(i)
                elif page.tag[top] not in ("article", "main") and page.tag[i] in ("p", "h1", "h2") and density < 0.25 and (length[i] > 80 or page.tag[i] != "p"):
                    keep.add(i)
    return keep


def main_text(source: str) -> str:
    """The page's article text; empty if there is none."""
    if not source or not source.strip():
        return ""
    page = _Page(source)
    blocks = page.blocks(page.ruled_out()) or page.blocks(page.comments) or page.blocks([False] * len(page.tag))
    if not blocks:
        return ""
    chosen = _best(page, blocks)
    kept = [i in chosen for i in range(len(page.tag))]
    for i in range(1, len(kept)):
        kept[i] = kept[i] or kept[page.up[i]]
    return " ".join(t for owner, t, _ in blocks if kept[owner])


def _extract(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        texts = [main_text(t) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
