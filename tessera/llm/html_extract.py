"""Operator 8, HTML extraction by two-pass block rules.

Pass 1 labels each block by where it stands, its stop-word density, length and
link density. Pass 2 gives blocks that are too short to tell the label of their
nearest decided neighbours, those of the same container first. Where the stop
words do not fit a page, length and link density decide alone; a page without any
article so far is judged by the density of its elements.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAME = re.compile(r"[a-zA-Z][^\s/><]*")
TAG_STOP = re.compile(r"[<>]|=\s*[\"']")
ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[^\W\d_]+")

# fixed values: element names of HTML
RAW = set("script style noscript template iframe svg math object title textarea canvas video audio".split())
UNCLOSED_HIDES = set("script style title textarea".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
            "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
OUTSIDE = set("aside button dialog fieldset footer head menu nav search select".split())
CLOSES_P = BLOCK - {"body", "html"}
# fixed values: words in class, id and role that mark what is not the article
MARKS = set("ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary "
            "consent contentinfo cookie cookies dialog discussion disqus footer login masthead menu modal nav navbar "
            "navigation newsletter notice notification pager pagination popup promo promoted promotion recommended "
            "related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
            "toolbar topbar widget".split())
# fixed values: frequent words of English, German, French and Spanish
STOP = set("a an and are as at be by for from has have he in is it its not of on or that the this to was were with "
           "auch auf aus das dem den der des die ein eine für im ist mit nicht sich sie und von zu "
           "au aux avec dans de du elle en est et il la le les par pas pour que qui se sur un une "
           "al como con del el las lo los más no para por su".split())

# elements that hold one block each; what lies around them is judged as a whole
LEAF = set("address blockquote center dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th tr".split())

LONG = 140              # characters from which a block is judged by its words
STOP_SHARE = 0.15       # share of stop words from which a long block is text
LINK_SHARE = 0.4        # share of a block's characters in links from which it is a menu
MOST = 0.5              # share of a page's dense long blocks that an element cannot hold without being the article's

GOOD, BAD, OPEN = 1, 0, None


class Page:
    """Splits a page into blocks: (text, characters in links, container number), in page order; ``boxes`` has the element around each.

    One position runs over the source; whatever is left open, no part is read
    twice. A quote counts only at the start of an attribute's value, and a tag that the next
    one begins in ends there.
    """

    def __init__(self, source: str):
        self.source = source
        self.blocks: list[tuple[str, int, int]] = []
        self.kinds = ["plain"]                # per container: article, header, outside, marked (by a whole name) or hinted (by a part, or a form)
        self.parents = [0]
        self.stack: list[tuple[str, int, int]] = []      # name, container, element around its blocks
        self.opened: dict[str, int] = {}
        self.boxes: list[int] = []
        self.elements = 0
        self.text: list[str] = []
        self.linked = self.in_link = 0
        self.nexts: dict[str, int] = {}
        at, end = 0, len(source)
        while at < end:
            lt = source.find("<", at)
            if lt < 0:
                self.add(source[at:])
                break
            if lt > at:
                self.add(source[at:lt])
            at = self.markup(lt)
        self.flush()
        self.resolve()

    def next(self, what: str, at: int) -> int:
        """Where ``what`` is found next, the end of the page if nowhere; asked at growing places."""
        found = self.nexts.get(what, -1)
        if found < at:
            found = self.source.find(what, at)
            self.nexts[what] = found = len(self.source) if found < 0 else found
        return found

    def markup(self, lt: int) -> int:
        """Handles what begins at ``<``; returns the place after it."""
        source, end = self.source, len(self.source)
        if source.startswith("<!--", lt):
            stop = self.next("-->", lt + 2)
            return stop + 3 if stop < end else min(self.next(">", lt) + 1, end)
        first = source[lt + 1:lt + 2]
        if first in ("!", "?"):
            return min(self.next(">", lt) + 1, end)
        m = NAME.match(source, lt + 2 if first == "/" else lt + 1)
        if m is None:
            self.add("<")
            return lt + 1
        name, stop = m.group().lower(), m.end()
        gt, lt2 = self.next(">", stop), self.next("<", stop)
        attrs = source[stop:gt] if gt < lt2 else None
        if attrs is None or "'" in attrs or attrs.count('"') % 2:
            gt, after = self.tag_end(stop)
            attrs = source[stop:gt]
        else:
            after = min(gt + 1, end)
        if first == "/":
            self.close(name)
        elif name in RAW:
            if not attrs.endswith("/"):
                return self.raw(name, after)
        else:
            self.open(name, attrs)
        return after

    def tag_end(self, at: int) -> tuple[int, int]:
        while m := TAG_STOP.search(self.source, at):
            if m.group() in "<>":
                return m.start(), m.start() + (m.group() == ">")
            quote = self.next(m.group()[-1], m.end())
            at = quote + 1 if quote < len(self.source) else m.end()
        return len(self.source), len(self.source)

    def raw(self, name: str, at: int) -> int:
        """The place after an element whose content is no text; one that is never closed hides the rest only if it is a script or the like."""
        if self.nexts.get("</" + name) != len(self.source):
            m = re.compile(rf"</{re.escape(name)}\b[^<>]*>?", re.I).search(self.source, at)
            if m:
                return m.end()
            self.nexts["</" + name] = len(self.source)
        return len(self.source) if name in UNCLOSED_HIDES else at

    def resolve(self) -> None:
        """The role of each container: 0 plain, 1 article, -1 outside the article; ``owner`` is the one it is judged with.

        A mark is evidence only: an element that holds most of the page's dense
        long text stays in, if the mark is a part of a name or a form; one that is
        named as a whole stays in if that text lies in an article within it.
        """
        n = len(self.kinds)
        dense, own = [0] * n, [0] * n                         # characters of dense long blocks: all, and in articles
        article = [False] * n
        for c in range(1, n):
            p = self.parents[c]
            article[c] = self.kinds[c] == "article" or article[p] and self.kinds[c] not in ("outside", "marked")
        for t, linked, c in self.blocks:
            if len(t) >= LONG and linked <= LINK_SHARE * len(t) and is_dense(t):
                dense[c] += len(t)
                own[c] += len(t) * article[c]
        for c in range(n - 1, 0, -1):
            dense[self.parents[c]] += dense[c]
            own[self.parents[c]] += own[c]
        self.roles, owner = [0] * n, [0] * n
        for c in range(1, n):
            p, kind = self.parents[c], self.kinds[c]
            inside, most = self.roles[p], MOST * dense[0]
            role = inside
            if inside >= 0:
                if kind == "article":
                    role = 1
                elif kind == "header":
                    role = inside or -1
                elif kind == "hinted":
                    role = inside if dense[c] and dense[c] >= most else -1
                elif kind in ("outside", "marked"):
                    role = inside if own[c] and own[c] >= most else -1
            self.roles[c], owner[c] = role, owner[p] if role == inside else c
        self.blocks = [(t, linked, owner[c]) for t, linked, c in self.blocks]

    @property
    def container(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def add(self, text: str) -> None:
        self.text.append(text)
        if self.in_link:
            self.linked += len(text)

    def flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                self.blocks.append((text, self.linked, self.container))
                self.boxes.append(self.stack[-1][2] if self.stack else 0)
            self.text = []
        self.linked = 0

    def open(self, name: str, attrs: str) -> None:
        if name == "br":
            self.add(" ")
        elif name == "a":
            low = attrs.lower()                              # an anchor with a name and no target is no link
            self.in_link = int("href" in low or not ("name" in low or "id" in low))
        if name not in BLOCK:
            return
        self.flush()
        if name in CLOSES_P and self.stack and self.stack[-1][0] == "p":
            self.pop()
        if name in ("li", "option") and self.stack and self.stack[-1][0] == name:
            self.pop()
        if name in VOID or name in ("html", "body"):
            return
        now, kind = self.container, self.kind(name, attrs)
        if kind:
            self.kinds.append(kind)
            self.parents.append(now)
            now = len(self.kinds) - 1
        self.elements += 1
        self.opened[name] = self.opened.get(name, 0) + 1
        self.stack.append((name, now, (self.stack[-1][2] if self.stack else 0) if name in LEAF else self.elements))

    def pop(self) -> str:
        name = self.stack.pop()[0]
        self.opened[name] -= 1
        return name

    def close(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name not in BLOCK:
            return
        self.flush()
        self.in_link = 0
        if self.opened.get(name):
            while self.pop() != name:
                pass

    @staticmethod
    def kind(name: str, attrs: str) -> str | None:
        """What a new element opens; None if it belongs to the container around it."""
        if name in OUTSIDE:
            return "outside"
        out = "header" if name == "header" else "hinted" if name == "form" else None
        whole = name in ("article", "main")
        if attrs and ("=" in attrs or "hidden" in attrs):
            found = {k.lower(): (a or b or c).lower() for k, a, b, c in ATTR.findall(attrs)}
            if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", "")):
                return "outside"
            names = set(" ".join(found.get(k, "") for k in ("class", "id", "role")).split())
            if names & MARKS:
                return "marked"
            parts = set(re.split(r"[^a-z0-9]+", " ".join(names)))
            if parts & MARKS and not whole:
                return "hinted"
            if "header" in parts and not whole:
                return "header"
            if found.get("role") == "main":
                return "article"
        return "article" if whole else out


def is_dense(text: str) -> bool:
    words = WORD.findall(text.lower())
    return bool(words) and sum(w in STOP for w in words) >= STOP_SHARE * len(words)


def decide(text: str, linked: int, role: int):
    """Pass 1: the label of a block by itself, or OPEN."""
    if role < 0:
        return BAD
    if linked > LINK_SHARE * len(text) and not role:
        return BAD
    if len(text) < LONG:
        return OPEN
    return GOOD if is_dense(text) else OPEN if role else BAD


def in_other_words(page: Page, first: list) -> list:
    """Labels of pass 1 where stop words fit less than half of the long blocks outside an article: all of these are good."""
    long = [i for i, (t, n, c) in enumerate(page.blocks)
            if not page.roles[c] and len(t) >= LONG and n <= LINK_SHARE * len(t)]
    size = lambda at: sum(len(page.blocks[i][0]) for i in at)
    if any(r > 0 for r in page.roles) or 2 * size(i for i in long if first[i]) >= size(long):
        return first
    long = set(long)
    return [GOOD if i in long else x for i, x in enumerate(first)]


def dense_elements(page: Page, first: list) -> list[str]:
    """The short blocks of elements that hold much text and few links."""
    total, linked = {}, {}
    for (t, n, c), box in zip(page.blocks, page.boxes):
        if not page.roles[c]:
            total[box] = total.get(box, 0) + len(t)
            linked[box] = linked.get(box, 0) + min(n, len(t))
    return [t for (t, _, c), box, x in zip(page.blocks, page.boxes, first)
            if x is None and not page.roles[c] and total[box] - linked[box] >= LONG and linked[box] <= LINK_SHARE * total[box]]


def main_text(source: str | None) -> str:
    """The article's blocks, one to a line; empty if there is none."""
    page = Page(source or "")
    first = in_other_words(page, [decide(t, n, page.roles[c]) for t, n, c in page.blocks])
    decided = [i for i, x in enumerate(first) if x is not None]
    out = []
    per_container: dict[int, list[int]] = {}
    for i in decided:
        per_container.setdefault(page.blocks[i][2], []).append(i)
    for i, (t, _, c) in enumerate(page.blocks):
        label = first[i]
        if label is None:
            near = per_container.get(c)
            if near:
                label = _nearest(near, i, first)
            else:                                # no decided block beside it: an article is one by its name
                label = GOOD if page.roles[c] > 0 else _nearest(decided, i, first)
        if label:
            out.append(t)
    return "\n".join(out or dense_elements(page, first))


def _nearest(at: list[int], i: int, label: list) -> int:
    """The label of the decided block closest to i; of two as close, good wins."""
    from bisect import bisect_left

    k = bisect_left(at, i)
    sides = [(abs(at[j] - i), -label[at[j]]) for j in (k - 1, k) if 0 <= j < len(at)]
    return -min(sides)[1] if sides else BAD


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    The text is the article without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles, comments. Character references are decoded, white space in a
    block is one space, blocks are joined by a line feed. A null or empty page,
    and one without an article, has an empty text. Ids and urls pass as they
    are, null or repeated; other columns are left behind. A page is parsed whole
    in one pass; nothing is shuffled.
    """
    def run(batches):
        for b in batches:
            texts = [main_text(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
