"""Main text of HTML pages by tag-path ratios.

Every piece of text has a path of block elements from the root. Per path, text length and punctuation are summed over the
page; the ratios of both to the number of pieces are smoothed over neighbouring paths in page order and fused into one
score. Paths whose score reaches a threshold hold content. All that stands in an article element with most of it belongs
to the article, without one all text of content paths, but for elements that never are article text (menus, forms,
adverts, comments).
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.words import batches, lean

# Fixed names of HTML.
NAMELESS = "area base br col embed hr img input link meta param source track wbr"
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul"
)
NO_TEXT = "noscript template iframe object svg canvas audio video math select button datalist"
#: Of these, the ones that stand within their own kind.
NESTED = "template object svg"
NOT_ARTICLE = "nav footer aside form menu dialog head"
#: No tags but their own end within them.
RAW = "script|style|textarea|title"
#: Words of class, id and role names that mark what surrounds an article.
SURROUNDS = (
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header hidden masthead "
    "menu modal nav navbar navigation newsletter notice notification notifications pager pagination popup promo promoted promotion related replies reply share "
    "sharing shoutbox sidebar skip social sponsor sponsored sponsors subscribe tags toolbar widget widgets"
)
#: A heading's own element; only outside an article is it the head of a page.
PAGE_HEAD = "header"

VOID, BLOCK, SILENT, NESTS, OUTSIDE, MARKED = (frozenset(x.split()) for x in (NAMELESS, BLOCKS, NO_TEXT, NESTED, NOT_ARTICLE, SURROUNDS))
#: Blocks that do not end a silent element whose end tag is missing.
CHOICES = frozenset(("option", "optgroup"))
#: What an opening tag closes if it is still open, within the nearest of the elements after the colon.
IMPLIED = "li: li < ul ol menu, dt: dt dd < dl, dd: dt dd < dl, tr: tr < table, td: td th < tr table, th: td th < tr table, option: option < select"
CLOSES = {name: tuple(frozenset(x.split()) for x in rule.split("<")) for name, rule in (x.split(": ") for x in IMPLIED.split(", "))}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + RAW + r")(?=[\s/>])(?P<own>[^>]*)>|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*+)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
CUT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
NO_LETTER = re.compile(r"[^a-zA-Z]+")
PUNCTUATION = re.compile(r"[,.;:!?…。，；：！？、]")
BLANK = re.compile(r"\s+")

class Page:
    """Block elements of a page by number (0: the root) and its pieces of text in page order, in one pass."""

    def __init__(self, page: str):
        self.parent, self.name, self.outside, self.marked = [0], [""], [False], [False]
        self.path, self._paths = [0], {}
        self.pieces: list[tuple[int, str]] = []
        held: list[str] = []
        stack, self._open = [0], {}
        silent, inner, loose, closed = [], {}, False, None
        endless: set[str] = set()
        at = 0

        def end_of(name: str) -> int:
            """Behind the end tag of a raw element that begins before ``at``, or where what is around it goes on without one."""
            if name not in endless and (found := _end_tag(name).search(page, at)):
                return found.end()
            endless.add(name)
            if name in ("title", "textarea"):
                return found if (found := page.find("<", at)) >= 0 else len(page)
            around = "|".join(sorted(x for x, n in self._open.items() if n))
            found = _end_tag(around).search(page, at) if around else None
            return found.start() if found else len(page)

        def settle():
            if held:
                text = BLANK.sub(" ", html.unescape("".join(held))).strip()
                held.clear()
                if text:
                    self.pieces.append((stack[-1], text))

        def close(down_to: int):
            for element in stack[down_to:]:
                self._open[self.name[element]] -= 1
            del stack[down_to:]

        while at < len(page):
            token = TOKEN.match(page, at)
            at = token.end()
            if token["text"] is not None:
                if not silent:
                    held.append(token["text"])
                continue
            if token["raw"]:
                raw = token["raw"].lower()
                if not token["own"].endswith("/"):
                    at = end_of(raw)
                continue
            if token["name"] is None:
                continue
            name = token["name"].lower()
            ended = bool(token["close"])
            if silent:
                if ended and inner.get(name):
                    while True:
                        last = silent.pop()
                        inner[last] -= 1
                        if last == name:
                            break
                    continue
                if ended and (self._open.get(name) or loose and name not in BLOCK and name not in SILENT) or not ended and loose and len(silent) == 1 and name in BLOCK and name not in CHOICES:
                    silent.clear()
                    inner.clear()
                else:
                    if not ended and name not in VOID and not (token["rest"] or "").endswith("/") and (loose or name in BLOCK or name in SILENT):
                        silent.append(name)
                        inner[name] = inner.get(name, 0) + 1
                    continue
            if name in SILENT:
                if not ended and not (token["rest"] or "").endswith("/"):
                    closed = _closed(page) if closed is None else closed
                    silent.append(name)
                    inner[name] = 1
                    loose = token.start() not in closed
                continue
            if name not in BLOCK:
                if name == "br":
                    held.append(" ")
                continue
            settle()
            if ended:
                if self._open.get(name):
                    close(next(i for i in range(len(stack) - 1, 0, -1) if self.name[stack[i]] == name))
                continue
            if self.name[stack[-1]] == "p":
                close(len(stack) - 1)
            likes, stops = CLOSES.get(name, ((), ()))
            if any(self._open.get(x) for x in likes):
                near = next((i for i in range(len(stack) - 1, 0, -1) if self.name[stack[i]] in likes | stops), 0)
                if self.name[stack[near]] in likes:
                    close(near)
            attributes = token["rest"] or ""
            if name not in VOID and not attributes.endswith("/"):
                self._add(name, attributes, stack)
        settle()
        self._condemn()

    def _add(self, name: str, attributes: str, stack: list[int]) -> None:
        above = stack[-1]
        out = self.outside[above] or name in OUTSIDE or name == PAGE_HEAD and not (self._open.get("article") or self._open.get("main"))
        marked = False
        if not out and attributes and name not in ("html", "body"):
            words = {w.lower() for own in NAMES.findall(attributes) for cut in (CUT, NO_LETTER) for w in cut.split("".join(own))}
            marked = not MARKED.isdisjoint(words)
            out = name not in ("article", "main") and HIDDEN.search(attributes) is not None
        stack.append(len(self.parent))
        self._open[name] = self._open.get(name, 0) + 1
        self.parent.append(above)
        self.name.append(name)
        self.outside.append(out)
        self.marked.append(marked)
        self.path.append(self._paths.setdefault((self.path[above], name), len(self._paths) + 1))

    def _condemn(self) -> None:
        """Put outside the marked elements that hold no article and little of the text around them.

        The text around is that of the nearest article or main element above, or of the page; little is less than half,
        or less than three quarters if there is an article in it elsewhere. An article within another, or marked itself,
        is none here: comments are often written so.
        """
        if True not in self.marked:
            return
        count = len(self.parent)
        length, scope, holds, nested = [0] * count, [0] * count, [False] * count, [False] * count
        for e, text in self.pieces:
            length[e] += len(text) * (not self.outside[e])
        for e in range(1, count):
            above = self.parent[e]
            scope[e] = above if self.name[above] in ("article", "main") else scope[above]
            nested[e] = nested[above] or self.name[above] == "article"
        for e in range(count - 1, 0, -1):  # an element's number is larger than its parent's
            length[self.parent[e]] += length[e]
            own = self.name[e] == "main" or self.name[e] == "article" and not nested[e]
            holds[self.parent[e]] |= holds[e] or own and not self.outside[e] and not self.marked[e] and length[e] > 0
        for e in range(1, count):
            little = 4 * length[e] < (3 if holds[scope[e]] else 2) * length[scope[e]]
            condemned = self.marked[e] and self.name[e] not in ("article", "main") and not holds[e] and little
            self.outside[e] = self.outside[e] or self.outside[self.parent[e]] or condemned


@lru_cache
def _end_tag(names: str) -> re.Pattern:
    return re.compile(f"</(?:{names})(?=[\\s/>])[^>]*>", re.I)


def _closed(page: str) -> set[int]:
    """Where the silent elements begin that have an end tag of their own."""
    begun, closed = {}, set()
    for token in TOKEN.finditer(page):
        if token["name"] and (name := token["name"].lower()) in SILENT:
            own = begun.setdefault(name, [])
            if token["close"]:
                if own:
                    closed.add(own.pop())
            elif not (token["rest"] or "").endswith("/"):
                if name not in NESTS:
                    own.clear()
                own.append(token.start())
    return closed


def path_scores(found: list[tuple[int, str]]) -> dict[int, float]:
    """Fused score of every path of ``(path, text)``: the geometric mean of smoothed text and punctuation ratios."""
    length, marks, pieces = {}, {}, {}
    for path, text in found:
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
        pieces[path] = pieces.get(path, 0) + 1
    paths = list(length)  # in page order

    def smoothed(values: list[float]) -> list[float]:
        return [(sum(values[max(i - 1, 0) : i + 2]) + 2 * values[i]) / (len(values[max(i - 1, 0) : i + 2]) + 2) for i in range(len(values))]

    text_ratio = smoothed([length[p] / pieces[p] for p in paths])
    mark_ratio = smoothed([(1 + marks[p]) / pieces[p] for p in paths])
    return {p: math.sqrt(t * m) for p, t, m in zip(paths, text_ratio, mark_ratio, strict=True)}


def main_text(page: str | None) -> str:
    """The article's blocks, joined by an empty line; empty for a page without text.

    Paths that score at least half the mean over all text are content. The article is the ``article`` or ``main`` element
    that has, with its siblings of that name, at least half of the content (the most, then the innermost), and these
    siblings; all their blocks count. Without one it is everything from the first block of a content path to the last,
    the first one's siblings before it and all that follows in the element of the last one, unless that element is the
    body, and every heading of the page.
    """
    tree = Page(page or "")
    found = [(e, text) for e, text in tree.pieces if not tree.outside[e]]
    if not found:
        return ""
    scores = path_scores([(tree.path[e], text) for e, text in found])
    mean = sum(scores[tree.path[e]] * len(text) for e, text in found) / sum(len(text) for _, text in found)
    content = {p for p, s in scores.items() if 2 * s >= mean}
    weight = [0] * len(tree.parent)
    for e, text in found:
        weight[e] += len(text) * (tree.path[e] in content)
    for e in range(len(weight) - 1, 0, -1):  # an element's number is larger than its parent's
        weight[tree.parent[e]] += weight[e]
    siblings: dict[tuple[int, str], list[int]] = {}
    for e in range(1, len(weight)):
        if tree.name[e] in ("article", "main"):
            siblings.setdefault((tree.parent[e], tree.name[e]), []).append(e)
    held = {own[0]: sum(weight[e] for e in own) for own in siblings.values()}
    named = max((own for own in siblings.values() if 2 * held[own[0]] >= weight[0]), key=lambda own: (held[own[0]], own[0]), default=None)
    if named:
        inside = _within(tree, named)
        return "\n\n".join(text for e, text in found if inside[e])
    at = [i for i, (e, _) in enumerate(found) if tree.path[e] in content]
    first, last = (tree.parent[found[i][0]] if found[i][0] else 0 for i in (at[0], at[-1]))
    own = [e and tree.name[e] not in ("html", "body") for e in (first, last)]
    inside = _within(tree, [last] if own[1] else [])

    def kept(i: int, e: int) -> bool:
        return at[0] <= i <= at[-1] or i < at[0] and own[0] and tree.parent[e] == first or i > at[-1] and inside[e] or tree.name[e] in ("h1", "h2", "h3")

    return "\n\n".join(text for i, (e, text) in enumerate(found) if kept(i, e))


def _within(tree: Page, elements: list[int]) -> list[bool]:
    """Which elements are one of ``elements`` or stand in one."""
    inside = [False] * len(tree.parent)
    for e in elements:
        inside[e] = True
    for e in range(1, len(inside)):
        inside[e] = inside[e] or inside[tree.parent[e]]
    return inside


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of ``pages``: key, url, ``text`` (empty if there is none) and ``n_chars``, its code points.

    The whole page is read; a null or empty page has no text. Rows that repeat a key are pages of their own. Row-local:
    nothing is shuffled, a task holds a piece of a batch at a time.
    """

    def extracted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in lean(parts):
            for a, b in batches(part.column(2)):
                own = part.slice(a, b - a)
                texts = [main_text(x) for x in own.column(2).to_pylist()]
                yield pa.record_batch([own.column(0), own.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [key, url, "text", "n_chars"])

    return pages.select(F.col(key).cast("long").alias(key), F.col(url).cast("string").alias(url), page).mapInArrow(extracted, f"{key} long, {url} string, text string, n_chars long")
