"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import map_batches

#: Lines under a sliding window, and the share of a full window of middling text lines that counts as a surge where the page does
#: not mark its article. From TEXT_LINE characters on a line is taken for text and not for a label.
BLOCK = 3
SURGE = 0.2
TEXT_LINE = 40

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements whose content is never text of the page, read up to their end tag.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas"}
# Elements that hold something other than the article.
_ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
_ASIDE_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"}
_ASIDE_NAME = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|sidebar|side|footer|header|"
    r"masthead|comment|comments|reply|replies|respond|disqus|notice|cookie\w*|consent|gdpr|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|share|sharing|social|related|recommended|breadcrumb\w*|pagination|pager|widget|login|signup|toolbar)"
    r"(?:$|[-_\s\d])",
    re.I,
)
# An article whose own class or id says that it is a reader's response.
_RESPONSE_ARTICLE = re.compile(r"(?:^|\s)(?:comment|comments|reply|replies|respond|disqus)(?:$|[-_\s\d])", re.I)
# Those names that can stand on an element with most of a page's text without it being the article.
_RESPONSE = re.compile(r"(?:^|[-_\s])(?:comment|comments|reply|replies|respond|disqus)(?:$|[-_\s\d])", re.I)
_ARTICLE = {"article", "main"}
_BLOCK_TAG = {
    *("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form"
      " h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split()
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# An open element that a start tag of the same row closes.
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


class Line(NamedTuple):
    text: str
    aside: bool  # inside something other than the article
    article: bool  # inside what the page marks as its article
    linked: int  # characters inside links


class Named(NamedTuple):
    within: int  # the set-apart element by name around it, -1 if none
    response: bool  # named like readers' responses


def _set_apart(name: str, rest: str) -> str | None:
    """What sets an element apart: "kind" for its tag or role, else the class or id that does, None if nothing does."""
    if name in _ASIDE:
        return "kind"
    by_name = None
    for key, *values in _ATTRIBUTE.findall(rest):
        value = "".join(values)
        if key.lower() == "role":
            if value.lower() in _ASIDE_ROLE:
                return "kind"
        elif name == "article":
            if _RESPONSE_ARTICLE.search(value):
                return "kind"
        elif name not in {"html", "body", "main"} and _ASIDE_NAME.search(value):
            by_name = f"{by_name or ''} {value}"
    return by_name


def _wrappers(named: list[Named], own: list[int], free: int, around: set[int]) -> list[bool]:
    """Which elements set apart by name hold most of the page's text, and so wrap it: `own` is the text in each of them, in none
    of those inside it, and `free` that in none at all. Responses wrap it only if there is no text beside them, and where the page
    marks an article, only the elements `around` one do."""
    held, total = list(own), free + sum(own)
    for i in range(len(named) - 1, -1, -1):
        if named[i].within >= 0:
            held[named[i].within] += held[i]
    return [
        2 * n > total and (n == total or not x.response) and (not around or i in around)
        for i, (n, x) in enumerate(zip(held, named, strict=True))
    ]


class Endings:
    """Where a page closes its elements."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.known: dict[str, tuple[list[int], list[int], list[int]]] = {}

    def after(self, name: str, at: int) -> int:
        """How many elements of that name, open at `at`, are closed behind it."""
        if name not in self.known:
            places, level, levels = [], 0, []
            for tag in re.finditer(rf"<(/?){re.escape(name)}(?![^\s/>])", self.page, re.I):
                level += 1 if tag[1] else -1
                places.append(tag.start())
                levels.append(level)
            highest, most = [0] * len(levels), -(10**9)
            for i in range(len(levels) - 1, -1, -1):
                highest[i] = most = max(most, levels[i])
            self.known[name] = places, levels, highest
        places, levels, highest = self.known[name]
        i = bisect_left(places, at)
        return max(0, highest[i] - (levels[i - 1] if i else 0)) if i < len(places) else 0


def lines(page: str) -> list[Line]:
    """The page without markup, one line for each run of text between block tags.

    A name sets an element apart unless the element holds most of the page's text: then the name tells of the layout. An article
    inside an element that is set apart is part of it, unless that element is never closed: then it ends where the article starts.
    """
    endings = Endings(page)
    out: list[tuple[Line, int]] = []  # set apart by kind, and by which innermost element by name
    text: list[str] = []
    linked = at = 0
    stack: list[tuple[str, bool, int]] = []  # open elements, whether each is set apart, and its number if by name, else -1
    named: list[Named] = []
    around: set[int] = set()  # the numbers of elements set apart by name that hold an article, and -1 if there is an article
    aside = kinds = article = links = 0
    inner = -1

    def end_line() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append((Line(joined, kinds > 0, article > 0, linked), inner))
        text.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal aside, kinds, inner, article, links
        while len(stack) > upto:
            name, apart, number = stack.pop()
            aside -= apart
            if number >= 0:
                inner = named[number].within
            else:
                kinds -= apart
            article -= name in _ARTICLE
            links -= name == "a"

    def add(part: str) -> None:
        nonlocal linked
        if part:
            part = html.unescape(part) if "&" in part else part
            text.append(part)
            if links:
                linked += len(part)

    length = len(page)
    while at < length:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if name in _BLOCK_TAG:
            end_line()
        if found["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        if name in _RAW:
            ending = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = ending.end() if ending else length
            continue
        if name in _VOID or found["rest"].endswith("/"):
            continue
        if name in _ARTICLE and aside and not article:
            # An element set apart that its page never closes ends here at the latest.
            names = [x[0] for x in stack]
            for i, (open_name, apart, _) in enumerate(stack):
                if apart and endings.after(open_name, found.start()) < names.count(open_name):
                    close(i)
                    break
        if name in _BLOCK_TAG:
            # Inline elements that nobody closed go with the element around them.
            i = len(stack) - 1
            while i > 0 and stack[i][0] not in _BLOCK_TAG and stack[i][0] not in _ASIDE:
                i -= 1
            if i >= 0 and (stack[i][0] == "p" or stack[i][0] in _CLOSED_BY.get(name, ())):
                close(i)
        what = _set_apart(name, found["rest"])
        apart, number = what is not None, -1
        if what == "kind":
            kinds += 1
        elif what is not None:
            number = len(named)
            named.append(Named(inner, bool(_RESPONSE.search(what))))
            inner = number
        if name in _ARTICLE and not kinds:
            around.update(x[2] for x in stack)
            around.add(-1)
        stack.append((name, apart, number))
        aside += apart
        article += name in _ARTICLE
        links += name == "a"
    end_line()
    own, free = [0] * len(named), 0
    for line, number in out:
        if not line.aside:
            weight = max(0, len(line.text) - line.linked)
            if number >= 0:
                own[number] += weight
            else:
                free += weight
    shut: list[bool] = []
    for x, wraps in zip(named, _wrappers(named, own, free, around), strict=True):
        shut.append(not wraps or (x.within >= 0 and shut[x.within]))
    return [line._replace(aside=line.aside or (number >= 0 and shut[number])) for line, number in out]


def stretches(length: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, highest sum) of each stretch of lines between a surge and a dive.

    The sum of the text lengths over a window of `BLOCK` lines from each line on rises from nothing at a surge and falls to nothing at a
    dive.
    """
    total = np.cumsum(np.concatenate([[0], length, np.zeros(BLOCK - 1, np.int64)]))
    sums = total[BLOCK:] - total[:-BLOCK]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (sums > 0).astype(np.int8), [0]])))
    return [(int(a), int(b), int(sums[a:b].max())) for a, b in edges.reshape(-1, 2)]


def surging(length: np.ndarray) -> list[tuple[int, int, int]]:
    """The stretches that reach a share of a window of median text lines, or of the highest sum if that is less, so one very long
    line outweighs no other."""
    found = stretches(length)
    if not found:
        return []
    text = np.sort(length[length >= TEXT_LINE])
    middling = BLOCK * text[(len(text) - 1) // 2] if len(text) else np.inf
    least = SURGE * min(max(top for _, _, top in found), middling)
    return [x for x in found if x[2] >= least]


def main_text(page: str | None) -> str:
    """The text between surges and dives of the line-block distribution.

    Every line counts with its length, lines that are set apart with none, and outside a marked article mostly linked ones too. Lines
    are kept in the stretches between a surge and a dive that rise high enough, see `surging`.

    Where the page marks an article, the distribution of its lines is held against that of the lines beside it. If its own
    surging stretches hold no less text, the article is the main text, and every stretch of it is kept, however low; if
    they hold less, the mark is on a part of the page, such as a card, and the page is taken as if it had none.
    """
    found = lines(page or "")
    own = np.array([0 if x.aside or not x.article else len(x.text) for x in found], np.int64)
    plain = np.array([0 if x.aside or 2 * x.linked > len(x.text) else len(x.text) for x in found], np.int64)
    beside = np.where([x.article for x in found], 0, plain) if found else plain

    def held(length: np.ndarray) -> int:
        return sum(int(length[a:b].sum()) for a, b, _ in surging(length))

    marked = own.any() and held(own) >= held(beside)
    length = own if marked else plain
    return " ".join(found[k].text for a, b, _ in (stretches if marked else surging)(length) for k in range(a, b) if length[k])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every whole page and its length in code points.

    A null or empty page has an empty text. Markup that is never closed, very long pages and lines are read to their end. Rows
    with equal or null ids are kept. An empty table gives an empty result. Other columns are ignored.
    """

    def run(ids: list, urls: list, bodies: list) -> Iterator[dict]:
        texts = [main_text(b.decode() if b is not None else None) for b in bodies]
        yield {
            "page_id": ids,
            "url": [u.decode() if u is not None else None for u in urls],
            "text": texts,
            "n_chars": [len(t) for t in texts],
        }

    kept = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html")
    )
    return map_batches(kept, run, f"page_id {kept.dtypes[0][1]}, url string, text string, n_chars long")
