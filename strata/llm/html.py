"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped so that each block of the page is a line.  A line's length is its text outside links and outside
elements that are never an article's (menus, headers, footers, sidebars, forms, notices, adverts, comments).  Lengths are summed over windows of
lines: where the sum reaches a threshold is a surge, where it falls to nothing a dive, and what stands
between is kept, but for lines of no length.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import field, map_text

COLUMNS = ["text", "n_chars"]
#: Lines of a window, and the length within a window that is certainly a text's.
WINDOW, SURGE = 3, 86
# Elements by what they are for.
_DROPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "textarea", "select", "button", "audio", "video", "map"}
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp", "noembed", "noframes"}
_ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption",
           "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "ol", "optgroup", "option", "p", "pre",
           "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"} | _ASIDE
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "form", "menu", "menubar"}
_ASIDE_NAME = (
    r"(?:ads?|advert\w*|banner\w*|breadcrumbs?|cookies?|consent|gdpr|comments?|comment-?list|disqus|respond|replies|reply|footer|"
    r"masthead|menus?|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|modal|overlay|promo\w*|related|recommend\w*|share|sharing|"
    r"sidebar|site-?header|page-?header|top-?bar|social|sponsor\w*|subscribe|signup|sign-?up|login|skip|toolbar|widgets?)")
#: A class or id is judged as a whole: words before a name of the list say whose it is, words after it what kind of box.
_ASIDE_CLASS = re.compile(rf"(?!(?:has|no|not|with|without|show|hide|is|in|under|above|below)[-_])(?:[a-z0-9]+[-_]+)*{_ASIDE_NAME}(?:[-_]+[a-z0-9]+)*\d*", re.I)
_COMMENTS = re.compile(r"comment|disqus|respond|repl(?:y|ies)", re.I)
#: The share of a page's text outside links from which on an element is the page's content, whatever its class says.
_MOST = 0.6
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(?=/?[a-zA-Z!?])[^<]*$", re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


def _is_aside(tag: str, attributes: str, in_article: bool) -> str | None:
    """Whether an element is a side part: by its tag, role or style ('sure'), or by the class or id that is given back."""
    if tag in _ASIDE or tag == "header" and not in_article:
        return "sure"
    if not attributes or tag in ("html", "body", "main", "article"):
        return None
    for name, *values in _NAMED.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in _ASIDE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and re.search(r"display\s*:\s*none", value):
            return "sure"
        if name in ("class", "id") and (found := next((x for x in value.split() if _ASIDE_CLASS.fullmatch(x)), None)):
            return found
    return None


def lines_of(html: str, content: frozenset[int] = frozenset()) -> list[tuple[str, int, bool, int]]:
    """The blocks of a page in order: text, its length outside links and side elements, whether it is outside side elements
    at all, and the number of the article element around it (0 without one).

    An element whose class makes it a side part, but which holds most of the page's text, is the content after all (if it
    isn't comments): the page is then read once more with these elements, numbered in order, as ``content``.
    """
    lines: list[tuple[str, int, bool, int]] = []
    parts: list[tuple[str, bool]] = []  # of the open block: text, and whether it counts
    opened: list[tuple[str, bool]] = []  # open elements, and whether each begins a side part
    aside = dropped = links = articles = number = total = within = 0
    outside = False
    doubted: list[int] = []  # elements that are side parts by their class: text in them
    marks: dict[int, int] = {}  # depth of an open one -> its place in `doubted`

    def end():
        nonlocal outside
        whole = _SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
        if whole:
            lines.append((whole, len(_SPACE.sub(" ", "".join(t for t, counts in parts if counts)).strip()), outside, within))
        parts.clear()
        outside = False

    def close(n: int):
        nonlocal aside, dropped, links, articles, within
        while len(opened) > n:
            tag, side = opened.pop()
            if len(opened) in marks:
                k = marks.pop(len(opened))
                doubted[k] = total - doubted[k]
            aside -= side
            dropped -= tag in _DROPPED
            links -= tag == "a"
            articles -= tag in ("article", "main")
            within = within if articles else 0

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        raw = html[at:m.start() if m else size]
        if raw and not dropped:
            parts.append((unescape(raw), not aside and not links))
            if not raw.isspace():
                outside = outside or not aside
                total += 0 if links else len(raw.strip())
        if not m:
            break
        at = m.end()
        if not m.group(2):
            continue
        tag, shut = m.group(2).lower(), m.group(1)
        if tag == "br" and not dropped:
            parts.append((" ", False))
        if tag in _BLOCKS or tag in _DROPPED:
            end()
        if shut:
            n = next((i for i in range(len(opened) - 1, -1, -1) if opened[i][0] == tag), None)
            if n is not None:
                close(n)
            continue
        if tag in _VOID or m.group(3).endswith("/") and tag in ("path", "rect", "circle", "use"):
            continue
        if tag in ("article", "main", "body") and (aside or dropped):  # side elements that were left open end here
            close(next((i for i, (t, side) in enumerate(opened) if side or t in _DROPPED), len(opened)))
        if tag == "p" or tag == "li":  # these end an open one of their kind
            for i in range(len(opened) - 1, -1, -1):
                if opened[i][0] == tag:
                    close(i)
                    break
                if opened[i][0] in _BLOCKS:
                    break
        why = _is_aside(tag, m.group(3), articles > 0)
        if why and why != "sure" and not _COMMENTS.search(why):
            if len(doubted) in content:
                why = None
            marks[len(opened)] = len(doubted)
            doubted.append(total)
        side = why is not None
        opened.append((tag, side))
        aside += side
        dropped += tag in _DROPPED
        links += tag == "a"
        if tag in ("article", "main"):
            articles += 1
            if articles == 1:
                number += 1
                within = number
        if tag in _RAW:  # no markup inside: to the end tag, or to the end of the page
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)", re.I).search(html, at)
            if tag not in _DROPPED:
                parts.append((unescape(html[at:stop.start() if stop else size]), not aside))
            at = stop.start() if stop else size
    end()
    close(0)
    most = frozenset(k for k, n in enumerate(doubted) if n >= _MOST * total > 0)
    return lines_of(html, most | content) if most - content else lines


def main_text(html: str) -> str:
    """The lines between surges and dives, joined by newlines.

    Between its first and its last line of some length a kept run keeps all its lines outside side elements, whatever their
    links; a short run in the article element of a kept one belongs to it.
    """
    lines = lines_of(html)
    lengths = [counted if 2 * counted >= len(text) else 0 for text, counted, *_ in lines]  # a line of links has no length
    sums = [sum(lengths[i:i + WINDOW]) for i in range(len(lengths))]
    top = max(sums, default=0)
    if not top:
        return ""
    surge = min(SURGE, top)  # a page of little text is measured by its fullest window
    runs, i, n = [], 0, len(sums)
    while i < n:
        if not sums[i]:
            i += 1
            continue
        dive = next((j for j in range(i, n) if not sums[j]), n)
        runs.append((max(sums[i:dive]) >= surge, [j for j in range(i, dive) if lengths[j]]))
        i = dive
    articles = {lines[j][3] for full, at in runs if full for j in at} - {0}
    kept = []
    for full, at in runs:
        if full or any(lines[j][3] in articles for j in at):
            kept += [lines[j][0] for j in range(at[0], at[-1] + 1) if lines[j][2] and (full or lines[j][3] in articles)]
    return "\n".join(kept)


def extract_main_text(pages: DataFrame, html: str = "html", *, carry: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``carry``) with the article's ``text`` and ``n_chars`` (code points); such columns in ``pages`` are replaced.

    A null or empty page, or one without any text that counts, gives an empty text.  Character references are decoded, white space inside a
    block is one space, blocks are joined by a newline.  Repeated rows get equal results; an empty table gives an empty result.
    """
    def make():
        def run(texts):
            found = [main_text(x) for x in texts.to_pylist()]
            return [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())]
        return run

    return map_text(pages, html, [field("text", "string"), field("n_chars", "long")], make, carry)
