"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block; lines that are marked as something else (menus, adverts) go. A line
weighs from 0 to 1 by whether it stands in a declared article and what it looks like (sentences, headings, lists of
links, notices). Weights are summed over a sliding window. A text surges at the first line with weight whose window reaches the
threshold, and dives before the first line whose window stays below; what lies between is kept, on every page. If
nothing surges, the heaviest stretch of lines is the text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdcatalog.llm.common import map_batches, text_or_empty

#: Lines of a window, and the sum at which a text surges and below which it dives.
WINDOW = 3
SURGE = 0.5
#: Weights: a sentence at least, a heading, a short line of a container without a meaning of its own.
SENTENCE, HEADING, LOOSE = 0.5, 0.35, 0.15
#: Part of the weight that lines outside a declared article keep.
OUTSIDE = 0.1
#: A line of which more than this part is links weighs nothing.
LINKED = 0.5
#: Words of a line that is a sentence without ending in a mark, and of the longest notice.
LONG, NOTICE_WORDS = 12, 40

# Element names and the words in class, id and role attributes that mark what is not main text.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
OUT = {"head", "nav", "footer", "aside", "form", "noscript", "button", "select", "dialog", "menu", "template", "svg", "object", "canvas",
       "audio", "video", "map", "script", "style", "textarea", "title", "iframe", "label", "datalist", "fieldset"}
OUT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
             "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "toolbar",
             "comment", "comments", "disqus", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert",
             "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social",
             "related", "recommended", "widget", "copyright", "pagination", "pager", "skip", "search", "topbar", "complementary",
             "contentinfo", "dialog", "paywall", "disclaimer", "outbrain", "taboola", "trending", "toc"}
OUT_ARTICLES = {"ad", "ads", "advert", "comment", "comments", "promo", "recommended", "related", "sponsored", "teaser"}
#: Words that say where or how large: together with a mark they are one still (``site-footer``, ``comment-list``).
PLACES = {"site", "page", "main", "top", "bottom", "left", "right", "box", "list", "bar", "block", "container", "wrapper", "wrap", "inner", "outer", "area", "section",
          "primary", "secondary", "global", "mobile", "slot", "unit", "links", "link", "buttons", "button", "posts", "articles", "items", "item", "form", "icons", "header"}
#: Marks that classes inside an article may be: what else may be part of it (notices, tables of contents, related work) stays.
INSIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored", "promo", "sidebar", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
                "comment", "comments", "disqus", "cookie", "cookies", "consent", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "pagination", "pager",
                "outbrain", "taboola", "widget", "popup", "paywall"}
#: Of these only together with another word: alone they may be what the article is about.
INSIDE_PAIRS = {"share", "social", "comment", "cookie", "cookies", "login", "widget", "popup", "subscribe", "signup", "consent"}
HEADER_WORDS = {"header", "pageheader", "siteheader", "masthead"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TEXT_ELEMENTS = {"p", "li", "dd", "dt", "blockquote", "pre", "figcaption", "td", "th", "caption", "summary", "address"}
COMMENT_WORDS = {"comment", "comments", "replies", "responses", "kommentar", "kommentare", "antworten", "commentaire", "commentaires", "réponses", "comentario", "comentarios",
                 "respuestas"}
COOKIE_WORDS = {"accept", "agree", "consent", "policy", "settings", "use", "uses", "using", "akzeptieren", "zustimmen", "verwenden", "verwendet", "accepter", "utilise",
                "utilisons", "aceptar", "utiliza", "utilizamos", "usamos"}
NOTICE_STARTS = ("share this", "share on", "follow us", "sign up", "subscribe", "log in", "sign in", "advertisement", "sponsored", "skip to", "read more", "related articles",
                 "related posts", "you may also like", "back to top", "all rights reserved", "leave a comment", "leave a reply", "post a comment")
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
ARTICLE = {"article", "main"}
ARTICLE_WORDS = {"article", "articlebody", "post", "postbody", "entry", "story"}
ARTICLE_PARTS = {"body", "content", "text"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


_SENTENCE = re.compile(r"""[.!?…。！？:;]["'”’»)\]]*(?:\s|$)""")
_SEPARATORS = re.compile(r"\s*[|·•»›/–—]\s+|\s+[|·•»›/]\s*")
_RIGHTS = re.compile(r"^\W*(?:©|\(c\)|copyright\b)|\ball rights reserved\b", re.I)
_WORDS = re.compile(r"\w+")


def _marks(value: str, marks: set[str], alone: bool = True) -> bool:
    """Whether one of the names in a class or id is a mark: a mark word and otherwise only words of place."""
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if any(w in marks for w in words) and all(w in marks or w in PLACES for w in words) and (alone or len(words) > 1 or words[0] not in INSIDE_PAIRS):
            return True
    return False


def _is_out(name: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element's name or attributes mark it as something else than main text.

    Inside an article an id says nothing, and a class only if it is plainly a mark.
    """
    if name in OUT or name == "header" and not inside_article:
        return True
    if not attributes or name in ("html", "body"):
        return False
    found = [(key.lower(), value.strip("\"'")) for key, value in _ATTRIBUTE.findall(attributes)]
    if _is_article(name, attributes):  # its own classes describe the layout around it, unless it is a comment or an advert itself
        words = {w.lower() for key, value in found if key in ("class", "id") for w in _NAME.findall(value)}
        return bool(words & OUT_ARTICLES)
    for key, value in found:
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key == "role" and value.lower() in OUT_ROLES:
            return True
        if name in HEADINGS:
            continue
        if inside_article:
            if key == "class" and _marks(value, INSIDE_WORDS, alone=False):
                return True
        elif key in ("class", "id") and _marks(value, OUT_WORDS | HEADER_WORDS):
            return True
    return False


def _is_article(name: str, attributes: str) -> bool:
    if name in ARTICLE:
        return True
    for key, value in _ATTRIBUTE.findall(attributes) if attributes and name in ("div", "section", "td") else ():
        key, value = key.lower(), value.strip("\"'")
        words = [w.lower() for w in _NAME.findall(value)]
        if key == "role" and value.lower() in ARTICLE or key in ("class", "id") and (
                set(words) == {"content"} or ARTICLE_WORDS & set(words) and ARTICLE_PARTS & set(words) or words and words[-1] == "articlebody"):
            return True
    return False


@dataclass
class Line:
    text: str
    plain: int  # characters outside links
    out: bool  # marked as something else than main text
    article: bool  # inside a declared article
    element: str  # the block it stands in


def lines(page: str) -> list[Line]:
    """The blocks of a page in order."""
    out: list[Line] = []
    pieces: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, bool, bool]] = []  # name, counted out, in an article, in a link
    dropped = article = link = False

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            block = next((x[0] for x in reversed(stack) if x[0] not in INLINE), "")
            out.append(Line(text, max(0, len(text) - linked), dropped, article, block))
        pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            linked += len(" ".join(text.split())) if link else 0

    at, length = 0, len(page)
    while at < length:
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name == "br":
            pieces.append(" ")
            continue
        if name not in INLINE:
            flush()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            # a stray end of an inner element does not close the sections around it
            if depth is not None and (name not in INLINE or all(x[0] in INLINE for x in stack[depth:])):
                del stack[depth:]
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else length
        elif name not in VOID:
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
                stack.pop()
            elif name not in INLINE:  # inline elements do not reach into the next block
                while stack and stack[-1][0] in INLINE and stack[-1][0] != "a":
                    stack.pop()
                if name == "p" and stack and stack[-1][0] == "p":
                    stack.pop()
            if not m[3].endswith("/"):
                outer = stack[-1][1:] if stack else (False, False, False)
                stack.append((name, outer[0] or _is_out(name, m[3], outer[1]), outer[1] or _is_article(name, m[3]), outer[2] or name == "a"))
        dropped, article, link = stack[-1][1:] if stack else (False, False, False)
    flush()
    return out


def is_comment_heading(text: str) -> bool:
    """``3 comments``, ``Comments (3)``, ``Leave a reply``: what follows is said by readers."""
    words = [w.lower() for w in _WORDS.findall(text)]
    rest = [w for w in words if not w.isdigit()]
    return len(rest) == 1 and len(words) <= 3 and rest[0] in COMMENT_WORDS or text.lower().startswith(("leave a comment", "leave a reply", "post a comment")) and len(words) <= 6


def is_cookie_notice(text: str) -> bool:
    words = {w.lower() for w in _WORDS.findall(text)}
    return len(words) <= NOTICE_WORDS and bool(words & {"cookie", "cookies"}) and bool(words & COOKIE_WORDS)


def looks(line: Line) -> float:
    """The weight of a line by what it looks like."""
    text = line.text
    if line.plain < (1 - LINKED) * len(text):
        return 0.0
    words = len(text.split())
    if words <= NOTICE_WORDS and _RIGHTS.search(text) or words <= LONG and text.lower().startswith(NOTICE_STARTS):
        return 0.0
    if line.element in HEADINGS:
        return HEADING
    pieces = [p for p in _SEPARATORS.split(text) if p]
    if len(pieces) >= 3 and all(len(p.split()) <= 4 for p in pieces) and not _SENTENCE.search(text):
        return 0.0
    if words >= LONG or _SENTENCE.search(text) or line.element in TEXT_ELEMENTS:
        return SENTENCE + min(0.5, line.plain / 400)
    return LOOSE


def _weighty(out: list[float]) -> list[float]:
    """Weights of which those below the least that any look gives are nothing, unless there are no others."""
    return [w if w >= LOOSE else 0.0 for w in out] if any(w >= LOOSE for w in out) else out


def weights(rows: list[Line]) -> list[float]:
    """The weight of each line that is not marked as something else: 1 in a declared article, else by its looks.

    Outside a declared article little of that is left. Where none is declared, neither is of what stands before the only
    title, a page's one or two notices about cookies weigh nothing, nor does what follows the heading of the readers' comments.
    """
    if any(line.article for line in rows):
        return _weighty([1.0 if line.article else OUTSIDE * looks(line) for line in rows])
    out = [looks(line) for line in rows]
    cookies = [i for i, line in enumerate(rows) if out[i] and is_cookie_notice(line.text)]
    for i in cookies if len(cookies) <= 2 else ():
        out[i] = 0.0
    titles = [i for i, line in enumerate(rows) if line.element == "h1"]
    if len(titles) == 1 and sum(out[:titles[0]]) < sum(out[titles[0]:]):  # what stands before the only title is rarely its text
        out = [OUTSIDE * w if i < titles[0] else w for i, w in enumerate(out)]
    said = False
    for i, line in enumerate(rows):
        if is_comment_heading(line.text) and any(w >= SENTENCE for w in out[:i]):
            said = True
        if said:
            out[i] = 0.0
    return _weighty(out)


def texts(weight: list[float]) -> list[tuple[int, int]]:
    """(first line, line after the last) from each surge to its dive; the heaviest stretch if nothing surges."""
    n = len(weight)
    sums = [0.0] * n
    for i in range(n):  # the window that starts at line i
        sums[i] = sum(weight[i:i + WINDOW])
    found, i = [], 0
    while i < n:
        # a short line of a container begins a text only right before it
        if sums[i] < SURGE or not weight[i] or weight[i] < HEADING and not (i + 1 < n and weight[i + 1] >= HEADING):
            i += 1
            continue
        end = i
        while end < n and sums[end] >= SURGE:  # up to the dive
            end += 1
        found.append((i, end))
        i = end
    if not found and any(weight):
        stretches, i = [], 0
        while i < n:
            end = i
            while end < n and weight[end]:
                end += 1
            if end > i:
                stretches.append((sum(weight[i:end]), -i, end))
            i = max(end, i + 1)
        total, begin, end = max(stretches)
        found = [(-begin, end)]
    return found


def main_text(page: str) -> str:
    """The main text of one page: its blocks joined by line breaks."""
    rows = [line for line in lines(page) if not line.out]
    weight = weights(rows)
    return "\n".join(rows[k].text for a, b in texts(weight) for k in range(a, b) if weight[k])


def _step(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(page) for page in batch.column(2).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``.

    Null or empty markup, and pages without main text, give an empty text; null and repeated ids stay as
    they are; other columns are ignored; an empty table gives no rows. Blocks are kept whole, in page
    order; nothing is shuffled and no text is cut.
    """
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), text_or_empty(markup).alias("html"))
    return (map_batches(rows, _step, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
