"""Operator 7: main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block. A line weighs the characters of its text
without twice those of its links; lines of menus, forms, adverts, notices, comments and the like
are left out. Whole class names tell them, and an article or main element in a wrapper so named
still counts, unless that holds replies or related pages. The weights are summed over sliding
windows of lines. Where the sums rise from nothing the text surges, where they fall to nothing it
dives; the text lies between, and the heaviest such stretch tells what the page is about. If most of
its weight is in article and main elements, lines outside them weigh nothing, the sums are taken
again and all stretches are kept, without what weighs nothing in them. Otherwise the least div or
section around the stretch is its container: all between the first surge and the last dive in there is
taken, and lists that stand in it directly. Around a stretch without container every stretch of the
page is taken.

Null or empty html gives an empty text, as does a page without any weight; equal rows give equal
texts; pages are independent of each other; other columns are carried along.
"""

from __future__ import annotations

import html as entities
import itertools
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3

#: Elements by what they mean for the text.
RAW = ("script", "style", "title", "textarea", "template", "iframe", "object", "canvas", "audio", "video", "select", "xmp")
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset", "datalist"}
BLOCK = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "section", "article", "main",
         "blockquote", "pre", "figure", "figcaption", "hr", "body", "html", "header", "hgroup", "address", "details", "summary", "center", "search", "noscript"} | ASIDE
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ZONES = {"article", "main"}
CONTAINERS = {"div", "section", "center"} | ZONES
SIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "banner", "promo", "promotion", "promoted", "sponsor", "sponsored", "cookie", "cookies",
              "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "comment", "comments",
              "commentlist", "disqus", "reply", "replies", "respond", "discussion", "sidebar", "aside", "rail", "widget", "widgets", "related", "recommended", "recommendations", "share",
              "sharing", "social", "follow", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "topbar", "footer", "masthead", "copyright",
              "legal", "search", "form", "hidden"}
#: An article inside these is no main text; inside other marked wrappers it may be.
FIRM_WORDS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion", "related", "recommended", "recommendations"}
#: May stand beside a side word in a class name.
NEUTRAL_WORDS = {"site", "list", "box", "bar", "area", "link", "links", "icons", "button", "buttons", "posts", "item", "items", "block"}
SIDE_ARTICLES = {"ad", "ads", "advert", "comment", "comments", "reply", "replies", "related", "promo", "sponsored", "teaser"}
SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(?P<raw>" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|$)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
                   r"(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def names_any(value: str, words: set[str]) -> bool:
    """Whether a whole class name is made of these words: ``cookie-notice``, but not ``has-sidebar``."""
    for name in value.split():
        parts = {x for x in re.split(r"[^a-z0-9]+", name) if x and not x.isdigit()}
        if not parts.isdisjoint(words) and parts <= words | NEUTRAL_WORDS:
            return True
    return False


def side_mark(name: str, attrs: str) -> int:
    """Whether an element stands beside the text: 0 no, 1 unless in an article or main element of its own, 2 yes."""
    if name in ASIDE:
        return 1 if name in ("form", "fieldset") else 2
    if not attrs or name in ("body", "html", "main"):
        return 0
    if re.search(r"(?:^|\s)hidden(?:\s|$|/)", attrs):
        return 2
    found = 0
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id") and names_any(value, SIDE_ARTICLES if name == "article" else SIDE_WORDS):
            found = max(found, 2 if name == "article" or any(names_any(x, SIDE_WORDS) and not FIRM_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", x)) for x in value.split()) else 1)
        if key == "role" and value.strip() in SIDE_ROLES:
            found = max(found, 1 if value.strip() in ("form", "search") else 2)
        if key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 2
    return found


def lines_of(page: str) -> list[tuple[str, int, int, tuple[int, ...]]]:
    """(text, weight, zone, containers from outside in) of each block that is no side block, in page order.

    The zone is the number of the article or main element, or 0; articles of the same parent share one.
    """
    out: list[tuple[str, int, int, tuple[int, ...]]] = []
    stack: list[tuple[str, int, int, bool, tuple[int, ...]]] = []  # name, side mark, zone, in a header, containers
    beside: dict[tuple[str, tuple[int, ...]], int] = {}
    text: list[str] = []
    linked = links = places = 0
    side, zone, header, place = 0, 0, False, ()
    heading = False

    def end_line():
        nonlocal linked
        line = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if line and not (side or header and not (zone and heading)):
            out.append((line, len(line) if zone else max(0, len(line) - 2 * linked), zone, place))
        linked = 0

    def add(part: str):
        nonlocal linked
        if part:
            text.append(part)
            if links:
                linked += len(part)

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            text.append(" ")
        if name == "a":
            links = 0 if m["close"] else 1
        if name in VOID and name != "hr":
            continue
        if name in BLOCK:
            end_line()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    end_line() if stack[k][1] != side else None
                    del stack[k:]
                    break
        elif not m["attrs"].endswith("/") and (name in BLOCK and name != "hr" or m["attrs"] and side_mark(name, m["attrs"])):
            if name in ("p", "li", "tr", "td", "th", "dt", "dd", *HEADINGS):  # these end one another
                while stack and stack[-1][0] == name:
                    stack.pop()
            inside, own_zone = (stack[-1][4], stack[-1][2]) if stack else ((), 0)
            if name in ZONES and not own_zone:
                own_zone = beside.setdefault((name, inside), len(beside) + 1)
            if name in CONTAINERS:
                places += 1
                inside += (places,)
            above, now_side = stack[-1][1] if stack else 0, side_mark(name, m["attrs"])
            if name == "noscript" and not own_zone:  # outside an article a notice to switch scripts on
                now_side = 2
            if name not in ZONES or above == 2:  # an article or main element in a wrapper that only looks like a side block is text
                now_side = max(above, now_side)
            if now_side and not side:
                end_line()
            stack.append((name, now_side, own_zone, name == "header" or bool(stack and stack[-1][3]), inside))
        top = stack[-1] if stack else ("", 0, 0, False, ())
        side, zone, header, place = top[1:]
        heading = top[0] in HEADINGS
    add(page[at:])
    end_line()
    return out


def window_sums(weights: list[int]) -> list[int]:
    """Sum of the weights of each line and of up to ``WINDOW - 1`` lines on either side."""
    upto = [0, *itertools.accumulate(weights)]
    n, reach = len(weights), WINDOW - 1
    return [upto[min(n, i + reach + 1)] - upto[max(0, i - reach)] for i in range(n)]


def stretches(weights: list[int]) -> list[tuple[int, int]]:
    """(first, last) line with weight between each surge of the window sums from nothing and the dive back to nothing."""
    found: list[tuple[int, int]] = []
    opened = None
    for i, total in enumerate([*window_sums(weights), 0]):
        if total > 0 and opened is None:
            opened = i
        elif total <= 0 and opened is not None:
            heavy = [k for k in range(opened, i) if weights[k] > 0]
            found.append((heavy[0], heavy[-1]))
            opened = None
    return found


def main_text(page: str | None) -> str:
    """Text between the surges and dives of the window sums that belongs to the heaviest stretch."""
    lines = lines_of(page or "")
    weights = [line[1] for line in lines]
    found = stretches(weights)
    if not found:
        return ""
    first, last = max(found, key=lambda s: (sum(weights[s[0]:s[1] + 1]), -s[0]))
    best = [i for i in range(first, last + 1) if weights[i] > 0]
    if 2 * sum(weights[i] for i in best if lines[i][2]) >= sum(weights[i] for i in best):
        marked = [w if line[2] else 0 for w, line in zip(weights, lines)]
        return " ".join(lines[i][0] for a, b in stretches(marked) for i in range(a, b + 1) if marked[i] > 0)
    around = os.path.commonprefix([lines[i][3] for i in best])
    if not around:
        return " ".join(lines[i][0] for a, b in found for i in range(a, b + 1))
    inside = [i for i, w in enumerate(weights) if w > 0 and lines[i][3][:len(around)] == around]
    return " ".join(line[0] for i, line in enumerate(lines) if line[3] == around or line[3][:len(around)] == around and inside[0] <= i <= inside[-1])


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html``, with its main text as column ``text``."""
    others = [c for c in pages.columns if c not in (html, text)]
    names = [f"c{i}" for i in range(len(others))]
    lean = pages.select(*[F.col(c).alias(n) for c, n in zip(others, names)], F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            out = pa.array([main_text(x.as_py()) for x in batch.column(len(names))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*names, "text"])

    schema = lean.drop("html").schema.add("text", "string")
    return lean.mapInArrow(run, schema).toDF(*others, text)
