"""Main text of a web page by the line-block distribution.

Markup is stripped into lines: each block-level tag ends one, so text blocks and the empty lines
between them alternate as in a rendered page. Elements that can't be main text (menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts, styles) are left out on the way, and
link text doesn't count. Nor do empty lines where one element ends and the next begins. The
distribution is the text length summed over a sliding window of lines. It surges where main text begins
and dives where it ends. All lines of the element that holds every stretch between a surge and a dive
are the page's text, so short paragraphs at its edges stay; where the heaviest stretch is in articles,
those are.

Pages are independent: one pass, no shuffle.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, unique_name

runs_in_tasks(__name__)

#: Lines in a window, and the text length of a window at which the distribution surges.
WINDOW = 3
SURGE = 86

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button|xmp)\b"
    r"[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.I | re.S,
)
#: One attribute: its name, and its value whole, so that no word of a value counts as a name.
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LINES = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody tfoot thead tr ul".split()
)
_CELLS = frozenset(["br", "td", "th", "option", "wbr"])
#: A start tag of these ends an open element of the same group.
_ENDS = {n: frozenset(g) for g in (["p"], ["li"], ["dt", "dd"], ["tr"], ["td", "th"], ["option"]) for n in g}
_MAIN = frozenset(["article", "main"])
_OUT = frozenset(["nav", "aside", "footer", "form", "menu", "dialog", "search", "head", "fieldset"])
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_OUT_NAMES = re.compile(
    r"(?:ad|ads|adv|adverts?|advertisements?|advertising|adsense|banners?|breadcrumbs?|comments?|commentlist|consent|"
    r"cookies?|cookiebar|disqus|footers?|gdpr|headers?|masthead|menus?|modals?|nav|navbar|navigation|newsletter|notices?|"
    r"overlay|pager|pagination|popups?|promos?|promotions?|recommended|related|replies|reply|responses|share|sharing|"
    r"sidebars?|skip|social|sponsors?|sponsored|subscribe|subscription|toolbar|topbar|widgets?)"
)
_KEPT_NAMES = frozenset(["free", "has", "no", "with", "without"])
_WHOLE_PAGE = frozenset(["html", "body"])
_WRAPPERS = frozenset(["div", "section"])
_HELD = frozenset(["p", "span", "b", "i", "em", "strong", "font", "a"])


def _left_out(name: str, rest: str, in_main: bool) -> bool:
    """Whether an element can't hold main text, by its name and attributes."""
    if name in _OUT or name == "header" and not in_main:
        return True
    if not rest or name in ("html", "body") or name in _MAIN:
        return False
    seen = set()
    for m in _ATTRIBUTE.finditer(rest):
        what, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if what in seen:
            continue  # of repeated attributes the first counts
        seen.add(what)
        if what == "hidden" or what == "aria-hidden" and value == "true":
            return True
        if what == "role" and value.strip() in _ROLES:
            return True
        if what == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if what in ("class", "id", "itemprop"):
            for token in value.split():
                parts = re.split(r"[-_:]+", token)
                if any(_OUT_NAMES.fullmatch(p) for p in parts) and not _KEPT_NAMES.intersection(parts):
                    return True
    return False


class _Lines:
    """Lines of a page with their unlinked text length, the path of open elements and whether an end
    tag ended them (None after an element that is left out)."""

    def __init__(self):
        self.text: list[str] = []
        self.weight: list[int] = []
        self.path: list[tuple] = []
        self.closed: list[bool | None] = []
        self.parts: list[str] = []
        self.linked = 0

    def add(self, raw: str, in_link: bool) -> None:
        part = html.unescape(raw) if "&" in raw else raw
        self.parts.append(part)
        if in_link:
            self.linked += len(part.strip())

    def end(self, path: tuple, closed: bool | None) -> None:
        line = " ".join("".join(self.parts).split())
        self.text.append(line)
        self.weight.append(max(0, len(line) - self.linked))
        self.path.append(path)
        self.closed.append(closed)
        self.parts, self.linked = [], 0

    def without_seams(self) -> list[int]:
        """The lines without the empty ones that stand where elements end and then others begin."""
        kept: list[int] = []
        empty: list[int] = []
        for i, text in enumerate(self.text):
            if not text:
                empty.append(i)
                continue
            # the tags between two texts: the one that ended the first, then those of the empty lines
            tags = [self.closed[j] for j in [*kept[-1:], *empty]]
            seam = None not in tags and tags == sorted(tags, reverse=True)
            kept += [i] if seam else [*empty, i]
            empty = []
        return kept + empty


def page_lines(page: str) -> _Lines:
    """Markup stripped into lines; what can't be main text is left out."""
    out = _Lines()
    stack: list[tuple[str, int]] = []  # open elements and their numbers
    skip = 0  # the number of open elements at which leaving out began
    links = mains = at = number = 0
    left_out = False  # since the last line
    for m in _MARKUP.finditer(page):
        if m.start() > at and not skip:
            out.add(page[at : m.start()], links > 0)
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if name in _CELLS and not skip:
            out.parts.append(" ")
        if name in _LINES and not skip:
            out.end(tuple(stack), None if left_out else bool(m["close"]))
            left_out = False
        if m["close"]:
            back = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if back is None:
                continue
            gone = stack[back:]
            del stack[back:]
        else:
            gone = []
            if name in _MAIN and skip:
                # an element that was never closed doesn't swallow the main text
                gone = stack[skip - 1 :]
                del stack[skip - 1 :]
            elif stack and stack[-1][0] in _ENDS.get(name, ()) or name in _LINES and stack and stack[-1][0] == "p":
                gone = [stack.pop()]
        links -= sum(g[0] == "a" for g in gone)
        mains -= sum(g[0] in _MAIN for g in gone)
        if skip and len(stack) < skip:
            skip, left_out = 0, True
        if not m["close"] and name not in _VOID and not m["rest"].endswith("/"):
            number += 1
            stack.append((name, number))
            links += name == "a"
            if not skip and _left_out(name, m["rest"], mains > 0):
                skip = len(stack)
            mains += name in _MAIN
    if at < len(page) and not skip:
        out.add(page[at:], links > 0)
    out.end(tuple(stack), True)
    return out


def stretches(weight: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first, last) line of each stretch between a surge and a dive of the distribution. On a page of
    little text, half the largest window is a surge."""
    n = len(weight)
    blocks = [sum(weight[i : i + window]) for i in range(n)]
    top = max(blocks, default=0)
    if not top:
        return []
    least = min(surge, top / 2)
    found, i = [], 0
    while i < n:
        if blocks[i] < least or not weight[i]:
            i += 1
            continue
        end = i
        while end < n and blocks[end]:
            end += 1
        found.append((i, end - 1))
        i = end
    return found


def core(weight: list[int], window: int = WINDOW, surge: int = SURGE) -> tuple[int, int] | None:
    """The heaviest stretch."""
    return max(stretches(weight, window, surge), key=lambda s: sum(weight[s[0] : s[1] + 1]), default=None)


def main_text(page: str | None) -> str:
    """The main text of a page: blocks joined by an empty line. '' without any."""
    if not page:
        return ""
    lines = page_lines(page)
    at = lines.without_seams()
    weight = [lines.weight[i] for i in at]
    top = core(weight)
    if top is None:
        return ""
    found = [[i for i in at[a : b + 1] if lines.text[i]] for a, b in stretches(weight)]
    heaviest = max(at[top[0] : top[1] + 1], key=lambda i: lines.weight[i])
    inside = [i for part in found for i in part]
    homes = {next((e for e in lines.path[i] if e[0] in _MAIN), None) for i in inside}
    home = next((e for e in lines.path[heaviest] if e[0] in _MAIN), None)
    if home is not None:
        # the main element, or else all articles
        homes = {home} if home[0] == "main" else {e for e in homes if e and e[0] == "article"}
        kept = [t for t, p in zip(lines.text, lines.path, strict=True) if t and homes.intersection(p)]
        return "\n\n".join(kept)
    shared = lines.path[inside[0]]
    for i in inside:
        shared = tuple(a for a, b in zip(shared, lines.path[i], strict=False) if a == b)
    # the block that holds a single line is that line: its parent holds the text
    while shared and shared[-1][0] in _HELD:
        shared = shared[:-1]
    home = shared[-1] if shared else None
    # where several wrappers of a whole page hold the text, lines of links before and after are its menus
    wrappers = {lines.path[i][len(shared)] for i in inside if len(lines.path[i]) > len(shared)}
    menus = (home is None or home[0] in _WHOLE_PAGE) and sum(e[0] in _WRAPPERS for e in wrappers) > 1
    kept = [
        t
        for i, (t, p) in enumerate(zip(lines.text, lines.path, strict=True))
        if t and (home is None or home in p) and not (menus and not lines.weight[i] and not inside[0] <= i <= inside[-1])
    ]
    return "\n\n".join(kept)


def _extract(batches):
    for b in batches:
        text = [main_text(h) for h in b.column(b.num_columns - 1).to_pylist()]
        size = [len(t) for t in text]
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array(text, pa.string()), pa.array(size, pa.int64())],
            names=[*b.schema.names[:-1], "text", "n_chars"],
        )


def extract(pages: DataFrame, *, markup: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the markup by default), text and n_chars (code points) of each
    row of ``pages``. NULL or empty markup, and a page without text, give ''. Columns text and
    n_chars of ``pages`` are replaced."""
    keep = [c for c in (pages.columns if keep is None else keep) if c.lower() not in ("text", "n_chars", markup.lower())]
    sent = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(markup).alias(unique_name(keep, "_html")))
    schema = sent.drop(sent.columns[-1]).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    return sent.mapInArrow(_extract, schema)
