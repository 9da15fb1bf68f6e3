"""Main text of web pages by line-block distribution.

Markup is stripped to lines: block tags end a line, and the border of a container leaves as many
empty lines as the window is long. Over the weights of the lines, which are their lengths without
links, the sums of a sliding window rise where running text begins (surge) and fall to nothing
where it ends (dive). What stands between such points is a passage. The passage of largest sum and
those that reach a share of it tell where the text stands, on every page alike: all lines are kept
of the containers that hold these passages, and of what lies between them. Sections stay together,
as do articles, and a heading before the text belongs to it.

Tags only set borders and weights. Menus, forms and other furniture weigh nothing and leave no
text. An article or main element bounds its text as the outermost container does elsewhere, and its
lines weigh more. Inside furniture known by its names only, they weigh less with each such name
around them, so they are the text of pages that have no other.

A null or empty page, and one without text, gives an empty text. Pages are read whole; broken
markup (tags that are never closed, cut pages) is read as far as it makes sense, in time linear in
its tags. Of passages with equal sums all count alike. Each row is read on its own, repeated rows
give the same text each, and an empty table an empty one. Ids and extra columns pass through; a
column named like the output is replaced.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import blocks
from .common import text_of

WINDOW = 3  # lines of a window
SHARE = 0.2  # of the largest passage, from which others tell where text stands
ARTICLE_WEIGHT = 10  # of a line in an article or main element
NAMED_WEIGHT = 1e-6  # for each furniture name around its article

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|canvas|textarea|select|title|audio|video)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
LINE_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article aside body dialog div fieldset footer form header main menu nav section table ul ol dl".split())
# Tags whose end tag may be left out, and those that the next one ends.
CELLS = frozenset({"td", "th"})
ROWS = CELLS | {"tr"}
TERMS = frozenset({"dt", "dd"})
OPTIONAL = {
    "p": frozenset({"p"}), "li": frozenset({"li"}), "dt": TERMS, "dd": TERMS, "td": CELLS, "th": CELLS, "tr": ROWS,
    "thead": ROWS | {"thead"}, "tbody": ROWS | {"thead", "tbody"}, "tfoot": ROWS | {"tbody"}, "option": frozenset({"option"}),
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LISTS = frozenset("ul ol dl table".split())
ARTICLE = frozenset({"article", "main"})
FURNITURE = frozenset("nav header footer aside form menu button dialog head search label fieldset".split())
ROLE = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|form|menu|menubar|alert|dialog|alertdialog)\b", re.I)
NAMES = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Words in class and id names of furniture.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|nav\w*|menu\w*|breadcrumbs?|footer|foot|header|masthead|toolbar|topbar|"
    r"comments?|commentlist|replies|disqus|respond|cookies?|consent|notices?|alerts?|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|"
    r"social|related|recommend\w*|widgets?|pagination|pager|search|form|legal|copyright|gdpr|hidden)(?:$|[\s_-])",
    re.I,
)


def _is_furniture(name: str, rest: str) -> bool:
    if name in FURNITURE or ROLE.search(rest):
        return True
    return name not in ARTICLE and name != "body" and _is_named(rest)


def _is_named(rest: str) -> bool:
    return any(NAMED.search(" ".join(filter(None, m))) for m in NAMES.findall(rest))


class Line(NamedTuple):
    text: str
    weight: float
    top: int = 0  # the outermost article, or container: where its tag begins, plus one; 0 outside of any
    kind: str = ""  # "section" or "article" if that is one
    title: bool = False  # a heading of the first level
    named: int = 0  # pieces of furniture, known by their names only, around its article


BORDER = Line("", 0)


def _left_open(page: str) -> set[int]:
    """Where the tags begin that have no end tag of their own, and those whose end tag may be that of an outer one left open."""
    out: set[int] = set()
    stack: list[tuple[str, int]] = []
    # Open tags of each name, and of every tag the one of its name that it opened in.
    of_name: dict[str, list[int]] = defaultdict(list)
    around: dict[int, int | None] = {}

    def leave() -> tuple[str, int]:
        name, at = stack.pop()
        of_name[name].pop()
        return name, at

    for m in TOKEN.finditer(page):
        name = (m["name"] or "").lower()
        if name not in LINE_TAGS and name not in FURNITURE or name in OPTIONAL or name == "hr":
            continue
        if not m["end"]:
            if not m["rest"].endswith("/"):
                around[m.start()] = of_name[name][-1] if of_name[name] else None
                stack.append((name, m.start()))
                of_name[name].append(m.start())
        elif of_name[name]:
            while (left := leave())[0] != name:
                out.add(left[1])
    out |= {at for _, at in stack}
    # Outer tags come first, so each asks only the next one around it.
    for at, outer in around.items():
        if outer in out:
            out.add(at)
    return out


def lines_of(page: str) -> list[Line]:
    """Lines of the page. Furniture has no text; borders are empty lines.

    Text of an article that opens in furniture known by its names only is kept with a small weight,
    or a full one where that furniture was left open.
    """
    lines: list[Line] = []
    # Name, kind of furniture (0 none, 1 by names around an article, 2 without text), where it begins.
    open_tags: list[tuple[str, int, int]] = []
    n_open: dict[str, int] = defaultdict(int)
    of_kind = [0, 0, 0]
    owned: list[int] = []  # places of furniture in open_tags
    outermost: int | None = None  # place of the outermost container
    articles = article_at = tags = closed = links = linked = 0
    title = False
    parts: list[str] = []
    unclosed: set[int] | None = None

    def silent() -> bool:
        return bool(of_kind[2] or of_kind[1] and not articles)

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            weight = max(1, len(text) - linked)
            if articles:
                weight *= ARTICLE_WEIGHT * NAMED_WEIGHT ** min(of_kind[1], 20)
                lines.append(Line(text, weight, article_at, "article", title, of_kind[1]))
            else:
                name, _, at = ("", 0, -1) if outermost is None else open_tags[outermost]
                lines.append(Line(text, weight, at + 1, name if name == "section" else "", title))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal articles, tags, closed, outermost
        while True:
            t, own, at = open_tags.pop()
            n_open[t] -= 1
            of_kind[own] -= 1
            if own:
                owned.pop()
                tags -= t in FURNITURE
                closed -= unclosed is not None and at not in unclosed
            if outermost == len(open_tags):
                outermost = None
            articles -= t in ARTICLE
            if t == name:
                return

    def resets(name: str, rest: str) -> bool:
        """Whether furniture that was never closed ends here, where an article begins."""
        nonlocal unclosed, closed
        if name not in ARTICLE or not owned or tags or _is_named(rest):
            return False
        if unclosed is None:
            unclosed = _left_open(page)
            closed = sum(open_tags[i][2] not in unclosed for i in owned)
        return not closed

    def furniture(name: str, rest: str) -> int:
        # Headings of an article stay, whoever wraps them.
        if name == "body" or name == "header" and articles:
            return 0
        if name in FURNITURE or ROLE.search(rest):
            return 2
        # An article's names count inside another one and inside furniture.
        if (name not in ARTICLE or articles or of_kind[1]) and _is_named(rest):
            return 2 if articles else 1
        return 0

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if not silent():
                parts.append(text)
                if links:
                    linked += len(text.strip())
            continue
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if name == "a":
            links = 0 if m["end"] else 1
        if name == "br" or name in VOID and name != "hr":
            if not silent() and name in ("br", "wbr", "img"):
                parts.append(" " if name == "br" else "")
            continue
        if name not in LINE_TAGS and name not in FURNITURE:
            continue
        flush()
        if open_tags and open_tags[-1][0] == "p" and not m["end"]:
            close("p")  # its end tag may be left out before any block
        if name in CONTAINERS:
            lines += [BORDER] * (1 if name in LISTS else WINDOW)
        if name == "hr":
            continue
        title = name == "h1" and not m["end"]
        if m["end"]:
            if n_open[name]:
                close(name)
        elif not m["rest"].endswith("/"):
            if name in OPTIONAL and any(n_open[t] for t in OPTIONAL[name]):
                # A list item or cell whose end tag is left out ends at the next one of its list or row.
                for t, _, _ in reversed(open_tags):
                    if t in OPTIONAL[name]:
                        close(t)
                        break
                    if t in CONTAINERS and t != "div":
                        break
            if resets(name, m["rest"]) or name == "body":
                for i in owned:
                    open_tags[i] = (open_tags[i][0], 0, open_tags[i][2])
                owned.clear()
                of_kind, tags, closed = [len(open_tags), 0, 0], 0, 0
            own = furniture(name, m["rest"])
            if name in ARTICLE:
                article_at = article_at if articles else m.start() + 1
                articles += 1
            if own or name in CONTAINERS or name in FURNITURE or name in ARTICLE:
                if outermost is None and name in CONTAINERS and name != "body" and name not in LISTS:
                    outermost = len(open_tags)
                if own:
                    owned.append(len(open_tags))
                    tags += name in FURNITURE
                    closed += unclosed is not None and m.start() not in unclosed
                open_tags.append((name, own, m.start()))
                n_open[name] += 1
                of_kind[own] += 1
    flush()
    return lines


def passages(lines: list[Line]) -> list[tuple[float, int, int]]:
    """Passages between surge and dive points of the window sums: sum of weights, first line, last (exclusive)."""
    out: list[tuple[float, int, int]] = []
    begin, total, rests = None, 0.0, 0
    for i, line in enumerate(lines):
        if line.weight:
            if begin is None:
                begin, total = i, 0.0  # surge: text from here on
            total, rests = total + line.weight, 0
        elif begin is not None:
            rests += 1
            if rests == WINDOW:  # dive: nothing for a whole window
                out.append((total, begin, i - WINDOW + 1))
                begin = None
    if begin is not None:
        out.append((total, begin, len(lines)))
    return out


def main_text(page: str) -> str:
    lines = lines_of(page)
    found = passages(lines)
    most = max((total for total, _, _ in found), default=0)
    strong = [line for total, a, b in found if total >= SHARE * most for line in lines[a:b] if line.weight]
    if not strong:
        return ""
    # Text inside fewer pieces of named furniture outweighs all of what stands inside more.
    named = min(line.named for line in strong)
    strong = [line for line in strong if line.named == named]
    tops, kinds = {line.top for line in strong}, {line.kind for line in strong} - {""}
    first, last = 0, len(lines)
    if 0 not in tops:
        at = [i for i, line in enumerate(lines) if line.weight and line.named == named and (line.top in tops or line.kind in kinds)]
        first, last = at[0], at[-1] + 1
        if not any(line.title for line in lines[first:last]):
            first = next((i for i in range(first - 1, -1, -1) if lines[i].title and lines[i].named == named), first)
    return "\n".join(line.text for line in lines[first:last] if line.weight and line.named <= named)


def main_text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array((main_text(p) for b in blocks(values, 64) for p in b), pa.string())

    return extract(text_of(page))


def extract(pages: DataFrame, html_column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_column`` in ``text``."""
    return pages.withColumn(text, main_text_column(F.col(html_column)))
