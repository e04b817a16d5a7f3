"""Text blocks of HTML pages and the paths of their containers, in one scan of the markup."""

from __future__ import annotations

import html
import re
from functools import lru_cache

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr br img "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
    "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml object select".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
CONTAINERS = frozenset("article main section div td body".split())
# Containers nested deeper count as the one at this depth, so paths stay short.
DEEPEST = 64
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class names and ids. Of others' words (comments, consent) a page often has more than of its own.
OTHERS = re.compile(r"comment\w*|disqus|repl(?:y|ies)|discussion|cookie\w*|consent")
NOISE = re.compile(
    r"ads?|advert\w*|banner|promo\w*|sponsor\w*|cookie\w*|consent|notice|popup|modal|newsletter|"
    r"subscri\w*|social|share|sharing|related|recommend\w*|sidebar|widgets?|breadcrumb\w*|menu|nav\w*|header|footer|"
    r"comment\w*|disqus|repl(?:y|ies)|discussion|pagination|pager|login|signup|masthead|toolbar|copyright"
)
# Builders' words that say nothing within a longer name, and ids that sections take from their headings.
BARE = re.compile(r"widgets?")
TOPICS = re.compile(r"discussion|related|shar\w+|recommend\w*|consent|notice|social|repl(?:y|ies)|copyright|sponsor\w*|advert\w*")
STRUCTURE = frozenset("area bar block body box col container content group inner list outer panel section text thread title wrap wrapper".split())
LACKS = frozenset("has hide no not show with without".split())
OWN = frozenset("article body content entry heading main page post section story text title".split())
# How sure a mark is. A NAMED element (nav and the like) is part of the text only where it
# holds the page, a whole class name also where nearly nothing is left without it; a form or
# a name with other words in it where it holds most of the text; others' words and hidden
# elements where nothing is left.
LIKELY, WHOLE, NAMED, SURE = range(1, 5)
MARKED_NAMES = {n: NAMED for n in ("nav", "header", "footer", "aside")} | {"form": LIKELY, "button": LIKELY, "menu": LIKELY, "dialog": SURE}
# Marks told apart within nested ones.
MOST_MARKS = 64
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

# Quoted values may hold ">"; where quotes do not close before the next "<", the tag ends at
# the first ">". No alternative reads on behind what it then takes, so a scan is linear.
_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]++|"[^"<]*"|'[^'<]*')*+>|[^>]*>))""", re.S
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|aria-label)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
# Of these an end tag may lack and "/>" may end them; only the others hold text up to their end tag.
_MAY_LACK_END = RAW - {"script", "style", "textarea", "title"}
_RAW_BEGIN = {name: re.compile(rf"<{name}[\s/>]", re.I) for name in _MAY_LACK_END}
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


@lru_cache(1 << 16)
def _name_level(name: str) -> int:
    """How sure a class name or id marks its element as no part of the text; 0 if it does not."""
    parts = [p for p in re.split(r"[^a-z]+", name) if p]
    words = [p for p in parts if NOISE.fullmatch(p)]
    if not words or parts[0] in LACKS:
        return 0
    telling = [p for p in parts if p in words or p not in STRUCTURE]
    last, whole = telling[-1], len(telling) == len(words)
    if OTHERS.fullmatch(last) or (whole and any(map(OTHERS.fullmatch, words))):
        return SURE
    if last in ("header", "banner", "masthead") and OWN.intersection(parts[: parts.index(last)]):
        return 0
    if whole:
        return WHOLE
    return 0 if all(map(BARE.fullmatch, words)) else LIKELY


def _traits(element: str, attributes: str) -> tuple[str, tuple[int, str] | None]:
    """(generalised classes, the surest mark of the element as no part of the text)."""
    if not attributes or attributes.isspace():
        return "", None
    classes, ids, mark = [], [], (0, "")
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "class":
            classes = value.split()
        elif name == "id":
            ids = value.split()
        elif name == "role" and value in ROLES:
            mark = max(mark, (LIKELY if value == "form" else WHOLE, f"role={value}"))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            mark = max(mark, (SURE, "hidden"))
    if element not in ("html", "body", "main"):
        # Ids of headings and sections are anchors named after the topic.
        anchored = element in ("section", "p", "li", "dt") or "section" in classes
        for value in classes:
            level = _name_level(value)
            if element not in HEADINGS or level == SURE:
                mark = max(mark, (level, value))
        for value in () if element in HEADINGS else ids:
            level = _name_level(value)
            if not (anchored and (level == LIKELY or any(map(TOPICS.fullmatch, re.split(r"[^a-z]+", value))))):
                mark = max(mark, (level, value))
    generalised = ".".join(sorted({re.sub(r"\d+", "0", c) for c in classes}))
    return generalised, mark if mark[0] and element != "body" else None


class Block(tuple):
    """(text, container path, characters within links, name of its element)."""

    __slots__ = ()


def page_blocks(page: str) -> list[Block]:
    """Blocks of the page's own text."""
    return blocks(page)


def blocks(page: str, marks: bool = True) -> list[Block]:
    """Text blocks in page order, without those of marked elements that are no part of the text."""
    found, holds = _scan(page)
    if not marks:
        return [block for block, _ in found]
    # All elements of one mark are judged together, by their text outside links.
    share: dict[tuple[int, str], int] = {}
    total = 0
    for (text, _, linked, _), own in found:
        if not any(level == SURE for level, _ in own):
            total += len(text) - linked
            for mark in own:
                share[mark] = share.get(mark, 0) + len(text) - linked
    kept = {
        mark
        for mark, chars in share.items()
        if (2 * chars > total and (mark[0] == LIKELY or mark in holds)) or (mark[0] == WHOLE and chars and 10 * chars >= 9 * total)
    }
    out = [block for block, own in found if own <= kept]
    return out or [block for block, own in found if not any(level == NAMED for level, _ in own)]


def _scan(page: str) -> tuple[list[tuple[Block, frozenset]], set[tuple[int, str]]]:
    """(every block with the marks of the elements around it, marks around a main element or first heading).

    A path lists the open containers from the outside in, each as tag and sorted
    classes with digits folded, so pages of one template share paths. Elements left
    open are closed by their parent's end, paragraphs by the next block element.
    """
    holds: set[tuple[int, str]] = set()
    out: list[tuple[Block, frozenset]] = []
    none: frozenset[tuple[int, str]] = frozenset()
    stack: list[tuple[str, str, frozenset]] = []  # name, path with it, marks
    parts: list[str] = []
    linked = [0]
    links = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            name, path, own = stack[-1] if stack else ("", "", none)
            out.append((Block((text, path, min(linked[0], len(text)), name)), own))
        parts.clear()
        linked[0] = 0

    def add(text: str) -> None:
        if text and not (stack and stack[-1][0] == "head"):
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked[0] += len(text.strip())

    # Behind the last ">" no tag ends.
    at, last = 0, page.rfind(">") + 1
    while True:
        m = _TAG.search(page, at, last)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                continue
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                flush()
                del stack[depth:]
                links = 0
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                add(" ")
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            if name in _MAY_LACK_END:
                if m[3].endswith("/>") or end is None or _RAW_BEGIN[name].search(page, at, end.start()):
                    continue  # nothing but the tag
            at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name == "a":
                links += 1
            continue
        flush()
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            stack.pop()
        if name == "li" and stack and stack[-1][0] == "li":
            stack.pop()
        parent, around = (stack[-1][1], stack[-1][2]) if stack else ("", none)
        classes, mark = _traits(name, m[3])
        if name in ("h1", "main"):
            holds |= around
        if name in MARKED_NAMES and not (name == "header" and any(n in ("article", "main") for n, _, _ in stack)):
            mark = max(mark or (0, ""), (MARKED_NAMES[name], f"<{name}>"))
        if mark and len(around) < MOST_MARKS:
            around |= {mark}
        path = parent
        if name in CONTAINERS and parent.count("/") < DEEPEST:
            path = f"{parent}/{name}" + (f".{classes}" if classes else "")
        stack.append((name, path, around))
        links = 0
    flush()
    return out, holds


def visible_text(page: str) -> str:
    """All text a page shows, menus and notices too, without scripts and the like."""
    return text_of(blocks(page, marks=False), None)


def container_scores(found: list[Block]) -> dict[str, float]:
    """Score of every container: characters outside links of its own blocks, and a part of its inner ones.

    A block counts fully for its own container and by 0.9 less a level for those
    around it, so the innermost one that holds most of the text wins.
    """
    scores: dict[str, float] = {}
    for text, path, linked, _ in found:
        value = float(len(text) - 2 * linked)
        while path:
            scores[path] = scores.get(path, 0.0) + value
            path = path.rpartition("/")[0]
            value *= 0.9
    return scores


def best_container(scores: dict[str, float]) -> str | None:
    """The path with the highest positive score (of equals the first by name), or the article around it."""
    best = min((p for p in scores if scores[p] > 0), key=lambda p: (-scores[p], p), default=None)
    around = re.match(r".*?/article(?:\.[^/]*)?(?=/|$)", best) if best else None
    return around[0] if around else best


def within(path: str, container: str) -> bool:
    """Whether a block's path lies in a container; of one that ends in "/", directly in it."""
    return path == container[:-1] if container.endswith("/") else path == container or path.startswith(f"{container}/")


def main_container(found: list[Block]) -> str | None:
    """The best container, widened to main, or to any around it whose other blocks are low in links.

    The body is widened to only where most of what it adds stands in it directly, and
    what is around an article only where a first heading is added. Of a container that
    is not widened to, a heading and the blocks beside it still count: further lines of
    the result name such containers, with "/" at the end.
    """
    best = best_container(container_scores(found))
    if best is None:
        return None
    rest = [b for b in found if not within(b[1], best)]
    around, article, beside = best.rpartition("/")[0], "/article" in best, []
    while around and rest:
        added = [b for b in rest if within(b[1], around)]
        chars, linked = sum(len(b[0]) for b in added), sum(b[2] for b in added)
        name = around.rpartition("/")[2].partition(".")[0]
        fits = name == "main" or 3 * linked <= chars
        if name == "body":
            fits &= 2 * sum(len(b[0]) for b in added if b[1] == around) >= chars
        if article:
            fits &= any(b[3] == "h1" for b in added)
        own = [b for b in added if b[1] == around]
        if added and fits:
            best, beside, rest = around, [], [b for b in rest if not within(b[1], around)]
        elif any(b[3] == "h1" for b in own) and 3 * sum(b[2] for b in own) <= sum(len(b[0]) for b in own):
            beside.append(f"{around}/")
        around = around.rpartition("/")[0]
    return "\n".join([best, *beside])


def text_of(found: list[Block], paths: str | None) -> str:
    """Blocks inside the containers (one a line), joined by an empty line; all of them without any."""
    return "\n\n".join(b[0] for b in inside(found, paths))


def inside(found: list[Block], paths: str | None) -> list[Block]:
    if paths is None:
        return found
    containers = paths.split("\n")
    return [b for b in found if any(within(b[1], c) for c in containers)]
