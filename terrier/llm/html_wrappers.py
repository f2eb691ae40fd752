"""Main text of web pages by inferred wrappers.

A wrapper is a regular expression without unions over what the pages of one host have in common: elements in order, each
once, optional (?), repeated (+) or both (*), with text slots where pages differ. Pages are aligned one after the other
with the wrapper so far: runs of equal siblings, and of equal pairs or triples, become repeated groups, what only some pages
have becomes optional, and an element keeps those of its texts that all pages have in it. Every task infers wrappers from its
own pages; those of a host are then aligned with one another, which needs as many rows of a host as there were tasks,
however many pages it has.

Each wrapper then names its regions: menus, notices and the like by their elements and names (outside an article also by parts
of names and by their share of links, inside one only containers whose names say nothing else), template text by being on all
pages, and candidates for the article by their element or name. Extraction follows a page along its host's wrapper and keeps
all candidates that the page has; where it has none, what the template doesn't explain. Pages may be nested at any depth: a
wrapper models the first levels, what lies deeper is judged by itself.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Fixed values of HTML: elements without content, with raw text, inline ones, and those that an open <p> ends at.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
    " svg math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts"
    " mtable mtr mtd semantics annotation annotation-xml".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements and words in class, id or role that mark what is not the article.
DROPPED = frozenset("head nav header footer aside form script style textarea title noscript template iframe svg menu dialog button select input object canvas audio video".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " header masthead footer sidebar aside complementary cookie cookies consent notice notices notification alert gdpr popup modal overlay"
    " comment comments commentlist reply replies respond disqus share sharing social related recommended newsletter subscribe signup login search widget pagination pager"
    " contentinfo toolbar skip hidden".split()
)
#: Inside an article, words drop these elements only, and only if their class, id and role say nothing else but such words, these ones and numbers.
CONTAINERS = frozenset("div section ul ol dl table details fieldset figure center span".split())
NEUTRAL_WORDS = frozenset("section box block container wrap wrapper list area item items inner outer left right top bottom small large group panel row col column title heading text body the and of for js is has no new page site post article entry".split())
MAIN = ("article", "main")
MAIN_WORDS = frozenset("article main content post entry story".split())
#: Hosts whose wrappers a task holds at once.
HOSTS_HELD = 500
#: Siblings in the longest group, items that an element of a wrapper may have before they become one loose group, and levels of a wrapper: these
#: bound the work of aligning. Texts are told from template text alike on all of them.
LONGEST_RUN, MOST_ITEMS, LEVELS = 3, 40, 100
#: Pages of a host from which texts that all of them have are the template's.
PAGES_ALIKE = 3
#: Tasks among which the wrappers of one host are dealt out before they are merged in one.
SALTS = 32

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


class Element:
    """sign: name and those words of class, id and role that tell regions apart (~ before those that are only part of a token, ! before words of names that say nothing else); parts: texts and elements in order."""

    __slots__ = ("name", "parts", "sign")

    def __init__(self, name: str, sign: str):
        self.name, self.sign, self.parts = name, sign, []


def _plain(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def tree(page: str | None) -> Element:
    """The elements of a page. Missing ends are implied, ends of nothing are ignored, raw text stays as it is and comments go."""
    root = Element("", "")
    stack, at, page = [root], 0, page or ""
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            if page[at:]:
                stack[-1].parts.append(_plain(page[at:]))
            return root
        if m.start() > at:
            stack[-1].parts.append(_plain(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name not in INLINE:
            # an open paragraph ends before a block, with the inline elements in it; list items and cells end each other
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p" or stack[k].name in CLOSED_BY.get(name, ()):
                    del stack[k:]
                    break
                if stack[k].name not in INLINE:
                    break
        attributes = m[3]
        words = []
        if attributes:
            plain, other = [], False
            for x in _NAMES.findall(attributes):
                for token in (x[1] or x[2] or x[3]).lower().split():
                    every = re.split("[_-]+", token)
                    parts = [w for w in every if w in DROPPED_WORDS or w in MAIN_WORDS]
                    words += parts if parts == [token] else ["~" + w for w in parts]
                    plain += [w for w in every if w in DROPPED_WORDS]
                    other = other or not all(w in DROPPED_WORDS or w in NEUTRAL_WORDS or not w.strip("0123456789") for w in every)
            if plain and not other:
                words.append("!only")
            if _HIDDEN.search(attributes):
                words.append("!hidden")
        made = Element(name, f"{name}.{'.'.join(sorted({w for w in words if w}))}" if words else name)
        stack[-1].parts.append(made)
        if name == "svg" and attributes.rstrip().endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append(made)


# A wrapper's item: s sign, q quantity ("", "?", "+", "*"), c items, t texts (None for no text, else the hashes of those that
# each page has in such elements), n pages, x characters of text, l characters of text in links.


def text_hash(texts: list[str]) -> str | None:
    """A short hash of an element's own text, white space aside; None for none."""
    words = " ".join(texts).split()
    return xxhash.xxh3_64_hexdigest(" ".join(words).encode("utf-8", "surrogatepass"))[:12] if words else None


def _weights(element: Element, in_link: bool) -> tuple[int, int]:
    """The characters of text in an element, and of those the ones in links."""
    x = links = 0
    left = [(element, in_link)]
    while left:
        e, linked = left.pop()
        linked = linked or e.name == "a"
        for part in e.parts:
            if not isinstance(part, str):
                left.append((part, linked))
            elif not part.isspace():
                x, links = x + len(part), links + len(part) * linked
    return x, links


def wrapper_of(element: Element, in_link: bool = False, level: int = 0) -> dict:
    """The wrapper of one page: its elements, with runs of siblings folded into repeated groups. Below LEVELS levels an element is one slot."""
    if level >= LEVELS:
        x, links = _weights(element, in_link)
        return {"s": element.sign, "q": "", "c": [], "t": [], "n": 1, "x": x, "l": links}
    texts, items, own = [], [], 0
    in_link = in_link or element.name == "a"
    for x in element.parts:
        if not isinstance(x, str):
            items.append(wrapper_of(x, in_link, level + 1))
        elif x and not x.isspace():
            own += len(x)
            texts.append(x)
    found = text_hash(texts)
    return {
        "s": element.sign,
        "q": "",
        "c": fold(items) if len(items) > 1 else items,
        "t": [found] if found else None,
        "n": 1,
        "x": own + sum([i["x"] for i in items]),
        "l": own * in_link + sum([i["l"] for i in items]),
    }


def _total(items: list[dict], key: str) -> int:
    return sum(i[key] for i in items)


def fold(items: list[dict]) -> list[dict]:
    """Repeats of one to LONGEST_RUN siblings become one repeated item or group."""
    signs = lambda some: [i["s"] for i in some]
    for width in range(1, LONGEST_RUN + 1):
        out: list[dict] = []
        for item in items:
            out.append(item)
            if width == 1:
                if len(out) > 1 and _key(out[-2]) == _key(item):
                    quantity = _quantity(out[-2]["q"], item["q"])
                    out[-2:] = [merge(out[-2], item, same_page=True) | {"q": "*" if quantity in ("?", "*") else "+"}]
                continue
            last = out[-width:]
            if len(out) > width and out[-width - 1]["s"] == "()" and signs(out[-width - 1]["c"]) == signs(last):
                before = [out[-width - 1]]
                made = [merge(x, y, same_page=True) for x, y in zip(before[0]["c"], last, strict=True)]
            elif len(out) >= 2 * width and signs(out[-2 * width : -width]) == signs(last) and len(set(signs(last))) > 1:
                before = out[-2 * width : -width]
                made = [merge(x, y, same_page=True) for x, y in zip(before, last, strict=True)]
            else:
                continue
            out[-width - len(before) :] = [{"s": "()", "q": "+", "c": made, "t": None, "n": 1, "x": _total(before + last, "x"), "l": _total(before + last, "l")}]
        items = out
    if len(items) > MOST_ITEMS or any(i["s"] == "(*)" for i in items):
        items = [loose(items)]
    return items


def loose(items: list[dict]) -> dict:
    """A repeated group in which each sign may stand any number of times: what bounds the wrapper of an irregular element."""
    signs: dict[str, dict] = {}
    for item in [i for x in items for i in (x["c"] if x["s"] in ("()", "(*)") else [x])]:
        signs[item["s"]] = merge(signs[item["s"]], item, same_page=True) if item["s"] in signs else item
        signs[item["s"]]["q"] = "*"
    inner = [signs[s] for s in sorted(signs)]
    return {"s": "(*)", "q": "+", "c": inner, "t": None, "n": 1, "x": _total(inner, "x"), "l": _total(inner, "l")}


def _quantity(a: str, b: str, missing: bool = False) -> str:
    optional = missing or a in ("?", "*") or b in ("?", "*")
    repeated = a in ("+", "*") or b in ("+", "*")
    return ("*" if optional else "+") if repeated else ("?" if optional else "")


def merge(a: dict, b: dict, same_page: bool = False) -> dict:
    """The wrapper that both a and b fit: the same element, its contents aligned by their signs. Of the texts of two pages those stay that both have; siblings of one page have theirs together."""
    if a["t"] is None or b["t"] is None:
        found = a["t"] if b["t"] is None else b["t"]
        text = found if same_page else [] if found is not None else None  # text on some pages only is a slot
    elif same_page:
        text = sorted({*a["t"], *b["t"]})
    else:
        text = sorted({*a["t"]} & {*b["t"]})
    return {
        "s": a["s"],
        "q": _quantity(a["q"], b["q"]),
        "c": align(a["c"], b["c"], same_page),
        "t": text,
        "n": max(a["n"], b["n"]) if same_page else a["n"] + b["n"],
        "x": a["x"] + b["x"],
        "l": a["l"] + b["l"],
    }


def _key(item: dict):
    return (item["s"], *(_key(i) for i in item["c"])) if item["s"] == "()" else item["s"]


def align(a: list[dict], b: list[dict], same_page: bool = False) -> list[dict]:
    """One sequence for both: items with equal signs meet (longest common subsequence), the rest becomes optional."""
    if any(i["s"] == "(*)" for i in (*a, *b)):
        return [loose_of_two(a, b, same_page)]
    ka, kb = [_key(i) for i in a], [_key(i) for i in b]
    if ka == kb:
        return [merge(x, y, same_page) for x, y in zip(a, b, strict=True)]
    n, m = len(ka), len(kb)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0

    def alone(item: dict) -> dict:
        return item | {"q": _quantity(item["q"], item["q"], missing=True)}

    while i < n or j < m:
        if i < n and j < m and ka[i] == kb[j]:
            out.append(merge(a[i], b[j], same_page))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(alone(a[i]))
            i += 1
        else:
            out.append(alone(b[j]))
            j += 1
    return fold(out)


def loose_of_two(a: list[dict], b: list[dict], same_page: bool) -> dict:
    """A loose group for the items of two elements; those of one sign meet as those of two pages do, unless it is one page."""
    one, two = ({i["s"]: i for i in loose(x)["c"]} if x else {} for x in (a, b))
    signs = {s: merge(one[s], two[s], same_page) if s in one and s in two else one.get(s) or two[s] for s in sorted({*one, *two})}
    inner = [i | {"q": "*"} for i in signs.values()]
    return {"s": "(*)", "q": "+", "c": inner, "t": None, "n": 1, "x": _total(inner, "x"), "l": _total(inner, "l")}


def expression(item: dict) -> str:
    """The wrapper as a readable expression."""
    inner = ("" if item["t"] is None else "".join(f" '{t}'" for t in item["t"]) if item["t"] else " #") + "".join(" " + expression(i) for i in item["c"])
    return f"({inner.strip()}){item['q']}" if item["s"] in ("()", "(*)") else f"<{item['s']}{inner}>{item['q']}"


def _sign(item: dict) -> tuple[str, set[str]]:
    name, *words = item["s"].split(".")
    return name, {w.lstrip("~") for w in words}


def _is_dropped(item: dict) -> bool:
    """Outside an article: by element, words and parts of words."""
    name, words = _sign(item)
    return name in DROPPED or "!hidden" in words or not DROPPED_WORDS.isdisjoint(words) and name not in MAIN and name not in ("html", "body")


def _is_dropped_inside(item: dict) -> bool:
    """Inside an article: by element, and containers whose names say nothing else."""
    name, *words = item["s"].split(".")
    return name in DROPPED or "!hidden" in words or name in CONTAINERS and "!only" in words


def _is_links(name: str, x: int, links: int) -> bool:
    return x > 0 and name in ("ul", "ol", "div", "section", "table") and links > 0.6 * x


def mark(item: dict, pages: int, loose: bool = False) -> dict:
    """What extraction needs of an item.

    d, i: dropped outside and inside an article. l: mostly links; None in loose groups, whose items are judged one by one.
    a: 2 an article by name, 1 by its words. f: texts that all of several pages have, which are the template's.
    """
    name, words = _sign(item)
    loose = loose or item["s"] == "(*)"
    return {
        "s": item["s"],
        "d": _is_dropped(item),
        "i": _is_dropped_inside(item),
        "l": None if loose else _is_links(name, item["x"], item["l"]),
        "a": 2 if name in MAIN else int(not MAIN_WORDS.isdisjoint(words)),
        "f": item["t"] if item["t"] and pages >= PAGES_ALIKE and item["n"] >= pages else [],
        "c": [mark(i, pages, loose) for i in item["c"]],
    }


def regions(wrapper: dict) -> dict:
    """The marked items of a wrapper."""
    return mark(wrapper, wrapper["n"])


def _look(items: list[dict], sign: str, start: int) -> tuple[dict | None, int]:
    """The item with this sign, from a place on and then from the beginning, also within groups."""
    for k in [*range(start, len(items)), *range(start)]:
        if items[k]["s"] == sign:
            return items[k], k
        if items[k]["s"] in ("()", "(*)"):
            for inner in items[k]["c"]:
                if inner["s"] == sign:
                    return inner, k
    return None, start


class _Seen:
    """An element of a page beside its item: characters of text, those in links, those that an article would keep."""

    __slots__ = ("children", "element", "fixed", "in_link", "item", "kept", "links", "off", "of_links", "up", "x")

    def __init__(self, element: Element, item: dict, up: _Seen | None, off: bool, in_link: bool):
        self.element, self.item, self.up, self.off = element, item, up, off
        self.in_link = in_link or element.name == "a"
        self.x = self.links = self.kept = 0
        self.children: list[_Seen] = []
        self.of_links = False
        texts = [p for p in element.parts if isinstance(p, str)] if item["f"] else []
        self.fixed = bool(item["f"]) and text_hash(texts) in item["f"]


def _paired(root: Element, marked: dict) -> list[_Seen]:
    """All elements beside their items, each before what it holds."""
    out = [_Seen(root, marked, None, False, False)]
    left = [out[0]]
    while left:
        seen, at = left.pop(), 0
        for part in seen.element.parts:
            if isinstance(part, str):
                n = 0 if part.isspace() else len(part)
                seen.x, seen.links, seen.kept = seen.x + n, seen.links + n * seen.in_link, seen.kept + n
                continue
            inner, at = _look(seen.item["c"], part.sign, at)
            if inner is None:  # what the host's wrapper doesn't cover is judged by itself
                inner = mark({"s": part.sign, "x": 0, "l": 0, "t": None, "n": 0, "c": []}, 1, True)
            made = _Seen(part, inner, seen, seen.off or inner["d"], seen.in_link)
            seen.children.append(made)
            out.append(made)
            left.append(made)
    for seen in reversed(out):  # what an element holds comes before it
        seen.of_links = _is_links(seen.element.name, seen.x, seen.links) if seen.item["l"] is None else seen.item["l"]
        if seen.up is not None:
            seen.up.x, seen.up.links = seen.up.x + seen.x, seen.up.links + seen.links
            seen.up.kept += 0 if seen.item["i"] else seen.kept
    return out


def _chosen(every: list[_Seen]) -> set[int]:
    """The candidates for the article: by name, or by words where no article by name lies within; of main elements those within, if any."""
    holds: dict[int, int] = {}  # whether candidates by words (1) or by name (2) lie within
    found: dict[int, _Seen] = {}
    for seen in reversed(every):
        within, kind = holds.get(id(seen), 0), seen.item["a"]
        if kind and seen.kept and not seen.off and not seen.of_links and not (within and seen.element.name == "main") and not (kind == 1 and within == 2):
            found[id(seen)] = seen
            within = kind
        if within and seen.up is not None:
            holds[id(seen.up)] = max(holds.get(id(seen.up), 0), within)
    outermost: set[int] = set()
    covered: set[int] = set()
    for seen in every:
        if seen.up is not None and id(seen.up) in covered:
            covered.add(id(seen))
        elif id(seen) in found:
            outermost.add(id(seen))
            covered.add(id(seen))
    return outermost


def _blocks(every: list[_Seen], chosen: set[int], template: bool) -> list[str]:
    """The blocks of the chosen elements; without any, of all that isn't dropped by itself, and without the template's texts if these go too."""
    blocks: list[list[str]] = [[]]
    # frames: the element, its parts and children that are left, whether texts count, whether it is in an article
    root = every[0]
    frames = [(root, iter(root.element.parts), iter(root.children), not chosen, False)]
    while frames:
        seen, parts, children, inside, in_article = frames[-1]
        part = next(parts, None)
        if part is None:
            frames.pop()
            if seen.element.name not in INLINE:
                blocks.append([])
            continue
        if isinstance(part, str):
            if inside and not (template and seen.fixed and not in_article):
                blocks[-1].append(part)
            continue
        child = next(children)
        if part.name == "br":
            blocks[-1].append(" ")
        elif part.name not in DROPPED:
            if in_article:
                now = inside and not child.item["i"], True
            elif id(child) in chosen:
                now = True, True
            else:
                now = inside and not child.item["d"] and not child.of_links, False
            if part.name not in INLINE:
                blocks.append([])
            frames.append((child, iter(part.parts), iter(child.children), *now))
    found = (" ".join("".join(b).split()) for b in blocks)
    return [b for b in found if b]


def extract(page: str | None, marked: dict) -> str:
    """The text of a page along its host's marked wrapper; blocks are joined by an empty line.

    The article is chosen among the candidates that the page has: pages of one host may be of several templates. A page
    without candidates gives what isn't the template's; one that has nothing else is a copy, and gives all of it.
    """
    every = _paired(tree(page), marked)
    chosen = _chosen(every)
    found = _blocks(every, chosen, True)
    return "\n\n".join(found or _blocks(every, chosen, False))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): for each host of pages(host, html) the wrapper that all its pages fit, as JSON.

    A task holds the wrappers of at most HOSTS_HELD hosts and passes them on when there are more. Those of a host are merged in
    up to SALTS tasks first, so that the last one sees no more of a host than that, and what tasks of several salts leave.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict] = {}

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array([json.dumps(w, ensure_ascii=False, separators=(",", ":")) for w in held.values()], pa.string())], ["host", "wrapper"])

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                made = wrapper_of(tree(page))
                if host in held:
                    made = merge(held[host], made)
                elif len(held) >= HOSTS_HELD:
                    yield out()
                    held.clear()
                held[host] = made
        if held:
            yield out()

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, made = None, None
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if host == current:
                    made = merge(made, json.loads(text))
                    continue
                if made is not None:
                    yield pa.record_batch([pa.array([current], pa.string()), pa.array([json.dumps(made, ensure_ascii=False, separators=(",", ":"))], pa.string())], ["host", "wrapper"])
                current, made = host, json.loads(text)
        if made is not None:
            yield pa.record_batch([pa.array([current], pa.string()), pa.array([json.dumps(made, ensure_ascii=False, separators=(",", ":"))], pa.string())], ["host", "wrapper"])

    parts = pages.select("host", "html").mapInArrow(local, "host string, wrapper string")
    # a host with very many wrappers is merged in many tasks first
    salted = parts.repartition("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).sortWithinPartitions("host", "wrapper").mapInArrow(across, "host string, wrapper string")
    return salted.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(across, "host string, wrapper string")


#: Wrappers are sent to all tasks up to this many bytes; beyond it they are joined by host.
BROADCAST_BYTES = 32 << 20


def extract_main_text(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) of pages(page_id, url, html).

    Null or empty html: empty text, 0 characters. Pages without a url share the host "". Repeated rows stay; other columns
    are not read. No pages: an empty table. Elements may be nested at any depth, and pages of any length are read whole. Texts
    that all of three or more pages of a host have in the same kind of element are the template's, but never within an article.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    wrappers = materialize(infer_wrappers(pages), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper")), F.lit(0))).first()[0]
    paired = pages.join(F.broadcast(wrappers) if size <= broadcast_bytes else wrappers, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            coded = batch.column(3).dictionary_encode()
            marked = []
            for text in coded.dictionary.to_pylist():
                if text not in known:
                    if len(known) >= HOSTS_HELD:
                        known.clear()
                    known[text] = regions(json.loads(text))
                marked.append(known[text])
            texts = [extract(page, marked[k]) for page, k in zip(batch.column(2).to_pylist(), coded.indices.to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return paired.select("page_id", "url", "html", "wrapper").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
