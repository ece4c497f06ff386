"""HTML extraction with site template removal.

A page is read into a small tree.  Each part of it (:data:`PARTS`) that holds
text has a hash of its subtree (names, classes, text).  Spark counts on how many
pages of a host a subtree occurs, pages of one main text counting once; subtrees
on at least ``LEAST_PAGES`` pages and more than ``TEMPLATE_SHARE`` of the host's
pages are its template and are deleted, and so are those of some words on at
least ``MANY_PAGES`` and more than ``MANY_SHARE``.  Only containers are template,
and paragraphs that lie in no article: an inline element, item, cell, heading or
an article's paragraph never is by itself, however often it recurs.
What by its element, role or class is navigation, a header, footer, sidebar,
notice, advert, form, script, style or comment section goes as well, since a menu
may differ on each page.  A class names such a part by its first or last word;
where that word has other meanings, long prose with few links is kept.  None of
this drops an article or most of a page.  The text is then that of the main part
or the articles, if they hold most of the body's, or the body, one line per block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import join_rows
from tidemark.session import stage

#: A subtree of a template occurs on so many pages of a host and on more than this share.
LEAST_PAGES = 10
TEMPLATE_SHARE = 0.5
#: On a large host a part of so many words is template on so many pages and more than this share.
MANY_PAGES = 100
MANY_SHARE = 0.1
PART_WORDS = 5
SLICE_ROWS = 128

#: Fixed values of HTML: elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Containers, which may be a menu, promo or notice as a whole.
PARTS = frozenset(
    "address aside center details dir div dl fieldset figure footer form header hgroup menu nav ol "
    "section table ul".split()
)
#: A start tag of the second column ends an open element of the first.
CLOSES_PARAGRAPH = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr li dd dt legend".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dd": frozenset(["dd", "dt"]),
    "dt": frozenset(["dd", "dt"]),
    "td": frozenset("td th tr tbody thead tfoot".split()),
    "th": frozenset("td th tr tbody thead tfoot".split()),
    "tr": frozenset("tr tbody thead tfoot".split()),
    "option": frozenset(["option", "optgroup"]),
}
SCOPES = frozenset("ul ol menu dl table select body html article section div".split())
#: Elements that are never part of an article's text.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input label map menu nav "
    "noembed noframes noscript object script search select style svg template textarea title video "
    "xmp".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar".split()
)
#: Words in classes and ids that name such parts, at either end of a name of several words.
STRONG_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus gdpr nav navbar navigation newsletter pagination paywall "
    "replies reply respond sidebar sidebars skyscraper sponsor sponsored sponsors".split()
)
#: Words that name such parts but also something else.
WEAK_NAMES = frozenset(
    "banner footer masthead menu modal notice notices notification overlay popup promo promos promotion "
    "recommended related share sharing signup social subscribe subscription toolbar widget widgets".split()
)
DROPPED_NAMES = STRONG_NAMES | WEAK_NAMES
#: Names of such parts that no word of theirs is alone.
DROPPED_PAIRS = frozenset(
    ["author bio", "author box", "author card", "more stories", "most popular", "most read", "read next",
     "top stories"]
)
#: First words that make the rest of a name say what something has, not what it is.
ABOUT_NAMES = frozenset("category has in is no not tag type with without".split())
#: Words beside which a weak name is one for certain, as in ``site-footer``, and which an id may hold besides.
BESIDE_NAMES = frozenset(
    "area bar block bottom box button buttons container global icons inner left links list main page "
    "primary right secondary section site top user wrap wrapper".split()
)
#: Characters of text with few links from which a part with a weak name is prose.
PROSE_CHARS = 200
PROSE_LINKS = 0.3
#: Elements that no class or id drops, and those that an id may drop.
KEPT = frozenset("article main h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("div section header footer nav aside ul ol dl table form figure center".split())
#: The same outside an article, whose own header is part of it.
PAGE_HEADERS = frozenset("header headers topbar topnav logo".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=|\"|')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+))")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class Element:
    """An element: its name, the words of its class, id and role, its children."""

    __slots__ = ("name", "label", "classes", "id", "hidden", "role", "children", "key", "heavy", "prose")

    def __init__(self, name: str, attrs: str = "") -> None:
        self.name, self.label, self.role, self.hidden, self.key = name, "", "", False, 0
        self.classes, self.id, self.heavy, self.prose = "", "", False, False
        self.children: list[Element | str] = []
        if attrs:
            found = {
                m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attrs)
            }
            self.label = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
            self.classes = found.get("class", "").lower()
            self.id = found.get("id", "").lower() if name in CONTAINERS else ""
            self.role = found.get("role", "").strip().lower()
            self.hidden = found.get("aria-hidden", "").lower() == "true" or bool(
                re.search(r"(?:^|\s)hidden(?:\s|/|$)", re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", "=", attrs))
            )

    def dropped(self, in_article: bool) -> bool:
        if self.name in DROPPED or self.role in DROPPED_ROLES or self.hidden:
            return True
        if self.name == "header" and not in_article:
            return True
        if self.heavy or self.name in KEPT or self.role in ("main", "article"):
            return False
        headers = frozenset() if in_article else PAGE_HEADERS
        for token in f"{self.classes} {self.id}".split():
            words = _WORD.findall(token)
            named = [w for w in words if w in DROPPED_NAMES or w in headers]
            if named and all(w in named or w in BESIDE_NAMES for w in words):
                return True
        return any(self._names_a_part(_WORD.findall(token)) for token in self.classes.split())

    def _names_a_part(self, words: list[str]) -> bool:
        if not words or words[0] in ABOUT_NAMES:
            return False
        ends = {words[0], words[-1]}
        if ends & STRONG_NAMES or " ".join(words[:2]) in DROPPED_PAIRS:
            return True
        return bool(ends & WEAK_NAMES) and not self.prose

    def may_be_template(self, in_article: bool) -> bool:
        return self.name in PARTS or self.name == "p" and not in_article


def parse(html: str) -> Element:
    """The tree of a page, with ends that may be left out put in."""
    root = Element("html")
    stack = [root]
    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.search(html, at)
        begin = token.start() if token else size
        if begin > at:
            stack[-1].children.append(unescape(html[at:begin]))
        if not token:
            break
        at = token.end()
        if not token["name"]:
            continue
        name = token["name"].lower()
        if token["end"]:
            _close(stack, name)
            continue
        if name in ("html", "body"):
            continue
        _make_room(stack, name)
        element = Element(name, token["attrs"])
        stack[-1].children.append(element)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if name not in ("path", "circle", "rect") or not token["attrs"].rstrip().endswith("/"):
            stack.append(element)
    return root


def _make_room(stack: list[Element], name: str) -> None:
    if name in CLOSES_PARAGRAPH:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name == "p":
                del stack[depth:]
                break
            if stack[depth].name in BLOCKS:
                break
    for depth in range(len(stack) - 1, 0, -1):
        open_name = stack[depth].name
        if name in CLOSED_BY.get(open_name, ()):
            del stack[depth:]
            break
        if open_name in SCOPES:
            break


def _close(stack: list[Element], name: str) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].name == name:
            del stack[depth:]
            return
        if name not in BLOCKS and stack[depth].name in BLOCKS:
            return


def subtrees(root: Element) -> dict[int, bool]:
    """Hashes of the parts with text, and whether each has words enough; each element bears its own.

    Parts within an article count only if they have.
    """
    import xxhash

    found: dict[int, bool] = {}
    words: dict[int, int] = {}
    # Children before parents, without recursion: pages may nest deeply.
    order: list[tuple[Element, bool]] = []
    todo = [(root, False)]
    while todo:
        element, inside = todo.pop()
        order.append((element, inside))
        inside = inside or is_unit(element)
        todo.extend((c, inside) for c in element.children if not isinstance(c, str))
    for element, inside in reversed(order):
        parts, n = [], 0
        for child in element.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                if text:
                    parts.append(text)
                    n += text.count(" ") + 1
            elif child.key:
                parts.append(f"\x00{child.key}")
                n += words[child.key]
        if parts:
            packed = "\x01".join([element.name, element.label, *parts])
            element.key = xxhash.xxh3_64_intdigest(packed.encode("utf-8", "surrogatepass")) - (1 << 63)
            words[element.key] = n
            if element is not root and element.may_be_template(inside) and (n >= PART_WORDS or not inside):
                found[element.key] = n >= PART_WORDS
    return found


def is_unit(element: Element) -> bool:
    return element.name in ("article", "main") or element.role in ("main", "article")


def weigh(root: Element) -> None:
    """Mark the elements that hold most of the page's text, unless an article or main stands beside them.

    Marks those that hold prose, too: text of some length with few links.
    """
    order, todo = [], [root]
    while todo:
        element = todo.pop()
        order.append(element)
        todo.extend(c for c in element.children if not isinstance(c, str))
    sizes: dict[int, int] = {}
    linked: dict[int, int] = {}
    units: dict[int, bool] = {}
    for element in reversed(order):
        if element.name in DROPPED or element.role in DROPPED_ROLES or element.hidden:
            sizes[id(element)], linked[id(element)], units[id(element)] = 0, 0, False
            continue
        size, links, unit = 0, 0, is_unit(element)
        for child in element.children:
            if isinstance(child, str):
                size += len(child.strip())
            else:
                size += sizes[id(child)]
                links += linked[id(child)]
                unit = unit or units[id(child)]
        links = size if element.name == "a" else links
        element.prose = size >= PROSE_CHARS and links <= PROSE_LINKS * size
        sizes[id(element)], linked[id(element)], units[id(element)] = size, links, unit
    top = root
    while True:
        inner = [c for c in top.children if not isinstance(c, str)]
        heavy = next((c for c in inner if 2 * sizes[id(c)] > sizes[id(root)]), None)
        if heavy is None or any(units[id(c)] for c in inner if c is not heavy):
            return
        heavy.heavy = True
        top = heavy


def units_of(root: Element) -> list[Element]:
    """The articles and mains that lie in no other, in page order."""
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if is_unit(element):
            found.append(element)
            continue
        todo.extend(
            c for c in reversed(element.children) if not isinstance(c, str) and not c.dropped(False)
        )
    return found


def text_blocks(top: Element, template: frozenset[int] | set[int]) -> list[str]:
    """Text of the blocks in page order, white space folded."""
    blocks: list[str] = []
    run: list[str] = []
    # (element, next child, in an article): a stack instead of recursion.
    todo: list[tuple[Element, int, bool]] = [(top, 0, top.name != "html")]

    def end() -> None:
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip()
            if text:
                blocks.append(text)
            run.clear()

    while todo:
        element, at, inside = todo.pop()
        if at == len(element.children):
            if element.name in BLOCKS:
                end()
            continue
        todo.append((element, at + 1, inside))
        child = element.children[at]
        if isinstance(child, str):
            run.append(child)
        elif child.name == "br":
            run.append(" ")
        elif child.dropped(inside) or child.key in template and child.key and child.may_be_template(inside):
            if child.name in BLOCKS or child.name in DROPPED:
                run.append(" ")
        else:
            if child.name in BLOCKS:
                end()
            todo.append((child, 0, inside or is_unit(child)))
    end()
    return blocks


def page_text(root: Element, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The text of the mains, or else of all articles and mains, that hold most of the body's; or the body's."""
    weigh(root)
    whole = text_blocks(root, template)
    units = units_of(root)
    mains = [u for u in units if u.name == "main" or u.role == "main"]
    for chosen in (mains, units):
        blocks = [block for unit in chosen for block in text_blocks(unit, template)]
        if 2 * sum(map(len, blocks)) > sum(map(len, whole)):
            return "\n".join(blocks)
    return "\n".join(whole)


def main_text(html: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    root = parse(html)
    if template:
        subtrees(root)
    return page_text(root, template)


def _host(url):
    """The host of an address, in lower case, without user and port; null if there is none."""
    found = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.coalesce(found, F.lit(""))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The subtrees of each page, and key 0 for the page; ``page`` is the hash of its main text."""
    import xxhash

    for whole in batches:
        for begin in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(begin, SLICE_ROWS)
            hosts, keys, parts, pages = [], [], [], []
            for host, html in zip(batch.column("_host").to_pylist(), batch.column("_html")):
                root = parse(html.as_py() or "")
                found = subtrees(root)
                text = page_text(root).encode("utf-8", "surrogatepass")
                hosts += [host] * (len(found) + 1)
                keys += [0, *found]
                parts += [False, *found.values()]
                pages += [xxhash.xxh3_64_intdigest(text) - (1 << 63)] * (len(found) + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hosts, pa.string()),
                    pa.array(keys, pa.int64()),
                    pa.array(parts, pa.bool_()),
                    pa.array(pages, pa.int64()),
                ],
                names=["_host", "key", "part", "page"],
            )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(begin, SLICE_ROWS)
            texts = [
                main_text(html.as_py() or "", frozenset(keys.as_py() or ()))
                for html, keys in zip(batch.column("_html"), batch.column("keys"))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_url"),
                    pa.array(texts, pa.string()),
                    pa.array(np.fromiter(map(len, texts), np.int64, len(texts))),
                ],
                names=["_id", "_url", "text", "n_chars"],
            )


def templates(pages: DataFrame, least_pages: int, share: float) -> DataFrame:
    """``_host, keys``: the subtrees of each host's template.

    Copies of a page count once.  A subtree is on more than ``MANY_SHARE`` of the
    pages, so a host has at most 1 / ``MANY_SHARE`` times as many as an average
    page has elements.
    """
    counts = (
        pages.mapInArrow(_count, "_host string, key long, part boolean, page long")
        .groupBy("_host", "key", "page").agg(F.max("part").alias("part"))
        .groupBy("_host", "key").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
        .where(F.col("n") >= least_pages)
    )
    counts = stage(counts, "subtrees")
    sizes = counts.where("key = 0").select("_host", F.col("n").alias("pages"))
    many = F.col("part") & (F.col("n") >= MANY_PAGES) & (F.col("n") > MANY_SHARE * F.col("pages"))
    return (
        join_rows(counts.where("key <> 0"), sizes, ["_host"], "inner")
        .where((F.col("n") > share * F.col("pages")) | many)
        .groupBy("_host").agg(F.collect_list("key").alias("keys"))
    )


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = LEAST_PAGES,
    share: float = TEMPLATE_SHARE,
) -> DataFrame:
    """``id_col, url_col, text, n_chars`` for every page.

    Null and empty pages have an empty text; pages whose address is null or has
    no host form one host.  Pages of one main text have each their row
    and count once for the template.
    Truncated and badly nested pages give what can be read.  Other columns don't
    matter.  An empty table gives an empty result.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.col(f"`{url_col}`").cast("string").alias("_url"),
        _host(F.col(f"`{url_col}`").cast("string")).alias("_host"),
        F.col(f"`{html_col}`").cast("string").alias("_html"),
    )
    found = templates(rows.select("_host", "_html"), least_pages, share)
    met = join_rows(rows, found, ["_host"], "left").select("_id", "_url", "_html", "keys")
    return met.mapInArrow(
        _extract, "_id long, _url string, text string, n_chars long"
    ).withColumnsRenamed({"_id": id_col, "_url": url_col})
