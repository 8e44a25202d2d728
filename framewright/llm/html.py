"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framewright.llm.common import slices, written

#: Elements whose content is no markup and no text of the page.
RAW = frozenset("script style noscript template textarea svg math iframe object select button title".split())
#: One token. A tag whose quoted values hold a ``<`` or ``>`` comes as ``open`` alone and is closed by ``Tags``.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>\"'<]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>"
    r"|<(?P<slow>/?)(?P<open>[a-zA-Z][^\s/>\"'<]*+)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
VALUES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
QUOTED = re.compile(r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag closes if it is the innermost open element.
CLOSES = {"li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "tr": {"td", "th", "tr", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"}}
#: Elements that are never part of an article, wherever they stand, and those that are not outside of one.
NEVER = frozenset("nav aside form footer head menu dialog".split())
OUTSIDE = frozenset(["header"])
#: Words of classes and ids that name such parts, in the languages of many pages.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense banner banners cookie cookies consent gdpr notice notices alert alerts "
    "popup popups modal promo promos promotion promotions sponsor sponsors sponsored sidebar sidebars side menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer footers comment comments commentlist respond replies disqus share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search widget widgets pagination pager toolbar skip copyright legal "
    "teaser teasers werbung anzeige anzeigen kommentar kommentare seitenleiste fusszeile hinweis hinweise anmelden suche "
    "publicite reklame reclame commentaire commentaires publicidad anuncio anuncios comentario comentarios publicidade pubblicita "
    "commenti reacties".split()
)
#: Words that say nothing about what an element holds: with them alone beside it, a name above still names the whole element.
NEUTRAL = frozenset(
    "0 area articles bar bars block blocks body bottom box boxes button buttons c center col column container content count desktop entry "
    "fixed floating form global grid group header heading icon icons inline inner input item items js l left link links list lists main "
    "mobile module o outer overlay page panel panels post posts primary region right row secondary section sections site slot sticky "
    "thread title toggle top u unit units view wrap wrapper zone".split()
)
OUTSIDE_NAMES = frozenset("header masthead topbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of an article that are rejected by a class alone; their ids are anchors.
WORDING = frozenset("p pre blockquote table thead tbody tfoot tr td th caption figure figcaption dl dt dd address".split())
#: Elements whose text, if it is the same on all pages of a host that have them, belongs to its template.
BOXES = frozenset("div section".split())
#: Words that say how a page is laid out and name no part of it.
LAYOUT = re.compile(r"(?:has|no|with|without)[-_].*|.*[-_](?:open|closed|enabled|disabled)")
#: Parts that often outgrow the article.
THREADS = frozenset(
    "comment comments commentlist respond replies disqus kommentar kommentare commentaire commentaires comentario comentarios commenti reacties".split()
)
GROUP = "()"
#: Stands for any class and id words in a label.
ANY = "\u2026"
#: Block elements that keep their name where labels are made coarse.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 head header html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Bounds of a wrapper: elements side by side, elements below one another, elements in all. Beyond them it gets coarser; texts don't.
WIDE, DEEP, LARGE = 100, 100, 5_000
#: Different pages that make equal text a constant.
PAGES = 3


def pieces_of(word: str) -> list[str]:
    return [p.rstrip("0") or "0" for p in re.split(r"[-_]+", word) if p]


def names_part(word: str) -> bool:
    """Whether a class or id word as a whole names a part that is no article: ``related-posts``, but not ``related-work``."""
    pieces = pieces_of(word)
    return any(p in NAMES for p in pieces) and all(p in NAMES or p in NEUTRAL for p in pieces)


def label_of(name: str, attrs: str) -> str:
    """Tag, class and id words with digits made alike, and marks: ``!`` hidden, ``*`` declared main, ``-`` named as no part
    of an article, ``.`` with such a name as a part of a word, ``=`` a thread of comments, ``~`` none outside of an article. Marks
    come from all words; four of them are kept to align elements. A page's html and body have no marks, headings none from names,
    paragraphs and tables none from ids and parts of words."""
    return short_label(name, attrs) if len(attrs) <= 500 else short_label.__wrapped__(name, attrs)


@lru_cache(maxsize=50_000)
def short_label(name: str, attrs: str) -> str:
    name = name.replace("|", "")
    if not attrs.strip():
        return name
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)}
    classes, ids = (re.sub(r"\d+", "0", html.unescape(found.get(k, "")).lower()).replace("|", "").split() for k in ("class", "id"))
    words = classes + ids
    named = [w for w in (classes if name in WORDING else words) if not LAYOUT.fullmatch(w)]
    pieces = {p for w in named for p in pieces_of(w)}
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
    role = found.get("role", "").lower()
    if role in ("navigation", "banner", "contentinfo", "search", "complementary", "dialog", "alert"):
        hidden = True
    mark = ("!" if hidden else "") + ("*" if role in ("main", "article") else "")
    if name not in HEADINGS:
        whole = any(map(names_part, named))
        mark += "-" if whole else "." if pieces & NAMES and name not in WORDING else ""
        mark += ("~" if pieces & OUTSIDE_NAMES else "") + ("=" if pieces & THREADS else "")
    if name in ("html", "body"):
        mark = ""
    return f"{name}|{' '.join(sorted(set(words))[:4])}|{mark}" if words or mark else name


def marks_of(label: str) -> str:
    return label.rpartition("|")[2] if "|" in label else ""


@lru_cache(maxsize=50_000)
def coarse(label: str) -> str:
    """The label without its class and id words, and without names that are no block element's."""
    name = label.partition("|")[0]
    return f"{name if name in BLOCKS else 'x'}|{ANY}|{marks_of(label)}"


def is_coarse(label: str) -> bool:
    return f"|{ANY}|" in label


@lru_cache(maxsize=50_000)
def unwanted(label: str, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside``: it stands within one."""
    name, mark = label.partition("|")[0], marks_of(label)
    if name in NEVER or "!" in mark or not inside and name in OUTSIDE:
        return True
    return "-" in mark or not inside and ("~" in mark or "." in mark)


@lru_cache(maxsize=50_000)
def declared(label: str) -> bool:
    """Whether an element says that it is the article."""
    return (label.partition("|")[0] in ("article", "main") or "*" in marks_of(label)) and not unwanted(label, True)


class Node:
    """An element of a wrapper: its label, how often it comes (optional, repeated) and what is in it. Text slots are
    added up in the element: their characters, those in links, a hash of the text and whether it differs between pages. ``digest``
    is that of all text in the element, ``fixed`` says that it is always the same, and ``seen`` has the smallest ``PAGES``
    digests of pages with the element, so copies of a page count once."""

    __slots__ = ("label", "kids", "optional", "repeated", "chars", "links", "hash", "varies", "digest", "fixed", "seen")

    def __init__(self, label: str):
        self.label, self.kids = label, []
        self.optional = self.repeated = self.varies = False
        self.chars = self.links = self.hash = self.digest = 0
        self.fixed, self.seen = True, ()

    def pack(self) -> list:
        flags = self.optional | self.repeated << 1 | self.varies << 2 | self.fixed << 3
        return [self.label, flags, self.chars, self.links, self.hash, self.digest, self.seen, [k.pack() for k in self.kids]]

    @staticmethod
    def unpack(raw: list) -> Node:
        node = Node(raw[0])
        node.optional, node.repeated, node.varies, node.fixed = (bool(raw[1] >> i & 1) for i in range(4))
        node.chars, node.links, node.hash, node.digest = raw[2:6]
        node.seen = tuple(raw[6])
        node.kids = [Node.unpack(k) for k in raw[7]]
        return node

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)


class Tags:
    """Ends of the tags of one page whose quoted values hold ``<`` or ``>``.

    Where a tag never ends, its reading goes to the end of the page. Such readings are remembered by the quoted runs they go through: a
    later tag that starts outside of them would be read alike, so at most three of them happen on a page, however many
    quotes are open."""

    def __init__(self, page: str):
        self.page = page
        self.open: list[tuple[int, list[int], list[int]]] = []

    def end(self, at: int) -> int:
        """Position of the tag's ``>``, -1 if it never ends; ``at`` is where its name does."""
        for first, starts, stops in self.open:
            i = bisect_right(starts, at) - 1
            if at >= first and (i < 0 or at >= stops[i]):
                return -1
        stop = VALUES.match(self.page, at).end()
        if stop < len(self.page) and self.page[stop] == ">":
            return stop
        runs = [m.span() for m in QUOTED.finditer(self.page, at)]
        self.open.append((at, [a for a, _ in runs], [b for _, b in runs]))
        return -1


def settle(root: Node) -> None:
    """Take the marks of a name off the elements that hold the article all the same, so that no name empties a page.

    Those are an element with more than half of the plain text of the page or such element around it, one with four fifths of the
    article around it, and one with a declared article, if no article and no more text stands there outside of named elements.
    A thread of comments is let in by its length only if all other text is in named elements. An element that only part of a
    word names is no part of an article where most of its text is links."""

    def count(node: Node) -> tuple[int, int]:
        text, linked = node.chars, node.links
        for kid in node.kids:
            t, k = count(kid)
            text, linked = text + t, linked + k
        mark = marks_of(node.label)
        if "." in mark and 2 * linked > text:
            node.label = node.label[:len(node.label) - len(mark)] + mark.replace(".", "-")
        return text, linked

    count(root)
    sums: dict[int, tuple[int, int, bool, bool]] = {}  # plain text, that outside of named elements, an article below, one outside of them

    def named(node: Node, inside: bool) -> bool:
        mark = marks_of(node.label)
        return "-" in mark or not inside and ("~" in mark or "." in mark)

    def out(node: Node) -> bool:
        return node.label.partition("|")[0] in NEVER or "!" in marks_of(node.label)

    def add(node: Node, inside: bool) -> None:
        plain = free = node.chars - node.links
        below = outside = False
        for kid in node.kids:
            if out(kid):
                continue
            add(kid, inside or declared(kid.label))
            p, f, b, o = sums[id(kid)]
            plain, below = plain + p, below or b or declared(kid.label)
            if not named(kid, inside):
                free, outside = free + f, outside or o or declared(kid.label)
        sums[id(node)] = plain, free, below, outside

    def walk(node: Node, base: Node, inside: bool) -> None:
        plain, free, _, outside = sums[id(base)]
        for kid in node.kids:
            if out(kid):
                continue
            if not named(kid, inside):
                here = declared(kid.label)
                walk(kid, kid if here else base, inside or here)
                continue
            own, _, below, _ = sums[id(kid)]
            most = own > (4 if inside else 1) * (plain - own) and ("=" not in marks_of(kid.label) or not free)
            if own and (most or below and not outside and own >= free):
                words, _, mark = kid.label.rpartition("|")
                kid.label = f"{words}|{mark.strip('-~=.')}"
                walk(kid, kid, inside or declared(kid.label))

    add(root, False)
    walk(root, root, False)


@lru_cache(maxsize=None)
def raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\s*+>", re.I)


def stamp(node: Node, page: int) -> None:
    """Digests of all text in each element, and that of the page in those with text."""
    digest = node.hash
    for kid in node.kids:
        stamp(kid, page)
        if kid.seen:
            digest = zlib.crc32(kid.digest.to_bytes(4, "little"), digest)
            node.seen = (page,)
    if node.chars:
        node.seen = (page,)
    node.digest = digest


def read_page(page: str) -> tuple[Node, list[tuple[tuple[str, ...], str]]]:
    """The tree of a page's block elements and its text blocks, (path of labels, text), in page order.

    Inline markup belongs to the text around it. Character references are decoded, white space is one
    space. Raw elements (scripts, styles, forms' fields) and comments are left out. Time is linear in the page, also with quotes
    that never end (such a ``<`` is text). Elements more than ``DEEP`` below one another count as part of the one there."""
    root = Node("")
    nodes, names = [root], [""]
    paths: list[tuple[Node, ...]] = [()]
    blocks: list[tuple[tuple[Node, ...], str]] = []
    named = False
    buffer: list[str] = []
    link = linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                node = nodes[-1]
                blocks.append((paths[-1], text))
                node.chars += len(text)
                node.links += min(linked, len(text))
                node.hash = zlib.crc32(text.encode("utf-8", "surrogatepass"), node.hash)
        linked = 0

    tags, at = Tags(page), 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        text, name, attrs, closing = m["text"], m["name"], m["attrs"], m["end"]
        if m["open"] is not None:
            stop = tags.end(at)
            if stop < 0:
                text, at = "<", m.start() + 1
            else:
                name, attrs, closing, at = m["open"], page[at:stop], m["slow"], stop + 1
        if text is not None:
            buffer.append(text)
            if link:
                linked += len(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not closing:
            over = raw_end(name).search(page, at)
            at = over.end() if over else len(page)
            continue
        if name in INLINE:
            if name == "a":
                link = 0 if closing else 1
            continue
        if name in VOID:
            buffer.append(" ")
            if name == "hr":
                flush()
            continue
        flush()
        if closing:
            if name in names:
                while names.pop() != name:
                    nodes.pop()
                    paths.pop()
                nodes.pop()
                paths.pop()
            if not names:
                nodes, names, paths = [root], [""], [()]
            continue
        closes = CLOSES.get(name, ("p",))
        while names[-1] in closes:
            names.pop()
            nodes.pop()
            paths.pop()
        label = label_of(name, attrs)
        names.append(name)
        if len(paths[-1]) >= DEEP and (len(paths[-1]) > DEEP or not unwanted(label, True)):
            nodes.append(nodes[-1])
            paths.append(paths[-1])
            continue
        node = Node(label)
        nodes[-1].kids.append(node)
        nodes.append(node)
        paths.append((*paths[-1], node))
        named = named or bool(label) and label[-1] in "-~=."
    flush()
    if named:
        settle(root)
    stamp(root, zlib.crc32("\n".join(text for _, text in blocks).encode("utf-8", "surrogatepass")))
    labels = {path: tuple(n.label for n in path) for path, _ in blocks}
    return root, [(labels[path], text) for path, text in blocks]


def merge(a: Node, b: Node) -> Node:
    """One node for two with the same label: counts add up, texts that differ make the slot vary."""
    a.optional |= b.optional
    a.repeated |= b.repeated
    if a.chars and b.chars:
        a.varies |= b.varies or a.hash != b.hash
    elif b.chars:
        a.hash, a.varies = b.hash, b.varies
    a.chars += b.chars
    a.links += b.links
    if a.seen and b.seen:
        a.fixed &= b.fixed and a.digest == b.digest
    elif b.seen:
        a.digest, a.fixed = b.digest, b.fixed
    a.seen = tuple(sorted({*a.seen, *b.seen})[:PAGES])
    a.kids = align(a.kids, b.kids)
    return a


def bag(row: list[Node]) -> list[Node]:
    """A row too wide to be aligned: one optional, repeated element for each coarse label."""
    out: dict[str, Node] = {}
    for node in row:
        for one in node.kids if node.label == GROUP else [node]:
            label = coarse(one.label)
            if label in out:
                merge(out[label], one)
            else:
                out[label], one.label = one, label
            out[label].optional = out[label].repeated = True
    return list(out.values())


def shrink(root: Node) -> Node:
    """Bound a wrapper to ``LARGE`` elements: rows become coarse, and if that is not enough, the deepest levels go into
    the elements above them."""
    if root.size() <= LARGE:
        return root

    def soften(node: Node) -> None:
        node.kids = bag(node.kids)
        for kid in node.kids:
            soften(kid)

    def cut(node: Node, inside: bool, deep: int) -> None:
        if not deep:
            plain, linked = totals(node, inside)
            node.chars, node.links, node.varies, node.kids = plain + linked, linked, True, []
        for kid in node.kids:
            cut(kid, inside or declared(node.label), deep - 1)

    soften(root)
    deep = DEEP
    while root.size() > LARGE:
        deep -= 1
        cut(root, False, deep)
    return root


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Align two rows of elements. What only one of them has becomes optional, what follows itself repeated."""
    if [x.label for x in a] == [x.label for x in b]:
        return [merge(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    if max(n, m) > WIDE or any(is_coarse(x.label) for x in (*a, *b)):
        return bag([*a, *b])
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            same = a[i].label == b[j].label
            best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].label == b[j].label:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
            continue
        if j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            node, i = a[i], i + 1
        else:
            node, j = b[j], j + 1
        node.optional = True
        out.append(node)
    return narrow(repeats(out))


def narrow(row: list[Node]) -> list[Node]:
    return bag(row) if len(row) > WIDE else row


def repeats(row: list[Node]) -> list[Node]:
    """Fold what follows itself: one element, or a group of up to three, becomes repeated."""
    for k in (1, 2, 3):
        i, out = 0, []
        while i < len(row):
            group = row[i:i + k]
            labels = [x.label for x in group]
            j, again = i + k, False
            while len(group) == k and [x.label for x in row[j:j + k]] == labels:
                group = [merge(x, y) for x, y in zip(group, row[j:j + k])]
                j, again = j + k, True
            if not again:
                out.append(row[i])
                i += 1
                continue
            if k == 1:
                node = group[0]
            else:
                node = Node(GROUP)
                node.kids = group
            node.repeated = True
            out.append(node)
            i = j
        row = out
    return row


def fold(node: Node) -> Node:
    """The page's own repetitions as repeated groups, innermost first."""
    for kid in node.kids:
        fold(kid)
    if len(node.kids) > 1:
        node.kids = narrow(repeats(node.kids))
    return node


def totals(node: Node, inside: bool = False) -> tuple[int, int]:
    """Characters of wanted text in a wrapper node: outside of links, and in links."""
    if node.label not in ("", GROUP) and unwanted(node.label, inside):
        return 0, 0
    plain, linked = node.chars - node.links, node.links
    for kid in node.kids:
        p, k = totals(kid, inside or declared(node.label))
        plain, linked = plain + p, linked + k
    return plain, linked


def main_paths(root: Node) -> list[list[str]]:
    """Paths of the wrapper's elements that hold the article.

    Elements that declare themselves are taken, the innermost that still hold half of what the outer one has. Without
    any, the way from the top goes on to the element with three fifths of the text outside links, as long as there is one."""
    found: list[tuple[int, list[str]]] = []

    def look(node: Node, path: list[str]) -> int:
        here = path if node.label in ("", GROUP) else [*path, node.label]
        if node.label not in ("", GROUP) and unwanted(node.label, False):
            return 0
        start = len(found)
        for kid in node.kids:
            look(kid, here)
        if declared(node.label):
            own, within = totals(node, True)[0], sum(n for n, _ in found[start:])
            if 2 * within < own or start == len(found):
                del found[start:]
                found.append((own, here))
        return 0

    look(root, [])
    found = [x for x in found if x[0]]
    if found:
        return [list(p) for p in dict.fromkeys(tuple(p) for _, p in found)]
    node, path = root, []
    while True:
        whole = totals(node)[0]
        step = max(node.kids, key=lambda k: totals(k)[0], default=None)
        if step is None or step.label.partition("|")[0] in ("p", "h1", "h2", "h3", "li", "pre", "blockquote") or 5 * totals(step)[0] < 3 * max(1, whole):
            return [path]
        node = step
        if node.label != GROUP:
            path = [*path, node.label]


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression over tags and text slots."""
    inner = ("#TEXT " if node.varies else "#CONST " if node.chars else "") + " ".join(map(expression, node.kids))
    body = inner.strip() if node.label in ("", GROUP) else f"<{node.label}>{inner.strip()}</>"
    mark = "*" if node.optional and node.repeated else "?" if node.optional else "+" if node.repeated else ""
    return f"({body}){mark}" if mark else body


def constants(root: Node, mains: list[list[str]]) -> list[list[str]]:
    """Paths of the boxes within the article whose slots are constant: the same text on all pages that have them, at least
    ``PAGES`` different ones. They belong to the template, whatever their names. None, if that were most of the article, as
    on hosts with versions of one article only; headings, paragraphs and lists directly in the article never."""
    found: dict[tuple[str, ...], list] = {}  # path: constant, characters
    tops = {tuple(m) for m in mains}
    text = 0

    def look(node: Node, path: tuple[str, ...], inside: bool) -> None:
        nonlocal text
        if node.label not in ("", GROUP):
            path = (*path, node.label)
            if inside and unwanted(node.label, True) or is_coarse(node.label):
                return
            if inside and node.label.partition("|")[0] in BOXES and node.seen:
                plain, linked = totals(node, True)
                state = found.setdefault(path, [True, 0])
                state[0] &= node.fixed and len(node.seen) >= PAGES and not declared(node.label)
                state[1] += plain + linked
        if path in tops and not inside:
            text += sum(totals(node, True))
            inside = True
        for kid in node.kids:
            look(kid, path, inside)

    look(root, (), False)
    same = {p for p, (constant, _) in found.items() if constant}
    outer = [p for p in same if not any(p[:k] in same for k in range(1, len(p)))]
    return [list(p) for p in sorted(outer)] if 2 * sum(found[p][1] for p in outer) < text else []


def below(path: tuple[str, ...], main: tuple[str, ...]) -> bool:
    """Whether a page's path leads through a wrapper's, whose labels may be coarse."""
    if len(path) < len(main):
        return False
    return all(x == y or is_coarse(y) and coarse(x) == y for x, y in zip(path, main))


def wanted(path: tuple[str, ...], mains: list[tuple[str, ...]], constant: frozenset[tuple[str, ...]] = frozenset()) -> bool:
    for main in mains:
        if below(path, main):
            if constant and any(path[:k] in constant for k in range(len(main) + 1, len(path) + 1)):
                return False
            return not any(unwanted(x, False) for x in main) and not any(unwanted(x, True) for x in path[len(main):])
    return False


def main_text(page: str, mains: list[tuple[str, ...]], constant: frozenset[tuple[str, ...]] = frozenset()) -> str:
    """The blocks below the main paths but for those in constant boxes, joined by line feeds; where a page has none of them, by
    its own wrapper."""
    root, blocks = read_page(page)
    seen: dict[tuple[str, ...], bool] = {}
    for path, _ in blocks:
        if path not in seen:
            seen[path] = wanted(path, mains, constant)
    if not any(seen.values()):
        own = [tuple(p) for p in main_paths(fold(root))]
        seen = {path: wanted(path, own) for path in seen}
    return "\n".join(text for path, text in blocks if seen[path])


def host_of(url: str):
    """The host of a URL; everything without one is one host."""
    host = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return host


def infer_wrappers(df: DataFrame, url: str = "url", page: str = "html", most_nodes: int = 200_000) -> DataFrame:
    """(host, wrapper, mains, constants, expression): the wrapper of every host, from all of its pages.

    Each task folds the pages it reads into wrappers of their hosts, so rows need no shuffle and a host with a
    third of all pages is no hot key: what moves is one wrapper for a host and task (earlier, when a task holds
    ``most_nodes`` elements). A wrapper has at most ``LARGE`` elements, whatever class names pages make up. Wrappers are merged like pages, in two steps, the first with the host's
    wrappers dealt to 32 groups. NULL pages are empty, rows with a NULL URL or one without host are one host.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "page", 4 << 20):
                for host, text in zip(part.column("host").to_pylist(), part.column("page").to_pylist()):
                    node = fold(read_page(text)[0])
                    sizes[host] = sizes.get(host, 0) + node.size()
                    known[host] = merge(known[host], node) if host in known else node
                    if sizes[host] > 2 * LARGE:
                        shrink(known[host])
                        sizes[host] = known[host].size()
                if sum(sizes.values()) > most_nodes:
                    yield packed((h, shrink(n)) for h, n in known.items())
                    known, sizes = {}, {}
        yield packed((h, shrink(n)) for h, n in known.items())

    def packed(items) -> pa.RecordBatch:
        rows = [{"host": h, "wrapper": json.dumps(n.pack(), ensure_ascii=False)} for h, n in items]
        return pa.RecordBatch.from_pylist(rows, pa.schema([("host", pa.string()), ("wrapper", pa.string())]))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, node = None, None
        for batch in batches:
            done = []
            for host, raw in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
                new = Node.unpack(json.loads(raw))
                if node is not None and host == here:
                    node = shrink(merge(node, new))
                else:
                    if node is not None:
                        done.append((here, node))
                    here, node = host, new
            yield packed(done)
        if node is not None:
            yield packed([(here, node)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "wrapper", "mains", "constants", "expression"]
        for batch in combine(batches):
            rows = []
            for host, raw in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
                node = Node.unpack(json.loads(raw))
                mains = main_paths(node)
                lists = [json.dumps(x, ensure_ascii=False) for x in (mains, constants(node, mains))]
                rows.append(dict(zip(names, (host, raw, *lists, expression(node)))))
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.string()) for n in names]))

    pages = df.select(host_of(url).alias("host"), F.coalesce(page, F.lit("")).alias("page"))
    schema = "host string, wrapper string"
    first = pages.mapInArrow(learn, schema).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(32)))
    dealt = first.repartition("host", "salt").sortWithinPartitions("host", "salt").drop("salt").mapInArrow(combine, schema)
    last = dealt.repartition("host").sortWithinPartitions("host")
    return written(last.mapInArrow(finish, schema + ", mains string, constants string, expression string"), "wrappers")


def extract_text(df: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the article of each page, by the wrapper of its host.

    Wrappers come from all pages (``infer_wrappers``); each host's main paths and constant boxes, short strings, are joined to its
    pages, a join whose hot keys AQE splits. Whole pages are read, nothing is cut off. NULL or empty pages, and
    pages without article text, give an empty text. Repeated rows are repeated. An empty table gives no rows.
    """
    mains = infer_wrappers(df, url, page).select(F.col("host").alias("__fw_h"), "mains", "constants")
    rows = df.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(page, F.lit("")).alias("page"), host_of(url).alias("host")
    )
    rows = rows.join(mains, F.col("host") == F.col("__fw_h"), "left").select("page_id", "url", "page", "mains", "constants")
    kind = df.schema[page_id].dataType.simpleString()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[tuple[str | None, str | None], tuple] = {}
        for batch in batches:
            for part in slices(batch, "page", 4 << 20):
                out = []
                columns = [part.column(c).to_pylist() for c in ("page", "mains", "constants")]
                for text, *raw in zip(*columns):
                    plan = plans.get(tuple(raw))
                    if plan is None:
                        if len(plans) > 1_000:
                            plans.clear()
                        mains, constant = ([tuple(p) for p in json.loads(x or "[]")] for x in raw)
                        plan = plans[tuple(raw)] = mains, frozenset(constant)
                    out.append(main_text(text, *plan))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars bigint")
