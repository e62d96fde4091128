"""HTML extraction by wrapper induction.

Every page is parsed once into a tree of structural elements; like siblings
are folded into one repeated node, so trees stay small whatever the page's
length.  Per host, the commonest tree is the reference, to which all other
layouts add what it lacks.  Each page's tree is aligned with it by simple tree
matching, and for each reference node, and each path of tags, the pages vote
with a hash of every text directly there (a run of paragraphs, headings or the
like is one text): a text that most of the pages with text there have is
*template*, any other fills a *slot*.  Equal pages of a host have one vote.  Votes are counted by Spark with partial aggregation, so a host
with a third of all pages is no special case; alignments are remembered by tree
pair.

A page's content is what its slots hold.  The region is the page's article or
main element where it has one, else the whole page, of which every slot is
content.  Outside the region nothing is content.  Inside, boxes that announce
themselves as boilerplate (by element, role or class) are left out, and so is
template of any element and at any depth where there are slots beside it; where
there are none, all texts stay, since copies of an article are still articles.

Defined results: null and empty pages give an empty text; a page alone on its
host, or on a host where all pages are equal, is judged by its elements alone;
a null url is a host of its own (''); repeated rows are extracted alike; very
long pages are read whole; empty tables give empty tables; other columns are
not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import discard, lower_ascii, per_batch, recorded, ship, stage

CONSTANT = 0.5             # a node is template if one text has more than this share of its pages
MIN_PAGES = 3              # and at least so many pages have that text

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S | re.X)
REST = re.compile(r"<!--.*|<!\[CDATA\[(?P<cdata>.*)|<[!?].*|(?P<end>(?!))(?P<tag>(?!))(?P<attrs>(?!))", re.S)    # after the last ``>``
ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BAND = 64                  # siblings further apart than this, by relative place, are not matched
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol optgroup option p pre section select summary table
    tbody td tfoot th thead tr ul svg button label object audio video canvas map""".split())
#: An opening element ends these, up to the scope elements.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}}
P_ENDS = BLOCK - {"button", "label", "object", "audio", "video", "canvas", "map", "svg", "option", "optgroup", "html", "head", "body"}
P_ONLY = frozenset({"p"})
BARRIERS = frozenset("article main body table td th li".split())      # an inline end tag closes nothing beyond them
SCOPE = frozenset("ul ol dl table select article section div main body html aside nav td th".split())
DROPPED = frozenset("head nav aside footer form button select textarea fieldset svg object audio video canvas dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu
    breadcrumb breadcrumbs sidebar footer cookie cookies consent notice gdpr popup modal newsletter subscribe subscription
    share sharing social related recommended recommendations comment comments disqus replies widget toolbar pagination pager
    login signup""".split())
COMMENTS = frozenset("comment comments disqus replies".split())
#: A class or id of several words names its box by the last; these may follow a word of WORDS, and those make it a state of the box.
HOLDERS = frozenset("""area bar block box button buttons container content form inner item items link links list message panel section
    slot unit icon icons group row column col title x widget wrap wrapper zone posts articles stories top bottom left right main site page header body primary secondary""".split())
STATES = frozenset("has have no not with without hide show".split())
REGION = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption caption article main body html".split())
ODD = re.compile(r"[^\w:-]")        # in a tag: would be read as one of the marks of a label, or of a tree's text
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("label", "children", "ids", "shape")

    def __init__(self, label: str):
        self.label, self.children, self.ids, self.shape = label, [], [], 0


def _names(value: str, of: frozenset) -> bool:
    """Whether a class or id of ``value`` as a whole names one of ``of``: 'sidebar', 'main-sidebar', 'ad-box', not 'has-sidebar'."""
    for name in value.split():
        parts = [w.lower() for w in CAMEL.findall(name) if not w.isdigit()]
        if not parts or not STATES.isdisjoint(parts):
            continue
        if parts[-1] in of or (parts[-1] in HOLDERS and any(w in of for w in parts) and all(w in of or w in HOLDERS for w in parts)):
            return True
    return False


def _label(tag: str, attrs: str) -> str:
    """Tag, ``!`` if the element is boilerplate or ``~`` if a class or id says so, then its class and id words."""
    words, role, named, comments = set(), "", False, False
    if attrs and "=" in attrs:
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                here = {w.lower() for w in CAMEL.findall(value) if not w.isdigit()}
                words |= here
                if not here.isdisjoint(WORDS):
                    named = named or _names(value, WORDS)
                    comments = comments or _names(value, COMMENTS)
            elif name == "role":
                role = value.strip().lower()
    if role == "main":
        tag = "main"
    bad = tag in DROPPED or role in ROLES or (comments and tag not in ("main", "body", "html"))
    soft = named and tag not in ("article", "main", "body", "html")
    return ODD.sub("-", tag) + ("!" if bad else "~" if soft else "") + "".join("." + w for w in sorted(words))


def _tag(label: str) -> str:
    return label.split(".")[0].rstrip("!~")


class _Open:
    """The open elements, with the places of each tag, so that none is searched for through the others."""

    def __init__(self, root: Node):
        self.tags: list[str] = []
        self.nodes: list[Node | None] = []                        # inline elements have no node
        self.boxes: list[Node] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.push("html", root)

    def push(self, tag: str, node: Node | None = None) -> None:
        self.places[tag].append(len(self.tags))
        self.tags.append(tag)
        self.nodes.append(node)
        if node is not None:
            if self.boxes:
                self.boxes[-1].children.append(node)
            self.boxes.append(node)

    def cut(self, i: int) -> None:
        while len(self.tags) > i:
            self.places[self.tags.pop()].pop()
            if self.nodes.pop() is not None:
                self.boxes.pop()

    def last(self, tags) -> int:
        """Place of the innermost of ``tags``; 0 (the root) if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def parse(page: str) -> tuple[Node, list[str]]:
    """The tree of block elements and, by number, the texts directly inside them (``ids`` of the nodes)."""
    root = Node("html")
    open_ = _Open(root)
    blocks: list[str] = []
    pending: list[str] = []
    running = False                                              # the open block has text since it was last flushed
    last_end = page.rfind(">")                                   # beyond it there are only comments and text

    def say(text: str):
        nonlocal running
        pending.append(text)
        running = running or not text.isspace()

    def flush():
        nonlocal running
        text = " ".join("".join(pending).split())
        pending.clear()
        running = False
        if text:
            open_.boxes[-1].ids.append(len(blocks))
            blocks.append(text)

    def close(i: int):
        if any(n is not None or t in BLOCK for t, n in zip(open_.tags[i:], open_.nodes[i:])):
            flush()
        open_.cut(i)

    at = 0
    while m := (TOKEN if at <= last_end else REST).search(page, at):
        if m.start() > at:
            say(html.unescape(page[at: m.start()]))
        at = m.end()
        if m["cdata"]:
            say(m["cdata"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            i = open_.last((tag,))
            barrier = BARRIERS if tag not in BLOCK else SCOPE if tag == "p" else ()
            if i and i >= open_.last(barrier):
                close(i)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            pending.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body"):
            flush()
            if tag == "body" and not open_.places.get("body"):
                open_.cut(1)
                open_.push(tag, Node("body"))
            continue
        ends = CLOSES.get(tag) or (P_ONLY if tag in P_ENDS else None)
        if ends and (i := open_.last(ends)) and i > open_.last(SCOPE - ends):
            close(i)
        if tag in BLOCK:
            flush()
            open_.push(tag, Node(_label(tag, m["attrs"])))
        else:
            label = _label(tag, m["attrs"])
            # an inline box that announces itself; within running text a class makes no box
            if "!" in label or ("~" in label and not running):
                flush()
                open_.push(tag, Node(label))
            else:
                open_.push(tag)
    if at < len(page):
        pending.append(html.unescape(page[at:]))
    flush()
    return root, blocks


def _merge(into: Node, n: Node) -> None:
    """Adds the texts of ``n``'s tree to a tree of the same shape."""
    todo = [(into, n)]
    while todo:
        a, b = todo.pop()
        a.ids += b.ids
        todo += zip(a.children, b.children)


def _fold_textual(nodes: list[Node]) -> list[Node]:
    out: list[Node] = []
    run: dict[str, Node] = {}                                    # of the textual elements just before
    for n in nodes:
        if n.label.split(".")[0] in TEXTUAL and n.label.split(".")[0] not in REGION:
            if n.label in run:
                run[n.label].ids += n.ids
                run[n.label].children += n.children
            else:
                out.append(n)
                run[n.label] = n
        else:
            run = {}
            out.append(n)
    return out


def _fold_like(nodes: list[Node]) -> list[Node]:
    out: list[Node] = []
    k = 0
    while k < len(nodes):
        n = nodes[k]
        out.append(n)
        k += 1
        if n.label.split(".")[0] in TEXTUAL and n.label.split(".")[0] not in REGION:
            continue
        like = k
        while like < len(nodes) and nodes[like].shape == n.shape:
            like += 1
        if like - k:
            for m in nodes[k:like]:
                _merge(n, m)
            k = like
    return out


def fold(nodes: list[Node], runs: dict[int, int]) -> list[Node]:
    """Like siblings become one node: paragraphs, headings, cells and the like within a run of such,
    other neighbours if their whole trees are alike.  ``runs`` gets the
    run of each block, by its first: what the page has there as one text, before boxes are folded."""
    top = Node("")
    top.children = nodes
    order = [top]
    for n in order:                                              # from the top down, as it grows
        n.children = _fold_textual(n.children)
        order += n.children
        runs.update((i, n.ids[0]) for i in n.ids)
    for n in reversed(order):
        n.children = _fold_like(n.children)
        n.shape = hash((n.label, *[c.shape for c in n.children]))
    return top.children


def flatten(root: Node) -> tuple[str, list[Node]]:
    """The tree as text, ``label(child child)``, and its nodes in that order."""
    nodes: list[Node] = []
    parts: list[str] = []
    todo: list[Node | str] = [root]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            parts.append(n)
            continue
        nodes.append(n)
        parts.append(n.label)
        if n.children:
            parts.append("(")
            todo.append(")")
            for c in reversed(n.children):
                todo += (c, " ")
            todo.pop()
    return "".join(parts), nodes


def read_tree(shape: str) -> list[tuple[str, list[int], int]]:
    """Nodes of ``flatten``'s text: label, children's numbers, parent's number."""
    nodes: list[tuple[str, list[int], int]] = []
    stack = [-1]
    for part in re.findall(r"[^()\s]+|[()]", shape):
        if part == "(":
            stack.append(len(nodes) - 1)
        elif part == ")":
            stack.pop()
        else:
            if stack[-1] >= 0:
                nodes[stack[-1]][1].append(len(nodes))
            nodes.append((part, [], stack[-1]))
    return nodes


def _interned(trees_: list[list[tuple[str, list[int], int]]]) -> list[tuple[list[int], list[int]]]:
    """For each tree, by node: a number that equal subtrees share (children's are smaller), and the subtree's size."""
    numbers: dict = {}
    out = []
    for nodes in trees_:
        number, size = [0] * len(nodes), [1] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):
            label, children, _ = nodes[k]
            number[k] = numbers.setdefault((label, *[number[c] for c in children]), len(numbers))
            size[k] += sum(size[c] for c in children)
        out.append((number, size))
    return out


def _ends(a: list[int], b: list[int]) -> tuple[int, int]:
    """How many children two lists share at their starts, and then at their ends."""
    most = min(len(a), len(b))
    first = next((k for k in range(most) if a[k] != b[k]), most)
    last = next((k for k in range(most - first) if a[-1 - k] != b[-1 - k]), most - first)
    return first, last


def _table(a: list[int], b: list[int], score) -> list[tuple[int, list[int]]]:
    """Rows (first column, most matched pairs) of an order-keeping matching of two lists, near the diagonal."""
    reach = BAND + len(b) // len(a)
    rows = [(0, [0] * (min(len(b), reach) + 1))]
    for k, x in enumerate(a, 1):
        low, high = max(0, k * len(b) // len(a) - reach), min(len(b), k * len(b) // len(a) + reach)
        before, old = rows[-1]
        row: list[int] = []
        for y in range(low, high + 1):
            best = row[-1] if row else -1
            at = y - before
            if 0 <= at < len(old):
                best = max(best, old[at])
            if 0 < at <= len(old) and y:
                best = max(best, old[at - 1] + score(x, b[y - 1]))
            row.append(max(best, 0))
        rows.append((low, row))
    return rows


def align(reference: str, shape: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of ``shape`` the node of ``reference`` it is matched with, or -1.

    Equal subtrees are matched whole; so are the equal children at either end of
    two lists of children, which loses no pair.  Between them, children are matched within
    ``BAND`` places of their relative place.  Equal pairs of subtrees are solved once.
    """
    a, b = read_tree(reference), read_tree(shape)
    if reference == shape:
        return tuple(range(len(b)))
    (na, sa), (nb, sb) = _interned([a, b])
    node_a = {n: k for k, n in reversed(list(enumerate(na)))}
    node_b = {n: k for k, n in reversed(list(enumerate(nb)))}
    kids = lambda nodes, number, k: [number[c] for c in nodes[k][1]]
    middles: dict[tuple[int, int], tuple[int, list[int], list[int]]] = {}
    todo = [(na[0], nb[0])] if a[0][0] == b[0][0] and na[0] != nb[0] else []
    while todo:                                                 # distinct pairs of unequal subtrees that a matching can reach
        u, v = todo.pop()
        if (u, v) in middles:
            continue
        x, y = kids(a, na, node_a[u]), kids(b, nb, node_b[v])
        first, last = _ends(x, y)
        x, y = x[first: len(x) - last], y[first: len(y) - last]
        middles[u, v] = first, x, y
        if x and y:
            reach, met = BAND + len(y) // len(x), set()
            for k, p in enumerate(x):
                at = k * len(y) // len(x)
                met.update((p, q) for q in y[max(0, at - reach - 1): at + reach + 1])
            todo += [(p, q) for p, q in met if p != q and a[node_a[p]][0] == b[node_b[q]][0]]
    size: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[tuple[int, list[int]]]] = {}

    def score(p: int, q: int) -> int:
        return sa[node_a[p]] if p == q else size.get((p, q), 0)
    for u, v in sorted(middles):                                # subtrees have smaller numbers
        first, x, y = middles[u, v]
        ka = kids(a, na, node_a[u])
        whole = sum(sa[node_a[n]] for n in ka[:first] + ka[first + len(x):])
        tables[u, v] = _table(x, y, score) if x and y else []
        size[u, v] = 1 + whole + (tables[u, v][-1][1][-1] if tables[u, v] else 0)

    out = [-1] * len(b)
    todo = [(0, 0)] if a[0][0] == b[0][0] else []
    while todo:
        i, j = todo.pop()
        if na[i] == nb[j]:
            out[j: j + sb[j]] = range(i, i + sa[i])
            continue
        out[j] = i
        ca, cb = a[i][1], b[j][1]
        first, x, y = middles[na[i], nb[j]]
        todo += zip(ca[:first], cb[:first])
        todo += zip(ca[first + len(x):], cb[first + len(y):])
        rows = tables[na[i], nb[j]]
        p, q = len(x), len(y)
        while p and q and rows:
            low, row = rows[p]
            before, old = rows[p - 1]
            value = row[q - low]
            if 0 <= q - before < len(old) and old[q - before] == value:
                p -= 1
            elif q > low and row[q - 1 - low] == value:
                q -= 1
            else:
                p, q = p - 1, q - 1
                if x[p] == y[q] or (x[p], y[q]) in size:
                    todo.append((ca[first + p], cb[first + q]))
                if not 0 <= q - before < len(old):
                    break
    return tuple(out)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def addresses(seen: dict, reference: str, shape: str) -> list[tuple[int, int]]:
    """Two addresses of each node of ``shape``, through a bounded memo: its node in the host's merged reference, and its path of tags.

    The merged reference holds the commonest tree and, below its nodes, whatever other layouts add: a node
    not matched has the address of its parent and its label.  The path of tags is for boxes whose class names differ by page.
    """
    if (reference, shape) not in seen:
        if len(seen) >= 4096:
            seen.clear()
        out: list[tuple[int, int]] = []
        for i, (label, _, up) in zip(align(reference, shape), read_tree(shape)):
            merged, path = out[up] if up >= 0 else (0, 0)
            out.append((_hash(f"node {i}" if i >= 0 else f"{merged} {label}"), _hash(f"path {path} {_tag(label)}")))
        seen[reference, shape] = out
    return seen[reference, shape]


def text_at(address: int, text: int) -> int:
    """The number of a text (its hash) at an address."""
    return (address * 0x9E3779B97F4A7C15 + text) & ((1 << 63) - 1)


def content(shape: str, owner: list[int], blocks: list[str], constant: list[bool]) -> str:
    """The content of a page: its tree, the node of each block, the blocks, whether each is template."""
    nodes = read_tree(shape)
    bad = [False] * len(nodes)
    for k, (label, _, up) in enumerate(nodes):
        bad[k] = "!" in label or (up >= 0 and bad[up])

    def weights(inside: list[bool]) -> list[int]:
        """Text in slots (in all, if there are none) at or below each node."""
        of = [(n, len(t), fixed) for n, t, fixed in zip(owner, blocks, constant) if inside[n] and not bad[n]]
        weight = [0] * len(nodes)
        for n, size, _ in [x for x in of if not x[2]] or of:
            weight[n] += size
        for k in range(len(nodes) - 1, 0, -1):
            weight[nodes[k][2]] += weight[k]
        return weight

    def named(inside: list[bool], holds: list[bool]) -> list[bool]:
        """What class words make boilerplate: not what ``holds`` the article, or most of the text."""
        weight, out = weights(inside), [False] * len(nodes)
        for k, (label, _, up) in enumerate(nodes):
            out[k] = up >= 0 and out[up] or "~" in label and not holds[k] and weight[k] <= 0.5 * weight[0]
        return out

    def within(tag: str, out: list[bool]) -> list[bool]:
        region = [False] * len(nodes)
        for k, (label, _, up) in enumerate(nodes):
            region[k] = not bad[k] and not out[k] and (label.split(".")[0] == tag or (up >= 0 and region[up]))
        return region

    everything, nothing = [True] * len(nodes), [False] * len(nodes)
    soft = named(everything, nothing)
    rest = sum(len(t) for n, t, fixed in zip(owner, blocks, constant) if not bad[n] and not soft[n] and not fixed)
    for tag, out in [(tag, out) for out in (soft, nothing) for tag in REGION]:
        region = within(tag, out)                               # articles in named boxes only hold the page if they have its text
        size = sum(len(t) for n, t in zip(owner, blocks) if region[n])
        if size and (out is soft or size > rest):
            break
    else:
        region = nothing
    else_main = within("main", nothing)
    tops = [k for k in range(len(nodes)) if region[k] and not (nodes[k][2] >= 0 and region[nodes[k][2]])]
    if len(tops) == 1 and else_main[tops[0]]:                    # the main element around the only article is the page's content
        region = else_main
    beside = {nodes[k][2] for k in tops}
    for k, (label, _, up) in enumerate(nodes):                   # a heading beside an article is the article's
        if not bad[k] and up >= 0 and (_tag(label) in HEADINGS and "~" not in label and up in beside or region[up]):
            region[k] = True
    holds = [False] * len(nodes)
    for k in range(len(nodes) - 1, -1, -1):
        holds[k] = holds[k] or (region[k] and not (k and region[nodes[k][2]]))
        if holds[k] and nodes[k][2] >= 0:
            holds[nodes[k][2]] = True
    marked = any(region)
    if not marked:
        header = [False] * len(nodes)
        for k, (label, _, up) in enumerate(nodes):
            header[k] = _tag(label) == "header" or (up >= 0 and header[up])
            bad[k] = bad[k] or header[k]
        region = [True] * len(nodes)
    soft = named(region, holds)
    bad = [b or s for b, s in zip(bad, soft)]
    kept = [(t, fixed) for n, t, fixed in zip(owner, blocks, constant) if region[n] and not bad[n]]
    slots = any(not fixed for _, fixed in kept)
    return " ".join(t for t, fixed in kept if not (slots and fixed))


def parse_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """id, url, host, shape (the folded tree), page (a hash of all), hashes (of each block's run), owner (node of each block), blocks."""
    def parsed(page: str | None) -> tuple:
        root, blocks = parse(page or "")
        runs: dict[int, int] = {}
        root.children = fold(root.children, runs)
        shape, nodes = flatten(root)
        owner = [0] * len(blocks)
        for k, n in enumerate(nodes):
            for i in n.ids:
                owner[i] = k
        run: dict[int, list[str]] = defaultdict(list)
        for i, t in enumerate(blocks):
            run[runs.get(i, -1)].append(t)
        whole = {k: _hash("\n".join(ts)) for k, ts in run.items()}
        hashes = [whole[runs.get(i, -1)] for i in range(len(blocks))]
        return shape, _hash(f"{shape} {owner} {hashes}"), hashes, owner, blocks

    types = {"shape": pa.string(), "page": pa.int64(), "hashes": pa.list_(pa.int64()), "owner": pa.list_(pa.int32()),
             "blocks": pa.list_(pa.string())}

    def make():
        return lambda b: dict(zip(types, zip(*map(parsed, b.column("html").to_pylist())))) if len(b) else dict.fromkeys(types, [])
    host = lower_ascii(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), "://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    return per_batch(rows, ["id", "url", "host"], "shape string, page long, hashes array<long>, owner array<int>, blocks array<string>",
                     types, make)


def induce(parsed: DataFrame, constant: float = CONSTANT, min_pages: int = MIN_PAGES) -> DataFrame:
    """One wrapper per host: host, reference (its commonest tree), template (numbers of its constant texts at their addresses)."""
    ship()
    distinct = parsed.select("host", "page", "shape", "hashes", "owner").dropDuplicates(["host", "page"])    # copies have one vote
    shapes = parsed.groupBy("host", "shape").agg(F.count("*").alias("n"))
    references = stage(shapes.groupBy("host").agg(F.max(F.struct("n", "shape")).alias("m"))
                       .select("host", F.col("m.shape").alias("reference")), "wrapper-references")

    def vote(batches):
        seen: dict = {}
        for pdf in batches:
            hosts, at, texts = [], [], []
            for host, reference, shape, hashes, owner in zip(pdf["host"], pdf["reference"], pdf["shape"], pdf["hashes"], pdf["owner"]):
                nodes = addresses(seen, reference, shape)
                votes = {(a, -1) for n in set(owner) for a in nodes[n]}              # the page has text there
                votes |= {(a, text_at(a, h)) for n, h in zip(owner, hashes.tolist()) for a in nodes[n]}
                hosts += [host] * len(votes)
                at += [a for a, _ in votes]
                texts += [t for _, t in votes]
            yield pd.DataFrame({"host": hosts, "at": at, "text": texts})

    votes = (distinct.join(references, "host").mapInPandas(vote, "host string, at long, text long")
             .groupBy("host", "at", "text").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages))
    votes = stage(votes, "wrapper-votes")
    pages = votes.filter("text < 0").select("host", "at", F.col("n").alias("all"))
    template = (votes.filter("text >= 0").join(pages, ["host", "at"]).filter(F.col("n") > constant * F.col("all"))
                .groupBy("host").agg(F.collect_list("text").alias("template")))        # as many as its layouts have constant texts
    return references.join(template, "host", "left")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (the main content) and n_blocks of every page."""
    parsed = stage(parse_pages(pages, id_col, url_col, html_col), "wrapper-pages")
    with recorded() as used:
        induced = induce(parsed)
    wrappers = stage(induced, "wrappers")
    discard(pages.sparkSession, used)

    def make():
        seen: dict = {}
        fixed: dict = {}                                        # template by host

        def main_text(host, shape, reference, template, hashes, owner, blocks) -> str:
            if host not in fixed:
                if len(fixed) >= 256:
                    fixed.clear()
                fixed[host] = frozenset(template or ())
            constant = [False] * len(blocks)
            if fixed[host]:
                nodes = addresses(seen, reference, shape)
                constant = [any(text_at(a, h) in fixed[host] for a in nodes[n]) for n, h in zip(owner, hashes)]
            return content(shape, owner, blocks, constant)

        def judge(b):
            names = "host", "shape", "reference", "template", "hashes", "owner", "blocks"
            rows = zip(*(b.column(n).to_pylist() for n in names))
            return {"text": [main_text(*r) for r in rows], "n_blocks": [len(x) for x in b.column("blocks").to_pylist()]}
        return judge
    rows = parsed.select("id", "url", "host", "shape", "hashes", "owner", "blocks").join(wrappers, "host")
    return per_batch(rows, ["id", "url"], "text string, n_blocks long", {"text": pa.string(), "n_blocks": pa.int64()}, make)
