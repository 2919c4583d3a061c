"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tokens: block tags, nested as they stand, and text runs.
The wrapper of a host starts as one page's stream and is aligned with the others
in turn. Where streams differ the mismatch is resolved in one of three ways: text
against text becomes a slot; a tag that stands again right after itself (alone or
as a group of up to four) becomes a repeated item; any other tag becomes an
optional item. Alternatives (unions) are never formed. Two wrappers are aligned in
the same way, so a host's distinct pages are dealt over the tasks by their content,
folded to one wrapper per host and task, and wrappers are folded afterwards: a hot
host is no hot group, and copies of a page count once.

From a wrapper follows its rule: the path to the item that holds the varying text
(an article, a main item, or where most slot text outside menus and links stands)
and the fixed texts that stand at one place in it on nearly all pages. The rule is then applied to
every page. A page that does not match its host's rule is judged by its own stream.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.storage import written

# Rules a task keeps, and page wrappers it hands on at once.
HELD_HOSTS, HELD_PAGES = 500, 500
# Rules up to this many characters in all are broadcast; beyond it they are joined.
BROADCAST_CHARS = 8_000_000
# A text counts as fixed when so many distinct pages of a host agree, and this share of them.
FIXED_PAGES, FIXED_SHARE = 3, 0.9
SALTS = 64

# Roles of tags and of words in class, id and role attributes.
BLOCKS = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre section article main "
    "header footer nav aside form fieldset figure figcaption address details summary hr center dir menu dialog hgroup search".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math canvas object audio video select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button label search dir fieldset".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd figcaption caption".split())
MAIN_WORDS = frozenset("article main content post entry story articlebody blogposting newsarticle".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert "
    "comment comments disqus reply replies respond responses nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar sidebar sidebars "
    "widget widgets related recommended recommendations share sharing social newsletter subscribe subscription signup login popup modal overlay pagination pager "
    "toolbar skip contentinfo complementary search dialog".split()
)
NEGATIONS = frozenset("no has with without".split())
# A start tag of the second kind ends open elements of the first, up to the nearest of the third.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>?)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """A block element: label (tag and words of its class, id, role), children, kind."""

    __slots__ = ("tag", "label", "kids", "kind")

    def __init__(self, tag: str, label: str, kind: str):
        self.tag, self.label, self.kind, self.kids = tag, label, kind, []


def _describe(tag: str, rest: str) -> tuple[str, str]:
    """(label, kind): kind is main, boilerplate, hidden or empty."""
    kind = "boilerplate" if tag in BOILERPLATE_TAGS else "main" if tag in ("article", "main") else ""
    if "=" not in rest and "hidden" not in rest:
        return tag, kind
    words, hidden = [], False
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            hidden = True
        elif name not in ("style", "aria-hidden"):
            words += [w.lower() for w in _WORDS.findall(value)]
    label = ".".join([tag, *words[:8]])
    if hidden:
        return label, "hidden"
    said = set(words)
    if said & BOILERPLATE_WORDS and not said & NEGATIONS and tag not in ("article", "main", "body", "html"):
        return label, "boilerplate"
    if said & {"comment", "comments"} and tag == "article":
        return label, "boilerplate"
    if not kind and said & MAIN_WORDS and tag in ("div", "section", "td"):
        kind = "part"
    return label, kind


def parse(page: str) -> Node:
    """Block tree of a page. Text runs are (text, characters inside links); script, style and the like are gone."""
    root = Node("#root", "#root", "")
    stack, text, links = [root], [], 0
    inline: list[str] = []

    def flush():
        nonlocal links
        if text:
            run = " ".join("".join(text).split())
            if run:
                stack[-1].kids.append((run, min(links, len(run))))
            text.clear()
            links = 0

    def close(depth: int):
        flush()
        del stack[depth:]
        inline.clear()

    def say(piece: str):
        nonlocal links
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if "a" in inline:
                links += len(piece)

    at, size = 0, len(page)
    search = _MARKUP.search
    while at < size:
        m = search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag, end, rest = tag.lower(), m.group(1), m.group(3)
        if tag in RAW:
            if not end and not rest.rstrip(">").endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else size
            continue
        if tag in BLOCKS or tag in BOILERPLATE_TAGS:
            if end:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                else:
                    flush()
                continue
            flush()
            inline.clear()
            if tag in BLOCKS:  # an open paragraph ends at any block
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
                    if stack[i].tag in ("td", "th", "table", "div", "section", "article", "li"):
                        break
            if tag in ENDS:
                over, bound = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in bound:
                        break
                    if stack[i].tag in over:
                        del stack[i:]
                        if tag != "tr":
                            break
            if tag in VOID:
                continue
            label, kind = _describe(tag, rest)
            node = Node(tag, label, kind)
            stack[-1].kids.append(node)
            stack.append(node)
        elif tag == "br":
            text.append(" ")
        elif tag in VOID:
            continue
        elif end:
            if tag in inline:
                inline.remove(tag)
        elif not rest.rstrip(">").endswith("/"):
            inline.append(tag)
    flush()
    return root


# A wrapper item is a list: [label, flags, pages, body]. flags: 1 optional, 2 repeated.
# body of "#": [digest of the fixed text or None for a slot, characters, characters in links];
# of "+" (a repeated group) and of elements: the list of items inside.


def _run(step):
    """Result of a generator that yields generators whose results it needs: recursion of any depth on a list."""
    stack, value = [step], None
    while stack:
        try:
            call = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(call)
            value = None
    return value


def lift(node: Node) -> list:
    return _run(_lift(node))


def _lift(node: Node):
    items = []
    for kid in node.kids:
        if isinstance(kid, tuple):
            items.append(["#", 0, 1, [digest(kid[0]), len(kid[0]), kid[1]]])
        elif kid.kind != "hidden":
            items.append((yield _lift(kid)))
    return [_keyed(node), 0, 1, (yield _fold(items))]


def _preorder(item: list) -> list:
    """(item, parent's index) of an item and all items inside, an item before those inside it, these in order."""
    out, todo = [], [(item, -1)]
    while todo:
        x, parent = todo.pop()
        out.append((x, parent))
        if x[0] != "#":
            at = len(out) - 1
            todo += [(y, at) for y in reversed(x[3])]
    return out


def to_json(item: list) -> str:
    """A wrapper as a flat list: label, flags, pages and text body, or number of items inside, of all items in preorder."""
    return json.dumps([v for x, _ in _preorder(item) for v in (x[0], x[1], x[2], x[3] if x[0] == "#" else len(x[3]))])


def from_json(text: str) -> list:
    flat, top = json.loads(text), []
    open_items = [(top, 1)]
    for i in range(0, len(flat), 4):
        while len(open_items[-1][0]) == open_items[-1][1]:
            open_items.pop()
        label, flags, pages, body = flat[i : i + 4]
        item = [label, flags, pages, body if label == "#" else []]
        open_items[-1][0].append(item)
        if label != "#":
            open_items.append((item[3], body))
    return top[0]


def _keyed(node: Node) -> str:
    return f"{node.label} {node.kind}"


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _shape(item: list):
    return ("+", *map(_shape, item[3])) if item[0] == "+" else item[0]


def _fold(items: list):
    """Repeats of one item, then of groups of two to four items, become repeated items."""
    for period in range(1, 5):
        i = 0
        while i + 2 * period <= len(items):
            head = items[i : i + period]
            names = [_shape(x) for x in head]
            j, body = i + period, head
            while [_shape(x) for x in items[j : j + period]] == names:
                more = []
                for a, b in zip(body, items[j : j + period], strict=True):
                    more.append((yield _same(a, b)))
                body = more
                j += period
            if j == i + period:
                i += 1
                continue
            if period == 1:
                merged = body[0]
                merged[1] |= 2 if merged[0] != "#" else 0
                items[i:j] = [merged]
            else:
                items[i:j] = [["+", 2, max(x[2] for x in body), body]]
            i += 1
    return items


def _same(a: list, b: list):
    """Two occurrences in one page: text becomes a slot unless equal; pages are not added."""
    out = yield _align(a, b)
    out[2] = max(a[2], b[2])
    return out


def align(a: list, b: list) -> list:
    return _run(_align(a, b))


def _align(a: list, b: list):
    """The item that covers both: slots, optional and repeated items where they differ."""
    flags, pages = a[1] | b[1], a[2] + b[2]
    if a[0] == "#":
        (x, n, links), (y, m, more) = a[3], b[3]
        return ["#", flags, pages, [x if x == y else None, n + m, links + more]]
    return [a[0], flags, pages, (yield _align_lists(a[3], b[3]))]


def _align_lists(a: list, b: list):
    x, y = [_shape(i) for i in a], [_shape(i) for i in b]
    if x == y:
        out = []
        for i, j in zip(a, b, strict=True):
            out.append((yield _align(i, j)))
        return out
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if x[i] == y[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append((yield _align(a[i], b[j])))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], a[i][1] | 1, *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], b[j][1] | 1, *b[j][2:]])
            j += 1
    return (yield _fold(out))


def _kind(item: list) -> str:
    return item[0].rpartition(" ")[2] if " " in item[0] else ""


def _tag(item: list) -> str:
    return item[0].partition(" ")[0].partition(".")[0]


def _left_out(item: list, holds_main: bool) -> bool:
    kind = _kind(item)
    if kind == "hidden":
        return True
    if _tag(item) == "header" or "header" in item[0].partition(" ")[0].split(".")[1:]:
        return not holds_main
    return kind == "boilerplate" and not holds_main


def _is_fixed(item: list, pages: int) -> bool:
    """Whether a text item is the same text on nearly all of the pages of its host."""
    return item[3][0] is not None and item[2] >= max(FIXED_PAGES, FIXED_SHARE * pages)


def _place(place: str, label: str) -> str:
    """The place of an item of this label below a place; the main item's is empty."""
    return digest(f"{place} {label}")


def rule(wrapper: list) -> dict:
    """{"path": labels from the root to the main item, "fixed": places in it and digests of texts to leave out}."""
    pages, items = wrapper[2], _preorder(wrapper)
    # Of each item, from the innermost out: whether a main item is inside, whether it is left out, and its
    # weight: varying text outside links; text that nearly every page repeats counts little.
    holds, out, weight = [False] * len(items), [False] * len(items), [0.0] * len(items)
    for at in range(len(items) - 1, -1, -1):
        x, parent = items[at]
        if x[0] == "#":
            weight[at] = (x[3][1] - x[3][2]) * (0.1 if _is_fixed(x, pages) else 1.0)
        elif x[0] != "+" and _left_out(x, holds[at]):
            out[at], weight[at] = True, 0.0
        if parent >= 0:
            weight[parent] += weight[at]
            holds[parent] |= holds[at] or (x[0] != "#" and _kind(x) == "main")
    shown, depth = [True] * len(items), [0] * len(items)
    found: list[tuple[int, float, int, int]] = []
    for at, (x, parent) in enumerate(items[1:], 1):
        shown[at] = shown[parent] and not out[at]
        depth[at] = depth[parent] + (x[0] not in "#+")
        if shown[at] and x[0] not in "#+" and _kind(x) in ("main", "part"):
            order = {"article": 2, "main": 1}.get(_tag(x), 1 if _kind(x) == "main" else 0)
            found.append((order, weight[at], depth[at], at))

    total, main = weight[0], 0
    named = [f for f in found if f[1] > 0 and f[0] == 2] or [f for f in found if f[1] >= 0.3 * total and f[1] > 0]
    explicit = bool(named)
    if named:
        # The most telling name, then the most text, then the innermost.
        main = max(named, key=lambda f: (f[0], round(f[1], 3), f[2]))[3]
    else:
        number = {id(x): at for at, (x, _) in enumerate(items)}
        while True:  # the innermost item that holds most of the text
            inner = [number[id(x)] for x in _inside(items[main][0])]
            heavy = max((at for at in inner if not out[at]), key=weight.__getitem__, default=None)
            if heavy is None or _tag(items[heavy][0]) in PARAGRAPHS or items[heavy][0][1] & 2 or weight[heavy] < 0.7 * weight[main] or not weight[main]:
                break
            main = heavy
    path, at = [], main
    while at > 0:
        if items[at][0][0] != "+":
            path.append(items[at][0][0])
        at = items[at][1]
    path.reverse()
    fixed: set[str] = set()
    within = _preorder(items[main][0])
    if any(x[0] == "#" and x[3][0] is None for x, _ in within):  # pages that are all alike tell nothing about what is fixed
        place = [""] * len(within)
        for at, (x, parent) in enumerate(within[1:], 1):
            if x[0] == "#":
                holder = _tag(within[parent][0])
                plain = holder not in PARAGRAPHS if explicit else not re.fullmatch("h[1-6]", holder)
                if plain and _is_fixed(x, pages):
                    fixed.add(f"{place[parent]} {x[3][0]}")
            else:
                place[at] = place[parent] if x[0] == "+" else _place(place[parent], x[0])
    return {"path": path, "fixed": sorted(fixed)}


def _inside(item: list) -> list:
    return [y for x in item[3] if x[0] != "#" for y in (_inside(x) if x[0] == "+" else [x])]


def _matching(node: Node, path: list[str]) -> list[Node]:
    level = [node]
    for label in path:
        level = [k for n in level for k in n.kids if isinstance(k, Node) and _keyed(k) == label]
    return level


def main_text(page: str | None, found: dict | None) -> str:
    """Blocks of the main item in page order, joined by line breaks."""
    if not page:
        return ""
    root = parse(page)
    places = _matching(root, found["path"]) if found else []
    if not places:
        found = rule(lift(root))
        places = _matching(root, found["path"])
    fixed, blocks = set(found["fixed"]), []
    # Nodes with a main item inside, from the innermost out.
    holds_main: set[int] = set()
    order = [(None, node) for node in places]
    for _, node in order:
        order += [(node, k) for k in node.kids if isinstance(k, Node)]
    for parent, node in reversed(order):
        if parent is not None and (node.kind == "main" or id(node) in holds_main):
            holds_main.add(id(parent))

    todo = [(node, node, "article" if node.tag == "article" else "", "") for node in reversed(places)]
    while todo:
        kid, node, inside, place = todo.pop()
        if isinstance(kid, tuple):
            if not fixed or f"{place} {digest(kid[0])}" not in fixed or node.tag in ("p", "li"):
                blocks.append(kid[0])
            continue
        if kid is not node:
            if kid.kind == "hidden" or (kid.kind == "boilerplate" and id(kid) not in holds_main):
                continue
            if (kid.tag == "header" or "header" in kid.label.split(".")[1:]) and inside != "article" and id(kid) not in holds_main:
                continue
            inside = "article" if kid.tag == "article" else inside
            place = _place(place, _keyed(kid)) if fixed else ""
        todo += [(k, kid, inside, place) for k in reversed(kid.kids)]
    return "\n".join(blocks)


def _infer(batches):
    """(host, page, wrapper) of the pages of a task: page is a hash of the wrapper, copies in a row of pages are gone."""
    for batch in (b.slice(at, HELD_PAGES) for b in batches for at in range(0, b.num_rows, HELD_PAGES)):
        held: dict[tuple[str, str], str] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = to_json(lift(parse(page)))
            held.setdefault((host, digest(text)), text)
        cols = [[h for h, _ in held], [p for _, p in held], list(held.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["host", "page", "wrapper"])


def _distinct(batches):
    """Rows sorted by host, page: (host, wrapper) with one wrapper of each host over its distinct pages."""
    last, wrapper = (None, None), None
    for batch in batches:
        done = []
        for host, page, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (host, page) == last:
                continue
            one = from_json(text)
            if host == last[0]:
                wrapper = align(wrapper, one)
            else:
                if wrapper is not None:
                    done.append((last[0], to_json(wrapper)))
                wrapper = one
            last = host, page
        yield _rows(done)
    if wrapper is not None:
        yield _rows([(last[0], to_json(wrapper))])


def _merge(batches):
    """Rows sorted by key, host: one wrapper of each."""
    key, wrapper = None, None
    for batch in batches:
        done = []
        for salt, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            one = from_json(text)
            if (salt, host) == key:
                wrapper = align(wrapper, one)
                continue
            if key is not None:
                done.append((key[1], to_json(wrapper)))
            key, wrapper = (salt, host), one
        yield _rows(done)
    if key is not None:
        yield _rows([(key[1], to_json(wrapper))])


def _rows(done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())], ["host", "wrapper"])


def host_of(url):
    """Host of a url column: after the first :// up to /, ? or #, A-Z lower-cased; empty if there is none."""
    found = F.regexp_extract(url.cast("string"), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper as flat JSON) over all distinct pages with html; folded in tasks, then by salted host, then by host."""
    rows = pages.where(F.col(html_col).isNotNull()).select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    one = rows.mapInArrow(_infer, "host string, page string, wrapper string").repartition("host", "page").sortWithinPartitions("host", "page")
    parts = one.mapInArrow(_distinct, "host string, wrapper string")

    def merged(df: DataFrame, salt) -> DataFrame:
        keyed = df.select(salt.alias("salt"), "host", "wrapper").repartition("salt", "host").sortWithinPartitions("salt", "host", "wrapper")
        return keyed.mapInArrow(_merge, "host string, wrapper string")

    return merged(merged(parts, F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))), F.lit(0).cast("long"))


def _rules(batches):
    for batch in batches:
        rules = [json.dumps(rule(from_json(w))) for w in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rules, pa.string())], ["host", "rule"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """Per row: id, url, text, n_chars (code points of text).

    Null and empty html give an empty text. A null url, or one without ://, belongs
    to the host "". Rows are judged one by one, so repeated ids give a row each. An
    empty table gives an empty result. Other columns are not read.
    """
    rules = written(wrappers(pages, url_col, html_col).mapInArrow(_rules, "host string, rule string"), "rules")
    held = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    size = rules.agg(F.sum(F.length("rule") + F.length("host"))).first()[0] or 0
    kinds = "id {}, url {}, text string, n_chars long".format(*(held.schema[c].dataType.simpleString() for c in ("id", "url")))

    def run(batches, known):
        loaded: dict[str, dict] = {}
        for batch in batches:
            texts = []
            given = batch.column(4).to_pylist() if known is None else map(known.get, batch.column(2).to_pylist())
            for said, page in zip(given, batch.column(3).to_pylist(), strict=True):
                if said is not None and said not in loaded:
                    if len(loaded) > HELD_HOSTS:
                        loaded.clear()
                    loaded[said] = json.loads(said)
                texts.append(main_text(page, loaded.get(said)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    if size <= broadcast_chars:
        sent = pages.sparkSession.sparkContext.broadcast({r.host: r.rule for r in rules.toLocalIterator()})
        out = held.mapInArrow(lambda it: run(it, sent.value), kinds)
    else:
        out = held.join(rules, "host", "left").select("id", "url", "host", "html", "rule").mapInArrow(lambda it: run(it, None), kinds)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
