"""HTML extraction by union-free wrapper inference.

Pages of one host share a template. A page becomes a tree of tags and texts; pages are aligned one
after the other into a wrapper, a regular expression without alternatives: what only some pages have
becomes optional, neighbours of one kind become a repeated item or group, and texts that differ
become slots, while texts that stay the same, of whatever length, are the template's. Children are
aligned by their longest common subsequence, which bit-parallel rows find at any length. Kinds are tags
with their classes, numbers aside, so that pages do not differ by their ids.

Each task merges its pages by host and shape; equal shapes are merged by Spark, and different ones of a
host are then aligned in a fixed order, in groups and as many rounds as their number needs. So no page
is left out, no task ever holds the pages of a host, and the result does not depend on how pages are
dealt.

The wrapper tells where a host's pages have their article: in the ``article`` or ``main`` element of
most slot text, unless ``TEASER`` times more of it lies outside such elements, or else in the deepest element that holds
most of the slot text outside menus, headers, footers and other boilerplate. It also tells which texts
there are the template's: those equal on every page of a host (of ``TEMPLATE_PAGES`` pages at least),
once each and not in a heading. The page's own tree is then read at that place, block by block, without
blocks made of such texts alone.

A class word of boilerplate or a form is overruled, page by page, where the element holds an
``article`` or ``main`` of more text than lies outside boilerplate, or nearly all text of the page.
Comments, related links and consent boxes are never overruled, nor are elements skipped by their tag
or role. Words that also have other uses (``ad-hoc``, ``share-price``) count only as the head of a name.

Defined cases: null html is empty and gives an empty text; a null url is a host of its own; pages
whose tree lacks the host's place are read by the rule for a single page, where every text is a slot;
end tags without a start and elements left open are tolerated; an element of raw content that is
closed at once has none, and one never closed ends with its parent; elements nested deeper than
``DEEPEST`` are read as children of the element there; repeated rows are read each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollwise.llm.staging import staged

#: Elements below this depth are flattened, as browsers do from some depth on.
DEEPEST = 80
#: Texts equal on all pages are the template's where a host has at least so many.
TEMPLATE_PAGES = 3
#: Share of the slot text that an element must hold for the article to lie inside it.
DENSE = 0.6
#: An article element is a teaser where more than so many times its text lies outside such elements.
TEASER = 3
#: Wrappers that a task aligns with each other, about.
FAN = 32

# Element names and class words of HTML pages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea svg title".split())
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - {"br"}
SKIPPED = set("nav footer aside form script style noscript template iframe svg textarea button select head title dialog menu".split())
#: Words that always mean boilerplate, and words that do as the head of a name or among neutral words.
ALWAYS = re.compile(
    r"nav\w*|menus?|breadcrumbs?|sidebars?|foot(er)?|masthead|cookies?|consent|gdpr|newsletter|advert\w*|sponsor\w*|comments?|disqus|respond|pagination"
)
OFTEN = re.compile(
    r"banner|notices?|alerts?|popup|modal|subscribe|signup|ads?|promo\w*|related|recommend\w*|share|sharing|social|replies|login|search|pager|toolbar|widget"
)
NEUTRAL = set(
    "area articles bar block body bottom box btn button buttons container content footer form global header icon icons inner item items js label left link links "
    "list main module outer page panel post posts primary right row secondary section site slot small text title top unit wrap wrapper".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6 th dt summary figcaption caption".split())


def is_boilerplate(words: str) -> bool:
    """Whether a class or id among ``words`` names something around the article."""
    for name in words.lower().split():
        parts = [x for x in re.split(r"[-_]+", name) if x and not x.isdigit()]
        if any(ALWAYS.fullmatch(x) for x in parts):
            return True
        often = [OFTEN.fullmatch(x) is not None for x in parts]
        if any(often) and (often[-1] or all(o or x in NEUTRAL for o, x in zip(often, parts))):
            return True
    return False


#: Class words of what readers add or what leads elsewhere; no amount of text makes it the article.
NEVER_ARTICLE = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|respond|related|recommend\w*|cookies?|consent|gdpr)(?:$|[\s_-])", re.I)
#: Share of a page's text that makes a boilerplate class or a form a layout container.
LAYOUT = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


class Node:
    """An element or, with key "#", a text; ``kids`` of an element in order.

    ``home`` is the element that takes what lies inside, itself but for elements nested too deep.
    """

    __slots__ = ("key", "name", "skip", "kids", "text", "home", "inside")

    def __init__(self, key: str, name: str, skip: bool = False, text: str = ""):
        self.key, self.name, self.skip, self.kids, self.text = key, name, skip, [], text
        self.home, self.inside = self, False


class _Open:
    """The elements that are open, with the number of each name among them."""

    def __init__(self, root: Node):
        self.stack, self.names = [root], Counter()

    def push(self, node: Node) -> None:
        parent = self.stack[-1]
        node.inside = parent.inside or parent.name == "article"
        if len(self.stack) > DEEPEST and (not node.skip or parent.home.skip):
            node.home = parent.home
        self.stack.append(node)
        self.names[node.name] += 1

    def close(self, at: int) -> None:
        for node in self.stack[at:]:
            self.names[node.name] -= 1
        del self.stack[at:]

    def end(self, name: str) -> None:
        if self.names[name] > 0:
            at = len(self.stack) - 1
            while self.stack[at].name != name:
                at -= 1
            self.close(at)


def _raw_end(html: str, name: str, start: int, unclosed: set[str]) -> int | None:
    """Where the raw content of an element ends; None if it is never closed."""
    if name in unclosed:
        return None
    found = re.compile(rf"</{name}\s*>", re.I).search(html, start)
    if found is None:
        unclosed.add(name)
        return None
    return found.end()


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("", "")
    opened, unclosed = _Open(root), set()
    stack = opened.stack
    #: Skipped for its class words or as a form, which the page's text may overrule.
    soft: set[Node] = set()
    candidates: list[tuple[Node, list[Node]]] = []
    pos = 0
    while pos < len(html):
        m = _TOKEN.match(html, pos)
        pos = m.end()
        text = m["text"]
        if text is not None:
            stack[-1].home.kids.append(Node("#", "#", text=entities.unescape(text)))
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            opened.end(name)
            continue
        attrs = m["attrs"]
        if name in RAW:
            if attrs.endswith("/"):
                continue
            end = _raw_end(html, name, pos, unclosed)
            if end is not None:
                pos = end
                continue
        if name in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p" or stack[i].name == name == "li":
                    opened.close(i)
                    break
                if stack[i].name in BLOCKS:
                    break
        found = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attrs)} if attrs.strip() else {}
        words = " ".join(found.get(k, "") for k in ("class", "id")).strip()
        role = found.get("role", "").lower()
        kind = " ".join(re.sub(r"\d+", "0", found.get("class", "")).split())
        key = name + (f".{kind}" if kind else "") + (f"@{role}" if role else "")
        hard = (
            name in SKIPPED
            and name != "form"
            or "hidden" in found
            or name == "header" and not (stack[-1].inside or stack[-1].name == "article")
            or role in ("navigation", "banner", "contentinfo", "search", "complementary", "alert", "dialog")
        )
        skip = hard or name == "form" or name not in ("html", "body", "article", "main") and bool(words) and is_boilerplate(words)
        node = Node(key, name, skip)
        stack[-1].home.kids.append(node)
        main = name in ("article", "main") or role == "main"
        around = [n for n in (*stack, node) if n.skip] if skip or main else []
        if skip and not hard and not NEVER_ARTICLE.search(words):
            soft.add(node)
        if around and soft.issuperset(around) and (around == [node] or main):
            candidates.append((node, around))
        if name not in VOID and not attrs.endswith("/"):
            opened.push(node)
    if candidates:
        _overrule(root, candidates)
    return root


def _characters(node: Node) -> int:
    """Characters of a node's text outside skipped elements below it."""
    if node.key == "#":
        return len(" ".join(node.text.split()))
    return sum(_characters(k) for k in node.kids if not k.skip)


def _overrule(root: Node, candidates: list[tuple[Node, list[Node]]]) -> None:
    """Read a skipped element after all if it holds an article or main element of more text than lies
    outside skipped elements, or else nearly all of the page's text."""
    outside = _characters(root)
    article = [(n, around) for n, around in candidates if n.name in ("article", "main") or n.key.endswith("@main")]
    for n, around in article:
        if _characters(n) > outside:
            for x in around:
                x.skip = False
    while outside == _characters(root):
        held = [(_characters(n), n) for n, around in candidates if n.skip and around == [n]]
        most, n = max(held, key=lambda x: x[0], default=(0, None))
        if n is None or most < LAYOUT * (most + outside) or not most:
            break
        n.skip = False


# A wrapper item is [key, optional, many, skip, text or None for a slot, characters seen, kids, times seen].
KEY, OPTIONAL, MANY, SKIP, TEXT, SEEN, KIDS, TIMES = range(8)


def shown(text: str) -> str:
    """A text as the wrapper keeps it: long ones by a hash of the whole."""
    return text if len(text) <= 80 else hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


def wrapper(node: Node) -> list:
    """The page's own wrapper, its repeats folded."""
    if node.key == "#":
        text = " ".join(node.text.split())
        return ["#", False, False, False, shown(text), len(text), [], 1]
    kids = [] if node.skip else [wrapper(k) for k in node.kids if k.key != "#" or not k.text.isspace()]
    return [node.key, False, False, node.skip, None, 0, fold(kids), 1]


def fold(items: list) -> list:
    """Neighbours of one kind become repeated, and so do runs of equal groups, inner ones first."""
    folded = True
    while folded:
        folded, keys, out, i = False, [x[KEY] for x in items], [], 0
        gap, last = [0] * len(keys), {}
        for at in range(len(keys) - 1, -1, -1):
            gap[at], last[keys[at]] = last.get(keys[at], at) - at, at
        while i < len(items):
            size, j = gap[i], i + gap[i]
            group = items[i:j]
            while size and keys[j : j + size] == keys[i : i + size]:
                group = [align(a, b) for a, b in zip(group, items[j : j + size])]
                j += size
            if j == i + size:
                out.append(items[i])
                i += 1
                continue
            if size == 1:
                group[0][MANY] = True
                out.append(group[0])
            else:
                out.append([f"({' '.join(keys[i : i + size])})", False, True, False, None, 0, group, 1])
            folded, i = True, j
        items = out
    return items


def align(a: list, b: list) -> list:
    """The wrapper of two items of one kind."""
    kids = a[KIDS]
    if kids or b[KIDS]:
        ka, kb = [x[KEY] for x in kids], [x[KEY] for x in b[KIDS]]
        kids = [align(x, y) for x, y in zip(kids, b[KIDS])] if ka == kb else fold(_aligned(kids, b[KIDS], ka, kb))
    flags = [a[OPTIONAL] or b[OPTIONAL], a[MANY] or b[MANY], a[SKIP] or b[SKIP]]
    return [a[KEY], *flags, a[TEXT] if a[TEXT] == b[TEXT] else None, a[SEEN] + b[SEEN], kids, a[TIMES] + b[TIMES]]


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in order; a row of its table is the bits of one number."""
    places: dict = {}
    for j, key in enumerate(b):
        places[key] = places.get(key, 0) | 1 << j
    whole = (1 << len(b)) - 1
    row, rows = whole, []
    for key in a:
        match = row & places.get(key, 0)
        row = (row + match | row - match) & whole
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        # A bit that is not set marks where the row's length goes up.
        if rows[i - 1] >> j - 1 & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> j - 1 & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def _aligned(a: list, b: list, ka: list[str], kb: list[str]) -> list:
    """Longest common subsequence by kind; what is on one side only becomes optional."""
    out, i, j = [], 0, 0
    for x, y in [*common(ka, kb), (len(a), len(b))]:
        out += [[one[KEY], True, *one[MANY:]] for one in (*a[i:x], *b[j:y])]
        if x < len(a):
            out.append(align(a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def slot_text(item: list, every: bool = False) -> int:
    """Characters seen in the slots of an item, or in all its texts; boilerplate aside."""
    if item[SKIP]:
        return 0
    own = item[SEEN] if item[KEY] == "#" and (every or item[TEXT] is None) else 0
    return own + sum(slot_text(k, every) for k in item[KIDS])


def template_texts(root: list, path: list[str]) -> list[str]:
    """Texts below ``path`` that every page has, once and alike, beside texts that differ."""
    level = [(root, not (root[OPTIONAL] or root[MANY]))]
    for key in path[1:]:
        level = [(k, sure and not (k[OPTIONAL] or k[MANY])) for x, sure in level for k in x[KIDS] if k[KEY] == key]
    found: set[str] = set()

    def search(item: list) -> None:
        if item[SKIP] or item[OPTIONAL] or item[MANY] or re.split(r"[.@]", item[KEY])[0] in HEADINGS:
            return
        if item[KEY] == "#" and item[TEXT] is not None and item[TIMES] == root[TIMES]:
            found.add(item[TEXT])
        for kid in item[KIDS]:
            search(kid)

    if root[TIMES] >= TEMPLATE_PAGES:
        for item, sure in level:
            if sure and slot_text(item):
                search(item)
    return sorted(found)


def article_path(root: list) -> list[str]:
    """Keys from the root to the element that holds the article.

    Slots count; where nothing differs, because there is one page or all are alike, every text does.
    """
    every = root[TIMES] == 1 or not slot_text(root)
    whole = slot_text(root, every)
    best: dict[str, tuple[int, list[str]]] = {}
    held: Counter = Counter()

    def search(item: list, path: list[str], within: frozenset) -> None:
        if item[SKIP]:
            return
        group = item[KEY].startswith("(")
        path = path if group else [*path, item[KEY]]
        name = re.split(r"[.@]", item[KEY])[0]
        kind = "article" if name == "article" else "main" if name == "main" or item[KEY].endswith("@main") else None
        if kind and not group:
            mass = slot_text(item, every)
            if kind not in within:
                held[kind] += mass
            if kind not in best or mass > best[kind][0]:
                best[kind] = mass, path
            within = within | {kind}
        for kid in item[KIDS]:
            search(kid, path, within)

    search(root, [], frozenset())
    for kind in ("article", "main"):
        # An element beside which much more text lies is a teaser.
        if kind in best and TEASER * best[kind][0] >= whole - held[kind]:
            return best[kind][1]
    item, path = root, [root[KEY]]
    while True:
        kids = [k for x in item[KIDS] for k in (x[KIDS] if x[KEY].startswith("(") else [x])]
        inner = [k for k in kids if k[KEY] != "#" and not k[SKIP] and re.split(r"[.@]", k[KEY])[0] in ("html", "body", "div", "section", "td", "table", "tbody", "tr", "center", "main", "article")]
        dense = max(inner, key=lambda k: slot_text(k, every), default=None)
        if dense is None or slot_text(dense, every) < DENSE * whole or not whole:
            return path
        item = dense
        path.append(item[KEY])


def places(root: Node, path: list[str]) -> list[Node]:
    """The outermost nodes of a page that lie at ``path``."""
    level = [root]
    for key in path[1:]:
        level = [k for n in level for k in n.kids if k.key == key and not k.skip]
    return level


def block_text(nodes: list[Node], template: frozenset[str] = frozenset()) -> str:
    """Text of the nodes without boilerplate: blocks in page order, joined by one space.

    A block all of whose texts are the template's is left out.
    """
    blocks: list[list[str]] = [[]]

    def read(node: Node) -> None:
        if node.key == "#":
            blocks[-1].append(node.text)
            return
        if node.skip:
            return
        block = node.name in BLOCKS
        if block:
            blocks.append([])
        for kid in node.kids:
            read(kid)
        if block:
            blocks.append([])

    for node in nodes:
        read(node)
        blocks.append([])
    if template:
        blocks = [b for b in blocks if not all(not t or shown(t) in template for t in (" ".join(x.split()) for x in b))]
    return " ".join(t for b in blocks if (t := " ".join("".join(b).split())))


def extract(html: str, path: list[str] | None, template: frozenset[str] = frozenset()) -> str:
    root = parse(html)
    found = places(root, path) if path else []
    return block_text(found, template) if found else block_text(places(root, article_path(wrapper(root))))


def _local_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host and shape of page, merged as far as a task's memory goes."""
    seen: dict[tuple[str, str], list] = {}
    for batch in batches:
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = wrapper(parse(html or ""))
            shape = (host, hashlib.md5(_shape(page).encode("utf-8", "surrogatepass")).hexdigest())
            seen[shape] = align(seen[shape], page) if shape in seen else page
            if len(seen) >= 2000:
                yield _rows(seen)
                seen = {}
    yield _rows(seen)


def _shape(item: list) -> str:
    kind = f"{item[KEY]}{'?' * item[OPTIONAL]}{'+' * item[MANY]}"
    return f"{kind}[{','.join(map(_shape, item[KIDS]))}]" if item[KIDS] else kind


_WRAPPERS = "host string, shape string, wrapper string"


def _rows(seen: dict) -> pa.RecordBatch:
    columns = [[h for h, _ in seen], [s for _, s in seen], [json.dumps(w) for w in seen.values()]]
    return pa.record_batch([pa.array(c, pa.string()) for c in columns], ["host", "shape", "wrapper"])


def _align_group(table: pa.Table) -> pa.Table:
    """The wrappers of a group aligned in the order of their shapes; the first shape names the result."""
    rows = sorted(zip(table.column("shape").to_pylist(), table.column("wrapper").to_pylist()))
    whole = json.loads(rows[0][1])
    for _, text in rows[1:]:
        whole = align(whole, json.loads(text))
    return pa.table({"host": table.column("host")[:1], "shape": pa.array([rows[0][0]]), "wrapper": pa.array([json.dumps(whole)])})


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = [json.loads(w) for w in batch.column("wrapper").to_pylist()]
        paths = [article_path(w) for w in wrappers]
        template = [json.dumps(template_texts(w, p)) for w, p in zip(wrappers, paths)]
        columns = [batch.column("host"), batch.column("wrapper"), pa.array([json.dumps(p) for p in paths], pa.string()), pa.array(template, pa.string())]
        yield pa.record_batch(columns, ["host", "wrapper", "path", "template"])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.lower(F.coalesce(F.col("url").cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))


def infer_wrappers(pages: DataFrame, fan: int = FAN) -> DataFrame:
    """host, wrapper, path and template texts (JSON each) of each host of ``pages`` (page_id, url, html)."""
    local = with_host(pages).select("host", "html").mapInArrow(_local_wrappers, _WRAPPERS)
    # Merging equal shapes only adds up, so it gives the same however the pages were dealt.
    merged = staged(local.groupBy("host", "shape").applyInArrow(_align_group, _WRAPPERS), "shapes")
    while (most := merged.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        group = F.pmod(F.xxhash64("shape"), F.lit(-(-most // fan)))
        merged = staged(merged.withColumn("group", group).groupBy("host", "group").applyInArrow(_align_group, _WRAPPERS), "wrappers")
    return merged.mapInArrow(_placed, "host string, wrapper string, path string, template string")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rules: dict[tuple, tuple] = {(None, None): (None, frozenset())}
        texts = []
        for html, *rule in zip(*(batch.column(c).to_pylist() for c in ("html", "path", "template"))):
            if (rule := tuple(rule)) not in rules:
                rules[rule] = json.loads(rule[0]), frozenset(json.loads(rule[1]))
            texts.append(extract(html or "", *rules[rule]))
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html)."""
    rules = staged(infer_wrappers(pages).select("host", "path", "template"), "rules")
    return with_host(pages).join(rules, "host", "left").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
