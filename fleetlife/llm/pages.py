"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a tree of elements, in which neighbours with equal labels are one node.
A host's wrapper is the tree most of its pages have. Simple tree matching aligns each page
with the wrapper, so a piece of text belongs to a slot: the wrapper node it is aligned
with, or its own path of labels. Text that most of a host's pages have in the same slot is
template; slots whose text varies are content, unless their elements say that they hold
menus, notices and the like. If a page marks its article, content outside it is left out,
and nothing in it is taken for template.
"""

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.store import stored
from fleetlife.llm.urls import parts

#: A text is template if this share of a host's different pages has it in one slot, of so many at least.
SHARE, LEAST_PAGES = 0.8, 5
#: Trees are matched down to this depth; below it, labels decide.
DEEPEST = 120

NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
QUOTE_OR_END = re.compile(r"""["'>]""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: What an open element of the name is ended by.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
ENDS = {name: [ended for ended, by in ENDED_BY.items() if name in by] for name in ("li", "dt", "dd", "tr", "td", "th", "option")}
HOLDERS = frozenset("ul ol dl table tbody thead article section main div body html nav aside header footer form blockquote".split())
ASIDE_TAGS = frozenset("head nav header footer aside form script style noscript template iframe button select option textarea svg canvas object menu dialog".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal overlay"
    " newsletter subscribe signup sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header footer masthead comment comments disqus"
    " reply replies respond share sharing social related widget pagination pager toolbar login search contentinfo complementary".split()
)
#: Words that may stand beside an aside word in one class or id.
BESIDE_WORDS = frozenset("site page main top bottom left right global primary secondary box block wrapper wrap container area list section item items inner outer bar".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Elements that hold a page's content whatever their classes say.
NEVER_ASIDE = frozenset(("html", "body", "main", "article"))


def says_aside(token: str) -> bool:
    """Whether a class, id or role names a menu, notice or the like as a whole: ``cookie-notice`` does, ``has-sidebar`` doesn't."""
    words = re.findall("[a-z]+", token)
    return not ASIDE_WORDS.isdisjoint(words) and all(w in ASIDE_WORDS or w in BESIDE_WORDS for w in words)


class Node:
    __slots__ = ("tag", "label", "aside", "items", "parent", "path")

    def __init__(self, tag, tokens, parent):
        marks = sorted({w for token in tokens for w in re.findall("[a-z]+", token)})
        self.tag, self.parent, self.items, self.path = tag, parent, [], None
        self.label = tag + "." + ".".join(marks) if marks else tag
        self.aside = tag in ASIDE_TAGS or (tag not in NEVER_ASIDE and any(map(says_aside, tokens)))


def tags(page: str):
    """(start, end, name, whether it closes, attributes) of each tag; comments and the like have no name.

    Marks of attributes may hold ``>``. One that is never closed would be sought again from
    every later tag, so after the first such one marks are no longer minded: every
    character is looked at a bounded number of times.
    """
    at, minded, last = 0, True, page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            yield start, at, None, False, ""
            continue
        if start > last:
            at = page.find("<!--", start)
            if at < 0:
                return
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            at = page.find(">", start) + 1
            yield start, at, None, False, ""
            continue
        if (m := NAME.match(page, start)) is None:
            at = start + 1
            continue
        end = m.end()
        while minded and (q := QUOTE_OR_END.search(page, end)):
            end = q.end()
            if q.group() == ">":
                break
            end = page.find(q.group(), end) + 1
            if end == 0:
                minded = False
        else:
            minded, end = False, page.find(">", m.end()) + 1
        at = end
        yield start, end, m.group(1).lower(), page[start + 1] == "/", page[m.end() : end - 1]


def tree(page: str) -> Node:
    """Elements of a page with their texts in order, ends of elements implied where they lack."""
    root = now = Node("#", (), None)
    at, until, open_ = 0, 0, Counter()

    def closed(node, stop):
        while node is not stop:
            open_[node.tag] -= 1
            node = node.parent
        return stop

    for start, end, name, closes, written_ in tags(page):
        if start < until:  # inside an element whose text is raw
            continue
        if start > at:
            now.items.append(page[at:start])
        at = end
        if name is None:
            continue
        if closes:
            if open_[name] > 0:
                up = now
                while up.tag != name:
                    up = up.parent
                now = closed(now, up.parent)
            continue
        if name not in INLINE and (left := open_["p"] + sum(open_[t] for t in ENDS.get(name, ()))):
            # A block ends an open paragraph, an item its neighbour.
            up, upper = now, None
            while left and up is not root and up.tag not in HOLDERS:
                if up.tag == "p" or name in ENDED_BY.get(up.tag, ()):
                    upper, left = up.parent, left - 1
                up = up.parent
            if upper is not None:
                now = closed(now, upper)
        tokens = [t for a in ATTRIBUTE.finditer(written_) for t in a.group(2).strip("\"'").lower().split()]
        node = Node(name, tokens, now)
        now.items.append(node)
        if name in RAW:
            found = re.compile(f"</{name}", re.IGNORECASE).search(page, end)
            until = found.start() if found else len(page)
            node.items.append(page[end:until])
            at = until
        elif name not in VOID and not written_.endswith("/"):
            now = node
            open_[name] += 1
    if at < len(page):
        now.items.append(page[at:])
    return root


def blocks(root: Node):
    """(node, text, whether in an aside, whether in an article) of each block in page order."""
    found, piece, owner = [], [], None
    stack = [(root, iter(root.items), False, False, root)]

    def close():
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            if text:
                found.append((owner[0], text, owner[1], owner[2]))
            piece.clear()

    while stack:
        node, items, aside, main, block = stack[-1]
        for item in items:
            if isinstance(item, str):
                if item.strip() or piece:
                    if not piece:
                        owner = (block, aside, main)
                    piece.append(item)
                continue
            if item.tag == "br":
                if piece:
                    piece.append(" ")
                continue
            if item.tag not in INLINE or item.aside:
                close()
            inline = item.tag in INLINE and not item.aside
            stack.append((item, iter(item.items), aside or item.aside, main or item.tag in MAIN_TAGS, block if inline else item))
            break
        else:
            if node.tag not in INLINE or node.aside:
                close()
            stack.pop()
    close()
    return found


class Merged:
    """A tree in which neighbours with equal labels are one node; inline elements are left out."""

    __slots__ = ("label", "children", "nodes", "at")

    def __init__(self, label):
        self.label, self.children, self.nodes, self.at = label, [], [], -1


def merged(root: Node) -> Merged:
    top = Merged(root.label)
    stack = [(top, [root])]
    while stack:
        own, nodes = stack.pop()
        own.nodes = nodes
        runs = []
        for node in nodes:
            for item in node.items:
                if isinstance(item, Node) and item.tag not in INLINE and item.tag != "script":
                    if runs and runs[-1][0].label == item.label:
                        runs[-1][1].append(item)
                    else:
                        same = next((r for r in runs if r[0].label == item.label), None) if len(nodes) > 1 else None
                        if same:
                            same[1].append(item)
                        else:
                            child = Merged(item.label)
                            own.children.append(child)
                            runs.append((child, [item]))
        stack += runs
    return top


def written(top: Merged) -> str:
    """A tree as lines of depth and label, in page order."""
    lines, stack = [], [(top, 0)]
    while stack:
        node, depth = stack.pop()
        lines.append(f"{depth} {node.label}")
        stack += [(child, depth + 1) for child in reversed(node.children)]
    return "\n".join(lines)


def read(lines: str) -> Merged:
    path = []
    for i, line in enumerate(lines.split("\n")):
        depth, _, label = line.partition(" ")
        node = Merged(label)
        node.at = i
        del path[int(depth) :]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]


def match(a: Merged, b: Merged, depth=0):
    """Simple tree matching: (pairs matched, [(node of a, node of b)])."""
    if a.label != b.label:
        return 0, []
    if depth >= DEEPEST or not a.children or not b.children:
        return 1, [(a, b)]
    if [c.label for c in a.children] == [c.label for c in b.children] and len({c.label for c in a.children}) == len(a.children):
        found = [match(x, y, depth + 1) for x, y in zip(a.children, b.children)]
        return 1 + sum(n for n, _ in found), [(a, b), *(p for _, pairs in found for p in pairs)]
    before = [(0, [])] * (len(b.children) + 1)
    for x in a.children:
        row = [(0, [])]
        for j, y in enumerate(b.children):
            best = max(before[j + 1], row[j], key=lambda s: s[0])
            if x.label == y.label:
                n, pairs = match(x, y, depth + 1)
                if before[j][0] + n > best[0]:
                    best = before[j][0] + n, before[j][1] + pairs
            row.append(best)
        before = row
    return 1 + before[-1][0], [(a, b), *before[-1][1]]


def _in_order(a: Merged, b: Merged):
    """Pairs of the nodes of two equal trees."""
    pairs, stack = [], [(a, b)]
    while stack:
        x, y = stack.pop()
        pairs.append((x, y))
        stack += zip(x.children, y.children)
    return pairs


def _path(node: Node) -> str:
    """Digest of the labels from the root to a node, kept in each node on the way."""
    way = []
    while node is not None and node.path is None:
        way.append(node)
        node = node.parent
    path = node.path if node is not None else ""
    for node in reversed(way):
        path = node.path = hashlib.blake2b(f"{path}/{node.label}".encode("utf-8", "replace"), digest_size=8).hexdigest()
    return path


def slotted(page: str, wrapper: str):
    """(slot, text, aside, main) of each block; a slot is a wrapper node's number or a path of labels."""
    root = tree(page)
    own = merged(root)
    pairs = _in_order(own, read(wrapper)) if written(own) == wrapper else match(own, read(wrapper))[1]
    slots = {id(node): str(b.at) for a, b in pairs for node in a.nodes}
    return [(slots.get(id(node)) or _path(node), text, aside, main) for node, text, aside, main in blocks(root)]


def _hash(text):
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the tree most pages of the host have, ties by the text of the tree."""

    def run(batches):
        for batch in batches:
            trees = [written(merged(tree(page or ""))) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees, pa.string())], names=["host", "wrapper"])

    shapes = pages.select("host", "html").mapInArrow(run, "host string, wrapper string").groupBy("host", "wrapper").agg(F.count("*").alias("n"))
    return shapes.groupBy("host").agg(F.max_by("wrapper", F.struct("n", "wrapper")).alias("wrapper"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): hashes of (slot, text) that most of the host's different pages have.

    ``pages`` (host, html, wrapper). At most 1 / SHARE times a page's blocks are kept for a host.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for host, page, wrapper in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = slotted(page or "", wrapper)
                whole = _hash("\n".join(text for _, text, _, _ in found))
                rows.append((host, 0, whole))
                rows += [(host, block, whole) for block in {_hash(f"{slot}\n{text}") for slot, text, _, _ in found}]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["host", "block", "page"])

    seen = pages.select("host", "html", "wrapper").mapInArrow(run, "host string, block long, page long").distinct()
    counts = stored(seen.groupBy("host", "block").agg(F.count("*").alias("n")))
    whole = counts.where("block = 0").select("host", F.col("n").alias("pages"))
    often = counts.where("block <> 0").join(whole, "host").where((F.col("pages") >= LEAST_PAGES) & (F.col("n") >= SHARE * F.col("pages")))
    return often.groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("template"))


def extract_text(pages: DataFrame) -> DataFrame:
    """The main text of every page.

    Takes page_id, url and html; returns (page_id, url, text, n_blocks) for each row: the
    blocks of the article in page order joined by an empty line, character references
    decoded, white space runs one blank. A null or empty page has empty text. Pages
    whose url is null or has no host share the empty host. Equal pages count once when
    templates are sought. An empty table gives an empty result.
    """
    host, _ = parts(F.col("url"))
    pages = pages.select("page_id", "url", "html").withColumn("host", host)
    known = stored(wrappers(pages))
    constant = stored(templates(pages.join(known, "host")))
    known = stored(known.join(constant, "host", "left"))

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for page, wrapper, template in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                constant = frozenset(template or ())
                found = slotted(page or "", wrapper)
                marked = any(main and not aside for _, _, aside, main in found)
                kept = [text for slot, text, aside, main in found if not aside and (main if marked else _hash(f"{slot}\n{text}") not in constant)]
                texts.append("\n\n".join(kept))
                counts.append(len(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=["page_id", "url", "text", "n_blocks"])

    rows = pages.join(known, "host").select("page_id", "url", "html", "wrapper", "template")
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_blocks int")
