"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node that is content or not.  A node's potential comes from its tag, the
words of its class, id and role, its share of linked text and the length of its own text; an edge's
potential says how likely a child of such a parent has either state.  Both are counted on labelled
pages.  Sum-product messages go up to the root and down again, and the text of nodes whose
marginal favours content is the result.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Never text of a page: what browsers do not show, and the controls of forms.
DROPPED = RAW | frozenset("head button select option datalist input".split())
#: Their contents are part of the line they stand in, whatever elements they use.
FOREIGN = frozenset("math svg".split())
#: Elements inside FOREIGN that hold HTML again.
ISLANDS = frozenset("foreignobject annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var img br wbr label button input select option canvas object audio video map math svg".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = frozenset("ul ol dl table tbody thead select".split())
GROUPS = {
    "article": "article main", "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside", "form": "form fieldset",
    "box": "div section center details", "table": "table", "cell": "td th tr tbody thead tfoot caption", "text": "p blockquote pre figure figcaption address", "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "list": "ul ol dl", "item": "li dt dd summary", "top": "html body",
}
GROUP = {t: g for g, tags in GROUPS.items() for t in tags.split()}
#: Added to every count of a feature's values.
SMOOTH = 0.1
#: Elements that a word of a name is smoothed with.
NAME_SMOOTH = 1.0
#: A name counts as so many features.
NAME_WEIGHT = 2.0

NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
HINT = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


@dataclass
class Node:
    """A block element."""

    tag: str
    parent: int
    names: frozenset[str] = frozenset()  # words of class, id and role
    hidden: bool = False
    label: int | None = None
    chars: int = 0  # of its own text
    linked: int = 0
    below: int = 0  # of its subtree, with links
    below_linked: int = 0
    children: list[int] = field(default_factory=list)


def _attributes(text: str) -> tuple[frozenset[str], bool, int | None]:
    names, hidden, label = set(), False, None
    for m in ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            names.update(w.lower() for w in HINT.findall(value))
        elif name == "style":
            hidden |= bool(HIDDEN.search(value))
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "hidden":
            hidden = True
        elif name == "data-content":
            label = int(value == "1")
    return frozenset(names), hidden, label


class Tags:
    """Finds where tags end, each character of the page being looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}  # place of a special character outside quotes -> end of its tag, or -1
        self.name_end = self.special = -1

    def read(self, at: int) -> tuple[str, str, int] | None:
        """Name, attributes and end of the tag whose name starts at ``at``; calls come in page order."""
        if self.name_end < at:
            m = NAME_END.search(self.page, at)
            self.name_end = m.start() if m else len(self.page)
        name_end = self.name_end
        if self.special < name_end:
            m = SPECIAL.search(self.page, name_end)
            self.special = m.start() if m else len(self.page)
        end = self._end(self.special)
        return None if end < 0 else (self.page[at:name_end].lower(), self.page[name_end:end], end + 1)

    def _end(self, at: int) -> int:
        """The first ``>`` outside quotes from the special character ``at`` on."""
        page, ends, passed = self.page, self.ends, []
        while at not in ends:
            passed.append(at)
            if at >= len(page):
                ends[at] = -1
            elif page[at] == ">":
                ends[at] = at
            else:
                quote = page.find(page[at], at + 1)
                m = SPECIAL.search(page, quote + 1) if quote >= 0 else None
                if m is None:
                    ends[at] = -1
                else:
                    at = m.start()
        for x in passed:
            ends[x] = ends[at]
        return ends[at]


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order (parents first) and the runs of text ``(node, text)``."""
    nodes, runs = [Node("html", -1)], []
    open_tags: list[tuple[str, int, bool]] = []  # tag, node that holds its text, is a block
    places: dict[str, list[int]] = defaultdict(list)  # tag -> its places in open_tags
    blocks: list[int] = []  # places of blocks
    scopes: list[tuple[int, str]] = []  # places of open FOREIGN elements and of ISLANDS in them
    dropped = links = 0  # open elements of these kinds
    parts: list[str] = []
    tags = Tags(page)

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                runs.append((open_tags[-1][1] if open_tags else 0, text))

    def close(n: int) -> None:
        nonlocal dropped, links
        while len(open_tags) > n:
            tag, _, block = open_tags[-1]
            if block:
                flush()
                blocks.pop()
            open_tags.pop()
            places[tag].pop()
            if scopes and scopes[-1][0] == len(open_tags):
                scopes.pop()
            dropped -= tag in DROPPED
            links -= tag == "a"

    def last(names: Iterable[str]) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=-1)

    def say(text: str) -> None:
        if not dropped:
            text = html.unescape(text)
            parts.append(text)
            node = nodes[open_tags[-1][1] if open_tags else 0]
            n = sum(map(len, text.split()))
            node.chars += n
            node.linked += n if links else 0

    at, end = 0, len(page)
    while at < end:
        start = page.find("<", at)
        if start != at:
            start = start if start >= 0 else end
            say(page[at:start])
            at = start
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if page[at + 1 : at + 2] in ("!", "?"):
            stop = page.find(">", at + 2)
            at = stop + 1 if stop >= 0 else end
            continue
        closing = page[at + 1 : at + 2] == "/"
        first = page[at + 1 + closing : at + 2 + closing]
        found = tags.read(at + 1 + closing) if first.isascii() and first.isalpha() else None
        if found is None:
            say("<")
            at += 1
            continue
        tag, attributes, at = found
        if closing:
            if places.get(tag):
                close(places[tag][-1])
            continue
        foreign = bool(scopes) and scopes[-1][1] in FOREIGN
        if foreign and tag in CLOSES_P:  # HTML ends a drawing or formula that was left open
            close(last(FOREIGN))
            foreign = bool(scopes) and scopes[-1][1] in FOREIGN
        if tag in ("html", "body") and places.get(tag):
            continue
        if tag == "body" and places.get("head"):  # an open head ends here
            close(places["head"][0])
        if tag in CLOSES_P and blocks and open_tags[blocks[-1]][0] == "p":
            close(blocks[-1])
        if tag in SIBLINGS:
            sibling = last(SIBLINGS[tag])
            if sibling > last(FENCES):
                close(sibling)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?![^\s/>])", re.I).search(page, at)
            stop = page.find(">", stop.end()) if stop else -1
            at = stop + 1 if stop >= 0 else end
            continue
        inline = tag in INLINE or foreign
        if tag in VOID or foreign and attributes.endswith("/"):
            if inline:
                parts.append(" " if tag in VOID else "")
            else:
                flush()
            continue
        here = open_tags[-1][1] if open_tags else 0
        block = not inline
        if block and tag != "html":
            flush()
            nodes.append(Node(tag, here, *_attributes(attributes)))
            nodes[here].children.append(len(nodes) - 1)
            here = len(nodes) - 1
        places[tag].append(len(open_tags))
        if block:
            blocks.append(len(open_tags))
        if tag in FOREIGN or foreign and tag in ISLANDS:
            scopes.append((len(open_tags), tag))
        open_tags.append((tag, here, block))
        dropped += tag in DROPPED
        links += tag == "a"
    close(0)
    flush()
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        x.below += x.chars
        x.below_linked += x.linked
        if x.parent >= 0:
            nodes[x.parent].below += x.below
            nodes[x.parent].below_linked += x.below_linked
    return nodes, runs


def kind(x: Node) -> str:
    """Elements that hold lines, entries of lists and tables, and those that hold other elements."""
    group = GROUP.get(x.tag, "box")
    return "line" if group in ("text", "heading") else "entry" if group in ("item", "cell") else "box"


def features(x: Node) -> tuple[tuple[str, str], ...]:
    if kind(x) == "entry":  # entries of one list are alike: the list tells of all of them, once
        return ()
    share = x.below_linked / x.below if x.below else 0.0
    links = "empty" if not x.below else "none" if not share else "few" if share < 0.2 else "some" if share < 0.8 else "many"
    size = "none" if not x.chars else "short" if x.chars < 25 else "long"
    return (("tag", GROUP.get(x.tag, "box")), ("links", f"{kind(x)} {links}"), ("size", size), ("hidden", str(x.hidden)))


class Model:
    """Log potentials counted on labelled pages, smoothed."""

    def __init__(self, pages: list[str]):
        seen: dict = defaultdict(Counter)
        edges: dict = defaultdict(Counter)
        values: dict = defaultdict(set)
        named: dict = defaultdict(lambda: [0, 0])
        states: Counter = Counter()
        for page in pages:
            nodes, _ = parse(page)
            state = []
            for x in nodes:
                # Labels hold for the subtree until another label; the top counts as content.
                state.append(x.label if x.label is not None else state[x.parent] if x.parent > 0 and x.tag != "body" else 1)
                s = state[-1]
                states[s] += 1
                for name, value in features(x):
                    seen[name, s][value] += 1
                    values[name].add(value)
                for word in x.names:
                    named["", word][s] += 1
                    named[kind(x), word][s] += 1
                if x.parent >= 0:
                    edges[GROUP.get(nodes[x.parent].tag, "box"), state[x.parent]][s] += 1
        self.values = {k: set(v) for k, v in values.items()}
        self.seen = {k: dict(v) for k, v in seen.items()}
        self.edges = {k: dict(v) for k, v in edges.items()}
        self.named = {k: tuple(v) for k, v in named.items()}
        self.share = [(states[s] + 1) / (sum(states.values()) + 2) for s in (0, 1)]
        self.prior = [log(x) for x in self.share]

    def name(self, of: str, word: str, s: int) -> float:
        """How much likelier ``word`` is in a name of an element of this kind in state ``s``, as a log.

        Counts of the kind are smoothed by those of the word on all elements, and these by the share of
        the state, so that a word that was never seen says nothing.
        """
        everywhere, here = self.named.get(("", word), (0, 0)), self.named.get((of, word), (0, 0))
        p = (everywhere[s] + NAME_SMOOTH * self.share[s]) / (sum(everywhere) + NAME_SMOOTH)
        p = (here[s] + NAME_SMOOTH * p) / (sum(here) + NAME_SMOOTH)
        return log(p / self.share[s])

    def unary(self, x: Node) -> tuple[float, float]:
        out = []
        for s in (0, 1):
            total = 0.0
            for name, value in features(x):
                counts = self.seen.get((name, s), {})
                total += log((counts.get(value, 0) + SMOOTH) / (sum(counts.values()) + SMOOTH * (len(self.values[name]) + 1)))
            if x.names:  # words of one element's names tell much the same, hence the mean, not the sum
                found = [self.name(kind(x), w, s) for w in sorted(x.names) if ("", w) in self.named]
                total += NAME_WEIGHT * sum(found) / max(1, len(found))
            out.append(total)
        if x.tag in DROPPED:
            out[1] = -50.0
        return out[0], out[1]

    def edge(self, parent: Node) -> tuple[tuple[float, float], tuple[float, float]]:
        """Log potential by parent state, then child state."""
        rows = []
        for s in (0, 1):
            c = self.edges.get((GROUP.get(parent.tag, "box"), s), {})
            n = c.get(0, 0) + c.get(1, 0) + 1.0
            own = 0.9 if s == 0 else 0.5  # where nothing is known, boilerplate stays boilerplate
            p0 = (c.get(0, 0) + (own if s == 0 else 1 - own)) / n
            rows.append((log(max(p0, 1e-4)), log(max(1 - p0, 1e-4))))
        return rows[0], rows[1]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node by messages to the root and back."""
        add = lambda a, b: max(a, b) + log(1 + exp(-abs(a - b)))
        belief = [list(self.unary(x)) for x in nodes]
        edges = [self.edge(x) for x in nodes]
        up: list = [None] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):  # children come after parents
            e = edges[nodes[i].parent]
            up[i] = [add(e[s][0] + belief[i][0], e[s][1] + belief[i][1]) for s in (0, 1)]
            for s in (0, 1):
                belief[nodes[i].parent][s] += up[i][s]
        belief[0][0] += self.prior[0]
        belief[0][1] += self.prior[1]
        for i in range(1, len(nodes)):
            p = nodes[i].parent
            e, rest = edges[p], [belief[p][s] - up[i][s] for s in (0, 1)]
            down = [add(rest[0] + e[0][s], rest[1] + e[1][s]) for s in (0, 1)]
            belief[i][0] += down[0]
            belief[i][1] += down[1]
        return [1 / (1 + exp(max(-50.0, min(50.0, b[0] - b[1])))) for b in belief]

    def text(self, page: str | None) -> str:
        nodes, runs = parse(page or "")
        p = self.marginals(nodes)
        return "\n".join(text for node, text in runs if p[node] > 0.5)


def extract(pages: DataFrame, labelled: list[str], html_col: str = "html") -> DataFrame:
    """``pages`` columns ``page_id, url`` with ``text`` and ``n_chars``, one row per input row.

    ``labelled`` are pages whose elements carry ``data-content`` 0 or 1 for their subtrees; they
    are the training set and bounded by being passed in.  A null or empty page has an empty text.
    Pages of any length are read whole, in time that grows with their length; broken markup is closed as
    browsers do.  Drawings, formulas and players belong to the line they stand in, with the text they hold.  Repeated rows get equal
    results, an empty table gives no rows, further columns are ignored.
    """
    model = Model(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = [model.text(x) for x in b.column(2).to_pylist()]
            cols = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
