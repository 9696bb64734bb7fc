"""Main text of web pages by a graphical model on the DOM tree.

Every element and every run of text is a node with the label main or other. A node has a potential from its own features (tag,
names, role; length of its text, sentence marks, long runs of text, share of links and of the page's text, place in the page and depth;
telling words of short texts), and every edge one from the two labels and the kind of child. Messages go from the
leaves to the root and back (sum-product), which is exact on a tree; a run of text belongs to the main text when its
marginal says so. The weights are learnt from labelled pages by gradient ascent on the likelihood. All trees of a batch are
passed together, level by level.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.labelled_pages import TELLING, training_pages
from tenura.llm.tables import free_name, pieces

FEATURES = 1 << 13
TRAIN_PAGES = 800
STEPS = 150
RATE = 0.3
PENALTY = 0.1
# Nodes of all trees that are passed together.
PASSED_NODES = 60_000

# Elements of HTML by what they do.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title".split())
UNREAD = set("noscript template iframe svg math object canvas select".split())
FOREIGN = {"svg", "math"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# A start tag of the second group closes an open element of the first.
CLOSES = {
    "p": set("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"},
}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|<([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/>\"']+)", re.S)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Nodes in page order; ``parent`` comes before its children. ``text`` is None for elements."""

    parent: list[int]
    tag: list[str]
    names: list[tuple[str, ...]]
    text: list[str | None]
    label: list[int]


_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.I) for tag in RAW}


def _closed(attributes: str) -> bool:
    return attributes.rstrip().endswith("/")


def _raw_end(page: str, tag: str, at: int) -> int:
    ending = _RAW_END[tag].search(page, at)
    return ending.end() if ending else len(page)


def _unread_ends(page: str, at: int) -> dict[int, int]:
    """Where each closed element of ``UNREAD`` from ``at`` on ends, by where it starts.

    An end belongs to the last start of its name. Self-closing svg and math and elements without an end are not named.
    """
    ends: dict[int, int] = {}
    starts: dict[str, list[int]] = {tag: [] for tag in UNREAD}
    while found := _TOKEN.search(page, at):
        at = found.end()
        end, start = (found.group(1) or "").lower(), (found.group(2) or "").lower()
        if start in UNREAD and not (start in FOREIGN and _closed(found.group(3))):
            starts[start].append(found.start())
        elif start in RAW and not (_closed(found.group(3)) and any(starts[x] for x in FOREIGN)):
            at = _raw_end(page, start, at)
        elif end in UNREAD and starts[end]:
            ends[starts[end].pop()] = at
    return ends


def parse(page: str, labelled: bool = False) -> Tree:
    """A tolerant reading: unknown ends are passed over, open elements end where their parent does, cut tags are dropped.

    Script, style and the like are single nodes without text, and so are elements such as svg and select where they are closed; one
    that is not closed is an empty node. ``labelled`` reads the marks of training pages.
    """
    tree = Tree([-1], ["#root"], [()], [None], [0])
    open_: list[int] = [0]
    at = 0
    # How many elements of each name are open, so that ends without a start cost nothing.
    standing: dict[str, int] = {}
    ends: dict[int, int] | None = None

    def close(depth):
        for i in open_[depth:]:
            standing[tree.tag[i]] -= 1
        del open_[depth:]

    def add(tag, names, text, label):
        tree.parent.append(open_[-1])
        tree.tag.append(tag)
        tree.names.append(names)
        tree.text.append(text)
        tree.label.append(label)

    while True:
        found = _TOKEN.search(page, at)
        run = page[at : found.start() if found else len(page)]
        if run and not run.isspace():
            add("#text", (), run, tree.label[open_[-1]])
        elif run and len(open_) > 1:
            add("#space", (), run, tree.label[open_[-1]])
        if not found:
            return tree
        at = found.end()
        end, start = found.group(1), found.group(2)
        if end:
            end = end.lower()
            for depth in range(len(open_) - 1, 0, -1) if standing.get(end) else ():
                if tree.tag[open_[depth]] == end:
                    close(depth)
                    break
                # The end of an inline element does not reach beyond its block.
                if end in INLINE and tree.tag[open_[depth]] not in INLINE:
                    break
        elif start:
            start = start.lower()
            while len(open_) > 1 and start in CLOSES.get(tree.tag[open_[-1]], ()):
                close(len(open_) - 1)
            if start in CLOSES["p"]:
                # Formatting left open inside a paragraph ends with it.
                depth = len(open_) - 1
                while depth > 0 and tree.tag[open_[depth]] in INLINE:
                    depth -= 1
                if depth > 0 and tree.tag[open_[depth]] == "p":
                    close(depth)
                elif start != "hr" and depth < len(open_) - 1 and tree.tag[open_[depth]] in ("article", "div", "main", "section", "body", "td", "li", "blockquote"):
                    close(depth + 1)
            names, label = [], tree.label[open_[-1]]
            for name, *values, bare in _ATTRIBUTE.findall(found.group(3)):
                key, value = (name or bare).lower(), "".join(values)
                if key in ("class", "id", "role"):
                    names.append(key[0] + "=" + value.lower().strip() if key == "role" else value.lower())
                elif labelled and key == "data-main":
                    label = 1
                elif labelled and key == "data-other":
                    label = 0
            if start in RAW or start in UNREAD:
                if start in RAW:
                    at = _raw_end(page, start, at)
                else:
                    ends = _unread_ends(page, found.start()) if ends is None else ends
                    at = ends.get(found.start(), at)
                add(start, tuple(names), None, 0)
                continue
            add(start, tuple(names), None, label)
            if start not in VOID and not _closed(found.group(3)):
                open_.append(len(tree.tag) - 1)
                standing[start] = standing.get(start, 0) + 1


# --- features and potentials ------------------------------------------------------------------------------------------------


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % FEATURES


_SLOTS: dict[str, int] = {}


def _slots(features: list[str]) -> list[int]:
    for f in features:
        if f not in _SLOTS:
            if len(_SLOTS) > 50_000:
                _SLOTS.clear()
            _SLOTS[f] = _slot(f)
    return [_SLOTS.get(f) if f in _SLOTS else _slot(f) for f in features]


@dataclass
class Forest:
    """Trees side by side: parents, depths, kinds of edge, and the features as (node, slot) pairs."""

    parent: np.ndarray
    depth: np.ndarray
    kind: np.ndarray
    node: np.ndarray
    slot: np.ndarray
    cuts: np.ndarray


# Elements with edge potentials of their own; all others share one.
EDGE_TAGS = "#text #space a article aside b blockquote body button dd div dl dt em figcaption figure footer form h1 h2 h3 h4 h5 h6 head header html i label li main nav ol p pre section span strong table tbody td th tr ul".split()
_KINDS = {tag: k + 1 for k, tag in enumerate(EDGE_TAGS)}


def _kind(tag: str) -> int:
    return _KINDS.get(tag, 0)


# Elements by the part they play; all others are inline.
_ROLE = {
    tag: role
    for role, tags in {
        "text": "#text", "space": "#space", "head": "h1 h2 h3 h4 h5 h6", "line": "p pre blockquote dd figcaption", "list": "ul ol dl li dt", "cell": "table tbody tr td th",
        "box": "#root html body div section article main aside header footer nav form fieldset figure address details dialog center",
    }.items()
    for tag in tags.split()
}
# Texts of so many words are searched for telling words, and texts of so many characters count as long runs.
SHORT_WORDS, LONG_RUN = 14, 60
_SAID = {word: part for part, words in TELLING.items() for word in words}
_WORD = re.compile(r"[^\W\d_]+|©")
_MARK = re.compile(r"[.!?;:](?=\s|$)")


def _size_step(n: int) -> int:
    """0 for nothing, then a step for each doubling up to 2048."""
    return min(n.bit_length(), 12)


def forest_of(trees: list[Tree]) -> Forest:
    parent, depth, kind, node, slot, cuts = [], [], [], [], [], [0]
    for tree in trees:
        base, n = len(parent), len(tree.tag)
        own_depth = [0] * n
        size, linked, marks, runs, start = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        said: list[frozenset | set] = [frozenset()] * n
        in_link = [False] * n
        at = 0
        for i in range(1, n):
            own_depth[i] = own_depth[tree.parent[i]] + 1
            in_link[i] = tree.tag[i] == "a" or in_link[tree.parent[i]]
            start[i] = at
            text = tree.text[i]
            if text is not None and tree.tag[i] == "#text":
                size[i] = len(text)
                marks[i] = len(_MARK.findall(text))
                runs[i] = int(size[i] >= LONG_RUN and not in_link[i])
                at += size[i]
                if size[i] < 200 and text.count(" ") < SHORT_WORDS:
                    found = {_SAID[w] for w in _WORD.findall(text.lower()) if w in _SAID}
                    said[i] = found or said[i]
        for i in range(n - 1, 0, -1):
            up = tree.parent[i]
            if tree.tag[i] == "a":
                linked[i] = size[i]
            size[up] += size[i]
            linked[up] += linked[i]
            marks[up] += marks[i]
            runs[up] += runs[i]
            if said[i]:
                said[up] = said[up] | said[i]
        whole = max(size[0], 1)
        for i in range(n):
            tag = tree.tag[i]
            role = _ROLE.get(tag, "inline")
            features = [f"tag {tag}"]
            if i and tag[0] != "#":
                features.append(f"tag {tag} in {tree.tag[tree.parent[i]]}")
            for name in tree.names[i]:
                if name.startswith("r="):
                    features.append(name)
                else:
                    words = _NAME.findall(name)
                    features += [f"name {w}" for w in words] + [f"name {a} {b}" for a, b in zip(words, words[1:])] + [f"stem {w[:5]}" for w in words if len(w) > 4]
            if size[i]:
                share = min(4, 5 * size[i] // whole)
                if role in ("box", "cell", "list", "line", "head", "text"):
                    features.append(f"size {_size_step(size[i])} {role}")
                    features.append(f"marks {min(4, 250 * marks[i] // size[i])} {role}")
                    features.append(f"place {min(4, 5 * start[i] // whole)} {role}")
                if tag[0] != "#":
                    part = min(3, 4 * linked[i] // size[i])
                    features.append(f"links {part} {tag}")
                    if role in ("box", "cell", "list"):
                        features += [f"runs {min(5, runs[i].bit_length())} {part} {role}", f"share {share} {part} {role}", f"depth {min(4, own_depth[i] // 2)} {role}"]
                elif in_link[i]:
                    features.append("text in link")
                for w in said[i]:
                    features.append(f"said {w} {role} {0 if role == 'text' else share}")
            for s in set(_slots(features)):
                node.append(base + i)
                slot.append(s)
            kind.append(_kind(tag))
        parent += [p + base if p >= 0 else -1 for p in tree.parent]
        depth += own_depth
        cuts.append(len(parent))
    return Forest(*(np.array(x, np.int64) for x in (parent, depth, kind, node, slot, cuts)))


@dataclass
class Model:
    """Weight of each feature for the label main, and log-potentials of (element of child, label of parent, label of child)."""

    weights: np.ndarray
    edges: np.ndarray


def _add(a, axis):
    top = a.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))


def marginals(forest: Forest, model: Model, known: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(probability of the label main for each node, joint probabilities (parent label, child label) for each edge).

    Nodes that are ``known`` to be main are taken as such. Upward messages from the deepest level to the roots, then downward; both in logarithms.
    """
    n = len(forest.parent)
    own = np.zeros((n, 2))
    own[:, 1] = np.bincount(forest.node, weights=model.weights[forest.slot], minlength=n)
    if known:
        own[known, 1] += 60
    edge = model.edges[forest.kind]
    levels = np.argsort(forest.depth, kind="stable")
    borders = np.searchsorted(forest.depth[levels], np.arange(forest.depth.max() + 2 if n else 1))
    up, message = own.copy(), np.zeros((n, 2))
    for d in range(len(borders) - 2, 0, -1):
        rows = levels[borders[d] : borders[d + 1]]
        message[rows] = _add(edge[rows] + up[rows][:, None, :], 2)
        # Nodes of a level are in the order of their parents.
        above = forest.parent[rows]
        first = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
        up[above[first]] += np.add.reduceat(message[rows], first, axis=0)
    down = np.zeros((n, 2))
    joint = np.zeros((n, 2, 2))
    for d in range(1, len(borders) - 1):
        rows = levels[borders[d] : borders[d + 1]]
        above = forest.parent[rows]
        rest = down[above] + up[above] - message[rows]
        both = edge[rows] + rest[:, :, None]
        down[rows] = _add(both, 1)
        both = both + up[rows][:, None, :]
        both -= both.max((1, 2), keepdims=True)
        joint[rows] = np.exp(both)
        joint[rows] /= joint[rows].sum((1, 2), keepdims=True)
    belief = up + down
    return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), joint


@lru_cache(maxsize=2)
def train(n_pages: int = TRAIN_PAGES, steps: int = STEPS, rate: float = RATE, penalty: float = PENALTY) -> Model:
    """The model, trained once a process. Gradient ascent on the likelihood of the labelled pages, with Adam's step sizes and a small quadratic penalty."""
    trees = [parse(p, labelled=True) for p in training_pages(n_pages)]
    forest = forest_of(trees)
    label = np.concatenate([t.label for t in trees])
    inner = np.flatnonzero(forest.parent >= 0)
    there = np.zeros((len(label), 2, 2))
    there[inner, label[forest.parent[inner]], label[inner]] = 1
    model = Model(np.zeros(FEATURES), np.zeros((len(EDGE_TAGS) + 1, 2, 2)))
    values = [model.weights, model.edges]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        probable, joint = marginals(forest, model)
        slope = np.bincount(forest.slot, weights=(label - probable)[forest.node], minlength=FEATURES)
        off = (there - joint)[inner].reshape(-1, 4)
        turn = np.stack([np.bincount(forest.kind[inner], weights=x, minlength=len(EDGE_TAGS) + 1) for x in off.T], 1).reshape(-1, 2, 2)
        for v, g, m, s in zip(values, (slope - penalty * model.weights, turn - penalty * model.edges), first, second):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v += rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


# --- text ---------------------------------------------------------------------------------------------------------------


def _blocks(tree: Tree, main: np.ndarray) -> Iterator[str]:
    """Texts of blocks in page order; a block ends where an element that is not inline begins or ends."""
    block: list[str] = []
    last = -1
    anchor = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        p = tree.parent[i]
        inline = tree.tag[i] in INLINE or tree.tag[i][0] == "#"
        anchor[i] = anchor[p] if inline else i
        if tree.tag[i] == "br":
            block.append(" ")
        if not inline or (tree.tag[i][0] == "#" and anchor[i] != last):
            if block:
                yield "".join(block)
            block, last = [], anchor[i]
        if tree.text[i] is not None and (main[i] or tree.tag[i] == "#space"):
            block.append(entities.unescape(tree.text[i]))
    if block:
        yield "".join(block)


def text_of(tree: Tree, main: np.ndarray) -> str:
    return "\n".join(t for t in (" ".join(b.split()) for b in _blocks(tree, main)) if t)


def _likeliest_run(tree: Tree, probable: np.ndarray, base: int) -> int | None:
    """The likeliest long run of text outside of links, by its place in the forest, where no text is main as yet; else None."""
    best, linked = None, [False] * len(tree.tag)
    for i, text in enumerate(tree.text):
        linked[i] = tree.tag[i] == "a" or (i > 0 and linked[tree.parent[i]])
        if tree.tag[i] == "#text":
            if probable[i] > 0.5:
                return None
            if not linked[i] and len(text) >= LONG_RUN and (best is None or probable[i] > probable[best]):
                best = i
    return None if best is None else base + best


def extract_texts(pages: list[str | None], model: Model) -> list[str]:
    out: list[str] = []
    at = 0
    while at < len(pages):
        trees: list[Tree] = []
        nodes = 0
        while at < len(pages) and nodes < PASSED_NODES:
            trees.append(parse(pages[at] or ""))
            nodes += len(trees[-1].tag)
            at += 1
        forest = forest_of(trees)
        probable = marginals(forest, model)[0]
        # A page with a long run of text has a main text: where none is found, its likeliest run is taken as given.
        given = [g for t, a, b in zip(trees, forest.cuts, forest.cuts[1:]) if (g := _likeliest_run(t, probable[a:b], int(a))) is not None]
        if given:
            probable = marginals(forest, model, given)[0]
        main = probable > 0.5
        out += [text_of(t, main[a:b]) for t, a, b in zip(trees, forest.cuts, forest.cuts[1:])]
    return out


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text`` (main text, blocks joined by line feeds) and ``n_chars``.

    A null or empty page has an empty text. Columns named ``text`` and ``n_chars`` are replaced. No row is moved or dropped.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())
    held = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    html = free_name(pages, "_html")
    asked = pages.select(*held, F.col(html_col).alias(html))
    schema = pages.select(*held).withColumn("text", F.lit("")).schema

    def step(batches):
        for batch in pieces(batches, html):
            texts = extract_texts(batch.column(html).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return asked.mapInArrow(step, schema).withColumn("n_chars", F.char_length("text").cast("bigint"))
