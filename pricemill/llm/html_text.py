"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Nodes are the block elements and the text blocks of a page, each content or not.  A node has a unary potential, a
logistic regression on its features (tag, kinds of words in class and id, length, share of link text, punctuation), and
each parent-child pair a potential learned from how often labels meet.  Sum-product messages go from the leaves up and
from the root down; the marginals that result are exact, as the graph is a tree.  Text blocks with a marginal of
one half or more are content.

Both potentials are fitted on labelled pages: a sample of at most ``SAMPLE`` pages whose elements name their role
(article and main against nav, header, footer, aside, form ...), and the labelled layouts below, which cover roles that
a sample may lack and pages that say them in class names only.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 120  # pages in the fit, at most
LAYOUT_COPIES = 8

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe xmp noembed noframes".split())  # without an end tag, the rest of the page is theirs
SKIPPED = set("noscript template svg math select button object canvas".split())  # without an end tag, they are passed over
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output progress q "
    "rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SAME_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
# Words in class, id and role that tell what an element is for.
ROLES = {
    "main": "article articlebody body content entry main mainbody maintext post posttext prose story text",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination tabs toc toolbar",
    "head": "banner header masthead topbar",
    "foot": "colophon copyright credits footer legal",
    "side": "aside complementary related recommended sidebar widget widgets",
    "notice": "alert consent cookie cookies gdpr message modal notice notification overlay popup toast",
    "advert": "ad ads adsense advert advertisement adverts banner-ad promo promotion promoted sponsor sponsored",
    "form": "form login newsletter search searchform signup subscribe subscription",
    "talk": "comment comments commentlist disqus discussion feedback replies reply respond response responses",
    "share": "share sharing social tags",
}
ROLE_OF = {word: role for role, words in ROLES.items() for word in words.split()}
TAG_ROLES = {
    "article": "main", "main": "main", "nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side",
    "form": "form", "fieldset": "form", "dialog": "notice",
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^\"'>]++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
END_TAGS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW | SKIPPED}
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden|data-label)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+(?:-ad)?", re.I)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Tree:
    """Parents come before children.  Node 0 is the page; a text block has a text, an element has None."""

    def __init__(self):
        self.parent, self.tag, self.roles, self.text, self.linked, self.label = [-1], ["#page"], [()], [None], [0], [None]

    def add(self, parent: int, tag: str, roles: tuple = (), text: str | None = None, linked: int = 0, label=None) -> int:
        for column, value in zip(
            (self.parent, self.tag, self.roles, self.text, self.linked, self.label),
            (parent, tag, roles, text, linked, label), strict=True,
        ):
            column.append(value)
        return len(self.parent) - 1


def _roles(tag: str, attrs: str) -> tuple[tuple, str | None]:
    """Kinds of the element (with hid for a hidden one) and its data-label."""
    found, label = {TAG_ROLES[tag]} if tag in TAG_ROLES else set(), None
    if attrs.strip(" /"):
        for m in ATTRIBUTE.finditer(attrs):
            name, value = m[1].lower(), next((x for x in m.groups()[1:] if x is not None), "")
            if name in ("class", "id", "role"):
                for word in WORDS.findall(HUMP.sub(" ", value)):
                    if word.lower() in ROLE_OF:
                        found.add(ROLE_OF[word.lower()])
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                found.add("hid")
            elif name == "data-label":
                label = value
    return tuple(sorted(found)), label


def parse(page: str) -> Tree:
    """The block elements and text blocks of a page, as a browser would nest them in the usual cases."""
    tree = Tree()
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements; inline ones have their block's node
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                tree.add(stack[-1][1], "#text", (), text, linked)
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal links
        for tag, _ in stack[upto:]:
            links -= tag == "a"
        del stack[upto:]

    def said(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links > 0:
                linked += len(text)

    at = 0
    unended: set[str] = set()  # elements that no end tag follows
    while m := TOKEN.search(page, at):
        said(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, attrs = tag.lower(), m["attrs"] or m["attrs2"] or ""
        if tag == "head":  # may lack an end tag; what it holds is no text
            flush()
            continue
        if m["end"] or m["end2"]:
            i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), None)
            if tag not in INLINE:
                flush()
            if i is not None:
                if tag in INLINE and any(t not in INLINE for t, _ in stack[i + 1 :]):
                    if tag == "a":  # an inline end tag does not close the blocks inside
                        links -= 1
                        stack[i] = ("#closed", stack[i][1])
                    continue
                close(i)
            continue
        if tag in RAW or tag in SKIPPED:
            if tag not in ("button", "svg", "math", "select"):
                flush()
            if tag not in unended and not (tag in ("svg", "math") and attrs.rstrip().endswith("/")):
                if end := END_TAGS[tag].search(page, at):
                    at = end.start()
                elif tag in RAW:
                    at = len(page)
                else:
                    unended.add(tag)
            continue
        if tag in VOID:
            if tag == "br":
                said(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
            links += tag == "a"
            continue
        flush()
        if tag in CLOSES_P or tag in SAME_CLOSES:
            ending = ({"p"} if tag in CLOSES_P else set()) | SAME_CLOSES.get(tag, set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ending:
                    close(i)
                    break
                if stack[i][0] not in INLINE and stack[i][0] not in ("tr", "td", "th", "tbody", "thead"):
                    break
        roles, label = _roles(tag, attrs)
        stack.append((tag, tree.add(stack[-1][1], tag, roles, None, 0, label)))
    said(page[at:])
    flush()
    return tree


# model -----------------------------------------------------------------------------------------------------------------


def features(tree: Tree, i: int) -> list[str]:
    tag, roles, parent = tree.tag[i], tree.roles[i], tree.parent[i]
    out = ["bias:text" if tag == "#text" else "bias:block"]
    if tag == "#text":
        text, n = tree.text[i], len(tree.text[i])
        out += [
            f"length:{min(6, int(math.log2(n + 1)) // 2)}", f"links:{min(3, 4 * tree.linked[i] // (n + 1))}",
            f"end:{text[-1] in '.!?'}", f"sign:{text[0] in '©®™|›»•'}", f"in:{tree.tag[parent]}",
        ]
    else:
        out += [f"tag:{tag}", *(f"role:{r}" for r in roles), f"roles:{bool(roles)}"]
    return out


class Model:
    """``weights`` by feature: log odds of content; ``pair[a][b]``: log potential of a parent with label a and child b."""

    def __init__(self, weights: dict[str, float], pair: list[list[float]]):
        self.weights, self.pair = weights, pair
        self._blocks: dict[tuple, float] = {}  # scores of elements, which depend on tag and roles alone

    def unary(self, tree: Tree) -> list[float]:
        out = [0.0] * len(tree.parent)
        for i in range(1, len(out)):
            key = (tree.tag[i], tree.roles[i]) if tree.text[i] is None else None
            score = self._blocks.get(key)
            if score is None:
                score = sum(self.weights.get(f, 0.0) for f in features(tree, i))
                if key:
                    self._blocks[key] = score
            out[i] = score
        return out

    def marginals(self, tree: Tree) -> list[float]:
        """Probability of content of each node, by messages from the leaves up and from the root down."""
        n, parent = len(tree.parent), tree.parent
        (p00, p01), (p10, p11) = self.pair
        up0, up1 = [0.0] * n, self.unary(tree)  # log beliefs from below
        up1[0] = -30.0  # the page itself is not content
        sent0, sent1 = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            sent0[i], sent1[i] = _log_add(p00 + up0[i], p01 + up1[i]), _log_add(p10 + up0[i], p11 + up1[i])
            up0[parent[i]] += sent0[i]
            up1[parent[i]] += sent1[i]
        out = [_share(up0[0], up1[0])] + [0.0] * (n - 1)
        down0, down1 = [0.0] * n, [0.0] * n
        for i in range(1, n):
            above0 = up0[parent[i]] + down0[parent[i]] - sent0[i]
            above1 = up1[parent[i]] + down1[parent[i]] - sent1[i]
            down0[i], down1[i] = _log_add(p00 + above0, p10 + above1), _log_add(p01 + above0, p11 + above1)
            out[i] = _share(up0[i] + down0[i], up1[i] + down1[i])
        return out

    def extract(self, page: str | None) -> str:
        tree = parse(page or "")
        likely = self.marginals(tree)
        return " ".join(t for t, p in zip(tree.text, likely, strict=True) if t is not None and p >= 0.5)


def _log_add(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


def _share(a: float, b: float) -> float:
    return 1.0 / (1.0 + math.exp(min(700.0, a - b)))


# Labelled layouts: m marks content, x marks anything else; LONG and SHORT stand for prose and a few words.
LAYOUTS = """
<body><header data-label=x><p>SHORT</p><nav><ul><li><a href=/>SHORT</a><li><a href=/>SHORT</a></ul></nav></header><main data-label=m><h1>SHORT</h1><p>LONG</p><p>SHORT</p><h2>SHORT</h2><ul><li>SHORT<li>SHORT</ul><blockquote><p>LONG</p></blockquote></main><aside data-label=x><h3>SHORT</h3><p>LONG</p></aside><footer data-label=x><p>© SHORT</p></footer></body>
<body><div id=masthead data-label=x>SHORT</div><div class="cookie-notice" data-label=x><p>LONG</p><button>x</button></div><div class=wrapper><div class="post-content" data-label=m><h1>SHORT</h1><p>LONG</p><p>LONG</p><p>SHORT</p><table><tr><td>SHORT<td>SHORT</table></div><div class=sidebar data-label=x><ul><li><a href=/>SHORT</a></ul><p>LONG</p></div></div><div class="comments" data-label=x><h3>SHORT</h3><div class=comment><p>LONG</p></div><div class=comment><p>LONG</p></div></div><div id=footer data-label=x>© SHORT</div></body>
<body><article data-label=m><header data-label=x><p>SHORT</p></header><h1>SHORT</h1><p>LONG</p><div class=ad data-label=x>LONG</div><p>LONG</p><figure><figcaption>SHORT</figcaption></figure><aside data-label=x><p>LONG</p></aside><p>SHORT</p><form data-label=x><p>SHORT</p><label>SHORT</label></form><section class=comments data-label=x><h2>SHORT</h2><p>LONG</p><p>LONG</p></section><footer data-label=x>SHORT</footer></article><div class="newsletter" data-label=x><p>LONG</p></div></body>
<body><div class="alert" data-label=x>LONG</div><nav data-label=x><a href=/>SHORT</a> <a href=/>SHORT</a></nav><div><div data-label=m><h1>SHORT</h1><p>LONG</p><p>LONG</p><pre>LONG</pre><ol><li>LONG<li>SHORT</ol></div></div><div class="related" data-label=x><a href=/>SHORT</a><a href=/>SHORT</a></div><div class="social share" data-label=x><a href=/>SHORT</a></div></body>
<body><div class=navbar data-label=x><ul><li><a href=/>SHORT</a></ul></div><section id=content data-label=m><div><h2>SHORT</h2><p>LONG</p><div class=promo data-label=x><p>LONG</p></div><p>LONG</p><div class=advert data-label=x>SHORT</div><dl><dt>SHORT<dd>LONG</dl></div></section><ul class=commentlist data-label=x><li><p>LONG</p><li><p>SHORT</p></ul><div role=banner data-label=x>SHORT</div></body>
""".strip().split("\n")
PROSE = "One of the long texts that a reader comes for, in plain words, with some commas and an end. " * 3


def label_layouts() -> list[tuple[Tree, list[int]]]:
    """The layouts with a label for each node: that of the nearest labelled element around it."""
    out = []
    for layout in LAYOUTS:
        tree = parse(layout.replace("LONG", PROSE).replace("SHORT", "A few words"))
        labels = [0] * len(tree.parent)
        for i in range(1, len(labels)):
            labels[i] = labels[tree.parent[i]] if tree.label[i] is None else int(tree.label[i] == "m")
        out.append((tree, labels))
    return out


def label_by_role(tree: Tree) -> list[int] | None:
    """Labels of a page whose elements name their role; None if no element is an article or main."""
    labels, seen = [0] * len(tree.parent), False
    for i in range(1, len(labels)):
        inherited, roles = labels[tree.parent[i]], set(tree.roles[i])
        if tree.tag[i] in ("article", "main"):
            labels[i], seen = 1, True
        else:
            labels[i] = 0 if roles - {"main"} else inherited
    return labels if seen else None


def fit(pages: list[tuple[Tree, list[int]]], steps: int = 500, rate: float = 0.3, penalty: float = 1e-4) -> Model:
    """Weights and pair potentials with the largest likelihood of the labels.

    The gradient is what the messages expect less what the labels show, for features and pairs alike.  The messages of
    all trees are passed together, one depth after the other.
    """
    index: dict[str, int] = {}
    node: list[int] = []
    column: list[int] = []
    parent: list[int] = []
    depth: list[int] = []
    label: list[int] = []
    for tree, labels in pages:
        first = len(parent)
        for i, p in enumerate(tree.parent):
            parent.append(first + p if i else -1)
            depth.append(depth[first + p] + 1 if i else 0)
            label.append(labels[i])
            for f in features(tree, i) if i else ():
                node.append(first + i)
                column.append(index.setdefault(f, len(index)))
    up, y, at = np.array(parent), np.array(label), np.array(depth)
    n, c = np.array(node, int), np.array(column, int)
    levels = [np.flatnonzero(at == d) for d in range(at.max() + 1)]
    below = np.flatnonzero(at > 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[up[below]], y[below]), 1)
    w, pair = np.zeros(len(index)), np.zeros((2, 2))
    square, pair_square = np.zeros(len(index)), np.zeros((2, 2))
    for _ in range(steps):
        belief, sent, down = np.zeros((len(y), 2)), np.zeros((len(y), 2)), np.zeros((len(y), 2))
        belief[:, 1] = np.bincount(n, w[c], len(y))
        belief[levels[0], 1] = -30.0
        for level in levels[:0:-1]:
            sent[level] = np.logaddexp(pair[:, 0] + belief[level, :1], pair[:, 1] + belief[level, 1:])
            np.add.at(belief, up[level], sent[level])
        above = np.zeros((len(y), 2))
        for level in levels[1:]:
            above[level] = belief[up[level]] + down[up[level]] - sent[level]
            down[level] = np.logaddexp(pair[0] + above[level, :1], pair[1] + above[level, 1:])
        both = above[below, :, None] + pair + belief[below, None, :]
        both = np.exp(both - both.max((1, 2), keepdims=True))
        both /= both.sum((1, 2), keepdims=True)
        likely = np.zeros(len(y))
        likely[below] = both[:, :, 1].sum(1)
        g = np.bincount(c, (likely - y)[n], len(w)) / len(below) + penalty * w
        g_pair = (both.sum(0) - seen) / len(below) + penalty * pair
        square += g * g
        pair_square += g_pair * g_pair
        w -= rate * g / np.sqrt(square + 1e-12)
        pair -= rate * g_pair / np.sqrt(pair_square + 1e-12)
    return Model({f: float(w[i]) for f, i in index.items()}, pair.tolist())


def train(pages: DataFrame) -> Model:
    """Fit on the first SAMPLE pages by the hash of page_id and on the layouts."""
    keyed = pages.where(F.col("html").isNotNull()).select(
        F.xxhash64("page_id").alias("place"), "page_id", F.xxhash64("html").alias("content"), "html")
    order = ["place", "page_id", "content"]
    picked = [tuple(r) for r in keyed.select(*order).orderBy(*order).limit(SAMPLE).collect()]
    if not picked:
        return fit(label_layouts() * LAYOUT_COPIES)
    # only then their texts are read, once for rows that repeat
    chosen = keyed.where(F.struct("place", "content").isin([F.struct(F.lit(p).cast("long"), F.lit(c).cast("long")) for p, _, c in dict.fromkeys(picked)]))
    html = {tuple(r)[:3]: r["html"] for r in chosen.groupBy(*order).agg(F.min("html").alias("html")).collect()}
    labelled = [(t, l) for t in (parse(html[key]) for key in picked) if (l := label_by_role(t))]
    return fit(labelled + label_layouts() * LAYOUT_COPIES)


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of every row of ``pages(page_id, url, html)``.

    Text blocks have their character references decoded and white space turned into single spaces, and are joined in
    page order by a space.  A null or empty html, and a page without content, gives the empty text.  Repeated rows are
    treated alike; an empty table gives an empty result; further columns of ``pages`` are ignored.
    """
    model = train(pages)
    weights, pair = model.weights, model.pair  # by feature: bounded by the sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(weights, pair)
        for batch in batches:
            texts = [fitted.extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
