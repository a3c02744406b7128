"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A page is parsed into a tree of elements. For every element the trees give the probability that it
lies in the article, from its tag, its attributes' words, text and link density of its subtree, depth and
what its siblings are like. Decoding finds the most likely labels of the whole tree under one rule: on
the way down, a path may enter the article once and leave it once. So nothing in a part that was cut
out of the article comes back, and no ancestor contradicts a descendant.

The trees learn from the pages themselves: a bounded sample of those that mark their article by a tag
is taught as it is and in versions whose telling tags are replaced and to which menus, sidebars, forms,
notices and comments are added.
"""

from __future__ import annotations

import html
import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import slices

#: Pages that the trees learn from on average, each in VERSIONS versions besides its own.
TRAINING_PAGES = 250
VERSIONS = 4
#: Weight of a page as it is, against one of its versions.
AS_IT_IS = 6.0
TREES, DEPTH, RATE, BINS = 80, 4, 0.25, 32
LEAST_GAIN, SHRINK = 1e-6, 1.0

# ---------------------------------------------------------------- fixed values of the language

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page: of the first up to the page's end if nothing closes them, of the
#: others only if something does.
RAW = frozenset("script style title textarea".split())
UNSHOWN = frozenset("head noscript template iframe select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr "
    "object svg g defs use path rect circle ellipse line polyline polygon text tspan textpath desc symbol "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mfenced mstyle "
    "mspace mpadded mphantom mtable mtr mtd semantics annotation".split()
)
#: A block ends these, however many of their elements are open.
FOREIGN = frozenset(["svg", "math"])
#: A start tag of these ends an open element of the other kind, up to the nearest container.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
BARRIER = frozenset("table ul ol dl body article section div nav form".split())
GROUPS = {
    "article": "article main", "paragraph": "p", "heading": "h1 h2 h3 h4 h5 h6", "box": "div section body center",
    "menu": "nav menu", "header": "header hgroup", "footer": "footer address", "aside": "aside",
    "form": "form input button label fieldset option dialog", "list": "ul ol dl", "item": "li dt dd",
    "table": "table thead tbody tfoot tr td th caption", "link": "a", "quote": "blockquote pre code",
    "figure": "figure figcaption img picture video audio", "inline": "b i em strong span small u s sub sup",
}
GROUP_OF = {tag: k for k, tags in enumerate(GROUPS.values()) for tag in tags.split()}
#: Beginnings of words in class, id and role that tell what an element is for.
WORDS = {
    "content": "article content post entry story text body main",
    "comment": "comment reply replies respon disqus discussion feedback review",
    "menu": "nav menu breadcrumb toc pagination pager tabs topbar",
    "ad": "ad ads advert sponsor promo banner adsense outbrain taboola",
    "side": "side widget related recommend popular trending more rail",
    "edge": "header footer masthead copyright legal bottom logo site",
    "notice": "cookie consent notice alert popup modal newsletter subscribe overlay gdpr",
    "social": "share social follow tweet like author byline tags meta",
    "form": "form login search signup register contact",
}
ROLES = {"navigation": "menu", "banner": "edge", "contentinfo": "edge", "complementary": "side",
         "search": "form", "main": "content", "dialog": "notice"}
WORD_GROUP: list[tuple[str, int]] = sorted(
    ((w, k) for k, ws in enumerate(WORDS.values()) for w in ws.split()), key=lambda x: -len(x[0])
)
ROLE_GROUP = {role: list(WORDS).index(g) for role, g in ROLES.items()}

NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW | UNSHOWN}

# ---------------------------------------------------------------- tree


@dataclass
class Tree:
    """Elements in page order, so that parents come before their children; 0 is the page itself."""

    tag: list[str]
    parent: list[int]
    words: list[int]  # bits of WORDS
    mark: list[int | None]  # the training mark, if the element has one
    own: list[int]  # characters of its own text
    links: list[int]  # of these, in links
    #: In page order: (element, text), or (element, None) where a block begins or ends.
    parts: list[tuple[int, str | None]]


def word_bits(value: str, seen: dict[str, int]) -> int:
    bits = seen.get(value)
    if bits is None:
        bits = 0
        for word in SPLIT.findall(value):
            word = word.lower()
            for begin, k in WORD_GROUP:
                if word == begin or len(begin) > 3 and word.startswith(begin):
                    bits |= 1 << k
                    break
        if len(seen) < 10_000:
            seen[value] = bits
    return bits


_seen: dict[str, int] = {}


class Next:
    """Where a pattern is next found, for places that mostly rise: what was looked through isn't again."""

    def __init__(self, pattern: re.Pattern, page: str) -> None:
        self.pattern, self.page = pattern, page
        self.low, self.found = 0, -1

    def at(self, place: int) -> int:
        """The first place from there on; the page's length if there is none."""
        if not self.low <= place <= self.found:
            match = self.pattern.search(self.page, place)
            self.low, self.found = place, match.start() if match else len(self.page)
        return self.found


class Tags:
    """Ends of a page's tags, in time that follows the page's length also if quotes stay open.

    A quote hides what is in it. A tag whose quote or bracket stays open is no tag. A quote from which no
    end was reached is remembered, so no later tag goes the same way again."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.names, self.specials = Next(NAME_END, page), Next(SPECIAL, page)
        self.last = {c: page.rfind(c) for c in ">'\""}
        self.dead: set[int] = set()

    def end(self, place: int) -> int:
        """The place of the bracket that ends the tag whose attributes begin there, or -1."""
        seen = []
        at = self.specials.at(place) if place <= self.last[">"] else len(self.page)
        while at <= self.last[">"]:
            quote = self.page[at]
            if quote == ">":
                return at
            if at in self.dead or at == self.last[quote]:
                break
            seen.append(at)
            at = self.page.find(quote, at + 1) + 1
            if at > self.last[">"]:
                break
            at = SPECIAL.search(self.page, at).start()
        self.dead.update(seen)
        return -1


def parse(page: str) -> Tree:
    tree = Tree([""], [-1], [0], [None], [0], [0], [])
    open_, at, end = [0], 0, len(page)
    places: dict[str, list[int]] = {}  # of each tag, where its open elements are in open_
    barriers = [0]
    tags, unclosed = Tags(page), set()

    def close(k: int) -> bool:
        """Ends the open elements from the k-th on; whether one of them is a block."""
        block = False
        while len(open_) > k:
            tag = tree.tag[open_.pop()]
            places[tag].pop()
            if tag in BARRIER:
                barriers.pop()
            block |= tag not in INLINE
        return block

    def add_text(text: str) -> None:
        here = open_[-1]
        text = html.unescape(text) if "&" in text else text
        size = len(text) - text.count(" ") if text.isspace() else len(text)
        if text.strip():
            tree.own[here] += size
            tree.links[here] += size if places.get("a") else 0
        tree.parts.append((here, text))

    while at < end:
        if page[at] != "<":
            start, at = at, page.find("<", at)
            at = at if at >= 0 else end
            add_text(page[start:at])
            continue
        if page.startswith("<!--", at):
            stop = page.find("-->", at + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if page.startswith(("<!", "<?"), at) and at < tags.last[">"]:
            at = page.find(">", at) + 1
            continue
        ending = page.startswith("</", at)
        begin = at + 1 + ending
        stop = -1
        if begin < end and page[begin].isascii() and page[begin].isalpha():
            name_end = tags.names.at(begin)
            stop = tags.end(name_end)
        if stop < 0:
            add_text("<")
            at += 1
            continue
        name, attributes = page[begin:name_end].lower(), page[name_end:stop]
        at = stop + 1
        if ending:
            if places.get(name):
                k = places[name][-1]
                if name not in INLINE or barriers[-1] < k:
                    above = tree.parent[open_[k]]
                    if close(k):
                        tree.parts.append((above, None))
            continue
        if name in CLOSE:
            closing = CLOSE[name].search(page, at) if name not in unclosed else None
            if closing:
                if name in UNSHOWN or not attributes.endswith("/"):
                    at = closing.end()
            else:
                unclosed.add(name)
                if name in RAW and not attributes.endswith("/"):
                    at = end
            if closing or name in RAW or name == "head":
                continue
        if name == "html":
            continue
        # What the start tag ends: an open paragraph or formula if it is a block, its own kind if an item.
        block = name not in INLINE
        ends = CLOSED_BY.get(name, frozenset()) | (frozenset(["p"]) if block else frozenset())
        if block and name in GROUP_OF:
            out = min((places[tag][0] for tag in FOREIGN if places.get(tag)), default=0)
            if out > barriers[-1]:
                close(out)
        k = max((places[tag][-1] for tag in ends if places.get(tag)), default=0)
        if k > barriers[-1]:
            close(k)
        parent = open_[-1]
        if name == "br":
            tree.parts.append((parent, " "))
            continue
        if block:
            tree.parts.append((parent, None))
        here = len(tree.tag)
        bits, mark = 0, None
        for a in ATTRIBUTE.finditer(attributes):
            value = a[2] or a[3] or a[4] or ""
            kind = a[1].lower()
            if kind == "data-main":
                mark = int(value == "1")
            else:
                bits |= word_bits(value, _seen)
                if kind == "role" and value.lower() in ROLE_GROUP:
                    bits |= 1 << ROLE_GROUP[value.lower()]
        tree.tag.append(name)
        tree.parent.append(parent)
        tree.words.append(bits)
        tree.mark.append(mark)
        tree.own.append(0)
        tree.links.append(0)
        if name not in VOID and not attributes.endswith("/"):
            places.setdefault(name, []).append(len(open_))
            if name in BARRIER:
                barriers.append(len(open_))
            open_.append(here)
    return tree


# ---------------------------------------------------------------- features


def summed(values: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The sum over each subtree."""
    out = values.astype(float).tolist()
    up = parent.tolist()
    for i in range(len(out) - 1, 0, -1):
        out[up[i]] += out[i]
    return np.array(out)


def features(tree: Tree) -> np.ndarray:
    n = len(tree.tag)
    parent = np.array(tree.parent)
    up = np.maximum(parent, 0)
    group = np.array([GROUP_OF.get(t, len(GROUPS)) for t in tree.tag])
    words = np.array(tree.words)
    own, links = np.array(tree.own, float), np.array(tree.links, float)
    text, linked = summed(own, parent), summed(links, parent)
    tags, paragraphs = summed(np.ones(n), parent), summed(group == 1, parent)
    depth = [0] * n
    above_tags, above_words = [0] * n, [0] * n
    group_list, word_list = group.tolist(), words.tolist()
    for i in range(1, n):
        p = tree.parent[i]
        depth[i] = depth[p] + 1
        above_tags[i] = above_tags[p] | (1 << group_list[p])
        above_words[i] = above_words[p] | word_list[p]
    at = np.arange(n)
    children = np.bincount(up[1:], minlength=n)
    order = np.argsort(up[1:], kind="stable") + 1
    rank = np.zeros(n)
    begin = np.cumsum(children) - children
    rank[order] = np.arange(n - 1) - begin[up[order]]
    siblings = np.maximum(children[up], 1)
    beside = (text[up] - own[up] - text) / np.maximum(siblings - 1, 1)
    same_kind = np.zeros(n)
    pairs, which, count = np.unique(up * 64 + group, return_inverse=True, return_counts=True)
    same_kind = count[which] / siblings
    previous = np.full(n, len(GROUPS))
    previous[order[1:]] = np.where(up[order[1:]] == up[order[:-1]], group[order[:-1]], len(GROUPS))
    link_share = linked / np.maximum(text, 1)
    total = max(text[0], 1.0)
    above_t, above_w = np.array(above_tags), np.array(above_words)
    numeric = np.stack(
        [
            np.log1p(text), np.log1p(own), link_share, text / np.maximum(tags, 1), text / total,
            np.log1p(paragraphs), np.log1p(tags), np.array(depth, float), at / n, np.cumsum(own) / total,
            np.log1p(siblings), rank / siblings, np.log1p(np.maximum(beside, 0)), same_kind,
            text[up] / total, link_share[up], np.log1p(paragraphs[up]), previous,
        ],
        axis=1,
    )
    kinds = [group == k for k in range(len(GROUPS))]
    kinds += [(above_t >> k) & 1 for k in range(len(GROUPS))]
    kinds += [(words >> k) & 1 for k in range(len(WORDS))]
    kinds += [(above_w >> k) & 1 for k in range(len(WORDS))]
    return np.hstack([numeric, np.stack(kinds, axis=1)]).astype(np.float32)


# ---------------------------------------------------------------- boosted trees


@dataclass
class Boosted:
    """Regression trees of equal depth for a logit: at node i, a row goes to 2i + 1 or 2i + 2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Gradient boosting of the weighted logistic loss, with splits at quantiles."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    flat = binned + BINS * np.arange(width)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    logit = np.full(n, base)
    inner = 2**DEPTH - 1
    model = Boosted(base, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1)))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        gradient, curve = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            index = ((node - first)[:, None] * width * BINS + flat).ravel()
            size = count * width * BINS
            g = np.bincount(index, np.repeat(gradient, width), size).reshape(count, width, BINS)
            h = np.bincount(index, np.repeat(curve, width), size).reshape(count, width, BINS)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > LEAST_GAIN and b < len(cuts[f]):
                    model.feature[t, first + k], model.cut[t, first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.cut[t, node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, curve, inner + 1)
        model.leaf[t] = RATE * g / (h + SHRINK)
        logit += model.leaf[t][leaf]
    return model


# ---------------------------------------------------------------- decoding


def decode(tree: Tree, logits: np.ndarray) -> list[bool]:
    """Whether each element is in the article, for the most likely labels of the tree.

    States: before the article, in it, cut out of it. A child is where its parent is or one further, so
    after a cut nothing is taken. Elements with text of their own weigh more."""
    n = len(tree.tag)
    weight = 1 + np.log1p(np.array(tree.own, float))
    yes = (-np.logaddexp(0, -logits) * weight).tolist()
    no = (-np.logaddexp(0, logits) * weight).tolist()
    before, inside, after = no[:], yes[:], no[:]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        before[p] += max(before[i], inside[i])
        inside[p] += max(inside[i], after[i])
        after[p] += after[i]
    state = [0] * n  # the page itself is before the article
    for i in range(1, n):
        s = state[tree.parent[i]]
        if s == 0:
            state[i] = int(inside[i] > before[i])
        elif s == 1:
            state[i] = 1 if inside[i] >= after[i] else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def block_text(tree: Tree, taken: list[bool]) -> str:
    blocks, now = [], []
    for element, text in [*tree.parts, (0, None)]:
        if text is None:
            words = "".join(now).split()
            if words:
                blocks.append(" ".join(words))
            now = []
        elif taken[element]:
            now.append(text)
    return "\n".join(blocks)


def texts(model: Boosted, pages: list[str]) -> list[str]:
    trees = [parse(page) for page in pages]
    rows = [features(tree) for tree in trees]
    if not rows:
        return []
    logits = np.split(model.logits(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
    return [block_text(tree, decode(tree, z)) for tree, z in zip(trees, logits)]


# ---------------------------------------------------------------- training


ARTICLE = re.compile(r"<(article|main)\b", re.I)
PLAIN = ("", "c1", "wrap", "box", "inner", "row", "col")
NAMED = {kind: words.split() for kind, words in WORDS.items()}


def versions(page: str, others: list[str], rng: random.Random) -> Iterator[str]:
    """The page with its article marked, and versions with other tags and further parts around.

    others: texts that may stand in those parts, so that words and lengths don't give them away."""
    marked = ARTICLE.sub(lambda m: f'<{m[1]} data-main="1"', page)
    yield marked

    def attribute(kind: str, shown: float = 0.7) -> str:
        name = rng.choice(NAMED[kind]) if rng.random() < shown else rng.choice(PLAIN)
        return f' {rng.choice(["class", "id"])}="{name}{rng.choice(["", "-1", "_box", " x"])}"' if name else ""

    def prose(most: int) -> str:
        words = rng.choice(others).split()
        start = rng.randrange(max(1, len(words) - most))
        return " ".join(words[start : start + rng.randint(3, most)])

    def menu() -> str:
        items = "".join(f'<li><a href="/x">{prose(4)}</a></li>' for _ in range(rng.randint(3, 9)))
        return f"<ul>{items}</ul>"

    def comments() -> str:
        one = "".join(
            f"<div{attribute('comment')}><b>{prose(3)}</b><p>{prose(40)}</p></div>" for _ in range(rng.randint(1, 5))
        )
        tag = rng.choice(["div", "section", "aside"])
        return f'<{tag}{attribute("comment", 1)} data-main="0"><h3>{prose(4)}</h3>{one}</{tag}>'

    def side() -> str:
        tag = rng.choice(["aside", "div"])
        shown = 0.7 if tag == "aside" else 1
        body = rng.choice([menu(), f"<p>{prose(30)}</p>", f"<h4>{prose(4)}</h4>{menu()}"])
        return f'<{tag}{attribute("side", shown)} data-main="0">{body}</{tag}>'

    def form() -> str:
        return (f'<form{attribute("form", 0.5)} data-main="0"><label>{prose(4)}</label><input name="q">'
                f"<p>{prose(12)}</p><button>{prose(3)}</button></form>")

    def small(kind: str) -> str:
        return f'<div{attribute(kind, 1)} data-main="0"><p>{prose(25)}</p></div>'

    def header() -> str:
        return f'<header{attribute("edge", 0.5)} data-main="0"><div>{prose(5)}</div>{menu()}</header>'

    parts = (comments, side, form, header, lambda: small("notice"), lambda: small("ad"), lambda: small("social"))
    def content() -> str:
        """Something else than a paragraph that articles have."""
        items = [prose(15) for _ in range(rng.randint(1, 5))]
        row = "".join(f"<td>{item}</td>" for item in items)
        return rng.choice(
            [
                "<ul>" + "".join(f"<li>{item}</li>" for item in items) + "</ul>",
                "<ol>" + "".join(f"<li><a href=/y>{item}</a> {prose(9)}</li>" for item in items) + "</ol>",
                f"<blockquote>{prose(30)}</blockquote>",
                f"<blockquote><p>{prose(30)}</p></blockquote>",
                f"<h2>{prose(6)}</h2>",
                f"<h3>{prose(6)}</h3><p>{prose(30)}</p>",
                f"<pre>{prose(20)}</pre>",
                f"<table><tr>{row}</tr><tr>{row}</tr></table>",
                f"<div><p>{prose(40)}</p><p>{prose(20)}</p></div>",
                f"<figure><img src=a><figcaption>{prose(9)}</figcaption></figure>",
                f'<p>{prose(9)} <a href="/z">{prose(4)}</a> {prose(20)}</p>',
            ]
        )

    for _ in range(VERSIONS):
        out = marked
        start = ARTICLE.search(out).start()
        body = out.find(">", start) + 1
        end = re.search(r"</(article|main)>|\Z", out[body:]).start() + body
        blocks = re.split(r"(?=<p[\s>])", out[body:end])
        if len(blocks) > 3 and rng.random() < 0.3:
            blocks = blocks[: rng.randint(2, len(blocks))]
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            blocks.insert(rng.randint(1, len(blocks)), content())
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            blocks.insert(rng.randint(1, len(blocks)), rng.choice(parts)())
        inner = "".join(blocks)
        name = rng.choice(["article", "main", "div", "div", "section"])
        own = attribute("content", 0.6) if name in ("div", "section") else ""
        whole = f'<{name}{own} data-main="1">{inner}</{name}>'
        around = [rng.choice(parts)() for _ in range(rng.choice([0, 0, 1, 2]))]
        around.insert(rng.randint(0, len(around)), whole)
        for _ in range(rng.choice([0, 0, 1, 2])):
            around = [f"<div{attribute('content', 0.2)}>{''.join(around)}</div>"]
        head, tail = out[:start], out[end:]
        tail = re.sub(r"^</(article|main)>", "", tail)
        for tag, kind in (("nav", "menu"), ("footer", "edge"), ("header", "edge"), ("aside", "side")):
            if rng.random() < 0.5:
                head, tail = (
                    re.sub(rf"<{tag}(?=[\s>])", f"<div{attribute(kind, 1)}", x).replace(f"</{tag}>", "</div>")
                    for x in (head, tail)
                )
        front = "".join(rng.choice(parts)() for _ in range(rng.randint(0, 2)))
        back = "".join(rng.choice(parts)() for _ in range(rng.randint(0, 3)))
        yield head + front + "".join(around) + back + tail


def marks(tree: Tree) -> np.ndarray:
    """The label of each element: its own mark, or that of the nearest ancestor that has one."""
    label = [0] * len(tree.tag)
    for i in range(1, len(label)):
        above = label[tree.parent[i]]
        label[i] = above if tree.mark[i] is None else tree.mark[i]
        # Parts of an article that by their tag are something else
        if tree.mark[i] is None and tree.tag[i] in ("nav", "aside", "form", "footer"):
            label[i] = 0
    return np.array(label, float)


def fit(pages: list[str]) -> Boosted:
    rng = random.Random(7)
    good = [p for p in pages if ARTICLE.search(p)]
    others = [w for p in pages for w in [re.sub(r"<[^>]*>", " ", p)] if w.strip()] or ["text"]
    trees, weights = [], []
    for page in good:
        for k, version in enumerate(versions(page, others, rng)):
            trees.append(parse(version))
            weights.append(np.full(len(trees[-1].tag), 1.0 if k else AS_IT_IS))
    if not trees:
        # Nothing shows an article: long text with few links is taken.
        trees = [parse(page) for page in pages]
        rows = [features(t) for t in trees]
        y = np.concatenate([((r[:, 0] > 4.5) & (r[:, 2] < 0.3)).astype(float) for r in rows]) if rows else np.zeros(1)
        x = np.concatenate(rows) if rows else np.zeros((1, features(parse("")).shape[1]), np.float32)
        return boost(x, y, np.ones(len(y)))
    x = np.concatenate([features(t) for t in trees])
    return boost(x, np.concatenate([marks(t) for t in trees]), np.concatenate(weights))


def train(pages: DataFrame, column: str = "html", rows: int = TRAINING_PAGES) -> Boosted:
    """Trees from a random sample of about `rows` pages. One task fits them; the driver gets the trees.

    The sample goes by a hash of the page, so it is the same in each run; of equal pages, all or none
    are drawn, and one is used."""
    known = pages.select(F.col(column).alias("html")).filter("html is not null")
    n = known.count()
    drawn = F.pmod(F.xxhash64("html", F.lit("train")), F.lit(1 << 30)) < min(1.0, rows / max(1, n)) * (1 << 30)
    sample = known.filter(drawn).distinct().repartition(1)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(page for b in batches for page in b.column(0).to_pylist())
        yield pa.record_batch([pa.array([pickle.dumps(fit(found))], pa.binary())], ["model"])

    row = sample.mapInArrow(fitted, "model binary").first()
    return pickle.loads(row["model"]) if row else fit([])


def extract(pages: DataFrame, model: Boosted, column: str = "html") -> DataFrame:
    """pages with text and n_chars (code points); columns of these names are replaced.

    text has the blocks of the article in page order, one to a line: entities decoded, white space of any
    kind within a block as one blank; empty if there is none, as for null and empty pages. Broken or cut
    pages are parsed as far as they go. Repeated rows get equal results, further columns do no harm, an
    empty table stays empty.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def main_text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in columns:
            out = []
            for part in slices(column, 1 << 20):
                out += texts(own, [page or "" for page in part.to_pylist()])
            yield pa.array(out, pa.string())

    rows = pages.withColumn("text", main_text(F.col(column)))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
