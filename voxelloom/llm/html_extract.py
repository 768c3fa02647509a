"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded over the tree.

A page is parsed into blocks (elements that aren't inline, and runs of loose text beside them). Each block has features of its subtree (text, links, tags,
punctuation), its attribute tokens and those above it, its depth and place, and its siblings. The trees score whether a block is article text. Decoding then chooses for each
block keep, drop or mixed so that the scores' sum is largest, where everything below a kept block is kept and everything below
a dropped one dropped: no block contradicts an ancestor.

The trees are fitted on the driver on TRAIN_PAGES generated pages of many layouts whose parts are known (training_page); the number is fixed,
so it doesn't grow with the data. Extraction reads each page once, without a shuffle.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page order by one space. Scripts, styles,
templates, form controls and markup never count. Elements that no list here names are inline, as in browsers; pictures inside a word don't part it. Cases: an empty table gives no rows; a null or empty
page has the empty text; broken markup is read as browsers do in the common cases (unclosed heads, paragraphs and items, stray end tags); pages may be of any length and nesting of any depth,
in time linear in the page; of choices with equal sums, dropping comes before mixing, keeping only where it beats dropping; repeated rows get equal texts; extra columns are kept; those named text or n_chars are replaced.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, columns, ddl, others, texts

TRAIN_PAGES, ROUNDS, DEPTH, RATE, BINS = 500, 60, 4, 0.25, 32
#: A mixed container counts as so much of its own score's size; the rest favours one choice for all below it.
MIXED = 0.8

# Fixed sets of HTML: elements without content, elements whose text is never page text, and what an opening element closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("script style noscript template head title button select option textarea iframe svg canvas object audio video datalist input".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base bgsound basefont link meta title style script noscript template noframes head html".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that are blocks; all others are inline.
BLOCK = ENDS_P | frozenset(CLOSES) - {"option"} | frozenset("thead caption center dir hgroup search summary legend body html".split())

TAGS = "nav header footer aside article main section div p h1 h2 h3 ul ol li table td form blockquote pre figure dl dd address".split()
#: Elements for what stands beside an article.
BESIDE = frozenset("nav header footer aside form".split())
#: Attribute tokens that name boilerplate, and those that name articles.
AGAINST = frozenset("nav navigation navbar menu sidebar side footer foot header masthead topbar top ad ads advert advertisement adverts banner promo promotion sponsor sponsored comment comments commentlist reply replies disqus discussion cookie cookies notice consent gdpr alert popup modal overlay subscribe newsletter signup share sharing social follow related recommended more trending popular widget breadcrumb breadcrumbs pagination pager login search toolbar copyright legal disclaimer tags tagcloud links blogroll".split())
FOR = frozenset("article articlebody content main post postbody entry story body text prose page maincontent".split())
_TOKEN, _SPACE = re.compile(r"[a-z]+"), re.compile(r"\s+")


class Block:
    __slots__ = ("tag", "tokens", "parent", "children", "parts", "depth", "n_tags", "linked", "label", "chars", "words", "links", "marks", "tags", "digits")

    def __init__(self, tag: str, tokens: frozenset, parent: Block | None, label: int | None = None):
        self.tag, self.tokens, self.parent, self.label = tag, tokens, parent, label
        self.children: list[Block] = []
        self.parts: list[str] = []
        self.depth = parent.depth + 1 if parent else 0
        self.n_tags = self.linked = 0

    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.parts)).strip()


class Reader(HTMLParser):
    """Builds the tree of blocks of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Block("body", frozenset(), None)
        self.stack: list[tuple[str, Block | None]] = [("#root", self.root)]
        self.open = [self.root]
        # How many elements of a name are open, and of inline ones how many inside each open block.
        self.count, self.inside = Counter(), [Counter()]
        self.never = self.in_link = 0
        self.loose: Block | None = None

    def block(self) -> Block:
        return self.open[-1]

    def _pop(self, n: int) -> None:
        while len(self.stack) > n:
            tag, b = self.stack.pop()
            self.never -= tag in NEVER
            self.in_link -= tag == "a"
            self.count[tag] -= 1
            if b is not None:
                self.open.pop()
                self.inside.pop()
                self.loose = None
            else:
                self.inside[-1][tag] -= 1

    def _push(self, tag: str, b: Block | None) -> None:
        self.stack.append((tag, b))
        self.count[tag] += 1
        if b is None:
            self.inside[-1][tag] += 1
        else:
            self.open.append(b)
            self.inside.append(Counter())

    def _end_head(self) -> None:
        """Close a head without an end tag, where nothing is open in it."""
        if self.stack[-1][0] == "head":
            self._pop(len(self.stack) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag in ("html", "body"):
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self._add(" ")
            return
        if tag in ENDS_P or tag in CLOSES:
            shut, until = CLOSES.get(tag, ({"p"}, {"#root"}))
            for at in range(len(self.stack) - 1, 0, -1) if any(self.count[x] for x in shut) else ():
                here = self.stack[at][0]
                if here in shut:
                    self._pop(at)
                    if tag not in ("tr", "tbody", "tfoot") or not any(self.count[x] for x in shut):
                        break
                elif here in until or (shut == {"p"} and (here in BLOCK or here in NEVER)):
                    break
        self.never += tag in NEVER
        self.in_link += tag == "a"
        if tag not in BLOCK:
            self._push(tag, None)
            self.block().n_tags += 1
            return
        a = {k: v or "" for k, v in attrs}
        tokens = frozenset(_TOKEN.findall(" ".join(a.get(k, "") for k in ("class", "id", "role", "itemprop")).lower()))
        up = self.block()
        b = Block(tag, tokens, up, int(a["data-y"]) if "data-y" in a else None)
        up.children.append(b)
        self.loose = None
        self._push(tag, b)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.count[tag]:
            return self._add(" ") if tag in ("br", "p") else None
        # The end of an inline element reaches no farther than its block.
        if tag not in BLOCK and tag not in NEVER and not self.inside[-1][tag]:
            return None
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            at -= 1
        return self._pop(at)

    def _add(self, data: str) -> None:
        if self.never or not data:
            return
        b = self.block()
        if b.children:
            # Text beside block children gets a block of its own, so that page order holds.
            if self.loose is None or self.loose.parent is not b:
                if data.isspace():
                    return
                self.loose = Block("#text", b.tokens, b)
                b.children.append(self.loose)
            b = self.loose
        b.parts.append(data)
        if self.in_link:
            b.linked += len(data.strip())

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self._end_head()
        self._add(data)


def _lift(b: Block) -> None:
    """A block's own text that came before its first child becomes the first child."""
    if b.children and b.parts:
        first = Block("#text", b.tokens, b)
        first.parts, first.linked, b.parts, b.linked = b.parts, b.linked, [], 0
        if not "".join(first.parts).isspace():
            b.children.insert(0, first)


def parse(page: str) -> list[Block]:
    """The blocks of a page, each before its children; the root first."""
    r = Reader()
    r.feed(page)
    r.close()
    out, stack = [], [r.root]
    while stack:
        b = stack.pop()
        _lift(b)
        out.append(b)
        stack.extend(reversed(b.children))
    return out


_MARKS, _DIGITS = re.compile(r"[.,;:!?]"), re.compile(r"[0-9]")


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block."""
    for b in reversed(blocks):
        t = "".join(b.parts)
        b.chars, b.words, b.links, b.marks, b.tags, b.digits = len(t), len(t.split()), b.linked, len(_MARKS.findall(t)), 1 + b.n_tags, len(_DIGITS.findall(t))
        for c in b.children:
            b.chars, b.words, b.links, b.marks, b.tags, b.digits = b.chars + c.chars, b.words + c.words, b.links + c.links, b.marks + c.marks, b.tags + c.tags, b.digits + c.digits
    total = max(1, blocks[0].chars)
    rows, above, before = [], {}, 0
    # Sums over the children of each block; the root is its own only sibling.
    together: dict[int, tuple[int, int, int, Counter]] = {0: (blocks[0].chars, blocks[0].links, 1, Counter([blocks[0].tag]))}
    for b in blocks:
        if kids := b.children:
            together[id(b)] = (sum(c.chars for c in kids), sum(c.links for c in kids), len(kids), Counter(c.tag for c in kids))
    for b in blocks:
        up = b.parent
        own_for, own_against = len(b.tokens & FOR), len(b.tokens & AGAINST)
        u = above[id(up)] if up else (0, 0, 0, 0)
        above[id(b)] = (u[0] + own_for, u[1] + own_against, u[2] or b.tag in ("article", "main"), u[3] or b.tag in BESIDE)
        sib_chars, sib_links, n_sib, sib_tags = together[id(up) if up else 0]
        rows.append(
            [
                own_for, own_against, b.tag in BESIDE, *u, b.depth, len(b.children), math.log1p(b.chars), math.log1p(b.words), b.links / max(1, b.chars), b.tags / max(1, b.words),
                b.marks / max(1, b.words), b.chars / total, b.digits / max(1, b.chars), b.words / max(1, len(b.children)), before / total, n_sib, b.chars / max(1, sib_chars),
                sib_links / max(1, sib_chars), math.log1p(sib_chars / n_sib), sib_tags[b.tag] / n_sib, *(b.tag == t for t in TAGS),
            ]
        )
        before += len("".join(b.parts))
    return np.array(rows, float)


class Boosted:
    """Gradient-boosted regression trees on the logistic loss, over binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        q, n = self._bins(x), len(y)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        self.feature, self.cut, self.value = [], [], []
        z = np.full(n, self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, BINS, np.int64)
            for level in range(depth):
                first, width = (1 << level) - 1, 1 << level
                best, gain0 = np.full(width, 1e-6), None
                for f in range(x.shape[1]):
                    at = (node - first) * (BINS + 1) + q[:, f]
                    sg = np.bincount(at, g, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                    sh = np.bincount(at, h, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                    tg, th = sg[:, -1:], sh[:, -1:]
                    if gain0 is None:
                        gain0 = (tg**2 / (th + 1.0))[:, 0]
                    gain = sg**2 / (sh + 1.0) + (tg - sg) ** 2 / (th - sh + 1.0) - gain0[:, None]
                    gain[(sh < 2) | (th - sh < 2)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + width][better], cut[first : first + width][better] = f, k[better]
                node = 2 * node + 1 + (q[np.arange(n), feature[node]] > cut[node])
            leaf = node - ((1 << depth) - 1)
            value = rate * np.bincount(leaf, g, 1 << depth) / (np.bincount(leaf, h, 1 << depth) + 1.0)
            z += value[leaf]
            self.feature.append(feature)
            self.cut.append(cut)
            self.value.append(value)
        self.depth = depth

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        q, rows = self._bins(x), np.arange(len(x))
        z = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (q[rows, feature[node]] > cut[node])
            z += value[node - ((1 << self.depth) - 1)]
        return z


def decode(blocks: list[Block], logit: np.ndarray) -> list[bool]:
    """Whether each block's own text is kept, under the choice of the largest sum."""
    at = {id(b): i for i, b in enumerate(blocks)}
    keep, drop, best = ([0.0] * len(blocks) for _ in range(3))
    for i in range(len(blocks) - 1, -1, -1):
        kids = [at[id(c)] for c in blocks[i].children]
        s = float(np.clip(logit[i], -6, 6)) if i else 0.0  # the whole page's score says nothing
        keep[i], drop[i] = s + sum(keep[k] for k in kids), -s + sum(drop[k] for k in kids)
        mixed = MIXED * abs(s) + sum(best[k] for k in kids) if kids else -math.inf
        best[i] = max(keep[i], drop[i], mixed)
    out = [False] * len(blocks)
    forced: list[bool | None] = [None] * len(blocks)
    for i, b in enumerate(blocks):
        choice = forced[i]
        if choice is None:
            choice = True if best[i] == keep[i] > drop[i] else False if best[i] == drop[i] else None
        out[i] = bool(choice)
        for c in b.children:
            forced[at[id(c)]] = choice
    return out


def _words(rng: random.Random, n: int) -> str:
    made = []
    for i in range(n):
        w = "".join(rng.choice("etaoinshrdlucmfwypvbg") for _ in range(rng.randint(2, 9)))
        made.append(w.capitalize() if i == 0 or made[-1][-1] == "." else w + rng.choice(["", "", "", "", "", ",", "."]))
    return " ".join(made) + "."


def training_page(rng: random.Random) -> str:
    """A page of a random layout; data-y marks what is article text (1) and what isn't (0)."""
    hint = rng.random() < 0.6

    def el(tag: str, inner: str, y: int | None = None, names: tuple[str, ...] = ()) -> str:
        a = f' {rng.choice(["class", "id"])}="{rng.choice(names)}"' if names and (hint or rng.random() < 0.3) else ""
        return f"<{tag}{a}" + (f' data-y="{y}"' if y is not None else "") + f">{inner}</{tag}>"

    links = lambda n, m=3: "".join(el("li", f'<a href="/x">{_words(rng, rng.randint(1, m))}</a>', 0) for _ in range(n))
    linked = lambda n: " ".join(f'<a href="/x">{_words(rng, 1)}</a>' for _ in range(n))
    menu = lambda: rng.choice([el("nav", el("ul", links(rng.randint(3, 9)), 0), 0, ("menu", "main-nav")), el("div", el("ul", links(rng.randint(3, 9)), 0), 0, ("menu", "navigation", "navbar", "top-menu")), el("div", linked(rng.randint(3, 8)), 0, ("nav", "breadcrumbs", "topbar"))])
    head = lambda: rng.choice([el("header", rng.choice(["", menu()]) + el(rng.choice(["div", "p", "span", "h1"]), _words(rng, rng.randint(1, 5)), 0), 0, ("masthead", "site-header")), el("div", el("div", _words(rng, rng.randint(1, 6)), 0), 0, ("header", "banner", "masthead"))])
    foot = lambda: rng.choice(["footer", "div"])
    advert = lambda: el(rng.choice(["div", "aside", "section"]), rng.choice([_words(rng, rng.randint(2, 14)), el("p", _words(rng, rng.randint(2, 25)), 0), linked(2)]), 0, ("ad", "advert", "ads-box", "sponsored", "promo", "banner-ad"))
    notice = lambda: el("div", el("p", _words(rng, rng.randint(5, 30)), 0) + rng.choice(["", "<button>Ok</button>"]), 0, ("cookie-notice", "consent", "notice", "gdpr-popup", "alert"))
    form = lambda: el("form", el("label", _words(rng, 2)) + "<input name=q>" + el("p", _words(rng, rng.randint(2, 12)), 0), 0, ("newsletter", "search-form", "login", "signup"))
    side = lambda: el(rng.choice(["aside", "div"]), el("h3", _words(rng, 2), 0) + rng.choice([el("ul", links(rng.randint(3, 8), 6), 0), el("p", _words(rng, rng.randint(5, 40)), 0)]), 0, ("sidebar", "widget", "related", "popular", "side-col"))
    remark = lambda: el(rng.choice(["li", "div", "article"]), el("p", _words(rng, rng.randint(3, 50)), 0) + rng.choice(["", linked(1)]), 0, ("comment", "reply"))
    remarks = lambda: el(rng.choice(["section", "div", "ol"]), el("h3", _words(rng, 2), 0) + "".join(remark() for _ in range(rng.randint(1, 6))), 0, ("comments", "commentlist", "disqus", "discussion"))
    share = lambda: el("div", linked(rng.randint(2, 5)), 0, ("share", "social", "tags"))

    body = [el("h1", _words(rng, rng.randint(2, 12)), 1)] if rng.random() < 0.8 else []
    short = rng.random() < 0.3
    for _ in range(rng.randint(1, 2) if short else rng.randint(1, 12)):
        body.append(
            rng.choices(
                [
                    lambda: el("p", _words(rng, rng.choice([1, 2, rng.randint(3, 90), rng.randint(10, 200)])), 1), lambda: el("h2", _words(rng, rng.randint(1, 6)), 1), lambda: el("blockquote", el("p", _words(rng, rng.randint(5, 40)), 1), 1),
                    lambda: el("ul", "".join(el("li", _words(rng, rng.randint(2, 25)), 1) for _ in range(rng.randint(2, 6))), 1), lambda: el("p", _words(rng, rng.randint(8, 40)) + " " + linked(rng.randint(1, 2)) + " " + _words(rng, rng.randint(8, 40)), 1),
                    lambda: el("table", "".join(el("tr", el("td", _words(rng, 2), 1) + el("td", str(rng.randint(1, 999)), 1), 1) for _ in range(3)), 1), lambda: el("div", _words(rng, rng.randint(10, 80)), 1),
                    lambda: el("pre", _words(rng, rng.randint(5, 30)), 1), advert, share,
                ],
                [10, 2, 1, 1.5, 3, 0.7, 2, 0.5, 1.0, 0.6],
            )[0]()
        )
    rng.random() < 0.25 and body.append(remarks())
    article = rng.choice([lambda s: el("article", s, None, ("post", "story")), lambda s: el("main", el("article", s)), lambda s: el("div", s, None, ("content", "main-content", "post-body", "entry", "article-text")), lambda s: el("section", el("div", s, None, ("text", "page"))), lambda s: s])("".join(body))
    parts = [p() for p in (head, menu, notice, advert, form) if rng.random() < 0.55]
    rng.shuffle(parts)
    after = [p() for p in (side, remarks, advert, side, form) if rng.random() < 0.45]
    if rng.random() < 0.3:
        after, parts = after[1:], parts + after[:1]
    end = el(foot(), rng.choice([_words(rng, rng.randint(2, 20)), el("p", "&copy; 2024 " + _words(rng, rng.randint(1, 8)), 0), el("ul", links(3), 0)]), 0, ("footer", "site-footer", "copyright", "legal")) if rng.random() < 0.85 else ""
    page = "".join(parts) + article + "".join(after) + end
    return f"<html><head><title>x</title></head><body>{el('div', page) if rng.random() < 0.3 else page}</body></html>"


def _labels(blocks: list[Block]) -> np.ndarray:
    """1, 0, or -1 for blocks that hold both kinds or no text."""
    own = {}
    for b in blocks:
        own[id(b)] = b.label if b.label is not None else own[id(b.parent)] if b.parent else None
    kinds: dict[int, set] = {}
    for b in reversed(blocks):
        k = {own[id(b)]} if b.text() else set()
        for c in b.children:
            k |= kinds[id(c)]
        kinds[id(b)] = k
    return np.array([next(iter(k)) if len(k := kinds[id(b)]) == 1 and None not in k else -1 for b in blocks])


@functools.cache
def trained(pages: int = TRAIN_PAGES, seed: int = 7) -> Boosted:
    rng, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        blocks = parse(training_page(rng))
        x, y = features(blocks), _labels(blocks)
        xs.append(x[y >= 0])
        ys.append(y[y >= 0])
    return Boosted(np.concatenate(xs), np.concatenate(ys).astype(float))


def main_texts(pages: list[str], model: Boosted) -> list[str]:
    """The main text of each page."""
    trees = [parse(p) if p else [] for p in pages]
    some = [t for t in trees if t]
    if not some:
        return [""] * len(pages)
    z = model.logit(np.concatenate([features(t) for t in some]))
    out, at = [], 0
    for t in trees:
        if not t:
            out.append("")
            continue
        kept = decode(t, z[at : at + len(t)])
        at += len(t)
        out.append(" ".join(s for b, k in zip(t, kept, strict=True) if k and (s := b.text())))
    return out


def extract(pages: DataFrame, html: str = "html", model: Boosted | None = None) -> DataFrame:
    """pages without the html, with text (main text) and n_chars (its code points)."""
    keep = others(pages, html, "text", "n_chars")
    model = model or trained()

    def one(batch: pa.RecordBatch):
        kept = columns(batch, keep)
        for at in range(0, batch.num_rows, 200):
            found = main_texts(texts(batch.slice(at, 200), html), model)
            yield pa.RecordBatch.from_arrays([*(c.slice(at, 200) for c in kept), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=[*(f.name for f in keep), "text", "n_chars"])

    return arrow_map(pages, one, ddl(keep, "text string", "n_chars bigint"))
