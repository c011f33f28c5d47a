"""Main text of web pages by a recurrent block labeller.

leaves() reads a page into its leaf blocks: text between block-level tags, with the tags and class words on the path to it. Scripts,
styles and other text that no reader sees are not leaves. A bidirectional LSTM (numpy) reads a page's leaves as one sequence of
tag-path and hashed-word vectors, so each block is judged with the whole page before and after it; the blocks labelled as main text
are joined by line feeds. All leaves are read, whatever the page's length.

The labeller is trained on the driver from SAMPLE_PAGES pages of the table (those with the least hash of page_id) in two ways: as they
are, with labels from what their markup states (STATED below), and as raw material: their blocks are set into generated layouts with
menus, headers, sidebars, notices, adverts, forms, footers and reader comments of known labels. Seeds are fixed, so reruns agree.

A null or empty html gives an empty text, as does a page without main blocks. Broken markup is read as far as it goes: a quote in a tag
opens a value after = only, a raw element that is closed in its own tag or never ends (other than script and style) hides nothing, and an end
tag without its element is passed over. Time grows with the page's length, however its elements are nested. Repeated rows, null ids and null urls
stay as they are.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import least_hash

SAMPLE_PAGES, LAYOUTS, SEED = 240, 1200, 5
PATH_DIM, TAG_DIM, WORD_DIM, NUMBERS, HIDDEN = 512, 32, 64, 8, 24
EPOCHS, PAGES_AT_ONCE, LEARNING = 8, 24, 0.01
PAGES_READ = 128

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style template noscript svg math iframe object head title textarea select audio video canvas map datalist".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
RAW = frozenset("script style title textarea iframe noscript template svg math select".split())
CODE = frozenset("script style".split())  # without an end tag, the rest of the page is code; other elements of RAW then hold nothing
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead tfoot div section article main aside nav header footer body html form fieldset blockquote figure td th".split())
PARAGRAPH, HEADINGS, OWNERS = frozenset({"p"}), frozenset("p h1 h2 h3 h4 h5 h6".split()), SCOPES | {"object"}

# Words of markup that state what a block is, by kind; used to label the sample and to generate layouts.
STATED = {
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "tabs", "pagination", "pager", "skip", "toc"),
    "header": ("header", "masthead", "topbar", "branding", "logo", "banner", "tagline"),
    "footer": ("footer", "copyright", "legal", "colophon", "bottom", "imprint", "credits"),
    "sidebar": ("aside", "sidebar", "widget", "related", "popular", "trending", "recommended", "tags", "archive", "archives", "blogroll", "rail", "more"),
    "notice": ("cookie", "cookies", "notice", "consent", "alert", "popup", "modal", "gdpr", "overlay", "paywall", "disclaimer", "toast", "message"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "adsense", "dfp", "outbrain", "taboola"),
    "form": ("form", "newsletter", "subscribe", "subscription", "signup", "login", "search", "searchbox", "contact", "register"),
    "comments": ("comment", "comments", "commentlist", "discussion", "replies", "reply", "respond", "disqus", "reviews", "responses"),
    "share": ("share", "sharing", "social", "follow", "meta", "byline", "toolbar", "actions"),
}
TAGS_OF = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
MAIN = ("content", "post", "entry", "story", "article", "body", "text", "main", "page", "single", "hentry", "prose", "maincontent", "articlebody")
PHRASES = {
    "menu": "Home|About|About us|Contact|News|Products|Services|Blog|Login|Search|Next|Previous|Help|Sitemap|Start|Inicio|Accueil|Startseite|Kontakt",
    "header": "Welcome|Daily News|The Journal|Your source for|Toggle navigation|Skip to content|Subscribe|Menu",
    "footer": "© 2024|Copyright|All rights reserved|Privacy Policy|Terms of Use|Powered by|Impressum|Datenschutz|Mentions légales|Aviso legal",
    "sidebar": "Related articles|Most read|Popular posts|Recent posts|Categories|Tags|Archives|You may also like|Read more|See also",
    "notice": "This site uses cookies|We use cookies to improve your experience|Accept|Accept all|Dismiss|Please enable JavaScript|You have 2 free articles left|Got it",
    "advert": "Advertisement|Sponsored|Buy now|Limited offer|50% off|Click here|Shop now|Best deals|Ad|Anzeige|Publicité",
    "form": "Your email|Name|Password|Submit|Sign up|Subscribe to our newsletter|Search|Send|Leave a message|Remember me",
    "comments": "Reply|Leave a reply|3 comments|says:|Great article!|Thanks for sharing|Log in to reply|Posted by|Comments|I disagree|Report|Like",
    "share": "Share|Tweet|Share on Facebook|Email this|Print|Follow us|By|min read|Posted on",
}

# In a tag a quote opens a value after = only; elsewhere, and where it is never closed, it is a character like others.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element adds to the path: its tag and the words of class, id and role."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return (tag,)
    out = [tag]
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "aria-hidden"):
            if value.lower() != "false":
                out.append(".hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                out.append(".hidden")
        else:
            out += ["." + p.lower() for p in PARTS.findall(value)]
    return tuple(out)


class Leaf:
    """A block: its text, the names on its path, the innermost block tag and the characters that are links."""

    __slots__ = ("links", "path", "tag", "text")

    def __init__(self, path: frozenset[str], tag: str) -> None:
        self.path, self.tag, self.text, self.links = path, tag, [], 0


def leaves(page: str | None) -> list[tuple[str, frozenset[str], str, float]]:
    """(text, names on the path, innermost block tag, share of link characters) of each leaf block, in page order."""
    page = page or ""
    out: list[Leaf] = []
    stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "")]
    # Open elements by tag: on the whole page, and since the innermost scope, so that a search that must fail is not begun.
    opened: dict[str, int] = defaultdict(int)
    scopes: list[tuple[str, dict[str, int]]] = [("", defaultdict(int))]
    endless: set[str] = set()  # raw elements that have no end tag any more
    current: Leaf | None = None
    at, end = 0, len(page)

    def close(k: int) -> None:
        for tag, _, _ in reversed(stack[k:]):
            opened[tag] -= 1
            if tag in UNSEEN:
                opened[".unseen"] -= 1
            if tag in OWNERS:
                scopes.pop()
            scopes[-1][1][tag] -= 1
        del stack[k:]

    while at < end:
        m = TOKEN.search(page, at)
        start = m.start() if m else end
        if start > at and stack[-1][0] == "head" and not page[at:start].isspace():
            close(len(stack) - 1)  # text may not stand in a head: </head> is left out
        if start > at and not opened[".unseen"]:
            piece = page[at:start]
            if current is None and not piece.isspace():
                current = Leaf(stack[-1][1], stack[-1][2])
                out.append(current)
            if current is not None:
                current.text.append(piece)
                current.links += len(piece) if opened["a"] else 0
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            current = None
        if m[1]:
            if (scopes[-1][1] if tag in INLINE else opened)[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag))
            continue
        if stack[-1][0] == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        empty = m[3].endswith("/")
        if tag in RAW:
            if not (empty and tag not in CODE) and tag not in endless:
                found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if found:
                    at = found.end()
                else:
                    endless.add(tag)
                    at = end if tag in CODE and not empty else at
            continue
        if tag in VOID:
            continue
        shut = CLOSES.get(tag) or (frozenset() if tag in INLINE else HEADINGS if tag == "p" or tag[0] == "h" and len(tag) == 2 else PARAGRAPH)
        scope, within = scopes[-1]
        if scope in shut or shut is PARAGRAPH and within["p"] or shut is not PARAGRAPH and any([within[x] for x in shut]):
            close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in shut))
        names, above = _names(tag, m[3]), stack[-1]
        path = above[1] if above[1].issuperset(names) else above[1].union(names)
        stack.append((tag, path, above[2] if tag in INLINE else tag))
        opened[tag] += 1
        if tag in UNSEEN:
            opened[".unseen"] += 1
        scopes[-1][1][tag] += 1
        if tag in OWNERS:
            scopes.append((tag, defaultdict(int)))
    done = []
    for leaf in out:
        raw = "".join(leaf.text)
        text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
        if text:
            done.append((text, leaf.path, leaf.tag, min(1.0, leaf.links / max(1, len(raw)))))
    return done


def vectors(pages: list[list[tuple[str, frozenset[str], str, float]]]) -> np.ndarray:
    """A row for each leaf of the pages: path names, innermost tag, hashed words, and a few numbers."""
    flat = [leaf for page in pages for leaf in page]
    n = len(flat)
    x = np.zeros((n, PATH_DIM + TAG_DIM + WORD_DIM + NUMBERS), np.float32)
    if not n:
        return x
    known: dict[frozenset[str], list[int]] = {}
    for path in {leaf[1] for leaf in flat}:
        known[path] = sorted({zlib.crc32(name.encode()) % PATH_DIM for name in path})
    lists = [known[leaf[1]] for leaf in flat]
    rows = np.repeat(np.arange(n), [len(v) for v in lists])
    x[rows, np.fromiter((b for v in lists for b in v), np.int64, len(rows))] = 1
    x[np.arange(n), [PATH_DIM + zlib.crc32(leaf[2].encode()) % TAG_DIM for leaf in flat]] = 1
    words = [leaf[0].lower().encode("utf-8", "surrogatepass").split() for leaf in flat]
    sizes = np.array([len(w) for w in words])
    hashed = np.fromiter((zlib.crc32(w) for ws in words for w in ws), np.int64, int(sizes.sum())) % WORD_DIM
    counts = np.bincount(np.repeat(np.arange(n), sizes) * WORD_DIM + hashed, minlength=n * WORD_DIM).reshape(n, WORD_DIM)
    x[:, PATH_DIM + TAG_DIM : -NUMBERS] = counts / np.sqrt(np.maximum(sizes, 1))[:, None]
    place = np.concatenate([np.arange(len(p)) / max(1, len(p) - 1) for p in pages if p])
    for i, leaf in enumerate(flat):
        text, size = leaf[0], len(leaf[0])
        x[i, -NUMBERS:-1] = (
            min(math.log1p(size) / 8, 2), math.log1p(sizes[i]) / 6, leaf[3], (text.count(".") + text.count(",")) / size * 10,
            text[-1] in ".!?:;\"'", text[0].isupper(), "©" in text or "|" in text,
        )
    x[:, -1] = place
    return x


class Labeller:
    """A bidirectional LSTM over the leaves of a page with a logistic output per leaf."""

    def __init__(self, seed: int = SEED) -> None:
        rng, size = np.random.default_rng(seed), PATH_DIM + TAG_DIM + WORD_DIM + NUMBERS
        self.p = {}
        for d in ("f", "b"):
            self.p["x" + d] = rng.normal(0, 0.08, (size, 4 * HIDDEN)).astype(np.float32)
            self.p["h" + d] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.p["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
        self.p["o"] = rng.normal(0, 0.2, (2 * HIDDEN, 1)).astype(np.float32)
        self.p["d"] = rng.normal(0, 0.05, (size, 1)).astype(np.float32)
        self.p["z"] = np.zeros(1, np.float32)

    @staticmethod
    def _gates(a: np.ndarray) -> tuple[np.ndarray, ...]:
        i, f, o = (1 / (1 + np.exp(-np.clip(a[:, k * HIDDEN : (k + 1) * HIDDEN], -30, 30))) for k in (0, 1, 2))
        return i, f, o, np.tanh(a[:, 3 * HIDDEN :])

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states (time, page, HIDDEN) in one direction; padding leaves the state as it is."""
        steps, pages = mask.shape
        a = (x.reshape(steps * pages, -1) @ self.p["x" + d] + self.p["c" + d]).reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            gates = self._gates(a[t] + h @ self.p["h" + d])
            i, f, o, g = gates
            m = mask[t][:, None]
            c_new = m * (f * c + i * g) + (1 - m) * c
            s = np.tanh(c_new)
            kept.append((t, gates, h, c, s, m))
            h, c = m * o * s + (1 - m) * h, c_new
            out[t] = h
        return out, kept

    def scores(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        (hf, kf), (hb, kb) = self._pass("f", x, mask), self._pass("b", x, mask)
        h = np.concatenate([hf, hb], 2)
        z = (h @ self.p["o"] + x @ self.p["d"])[..., 0] + self.p["z"]
        return z, (h, kf, kb)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        z, (h, kf, kb) = self.scores(x, mask)
        e = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * mask / max(1, mask.sum()))[..., None].astype(np.float32)
        flat = x.reshape(-1, x.shape[2])
        g = {"o": h.reshape(-1, 2 * HIDDEN).T @ e.reshape(-1, 1), "d": flat.T @ e.reshape(-1, 1), "z": e.sum((0, 1))}
        dh_all = e @ self.p["o"].T
        for d, kept, lo in (("f", kf, 0), ("b", kb, HIDDEN)):
            da = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((mask.shape[1], HIDDEN), np.float32)
            gh = np.zeros_like(self.p["h" + d])
            for t, (i, f, o, u), h0, c0, s, m in reversed(kept):
                dh = dh + dh_all[t][:, lo : lo + HIDDEN]
                dm = dh * m
                dcm = (dc + dm * o * (1 - s * s)) * m
                da[t] = np.concatenate([dcm * u * i * (1 - i), dcm * c0 * f * (1 - f), dm * s * o * (1 - o), dcm * i * (1 - u * u)], 1)
                gh += h0.T @ da[t]
                dh = dh * (1 - m) + da[t] @ self.p["h" + d].T
                dc = dc * (1 - m) + dcm * f
            flat_a = da.reshape(-1, 4 * HIDDEN)
            g |= {"x" + d: flat.T @ flat_a, "h" + d: gh, "c" + d: flat_a.sum(0)}
        return g

    def fit(self, pages: list[tuple[list, list[int]]]) -> Labeller:
        """Adam over batches of pages of like length."""
        rng, first, second, step = np.random.default_rng(SEED), {}, {}, 0
        made = [(vectors([p]), np.array(y, np.float32)) for p, y in pages if p]
        for epoch in range(EPOCHS):
            order = sorted(range(len(made)), key=lambda k: (len(made[k][1]) // 4, rng.random()))
            batches = [order[k : k + PAGES_AT_ONCE] for k in range(0, len(order), PAGES_AT_ONCE)]
            for b in rng.permutation(len(batches)):
                x, mask = padded([made[k][0] for k in batches[b]])
                y = np.zeros(mask.shape, np.float32)
                for column, k in enumerate(batches[b]):
                    y[: len(made[k][1]), column] = made[k][1]
                step += 1
                rate = LEARNING * (1 - epoch / EPOCHS)
                for name, g in self.gradients(x, mask, y).items():
                    first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                    second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
                    self.p[name] = self.p[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
        return self

    def main_blocks(self, pages: list[list]) -> list[list[bool]]:
        """Whether each leaf of each page is main text; pages of like length are read together."""
        out: list[list[bool]] = [[] for _ in pages]
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        for at in range(0, len(order), PAGES_READ):
            rows = order[at : at + PAGES_READ]
            while rows:  # batches of bounded area
                take = max(1, min(len(rows), 20000 // len(pages[rows[-1]])))
                part, rows = rows[-take:], rows[:-take]
                x = vectors([pages[k] for k in part])
                cuts = np.cumsum([len(pages[k]) for k in part])[:-1]
                z, _ = self.scores(*padded(np.split(x, cuts)))
                for column, k in enumerate(part):
                    out[k] = (z[: len(pages[k]), column] >= 0).tolist()
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32), np.zeros((steps, len(rows)), np.float32)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, 1
    return x, mask


# --- training material

BOILERPLATE = frozenset(w for words in STATED.values() for w in words)


def stated(leaf: tuple[str, frozenset[str], str, float]) -> int | None:
    """The label that a leaf's markup states: 0 boilerplate, 1 main, None if it says nothing."""
    names = leaf[1]
    if names & {"nav", "footer", "aside", "form", ".hidden"} or any(n[0] == "." and n[1:] in BOILERPLATE for n in names if len(n) > 1):
        return 0
    if "article" in names or "main" in names:
        return 1
    return 0 if "header" in names else None


def layout(rng: random.Random, blocks: list[str], pool: list[str]) -> tuple[str, list[int]]:
    """A generated page around the given main blocks, and the labels of its leaves."""
    page: list[str] = []
    labels: list[int] = []

    def words(least: int, most: int) -> str:
        return entities.escape(" ".join(rng.choice(pool) for _ in range(rng.randint(least, most))))

    def put(text: str, tag: str, label: int, link: bool = False) -> None:
        page.append(f"<{tag}>" + (f'<a href="/{rng.randint(1, 99)}">{text}</a>' if link else text) + f"</{tag}>")
        if text.strip():
            labels.append(label)

    def named(kind: str) -> str:
        word = rng.choice(STATED[kind])
        shape = rng.choice(("{}", "{}", "site-{}", "{}-box", "{}_wrap", "page {}", "{}-inner", "js-{}"))
        return f'{rng.choice(("class", "class", "id"))}="{shape.format(word)}"'

    def boilerplate(kind: str) -> None:
        tag = TAGS_OF.get(kind, "div") if rng.random() < 0.6 else rng.choice(("div", "div", "section", "ul" if kind == "menu" else "div"))
        marked = tag in TAGS_OF.values() and rng.random() < 0.6
        page.append(f"<{tag}>" if marked else f"<{tag} {named(kind)}>")
        phrases = PHRASES[kind].split("|")
        phrase = lambda: entities.escape(rng.choice(phrases)) if rng.random() < 0.5 else words(1, 6)
        if kind == "menu":
            page.append("<ul>")
            for _ in range(rng.randint(2, 9)):
                put(phrase(), "li", 0, True)
            page.append("</ul>")
        elif kind in ("comments", "sidebar"):
            if rng.random() < 0.7:
                put(phrase(), rng.choice(("h2", "h3", "h4", "div")), 0)
            for _ in range(rng.randint(1, 6)):
                if kind == "comments":
                    inner = rng.choice(("div", "li"))
                    page.append(f"<{inner}>" if inner == "div" else '<li class="comment">')
                    put(phrase(), "div", 0, rng.random() < 0.4)
                    put(words(3, 60), "p", 0)
                    page.append(f"</{inner}>")
                else:
                    put(words(2, 30), rng.choice(("li", "p", "div")), 0, rng.random() < 0.7)
        elif kind == "form":
            for _ in range(rng.randint(1, 4)):
                put(phrase(), rng.choice(("p", "div", "button", "h3")), 0)
                page.append('<input type="text">')
        else:
            for _ in range(rng.randint(1, 3)):
                put(phrase() if rng.random() < 0.5 else words(2, 25), rng.choice(("p", "div", "div", "li")), 0, rng.random() < 0.3)
            if rng.random() < 0.25:  # bare text
                page.append(words(2, 12))
                labels.append(0)
        page.append(f"</{tag}>")

    kinds = list(STATED)
    for kind in ("notice", "header", "menu", "advert", "share"):
        if rng.random() < 0.45:
            boilerplate(kind)
    outer = rng.choice(("", "", "<div>", '<div class="container">', '<div id="wrapper"><div class="row">', "<table><tr><td>"))
    tag = rng.choice(("article", "article", "main", "div", "section"))
    bare = tag in ("article", "main") and rng.random() < 0.7
    page += [outer, f"<{tag}>" if bare else f'<{tag} class="{rng.choice(("", "", "post-", "entry-", "article-", "main-"))}{rng.choice(MAIN)}">']
    if rng.random() < 0.6:
        put(words(2, 10), rng.choice(("h1", "h1", "h2")), 1)
    for number, text in enumerate(blocks):
        draw = rng.random()
        if draw < 0.12:
            page.append("<ul>")
            for _ in range(rng.randint(1, 4)):
                put(words(2, 15), "li", 1)
            page.append("</ul>")
        elif draw < 0.2:
            put(words(1, 8), rng.choice(("h2", "h3")), 1)
        elif draw < 0.3:
            put(f'{words(3, 20)} <a href="/x">{words(1, 4)}</a> {words(2, 20)}', "p", 1)
        elif draw < 0.36:
            put(words(1, 5), rng.choice(("blockquote", "pre", "figcaption", "td", "p")), 1)
        put(entities.escape(text, quote=False), rng.choice(("p", "p", "p", "p", "div")), 1)
        if rng.random() < 0.07 and number:
            boilerplate(rng.choice(("advert", "share", "notice", "sidebar", "form")))
    if rng.random() < 0.25:
        boilerplate(rng.choice(("comments", "share", "sidebar", "advert")))
    page.append(f"</{tag}>")
    for kind in rng.sample(("comments", "sidebar", "advert", "form", "share", "menu"), 6):
        if rng.random() < 0.3:
            boilerplate(kind)
    page.append("</div></div>" if "row" in outer else "</td></tr></table>" if "table" in outer else "</div>" if outer else "")
    if rng.random() < 0.6:
        boilerplate("footer")
    if rng.random() < 0.15:
        boilerplate(rng.choice(kinds))
    return "<html><head><title>" + words(1, 5) + "</title></head><body>" + "".join(page) + "</body></html>", labels


def training_pages(pages: list[str]) -> list[tuple[list, list[int]]]:
    """Leaves and labels of the sample as it is marked, and of generated layouts around its blocks."""
    out, blocks = [], []
    for page in pages:
        found = leaves(page)
        labels = [stated(x) for x in found]
        blocks += [x[0] for x, y in zip(found, labels, strict=True) if y != 0]
        if found and None not in labels:
            out.append((found, labels))
    rng = random.Random(SEED)
    blocks = blocks or ["Lorem ipsum dolor sit amet."]
    pool = sorted({w for b in rng.sample(blocks, min(len(blocks), 400)) for w in b.split()})

    def block() -> str:
        """A block of the sample, or as many of its first words as chance has it: articles have blocks of all lengths."""
        words = rng.choice(blocks).split(" ")
        return " ".join(words if rng.random() < 0.3 else words[: max(3, int(len(words) * rng.random() ** 2))])

    for _ in range(LAYOUTS):
        page, labels = layout(rng, [block() for _ in range(rng.choice((1, 1, 2, 3, 4, 6, 9, 14)))], pool)
        found = leaves(page)
        if len(found) == len(labels):
            out.append((found, labels))
    return out


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Labeller:
    """A labeller from at most `sample` pages, those with the least hash of page_id."""
    rows = least_hash(pages.select("page_id", "html"), "page_id", sample).where("html is not null").collect()
    found = sorted(((r["page_id"] is None, r["page_id"], r["html"]) for r in rows), key=lambda x: (x[0], x[1] or 0, x[2]))
    return Labeller().fit(training_pages([html for _, _, html in found]))


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_main), a row per row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for part in (x.slice(k, 2 * PAGES_READ) for k in range(0, x.num_rows, 2 * PAGES_READ)):
                found = [leaves(h) for h in part.column("html").to_pylist()]
                texts, main = [], labeller.main_blocks(found)
                for page, kept in zip(found, main, strict=True):
                    texts.append("\n".join(leaf[0] for leaf, k in zip(page, kept, strict=True) if k))
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                    pa.array(map(len, found), pa.int64()), pa.array(map(sum, main), pa.int64()),
                ], ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_main long")
