"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its text blocks; each has features of its ancestors (tags, class and id
words) and of its text. The field is trained on labelled pages: a small set written by rule, and pages of
the table whose markup names the article. Viterbi decoding marks the blocks of the article.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditweave.llm.common import Memo

#: HTML elements that do not break the line, and that have no end tag.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup svg time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_SIBLING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Block elements that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

#: Elements whose content is no text of the page; the first two swallow the rest of a page that does not end them.
_RAW = frozenset("script style".split())
_SKIPPED = _RAW | frozenset("title noscript template iframe textarea select svg object".split())
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
_ENDS = re.compile(rf"</({'|'.join(sorted(_SKIPPED))})\s*>", re.I)
#: In a tag: what stands between attributes, a name, an equals sign, a value without quotes.
_GAP, _ATTRIBUTE, _EQUALS, _BARE = re.compile(r"[\s/]*"), re.compile(r"[^\s/>=<][^\s/>=<]*|="), re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDES = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_SPACES = re.compile(r"\s+")
_HINTS = re.compile(r"©|\b(?:copyright|all rights reserved|cookies?|subscribe|newsletter|sign up|log ?in|privacy|advertis\w*|sponsored|share|repl(?:y|ies)|comments?)\b", re.I)


#: In a block of more characters than this, a hint word counts if it comes up once in so many.
HINT_SPAN = 400
#: Elements nested deeper than this, which browsers flatten, give no features to the text inside.
DEEPEST = 512


@dataclass
class Block:
    text: str
    #: Features of the elements around it.
    path: frozenset[str]
    linked: int = 0


def _node(tag: str, attributes: str) -> tuple[str, ...]:
    words = [w for m in _NAMED.finditer(attributes) for w in re.split(r"[^a-z0-9]+", next(g for g in m.groups() if g is not None).lower()) if w]
    marks = ("hidden",) if _HIDES.search(attributes) else ()
    return (f"t:{tag}", *dict.fromkeys(f"c:{w}" for w in words), *marks)


_NODES = Memo(lambda key: _node(*key), 50_000)


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that closes the tag whose name ends at ``at``; -1 if a ``<`` or the page's end comes first.

    A quote opens a value only behind an equals sign, and only if it is closed and followed by the end of the
    tag, a blank or a slash, or holds no ``<``; any other quote is a character like others.
    """
    n = len(page)
    while True:
        at = _GAP.match(page, at).end()
        if at >= n or page[at] == "<":
            return -1
        if page[at] == ">":
            return at
        at = _ATTRIBUTE.match(page, at).end()
        equals = _EQUALS.match(page, at)
        if equals is None:
            continue
        at = equals.end()
        quote = page[at : at + 1]
        if quote in ('"', "'") and quote:
            close = page.find(quote, at + 1)
            if close >= 0 and (page[close + 1 : close + 2] in "> \t\n\r\f/" or page.find("<", at, close) < 0):
                at = close + 1
                continue
        at = _BARE.match(page, at).end()


def _tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``start, end, name, closes, attributes`` of what is markup; the name is empty for what is only left out.

    Every character is looked at a few times, whatever stands where: a ``<`` that opens nothing is text.
    """
    ends: dict[str, list[tuple[int, int]]] | None = None
    last, at = page.rfind(">"), page.find("<")
    while 0 <= at < last:
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = len(page) if close < 0 else close + 3
            yield at, end, "", False, ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            yield at, end, "", False, ""
        else:
            name = _NAME.match(page, at + 1)
            close = _tag_end(page, name.end()) if name else -1
            if close < 0:
                at = page.find("<", at + 1)
                continue
            tag, closes, end = name[1].lower(), page[at + 1] == "/", close + 1
            if tag in _SKIPPED and not closes:
                if ends is None:
                    ends = {}
                    for found in _ENDS.finditer(page):
                        ends.setdefault(found[1].lower(), []).append(found.span())
                later = ends.get(tag, [])
                k = bisect_left(later, (end, 0))
                if k < len(later) or tag in _RAW:
                    end = later[k][1] if k < len(later) else len(page)
                    yield at, end, "", False, ""
                    at = page.find("<", end)
                    continue
            yield at, end, tag, closes, page[name.end() : close]
        at = page.find("<", end)
    # A comment, script or style that nothing ends takes the rest.
    if at >= 0 and (page.startswith("<!--", at) or (name := _NAME.match(page, at + 1)) and name[1].lower() in _RAW and page[at + 1] != "/"):
        yield at, len(page), "", False, ""


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, with decoded text, single blanks, and their ancestors."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_tags: Counter[str] = Counter()
    active: Counter[str] = Counter()
    known: dict[frozenset[str], frozenset[str]] = {}
    parts: list[str] = []
    links, linked = 0, 0

    def leave() -> str:
        tag, names = stack.pop()
        open_tags[tag] -= 1
        if len(stack) < DEEPEST:
            for name in names:
                active[name] -= 1
                if not active[name]:
                    del active[name]
        return tag

    def flush() -> None:
        nonlocal linked
        text = _SPACES.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            around = frozenset(active) | {f"p:{stack[-1][1][0]}" if stack else "p:none"}
            found.append(Block(text, known.setdefault(around, around), linked))
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            linked += len(piece) if links else 0

    at = 0
    for start, end, tag, closes, attributes in _tags(page):
        text(page[at:start])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                links = 0 if closes else 1
            continue
        flush()
        links = 0
        if closes:
            if open_tags[tag]:
                while leave() != tag:
                    pass
            continue
        if tag == "body":
            for held in (stack, open_tags, active):
                held.clear()
        if tag in _ENDS_P and stack and stack[-1][0] == "p":
            leave()
        if stack and stack[-1][0] in CLOSED_BY_SIBLING.get(tag, ()):
            leave()
        if tag not in VOID:
            names = _NODES[tag, attributes] if len(attributes) <= 300 else _node(tag, attributes)
            if len(stack) < DEEPEST:
                active.update(names)
            stack.append((tag, names))
            open_tags[tag] += 1
    text(page[at:])
    flush()
    return found


def features(block: Block) -> list[str]:
    """Names of the features of a block."""
    n = len(block.text)
    size = "len:0" if n < 25 else "len:1" if n < 80 else "len:2" if n < 250 else "len:3"
    share = "link:none" if not block.linked else "link:most" if block.linked > n * 0.6 else "link:some"
    own = [size, share, "end:stop" if block.text[-1] in ".!?…\"”»" else "end:open"]
    # A long block is marked by a word that comes up all along it, not by a single mention.
    hints = Counter(m.lower()[:8] for m in _HINTS.findall(block.text))
    own += [f"w:{word}" for word, count in hints.items() if count * HINT_SPAN >= n or n <= HINT_SPAN]
    return [*block.path, *own]


@dataclass
class Field:
    """Weights of a two-label chain: by feature for label 1 against 0, and between neighbours."""

    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    turn: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def decode(self, found: list[Block]) -> list[int]:
        """The most likely labels (Viterbi); of equals, label 0."""
        if not found:
            return []
        scores, back = [self.start[0], self.start[1] + self._unary(found[0])], []
        for block in found[1:]:
            u = self._unary(block)
            (s00, s01), (s10, s11) = self.turn
            to0, to1 = (scores[0] + s00, scores[1] + s10), (scores[0] + s01, scores[1] + s11)
            step = (int(to0[1] > to0[0]), int(to1[1] > to1[0]))
            back.append(step)
            scores = [to0[step[0]], to1[step[1]] + u]
        labels = [int(scores[1] > scores[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def _unary(self, block: Block) -> float:
        return math.fsum(self.weights.get(f, 0.0) for f in features(block))


def fit(pages: list[tuple[list[Block], list[int]]], steps: int = 200, ridge: float = 0.02) -> Field:
    """Maximum likelihood with a ridge penalty, by Adam steps over all pages; forward-backward in step over pages."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for found, _ in pages for b in found for f in features(b)})
    index = {f: i for i, f in enumerate(names)}
    longest, n = max(len(p[0]) for p in pages), len(pages)
    width = max(len(features(b)) for found, _ in pages for b in found)
    x = np.full((n, longest, width), len(names))
    y, real = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for i, (found, labels) in enumerate(pages):
        real[i, : len(found)], y[i, : len(found)] = True, labels
        for t, block in enumerate(found):
            hit = sorted(index[f] for f in features(block))
            x[i, t, : len(hit)] = hit
    w, start, turn = np.zeros(len(names) + 1), np.zeros(2), np.zeros((2, 2))
    sizes = [len(w), 2, 4]
    moment, spread = np.zeros(sum(sizes)), np.zeros(sum(sizes))
    gold = np.zeros((2, 2))
    pair_real = real[:, 1:]
    np.add.at(gold, (y[:, :-1][pair_real], y[:, 1:][pair_real]), 1)
    for step in range(1, steps + 1):
        unary = np.stack([np.zeros((n, longest)), w[x].sum(axis=2)], axis=2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = start + unary[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + turn[None], axis=1) + unary[:, t]
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(turn[None] + (unary[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], new, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        p1 = np.where(real, np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]), 0.0)
        pair = np.exp(ahead[:, :-1, :, None] + turn + (unary + behind)[:, 1:, None, :] - total[:, None, None, None])
        expected = (pair * pair_real[:, :, None, None]).sum(axis=(0, 1))
        diff = np.where(real, y - p1, 0.0)
        g_w = np.bincount(x.ravel(), weights=np.repeat(diff.ravel(), width), minlength=len(w))
        g_w[-1] = 0
        first = np.array([(y[:, 0] == 0).sum() - (1 - p1[:, 0]).sum(), y[:, 0].sum() - p1[:, 0].sum()])
        gradient = np.concatenate([g_w, first, (gold - expected).ravel()]) / n - ridge / n * np.concatenate([w, start, turn.ravel()])
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        move = 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        w += move[: sizes[0]]
        start += move[sizes[0] : sizes[0] + 2]
        turn += move[sizes[0] + 2 :].reshape(2, 2)
    w[-1] = 0
    return Field(dict(zip(names, w[:-1].tolist(), strict=True)), tuple(start.tolist()), tuple(map(tuple, turn.tolist())))


#: Containers as pages name them, for the labelled pages written by rule.
BOILERPLATE = (
    "nav", "header", "footer", "aside", "form", "div ad", "div ads", "div advert", "div advertisement", "div banner", "div sponsored", "div promo",
    "ul menu", "div menu", "div nav", "div navbar", "div navigation", "div sidebar", "aside sidebar", "div widget", "div related", "div cookie", "div cookie-notice", "div notice",
    "div popup", "div modal", "div newsletter", "div subscribe", "div login", "div search", "form search", "div comments", "section comments", "div comment", "ol commentlist",
    "section responses", "div replies", "div share", "div social", "div breadcrumb", "div footer", "div header", "div top", "div copyright", "div disclaimer", "div consent",
    "div alert", "div tags", "div pagination", "div toolbar", "section related", "div recommended", "div legal", "dialog", "menu",
)
CONTENT = (
    "article", "article", "article", "main", "article post", "div content", "div article", "div article-body", "div post", "div entry-content", "div post-content",
    "section story", "div main", "div text", "div body", "section", "div",
)


def written_pages(n: int = 400, seed: int = 3) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages made by rule: an article among containers of other text, some of them inside it."""
    draw = np.random.default_rng(seed)
    syllables = "an be ca do el fi go ha in ka le mo na or pi ra so tu ve wi".split()

    def words(k: int) -> str:
        text = " ".join("".join(draw.choice(syllables, draw.integers(1, 4))) for _ in range(k))
        return text.capitalize() + ("." if k > 4 and draw.random() < 0.9 else "")

    def box(name: str, inner: str, label: str) -> str:
        tag, _, cls = name.partition(" ")
        mark = f' {draw.choice(["class", "id"])}="{cls}"' if cls else ""
        return f"<{tag}{mark}>{inner}</{tag}>".replace("\x01", label)

    def other() -> str:
        kind = draw.integers(0, 4)
        if kind == 0:
            inner = "<ul>" + "".join(f'<li><a href="/x">\x01{words(int(draw.integers(1, 4)))}</a></li>' for _ in range(draw.integers(2, 7))) + "</ul>"
        elif kind == 1:
            inner = f"\x01{words(int(draw.integers(3, 25)))}"
        elif kind == 2:
            inner = "".join(f"<p>\x01{words(int(draw.integers(3, 60)))}</p>" for _ in range(draw.integers(1, 4)))
        else:
            inner = f"<h3>\x01{words(2)}</h3><p>\x01{words(int(draw.integers(5, 30)))} <a href='/y'>{words(2)}</a></p>"
        return box(str(draw.choice(BOILERPLATE)), inner, "\x02")

    def article() -> str:
        parts = [f"<h1>\x03{words(int(draw.integers(3, 12)))}</h1>"] if draw.random() < 0.9 else []
        for _ in range(draw.integers(1, 12)):
            kind = draw.random()
            if kind < 0.75:
                parts.append(f"<p>\x03{words(int(draw.integers(1, 120)))}</p>")
            elif kind < 0.82:
                parts.append(f"<h2>\x03{words(int(draw.integers(1, 6)))}</h2>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>\x03{words(int(draw.integers(2, 20)))}</li>" for _ in range(draw.integers(2, 5))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote>\x03{words(int(draw.integers(5, 40)))}</blockquote>")
            else:
                parts.append(other())
        return box(str(draw.choice(CONTENT)), "".join(parts), "\x03")

    pages = []
    for _ in range(n):
        before = [other() for _ in range(draw.integers(1, 5))]
        after = [other() for _ in range(draw.integers(1, 5))]
        inner = article()
        if draw.random() < 0.4:  # a wrapper around the article and what stands beside it
            wrapper = str(draw.choice(["main", "div main", "div content", "section", "div"]))
            inner = box(wrapper, "".join(other() for _ in range(draw.integers(0, 3))) + inner + "".join(other() for _ in range(draw.integers(0, 3))), "")
        body = "".join(before) + inner + "".join(after)
        if draw.random() < 0.3:
            body = f'<div class="{draw.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
        found = blocks(f"<html><body>{body}</body></html>")
        labels = [int("\x03" in b.text) for b in found]
        for b in found:
            b.text = re.sub("[\x01-\x03]", "", b.text).strip() or "."
        pages.append((found, labels))
    return pages


_NOT_ARTICLE = {f"t:{t}" for t in ("nav", "header", "footer", "aside", "form", "dialog", "menu")} | {f"c:{c}" for c in ("ad", "ads", "advert", "comments", "comment", "menu", "sidebar", "notice", "cookie")}


def marked_page(page: str) -> tuple[list[Block], list[int]]:
    """A page labelled by its own markup; no blocks unless it has an ``article``."""
    found = blocks(page)
    labels = [int("t:article" in (names := b.path) and not names & _NOT_ARTICLE) for b in found]
    return (found, labels) if any(labels) else ([], [])


def train(pages: DataFrame, max_pages: int = 300, max_chars: int = 200_000, max_blocks: int = 400) -> Field:
    """A field from the pages written by rule and a bounded sample of the table.

    The sample are at most ``max_pages`` pages, the first by a hash, of those with at most ``max_chars``
    characters; of them, the ones whose markup names the article and that have at most ``max_blocks`` blocks.
    """
    keyed = pages.filter(F.col("html").isNotNull() & (F.length("html") <= max_chars)).select(F.xxhash64("page_id", "url").alias("pick"), "html")
    # Only hashes are sorted and at most max_pages of them broadcast; of rows with one hash, one page is taken.
    picked = keyed.select("pick").distinct().orderBy("pick").limit(max_pages)
    sample = keyed.join(F.broadcast(picked), "pick").groupBy("pick").agg(F.min("html").alias("html"))
    found = [marked_page(r["html"]) for r in sorted(sample.collect())]
    return fit(written_pages() + [p for p in found if len(p[0]) <= max_blocks])


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; a map over rows.

    ``text`` joins the article's blocks by line breaks; character references are decoded, white space in
    a block is one blank. A null or empty page, or one without an article, gives an empty text. Other
    columns are left out.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = []
            for page in batch.column(2):
                found = blocks(page.as_py() or "")
                texts.append("\n".join(b.text for b, y in zip(found, model.decode(found), strict=True) if y))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
