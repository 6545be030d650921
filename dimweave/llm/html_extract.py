"""Main text of web pages by a linear-chain conditional random field.

A page is cut into the leaf blocks of its element tree: runs of text between
block-level tags.  Each block is described by the tags, classes and ids of its
ancestors and by its text (length, share of links, punctuation, place).  The
CRF labels the sequence of blocks as main text or not; it is trained by
gradient ascent on the labelled pages of ``labelled_pages`` and decoded by
Viterbi.  Training takes a fixed set of pages, whatever the input.

Within a block character references are decoded, white space becomes one
space, and the ends are trimmed; blocks are joined by one newline.

The content of scripts, styles, templates, text areas, titles, and of closed
noscript, iframe and select elements is no text; formulas and drawings are
inline text, and so is what follows an element that is never closed.

Edge cases: a null or empty page, or one without text, has an empty text;
unclosed, stray and cut-off tags, comments and references are read as far as
they go; white space is that of Unicode; pages of any length are read whole;
repeated rows and null ids come back row by row; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul "
    "button iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style template textarea title".split())
SKIPPED_TAGS = frozenset("noscript iframe select".split())  # up to their closing tag, if they have one
_CLOSES_P = BLOCK_TAGS - {"head", "html", "body", "title"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_OTHER = re.compile(r"[^a-z]+")


def _names(marks: str) -> list[str]:
    """Classes, ids and roles as words of a-z joined by hyphens: ``topNav_2`` is top-nav."""
    return [n for n in (_OTHER.sub("-", _HUMP.sub("-", m).lower()).strip("-") for m in marks.split()) if n]


@dataclass
class Block:
    """A leaf block: its ancestors from the root down, text, and link share."""

    path: tuple[str, ...]
    text: str
    links: float


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order, with their decoded text."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    state = {"link": 0, "linked": 0}

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(tuple(label for _, label in stack), text, min(1.0, state["linked"] / len(text))))
        parts.clear()
        state["linked"] = 0

    def add(raw: str) -> None:
        if raw:
            parts.append(html.unescape(raw))  # a reference does not go on behind a tag
            if state["link"]:
                state["linked"] += len(parts[-1])

    def close(name: str) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == name:
                del stack[depth:]
                return

    page, at, unclosed = page or "", 0, set()
    while True:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        name = found[2].lower()
        if found[1]:
            if name == "a":
                state["link"] = max(0, state["link"] - 1)
            elif name in BLOCK_TAGS:
                flush()
                close(name)
            continue
        if name in RAW_TAGS | SKIPPED_TAGS - unclosed and not found[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            if end or name in RAW_TAGS:
                at = end.end() if end else len(page)
                if name in BLOCK_TAGS and name != "title":  # a drawing may have one
                    flush()
                continue
            unclosed.add(name)
        if name == "a":
            state["link"] += 1
        elif name == "br":
            add(" ")
        if name not in BLOCK_TAGS:
            continue
        flush()
        if name in VOID_TAGS:
            continue
        if name in _CLOSES_P and any(n == "p" for n, _ in stack):
            close("p")
        if name in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            stack.pop()
        marks = " ".join(next(filter(None, m[1:]), "") for m in _MARKS.findall(found[3]))
        stack.append((name, name + "".join("." + w for w in _names(marks))))
    flush()
    return out


_COMMON = re.compile(r"[.!?…]['\")\]]*$")


def path_features(path: tuple[str, ...], outside: bool) -> list[str]:
    """Ancestor features: tag names; classes and ids as whole names, and of
    compounds the last word and the others (a comment-list is a list of
    comments, a notice-board no notice); the leaf's own tag; and whether the page
    has an article or main element in which the block does not stand."""
    out = set()
    for label in path:
        tag, *names = label.split(".")
        out.add("in:" + tag)
        for name in names:
            *mods, head = name.split("-")
            out.add("name:" + name)
            if mods:
                out.add("head:" + head)
                out.update("mod:" + m for m in mods)
    last = path[-1].split(".")[0] if path else "none"
    return sorted(out) + ["leaf:" + last] + ["outside"] * outside


def outside(page: Sequence[Block]) -> list[bool]:
    """Which blocks stand outside the article or main elements of a page that has some."""
    inside = [any(label.split(".")[0] in ("article", "main") for label in b.path) for b in page]
    return [any(inside) and not i for i in inside]


def text_features(block: Block, place: int, of: int) -> list[str]:
    words = block.text.count(" ") + 1
    out = ["bias", f"words:{min(words.bit_length(), 7)}", f"links:{int(block.links * 3.99)}"]
    out.append("ends" if _COMMON.search(block.text) else "open")
    if "©" in block.text or "|" in block.text:
        out.append("mark")
    out.append("first" if place == 0 else "last" if place == of - 1 else "middle")
    return out


class Crf:
    """Two-label linear-chain CRF: weights of (feature, label) and of label pairs."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.index, self.weights, self.pairs = index, weights, pairs
        self._paths: dict[tuple, np.ndarray] = {}

    def score(self, features: Sequence[str]) -> np.ndarray:
        on = [self.index[f] for f in features if f in self.index]
        return self.weights[on].sum(axis=0)

    def decode(self, page: Sequence[Block]) -> list[int]:
        """Viterbi: the most likely labels (1: main text)."""
        if len(self._paths) > 50_000:
            self._paths.clear()
        back, (p00, p01), (p10, p11), s0, s1 = [], *self.pairs.tolist(), 0.0, 0.0
        for i, (b, out) in enumerate(zip(page, outside(page), strict=True)):
            if (own := self._paths.get((b.path, out))) is None:
                own = self._paths[b.path, out] = self.score(path_features(b.path, out))
            e0, e1 = (own + self.score(text_features(b, i, len(page)))).tolist()
            if i == 0:
                s0, s1 = e0, e1
                continue
            b0, b1 = s1 + p10 > s0 + p00, s1 + p11 > s0 + p01
            s0, s1 = e0 + (s1 + p10 if b0 else s0 + p00), e1 + (s1 + p11 if b1 else s0 + p01)
            back.append((int(b0), int(b1)))
        labels = [int(s1 > s0)] if page else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def fit(pages: Sequence[tuple[list[Block], list[int]]], steps: int = 150, l2: float = 0.001, least: int = 3) -> Crf:
    """Maximum likelihood with an L2 penalty, by Adam on all pages at once.
    Features of fewer than ``least`` blocks are left out."""
    pages = [p for p in pages if p[0]]
    feats = [path_features(b.path, out) + text_features(b, i, len(bs)) for bs, _ in pages for i, (b, out) in enumerate(zip(bs, outside(bs), strict=True))]
    counts = Counter(f for fs in feats for f in fs)
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= least))}
    # Blocks are rows; ``on`` holds the features of each, one after the other.
    active = [[index[f] for f in fs if f in index] for fs in feats]
    on, row = np.concatenate(active), np.repeat(np.arange(len(active)), [len(a) for a in active])
    sizes = np.array([len(bs) for bs, _ in pages])
    page, place = np.repeat(np.arange(len(pages)), sizes), np.concatenate([np.arange(n) for n in sizes])
    label = np.concatenate([np.asarray(y) for _, y in pages])
    longest = int(sizes.max())
    real = np.arange(longest) < sizes[:, None]
    both = real[:, 1:]

    def gathered(per_block: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(on, per_block[row, k], len(index)) for k in (0, 1)], axis=1)

    one = np.eye(2)[label]
    shown = np.zeros((len(pages), longest, 2))
    shown[page, place] = one
    want, want_pairs = gathered(one), np.einsum("ptl,ptm->lm", shown[:, :-1] * both[..., None], shown[:, 1:])
    theta = np.zeros((len(index) + 2, 2))  # the last two rows: label pairs
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for step in range(1, steps + 1):
        trans, emit = theta[-2:], np.zeros((len(pages), longest, 2))
        emit[page, place] = np.stack([np.bincount(row, theta[on, k], len(label)) for k in (0, 1)], axis=1)
        fwd, bwd = emit.copy(), np.zeros_like(emit)
        for t in range(1, longest):
            go = emit[:, t] + lse(fwd[:, t - 1, :, None] + trans, 1)
            fwd[:, t] = np.where(real[:, t, None], go, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            go = lse(trans + (emit[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
            bwd[:, t] = np.where(real[:, t + 1, None], go, 0)
        whole = lse(fwd[:, -1], 1)[:, None, None]
        p = np.exp(fwd + bwd - whole)
        pp = np.exp(fwd[:, :-1, :, None] + trans + (emit + bwd)[:, 1:, None, :] - whole[..., None]) * both[..., None, None]
        grad = np.concatenate([want - gathered(p[page, place]), want_pairs - pp.sum(axis=(0, 1))]) / len(pages) - l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(index, theta[:-2], theta[-2:])


# ------------------------------------------------------------ labelled pages
_MARK = "\ue000"
# In all patterns: {w}: a few words, {s}: a sentence, {l}: links, {c}: a name that
# says nothing, or a compound of a word that elsewhere means clutter.
_SHELLS = [  # where main text stands: (opening, closing)
    ("<article>", "</article>"), ("<main>", "</main>"), ('<main><article class="post">', "</article></main>"), ('<article class="{c}">', "</article>"),
    ('<div id="content"><div class="entry-content">', "</div></div>"), ('<div class="article-body">', "</div>"), ('<article><div class="{c}">', "</div></article>"),
    ('<section class="story">', "</section>"), ('<div class="main"><section>', "</section></div>"), ('<article id="post"><div class="text">', "</div></article>"),
    ("", ""), ("", ""), ("<div>", "</div>"), ("<div><div>", "</div></div>"), ('<div class="page">', "</div>"), ('<div class="{c}">', "</div>"), ('<div id="wrapper"><div class="{c}">', "</div></div>"),
    ("<section>", "</section>"), ('<main class="{c}"><section>', "</section></main>"), ("<table><tr><td>", "</td></tr></table>"), ('<div class="container"><div class="row">', "</div></div>"),
]
_CLUTTER = [  # what surrounds or interrupts it
    "<nav><ul>{l}</ul></nav>", '<div class="menu"><ul>{l}</ul></div>', '<ul id="navigation">{l}</ul>', '<div class="breadcrumb">{l}</div>',
    "<header><h2>{w}</h2><p>{s}</p></header>", '<div id="header"><p>{s}</p></div>', "<footer>{s}</footer>", "<footer><p>&copy; {w}</p></footer>",
    '<div class="footer"><p>{s}</p></div>', "<aside><h3>{w}</h3><ul>{l}</ul></aside>", "<aside><p>{s}</p></aside>",
    '<div class="sidebar"><h4>{w}</h4><p>{s}</p></div>', '<div class="related"><h4>{w}</h4><ul>{l}</ul></div>', '<div class="ad">{s}</div>',
    '<div class="ads"><p>{s}</p></div>', '<div class="advert">{s}</div>', '<div class="advertisement"><p>{s}</p></div>', '<div class="sponsored promo">{s}</div>',
    '<div class="banner">{w}</div>', '<div class="cookie-notice"><p>{s}</p><button>{w}</button></div>', '<div id="cookie-consent">{s}</div>',
    '<div class="notice">{s}</div>', '<p class="notice">{s}</p>', '<div class="popup modal"><p>{s}</p></div>', '<div class="newsletter subscribe"><p>{s}</p></div>',
    "<form><label>{w}</label><input><button>{w}</button></form>", '<form class="search"><p>{s}</p></form>', '<div class="share social">{l}</div>',
    '<div class="comments"><h3>{w}</h3><div class="comment"><p>{s}</p></div><div class="comment"><p>{s}</p></div></div>',
    '<section id="comments"><ol><li><p>{s}</p></li><li><p>{s}</p></li></ol></section>', '<div class="comment"><p>{s}</p></div>',
    '<div class="meta byline">{w}</div>', '<div class="pagination">{l}</div>', '<div class="disclaimer">{s}</div>', '<div class="copyright legal">{s}</div>',
    "<dialog><p>{s}</p></dialog>", '<div role="navigation">{l}</div>', '<div role="banner">{w}</div>', '<div role="complementary"><p>{s}</p></div>',
    '<p class="ad">{s}</p>', '<p class="advert">{s} {s}</p>', '<p class="promo">{s}</p>', '<section class="ad"><p>{s} {s}</p></section>', '<ul class="menu">{l}</ul>',
    '<p class="comment">{s}</p>', '<p class="footer">{s}</p>', '<p class="copyright">{s}</p>', '<li class="comment">{s}</li>', '<td class="sidebar">{s}</td>',
]
#: Words that mean clutter, and what they are compounded with: behind another
#: word or before a word for a container they still do, before any other word they don't.
_CLUTTER_WORDS = "ad ads advert banner comment comments cookie footer header menu nav navigation newsletter notice popup promo related share sidebar social sponsor".split()
_CONTAINERS = "area bar block bottom box container inner left links list panel right section slot top widget wrapper".split()
_NEUTRAL = "article body chapter column content copy entry essay holder lead page paper part post report story text unit".split()
_PROSE = ["<h1>{w}</h1>", "<h2>{w}</h2>", "<p>{s}</p>", "<p>{s} {s} {s}</p>", "<p><b>{s}</b><br>", "<p>{s} <a href='x'>{w}</a> {s}</p>", "<ul><li>{s}</li><li>{w}</li></ul>", "<ol><li>{s}</li><li>{s}</li></ol>",
          "<blockquote>{s}</blockquote>", "<pre>{w}</pre>", "<p>{w}</p>", "<table><tr><td>{w}</td><td>{s}</td></tr></table>", "<h3>{w}</h3><p>{s} {s}</p>", "<figure><figcaption>{s}</figcaption></figure>",
          "<div>{s}</div>", "<div>{s} {s}</div>", "<div><p>{s}</p><p>{s} {s}</p></div>", "<section><h2>{w}</h2><p>{s}</p></section>", "<div class='{c}'>{s}</div>", "<div class='{c}'><p>{s}</p></div>",
          "<p class='{c}'>{s} {s}</p>", "<dl><dt>{w}</dt><dd>{s}</dd></dl>", "{s} {s}<br>", "<div><div>{s}</div></div>"]


def labelled_pages(n: int = 600, seed: int = 5) -> list[tuple[list[Block], list[int]]]:
    """Pages of common layouts, made up of the patterns above, whose blocks are
    labelled by the part of the pattern that they come from."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdeghiklmnoprstuv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def neutral() -> str:
        kind = rng.random()
        return rng.choice(_NEUTRAL) if kind < 0.35 else f"{word()}-{rng.choice(_NEUTRAL)}" if kind < 0.5 else f"{rng.choice(_CLUTTER_WORDS)}-{rng.choice(('on-', '', ''))}{word()}" if kind < 0.8 else word()

    def fill(pattern: str) -> str:
        some = lambda lo, hi: " ".join(word() for _ in range(rng.randint(lo, hi)))
        while "{" in pattern:
            i = pattern.index("{")
            kind = pattern[i + 1]
            new = some(1, 5) if kind == "w" else neutral() if kind == "c" else (some(3, 30).capitalize() + rng.choice("...!?")) if kind == "s" else "".join(
                f"<li><a href='/{word()}'>{some(1, 2)}</a></li>" for _ in range(rng.randint(2, 7)))
            pattern = pattern[:i] + new + pattern[i + 3 :]
        return pattern

    def compound() -> str:
        """Clutter whose name is a compound."""
        w, tag = rng.choice(_CLUTTER_WORDS), rng.choice(("div", "div", "section", "p", "ul"))
        name = rng.choice((f"{word()}-{w}", f"site-{w}", f"{w}-{rng.choice(_CONTAINERS)}"))
        inner = "{l}" if tag == "ul" else rng.choice(("{s}", "{s} {s}")) if tag == "p" else rng.choice(("{s}", "<p>{s}</p>", "<h4>{w}</h4><p>{s}</p>"))
        return f'<{tag} {rng.choice(("class", "id"))}="{name}">{inner}</{tag}>'

    out = []
    for _ in range(n):
        head, tail = rng.choice(_SHELLS)
        clutter = lambda k: [(fill(compound() if rng.random() < 0.25 else c), 0) for c in rng.sample(_CLUTTER, k)]
        prose = [(fill(rng.choice(_PROSE)), 1) for _ in range(rng.randint(1, 12))]
        for c in clutter(rng.choice((0, 0, 1, 2, 3))):  # clutter inside the article
            prose.insert(rng.randint(0, len(prose)), c)
        body = [*clutter(rng.randint(0, 4)), (fill(head), None), *prose, (tail, None), *clutter(rng.randint(0, 4))]
        # Main pieces carry a mark through the parser, so that their blocks can be told apart.
        page = "".join(re.sub(r"(^|>)([^<\s])", f"\\1{_MARK}\\2", p) if y else p for p, y in body)
        cut = blocks(f"<html><head><title>{word()}</title></head><body>{page}</body></html>")
        labels = [int(_MARK in b.text) for b in cut]
        for b in cut:
            b.text = " ".join(b.text.replace(_MARK, "").split())
        out.append((cut, labels))
    return out


def train() -> Crf:
    return fit(labelled_pages())


def main_text(page: str | None, model: Crf) -> str:
    cut = blocks(page)
    return "\n".join(b.text for b, y in zip(cut, model.decode(cut), strict=True) if y)


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(h, model) for h in part["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train())
    return pages.select(pages["page_id"].cast("long").alias("page_id"), "url", "html").mapInArrow(
        _extract(shared), "page_id long, url string, text string, n_chars long")
