"""Main text of web pages: a bidirectional LSTM labels each block of a page from its tag path, its words and its neighbours."""

from __future__ import annotations

import html
import random
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PATHS, _WORDS, _NUMBERS = 256, 64, 8
FEATURES = _PATHS + _WORDS + _NUMBERS

# Elements of HTML by their role in layout.
_RAW = frozenset("script style".split())
_HIDDEN = frozenset("noscript template svg iframe object head annotation annotation-xml".split())
#: What may stand in a head; anything else ends one whose end tag is left out.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Start tags that end a drawing or a formula which was left open, unless they are inside a part of it that may hold HTML.
_BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
                      "pre ruby s small span strong strike sub sup table tt u ul var article section main header footer nav aside form figure".split())
_ENDED_EARLY = frozenset(("head", "svg", "math"))
_FOREIGN, _HTML_INSIDE = frozenset(("svg", "math")), frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr "
                    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
                    "msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation annotation-xml".split())
_CLOSED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                   "th": ("td", "th"), "option": ("option",)}
_STOPS = frozenset("ul ol dl table div section article main aside nav header footer body form blockquote".split())
_NOT_CLOSED_BEYOND = _STOPS | _HIDDEN
_NOT_BROKEN_OUT_OF = _HTML_INSIDE - {"title"} | {"noscript", "template", "object"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[A-Za-z]+")
_WORD = re.compile(r"\w+")


class _Open:
    """An open element and those around it. ``marks`` has a bit for each bucket of the hashed path down to it, ``depth`` counts
    the path's parts, so a block costs the same however deep it lies."""

    __slots__ = ("name", "own", "around", "marks", "depth")

    def __init__(self, name: str, own: tuple[str, ...], around: _Open | None):
        self.name, self.own, self.around = name, own, around
        self.marks, self.depth = (around.marks, around.depth) if around else (0, 0)
        self.depth += 1 + len(own)
        for part in (name, *own):
            if part not in ("html", "body"):
                self.marks |= 1 << _bucket(part, _PATHS)


@dataclass
class Block:
    """A run of text without a block boundary in it. ``path`` holds the open elements and the parts of their class, id and
    role; ``linked`` counts characters in links."""

    text: str
    inside: _Open | None
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        parts, at = [], self.inside
        while at:
            parts.append((at.name, *at.own))
            at = at.around
        return tuple(x for own in reversed(parts) for x in own)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order: references decoded, white space made one space, no scripts, styles, comments.

    Any text will do as a page: unknown tags count as blocks, unclosed elements end with their parents, and a ``<`` that
    begins no tag is text. What a browser does not show of other elements (head, svg, noscript ...) is left out up to
    their end; a head ends where something begins that cannot stand in it, and one of the others that is never closed on the
    page is empty. Null has no blocks.
    """
    page = page or ""
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}  # where in the stack elements of a name are, and by kind those that end a search
    barriers: list[int] = []
    shelters: list[int] = []
    found: list[Block] = []
    parts: list[str] = []
    linked = links = hidden = early = at = 0
    ends: dict[str, int] = {}

    def closed_later(name: str) -> bool:
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(rf"</{re.escape(name)}(?=[\s/>])", page, re.I)), default=-1)
        return ends[name] >= at

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            found.append(Block(text, stack[-1] if stack else None, min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal links, hidden, early
        if not places.get(name):
            return
        for k in range(len(stack) - 1, places[name][-1] - 1, -1):
            gone = stack.pop().name
            places[gone].pop()
            for kind in (barriers, shelters):
                if kind and kind[-1] == k:
                    kind.pop()
            links -= gone == "a"
            hidden -= gone in _HIDDEN
            early -= gone in _ENDED_EARLY

    def close_innermost(names: Sequence[str], limits: list[int]) -> None:
        """Ends the innermost open element of these names, unless one that ends the search lies inside it."""
        k = max((places[n][-1] for n in names if places.get(n)), default=-1)
        if k > (limits[-1] if limits else -1):
            close(stack[k].name)

    def text_to(end: int) -> None:
        nonlocal linked
        if stack and stack[-1].name == "head" and page[at:end].strip():
            close("head")
        if end > at and not hidden:
            parts.append(page[at:end])
            if links:
                linked += end - at

    while match := _TAG.search(page, at):
        text_to(match.start())
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if name not in _INLINE:
            flush()
        elif name == "br":
            parts.append(" ")
        if match[1]:
            close(name)
            continue
        if early:
            close_innermost([*(() if name in _IN_HEAD else ("head",)), *(_FOREIGN if name in _BREAKOUT else ())], shelters)
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _VOID or match[3].endswith("/") or name in _HIDDEN and name != "head" and not closed_later(name):
            continue
        closed = _CLOSED_BY_NEXT.get(name, ())
        close_innermost(closed if name in _INLINE or name in _HIDDEN else (*closed, "p"), barriers)
        own = tuple("." + x.lower() for values in _NAMES.findall(match[3]) for x in _NAME_PARTS.findall("".join(values)))
        places.setdefault(name, []).append(len(stack))
        if name in _NOT_CLOSED_BEYOND:
            barriers.append(len(stack))
        if name in _NOT_BROKEN_OUT_OF:
            shelters.append(len(stack))
        stack.append(_Open(name, own, stack[-1] if stack else None))
        links += name == "a"
        hidden += name in _HIDDEN
        early += name in _ENDED_EARLY
    text_to(len(page))
    flush()
    return found


@lru_cache(100_000)
def _bucket(text: str, buckets: int) -> int:
    return crc32(text.encode("utf-8", "replace")) % buckets


def features(page: Sequence[Block], first: int = 0, end: int | None = None) -> np.ndarray:
    """One row per block, from block ``first`` to before ``end``: hashed tag path, hashed words, and a few numbers on length, links and place."""
    some = page[first:end]
    out = np.zeros((len(some), FEATURES), dtype="float32")
    marks = b"".join((b.inside.marks if b.inside else 0).to_bytes(_PATHS // 8, "little") for b in some)
    out[:, :_PATHS] = np.unpackbits(np.frombuffer(marks, dtype="uint8").reshape(-1, _PATHS // 8), axis=1, bitorder="little")
    for k, block in enumerate(some, first):
        row = out[k - first]
        words = _WORD.findall(block.text.lower())
        if words:
            hashed = np.bincount([_bucket(w, _WORDS) for w in words], minlength=_WORDS)
            row[_PATHS:_PATHS + _WORDS] = np.sqrt(hashed / len(words))
        size = len(block.text)
        row[_PATHS + _WORDS:] = (np.log1p(size) / 8, np.log1p(len(words)) / 6, block.linked / size, block.text[-1] in ".!?…。",
                                 k == 0, k == len(page) - 1, (block.inside.depth if block.inside else 0) / 20,
                                 sum(c.isdigit() for c in block.text[:200]) / min(size, 200))
    return out


class Labeller:
    """A bidirectional LSTM with a logistic output, in numpy. Sequences are padded behind and masked."""

    def __init__(self, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        wide = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("float32")
        self.hidden = hidden
        self.weights = {f"{side}{name}": value for side in "fb" for name, value in (
            ("W", wide(FEATURES, 4 * hidden) * 2), ("U", wide(hidden, 4 * hidden)), ("c", np.zeros(4 * hidden, "float32")))}
        self.weights |= {"V": wide(2 * hidden, 1), "d": np.zeros(1, "float32")}

    def _inputs(self, side: str, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[f"{side}W"] + self.weights[f"{side}c"]

    def _run(self, side: str, inputs: np.ndarray, mask: np.ndarray, traced: bool = False) -> tuple[np.ndarray, list]:
        h = c = np.zeros((inputs.shape[1], self.hidden), "float32")
        n, trace, out = self.hidden, [], np.zeros((*inputs.shape[:2], self.hidden), "float32")
        for t in range(len(inputs)) if side == "f" else range(len(inputs) - 1, -1, -1):
            z = inputs[t] + h @ self.weights[f"{side}U"]
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * n], -30, 30)))
            i, f, o, g = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:], np.tanh(z[:, 3 * n:])
            new = f * c + i * g
            m = mask[t][:, None]
            if traced:
                trace.append((t, i, f, o, g, c, h, np.tanh(new), m))
            c = m * new + (1 - m) * c
            h = m * o * np.tanh(new) + (1 - m) * h
            out[t] = h
        return out, trace

    def _output(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        return (np.concatenate([forward, backward], axis=2) @ self.weights["V"] + self.weights["d"])[:, :, 0]

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self._output(*(self._run(side, self._inputs(side, x), mask)[0] for side in "fb"))

    def score_pages(self, pages: Sequence[Sequence[Block]], slice_rows: int = 4096) -> list[np.ndarray]:
        """Scores of the blocks of each page, pages side by side. Features are made and multiplied a slice at a time."""
        mask = np.zeros((max(map(len, pages)), len(pages)), "float32")
        inputs = {side: np.zeros((*mask.shape, 4 * self.hidden), "float32") for side in "fb"}
        for lane, page in enumerate(pages):
            mask[:len(page), lane] = 1
            for first in range(0, len(page), slice_rows):
                x = features(page, first, first + slice_rows)
                for side in "fb":
                    inputs[side][first:first + len(x), lane] = self._inputs(side, x)
        both = self._output(*(self._run(side, inputs.pop(side), mask)[0] for side in "fb"))
        return [both[:len(page), lane] for lane, page in enumerate(pages)]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {side: self._run(side, self._inputs(side, x), mask, traced=True) for side in "fb"}
        score = self._output(runs["f"][0], runs["b"][0])
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        slope = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y) * mask / mask.sum()
        out = {"V": np.einsum("tbh,tb->h", both, slope)[:, None], "d": slope.sum(keepdims=True)[0]}
        n = self.hidden
        for k, side in enumerate("fb"):
            push = slope[:, :, None] * self.weights["V"][k * n:(k + 1) * n, 0]
            dz_all = np.zeros((*x.shape[:2], 4 * n), "float32")
            dh = dc = np.zeros((x.shape[1], n), "float32")
            du = np.zeros_like(self.weights[f"{side}U"])
            for t, i, f, o, g, c_before, h_before, tanh_c, m in reversed(runs[side][1]):
                dh_all = dh + push[t]
                inner = m * dh_all
                dcell = dc * m + inner * o * (1 - tanh_c ** 2)
                dz = np.concatenate([dcell * g * i * (1 - i), dcell * c_before * f * (1 - f), inner * tanh_c * o * (1 - o),
                                     dcell * i * (1 - g ** 2)], axis=1)
                dz_all[t] = dz
                du += h_before.T @ dz
                dh = dz @ self.weights[f"{side}U"].T + (1 - m) * dh_all
                dc = dcell * f + (1 - m) * dc
            flat = dz_all.reshape(-1, 4 * n)
            out |= {f"{side}U": du, f"{side}W": x.reshape(-1, FEATURES).T @ flat, f"{side}c": flat.sum(axis=0)}
        return out


def _padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, pages)), len(pages), FEATURES), "float32")
    mask = np.zeros(x.shape[:2], "float32")
    for k, page in enumerate(pages):
        x[:len(page), k] = page
        mask[:len(page), k] = 1
    return x, mask


# Names that page authors give to containers. Training pages draw from them.
_ASIDE_NAMES = ("nav menu navbar navigation topbar breadcrumb breadcrumbs sidebar side widget ad ads advert advertisement sponsor banner promo "
                "cookie consent notice alert popup modal newsletter subscribe signup share social related recommended footer header masthead "
                "copyright comments comment replies reply respond discussion login search form pagination toolbar tags meta skip legal").split()
_MAIN_NAMES = "content main post entry article story body text page single blog news document section wrapper container".split()
_ASIDE_TAGS = "nav header footer aside form".split()
_ASIDE_WORDS = ("home about contact login register menu search subscribe newsletter cookie cookies privacy policy terms copyright rights reserved "
                "share follow comment comments reply posted advertisement sponsored accept close next previous more related read sign").split()


def training_page(rng: random.Random) -> tuple[str, list[int]]:
    """A made-up page and, for each of its blocks, whether it belongs to the article."""
    syllables = [rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiouéäó") + rng.choice(["", "n", "r", "s"]) for _ in range(40)]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])
    labels: list[int] = []

    def leaf(label: int, tag: str, n: int, link: bool = False, aside_words: bool = False) -> str:
        labels.append(label)
        text = sentence(n)
        if aside_words:
            text = " ".join(rng.choice(_ASIDE_WORDS) if rng.random() < 0.5 else x for x in text.split())
        if link:
            text = f'<a href="/{word()}">{text}</a>'
        elif rng.random() < 0.15:
            text = rng.choice(["<b>{}</b>", "<em>{}</em>", '<span class="x">{}</span>', "<b>{}", '<a href="#">{}</a>']).format(text)
        return f"<{tag}>{text}" + ("" if tag in ("p", "li") and rng.random() < 0.2 else f"</{tag}>")

    def named(tag: str, names: Sequence[str], inside: str) -> str:
        kind = rng.choice(["class", "class", "id"])
        return f'<{tag} {kind}="{rng.choice(names)}{rng.choice(["", "-" + word(), " " + word()])}">{inside}</{tag}>'

    def aside() -> str:
        shape = rng.random()
        if shape < 0.35:
            inside = "<ul>" + "".join(leaf(0, "li", rng.randint(1, 3), True, rng.random() < 0.4) for _ in range(rng.randint(2, 8))) + "</ul>"
        elif shape < 0.7:
            labels.append(0)
            inside = sentence(rng.randint(3, 30))
        else:
            inside = "".join(leaf(0, rng.choice(["p", "div", "h3"]), rng.randint(1, 25), rng.random() < 0.2, rng.random() < 0.4) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.55:
            return named("div", _ASIDE_NAMES, inside)
        tag = rng.choice(_ASIDE_TAGS)
        return f"<{tag}>{inside}</{tag}>" if rng.random() < 0.6 else named(rng.choice([tag, "section"]), _ASIDE_NAMES, inside)

    def main() -> str:
        out = [leaf(1, rng.choice(["h1", "h1", "h2"]), rng.randint(2, 9))] if rng.random() < 0.9 else []
        for _ in range(rng.choice([1, 2, 4, 8, 16])):
            shape = rng.random()
            if shape < 0.75:
                out.append(leaf(1, "p", rng.choice([1, 3, 8, 20, 60])))
            elif shape < 0.82:
                out.append(leaf(1, rng.choice(["h2", "h3"]), rng.randint(1, 6)))
            elif shape < 0.88:
                out.append("<ul>" + "".join(leaf(1, "li", rng.randint(2, 15)) for _ in range(rng.randint(1, 4))) + "</ul>")
            elif shape < 0.92:
                out.append(leaf(1, rng.choice(["blockquote", "pre", "td", "figcaption"]), rng.randint(3, 20)))
            else:
                out.append(aside())
        inside = "".join(out)
        return (f"<article>{inside}</article>" if rng.random() < 0.5 else named("div", _MAIN_NAMES, inside) if rng.random() < 0.6
                else f"<main>{named('section', _MAIN_NAMES, inside)}</main>")

    before = "".join(aside() for _ in range(rng.randint(0, 4)))
    middle = main()
    after = "".join(aside() for _ in range(rng.randint(0, 4)))
    if rng.random() < 0.3:
        return f'<html><body><div class="{rng.choice(_MAIN_NAMES)}">{before}{middle}{after}</div></body></html>', labels
    return f"<html><head><title>{word()}</title></head><body>{before}{middle}{after}</body></html>", labels


@lru_cache(2)
def trained(pages: int = 600, rounds: int = 12, hidden: int = 16, seed: int = 7) -> Labeller:
    """A labeller trained on made-up pages, whose blocks are labelled by construction; the same each time."""
    rng = random.Random(seed)
    known = []
    while len(known) < pages:
        page, labels = training_page(rng)
        found = blocks(page)
        if len(found) == len(labels) and found:
            known.append((features(found), np.array(labels, "float32")))
    known.sort(key=lambda x: len(x[0]))
    groups = [known[k:k + 30] for k in range(0, len(known), 30)]
    model = Labeller(hidden, seed)
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for turn in range(rounds):
        rng.shuffle(groups)
        for group in groups:
            x, mask = _padded([page for page, _ in group])
            y = np.zeros(mask.shape, "float32")
            for k, (_, labels) in enumerate(group):
                y[:len(labels), k] = labels
            step += 1
            for name, slope in model.gradients(x, mask, y).items():
                mean[name] = 0.9 * mean[name] + 0.1 * slope
                square[name] = 0.99 * square[name] + 0.01 * slope ** 2
                size = 0.02 * (1 - turn / (rounds + 1))
                model.weights[name] -= (size * mean[name] / (1 - 0.9 ** step) / (
                    np.sqrt(square[name] / (1 - 0.99 ** step)) + 1e-7)).astype("float32")
    return model


def main_text(pages: Sequence[str | None], model: Labeller, lanes: int = 64, cells: int = 65_536) -> list[str]:
    """The article blocks of each page, joined by line breaks.

    Pages of like length are labelled side by side, at most ``lanes`` of them and so many that, padded to the longest, they
    take at most ``cells`` blocks; a page longer than that is labelled alone, in memory in proportion to its own blocks.
    """
    found = [blocks(page) for page in pages]
    out = [""] * len(found)
    order = sorted((k for k in range(len(found)) if found[k]), key=lambda k: len(found[k]))
    while order:
        # From the longest down: the first of a group decides what each lane takes.
        count = max(1, min(lanes, cells // len(found[order[-1]])))
        group, order = order[-count:], order[:-count]
        for k, scores in zip(group, model.score_pages([found[k] for k in group]), strict=True):
            out[k] = "\n".join(b.text for b, score in zip(found[k], scores, strict=True) if score > 0)
    return out


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``; other columns stay (one named text is replaced).

    Null and empty html, and pages without an article, give an empty text. The whole page is read. Equal pages give
    equal texts.
    """

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series(main_text(list(column), model), dtype="object")

    return pages.withColumn("text", run.asNondeterministic()("html"))
