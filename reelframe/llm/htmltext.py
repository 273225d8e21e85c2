"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with the tags and
class names above it. A block's features are those names and measures of its text; the field
adds how labels follow each other, and Viterbi picks the best labelling of the whole page.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import map_rows

#: Most pages the field is fitted on, in expectation, and as many composed of their blocks.
SAMPLE_PAGES = 400
STEPS = 200
RATE = 0.1
SHRINK = 1e-4

# Fixed values of the markup language: elements that start a block, those whose content is no
# text, those that a new element of the same kind closes, and those that hold the latter.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul option select title".split()
)
RAW = frozenset("script style template noscript iframe svg title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_LIKE = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead"), "tfoot": ("tbody", "thead"),
}
SCOPES = frozenset("ul ol dl table select".split())
KEPT_INLINE = frozenset("a b strong em i span label button time cite".split())

TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|$)",
    re.S,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKENS = re.compile(r"[a-z]+")
NOTICE_WORDS = re.compile(r"(?i)©|copyright|cookie|subscribe|newsletter|sign (?:in|up)|log ?in|advert|sponsor|privacy|comment|share|related|menu")

EXTRACTED = "page_id long, url string, text string"


@dataclass
class Block:
    """A piece of text, the names of all elements around it and of the nearest that starts a block,
    the words in their class names and ids, those of the nearest that has any, and the share of its
    text that is linked."""

    text: str
    above: frozenset[str]
    holder: str
    names: frozenset[str]
    inner: frozenset[str]
    linked: float


class Element:
    """An open element. What is above it is shared with the element around it unless it adds something,
    so that deep pages take memory in proportion to their length."""

    __slots__ = ("name", "above", "holder", "names", "inner")

    def __init__(self, name: str, words: frozenset[str], around: Element | None):
        self.name = name
        above, names = (around.above, around.names) if around else (NOTHING, NOTHING)
        self.above = above if name in above else above | {name}
        self.names = names if words <= names else names | words
        self.inner = words or (around.inner if around else NOTHING)
        self.holder = name if name in BLOCKS else around.holder if around else "none"


NOTHING: frozenset[str] = frozenset()


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks of a page in order, with their character references decoded and their white
    space collapsed. An unfinished tag at the end is dropped; missing end tags are implied."""
    blocks: list[Block] = []
    stack: list[Element] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, at = 0, 0
    place: Element | None = None
    placed = False

    def close() -> None:
        nonlocal linked, placed
        text = " ".join("".join(parts).split())
        if text and placed:
            around = (place.above, place.holder, place.names, place.inner) if place else (NOTHING, "none", NOTHING, NOTHING)
            blocks.append(Block(text, *around, linked / len(text)))
        parts.clear()
        linked, placed = 0, False

    def add(raw: str) -> None:
        nonlocal linked, place, placed
        text = html.unescape(raw)
        if text.strip():
            if not placed:
                place, placed = stack[-1] if stack else None, True
            if opened["a"]:
                linked += len(text.strip())
        parts.append(text)

    def pop_to(depth: int) -> None:
        opened.subtract(element.name for element in stack[depth:])
        del stack[depth:]

    while at < len(page):
        match = TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        name = (match[2] or match[5] or "").lower()
        if not name:
            continue
        if name in BLOCKS or name in RAW:
            close()
        if match[1] or match[4]:
            if opened[name]:
                pop_to(next(depth for depth in range(len(stack) - 1, -1, -1) if stack[depth].name == name))
            continue
        attributes = match[3] or match[6] or ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?![a-z0-9])[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            parts.append(" ")
        if name in VOID or attributes.endswith("/"):
            continue
        if name in BLOCKS:
            # A paragraph is only closed if it is what the new element would stand in.
            if opened["p"] and stack[-1].holder == "p":
                pop_to(next(depth for depth in range(len(stack) - 1, -1, -1) if stack[depth].name == "p"))
            likes = CLOSED_BY_LIKE.get(name, ())
            if any(opened[like] for like in likes):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name in SCOPES:
                        break
                    if stack[depth].name in likes:
                        pop_to(depth)
                        break
        if name in BLOCKS or name in KEPT_INLINE:
            found = {token for groups in NAMES.findall(attributes) for token in TOKENS.findall("".join(groups).lower())}
            stack.append(Element(name, frozenset(found), stack[-1] if stack else None))
            opened[name] += 1
    close()
    return blocks


def features(block: Block, index: int, count: int) -> list[str]:
    words = block.text.count(" ") + 1
    last, first = block.text[-1], block.text[0]
    found = {f"above {name}" for name in block.above}
    found |= {f"named {name}" for name in block.names}
    found |= {f"named nearest {name}" for name in block.inner}
    found.add(f"words {min(words, 64).bit_length()}")
    found.add(f"linked {round(min(block.linked, 1.0) * 3)}")
    found.add("ends a sentence" if last in ".!?…" else "ends in a word")
    if first.isupper():
        found.add("starts upper")
    if NOTICE_WORDS.search(block.text) and words < 30:
        found.add("speaks of the site")
    found.add("first" if index == 0 else "last" if index == count - 1 else "between")
    found.add(f"held by {block.holder}")
    found.add("bias")
    return sorted(found)


class Field:
    """Weights for the label 1 (main text) against 0, and for labels that follow each other."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.follow = np.zeros((2, 2))

    def train(self, pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> None:
        """Full-batch Adagrad on the log likelihood; sums over labellings go forward and backward
        over all pages at once."""
        pages = [page for page in pages if page[0]]
        if not pages:
            return
        number: dict[str, int] = {}
        owner, flat, starts = [], [], [0]
        for found, _ in pages:
            for names in found:
                flat += [number.setdefault(name, len(number)) for name in names]
                owner += [len(starts) - 1] * len(names)
                starts.append(len(flat))
        flat_ids, owners = np.array(flat), np.array(owner)
        sizes = np.array([len(found) for found, _ in pages])
        longest, n = sizes.max(), len(pages)
        rows = np.repeat(np.arange(n), sizes)
        columns = np.concatenate([np.arange(size) for size in sizes])
        gold = np.concatenate([labels for _, labels in pages])
        held = np.zeros((n, longest), bool)
        held[rows, columns] = True
        both = held[:, 1:] & held[:, :-1]
        truth = np.zeros((n, longest), int)
        truth[rows, columns] = gold
        seen = np.zeros((2, 2))
        np.add.at(seen, (truth[:, :-1][both], truth[:, 1:][both]), 1)
        weights, grown, grown_follow = np.zeros(len(number)), np.full(len(number), 1e-6), np.full((2, 2), 1e-6)
        for _ in range(steps):
            emitted = np.zeros((n, longest, 2))
            emitted[rows, columns, 1] = np.bincount(owners, weights[flat_ids], len(gold))
            ahead, behind = np.zeros_like(emitted), np.zeros_like(emitted)
            ahead[:, 0] = emitted[:, 0]
            for t in range(1, longest):
                step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + self.follow, axis=1) + emitted[:, t]
                ahead[:, t] = np.where(held[:, t, None], step, ahead[:, t - 1])
            for t in range(longest - 2, -1, -1):
                step = np.logaddexp.reduce(self.follow + (emitted[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
                behind[:, t] = np.where(held[:, t + 1, None], step, 0)
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)
            likely = np.exp(ahead + behind - total[:, None, None])[..., 1]
            slope = np.bincount(flat_ids, (likely[rows, columns] - gold)[owners], len(number)) / n + SHRINK * weights
            pairs = np.exp(
                ahead[:, :-1, :, None] + self.follow + (emitted + behind)[:, 1:, None, :] - total[:, None, None, None]
            )
            slope_follow = (pairs[both].sum(0) - seen) / n + SHRINK * self.follow
            grown += slope**2
            grown_follow += slope_follow**2
            weights -= RATE * slope / np.sqrt(grown)
            self.follow -= RATE * slope_follow / np.sqrt(grown_follow)
        self.weights = {name: float(weights[i]) for name, i in number.items()}

    def decode(self, found: list[list[str]]) -> list[int]:
        """The best labelling of a page (Viterbi); ties go to 0."""
        if not found:
            return []
        (f00, f01), (f10, f11) = self.follow.tolist()
        weights, best0, best1, back = self.weights, 0.0, 0.0, []
        for i, names in enumerate(found):
            score = sum(weights.get(name, 0.0) for name in names)
            if i == 0:
                best1 = score
                continue
            from0, from1 = best1 + f10 > best0 + f00, best1 + f11 >= best0 + f01
            back.append((int(from0), int(from1)))
            best0, best1 = max(best0 + f00, best1 + f10), max(best0 + f01, best1 + f11) + score
        labels = [int(best1 > best0)]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


CONTAINERS = frozenset(("article", "main"))
NOT_MAIN = frozenset("nav aside footer form header menu dialog select option button".split())
NOT_MAIN_NAMES = frozenset(
    "ad ads advert advertisement banner sponsored promo sidebar menu nav navigation footer header comment comments "
    "cookie cookies consent notice alert newsletter subscribe related share social breadcrumb breadcrumbs form login "
    "disclaimer popup modal widget reply replies".split()
)
MAIN_NAMES = ("content", "post", "entry", "story", "text", "body", "page")


def labels_of(blocks: list[Block]) -> list[int] | None:
    """Labels of a page whose markup tells: what its article holds, without asides and the like.
    None for a page without an article."""
    if not any(CONTAINERS.intersection(block.above) for block in blocks):
        return None
    return [
        int(bool(CONTAINERS.intersection(b.above)) and not NOT_MAIN.intersection(b.above) and not NOT_MAIN_NAMES & b.names)
        for b in blocks
    ]


def holder_of(path: Sequence[str]) -> str:
    """The nearest element of a path that starts a block."""
    return next((name for name in reversed(path) if name in BLOCKS), "none")


def composed(main: list[str], rest: list[str], seed: int) -> tuple[list[Block], list[int]]:
    """A labelled page of other markup, from texts whose labels are known."""
    rng = random.Random(seed)
    holder = rng.choice(["article", "main", "section", "div", "div", "td"])
    names = frozenset({rng.choice(MAIN_NAMES)} if holder in ("section", "div") else ())
    above = ("html", "body", holder)
    blocks, labels = [], []

    def around(count: int, within: bool = False) -> None:
        for _ in range(count):
            if rng.random() < 0.5:
                outer, own = rng.choice(sorted(NOT_MAIN)), frozenset()
            else:
                outer, own = rng.choice(["div", "section", "ul"]), frozenset({rng.choice(sorted(NOT_MAIN_NAMES))})
            inside = within or rng.random() < 0.3
            path = (*(above if inside else above[:2]), outer, rng.choice(["p", "li", "div", "span", "h3"]))
            linked = 1.0 if rng.random() < 0.4 else 0.0
            for _ in range(rng.randint(1, 1 if within else 4)):
                text = rng.choice(main if rng.random() < 0.4 else rest) if rest else rng.choice(main)
                blocks.append(Block(text, frozenset(path), holder_of(path), own | (names if inside else frozenset()), own or (names if inside else own), linked))
                labels.append(0)

    around(rng.randint(1, 4))
    for i, text in enumerate(main):
        tag = "h1" if i == 0 else rng.choice(["p", "p", "p", "p", "li", "h2", "blockquote", "pre"])
        blocks.append(Block(text, frozenset((*above, tag)), tag, names, names, 0.0))
        labels.append(1)
        if i and rng.random() < 0.15:
            around(1, within=True)
    around(rng.randint(1, 4))
    return blocks, labels


#: A page that may mark its article.
MARKED = "(?i)<(article|main)[\\s>/]"


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Field:
    """A field fitted on about ``sample_pages`` pages whose article is marked, chosen by a hash of
    what they hold, copies being one, and as many pages composed of their texts in other markup.
    Half of the former hide the article tag, so that text and other names are learned too.

    A table whose pages mark no article, but hold text, is refused: there is nothing to learn from,
    and all its texts would be empty.
    """
    marked = pages.where(F.col("html").rlike(MARKED))
    share = min(1.0, sample_pages / max(marked.count(), 1))
    part = F.pmod(F.xxhash64("html"), F.lit(1_000_000)) / 1_000_000
    rows = marked.where(part < share).groupBy("html").agg(F.min(F.col("page_id").cast("long")).alias("page_id")).collect()
    training = []
    for number, row in enumerate(sorted(rows, key=lambda row: (row["page_id"] or 0, row["html"]))):
        blocks = blocks_of(row["html"])
        labels = labels_of(blocks)
        if labels is None:
            continue
        main = [b.text for b, y in zip(blocks, labels, strict=True) if y]
        rest = [b.text for b, y in zip(blocks, labels, strict=True) if not y]
        if number % 2:
            hidden = {"holder": "div"}
            blocks = [replace(b, above=b.above - CONTAINERS, **(hidden if b.holder in CONTAINERS else {})) for b in blocks]
        training.append((blocks, labels))
        if main:
            training.append(composed(main, rest, number))
    if not training and not pages.where(F.col("html").rlike(r"[^\s<>][^<>]*(<|$)")).isEmpty():
        raise ValueError("no page marks its article: there is nothing to learn main text from")
    field = Field()
    field.train([([features(b, i, len(blocks)) for i, b in enumerate(blocks)], labels) for blocks, labels in training])
    return field


def main_text(page: str, field: Field) -> str:
    blocks = blocks_of(page)
    labels = field.decode([features(block, i, len(blocks)) for i, block in enumerate(blocks)])
    return "\n".join(block.text for block, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, url, text): the main text of each whole page, its blocks joined by line feeds.

    A null or empty page, and one without main text, gives the empty text. Null ids and repeated
    rows are kept; other columns are ignored, whatever their names. No shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = [main_text(page or "", field) for page in batch.column(2).to_pylist()]
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts}

    return map_rows(pages.select(F.col("page_id").cast("long"), "url", "html"), task, EXTRACTED)
