"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Each block is described by the tags and names that enclose it and by its text; the field labels the blocks
of a page as main text or not, and Viterbi finds the best labels together. It is trained on labelled
pages: sampled pages that say by their elements which part is the article, and the same blocks laid
out anew in other common ways, with side bars, notices, adverts, forms and comments around them, so that
it does not lean on one layout.

Null and empty html have no blocks, and an empty text. Repeated pages get the same answer. Without any
page to learn from, all blocks count as main text. Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from widefold.llm.common import read_table
from widefold.llm.html_blocks import Block, blocks_of

FEATURES = 1 << 14
#: So many pages that tell their article, none longer than so many characters, are learned from.
SAMPLE_PAGES = 150
SAMPLE_CHARS = 60_000
LAYOUTS = 3
EPOCHS = 4
RATE = 0.3
DECAY = 1e-4
#: Elements that say what is the article, and elements and names that are not part of it.
ARTICLE = frozenset(["article", "main"])
APART = frozenset("nav aside footer form header button".split())
APART_NAMES = frozenset("ad ads advert advertisement comment comments cookie sidebar menu promo related share".split())
TELLING = ("cookie", "copyright", "©", "subscribe", "advert", "sponsored", "comment", "reply", "share", "sign", "login",
           "search", "related", "newsletter", "privacy", "menu")


@dataclass(frozen=True)
class Field:
    """Weights of the features for the label main, and of the label before; other has weight zero."""

    weights: np.ndarray
    moves: np.ndarray

    def scores(self, pages: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(pages), 2))
        out[:, 1] = [self.weights[f].sum() for f in pages]
        return out

    def decode(self, features: list[list[int]]) -> list[int]:
        """Viterbi: the labels with the highest score together."""
        if not features:
            return []
        scores = self.scores(features).tolist()
        moves = self.moves.tolist()
        best, back = scores[0], []
        for row in scores[1:]:
            came = [0 if best[0] + moves[0][y] > best[1] + moves[1][y] else 1 for y in (0, 1)]
            best = [best[came[y]] + moves[came[y]][y] + row[y] for y in (0, 1)]
            back.append(came)
        label = 0 if best[0] > best[1] else 1
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return labels[::-1]


@lru_cache(maxsize=100_000)
def place(feature: str) -> int:
    return crc32(feature.encode()) % FEATURES


def features_of(blocks: list[Block]) -> list[list[int]]:
    return [[place(f) for f in described(b, i, len(blocks))] for i, b in enumerate(blocks)]


def described(block: Block, at: int, total: int) -> Iterator[str]:
    text = block.text
    words = text.count(" ") + 1
    yield "any"
    yield f"tag {block.tags[-1] if block.tags else ''}"
    for tag in set(block.tags):
        yield f"in {tag}"
    for name in block.names:
        yield f"name {name}"
    yield f"words {min(words, 255).bit_length()}"
    yield f"links {round(3 * min(1.0, block.link_chars / len(text)))}"
    yield f"end {text[-1] in '.!?…:'}"
    yield f"commas {min(text.count(','), 7).bit_length()}"
    yield f"digits {sum(map(str.isdigit, text)) * 4 // len(text)}"
    yield f"from start {min(at, 3)}"
    yield f"from end {min(total - 1 - at, 3)}"
    if words < 40:
        low = text.lower()
        for word in TELLING:
            if word in low:
                yield f"says {word}"


# ---- labelled pages ----------------------------------------------------------------------------


def told_by_elements(blocks: list[Block]) -> list[int] | None:
    """Labels where the page has an article element and something besides; else None."""
    labels = [
        int(bool(ARTICLE & set(b.tags)) and not APART & set(b.tags) and not APART_NAMES & set(b.names)) for b in blocks
    ]
    return labels if 0 < sum(labels) < len(labels) else None


def laid_out(blocks: list[Block], labels: list[int], chance: random.Random) -> str:
    """A page in one of many layouts from a page's main and other blocks. Main elements carry data-main."""
    main = [b for b, y in zip(blocks, labels, strict=True) if y]
    other = [b.text for b, y in zip(blocks, labels, strict=True) if not y]
    words = [w for b in blocks for w in b.text.split()] or ["page"]

    def some(low: int, high: int) -> str:
        return entities.escape(" ".join(chance.choice(words) for _ in range(chance.randint(low, high))))

    def named(tag: str, *names: str) -> tuple[str, str]:
        attribute = chance.choice(["class", "id"])
        return f'<{tag} {attribute}="{chance.choice(names)}">', f"</{tag}>"

    def links(n: int) -> str:
        return "".join(f'<li><a href="#">{some(1, 3)}</a></li>' for _ in range(n))

    def piece(kind: str) -> str:
        if kind == "menu":
            start, end = chance.choice([("<nav>", "</nav>"), named("div", "menu", "navbar", "nav", "breadcrumbs", "topbar")])
            return f"{start}<ul>{links(chance.randint(2, 8))}</ul>{end}"
        if kind == "side":
            start, end = chance.choice([("<aside>", "</aside>"), named("div", "sidebar", "widget", "related", "share", "toc")])
            return f"{start}<h3>{some(1, 3)}</h3><ul>{links(chance.randint(1, 5))}</ul><p>{some(3, 15)}</p>{end}"
        if kind == "advert":
            start, end = named("div", "ad", "advert", "banner", "promo", "sponsored", "ads")
            text = chance.choice(other) if other and chance.random() < 0.5 else some(3, 25)
            return f"{start}{entities.escape(text)}{end}"
        if kind == "notice":
            start, end = named("div", "cookie", "notice", "consent", "alert", "popup", "newsletter")
            return f"{start}<p>{chance.choice(['Cookies: ', 'Subscribe: ', ''])}{some(4, 20)}</p><button>{some(1, 2)}</button>{end}"
        if kind == "form":
            return f"<form><label>{some(1, 3)}</label><input name=q><button>{some(1, 2)}</button><p>{some(2, 8)}</p></form>"
        if kind == "comments":
            start, end = named("section", "comments", "replies", "discussion", "responses", "respond")
            each = named("div", "comment", "reply", "comment-body")
            return f"{start}<h3>{some(1, 2)}</h3>" + "".join(
                f"{each[0]}<p>{some(2, 4)}</p><p>{some(5, 40)}.</p>{each[1]}" for _ in range(chance.randint(1, 4))
            ) + end
        if kind == "head":
            start, end = chance.choice([("<header>", "</header>"), named("div", "header", "masthead", "site-header", "logo")])
            return f"{start}<p>{some(1, 4)}</p>{end}"
        start, end = chance.choice([("<footer>", "</footer>"), named("div", "footer", "bottom", "copyright", "site-footer")])
        return f"{start}<p>&copy; {some(2, 12)}</p>{end}"

    holder = chance.choice([
        ("<article data-main>", "</article>"), ("<main data-main>", "</main>"), ("<section data-main>", "</section>"),
        ("<div data-main>", "</div>"),
        tuple(s.replace("<div", "<div data-main") for s in named("div", "content", "post", "entry", "story", "main", "text", "article-body")),
    ])
    inner = []
    for b in main:
        tag = b.tags[-1] if b.tags and b.tags[-1] in ("h1", "h2", "h3", "li", "blockquote", "pre", "td") else "p"
        inner.append(f"<{tag}>{entities.escape(b.text)}</{tag}>")
    before = [piece(k) for k in ("notice", "head", "menu", "advert", "form") if chance.random() < 0.5]
    after = [piece(k) for k in ("side", "comments", "form", "advert", "menu", "notice", "foot") if chance.random() < 0.5]
    return "".join(["<body>", *before, holder[0], *inner, holder[1], *after, "</body>"])


def labelled(pages: list[str], layouts: int = LAYOUTS) -> list[tuple[list[list[int]], list[int]]]:
    """Features and labels of the pages that tell their article, and of the same in other layouts."""
    chance = random.Random(0)
    out = []
    for html in pages:
        blocks = blocks_of(html)
        labels = told_by_elements(blocks)
        if labels is None:
            continue
        out.append((features_of(blocks), labels))
        for _ in range(layouts):
            anew = blocks_of(laid_out(blocks, labels, chance))
            out.append((features_of(anew), [int(b.marked) for b in anew]))
    return out


# ---- training ------------------------------------------------------------------------------------


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label at each block, and expected number of each move: forward-backward."""
    n = len(scores)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1])
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp(moves[:, 0] + scores[i + 1, 0] + behind[i + 1, 0], moves[:, 1] + scores[i + 1, 1] + behind[i + 1, 1])
    whole = np.logaddexp(*ahead[-1])
    pairs = ahead[:-1, :, None] + moves[None] + (scores[1:] + behind[1:])[:, None, :]
    return np.exp(ahead + behind - whole), np.exp(pairs - whole).sum(axis=0)


def fit(examples: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS) -> Field:
    """Raise the likelihood of the labels given the blocks, page by page, with steps scaled by past slopes."""
    weights, moves = np.zeros(FEATURES), np.zeros((2, 2))
    seen, seen_moves = np.full(FEATURES, 1e-6), np.full((2, 2), 1e-6)
    order = random.Random(1)
    examples = list(examples)
    for _ in range(epochs):
        order.shuffle(examples)
        for features, labels in examples:
            y = np.array(labels)
            chance, expected = marginals(Field(weights, moves).scores(features), moves)
            places = np.concatenate([np.array(f) for f in features])
            wrong = np.repeat(y - chance[:, 1], [len(f) for f in features])
            slope = np.bincount(places, wrong, FEATURES)
            touched = np.flatnonzero(slope)
            step = slope[touched] - DECAY * weights[touched]
            seen[touched] += step**2
            weights[touched] += RATE * step / np.sqrt(seen[touched])
            taken = np.zeros((2, 2))
            np.add.at(taken, (y[:-1], y[1:]), 1)
            seen_moves += (taken - expected) ** 2
            moves = moves + RATE * (taken - expected - DECAY * moves) / np.sqrt(seen_moves)
    return Field(weights, moves)


def draw(pages: DataFrame, n: int, first: int) -> list[str]:
    """n different pages that tell their article, by a hash from all that do; fewer only where no more exist.

    Pages without such an element are left out unparsed. Of the others a share that should hold `first` is
    parsed, and a larger one until there are enough.
    """

    @F.pandas_udf("boolean")
    def tells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([told_by_elements(blocks_of(h)) is not None for h in batch], dtype=bool)

    able = pages.where(F.rlike("html", F.lit(r"(?i)<(article|main)[\s/>]"))).select("html")
    part = 1_000_000
    share = min(part, part * first // max(1, able.count()) + 1)
    while True:
        place = F.xxhash64("html")
        near = able.where(F.pmod(place, F.lit(part)) < share).where(tells("html")).distinct()
        found = [r["html"] for r in near.orderBy(F.pmod(place, F.lit(part)), "html").limit(n).collect()]
        if len(found) >= n or share == part:
            return sorted(found)
        share = min(part, share * 8)


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Field:
    """Fit the field on sample_pages pages that tell their article, none longer than SAMPLE_CHARS characters.

    Warns where there are fewer."""
    drawn = draw(pages.where(F.length("html") <= SAMPLE_CHARS), sample_pages, 2 * sample_pages)
    if len(drawn) < sample_pages:
        warnings.warn(f"only {len(drawn)} of {sample_pages} pages to learn from tell their article", stacklevel=2)
    return fit(labelled(drawn))


# ---- extraction ------------------------------------------------------------------------------------


def main_text(html: str, model: Field) -> str:
    blocks = blocks_of(html)
    labels = model.decode(features_of(blocks))
    return " ".join(b.text for b, y in zip(blocks, labels, strict=True) if y)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """page_id, url, text and n_chars of every row. The html goes through one task only and is not shuffled."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h, shared.value) for h in batch], dtype=object)

    found = pages.select("page_id", "url", text_of(F.coalesce("html", F.lit(""))).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return extract(pages, train(pages))
