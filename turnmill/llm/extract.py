"""Main text of web pages by boosted trees over DOM nodes and hierarchical decoding.

Every block element of a page gets features of its subtree (text, links, density), its name and
attribute words and those of its ancestors, its depth and its siblings. Gradient-boosted trees give the
probability that it holds main text; they are fitted on a bounded set of example pages. The decoding
picks the most likely choice for the whole tree in which nothing below a dropped element is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from turnmill.llm.boosting import Boosting, Trees
from turnmill.llm.dom import SILENT, Page, attribute_words
from turnmill.llm.page_models import SETS, PageMaker

# Kinds of elements a node or an ancestor can be; one bit each.
KINDS = {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup", "p": "p", "list": "ul ol dl menu", "item": "li dt dd",
    "table": "table tbody thead tfoot tr td th", "box": "div section center", "main": "article main",
    "nav": "nav", "header": "header", "footer": "footer address", "aside": "aside",
    "form": "form fieldset search", "dialog": "dialog details summary", "quote": "blockquote pre",
    "figure": "figure figcaption", "silent": " ".join(SILENT),
}
_KIND_BIT = {tag: 1 << bit for bit, tags in enumerate(KINDS.values()) for tag in tags.split()}
_WORD_BIT: dict[str, int] = {}
for _bit, _words in enumerate(SETS.values(), len(KINDS)):
    for _word in _words:
        _WORD_BIT[_word] = _WORD_BIT.get(_word, 0) | 1 << _bit
_HIDDEN = 1 << (len(KINDS) + len(SETS))
BITS = len(KINDS) + len(SETS) + 1
NUMBERS = 16


@dataclass(frozen=True)
class Extraction:
    pages: int = 1_000  # example pages that are learnt from
    seed: int = 23
    boosting: Boosting = Boosting()


class Nodes:
    """Features of a page's elements; `weight` says how much text hangs on each."""

    def __init__(self, page: Page) -> None:
        n = len(page.tag)
        parent = page.parent
        own, linked, stops, words, before = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        read = 0
        seen = -1
        for element, text, in_link in page.segments:
            if text is None:
                continue
            while seen < element:
                seen += 1
                before[seen] = read
            size = len(text) - text.count(" ")
            own[element] += size
            words[element] += text.count(" ") + 1
            stops[element] += text.count(".") + text.count(",")
            if in_link:
                linked[element] += size
            read += size
        while seen < n - 1:
            seen += 1
            before[seen] = read
        bits, above, depth = [0] * n, [0] * n, [0] * n
        for k in range(1, n):
            found = _KIND_BIT.get(page.tag[k], 0)
            if page.attributes[k]:
                names, hidden = attribute_words(page.attributes[k])
                for name in names:
                    found |= _WORD_BIT.get(name, 0)
                found |= _HIDDEN if hidden else 0
            bits[k] = found
            above[k] = above[parent[k]] | bits[parent[k]]
            depth[k] = depth[parent[k]] + 1
        text, link, stop, word = own[:], linked[:], stops[:], words[:]
        tags, blocks, children = page.inline[:], [0] * n, [0] * n
        for k in range(n - 1, 0, -1):
            p = parent[k]
            text[p] += text[k]
            link[p] += link[k]
            stop[p] += stop[k]
            word[p] += word[k]
            tags[p] += tags[k] + 1
            blocks[p] += blocks[k] + 1
            children[p] += 1
        place, last, previous, following = [0] * n, [0] * n, [0] * n, [0] * n
        counted = [0] * n
        for k in range(1, n):
            p = parent[k]
            place[k] = counted[p]
            counted[p] += 1
            if last[p]:
                previous[k] = text[last[p]]
                following[last[p]] = text[k]
            last[p] = k
        col = lambda values: np.array(values, float)
        up = np.maximum(np.array(parent), 0)
        text_, link_, all_text = col(text), col(link), max(text[0], 1)
        self.page, self.bits, self.above = page, bits, above
        self.own = np.log1p(col(own))
        density = link_ / np.maximum(text_, 1)
        share = text_ / np.maximum(text_[up], 1)
        self.numbers = np.stack(
            [
                col(depth), np.log1p(text_), text_ / all_text, density,
                np.minimum(col(tags) / np.maximum(text_, 1), 5), col(children), np.log1p(col(blocks)),
                col(stop) / np.maximum(col(word), 1), col(before) / all_text, col(place),
                np.array(children)[up], np.log1p(col(previous)), np.log1p(col(following)),
                share, density[up], text_ / np.maximum(col(word), 1),
            ],
            axis=1,
        )

    def features(self) -> np.ndarray:
        masks = np.stack([np.array(self.bits, np.int64), np.array(self.above, np.int64)], axis=1)
        flags = (masks[:, :, None] >> np.arange(BITS)) & 1
        return np.concatenate([self.numbers, flags.reshape(len(masks), -1)], axis=1)


def decode(parent: list[int], weight: np.ndarray, probability: np.ndarray) -> list[bool]:
    """The most likely labels of a tree in which a kept element's parent is kept. The root is."""
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = (-weight * np.log(p)).tolist(), (-weight * np.log(1 - p)).tolist()
    for k in range(len(parent) - 1, 0, -1):
        keep[parent[k]] += min(keep[k], drop[k])
        drop[parent[k]] += drop[k]
    kept = [True] * len(parent)
    for k in range(1, len(parent)):
        kept[k] = kept[parent[k]] and keep[k] <= drop[k]
    return kept


_LABEL = re.compile(r'data-label="([01])"')


@lru_cache(maxsize=4)
def fit(how: Extraction = Extraction()) -> Trees:
    """Learn from the example pages. An element without a label has that of its parent."""
    maker, features, labels = PageMaker(how.seed), [], []
    for _ in range(how.pages):
        page = Page(maker.page())
        nodes = Nodes(page)
        label = [1] * len(page.tag)
        for k in range(1, len(page.tag)):
            found = _LABEL.search(page.attributes[k])
            label[k] = int(found[1]) if found else label[page.parent[k]]
        features.append(nodes.features()[1:])
        labels += label[1:]
    return Trees(np.concatenate(features), np.array(labels, float), how.boosting)


def extract_pages(pages: list[str | None], trees: Trees) -> list[str]:
    parsed = [Nodes(Page(html or "")) for html in pages]
    if not parsed:
        return []
    probability = trees.probability(np.concatenate([n.features() for n in parsed]))
    texts, start = [], 0
    for nodes in parsed:
        stop = start + len(nodes.bits)
        kept = decode(nodes.page.parent, 1 + nodes.own, probability[start:stop])
        texts.append(nodes.page.text(kept))
        start = stop
    return texts


def _extract_udf(spark: SparkSession, trees: Trees, at_once: int):
    shared = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            made: list[str] = []
            for start in range(0, len(pages), at_once):
                made += extract_pages(list(pages[start : start + at_once]), shared.value)
            yield pd.Series(made, dtype=object)

    return extract


def main_text(
    pages: DataFrame, how: Extraction = Extraction(), html: str = "html", into: str = "main_text"
) -> DataFrame:
    """`pages` with the string column `into`, the main text.

    Every row stays with all its columns but one named `into`, which is replaced. A null or empty page, and one without main text, gives
    an empty text; text that is no markup at all is main text. Character references are decoded, white space in a
    block becomes one space, and blocks are joined in page order by one space. Unclosed elements,
    stray end tags, unfinished tags and any depth are accepted. The result depends on the page
    alone, so repeated rows get the same text.
    """
    trees = fit(how)
    return pages.withColumn(into, _extract_udf(pages.sparkSession, trees, 64)(F.col(html)))
