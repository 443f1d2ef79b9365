"""Main text of web pages by minimum-cut labelling.

Each text block of a page gets the costs of a classifier: what its length, links and punctuation say, and
what the tags and names of the elements around it say, each of them bounded and on the scale of the edges. The
costs are terminal capacities; blocks next to each other, and blocks of one parent element, are tied by
smoothness edges, the stronger the nearer they are in the document tree. A minimum cut separates the article
from the rest of the page, so a block whose own signs are weak or contradict each other goes with its neighbours.
Nothing is fixed but what holds no text to read (scripts, styles and the like).

The classifier is a logistic regression of text features, fitted on blocks whose surroundings name them
(inside an article and nothing else, or in navigation, footers, forms and the like) from ``SAMPLE_PAGES`` expected pages, at most
``PAGE_BLOCKS`` evenly spread blocks of each. Without both kinds of blocks it starts from fixed weights.

Defined results: a null page is empty and has an empty text, as has a page without article; unclosed and
misplaced tags end with the elements around them; repeated rows, null ids and null addresses are kept; an
empty table gives an empty result. Columns other than the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import texts_of
from tidewell.llm.html_blocks import CERTAIN, HINT, Block, Element, blocks_of
from tidewell.llm.mincut import source_side

SAMPLE_PAGES = 2000
PAGE_BLOCKS = 64
SEED = 5
#: Before any training: long text with punctuation and no links.
START = np.array([-2.0, 0.5, -3.0, 1.5, 0.5, 0.5])
#: Costs of calling a block the other thing than what the elements around it say with certainty.
INSIDE = 2.5
OUTSIDE = 7.0
#: Largest cost that text features alone may give.
LIMIT = 2.0
NEIGHBOURS = 1.5
SIBLINGS = 0.5


def features(block: Block) -> list[float]:
    text = block.text
    stops = text.count(".") + text.count("!") + text.count("?")
    return [
        1.0,
        float(np.log1p(len(text))),
        block.linked,
        1.0 if text[-1] in ".!?:\"'”»" else 0.0,
        min(3.0, float(np.log1p(stops))),
        1.0 if block.element.tag in ("p", "pre", "blockquote", "h1", "h2", "h3") else 0.0,
    ]


def fitted(rows: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression held near ``START``, by Newton steps."""
    weights = START.copy()
    if content.all() or not content.any():
        return weights
    # Both kinds count the same in total.
    mass = np.where(content, 0.5 / content.sum(), 0.5 / (~content).sum()) * min(len(rows), 1000)
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (mass * (content - chance)) - (weights - START)
        bend = (rows * (mass * chance * (1 - chance))[:, None]).T @ rows + np.eye(rows.shape[1])
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def surroundings(element: Element) -> float:
    """What the elements around a block add to its cost; the surer the signs against it, the less count those for it."""
    outside = CERTAIN if element.form else element.outside
    return INSIDE * element.inside * (1 - outside) - OUTSIDE * outside


def named(block: Block) -> bool | None:
    """Whether the block is content as far as its surroundings are certain, else None."""
    element = block.element
    if element.form or element.outside >= CERTAIN:
        return False
    return True if element.inside >= CERTAIN and element.outside < HINT else None


def labelled(blocks: list[Block], weights: np.ndarray) -> list[bool]:
    """Whether each block belongs to the main text."""
    if not blocks:
        return []
    logits = np.clip(np.array([features(block) for block in blocks]) @ weights, -LIMIT, LIMIT)
    terminal, edges = [], []
    last_of: dict[int, int] = {}
    for i, (block, logit) in enumerate(zip(blocks, logits.tolist(), strict=True)):
        element = block.element
        terminal.append(logit + surroundings(element))
        if i:
            steps = element.depth + blocks[i - 1].element.depth - 2 * block.shared
            edges.append((i - 1, i, NEIGHBOURS / max(1, steps)))
        before = last_of.get(block.parent)
        if before is not None:
            edges.append((before, i, SIBLINGS))
        last_of[block.parent] = i
    return source_side(terminal, edges)


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    return "\n".join(block.text for block, keep in zip(blocks, labelled(blocks, weights), strict=True) if keep)


def train(pages: DataFrame, html: str = "html") -> np.ndarray:
    keep = F.rand(SEED) < SAMPLE_PAGES / max(1, pages.count())

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, content = [], []
            for page in texts_of(batch.column(0)):
                known = [b for b in blocks_of(page) if named(b) is not None]
                for block in known[:: max(1, -(-len(known) // PAGE_BLOCKS))]:
                    rows.append(features(block))
                    content.append(named(block))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), pa.array(content, pa.bool_())], names=["x", "content"]
            )

    found = pages.select(html).filter(keep).mapInArrow(mapped, "x ARRAY<DOUBLE>, content BOOLEAN").collect()
    if not found:
        return START
    return fitted(np.array([row["x"] for row in found]), np.array([row["content"] for row in found]))


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The columns ``keep`` and the main ``text`` of every page."""
    weights = train(pages, html)
    schema = pages.select(*keep).schema.add("text", "string")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in texts_of(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names
            )

    return pages.select(*keep, html).mapInArrow(mapped, schema)
