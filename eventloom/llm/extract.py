"""Main text of web pages: boosted trees score blocks, decoding from the body down chooses among them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import boost
from eventloom.llm.dom import Page, features, parse
from eventloom.llm.layouts import training_pages
from eventloom.llm.tables import fields

#: Nodes whose features are held at once (one page's at least); the log-probability above which a node is chosen.
NODES, LIKELIER = 30_000, math.log(0.5)


@dataclass(frozen=True)
class Model:
    """How much tags and words of classes and ids speak for main text, and the trees over all features."""

    tag_score: dict[str, float]
    name_score: dict[str, float]
    trees: boost.Trees


def wanted(page: Page) -> np.ndarray:
    """A node is wanted if there is marked text in it or below."""
    out = np.array([bool(t) and m == 1 for t, m in zip(page.text, page.main, strict=True)])
    for i in range(len(out) - 1, 0, -1):
        out[page.parent[i]] |= out[i]
    return out


def learn(lines: list[str], n_pages: int = 800, seed: int = 0) -> Model:
    """Fits tags, names and trees to `n_pages` pages of known layout around `lines`: trees to the nodes whose parent is
    wanted, since they are to say what holds given that.

    Scores of tags and names are the log-odds of nodes that have them, from the other half of the pages: a tree must
    not see what a name's score owes to its own page."""
    pages = [parse(p, marks=True) for p in training_pages(lines, n_pages, seed)]
    labels = [wanted(p) for p in pages]
    half = max(1, n_pages // 2)
    scores = _scores(pages[:half], labels[:half]), _scores(pages[half:], labels[half:])
    x = np.concatenate([features(part, *scores[1 - k])[0] for k, part in enumerate((pages[:half], pages[half:])) if part])
    y = np.concatenate(labels)
    asked = np.concatenate([np.concatenate([[False], label[np.array(page.parent[1:], np.int64)]]) for page, label in zip(pages, labels, strict=True)]).astype(bool)
    return Model(*_scores(pages, labels), boost.fit(x[asked], y[asked].astype(float)))


def _scores(pages: list[Page], labels: list[np.ndarray]) -> tuple[dict[str, float], dict[str, float]]:
    good, seen = (Counter(), Counter()), (Counter(), Counter())
    for page, label in zip(pages, labels, strict=True):
        has = [({}, {}) for _ in range(2)]
        for t, names, y in zip(page.tag, page.names, label.tolist(), strict=True):
            has[0][y].setdefault(t, 0)
            for x in names:
                has[1][y].setdefault(x, 0)
        for k in range(2):  # a page counts once for a tag or name, on either side
            good[k].update(has[k][1].keys())
            seen[k].update([*has[k][0].keys(), *has[k][1].keys()])
    return tuple({x: math.log((good[k][x] + 1) / (n - good[k][x] + 1)) for x, n in seen[k].items() if n >= 2} for k in range(2))


def decode(pages: list[Page], first: np.ndarray, margin: np.ndarray) -> list[list[int]]:
    """Each page's chosen text nodes.

    A margin is the log-odds that a node has main text in it, given that its parent has; a node whose parent has none
    has none.  So a node's probability is its own times its parent's, which no node's exceeds, and the choice of all
    nodes that are likelier wanted than not never has one without its ancestors: nothing that stands in a
    block left out comes back, however much it looks like text."""
    own = -np.logaddexp(0.0, -margin)
    out = []
    for k, page in enumerate(pages):
        given = own[first[k] : first[k + 1]].tolist()
        given[0] = 0.0  # the body
        for i in range(1, len(given)):  # parents come first
            given[i] += given[page.parent[i]]
        out.append([i for i, (g, t) in enumerate(zip(given, page.text, strict=True)) if t and g > LIKELIER])
    return out


def main_texts(pages: list[Page], model: Model) -> Iterator[str]:
    """The main text of each page, whose features are found for NODES nodes at a time."""
    i = 0
    while i < len(pages):
        j, size = i + 1, len(pages[i].parent)
        while j < len(pages) and size + len(pages[j].parent) <= NODES:
            size += len(pages[j].parent)
            j += 1
        x, first = features(pages[i:j], model.tag_score, model.name_score)
        margin = model.trees.margin(x)
        for page, kept in zip(pages[i:j], decode(pages[i:j], first, margin), strict=True):
            yield "\n".join([page.text[b] for b in kept])
        i = j


def sample_lines(df: DataFrame, html: str = "html", key: str = "page_id", rows: int = 200, longest: int = 1_000_000) -> list[str]:
    """Blocks of text of `rows` pages at most, none of more than `longest` characters (those of the least hash of key
    and page): material for the training pages.  These parameters bound it; the pages are sampled for their
    language, not for labels."""
    order = F.xxhash64(F.col(key).cast("string"), F.col(html))
    some = df.where(F.length(html) <= longest)
    # About twice as many are looked at: each task sends its share of those, not as many as are asked for.
    share = max(1, df.count() // (2 * max(1, rows)))
    found = some.select(F.col(html).alias("h"), order.alias("o")).where(F.pmod("o", F.lit(share)) == 0).orderBy("o", "h").limit(rows).collect()
    return [t for r in found for t in parse(r["h"]).text if t]


def fit(df: DataFrame, html: str = "html", key: str = "page_id", sample_pages: int = 200, n_pages: int = 800, seed: int = 0) -> Model:
    """A model for the pages of `df`: trees fitted on the driver to pages of known layout, whose text is that of
    `sample_pages` pages at most.  An empty table gives a model of placeholder text."""
    return learn(sample_lines(df, html, key, sample_pages), n_pages, seed)


def extract(df: DataFrame, model: Model, html: str = "html", batch: int = 500, keep_html: bool = True) -> DataFrame:
    """Adds text and n_chars (its code points): the main text of each row's page.

    One pass, no shuffle.  Pages are parsed whole; every node gets a margin from the trees, then `decode` makes a
    choice in which no node contradicts its ancestors or descendants.  Blocks are elements that stand in blocks of
    their own; their text has references decoded, white space (and <br>) made one space, and is joined by one \\n in
    page order.  Null and empty pages have the text ''; repeated rows are alike; other columns pass through, whatever
    their names, except that text and n_chars are replaced (and `html` goes, if `keep_html` is false); an empty
    table gives no rows.
    """
    df = df.drop("text", "n_chars")
    held = df.sparkSession.sparkContext.broadcast(model)
    at_html, kept = df.columns.index(html), [c for c in df.columns if keep_html or c != html]
    places = [df.columns.index(c) for c in kept]
    numbered = df.toDF(*[f"_{k}" for k in range(len(df.columns))])  # names with dots don't pass through mapInArrow
    names = [*[f"_{k}" for k in places], "text", "n_chars"]

    def main(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.slice(at, batch)
                texts = list(main_texts([parse(x or "") for x in part.column(at_html).to_pylist()], own))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    out = numbered.mapInArrow(main, ", ".join(filter(None, [fields(numbered.select(*names[:-2])), "text string, n_chars long"])))
    return out.toDF(*kept, "text", "n_chars")
