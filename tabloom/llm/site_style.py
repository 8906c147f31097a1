"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: elements with the same path of tags, classes and ids are
one node. A node whose pages lay it out in the same way, or show the same texts and links in it, has
a low entropy-based importance; one with diverse layout or content is important. Branches in which
nothing is important are taken out of every page. Trees of few pages say little, so a tree's finding
counts with its number of pages against a fixed number that hold everything important.

What HTML and its names declare weighs in: the declared weight of menus, footers, adverts, comments
and the like, and of all but headings beside an article, keeps them below the threshold whatever the
tree says; unnamed parts of a declared article stay above it.

Trees are aggregates of narrow rows, summed in the tasks that read the pages; no page is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import mapped
from tabloom.llm.pages import DIGITS, Element, number, parsed
from tabloom.sources.shared import stored

HOST = re.compile(r"://([^/?#]*)")
PAGES, STYLES, FEATURES, ABOVE, ROOT = range(5)


@dataclass(frozen=True)
class Settings:
    #: Branches below this importance are removed.
    threshold: float = 0.6
    #: Pages that speak for a node's importance before any page of its host is seen.
    prior: float = 100.0
    #: How fast the weight of a node's own layout grows with the number of its layouts.
    attenuation: float = 0.9
    #: Unimportant nodes that are sent to all tasks; if there are more, pages are joined with their host's.
    broadcast: int = 2_000_000
    #: Rows that a task gathers before it passes them on.
    gathered: int = 200_000


def host(url: str | None) -> str:
    found = HOST.search(url or "")
    return found.group(1).lower() if found else ""


def root_key(url: str | None) -> int:
    return number("host " + host(url))


def page_counts(elements: list[Element], blocks: list[tuple[Element, str]]) -> tuple[dict[int, Element], set, Counter]:
    """A page's nodes, its (node, layout) pairs and the uses of its (node, feature) pairs."""
    nodes, styles, features = {}, set(), Counter()
    for element in elements:
        nodes.setdefault(element.key, element)
        if element.children:
            styles.add((element.key, number(" ".join(element.children))))
        features.update((element.key, f) for f in element.features)
    for owner, text in blocks:
        features[owner.key, number(DIGITS.sub("0", text.lower()))] += 1
    return nodes, styles, features


def gathered(batches: Iterator[pd.DataFrame], settings: Settings) -> Iterator[pd.DataFrame]:
    """Rows of the style trees: how often pages have a node, a layout of it, a feature in it; and the
    nodes above it, itself included, and its root, once whenever rows are passed on."""
    sums: dict[tuple[int, int, int], list[float]] = {}
    known: set[int] = set()

    def rows() -> pd.DataFrame:
        out = [(*key, n, t) for key, (n, t) in sums.items()]
        sums.clear(), known.clear()
        return pd.DataFrame(out, columns=["node", "kind", "value", "n", "t"])

    def add(node: int, kind: int, value: int, n: int) -> None:
        held = sums.setdefault((node, kind, value), [0.0, 0.0])
        held[0] += n
        held[1] += n * math.log(n)

    for batch in batches:
        for url, html in zip(batch["url"], batch["html"], strict=True):
            nodes, styles, features = page_counts(*parsed(html or "", root_key(url)))
            for node, element in nodes.items():
                add(node, PAGES, 0, 1)
                if node not in known:
                    known.add(node)
                    while element:
                        sums[node, ABOVE, element.key] = [1.0, 0.0]
                        top, element = element.key, element.parent
                    sums[node, ROOT, top] = [1.0, 0.0]
            for node, value in styles:
                add(node, STYLES, value, 1)
            for (node, value), n in features.items():
                add(node, FEATURES, value, n)
            if len(sums) > settings.gathered:
                yield rows()
    yield rows()


def style_trees(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``node``, ``pages``, ``importance`` of the node itself and ``branch``, the largest in its branch.

    With m pages, the importance of layouts is their entropy to base m, of contents one less the mean
    entropy of the features over the pages; a node on one page has 1. A node's layouts and the mean
    content of its branch are weighted by the number of layouts; nodes without elements in them have
    their content alone."""
    rows = mapped(pages.select("url", "html"), lambda b: gathered(b, settings), "node long, kind int, value long, n double, t double")
    rows = stored(rows.groupBy("node", "kind", "value").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "style-rows")
    of = {kind: F.col("kind") == kind for kind in (PAGES, STYLES, FEATURES, ROOT)}
    nodes = rows.where(F.col("kind") != ABOVE).groupBy("node").agg(
        F.sum(F.when(of[PAGES], F.col("n"))).alias("pages"),
        F.max(F.when(of[ROOT], F.col("value"))).alias("root"),
        F.count_if(of[STYLES]).alias("styles"),
        F.sum(F.when(of[STYLES], F.col("n"))).alias("laid"),
        F.sum(F.when(of[STYLES], F.col("n") * F.ln("n"))).alias("laid_log"),
        F.avg(F.when(of[FEATURES], F.ln("n") - F.col("t") / F.col("n"))).alias("entropy"),
    )
    above = rows.where(F.col("kind") == ABOVE).select("node", F.col("value").alias("above"))
    base = F.ln("pages")

    def held(importance):
        """Importance with the prior's pages; nothing is known from one page."""
        seen = F.when(F.col("pages") > 1, F.greatest(F.lit(0.0), F.least(F.lit(1.0), importance))).otherwise(1.0)
        return (F.col("pages") * seen + settings.prior) / (F.col("pages") + settings.prior)

    nodes = nodes.select(
        "node",
        "pages",
        "root",
        "styles",
        F.when(F.col("entropy").isNotNull(), held(1 - F.col("entropy") / base)).alias("content"),
        held((F.ln("laid") - F.col("laid_log") / F.col("laid")) / base).alias("layout"),
    )
    nodes = stored(nodes, "style-nodes")
    inside = nodes.where("content is not null").join(above, "node").groupBy(F.col("above").alias("node")).agg(F.avg("content").alias("inside"))
    own = F.lit(1.0) - F.pow(F.lit(settings.attenuation), "styles")
    mixed = F.coalesce(own * F.col("layout") + (1 - own) * F.col("inside"), F.col("layout"))
    importance = F.when(F.col("styles") > 0, mixed).otherwise(F.coalesce("content", F.lit(0.0)))
    nodes = stored(nodes.join(inside, "node", "left").select("node", "pages", "root", importance.alias("importance")), "style-nodes")
    branches = nodes.join(above, "node").groupBy(F.col("above").alias("node")).agg(F.max("importance").alias("branch"))
    return nodes.join(branches, "node")


def main_text(html: str | None, root: int, unimportant) -> str:
    """The page's blocks without furniture and without the branches that its host's tree finds unimportant."""
    _, blocks = parsed(html or "", root)
    said = [(owner, text) for owner, text in blocks if not owner.noise]
    for inside in ("article", "main"):
        if any(getattr(owner, inside) for owner, _ in said):
            said = [(owner, text) for owner, text in said if getattr(owner, inside) or owner.tag == "h1"]
            break
    kept = [text for owner, text in said if owner.plain or owner.key not in unimportant]
    return "\n".join(kept or [text for _, text in said])


def extracted(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page.

    ``text`` holds the blocks of the main text, one a line: character references are decoded and white
    space, line breaks of the page included, becomes one space. Null and empty html gives an empty
    text, and so does a page of nothing but furniture. Pages whose url is null or has no host share a
    tree. Rows with a null or repeated ``page_id`` are pages like any other; pages of any length are
    read whole, elements nested deeper than 512 count as their 512th ancestor. Where the tree leaves
    nothing of a page, it isn't applied to that page. Other columns are left behind.
    """
    spark = pages.sparkSession
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    low = stored(style_trees(rows, settings).where(F.col("branch") < settings.threshold).select("root", "node"), "unimportant")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def texts(batch: pd.DataFrame, unimportant_of) -> pd.DataFrame:
        text = [main_text(h, root_key(u), unimportant_of(k)) for k, (u, h) in enumerate(zip(batch["url"], batch["html"], strict=True))]
        return pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": text, "n_chars": [len(t) for t in text]})

    if low.count() <= settings.broadcast:
        held = spark.sparkContext.broadcast(np.array([r["node"] for r in low.select("node").toLocalIterator()], np.int64))

        def everywhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            unimportant = frozenset(held.value.tolist())
            for batch in batches:
                yield texts(batch, lambda _: unimportant)

        return mapped(rows, everywhere, schema)

    def by_host(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [frozenset(n.tolist()) if n is not None else frozenset() for n in batch["nodes"]]
            yield texts(batch, sets.__getitem__)

    roots = mapped(rows, with_roots, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, html string, root long")
    return mapped(roots.join(low.groupBy("root").agg(F.collect_list("node").alias("nodes")), "root", "left"), by_host, schema)


def with_roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(root=[root_key(u) for u in batch["url"]])
