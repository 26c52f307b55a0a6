"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree: elements with the same way of tags and class names from the root are one node. A node
counts the pages that have it, the presentations it has (sequences of child elements) and the texts found directly in it. Presentations
that differ, and texts that are on few of the pages, carry information; what is the same on all pages does not:

    importance of presentations = entropy of their shares, base m, for a node on m pages (1 for one page)
    importance of texts         = 1 - mean over texts of log_m(pages that have the text)
    importance of a branch      = (1 - g^l) * presentations + g^l * (texts and branches below, by weight),  l presentations

Branches below a limit are taken out of every page of the host. A branch on few pages must carry nothing at all, and the pages that
have it must differ elsewhere: two pages that are the same all over are copies and show no template. Besides, what its tag, role or class name says is no article
goes (menus, headers, footers, adverts, forms, comments). Plain paragraphs, headings and lists inside an article or main element
are never taken for a branch of the template, however often a site repeats them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import all_columns, map_batches
from recurra.llm.html_tree import NOISE_TAGS, Node, blocks, elements, main_elements, parse
from recurra.session import cut_lineage

DAMPING = 0.9
LIMIT = 0.2
# From so many pages on, a template may differ a little from page to page.
MIN_PAGES = 8
NOTHING = 1e-9
# Noise branches are sent to all tasks up to this number (8 bytes each and the host's name); more are joined by host.
MOST_SENT = 200_000

PAGES, PRESENTATION, TEXT = 0, 1, 2
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tr td th article main b i em strong a span code br".split())
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def _is_plain(node: Node, mains: set[int]) -> bool:
    """Whether the element is ordinary article markup: without names, inside an article or main element, by such elements only."""
    while node is not None:
        if node.tag not in _PLAIN or node.looks and id(node) not in mains:
            return False
        if id(node) in mains:
            return node.tag in ("article", "main")
        node = node.parent
    return False


def observations(text: str) -> set[tuple[int, int, int, int]]:
    """(path, path above, kind, value) of one page: its style nodes, their presentations, and the texts directly in them."""
    root = parse(text)
    found: set[tuple[int, int, int, int]] = set()
    above: dict[int, int] = {}
    for node in elements(root):
        up = node.parent.path if node.parent else 0
        above[node.path] = up
        below = [c.path for c in node.children if isinstance(c, Node)]
        shape = xxhash.xxh64_intdigest(b"".join(p.to_bytes(8, "little") for p in below))
        found.add((node.path, up, PAGES, 0))
        found.add((node.path, up, PRESENTATION, shape))
    for node, block in blocks(root):
        found.add((node.path, above[node.path], TEXT, xxhash.xxh64_intdigest(block)))
    return found


def main_text(text: str, noise: frozenset[int] | set[int]) -> str:
    """The blocks of the article, one a line. If the noise branches would leave nothing, only names and tags decide; if those would,
    on a page without an article or main element, only tags do, as a wrapper of everything may have any name."""
    root = parse(text)
    mains = main_elements(root)
    inside = {id(n) for n in mains}
    named = {id(n) for n in elements(root) if n.noise and id(n) not in inside}
    template = set()
    if noise:
        template = {id(n) for n in elements(root) if n.path in noise and id(n) not in inside and not _is_plain(n, inside)}

    def read(skip: set[int]) -> str:
        return "\n".join(block for main in mains for _, block in blocks(main, skip))

    if found := read(named | template) or read(named):
        return found
    if mains[0].tag in ("article", "main"):
        return ""
    return read({id(n) for n in elements(root) if n.tag in NOISE_TAGS and id(n) not in inside})


def style_nodes(pages: DataFrame) -> DataFrame:
    """(host, path, up, m, shapes, shape_entropy, texts, text_logs) from (host, data): what importance is made of, one row a style node."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.update((host, *seen) for seen in observations(data.as_py() or ""))
            rows = list(counts)
            columns = [pa.array([r[0] for r in rows], pa.string())]
            columns += [pa.array([_signed(r[i]) for r in rows], pa.int64()) for i in (1, 2)]
            columns += [pa.array([r[3] for r in rows], pa.int8()), pa.array([_signed(r[4]) for r in rows], pa.int64())]
            columns.append(pa.array(list(counts.values()), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "up", "kind", "value", "n"])

    seen = pages.mapInArrow(of_batches, "host string, path bigint, up bigint, kind tinyint, value bigint, n bigint")
    counted = seen.groupBy("host", "path", "up", "kind", "value").agg(F.sum("n").alias("n"))
    n = F.col("n").cast("double")
    return (
        counted.groupBy("host", "path", "up").agg(
            F.max(F.when(F.col("kind") == PAGES, F.col("n"))).alias("m"),
            F.count_if(F.col("kind") == PRESENTATION).alias("shapes"),
            F.sum(F.when(F.col("kind") == PRESENTATION, n)).alias("all_shapes"),
            F.sum(F.when(F.col("kind") == PRESENTATION, n * F.log(n))).alias("shape_logs"),
            F.count_if(F.col("kind") == TEXT).alias("texts"),
            F.sum(F.when(F.col("kind") == TEXT, F.log(n))).alias("text_logs"),
        )
        .select(
            "host", "path", "up", "m", "shapes",
            (F.log("all_shapes") - F.col("shape_logs") / F.col("all_shapes")).alias("shape_entropy"),
            "texts", F.coalesce("text_logs", F.lit(0.0)).alias("text_logs"),
        )
    )


def branch_importance(nodes: pd.DataFrame, damping: float = DAMPING) -> dict[int, float]:
    """Importance of every branch of one host's tree, from the leaves up. `singles` counts the nodes below that are on one page only."""
    rows = {r.path: r for r in nodes.itertuples()}
    below: dict[int, list[int]] = {}
    for r in rows.values():
        below.setdefault(r.up, []).append(r.path)
    order, waiting = [], [r.path for r in rows.values() if r.up not in rows or r.up == r.path]
    while waiting:
        path = waiting.pop()
        order.append(path)
        waiting += [p for p in below.get(path, []) if p != path]
    found: dict[int, float] = {}
    for path in reversed(order):
        r = rows[path]
        log_m = math.log(r.m) if r.m > 1 else 0.0
        parts = [(rows[p].m, found[p]) for p in below.get(path, []) if p in found]
        if singles := getattr(r, "singles", 0):
            parts.append((singles, 1.0))
        if r.texts:
            parts.append((r.m, 1 - r.text_logs / r.texts / log_m if log_m else 1.0))
        inner = sum(w * v for w, v in parts) / sum(w for w, _ in parts) if parts else None
        shape = min(1.0, r.shape_entropy / log_m) if log_m else 1.0
        share = damping ** r.shapes
        found[path] = shape if inner is None else inner if not (below.get(path) or singles) else (1 - share) * shape + share * inner
    return found


def shared_nodes(nodes: DataFrame) -> DataFrame:
    """The style nodes that are on two pages or more, with `singles`, how many below each are on one page only. Those have importance
    1 whatever they hold, so their number tells all of them: names made of page titles leave the host's tree here."""
    own = [F.col(name) for name in ("up", "m", "shapes", "shape_entropy", "texts", "text_logs")]
    kept = F.struct("path", F.struct(*own).alias("node"), F.lit(0).cast("bigint").alias("singles"))
    counted = F.struct(F.col("up").alias("path"), F.lit(None).alias("node"), F.lit(1).cast("bigint").alias("singles"))
    rows = nodes.select("host", F.inline(F.array(F.when(F.col("m") > 1, kept).otherwise(counted))))
    joined = rows.groupBy("host", "path").agg(F.max("node").alias("node"), F.sum("singles").alias("singles"))
    return joined.where("node is not null").select("host", "path", "node.*", "singles")


def low_branches(nodes: pd.DataFrame, *, damping: float, limit: float, min_pages: int) -> list[int]:
    """The branches of one host that are template: below the limit on many pages, or the same on all of few pages that differ elsewhere."""
    importance = branch_importance(nodes, damping)
    pages_of, above = dict(zip(nodes["path"], nodes["m"])), dict(zip(nodes["path"], nodes["up"]))
    # Whether a branch is part of one on the same pages that carries something.
    differs: dict[int, bool] = {}
    for path in importance:
        way = []
        while path not in differs:
            way.append(path)
            up = above[path]
            if importance[path] >= limit or up == path or pages_of.get(up) != pages_of[path]:
                differs[path] = importance[path] >= limit
            else:
                path = up
        for below in way:
            differs[below] = differs[path]
    return sorted(
        p for p, v in importance.items()
        if (v < limit and pages_of[p] >= min_pages) or (v < NOTHING and pages_of[p] > 1 and differs[p])
    )


def noise_branches(pages: DataFrame, *, damping: float = DAMPING, limit: float = LIMIT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, paths): the style nodes of each host whose branches carry too little. One task handles the style nodes of a host that
    several of its pages share."""

    def of_host(nodes: pd.DataFrame) -> pd.DataFrame:
        low = low_branches(nodes, damping=damping, limit=limit, min_pages=min_pages)
        return pd.DataFrame({"host": [nodes["host"].iloc[0]], "paths": [low]})

    found = shared_nodes(style_nodes(pages)).groupBy("host").applyInPandas(of_host, "host string, paths array<bigint>")
    return found.where(F.size("paths") > 0)


def extract(
    pages: DataFrame, *, url_column: str = "url", html_column: str = "html", keep: list[str] | None = None,
    damping: float = DAMPING, limit: float = LIMIT, min_pages: int = MIN_PAGES, most_sent: int = MOST_SENT,
) -> DataFrame:
    """The columns `keep` of `pages` (all by default), then `extracted`, the main text of every page, whole.

    Null and empty pages have an empty text. A null url, or one without a host, belongs to a site without a name. Pages are read as
    they are, however broken; repeated pages are each extracted. An existing column `extracted` is replaced. No rows: no rows.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_column), _HOST, 1), F.lit("")))
    data = F.coalesce(F.col(html_column), F.lit(""))
    branches = cut_lineage(noise_branches(pages.select(host.alias("host"), data.alias("data")), damping=damping, limit=limit, min_pages=min_pages))
    size = branches.agg(F.sum(F.size("paths"))).first()[0] or 0
    wanted = [c for c in (pages.columns if keep is None else keep) if c.lower() != "extracted"]
    kept = [c for c, name in zip(all_columns(pages), pages.columns) if name in wanted]
    # A user's columns go by number, so that no name of theirs can be one of ours.
    rows = pages.select(*[c.alias(f"c{n}") for n, c in enumerate(kept)], host.alias("host"), data.alias("data"))
    sites = branches.select(F.col("host").alias("site"), "paths")
    sites = F.broadcast(sites) if size <= most_sent else sites
    rows = rows.join(sites, F.col("host") == F.col("site"), "left").drop("host", "site")
    place = len(kept)
    out = pages.select(*kept, F.lit("").alias("extracted"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(d.as_py(), frozenset(p & (1 << 64) - 1 for p in paths.as_py() or ()))
                for d, paths in zip(batch.column(place), batch.column(place + 1))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(texts, pa.string())], names=[str(n) for n in range(place + 1)])

    return map_batches(rows, of_batches, out.schema)
