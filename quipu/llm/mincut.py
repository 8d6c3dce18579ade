"""Main text of web pages by minimum cuts.

A page is a graph whose nodes are its text blocks and elements. A classifier's cost of each
label becomes the capacity between a block and the terminals; neighbouring blocks, and
blocks and elements along the tree, are tied by smoothness edges. The minimum cut, found as
a maximum flow, parts main text from boilerplate at least total cost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .htmlblocks import HEADINGS, LIKELY, MAIN, NEVER, REPLACEABLE, SILENT, Page

UNIT = 1000  # capacities are whole numbers, thousandths of a natural logarithm of odds
EVIDENCE = {NEVER: -8 * UNIT, REPLACEABLE: -6 * UNIT, SILENT: 0, LIKELY: 5 * UNIT // 2, MAIN: 5 * UNIT}
MOST_BY_TEXT = 4 * UNIT  # what the classifier can say of a block's text at most
NEXT = UNIT  # between neighbouring blocks of one element; less the farther apart in the tree
CLOSE = 6 * UNIT // 10  # between a block and its element, and an element and the one above
SAMPLE_PAGES = 2000

#: Counts (main, boilerplate) that stand beside the learned ones, so that a corpus without
#: labelled blocks has a classifier too.
PRIOR = {
    ("tag", "p"): (8, 2), ("tag", "heading"): (5, 3), ("tag", "li"): (4, 5), ("tag", "other"): (5, 5),
    ("tag", "p linked"): (2, 3), ("tag", "heading linked"): (2, 3), ("tag", "li linked"): (1, 8), ("tag", "other linked"): (1, 6),
    ("length", 0): (1, 6), ("length", 1): (2, 6), ("length", 2): (4, 4), ("length", 3): (6, 3), ("length", 4): (8, 1), ("length", 5): (8, 1),
    ("linked", 0): (8, 4), ("linked", 1): (6, 4), ("linked", 2): (2, 6), ("linked", 3): (1, 8),
    ("ends", True): (8, 3), ("ends", False): (3, 7),
    ("commas", 0): (5, 7), ("commas", 1): (6, 3), ("commas", 2): (8, 1),
    ("marks", True): (1, 6), ("marks", False): (8, 6),
}


def features(page: Page) -> list[tuple[tuple[str, int | bool | str], ...]]:
    """What the classifier sees of each block: nothing of its place or its elements' names but `tag`."""
    out = []
    for tag, text, linked in zip(page.tag, page.text, page.linked):
        kind = "heading" if tag in HEADINGS else tag if tag in ("p", "li") else "other"
        share = linked / len(text)
        out.append(
            (
                ("tag", f"{kind} linked" if share >= 0.3 else kind),
                ("length", min(5, max(0, int(math.log2(len(text))) - 3))),
                ("linked", 0 if not linked else 1 if share < 0.3 else 2 if share < 0.8 else 3),
                ("ends", text[-1] in ".!?…:;\"'”’»)。！？"),
                ("commas", min(2, text.count(",") + text.count("，") + text.count("、"))),
                ("marks", any(c in text for c in "©|»·•")),
            )
        )
    return out


def taught(page: Page) -> Counter:
    """Counts of (feature, value, label) over the blocks whose elements tell what they are.

    Main text is what lies in <article> or <main>; boilerplate what lies in <nav>, <header>,
    <footer>, <aside> or <menu>. Forms and readers' comments teach nothing.
    """
    sure: list[bool | None] = [None]
    for parent, name, evidence in zip(page.parent[1:], page.names[1:], page.evidence[1:]):
        above = sure[parent]
        if name in ("nav", "footer", "aside", "menu") or name == "header" and above is None:
            sure.append(False)
        else:
            sure.append(True if evidence == MAIN and above is not False else None if evidence == NEVER and above else above)
    counts: Counter = Counter()
    for owner, seen in zip(page.owner, features(page)):
        if sure[owner] is not None:
            counts.update((name, str(value), sure[owner]) for name, value in seen)
    return counts


def learn(pages: DataFrame, id: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES) -> dict[tuple[str, str], int]:
    """Naive Bayes weights of the features' values, in UNITs: positive speaks for main text.

    Learned from the labelled blocks of about `sample_pages` pages, drawn by a hash of their
    id and length, or of all pages where there are fewer. The driver gets one count for each
    value and label.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), F.length(F.col(f"`{html}`"))), 11) / float(1 << 53)
    n = pages.count()
    sample = pages.filter(F.col(f"`{html}`").isNotNull() & (draw * n < sample_pages)).select(F.col(f"`{html}`").alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                total.update(taught(Page(text.as_py())))
        keys = list(total)
        columns = [[k[i] for k in keys] for i in range(3)] + [[total[k] for k in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.bool_(), pa.int64()))], ["name", "value", "main", "n"])

    rows = sample.mapInArrow(count, "name string, value string, main boolean, n long")
    found = {(r["name"], r["value"], r["main"]): r["n"] for r in rows.groupBy("name", "value", "main").agg(F.sum("n").alias("n")).collect()}
    return weights(found)


def weights(found: dict[tuple[str, str, bool], int]) -> dict[tuple[str, str], int]:
    sums: Counter = Counter()
    counts = {}
    for (name, value), (main, other) in PRIOR.items():
        counts[name, str(value)] = own = {True: main + found.get((name, str(value), True), 0), False: other + found.get((name, str(value), False), 0)}
        sums[name, True] += own[True]
        sums[name, False] += own[False]
    # features of one block lean on each other, so each counts half
    return {
        key: round(UNIT / 2 * math.log(own[True] / sums[key[0], True] / (own[False] / sums[key[0], False])))
        for key, own in counts.items()
    }


def graph(page: Page, weight: dict[tuple[str, str], int]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Terminal capacities (above 0: to main text) and smoothness edges (node, node, capacity).

    Nodes are the blocks, then the elements. A block is tied to the next one and to its
    element, an element to the one above.
    """
    n = len(page.text)
    terminal = []
    for owner, seen in zip(page.owner, features(page)):
        by_text = sum(weight[name, str(value)] for name, value in seen)
        terminal.append(EVIDENCE[page.evidence[owner]] + max(-MOST_BY_TEXT, min(MOST_BY_TEXT, by_text)))
    used, edges = set(), []
    for i, owner in enumerate(page.owner):
        edges.append((i, n + owner, CLOSE))
        while owner not in used:
            used.add(owner)
            if page.parent[owner] < 0:
                break
            edges.append((n + owner, n + page.parent[owner], CLOSE))
            owner = page.parent[owner]
        if i:
            a, b = page.owner[i - 1], page.owner[i]
            together = a == b or page.parent[a] == page.parent[b]
            edges.append((i - 1, i, NEXT if together else NEXT // 2))
    return terminal + [0] * len(page.parent), edges


def minimum_cut(terminal: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """For each node whether it lies on the main side; of several least cuts that of most main nodes.

    A node whose terminal outweighs all its edges is settled at once, which shifts the
    weight of its edges to its neighbours' terminals; what remains is cut by a maximum flow.
    """
    terminal = list(terminal)
    near: list[dict[int, int]] = [{} for _ in terminal]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0) + c
        near[b][a] = near[b].get(a, 0) + c
    free = [sum(x.values()) for x in near]
    side: list[bool | None] = [None] * len(terminal)
    work = list(range(len(terminal)))
    while work:
        i = work.pop()
        if side[i] is not None or -free[i] <= terminal[i] < free[i] and free[i]:
            continue
        side[i] = terminal[i] >= 0 if not free[i] else terminal[i] >= free[i]
        for j, c in near[i].items():
            if side[j] is None:
                terminal[j] += c if side[i] else -c
                free[j] -= c
                work.append(j)
    left = [i for i, s in enumerate(side) if s is None]
    if left:
        for i, main in zip(left, flow_sides(left, terminal, near)):
            side[i] = main
    return [bool(s) for s in side]


def flow_sides(nodes: list[int], terminal: list[int], near: list[dict[int, int]]) -> list[bool]:
    """Sides of the given nodes by a maximum flow from main to boilerplate, path lengths growing."""
    place = {i: k for k, i in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    to: list[list[int]] = [[] for _ in range(len(nodes) + 2)]  # edges by node; edge e goes back as e ^ 1
    head: list[int] = []
    room: list[int] = []

    def join(a: int, b: int, there: int, back: int) -> None:
        to[a].append(len(head))
        to[b].append(len(head) + 1)
        head.extend((b, a))
        room.extend((there, back))

    for k, i in enumerate(nodes):
        if terminal[i] > 0:
            join(source, k, terminal[i], 0)
        elif terminal[i] < 0:
            join(k, sink, -terminal[i], 0)
        for j, c in near[i].items():
            if j in place and i < j:
                join(k, place[j], c, c)

    def distances(start: int, forward: bool) -> list[int]:
        far = [-1] * len(to)
        far[start] = 0
        queue = [start]
        for a in queue:
            for e in to[a]:
                if far[head[e]] < 0 and room[e if forward else e ^ 1]:
                    far[head[e]] = far[a] + 1
                    queue.append(head[e])
        return far

    while (far := distances(sink, False))[source] >= 0:  # steps that each node still is from the sink
        tried = [0] * len(to)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                first = next(k for k, e in enumerate(path) if not room[e])
                at = head[path[first] ^ 1]
                del path[first:]
            while tried[at] < len(to[at]):
                e = to[at][tried[at]]
                if room[e] and far[head[e]] == far[at] - 1:
                    path.append(e)
                    at = head[e]
                    break
                tried[at] += 1
            else:
                if not path:
                    break
                at = head[path.pop() ^ 1]
                tried[at] += 1
    reaches = distances(sink, False)
    return [reaches[k] < 0 for k in range(len(nodes))]


def main_text(html: str, weight: dict[tuple[str, str], int]) -> str:
    page = Page(html)
    sides = minimum_cut(*graph(page, weight))
    return "\n".join(text for text, main in zip(page.text, sides) if main)


def extract(pages: DataFrame, id: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES, name: str = "text") -> DataFrame:
    """`pages` with the main text of every whole page in column `name`, in place of one of that name.

    Character references are decoded, white space inside a block is one space, blocks are
    joined by a line break in page order. <br> is white space. Null or empty pages, and
    pages without main text, have an empty text. Tags need not be closed: a paragraph ends
    where the next block begins, a tag or comment that never ends hides the rest. Repeated rows
    are extracted each by itself; a table without rows gives none.
    """
    rows = pages if isinstance(pages.schema[html].dataType, T.StringType) else pages.withColumn(html, F.col(f"`{html}`").cast("string"))
    weight = learn(rows, id, html, sample_pages)

    @F.pandas_udf("string")
    def texts(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in series:
            yield pd.Series([main_text(x or "", weight) for x in batch], dtype=object)

    return rows.withColumn(name, texts(F.col(f"`{html}`")))
