"""Document fingerprints: a Merkle tree over sections, paragraphs and word runs.

A paragraph is a line with its line break. A section is a run of paragraphs that ends
after one whose digest ends in three zero bits, and a word run ends after a word whose
checksum is a multiple of three, so an edit moves only the cuts beside it. Words of more
than 32 code points (texts without blanks) are cut into pieces first, by a checksum of
four code points, and the pieces count as words; one of the greatest length ends a run. Every node's
digest follows from its children's; equal roots mean equal texts, and a comparison
descends into the branches that differ.

The fingerprint holds the whole tree as text: the root in 32 hex digits, then for each
section `/` and 8 digits, for each paragraph `:` and 8 digits, and for each word run 4
letters of base 64.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from base64 import b64encode
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranges import MOST_RANGES, range_starts, with_range
from .common import text_or_empty

WORDS = re.compile(r"\S+\s*|\s+")
SECTION_BITS = 7
RUN_EVERY = 3
LONG, WINDOW, PIECE_BITS, MOST = 32, 4, 7, 64  # code points: longest whole word, of a checksum, a mask, longest piece
ROOT, NODE, RUN = 32, 8, 4  # letters
KEY_LETTERS = 32  # of a text that help to deal rows with equal ids


class Paragraph(NamedTuple):
    digest: str
    runs: str  # RUN letters for each word run


def pieces(word: str) -> list[str]:
    """A word cut where its code points say so, whatever stands further off; short words stay whole.

    A cut follows a window whose checksum fits, unless one of the three windows before fits
    too. What is still long between two cuts (repeated letters) is cut by length.
    """
    if len(word) <= LONG:
        return [word]
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sums = np.zeros(len(points) - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        sums = (sums ^ points[i : len(points) - WINDOW + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        sums ^= sums >> np.uint64(29)
    fits = sums & np.uint64(PIECE_BITS) == 0
    near = np.zeros(len(fits), bool)
    for i in range(1, WINDOW):
        near[i:] |= fits[:-i]
    cuts = [0, *(np.flatnonzero(fits & ~near) + WINDOW).tolist(), len(word)]
    return [word[i : min(i + MOST, b)] for a, b in zip(cuts, cuts[1:]) for i in range(a, b, MOST)]


def paragraph(text: str) -> Paragraph:
    runs, held = [], []
    for word in (p for w in WORDS.findall(text) for p in pieces(w)):
        held.append(word)
        if len(word) == MOST or zlib.crc32(word.encode("utf-8", "surrogatepass")) % RUN_EVERY == 0:
            runs.append("".join(held))
            held.clear()
    if held:
        runs.append("".join(held))
    digests = [hashlib.blake2b(r.encode("utf-8", "surrogatepass"), digest_size=16).digest() for r in runs]
    whole = hashlib.blake2b(b"".join(digests), digest_size=16).hexdigest()
    return Paragraph(whole, b64encode(b"".join(d[:3] for d in digests)).decode())


def fingerprint(text: str, known: dict[str, Paragraph] | None = None) -> str:
    """The tree of a text; `known` keeps paragraphs for a text that shares some."""
    known = {} if known is None else known
    sections: list[list[Paragraph]] = []
    closed = True
    for line in text.splitlines(keepends=True) if text else ():
        own = known.get(line)
        if own is None:
            own = known[line] = paragraph(line)
        if closed:
            sections.append([])
        sections[-1].append(own)
        closed = int(own.digest[-2:], 16) & SECTION_BITS == 0
    nodes = [hashlib.blake2b("".join(p.digest for p in s).encode(), digest_size=16).hexdigest() for s in sections]
    root = hashlib.blake2b("".join(nodes).encode(), digest_size=16).hexdigest()
    parts = [root]
    for node, section in zip(nodes, sections):
        parts.append(f"/{node[:NODE]}")
        parts += [f":{p.digest[:NODE]}{p.runs}" for p in section]
    return "".join(parts)


def branches(tree: str) -> list[tuple[str, list[str]]]:
    """Sections of a fingerprint: digest and paragraphs (digest and runs).

    Base 64 has a `/`, so sections are found by their paragraphs' `:`.
    """
    out: list[tuple[str, list[str]]] = []
    for i, piece in enumerate(tree[ROOT:].split(":")):
        # a piece is a paragraph, and at its end may stand the digest of the next section
        has_next = (len(piece) - (NODE if i else 0)) % RUN == 1
        if i:
            out[-1][1].append(piece[: len(piece) - NODE - 1] if has_next else piece)
        if has_next:
            out.append((piece[-NODE:], []))
    return out


def unmatched(a: list[str], b: list[str]) -> tuple[list[int], list[int]]:
    """Places in both lists that have no equal in the other, repeats counted."""
    spare = Counter(a) & Counter(b)

    def rest(values: list[str]) -> list[int]:
        left, out = Counter(spare), []
        for i, v in enumerate(values):
            if left[v] > 0:
                left[v] -= 1
            else:
                out.append(i)
        return out

    return rest(a), rest(b)


def runs_of(paragraphs: list[str]) -> list[str]:
    return [p[i : i + RUN] for p in paragraphs for i in range(NODE, len(p), RUN)]


def likeness(a: str | None, b: str | None) -> float:
    """Share of equal word runs in both trees, 1 for equal roots; descends only where branches differ."""
    if a is None or b is None:
        return 0.0
    if a[:ROOT] == b[:ROOT]:
        return 1.0
    left, right = branches(a), branches(b)
    i, j = unmatched([s for s, _ in left], [s for s, _ in right])
    count = lambda sections: sum((len(p) - NODE) // RUN for _, ps in sections for p in ps)
    total = count(left) + count(right)
    lost_a, lost_b = [p for k in i for p in left[k][1]], [p for k in j for p in right[k][1]]
    i, j = unmatched([p[:NODE] for p in lost_a], [p[:NODE] for p in lost_b])
    runs_a, runs_b = runs_of([lost_a[k] for k in i]), runs_of([lost_b[k] for k in j])
    i, j = unmatched(runs_a, runs_b)
    # different roots never give 1, though cut digests may agree
    return min((total - len(i) - len(j)) / total, 0.999999) if total else 0.0


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers (from 0) of the paragraphs of each text that the other one lacks."""
    if a[:ROOT] == b[:ROOT]:
        return [], []
    left, right = branches(a), branches(b)
    i, j = unmatched([s for s, _ in left], [s for s, _ in right])

    def places(tree: list, open_: list[int]) -> tuple[list[int], list[str]]:
        starts = np.cumsum([0, *[len(p) for _, p in tree]])
        numbers = [int(starts[k]) + n for k in open_ for n in range(len(tree[k][1]))]
        return numbers, [p[:NODE] for k in open_ for p in tree[k][1]]

    (at_a, own_a), (at_b, own_b) = places(left, i), places(right, j)
    i, j = unmatched(own_a, own_b)
    return [at_a[k] for k in i], [at_b[k] for k in j]


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with the tree of each text; a null text is empty."""

    @F.pandas_udf("string")
    def trees(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return docs.withColumn(name, trees(text_or_empty(text)))


def likeness_of(a: str | Column, b: str | Column) -> Column:
    """Likeness of two fingerprint columns; 0 where one is null."""

    @F.pandas_udf("double")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(left, right)], dtype="float64")

    return alike(a, b)


def edits_of(a: str | Column, b: str | Column) -> Column:
    """Paragraph numbers that differ between two fingerprint columns."""

    @F.pandas_udf("removed array<int>, added array<int>")
    def find(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([differing(x, y) for x, y in zip(left, right)], columns=["removed", "added"])

    return find(a, b)


def in_order_with_next(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text, range, ahead) dealt by ranges of (id, first letters) and sorted within a partition.

    Spark chooses the ranges from the ids alone, of any type that can be ordered. The first
    row of a range also ends the range before it, marked `ahead`, and the first row of all
    ends the last range, so every row's successor follows it in its partition. The texts are
    shuffled once; the driver gets nothing.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), text_or_empty(F.col(f"`{text}`")).alias("text"))
    n = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    key = (F.col("id"), F.substring("text", 1, KEY_LETTERS).alias("letters"))
    starts = range_starts(rows.select(*key), n)
    placed = with_range(rows, F.struct(*key), starts, "range", n)
    begins = placed.filter(F.get(starts.scalar(), F.col("range")) == F.struct(*key))  # with the few others of the same key
    first = begins.groupBy("range").agg(F.min(F.struct("id", "text")).alias("row"))
    before = F.pmod(F.col("range") - 1, F.size(starts.scalar())).alias("range")
    ahead = first.select("row.id", "row.text", before, F.lit(True).alias("ahead"))
    both = placed.select("id", "text", "range", F.lit(False).alias("ahead")).unionByName(ahead)
    return both.repartitionById(n, "range").sortWithinPartitions("range", "ahead", F.col("id").asc_nulls_first(), "text")


def edited_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    In the edited text the last quarter of the code points (rounded down) gives way to as
    many first ones of the next document by id, or all it has; the last document is followed
    by the first. A null text is empty. Ids are of any type that can be ordered, and are never
    turned into another; null ids come first, documents with equal ids are in order of their
    texts. Every row of `docs` has its row, an empty table gives an empty result.
    """
    kind = next(f.dataType for f in docs.schema if f.name == id).simpleString()
    out = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: id, text, tree, its paragraphs
        range_ = None
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for doc, value, place, ahead in zip(*columns):
                if place != range_:
                    held, range_ = None, place
                known: dict[str, Paragraph] = {}
                tree = fingerprint(value, known)
                if held is not None:
                    before, own, own_tree, paragraphs = held
                    k = len(own) // 4
                    edited = own[: len(own) - k] + value[:k]
                    changed = fingerprint(edited, paragraphs)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append((before, len(own), digest, own_tree, changed, likeness(own_tree, changed), likeness(own_tree, tree)))
                held = None if ahead else (doc, value, tree, known)
                if ahead:
                    continue
            if rows:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return in_order_with_next(docs, id, text).select("id", "text", "range", "ahead").mapInArrow(walk, out)
