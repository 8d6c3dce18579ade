"""Packing documents into training sequences, shortest pack first over the length histogram.

Documents become token ids and are cut into pieces of at most one sequence. Only the
histogram of piece lengths goes to the driver; there the lengths are placed longest first,
each into the shortest packs with room, and the counts of the packing patterns are updated.
The patterns come back to the pieces by rank: the k-th piece of a length takes the k-th
place that the patterns have for that length.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import by_bytes, stored, text_or_empty
from .tokens import encoder

SEQUENCE = 1024
END_ID = 0
PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids binary, part int, place long"


class Slot(NamedTuple):
    """Places of one length: pieces ranked first .. first + count - 1 go to sequences sequence .. at `offset`."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


def pack_histogram(histogram: dict[int, int], room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns and their counts, from how many pieces each length has.

    A step uses up a length or a pattern, so there are at most a few thousand patterns
    whatever the counts are.
    """
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    levels: list[int] = []  # used lengths that have open packs, in order
    full = []

    def put(used: int, count: int, pattern: tuple[int, ...]) -> None:
        if used == room:
            full.append((count, pattern))
            return
        if not open_packs[used]:
            bisect.insort(levels, used)
        open_packs[used].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not levels or levels[0] + length > room:
                put(length, left, (length,))
                break
            used = levels[0]
            count, pattern = open_packs[used].pop()
            if not open_packs[used]:
                levels.pop(0)
            taken = min(count, left)
            left -= taken
            if count > taken:
                put(used, count - taken, pattern)
            put(used + length, taken, (*pattern, length))
    return full + [p for used in levels for p in open_packs[used]]


def slots_of(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, list[Slot]]:
    """Places by length, ranks ascending; sequences are numbered pattern by pattern."""
    out: dict[int, list[Slot]] = defaultdict(list)
    ranks: Counter = Counter()
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            out[length].append(Slot(length, ranks[length], count, sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    return out


def cut_pieces(docs: DataFrame, id: str, text: str, room: int, end_id: int, tokenizer: str | None) -> DataFrame:
    """Token ids of every text and `end_id`, in pieces of at most `room` ids.

    `part` is the task that made a piece and `place` its place there among pieces of its
    length. Both are stored with the piece, so a task that runs again changes nothing.
    """
    rows = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        places: Counter = Counter()
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for some in by_bytes(pairs, 4 << 20, lambda p: len(p[1])):
                out = []
                for (doc, _), ids in zip(some, encode([t for _, t in some])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), room):
                        piece = ids[start : start + room]
                        out.append((doc, start, len(piece), len(ids), piece.tobytes(), part, places[len(piece)]))
                        places[len(piece)] += 1
                columns = list(zip(*out))
                kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "length", "doc_tokens", "ids", "part", "place"]
                )

    return stored(rows.mapInArrow(cut, kind), "pieces")


def seat(slots: dict[int, list[Slot]]) -> Column:
    """A function of length and rank: struct of `sequence_id` and `offset`."""
    table = {n: tuple(np.array([getattr(s, f) for s in own], np.int64) for f in ("first", "sequence", "offset")) for n, own in slots.items()}

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for n in np.unique(lengths):
            own = lengths == n
            first, sequence, offset = table[int(n)]
            k = np.searchsorted(first, ranks[own], "right") - 1
            out[0, own], out[1, own] = sequence[k] + ranks[own] - first[k], offset[k]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    return find


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    room: int = SEQUENCE,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: Column | None = None,
    name: str = "ids",
) -> DataFrame:
    """Pieces with their place: doc_id, start, length, doc_tokens, sequence_id, offset, and `name`.

    `name` holds the token ids as little-endian unsigned 32-bit numbers, or what `with_ids`
    derives from the column `ids`. A null text is empty and gives the end id alone; repeated
    rows are packed as often as they come; an empty table gives no piece.
    """
    pieces = cut_pieces(docs, id, text, room, end_id, tokenizer)
    # each length and task once; the histogram has at most `room` rows
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = slots_of(pack_histogram(histogram, room))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "ranks")
    carried = with_ids if with_ids is not None else F.col("ids")
    slim = pieces.select("doc_id", "start", "length", "doc_tokens", "part", "place", carried.alias(name))
    ranked = slim.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    placed = ranked.withColumn("seat", seat(slots)("length", "rank"))
    return placed.select("doc_id", "start", "length", "doc_tokens", "seat.sequence_id", "seat.offset", name)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with the checksum of their ids."""
    return pack(docs, with_ids=F.crc32("ids"), name="ids_crc32")
