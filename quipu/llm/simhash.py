"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

The Hamming ball of radius 1 is enumerated around the whole fingerprint: every fingerprint
enters one table under its own value and under the 64 values that differ from it in one
bit. Two fingerprints at most 2 bits apart meet under the value halfway between them, and
whatever meets there is verified by its complete distance. There are no tables for single
segments, as the whole 64-bit value is the key: under a segment alone a family of near
copies would be one bucket, whose members would all be paired. So an entry holds at most
65 fingerprints, however many copies the corpus has: it is kept as a 64-bit mask of the
flipped bits, which Spark combines before the shuffle. More than 2 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import fresh, stored, text_or_empty
from .components import components

LANES = np.uint64(0x0101010101010101)
MOST_BITS = 2


def shingle_hashes(text: bytes, words: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's shingles, repeats included, in arrays of bounded size."""
    tokens = text.lower().split()  # bytes: A-Z only, and blanks 0x20 and 0x09 to 0x0D
    if not tokens:
        return
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    digest = xxhash.xxh64_intdigest
    last = len(tokens) - width + 1
    for i in range(0, last, 1 << 16):
        j = min(last, i + (1 << 16))
        spans = zip(starts[i:j].tolist(), ends[i + width - 1 : j + width - 1].tolist())
        yield np.fromiter((digest(line[s:e], seed) for s, e in spans), np.uint64, j - i)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest bit first."""
    out = np.empty((8, 8), np.int64)
    edges = np.arange(0, len(hashes), 255)  # a byte lane counts to 255
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, edges)
        out[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.ravel()


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash as an unsigned number; a text without words has 0."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words, seed):
        counts += bit_counts(hashes)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """`docs` with its fingerprint as a long in a last column of a free name; null is empty."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, words, seed) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return docs.withColumn(fresh(docs, "fingerprint"), simhash(text_or_empty(text).cast("binary")))


def links(values: DataFrame, max_bits: int = MOST_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that give all components.

    Every pair at most `max_bits` (0 to 2) apart is linked directly or by way of the
    least fingerprint of a table entry, itself within the distance of both.
    """
    if max_bits not in range(MOST_BITS + 1):
        raise ValueError("max_bits must be 0, 1 or 2")
    one, bits = F.lit(1).cast("long"), F.sequence(F.lit(0), F.lit(63))
    flips = F.transform(bits, lambda i: F.call_function("shiftleft", one, i))
    # no flip stands for the value itself
    probes = values.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)).alias("flip"))
    entries = probes.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).agg(
        F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("own")
    )
    met = entries.filter(F.bit_count("flips") + F.col("own").cast("int") > 1)
    others = F.transform(
        F.filter(bits, lambda i: F.getbit("flips", i) == 1),
        lambda i: F.col("value").bitwiseXOR(F.call_function("shiftleft", one, i)),
    )
    members = met.select("value", "own", others.alias("others")).select(
        "own", "value", F.when(F.col("own"), F.array_append("others", F.col("value"))).otherwise(F.col("others")).alias("members")
    )
    if max_bits == MOST_BITS:
        hub = F.array_min("members")
    else:  # only the value itself is within one bit of the others
        members = members.filter("own")
        hub = F.col("value")
    pairs = members.select(hub.alias("a"), F.explode("members").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.filter((F.col("a") != F.col("b")) & near).distinct()


def linked(rows: DataFrame, id: str, fp: str, max_bits: int = MOST_BITS) -> DataFrame:
    """(fp, label, component): each fingerprint's component and the least `id` in that.

    `rows` should be stored. A null id is passed over unless a component has no other.
    """
    values = stored(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(id).alias("least")), "fingerprints")
    labels = components(links(values, max_bits))
    label = F.coalesce("label", "fp").alias("label")
    placed = stored(values.join(labels, values.fp == labels.node, "left").select("fp", label, "least"), "placed")
    lowest = placed.groupBy("label").agg(F.min("least").alias("component"))
    return stored(placed.join(lowest, "label").select("fp", "label", "component"), "component")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    Empty and null texts have fingerprint zero and link like any other. Repeated rows are
    returned as often as they come; an empty table gives an empty result.
    """
    marked = fingerprints(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", words)
    rows = stored(marked.select("id", F.col(marked.columns[-1]).alias("value")), "simhash")
    found = linked(rows, "id", "value", max_bits)
    return rows.join(found, rows.value == found.fp, "left").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = MOST_BITS) -> DataFrame:
    """One row of each component: the least id, then the least hash of its text.

    Null ids come last. Of rows that repeat id and text one stays. Columns unchanged.
    """
    key = [F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")), F.col(f"`{id}`").isNull(), F.xxhash64(F.col(f"`{text}`"))]
    names = []
    keyed = docs
    for stem, column in zip(("id_text", "id_missing", "text_hash"), key):
        names.append(fresh(keyed, stem))
        keyed = keyed.withColumn(names[-1], column)
    slim = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), *[c.alias(f"k{i}") for i, c in enumerate(key)])
    marked = fingerprints(slim, "text", words)
    rows = stored(marked.select("id", "k0", "k1", "k2", F.col(marked.columns[-1]).alias("value")), "simhash")
    found = linked(rows, "id", "value", max_bits)
    # the rows with the least id of their component; the rest of the order decides between equals
    firsts = rows.join(found, rows.value == found.fp).filter(F.col("id").eqNullSafe(F.col("component")))
    kept = firsts.groupBy("label").agg(F.min(F.struct("k0", "k1", "k2")).alias("k"))
    keepers = stored(kept.select(*[F.col(f"k.k{i}").alias(n) for i, n in enumerate(names)]), "keepers")
    same = Window.partitionBy(*names).orderBy(F.lit(1))
    place = fresh(keyed, "place")
    survivors = keyed.join(keepers, names, "left_semi").withColumn(place, F.row_number().over(same))
    return survivors.filter(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
