"""Ranked lexical search by dense blocked matrix products.

The vocabulary is that of the items alone. A document becomes its counts of these terms,
kept in a table; a tile of documents becomes a dense matrix of impacts, a tile of items a
dense matrix of weights, and one float64 product gives all scores of both. Weights are split
into digits of 20 bits and tiles have at most 4,096 terms, so with impacts below 2^20 every
partial sum stays below 2^52 and is exact; the digits' sums are added as 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import stored, table_of

DIGIT_BITS = 20  # of a weight; impacts are below 10^6 < 2^20
TERMS_AT_ONCE = 4096  # 2^12 terms x 2^20 x 2^20 = 2^52
DOCS_AT_ONCE = 256
ITEMS_AT_ONCE = 256
BLOCK_BYTES = 16 << 20  # of item texts that the driver reads at once
BLOCK_ITEMS = 8192
CHUNK = 1 << 22  # bytes of a long text whose words are held at once

#: letters, digits and all bytes of other characters stay, A-Z become small, the rest parts terms
LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text in order, about CHUNK bytes of it at a time."""
    plain = text.translate(LETTERS)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """Of terms by the number of documents that hold them."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of terms in documents of the given lengths."""
    norm = 75 + (25 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


def tiles(items: list[dict[int, int]], weight: np.ndarray) -> list[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """Weight matrices of the items: (first item, number, terms, digits from the lowest).

    A tile's terms are those of its items only. Digit k of an item's term is bits 20k to
    20k + 19 of its weight times its repeats.
    """
    out = []
    for first in range(0, len(items), ITEMS_AT_ONCE):
        own = items[first : first + ITEMS_AT_ONCE]
        terms = np.array(sorted({t for i in own for t in i}), np.int64)
        for a in range(0, len(terms), TERMS_AT_ONCE):
            part = terms[a : a + TERMS_AT_ONCE]
            at = {t: k for k, t in enumerate(part.tolist())}
            whole = np.zeros((len(own), len(part)), np.int64)
            for row, item in enumerate(own):
                for t, n in item.items():
                    if t in at:
                        whole[row, at[t]] = n * weight[t]
            digits = []
            while whole.any():
                digits.append((whole & (1 << DIGIT_BITS) - 1).astype(np.float64))
                whole >>= DIGIT_BITS
            out.append((first, len(own), part, digits))
    return out


def tile_scores(tile, terms: np.ndarray, rows: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of a tile's items (down) in `n_docs` documents (across), from (term, document, impact)."""
    _, n_items, own, digits = tile
    total = np.zeros((n_items, n_docs), np.int64)
    if len(digits) and len(terms):
        place = np.searchsorted(own, terms)
        place[place == len(own)] = 0
        met = own[place] == terms
        dense = np.zeros((len(own), n_docs))
        dense[place[met], rows[met]] = impact[met]
        for k, digit in enumerate(digits):
            total += (digit @ dense).astype(np.int64) << DIGIT_BITS * k
    return total


def count_terms(docs: DataFrame, id: str, text: str, numbers: dict[bytes, int]) -> DataFrame:
    """id, n (terms of the whole text) and the counts of the known terms, for every row."""
    held = docs.sparkSession.sparkContext.broadcast(numbers)
    fields = [T.StructField("id", docs.schema[id].dataType), T.StructField("n", T.LongType())]
    fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("terms", "tf")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        for batch in batches:
            lengths, found, times = [], [], []
            for text in batch.column(1):
                n, sums = 0, []
                for words in term_lists(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    n += len(words)
                    known = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                    sums.append(np.unique(known[known >= 0], return_counts=True))
                if len(sums) > 1:
                    ids, back = np.unique(np.concatenate([a for a, _ in sums]), return_inverse=True)
                    sums = [(ids, np.bincount(back, np.concatenate([b for _, b in sums]), len(ids)).astype(np.int64))]
                ids, tf = sums[0] if sums else (np.empty(0, np.int32), np.empty(0, np.int64))
                lengths.append(n)
                found.append(ids)
                times.append(tf)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *x]).astype(np.int32))) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], ["id", "n", "terms", "tf"])

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(count, T.StructType(fields))


def first_of_each(table: pa.Table, k: int) -> pa.Table:
    """The k best rows of each item: score falling, then id rising, null ids last."""
    table = table.take(pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("id", "ascending")]))
    item = table.column("item").to_numpy()
    begin = np.flatnonzero(np.diff(item, prepend=-1))
    nth = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
    return table.filter(pa.array(nth < k))


def best_of_tiles(counted: DataFrame, items: list[dict[int, int]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's k best documents of every item."""
    held = counted.sparkSession.sparkContext.broadcast(tiles(items, weight))
    n_items = len(items)
    fields = [T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()), counted.schema["id"]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = None, np.zeros(n_items, np.int64)  # the lowest score that still matters
        for batch in batches:
            batch = batch.take(pc.sort_indices(pa.table({"id": batch.column(0)}), [("id", "ascending")]))
            for a in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(a, DOCS_AT_ONCE)
                size, terms, tf = part.num_rows, part.column(2), part.column(3).flatten().to_numpy()
                rows = np.repeat(np.arange(size), np.diff(terms.offsets.to_numpy()))
                terms = terms.flatten().to_numpy().astype(np.int64)
                impact = impacts(tf.astype(np.int64), part.column(1).to_numpy()[rows], n_docs, max(n_terms, 1))
                scores = np.zeros((n_items, size), np.int64)
                for tile in held.value:
                    scores[tile[0] : tile[0] + tile[1]] += tile_scores(tile, terms, rows, impact, size)
                item, doc = np.nonzero((scores > 0) & (scores >= least[:, None]))
                if not len(item):
                    continue
                own = pa.table({"item": item.astype(np.int32), "score": scores[item, doc], "id": part.column(0).take(pa.array(doc))})
                best = first_of_each(own if best is None else pa.concat_tables([best, own]), k).combine_chunks()
                held_items, last = best.column("item").to_numpy(), best.column("score").to_numpy()
                full = np.flatnonzero(np.bincount(held_items, minlength=n_items) == k)
                least[full] = last[np.searchsorted(held_items, full, "right") - 1]
        if best is not None:
            yield from best.to_batches()

    return counted.mapInArrow(search, T.StructType(fields))


def blocks(items: DataFrame, id: str, text: str, block_bytes: int, block_items: int) -> Iterator[list]:
    """Rows (id, text) of the items, in lists of bounded size or of one item."""
    kept = stored(items.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")), "items")
    size = kept.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("b")).first()
    if not size.n:
        return
    n = max(1, -(-size.n // block_items), -(-2 * size.b // block_bytes))
    numbered = stored(kept.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n))), "item-blocks")
    for k in range(n):
        held, total = [], 0
        for r in numbered.filter(F.col("block") == k).select("id", "text").toLocalIterator():
            if held and total + len(r.text or b"") > block_bytes:
                yield held
                held, total = [], 0
            held.append(r)
            total += len(r.text or b"")
        if held:
            yield held


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's `k` best documents with a score above 0.

    Every document counts in the corpus statistics, every item is searched against all of
    them, in blocks of items: a block is what the driver and a task hold of the items, at most
    `block_bytes` of text and `block_items` items, or one item however long. A null or empty
    text has no terms, and an item without any found term has no row. Every row of `items` is
    an item of its own, repeated ids or not; repeated rows of `docs` are ranked each by itself.
    Equal scores go by rising id, a null id last. A table without rows gives none.
    """
    totals, found = None, None
    fields = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_id].dataType)])
    ranked = T.StructType([fields["item_id"], T.StructField("rank", T.IntegerType()), T.StructField(id, docs.schema[id].dataType), T.StructField("score", T.LongType())])
    for block in blocks(items, item_id, item_text, block_bytes, block_items):
        bags = [Counter(w for words in term_lists(bytes(r.text or b"")) for w in words) for r in block]
        numbers = {w: i for i, w in enumerate(sorted({w for bag in bags for w in bag}))}
        counted = stored(count_terms(docs, id, text, numbers), "term-counts")
        if totals is None:
            totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(numbers), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row for each item term
            df[r.t] = r["count"]
        bags = [{numbers[w]: n for w, n in bag.items()} for bag in bags]
        best = best_of_tiles(counted.filter(F.size("terms") > 0), bags, weights(totals.docs, df), totals.docs, totals.terms, k)
        order = [F.desc("score"), F.asc_nulls_last("id")]
        # tasks' lists are first cut within a few hundred groups of tasks, so no item's rows all meet at once
        some = best.withColumn("part", F.spark_partition_id() % 256)
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
        last = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        names = table_of(docs.sparkSession, [(i, r.id) for i, r in enumerate(block)], fields)
        own = last.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias(id), "score")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return table_of(docs.sparkSession, [], ranked)
    return found.withColumnRenamed("item_id", item_id)


RANKED_SQL = r"""
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws
    from documents
),
size as (select count(*) as nd, cast(sum(len(ws)) as bigint) as nt from words where len(ws) > 0),
asked as (
    select item_id, term, count(*) as times
    from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
    group by item_id, term
),
tf as (
    select doc_id, n, term, count(*) as tf
    from (select doc_id, len(ws) as n, unnest(ws) as term from words)
    where term in (select term from asked)
    group by doc_id, n, term
),
weight as (
    select term, cast(floor(1000 * ln(cast(2 * any_value(nd) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
    from tf, size group by term
),
score as (
    select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nt)))) as bigint) as score
    from tf join weight using (term) join asked using (term), size
    group by item_id, doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from score where score > 0)
where rank <= 20
"""
