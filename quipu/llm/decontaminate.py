"""Benchmark decontamination: documents are scanned for word n-grams of test items.

The normalised n-grams of the benchmark are made by Spark and sent to every task as a hash
set, once their size is checked. A document word that no n-gram has ends a run; only runs
long enough for a window are looked up, and a look-up compares the words themselves. A
benchmark beyond the size bound is matched by a shuffle join on whole n-grams instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import fresh, stored, text_or_empty

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GRAM_WORDS = 10
BROADCAST_BYTES = 64 << 20  # most bytes of n-gram text that are sent to every task
HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])


class Grams(NamedTuple):
    """Numbers of the words that occur in n-grams, and the items of each n-gram by length."""

    numbers: dict[bytes, int]
    items: dict[int, dict[tuple[int, ...], tuple[str | None, ...]]]


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return WORD.findall(text.lower())


def windows(words: list, n: int) -> Iterator[list]:
    """n consecutive words, again and again; all words where there are fewer."""
    for i in range(max(1, len(words) - n + 1) if words else 0):
        yield words[i : i + n]


def in_order(items: Iterable[str | None]) -> list[str | None]:
    """Sorted ids, a missing one last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def benchmark_grams(benchmark: DataFrame, id: str, text: str, n: int) -> DataFrame:
    """(gram, width, item): distinct windows of every item, words joined by blanks; an item may have no id."""
    kind = "array<struct<gram:binary,width:int>>"

    @F.pandas_udf(kind)
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"gram": b" ".join(w), "width": len(w)} for w in windows(words_of(t), n)] for t in texts])

    rows = benchmark.select(
        F.col(id).cast("string").alias("item"), F.explode(cut(text_or_empty(text).cast("binary"))).alias("w")
    )
    return rows.select("w.gram", "w.width", "item").distinct()


def hash_set(grams: DataFrame, most_bytes: int) -> Grams | None:
    """The n-grams in memory, or None where they have more than `most_bytes`."""
    size = grams.agg(F.sum(F.length("gram") + F.coalesce(F.length("item"), F.lit(0)) + 64).alias("n")).first().n or 0
    if size > most_bytes:
        return None
    numbers: dict[bytes, int] = {}
    items: dict[int, dict[tuple[int, ...], set[str | None]]] = {}
    for r in grams.toLocalIterator():
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in bytes(r.gram).split(b" "))
        items.setdefault(r.width, {}).setdefault(key, set()).add(r.item)
    return Grams(numbers, {w: {k: tuple(in_order(v)) for k, v in x.items()} for w, x in items.items()})


def scan(text: bytes, grams: Grams) -> tuple[int, np.ndarray, set[str | None]]:
    """Number of words, places of the words inside an occurrence, and the items found."""
    words = words_of(text)
    known = np.fromiter(map(grams.numbers.get, words, [0] * len(words)), np.int64, len(words))
    found: set[str | None] = set()
    hit = np.zeros(len(words), bool)
    for width, table in grams.items.items():
        # a window can only begin where `width` known words follow
        run = np.concatenate(([0], np.cumsum(known > 0)))
        for i in np.flatnonzero(run[width:] - run[:-width] == width).tolist() if len(words) >= width else ():
            own = table.get(tuple(known[i : i + width].tolist()))
            if own:
                found.update(own)
                hit[i : i + width] = True
    return len(words), np.flatnonzero(hit), found


def spans_of(text: bytes, places: np.ndarray) -> list[dict[str, int]]:
    """Runs of neighbouring hit words as code point ranges, ends exclusive."""
    if not len(places):
        return []
    at = np.array([m.span() for m in WORD.finditer(text.lower())])[places]
    first = np.flatnonzero(np.diff(places, prepend=-2) > 1)
    last = np.append(first[1:], len(places)) - 1
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(lead)))
    return [{"start": int(points[at[a, 0]]), "end": int(points[at[b, 1]])} for a, b in zip(first, last)]


def hits_by_broadcast(docs: DataFrame, text: str, grams: Grams) -> tuple[DataFrame, str]:
    held = docs.sparkSession.sparkContext.broadcast(grams)

    @F.pandas_udf(HITS)
    def look(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = held.value
        for texts in series:
            rows = []
            for value in texts:
                n, places, found = scan(value, table)
                rows.append((n, len(places), in_order(found), spans_of(value, places)))
            yield pd.DataFrame(rows, columns=HITS.names)

    name = fresh(docs, "hits")
    return docs.withColumn(name, look(text_or_empty(text).cast("binary"))), name


def hits_by_join(docs: DataFrame, text: str, grams: DataFrame, n: int) -> tuple[DataFrame, str]:
    """The same hits for a benchmark of any size: windows meet n-grams in a shuffle.

    Distinct texts are scanned once, keyed by their SHA-256. A task puts out the windows of
    its documents; hot windows of many documents spread over tasks by Spark's skew join.
    """
    name, key = fresh(docs, "hits"), fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(text_or_empty(text), 256))
    widths = sorted(r.width for r in grams.select("width").distinct().collect())  # at most n numbers

    @F.pandas_udf("array<struct<at:int,width:int,gram:binary>>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            words = words_of(t)
            out.append([{"at": i, "width": w, "gram": b" ".join(words[i : i + w])} for w in widths for i in range(len(words) - w + 1)])
        return pd.Series(out)

    texts = keyed.select(F.col(key).alias("k"), text_or_empty(text).cast("binary").alias("t")).dropDuplicates(["k"])
    shown = texts.select("k", F.explode(cut("t")).alias("w")).select("k", "w.at", "w.gram")
    met = stored(shown.join(grams, "gram").groupBy("k", "at").agg(F.max("width").alias("width"), F.collect_set(F.struct("item")).alias("items")), "windows")
    per_text = met.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("at", "width"))).alias("met"), F.array_distinct(F.flatten(F.collect_list("items")))["item"].alias("items"))

    @F.pandas_udf(HITS)
    def finish(texts: pd.Series, met: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for value, own, names in zip(texts, met, items):
            n_words = len(words_of(value))
            hit = np.zeros(n_words, bool)
            for w in own if own is not None else ():
                hit[w["at"] : w["at"] + w["width"]] = True
            places = np.flatnonzero(hit)
            rows.append((n_words, len(places), in_order(names) if names is not None else [], spans_of(value, places)))
        return pd.DataFrame(rows, columns=HITS.names)

    per_text = stored(per_text, "hits").withColumnsRenamed({"k": key, "met": f"{name}_met", "items": f"{name}_items"})
    found = keyed.join(per_text, key, "left").withColumn(name, finish(text_or_empty(text).cast("binary"), f"{name}_met", f"{name}_items"))
    return found.drop(key, f"{name}_met", f"{name}_items"), name


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = GRAM_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, str]:
    """`docs` with a struct column of its hits, and that column's name.

    The struct has n_words, n_hit (words inside an occurrence), items (sorted ids as text,
    null last for items without an id) and spans (code points). A null text has no words, and neither has a null item; repeated items count once; an empty benchmark hits nothing.
    """
    grams = benchmark_grams(benchmark, item_id, item_text, n)
    table = hash_set(grams, broadcast_bytes)
    if table is None:
        return hits_by_join(docs, text, stored(grams, "grams"), n)
    return hits_by_broadcast(docs, text, table)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows without any hit, columns unchanged."""
    found, name = find_hits(docs, benchmark, text, **options)
    return found.filter(F.col(f"{name}.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the given ordered, disjoint code point ranges."""
    edges = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    return F.array_join(F.transform(F.arrays_zip(edges.alias("a"), ends.alias("b")), lambda e: F.substring(text, e["a"] + 1, e["b"] - e["a"])), "")


def remove_hit_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows, with the hit spans cut out of `text`."""
    found, name = find_hits(docs, benchmark, text, **options)
    clean = F.when(F.size(f"{name}.spans") > 0, cut_spans(F.col(text), F.col(f"{name}.spans"))).otherwise(F.col(text))
    return found.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    All items without an id count as one in n_items, and no name stands for them in items_sha256.
    """
    found, name = find_hits(docs.select("doc_id", "text"), benchmark, **options)
    hits = F.col(name)
    return found.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        (hits["n_hit"] > 0).alias("contaminated"),
    )


CONTAMINATION_SQL = r"""
with words as (
    select 'd' as side, doc_id as id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from documents
    union all
    select 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    from benchmark
),
grams as (
    select distinct id as item_id, width, array_to_string(ws[i:i + width - 1], ' ') as gram
    from (select id, ws, least(len(ws), 10) as width, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from words where side = 'b' and len(ws) > 0)
),
shown as (
    select id as doc_id, i, w.width, array_to_string(ws[i:i + w.width - 1], ' ') as gram
    from (select id, ws, unnest(range(1, len(ws) + 1)) as i from words where side = 'd') d, (select distinct width from grams) w
    where i + w.width - 1 <= len(ws)
),
met as (select doc_id, i, s.width, g.item_id from shown s join grams g on g.width = s.width and g.gram = s.gram),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + width)) as p from met) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from met) group by doc_id)
select id as doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit on hit.doc_id = id left join items on items.doc_id = id
where side = 'd'
"""
