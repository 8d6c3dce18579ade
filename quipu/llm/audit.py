"""How quality filters interact: which of them removes what, in every order of application.

The corpus becomes a sparse document-term matrix. A shard holds the rows of a few MB of text
as compressed sparse rows over its own words; all shards' words get their numbers from one
dictionary, dealt by word, and the numbers go back to the shards. Sums of the rows and counts
of their entries decide two filters, the other flags are attached, and counts by set of
failed filters are all that the 120 orders need.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import stored, table_of

FILTERS = "ABCDE"
A, B, C, D, E = (1 << i for i in range(5))
SHARD_BYTES = 4 << 20  # of text in a shard; one longer document is a shard of its own
BUCKET_WORDS = 1 << 21  # shards' words in a bucket of the dictionary, which one task numbers
CHUNK = 1 << 22  # bytes of a long text whose words are held at once
HOT_KEYS = 2000  # so many keys at most are broadcast, others have fewer than rows / HOT_KEYS rows
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """All words of a text in order, about CHUNK bytes of it at a time."""
    at = 0
    while at < len(text):
        gap = BLANK.search(text, at + CHUNK)
        end = gap.start() if gap else len(text)
        yield text[at:end].split()  # at just these blanks
        at = end


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes, all low bytes first: they compress better."""
    return np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def character_flags(text: bytes, caps_percent: int, marks: np.ndarray) -> int:
    """C and D of a text, from how often it has each byte."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(seen[0x80:0xC0].sum())  # bytes that do not begin a code point
    return C * (100 * int(seen[0x41:0x5B].sum()) > caps_percent * points) | D * bool(seen[marks].any())


def local_shards(docs: DataFrame, id: str, text: str, part: str, caps_percent: int, marks: str) -> DataFrame:
    """Shards of the matrix over their own words, with what else is kept of their documents."""
    key = docs.schema[id].dataType
    wanted = np.frombuffer(marks.encode("ascii"), np.uint8).astype(np.int64)
    schema = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("ids", T.ArrayType(key)),
            T.StructField("parts", T.ArrayType(T.StringType())),
            T.StructField("flags", T.ArrayType(T.IntegerType())),
            T.StructField("digests", T.ArrayType(T.BinaryType())),
            T.StructField("starts", T.BinaryType()),
            T.StructField("columns", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32

        def whole() -> pa.RecordBatch:
            row = [number, ids, parts, flags, digests, packed(np.cumsum([0, *lengths])), packed(np.fromiter(columns, np.int64, len(columns)))]
            row += [packed(np.fromiter(counts, np.int64, len(counts))), b" ".join(known), len(known)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, fields)], schema=fields)

        def clear() -> None:
            nonlocal known, ids, parts, flags, digests, lengths, columns, counts, size
            known, ids, parts, flags, digests, lengths, columns, counts, size = {}, [], [], [], [], [], [], [], 0

        known = ids = parts = flags = digests = lengths = columns = counts = size = None
        clear()
        for batch in batches:
            for doc, name, value in zip(*batch.columns):
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                if ids and size + len(data) > SHARD_BYTES:
                    yield whole()
                    number += 1
                    clear()
                bag: Counter[bytes] = Counter()
                for words in word_lists(data):
                    bag.update(words)
                columns += [known.setdefault(w, len(known)) for w in bag]
                counts += bag.values()
                lengths.append(len(bag))
                ids.append(doc.as_py())
                parts.append(name.as_py())
                flags.append(character_flags(data, caps_percent, wanted))
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
                size += len(data)
        if ids:
            yield whole()

    rows = docs.select(
        F.col(f"`{id}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    return rows.mapInArrow(build, schema)


def word_numbers(shards: DataFrame, buckets: int, with_words: bool = False) -> DataFrame:
    """For each shard and bucket of words, their places in the shard and their numbers.

    A word belongs to one bucket, whose task numbers its distinct words in the order of
    shards: the same numbers whenever a lost task runs again. `with_words` adds the words.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = blob.as_buffer().to_pybytes().split()
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                own = [k for k in range(buckets) if ends[k] < ends[k + 1]]
                places = [order[ends[k] : ends[k + 1]] for k in own]
                parts = [own, [shard] * len(own), [b" ".join([words[i] for i in p.tolist()]) for p in places], [packed(p) for p in places]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "shard", "words", "places"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, {}
        for batch in batches:
            out = []
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(2)):
                if bucket != last:
                    last, known = bucket, {}
                words = blob.as_buffer().to_pybytes().split()
                out.append(packed(np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words))))
            columns = [batch.column(i) for i in ((0, 1, 3, 2) if with_words else (0, 1, 3))]
            names = ["bucket", "shard", "places", *["words"] * with_words, "numbers"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names)

    dealt = shards.select("shard", "words").mapInArrow(deal, "bucket int, shard long, words binary, places binary")
    grouped = dealt.repartition(F.col("bucket")).sortWithinPartitions("bucket", "shard")
    return grouped.mapInArrow(number, f"bucket int, shard long, places binary, {'words binary, ' * with_words}numbers binary")


def bucket_count(shards: DataFrame) -> int:
    n = shards.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first().n
    return max(1, -(-n // BUCKET_WORDS))


def global_rows(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's compressed rows (starts, columns, counts) over the dictionary's numbers."""
    codes = np.zeros(row["n_words"], np.int64)
    for piece in row["pieces"]:
        codes[unpacked(piece["places"])] = (piece["bucket"] << 32) | unpacked(piece["numbers"]).astype(np.int64)
    return unpacked(row["starts"]).astype(np.int64), codes[unpacked(row["columns"])], unpacked(row["counts"]).astype(np.int64)


def matrix(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang", caps_percent: int = 10, marks: str = "#$%&*|") -> DataFrame:
    """Shards of the document-term matrix with the pieces of the dictionary that they need.

    A row is read by `global_rows`. Every row of `docs` is a row of the matrix; null text is
    empty. A shard holds about SHARD_BYTES of text, or one longer document.
    """
    shards = stored(local_shards(docs, id, text, part, caps_percent, marks), "term-shards")
    numbers = word_numbers(shards, bucket_count(shards))
    pieces = numbers.groupBy("shard").agg(F.collect_list(F.struct("bucket", "places", "numbers")).alias("pieces"))
    return shards.drop("words").join(pieces, "shard", "left")


def document_flags(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    least_words: int = 100,
    distinct_percent: int = 80,
    caps_percent: int = 10,
    marks: str = "#$%&*|",
) -> DataFrame:
    """id, part, failed (bits of A to E), n_words and n_distinct of every row.

    A: under `least_words` words; B: distinct words are under `distinct_percent` of all;
    C: A-Z are over `caps_percent` of the code points; D: holds one of `marks` (ASCII);
    E: a row with a smaller id has the same text. A null text is empty. Rows of one id are
    no copies of each other, and a null id is neither smaller nor larger than any. A text is
    known by 128 bits of its BLAKE2b digest.
    """
    shards = matrix(docs, id, text, part, caps_percent, marks)
    key = docs.schema[id].dataType
    schema = T.StructType(
        [
            T.StructField("id", key),
            T.StructField("part", T.StringType()),
            T.StructField("failed", T.IntegerType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_distinct", T.LongType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.select(["n_words", "starts", "columns", "counts", "pieces"]).to_pylist()[0]
                starts, codes, counts = global_rows(row | {"pieces": row["pieces"] or []})
                total = np.concatenate(([0], np.cumsum(counts)))[starts]
                entries = np.concatenate(([0], np.cumsum(counts > 0)))[starts]
                n, distinct = np.diff(total), np.diff(entries)
                flags = one.column("flags").flatten().to_numpy() | A * (n < least_words) | B * (100 * distinct < distinct_percent * n)
                yield pa.RecordBatch.from_arrays(
                    [one.column("ids").flatten(), one.column("parts").flatten(), pa.array(flags.astype(np.int32)), pa.array(n), pa.array(distinct), one.column("digests").flatten()],
                    schema.names,
                )

    rows = stored(shards.select("ids", "parts", "flags", "digests", "n_words", "starts", "columns", "counts", "pieces").mapInArrow(decide, schema), "failed")
    copies = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1")
    found = matched(rows, stored(copies, "copies"), "digest")
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * E
    return found.select("id", "part", F.col("failed").bitwiseOR(again).alias("failed"), F.col("n_words"), F.col("n_distinct"))


def matched(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """`rows` left joined to `keyed`, which has each key once and its number of rows `n`.

    Keys with over 1 / HOT_KEYS of all rows, at most HOT_KEYS, are broadcast; no other key can
    fill a task.
    """
    least = rows.count() / HOT_KEYS
    hot, cold = (keyed.filter(c).drop("n") for c in (F.col("n") > least, F.col("n") <= least))
    direct = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return direct.unionByName(others.join(cold, key, "left"))


def any_bit(bits: Column) -> Column:
    return bits != 0


def order_table() -> list[tuple[int, int, str, int]]:
    """(filter, those before it, order, step) of every step of every order, as bits."""
    bit = {name: 1 << i for i, name in enumerate(FILTERS)}
    return [
        (bit[f], sum(bit[x] for x in order[:i]), "".join(order), i + 1)
        for order in permutations(FILTERS)
        for i, f in enumerate(order)
    ]


def interactions(docs: DataFrame, labels: DataFrame, id: str = "doc_id", label_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic", **options) -> DataFrame:
    """part, filter_order, step and the step's counts, for all orders of the five filters.

    Where an id has several labels, one of quality 1 or toxic 1 is enough; ids without labels
    and null ids have neither. A part is each value of the part column, null the empty one. A
    table without rows has no parts and no result. `options` go to `document_flags`.
    """
    # equal rows are counted before they meet the labels, so no id fills a task
    counted = document_flags(docs, id, **options).groupBy("id", "part", "failed").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col(f"`{label_id}`").alias("id")).agg(
        F.coalesce(F.max(F.col(quality) == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col(toxic) == 1), F.lit(False)).alias("bad")
    )
    known = counted.join(marks.filter(F.col("id").isNotNull()), "id", "left")
    cells = known.groupBy("part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("bad", F.lit(False)).alias("bad")).agg(F.sum("n").alias("n"))
    sets = [(1 << i, sum(c)) for i in range(5) for k in range(5) for c in combinations([1 << j for j in range(5) if j != i], k)]
    turns = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(p).alias("before")) for b, p in sets]))
    at = cells.withColumn("turn", turns).select("*", "turn.bit", "turn.before").drop("turn")  # 80 rows for each of at most 128 cells
    fails = any_bit(F.col("failed").bitwiseAND(F.col("bit")))
    gone = any_bit(F.col("failed").bitwiseAND(F.col("before")))

    def total(condition: Column, times: Column | int = 1) -> Column:
        return F.sum(F.when(condition, F.col("n") * times).otherwise(0)).cast("long")

    removed = fails & ~gone
    share = F.lit(120) / F.greatest(F.bit_count("failed"), F.lit(1))  # orders in which it comes before all others that fail
    steps = at.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("bad")).alias("toxic_lost"),
        total(fails, share.cast("long")).alias("shapley"),
    )
    fields = T.StructType([T.StructField(n, t()) for n, t in (("bit", T.IntegerType), ("before", T.IntegerType), ("filter_order", T.StringType), ("step", T.IntegerType))])
    orders = table_of(docs.sparkSession, order_table(), fields)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return steps.join(F.broadcast(orders), ["bit", "before"]).select(*columns)


AUDIT_SQL = r"""
with words as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
    from documents
),
marked as (select doc_id, max(quality = 1) as good, max(toxic = 1) as bad from labels where doc_id is not null group by doc_id),
flags as (
    select part, coalesce(good, false) as good, coalesce(bad, false) as bad, {
        'A': len(ws) < 100,
        'B': 100 * len(list_distinct(ws)) < 80 * len(ws),
        'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'),
        'E': coalesce(doc_id > min(doc_id) over (partition by t), false)} as f
    from words left join marked using (doc_id)
),
long as (
    select part, good, bad, (case when f.A then 'A' else '' end) || (case when f.B then 'B' else '' end) || (case when f.C then 'C' else '' end)
        || (case when f.D then 'D' else '' end) || (case when f.E then 'E' else '' end) as failed
    from flags
),
cells as (select part, failed, good, bad, count(*) as n from long group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
),
steps as (select filter_order, step, filter_order[step] as f, filter_order[1:step - 1] as before from orders, (select unnest(range(1, 6)) as step)),
met as (
    select part, filter_order, step, f, n, good, bad, contains(failed, f) as fails, failed = f as only_it,
        length(translate(failed, before, '')) < length(failed) as gone
    from cells, steps
),
counted as (
    select part, filter_order, step, f,
        coalesce(sum(n) filter (not fails and not gone), 0) as kept, coalesce(sum(n) filter (fails and not gone), 0) as removed,
        coalesce(sum(n) filter (fails and gone), 0) as redundant, coalesce(sum(n) filter (only_it), 0) as unique_fails,
        coalesce(sum(n) filter (fails and not gone and good), 0) as good_lost, coalesce(sum(n) filter (fails and not gone and bad), 0) as toxic_lost
    from met group by all
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
    cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
    cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, f) as bigint) as shapley
from counted
"""
