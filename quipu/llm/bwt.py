"""Repeated passages by a radix refinement over the strings of text shards.

Every byte covered by a string of `least` bytes that starts at two places is removed.

Only strings that may repeat reach the transforms. A string of `least` bytes has an anchor:
of its grams of `GRAM` bytes the one with the least hash, the leftmost of equals. Equal
strings have equal anchors, so strings meet by the anchor's hash. Strings that follow one
another in a text and share an anchor are sent as one stretch; stretches that are equal
throughout settle each other by their digests, and one of each different kind goes on.

Different stretches with the same anchor are laid out in shards. The symbol of a position is
the `width` bytes before it (50), numbered by prefix doubling for all shards together. A
radix refinement over these numbers follows: starting with no order, a pass deals the rows
to the places of their symbols, steps to the positions where these begin, and marks where
the common string ends. Rows alone in their block drop out, since what precedes them is
unique as well. After least / width passes each block is a repeated string. The shards are
not sorted into transforms of their own, as only equality of symbols decides.

An anchor with very many different stretches (a common line among changing text) would be a
large group in one task. Its stretches are cut into pieces that meet by all bytes their
strings have in common instead of the anchor's alone, and go the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import by_bytes, stored, text_or_empty

LEAST = 200
GRAM = 48
SEGMENT = 1 << 17  # window starts handled at once; bounds a task's memory
PLACE = np.uint64((1 << 20) - 1)
BASE = 0x9E3779B97F4A7C15
CROWD = 256  # different stretches of one anchor that a merge takes
STEPS = (16, 4, 1)  # string starts that a piece of a crowded stretch has, ever finer
MASK = (1 << 64) - 1
SHARD_BYTES = 32 << 10
MERGE_BYTES = 1 << 20


@lru_cache(1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    n = SEGMENT + 4096
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of every `gram` bytes; it depends on these bytes alone."""
    up, down = powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Stretches(NamedTuple):
    anchor: np.ndarray
    digest: np.ndarray
    start: np.ndarray
    length: np.ndarray


def stretches(text: bytes, least: int, gram: int) -> Iterator[Stretches]:
    """The text's strings of `least` bytes, those in a row with one anchor as a stretch."""
    for begin in range(0, len(text) - least + 1, SEGMENT):
        part = text[begin : begin + SEGMENT + least - 1]
        hashes = gram_hashes(np.frombuffer(part, np.uint8), gram)
        # the leftmost of equal hashes wins, since the place fills the low bits
        ranked = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_least(ranked, least - gram + 1) & PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        length = np.append(first[1:], len(place)) - first + least - 1
        spans = zip(first.tolist(), length.tolist())
        digest = np.fromiter((xxhash.xxh3_64_intdigest(part[i : i + n], seed=10) for i, n in spans), np.uint64, len(first))
        yield Stretches(hashes[place[first]].view(np.int64), digest.view(np.int64), first + begin, length)


class Shard(NamedTuple):
    """Positions, the bytes before each by number, and the row of the position where these begin."""

    position: np.ndarray
    symbol: np.ndarray
    earlier: np.ndarray  # -1 where the string begins too soon


class Text(NamedTuple):
    """Strings one after another, each followed by one end position, the suffix without bytes."""

    words: np.ndarray  # number of the 8 bytes from each position on, ends and what follows as 0
    ends: np.ndarray  # first position after each position's string
    offset: np.ndarray  # place of each position in its string


def numbered(*parts: np.ndarray) -> np.ndarray:
    """Numbers in the order of the given columns, equal ones alike."""
    key = parts[0] if len(parts) == 1 else parts[0].astype(np.int64) << 32 | parts[1]
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def laid_out(strings: list[bytes]) -> Text:
    lengths = np.fromiter((len(s) + 1 for s in strings), np.int64, len(strings))
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(ends))
    offset = at - (ends - np.repeat(lengths, lengths))
    data = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for i in range(8):  # bytes behind the end do not count
        inside = at + i < ends - 1
        words |= np.where(inside, np.append(data[i:], np.zeros(i, np.uint64)), np.uint64(0)) << np.uint64(56 - 8 * i)
    return Text(words, ends, offset)


def later(values: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """One more than the value `step` positions on in the same string, 0 behind its end."""
    at = np.arange(len(values)) + step
    return np.where(at < ends, values[np.minimum(at, len(values) - 1)] + 1, 0)


def before(text: Text, width: int) -> np.ndarray:
    """Number of the `width` bytes before each position; right where the string has as many."""
    have = min(8, width)
    names = numbered(text.words >> np.uint64(8 * (8 - have)))
    while have < width:
        step = min(have, width - have)
        names, have = numbered(names, later(names, text.ends, step)), have + step
    return np.concatenate([np.zeros(width, np.int64), names])[: len(names)]


def linked(text: Text, names: np.ndarray, width: int, begin: int) -> Shard:
    """Rows of a shard's text as they come; its first position is `begin` of the merge."""
    at = np.arange(len(names))
    return Shard(at + begin, names, np.where(text.offset >= width, at - width, -1))


def dealt(symbols: np.ndarray) -> np.ndarray:
    """Order of rows by symbol number, equal ones as they come: two passes of 16 bits."""
    low = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    high = (symbols >> 16).astype(np.uint16)
    return low[np.argsort(high[low], kind="stable")] if high.any() else low


def merge(shards: list[Shard], least: int, width: int) -> np.ndarray:
    """Positions at which a string of `least` bytes starts that starts at another position too."""
    firsts = np.cumsum([0, *[len(s.position) for s in shards]])
    position = np.concatenate([s.position for s in shards])
    symbol = np.concatenate([s.symbol for s in shards])
    earlier = np.concatenate([np.where(s.earlier < 0, -1, s.earlier + f) for s, f in zip(shards, firsts)])
    rows, block = np.arange(len(position)), np.zeros(len(position), np.int64)
    for _ in range(least // width):
        has = earlier[rows] >= 0
        rows, block = rows[has], block[has]
        symbols = symbol[rows]
        order = dealt(symbols)
        symbols, block, rows = symbols[order], block[order], earlier[rows[order]]
        cut = np.ones(len(rows), bool)  # here the common prefix with the row above ends
        cut[1:] = (symbols[1:] != symbols[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(cut) - 1
        shared = np.bincount(block)[block] > 1 if len(block) else cut
        rows, block = rows[shared], block[shared]
    return np.sort(position[rows])


def symbol_width(least: int) -> int:
    """Bytes in a symbol: the largest divisor of `least` up to 64."""
    return next(w for w in range(64, 0, -1) if least % w == 0)


def repeated_starts(strings: list[bytes], least: int, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each string the offsets at which a repeated string of `least` bytes starts.

    Symbols are numbered once for all shards, so that their rows speak of the same.
    """
    if not strings:
        return []
    width = symbol_width(least)
    names = before(laid_out(strings), width)
    shards, begin = [], 0
    for held in by_bytes(strings, shard_bytes, lambda s: len(s) + 1):
        text = laid_out(held)
        end = begin + len(text.ends)
        shards.append(linked(text, names[begin:end], width, begin))
        begin = end
    found = merge(shards, least, width)
    edges = np.cumsum([0, *[len(s) + 1 for s in strings]])
    cuts = np.searchsorted(found, edges)
    return [found[a:b] - e for a, b, e in zip(cuts[:-1], cuts[1:], edges[:-1])]


def spans_of(starts: np.ndarray, least: int) -> list[dict[str, int]]:
    """Runs of bytes covered by strings that start at the given ascending offsets."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.diff(starts, prepend=starts[0] - least - 1) > least)
    last = np.append(first[1:], len(starts)) - 1
    return [{"start": int(starts[a]), "end": int(starts[b]) + least} for a, b in zip(first, last)]


SPANS = "array<struct<start:int,end:int>>"


def text_keys(text: str) -> list:
    """Two columns that stand for a text: a 64-bit hash and its length in bytes."""
    value = text_or_empty(text)
    return [F.xxhash64(value).alias("key"), F.octet_length(value).alias("size")]


def find_stretches(docs: DataFrame, text: str, least: int, gram: int) -> DataFrame:
    """(anchor, digest, key, size, start, length) of every stretch, stored."""
    rows = docs.select(*text_keys(text), text_or_empty(text).cast("binary").alias("text")).filter(F.col("size") >= least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "digest", "key", "size", "start", "length"]
        for batch in batches:
            for key, size, value in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                for s in stretches(value, least, gram):
                    n = len(s.anchor)
                    own = [s.anchor, s.digest, np.full(n, key), np.full(n, size, np.int32), s.start.astype(np.int32), s.length.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in own], names)

    kind = "anchor long, digest long, key long, size int, start int, length int"
    return stored(rows.mapInArrow(grouped(cut), kind), "stretches")


def grouped(fn, rows: int = 100_000):
    """`fn` with its small batches put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in fn(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def fetch(docs: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """(anchor, digest, crowded, value): the bytes of the wanted stretches, stored.

    Of the documents with a text the one with the least id is read; a stretch may come
    twice if rows repeat.
    """
    name = F.coalesce(F.col(id).cast("string"), F.lit("")).alias("name")
    firsts = docs.select(*text_keys(text), name).groupBy("key", "size").agg(F.min("name").alias("name"))
    lists = wanted.groupBy("key", "size").agg(F.collect_list(F.struct("anchor", "digest", "crowded", "start", "length")).alias("wanted"))
    lists = stored(lists.join(firsts, ["key", "size"]), "wanted")
    rows = docs.select(*text_keys(text), name, text_or_empty(text).cast("binary").alias("text"))
    met = rows.join(lists, ["key", "size", "name"]).select("text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, parts in zip(batch.column(0), batch.column(1)):
                value, parts = value.as_py(), parts.as_py()
                own = [(p["anchor"], p["digest"], p["crowded"], value[p["start"] : p["start"] + p["length"]]) for p in parts]
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*own), kinds)], ["anchor", "digest", "crowded", "value"])

    return stored(met.mapInArrow(grouped(cut, 10_000), "anchor long, digest long, crowded boolean, value binary"), "values")


def merged_spans(values: DataFrame, least: int) -> DataFrame:
    """(anchor, digest, spans) by merged transforms; an anchor's stretches are in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        size = 0

        def settle() -> pa.RecordBatch:
            found = [spans_of(s, least) for s in repeated_starts([v for _, _, v in held], least)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), pa.array(found, kind)]
            return pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "spans"])

        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if held and row[:2] == held[-1][:2]:
                    continue
                if size > MERGE_BYTES and row[0] != held[-1][0]:
                    yield settle()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield settle()

    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work follows the bytes; keep all tasks
    dealt_out = values.select("anchor", "digest", "value").repartition(tasks, "anchor").sortWithinPartitions("anchor", "digest")
    return dealt_out.mapInArrow(run, f"anchor long, digest long, spans {SPANS}").filter(F.size("spans") > 0)


def cut_pieces(values: DataFrame, step: int, least: int, gram: int) -> DataFrame:
    """Stretches cut by where their strings stand to the anchor, `step` places at a time, stored.

    Strings of the same place and content share the bytes that all strings of a piece have in
    common, its core; the core's hash is the piece's own anchor. Columns: up_anchor, up_digest
    (the stretch), anchor, digest, start (in the stretch), at (the anchor's place), value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        names = ["up_anchor", "up_digest", "anchor", "digest", "start", "at", "value"]
        for batch in batches:
            out = []
            for anchor, digest, at, value in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if at is None:
                    at = int(np.argmax(gram_hashes(np.frombuffer(value, np.uint8), gram).view(np.int64) == anchor))
                # a string that starts at p stands at - p bytes before the anchor
                for j in range(max(0, at - (len(value) - least)) // step, at // step + 1):
                    start = max(0, at - j * step - step + 1)
                    end = min(len(value), at - j * step + least)
                    core = value[at - j * step : at - j * step - step + 1 + least]
                    piece = value[start:end]
                    own = xxhash.xxh3_128_intdigest(core, seed=j)
                    other = xxhash.xxh3_64_intdigest(piece, seed=at - start)
                    out.append((anchor, digest, *np.array([own >> 64 ^ own & MASK, other], np.uint64).view(np.int64).tolist(), start, at - start, piece))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    kind = "up_anchor long, up_digest long, anchor long, digest long, start int, at int, value binary"
    return stored(values.select("anchor", "digest", "at", "value").mapInArrow(grouped(run, 10_000), kind), "pieces")


def crowded_spans(values: DataFrame, least: int, gram: int, crowd: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """(anchor, digest, spans) of stretches whose anchor has too many for one merge.

    Their pieces meet by the hash of the piece's core instead of the anchor. Equal pieces
    settle each other, the others are merged; what is still crowded is cut finer, in the end
    into single strings, which are equal where their cores are.
    """
    parts = cut_pieces(values, steps[0], least, gram)
    kinds = parts.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.first("at").alias("at"), F.first("value").alias("value"))
    kinds = stored(kinds, "piece-kinds")
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("rarest")).filter("kinds > 1 and rarest = 1").drop("rarest")
    differing = kinds.join(stored(many, "many"), "anchor")
    whole = kinds.filter("n > 1").select("anchor", "digest", F.array(F.struct(F.lit(0).alias("start"), F.octet_length("value").alias("end"))).alias("spans"))
    found = whole.unionByName(merged_spans(differing.filter(F.col("kinds") <= crowd), least))
    crowded = differing.filter(F.col("kinds") > crowd)
    if len(steps) > 1 and not crowded.isEmpty():
        found = found.unionByName(crowded_spans(crowded, least, gram, crowd, steps[1:]))
    own = F.transform("spans", lambda s: F.struct((s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end")))
    up = parts.select("up_anchor", "up_digest", "anchor", "digest", "start").join(stored(found, "piece-spans"), ["anchor", "digest"])
    up = up.select(F.col("up_anchor").alias("anchor"), F.col("up_digest").alias("digest"), own.alias("spans"))
    return up.groupBy("anchor", "digest").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def repeated_spans(docs: DataFrame, id: str, text: str, least: int, gram: int, crowd: int) -> DataFrame:
    """(key, size, spans): byte ranges of every text that a repeated string covers, stored; ranges may overlap."""
    found = find_stretches(docs, text, least, gram)
    anchors = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    shared = stored(found.join(stored(anchors, "anchors"), "anchor"), "shared")
    one = F.min(F.struct("key", "size", "start", "length")).alias("one")
    kinds = stored(shared.groupBy("anchor", "digest").agg(F.count("*").alias("n"), one).select("anchor", "digest", "n", "one.*"), "kinds")
    # kinds that occur twice are settled, so an anchor needs one that does not and another one
    many = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("rarest")).filter("kinds > 1 and rarest = 1").drop("rarest")
    wanted = kinds.join(stored(many, "many"), "anchor").withColumn("crowded", F.col("kinds") > crowd)
    values = fetch(docs, stored(wanted, "differing"), id, text)
    whole = kinds.filter("n > 1").select("anchor", "digest", F.array(F.struct(F.lit(0).alias("start"), F.col("length").alias("end"))).alias("spans"))
    parts = merged_spans(values.filter("not crowded"), least)
    crowded = values.filter("crowded").dropDuplicates(["anchor", "digest"]).withColumn("at", F.lit(None).cast("int"))
    if not crowded.isEmpty():
        parts = parts.unionByName(crowded_spans(crowded, least, gram, crowd))
    spans = stored(whole.unionByName(parts), "spans")
    own = F.transform("spans", lambda s: F.struct((s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end")))
    placed = shared.join(spans, ["anchor", "digest"]).select("key", "size", F.explode(own).alias("span"))
    # a group of copies comes down to one set of ranges before the shuffle
    return stored(placed.groupBy("key", "size").agg(F.sort_array(F.collect_set("span")).alias("spans")), "ranges")


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, gram: int = GRAM, crowd: int = CROWD
) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed and n_spans of every row of `docs`.

    Strings are judged on the input: of a repeated passage every occurrence goes, in the
    same document or in others, overlaps included; matches never cross documents. Spans are
    the removed runs. A null text is empty; texts shorter than `least` keep everything;
    repeated rows are copies of each other; an empty table gives no rows.
    """
    if not gram < least:
        raise ValueError("gram must be shorter than least")
    ranges = repeated_spans(docs, id, text, least, gram, crowd)

    @F.pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for value, first, last in zip(texts, starts, ends):
            kept, reach, removed, runs = [], 0, 0, 0
            for start, end in zip(first.tolist(), last.tolist()) if first is not None else ():
                if start > reach or not runs:
                    kept.append(value[reach:start])
                    runs += 1
                    removed += end - start
                    reach = end
                elif end > reach:
                    removed += end - reach
                    reach = end
            kept.append(value[reach:])
            out.append((b"".join(kept), removed, runs))
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    rows = docs.select(F.col(id).alias("doc_id"), *text_keys(text), text_or_empty(text).cast("binary").alias("text"))
    part = lambda name: F.transform("spans", lambda s: s[name])
    made = rows.join(ranges, ["key", "size"], "left").withColumn("made", cut("text", part("start"), part("end")))
    return made.select("doc_id", "made.kept", F.col("size").cast("long").alias("n_bytes"), "made.n_removed", "made.n_spans")


def kept_bytes(docs: DataFrame) -> DataFrame:
    """Counts and the checksum of what is left of every document."""
    found = remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows as `kept_bytes`: every window's digest is counted, and runs of repeated ones are cut out.
REPEATS_SQL = f"""
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
sized as (select doc_id, h, cast(length(h) / 2 as bigint) as n_bytes from texts),
segments as (
    select doc_id, n_bytes, s, substr(h, 2 * s + 1, {2 * (LEAST + 499)}) as part
    from (select doc_id, n_bytes, h, unnest(range(0, greatest(n_bytes - {LEAST - 1}, 0), 500)) as s from sized)
),
strings as (
    select doc_id, s + j as i, md5(substr(part, 2 * j + 1, {2 * LEAST})) as digest
    from (select doc_id, s, part, unnest(range(0, least(500, n_bytes - {LEAST - 1} - s))) as j from segments)
),
twice as (select digest from strings group by digest having count(*) > 1),
starts as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as step from strings join twice using (digest)),
marked as (select doc_id, i, sum(case when step <= {LEAST} then 0 else 1 end) over (partition by doc_id order by i) as run from starts),
runs as (select doc_id, run, min(i) as start, max(i) + {LEAST} as stop from marked group by doc_id, run),
gaps as (select doc_id, run, start, stop, lag(stop, 1, 0) over (partition by doc_id order by run) as since from runs),
cut as (
    select doc_id, sum(stop - start) as n_removed, count(*) as n_spans, max(stop) as last,
        string_agg(substr(h, 2 * since + 1, 2 * (start - since)), '' order by run) as kept
    from gaps join sized using (doc_id) group by doc_id
)
select doc_id, n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from sized left join cut using (doc_id)
"""
