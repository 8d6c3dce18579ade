"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from its code point. A letter
n-gram is bound into one vector: the letters' vectors, rotated by their place, multiplied
element by element. A text is the bundle (sum) of its n-grams' vectors, a language is the
bundle of its training texts, and a document gets the language whose prototype has the
largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

UNDETERMINED = "und"
GAP = 0  # stands for every run of characters that are no letters
CODE_BITS = 21  # a code point has at most 21 bits, so three fit a signed 64-bit number
NGRAMS_AT_ONCE = 40_000  # n-gram entries bundled together; bounds a task's memory, not the result


@dataclass(frozen=True)
class Profiles:
    """Prototypes of the learned languages: one row of `vectors` for each, of length 1."""

    languages: tuple[str, ...]
    vectors: np.ndarray = field(repr=False)
    dims: int
    seed: int


@lru_cache(1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(4096)
def letter_vector(code: int, dims: int, seed: int) -> np.ndarray:
    """The letter's random vector; it depends on nothing but the arguments."""
    bits = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dims, dtype=np.int8)
    return bits * 2 - 1


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct letter trigrams of the whole text as numbers, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_table()[codes]
    if not letters.any():
        return None
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # of a run of other characters only the first
    inner = np.where(letters, codes, GAP)[keep].astype(np.int64)
    symbols = np.concatenate(([GAP], inner, [GAP] if inner[-1] != GAP else []))
    symbols = symbols.astype(np.int64)
    grams = (symbols[:-2] << 2 * CODE_BITS) | (symbols[1:-1] << CODE_BITS) | symbols[2:]
    return np.unique(grams, return_counts=True)


def bound(grams: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Vectors of the given trigrams: rotated letter vectors, multiplied."""
    mask = (1 << CODE_BITS) - 1
    places = [(grams >> 2 * CODE_BITS) & mask, (grams >> CODE_BITS) & mask, grams & mask]
    letters, where = np.unique(np.concatenate(places), return_inverse=True)
    base = np.stack([letter_vector(int(x), dims, seed) for x in letters])
    out = np.roll(base, 2, axis=1)[where[: len(grams)]]
    out *= np.roll(base, 1, axis=1)[where[len(grams) : 2 * len(grams)]]
    out *= base[where[2 * len(grams) :]]
    return out


def bundle_counts(counts: dict[int, int], dims: int, seed: int) -> np.ndarray:
    """Sum of n-gram vectors times their counts, in whole numbers."""
    total = np.zeros(dims, np.int64)
    grams = np.fromiter(counts, np.int64, len(counts))
    times = np.fromiter(counts.values(), np.int64, len(counts))
    for i in range(0, len(grams), 8192):
        total += times[i : i + 8192] @ bound(grams[i : i + 8192], dims, seed).astype(np.int64)
    return total


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = 20_000,
    dims: int = 1024,
    seed: int = 8,
) -> Profiles:
    """Learn a prototype for every non-null label.

    Each language is learned from a sample of about `rows_per_language` rows, taken by a
    hash of `key` and length; a language with fewer rows is learned from all of them. Rows
    without a label, a text or a letter teach nothing. The driver gets the number of rows and
    one vector of `dims` numbers for each language.
    """
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).cast("string").alias("label"),
        F.col(text).alias("text"),
        F.col(key).cast("string").alias("key"),
    )
    # one number for each language; as literals they need no join that would gather a language's texts
    sizes = [x for r in rows.groupBy("label").count().collect() for x in (F.lit(r["label"]), F.lit(r["count"]))]
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce("key", F.lit("")), F.length("text")), 11) / float(1 << 53)
    share = F.element_at(F.create_map(*sizes), F.col("label")) if sizes else F.lit(0)
    sample = rows.filter(draw * share < rows_per_language).select("label", "text")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[int, int]] = {}
        sums: dict[str, np.ndarray] = {}

        def fold(label: str) -> None:
            own = counts.pop(label)
            sums[label] = sums.get(label, 0) + bundle_counts(own, dims, seed)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = trigrams(value)
                if found is None:
                    continue
                own = counts.setdefault(name, {})
                for gram, n in zip(found[0].tolist(), found[1].tolist()):
                    own[gram] = own.get(gram, 0) + n
                if len(own) > 100_000:
                    fold(name)
        for name in list(counts):
            fold(name)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dims), pa.array(range(dims), pa.int32()), pa.array(vector)],
                ["label", "place", "total"],
            )

    parts = sample.mapInArrow(partial, "label string, place int, total long")
    # one row for each language and place: languages x dims numbers
    sums = parts.groupBy("label", "place").agg(F.sum("total").alias("total")).collect()
    languages = tuple(sorted({r.label for r in sums}))
    at = {name: i for i, name in enumerate(languages)}
    vectors = np.zeros((len(languages), dims))
    for r in sums:
        vectors[at[r.label], r.place] = r.total
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(languages, (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32), dims, seed)


def best_language(profiles: Profiles) -> Column:
    """A function of a text column: struct of `lang_pred` and `score`."""

    @F.pandas_udf("lang_pred string, score double")
    def best(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            held: list[tuple[int, np.ndarray, np.ndarray]] = []

            def settle() -> None:
                if not held:
                    return
                grams = np.unique(np.concatenate([g for _, g, _ in held]))
                vectors = bound(grams, profiles.dims, profiles.seed).astype(np.float32)
                for row, own, n in held:
                    # sums of whole numbers, exact in 64 bits whatever the batch
                    total = np.zeros(profiles.dims)
                    for i in range(0, len(own), 4096):
                        total += n[i : i + 4096].astype(np.float32) @ vectors[np.searchsorted(grams, own[i : i + 4096])]
                    cosines = (profiles.vectors @ total) / max(float(np.linalg.norm(total)), 1e-9)
                    k = int(np.argmax(np.round(cosines, 9)))
                    names[row], scores[row] = profiles.languages[k], min(1.0, max(0.0, float(cosines[k])))
                held.clear()

            entries = 0
            for row, value in enumerate(texts):
                found = trigrams(value) if value and profiles.languages else None
                if found is None:
                    continue
                if entries + len(found[0]) > NGRAMS_AT_ONCE:
                    settle()
                    entries = 0
                held.append((row, *found))
                entries += len(found[0])
            settle()
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return best


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score` in one struct column, whose name is the last.

    The language with the largest cosine wins, of equal ones the first by name. A null
    text, one without a letter, and every text when nothing was learned get `und` and 0.
    Repeated rows get equal answers; other columns are left alone.
    """
    name = fresh(docs, "language")
    return docs.withColumn(name, best_language(profiles)(F.col(text)))


def keep_identified(docs: DataFrame, profiles: Profiles, least: float = 0.0, text: str = "text") -> DataFrame:
    """Rows whose language was determined with a score of at least `least`, columns unchanged."""
    found = identify(docs, profiles, text)
    made = found.columns[-1]
    return found.filter((F.col(f"{made}.lang_pred") != UNDETERMINED) & (F.col(f"{made}.score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])


def held_out(key: Column | str = "doc_id") -> Column:
    """A quarter of the documents, by the checksum of their id; never learned from."""
    return F.coalesce(F.crc32(F.col(key) if isinstance(key, str) else key) % 4 == 2, F.lit(False))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from the others."""
    ids = F.col("doc_id").cast("string")
    profiles = fit(docs.filter(~held_out(ids)))
    rows = docs.select("doc_id", held_out(ids).alias("held_out"), "text")
    found = identify(rows, profiles)
    made = found.columns[-1]
    return found.select("doc_id", "held_out", f"{made}.lang_pred", f"{made}.score")
