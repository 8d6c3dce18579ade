"""Keys that the data show, and alignment without given keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.cells import EXACT, CellRules, comparable
from ...functions.text import key_text
from ...session import written
from ..names import own

SKETCH_ERROR = 0.02  # relative standard deviation
SURE = 10  # deviations by which a sketch must miss to rule a column set out
SKETCHES_AT_ONCE = 200


def distinct_counts(a: DataFrame, b: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """One row per column: its distinct texts (NULL counts once) in `a` plus in `b`.

    Exact counts group (column, value) pairs, so every column shares one exchange and
    no column's values gather in one task; `exact=False` uses sketches instead.
    """
    def pairs(df: DataFrame, side: int) -> DataFrame:
        cells = F.array(
            *[
                F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                for i, c in enumerate(columns)
            ]
        )
        return df.select(F.lit(side).alias("side"), F.inline(cells))

    rows = pairs(a, 0).unionByName(pairs(b, 1))
    if exact:
        return rows.distinct().groupBy("at", "column").agg(F.count("*").alias("distinct_values"))
    text = F.coalesce(F.concat(F.lit("="), "v"), F.lit(""))
    per_side = rows.groupBy("at", "column", "side").agg(F.approx_count_distinct(text).alias("n"))
    return per_side.groupBy("at", "column").agg(F.sum("n").alias("distinct_values"))


def top_columns(a: DataFrame, b: DataFrame, columns: list[str], keep: int = 5) -> DataFrame:
    """The `keep` columns of the most distinct values, earlier columns first among equals."""
    counts = distinct_counts(a, b, columns)
    return counts.orderBy(F.desc("distinct_values"), "at").limit(keep).select("column", "distinct_values")


# ---- keys found in the data ---------------------------------------------------------------


def _hashes(columns: tuple[str, ...]) -> list[Column]:
    cells = [x for c in columns for x in (own(c), own(c).isNull())]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)]


def _estimates(df: DataFrame, sets: list[tuple[str, ...]]) -> list[int]:
    """About how many distinct values each column set has, one pass for many sets."""
    found = []
    for i in range(0, len(sets), SKETCHES_AT_ONCE):
        own_sets = sets[i : i + SKETCHES_AT_ONCE]
        found += df.agg(*[F.approx_count_distinct(_hashes(s)[0], SKETCH_ERROR).alias(f"s{k}") for k, s in enumerate(own_sets)]).first()
    return found


def _repeating(df: DataFrame, sets: list[tuple[str, ...]]) -> set[int]:
    """Which of the column sets hold some value twice: all sets in one exchange of 128-bit hashes."""
    values = F.array(*[F.struct(F.lit(k).alias("set"), *[h.alias(f"h{i}") for i, h in enumerate(_hashes(s))]) for k, s in enumerate(sets)])
    repeats = df.select(F.inline(values)).groupBy("set", "h0", "h1").agg(F.count("*").alias("n")).filter("n > 1")
    return {r["set"] for r in repeats.select("set").distinct().collect()}


def minimal_keys(tables: list[DataFrame], columns: list[str] | None = None, with_nulls: bool = False) -> list[tuple[str, ...]]:
    """All smallest column sets whose values are present and unique in every table, by size and place.

    Sets grow by a column a level. A set is looked at only if no smaller key lies in it. It is
    ruled out without a count where the product of the distinct values of its parts stays
    below the rows, and by a sketch of the level where that stays far below; sets that are
    left are counted exactly. Columns with a NULL are no part of a key unless `with_nulls`.
    Every column set may be a key, whatever its size.
    """
    columns = columns or [c for c in tables[0].columns if all(c in t.columns for t in tables)]
    sizes = []
    for t in tables:
        filled = t.agg(F.count("*").alias("all"), *[F.count(own(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        sizes.append(filled["all"])
        if not with_nulls:
            columns = [c for i, c in enumerate(columns) if filled[f"c{i}"] == filled["all"]]
    keys: list[tuple[str, ...]] = []
    distinct: dict[tuple[str, ...], list[float]] = {}  # of sets that are no keys, at most so many values in each table
    level: list[tuple[str, ...]] = [(c,) for c in columns]
    while level:
        open_sets = []
        for s in level:
            bound = [min((distinct[tuple(x for x in s if x != c)][t] * distinct[(c,)][t] for c in s), default=0) if len(s) > 1 else n for t, n in enumerate(sizes)]
            distinct[s] = bound
            if all(n <= most for n, most in zip(sizes, bound)):
                open_sets.append(s)
        for t, df in enumerate(tables):
            about = _estimates(df, open_sets) if open_sets else []
            for s, n in zip(open_sets, about):
                distinct[s][t] = min(distinct[s][t], n * (1 + SURE * SKETCH_ERROR))
            open_sets = [s for s, n in zip(open_sets, about) if n * (1 + SURE * SKETCH_ERROR) >= sizes[t]]
        for df in tables:
            again = _repeating(df, open_sets) if open_sets else set()
            open_sets = [s for k, s in enumerate(open_sets) if k not in again]
        keys += open_sets
        others = sorted((s for s in level if s not in set(open_sets)), key=lambda s: [columns.index(c) for c in s])
        known = set(others)
        level = [
            (*s, t[-1])
            for i, s in enumerate(others)
            for t in others[i + 1 :]
            if s[:-1] == t[:-1] and all(tuple(x for x in (*s, t[-1]) if x != c) in known for c in s)
        ]
    return keys


def key_frequency(df: DataFrame, columns: list[str], rules: CellRules = EXACT) -> DataFrame:
    """Rows per candidate key text."""
    return df.groupBy(_key(columns, rules).alias("key")).agg(F.count("*").alias("n"))


def _key(columns: list[str], rules: CellRules) -> Column:
    return key_text(*[comparable(own(c), rules) for c in columns])


def _link_key(columns: list[str], rules: CellRules) -> Column:
    """The cells themselves, so that no separator inside a text can mix them up; NULL where the key text is empty."""
    return F.when(_key(columns, rules) != "", F.array(*[key_text(comparable(own(c), rules)) for c in columns]))


def align_infer_keys(
    a: DataFrame,
    b: DataFrame,
    id_a: str,
    id_b: str,
    candidates: list[list[str]] | None = None,
    rules: CellRules = EXACT,
) -> DataFrame:
    """Links (id_a, id_b, subset) between rows of `a` and `b` by any of the candidate keys.

    Without candidates the keys are found: all smallest column sets, ids aside, that are
    unique and present in both tables, small ones first.

    A candidate links two rows whose key text is found once on each side and is not
    empty. All candidates are keyed and grouped together: one exchange. A row linked by
    several candidates keeps the link of the first one; a link whose other row is taken
    by an earlier candidate is left out. `id_a` and `id_b` name row ids.
    """
    if candidates is None:
        shared = [c for c in a.columns if c in b.columns and c not in (id_a, id_b)]
        candidates = [list(k) for k in minimal_keys([a, b], shared)]
    if not candidates:
        raise ValueError("no candidate key was given or found")

    def keyed(df: DataFrame, id: str, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(i).alias("turn"), _link_key(c, rules).alias("key")) for i, c in enumerate(candidates)])
        return df.select(own(id).alias(name), F.inline(keys))

    rows = keyed(a, id_a, "id_a").unionByName(keyed(b, id_b, "id_b"), allowMissingColumns=True).filter("key is not null")
    groups = rows.groupBy("turn", "key").agg(
        F.count("id_a").alias("n_a"), F.count("id_b").alias("n_b"), F.max("id_a").alias("id_a"), F.max("id_b").alias("id_b")
    )
    found = written(groups.filter("n_a = 1 and n_b = 1").select("turn", "id_a", "id_b"), "candidate-links")
    links = None
    for i, candidate in enumerate(candidates):  # as many steps as candidates were given
        mine = found.filter(F.col("turn") == i)
        if links is not None:
            mine = mine.join(links.select("id_a"), "id_a", "left_anti").join(links.select("id_b"), "id_b", "left_anti")
        mine = written(mine.select("id_a", "id_b", F.lit(",".join(candidate)).alias("subset")), "links")
        links = mine if links is None else links.unionByName(mine)
    return links
