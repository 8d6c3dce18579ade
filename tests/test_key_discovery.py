"""Keys found in the data, against all column sets."""

import itertools
import random

import pytest

from quipu.operators.compare import infer


def smallest_sets(tables, names, with_nulls):
    found = []
    for n in range(1, len(names) + 1):
        for s in itertools.combinations(range(len(names)), n):
            if any(set(f) <= set(s) for f in found):
                continue
            values = [[tuple(r[i] for i in s) for r in rows] for rows in tables]
            if all(len(set(v)) == len(v) and (with_nulls or not any(None in x for x in v)) for v in values):
                found.append(s)
    return [tuple(names[i] for i in s) for s in found]


@pytest.mark.parametrize("with_nulls", [False, True])
def test_smallest_keys_of_random_tables(spark, with_nulls):
    draw = random.Random(7)
    names = ["a", "b.c", "d", "e"]
    for _ in range(1):
        sizes = [draw.choice([3, 6, 12]) for _ in names]
        row = lambda: tuple(None if draw.random() < 0.004 else draw.randrange(n) for n in sizes)
        tables = [list({row(): 1 for _ in range(40)}) for _ in range(2)]
        frames = [spark.createDataFrame(t, ", ".join(f"`{c}` int" for c in names)) for t in tables]
        assert infer.minimal_keys(frames, with_nulls=with_nulls) == smallest_sets(tables, names, with_nulls)


def test_a_key_of_all_columns_and_no_key(spark):
    whole = list(itertools.product(range(2), repeat=4))
    names = [f"c{i}" for i in range(4)]
    df = spark.createDataFrame(whole, names)
    assert infer.minimal_keys([df]) == [tuple(names)]
    assert infer.minimal_keys([df.unionByName(df.limit(1))]) == []
    with pytest.raises(ValueError):
        infer.align_infer_keys(df.unionByName(df), df, "c0", "c0")
    assert infer.minimal_keys([df.limit(0)]) == [(n,) for n in names]


def test_null_is_no_empty_text(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a", "")], "x string, y string")
    assert infer.minimal_keys([df], with_nulls=True) == [("x", "y")] and infer.minimal_keys([df]) == []


def test_separators_inside_texts_link_nothing(spark):
    a = spark.createDataFrame([(1, "a // b", "c")], "id int, x string, y string")
    b = spark.createDataFrame([(2, "a", "b // c")], "id int, x string, y string")
    assert infer.align_infer_keys(a, b, "id", "id", [["x", "y"]]).isEmpty()
    empty = spark.createDataFrame([(3, "", None)], a.schema)
    assert infer.align_infer_keys(empty, empty, "id", "id", [["x"]]).isEmpty()
    assert infer.align_infer_keys(a, a, "id", "id").count() == 1


def test_top_columns_by_distinct_values(spark):
    df = spark.createDataFrame([(i, i % 3, i % 2, None, str(i), 1) for i in range(12)], "a int, b int, c int, d int, e string, f int")
    got = infer.top_columns(df, df.limit(6), df.columns).collect()
    assert [r.column for r in got] == ["a", "e", "b", "c", "d"]
