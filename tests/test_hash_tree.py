"""Range hash trees: equal and unlike tables, stored and not, against counts of whole rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quipu.operators.compare import hash_tree, rows as rowdiff
from quipu.operators.compare.hash_tree import HashedTable
from quipu.session import scratch_path

SCHEMA = "k long, x string, y double"


def counted(df):
    return Counter(repr(tuple(0.0 if v == 0 else v for v in r)) for r in df.collect())


def random_rows(seed, n=400):
    draw = random.Random(seed)
    cell = lambda: draw.choice([None, "", "a", "b"])
    return [(draw.choice([None, 1, draw.randrange(200)]), cell(), draw.choice([None, 0.0, -0.0, 1.5, float("nan")])) for _ in range(n)]


@pytest.mark.parametrize("rows_per_range", [20, 1_000_000])
def test_netted_rows_are_those_of_whole_tables(spark, rows_per_range):
    left = random_rows(0)
    right = left[:380] + left[:3] + random_rows(9, 5)
    a, b = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (left, right))
    one, two = counted(a), counted(b)
    got = rowdiff.equality_report(a, b, rows_per_range=rows_per_range).first()
    assert (got.solo_a, got.solo_b, got.iguales) == ((one - two).total(), (two - one).total(), False)
    assert rowdiff.equality_report(a, a.repartition(5), rows_per_range=rows_per_range).first().iguales
    first = HashedTable.store(a, scratch_path(spark, "t"), ["k"], rows_per_range=rows_per_range)
    second = HashedTable.store(b, scratch_path(spark, "t"), ["k"], like=first)
    stored = rowdiff.equality_report(first, HashedTable.open(spark, second.path)).first()
    assert stored == got
    assert counted(second.rows()) == two


def test_null_is_told_from_its_place_and_from_values(spark):
    a = spark.createDataFrame([(1, "a", None, None)], "k int, x string, y string, z string")
    for other in [(1, None, "a", None), (1, "a", "", None), (1, "a", None, "null")]:
        b = spark.createDataFrame([other], a.schema)
        assert not rowdiff.tables_equal(a, b)
    twice = a.unionByName(a)
    assert not rowdiff.tables_equal(a, twice) and rowdiff.tables_equal(twice, twice)


def test_other_types_and_columns(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, `a.b` string")
    b = spark.createDataFrame([("x", 1), (None, 2)], "`a.b` string, k long")
    assert rowdiff.equality_report(a, b).first().iguales
    assert not rowdiff.tables_equal(a, b) and not rowdiff.tables_equal(a, a.withColumnRenamed("k", "q"))
    none = a.limit(0)
    assert rowdiff.tables_equal(none, none)
    assert rowdiff.equality_report(none, a).first().solo_b == 2


def test_equal_tables_shuffle_sums_only(spark, monkeypatch):
    seen = []
    find = hash_tree.unlike_nodes
    monkeypatch.setattr(hash_tree, "unlike_nodes", lambda a, b: seen.extend([a, b]) or find(a, b))
    a = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("x"))
    pair = hash_tree.unlike_rows(a, a.repartition(7), ["id"], rows_per_range=500)
    assert all(df.isEmpty() for df in pair)
    for sums in seen:
        plan = sums._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 1 and plan.count("HashAggregate") == 2
        assert sums.count() == 40


def test_one_changed_row_reads_one_range(spark):
    a = spark.range(20_000).select("id", F.lit("same").alias("x"))
    first = HashedTable.store(a, scratch_path(spark, "t"), ["id"], rows_per_range=500)
    assert len(first.rows().inputFiles()) >= 30
    changed = a.withColumn("x", F.when(F.col("id") == 7777, "other").otherwise(F.col("x")))
    second = HashedTable.store(changed, scratch_path(spark, "t"), ["id"], like=first)
    assert first.unlike(first) == [] and len(first.unlike(second)) == 1
    for side in first.unlike_rows(second):
        folders = {f.rsplit("/", 2)[1] for f in side.inputFiles()}
        assert len(folders) == 1 and side.count() < 1500
    got = rowdiff.diff_many({"t": first}, {"t": second}, {"t": ["id"]}).collect()
    assert [(r.action, r.rows) for r in got] == [("->", 1)]


def test_nodes_add_up_to_the_root(spark, monkeypatch):
    monkeypatch.setattr(hash_tree, "FANOUT", 6)
    table = HashedTable.store(spark.range(3000).toDF("k"), scratch_path(spark, "t"), ["k"], rows_per_range=100)
    sums = [tuple(table.level(i).agg(*[F.sum(s) for s in hash_tree.SUMS]).first()) for i in range(hash_tree.LEVELS)]
    assert sums[0] == sums[1] == sums[2] and sums[0][0] == 3000
    assert [table.level(i).count() for i in (0, 1)] == [1, 5] and table.level(2).count() == 30


def test_tables_of_other_ranges_are_refused(spark):
    a = spark.range(100).toDF("k")
    one = HashedTable.store(a, scratch_path(spark, "t"), ["k"], rows_per_range=10)
    two = HashedTable.store(a, scratch_path(spark, "t"), ["k"], rows_per_range=50)
    with pytest.raises(ValueError):
        one.unlike(two)


def test_many_tables_with_and_without_ranges(spark):
    draw = random.Random(4)
    make = lambda: spark.createDataFrame([(i, draw.choice("ab"), None) for i in range(300) if draw.random() < 0.97], SCHEMA)
    a, b = make(), make()
    want = {r.action: r["count"] for r in rowdiff.row_diff(a, b, ["k"]).groupBy("action").count().collect()}
    for size in (10, 1000):
        got = rowdiff.diff_many({"t": a, "old": a}, {"t": b, "new": b}, {"t": ["k"], "old": ["k"], "new": ["k"]}, rows_per_range=size).collect()
        assert {r.action: r.rows for r in got if r.table_name == "t"} == want
        assert {(r.table_name, r.state, r.action): r.rows for r in got if r.table_name != "t"} == {("old", "dropped", "---"): a.count(), ("new", "added", "+++"): b.count()}
