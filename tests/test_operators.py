"""Numbering, joins under skew, upserts."""

import pytest
from pyspark.sql import functions as F

from quipu.functions.text import folded
from quipu.operators import folding, joins
from quipu.operators.numbering import first_writer, keep_best, number_rows
from quipu.operators.upsert import upsert


def test_numbering_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("g"), F.col("id").alias("v")
    )
    order = [F.desc("g"), F.asc("v")]
    got = number_rows(df, order, "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [(r.g, r.v) for r in got] == sorted(((r.g, r.v) for r in got), key=lambda t: (-t[0], t[1]))


def test_numbering_of_nothing_and_start(spark):
    empty = spark.range(0).withColumnRenamed("id", "v")
    assert number_rows(empty, [F.col("v")], "n").count() == 0
    got = number_rows(spark.range(3), [F.desc("id")], "n", start=F.lit(10)).orderBy("n").collect()
    assert [(r.id, r.n) for r in got] == [(2, 11), (1, 12), (0, 13)]


def test_numbering_puts_nulls_where_asked(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "v int")
    last = number_rows(df, [F.asc_nulls_last("v")], "n").orderBy("n").collect()
    first = number_rows(df, [F.desc_nulls_first("v")], "n").orderBy("n").collect()
    assert [r.v for r in last] == [0, 1, None] and [r.v for r in first] == [None, 1, 0]


def test_keep_best_limits_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    best = keep_best(df, ["k"], [F.desc("v")])
    assert {(r.k, r.v) for r in best.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = best._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], "the map side must cut to one row per key"


def test_first_writer_keeps_the_earliest_stream(spark, rows):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, y string")
    assert rows(first_writer([a, b], ["k"])) == [(1, "a", None), (2, None, "b")]


def hot_sides(spark):
    left = spark.range(60).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 20).alias("k"), F.col("id").alias("l")
    )
    right = spark.range(900).select(
        F.when(F.col("id") % 3 != 0, F.lit(5)).otherwise(F.col("id") % 30).alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("parts", [2, 8, 40])
def test_skew_join_equals_plain_join(spark, rows, how, parts):
    left, right = hot_sides(spark)
    hot = {r["_hot"]: r["_splits"] for r in joins.hot_keys(right, "k", parts).collect()}
    assert hot[5] == {2: 2, 8: 6, 40: 27}[parts] and (parts < 40) == (len(hot) == 1)
    got = joins.skew_join(left, right, "k", how, parts)
    assert rows(got) == rows(left.join(right, "k", how))


def test_skew_join_without_hot_keys(spark, rows):
    left, _ = hot_sides(spark)
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    assert rows(joins.skew_join(left, right, "k", "left", parts=4)) == rows(left.join(right, "k", "left"))


def test_hot_key_list_is_bounded(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert joins.hot_keys(df, "k", 32).count() == 0
    few = spark.range(10_000).select((F.col("id") % 20).alias("k"))
    assert joins.hot_keys(few, "k", 32).count() == 20


def test_keys_with_a_few_hundredths_of_the_rows_are_split(spark, rows):
    key = F.when(F.col("id") % 50 == 0, -1).when(F.col("id") % 100 == 1, -2).otherwise(F.col("id"))
    right = spark.range(10_000).select(key.alias("k"), F.col("id").alias("r"))
    assert {(r["_hot"], r["_splits"]) for r in joins.hot_keys(right, "k", 400).collect()} == {(-1, 8), (-2, 4)}
    left = spark.createDataFrame([(-1, 1), (-2, 2), (5, 3), (50, 4), (None, 5)], "k long, l int")
    assert rows(joins.skew_join(left, right, "k", "left", 400)) == rows(left.join(right, "k", "left"))


def test_null_keys_are_scattered(spark, rows):
    left, _ = hot_sides(spark)
    right = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    got = joins.left_join_unique(left, right, "k", ["l"])
    assert rows(got.select("k", "l", "r")) == rows(left.join(right, "k", "left").select("k", "l", "r"))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joins.left_join_unique(left, right, "k", ["l"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "_spread" in plan.split("hashpartitioning(")[1].split(")")[0]


def test_null_safe_join_meets_nulls(spark, rows):
    a = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "k int, v int")
    b = spark.createDataFrame([(None, 9), (1, 8)], "k int, w int")
    assert rows(joins.null_safe(a, b, ["k"], "inner")) == [(1, 2, 8), (None, 1, 9)]
    assert rows(joins.null_safe(a, b, ["k"], "left_anti")) == [(2, 3)]
    assert rows(joins.null_safe(a, a.filter("k = 1"), ["k"], "left_semi")) == [(1, 2)]


def test_lookup_leaves_the_broadcast_to_the_bytes(spark):
    from quipu.session import written

    fact = spark.range(100).withColumnRenamed("id", "f")
    dim = written(spark.range(50).withColumnRenamed("id", "d"), "dim")
    plan = lambda: joins.lookup(fact, dim, F.col("f") == F.col("d"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_upsert_keeps_surrogates(spark, rows):
    target = spark.createDataFrame([(1, 10, "a", 5), (2, 20, "b", 6)], "sk long, k int, x string, y int")
    source = spark.createDataFrame([(20, None, 7), (40, "d", 9), (30, "c", 8)], "k int, x string, y int")
    assert rows(upsert(target, source, ["k"], "sk")) == [
        (1, 10, "a", 5), (2, 20, None, 7), (3, 30, "c", 8), (4, 40, "d", 9),
    ]
    assert rows(upsert(target, source, ["k"], "sk", ["x"])) == [
        (1, 10, "a", 5), (2, 20, None, 6), (3, 30, "c", 8), (4, 40, "d", 9),
    ]
    again = upsert(upsert(target, source, ["k"], "sk"), source, ["k"], "sk")
    assert rows(again) == rows(upsert(target, source, ["k"], "sk"))


def test_upsert_takes_one_row_of_a_repeated_source_key(spark, rows):
    target = spark.createDataFrame([(1, 10, "a")], "sk long, k int, x string")
    source = spark.createDataFrame([(10, "old", 1), (10, "new", 2), (20, "z", 1), (20, "b", 2), (20, "b", 2)], "k int, x string, at int")
    assert rows(upsert(target, source, ["k"], "sk", last=[F.desc("at")])) == [(1, 10, "new"), (2, 20, "b")]
    assert rows(upsert(target, source, ["k"], "sk")) == [(1, 10, "old"), (2, 20, "z")]
    empty = target.limit(0)
    by = [F.col("x")]
    assert rows(upsert(empty, source, ["k"], "sk", last=[F.desc("at")], number_by=by)) == [(1, 20, "b"), (2, 10, "new")]


def test_distributed_numbering_after_upsert_start(spark):
    target = spark.createDataFrame([(7, 1)], "sk long, k long")
    source = spark.range(1, 50).withColumnRenamed("id", "k")
    got = {(r.k, r.sk) for r in upsert(target, source, ["k"], "sk").collect()}
    assert got == {(1, 7)} | {(k, k + 6) for k in range(2, 50)}


# equal in groups under the collation: accents, case, ligatures, ignorable signs, trailing blanks
TEXTS = [
    "É", "e", "E ", "\u0001", "", " ", "a\u0001b", "AB", "a\tb", "ß", "ss", "SS ", "ﬁ", "fi", "K", "k", "İ", "i", "ı", "a\n", "a", "a\r\n",
    "ａ", "١", "1", "½", "\U0001f4a9", "\u3000", "ñ", "N", "x-1", "X-1  ", " x-1", "x_1",
]


def test_texts_meet_as_under_the_collation(spark, rows):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    fold = texts.withColumn("f", folded(F.col("t")))
    heads = fold.groupBy("f").agg(F.min("t").alias("head"))
    assert rows(folding.canonical_texts(texts, "t", "head")) == rows(fold.join(heads, "f").select("t", "head"))
    other = texts.filter(F.length("t") < 2).withColumnRenamed("t", "u")
    want = fold.join(other.withColumn("f", folded(F.col("u"))), "f").select("t", "u")
    assert rows(folding.equal_texts(texts, "t", other, "u").select("t", "u")) == rows(want)


def test_collation_sees_each_text_once(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3000).select(F.element_at(F.array(*map(F.lit, ("É", "e", "b"))), (F.col("id") % 3 + 1).cast("int")).alias("t")).write.parquet(path)
    got = folding.canonical_texts(spark.read.parquet(path), "t", "head")
    assert rows(got) == [("É", "e"), ("e", "e"), ("b", "b")]
    assert not [f for f in got.inputFiles() if path in f]


def test_printable_texts_need_no_collation(spark):
    texts = spark.createDataFrame([("B",), ("b ",), ("x-1",)], "t string")
    plan = folding.canonical_texts(texts, "t", "head")._jdf.queryExecution().optimizedPlan().toString()
    assert "collat" not in plan.lower()
