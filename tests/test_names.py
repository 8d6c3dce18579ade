"""Operators over tables whose columns bear the names of helper columns: the same rows as under plain names."""

import pytest
from pyspark.sql import functions as F

from quipu.operators import joins, numbering
from quipu.operators.compare import order, patch, rows as rowdiff
from quipu.operators.names import own
from quipu.operators.upsert import upsert
from quipu.session import scratch_path
from quipu.sources import sinks
from quipu.streaming import cdc, incremental

DATA = [(1, 10, 5), (2, 20, 4), (3, None, 3), (4, 40, 2)]
OTHER = [(2, 20, 4), (3, 30, 3), (4, 41, 9), (5, 50, 1)]


def frames(spark, names):
    """Two versions of a table with key, value and place, and every other name as a column of constants."""
    key, value, place, *rest = names
    out = []
    for data in (DATA, OTHER):
        df = spark.createDataFrame(data, "k0 int, k1 int, k2 int").toDF(key, value, place)
        out.append(df.select("*", *[F.lit(f"c{i}").alias(c) for i, c in enumerate(rest)]))
    return out


def diffed(a, b, key, value, place):
    diff = rowdiff.row_diff(a, b, [key], ordered=place, keep_unchanged=True)
    return rowdiff.flat_cells(diff)


def patched(a, b, key, value, place):
    table, rejects = patch.apply_patch(a, rowdiff.row_diff(a, b, [key]), [key])
    assert rejects.isEmpty()
    return table


def summed(a, b, key, value, place):
    return rowdiff.diff_summary(a, b, [key], unique_keys=True).drop("different")


def upserted(a, b, key, value, place):
    free = next(f"s{i}" for i in range(9) if f"s{i}" not in a.columns)
    target = numbering.number_rows(a, [own(key)], free)
    return upsert(target, b, [key], free)


def stored_loads(a, b, key, value, place):
    path = scratch_path(a.sparkSession, "loads")
    for load in (1, 2):
        incremental.append_newer(a.sparkSession, a if load == 1 else b, path, key, [key], load)
    return incremental.append_newer(a.sparkSession, b, path, key, [key], 2)


def by_load(a, b, key, value, place):
    path = scratch_path(a.sparkSession, "loads")
    sinks.append_load(a, path, 1)
    got = sinks.append_load(b, path, 2)
    return got.withColumnRenamed(got.columns[-1], "the load")


def applied(a, b, key, value, place):
    log = lambda df, op, at: df.withColumn("op", F.lit(op)).withColumn("seq", F.lit(at))
    state = cdc.apply_changes(cdc.apply_changes(None, log(a, "I", 1), [key]), log(b, "U", 2), [key])
    return cdc.live_rows(state)


CASES = {
    "number_rows": lambda a, b, key, value, place: numbering.number_rows(a, [own(place)], "the number"),
    "keep_best": lambda a, b, key, value, place: numbering.keep_best(a.unionByName(b), [key], [own(place)]),
    "first_writer": lambda a, b, key, value, place: numbering.first_writer([a, b], [key]),
    "null_safe": lambda a, b, key, value, place: joins.null_safe(a, b.select(own(key), own(place)), [key, place], "left_anti"),
    "skew_join": lambda a, b, key, value, place: joins.skew_join(a, b.select(own(key)).unionByName(b.select(own(key))), key, parts=2),
    "row_diff": diffed,
    "diff_summary": summed,
    "equality_report": lambda a, b, *names: rowdiff.equality_report(a, b, [names[0]], rows_per_range=1),
    "apply_patch": patched,
    "upsert": upserted,
    "order_changed": lambda a, b, key, value, place: order.order_changed(a, key, place, 2, name="was moved"),
    "append_newer": stored_loads,
    "append_load": by_load,
    "apply_changes": applied,
}


#: names that the operator uses itself, or once did; the first three are key, value and place
NAMES = {
    "number_rows": "_at _part _before _n",
    "keep_best": "_rn _place _turn",
    "first_writer": "_turn _place _rn",
    "null_safe": "_r_k _r__r_k _side",
    "skew_join": "_hot _splits _salt _found _key _n",
    "row_diff": "l action _new _old r n_l _own _side side _repeats _copy _moved _slot _top _prior _inside _action",
    "diff_summary": "r l action side n_r _own changed",
    "equality_report": "_range _net _side node n h0 _range__starts",
    "apply_patch": "action l _change r cells _r_action _own",
    "upsert": "_new _place _at _part",
    "order_changed": "_slot _top _prior _inside movida",
    "append_newer": "load_id _load_id _r_load_id",
    "append_load": "_load_id load_id _x",
    "apply_changes": "_seq _deleted _turn _turn_of_batch _place",
}


@pytest.mark.parametrize("case", CASES)
def test_helper_names_are_the_callers(spark, case):
    names = NAMES[case].split()
    plain = [f"n{i}" for i in range(len(names))]
    want = CASES[case](*frames(spark, plain), *plain[:3])
    got = CASES[case](*frames(spark, names), *names[:3])
    lines = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    assert lines(got) == lines(want) and len(set(got.columns)) == len(got.columns) == len(want.columns)
