"""Comparison, merge and patch: algebra, truth tables and odd cells."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quipu.functions.cells import CellRules
from quipu.operators.compare import columns as cols
from quipu.operators.compare import infer, patch, rows as rowdiff, textform, three_way
from quipu.operators.compare.order import order_changed, with_context

SCHEMA = "k int, x string, y int"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def pair(spark):
    a = table(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3), (None, "n", 4), (5, "", 5)])
    b = table(spark, [(1, "a", 1), (2, "B", 2), (3, "", 3), (None, "m", 4), (6, "f", None)])
    return a, b


def test_diff_of_itself_is_empty(pair):
    a, _ = pair
    assert rowdiff.row_diff(a, a, ["k"]).isEmpty()


def test_diff_actions(pair, rows):
    got = rowdiff.row_diff(*pair, ["k"]).select("k", "action")
    assert rows(got) == [(2, "->"), (3, "->"), (5, "---"), (6, "+++"), (None, "->")]


def test_patch_turns_one_into_the_other(pair, rows):
    a, b = pair
    table_, rejects = patch.apply_patch(a, rowdiff.row_diff(a, b, ["k"]), ["k"])
    assert rows(table_) == rows(b) and rejects.isEmpty()


def test_random_patches(spark, rows):
    draw = random.Random(5)
    for _ in range(3):
        make = lambda: [(k, draw.choice(["p", "q", None, ""]), draw.randint(0, 2)) for k in range(40) if draw.random() < 0.7]
        a, b = table(spark, make()), table(spark, make())
        assert rows(patch.apply_patch(a, rowdiff.row_diff(a, b, ["k"]), ["k"])[0]) == rows(b)


def test_repeated_keys_link_nothing(spark, rows):
    a = table(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)])
    b = table(spark, [(1, "a", 1), (2, "c", 3), (2, "c", 4)])
    got = rowdiff.row_diff(a, b, ["k"]).select("k", "action", F.coalesce("y.before", "y.after").alias("y"))
    assert rows(got) == [
        (1, "+++", 1), (1, "---", 1), (1, "---", 2), (2, "+++", 3), (2, "+++", 4), (2, "---", 3),
    ]


def test_link_unique_needs_one_row_per_side(spark, rows):
    a = table(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3), (3, "d", 4)])
    b = table(spark, [(1, "a", 1), (2, "c", 5), (4, "e", 6)])
    assert rows(rowdiff.link_unique(a, b, ["k"]).select("k", "l.y", "r.y")) == [(2, 3, 5)]


def test_loose_cells_and_ignored_columns(spark):
    a = table(spark, [(1, " Ab ", 1)])
    b = table(spark, [(1, "aB", 2)])
    loose = CellRules(ignore_whitespace=True, ignore_case=True, ignore_columns=("y",))
    assert rowdiff.row_diff(a, b, ["k"], loose).isEmpty()
    assert rowdiff.row_diff(a, b, ["k"], CellRules(epsilon=5.0)).count() == 1


def test_type_change_compares_text(spark):
    a = table(spark, [(1, "7", 7)])
    b = spark.createDataFrame([(1, "7", 7)], "k int, x string, y long")
    assert rowdiff.row_diff(a, b, ["k"]).isEmpty()


def test_summary_and_equality(pair):
    a, b = pair
    got = rowdiff.diff_summary(a, b, ["k"]).first()
    assert (got.row_inserts, got.row_deletes, got.row_updates, got.col_updates, got.different) == (1, 1, 3, 1, True)
    assert (got.row_count_initial, got.row_count_final) == (5, 5)
    assert rowdiff.diff_summary(a, a, ["k"]).first().different is False
    assert rowdiff.tables_equal(a, a.repartition(3)) and not rowdiff.tables_equal(a, b)
    assert not rowdiff.tables_equal(a, a.unionByName(a.limit(1)))
    assert not rowdiff.tables_equal(a, a.select("x", "k", "y"))


def test_schema_changes(spark):
    a = spark.createDataFrame([], "k int, x string, y int, old int")
    b = spark.createDataFrame([], "x string, k int, y long, fresh string, renamed int")
    codes = {c: code for code, c, _, _ in cols.schema_diff(a, b, {"old": "renamed"})}
    assert codes == {"x": ":", "k": ":", "y": "type", "fresh": "+++", "renamed": "(old)"}
    assert cols.type_diff(a, b, ["k"], ["x"]) == [("k", "key", "true", "false"), ("x", "key", "false", "true"), ("y", "type", "int", "bigint")]
    assert cols.same_columns(a, a) and not cols.same_columns(a, b)


def test_alter_columns_in_one_step(spark):
    df = spark.createDataFrame([(1, "a", 2)], SCHEMA)
    got = cols.alter_columns(df, [("y", "y2", {"type": "bigint"}), ("k", "k", {}), (None, "z", {"type": "date"}), ("x", None, {})])
    assert got.dtypes == [("y2", "bigint"), ("k", "int"), ("z", "date")] and tuple(got.first()) == (2, 1, None)


# ---- three-way ----------------------------------------------------------------------


def merged(p, l, r):
    """Presence and cell rules on plain values; None means the row is absent."""
    if p is not None:
        if l is None or r is None:
            return None, False
        if r == p:
            return l, False
        if l == p:
            return r, False
        return l, l != r
    return (l if l is not None else r), False


@pytest.fixture
def versions(spark):
    cases = list(itertools.product([None, 1, 2, 3], repeat=3))
    side = lambda i: spark.createDataFrame([(n, str(c[i]), c[i]) for n, c in enumerate(cases) if c[i] is not None], SCHEMA)
    return cases, side(0), side(1), side(2)


def test_merge_truth_table(versions):
    cases, p, l, r = versions
    table_, conflicts, rejects = three_way.merge3(p, l, r, ["k"])
    want = {n: merged(*c)[0] for n, c in enumerate(cases) if merged(*c)[0] is not None}
    assert {row.k: row.y for row in table_.collect()} == want
    clashes = {(n, col) for n, c in enumerate(cases) if merged(*c)[1] for col in ("x", "y")}
    assert {(row.k, row["column"]) for row in conflicts.collect()} == clashes
    assert rejects.count() == 0


def test_repeated_keys_are_rejects(spark):
    """Rows of a repeated key are neither merged nor lost."""
    p = spark.createDataFrame([(1, "a", 1), (3, "c", 1), (None, "n", 1)], SCHEMA)
    l = spark.createDataFrame([(1, "a", 2), (2, "b", 20), (2, "b", 21), (3, "c", 5), (3, "c", 6), (None, "n", 1), (None, "n", 1)], SCHEMA)
    r = spark.createDataFrame([(1, "a", 1), (4, "d", 1), (4, "d", 2), (5, "e", 1)], SCHEMA)
    table_, _, rejects = three_way.merge3(p, l, r, ["k"])
    assert {(row.k, row.y) for row in table_.collect()} == {(1, 2), (5, 1)}
    got = sorted((row.k or 0, row.side, row[row.side].y) for row in rejects.collect())
    assert got == [(0, "l", 1), (0, "l", 1), (0, "p", 1), (2, "l", 20), (2, "l", 21), (3, "l", 5), (3, "l", 6), (3, "p", 1), (4, "r", 1), (4, "r", 2)]
    diff, rejects = three_way.diff3(p, l, r, ["k"])
    assert {(row.k, row.action) for row in diff.collect()} == {(5, "+++")} and rejects.count() == len(got)


def test_repeated_keys_link_nothing(spark, rows):
    a = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "x", 2), (2, "b", 1), (None, "n", 1), (3, "c", 1)], SCHEMA)
    b = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 1), (None, "m", 1), (4, "d", 1)], SCHEMA)
    got = rowdiff.align_by_key(a, b, ["k"]).select("k", "l.y", "r.y", "l.x", "r.x")
    want = [(1, 1, None, "a", None)] * 2 + [(1, 2, None, "x", None), (1, None, 1, None, "a"), (2, 1, 2, "b", "b"), (None, 1, None, "n", None)]
    want += [(None, None, 1, None, "n"), (None, None, 1, None, "m"), (3, 1, None, "c", None), (4, None, 1, None, "d")]
    assert rows(got) == want
    with pytest.raises(Exception, match="declared unique"):
        rowdiff.row_diff(a, b, ["k"], unique_keys=True).collect()
    plan = rowdiff.align_by_key(a, b, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") + plan.count("SortAggregate") <= 2, "full rows are grouped once"


def test_moved_rows(spark):
    a = spark.createDataFrame([(k, str(k), k) for k in range(8)], "k int, x string, place int")
    b = spark.createDataFrame([(k, "edited" if k == 6 else str(k), p) for p, k in enumerate([0, 2, 3, 1, 6, 5, 9, 7])], "k int, x string, place int")
    got = {r.k: r.action for r in rowdiff.row_diff(a, b, ["k"], unique_keys=True, ordered="place").collect()}
    assert got == moved_by_brute_force()


def moved_by_brute_force():
    """Rows whose new place lies above that of a row that came earlier."""
    new = {k: p for p, k in enumerate([0, 2, 3, 1, 6, 5, 9, 7])}
    both = [k for k in range(8) if k in new]
    moved = {k for i, k in enumerate(both) if any(new[j] > new[k] for j in both[:i])}
    return {k: ":" for k in moved - {6}} | {4: "---", 6: "->", 9: "+++"}


def test_merge_conflict_text(versions):
    cases, p, l, r = versions
    table_, _, _ = three_way.merge3(p, l, r, ["k"], conflict_text=True)
    n = cases.index((1, 2, 3))
    assert table_.filter(F.col("k") == n).first().y == "((( 1 ))) 2 /// 3"


def test_diff3_truth_table(versions):
    cases, p, l, r = versions

    def action(pv, lv, rv):
        if pv is None and lv is None:
            return "+++" if rv is not None else ""
        if pv is not None and lv is not None and rv is None:
            return "---"
        if rv is None:
            return ""
        if pv is None:
            return "->" if lv != rv else ""
        if rv == pv:
            return ""
        return "->" if lv in (pv, rv) else "!->"

    want = {n: action(*c) for n, c in enumerate(cases) if action(*c)}
    assert {row.k: row.action for row in three_way.diff3(p, l, r, ["k"])[0].collect()} == want


def test_merge_identities(pair, rows):
    a, b = pair
    a, b = a.filter("k is not null"), b.filter("k is not null")
    assert rows(three_way.merge3(a, b, a, ["k"])[0]) == rows(b)
    assert rows(three_way.merge3(a, a, b, ["k"])[0]) == rows(b)


def test_merge_columns(spark, rows):
    p = spark.createDataFrame([(1, "a", 1)], "k int, x string, y int")
    l = spark.createDataFrame([(1, "a", 5), (2, "l", 2)], "k int, x string, mine int")
    r = spark.createDataFrame([(1, "b", 1, 9), (3, "r", 3, 8)], "k int, x string, y int, theirs int")
    table_, _, _ = three_way.merge3(p, l, r, ["k"])
    assert table_.columns == ["k", "x", "mine", "theirs"]
    assert rows(table_) == [(1, "b", 5, 9), (2, "l", 2, None), (3, "r", None, 8)]


def test_patch_leaves_conflicting_cells(versions):
    cases, p, l, r = versions
    diff, _ = three_way.diff3(p, l, r, ["k"])
    diff = diff.withColumn("action", F.when(F.col("action") == "!->", "->").otherwise(F.col("action")))
    table_, _ = patch.apply_patch(l, diff, ["k"])
    assert table_.filter(F.col("k") == cases.index((1, 2, 3))).first().y == 2


# ---- patches --------------------------------------------------------------------------


def test_unmatched_changes_are_rejected(pair, rows):
    a, b = pair
    diff = rowdiff.row_diff(a, b, ["k"])
    _, rejects = patch.apply_patch(a.filter("k in (1, 2)"), diff, ["k"])
    assert rows(rejects.select("k", "action")) == [(3, "->"), (5, "---"), (None, "->")]


def test_patches_never_multiply_rows(spark, rows):
    source = table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (None, "n", 4)])
    target = table(spark, [(1, "a", 10), (2, "b", 20), (4, "d", 4), (None, "n", 5)])
    diff = rowdiff.row_diff(source, target, ["k"])
    twice = diff.unionByName(diff.filter("k = 1 or k is null or k = 4"))
    table_, rejects = patch.apply_patch(source, twice, ["k"])
    assert rows(table_) == [(1, "a", 1), (2, "b", 20), (None, "n", 4)]
    assert rows(rejects.select("k", "action")) == [(k, a) for k, a in ((1, "->"), (4, "+++"), (None, "->")) for _ in range(2)]
    # the inserted key is there already
    table_, rejects = patch.apply_patch(target, diff, ["k"])
    assert rows(rejects.select("k", "action")) == [(3, "---"), (4, "+++")] and table_.count() == 4


def test_patches_in_any_order_and_chained(spark, rows):
    draw = random.Random(8)
    for _ in range(2):
        make = lambda: [(k, draw.choice("pq"), draw.randint(0, 2)) for k in range(30) if draw.random() < 0.6]
        a, b, c = (table(spark, make()) for _ in range(3))
        first, second = rowdiff.row_diff(a, b, ["k"]), rowdiff.row_diff(b, c, ["k"])
        middle, none = patch.apply_patch(a, first.repartition(3), ["k"])
        end, rejected = patch.apply_patch(middle, second, ["k"])
        assert rows(end) == rows(c) and none.isEmpty() and rejected.isEmpty()
        again, rejected = patch.apply_patch(b, first, ["k"])
        # applied again, inserts and deletes find nothing to do, and no row is doubled
        assert rows(again) == rows(b) and {r.action for r in rejected.collect()} <= {"+++", "---"}


def test_row_changes_match_null_conditions(spark, rows):
    target = table(spark, [(1, "a", 1), (2, None, 2), (3, "c", 3)])
    changes = spark.createDataFrame(
        [("---", None, None), ("->", "a", 9), ("+", "c", None), ("+++", None, 4)], "action string, cond_x string, val_y int"
    )
    got, rejects = patch.apply_row_changes(target, changes, ["x"], ["y"])
    assert rows(got) == [(1, "a", 9), (3, "c", 3), (None, None, 4)] and rejects.isEmpty()


def test_row_changes_that_are_unclear_are_rejected(spark, rows):
    target = table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4), (5, None, 5), (5, "f", 5)])
    kind = "action string, conds array<string>, cond_k int, cond_x string, vals array<string>, val_k int, val_y int, note string"
    changes = [
        ("->", ["k"], 1, "zz", ["y"], None, 11, "only the key counts"),
        ("->", ["k", "x"], 2, "b", ["y"], None, 22, "both count"),
        ("---", ["x"], None, "b", None, None, None, "meets a row of the one above"),
        ("->", ["x", "k"], 3, "c", ["y"], None, None, "sets NULL"),
        ("->", ["x"], None, "d", ["y"], None, 44, "twice"),
        ("---", ["x"], 9, "d", None, None, None, "twice, the key does not count"),
        ("->", ["k", "x"], 5, None, ["y"], None, 55, "NULL is asked for"),
        ("->", ["k"], 77, None, ["y"], None, 1, "meets none"),
        ("---", [], 4, None, None, None, None, "asks nothing"),
        ("+++", None, None, None, ["k", "y"], 6, 6, "new"),
        ("+++", None, None, None, ["k"], 1, 8, "is there"),
        ("+++", None, None, None, ["k"], 8, 8, "repeats"),
        ("+++", None, None, None, ["k"], 8, 9, "repeats too"),
    ]
    got, rejects = patch.apply_row_changes(target, spark.createDataFrame(changes, kind), ["k", "x"], ["k", "y"], keys=["k"])
    assert rows(got) == [(1, "a", 11), (2, "b", 2), (3, "c", None), (4, "d", 4), (5, None, 55), (5, "f", 5), (6, None, 6)]
    assert rows(rejects.select("note")) == [
        ("both count",), ("meets a row of the one above",), ("twice",), ("twice, the key does not count",),
        ("meets none",), ("asks nothing",), ("is there",), ("repeats",), ("repeats too",),
    ]
    assert rejects.columns == spark.createDataFrame(changes, kind).columns
    none = spark.createDataFrame([], kind)
    got, rejects = patch.apply_row_changes(target, none, ["k", "x"], ["k", "y"], keys=["k"])
    assert rows(got) == rows(target) and rejects.isEmpty()


# ---- text form --------------------------------------------------------------------------


def test_separator_outgrows_the_data(spark):
    df = spark.createDataFrame([(1, "x-->y!", 1)], SCHEMA)
    assert textform.separators(df) == ("--->", "-!--->")
    assert textform.separators(table(spark, [(1, "a", 1)])) == ("->", "!->")
    assert textform.separators(df.withColumnRenamed("x", "a---->b")) == ("----->", "-!----->")


def test_text_round_trip(spark, rows):
    a = table(spark, [(1, "a", 1), (2, None, 2), (3, "NULL", 3), (4, "d", 4), (5, "e->f", 5)])
    b = table(spark, [(1, "b", 1), (2, "x", 2), (3, None, 3), (5, "g", 5), (6, "z", 6)])
    change, conflict = textform.separators(a, b)
    shown = textform.as_text(rowdiff.row_diff(a, b, ["k"]), ["k"], change, conflict)
    assert change == "-->"
    assert rows(shown.select("k", "action", "x")) == [
        (1, "-->", "a-->b"), (2, "-->", "NULL-->x"), (3, "-->", "_NULL-->NULL"),
        (4, "---", "d"), (5, "-->", "e->f-->g"), (6, "+++", "z"),
    ]
    parsed = textform.parse_change_text(shown, "action", ["x"], ["k"]).select("k", "category", "old_value", "new_value")
    assert rows(parsed) == [
        (1, "modify", "a", "b"), (2, "modify", None, "x"), (3, "modify", "NULL", None),
        (4, "remove", "d", None), (5, "modify", "e->f", "g"), (6, "add", None, "z"),
    ]


def test_markers_are_told_apart(spark):
    df = spark.createDataFrame([("@@", "k"), ("...", "..."), ("!", "+++"), (":", "v"), ("", "w")], "code string, c string")
    got = textform.parse_change_text(df, "code", ["c"], ["code"]).collect()
    assert {r.code: r.category for r in got} == {"@@": "header", "...": "gap", "!": "spec", ":": "move", "": ""}


# ---- order and inferred keys ---------------------------------------------------------------


@pytest.mark.parametrize("bucket", [3, 7, 1000])
def test_order_changed_against_brute_force(spark, bucket):
    draw = random.Random(bucket)
    new = list(range(40))
    draw.shuffle(new)
    df = spark.createDataFrame(list(enumerate(new)), "o long, n long")
    got = {r.o: r.movida for r in order_changed(df, "o", "n", bucket_rows=bucket).collect()}
    assert got == {i: any(m > n for m in new[:i]) for i, n in enumerate(new)}


@pytest.mark.parametrize("around", [0, 1, 2])
def test_context_against_brute_force(spark, around):
    changed = {3, 4, 11, 19}
    df = spark.range(1, 26).select((F.col("id") * 10).alias("o"), F.col("id").isin(*changed).alias("c"))
    got = {r.posicion: r.papel for r in with_context(df, [F.col("o")], F.col("c"), around).collect()}
    assert got == {r.posicion: r.papel for r in with_context(df, [F.col("o")], F.col("c"), around, bucket_rows=3).collect()}
    near = {p for p in range(1, 26) if any(abs(p - c) <= around for c in changed)}
    want = {p: "cambio" if p in changed else "contexto" for p in near}
    want |= {p: "..." for p in range(1, 26) if p not in near and (p + 1 in near or p == 25)}
    assert got == want


def brute_links(a, b, candidates):
    """Rows as dicts with an id; the candidates in turn, row by row."""
    def key(row, subset):
        return " // ".join("" if row[c] in (None, "", "null", "undefined") else str(row[c]) for c in subset)

    links, used_b = {}, set()
    for subset in candidates:
        at_a, at_b = {}, {}
        for rows_, at in ((a, at_a), (b, at_b)):
            for r in rows_:
                at.setdefault(key(r, subset), []).append(r["id"])
        pairs = [(ids[0], at_b[text][0]) for text, ids in at_a.items() if text and len(ids) == 1 and len(at_b.get(text, [])) == 1]
        pairs = [(x, y) for x, y in pairs if x not in links and y not in used_b]
        links |= dict(pairs)
        used_b |= {y for _, y in pairs}
    return links


@pytest.mark.parametrize("seed, width", [(1, 2), (2, 3), (3, 7)])
def test_inferred_keys_against_brute_force(spark, seed, width):
    draw = random.Random(seed)
    names = [f"c{i}" for i in range(width)]
    make = lambda n: [
        {"id": i, **{c: draw.choice([None, "", *map(str, range(4 + 14 * j))]) for j, c in enumerate(names)}} for i in range(n)
    ]
    a = make(30)
    b = [dict(r, id=100 + r["id"]) for r in a if draw.random() < 0.8] + [dict(r, id=200 + r["id"]) for r in make(6)]
    for r in b:
        if draw.random() < 0.3:
            r[draw.choice(names)] = "edited"
    schema = "id int, " + ", ".join(f"{c} string" for c in names)
    frame = lambda data: spark.createDataFrame([tuple(r.values()) for r in data], schema)
    candidates = [[names[-1]], names[:2], names, names[1:]]
    got = infer.align_infer_keys(frame(a), frame(b), "id", "id", candidates)
    assert {r.id_a: r.id_b for r in got.collect()} == brute_links(a, b, candidates)
