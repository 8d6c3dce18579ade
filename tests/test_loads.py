"""Formats, load modes, change-data apply."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quipu import session
from quipu.sources import files, ranged, sinks, versions
from quipu.sources.registry import Sources
from quipu.streaming import cdc, incremental

SCHEMA = "k int, s string, d date, m decimal(8,2)"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(
        [
            (1, 'say "hi", you', dt.date(2024, 1, 1), Decimal("1.50")),
            (2, " padded ", None, None),
            (3, None, dt.date(1999, 12, 31), Decimal("-2.00")),
            (4, "", dt.date(1999, 12, 31), Decimal("0.00")),
            (5, "a;b\tc", None, Decimal("7.00")),
            (6, "two\nlines", None, None),
            (7, "NULL", None, None),
            (8, "__NULL", None, None),
            (9, "x\U0001f4a9\"y\"\r\nz", None, None),
        ],
        SCHEMA,
    )


@pytest.mark.parametrize("ext", ["csv", "tsv", "ssv", "psv"])
def test_delimited_round_trip(spark, odd, rows, tmp_path, ext):
    path = str(tmp_path / ext)
    files.write_delimited(odd, path, ext)
    assert rows(files.read_delimited(spark, path, ext, SCHEMA)) == rows(odd)


def test_unquoted_null_is_missing(spark, rows, tmp_path):
    (tmp_path / "t.csv").write_text("k,s,d,m\n1,NULL,NULL,2.00\n")
    assert rows(files.read_delimited(spark, str(tmp_path / "t.csv"), "csv", SCHEMA)) == [(1, None, None, Decimal("2.00"))]


def test_convert_between_formats(spark, odd, rows, tmp_path):
    steps = [("csv", "ndjson"), ("ndjson", "tsv"), ("tsv", "parquet")]
    files.write_delimited(odd, str(tmp_path / "csv"), "csv")
    for src, dst in steps:
        files.convert(spark, str(tmp_path / src), src, str(tmp_path / dst), dst, SCHEMA)
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == rows(odd)


def test_ndjson_columns_are_the_union_of_keys(spark, rows, tmp_path):
    (tmp_path / "t.ndjson").write_text('{"a": 1}\n{"b": "x", "a": 2}\n')
    assert rows(files.read_ndjson(spark, str(tmp_path / "t.ndjson"))) == [(1, None), (2, "x")]


def test_json_tables(spark, rows, tmp_path):
    one = tmp_path / "one.json"
    one.write_text(json.dumps({"t": {"columns": ["a", "b"], "rows": [["1", "x"], ["2", None]]}}, indent=1))
    assert rows(files.read_json_table(spark, str(one), "t", ["b", "a"])) == [("x", "1"), (None, "2")]
    obj = tmp_path / "obj.json"
    obj.write_text(json.dumps({"t": {"columns": ["a"], "rows": [{"a": "1"}, {"a": None}]}}))
    assert rows(files.read_json_objects(spark, str(obj), "t", ["a"])) == [("1",), (None,)]
    many = tmp_path / "many.json"
    many.write_text(
        json.dumps({"names": ["t", "u"], "tables": {"t": {"columns": ["a"], "rows": [{"a": "1"}]}, "u": {"columns": ["b"], "rows": [{"b": "2"}]}}})
    )
    got = files.read_json_tables(spark, str(many), {"t": ["a"], "u": ["b"]})
    assert {n: rows(df) for n, df in got.items()} == {"t": [("1",)], "u": [("2",)]}


def test_json_table_chunks(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").cast("string").alias("a"))
    files.write_json_table(df, str(tmp_path / "t"), "t")
    assert spark.read.text(str(tmp_path / "t")).count() >= 3
    assert files.read_json_table(spark, str(tmp_path / "t"), "t", ["a"], multi_line=False).exceptAll(df).isEmpty()


def test_drop_blank(spark, rows):
    df = spark.createDataFrame([(1, "", None), (None, "", None), (None, None, "x")], "a int, b string, c string")
    assert rows(files.drop_blank(df)) == [(1, None), (None, "x")]
    assert files.drop_blank(df.select("b")).count() == 0


def test_schema_routing():
    assert sinks.resolve_schema(" marts ", "staging") == "marts"
    assert sinks.resolve_schema(None, "staging") == "staging"


def test_append_load_is_idempotent(spark, odd, tmp_path):
    for load in (1, 2, 1):
        got = sinks.append_load(odd, str(tmp_path / "t"), load)
    assert got.groupBy("load_id").count().collect() and got.count() == 2 * odd.count()


def test_conform_and_defaults(spark):
    df = spark.createDataFrame([(20240101, None, 5)], "dtiem_id long, ingresos_s double, venta_id int")
    typed = sinks.conform(df, "hecho_ventas").first()
    assert (typed.kits_vendidos, typed.ingresos_s, typed.dofic_id) == (1, None, None)
    assert sinks.fill_defaults(df, "hecho_ventas").first().ingresos_s == Decimal("0.00")
    assert dict(sinks.conform(df, "hecho_ventas").dtypes)["ingresos_s"] == "decimal(38,2)"


def test_wide_sums_and_keys_fit(spark):
    df = spark.createDataFrame([(3_000_000_000, Decimal("12345678901234.00"))], "dest_id long, ingresos_s decimal(20,2)")
    row = sinks.conform(df, "hecho_ventas").first()
    assert (row.dest_id, row.ingresos_s) == (3_000_000_000, Decimal("12345678901234.00"))


def test_recreate_leaves_empty_typed_tables(spark, tmp_path):
    made = sinks.recreate(spark, str(tmp_path), ["dim_oficina", "hecho_canal"])
    assert made["hecho_canal"].count() == 0 and "mix_canal_pct" in made["hecho_canal"].columns


def test_collated_columns_group_loosely(spark):
    df = spark.createDataFrame([("Jose",), ("JOSÉ ",), ("ana",)], "s string")
    assert sinks.collate_text(df).groupBy("s").count().count() == 2


def test_incremental_append_takes_only_newer_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    first = spark.createDataFrame([(1, day(1)), (2, day(2))], "k int, d date")
    later = spark.createDataFrame([(1, day(1)), (2, day(2)), (3, day(3))], "k int, d date")
    incremental.append_newer(spark, first, path, "d", ["k"], 0)
    incremental.append_newer(spark, later, path, "d", ["k"], 1)
    assert rows(incremental.append_newer(spark, later, path, "d", ["k"], 2)) == rows(later)


def test_incremental_append_takes_rows_that_share_the_cursor(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, d date"
    day = lambda n: dt.date(2024, 1, n)
    load = lambda data, n: incremental.append_newer(spark, spark.createDataFrame(data, schema), path, "d", ["k"], n)
    load([(1, day(1)), (9, None)], 0)
    load([(1, day(1)), (2, day(1)), (9, None), (8, None)], 1)
    full = [(1, day(1)), (2, day(1)), (3, day(2)), (8, None), (9, None)]
    assert rows(load(full, 2)) == full
    # the last load again, as after a failure: nothing doubles
    assert rows(load(full, 2)) == full


def test_incremental_append_of_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k int, d date")
    assert rows(incremental.append_newer(spark, empty, path, "d", ["k"], 0)) == []
    assert rows(incremental.append_newer(spark, spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k int, d date"), path, "d", ["k"], 1)) == [(1, dt.date(2024, 1, 1))]


def test_append_stream_loads_each_file_once(spark, rows, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    spark.range(3).coalesce(1).write.parquet(src)
    incremental.append_stream(spark, src, "id long", out, mark)
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(src)
    got = incremental.append_stream(spark, src, "id long", out, mark)
    assert rows(got) == [(0,), (1,), (2,), (3,), (4,)]


LOG = "op string, key int, seq long, v string"


def test_cdc_latest_image_wins_and_replay_changes_nothing(spark, rows):
    first = spark.createDataFrame([("I", 1, 1, "a"), ("U", 1, 3, "c"), ("U", 1, 2, "b"), ("I", 2, 4, "x")], LOG)
    second = spark.createDataFrame([("D", 2, 6, None), ("U", 1, 2, "late"), ("I", 3, 7, "n")], LOG)
    state = cdc.apply_changes(None, first, ["key"])
    state = cdc.apply_changes(state, second, ["key"])
    assert rows(cdc.live_rows(state)) == [(1, "c"), (3, "n")]
    again = cdc.apply_changes(cdc.apply_changes(state, second, ["key"]), first, ["key"])
    assert rows(cdc.live_rows(again)) == [(1, "c"), (3, "n")]
    revived = cdc.apply_changes(state, spark.createDataFrame([("I", 2, 9, "y")], LOG), ["key"])
    assert (2, "y") in rows(cdc.live_rows(revived))


def test_cdc_stream_over_arriving_files(spark, rows, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    batches = [
        [("I", 1, 1, "a"), ("I", 2, 2, "x")],
        [("U", 1, 5, "b"), ("D", 2, 6, None)],
        [("U", 1, 3, "late"), ("I", 3, 7, "n")],
    ]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(src)
        if n == 1:
            cdc.cdc_stream(spark, src, LOG, lambda df: df, ["key"], root, max_files=1)
    state = cdc.cdc_stream(spark, src, LOG, lambda df: df, ["key"], root, max_files=1)
    assert rows(cdc.live_rows(state)) == [(1, "b"), (3, "n")]
    small = cdc.compact_changes(spark, root, ["key"])
    assert rows(cdc.live_rows(small)) == [(1, "b"), (3, "n")]
    # what a compaction covers is not read again, and later batches are added to it
    spark.createDataFrame([("U", 3, 9, "m"), ("U", 1, 4, "late")], LOG).coalesce(1).write.mode("append").parquet(src)
    state = cdc.cdc_stream(spark, src, LOG, lambda df: df, ["key"], root)
    files_read = state.inputFiles()
    assert rows(cdc.live_rows(state)) == [(1, "b"), (3, "m")]
    last = cdc.last_manifest(spark, root).version
    assert {f.split("/runs/")[1].split("/")[0] for f in files_read} == {f"version={last - 1}", f"version={last}"}


def test_an_image_may_have_a_column_named_batch(spark, rows, tmp_path):
    log = "op string, key int, seq long, batch string"
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    spark.createDataFrame([("I", 1, 1, "kept")], log).write.parquet(src)
    assert rows(cdc.live_rows(cdc.cdc_stream(spark, src, log, lambda df: df, ["key"], root))) == [(1, "kept")]


def test_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_unknown_source(spark):
    with pytest.raises(KeyError):
        Sources(spark, "/nowhere").raw("pedidos")


def test_scratch_tables_can_be_dropped(spark):
    path = session.scratch_path(spark, "probe")
    spark.range(3).write.parquet(path)
    assert session.written(spark.range(3), "probe").count() == 3
    session.drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


# ---- levelled state and versions --------------------------------------------------------


def test_small_batches_read_little_of_the_state(spark, rows, tmp_path):
    """Whatever the number of batches before: only runs of touched ranges are read and written."""
    root, want = str(tmp_path / "state"), {}

    def batch(number, changes):
        for op, key, seq, x in changes:
            if seq > want.get(key, (0, 0))[0]:
                want[key] = (seq, None if op == "D" else x)
        return cdc.apply_batch(spark, root, spark.createDataFrame(changes, LOG), number, ["key"], fanout=3, ranges=40)

    batch(0, [("I", k, 1, "first") for k in range(2000)])
    assert len(cdc.last_manifest(spark, root).runs) >= 35
    for number in range(1, 7):
        keys = [number, number + 1, 1000 + number] if number % 2 else [number, 1500]
        work = batch(number, [("D" if k % 5 == 0 else "U", k, 10 * number + i, f"b{number}") for i, k in enumerate(keys)])
        live = cdc.last_manifest(spark, root)
        assert sum(r.rows for r in work.read) < sum(r.rows for r in live.runs) / 10
        assert {r.range for r in work.read} <= {r.range for r in work.written} and len({r.range for r in work.written}) <= len(keys)
    assert max(r.level for r in live.runs) >= 1
    expected = sorted((k, x) for k, (_, x) in want.items() if x is not None)
    assert sorted(map(tuple, cdc.live_rows(cdc.changes_state(spark, root, ["key"])).collect())) == expected
    again = cdc.apply_batch(spark, root, spark.createDataFrame([("U", 1, 999, "again")], LOG), 6, ["key"])
    assert again == cdc.Work()
    assert sorted(map(tuple, cdc.live_rows(cdc.compact_changes(spark, root, ["key"])).collect())) == expected
    runs = cdc.last_manifest(spark, root).runs
    assert len(runs) == len({r.range for r in runs})


def test_a_batch_that_dies_leaves_the_old_state(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "state")
    log = lambda *changes: spark.createDataFrame(list(changes), LOG)
    cdc.apply_batch(spark, root, log(("I", 1, 1, "a"), ("I", 2, 2, "b")), 0, ["key"], fanout=2, ranges=2)
    before = cdc.last_manifest(spark, root)
    write = cdc.write_manifest

    def dies(*args):
        raise RuntimeError("lost between two writes")

    monkeypatch.setattr(cdc, "write_manifest", dies)
    with pytest.raises(RuntimeError):
        cdc.apply_batch(spark, root, log(("U", 1, 3, "c"), ("D", 2, 4, "b")), 1, ["key"], fanout=2, ranges=2)
    assert cdc.last_manifest(spark, root) == before
    assert rows(cdc.live_rows(cdc.changes_state(spark, root, ["key"]))) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(cdc, "write_manifest", write)
    cdc.apply_batch(spark, root, log(("U", 1, 3, "c"), ("D", 2, 4, "b")), 1, ["key"], fanout=2, ranges=2)
    assert rows(cdc.live_rows(cdc.changes_state(spark, root, ["key"]))) == [(1, "c")]


def test_a_refresh_that_dies_leaves_the_old_table(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    sinks.as_table(spark.range(100).toDF("k"), path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).alias("k"))
    with pytest.raises(Exception, match="midway"):
        sinks.as_table(broken, path)
    assert versions.published(spark, path).count() == 100
    # a table may be rebuilt from itself, and old versions go
    for _ in range(3):
        sinks.as_table(versions.published(spark, path).filter("k % 2 = 0"), path)
    assert rows(versions.published(spark, path)) == [(k,) for k in range(0, 100, 2)]
    assert len(versions.numbered_folders(spark, path, "version")) == versions.KEPT_VERSIONS
    with pytest.raises(ValueError):
        versions.published(spark, str(tmp_path / "none"))


def test_an_upsert_rewrites_only_ranges_of_its_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    target = spark.range(1, 2501).select((F.col("id") * 2).alias("key"), F.lit("old").alias("x"), F.lit("kept").alias("y"), F.col("id").alias("sk"))
    ranged.store(target, root, ["key"], "sk", rows_per_range=50)
    before = ranged.parts(spark, root)
    assert len(before) >= 45 and sum(p.rows for p in before) == 2500
    changes = [(k, "new", None) for k in (20, 22, 24, 4000, 4001, 4003, 4999, 5001, -5, 20)]
    source = spark.createDataFrame(changes, "key long, x string, y string")
    made = ranged.upsert_ranges(spark, root, source, ["key"], "sk", ["x"])
    after = {p.range: p for p in ranged.parts(spark, root)}
    assert len(made) <= 5 and {p.folder for p in before} - {p.folder for p in after.values()} == {p.folder for p in before if p.range in {m.range for m in made}}
    want = {k: ("old", "kept", k // 2) for k in range(2, 5001, 2)} | {k: ("new", "kept", k // 2) for k in (20, 22, 24, 4000)}
    want |= {k: ("new", None, 2501 + i) for i, k in enumerate((-5, 4001, 4003, 4999, 5001))}
    assert {r.key: (r.x, r.y, r.sk) for r in ranged.read(spark, root).collect()} == want
    # the next one numbers after all ranges, also those it does not read
    ranged.upsert_ranges(spark, root, spark.createDataFrame([(-7, "z", "z")], source.schema), ["key"], "sk")
    assert ranged.read(spark, root).filter("key = -7").first().sk == 2506
    assert ranged.upsert_ranges(spark, root, source.limit(0), ["key"], "sk") == []
    with pytest.raises(ValueError):
        ranged.read(spark, str(tmp_path / "none"))


def test_a_stored_table_without_rows_takes_an_upsert(spark, tmp_path):
    root = str(tmp_path / "t")
    none = spark.createDataFrame([], "key long, x string, sk long")
    assert ranged.store(none, root, ["key"], "sk").count() == 0
    ranged.upsert_ranges(spark, root, spark.createDataFrame([(2, "b"), (1, "a"), (None, "n")], "key long, x string"), ["key"], "sk")
    assert sorted((r.key, r.sk) for r in ranged.read(spark, root).filter("key is not null").collect()) == [(1, 2), (2, 3)]


@pytest.mark.parametrize("ext", ["csv", "psv"])
def test_own_text_files_are_split_over_tasks(spark, rows, tmp_path, ext):
    cells = ["plain", "two\nlines", "a\r\nb", "back\\slash", "\\n", "\\\\n\n", "ends in \\", 'quo"ted, ', "", None, "NULL", "\n"]
    cell = F.element_at(F.array(*map(F.lit, cells)), (F.col("id") % len(cells) + 1).cast("int"))
    df = spark.range(20_000).select("id", F.lit("x" * 50).alias("pad"), cell.alias("s"))
    path = str(tmp_path / "t")
    files.write_delimited(df.coalesce(1), path, ext)
    size = sum(f.stat().st_size for f in (tmp_path / "t").iterdir() if f.name.startswith("part"))
    assert size > 1_200_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = files.read_delimited(spark, path, ext, "id long, pad string, s string")
        assert back.rdd.getNumPartitions() > 10
        assert back.exceptAll(df).isEmpty() and back.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
