"""Both marts on small hand-made raw tables, read through the stored layout."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quipu.plans import deltas, histograms, kpis, layered, measures, quality, scripted
from quipu.plans.mart import Mart
from quipu.sources import versions
from quipu.sources.schemas import RAW_SCHEMAS

D = dt.date
RAW = {
    "oficinas": [(1, "Puno", "D1", "SUR", "Z1"), (2, "Lima", "D2", "CENTRO", "Z2")],
    "productos": [
        (10, " ab\t1 ", "kit", Decimal("1"), True),
        (11, "AB2", "kit", Decimal("1"), True),
        (12, None, "kit", Decimal("1"), True),
        (13, " \n", "kit", Decimal("1"), True),
        (14, "AB1", "kit", Decimal("1"), True),
    ],
    "vendedores": [(100, "Ana")],
    "asesores": [(100, "Beto"), (101, "Cira")],
    "ventas": [
        (1, 1, 10, 100, None, "DIRECTO", D(2024, 1, 1), 1, Decimal("50")),
        (2, 1, 11, None, 100, "PDV", D(2024, 1, 15), 2, Decimal("50")),
        (3, 2, 11, None, None, "ONLINE", D(2024, 2, 1), None, Decimal("80.50")),
        (4, 9, 12, None, 999, "PDV", D(2027, 1, 1), 2, Decimal("50")),
    ],
    "recepciones": [
        (1, 1, 10, D(2024, 1, 10), "VENDIDO", 100),
        (2, 1, 11, D(2023, 9, 1), "DISPONIBLE", 120),
        (3, 2, 14, D(2023, 9, 2), "EN_TRANSITO", 5),
        (4, 2, 14, D(2023, 9, 3), "VENDIDO", 5),
        (5, 2, 13, D(2023, 9, 3), None, 200),
    ],
    "activaciones": [
        (1, 1, D(2024, 1, 2), True),
        (2, 1, D(2024, 1, 3), False),
        (3, 2, D(2024, 1, 16), True),
        (4, 3, D(2024, 2, 2), None),
    ],
    "metas": [(1, 2024, 1, 2), (1, 2024, 1, 4), (2, 2024, 2, 0), (2, 2024, 13, 7)],
}


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    for name, data in RAW.items():
        spark.createDataFrame(data, RAW_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return Mart(spark, root, "stored")


def test_time_dimension_skips_the_bad_goal_month(mart):
    keys = {r.dtiem_id for r in mart.dim_tiempo.collect()}
    assert keys == {20240101, 20240115, 20240201, 20270101, 20240110, 20230901, 20230902, 20230903}


def test_status_dimension_keeps_the_least_idle_cleaned_series(mart, rows):
    got = rows(mart.dim_estado.select("dest_id", "estado", "dias_desde_recepcion", "flag_riesgo_90d", "lote_serie"))
    # AB1 comes from ' ab 1 ' (100 days) and AB1 (5 days, two states: the later name wins)
    assert got == [(1, "DISPONIBLE", 120, True, "AB2"), (2, "VENDIDO", 5, False, "AB1")]


def test_sales_fact_repeats_per_activation_and_misses_dirty_series(mart, rows):
    got = rows(mart.fact_ventas.select("venta_id", "dofic_id", "dest_id", "kits_activos", "ingresos_s"))
    assert got == [
        (1, 1, None, 0, Decimal("220.00")),
        (1, 1, None, 1, Decimal("220.00")),
        (2, 1, 1, 1, Decimal("160.00")),
        (3, 2, 1, 0, Decimal("80.50")),
        (4, None, None, 0, Decimal("160.00")),
    ]
    # 600 of 840.50 in office 1; the unknown office takes part in the total
    shares = {r.venta_id: r.contribucion_pct for r in mart.fact_ventas.collect()}
    assert shares == {1: Decimal("71.39"), 2: Decimal("71.39"), 3: Decimal("9.58"), 4: Decimal("19.04")}


def test_sales_fact_options(mart, rows):
    args = [mart.stg(t) for t in ("ventas", "activaciones", "productos")] + [mart.dim_tiempo, mart.dim_oficina, mart.dim_estado]
    once = layered.fact_ventas(*args, dedupe=True)
    assert rows(once.select("venta_id", "kits_activos")) == [(1, 1), (2, 1), (3, 0), (4, 0)]
    clean = layered.fact_ventas(*args, normalize_serie=True)
    assert {r.dest_id for r in clean.filter("venta_id = 1").collect()} == {2}


def test_inventory_fact(mart, rows):
    got = rows(mart.fact_inventario.select("dtiem_id", "serie", "dias_inactivo", "kits_riesgo_90d", "rotation_lote"))
    assert got == [
        (20230901, "AB2", 120, 1, 136), (20230901, "AB2", 120, 1, 1218),
        (20230902, "AB1", 5, 0, None), (20230903, " \n", 200, 0, None), (20230903, "AB1", 5, 0, None),
        (20240110, " ab\t1 ", 100, 0, -9),
    ]


def test_channel_fact(mart, rows):
    got = rows(mart.fact_canal.select("dtiem_id", "dofic_id", "kits_canal_directo", "kits_canal_pdv", "ingresos_directo", "mix_canal_pct"))
    assert got == [
        (20240101, 1, 2, 1, Decimal("440.00"), Decimal("33.33")),
        (20240201, 2, 0, 0, Decimal("0.00"), Decimal("0.00")),
        (20270101, None, 0, 1, Decimal("0.00"), Decimal("100.00")),
    ]


def test_performance_fact_repeats_per_goal(mart, rows):
    got = rows(mart.fact_desempeno.select("dtiem_id", "dases_id", "kits_por_asesor", "meta_kits_mes", "cumplimiento_meta_pct", "kits_inactivos_pct"))
    assert got == [
        (20240101, 1, 2, 2, Decimal("50.00"), Decimal("50.00")), (20240101, 1, 2, 4, Decimal("25.00"), Decimal("50.00")),
        (20240101, 2, 1, 2, Decimal("50.00"), Decimal("0.00")), (20240101, 2, 1, 4, Decimal("25.00"), Decimal("0.00")),
        (20240201, None, 1, 0, None, Decimal("100.00")), (20270101, None, 1, 0, None, Decimal("100.00")),
    ]


def test_scripted_performance_sums_the_goals(mart, rows):
    office = scripted.dim_oficina(scripted.empty_dim(mart.spark, "dim_oficina"), mart.raw("oficinas"))
    seller = scripted.dim_asesor_pdv(
        scripted.empty_dim(mart.spark, "dim_asesor_pdv"), mart.raw("vendedores"), mart.raw("asesores")
    )
    got = scripted.hecho_desempeno(mart.raw("ventas"), mart.raw("activaciones"), mart.raw("metas"), office, seller)
    assert rows(got.select("dtiem_id", "dases_id", "kits_por_asesor", "meta_kits_mes")) == [
        (20240101, 1, 2, 6), (20240101, 2, 1, 6), (20240201, None, 1, 0),
    ]


def test_scripted_sales_repeat_per_status_row(mart, rows):
    raw = [mart.raw(t) for t in ("ventas", "recepciones", "activaciones", "productos")]
    office = scripted.dim_oficina(scripted.empty_dim(mart.spark, "dim_oficina"), mart.raw("oficinas"))
    state = scripted.dim_estado(mart.raw("recepciones"), mart.raw("productos"))
    got = scripted.hecho_ventas(scripted.vw_ventas_enriched(*raw), office, state, mart.raw("productos"))
    # sale 4 has no known office; the series of sale 1 is ' ab 1 ', which only its own receipt has
    assert rows(got.groupBy("venta_id").agg(F.count("*"), F.max("contribucion_pct"))) == [
        (1, 2, Decimal("88.17")), (2, 1, Decimal("88.17")), (3, 1, Decimal("11.83")),
    ]


def test_status_by_product_gives_the_status_by_series(spark, mart, rows):
    view = [mart.raw(t) for t in ("ventas", "recepciones", "activaciones")]
    office = scripted.dim_oficina(scripted.empty_dim(mart.spark, "dim_oficina"), mart.raw("oficinas"))
    states = [(1, "VENDIDO", 1, 0, "ab2"), (2, "VENDIDO", 2, 0, " AB\t1"), (3, "VENDIDO", 3, 0, "AB2 "), (4, "VENDIDO", 4, 0, None)]
    state = spark.createDataFrame(states, scripted.MART_SCHEMAS["dim_estado"])
    more = [(11, "ab2 ", "kit", None, True), (12, "unknown", "kit", None, True), (None, "AB2", "kit", None, True)]
    products = mart.raw("productos").unionByName(spark.createDataFrame(more, RAW_SCHEMAS["productos"]))
    goods = scripted.with_status(products, state)
    want = scripted.hecho_ventas(scripted.vw_ventas_enriched(*view, products), office, state, products)
    got = scripted.hecho_ventas(scripted.vw_ventas_enriched(*view, goods), office, state, goods)
    assert rows(got) == rows(want) and got.schema == want.schema
    assert {(r.dest_id, r.n_estados) for r in got.collect()} == {(1, 2), (2, 1)}
    sold = [scripted.hecho_inventario(mart.raw("recepciones"), p, mart.raw("ventas"), office, state) for p in (products, goods)]
    assert rows(sold[0]) == rows(sold[1])
    assert {(r.serie, r.dest_id, r.n_estados) for r in sold[0].collect()} == {
        (" ab\t1 ", 2, 1), ("AB2", 1, 2), ("ab2 ", 1, 2), ("AB1", None, 0), (" \n", None, 0),
    }


def test_blank_series_meet_under_the_collation(spark, rows):
    states = spark.createDataFrame([(1, "ab1"), (2, "  "), (3, " "), (4, None)], "dest_id int, lote_serie string")
    sales = spark.createDataFrame([(1, "AB1  "), (2, ""), (3, None)], "v int, s string")
    got = rows(scripted.join_status(sales, states, "s", ["v"]).select("v", "dest_id", "n_estados"))
    assert got == [(1, 1, 1), (2, 2, 2), (3, None, 0)]


def test_view_forms(mart, rows):
    raw = lambda *names: [mart.raw(n) for n in names]
    full = scripted.vw_ventas_enriched(*raw("ventas", "recepciones", "activaciones", "productos"))
    assert rows(full.select("venta_id", "dias_lead_time", "flag_riesgo_90d")) == [
        (1, -9, 0), (1, -9, 0), (2, 136, 1), (3, None, 0), (4, 1218, 1),
    ]
    part = scripted.vw_ventas_received(*raw("ventas", "recepciones", "activaciones"))
    assert rows(part.select("venta_id", "es_riesgo").distinct()) == [(1, 0), (2, 1), (4, 1)]


def test_measures_keep_the_facts_apart(mart):
    sales = measures.with_attributes(
        measures.sales_cube(mart.stg("ventas"), mart.stg("activaciones")), "fecha_venta", mart.stg("oficinas")
    )
    goals = measures.with_attributes(
        measures.goals_table(mart.stg("recepciones"), mart.stg("metas")), "fecha_mes", mart.stg("oficinas")
    )
    names = ["total_pedidos", "total_vendidos", "stock_actual", "tasa_activacion", "brecha_meta", "semaforo", "ticket_promedio"]
    got = {r.oficina_id: tuple(r)[1:] for r in measures.measure(sales, goals, names, ["oficina_id"]).collect()}
    assert got[1] == (2, 3, -1, 2 / 3, 4, "Critico", 200.0)
    assert got[2] == (3, 1, 2, 0.0, 7, "Critico", 80.5)
    assert got[9] == (0, 1, -1, 0.0, 0, "Critico", 160.0)
    whole = measures.measure(sales, goals, ["total_vendidos", "meta"], []).first()
    assert tuple(whole) == (5, 13)
    only = measures.measure(sales, None, ["ventas_pdv"], ["region"], F.col("region") == "SUR").collect()
    assert [tuple(r) for r in only] == [("SUR", 1)]


def test_risk_counts_by_day(mart, rows):
    got = kpis.kits_at_risk(mart.raw("recepciones"), D(2023, 12, 31), ["oficina_id"])
    assert rows(got) == [(1, 1, 2, Decimal("50.00")), (2, 1, 3, Decimal("33.33"))]


def test_checks_count_failures(mart):
    models = {n: getattr(mart, n) for n in ("fact_ventas", "fact_inventario", "dim_oficina")}
    got = {(r.model, r.test, r["column"]): r.failures for r in quality.run_checks(models).collect()}
    assert got == {
        ("fact_ventas", "unique", "venta_id"): 1,
        ("fact_ventas", "not_null", "venta_id"): 0,
        ("fact_ventas", "not_null", "dtiem_id"): 0,
        ("fact_ventas", "not_null", "dofic_id"): 1,
        ("fact_ventas", "not_null", "dest_id"): 3,
        ("fact_inventario", "not_null", "serie"): 0,
        ("dim_oficina", "unique", "dofic_id"): 0,
        ("dim_oficina", "not_null", "dofic_id"): 0,
        ("dim_oficina", "not_null", "oficina_id"): 0,
    }


def test_orphans_and_reconciliation(mart, rows):
    lost = quality.orphans(mart.raw("ventas"), "oficina_id", mart.raw("oficinas"), "oficina_id")
    assert [r.venta_id for r in lost.collect()] == [4]
    both = quality.reconcile_amounts(mart.raw("ventas"), mart.raw("ventas").filter("venta_id <> 3"), ["oficina_id"], "monto_venta")
    assert {r.oficina_id for r in both.filter("not cuadra").collect()} == {2}
    counts = quality.reconcile_counts({"v": (mart.raw("ventas"), mart.raw("ventas").limit(3))}).first()
    assert (counts.origen, counts.destino, counts.cuadra) == (4, 3, False)


# ---- facts from deltas ------------------------------------------------------------------

SALE = "venta_id long, oficina_id int, vendedor_id long, asesor_pdv_id long, canal_venta string, fecha_venta date, monto_calculado decimal(12,2)"
ACTIVATION = "activacion_id long, venta_id long, fecha_activacion date, flag_activo int"


def test_loads_and_corrections_add_up_to_a_rebuild(spark, rows, tmp_path):
    """Sales come, change and go, with their activations; any cut into loads gives the facts of the rest."""
    draw, root = random.Random(6), str(tmp_path / "sums")
    held, acts = {}, {}

    def sale(k):
        channel = draw.choice(["DIRECTO", "PDV", "ONLINE", None])
        return (k, draw.choice([1, 2, None]), draw.choice([7, None]), None, channel, dt.date(2024, draw.choice([1, 2]), draw.randrange(1, 28)), Decimal(draw.randrange(500)))

    def frames(keys):
        keys = sorted(keys)
        return spark.createDataFrame([held[k] for k in keys], SALE), spark.createDataFrame([a for k in keys for a in acts[k]], ACTIVATION)

    for load in range(4):
        old = [k for k in held if draw.random() < 0.4]
        gone = [k for k in old if draw.random() < 0.5]
        removed = frames(old) if old else None
        for k in gone:
            del held[k], acts[k]
        changed = [k for k in old if k not in gone] + list(range(100 * load, 100 * load + 15))
        for k in changed:
            held[k] = sale(k)
            acts[k] = [(10 * k + i, k, dt.date(2024, 3, 1), draw.randrange(2)) for i in range(draw.choice([0, 1, 1, 3]))]
        new = frames(changed)
        for _ in range(draw.choice([1, 2])):
            deltas.add_load(root, load, new, removed)
        if load == 1:
            deltas.fold(spark, root)
            assert versions.numbered_folders(spark, f"{root}/loads", "load") == []
    sums = deltas.stored_sums(spark, root)
    whole = frames(held)
    for made, rebuilt in ((deltas.channel_months(sums), layered.channel_months(*whole)), (deltas.seller_months(sums), layered.seller_months(*whole))):
        assert rows(made.select(*rebuilt.columns)) == rows(rebuilt) and made.schema[-1].dataType == rebuilt.schema[-1].dataType
    # all gone: no group stays behind
    deltas.add_load(root, 4, tuple(df.limit(0) for df in whole), whole)
    assert deltas.stored_sums(spark, root).isEmpty()


def test_histograms_of_loads_give_means_and_quantiles_of_all_rows(spark):
    draw = random.Random(2)
    data = [(draw.choice("ab"), draw.choice(["x", "y"]), draw.choice([None, draw.randrange(-5, 200)]), draw.randrange(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, h string, d int, w long")
    parts = [histograms.day_histogram(df.filter(p), [F.col("g"), F.col("h")], F.col("d"), F.col("w")) for p in ("d % 2 = 0", "d % 2 <> 0", "d is null")]
    got = {(r.g, r.h): r for r in histograms.day_drill(histograms.added(parts), ["g", "h"]).collect()}
    for g, h in [(None, None), ("a", None), ("b", "x")]:
        days = sorted(d for a, b, d, w in data for _ in range(w) if d is not None and g in (None, a) and h in (None, b))
        at = lambda q: days[int(i := q * (len(days) - 1))] + (i - int(i)) * (days[min(int(i) + 1, len(days) - 1)] - days[int(i)])
        r = got[g, h]
        assert (r.kits, r.nivel) == (len(days), 2 - [g, h].count(None))
        assert (r.dias_promedio, r.dias_mediana, r.dias_p90) == pytest.approx((sum(days) / len(days), at(0.5), at(0.9)))
