"""Edge rows of the semantic rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quipu.functions import dates, numeric, rules, text
from quipu.functions.cells import CellRules, same_cell
from quipu.plans import kpis
from quipu.plans.staging import latest_sale_per_serie, stg_metas, stg_recepciones


def one(spark, *cols, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return tuple(df.select(*cols).first())


@pytest.mark.parametrize(
    "days, state, risk",
    [(91, "DISPONIBLE", True), (90, "DISPONIBLE", False), (200, "VENDIDO", False), (200, None, False), (None, "X", False)],
)
def test_risk_flag_with_unknowns(spark, days, state, risk):
    flag = rules.stock_at_risk(F.col("d"), F.col("s"))
    assert one(spark, flag, numeric.flag(flag), d=("int", days), s=("string", state)) == (risk, int(risk))


def test_staging_risk_reads_raw_days(spark):
    raw = spark.createDataFrame(
        [(1, 1, 1, dt.date(2024, 1, 1), "DISPONIBLE", None), (2, 1, 1, dt.date(2024, 1, 1), "DISPONIBLE", 120)],
        "recepcion_id long, oficina_id int, producto_id long, fecha_recepcion date, estado_recepcion string, dias_inactivo int",
    )
    got = {r.recepcion_id: (r.dias_inactivo, r.flag_riesgo_90d) for r in stg_recepciones(raw).collect()}
    assert got == {1: (0, False), 2: (120, True)}


def test_iso_week_keeps_calendar_year(spark):
    day = dt.date(2027, 1, 1)
    got = one(spark, *dates.calendar_columns(F.col("d")), d=("date", day))
    assert got == (20270101, day, 1, 53, 1, "January", 1, 2027)


def test_day_gap_can_be_negative(spark):
    gap = dates.day_gap(F.col("a"), F.col("b"))
    assert one(spark, gap, a=("date", dt.date(2024, 1, 1)), b=("date", dt.date(2024, 1, 5))) == (-4,)


@pytest.mark.parametrize("month, want", [(2, dt.date(2024, 2, 1)), (13, None), (0, None), (None, None)])
def test_month_start_of_bad_month_is_null(spark, month, want):
    raw = spark.createDataFrame([(1, 2024, month, 5)], "oficina_id int, anio int, mes_num int, meta_kits int")
    assert stg_metas(raw).first().fecha_mes == want


@pytest.mark.parametrize(
    "part, whole, want", [(1, 3, "33.33"), (2, 3, "66.67"), (1, 8, "12.50"), (1, 800, "0.13"), (1, 0, None), (3, None, None)]
)
def test_percent_rounds_half_up_and_guards_zero(spark, part, whole, want):
    got = one(spark, numeric.percent(F.col("a"), F.col("b")), a=("long", part), b=("long", whole))[0]
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize("part, whole, want", [(1, 2, 0.5), (1, 0, 0.0), (1, None, 0.0), (None, 2, 0.0)])
def test_divide_or_zero(spark, part, whole, want):
    assert one(spark, numeric.divide(F.col("a"), F.col("b")), a=("int", part), b=("int", whole)) == (want,)


@pytest.mark.parametrize("ratio, want", [(1.0, "Meta Cumplida"), (0.8, "En Riesgo"), (0.79, "Critico"), (0.0, "Critico")])
def test_goal_light(spark, ratio, want):
    assert one(spark, rules.goal_light(F.col("r")), r=("double", ratio)) == (want,)


@pytest.mark.parametrize("channel, want", [("DIRECTO", "220"), ("PDV", "160"), ("ONLINE", "99.50"), (None, "99.50")])
def test_channel_amount(spark, channel, want):
    got = one(spark, rules.channel_amount(F.col("c"), F.col("m")), c=("string", channel), m=("decimal(12,2)", Decimal("99.50")))
    assert got == (Decimal(want),)


def test_clean_serie_removes_every_blank(spark):
    assert one(spark, text.clean_serie(F.col("s")), s=("string", " ab\t1\r\n2 ")) == ("AB12",)
    assert one(spark, text.has_serie(F.col("s")), s=("string", " \t\r\n")) == (False,)
    assert one(spark, text.has_serie(F.col("s")), s=("string", None)) == (False,)


def test_first_other_character_only(spark):
    assert one(spark, text.letters_without_first_other(F.col("s")), s=("string", "pdv-1 x")) == ("PDV1 X",)


def test_folded_text_ignores_case_accent_and_trailing_blanks(spark):
    same = text.folded(F.col("a")) == text.folded(F.col("b"))
    assert one(spark, same, a=("string", "Jose "), b=("string", "JOSÉ")) == (True,)
    assert one(spark, same, a=("string", " Jose"), b=("string", "JOSÉ")) == (False,)


@pytest.mark.parametrize("cell, quoted", [(None, "NULL"), ("NULL", "_NULL"), ("_NULL", "__NULL"), ("NULLS", "NULLS"), ("", "")])
def test_null_quoting_round_trip(spark, cell, quoted):
    once = text.null_as_text(F.col("c"))
    assert one(spark, once, text.text_as_null(once), c=("string", cell)) == (quoted, cell)


def test_key_text_empties(spark):
    key = text.key_text(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, key, a=("string", None), b=("string", "undefined"), c=("string", "x")) == (" //  // x",)


@pytest.mark.parametrize(
    "a, b, rule, want",
    [
        (None, None, CellRules(), True),
        (None, "", CellRules(), False),
        (" A\t", "a", CellRules(ignore_whitespace=True, ignore_case=True), True),
        (" A", "A", CellRules(ignore_case=True), False),
        ("1.0", "1.004", CellRules(epsilon=0.01), True),
        ("1.0", "1.01", CellRules(epsilon=0.001), False),
        ("x", "x", CellRules(epsilon=0.01), True),
        (None, "1", CellRules(epsilon=5.0), False),
    ],
)
def test_same_cell(spark, a, b, rule, want):
    assert one(spark, same_cell(F.col("a"), F.col("b"), rule), a=("string", a), b=("string", b)) == (want,)


def test_zone_to_utc(spark):
    got = one(spark, dates.local_to_utc(F.col("t")), t=("timestamp_ntz", dt.datetime(2024, 5, 1, 20, 30)))
    assert got == (dt.datetime(2024, 5, 2, 1, 30),)


@pytest.mark.parametrize(
    "kpi, value, want",
    [
        ("tasa_activacion", 79.99, "bajo"),
        ("tasa_activacion", 80.0, "esperado"),
        ("tasa_activacion", 90.0, "alto"),
        ("contribucion", 15.0, "esperado"),
        ("contribucion", 15.01, "alto"),
        ("riesgo_pct", 15.0, "esperado"),
        ("riesgo_pct", 4.9, "alto"),
        ("dias_inactivo", 60.0, "esperado"),
        ("rotacion", 45.5, "bajo"),
        ("canal_unico", 90.01, "critico"),
        ("cumplimiento_meta", 100.0, "alto"),
        ("cumplimiento_meta", None, None),
    ],
)
def test_bands_at_their_limits(spark, kpi, value, want):
    assert one(spark, kpis.band(kpi, F.col("v")), v=("double", value)) == (want,)


def test_latest_sale_keeps_one_row_per_serie(spark):
    rows = [
        (1, "A", 5, "p-dv", dt.date(2024, 1, 1), 1, 1),
        (2, "A", None, "p-dv", dt.date(2024, 2, 1), 1, 1),
        (None, None, 7, "pdv", dt.date(2024, 2, 1), 1, 1),
    ]
    df = spark.createDataFrame(
        rows, "id_venta int, lote_serie string, monto int, canal string, fecha_venta date, id_oficina int, id_vendedor int"
    )
    got = sorted((r.id_venta, r.lote_serie, r.monto_venta, r.canal_venta) for r in latest_sale_per_serie(df).collect())
    assert got == [(0, "SIN_SERIE", 7, "PDV"), (2, "A", 0, "PDV")]
