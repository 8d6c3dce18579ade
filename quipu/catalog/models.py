"""Whole models of both marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..plans import deltas, layered, scripted
from ..plans.staging import STAGING
from ..session import scratch_path
from .registry import query

RAW4 = ("ventas", "recepciones", "activaciones", "productos")

_STAGING = {
    "ventas": "select venta_id, oficina_id, producto_id, vendedor_id, asesor_pdv_id, canal_venta, fecha_venta, recepcion_id, monto_original, monto_calculado from stg_ventas",
    "recepciones": "select * from stg_recepciones",
    "activaciones": "select * from stg_activaciones",
    "metas": "select * from stg_metas",
    "oficinas": "select * from oficinas",
    "productos": "select * from productos",
    "vendedores": "select * from stg_vendedores",
    "asesores": "select * from stg_asesores",
}
for _name, _sql in _STAGING.items():
    query(f"x1_stg_{_name}", _sql)(lambda m, n=_name: m.stg(n))

for _key, _model in (
    ("x2_dim_tiempo", "dim_tiempo"),
    ("x3_dim_oficina", "dim_oficina"),
    ("x3_dim_asesor_pdv", "dim_asesor_pdv"),
    ("x3_dim_estado", "dim_estado"),
    ("x4_fact_ventas", "fact_ventas"),
    ("x6_fact_inventario", "fact_inventario"),
    ("x7_fact_canal", "fact_canal"),
    ("x8_fact_desempeno", "fact_desempeno"),
    ("x9_fact_metas_pedidos", "fact_metas_pedidos"),
):
    query(_key, f"select * from {_model}")(lambda m, n=_model: getattr(m, n))


def scripted_dims(m):
    office = scripted.dim_oficina(scripted.empty_dim(m.spark, "dim_oficina"), m.raw("oficinas"))
    state = scripted.dim_estado(m.raw("recepciones"), m.raw("productos"))
    return office, state


@query("x5_hecho_ventas", "select * from hecho_ventas")
def hecho_ventas(m):
    m.land()
    office, state = scripted_dims(m)
    goods = scripted.with_status(m.raw("productos"), state)
    view = scripted.vw_ventas_enriched(*[m.raw(t) for t in RAW4[:3]], goods)
    return scripted.hecho_ventas(view, office, state, goods)


@query("x6_hecho_inventario", "select * from hecho_inventario")
def hecho_inventario(m):
    m.land()
    return scripted.hecho_inventario(m.raw("recepciones"), m.raw("productos"), m.raw("ventas"), *scripted_dims(m))


def scripted_office(m):
    return scripted.dim_oficina(scripted.empty_dim(m.spark, "dim_oficina"), m.raw("oficinas"))


@query("x7_hecho_canal", "select * from hecho_canal")
def hecho_canal(m):
    return scripted.hecho_canal(m.raw("ventas"), m.raw("activaciones"), scripted_office(m))


@query("x8_hecho_desempeno", "select * from hecho_desempeno")
def hecho_desempeno(m):
    m.land()
    sellers = scripted.dim_asesor_pdv(
        scripted.empty_dim(m.spark, "dim_asesor_pdv"), m.raw("vendedores"), m.raw("asesores")
    )
    return scripted.hecho_desempeno(
        m.raw("ventas"), m.raw("activaciones"), m.raw("metas"), scripted_office(m), sellers
    )


def corrected_sums(m) -> DataFrame:
    """Sums after three loads: two of new sales, the last deletes some and moves others to another channel."""
    root = scratch_path(m.land().spark, "sales-sums")
    raw, activations = m.raw("ventas"), m.stg("activaciones")
    sale = F.col("venta_id")
    touched = (sale % 17 == 0) | (sale % 23 == 0)
    moved = raw.filter((sale % 17 == 0) & (sale % 23 != 0)).withColumn("canal_venta", F.lit("PDV"))
    own = lambda rows, part: (STAGING["ventas"](rows), activations.filter(part))
    deltas.add_load(root, 0, own(raw.filter(sale % 3 == 0), sale % 3 == 0))
    deltas.add_load(root, 1, own(raw.filter(sale % 3 != 0), sale % 3 != 0))
    for _ in range(2):  # the corrections come twice and count once
        deltas.add_load(root, 2, own(moved, touched), removed=own(raw.filter(touched), touched))
    return deltas.stored_sums(m.spark, root)


@query("x7_canal_after_corrections", "select * from corr_fact_canal")
def canal_corrected(m):
    return layered.canal_of_months(deltas.channel_months(corrected_sums(m)), m.dim_tiempo, m.dim_oficina)


@query("x8_desempeno_after_corrections", "select * from corr_fact_desempeno")
def desempeno_corrected(m):
    months = deltas.seller_months(corrected_sums(m))
    return layered.desempeno_of_months(months, m.stg("metas"), m.dim_tiempo, m.dim_oficina, m.dim_asesor_pdv)


@query("x10_vw_enriched", "select * from vw_enriched")
def vw_enriched(m):
    return scripted.vw_ventas_enriched(*[m.land().raw(t) for t in RAW4])


@query("x11_vw_received", "select * from vw_received")
def vw_received(m):
    m.land()
    return scripted.vw_ventas_received(m.raw("ventas"), m.raw("recepciones"), m.raw("activaciones"))


@query("x12_scripted_dim_tiempo", "select * from a_dim_tiempo")
def scripted_dim_tiempo(m):
    m.land()
    return scripted.dim_tiempo(m.raw("ventas"), m.raw("recepciones"), m.raw("metas"))


@query("x12_scripted_dim_estado", "select * from a_dim_estado")
def scripted_dim_estado(m):
    return scripted.dim_estado(m.raw("recepciones"), m.raw("productos"))


@query("x12_scripted_dim_oficina", "select * from a_dim_oficina")
def scripted_dim_oficina(m):
    return scripted_office(m)


@query("x12_scripted_dim_asesor", "select * from a_dim_asesor")
def scripted_dim_asesor(m):
    """Two runs: the second only refreshes names and leaves every key as it was."""
    load = lambda target: scripted.dim_asesor_pdv(target, m.raw("vendedores"), m.raw("asesores"))
    return load(load(scripted.empty_dim(m.spark, "dim_asesor_pdv")))


@query("s2_mart_sizes", " union all ".join(f"select '{t}' as modelo, count(*) as filas from {t}" for t in ("dim_asesor_pdv", "dim_estado", "dim_oficina", "dim_tiempo")))
def mart_sizes(m):
    m.land()
    names = ("dim_asesor_pdv", "dim_estado", "dim_oficina", "dim_tiempo")
    return reduce(
        DataFrame.unionByName,
        [getattr(m, n).agg(F.count("*").alias("filas")).select(F.lit(n).alias("modelo"), "filas") for n in names],
    )


