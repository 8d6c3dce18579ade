"""Declared schemas of the raw tables and of the typed mart, as DDL text."""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "ventas": "venta_id long, oficina_id int, producto_id long, vendedor_id long, "
    "asesor_pdv_id long, canal_venta string, fecha_venta date, recepcion_id long, "
    "monto_venta decimal(12,2)",
    "recepciones": "recepcion_id long, oficina_id int, producto_id long, "
    "fecha_recepcion date, estado_recepcion string, dias_inactivo int",
    "productos": "producto_id long, serie string, descripcion string, "
    "precio_base decimal(10,2), activo boolean",
    "oficinas": "oficina_id int, nom_oficina string, departamento string, "
    "region string, zona string",
    "vendedores": "vendedor_id long, nom_vendedor string",
    "asesores": "asesor_pdv_id long, nom_asesor_pdv string",
    "activaciones": "activacion_id long, venta_id long, fecha_activacion date, "
    "flag_activo boolean",
    "metas": "oficina_id int, anio int, mes_num int, meta_kits int",
}

RAW_KEYS = {
    "ventas": "venta_id",
    "recepciones": "recepcion_id",
    "productos": "producto_id",
    "oficinas": "oficina_id",
    "vendedores": "vendedor_id",
    "asesores": "asesor_pdv_id",
    "activaciones": "activacion_id",
}

# fixed values: column names of the scripted mart, with types wide enough for any sum or key, and the value a missing cell takes
MART_SCHEMAS: dict[str, str] = {
    "dim_tiempo": "dtiem_id int, fecha date, dia int, semana int, mes int, "
    "nombre_mes string, trimestre int, anio int, fecha_recepcion date, fecha_venta date",
    "dim_oficina": "dofic_id long, oficina_id int, nom_oficina string, "
    "departamento string, region string, zona string",
    "dim_estado": "dest_id long, estado string, dias_desde_recepcion int, "
    "flag_riesgo_90d int, lote_serie string",
    "dim_asesor_pdv": "dases_id long, origen_id long, nom_cliente_pdv string, "
    "tipo_canal string, monto_asociado decimal(10,2)",
    "hecho_ventas": "hventas_key long, dtiem_id int, dofic_id long, dest_id long, n_estados long, "
    "kits_vendidos int, kits_activos int, tasa_activacion_pct decimal(5,2), "
    "ingresos_s decimal(38,2), contribucion_pct decimal(5,2), venta_id long, "
    "serie string, canal_venta string",
    "hecho_inventario": "hinventario_key long, dtiem_id int, dofic_id long, dest_id long, n_estados long, "
    "dias_inactivo int, kits_riesgo_90d int, rotation_lote decimal(8,2), serie string",
    "hecho_canal": "hcanal_key long, dtiem_id int, dofic_id long, kits_canal_directo long, "
    "kits_canal_pdv long, ingresos_directo decimal(38,2), ingresos_pdv decimal(38,2), "
    "mix_canal_pct decimal(5,2)",
    "hecho_desempeno": "hdesempeno_key long, dtiem_id int, dofic_id long, dases_id long, "
    "kits_por_asesor long, kits_activos_asesor long, kits_inactivos_asesor long, "
    "meta_kits_mes long, cumplimiento_meta_pct decimal(12,2), kits_inactivos_pct decimal(5,2)",
}

MART_DEFAULTS: dict[str, dict[str, object]] = {
    "dim_estado": {"flag_riesgo_90d": 0},
    "hecho_ventas": {
        "n_estados": 1,
        "kits_vendidos": 1,
        "kits_activos": 0,
        "tasa_activacion_pct": 0,
        "ingresos_s": 0,
        "contribucion_pct": 0,
    },
    "hecho_inventario": {"dias_inactivo": 0, "kits_riesgo_90d": 0},
    "hecho_canal": {
        "kits_canal_directo": 0,
        "kits_canal_pdv": 0,
        "ingresos_directo": 0,
        "ingresos_pdv": 0,
        "mix_canal_pct": 0,
    },
    "hecho_desempeno": {
        "kits_por_asesor": 0,
        "kits_activos_asesor": 0,
        "kits_inactivos_asesor": 0,
        "meta_kits_mes": 0,
        "cumplimiento_meta_pct": 0,
        "kits_inactivos_pct": 0,
    },
}
