"""Sources, sinks and load modes."""

from __future__ import annotations

import re
from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.compare.rows import row_diff
from ..operators.numbering import first_writer, number_rows
from ..operators.upsert import upsert
from ..plans import layered, scripted
from ..session import at_once, scratch_path
from ..sources import files, ranged, sinks
from ..sources.schemas import MART_SCHEMAS, RAW_SCHEMAS
from ..streaming import cdc, incremental
from .changes import diff_pair
from .registry import query


def _row_text(table: str) -> str:
    """The cells of a raw table as one text in SQL."""
    names = [c.split()[0] for c in re.split(r",\s*(?![0-9])", RAW_SCHEMAS[table])]
    return "concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, 'NULL')" for c in names) + ")"


@query("s1_source_scan", "select * from recepciones")
def source_scan(m):
    return m.raw("recepciones")


@query("s2_model_reference", "select dofic_id, oficina_id, nom_oficina, departamento, region, zona from dim_oficina")
def model_reference(m):
    return layered.dim_oficina(m.stg("oficinas"))


@query(
    "s3_snapshot_copy",
    " union all ".join(f"select '{t}' as tabla, {_row_text(t)} as fila from {t}" for t in RAW_SCHEMAS),
)
def snapshot_copy(m):
    """All eight raw tables are mirrored; every cell of the copies is compared."""
    m.land()
    copies = sinks.snapshot_copy({n: m.raw(n) for n in RAW_SCHEMAS}, scratch_path(m.spark, "mirror"))
    text = lambda df: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in df.columns])
    parts = [df.select(F.lit(n).alias("tabla"), text(df).alias("fila")) for n, df in copies.items()]
    return reduce(DataFrame.unionByName, parts)


@query("s4_full_refresh", "select * from vendedores")
def full_refresh(m):
    path = scratch_path(m.spark, "vendedores")
    sinks.as_table(m.raw("asesores").withColumnsRenamed({"asesor_pdv_id": "vendedor_id", "nom_asesor_pdv": "nom_vendedor"}), path)
    return sinks.as_table(m.raw("vendedores"), path)


@query("s5_incremental_append", "select * from ventas")
def incremental_append(m):
    """Loads in the middle of a day: its other sales arrive with the next load, and none twice."""
    m.land()
    path = scratch_path(m.spark, "ventas")
    source, day = m.raw("ventas"), F.col("fecha_venta")
    for load, until in enumerate(("1996-06-28", "1999-02-10", "1999-02-10", "9999-12-31")):
        last = F.lit(until).cast("date")
        early = (day == last) & ((F.col("venta_id") % 2 == 0) | F.lit(load == 2))
        target = incremental.append_newer(m.spark, source.filter((day < last) | early), path, "fecha_venta", ["venta_id"], load)
    return target


@query(
    "s5_incremental_stream",
    "select o_orderkey, o_custkey, o_totalprice, cast(o_orderdate as date) as o_orderdate from orders",
)
def incremental_stream(m):
    schema = m.sources.base("orders").schema
    root = scratch_path(m.spark, "orders-stream")
    pick = lambda df: df.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date"))
    args = (m.spark, f"{m.sources.root}/orders.parquet*", schema, f"{root}/data", f"{root}/checkpoint", pick)
    incremental.append_stream(*args)
    return incremental.append_stream(*args)  # nothing new: the second run adds no row


def _changes(events):
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
    return events.select(
        op.otherwise("U").alias("op"),
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        "event_type",
        "value",
    )


CDC_SQL = (
    "select user_id as key, event_type, value from events "
    "qualify row_number() over (partition by user_id order by event_id desc) = 1 and event_type <> 'error'"
)


@query("s6_cdc_apply", CDC_SQL)
def cdc_apply(m):
    """Two batches split by log position, the second replayed."""
    log = _changes(m.sources.base("events"))
    state = cdc.apply_changes(None, log.filter("seq % 3 <> 0"), ["key"])
    late = log.filter("seq % 3 = 0")
    state = cdc.apply_changes(state, late, ["key"])
    return cdc.live_rows(cdc.apply_changes(state, late, ["key"]))


@query("s6_cdc_stream", CDC_SQL)
def cdc_stream(m):
    """Two runs over two drops of the log with a compaction between them."""
    schema = m.sources.base("events").schema
    root, drops = scratch_path(m.spark, "cdc"), scratch_path(m.spark, "events")
    events = m.sources.base("events")
    for drop in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.filter(drop).write.mode("append").parquet(drops)
        cdc.cdc_stream(m.spark, drops, schema, _changes, ["key"], root)
        state = cdc.compact_changes(m.spark, root, ["key"])
    return cdc.live_rows(state)


@query("s7_view_materialization", "select oficina_id, count(*) as recepciones from stg_recepciones group by 1")
def view_materialization(m):
    view = sinks.as_view(m.stg("recepciones"), "stg_recepciones")
    return view.groupBy("oficina_id").agg(F.count("*").alias("recepciones"))


@query("s8_table_materialization", "select * from fact_metas_pedidos")
def table_materialization(m):
    path = scratch_path(m.spark, "fact_metas_pedidos")
    sinks.as_table(m.fact_metas_pedidos, path)
    return sinks.as_table(m.fact_metas_pedidos, path)


@query(
    "s9_schema_routing",
    "select 'marts' as esquema, count(*) as filas from stg_metas union all select 'staging', count(*) from stg_metas",
)
def schema_routing(m):
    root = scratch_path(m.spark, "warehouse")
    out = None
    for custom in (" marts ", None):
        schema = sinks.resolve_schema(custom, "staging")
        rows = sinks.as_table(m.stg("metas"), sinks.model_path(root, schema, "stg_metas"))
        rows = rows.agg(F.count("*").alias("filas")).select(F.lit(schema).alias("esquema"), "filas")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "s10_append_by_load",
    "select load_id, oficina_id, sum(meta_kits)::bigint as meta from metas, (values (1), (2)) l(load_id) group by all",
)
def append_by_load(m):
    """Two loads, the second run twice: its partition is replaced, not doubled."""
    path = scratch_path(m.spark, "metas")
    for load in (1, 2, 2):
        target = sinks.append_load(m.raw("metas"), path, load)
    return target.groupBy("load_id", "oficina_id").agg(F.sum("meta_kits").alias("meta"))


@query(
    "s11_insert_ignore",
    "select fecha, if(fecha in (select fecha_venta from ventas), 'venta', 'recepcion') as origen from "
    "(select fecha_venta as fecha from ventas union select fecha_recepcion from recepciones)",
)
def insert_ignore(m):
    sold = m.raw("ventas").select(F.col("fecha_venta").alias("fecha")).distinct()
    received = m.raw("recepciones").select(F.col("fecha_recepcion").alias("fecha")).distinct()
    streams = [sold.withColumn("origen", F.lit("venta")), received.withColumn("origen", F.lit("recepcion"))]
    return first_writer(streams, ["fecha"])


@query(
    "s12_upsert",
    "with antes as (select row_number() over (order by oficina_id) as dofic_id, oficina_id from oficinas where oficina_id % 3 <> 0), "
    "tope as (select max(dofic_id) as n from antes) "
    "select ifnull(a.dofic_id, n + row_number() over (partition by a.dofic_id is null order by o.oficina_id)) as dofic_id, o.* "
    "from oficinas o left join antes a on a.oficina_id = o.oficina_id, tope",
)
def upsert_all(m):
    offices = m.raw("oficinas")
    old = offices.filter("oficina_id % 3 <> 0").withColumns(
        {"nom_oficina": F.lower("nom_oficina"), "zona": F.lit("SIN ZONA")}
    )
    target = layered.dim_oficina(old)
    # the source brings every office twice; the later row counts
    twice = offices.withColumn("turno", F.lit(2)).unionByName(old.withColumn("turno", F.lit(1)))
    return upsert(target, twice, ["oficina_id"], "dofic_id", last=[F.desc("turno")])


@query(
    "s12_upsert_ranges",
    "with antes as (select row_number() over (order by producto_id) as prod_key, producto_id, precio_base from productos where producto_id % 9 <> 0), "
    "nuevos as (select producto_id, precio_base, row_number() over (order by producto_id) as n from productos where producto_id % 9 = 0 and producto_id <= 90) "
    "select prod_key, producto_id, if(producto_id <= 40, precio_base + 1, precio_base)::decimal(10,2) as precio_base from antes "
    "union all select (select max(prod_key) from antes) + n, producto_id, precio_base from nuevos",
)
def upsert_ranges(m):
    """A stored table of products; only the ranges of new and repriced ones are written again."""
    products = m.raw("productos").select("producto_id", "precio_base")
    number = F.col("producto_id")
    root = scratch_path(m.spark, "productos")
    target = number_rows(products.filter(number % 9 != 0), [number], "prod_key")
    ranged.store(target, root, ["producto_id"], "prod_key", rows_per_range=1000)
    price = F.when(number % 9 != 0, F.col("precio_base") + 1).otherwise(F.col("precio_base"))
    source = products.filter((number <= 40) | ((number % 9 == 0) & (number <= 90))).withColumn("precio_base", price.cast("decimal(10,2)"))
    ranged.upsert_ranges(m.spark, root, source, ["producto_id"], "prod_key")
    return ranged.read(m.spark, root)


@query(
    "s13_partial_upsert",
    "with antes as (select row_number() over (order by vendedor_id) as dases_id, vendedor_id as origen_id, cast(99 as decimal(5,2)) as monto from vendedores where vendedor_id % 4 = 0), "
    "tope as (select max(dases_id) as n from antes) "
    "select ifnull(a.dases_id, n + row_number() over (partition by a.dases_id is null order by v.vendedor_id)) as dases_id, "
    "v.vendedor_id as origen_id, nom_vendedor as nom_cliente_pdv, 'DIRECTO' as tipo_canal, ifnull(monto, cast(220 as decimal(5,2))) as monto_asociado "
    "from vendedores v left join antes a on a.origen_id = v.vendedor_id, tope",
)
def partial_upsert(m):
    """Known sellers get the new name and keep their tariff."""
    rows = m.stg("vendedores").withColumnsRenamed({"vendedor_id": "origen_id", "nom_vendedor": "nom_cliente_pdv"})
    old = rows.filter("origen_id % 4 = 0").withColumns(
        {"nom_cliente_pdv": F.lit("?"), "monto_asociado": F.lit("99.00").cast("decimal(5,2)")}
    )
    target = layered.number_rows(old, [F.col("origen_id")], "dases_id")
    twice = rows.withColumn("turno", F.lit(2)).unionByName(
        rows.withColumns({"nom_cliente_pdv": F.lit("antes"), "turno": F.lit(1)})
    )
    return upsert(target, twice, ["origen_id", "tipo_canal"], "dases_id", ["nom_cliente_pdv"], [F.desc("turno")])


@query(
    "s14_post_load_update",
    "select dofic_id, any_value(contribucion_pct) as contribucion_pct, count(*) as filas from hecho_ventas group by dofic_id",
)
def post_load_update(m):
    facts = _scripted_sales(m)
    return facts.groupBy("dofic_id").agg(
        F.any_value("contribucion_pct").alias("contribucion_pct"), F.count("*").alias("filas")
    )


def _scripted_sales(m):
    m.land()
    office = scripted.dim_oficina(scripted.empty_dim(m.spark, "dim_oficina"), m.raw("oficinas"))
    state = scripted.dim_estado(m.raw("recepciones"), m.raw("productos"))
    goods = scripted.with_status(m.raw("productos"), state)
    view = scripted.vw_ventas_enriched(*[m.raw(t) for t in ("ventas", "recepciones", "activaciones")], goods)
    return scripted.hecho_ventas(view, office, state, goods)


@query(
    "s15_conform_defaults",
    "select date_key_of as dtiem_id, null::bigint as dofic_id, null::bigint as dest_id, 1::bigint as n_estados, 1 as kits_vendidos, 0 as kits_activos, "
    "0::decimal(5,2) as tasa_activacion_pct, ifnull(if(venta_id % 2 = 0, monto_venta, null), 0)::decimal(38,2) as ingresos_s, 0::decimal(5,2) as contribucion_pct, "
    "venta_id, null::varchar as serie, canal_venta from (select *, cast(strftime(fecha_venta, '%Y%m%d') as integer) as date_key_of from ventas)",
)
def conform_defaults(m):
    """Columns left out and cells left empty take the declared defaults."""
    rows = m.raw("ventas").select(
        layered.date_key(F.col("fecha_venta")).alias("dtiem_id"),
        "venta_id",
        "canal_venta",
        F.when(F.col("venta_id") % 2 == 0, F.col("monto_venta")).alias("ingresos_s"),
    )
    return sinks.fill_defaults(rows, "hecho_ventas")


@query(
    "s16_recreate_targets",
    " union all ".join(
        f"select '{name}' as tabla, count(*) as filas from {view}"
        for name, view in (
            ("dim_tiempo", "a_dim_tiempo"), ("dim_oficina", "a_dim_oficina"), ("dim_estado", "a_dim_estado"), ("dim_asesor_pdv", "a_dim_asesor"),
            ("hecho_ventas", "hecho_ventas"), ("hecho_inventario", "hecho_inventario"), ("hecho_canal", "hecho_canal"), ("hecho_desempeno", "hecho_desempeno"),
        )
    ),
)
def recreate_targets(m):
    """All eight targets hold old rows, are replaced by empty ones, and are loaded once.

    Tables that do not need each other are loaded at once: the small dimensions while the order
    rows land, and facts without a status while the status dimension is made.
    """
    root = scratch_path(m.spark, "targets")
    raw, path, loaded = m.raw, partial(sinks.model_path, root, ""), {}

    def load(name, make, *args):
        loaded[name] = sinks.as_table(make(*args), path(name))

    def renew():
        old = lambda name: sinks.as_table(raw("oficinas").select(F.lit(name).alias("vieja")), path(name))
        at_once(*[partial(old, name) for name in MART_SCHEMAS])
        empty = sinks.recreate(m.spark, root, list(MART_SCHEMAS))
        at_once(
            lambda: load("dim_oficina", scripted.dim_oficina, empty["dim_oficina"], raw("oficinas")),
            lambda: load("dim_asesor_pdv", scripted.dim_asesor_pdv, empty["dim_asesor_pdv"], raw("vendedores"), raw("asesores")),
        )

    at_once(m.sources.land, renew)
    office, seller = loaded["dim_oficina"], loaded["dim_asesor_pdv"]
    sales, receipts, activations, products, goals = map(raw, ("ventas", "recepciones", "activaciones", "productos", "metas"))

    def load_by_product():
        state = scripted.dim_estado(receipts, products)
        goods, _ = at_once(lambda: scripted.with_status(products, state), lambda: load("dim_estado", lambda: state))
        view = partial(scripted.vw_ventas_enriched, sales, receipts, activations, goods)
        at_once(
            lambda: load("hecho_ventas", lambda: scripted.hecho_ventas(view(), office, state, goods)),
            lambda: load("hecho_inventario", scripted.hecho_inventario, receipts, goods, sales, office, state),
        )

    at_once(
        load_by_product,
        lambda: load("dim_tiempo", scripted.dim_tiempo, sales, receipts, goals),
        lambda: load("hecho_canal", scripted.hecho_canal, sales, activations, office),
        lambda: load("hecho_desempeno", scripted.hecho_desempeno, sales, activations, goals, office, seller),
    )
    parts = [
        loaded[name].agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas") for name in MART_SCHEMAS
    ]
    return reduce(DataFrame.unionByName, parts)


#: Text columns of the raw tables that the targets take over, by table and its key.
_TEXTS = {
    "ventas": ("venta_id", ["canal_venta"]),
    "recepciones": ("recepcion_id", ["estado_recepcion"]),
    "productos": ("producto_id", ["serie", "descripcion"]),
    "oficinas": ("oficina_id", ["nom_oficina", "departamento", "region", "zona"]),
    "vendedores": ("vendedor_id", ["nom_vendedor"]),
    "asesores": ("asesor_pdv_id", ["nom_asesor_pdv"]),
}


@query(
    "s17_collated_text",
    " union all ".join(
        f"select '{t}' as tabla, '{c}' as columna, lower(rtrim({c})) as valor, count(*) as filas from {t} group by lower(rtrim({c}))"
        for t, (_, names) in _TEXTS.items()
        for c in names
    ),
)
def collated_text(m):
    """Texts in mixed case and with trailing blanks meet in one group, column by column."""
    m.land()
    parts = []
    for table, (key, names) in _TEXTS.items():
        odd = F.col(key) % 2 == 1
        mixed = [F.when(odd, F.concat(F.upper(c), F.lit(" "))).otherwise(F.lower(c)).alias(c) for c in names]
        texts = sinks.collate_text(m.raw(table).select(*mixed))
        cells = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("valor")) for c in names])
        counts = texts.select(F.inline(cells)).groupBy("columna", "valor").agg(F.count("*").alias("filas"))
        plain = F.lower(F.rtrim(F.col("valor").cast("string"))).cast("string").alias("valor")
        parts.append(counts.select(F.lit(table).alias("tabla"), "columna", plain, "filas"))
    return reduce(DataFrame.unionByName, parts)


#: Cells that a text format has to quote or escape, by product.
_AWKWARD = {0: "a\nb \"x\" ", 1: "a,b;c\td\U0001f4a9e", 2: "NULL", 3: None, 4: "_NULL", 5: "", 6: " c\rd"}
_AWKWARD_SQL = "case producto_id % 8 " + " ".join(
    f"when {k} then " + ("null" if v is None else "'" + v + "'") for k, v in _AWKWARD.items()
) + " else descripcion end"


def _delimited(m, ext):
    path = scratch_path(m.spark, ext)
    cell = F.col("descripcion")
    for k, v in _AWKWARD.items():
        cell = F.when(F.col("producto_id") % 8 == k, F.lit(v)).otherwise(cell)
    files.write_delimited(m.raw("productos").withColumn("descripcion", cell), path, ext)
    return files.read_delimited(m.spark, path, ext, RAW_SCHEMAS["productos"])


for _ext in ("csv", "tsv", "ssv", "psv"):
    query(f"s18_delimited_{_ext}", f"select producto_id, serie, {_AWKWARD_SQL} as descripcion, precio_base, activo from productos")(
        lambda m, e=_ext: _delimited(m, e)
    )


@query("s19_ndjson", "select * from activaciones")
def ndjson(m):
    path = scratch_path(m.spark, "ndjson")
    files.write_ndjson(m.raw("activaciones"), path)
    return files.read_ndjson(m.spark, path, RAW_SCHEMAS["activaciones"])


@query("s20_json_table", "select oficina_id::varchar as oficina_id, anio::varchar as anio, mes_num::varchar as mes_num, meta_kits::varchar as meta_kits from metas")
def json_table(m):
    path = scratch_path(m.spark, "json")
    files.write_json_table(m.raw("metas"), path, "metas")
    return files.read_json_table(m.spark, path, "metas", ["oficina_id", "anio", "mes_num", "meta_kits"], False)


@query("s20_json_objects", "select producto_id::varchar as producto_id, serie, precio_base::varchar as precio_base from productos")
def json_objects(m):
    """Rows as objects, a hundred to a document."""
    path = scratch_path(m.spark, "json-objects")
    rows = m.raw("productos").select("producto_id", "serie", "precio_base")
    files.write_json_table(rows, path, "productos", rows_per_document=100, objects=True)
    return files.read_json_objects(m.spark, path, "productos", rows.columns, False)


@query("s20_json_tables", "select 'metas' as tabla, oficina_id::varchar as clave, count(*) as filas from metas group by all union all select 'oficinas', oficina_id::varchar, count(*) from oficinas group by all")
def json_tables(m):
    """Two tables in one set of documents."""
    path = scratch_path(m.spark, "json-tables")
    files.write_json_tables({n: m.raw(n) for n in ("metas", "oficinas")}, path)
    tables = files.read_json_tables(m.spark, path, {n: ["oficina_id"] for n in ("metas", "oficinas")}, False)
    parts = [
        df.groupBy(F.col("oficina_id").alias("clave")).agg(F.count("*").alias("filas")).select(F.lit(n).alias("tabla"), "clave", "filas")
        for n, df in tables.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "s21_keyed_table_diff",
    "select action, count(*) as filas from (select case when a.c_custkey is null then '+++' when b.c_custkey is null then '---' "
    "when a.c_acctbal is distinct from b.c_acctbal or a.c_mktsegment is distinct from b.c_mktsegment then '->' end as action "
    "from diff_a a full join diff_b b on a.c_custkey = b.c_custkey) where action is not null group by 1",
)
def keyed_table_diff(m):
    diff = row_diff(*diff_pair(m), ["c_custkey"], unique_keys=True)
    return diff.groupBy("action").agg(F.count("*").alias("filas"))


@query("s22_convert_format", "select * from recepciones")
def convert_format(m):
    schema = RAW_SCHEMAS["recepciones"]
    path = {e: scratch_path(m.spark, e) for e in ("parquet", "csv", "ndjson")}
    m.raw("recepciones").write.parquet(path["parquet"])
    files.convert(m.spark, path["parquet"], "parquet", path["csv"], "csv", schema)
    files.convert(m.spark, path["csv"], "csv", path["ndjson"], "ndjson", schema)
    return files.read_ndjson(m.spark, path["ndjson"], schema)


@query("s23_drop_blank", "select serie, precio from (select if(trim(serie) = '', null, serie) as serie, if(producto_id % 5 = 0, null, precio_base) as precio from productos) where serie is not null or precio is not null")
def blank_rows(m):
    """Rows empty in every cell go, and so does a column that is empty in every row."""
    rows = m.raw("productos").select(
        F.when(F.trim("serie") != "", F.col("serie")).alias("serie"),
        F.when(F.col("producto_id") % 5 != 0, F.col("precio_base")).alias("precio"),
        F.lit("").alias("vacia"),
    )
    return files.drop_blank(rows)
