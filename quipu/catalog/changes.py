"""Table comparison, merge and patch."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cells import CellRules
from ..operators.compare import columns as cols
from ..operators.compare import infer, patch, rows, textform, three_way
from ..operators.compare.hash_tree import HashedTable
from ..operators.compare.order import active_columns, order_changed, with_context
from ..operators.numbering import number_rows
from ..session import scratch_path
from .registry import query

KEY = ["c_custkey"]
CELLS = ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# ---- fixtures derived from the customer and part tables --------------------------------


def diff_pair(m) -> tuple[DataFrame, DataFrame]:
    """The customer table and a second version of it."""
    a = m.sources.base("customer")
    turn = F.col("c_custkey") % 20
    b = a.filter(F.col("c_custkey") % 50 != 0).withColumns(
        {
            "c_acctbal": F.when(turn == 1, F.col("c_acctbal") + 1)
            .when(turn == 3, F.col("c_acctbal") + F.lit(0.001))
            .otherwise(F.col("c_acctbal")),
            "c_mktsegment": F.when(
                turn == 2, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
            ).otherwise(F.col("c_mktsegment")),
        }
    )
    new = a.filter(F.col("c_custkey") % 70 == 0).withColumn("c_custkey", F.col("c_custkey") + 10000000)
    return a, b.unionByName(new)


def exact_pair(m) -> tuple[DataFrame, DataFrame]:
    """The same pair with balances as whole thousandths, whose text form is the same everywhere."""
    return tuple(
        df.withColumn("c_acctbal", F.round(F.col("c_acctbal") * 1000).cast("long")) for df in diff_pair(m)
    )


def three_versions(m) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parent, local and remote customers covering every presence and edit case.

    Keys above 50,000,000 repeat: they take part in no comparison and are rejects.
    """
    key = F.col("c_custkey")
    cents = F.col("cents")
    turn = key % 20
    parent = m.sources.base("customer").select(
        "c_custkey", "c_name", "c_nationkey", F.round(F.col("c_acctbal") * 100).cast("long").alias("cents")
    )

    def shifted(every: int, by: int) -> DataFrame:
        return parent.filter(key % every == 0).withColumn("c_custkey", key + by)

    local = (
        parent.filter(key % 50 != 7)
        .withColumn("cents", F.when(turn.isin(1, 4, 6), cents + 10).otherwise(cents))
        .unionByName(shifted(70, 20000000))
        .unionByName(shifted(90, 40000000))
        .unionByName(shifted(110, 50000000))
        .unionByName(shifted(110, 50000000).withColumn("cents", cents + 1))
    )
    remote = (
        parent.filter(key % 50 != 9)
        .withColumns(
            {
                "cents": F.when(turn.isin(1, 5), cents + 20).when(turn == 6, cents + 10).otherwise(cents),
                "c_nationkey": F.when(turn == 8, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")),
            }
        )
        .unionByName(shifted(70, 30000000))
        .unionByName(shifted(90, 40000000).withColumn("cents", cents + 5))
        .unionByName(shifted(110, 50000000))
        .unionByName(shifted(130, 60000000))
        .unionByName(shifted(130, 60000000))
    )
    return parent, local, remote


def part_pair(m) -> tuple[DataFrame, DataFrame]:
    """Parts, and parts with a column dropped, one renamed and one added."""
    a = m.sources.base("part")
    key = F.col("p_partkey")
    b = a.filter(key % 40 != 0).select(
        "p_partkey",
        "p_name",
        "p_brand",
        F.col("p_type").alias("p_kind"),
        "p_retailprice",
        F.when(key % 3 == 0, "A").when(key % 3 == 1, "").alias("p_tier"),
    )
    return a, b


# ---- schema ----------------------------------------------------------------------------


def _filled(df: DataFrame, names: list[str]) -> DataFrame:
    """Non-null cells per column, from one aggregate."""
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in names]))
    )


@query(
    "d1_schema_diff",
    "select n, code, \"column\", filled from (values ('', 'p_partkey', 'p_partkey'), ('', 'p_name', 'p_name'), ('', 'p_brand', 'p_brand'), ('(p_type)', 'p_kind', 'p_kind'), ('', 'p_retailprice', 'p_retailprice'), ('+++', 'p_tier', 'p_tier')) c(code, \"column\", n) "
    "join (select 'p_partkey' as n, count(p_partkey) as filled from part_new union all select 'p_name', count(p_name) from part_new union all select 'p_brand', count(p_brand) from part_new union all select 'p_kind', count(p_kind) from part_new union all select 'p_retailprice', count(p_retailprice) from part_new union all select 'p_tier', count(p_tier) from part_new) using (n) "
    "union all select 'p_size', '---', 'p_size', count(p_size) from part",
)
def d1(m):
    """Column changes, each with the filled cells of its column (old table when dropped)."""
    a, b = part_pair(m)
    found = [(code, c) for code, c, _, _ in cols.schema_diff(a, b, {"p_type": "p_kind"})]
    codes = m.spark.createDataFrame(found, "code string, column string")
    filled = _filled(b, b.columns).unionByName(_filled(a, ["p_size"]))
    return codes.join(filled, "column").select(F.col("column").alias("n"), "code", "column", "filled")


@query(
    "d2_type_diff",
    "select 'p_partkey' as \"column\", 'key' as property, 'true' as before, 'false' as after, count(p_partkey) as filled from part "
    "union all select 'p_name', 'key', 'false', 'true', count(p_name) from part union all select 'p_size', 'type', 'int', 'bigint', count(p_size) from part",
)
def d2(m):
    a = m.sources.base("part")
    b = a.withColumn("p_size", F.col("p_size").cast("long"))
    found = cols.type_diff(a, b, ["p_partkey"], ["p_name"])
    props = m.spark.createDataFrame(found, "column string, property string, before string, after string")
    return props.join(_filled(b, sorted({r[0] for r in found})), "column")


@query(
    "d20_alter_columns",
    "select p_name as nombre, p_partkey, p_retailprice::decimal(12,2) as precio, null::varchar as nota, p_size::bigint as p_size from part",
)
def d20(m):
    return cols.alter_columns(
        m.sources.base("part"),
        [
            ("p_name", "nombre", {}),
            ("p_partkey", "p_partkey", {"key": "true"}),
            ("p_retailprice", "precio", {"type": "decimal(12,2)"}),
            (None, "nota", {"type": "string"}),
            ("p_size", "p_size", {"type": "bigint"}),
            ("p_brand", None, {}),
        ],
    )


@query(
    "d22_same_columns",
    "select 'customer' as par, 'juntas' as version, c_nationkey::varchar as clave, count(*) as filas from (select * from diff_a union all select * from diff_b) group by c_nationkey "
    "union all select 'part', 'a', p_brand, count(*) from part group by p_brand union all select 'part', 'b', p_brand, count(*) from part_new group by p_brand",
)
def d22(m):
    """Versions with the same columns are stacked and counted together, others each by itself."""
    parts = []
    for name, (a, b), by in (("customer", diff_pair(m), "c_nationkey"), ("part", part_pair(m), "p_brand")):
        tables = {"juntas": a.unionByName(b)} if cols.same_columns(a, b) else {"a": a, "b": b}
        for version, df in tables.items():
            counts = df.groupBy(F.col(by).cast("string").alias("clave")).agg(F.count("*").alias("filas"))
            parts.append(counts.select(F.lit(name).alias("par"), F.lit(version).alias("version"), "clave", "filas"))
    return reduce(DataFrame.unionByName, parts)


# ---- alignment -------------------------------------------------------------------------

_SIDES = (
    "with a as (select fecha_venta as fecha, oficina_id, venta_id as id, count(*) over (partition by fecha_venta, oficina_id) as n from ventas), "
    "b as (select fecha_recepcion as fecha, oficina_id, recepcion_id as id, count(*) over (partition by fecha_recepcion, oficina_id) as n from recepciones), "
    "pares as (select a.fecha, a.oficina_id, a.id as izquierda, b.id as derecha from a join b on a.fecha = b.fecha and a.oficina_id = b.oficina_id where a.n = 1 and b.n = 1) "
)


@query(
    "d3_align_by_key",
    _SIDES + "select * from pares union all select fecha, oficina_id, id, null from a where id not in (select izquierda from pares) "
    "union all select fecha, oficina_id, null, id from b where id not in (select derecha from pares)",
)
def d3(m):
    """Sales and receipts by day and office; a repeated key links nothing."""
    m.land()
    a = m.raw("ventas").select(F.col("fecha_venta").alias("fecha"), "oficina_id", F.col("venta_id").alias("id"))
    b = m.raw("recepciones").select(F.col("fecha_recepcion").alias("fecha"), "oficina_id", F.col("recepcion_id").alias("id"))
    pairs = rows.align_by_key(a, b, ["fecha", "oficina_id"])
    return pairs.select("fecha", "oficina_id", F.col("l.id").alias("izquierda"), F.col("r.id").alias("derecha"))


#: Candidate keys over the columns of the two order versions; the last one needs a sixth column.
_CANDIDATES = [["custkey", "total"], ["custkey", "day", "priority"], ["clerk"], ["status", "total", "day"], ["custkey", "status", "day", "clerk", "priority", "ship"]]


def order_versions(m) -> tuple[DataFrame, DataFrame]:
    """Orders as they are, and a version with changed totals, days and clerks."""
    key = F.col("o_orderkey")
    a = m.sources.base("orders").select(
        key.alias("id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("total"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").alias("priority"),
        (key % 1000).alias("clerk"),
        (key % 7).alias("ship"),
    )
    id = F.col("id")
    b = a.filter(id % 50 != 0).withColumns(
        {
            "total": F.when(id % 3 == 0, F.col("total") + 7).otherwise(F.col("total")),
            "day": F.when(id % 9 == 0, F.date_add("day", 1)).otherwise(F.col("day")),
            "custkey": F.when(id % 45 == 0, None).otherwise(F.col("custkey")),
        }
    )
    return a, b.withColumn("id", id + 90000000)


def _infer_sql() -> str:
    """The candidates in turn: pairs alone under their key text, without rows linked before."""
    text = "case when {c}::varchar in ('', 'NULL') then '' else coalesce({c}::varchar, '') end"
    parts, linked = [], []
    for i, candidate in enumerate(_CANDIDATES):
        key = "concat_ws(' // ', " + ", ".join(text.format(c=c) for c in candidate) + ")"
        alone = f"select {key} as k, max(id) as id from {{v}} group by 1 having count(*) = 1 and {key} <> ''"
        seen = " ".join(f"and a.id not in (select id_a from l{j}) and b.id not in (select id_b from l{j})" for j in range(i))
        parts.append(
            f"l{i} as (select a.id as id_a, b.id as id_b, '{','.join(candidate)}' as subset from ({alone.format(v='ord_a')}) a join ({alone.format(v='ord_b')}) b using (k) where true {seen})"
        )
        linked.append(f"select * from l{i}")
    a = "select o_orderkey as id, o_custkey as custkey, o_orderstatus as status, cast(round(o_totalprice * 100) as bigint) as total, cast(o_orderdate as date) as day, o_orderpriority as priority, o_orderkey % 1000 as clerk, o_orderkey % 7 as ship from orders"
    b = "select id + 90000000 as id, if(id % 45 = 0, null, custkey) as custkey, status, if(id % 3 = 0, total + 7, total) as total, if(id % 9 = 0, (day + 1)::date, day) as day, priority, clerk, ship from ord_a where id % 50 <> 0"
    return f"with ord_a as ({a}), ord_b as ({b}), " + ", ".join(parts) + " " + " union all ".join(linked)


ORDER_VERSIONS_SQL = _infer_sql().split(", l0 as")[0]


@query("d4_align_infer_keys", _infer_sql())
def d4(m):
    """No single key links all rows: the candidate keys are tried in turn."""
    return infer.align_infer_keys(*order_versions(m), "id", "id", _CANDIDATES)


def _office_days(m) -> tuple[DataFrame, DataFrame]:
    """Sales of an office and day, and a version in which some days are gone, new or corrected."""
    day, office = F.col("fecha"), F.col("oficina_id")
    a = m.raw("ventas").groupBy("oficina_id", F.col("fecha_venta").alias("fecha")).agg(
        F.count("*").alias("ventas"), F.count_if(F.col("canal_venta") == "PDV").alias("pdv"), F.max("monto_venta").cast("long").alias("mayor")
    )
    a = a.withColumn("mayor", F.col("mayor") % 10).withColumn("id", F.unix_date(day).cast("long") * 100 + office)
    b = a.filter(F.col("id") % 50 != 7).withColumns(
        {
            "fecha": F.when(F.col("id") % 31 == 0, F.date_add("fecha", 10000)).otherwise(day),
            "ventas": F.when(F.col("id") % 3 == 0, F.col("ventas") + 1).otherwise(F.col("ventas")),
            "id": F.col("id") + 90000000,
        }
    )
    return a, b


_DAYS = (
    "with dias_a as (select oficina_id, fecha_venta as fecha, count(*) as ventas, count(*) filter (canal_venta = 'PDV') as pdv, trunc(max(monto_venta))::bigint % 10 as mayor, "
    "date_diff('day', date '1970-01-01', fecha_venta)::bigint * 100 + oficina_id as id from ventas group by oficina_id, fecha_venta), "
    "dias_b as (select oficina_id, if(id % 31 = 0, (fecha + 10000)::date, fecha) as fecha, if(id % 3 = 0, ventas + 1, ventas) as ventas, pdv, mayor, id + 90000000 as id from dias_a where id % 50 <> 7)"
)
_DAY_COLUMNS = ["oficina_id", "fecha", "ventas", "pdv", "mayor"]


def _keys_sql() -> str:
    """Every column set, whether it is unique and present in both tables, and the smallest of those."""
    sets = [list(s) for n in range(1, len(_DAY_COLUMNS) + 1) for s in combinations(_DAY_COLUMNS, n)]
    # the cast tells NULL from empty, and the length a text from its neighbour
    cells = lambda s: " || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '-')" for c in s)
    test = lambda s, t: f"(select count(distinct {cells(s)}) = count(*) and {' and '.join(f'count({c}) = count(*)' for c in s)} from {t})"
    listed = " union all ".join(f"select {s} as parts where {test(s, 'dias_a')} and {test(s, 'dias_b')}" for s in sets)
    return f"{_DAYS}, found as ({listed}) select array_to_string(parts, ',') as columnas, len(parts) as tamano from found f where not exists (select 1 from found g where len(g.parts) < len(f.parts) and list_has_all(f.parts, g.parts))"


@query("d4_find_keys", _keys_sql())
def d4_find(m):
    """Given only two tables: the smallest column sets that tell all rows apart in both."""
    a, b = _office_days(m)
    found = infer.minimal_keys([a, b], _DAY_COLUMNS)
    return m.spark.createDataFrame([(",".join(k), len(k)) for k in found], "columnas string, tamano long")


@query("d4_align_found_keys", f"{_DAYS} select a.id as id_a, b.id as id_b, 'oficina_id,fecha' as subset from dias_a a join dias_b b using (oficina_id, fecha)")
def d4_align_found(m):
    """Office and day are the one key of both tables, and nobody says so."""
    return infer.align_infer_keys(*_office_days(m), "id", "id")


_ACTION = "case when a.c_custkey is null then '+++' when b.c_custkey is null then '---' when a.c_name is distinct from b.c_name or a.c_nationkey is distinct from b.c_nationkey or a.c_acctbal is distinct from b.c_acctbal or a.c_mktsegment is distinct from b.c_mktsegment then '->' else '' end"
_PAIRED = "diff_a a full join diff_b b on a.c_custkey = b.c_custkey"


@query("d5_keys_by_role", f"select action, count(*) as filas from (select {_ACTION} as action from {_PAIRED}) where action <> '' group by 1")
def d5(m):
    a, b = diff_pair(m)
    b = cols.rename_keys(b.withColumnRenamed("c_custkey", "cliente"), ["cliente"], KEY)
    return rows.row_diff(a, b, KEY, unique_keys=True).groupBy("action").agg(F.count("*").alias("filas"))


# ---- difference ------------------------------------------------------------------------


@query(
    "d6_inserts_deletes_updates",
    f"select tipo, c_custkey from (select case {_ACTION} when '+++' then 'insert' when '---' then 'delete' when '->' then 'update' end as tipo, ifnull(a.c_custkey, b.c_custkey) as c_custkey from {_PAIRED}) where tipo is not null",
)
def d6(m):
    a, b = diff_pair(m)
    parts = [
        part.select(F.lit(kind).alias("tipo"), *KEY)
        for kind, part in (
            ("insert", rows.inserts(a, b, KEY)),
            ("delete", rows.deletes(a, b, KEY)),
            ("update", rows.updates(a, b, KEY)),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


_FLAT = ", ".join(f"a.{c} as {c}_before, b.{c} as {c}_after" for c in CELLS)


@query("d7_row_diff", f"select ifnull(a.c_custkey, b.c_custkey) as c_custkey, {_ACTION} as action, {_FLAT} from {_PAIRED} where {_ACTION} <> ''")
def d7(m):
    return rows.flat_cells(rows.row_diff(*diff_pair(m), KEY))


@query(
    "d7_moved_rows",
    "with v as (select a.c_custkey, row_number() over (order by a.c_custkey) as vieja, row_number() over (order by if(a.c_custkey % 15 = 0, -1, 1) * a.c_custkey) as nueva, "
    f"{_ACTION} as action from {_PAIRED} where a.c_custkey is not null and b.c_custkey is not null), "
    "w as (select c_custkey, action, ifnull(max(nueva) over (order by vieja rows between unbounded preceding and 1 preceding) > nueva, false) as movida from v) "
    "select c_custkey, if(action = '' and movida, ':', action) as action from w where action <> '' or movida "
    f"union all select ifnull(a.c_custkey, b.c_custkey), {_ACTION} from {_PAIRED} where a.c_custkey is null or b.c_custkey is null",
)
def d7_moved(m):
    """Both versions in an order of their own: some unchanged rows now stand above earlier ones."""
    a, b = diff_pair(m)
    key = F.col("c_custkey")
    place = F.when(key % 15 == 0, -key).otherwise(key)
    diff = rows.row_diff(a.withColumn("lugar", key), b.withColumn("lugar", place), KEY, unique_keys=True, ordered="lugar")
    return diff.select("c_custkey", "action")


@query(
    "d7_changed_cells",
    f"select c_custkey, action, \"column\", before, after from (select ifnull(a.c_custkey, b.c_custkey) as c_custkey, {_ACTION} as action, unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) as \"column\", "
    "unnest([a.c_name, a.c_nationkey::varchar, round(a.c_acctbal * 1000)::bigint::varchar, a.c_mktsegment]) as before, unnest([b.c_name, b.c_nationkey::varchar, round(b.c_acctbal * 1000)::bigint::varchar, b.c_mktsegment]) as after "
    f"from {_PAIRED}) where action <> '' and before is distinct from after",
)
def d7_cells(m):
    return rows.changed_cells(rows.row_diff(*exact_pair(m), KEY, unique_keys=True), KEY)


@query(
    "d7_new_column",
    "select coalesce(a.p_partkey, b.p_partkey) as p_partkey, case when b.p_partkey is null then '---' else '+' end as action, p_tier from part a left join part_new b on a.p_partkey = b.p_partkey where b.p_partkey is null or p_tier <> ''",
)
def d7_new_column(m):
    """Rows where only the added column is filled get the `+` code."""
    a, b = part_pair(m)
    diff = rows.row_diff(a, b, ["p_partkey"], renames={"p_type": "p_kind"}, unique_keys=True)
    return diff.select("p_partkey", "action", F.col("p_tier.after").alias("p_tier"))


@query(
    "d8_loose_options",
    "select c_custkey, action from (select ifnull(a.c_custkey, b.c_custkey) as c_custkey, case when a.c_custkey is null then '+++' when b.c_custkey is null then '---' "
    f"when not (abs(a.c_acctbal - b.c_acctbal) < 0.01e0) or lower(trim(a.c_mktsegment)) <> lower(trim(b.c_mktsegment)) then '->' else '' end as action from {_PAIRED}) where action <> ''",
)
def d8(m):
    loose = CellRules(ignore_whitespace=True, ignore_case=True, epsilon=0.01)
    return rows.row_diff(*diff_pair(m), KEY, loose, unique_keys=True).select(*KEY, "action")


_SHOWN = (
    f"with todo as (select ifnull(a.c_custkey, b.c_custkey) as c_custkey, {_ACTION} as action, b.c_acctbal as despues, b.c_mktsegment as segmento from {_PAIRED}), "
    "filas as (select row_number() over (order by c_custkey) as posicion, *, max((action <> '')::integer) over (order by c_custkey rows between 1 preceding and 1 following) as cerca from todo) "
    "select posicion, c_custkey, if(action <> '', 'cambio', 'contexto') as papel, despues, segmento from filas where cerca = 1 "
    "union all select posicion, null, '...', null, null from filas f where cerca = 0 and (posicion = (select max(posicion) from filas) or exists (select 1 from filas n where n.posicion = f.posicion + 1 and n.cerca = 1))"
)


@query("d9_hide_unchanged", _SHOWN)
def d9(m):
    """Changed rows with one row of context; only key and changed columns stay."""
    diff = rows.row_diff(*diff_pair(m), KEY, unique_keys=True, keep_unchanged=True)
    linked = diff.filter(~F.col("action").isin("+++", "---"))
    kept = active_columns(linked, KEY)
    shown = with_context(diff.select("action", *kept), [F.asc(KEY[0])], F.col("action") != "", 1)
    return shown.select(
        "posicion", *KEY, "papel", F.col("c_acctbal.after").alias("despues"), F.col("c_mktsegment.after").alias("segmento")
    )


def _text_cell(a: str, b: str) -> str:
    return f"case when action = '+++' then {b} when action = '---' then {a} when {a} is distinct from {b} then ifnull({a}, 'NULL') || '->' || ifnull({b}, 'NULL') else {b} end"


_TEXT = (
    f"select action, c_custkey, {_text_cell('a2', 'b2')} as c_name, {_text_cell('a3', 'b3')} as c_nationkey, {_text_cell('a4', 'b4')} as c_acctbal, {_text_cell('a5', 'b5')} as c_mktsegment from "
    f"(select {_ACTION} as action, ifnull(a.c_custkey, b.c_custkey) as c_custkey, a.c_name as a2, b.c_name as b2, a.c_nationkey::varchar as a3, b.c_nationkey::varchar as b3, round(a.c_acctbal * 1000)::bigint::varchar as a4, round(b.c_acctbal * 1000)::bigint::varchar as b4, a.c_mktsegment as a5, b.c_mktsegment as b5 from {_PAIRED}) where action <> ''"
)


def _text_diff(m) -> DataFrame:
    a, b = exact_pair(m)
    diff = rows.row_diff(a, b, KEY, unique_keys=True)
    return textform.as_text(diff, KEY, *textform.separators(a, b))


query("d10_text_format", _TEXT)(_text_diff)


@query(
    "d11_nested_format",
    f"select ifnull(a.c_custkey, b.c_custkey) as c_custkey, to_json({{'before': a.c_mktsegment, 'after': b.c_mktsegment}})::varchar as celda from {_PAIRED} where {_ACTION} <> ''",
)
def d11(m):
    diff = rows.row_diff(*diff_pair(m), KEY, unique_keys=True)
    return diff.select(*KEY, F.to_json("c_mktsegment", {"ignoreNullFields": "false"}).alias("celda"))


@query(
    "d12_diff_summary",
    "select 0::bigint as row_inserts, count(*) filter (b.p_partkey is null) as row_deletes, 0::bigint as row_updates, count(*) as row_count_initial, count(b.p_partkey) as row_count_final, 0::bigint as col_updates, 1::bigint as col_inserts, 1::bigint as col_deletes, 1::bigint as col_renames, true as different from part a left join part_new b on a.p_partkey = b.p_partkey",
)
def d12(m):
    return rows.diff_summary(*part_pair(m), ["p_partkey"], renames={"p_type": "p_kind"}, unique_keys=True)


@query("d13_tables_equal", "select 'copia' as par, 0::bigint as solo_a, 0::bigint as solo_b, true as iguales union all select 'version', (select count(*) from (select * from diff_a except all select * from diff_b)), (select count(*) from (select * from diff_b except all select * from diff_a)), false")
def d13(m):
    """Three stored tables: the trees tell which ranges of rows are read at all."""
    a, b = diff_pair(m)
    first = HashedTable.store(a, scratch_path(m.spark, "version-a"), KEY, rows_per_range=1000)
    others = {"copia": a.repartition("c_mktsegment"), "version": b}
    reports = [
        rows.equality_report(first, HashedTable.store(df, scratch_path(m.spark, par), KEY, like=first)).withColumn("par", F.lit(par))
        for par, df in others.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query(
    "d17_diff_many",
    f"select 'customer' as table_name, 'kept' as state, action, count(*) as \"rows\" from (select {_ACTION} as action from {_PAIRED}) where action <> '' group by 3 "
    "union all select 'nation', 'dropped', '---', count(*) from nation union all select 'supplier', 'added', '+++', count(*) from supplier",
)
def d17(m):
    a, b = diff_pair(m)
    nation, supplier = m.sources.base("nation"), m.sources.base("supplier")
    keys = {"customer": KEY, "nation": ["n_nationkey"], "supplier": ["s_suppkey"]}
    return rows.diff_many({"customer": a, "nation": nation}, {"customer": b, "supplier": supplier}, keys)


@query(
    "d18_order_changed",
    "select count(*) filter (movida) as movidas, count(*) as filas from (select ifnull(max(nueva) over (order by vieja rows between unbounded preceding and 1 preceding) > nueva, false) as movida from "
    "(select row_number() over (order by c_custkey) as vieja, row_number() over (order by c_acctbal, c_custkey) as nueva from customer))",
)
def d18(m):
    """Customers by key against customers by balance: which rows moved back."""
    base = m.sources.base("customer").select("c_custkey", "c_acctbal")
    old = number_rows(base, [F.asc("c_custkey")], "vieja")
    new = number_rows(base, [F.asc_nulls_last("c_acctbal"), F.asc("c_custkey")], "nueva").select("c_custkey", "nueva")
    moved = order_changed(old.join(new, "c_custkey"), "vieja", "nueva", bucket_rows=100_000)
    return moved.agg(F.count_if("movida").alias("movidas"), F.count("*").alias("filas"))


# ---- three-way -------------------------------------------------------------------------

_THREE_CELLS = ("name", "nation", "cents")


def _edit(c: str) -> str:
    return f"((in_p and in_r and p_{c} is distinct from r_{c}) or (not in_p and in_l and in_r and l_{c} is distinct from r_{c}))"


def _clash(c: str) -> str:
    return f"(in_p and {_edit(c)} and p_{c} is distinct from l_{c} and l_{c} is distinct from r_{c})"


_THREE_ACTION = (
    "case when not in_p and not in_l then '+++' when in_p and in_l and not in_r then '---' "
    f"when {' or '.join(map(_clash, _THREE_CELLS))} then '!->' when {' or '.join(map(_edit, _THREE_CELLS))} then '->' else '' end"
)


@query(
    "d14_diff3",
    f"select c_custkey, {_THREE_ACTION} as action, if(in_p, if({_edit('cents')} or not in_r or not in_l, p_cents, l_cents), l_cents) as cents_before, if({_clash('cents')}, l_cents, null) as cents_ours, "
    f"if({_edit('cents')} or (not in_p and not in_l), r_cents, null) as cents_after, if({_edit('nation')} or (not in_p and not in_l), r_nation, null) as nation_after from three where {_THREE_ACTION} <> ''",
)
def d14(m):
    diff, _ = three_way.diff3(*three_versions(m), KEY)
    return diff.select(
        *KEY,
        "action",
        *[F.col("cents")[p].alias(f"cents_{p}") for p in ("before", "ours", "after")],
        F.col("c_nationkey.after").alias("nation_after"),
    )


def _merged(c: str) -> str:
    return f"case when not in_l then r_{c} when in_p and in_l and in_r and l_{c} is not distinct from p_{c} then r_{c} else l_{c} end"


_ALL = "in_p and in_l and in_r"
_MERGE_ROWS = f"({_ALL}) or not in_p"


@query("d15_merge3", f"select c_custkey, {_merged('name')} as c_name, {_merged('nation')} as c_nationkey, {_merged('cents')} as cents from three where {_MERGE_ROWS}")
def d15(m):
    table, _, _ = three_way.merge3(*three_versions(m), KEY)
    return table


@query(
    "d15_merge_rejects",
    "select c_custkey + 50000000 as c_custkey, 'l' as side, cents + extra as cents from three_p, (values (0), (1)) e(extra) where c_custkey % 110 = 0 "
    "union all select c_custkey + 50000000, 'r', cents from three_p where c_custkey % 110 = 0 "
    "union all select c_custkey + 60000000, 'r', cents from three_p, (values (0), (1)) e(extra) where c_custkey % 130 = 0",
)
def d15_rejects(m):
    """Rows of keys that repeat in a version, of every version that has the key."""
    _, _, rejects = three_way.merge3(*three_versions(m), KEY)
    return rejects.select(*KEY, "side", F.coalesce("p.cents", "l.cents", "r.cents").alias("cents"))


@query(
    "d15_merge3_text",
    f"select c_custkey, if({_ALL} and {_clash('cents')}, concat('((( ', p_cents, ' ))) ', l_cents, ' /// ', r_cents), ({_merged('cents')})::varchar) as cents from three where {_MERGE_ROWS}",
)
def d15_text(m):
    table, _, _ = three_way.merge3(*three_versions(m), KEY, conflict_text=True)
    return table.select(*KEY, "cents")


@query(
    "d15_merge_conflicts",
    f"select c_custkey, 'cents' as \"column\", p_cents::varchar as parent, l_cents::varchar as local, r_cents::varchar as remote from three where {_ALL} and {_clash('cents')}",
)
def d15_conflicts(m):
    _, conflicts, _ = three_way.merge3(*three_versions(m), KEY)
    return conflicts


# ---- patch -----------------------------------------------------------------------------


@query("d16_apply_patch", "select * from diff_b")
def d16(m):
    a, b = diff_pair(m)
    table, _ = patch.apply_patch(a, rows.row_diff(a, b, KEY, unique_keys=True), KEY)
    return table


@query("d16_patch_columns", "select p_partkey, p_name, p_brand, p_kind, p_retailprice, p_tier from part_new")
def d16_columns(m):
    a, b = part_pair(m)
    names = {"p_type": "p_kind"}
    plan = cols.column_plan(a, b, names)
    # rows whose new cell is empty carry no change, so the empty cells come with the fill rows only
    diff = rows.row_diff(a, b, ["p_partkey"], renames=names, unique_keys=True, keep_unchanged=True)
    diff = diff.withColumn("action", F.when(F.col("action") == "", "+").otherwise(F.col("action")))
    table, _ = patch.apply_patch(a, diff, ["p_partkey"], list(plan.added), list(plan.dropped), names)
    return table


@query(
    "d16_patch_rejects",
    f"select c_custkey, action from (select ifnull(a.c_custkey, b.c_custkey) as c_custkey, {_ACTION} as action from {_PAIRED}) where action in ('---', '->') and c_custkey % 3 = 0",
)
def d16_rejects(m):
    """Changes whose row the source no longer has."""
    a, b = diff_pair(m)
    diff = rows.row_diff(a, b, KEY, unique_keys=True)
    _, rejects = patch.apply_patch(a.filter("c_custkey % 3 <> 0"), diff, KEY)
    return rejects.select(*KEY, "action")


@query(
    "d19_apply_row_changes",
    "select c_custkey, c_name, c_nationkey, if(c_custkey % 20 = 1, c_acctbal * 2, c_acctbal) as c_acctbal, c_mktsegment from customer where c_custkey % 50 <> 0 "
    "union all select c_custkey + 50000000, null, c_nationkey, c_acctbal, null from customer where c_custkey % 70 = 0",
)
def d19(m):
    base = m.sources.base("customer")
    key = F.col("c_custkey")

    def change(rows_: DataFrame, action: str, cond: Column, val_key: Column, balance: Column) -> DataFrame:
        return rows_.select(
            F.lit(action).alias("action"),
            cond.cast("long").alias("cond_c_custkey"),
            val_key.cast("long").alias("val_c_custkey"),
            balance.cast("double").alias("val_c_acctbal"),
            F.col("c_nationkey").alias("val_c_nationkey"),
        )

    none = F.lit(None)
    changes = (
        change(base.filter(key % 50 == 0), "---", key, none, none)
        .unionByName(change(base.filter((key % 20 == 1) & (key % 50 != 0)), "->", key, key, F.col("c_acctbal") * 2))
        .unionByName(change(base.filter(key % 70 == 0), "+++", none, key + 50000000, F.col("c_acctbal")))
    )
    table, _ = patch.apply_row_changes(base, changes, ["c_custkey"], ["c_custkey", "c_acctbal", "c_nationkey"], keys=KEY)
    return table


@query(
    "d19_row_change_rejects",
    "select '->' as action, c_custkey + 90000000 as clave, null::varchar as nombre from customer where c_custkey % 30 = 0 "
    "union all select '->', c_custkey, null from customer, (values (0), (1)) v(n) where c_custkey % 110 = 0 "
    "union all select unnest(['->', '---']), unnest([c_custkey, null]), unnest([null, c_name]) from customer where c_custkey % 20 = 1 "
    "union all select '---', null, null from customer where c_custkey = 7 "
    "union all select '+++', null, null from customer where c_custkey % 70 = 0",
)
def d19_rejects(m):
    """Changes with conditions of their own: by key or by name, absent, repeated, or two for one row."""
    base = m.sources.base("customer")
    key, none = F.col("c_custkey"), F.lit(None)

    def change(rows_: DataFrame, action: str, by: str | None, clave: Column = none, nombre: Column = none, nueva: Column = none) -> DataFrame:
        return rows_.select(
            F.lit(action).alias("action"),
            (F.array(F.lit(by)) if by else none.cast("array<string>")).alias("conds"),
            clave.cast("long").alias("cond_c_custkey"),
            nombre.cast("string").alias("cond_c_name"),
            F.array(F.lit("c_custkey" if action == "+++" else "c_mktsegment")).alias("vals"),
            nueva.cast("long").alias("val_c_custkey"),
            F.lit("NUEVO").alias("val_c_mktsegment"),
        )

    twice = base.filter(key % 110 == 0)
    clash = base.filter(key % 20 == 1)
    changes = [
        change(base.filter(key % 30 == 0), "->", "c_custkey", key + 90000000),
        change(twice, "->", "c_custkey", key),
        change(twice, "->", "c_custkey", key),
        change(clash, "->", "c_custkey", key),
        change(clash, "---", "c_name", nombre=F.col("c_name")),
        change(base.filter(key % 20 == 3), "->", "c_name", nombre=F.col("c_name")),
        change(base.filter(key == 7), "---", "c_name"),
        change(base.filter(key % 70 == 0), "+++", None, nueva=key),
        change(base.filter(key % 70 == 0), "+++", None, nueva=key + 50000000),
    ]
    _, rejects = patch.apply_row_changes(base, reduce(DataFrame.unionByName, changes), ["c_custkey", "c_name"], ["c_custkey", "c_mktsegment"], keys=KEY)
    return rejects.select("action", F.col("cond_c_custkey").alias("clave"), F.col("cond_c_name").alias("nombre"))


@query(
    "d21_parse_change_text",
    "select c_custkey, 'c_acctbal' as \"column\", case action when '+++' then 'add' when '---' then 'remove' else if(a4 is distinct from b4, 'modify', '') end as category, "
    "if(action = '---', a4, if(action = '->' and a4 is distinct from b4, a4, null)) as old_value, if(action = '+++', b4, if(action = '->' and a4 is distinct from b4, b4, null)) as new_value, null::varchar as parent_value from "
    f"(select {_ACTION} as action, ifnull(a.c_custkey, b.c_custkey) as c_custkey, round(a.c_acctbal * 1000)::bigint::varchar as a4, round(b.c_acctbal * 1000)::bigint::varchar as b4 from {_PAIRED}) where action <> ''",
)
def d21(m):
    return textform.parse_change_text(_text_diff(m), "action", ["c_acctbal"], KEY)


@query(
    "d21_parse_conflict_text",
    f"select c_custkey, 'cents' as \"column\", 'conflict' as category, if(in_l, l_cents::varchar, 'null') as old_value, r_cents::varchar as new_value, p_cents::varchar as parent_value from three where {_THREE_ACTION} = '!->' and {_clash('cents')}",
)
def d21_conflicts(m):
    diff, _ = three_way.diff3(*three_versions(m), KEY)
    shown = textform.as_text(diff, KEY)
    cells = textform.parse_change_text(shown, "action", ["cents"], KEY)
    return cells.filter("category = 'conflict'")
