"""Data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# fixed values: model -> (columns that must be unique, columns that must be present)
CHECKS: dict[str, tuple[list[str], list[str]]] = {
    "fact_ventas": (["venta_id"], ["venta_id", "dtiem_id", "dofic_id", "dest_id"]),
    "dim_oficina": (["dofic_id"], ["dofic_id", "oficina_id"]),
    "dim_asesor_pdv": (["dases_id"], ["dases_id"]),
    "dim_tiempo": (["dtiem_id"], ["dtiem_id"]),
    "dim_estado": (["dest_id"], ["dest_id"]),
    "fact_canal": ([], ["dtiem_id", "dofic_id"]),
    "fact_inventario": ([], ["serie"]),
    "stg_ventas": (["venta_id"], ["venta_id"]),
    "stg_activaciones": (["activacion_id"], ["activacion_id"]),
    "stg_asesores": (["asesor_pdv_id"], ["asesor_pdv_id"]),
    "stg_oficinas": (["oficina_id"], ["oficina_id"]),
    "stg_productos": (["producto_id"], ["producto_id"]),
    "stg_recepciones": (["recepcion_id"], ["recepcion_id"]),
    "stg_vendedores": (["vendedor_id"], ["vendedor_id"]),
}


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.filter("n > 1")


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null reference no parent row has."""
    known = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def table_checks(model: str, df: DataFrame, unique: list[str], present: list[str]) -> DataFrame:
    """Failures of all checks of a table: one row per check.

    The rows are grouped by the first unique column; its groups also carry the missing
    cells, so one grouping answers all checks. A further unique column is grouped by itself.
    """
    misses = {f"m{i}": F.col(c).isNull() for i, c in enumerate(present)}
    if unique:
        groups = df.groupBy(unique[0]).agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in misses.items()])
        repeats = F.count_if((F.col("n") > 1) & F.col(unique[0]).isNotNull())
        counts = groups.agg(repeats.alias("u"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in misses])
    else:
        counts = df.agg(*[F.count_if(c).alias(k) for k, c in misses.items()])
    found = [("unique", unique[0], "u")] if unique else []
    found += [("not_null", c, k) for c, k in zip(present, misses)]
    cells = F.array(*[F.struct(F.lit(test).alias("test"), F.lit(c).alias("column"), F.col(k).alias("failures")) for test, c, k in found])
    rows = counts.select(F.lit(model).alias("model"), F.inline(cells))
    for c in unique[1:]:
        more = duplicates(df, c).agg(F.count("*").alias("failures"))
        rows = rows.unionByName(more.select(F.lit(model).alias("model"), F.lit("unique").alias("test"), F.lit(c).alias("column"), "failures"))
    return rows


def checked_columns(model: str, checks: dict[str, tuple[list[str], list[str]]] | None = None) -> list[str]:
    """The columns that the checks of a model read."""
    unique, present = (checks or CHECKS)[model]
    return list(dict.fromkeys([*unique, *present]))


def run_checks(models: dict[str, DataFrame], checks: dict[str, tuple[list[str], list[str]]] = CHECKS) -> DataFrame:
    """One row per check: model, test, column and number of failures; one pass over each table."""
    parts = [table_checks(name, models[name], *checks[name]) for name in checks if name in models]
    return reduce(DataFrame.unionByName, parts)


def reconcile_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows in the source against rows that arrived, per table."""
    parts = []
    for name, (source, landed) in pairs.items():
        rows = source.select(F.lit(1).alias("s")).unionByName(landed.select(F.lit(0).alias("s")))
        counts = rows.agg(F.count_if(F.col("s") == 1).alias("origen"), F.count_if(F.col("s") == 0).alias("destino"))
        parts.append(counts.select(F.lit(name).alias("tabla"), "origen", "destino"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("cuadra", F.col("origen") == F.col("destino"))


def reconcile_amounts(left: DataFrame, right: DataFrame, by: list[str], amount: str) -> DataFrame:
    """Sums per group on both sides, to the cent; a side without the group counts 0."""
    a = left.groupBy(*by).agg(F.sum(amount).alias("monto_a"))
    b = right.groupBy(*by).agg(F.sum(amount).alias("monto_b"))
    both = a.join(b, by, "full").select(
        *by,
        F.coalesce("monto_a", F.lit(0)).alias("monto_a"),
        F.coalesce("monto_b", F.lit(0)).alias("monto_b"),
    )
    gap = (F.col("monto_a") - F.col("monto_b")).alias("diferencia")
    return both.select("*", gap, (F.col("monto_a") == F.col("monto_b")).alias("cuadra"))
