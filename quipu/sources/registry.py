"""Named tables: stored retail tables, or the same tables derived from order data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import written
from .schemas import RAW_SCHEMAS


class Sources:
    """Raw tables by name.

    `layout="stored"` reads `<root>/<name>.parquet` under the declared schemas;
    `layout="derived"` builds the eight raw tables from the order tables in `root`.
    """

    def __init__(self, spark: SparkSession, root: str, layout: str = "derived"):
        self.spark = spark
        self.root = root
        self.layout = layout
        self._landed: DataFrame | None = None

    def land(self) -> None:
        """Write the joined order rows once, for jobs that read several derived tables.

        Sales, receipts and goals are then plain projections of one stored table; stored
        raw tables need no landing.
        """
        if self.layout == "derived" and self._landed is None:
            self._landed = written(self._order_rows(), "order-rows")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(f"unknown source table {name}")
        if self.layout == "stored":
            reader = self.spark.read.schema(RAW_SCHEMAS[name])
            return reader.parquet(f"{self.root}/{name}.parquet")
        return getattr(self, f"_{name}")()

    def _oficinas(self) -> DataFrame:
        nation, region = self.base("nation"), self.base("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("oficina_id"),
            F.col("n_name").alias("nom_oficina"),
            F.concat("r_name", F.lit("-D"), (F.col("n_nationkey") % 2).cast("string")).alias(
                "departamento"
            ),
            F.col("r_name").alias("region"),
            F.concat(F.lit("ZONA_"), (F.col("n_nationkey") % 4).cast("string")).alias("zona"),
        )

    def _productos(self) -> DataFrame:
        key = F.col("p_partkey")
        number = key.cast("string")
        serie = (
            F.when(key % 97 == 0, F.lit(None).cast("string"))
            .when(key % 89 == 0, "  ")
            .when(
                key % 7 == 0,
                F.concat(F.lit(" "), F.lower("p_brand"), F.lit("-"), number, F.lit(" ")),
            )
            .otherwise(F.concat("p_brand", F.lit("-"), number))
        )
        return self.base("part").select(
            key.alias("producto_id"),
            serie.alias("serie"),
            F.col("p_name").alias("descripcion"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("precio_base"),
            (F.col("p_size") > 5).alias("activo"),
        )

    def _vendedores(self) -> DataFrame:
        return self._suppliers(0, "vendedor_id", "nom_vendedor")

    def _asesores(self) -> DataFrame:
        return self._suppliers(1, "asesor_pdv_id", "nom_asesor_pdv")

    def _suppliers(self, parity: int, key: str, name: str) -> DataFrame:
        rows = self.base("supplier").filter(F.col("s_suppkey") % 2 == parity)
        return rows.select(F.col("s_suppkey").alias(key), F.col("s_name").alias(name))

    def _order_rows(self) -> DataFrame:
        """Orders with the customer's nation and the lowest part and supplier of the lines.

        The customer comes first: the lines, grouped by order, then join without
        another exchange, and what follows stays partitioned by order.
        """
        if self._landed is not None:
            return self._landed
        lines = (
            self.base("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk"))
        )
        customer = self.base("customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey"
        )
        orders = self.base("orders").drop("o_orderpriority")
        return orders.join(customer, "o_custkey").join(lines, "o_orderkey", "left")

    def _ventas(self) -> DataFrame:
        key, seller = F.col("o_orderkey"), F.col("sk")
        online = key % 11 == 0
        return (
            self._order_rows()
            .filter(F.col("o_orderstatus") != "P")
            .select(
                key.alias("venta_id"),
                F.col("c_nationkey").alias("oficina_id"),
                F.col("pk").alias("producto_id"),
                F.when(~online & (seller % 2 == 0), seller).alias("vendedor_id"),
                F.when(~online & (seller % 2 == 1), seller).alias("asesor_pdv_id"),
                F.when(online | seller.isNull(), "ONLINE")
                .when(seller % 2 == 0, "DIRECTO")
                .otherwise("PDV")
                .alias("canal_venta"),
                F.col("o_orderdate").cast("date").alias("fecha_venta"),
                F.when(key % 13 != 0, key).alias("recepcion_id"),
                F.col("o_totalprice").cast("decimal(12,2)").alias("monto_venta"),
            )
        )

    def _recepciones(self) -> DataFrame:
        key = F.col("o_orderkey")
        idle = (key % 150).cast("int")
        return self._order_rows().select(
            key.alias("recepcion_id"),
            F.col("c_nationkey").alias("oficina_id"),
            F.col("pk").alias("producto_id"),
            F.date_sub(F.col("o_orderdate").cast("date"), idle).alias("fecha_recepcion"),
            F.when(F.col("o_orderstatus") == "F", "VENDIDO")
            .when(F.col("o_orderstatus") == "O", "EN_TRANSITO")
            .otherwise("DISPONIBLE")
            .alias("estado_recepcion"),
            F.when(key % 17 != 0, idle).alias("dias_inactivo"),
        )

    def _activaciones(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        rows = self.base("orders").filter((F.col("o_orderstatus") != "P") & (key % 5 != 0))
        first = rows.select(
            key.alias("activacion_id"),
            key.alias("venta_id"),
            F.date_add(day, (key % 30).cast("int")).alias("fecha_activacion"),
            (key % 4 != 0).alias("flag_activo"),
        )
        second = rows.filter(key % 101 == 0).select(
            (-key).alias("activacion_id"),
            key.alias("venta_id"),
            day.alias("fecha_activacion"),
            F.lit(True).alias("flag_activo"),
        )
        return first.unionByName(second)

    def _metas(self) -> DataFrame:
        office, day = F.col("oficina_id"), F.col("fecha_venta")
        return (
            self._ventas()
            .filter((office + F.month(day)) % 9 != 0)
            .select(
                office,
                F.year(day).alias("anio"),
                F.month(day).alias("mes_num"),
                ((office * 7 + F.year(day) * 12 + F.month(day)) % 40).alias("meta_kits"),
            )
            .distinct()
        )
