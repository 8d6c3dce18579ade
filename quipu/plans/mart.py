"""The layered mart over one set of sources; shared tables are built once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import written
from ..sources.registry import Sources
from . import layered
from .staging import STAGING


MODEL_THREADS = 4


class Mart:
    """Models by name. Dimensions are written once and read by every fact."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "derived"):
        self.spark = spark
        self.sources = Sources(spark, root, layout)
        self._staged: dict[str, DataFrame] = {}

    def land(self) -> Mart:
        """Call before a job that reads sales and receipts more than once."""
        self.sources.land()
        return self

    def build(self, *names: str) -> None:
        """Build models that do not need each other from a few driver threads."""
        with ThreadPoolExecutor(MODEL_THREADS) as pool:
            list(pool.map(lambda name: getattr(self, name), names))

    def raw(self, name: str) -> DataFrame:
        return self.sources.raw(name)

    def stg(self, name: str) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = STAGING[name](self.raw(name))
        return self._staged[name]

    @cached_property
    def dim_tiempo(self) -> DataFrame:
        self.land()
        days = layered.dim_tiempo(self.stg("ventas"), self.stg("recepciones"), self.stg("metas"))
        return written(days, "dim_tiempo")

    @cached_property
    def dim_oficina(self) -> DataFrame:
        return layered.dim_oficina(self.stg("oficinas"))

    @cached_property
    def dim_asesor_pdv(self) -> DataFrame:
        return layered.dim_asesor_pdv(self.stg("vendedores"), self.stg("asesores"))

    @cached_property
    def dim_estado(self) -> DataFrame:
        return layered.dim_estado(self.stg("recepciones"), self.stg("productos"))

    @cached_property
    def enriched(self) -> DataFrame:
        return layered.enrich_sales(
            self.stg("ventas"), self.stg("activaciones"), self.stg("productos")
        )

    @cached_property
    def fact_ventas(self) -> DataFrame:
        self.land()
        self.build("dim_tiempo", "dim_oficina", "dim_estado")
        return layered.fact_ventas(
            self.stg("ventas"),
            self.stg("activaciones"),
            self.stg("productos"),
            self.dim_tiempo,
            self.dim_oficina,
            self.dim_estado,
        )

    @cached_property
    def fact_inventario(self) -> DataFrame:
        self.land()
        self.build("dim_tiempo", "dim_oficina", "dim_estado")
        return layered.fact_inventario(
            self.stg("recepciones"),
            self.stg("ventas"),
            self.stg("productos"),
            self.dim_tiempo,
            self.dim_oficina,
            self.dim_estado,
        )

    @cached_property
    def fact_canal(self) -> DataFrame:
        self.land()
        self.build("dim_tiempo", "dim_oficina")
        return layered.fact_canal(
            self.stg("ventas"), self.stg("activaciones"), self.dim_tiempo, self.dim_oficina
        )

    @cached_property
    def fact_desempeno(self) -> DataFrame:
        self.land()
        self.build("dim_tiempo", "dim_oficina", "dim_asesor_pdv")
        return layered.fact_desempeno(
            self.stg("ventas"),
            self.stg("activaciones"),
            self.stg("metas"),
            self.dim_tiempo,
            self.dim_oficina,
            self.dim_asesor_pdv,
        )

    @cached_property
    def fact_metas_pedidos(self) -> DataFrame:
        self.land()
        return layered.fact_metas_pedidos(self.stg("recepciones"), self.stg("metas"))
