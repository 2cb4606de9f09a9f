"""A warehouse: a model and the DataFrames of its tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from hoarfrost.model import Origin, WarehouseModel
from hoarfrost.sources import tables


class Warehouse(Mapping):
    """Tables by name. A table may be given as a function, which is called when first asked
    for, so that declaring a warehouse reads nothing."""

    def __init__(
        self,
        spark: SparkSession,
        model: WarehouseModel,
        given: dict[str, DataFrame | Callable[[], DataFrame]],
        origins: dict[tuple[str, str], Origin] | None = None,
        reopened: Callable[[dict[str, Callable[[DataFrame], DataFrame]]], Warehouse] | None = None,
    ):
        """`origins` names, by table and column, the raw dates that keys are computed from, and `reopened`
        gives the same warehouse over sources that are narrowed first."""
        self.spark = spark
        self.model = model
        self._tables = dict(given)
        self._origins, self._reopened = origins or {}, reopened

    def bounded(self, name: str, column: str, low: int | None, high: int | None) -> DataFrame:
        """A table without source rows whose key cannot lie from low to high (None: without bound).

        The bounds become bounds on the raw date, before anything is computed from it, so they reach the
        Parquet scan. A column without a known origin gives the whole table.
        """
        origin = self._origins.get((name, column))
        if origin is None or self._reopened is None:
            return self[name]
        return self._reopened({origin.source: lambda source: source.filter(origin.condition(source, low, high))})[name]

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if callable(table) and not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    @classmethod
    def stored(cls, spark: SparkSession, model: WarehouseModel, root: str) -> "Warehouse":
        """A warehouse kept below one folder: facts and bridges by batch, other tables by version."""

        def reader(name: str) -> Callable[[], DataFrame]:
            spec = model[name]
            if spec.kind in ("fact", "bridge"):
                return lambda: spark.read.schema(spec.schema_type()).parquet(f"{root}/{name}")
            return lambda: tables.read_version(spark, f"{root}/{name}", schema=spec.schema_type())

        return cls(spark, model, {name: reader(name) for name in model.tables})
