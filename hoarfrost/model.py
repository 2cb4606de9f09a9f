"""The table model: what a warehouse table is made of, and how tables refer to each other.

The model is plain data. Operators read it on the driver to decide which columns to select
and which joins to declare; the data itself only ever lives in DataFrames.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_KEY = -1
OPEN_END = "9999-12-31"
VERSION_COLUMNS = ("EffectiveFromUtc", "EffectiveToUtc", "IsCurrent", "RowHash")
AUDIT_COLUMNS = ("SourceSystemKey", "BatchId", "LoadedAtUtc")
STAGE_COLUMNS = ("BatchId", "RowNumber")

_TYPE = re.compile(r"^([a-z0-9]+)(?:\((max|\d+)(?:,(\d+))?\))?$")

_SIMPLE_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "tinyint": T.ShortType(),
    "bit": T.BooleanType(),
    "money": T.DecimalType(19, 4),
    "float": T.DoubleType(),
    "date": T.DateType(),
    "datetime2": T.TimestampNTZType(),
    "time": T.StringType(),
    "nvarchar": T.StringType(),
    "char": T.StringType(),
    "uniqueidentifier": T.StringType(),
    "varbinary": T.BinaryType(),
    "binary": T.BinaryType(),
}


def spark_type(declared: str) -> T.DataType:
    base, first, second = _TYPE.match(declared).groups()
    if base == "decimal":
        return T.DecimalType(int(first or 18), int(second or 0))
    return _SIMPLE_TYPES[base]


def text_limit(declared: str) -> int | None:
    base, first, _ = _TYPE.match(declared).groups()
    if base in ("nvarchar", "char") and first not in (None, "max"):
        return int(first)
    return None


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    nullable: bool = True
    aggregation: str | None = None  # measures only: sum, avg or max

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.type)

    @property
    def limit(self) -> int | None:
        return text_limit(self.type)


@dataclass(frozen=True)
class ForeignKey:
    parent: str
    role: str = ""
    nullable: bool = False
    member: bool = False  # bridge grain
    type: str = "int"  # that of the parent's key, set when a model is made

    @property
    def column(self) -> str:
        if not self.role and self.parent == "SourceSystem":
            return "SourceSystemRefKey"
        return f"{self.role}{self.parent}Key"


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str  # ref, dim, bridge or fact
    columns: tuple[Column, ...] = ()
    business_key: Column | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()
    scd: int = 1
    hierarchy: bool = False
    explicit_key: bool = False
    fact_kind: str = "transaction"
    date_roles: tuple[str, ...] = ()
    time_roles: tuple[str, ...] = ()
    unique_members: bool = True
    key_type: str | None = None

    @property
    def key(self) -> str:
        return self.business_key.name if self.explicit_key else f"{self.name}Key"

    @property
    def own_key_type(self) -> str:
        """Facts and bridges grow with the data; a dimension that may pass 2^31 rows says so."""
        return self.key_type or ("bigint" if self.kind in ("fact", "bridge") else "int")

    @property
    def schema(self) -> str:
        return self.kind

    @property
    def measures(self) -> tuple[Column, ...]:
        return tuple(c for c in self.columns if c.aggregation)

    @property
    def is_scd2(self) -> bool:
        return self.kind == "dim" and self.scd == 2

    @property
    def lag_column(self) -> str | None:
        return f"{self.name}LagDays" if self.kind == "fact" and self.fact_kind == "accumulating" else None

    @property
    def references(self) -> tuple[ForeignKey, ...]:
        """Declared foreign keys plus the date and time roles of a fact."""
        dates = tuple(ForeignKey("Date", role) for role in self.date_roles)  # yyyymmdd and seconds fit an int
        times = tuple(ForeignKey("TimeOfDay", role) for role in self.time_roles)
        return dates + times + self.foreign_keys

    def all_columns(self) -> tuple[Column, ...]:
        """Every column in table order, injected ones included."""
        cols = [Column(self.key, self.own_key_type, False)]
        if self.business_key and not self.explicit_key:
            cols.append(replace(self.business_key, nullable=False))
        cols += [Column(fk.column, fk.type, fk.nullable) for fk in self.references]
        cols += list(self.columns)
        if self.lag_column:
            cols.append(Column(self.lag_column, "int"))
        if self.name != "SourceSystem":
            cols.append(Column("SourceSystemKey", "int", False))
        cols += [Column("BatchId", "bigint", False), Column("LoadedAtUtc", "datetime2(3)", False)]
        if self.is_scd2:
            cols += [
                Column("EffectiveFromUtc", "datetime2(3)", False),
                Column("EffectiveToUtc", "datetime2(3)", False),
                Column("IsCurrent", "bit", False),
                Column("RowHash", "binary(32)", False),
            ]
        return tuple(cols)

    def column(self, name: str) -> Column:
        return next(c for c in self.all_columns() if c.name == name)

    def schema_type(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.all_columns()])


@dataclass(frozen=True)
class Origin:
    """The raw date that a key column is computed from and grows with: a source table and its column.

    `grain` says what a key is: a day (yyyymmdd) or a month (yyyymm). A bound on such a key is a bound on
    the date, which a Parquet scan can use, where it cannot use one on the computed key.
    """

    source: str
    column: str
    grain: str = "day"

    def first_day(self, key: int) -> dt.date:
        """The first day with this key or a larger one."""
        year, month, day = (key // 10000, key // 100 % 100, key % 100) if self.grain == "day" else (key // 100, key % 100, 1)
        if month > 12:
            return dt.date(year + 1, 1, 1)
        start = dt.date(year, max(month, 1), 1)
        last = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return min(start + dt.timedelta(days=max(day if month else 1, 1) - 1), last)

    def condition(self, source: DataFrame, low: int | None, high: int | None) -> Expression:
        """What holds for the source rows of all keys from low to high (None: without bound)."""
        raw, kind = F.col(self.column), source.schema[self.column].dataType
        out = F.lit(True)
        if low is not None:
            out = raw >= F.lit(self.first_day(low).isoformat()).cast(kind)
        if high is not None:
            out = out & (raw < F.lit(self.first_day(high + 1).isoformat()).cast(kind))
        return out


@dataclass(frozen=True)
class Edge:
    """One foreign key of the catalog, from a child table to the table it names."""

    child: str
    column: str
    parent: str
    parent_key: str


@dataclass
class WarehouseModel:
    tables: dict[str, TableSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, *specs: TableSpec) -> "WarehouseModel":
        """A model of these tables, with every foreign key as wide as its parent's key."""
        keys = {s.name: s.own_key_type for s in specs}
        typed = [
            replace(s, foreign_keys=tuple(replace(fk, type=keys.get(fk.parent, fk.type)) for fk in s.foreign_keys)) for s in specs
        ]
        return cls({s.name: s for s in typed})

    def __getitem__(self, name: str) -> TableSpec:
        return self.tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def of_kind(self, *kinds: str) -> list[TableSpec]:
        return sorted((t for t in self.tables.values() if t.kind in kinds), key=lambda t: (t.kind, t.name))

    def edges(self, table: str) -> list[Edge]:
        spec = self.tables[table]
        found = [
            Edge(table, fk.column, fk.parent, self.tables[fk.parent].key)
            for fk in spec.references
            if fk.parent in self.tables
        ]
        return sorted(found, key=lambda e: e.column)

    def natural_column(self, fk: ForeignKey) -> str:
        """Name of the staging column that carries the parent's business key."""
        parent = self.tables[fk.parent]
        bk = parent.business_key.name
        return f"{fk.role}{bk}" if bk == f"{fk.parent}Key" else f"{fk.role}{fk.parent}{bk}"

    def staging_columns(self, table: str) -> tuple[Column, ...]:
        """Staging mirror: own columns, natural keys in place of foreign keys, batch and row."""
        spec = self.tables[table]
        cols: list[Column] = []
        if spec.business_key and not spec.explicit_key:
            cols.append(spec.business_key)
        cols += [c for c in spec.columns]
        for fk in spec.references:
            parent = self.tables.get(fk.parent)
            if parent is None:
                continue
            if parent.explicit_key:
                cols.append(Column(fk.column, fk.type, fk.nullable))
            else:
                cols.append(Column(self.natural_column(fk), parent.business_key.type, fk.nullable))
        cols += [Column("BatchId", "bigint", False), Column("RowNumber", "bigint", False)]
        return tuple(cols)

    def staging_schema(self, table: str) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.staging_columns(table)])

    def leaves(self) -> list[TableSpec]:
        return [t for t in self.of_kind("dim") if not t.hierarchy]


def hierarchy(*levels: str, **overrides: TableSpec) -> list[TableSpec]:
    """One table per level, each pointing at the level above it."""
    specs, above = [], None
    for level in levels:
        specs.append(
            overrides.get(level)
            or TableSpec(
                name=level,
                kind="dim",
                business_key=Column(f"{level}Code", "nvarchar(30)", False),
                columns=(Column(f"{level}Name", "nvarchar(120)", False),),
                foreign_keys=(ForeignKey(above),) if above else (),
                hierarchy=True,
            )
        )
        above = level
    return specs
