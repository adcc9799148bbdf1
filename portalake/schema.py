"""Table declarations: vendor token -> column, type and key, as a Spark schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import Column
from pyspark.sql import types as T

#: The month that stored tables are laid out by, as yyyy-MM: of a row's date, or of the period the
#: table declares.
PERIOD = "part_month"

# Column kinds and the Spark type each one is stored as.
SPARK_TYPES: dict[str, T.DataType] = {
    "date_ymd": T.StringType(),   # ISO yyyy-MM-dd: sorts like the date
    "date_ym": T.StringType(),    # ISO yyyy-MM
    "text": T.StringType(),
    "int": T.LongType(),
    "whole": T.DecimalType(38, 0),
    "ratio": T.DoubleType(),
    "decimal": T.DoubleType(),
}


def between(first: str, last: str | None = None) -> Callable[[Column], tuple[Column, Column]]:
    """A span named by two request parameters, or by one."""
    return lambda params: (params[first], params[last or first])


@dataclass(frozen=True)
class Field:
    token: str
    column: str
    kind: str
    key: bool = False

    def __post_init__(self) -> None:
        if self.kind not in SPARK_TYPES:
            raise ValueError(f"{self.column}: unknown kind {self.kind!r}")

    @property
    def is_date(self) -> bool:
        return self.kind in ("date_ymd", "date_ym")

    @property
    def struct_field(self) -> T.StructField:
        meta = {"token": self.token, "kind": self.kind, "key": self.key}
        return T.StructField(self.column, SPARK_TYPES[self.kind], True, meta)


@dataclass(frozen=True)
class Table:
    """One dataset. ``wide`` tables have no usable natural key: they keep rows whose key
    parts are NULL, get a surrogate row id and are replaced period by period."""

    service: str
    name: str
    operation: str
    fields: tuple[Field, ...]
    wide: bool = False
    fmt: str = "xml"
    # token -> expression over the raw row, for tokens the vendor does not send itself
    derived: Mapping[str, Callable[[Column], Column]] = dc_field(default_factory=dict)
    # vendor tokens the derived expressions read
    derived_from: tuple[str, ...] = ()
    # What one request of a wide table covers, and so replaces: its period (the date, or the
    # column or request parameter named here, by day or by month) and these columns' values.
    slices: tuple[str, ...] = ()
    period_column: str | None = None
    period_param: str | None = None
    monthly: bool = False
    # What a capture was asked for, read from its request parameters: the parameter that names a
    # column's one value, and the first and last period (digits, a year at least), NULL if open or unknown.
    asks: Mapping[str, str] = dc_field(default_factory=dict)
    span: Callable[[Column], tuple[Column, Column]] | None = None

    def __post_init__(self) -> None:
        for what, values in (("column", self.columns),
                             ("token", [f.token for f in self.fields])):
            repeated = sorted({v for v in values if list(values).count(v) > 1})
            if repeated:
                raise ValueError(f"{self.full_name}: repeated {what} {repeated}")

    def exact(self, *columns: str) -> Table:
        """The same table with these whole-number columns as DECIMAL(38, 0), so that numbers of 19 to 38
        digits are kept."""
        if unknown := sorted(set(columns) - {f.column for f in self.fields if f.kind in ("int", "whole")}):
            raise ValueError(f"{self.full_name}: no whole-number columns {unknown}")
        return replace(self, fields=tuple(replace(f, kind="whole") if f.column in columns else f for f in self.fields))

    @property
    def full_name(self) -> str:
        return f"{self.service}.{self.name}"

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    @property
    def key_columns(self) -> list[str]:
        return [f.column for f in self.fields if f.key]

    @property
    def date_field(self) -> Field | None:
        return next((f for f in self.fields if f.is_date), None)

    @property
    def date_column(self) -> str | None:
        return self.date_field.column if self.date_field else None

    @property
    def required_columns(self) -> list[str]:
        """Columns that must not be NULL in a clean row."""
        return [f.column for f in self.fields if f.is_date or (f.key and not self.wide)]

    @property
    def source_tokens(self) -> list[str]:
        """Tokens read from a vendor row."""
        own = [f.token for f in self.fields if f.token not in self.derived]
        return own + [t for t in self.derived_from if t not in own]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f.struct_field for f in self.fields])

    @property
    def item_type(self) -> T.StructType:
        """Type of one vendor row when only the declared tokens are wanted."""
        return T.StructType([T.StructField(t, T.StringType()) for t in self.source_tokens])


def parse_fields(text: str) -> tuple[Field, ...]:
    """Fields from lines of ``token column kind [key]``."""
    fields = []
    for line in text.strip().splitlines():
        token, column, kind, *key = line.split()
        fields.append(Field(token, column, kind, key == ["key"]))
    return tuple(fields)
