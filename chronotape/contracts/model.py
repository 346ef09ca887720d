"""What a contract is: an ordered, typed column list that yields a Spark schema."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import types as T


class ContractError(ValueError):
    """A table does not have the shape or the content its contract declares."""


class TimeGroup(Enum):
    CORE = "core"
    EFFECTIVE = "effective"


# Kind name -> (Spark type, unit). Instants stay LongType: Spark timestamps stop at microseconds.
KINDS: dict[str, tuple[T.DataType, str | None]] = {
    "instant": (T.LongType(), "ns_utc"),
    "money": (T.LongType(), "nanodollar"),
    "shares": (T.LongType(), "share"),
    "instrument": (T.LongType(), None),
    "code": (T.StringType(), None),
    "codes": (T.ArrayType(T.StringType()), None),
    "tape": (T.StringType(), None),
    "sequence": (T.LongType(), None),
    "text": (T.StringType(), None),
    "uuid": (T.StringType(), None),
    "count": (T.IntegerType(), None),
    "bool": (T.BooleanType(), None),
    "ratio": (T.DoubleType(), None),
    "date": (T.DateType(), None),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool = False
    codeset: str | None = None

    @property
    def data_type(self) -> T.DataType:
        return KINDS[self.kind][0]

    @property
    def unit(self) -> str | None:
        return KINDS[self.kind][1]

    def struct_field(self) -> T.StructField:
        notes = {"kind": self.kind, "unit": self.unit, "codeset": self.codeset}
        metadata = {key: value for key, value in notes.items() if value}
        return T.StructField(self.name, self.data_type, self.nullable, metadata)


@dataclass(frozen=True)
class Contract:
    name: str
    version: int
    fields: tuple[Field, ...]
    time_group: TimeGroup = TimeGroup.CORE
    frozen: bool = True

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.name}: repeated column name")

    @property
    def dataset(self) -> str:
        """Directory name of the contract's table: the part after the namespace."""
        return self.name.split(".", 1)[1]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def money_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.kind == "money"]

    @property
    def required_columns(self) -> list[str]:
        return [f.name for f in self.fields if not f.nullable]

    @property
    def is_ordered(self) -> bool:
        return "ingest_index" in self.columns

    def schema(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])


def parse_fields(text: str) -> tuple[Field, ...]:
    """Read ``name kind[codeset]?`` entries, one per line; a trailing ``?`` marks a nullable column."""
    fields = []
    for line in filter(None, (raw.strip() for raw in text.splitlines())):
        name, declared = line.split()
        nullable = declared.endswith("?")
        kind, _, codeset = declared.rstrip("?").rstrip("]").partition("[")
        fields.append(Field(name, kind, nullable, codeset or None))
    return tuple(fields)
