"""Column roles, job settings and the declared table schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, types as T


@dataclass(frozen=True)
class Roles:
    """Which column is the target and which columns describe it.

    ``negative`` and ``positive`` are the two target values, as they stand in the data.
    """

    label: str
    negative: object
    positive: object
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "numeric", tuple(self.numeric))
        object.__setattr__(self, "categorical", tuple(self.categorical))
        if self.negative == self.positive:
            raise ValueError("the two target values must differ")
        seen = [self.label, *self.numeric, *self.categorical]
        repeated = sorted({name for name in seen if seen.count(name) > 1})
        if repeated:
            raise ValueError(f"columns with more than one role: {repeated}")

    @property
    def classes(self) -> tuple[object, object]:
        return (self.negative, self.positive)

    @property
    def class_names(self) -> tuple[str, str]:
        """The two target values as Spark prints them."""
        return tuple(str(v).lower() if isinstance(v, bool) else str(v) for v in self.classes)

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.label, *self.categorical, *self.numeric)

    def require(self, df: DataFrame) -> None:
        """Raise if ``df`` lacks one of the named columns."""
        missing = [name for name in self.columns if name not in df.columns]
        if missing:
            raise ValueError(f"columns named in the roles but not in the data: {missing}")


@dataclass(frozen=True)
class JdbcSource:
    """A database table and how to reach it. The driver class is the caller's choice."""

    url: str
    table: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 1000


@dataclass(frozen=True)
class JdbcRange:
    """Split a JDBC read on a numeric or date column; rows outside the bounds are still read."""

    column: str
    lower: object
    upper: object
    partitions: int


@dataclass(frozen=True)
class Settings:
    """Paths, roles and search effort of a train or score job."""

    roles: Roles
    pipeline_path: str
    model_paths: Mapping[str, str]
    output_path: str | None = None
    input_path: str | None = None
    jdbc: JdbcSource | None = None
    jdbc_range: JdbcRange | None = None
    separator: str = ","
    key_columns: tuple[str, ...] = ()
    train_percent: int = 90
    folds: int = 10
    parallelism: int = 2
    seed: int = 42
    check_header: bool = True
    fit_features_on: str = "train"
    handle_invalid: str = "error"
    label_order: str = "roles"
    max_levels: int = 10_000
    training_partitions: int | None = None
    resume_path: str | None = None


COLUMN_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table_schema(columns: Mapping[str, str]) -> T.StructType:
    """Nullable ``StructType`` from an ordered ``{name: type}`` mapping."""
    return T.StructType([T.StructField(name, COLUMN_TYPES[kind], True) for name, kind in columns.items()])
