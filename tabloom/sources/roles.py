"""Role headers: which column is a key (K), categorical (C), numerical (N), target (L),
or, in a scaled table, numerical (N) or conditioning (G)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import by_name
_TYPES = {"N": T.DoubleType(), "L": T.DoubleType(), "G": T.DoubleType()}


@dataclass
class Roles:
    """Column name to role in header order; `missing` holds the optional default-missing text."""

    roles: dict[str, str]
    missing: dict[str, str] = field(default_factory=dict)

    def of(self, *wanted: str) -> list[str]:
        return [c for c, r in self.roles.items() if r in wanted]

    @property
    def numerical(self) -> list[str]:
        return self.of("N")

    @property
    def categorical(self) -> list[str]:
        return self.of("C")

    @property
    def targets(self) -> list[str]:
        return self.of("L")

    @property
    def conditions(self) -> list[str]:
        return self.of("G")

    @property
    def key(self) -> str:
        return self.of("K")[0]

    @property
    def names(self) -> list[str]:
        return list(self.roles)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _TYPES.get(r, T.StringType())) for c, r in self.roles.items()])

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(pos, c, r, self.missing.get(c)) for pos, (c, r) in enumerate(self.roles.items())]
        return spark.createDataFrame(rows, "pos int, name string, role string, default_missing string")


def read_role_header(spark: SparkSession, path: str) -> Roles:
    """Header CSV: names, then the role row, then optionally a row of missing-value markers."""
    header = spark.read.csv(path, header=True)
    rows = header.limit(2).collect()  # a header file has at most two data rows
    roles = {c: (rows[0][c] or "") for c in header.columns}
    missing = {c: rows[1][c] for c in header.columns if rows[1][c] is not None} if len(rows) > 1 else {}
    return Roles(roles, missing)


def network_columns(header: Roles, conditional: bool) -> tuple[list[str], list[str]]:
    """Data and condition columns of a network: N and G apart, or N+G together without conditions."""
    if conditional:
        return header.of("N"), header.of("G")
    return header.of("N", "G"), []


def derive_scaled_roles(
    columns: Iterable[str],
    numerical: Iterable[str],
    onehot: Iterable[str],
    missing: Iterable[str],
    highfreq: Iterable[str],
    targets: Iterable[str],
) -> Roles:
    """Role of each column of the scaled table; columns that are neither N nor G get ''."""
    conditioning = set(onehot) | set(missing) | set(highfreq) | set(targets)
    numeric = set(numerical)
    return Roles({c: "G" if c in conditioning else "N" if c in numeric else "" for c in columns})


def write_role_header(spark: SparkSession, roles: Roles, path: str) -> None:
    row = spark.createDataFrame([tuple(roles.roles.values())], ", ".join(f"`{c}` string" for c in roles.names))
    row.coalesce(1).write.mode("overwrite").option("emptyValue", "").csv(path, header=True)


def read_typed_table(spark: SparkSession, path: str, roles: Roles, format: str = "csv") -> DataFrame:
    """Numerical and target columns as double, everything else as string; NaN and markers become NULL."""
    if format == "csv":
        # the file's own header may list the columns in another order
        names = spark.read.csv(path, header=True).columns
        known = {c: roles.schema()[c] for c in roles.names}
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in names])
        df = spark.read.schema(schema).csv(path, header=True)
    else:
        df = spark.read.format(format).load(path)
    return typed(df, roles)


def typed(df: DataFrame, roles: Roles) -> DataFrame:
    """Project `df` to the header's columns with the role-derived types; a column that is not there is an error."""
    absent = [c for c in roles.names if c not in df.columns]
    if absent:
        raise ValueError(f"columns of the header that the table lacks: {', '.join(absent)}")

    def one(c: str):
        value = by_name(c)
        marker = roles.missing.get(c)
        if roles.roles[c] in _TYPES:
            value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            if marker not in (None, ""):
                try:
                    number = float(marker)
                except ValueError:
                    raise ValueError(f"missing marker {marker!r} of the numeric column {c} is not a number") from None
                value = F.when(value != F.lit(number), value)
        else:
            value = value.cast("string")
            if marker not in (None, ""):
                value = F.when(value != F.lit(marker), value)
        return value.alias(c)

    return df.select(*[one(c) for c in roles.names])
