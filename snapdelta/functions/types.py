"""Type names: declared schemas, warehouse columns and source catalogs."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared column type -> Spark type.
DECLARED_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(38, 12),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}

# Spark type -> warehouse column type.
WAREHOUSE_TYPES: dict[type[T.DataType], str] = {
    T.StringType: "String",
    T.IntegerType: "Int32",
    T.LongType: "Int64",
    T.DoubleType: "Float64",
    T.DateType: "Date",
    T.TimestampType: "DateTime64(3)",
    T.BooleanType: "UInt8",
}

# Source catalog type -> warehouse column type; others are String.
CATALOG_TYPES = {
    "NUMBER": "Decimal64(2)",
    "VARCHAR2": "String",
    "CHAR": "String",
    "DATE": "DateTime",
    "TIMESTAMP": "DateTime64(3)",
    "CLOB": "String",
    "BLOB": "String",
}
CATALOG_DEFAULT = "String"

# Names used by schema checks in table configs.
CONFIG_TYPES = {"integer": "int", "string": "string", "timestamp": "timestamp"}

_DECIMAL = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")


def declared_type(name: str) -> T.DataType:
    """Spark type of a declared type name; an unknown name raises KeyError."""
    name = name.strip().lower()
    sized = _DECIMAL.fullmatch(name)
    if sized:
        return T.DecimalType(int(sized.group(1)), int(sized.group(2)))
    return DECLARED_TYPES[name]


def build_schema(definition: Iterable[Mapping]) -> T.StructType:
    """``[{"name", "type", "nullable"}]`` as a StructType; nullable is off unless given."""
    return T.StructType(
        [T.StructField(c["name"], declared_type(c["type"]), bool(c.get("nullable", False))) for c in definition]
    )


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema, in its order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def warehouse_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"Decimal({dtype.precision},{dtype.scale})"
    try:
        return WAREHOUSE_TYPES[type(dtype)]
    except KeyError:
        raise TypeError(f"no warehouse type for {dtype.simpleString()}") from None


def catalog_type(c: str | Column, mapping: Mapping[str, str] = CATALOG_TYPES, sized: bool = False) -> Column:
    """Warehouse type of a source catalog type name, as a column.

    Only exact names match, so ``TIMESTAMP(6)`` becomes String; with ``sized`` a
    trailing ``(n)`` is ignored first.
    """
    name = F.upper(F.col(c) if isinstance(c, str) else c)
    if sized:
        name = F.regexp_replace(name, r"\s*\(.*$", "")
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, name), F.lit(CATALOG_DEFAULT))
