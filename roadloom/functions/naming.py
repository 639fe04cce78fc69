"""Column-name helpers (driver-side, on the schema only)."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_CAMEL_1 = re.compile(r"(.)([A-Z][a-z]+)")
_CAMEL_2 = re.compile(r"([a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    """``isActive`` -> ``is_active``, ``phoneNumbers`` -> ``phone_numbers``."""
    return _CAMEL_2.sub(r"\1_\2", _CAMEL_1.sub(r"\1_\2", name)).lower()


def snake_case_type(dtype: T.DataType) -> T.DataType:
    """The same type with every struct field name in snake_case."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(snake_case(f.name), snake_case_type(f.dataType), f.nullable) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(snake_case_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, snake_case_type(dtype.valueType), dtype.valueContainsNull)
    return dtype
