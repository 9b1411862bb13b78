"""Values of any JSON type as the types of a layout, without losing what is of another type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{','.join(fields)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_ddl(kind.keyType)},{_ddl(kind.valueType)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def as_type(value: Column, kind: T.DataType) -> Column:
    """A variant as ``kind``, read in one pass.

    Numbers and texts are taken for one another: a text of digits is a number, a fraction where a
    whole number is wanted loses its fraction. Where a text is wanted, lists and objects are JSON and a
    JSON null is NULL. What cannot be taken so is NULL, by itself; the rest of a record stays.
    """
    return F.try_variant_get(value, "$", _ddl(kind))
