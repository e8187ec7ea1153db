"""JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def parse_payload(df: DataFrame, column: str, schema: str | T.StructType, into: str = "payload") -> DataFrame:
    """Parse JSON text once into a struct (O-1, O-2).

    Text that is malformed or has a field of the wrong type is kept in ``<into>._corrupt``. The struct comes
    out of a generator of one row: as a plain column, filters on its fields would be pushed below it and
    parse the text again for every field they name.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column), with_corrupt, options)
    return df.select("*", F.explode(F.array(parsed)).alias(into))


def is_corrupt(into: str = "payload") -> Column:
    return F.col(into).isNull() | F.col(f"{into}.{CORRUPT}").isNotNull()


def text_array(column: Column, element: str) -> Column:
    """JSON text array → array (O-4)."""
    return F.from_json(column, f"array<{element}>")


def zip_shortest(a: Column, b: Column, names: tuple[str, str]) -> Column:
    """Pair two arrays position by position and stop at the shorter one (O-4)."""
    n = F.least(F.size(a), F.size(b))
    left, right = F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n)
    return F.zip_with(left, right, lambda x, y: F.struct(x.alias(names[0]), y.alias(names[1])))
