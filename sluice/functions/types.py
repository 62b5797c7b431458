"""The type lattice: JSON value kinds to column types, widening, DDL names, quoting.

Everything that runs per record is a built-in Column expression (JVM side);
the Python functions here only work on schema metadata.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column type names the inference emits.
BIGINT = "BIGINT"
BIG_INTEGER = "DECIMAL(38,0)"  # integers beyond 64 bits, to 38 digits
DOUBLE = "DOUBLE"
STRING = "STRING"
BOOLEAN = "BOOLEAN"
ARRAY_STRING = "ARRAY<STRING>"

# Conflict handling modes.
STRICT = "strict"
WIDEN = "widen"

# A routing key (table suffix) must match this to reach SQL. \z, as $ would
# also match before a final newline.
SUFFIX_PATTERN = r"\A[A-Za-z0-9_]+\z"

_SIMPLE_DDL = {
    T.BinaryType: "BINARY",
    T.StringType: "STRING",
    T.IntegerType: "INT",
    T.LongType: "BIGINT",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP_NTZ",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT",
}


def json_kind(value: Column) -> Column:
    """Column type name for one parsed JSON value (a VARIANT), NULL for JSON null.

    Integers are BIGINT, beyond 64 bits DECIMAL(38,0); fractions and exponents
    are DOUBLE; arrays keep their elements as JSON text; objects stay JSON text.
    A decimal of scale 0 with 19 digits or more is an integer that no BIGINT
    holds (``5.0`` has one digit).
    """
    kind = F.schema_of_variant(value)
    digits = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1)
    return (
        F.when(value.isNull() | (kind == F.lit("VOID")), F.lit(None).cast("string"))
        .when(kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(BIGINT))
        .when((digits != "") & (F.lpad(digits, 2, "0") >= "19"), F.lit(BIG_INTEGER))
        .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.lit(DOUBLE))
        .when(kind == F.lit("BOOLEAN"), F.lit(BOOLEAN))
        .when(kind.startswith("ARRAY"), F.lit(ARRAY_STRING))
        .otherwise(F.lit(STRING))
    )


def resolve_kinds(kinds: Column, mode: str) -> Column:
    """Merge the sorted set of kinds seen for one field into one type.

    Integers of both widths are the wider type. ``strict``: else one kind, or
    NULL (the caller reports the conflict). ``widen``: BIGINT with DOUBLE gives
    DOUBLE, any other clash STRING.
    An empty set (only JSON nulls) gives NULL: no evidence of a type.
    """
    n = F.size(kinds)
    one = F.when(n == 1, F.get(kinds, F.lit(0))).when(_both(kinds, BIGINT, BIG_INTEGER), F.lit(BIG_INTEGER))
    if mode == STRICT:
        return one
    if mode == WIDEN:
        return one.when(_both(kinds, BIGINT, DOUBLE), F.lit(DOUBLE)).when(n > 1, F.lit(STRING))
    raise ValueError(f"unknown conflict mode {mode!r}")


def _both(kinds: Column, a: str, b: str) -> Column:
    """Exactly these two kinds were seen."""
    return (F.size(kinds) == 2) & F.array_contains(kinds, a) & F.array_contains(kinds, b)


def is_conflict(kinds: Column, spellings: Column, mode: str) -> Column:
    clash = F.size(spellings) > 1
    if mode == STRICT:
        clash = clash | ((F.size(kinds) > 1) & ~_both(kinds, BIGINT, BIG_INTEGER))
    return clash


def ddl(data_type: T.DataType) -> str:
    """SQL type name for a Spark type, including arrays (the reference lacked them)."""
    if isinstance(data_type, T.ArrayType):
        return f"ARRAY<{ddl(data_type.elementType)}>"
    simple = _SIMPLE_DDL.get(type(data_type))
    if simple is None:
        return data_type.simpleString().upper()
    return simple


def storable(batch_type: str, stored_type: str, mode: str) -> bool:
    """May a batch value of ``batch_type`` be written to a column of ``stored_type``?

    Same type passes, BIGINT into DOUBLE, DECIMAL(38,0) or INT passes; under ``widen`` anything
    also goes into STRING. A fraction never goes into an integer column.
    """
    if batch_type == stored_type:
        return True
    if batch_type == BIGINT and stored_type in (DOUBLE, BIG_INTEGER, "INT", "FLOAT"):
        return True
    return mode == WIDEN and stored_type == STRING


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def struct_ddl(fields: list[tuple[str, str]]) -> str:
    """``STRUCT<`a`: BIGINT, ...>`` for variant extraction by exact spelling."""
    return "STRUCT<" + ", ".join(f"{quote(n)}: {t}" for n, t in fields) + ">"
