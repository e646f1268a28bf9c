"""Rule type names matched against Spark types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Spark types a rule type name accepts.
TYPE_FAMILIES = {
    "STRING": ("string",),
    "INTEGER": ("int", "bigint"),
    "DOUBLE": ("double", "float"),
    "DATE": ("date",),
    "TIMESTAMP": ("timestamp", "timestamp_ntz"),
    "BOOLEAN": ("boolean",),
}

# Other spellings of Spark SQL type names.
TYPE_SYNONYMS = {
    "long": "bigint",
    "short": "smallint",
    "byte": "tinyint",
    "real": "float",
    "dec": "decimal",
    "numeric": "decimal",
}


def _sql_map(pairs: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{k}', {v}" for k, v in pairs.items()) + ")"


def type_matches(expected: str, actual: str) -> str:
    """SQL condition: does the type in column ``actual`` (``simpleString`` form) satisfy
    the rule type name in column ``expected``?

    The six rule names accept a family; any other name must be the same Spark type.
    """
    families = _sql_map({k: f"array{v}".replace(",)", ")") for k, v in TYPE_FAMILIES.items()})
    synonyms = _sql_map({k: f"'{v}'" for k, v in TYPE_SYNONYMS.items()})
    compact = f"regexp_replace(lower({expected}), '[ \\t\\n]', '')"
    base = f"regexp_extract({compact}, '^([a-z_]+)', 1)"
    spelled = (
        f"concat(coalesce({synonyms}[{base}], {base}), regexp_replace({compact}, '^[a-z_]+', ''))"
    )
    family = f"{families}[upper(trim({expected}))]"
    return (
        f"coalesce(if({family} IS NOT NULL, array_contains({family}, lower({actual})), "
        f"replace({spelled} || ';', 'decimal;', 'decimal(10,0);') = lower({actual}) || ';'), false)"
    )


# Spark SQL type names without parameters.
PLAIN_TYPES = (
    "string", "int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte", "double",
    "float", "real", "decimal", "dec", "numeric", "date", "timestamp", "timestamp_ntz",
    "timestamp_ltz", "boolean", "binary", "variant", "void",
)
_TYPE_NAME = (
    rf"(?i)^\s*({'|'.join(PLAIN_TYPES)}|(decimal|dec|numeric)\s*\(\s*\d+\s*(,\s*\d+\s*)?\)"
    r"|(var)?char\s*\(\s*\d+\s*\)|(array|map|struct)\s*<.*>|interval\b.*)\s*$"
)


def unknown_type(name: Column) -> Column:
    """Is this no type name that Spark knows? What nested types hold is not looked into."""
    return ~name.rlike(_TYPE_NAME)


def compares_fast(data_type: T.DataType) -> bool:
    """Has values of a fixed, small width."""
    return not isinstance(
        data_type,
        (T.StringType, T.CharType, T.VarcharType, T.BinaryType, T.ArrayType, T.StructType, T.MapType),
    )


def orderable(data_type: T.DataType) -> bool:
    """Can Spark sort by this type? Maps and variants cannot, at any depth."""
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return not isinstance(
        data_type, (T.MapType, T.VariantType, T.CalendarIntervalType)
    )


def column_types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}
