"""Reading single values out of JSON, as column expressions.

JSON values travel as VARIANT, so an element is parsed once however many fields are read from it.
``strict=True`` fails on a value that cannot be converted, ``strict=False`` gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_text(value: Column, path: str) -> Column:
    """Text at ``path``; NULL for a JSON null as well as for a missing key."""
    return F.try_variant_get(value, path, "string")


def json_value(value: Column, path: str) -> Column:
    """The JSON value at ``path``: SQL NULL if missing, a JSON null if it is one."""
    return F.try_variant_get(value, path, "variant")


def json_kind(value: Column) -> Column:
    """Type name of a JSON value; MISSING where there is none."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), "MISSING")
        .when(F.is_variant_null(value), "NULL")
        .when(shape.startswith("ARRAY"), "ARRAY")
        .when(shape.startswith("OBJECT"), "OBJECT")
        .when(shape == "STRING", "VARCHAR")
        .when(shape == "BOOLEAN", "BOOLEAN")
        .when(shape == "BIGINT", "BIGINT")
        .otherwise("DOUBLE")
    )


def joined_text(value: Column, separator: str = ", ") -> Column:
    """null or missing to NULL, an array to its joined elements, anything else to its text."""
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None))
        .when(
            F.schema_of_variant(value).startswith("ARRAY"),
            F.array_join(F.try_variant_get(value, "$", "array<string>"), separator),
        )
        .otherwise(F.try_variant_get(value, "$", "string"))
    )


def _checked(result: Column, present: Column, shown: Column, target: str, strict: bool) -> Column:
    if not strict:
        return result
    message = F.concat(F.lit(f"not a valid {target}: "), F.coalesce(shown, F.lit("?")))
    return F.when(present & result.isNull(), F.raise_error(message).cast(target)).otherwise(result)


def text_to_int(text: Column, strict: bool = True) -> Column:
    """Text to INT; fractions are rounded half away from zero."""
    number = F.trim(text).try_cast("decimal(38,9)")
    return _checked(F.round(number).try_cast("int"), text.isNotNull(), text, "int", strict)


def json_to_int(value: Column, strict: bool = True) -> Column:
    """A JSON number, boolean or whole-number text to INT; fractions are rounded half to even."""
    kind = json_kind(value)
    result = F.when(
        kind.isin("BIGINT", "DOUBLE"),
        F.bround(F.try_variant_get(value, "$", "double")).try_cast("int"),
    ).otherwise(F.try_variant_get(value, "$", "int"))
    return _checked(result, ~kind.isin("MISSING", "NULL"), F.to_json(value), "int", strict)


def json_to_boolean(value: Column, strict: bool = True) -> Column:
    result = F.try_variant_get(value, "$", "boolean")
    present = value.isNotNull() & ~F.is_variant_null(value)
    return _checked(result, present, F.to_json(value), "boolean", strict)


def utc_timestamp(text: Column, strict: bool = True) -> Column:
    """ISO-8601 text to the UTC wall clock, whatever the session zone."""
    instant = text.cast("timestamp") if strict else text.try_cast("timestamp")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))
