"""From documents to typed rows: one row per array element, with the file it came from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_values as J

LINEAGE = ("meta_file_name", "meta_file_modified")


@dataclass(frozen=True)
class Field:
    """A column of the flattened relation.

    ``kind``: text, int (a JSON number), int_text (an integer written as text), boolean,
    joined (null, a scalar or an array of texts) or json (the value as it is).
    """

    name: str
    source: str
    kind: str = "text"

    def read(self, element: Column, strict: bool) -> Column:
        path = f"$.{self.source}"
        value = J.json_value(element, path)
        column = {
            "text": lambda: J.json_text(element, path),
            "int": lambda: J.json_to_int(value, strict),
            "int_text": lambda: J.text_to_int(J.json_text(element, path), strict),
            "boolean": lambda: J.json_to_boolean(value, strict),
            "joined": lambda: J.joined_text(value),
            "json": lambda: value,
        }[self.kind]()
        return column.alias(self.name)


def elements(raw: DataFrame, levels: Sequence[str] = ("data",), strict: bool = True) -> DataFrame:
    """One row ``(element VARIANT, lineage…)`` per element of the array at the path ``levels[0]``.

    Each further level unnests an array inside the elements of the level before. NULL, missing
    and empty arrays give no row. A value that is no array fails, or gives no row if not strict.
    The whole document is parsed once.
    """
    rows = raw.select(_outer(levels[0], strict).alias("element"), *LINEAGE)
    for path in levels[1:]:
        rows = rows.select(_inner(path, strict).alias("element"), *LINEAGE)
    return rows


def _outer(path: str, strict: bool) -> Column:
    names = path.split(".")
    schema = "array<variant>"
    for name in reversed(names):
        schema = f"struct<{name}: {schema}>"
    array = F.from_json("data", schema)
    for name in names:
        array = array[name]
    if strict:
        # Only where no array was found is the document looked at again.
        otherwise = F.when(F.get_json_object("data", f"$.{path}").isNotNull(), _no_array(path))
        array = F.coalesce(array, otherwise)
    return F.explode(array)


def _inner(path: str, strict: bool) -> Column:
    value = J.json_value(F.col("element"), f"$.{path}")
    array = F.try_variant_get(F.col("element"), f"$.{path}", "array<variant>")
    if strict:
        present = value.isNotNull() & ~F.is_variant_null(value)
        array = F.coalesce(array, F.when(present, _no_array(path)))
    return F.explode(array)


def _no_array(path: str) -> Column:
    return F.raise_error(F.lit(f"no array at {path}")).cast("array<variant>")


def flatten(
    raw: DataFrame, fields: Sequence[Field], levels: Sequence[str] = ("data",), strict: bool = True,
) -> DataFrame:
    """Rows of ``fields`` plus lineage, all versions, duplicates kept."""
    rows = elements(raw, levels, strict)
    return rows.select(*[f.read(F.col("element"), strict) for f in fields], *LINEAGE)


def flatten_structs(df: DataFrame, array: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array of structs, its fields as columns."""
    return df.select(*keep, F.inline(array))
